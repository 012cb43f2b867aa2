"""Operators 7, 9 and 10, components and the pipeline."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from promo_engine.llm import ann, components, ngram_join, sharding


def brute_links(texts):
    sets = [set(ngram_join.shingles((t or "").encode()).tolist()) for t in texts]
    return [[j for j, b in enumerate(sets) if j != i and a and b and len(a & b) >= 0.8 * len(a | b) - 1e-9]
            for i, a in enumerate(sets)]


def classes(links):
    root = list(range(len(links)))
    for _ in links:
        root = [min([root[i], *(root[j] for j in links[i])]) for i in range(len(links))]
    return root


def near_copies():
    rng = random.Random(9)
    word = lambda: f"t{rng.randint(0, 5000)}"
    rows, boiler = [], [word() for _ in range(30)]
    for _ in range(30):
        base = [word() for _ in range(rng.randint(8, 150))]
        for _ in range(rng.randint(1, 8)):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                copy[rng.randrange(len(copy))] = word()
            rows.append(" ".join(copy + (boiler if rng.random() < 0.4 else [])))
    return rows


@pytest.mark.parametrize("bucket, block", [(2048, 1024), (4, 5)])     # the small ones recurse and split into blocks
def test_ngram_join_is_brute_force(llm, bucket, block):
    texts = near_copies()
    docs = llm.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r for r in ngram_join.near_groups(docs, bucket=bucket, block_entries=block).collect()}
    links = brute_links(texts)
    root = classes(links)
    assert [got[i].n_links for i in range(len(texts))] == [len(x) for x in links]
    assert [got[i].class_id for i in range(len(texts))] == root
    assert {i for i in got if got[i].kept} == set(root)


def test_ngram_join_edges(edge, edge_rows, empty):
    got = ngram_join.near_groups(edge).collect()
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    assert len(got) == len(edge_rows)
    assert (by_id[5].class_id, by_id[5].n_links, by_id[5].kept) == (4, 1, False)
    assert {by_id[i].class_id for i in (6, 7, 8)} == {6} and by_id[7].n_links == 2
    assert by_id[9].n_links == 2 and by_id[9].class_size == 3            # the repeated row and the one without id
    assert all(by_id[i].n_links == 0 and by_id[i].class_size == 1 for i in (1, 2, 3))
    kept = ngram_join.keep_one(edge)
    assert kept.columns == edge.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids == Counter({i: 1 for i in (1, 2, 3, 4, 6, 9, 10, 11, 12)} | {None: 1})
    assert ngram_join.near_groups(empty).count() == 0 and ngram_join.keep_one(empty).count() == 0


def test_components_chain(llm):
    n = 60
    edges = [(i, i + 1) for i in range(n - 1)] + [(100, 101), (101, 100), (103, 103), (200, 7)]
    got = dict(components.components(llm.createDataFrame(edges, "a bigint, b bigint")).collect())
    assert got == {**{i: 0 for i in range(n)}, 200: 0, 100: 100, 101: 100}


def check_shards(rows, texts, shards, whole):
    sizes = Counter()
    for r in rows:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
        sizes[r.shard] += r.size
    assert Counter((r.size, r.text_crc32) for r in rows) == Counter(
        (len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for t in texts)
    for s in sizes:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    total, largest = sum(sizes.values()), max(r.size for r in rows)
    assert max(sizes.values()) <= total / shards * (1 + 2 * whole) + 2 * largest


def test_sharding_hot_group(llm):
    rng = random.Random(2)
    texts = ["one hot text of many copies"] * 700 + ["".join(rng.choices("abc de", k=rng.randint(0, 300))) for _ in range(1300)]
    texts += ["pair"] * 4 + [None, ""]
    docs = llm.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = sharding.shard(docs).collect()
    check_shards(rows, texts, 24, 0.01)
    assert len({r.shard for r in rows if r.text_crc32 == zlib.crc32(b"pair")}) == 1             # a small group stays together


def test_sharding_edges(edge, edge_rows, empty, llm):
    check_shards(sharding.shard(edge).collect(), [r[1] for r in edge_rows], 24, 0.01)
    assert sharding.shard(empty).count() == 0
    same = llm.createDataFrame([(None, "x")] * 500, "doc_id bigint, text string")
    check_shards(sharding.shard(same, shards=5).collect(), ["x"] * 500, 5, 0.01)


def exact_nearest(rows, k=20):
    rows = [(i, np.array(v, dtype=float)) for i, v in rows]
    out = {}
    for q, v in rows:
        if q % 20 == 0:
            near = sorted(((-float((v * x).sum()), i) for i, x in rows if i != q and len(x) == len(v)))[:k]
            out[q] = [(i, -s) for s, i in near]
    return out


def as_lists(got):
    out = {}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_nearest_recall(spark, sf, llm):
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet")
    want = exact_nearest([(r.vec_id, r.embedding) for r in vectors.collect()])
    got = as_lists(ann.nearest(vectors).collect())
    assert set(got) == set(want) and all(len(got[q]) == len(want[q]) for q in want)
    hit = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hit >= 0.9 * sum(map(len, want.values()))


def test_nearest_with_uneven_lengths(llm):
    rng = np.random.default_rng(8)
    for d in (64, 100):
        lengths = np.where(rng.random(3000) < 0.01, 10.0, 1.0) * (1 + rng.pareto(1.5, 3000))
        x = rng.normal(size=(3000, d))
        x *= (lengths / np.linalg.norm(x, axis=1))[:, None]
        rows = [(i, v.tolist()) for i, v in enumerate(x)]
        got = as_lists(ann.nearest(llm.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect())
        want = exact_nearest(rows)
        # hashed, not searched in full: nearly all are found, and what is found is ranked exactly
        hit = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
        assert set(got) == set(want) and hit >= 0.97 * 20 * len(want)
        score = {q: dict(zip(range(3000), (x[q] * x).sum(axis=1))) for q in want}
        for q in got:
            np.testing.assert_allclose([s for _, s in got[q]], [score[q][i] for i, _ in got[q]])
            assert [s for _, s in got[q]] == sorted((s for _, s in got[q]), reverse=True)


def test_nearest_ties_copies_and_few(llm):
    rng = np.random.default_rng(3)
    rows = [(i, [1.0, 2.0, 2.0]) for i in range(60)] + [(i, rng.normal(size=3).tolist()) for i in range(60, 90)]
    bad = [(100, None), (120, []), (140, [0.0, 0.0, 0.0]), (160, [1.0, None, 2.0]), (180, [1.0, float("nan"), 2.0]),
           (200, [float("inf"), 0.0, 0.0]), (None, [1.0, 1.0, 1.0]), (220, [3.0, 4.0])]
    docs = llm.createDataFrame(rows + rows[:3] + bad, "vec_id bigint, embedding array<double>").withColumns(
        {c: F.lit(0) for c in ("rep", "v", "q", "score", "rank")})
    got = as_lists(ann.nearest(docs, chunk=16).collect())
    want = exact_nearest(rows)
    assert set(got) == set(want)
    for q in want:
        assert len(got[q]) == 20
        if q < 60:
            assert [i for i, _ in got[q]] == [i for i, _ in want[q]]     # equal vectors: by id
        np.testing.assert_allclose([s for _, s in got[q]][:1], [s for _, s in want[q]][:1])
    few = [(0, [1.0, 0.0, 0.5, 0.0]), (1, [0.0, -1.0, 0.0, 3.0]), (2, [-1.0, 0.1, 0.0, 0.0])]
    assert [i for i, _ in as_lists(ann.nearest(llm.createDataFrame(few, "vec_id bigint, embedding array<float>")).collect())[0]] == [1, 2]
    assert ann.nearest(docs.where("false")).count() == 0


def test_pipeline_stages(spark, sf, llm):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dedup", "mixing", "bpe"]
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, sf)
        after = corpus_pipeline.common.cut_lineage(after, "test")
        if name == "bpe":
            assert after.count() == before.count() and "ids" in after.columns
        else:
            assert after.columns == docs.columns and 0 < after.count() <= before.count()
        if name == "near_dedup":
            texts = [r.text for r in after.collect()]
            assert not any(brute_links(texts))
        before = after
    assert corpus_pipeline.run(spark, sf).count() == before.count()


def test_pipeline_on_edge_and_empty(edge, empty, spark, sf, llm):
    for docs in (edge, empty):
        for _, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.common.cut_lineage(stage(spark, docs, sf), "test")
        assert "ids" in docs.columns


def spread_vectors(n, d, kind, seed=0):
    g = np.random.default_rng(seed)
    x = g.normal(size=(n, d))
    length = {"even": np.ones(n), "lognormal": np.exp(g.normal(size=n)), "lognormal_half": np.exp(0.5 * g.normal(size=n)),
              "pareto": 1 + g.pareto(1.5, n)}[kind]
    return x * (length / np.linalg.norm(x, axis=1))[:, None]


@pytest.mark.parametrize("n, d, kind", [(20_000, 64, "even"), (20_000, 64, "lognormal_half"), (20_000, 64, "lognormal"),
                                        (20_000, 64, "pareto"), (20_000, 100, "lognormal_half"), (20_000, 100, "pareto"),
                                        (500, 64, "even"), (2_000, 64, "even")])
def test_hashed_candidates(n, d, kind):
    """Recall of the tables' candidates on vectors without any structure, and how many pairs they compare."""
    x = spread_vectors(n, d, kind)
    length = np.linalg.norm(x, axis=1)
    codes = ann.buckets(ann.turned(x, ann.TABLES, 5))
    at = np.arange(0, n, 20)[:256]
    hit = ann.found_in(codes, ann.turned(x[at], ann.TABLES, 5), ann.probes_for(n, d, ann.TABLES))
    if kind != "even":
        hit[:, length > np.quantile(length, 1 - ann.longest(n))] = True
    s = x[at] @ x.T
    s[np.arange(len(at)), at] = -np.inf
    want = np.argsort(-s, axis=1)[:, :20]
    assert np.take_along_axis(hit, want, 1).mean() >= 0.92
    if n == 20_000:
        assert hit.mean() * (n / 20) * n < n * n / 100


def test_probed_buckets_are_the_best():
    g = np.random.default_rng(1)
    a, b = g.normal(size=(2, 5, 32))
    for probes in (1, 40, 700, 64 * 64):
        got = ann.probed(a, b, probes)
        for i in range(5):
            s = (np.stack([a[i], -a[i]], 1).ravel()[:, None] + np.stack([b[i], -b[i]], 1).ravel()[None, :]).ravel()
            assert len(set(got[i].tolist())) == probes
            assert np.allclose(np.sort(s[got[i]]), np.sort(np.sort(s)[-probes:]))


def test_fast_rotation_is_the_matrix():
    x = np.random.default_rng(2).normal(size=(7, 100))
    dense = ann.turned(x, 2, 9)
    plain = np.stack([ann.rotated(x, t, 9) for t in range(4)], axis=1)
    assert np.abs(dense - plain).max() < 1e-12 and np.abs(np.linalg.norm(dense, axis=2) - 1).max() < 1e-12


def test_nearest_recall_on_even_lengths(llm):
    """The hashed search itself, over several blocks and cells."""
    x = spread_vectors(3_000, 64, "even", 4)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = as_lists(ann.nearest(llm.createDataFrame(rows, "vec_id bigint, embedding array<double>"), chunk=64,
                               block_values=64 * 700).collect())
    want = exact_nearest(rows)
    hit = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert set(got) == set(want) and all(len(got[q]) == 20 for q in got)
    assert 0.92 * 20 * len(want) <= hit < 20 * len(want)                 # hashed: nearly all, not all
