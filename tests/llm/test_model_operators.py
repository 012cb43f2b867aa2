"""Operators 4, 6 and 8: recursions against plain versions, fits on planted data, edge cases."""

import tracemalloc
import zlib
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from promo_engine.llm import common, hmm_lm, mixing, quality


def chain(rng, k=3, m=5):
    return hmm_lm.Params(rng.dirichlet(np.ones(k)), rng.dirichlet(np.ones(k), k), rng.dirichlet(np.ones(m), k).T)


def plain(p, seq):
    n, k = len(seq), len(p.start)
    al, be = np.zeros((n, k)), np.ones((n, k))
    al[0] = p.start * p.emit[seq[0]]
    for t in range(1, n):
        al[t] = (al[t - 1] @ p.move) * p.emit[seq[t]]
    for t in range(n - 2, -1, -1):
        be[t] = p.move @ (p.emit[seq[t + 1]] * be[t + 1])
    total = al[-1].sum()
    emit = np.zeros_like(p.emit)
    np.add.at(emit, seq, al * be / total)
    moves = sum((np.outer(al[t], p.emit[seq[t + 1]] * be[t + 1]) * p.move / total for t in range(n - 1)), np.zeros((k, k)))
    return np.log(total), (al * be / total)[0], moves, emit


@pytest.mark.parametrize("at_once", [1, 3, 1024])
@pytest.mark.parametrize("most", [1, 2, 4, 100])
def test_forward_backward_is_plain(most, at_once, monkeypatch):
    monkeypatch.setattr(hmm_lm, "SEGMENTS_AT_ONCE", at_once)
    rng = np.random.default_rng(1)
    p, sizes = chain(rng), np.array([1, 7, 3, 20, 2, 11])
    sym = rng.integers(0, 5, sizes.sum())
    seqs = np.split(sym, np.cumsum(sizes)[:-1])
    want = [plain(p, s) for s in seqs]
    np.testing.assert_allclose(hmm_lm.log_likelihoods(p, sym, sizes, most), [w[0] for w in want], rtol=1e-12)
    got = hmm_lm.expected_counts(p, sym, sizes, most)
    for g, k in zip(got[:3], (1, 2, 3), strict=True):
        np.testing.assert_allclose(g, sum(w[k] for w in want), rtol=1e-10, atol=1e-12)


def test_passes_use_memory_again():
    """After the first group of a worker, a pass takes no new memory for vectors of tokens; what other documents left
    in it changes nothing."""
    rng = np.random.default_rng(4)
    p, sizes = chain(rng, 6, 50), np.full(400, 300)
    sym = rng.integers(0, 50, sizes.sum())
    small = sym[:90], np.array([7, 80, 3])
    want = hmm_lm.expected_counts(p, *small)
    first = hmm_lm.expected_counts(p, sym, sizes)
    tracemalloc.start()
    again = hmm_lm.expected_counts(p, sym, sizes)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < len(sym) * 6 * 8, most            # less than one such array
    for a, b in zip([*first, *want], [*again, *hmm_lm.expected_counts(p, *small)], strict=True):
        np.testing.assert_array_equal(a, b)


def test_hmm_scores_edges_and_base(edge, edge_rows):
    got = hmm_lm.score(edge, block_tokens=5000, range_entries=50, symbols=64, start_passes=1, passes=1).collect()
    fold = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    toks = [(r[0], (r[1] or "").encode().lower().split() + [b""]) for r in edge_rows]
    counts = {}
    for i, t in toks:
        if not fold(i):
            for w in t:
                counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    base = lambda t: sum(np.log10((counts.get(w, 0) + 0.5) / (n + 0.5 * (v + 1))) for w in t)
    want = sorted((i or 0, fold(i), len(t), sum(w in counts for w in t), n, round(base(t), 6)) for i, t in toks)
    assert sorted((r.doc_id or 0, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
                  for r in got) == want
    assert all(np.isfinite(r.score) and r.score < 0 for r in got)


def test_hmm_model_is_normalised(llm):
    """Over all one-word texts of the vocabulary, an unknown word per symbol and the empty text, with one
    symbol, probabilities of ending texts add up with those of going on to 1."""
    docs = llm.createDataFrame([(0, "a b"), (5, "a c a")] * 3, "doc_id bigint, text string")
    probe = docs.unionByName(llm.createDataFrame([(100 + k, t) for k, t in enumerate(["", "a", "b", "c", "zz"])],
                                                 docs.schema))
    got = hmm_lm.score(probe.withColumn("doc_id", F.col("doc_id")), symbols=1, states=1, start_passes=0, passes=1)
    assert got.where("score >= 0").count() == 0


def test_hmm_beats_base_on_two_languages(llm):
    rng = np.random.default_rng(0)
    texts = [" ".join(f"{'xy'[k % 2]}{int(w)}" for w in rng.zipf(1.6, 60) % 50) for k in range(300)]
    out = hmm_lm.score(llm.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), states=2,
                       start_passes=10, passes=5).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert out[0] > out[1] + 100


def test_hmm_passes_read_all_blocks(llm, monkeypatch):
    read, one_pass = [], hmm_lm._pass
    monkeypatch.setattr(hmm_lm, "_pass", lambda blocks, *a: read.append(blocks.count()) or one_pass(blocks, *a))
    texts = [" ".join(f"w{(i * j) % 13}" for j in range(40)) for i in range(120)]
    docs = llm.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    hmm_lm.score(docs, block_tokens=100, symbols=8, states=2, start_passes=2, passes=1)
    assert len(read) == 3 and len(set(read)) == 1 and read[0] > 12


def test_hmm_blocks_are_read_and_written_a_few_at_a_time(llm, monkeypatch):
    """However many blocks a task writes, a row group (and so a page, and a batch of the reader) holds a few; texts
    come to Python in small batches."""
    kept, batches, cut, coded = {}, [], hmm_lm.C.cut_lineage, hmm_lm.coded_blocks

    def noted(df, name, **options):
        batches.append((name, int(llm.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))))
        kept[name] = cut(df, name, **options)
        return kept[name]
    monkeypatch.setattr(hmm_lm.C, "cut_lineage", noted)
    monkeypatch.setattr(hmm_lm, "coded_blocks", lambda rows, *a: coded(rows.coalesce(1), *a))
    texts = [" ".join(f"w{(i * j) % 13}" for j in range(40)) for i in range(120)]
    docs = llm.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert hmm_lm.score(docs, block_tokens=100, symbols=8, states=2, start_passes=1, passes=1).count() == len(texts)
    groups = [m.row_group(i).num_rows for m in (pq.read_metadata(urlparse(f).path) for f in kept["lm-blocks"].inputFiles())
              for i in range(m.num_row_groups)]
    assert sum(groups) == 40 and max(groups) <= hmm_lm.BLOCKS_AT_ONCE
    assert dict(batches)["lm-blocks"] <= hmm_lm.TEXTS_AT_ONCE


def test_byte_strings_are_the_values():
    words = [b"a", b"", "Ünï".encode(), b"x" * 300, b"b"]
    for kind in (pa.binary(), pa.large_binary()):
        lists = pa.array([words, [], words[3:]], type=pa.list_(kind))
        got = [common.byte_strings(lists.slice(i, 1).flatten()) for i in range(3)]
        assert got == lists.to_pylist() and common.byte_strings(pa.array([b""], type=kind)) == [b""]


def test_hmm_empty_and_untrained(empty, llm):
    assert hmm_lm.score(empty).count() == 0
    held = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 5 == 1)
    (row,) = hmm_lm.score(llm.createDataFrame([(held, "a b")], "doc_id bigint, text string")).collect()
    assert row.held_out and row.n_known == 0 and row.train_tokens == 0 and np.isfinite(row.score)


def test_quality_learns_and_keeps(spark, sf, llm):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    out = quality.classify(docs, labels)
    seen = out.join(labels, "doc_id")
    right = seen.select(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0]
    assert right > 0.9
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in out.where("predicted = 1").collect())


def test_quality_score_is_the_density_difference():
    rng = np.random.default_rng(2)
    d = len(quality.STATISTICS)
    x = {k: rng.normal(k, 1 + k, (500, d)) for k in (0, 1)}
    model = quality.fit({k: (float(len(v)), v.sum(0), v.T @ v) for k, v in x.items()}, 0.0, 0.0, 0.0)
    probe = rng.normal(0.5, 1, (5, d))
    log = {}
    for k, v in x.items():
        c = np.cov(v.T, bias=True) + 1e-9 * np.eye(d)
        z = probe - v.mean(0)
        log[k] = -0.5 * np.linalg.slogdet(c)[1] - 0.5 * np.einsum("ij,jk,ik->i", z, np.linalg.inv(c), z)
    np.testing.assert_allclose(model.score(probe), 1 / (1 + np.exp(log[0] - log[1])), rtol=1e-6)


def test_quality_edges(edge, edge_rows, empty, no_labels, llm):
    got = quality.classify(edge, no_labels).collect()
    assert len(got) == len(edge_rows) and {r.score for r in got} == {0.5} and {r.predicted for r in got} == {1}
    one = llm.createDataFrame([(2, 0, 0), (6, 0, 1), (None, 1, 0), (7, None, 0)], no_labels.schema)
    assert {r.score for r in quality.classify(edge, one).collect()} == {0.0}
    assert quality.classify(empty, one).count() == 0 and quality.keep_good(empty, one).count() == 0
    assert quality.keep_good(edge, no_labels).count() == len(edge_rows)


def test_rates_reach_targets(llm):
    rng = np.random.default_rng(4)
    p = rng.dirichlet([0.2, 0.2, 0.2], 400)
    t = rng.integers(1, 500, 400)
    rows = llm.createDataFrame([(int(a), [float(y) for y in b]) for a, b in zip(t, p, strict=True)],
                               "tokens bigint, p array<double>")
    fit = mixing.fit_rates(rows, [0.7, 0.2, 0.1], total=50_000.0)
    np.testing.assert_allclose(fit.totals, [35_000, 10_000, 5_000], atol=6)
    r = mixing.rates(p, fit.steps)
    assert (r >= 0).all()
    np.testing.assert_allclose((t * r) @ p, fit.totals)
    bare = mixing.fit_rates(rows.withColumn("p", F.array(F.lit(1.0), F.lit(0.0), F.lit(0.0))), [0.5, 0.3, 0.2])
    assert np.isfinite(bare.totals).all() and bare.passes < mixing.PASSES     # targets no rates reach


def test_mixing_edges(edge, edge_rows, empty, no_labels, llm):
    out, _ = mixing.mix(edge, no_labels)
    got = out.collect()
    assert len(got) == len(edge_rows) and all(abs(sum(r.posteriors) - 1) < 1e-9 and r.rate >= 0 for r in got)
    assert {r.n_tokens for r in got if r.doc_id in (1, 2, 3)} == {0}
    assert mixing.mix(empty, no_labels)[0].count() == 0
    assert mixing.mixed(edge, no_labels).columns == edge.columns


def test_mixing_shifts_domains(spark, sf, llm):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    out, fit = mixing.mix(docs, labels)
    seen = out.join(labels, "doc_id").groupBy("quality", "toxic").agg(F.avg("rate").alias("r")).collect()
    rate = {(r.quality, r.toxic): r.r for r in seen}
    assert rate[1, 0] > 0.9 > 0.5 > rate[1, 1] and rate[0, 0] < 0.5
    copies = out.groupBy("copies").count().collect()
    assert mixing.mixed(docs, labels).count() == sum(r["copies"] * r["count"] for r in copies)
