"""Operators 11, 12 and 13."""

import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from promo_engine.llm import collocations, common, hard_negatives, language

SF = "/root/testdata/sf0.01"


# ---- 11: hard negatives ----------------------------------------------------------------------
def plain_negatives(rows, step):
    """The contract's rules by whole-number products of every pair."""
    one = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        vec = [int(np.floor(256.0 * x)) for x in v]
        one[i] = min(one.get(i, (label, vec)), (label, vec))
    out = []
    for a, (label, vec) in one.items():
        if a % step:
            continue
        scored = sorted((-sum(p * q for p, q in zip(vec, w)), i, k) for i, (k, w) in one.items()
                        if i != a and len(w) == len(vec))
        for s, i, k in [x for x in scored if x[2] == label][:5]:
            near = [(j, t) for t, j, m in scored if m != label and 50 * -s <= 100 * -t <= 95 * -s][:3]
            out += [(a, i, r, j, -s, -t) for r, (j, t) in enumerate(near, 1)]
    return sorted(out)


def mined(llm, rows, **how):
    df = llm.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    df = df.withColumns({c: F.lit("clash") for c in ("chunk", "place", "block", "dim", "v", "score", "rank", "asked")})
    return sorted(tuple(r) for r in hard_negatives.mine(df, **how).collect())


def vectors(n, d, seed, centres=6, spread=0.15):
    """Clustered vectors of uneven length, a fifth of them copies of one vector."""
    g = np.random.default_rng(seed)
    mid = g.normal(size=(centres, d))
    x = (mid[g.integers(0, centres, n)] + g.normal(size=(n, d)) * spread) * g.uniform(0.5, 2.0, (n, 1))
    x[g.random(n) < 0.2] = x[0]
    return [(int(i), [float(v) for v in row], int(k)) for i, (row, k) in enumerate(zip(x, g.integers(0, 4, n)))]


@pytest.mark.parametrize("how", [{}, {"chunk": 6, "block": 40, "span": 2, "pivots": 3}])
def test_negatives_are_brute_force(llm, how):
    rows = vectors(600, 12, 3)
    want = plain_negatives(rows, 10)
    assert len(want) > 300 and mined(llm, rows, anchor_step=10, **how) == want


def test_bounds_skip_candidates():
    """Along short edges most of a block isn't scored again, and nothing is lost."""
    g = np.random.default_rng(4)
    x = np.floor(256 * g.normal(size=(500, 16)))
    near = x[0] + g.integers(-3, 4, (40, 16))
    order, parent, edge = hard_negatives.spanning_tree(near)
    tree = near[order]
    assert (np.linalg.norm(tree[1:] - tree[parent[1:]], axis=1) <= edge[1:]).all() and (parent < np.arange(40)).all()
    block = hard_negatives.Block(x, np.linalg.norm(x, axis=1) * hard_negatives.SLACK, np.zeros(500), np.arange(500), np.arange(501))
    least = int(np.sort(x @ near[0])[-20])
    scored = 0
    for i, at, s in hard_negatives.walk(block, tree, parent, edge, lambda i, low, high: high >= least):
        true = x @ tree[i]
        assert (s == true[at]).all() and set(np.flatnonzero(true >= least)) <= set(at.tolist())
        scored += len(at)
    assert scored < 500 + 39 * 250


def test_negatives_edges(llm):
    rows = vectors(300, 5, 8)
    odd = [(None, [1.0] * 5, 1), (1000, None, 1), (1001, [1.0] * 5, None), (1002, [1.0, None, 0.0, 0.0, 0.0], 1),
           (1003, [float("nan")] * 5, 1), (1004, [float("inf")] * 5, 1), (1050, [0.0] * 5, 2), (1100, [], 1), (1051, [], 2),
           (1150, [1.0, 2.0], 3), (1151, [1.0, 2.0], 3), (1152, [0.9, 1.5], 4), (1200, [3e6] * 5, 1), (1201, [2e6] * 5, 1),
           (1202, [1.5e6, 1.5e6, 1.5e6, 1.5e6, 1.0], 2), (50, rows[50][1], rows[50][2]), (1250, [-1.0] * 5, 1)]
    got = mined(llm, rows + odd)
    assert got == plain_negatives(rows + odd, 50)
    assert any(r[0] == 1150 for r in got) and any(r[0] == 1200 and r[4] > 2 ** 60 for r in got)
    assert mined(llm, []) == [] and mined(llm, [(50, [1.0], 1)]) == []


# ---- 12: language ----------------------------------------------------------------------------
def test_language_held_out(llm):
    docs = common.documents(llm, SF)
    got = language.identify(docs).join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    held = [r for r in got if r.held_out and r.lang is not None and language.has_letter(r.text or "")]
    assert len(got) == docs.count() and len(held) > 150
    assert sum(r.lang_pred == r.lang for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)


def test_language_sizes_are_the_librarys():
    import zstandard
    pieces = {"a": ["the cat sat on the mat and the dog " * 5], "b": ["le chat est sur le tapis et le chien " * 5]}
    given = language.dictionaries(pieces)
    model = language.Classifier(given)
    text = "The   cat\nsat. " * 400
    want = []
    for k in "ab":
        d = zstandard.ZstdCompressionDict(given[k], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        raw = language.normal(text)
        want.append(sum(len(zstandard.ZstdCompressor(level=language.LEVEL, dict_data=d, write_checksum=False, write_content_size=False,
                                                     write_dict_id=False).compress(raw[i:i + language.PIECE]))
                        for i in range(0, len(raw), language.PIECE)))
    assert model.sizes(text).tolist() == want and want[0] < want[1]
    assert model.answer(text)[0] == "a" and model.answer("12 + 3 …") == ("und", 0.0, None)


def test_language_edges(llm, edge, edge_rows, empty):
    got = language.identify(edge).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in edge_rows)
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (1, 2, 3))
    assert {r.lang_pred for r in got} <= {"en", "fr", "und"} and by[4].lang_pred == "en"
    assert language.identify(empty).count() == 0
    none = edge.withColumn("lang", F.lit(None).cast("string"))
    assert {(r.lang_pred, r.score) for r in language.identify(none).collect()} == {("und", 0.0)}
    same = llm.createDataFrame([(i, "same words here", lang) for i in range(40) for lang in ("x", "y")],
                               "doc_id bigint, text string, lang string")
    tie = language.identify(same, reject=True).collect()
    assert all(r.rejected and r.lang_pred == "und" and abs(r.score - 0.5) < 1e-9 for r in tie)
    broken = llm.sql("select 4L as doc_id, cast(unhex('61FF62') as string) as text, 'en' as lang")
    assert language.identify(broken).first().lang_pred == "en"


# ---- 13: collocations ------------------------------------------------------------------------
def plain_collocations(rows, least, top=2000):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, *w[i:i + k]) for k in (1, 2, 3, 4) for i in range(len(w) - k + 1))
    cand = {p: a for p, a in f.items() if a >= least and len(p) > 2}
    covered = {(q[0], *q[i:j]) for q, a in cand.items() for i in range(1, len(q)) for j in range(i + 2, len(q) + 1)
               if j - i < len(q) - 1 and 100 * a >= 80 * f[(q[0], *q[i:j])]}
    out = {}
    for p, a in cand.items():
        if p not in covered:
            cuts = [(2_000_000 * a // (f[p[:k]] + f[(p[0], *p[k:])]), k) for k in range(2, len(p))]
            s, k = min(cuts)
            out.setdefault(p[0], []).append((-s, -a, " ".join(p[1:]).encode(), f[p[:k]], f[(p[0], *p[k:])]))
    return sorted((g, r, p.decode(), -a, x, y, n[g], -s) for g, v in out.items()
                  for r, (s, a, p, x, y) in enumerate(sorted(v)[:top], 1))


def found(llm, rows, **how):
    df = llm.createDataFrame(rows, "text string, lang string").withColumns(
        {c: F.lit("clash") for c in ("word", "n", "g", "shard", "hi", "lo", "phrase", "doc_id")})
    return sorted(tuple(r) for r in collocations.collocations(df, **how).collect())


@pytest.mark.parametrize("words, group", [(collocations.SHARD_WORDS, collocations.GROUP_WORDS), (300, 700), (50, 1)])
def test_collocations_are_brute_force(llm, words, group):
    rng = random.Random(5)
    names = [f"w{i}" for i in range(12)] + ["Été", "été", "a-b"]
    rows = []
    for i in range(250):
        text = "".join(rng.choice(names) + rng.choice([" ", " ", " ", "\t ", ", ", ". ", "\n"]) for _ in range(rng.randint(0, 60)))
        rows.append((text + (" New York City hall" if i % 3 else ""), rng.choice(["en", "en", "de", None, "und"])))
    for least, top in ((30, 2000), (4, 2000), (4, 7)):
        want = plain_collocations(rows, least, top)
        assert want and found(llm, rows, min_count=least, top=top, shard_words=words, group_words=group) == want


def test_collocations_repeats_and_edges(llm, edge, edge_rows, empty):
    rows = [("a a a a a a", "x")] * 20 + [(None, None), ("", "x"), ("...", "y"), ("word", "z"), ("x" * 70_000, "x")]
    assert found(llm, rows) == plain_collocations(rows, 30)
    got = sorted(tuple(r) for r in collocations.collocations(edge).collect())
    assert got == plain_collocations([(r[1], r[2]) for r in edge_rows], 30) and got
    assert collocations.collocations(empty).count() == 0


def test_long_text_is_cut_at_pieces():
    """A long text's shards hold all its words; lists of tokens join to those of the whole text."""
    text = b"One two; three\tfour " * 200_000
    toks = [t for part in collocations.tokens(text) for t in part]
    assert toks == [b"one", b"two", b".", b"three", b"four"] * 200_000
    ids = np.array([0, 5, 2 ** 32 - 1, 7])
    assert collocations.unpack(collocations.pack(ids)).tolist() == ids.tolist()
    assert collocations.unpack(collocations.pack(ids[:0])).tolist() == []


def test_group_is_held_in_little_memory():
    """A group's words and the phrases of its shards: bytes per word, and what adding the shards up takes beside them."""
    words = [b"word%07d" % i for i in range(100_000)]
    tracemalloc.start()
    group = collocations._Group(0)
    for lo in range(0, len(words), 1000):
        group.add("en", words[lo:lo + 1000])
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    rows = [(b.column("local").to_pylist(), b.column("word").to_pylist(), b.column("lang").to_pylist(),
             b.column("n").to_pylist()) for _ in [list(group.shard())] for b in group.vocabulary()]
    assert sorted(r for cols in rows for r in zip(*cols, strict=True)) == [(i + 1, w, "en", 1) for i, w in enumerate(words)]
    assert held < 120 * len(words), held
    rng = np.random.default_rng(2)
    shards = [(k, rng.integers(1, 9, len(k))) for k in (rng.choice(1 << 40, 100_000) >> 22 for _ in range(6))]
    want = Counter()
    for k, n in shards:
        np.add.at(total := np.zeros(1 << 18, dtype=np.int64), k, n)
        want.update({int(i): int(total[i]) for i in np.flatnonzero(total)})
    parts = [collocations._by_key(*s) for s in [*shards, (np.empty(0, np.int64), np.empty(0, np.int64))]]
    got = list(collocations._summed(parts, 1 << 12))
    most = max(len(k) for k, _ in got)
    key = np.concatenate([k for k, _ in got])
    assert (np.diff(key) > 0).all() and most < 1 << 15
    assert dict(zip(key.tolist(), np.concatenate([n for _, n in got]).tolist(), strict=True)) == want
    assert list(collocations._summed([])) == []


def test_index_counts_phrases():
    rng = np.random.default_rng(2)
    text = np.concatenate([[0], rng.integers(0, 5, 400)])
    index = collocations.Index(text, 5)
    w, lo, back, n = index.words()
    phrases = [(int(x),) for x in w]
    for side in ("right", "left", "right"):
        own, word, lo, back, n = getattr(index, side)(lo, back, n)
        phrases = [phrases[o] + (int(x),) if side == "right" else (int(x),) + phrases[o] for o, x in zip(own, word)]
        size = len(phrases[0])
        want = Counter(p for p in zip(*[text[i:].tolist() for i in range(size)]) if 0 not in p)
        assert dict(zip(phrases, n.tolist())) == want
