"""Operators 1, 2, 3 and 5 against brute force and on edge cases."""

import hashlib
import random

import public_tokenizers as P
import pytest

from promo_engine.llm import bpe, exact_dedup, line_templates, substring_dedup
from promo_engine.llm.queries import RANKS


def multiset(rows):
    return sorted(map(repr, rows))


@pytest.mark.parametrize("window", [1, 3, 35])
def test_substring_dedup_is_brute_force(llm, edge, edge_rows, window):
    rows = edge_rows if window > 1 else [r for r in edge_rows if len(r[1] or "") < 5000]
    docs = edge if window > 1 else llm.createDataFrame(rows, "doc_id bigint, text string, a string, b string, c bigint")
    got = substring_dedup.digest(substring_dedup.remove_repeats(docs, window, block_bytes=2000, range_entries=500))
    want = [(r[0], *w) for r, w in zip(rows, substring_dedup.brute_force([r[1] for r in rows], window), strict=True)]
    assert multiset(map(tuple, got.collect())) == multiset(want)


def test_substring_dedup_periodic_texts(llm):
    rng = random.Random(5)
    texts = [" ".join("ab"[k % p == 0] for k in range(rng.randint(0, 90))) for p in range(1, 40)]
    docs = llm.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: (r.n_words, r.n_removed) for r in substring_dedup.remove_repeats(docs, block_bytes=300).collect()}
    assert [got[i] for i in range(len(texts))] == [w[:2] for w in substring_dedup.brute_force(texts)]


def test_substring_spans_are_maximal(llm):
    words = [f"v{i}" for i in range(120)]
    docs = llm.createDataFrame([(0, " ".join(words)), (1, " ".join(words[10:60]))], "doc_id bigint, text string")
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in substring_dedup.remove_repeats(docs).collect()}
    assert got == {0: [(10, 60)], 1: [(0, 50)]}


def test_bpe_round_trip_and_library(edge, edge_rows):
    enc = bpe.encoding(RANKS, P.PATTERN)
    tokens = bpe.encode(edge, RANKS, P.PATTERN, piece_chars=1000)
    got = bpe.decode(tokens, RANKS, P.PATTERN).collect()
    want = [(r[0], enc.encode_ordinary(r[1] or ""), (r[1] or "").encode()) for r in edge_rows]
    assert multiset((r.doc_id, list(r.ids), bytes(r.raw)) for r in got) == multiset(want)
    digest = bpe.digest(tokens, RANKS, P.PATTERN).collect()
    assert multiset(map(tuple, digest)) == multiset(
        (i, len(t), hashlib.sha256(" ".join(map(str, t)).encode()).hexdigest(), hashlib.sha256(raw).hexdigest())
        for i, t, raw in want)


def test_bpe_cuts_are_safe():
    enc, rng = bpe.encoding(RANKS, P.PATTERN), random.Random(1)
    letters = ["a", "B", "é", "中", "1", "٣", " ", " ", "\n", "\t", "'s", "'", " '", ".", "!", "\x85", "　", "\x1c"]
    for _ in range(3000):
        s = "".join(rng.choices(letters, k=rng.randint(0, 14)))
        for size in (1, 2, 5):
            assert bpe.encode_array(enc, s, size).tolist() == enc.encode_ordinary(s), (s, size)


def test_bpe_raw_bytes_and_long_space():
    enc = bpe.encoding(RANKS, P.PATTERN)
    assert enc.decode_bytes([enc.encode_ordinary("é")[0]][:1]) != b""
    text = "x" + " " * 1_200_000 + "y"                     # the library's own matcher overflows on this
    assert enc.decode_bytes(bpe.encode_text(enc, text)) == text.encode()


def test_exact_dedup_is_brute_force(edge, edge_rows):
    for bits in (64, 3):                                   # 3 bits: chunks collide all the time
        got = exact_dedup.exact_groups(edge, hash_bits=bits).collect()
        groups = {}
        for i, t, *_ in edge_rows:
            groups.setdefault(exact_dedup.normalise((t or "").encode()), []).append((-len(t or ""), i is None, i or 0))
        want = []
        for i, t, *_ in edge_rows:
            n = exact_dedup.normalise((t or "").encode())
            best = min(groups[n])
            want.append((i, None if best[1] else best[2], len(groups[n]), hashlib.sha256(n).hexdigest()))
        assert multiset((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == multiset(want)
        kept = [r for r in got if r.kept]
        assert len(kept) == len(groups) == len({r.text_sha256 for r in kept})
        assert all(r.doc_id == r.keep_id for r in kept)


def test_cut_points_follow_content():
    rng = random.Random(3)
    data = rng.randbytes(300_000)
    cuts = exact_dedup.cut_points(data)
    assert cuts[-1] == len(data) and all(exact_dedup.LEAST_BYTES <= b - a <= exact_dedup.MOST_BYTES
                                         for a, b in zip([0, *cuts], cuts[:-1], strict=False))
    moved = exact_dedup.cut_points(b"some other head" + data)
    assert len({c + 15 for c in cuts} & set(moved)) > len(cuts) * 0.8


def test_line_templates_drop_and_keep(llm):
    same = "This exact line is in every document"
    docs = [(i, f"{same}\nPage {i} of report printed by user{i}\nJob alpha run number {'abc'[i % 3]} finished well today"
                f"\nown words {' '.join(f'{i}q{j}q'.replace(str(i), 'z' * (i + 1)) for j in 'abcde')}\nshort one")
            for i in range(12)]
    out = {r.doc_id: r for r in line_templates.drop_recurring(llm.createDataFrame(docs, "doc_id bigint, text string"),
                                                              min_docs=5).collect()}
    assert out[0].kept_text == docs[0][1] and out[0].n_dropped == 0        # the first document keeps its lines
    for i in range(1, 12):
        assert out[i].n_dropped == 3 and out[i].kept_text.startswith("own words") and out[i].n_lines == 5


def test_line_templates_edges(edge, edge_rows, empty):
    out = line_templates.drop_recurring(edge, min_docs=2).collect()
    assert multiset((r.doc_id, r.text) for r in out) == multiset((r[0], r[1]) for r in edge_rows)
    by_id = {r.doc_id: r for r in out}
    assert by_id[1].kept_text is None and by_id[1].n_lines == 0
    assert by_id[2].kept_text == "" and by_id[2].n_lines == 1
    assert by_id[4].n_dropped == 0 and by_id[5].n_dropped == 1 and by_id[5].kept_text == ""
    kept = line_templates.strip_recurring(edge, min_docs=2)
    assert kept.columns == edge.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == sorted(r[0] or 0 for r in edge_rows if r[0] != 5)
    assert line_templates.drop_recurring(empty).count() == 0 and line_templates.strip_recurring(empty).count() == 0


def stripped(llm, texts):
    docs = llm.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    out = line_templates.strip_recurring(docs, rule=line_templates.every_recurring_line)
    return {r.doc_id: r.text for r in out.collect()}


def letters(i):
    return "".join(chr(97 + int(c)) for c in str(i))


def test_every_recurring_line_finds_several_templates_in_a_leaf(llm):
    texts = [f"own {letters(i)}\nPosted by {letters(i)} {letters(i * 7)}x on the forum today" for i in range(20)]
    texts += [f"own {letters(i)}\nPosted by {letters(i)} {letters(i * 7)}x in our shop yesterday" for i in range(20, 35)]
    texts += [f"own {letters(i)}\nPosted by {' '.join(letters(i * k) + 'y' for k in range(3, 9))}" for i in range(35, 95)]
    out = stripped(llm, texts)
    for i, t in enumerate(texts):
        assert out[i] == (t if i in (0, 20) or i >= 35 else t.split("\n")[0])


def test_every_recurring_line_counts_short_and_few(llm):
    same = "All rights reserved."
    texts = [f"own {letters(i)}\n" + (same if i < 3 else "") + ("\nwords that two of them share" if i in (4, 5) else "")
             for i in range(8)]
    out = stripped(llm, texts)
    assert [same in out[i] for i in range(4)] == [True, False, False, False]
    assert "share" in out[4] and "share" not in out[5]


def test_every_recurring_line_keeps_different_figures(llm):
    texts = [f"{i} {i + 1}.5 {i * 3} {i}:30\n| {i} | {i + 7} | {i * 2} |" for i in range(15)]
    texts += [f"own {letters(i)}\nPage {i} of the report" for i in range(12)] + [texts[3]]
    out = stripped(llm, texts)
    assert [out[i] for i in range(15)] == texts[:15] and 27 not in out
    assert "Page" in out[15] and not any("Page" in out[i] for i in range(16, 27))


def test_empty_tables(empty):
    assert substring_dedup.remove_repeats(empty).count() == 0
    assert bpe.digest(bpe.encode(empty, RANKS, P.PATTERN), RANKS, P.PATTERN).count() == 0
    assert exact_dedup.exact_groups(empty).count() == 0


def thue_morse(k):
    """Two words of 2**k letters that polynomials modulo 2**64 can't tell apart, from k = 11 on."""
    a = b"a"
    for _ in range(k):
        a += a.translate(bytes.maketrans(b"ab", b"ba"))
    return a.decode(), a.translate(bytes.maketrans(b"ab", b"ba")).decode()


def test_words_alike_to_polynomials_are_told_apart(llm):
    from promo_engine.llm import common, ngram_join
    one, two = thue_morse(11)
    for seed in range(4):
        assert len(set(common.word_hashes([one.encode(), two.encode()], seed).tolist())) == 2
    rest = " ".join(f"w{i}" for i in range(34))
    texts = [f"{one} {rest}", f"{two} {rest}"]
    docs = llm.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert {r.n_removed for r in substring_dedup.remove_repeats(docs).collect()} == {0}
    short = llm.createDataFrame([(0, f"{one} a b c d"), (1, f"{two} a b c d")], "doc_id bigint, text string")
    assert {r.n_links for r in ngram_join.near_groups(short).collect()} == {0}
