"""Substring dedup: Rabin-Karp hashes of every fixed-length word window,
counted in Spark; repeated windows merge into maximal removal intervals.

The work is cut into blocks of about ``BLOCK_BYTES`` of text (a hash of the
whole row names the block, so the same rows meet again in every round):

1. *Seeds.*  A block hashes every run of ``SEED_WORDS`` words and keeps, for
   every window, the run with the least hash inside it (its seed; a window's
   seed depends on its words alone).  The distinct seeds go to hash ranges,
   where their occurrences are counted.  A window whose seed occurs once is
   unique, so only the others go on; this is exact and shrinks the shuffle.
2. *Windows.*  A block takes 128-bit Rabin-Karp hashes of its remaining
   windows; the distinct ones are counted in hash ranges.
3. *Removal.*  Windows counted twice or more cover words; covered stretches
   merge into maximal intervals, the rest of the words is kept.

A block sends each hash once with a "twice here" bit, so a window that a
third of all rows share costs one entry per block.  Ranges get one bit per
entry back.  The blocks' exchange is the same in all rounds, so Spark moves
the texts once.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promo_engine.llm import common as C

WINDOW_WORDS = 35
SEED_WORDS = 8
BLOCK_BYTES = 2 << 20
RANGE_ENTRIES = 1_000_000

_ASK = "part int, round int, block bigint, n bigint, keys binary, twice binary"
_ANSWER = "block bigint, round int, part int, n bigint, bits binary"


class _Block:
    """Words, word hashes and window starts of one block's rows, in an order
    that depends on the rows alone."""

    def __init__(self, table: pa.Table, window: int):
        order = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        self.ids = order.column("doc_id").combine_chunks()
        self.docs = [t.split() for t in C.texts_of(order)]
        self.counts = np.array([len(d) for d in self.docs], dtype=np.int64)
        self.words = [w for d in self.docs for w in d]
        self.hash = C.word_hashes(self.words)
        self.window = window
        self.first = np.concatenate([[0], np.cumsum(self.counts)])
        last = np.repeat(self.first[1:], self.counts)           # end of each word's document
        self.valid = np.flatnonzero(np.arange(len(self.words)) + window <= last)

    def seeds(self) -> tuple[np.ndarray, np.ndarray]:
        """The seed's hash of every window, and the hash at every place that is some window's seed."""
        size = min(SEED_WORDS, self.window)
        grams = C.gram_hashes(self.hash, size, seed=2)
        span = self.window - size + 1
        if len(self.valid) == 0:
            return grams[:0], grams[:0]
        least, at = grams, np.arange(len(grams))
        done = 1
        while done < span:                                      # leftmost minima of doubling spans
            step = min(done, span - done)
            right = least[step:] < least[:len(least) - step]
            at = np.where(right, at[step:], at[:len(at) - step])
            least = grams[at]
            done += step
        at = at[self.valid]
        return grams[at], grams[np.unique(at)]

    def windows(self, chosen: np.ndarray) -> np.ndarray:
        """128-bit hashes (two 64-bit halves) of the windows at ``self.valid[chosen]``."""
        out = np.empty(len(chosen), dtype=[("a", "<u8"), ("b", "<u8")])
        if len(chosen):
            at = self.valid[chosen]
            out["a"] = C.gram_hashes(self.hash, self.window, seed=3)[at]
            out["b"] = C.gram_hashes(C.word_hashes(self.words, seed=1), self.window, seed=4)[at]
        return out


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.unique(keys, return_inverse=True, return_counts=True)


def _lead(keys: np.ndarray) -> np.ndarray:
    return keys["a"] if keys.dtype.names else keys


def _ask(block: int, rnd: int, keys: np.ndarray, parts: int) -> pa.Table:
    """The block's distinct keys, dealt by their leading bits to ``parts`` ranges."""
    found, _, count = _distinct(keys)
    # exact floor(lead * parts / 2**64) is not needed: 32 leading bits deal evenly
    part = ((_lead(found) >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    cuts = np.flatnonzero(np.diff(part, prepend=np.uint64(2**63))) if len(found) else np.empty(0, int)
    ends = np.append(cuts[1:], len(found))
    rows = [(int(part[a]), rnd, block, int(b - a), found[a:b].tobytes(),
             np.packbits(count[a:b] > 1).tobytes()) for a, b in zip(cuts, ends, strict=True)] if len(found) else []
    cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
    types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    return pa.table([pa.array(list(c), type=t) for c, t in zip(cols, types, strict=True)],
                    names=["part", "round", "block", "n", "keys", "twice"])


def _count(table: pa.Table) -> pa.Table:
    """Which keys of a range occur twice or more, one bit per entry asked."""
    rnd = table.column("round")[0].as_py()
    kind = np.dtype("<u8") if rnd == 1 else np.dtype([("a", "<u8"), ("b", "<u8")])
    sizes = table.column("n").to_pylist()
    keys = np.concatenate([np.frombuffer(k, dtype=kind) for k in table.column("keys").to_pylist()])
    twice = np.concatenate([np.unpackbits(np.frombuffer(t, dtype=np.uint8), count=n).astype(np.int64)
                            for t, n in zip(table.column("twice").to_pylist(), sizes, strict=True)])
    found, at, _ = _distinct(keys)
    seen = np.bincount(at, weights=1 + twice, minlength=len(found)) >= 2
    ends = np.cumsum(sizes)
    bits = [np.packbits(seen[at[e - n:e]]).tobytes() for e, n in zip(ends, sizes, strict=True)]
    return pa.table({"block": table.column("block"), "round": table.column("round"),
                     "part": table.column("part"), "n": table.column("n"), "bits": C.binary(bits)})


def _told(answers: pa.Table, rnd: int) -> np.ndarray:
    """The bits of one round over the block's distinct keys in key order."""
    rows = sorted((p, n, b) for r, p, n, b in zip(
        *(answers.column(c).to_pylist() for c in ("round", "part", "n", "bits")), strict=True) if r == rnd)
    if not rows:
        return np.empty(0, dtype=bool)
    return np.concatenate([np.unpackbits(np.frombuffer(b, dtype=np.uint8), count=n) for _, n, b in rows]).astype(bool)


def _open_windows(b: _Block, answers: pa.Table) -> np.ndarray:
    """Indexes (in ``b.valid``) of the windows whose seed occurs again."""
    seeds, places = b.seeds()
    if len(seeds) == 0:
        return np.empty(0, dtype=np.int64)
    return np.flatnonzero(_told(answers, 1)[np.searchsorted(_distinct(places)[0], seeds)])


def _covered(b: _Block, answers: pa.Table) -> np.ndarray:
    """Which words of the block lie in a repeated window."""
    mark = np.zeros(len(b.words) + 1, dtype=np.int64)
    chosen = _open_windows(b, answers)
    if len(chosen):
        again = b.valid[chosen[_told(answers, 2)[_distinct(b.windows(chosen))[1]]]]
        mark[again] += 1
        mark[again + b.window] -= 1
    return np.cumsum(mark[:-1]) > 0


def _spans(gone: np.ndarray) -> tuple[list[int], list[int]]:
    edge = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0))
    return edge[::2].tolist(), edge[1::2].tolist()


def remove_repeats(docs: DataFrame, window: int = WINDOW_WORDS, id_col: str = "doc_id",
                   text_col: str = "text", block_bytes: int = BLOCK_BYTES,
                   range_entries: int = RANGE_ENTRIES) -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_removed, spans, kept_text``.

    Words are maximal runs of characters other than space and \\x09-\\x0D.  A
    word goes when a window of ``window`` consecutive words of its document
    covers it whose words also start anywhere else, in the same document too.
    ``spans`` are the maximal removed intervals [start, end) in word numbers;
    ``kept_text`` joins the other words by one space.

    Null and empty texts have no words: 0, 0, no span, "".  A null id stays
    null.  Repeated rows are documents of their own, so they repeat each
    other.  A text below ``window`` words has no window and stays whole.
    Other columns of ``docs`` are not read.  An empty table gives no rows.
    """
    if window < 1:
        raise ValueError("window must be at least 1")
    rows = C.id_text(docs, id_col, text_col)
    total = C.text_bytes(rows)
    n_blocks = C.parts_for(total, block_bytes)
    # about one word in eight bytes at most, one seed in ten words
    ranges = {1: C.parts_for(total // 60, range_entries), 2: C.parts_for(total // 6, range_entries)}
    blocks = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_blocks)))

    def seeds(key: tuple, table: pa.Table) -> pa.Table:
        return _ask(key[0].as_py(), 1, _Block(table, window).seeds()[1], ranges[1])

    def windows(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        if table.num_rows == 0:
            return _ask(0, 2, np.empty(0, dtype=np.uint64), 1)
        b = _Block(table, window)
        return _ask(key[0].as_py(), 2, b.windows(_open_windows(b, answers)), ranges[2])

    def remove(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        out = {k: [] for k in ("n_removed", "starts", "ends", "kept_text")}
        b = _Block(table, window)
        gone = _covered(b, answers)
        for k, words in enumerate(b.docs):
            mine = gone[b.first[k]:b.first[k + 1]]
            starts, ends = _spans(mine)
            out["n_removed"].append(int(mine.sum()))
            out["starts"].append(starts)
            out["ends"].append(ends)
            keep = words if not starts else [w for w, g in zip(words, mine, strict=True) if not g]
            out["kept_text"].append(b" ".join(keep))
        return pa.table({
            "doc_id": b.ids, "n_words": pa.array(b.counts, type=pa.int64()),
            "n_removed": pa.array(out["n_removed"], type=pa.int64()),
            "starts": pa.array(out["starts"], type=pa.list_(pa.int32())),
            "ends": pa.array(out["ends"], type=pa.list_(pa.int32())),
            "kept_text": pa.array(out["kept_text"], type=pa.binary()).cast(pa.string())})

    def counted(asked: DataFrame) -> DataFrame:
        return asked.groupBy("part").applyInArrow(_count, _ANSWER)

    one = counted(blocks.groupBy("block").applyInArrow(seeds, _ASK))
    two = counted(blocks.groupBy("block").cogroup(one.groupBy("block")).applyInArrow(windows, _ASK))
    done = (blocks.groupBy("block").cogroup(one.unionByName(two).groupBy("block"))
            .applyInArrow(remove, "doc_id bigint, n_words bigint, n_removed bigint, starts array<int>, "
                                  "ends array<int>, kept_text string"))
    return done.select("doc_id", "n_words", "n_removed", F.arrays_zip(
        F.col("starts").alias("start"), F.col("ends").alias("end")).alias("spans"), "kept_text")


def digest(out: DataFrame) -> DataFrame:
    """The contract's columns."""
    return out.select("doc_id", "n_words", "n_removed",
                      F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


def brute_force(texts: list[str | None], window: int = WINDOW_WORDS) -> list[tuple[int, int, str]]:
    """(n_words, n_removed, kept_sha256) by the definition, for tests."""
    docs = [(t or "").encode().split() for t in texts]
    seen: dict[tuple, int] = {}
    for d in docs:
        for i in range(len(d) - window + 1):
            k = tuple(d[i:i + window])
            seen[k] = seen.get(k, 0) + 1
    out = []
    for d in docs:
        gone = [False] * len(d)
        for i in range(len(d) - window + 1):
            if seen[tuple(d[i:i + window])] > 1:
                gone[i:i + window] = [True] * window
        kept = b" ".join(w for w, g in zip(d, gone, strict=True) if not g)
        out.append((len(d), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out
