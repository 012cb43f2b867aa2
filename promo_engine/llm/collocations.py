"""Phrase collocations from FM-indexes of corpus shards.

1. *Shards.*  Each task turns consecutive texts into sequences of word ids
   (a language and a word make an id; pieces end in id 0) of a bounded number
   of words.  Consecutive shards form a group of bounded size with one
   vocabulary.  Word counts are added up over the groups; words that reach
   ``min_count`` get an id for the whole corpus, the others end a piece, as no
   phrase that holds one can reach it.
2. *Index.*  A shard's ids are sorted by the ``LONGEST`` words that follow,
   in both directions; that gives a Burrows-Wheeler transform each, and
   phrases are pairs of intervals in them.  Extending intervals to the left
   or right by every word that occurs there enumerates the phrases with
   their counts (``Index.left``, ``Index.right``).
3. *Levels.*  Two-word phrases are counted first and added up over the
   groups.  Those that reach ``min_count`` go back to the groups that hold
   them, and only they are extended to three words, and those in turn to
   four.  No phrase that reaches ``min_count`` is lost by this: every part of
   it occurs at least as often.
4. Cuts, drops by longer phrases and ranks are joins and aggregates over the
   phrases that are left, in exact arithmetic.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promo_engine.llm import common as C

LONGEST = 4                # words of a phrase; the index is sorted to this depth
MIN_COUNT = 30
COVER = (80, 100)          # a phrase goes if a longer one has this share of its count
TOP = 2000
SCALE = 2_000_000
SHARD_WORDS = 1_000_000  # words and ends of pieces of an index; below 2**21 the sorts are fastest
GROUP_WORDS = 8_000_000  # of the shards of one group
RANGES = 1 << 16           # of words, each numbered by itself
SLICE = 1 << 20            # bytes tokenised at once
ROWS = 1 << 16             # rows of an Arrow batch sent on

# A-Z become a-z, the ends of pieces become ".", a tab becomes a space.
_TABLE = bytearray(range(256))
_TABLE[ord("A"):ord("Z") + 1] = range(ord("a"), ord("z") + 1)
for _c in b".,;:!?\x0a\x0b\x0c\x0d":
    _TABLE[_c] = ord(".")
_TABLE[ord("\t")] = ord(" ")
_TABLE = bytes(_TABLE)


def tokens(text: bytes) -> Iterator[list[bytes]]:
    """The lower-case words of a text, in lists of bounded size, with ``b"."``
    at the end of each piece (also where it has no words)."""
    raw = text.translate(_TABLE)
    at = 0
    while at < len(raw):
        to = len(raw)
        if to - at > SLICE:
            ends = [i for i in (raw.find(b" ", at + SLICE), raw.find(b".", at + SLICE)) if i >= 0]
            to = min(ends, default=to)
        yield raw[at:to].replace(b".", b" . ").split()
        at = to


def pack(ids: np.ndarray) -> bytes:
    """Ids below 2**32 as compressed bytes."""
    planes = ids.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


class _Words(dict):
    """Ids of the words of one language, given by ``group``."""

    def __init__(self, group: _Group):
        super().__init__({b".": 0})
        self.group = group

    def __missing__(self, word: bytes) -> int:
        self.group.known += 1
        self[word] = self.group.known
        return self.group.known


class _Group:
    """Consecutive shards with one vocabulary."""

    def __init__(self, number: int):
        self.number, self.size, self.pending, self.known = number, 0, 0, 0
        self.words: dict[str, _Words] = {}
        self.parts: list[np.ndarray] = []
        self.counts = np.zeros(1, dtype=np.int64)

    def add(self, lang: str, toks: list[bytes]) -> None:
        have = self.words.get(lang)
        if have is None:
            have = self.words[lang] = _Words(self)
        self.parts.append(np.fromiter(map(have.__getitem__, toks), dtype=np.uint32, count=len(toks)))
        self.pending += len(toks)

    def shard(self) -> Iterator[pa.RecordBatch]:
        """What was added since the last shard."""
        if self.pending:
            ids = np.concatenate(self.parts)
            counts = np.bincount(ids, minlength=self.known + 1)
            counts[:len(self.counts)] += self.counts
            self.counts, self.parts = counts, []
            self.size, self.pending = self.size + self.pending, 0
            yield pa.record_batch([pa.array([self.number]), *[pa.nulls(1, type=t) for t in (
                pa.int32(), pa.string(), pa.binary(), pa.int64())], C.binary([pack(ids)])], names=_SHARD_COLUMNS)

    def vocabulary(self) -> Iterator[pa.RecordBatch]:
        for lang, have in self.words.items():
            items = islice(have.items(), 1, None)            # without the ends of pieces
            while part := list(islice(items, ROWS)):
                n = len(part)
                local = np.fromiter((i for _, i in part), dtype=np.int32, count=n)
                yield pa.record_batch([
                    pa.array(np.full(n, self.number)), pa.array(local), pa.array([lang] * n, type=pa.string()),
                    C.binary([w for w, _ in part]), pa.array(self.counts[local]), pa.nulls(n, type=pa.binary())],
                    names=_SHARD_COLUMNS)


_SHARD_COLUMNS = ["grp", "local", "lang", "word", "n", "ids"]


def shards(docs: DataFrame, text_col: str, lang_col: str, words: int, group_words: int) -> DataFrame:
    """A row with the packed ``ids`` of every shard, and one for each word of a group (``local`` is its id there)."""
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       F.col(text_col).cast("string").cast("binary").alias("text")).where(F.octet_length("text") > 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = _Group(TaskContext.get().partitionId() << 32)
        for b in batches:
            for row in range(b.num_rows):
                lang = b.column("lang")[row].as_py()
                for toks in tokens(b.column("text")[row].as_py()):
                    if group.pending + len(toks) >= words and b"." in toks:      # full: the next begins with a piece
                        cut = len(toks) - toks[::-1].index(b".")
                        group.add(lang, toks[:cut])
                        toks = toks[cut:]
                        yield from group.shard()
                        if group.size >= group_words:
                            yield from group.vocabulary()
                            group = _Group(group.number + 1)
                    group.add(lang, toks)
                group.add(lang, [b"."])
        yield from group.shard()
        yield from group.vocabulary()
    return rows.mapInArrow(run, "grp bigint, local int, lang string, word binary, n bigint, ids binary")


def corpus_words(vocabulary: DataFrame, min_count: int) -> DataFrame:
    """``grp, local, g, lang, word, f`` of the words that reach ``min_count``, with the id ``g`` of the word in
    the corpus; ``lang``, ``word`` and ``f`` stand in one of a word's rows alone.

    Words are dealt to ``RANGES`` ranges by a hash and numbered in each, so one shuffle adds up the counts
    and gives the ids."""
    own = Window.partitionBy("range", "lang", "word")
    rows = (vocabulary.withColumn("range", F.pmod(F.xxhash64("lang", "word"), F.lit(RANGES)))
            .repartition("range").withColumn("f", F.sum("n").over(own)).where(F.col("f") >= min_count)
            .withColumn("at", F.dense_rank().over(Window.partitionBy("range").orderBy("lang", "word")))
            .withColumn("lead", F.row_number().over(own.orderBy("grp")) == 1))
    g = F.col("at").cast("bigint") * RANGES + F.col("range")
    low = F.when(g < 1 << 32, g).otherwise(F.raise_error(F.lit("ids of frequent words need more than 32 bits")))
    return C.cut_lineage(rows.select("grp", "local", low.alias("g"), *[
        F.when(F.col("lead"), F.col(c)).alias(c) for c in ("lang", "word", "f")]), "phrase-words")


def _sorted(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the (whole, not negative) keys, equal ones by place, and the keys in it."""
    bits = max(1, (len(key) - 1).bit_length())
    if int(key.max(initial=0)).bit_length() + bits > 63:
        order = np.argsort(key, kind="stable")
        return order, key[order]
    both = key << bits
    both |= np.arange(len(key))
    both.sort()                                             # far faster than sorting places by keys
    order = both & ((1 << bits) - 1)
    both >>= bits
    return order, both


class Index:
    """Burrows-Wheeler transforms of a circular sequence of symbols (0 ends a
    piece) in both directions, sorted by the ``LONGEST`` symbols that follow.

    Phrases are rows of three arrays: where they begin in the order of the
    sequence (``lo``) and in that of the reversed sequence (``back``), and how
    often they occur (``n``)."""

    def __init__(self, text: np.ndarray, symbols: int):
        self.text, self.symbols = text, symbols
        counts = np.bincount(text, minlength=symbols)
        self.counts, self.first = counts, np.cumsum(counts) - counts
        self.sides: list[tuple[np.ndarray, np.ndarray] | None] = [None, None]        # made when first asked for

    def _side(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol before each place in sorted order, and the place which that symbol has in it."""
        rank, top, depth = text, self.symbols - 1, 1
        while depth < LONGEST:
            key = np.roll(rank, -depth)
            key |= rank << top.bit_length()
            order, key = _sorted(key)
            new = np.concatenate([[False], key[1:] != key[:-1]])
            rank = np.empty(len(text), dtype=np.int64)
            rank[order] = np.cumsum(new)
            del key, new
            top, depth = int(rank[order[-1]]), depth * 2
        del rank
        order -= 1
        before = text[order]
        del order
        step = np.empty(len(text), dtype=np.int32)          # kept as long as the index
        step[_sorted(before)[0]] = np.arange(len(text), dtype=np.int32)
        return before.astype(np.int32), step

    def side(self, which: int) -> tuple[np.ndarray, np.ndarray]:
        if self.sides[which] is None:
            self.sides[which] = self._side(self.text[::-1] if which else self.text)
        return self.sides[which]

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``symbol, lo, back, n`` of every symbol but 0."""
        w = np.flatnonzero(self.counts[1:]) + 1
        return w, self.first[w], self.first[w], self.counts[w]

    def _extend(self, which: int, lo: np.ndarray, other: np.ndarray, n: np.ndarray):
        before, step = self.side(which)
        begin = np.cumsum(n) - n
        place = np.repeat(lo - begin, n)
        place += np.arange(len(place))
        bits = self.symbols.bit_length()
        key = np.repeat(np.arange(len(n)) << bits, n)
        key |= before[place]
        order, key = _sorted(key)
        at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
        own, symbol = key[at] >> bits, key[at] & ((1 << bits) - 1)
        count = np.diff(np.append(at, len(key)))
        real = symbol > 0
        at, own, symbol, count = at[real], own[real], symbol[real], count[real]
        return own, symbol, step[place[order[at]]].astype(np.int64), other[own] + at - begin[own], count

    def left(self, lo: np.ndarray, back: np.ndarray, n: np.ndarray):
        """Every phrase with one word more on the left: ``row it extends, word, lo, back, n``."""
        return self._extend(0, lo, back, n)

    def right(self, lo: np.ndarray, back: np.ndarray, n: np.ndarray):
        """The same with one word more on the right."""
        own, word, back, lo, n = self._extend(1, back, lo, n)
        return own, word, lo, back, n


def _indexed(ids: bytes, names: bytes) -> tuple[np.ndarray, Index]:
    """The corpus ids of the shard's symbols (0 first), and the index over its symbols."""
    names = np.concatenate([[0], np.cumsum(unpack(names))])
    return names, Index(np.concatenate([[0], unpack(ids)]), len(names))


def _two(names: np.ndarray, index: Index):
    """All two-word phrases: the words, their key, and the intervals."""
    w, lo, back, n = index.words()
    own, left, lo, back, n = index.left(lo, back, n)
    right = w[own]
    return left, right, _key(names[left], names[right]), lo, back, n


def _key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64)).view(np.int64)


def _table(columns: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    n = len(next(iter(columns.values())))
    for lo in range(0, n, ROWS):
        yield pa.record_batch([pa.array(c[lo:lo + ROWS], type=pa.int64()) for c in columns.values()],
                              names=list(columns))


def _encoded(group: pa.Table, words: pa.Table) -> pa.Table:
    """The group's shards in symbols: a shard's frequent words by ascending corpus id from 1 on, 0 for its
    other words and one 0 between pieces; ``names`` are the steps between these ids."""
    out = []
    if group.num_rows and words.num_rows:
        local, g = (np.asarray(words.column(c).combine_chunks()).astype(np.int64) for c in ("local", "g"))
        order = np.argsort(g)
        local, g = local[order], g[order]
        for raw in group.column("ids"):
            ids = unpack(raw.as_py())
            here = np.bincount(ids, minlength=int(local.max()) + 1)[local] > 0
            symbol = np.zeros(max(int(ids.max(initial=0)), int(local.max())) + 1, dtype=np.int64)
            symbol[local[here]] = np.arange(1, int(here.sum()) + 1)
            ids = symbol[ids]
            keep = np.ones(len(ids), dtype=bool)
            keep[1:] = (ids[1:] > 0) | (ids[:-1] > 0)
            out.append((pack(ids[keep]), pack(np.diff(g[here], prepend=0))))
    number = group.column("grp")[0].as_py() if group.num_rows else 0
    return pa.table([pa.array([number] * len(out), type=pa.int64()), C.binary([x for x, _ in out]),
                     C.binary([x for _, x in out])], names=["grp", "ids", "names"])


def _merged(parts: list[np.ndarray]) -> np.ndarray:
    """Rows ``hi, lo, n`` of several shards as those of the group, in order."""
    rows = np.concatenate([np.empty((0, 3), dtype=np.int64), *parts])
    if len(parts) < 2 or not len(rows):
        return rows
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))] if rows[:, 1].any() else rows[np.argsort(rows[:, 0])]
    at = np.flatnonzero(np.concatenate([[True], (rows[1:, :2] != rows[:-1, :2]).any(axis=1)]))
    return np.concatenate([rows[at, :2], np.add.reduceat(rows[:, 2], at)[:, None]], axis=1)


def _by_key(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Phrases of one shard by ascending key; a shard's counts have 32 bits."""
    order = np.argsort(key)
    return key[order], n[order].astype(np.uint32)


def _summed(parts: list[tuple[np.ndarray, np.ndarray]], rows: int = ROWS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Phrases (keys, counts) of several shards, each by ascending key, as those of all, in order: range of keys by
    range, so that beside the parts only about ``rows`` rows of them are held."""
    at = [0] * len(parts)
    while any(a < len(key) for a, (key, _) in zip(at, parts, strict=True)):
        each = max(1, rows // len(parts))
        last = min(key[min(a + each, len(key)) - 1] for a, (key, _) in zip(at, parts, strict=True) if a < len(key))
        to = [int(np.searchsorted(key, last, side="right")) for key, _ in parts]
        key = np.concatenate([key[a:z] for (key, _), a, z in zip(parts, at, to, strict=True)])
        n = np.concatenate([n[a:z] for (_, n), a, z in zip(parts, at, to, strict=True)]).astype(np.int64)
        order = np.argsort(key)
        key, n = key[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        yield key[first], np.add.reduceat(n, first)
        at = to


def pairs(encoded: DataFrame) -> DataFrame:
    """``grp, hi, lo, n``: the two-word phrases of each group."""
    def found(row: dict) -> tuple[np.ndarray, np.ndarray]:
        _, _, key, _, _, n = _two(*_indexed(row["ids"], row["names"]))
        return _by_key(key, n)

    def sent(number: int | None, parts: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for key, n in _summed(parts):
            yield from _table({"grp": np.full(len(key), number), "hi": key, "lo": np.zeros(len(key), np.int64), "n": n})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, parts = None, []
        for b in batches:
            for row in C.each_row(b):
                if row["grp"] != number and parts:                 # a group's shards follow each other
                    yield from sent(number, parts)
                    parts = []
                number = row["grp"]
                parts.append(found(row))
        if parts:
            yield from sent(number, parts)
    return encoded.mapInArrow(run, "grp bigint, hi bigint, lo bigint, n bigint")


class _Known:
    """A set of phrases by their keys."""

    def __init__(self, hi: np.ndarray, lo: np.ndarray | None = None):
        self.hi = np.unique(hi)
        if lo is not None:             # two keys: the second under the place of the first
            self.both = np.unique(self._under(hi, lo))

    def _under(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.hi, hi) << 32 | (lo >> 32 & 0xFFFFFFFF)

    @staticmethod
    def _is_in(sorted_: np.ndarray, key: np.ndarray) -> np.ndarray:
        return sorted_[np.minimum(np.searchsorted(sorted_, key), len(sorted_) - 1)] == key

    def two(self, hi: np.ndarray) -> np.ndarray:
        return self._is_in(self.hi, hi)

    def three(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        return self.two(hi) & self._is_in(self.both, self._under(hi, lo))


def _threes(row: tuple[bytes, bytes], known: _Known):
    """Three-word phrases whose two-word parts are known: names, index, words, keys and intervals."""
    names, index = _indexed(*row)
    a, b, key, lo, back, n = _two(names, index)
    ok = known.two(key)
    a, b, lo, back, n = a[ok], b[ok], lo[ok], back[ok], n[ok]
    own, c, lo, back, n = index.right(lo, back, n)
    ok = known.two(_key(names[b[own]], names[c]))
    own, c, lo, back, n = own[ok], c[ok], lo[ok], back[ok], n[ok]
    a, b = a[own], b[own]
    return names, index, (a, b, c), (_key(names[a], names[b]), _key(names[c], np.zeros(len(c), np.int64))), (lo, back, n)


def _of_group(found):
    """For a cogroup of a group's shards and its known phrases: ``found`` of every shard, added up."""
    def run(group: pa.Table, often: pa.Table) -> pa.Table:
        parts = []
        if group.num_rows and often.num_rows:
            hi, lo = (np.asarray(often.column(c).combine_chunks()) for c in ("hi", "lo"))
            parts = [found((x.as_py(), y.as_py()), hi, lo) for x, y in zip(group.column("ids"), group.column("names"), strict=True)]
        rows = _merged(parts)
        number = group.column("grp")[0].as_py() if len(rows) else 0
        return pa.table([pa.array(np.full(len(rows), number)), *[pa.array(np.ascontiguousarray(rows[:, i])) for i in range(3)]],
                        names=["grp", "hi", "lo", "n"])
    return run


def _three_words(row: tuple[bytes, bytes], hi: np.ndarray, _: np.ndarray) -> np.ndarray:
    _, _, _, key, (_, _, n) = _threes(row, _Known(hi))
    return np.stack([*key, n], axis=1)


def _four_words(row: tuple[bytes, bytes], hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """Four-word phrases whose three-word parts are known."""
    known = _Known(hi, lo)
    inner = _key(hi & 0xFFFFFFFF, lo >> 32 & 0xFFFFFFFF)
    names, index, (a, b, c), key, (left, back, n) = _threes(row, _Known(np.concatenate([hi, inner])))
    ok = known.three(*key)
    a, b, c, left, back, n = a[ok], b[ok], c[ok], left[ok], back[ok], n[ok]
    own, d, _, _, n = index.left(left, back, n)
    a, b, c = a[own], b[own], c[own]
    ok = known.three(_key(names[d], names[a]), _key(names[b], np.zeros(len(b), np.int64)))
    return np.stack([_key(names[d], names[a])[ok], _key(names[b], names[c])[ok], n[ok]], axis=1)


def _part(word: str) -> Column:
    """Word 1 to 4 of a key."""
    c = F.col("hi" if word in "12" else "lo")
    return F.shiftrightunsigned(c, 32) if word in "13" else c.bitwiseAND(0xFFFFFFFF)


def _joined(a: Column | None, b: Column | None) -> Column:
    high = F.lit(0).cast("bigint") if a is None else F.shiftleft(a, 32)
    return high if b is None else high.bitwiseOR(b)


def _first(k: int) -> Column:
    """The key of the first ``k`` words."""
    return F.struct((_joined(F.col("g1"), None) if k == 1 else F.col("hi")).alias("hi"),
                    (_joined(F.col("g3"), None) if k == 3 else _joined(None, None)).alias("lo"))


def _after(k: int) -> Column:
    """The key of the words after the first ``k``."""
    hi = {1: _joined(F.col("g2"), F.col("g3")), 2: _joined(F.col("g3"), F.col("g4")), 3: _joined(F.col("g4"), None)}[k]
    return F.struct(hi.alias("hi"), (_joined(F.col("g4"), None) if k == 1 else _joined(None, None)).alias("lo"))


def phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT,
            shard_words: int = SHARD_WORDS, group_words: int = GROUP_WORDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(words, counts, totals): ``lang, word, f, g`` of the words that reach ``min_count``, ``hi, lo, f`` of the
    phrases of two to four of them that do (four ids of 32 bits), ``lang, n`` of all word occurrences."""
    spark = docs.sparkSession
    with C.arrow_rows(spark, 1000):
        raw = C.cut_lineage(shards(docs, text_col, lang_col, shard_words, group_words), "phrase-shards")
    vocabulary = raw.where(F.col("local").isNotNull())
    totals = vocabulary.groupBy("lang").agg(F.sum("n").alias("n"))
    found = corpus_words(vocabulary, min_count)
    by_group = lambda rows, *names: rows.select(*names).toDF(*names).groupBy("grp")
    encoded = C.cut_lineage(
        by_group(raw.where(F.col("local").isNull()), "grp", "ids").cogroup(by_group(found, "grp", "local", "g"))
        .applyInArrow(_encoded, "grp bigint, ids binary, names binary"), "phrase-ids")

    def often(rows: DataFrame, name: str) -> DataFrame:
        # one row per group and phrase; the sum over groups stays beside them, to go back to the groups
        total = F.sum("n").over(Window.partitionBy("hi", "lo"))
        return C.cut_lineage(rows.withColumn("f", total).where(F.col("f") >= min_count).drop("n"), name)

    def longer(known: DataFrame, how) -> DataFrame:
        return by_group(encoded, "grp", "ids", "names").cogroup(by_group(known, "grp", "hi", "lo")).applyInArrow(
            _of_group(how), "grp bigint, hi bigint, lo bigint, n bigint")
    with C.arrow_rows(spark, 1):
        two = often(pairs(encoded), "phrase-pairs")
    three = often(longer(two, _three_words), "phrase-threes")
    four = longer(three, _four_words).groupBy("hi", "lo").agg(F.sum("n").alias("f")).where(F.col("f") >= min_count)
    once = [t.groupBy("hi", "lo").agg(F.max("f").alias("f")) for t in (two, three)]
    return (found.where(F.col("f").isNotNull()).select("lang", "word", "f", "g"),
            C.cut_lineage(once[0].unionByName(once[1]).unionByName(four), "phrase-all"), totals)


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT,
                 cover: tuple[int, int] = COVER, top: int = TOP, shard_words: int = SHARD_WORDS,
                 group_words: int = GROUP_WORDS) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of two
    to four words of each language, by the score of their weakest cut.

    A null language counts as ``und``, together with a language of that name;
    a null text counts as empty, and empty texts and pieces hold no words.
    Texts of any length are read in full; a piece stays in one shard.
    Repeated rows count each time.  Ties go to the larger count, then to the
    smaller phrase in byte order.  Bytes that are no UTF-8 are kept as they
    are in the counts, and shown as the replacement character.  Other columns
    are not read; an empty table gives no rows.
    """
    words, counts, totals = phrases(docs, text_col, lang_col, min_count, shard_words, group_words)
    keyed = counts.select("hi", "lo", F.col("f").alias("a"), *[_part(w).alias(f"g{w}") for w in "1234"])
    keyed = C.cut_lineage(keyed.withColumn("size", F.when(F.col("g3") == 0, 2).when(F.col("g4") == 0, 3).otherwise(4)),
                          "phrase-counts")
    # every part of a phrase reaches the count too, so these joins lose no phrase
    known = counts.unionByName(words.select(_joined(F.col("g"), None).alias("hi"), F.lit(0).cast("bigint").alias("lo"), "f"))
    cut = F.explode(F.filter(F.array(*[F.struct(F.lit(k).alias("k"), _first(k).alias("first"), _after(k).alias("rest"))
                                       for k in (1, 2, 3)]), lambda c: c["k"] < F.col("size")))
    cuts = keyed.select("hi", "lo", "a", cut.alias("c"))

    def with_count(rows: DataFrame, side: str, name: str) -> DataFrame:
        part = known.select(F.col("hi").alias("p"), F.col("lo").alias("q"), F.col("f").alias(name))
        return rows.join(part, (F.col(f"c.{side}.hi") == F.col("p")) & (F.col(f"c.{side}.lo") == F.col("q"))).drop("p", "q")
    whole = lambda c: c.cast("decimal(20,0)")
    cuts = with_count(with_count(cuts, "first", "l"), "rest", "r").withColumns(
        {"k": F.col("c.k"), "top": F.lit(SCALE).cast("decimal(7,0)") * whole(F.col("a")),
         "sum": whole(F.col("l")) + whole(F.col("r"))}).withColumn("score", F.expr("`top` div `sum`").cast("bigint"))
    scored = cuts.groupBy("hi", "lo").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("s")).select("hi", "lo", "s.*")
    # a longer phrase that covers this one occurs no more often than one of them with a single word more
    sub = F.explode(F.array(F.when(F.col("size") == 3, _first(2)).otherwise(_first(3)), _after(1)))
    around = (keyed.where("size > 2").select(sub.alias("p"), "a").groupBy("p.hi", "p.lo").agg(F.max("a").alias("most")))
    kept = (scored.join(around, ["hi", "lo"], "left")
            .where(F.col("most").isNull() | (whole(F.col("most")) * cover[1] < whole(F.col("a")) * cover[0])).drop("most"))
    named = kept.select("*", _part("1").alias("g")).join(words.select("g", "lang"), "g")
    # ties by phrase need the words: first all that can be among the top without them
    order = [F.desc("score"), F.desc("a")]
    first = C.cut_lineage(named.withColumn("rank", F.rank().over(Window.partitionBy("lang").orderBy(*order)))
                          .where(F.col("rank") <= top).drop("rank", "g"), "phrase-first")
    spelt = (first.select("hi", "lo", F.posexplode(F.array(*[_part(w) for w in "1234"])).alias("at", "g")).where("g > 0")
             .join(words.select("g", "word"), "g").groupBy("hi", "lo")
             .agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("w"))      # four at most
             .select("hi", "lo", F.concat_ws(" ", F.transform("w", lambda x: x["word"].cast("string"))).alias("phrase")))
    last = Window.partitionBy("lang").orderBy(*order, "phrase")
    return (first.join(spelt, ["hi", "lo"]).withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= top)
            .join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n",
                                         "score"))
