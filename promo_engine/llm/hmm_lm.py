"""Hidden Markov language model over whole documents.

A document is its lower-cased words and one end token.  Every word belongs
to one of ``SYMBOLS`` symbols by its hash (the end token has its own), the
hidden states emit symbols, and a symbol emits its words by their corpus
counts.  So the part of the model that every task needs is bounded by
parameters, while the word counts, which grow with the corpus, stay
distributed: they are counted in Spark and only meet the blocks that ask.

1. Blocks: documents are coded by the words of their block and written once.
2. Counts: blocks send their distinct words with training counts to ranges
   of symbols, where they are added up; each block gets its words' totals.
3. Baum-Welch: expected transition and emission counts of every training
   document, by the scaled forward-backward recursion, added up per partition
   and then by Spark; every pass covers all.  Passes end when one gains less
   than ``TOLERANCE`` of the log likelihood, or at a number set by parameters.
4. Scores: scaled forward recursion over the whole text, plus the words'
   shares of their symbols.

Long documents are cut into segments only to run side by side: a segment's
transfer matrix joins it to the one before, so the likelihood is exact.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promo_engine.llm import common as C

STATES = 6
SYMBOLS = 1 << 14
BLOCK_TOKENS = 500_000
RANGE_ENTRIES = 250_000
SEGMENT = 256
SEGMENTS_AT_ONCE = 2048
TOKENS_AT_ONCE = 1 << 17
RESCALE = 8             # steps after which vectors are scaled to sum 1
BLOCKS_AT_ONCE = 2      # rows of blocks in a batch sent to Python, and in a row group of their files
TEXTS_AT_ONCE = 256
PASS_BYTES = 64 << 20   # of the blocks' files to a task of a pass; each task sends sums of all symbols
START_PASSES = 8
PASSES = 3
TOLERANCE = 5e-4        # share of its log likelihood that a pass must gain for another one to follow
EMISSION_PRIOR = 0.05
HELD_OUT_FOLD = 1


@dataclass
class Params:
    start: np.ndarray       # K
    move: np.ndarray        # K x K
    emit: np.ndarray        # (SYMBOLS + 1) x K, columns sum to 1


# ---------------------------------------------------------------- sequences
# Vectors of states are columns: arrays have a row for each state, so that a step over many segments is a few plain
# operations on long rows.

@dataclass
class _Segments:
    doc: np.ndarray
    index: np.ndarray
    at: np.ndarray
    size: np.ndarray
    prev: np.ndarray        # row of the segment before, -1 for first ones


def _segments(sizes: np.ndarray, most: int) -> _Segments:
    """Segments of at most ``most`` tokens, longest first."""
    n = -(-sizes // most)
    doc = np.repeat(np.arange(len(sizes)), n)
    index = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    at = np.repeat(np.cumsum(sizes) - sizes, n) + index * most
    size = np.minimum(most, sizes[doc] - index * most)
    order = np.argsort(-size, kind="stable")
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    prev = np.where(index[order] > 0, place[order - (index[order] > 0)], -1)
    return _Segments(doc[order], index[order], at[order], size[order], prev)


def _groups(rows: np.ndarray, size: np.ndarray) -> Iterator[np.ndarray]:
    """The rows (of segments, longest first) in groups that run side by side."""
    lo = 0
    while lo < len(rows):
        n = max(1, min(SEGMENTS_AT_ONCE, TOKENS_AT_ONCE // int(size[rows[lo]])))
        yield rows[lo:lo + n]
        lo += n


def _steps(sym: np.ndarray, at: np.ndarray, size: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """The tokens of segments (longest first) by their place in them, all at place 0 first: where each place
    begins (and the last one ends), the symbols, and for each segment where its last token is."""
    act = np.searchsorted(-size, -np.arange(int(size[0])), side="left")       # segments that reach a place
    begin = np.concatenate([[0], np.cumsum(act)])
    here = np.empty(begin[-1], dtype=np.int64)
    for t, (lo, n) in enumerate(zip(begin.tolist(), act.tolist(), strict=False)):
        np.take(sym, at[:n] + t, out=here[lo:lo + n], mode="clip")
    return begin.tolist(), here, begin[size - 1] + np.arange(len(size))


_HELD: dict[str, np.ndarray] = {}


def _rows(name: str, k: int, n: int) -> np.ndarray:
    """``k`` rows of ``n`` numbers, not set, in memory that the worker keeps under ``name`` and uses again (new
    memory for every group costs as much as the work on it).  The rows' places don't fall together in the
    processor's cache."""
    step = n + (65 - n) % 512
    if name not in _HELD or len(_HELD[name]) < k * step:
        _HELD[name] = np.empty(k * step)
    return _HELD[name][:k * step].reshape(k, step)[:, :n]


def _emissions(p: Params, here: np.ndarray) -> np.ndarray:
    e = _rows("emissions", len(p.start), len(here))
    for own, row in zip(p.emit.T, e, strict=True):
        np.take(own, here, out=row, mode="clip")
    return e


def _transfers(p: Params, sym: np.ndarray, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scaled transfer matrix (from, to, segment) of each segment and its log scale."""
    k = len(p.start)
    begin, here, _ = _steps(sym, at, size)
    e = _emissions(p, here)
    move = np.ascontiguousarray(p.move.T)
    m = np.repeat(np.eye(k)[:, :, None], len(at), axis=2)
    log, next_ = np.zeros(len(at)), np.empty_like(m)
    for t in range(len(begin) - 1):
        act = begin[t + 1] - begin[t]
        mine = m[:, :, :act]
        np.multiply(np.matmul(move, mine, out=next_[:, :, :act]), e[:, begin[t]:begin[t + 1]], out=mine)
        if t % RESCALE == RESCALE - 1:
            top = mine.max(axis=(0, 1))
            mine /= top
            log[:act] += np.log(top)
    return m, log


def _forward(p: Params, e: np.ndarray, begin: list[int], enter: np.ndarray | None
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward vectors of all tokens (emissions ``e``) in the order of ``_steps``, scaled at every ``RESCALE``th
    place, these scales (1 between), and their summed logs of each segment.  Without ``enter`` (vectors before
    the segments) they begin at the start."""
    n = begin[1]
    move = np.ascontiguousarray(p.move.T)
    a, scale, log = _rows("forward", *e.shape), _rows("scale", 1, e.shape[1])[0], np.zeros(n)
    scale[:] = 1
    a[:, :n] = p.start[:, None] if enter is None else move @ enter
    a[:, :n] *= e[:, :n]
    for t in range(len(begin) - 1):
        lo, hi = begin[t], begin[t + 1]
        now = a[:, lo:hi]
        if t:
            np.matmul(move, a[:, begin[t - 1]:begin[t - 1] + hi - lo], out=now)
            now *= e[:, lo:hi]
        if t % RESCALE == 0:                         # between, the vectors get smaller but don't vanish
            c = now.sum(axis=0)
            now /= c
            scale[lo:hi] = c
            log[:hi - lo] += np.log(c)
    return a, scale, log


def _backward(p: Params, e: np.ndarray, begin: list[int], last: np.ndarray, leave: np.ndarray) -> np.ndarray:
    """Backward vectors of all tokens, from those at the segments' last tokens; ``e`` is multiplied by them."""
    b = _rows("backward", *e.shape)
    b[:, last] = leave
    for t in range(len(begin) - 2, 0, -1):
        lo, hi = begin[t], begin[t + 1]
        before = b[:, begin[t - 1]:begin[t - 1] + hi - lo]
        e[:, lo:hi] *= b[:, lo:hi]
        np.matmul(p.move, e[:, lo:hi], out=before)
        if t % RESCALE == 0:
            before /= before.sum(axis=0)
    e[:, :begin[1]] *= b[:, :begin[1]]
    return b


def _later(p: Params, sym: np.ndarray, s: _Segments) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Rows of the segments that aren't first, by their index; the transfer matrices of all (identity for first
    ones) and their log scales."""
    k = len(p.start)
    rows = np.flatnonzero(s.prev >= 0)
    rows_by = [rows[s.index[rows] == j] for j in range(1, int(s.index.max(initial=0)) + 1)]
    mats, log = np.repeat(np.eye(k)[:, :, None], len(s.at), axis=2), np.zeros(len(s.at))
    for g in _groups(rows, s.size):
        mats[:, :, g], log[g] = _transfers(p, sym, s.at[g], s.size[g])
    return rows_by, mats, log


def _through(mats: np.ndarray, rows_by: list[np.ndarray], s: _Segments, out: np.ndarray, log: np.ndarray) -> np.ndarray:
    """Vectors entering each segment (zeros for first ones), given those at the ends (``out``) of first ones;
    completes ``out``, and ``log`` by what each segment adds."""
    enter = np.zeros_like(out)
    for rows in rows_by:
        enter[:, rows] = out[:, s.prev[rows]]
        v = np.einsum("in,ijn->jn", enter[:, rows], mats[:, :, rows])
        c = v.sum(axis=0)
        out[:, rows] = v / c
        log[rows] += np.log(c)
    return enter


def log_likelihoods(p: Params, sym: np.ndarray, sizes: np.ndarray, most: int = SEGMENT) -> np.ndarray:
    """Natural log likelihood of each sequence (``sizes`` tokens each, one after the other in ``sym``)."""
    if len(sizes) == 0:
        return np.zeros(0)
    s = _segments(sizes, most)
    rows_by, mats, log = _later(p, sym, s)
    out = np.empty((len(p.start), len(s.at)))
    for g in _groups(np.flatnonzero(s.prev < 0), s.size):
        begin, here, last = _steps(sym, s.at[g], s.size[g])
        a, _, scales = _forward(p, _emissions(p, here), begin, None)
        ends = a[:, last]
        c = ends.sum(axis=0)
        out[:, g], log[g] = ends / c, scales + np.log(c)
    _through(mats, rows_by, s, out, log)
    return np.bincount(s.doc, weights=log, minlength=len(sizes))


def expected_counts(p: Params, sym: np.ndarray, sizes: np.ndarray, most: int = SEGMENT
                    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Baum-Welch counts of all sequences: start (K), moves (K x K), emissions (symbols x K), log likelihood.

    The transfer matrices of later segments give the backward vectors at the
    ends of all; first segments are run, their ends give the forward vectors
    that enter the others, and these are run."""
    k, n_sym = len(p.start), len(p.emit)
    start, moves, emit, log = np.zeros(k), np.zeros((k, k)), np.zeros((k, n_sym)), 0.0
    if len(sizes) == 0:
        return start, moves, emit.T, log
    p = Params(p.start, p.move, np.ascontiguousarray(p.emit.T).T)      # a row of emissions for each state
    s = _segments(sizes, most)
    rows_by, mats, scales = _later(p, sym, s)
    leave, out = np.ones((k, len(s.at))), np.empty((k, len(s.at)))
    for rows in reversed(rows_by):
        b = np.einsum("ijn,jn->in", mats[:, :, rows], leave[:, rows])
        leave[:, s.prev[rows]] = b / b.sum(axis=0)
    for g in _groups(np.flatnonzero(s.prev < 0), s.size):
        more, out[:, g] = _add_counts(p, sym, s.at[g], s.size[g], None, leave[:, g], start, moves, emit)
        log += more
    enter = _through(mats, rows_by, s, out, scales)
    for g in _groups(np.flatnonzero(s.prev >= 0), s.size):
        log += _add_counts(p, sym, s.at[g], s.size[g], enter[:, g], leave[:, g], start, moves, emit)[0]
    return start, moves, emit.T, log


def _add_counts(p: Params, sym: np.ndarray, at: np.ndarray, size: np.ndarray, enter: np.ndarray | None,
                leave: np.ndarray, start: np.ndarray, moves: np.ndarray, emit: np.ndarray) -> tuple[float, np.ndarray]:
    """Adds the expected counts of segments (longest first, all first ones or none) to ``start``, ``moves`` and
    ``emit``; their log likelihood given what comes before them, and the forward vectors at their ends."""
    n = len(at)
    begin, here, last = _steps(sym, at, size)
    e = _emissions(p, here)
    a, scale, scales = _forward(p, e, begin, enter)
    ends = a[:, last]
    c = ends.sum(axis=0)
    g = _backward(p, e, begin, last, leave)
    g *= a
    total = np.sum(g, axis=0, out=_rows("total", 1, g.shape[1])[0])
    # what the vectors before and behind give together: the same sum as at a token, in the scale of the one before
    scale *= total
    g /= total
    e /= scale
    both, t = np.zeros_like(moves), 1
    same = np.diff(begin, n=2) == 0                      # places that as many segments reach as the one before
    while t < len(begin) - 1:
        to = t + 1
        while same[t - 1] and to < len(begin) - 1 and same[to - 1]:
            to += 1
        lo, hi = begin[t], begin[to]
        both += a[:, begin[t - 1]:begin[t - 1] + hi - lo] @ e[:, lo:hi].T
        t = to
    if enter is None:
        start += g[:, :n].sum(axis=1)
    else:
        both += enter @ e[:, :n].T
    moves += p.move * both
    for i in range(len(emit)):
        emit[i] += np.bincount(here, weights=g[i], minlength=emit.shape[1])
    return float((scales + np.log(c)).sum()), ends / c


def estimate(start: np.ndarray, moves: np.ndarray, emit: np.ndarray, shape: np.ndarray) -> Params:
    """Parameters of expected counts; emissions are smoothed towards ``shape``, the symbols' overall shares."""
    e = emit + EMISSION_PRIOR * len(shape) * shape[:, None]
    m, s = moves + 0.1, start + 0.1
    return Params(s / s.sum(), m / m.sum(axis=1, keepdims=True), e / e.sum(axis=0))


def starting_point(shape: np.ndarray, states: int, seed: int) -> Params:
    rng = np.random.default_rng(seed)
    e = shape[:, None] * np.exp(rng.normal(0, 1, (len(shape), states)))
    move = np.full((states, states), 0.1 / max(1, states - 1))
    np.fill_diagonal(move, 0.9 if states > 1 else 1.0)
    return Params(np.full(states, 1 / states), move, e / e.sum(axis=0))


# ------------------------------------------------------------------- blocks

def _words_of(text: bytes) -> list[bytes]:
    return text.lower().split()            # bytes.lower changes A-Z only


def _symbols(words: list[bytes], n: int) -> np.ndarray:
    return (C.word_hashes(words, seed=2) % np.uint64(n)).astype(np.int64)


_BLOCK = ("block bigint, ids array<bigint>, train array<boolean>, sizes array<int>, codes binary, "
          "words array<binary>, symbols binary")


def coded_blocks(rows: DataFrame, block_tokens: int, n_symbols: int) -> DataFrame:
    """Documents (doc_id, text, train) as blocks: code 0 is the end, code i the block's word i - 1,
    whose symbol stands in ``symbols``, so that passes over symbols don't read the words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n, held = TaskContext.get().partitionId(), 0, 0
        ids, train, sizes, codes = [], [], [], []
        table: dict[bytes, int] = defaultdict()
        table.default_factory = lambda: len(table) + 1

        def out() -> pa.RecordBatch:
            return pa.record_batch([
                pa.array([(task << 32) + n], type=pa.int64()), pa.array([ids], type=pa.list_(pa.int64())),
                pa.array([train], type=pa.list_(pa.bool_())), pa.array([sizes], type=pa.list_(pa.int32())),
                C.binary([np.concatenate(codes).astype("<i4").tobytes()]),
                pa.array([list(table)], type=pa.list_(pa.binary())),
                C.binary([_symbols(list(table), n_symbols).astype("<i4").tobytes()])],
                names=["block", "ids", "train", "sizes", "codes", "words", "symbols"])
        for b in (whole.slice(lo, TEXTS_AT_ONCE) for whole in batches for lo in range(0, whole.num_rows, TEXTS_AT_ONCE)):
            for i, t, raw in zip(b.column("doc_id").to_pylist(), b.column("train").to_pylist(), C.texts_of(b),
                                 strict=True):
                words = _words_of(raw)
                ids.append(i)
                train.append(t)
                sizes.append(len(words) + 1)
                codes.append(np.fromiter(chain(map(table.__getitem__, words), (0,)), dtype=np.int32, count=len(words) + 1))
                held += len(words) + 1
                if held >= block_tokens:
                    yield out()
                    n, held = n + 1, 0
                    ids, train, sizes, codes = [], [], [], []
                    table.clear()
        if ids:
            yield out()
    return rows.mapInArrow(run, _BLOCK)


def written_blocks(rows: DataFrame, block_tokens: int, n_symbols: int) -> DataFrame:
    """``coded_blocks``, written and read back.

    Their rows have some 4 MB.  Row groups of a few keep what executors hold to
    write and read them (row group, columns, (de)compressed pages outside the
    heap) to a few blocks; else a page takes the codes of 100 blocks, or all
    that a task writes.  Texts come in batches of few, too."""
    with C.arrow_rows(rows.sparkSession, TEXTS_AT_ONCE):
        return C.cut_lineage(coded_blocks(rows, block_tokens, n_symbols), "lm-blocks",
                             **{"parquet.block.row.count.limit": str(BLOCKS_AT_ONCE)})


class _Block:
    def __init__(self, row: dict, n_symbols: int):
        self.block = row["block"]
        self.ids, self.words = row.get("ids"), row.get("words")
        self.train = np.array(row["train"], dtype=bool)
        self.sizes = np.array(row["sizes"], dtype=np.int64)
        self.codes = np.frombuffer(row["codes"], dtype="<i4")
        own = np.frombuffer(row["symbols"], dtype="<i4").astype(np.int64)
        self.symbol = np.concatenate([[n_symbols], own])     # by code

    def parts(self, n_parts: int, n_symbols: int) -> np.ndarray:
        """Range of each word: a range of symbols; beyond one range per symbol, a part of a symbol."""
        own = self.symbol[1:]
        if n_parts <= n_symbols:
            return own * n_parts // n_symbols
        more = n_parts // n_symbols
        return own * more + (C.word_hashes(self.words, seed=3) >> np.uint64(40)).astype(np.int64) % more

    def in_training(self) -> np.ndarray:
        return np.repeat(self.train, self.sizes)


_ASK = "part int, block bigint, words binary, counts binary"
_ANSWER = "part int, block bigint, counts binary, symbols binary, seen binary, tokens binary"


def _asks(blocks: DataFrame, n_parts: int, n_symbols: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("words")
            for i, row in enumerate(C.each_row(batch.drop_columns(["words"]))):
                b = _Block(row | {"words": C.byte_strings(words.slice(i, 1).flatten())}, n_symbols)
                if not b.words:
                    continue
                counts = np.bincount(b.codes[b.in_training()], minlength=len(b.words) + 1)[1:].astype("<i4")
                part = b.parts(n_parts, n_symbols)
                order = np.argsort(part, kind="stable")
                cuts = np.flatnonzero(np.diff(part[order], prepend=-1))
                ends = np.append(cuts[1:], len(order))
                sent = [b.words[i] for i in order.tolist()]
                yield pa.record_batch([
                    pa.array(part[order][cuts], type=pa.int32()), pa.array([b.block] * len(cuts), type=pa.int64()),
                    C.binary([b" ".join(sent[a:z]) for a, z in zip(cuts, ends, strict=True)]),
                    C.binary([counts[order[a:z]].tobytes() for a, z in zip(cuts, ends, strict=True)])],
                    names=["part", "block", "words", "counts"])
    return blocks.mapInArrow(run, _ASK)


def _counted(n_symbols: int):
    """Corpus counts of a range's words, per block that asked; and, once, what its symbols have seen."""
    def run(table: pa.Table) -> pa.Table:
        lists = [w.split(b" ") for w in table.column("words").to_pylist()]
        given = [np.frombuffer(c, dtype="<i4") for c in table.column("counts").to_pylist()]
        place: dict[bytes, int] = defaultdict()
        place.default_factory = place.__len__
        at = [np.array([place[w] for w in words], dtype=np.int64) for words in lists]
        total = np.bincount(np.concatenate(at), weights=np.concatenate(given), minlength=len(place)).astype("<i8")
        own = _symbols(list(place), n_symbols)
        found, which = np.unique(own, return_inverse=True)
        seen = np.bincount(which, weights=total > 0, minlength=len(found)).astype("<i8")
        tokens = np.bincount(which, weights=total, minlength=len(found)).astype("<i8")
        n = table.num_rows
        return pa.table({
            "part": pa.concat_arrays([table.column("part").combine_chunks(), table.column("part").combine_chunks()[:1]]),
            "block": pa.array([*table.column("block").to_pylist(), None], type=pa.int64()),
            "counts": C.binary([*(total[a].tobytes() for a in at), None]),
            "symbols": C.binary([None] * n + [found.astype("<i4").tobytes()]),
            "seen": C.binary([None] * n + [seen.tobytes()]), "tokens": C.binary([None] * n + [tokens.tobytes()])})
    return run


def _symbol_totals(answers: DataFrame, n_symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct words seen, training tokens) of each symbol; its size is a parameter."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for sym, seen, tokens in zip(*(b.column(c).to_pylist() for c in ("symbols", "seen", "tokens")), strict=True):
                yield pa.record_batch([pa.array(np.frombuffer(sym, "<i4")), pa.array(np.frombuffer(seen, "<i8")),
                                       pa.array(np.frombuffer(tokens, "<i8"))], names=["symbol", "seen", "tokens"])
    got = (answers.where("block is null").select("symbols", "seen", "tokens")
           .mapInArrow(run, "symbol int, seen bigint, tokens bigint").groupBy("symbol")
           .agg(F.sum("seen").alias("seen"), F.sum("tokens").alias("tokens")).toArrow())
    out = np.zeros((2, n_symbols), dtype=np.int64)
    at = np.asarray(got.column("symbol"))
    out[0, at], out[1, at] = np.asarray(got.column("seen")), np.asarray(got.column("tokens"))
    return out[0], out[1]


def _pass(blocks: DataFrame, p: Params, n_symbols: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """One Baum-Welch pass: expected counts per partition, added up by Spark."""
    k = len(p.start)
    names = [f"s{i}" for i in range(k)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc = np.zeros((n_symbols + 1 + k + 2, k))      # emissions, moves, start, log likelihood
        for batch in batches:
            for row in C.each_row(batch):
                b = _Block(row, n_symbols)
                sym = b.symbol[b.codes[b.in_training()]]
                start, moves, emit, log = expected_counts(p, sym, b.sizes[b.train])
                acc[:n_symbols + 1] += emit
                acc[n_symbols + 1:-2] += moves
                acc[-2] += start
                acc[-1, 0] += log
        at = np.flatnonzero(acc.any(axis=1))
        yield pa.record_batch([pa.array(at, type=pa.int32()), *(pa.array(acc[at, i]) for i in range(k))],
                              names=["at", *names])
    sums = (blocks.select("block", "train", "sizes", "codes", "symbols")
            .mapInArrow(run, "at int, " + ", ".join(f"{n} double" for n in names))
            .groupBy("at").agg(*(F.sum(n).alias(n) for n in names)))
    with C.arrow_rows(blocks.sparkSession, BLOCKS_AT_ONCE), C.settings(
            blocks.sparkSession, {"spark.sql.files.maxPartitionBytes": str(PASS_BYTES)}):
        got = sums.toArrow()
    acc = np.zeros((n_symbols + 1 + k + 2, k))
    if got.num_rows:
        acc[np.asarray(got.column("at"))] = np.stack([np.asarray(got.column(n)) for n in names], axis=1)
    return acc[-2], acc[n_symbols + 1:-2], acc[:n_symbols + 1], float(acc[-1, 0])


def _fit(blocks: DataFrame, tokens: np.ndarray, ends: int, states: int, seed: int,
         start_passes: int, passes: int) -> tuple[Params, list[float]]:
    n_symbols = len(tokens)
    shape = np.append(tokens, ends).astype(np.float64) + 0.5
    shape /= shape.sum()
    p = starting_point(shape, states, seed)
    logs = []
    for _ in range(start_passes + passes):
        start, moves, emit, log = _pass(blocks, p, n_symbols)
        if start.sum() > 0:                     # there may be no training document
            p = estimate(start, moves, emit, shape)
        logs.append(log)
        if len(logs) > 1 and logs[-1] - logs[-2] <= TOLERANCE * abs(logs[-1]):
            break
    return p, logs


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", states: int = STATES,
          symbols: int = SYMBOLS, folds: int = 5, held_out: int = HELD_OUT_FOLD, seed: int = 3,
          block_tokens: int = BLOCK_TOKENS, range_entries: int = RANGE_ENTRIES,
          start_passes: int = START_PASSES, passes: int = PASSES) -> DataFrame:
    """One row per input row: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Trained on rows whose fold isn't ``held_out``.  A null text counts as
    empty: its only token is the end.  A null id is in no fold and held out
    is false; repeated rows are documents of their own.  Without training
    rows there are no counts, and words score by the smoothing alone.  Other
    columns are not read; an empty table gives no rows.
    """
    rows = C.id_text(docs, id_col, text_col)
    out = F.coalesce(C.doc_fold(folds=folds) == held_out, F.lit(False))
    n_parts = C.parts_for(C.text_bytes(rows) // 24, range_entries)
    blocks = written_blocks(rows.withColumn("train", ~out), block_tokens, symbols)
    with C.arrow_rows(docs.sparkSession, BLOCKS_AT_ONCE):
        answers = C.cut_lineage(_asks(blocks, n_parts, symbols).groupBy("part").applyInArrow(_counted(symbols), _ANSWER),
                                "lm-counts")
    seen, tokens = _symbol_totals(answers, symbols)
    ends = blocks.agg(F.coalesce(F.sum(F.size(F.filter("train", lambda x: x))), F.lit(0))).first()[0]
    n, v = int(tokens.sum()) + ends, int(seen.sum()) + int(ends > 0)
    p, _ = _fit(blocks, tokens, ends, states, seed, start_passes, passes)
    whole = np.log10(n + 0.5 * (v + 1))
    share = np.log10(np.append(tokens + 0.5 * (seen + 1), 1.0))

    def run(table: pa.Table, told: pa.Table) -> pa.Table:
        cols = {k: [] for k in ("doc_id", "held_out", "n_tokens", "n_known", "base_score", "score")}
        for row in table.to_pylist():
            b = _Block(row, symbols)
            count = np.zeros(len(b.symbol), dtype=np.int64)
            count[0] = ends
            if len(count) > 1:
                got = sorted(zip(told.column("part").to_pylist(), told.column("counts").to_pylist(), strict=True))
                order = np.argsort(b.parts(n_parts, symbols), kind="stable")
                count[1 + order] = np.concatenate([np.frombuffer(c, dtype="<i8") for _, c in got])
            weight = np.log10(count + 0.5)
            within = weight - share[b.symbol]
            within[0] = 0.0                                # the end is its symbol's only token
            doc = np.repeat(np.arange(len(b.sizes)), b.sizes)
            add = lambda x: np.bincount(doc, weights=x[b.codes], minlength=len(b.sizes))
            path = log_likelihoods(p, b.symbol[b.codes], b.sizes)
            cols["doc_id"] += b.ids
            cols["held_out"] += (~b.train).tolist()
            cols["n_tokens"] += b.sizes.tolist()
            cols["n_known"] += add(count > 0).astype(np.int64).tolist()
            cols["base_score"] += add(weight - whole).tolist()
            cols["score"] += (path / np.log(10) + add(within)).tolist()
        types = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
        return pa.table([pa.array(c, type=t) for c, t in zip(cols.values(), types, strict=True)], names=list(cols))
    # words are only needed where a symbol's words are dealt to several ranges
    coded = blocks if n_parts > symbols else blocks.drop("words")
    scored = (coded.groupBy("block").cogroup(answers.where("block is not null").select("block", "part", "counts")
                                              .groupBy("block"))
              .applyInArrow(run, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, "
                                 "base_score double, score double"))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("bigint").alias("train_tokens"),
                         "base_score", "score")
