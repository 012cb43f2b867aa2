"""Hard-negative mining with spanning trees over the anchors.

Anchors are grouped by their nearest pivot (a bounded sample of anchors) into
chunks of bounded size, and each chunk gets a minimum spanning tree.  Blocks
of candidates meet the chunks in cells of bounded size.  In a cell the tree is
walked from its root, which is scored against the whole block.  Along an edge
of length ``e`` the score of a candidate of norm ``|x|`` moves by ``e |x|`` at
most, so the parent's bounds, widened by that, bound the child's scores; only
candidates whose bounds meet the child's window are scored again.

Two passes use this.  The first finds the positives: its window is what can
be among the first few rows of the anchor's label.  The second finds the
negatives of other labels; its windows follow from the positives' scores.
Rows of equal label and vector are one candidate that carries its first ids,
so a large group of copies costs one score.  Products are exact: in doubles
where no sum can pass 2**53, else in whole numbers of any size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from promo_engine.llm import common as C

ANCHOR_STEP = 50
FLIP_STEP = 7            # rows whose id it divides get the next label
LABELS = 10
SCALE = 256
POSITIVES = 5
NEGATIVES = 3
LOW, HIGH = 50, 95       # a negative's score in hundredths of the positive's
PIVOTS = 1024            # at most
CHUNK = 400              # anchors of a chunk, on average
BLOCK = 4096             # candidates of a block, on average
SPAN = 8                 # chunks that a cell brings together with a block
SLACK = 1 + 1e-9         # on lengths, for rounding
EXACT = float(1 << 53)
FULL = 0.25              # with more of a block in the window, the whole block is scored


def packed(x: np.ndarray) -> bytes:
    """Whole numbers as 4-byte floats where these are exact, else as 8-byte ones."""
    return x.astype("<f4" if np.abs(x).max(initial=0) <= 1 << 24 else "<f8").tobytes()


def matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    raw = column.to_pylist()
    if all(len(b) == 4 * dim for b in raw):
        return np.frombuffer(b"".join(raw), dtype="<f4").reshape(len(raw), dim).astype(np.float64)
    return np.array([np.frombuffer(b, dtype="<f4" if len(b) == 4 * dim else "<f8") for b in raw]).astype(np.float64)


def spanning_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows in an order that has parents before children, the place of each
    row's parent in that order (-1: root), and the distance to it (Prim)."""
    n = len(x)
    order, parent, edge = np.zeros(n, np.int64), np.full(n, -1, np.int64), np.zeros(n)
    place, near = np.zeros(n, np.int64), np.zeros(n, np.int64)
    with np.errstate(over="ignore", invalid="ignore"):
        apart = ((x - x[0]) ** 2).sum(axis=1)
        out = np.arange(n) > 0
        for at in range(1, n):
            rest = np.flatnonzero(out)
            j = rest[np.argmin(apart[rest])]
            order[at], parent[at], edge[at] = j, place[near[j]], np.sqrt(apart[j])
            place[j], out[j] = at, False
            d = ((x - x[j]) ** 2).sum(axis=1)
            closer = out & (d < apart)
            apart[closer], near[closer] = d[closer], j
    return order, parent, np.nan_to_num(edge, nan=np.inf) * SLACK


@dataclass
class Block:
    """Candidates of one cell: vectors, norms, labels and the first ids of each."""
    x: np.ndarray
    norm: np.ndarray
    label: np.ndarray
    ids: np.ndarray
    ends: np.ndarray

    @classmethod
    def of(cls, t: pa.Table, dim: int) -> Block:
        x = matrix(t.column("v"), dim)
        lists = t.column("ids").combine_chunks()
        with np.errstate(over="ignore"):
            norm = np.sqrt((x * x).sum(axis=1)) * SLACK
        return cls(x, norm, np.asarray(t.column("label").combine_chunks()),
                   np.asarray(lists.flatten()), np.cumsum([0, *np.asarray(lists.value_lengths())]))

    def scores(self, a: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Exact products of ``a`` with the candidates ``at``, as whole numbers; one that 64 bits
        can't hold is the least of them."""
        x = self.x if len(at) == len(self.x) else self.x[at]
        with np.errstate(over="ignore"):
            most = np.sqrt((a * a).sum()) * self.norm.max(initial=0.0)
        if most < EXACT:
            return (x @ a).astype(np.int64)
        whole = [int(v) for v in a]
        s = [sum(int(p) * q for p, q in zip(row, whole, strict=True)) for row in x]
        return np.array([v if abs(v) < 1 << 63 else -(1 << 63) for v in s], dtype=np.int64)

    def first(self, at: np.ndarray, s: np.ndarray, keep: int, without: int | None = None):
        """Ids and scores of the first ``keep`` rows among the candidates ``at`` with scores ``s``."""
        more = keep + (without is not None)
        if len(s) > more:
            ok = s >= np.partition(s, len(s) - more)[len(s) - more]
            at, s = at[ok], s[ok]
        n = self.ends[at + 1] - self.ends[at]
        ids = self.ids[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.ends[at], n)]
        s = np.repeat(s, n)
        if without is not None:
            s, ids = s[ids != without], ids[ids != without]
        by = np.lexsort((ids, -s))[:keep]
        return ids[by], s[by]


def _kth(values: np.ndarray, k: int) -> float:
    """The ``k``-th largest value, or less than all if there are fewer."""
    return -np.inf if len(values) < k else np.partition(values, len(values) - k)[len(values) - k]


def walk(block: Block, x: np.ndarray, parent: np.ndarray, edge: np.ndarray,
         needed: Callable[[int, np.ndarray, np.ndarray], np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``row, candidates, scores`` of every row of the tree, with all candidates that ``needed`` finds by
    their bounds."""
    children = np.bincount(parent[parent >= 0], minlength=len(x))
    have: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    every = np.arange(len(block.x))
    for i in range(len(x)):
        up = int(parent[i])
        at = every
        if up >= 0:
            with np.errstate(over="ignore", invalid="ignore"):
                reach = np.nan_to_num(edge[i] * block.norm, nan=np.inf, posinf=np.inf) * SLACK
                low, high = have[up][0] - reach, have[up][1] + reach
            children[up] -= 1
            if children[up] == 0:
                del have[up]
            need = np.flatnonzero(needed(i, low, high))
            if len(need) <= FULL * len(every):
                at = need
        s = block.scores(x[i], at)
        if children[i]:
            if at is every:
                low = high = s.astype(np.float64)
                low, high = low - np.abs(low) * 1e-15, high + np.abs(high) * 1e-15
            else:
                low[at] = high[at] = s
            have[i] = (low, high)
        yield i, at, s


def _positives(keep: int):
    def run(block: Block, anchors: pa.Table, x: np.ndarray, parent: np.ndarray, edge: np.ndarray) -> Iterator[tuple]:
        label, ids = (np.asarray(anchors.column(c).combine_chunks()) for c in ("label", "vec_id"))
        same = {v: block.label == v for v in np.unique(label).tolist()}

        def needed(i: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
            mine = same[int(label[i])]
            return mine & (high >= _kth(low[mine], keep + 1))
        for i, at, s in walk(block, x, parent, edge, needed):
            mine = same[int(label[i])][at]
            found, s = block.first(at[mine], s[mine], keep, without=int(ids[i]))
            yield np.full(len(found), ids[i]), np.zeros(len(found), np.int64), found, s
    return run


def window(positive_score: int) -> tuple[int, int]:
    """The least and the largest score of a negative."""
    return -(-LOW * positive_score // 100), HIGH * positive_score // 100


def _negatives(keep: int):
    def run(block: Block, anchors: pa.Table, x: np.ndarray, parent: np.ndarray, edge: np.ndarray) -> Iterator[tuple]:
        label, ids = (np.asarray(anchors.column(c).combine_chunks()) for c in ("label", "vec_id"))
        asked = anchors.column("asked").to_pylist()
        other = {v: block.label != v for v in np.unique(label).tolist()}

        def needed(i: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
            out = np.zeros(len(low), dtype=bool)
            for p in asked[i]:
                least, most = window(p)
                meets = other[int(label[i])] & (high >= least) & (low <= most)
                inside = meets & (low >= least) & (high <= most)
                out |= meets & (high >= _kth(low[inside], keep))
            return out
        for i, at, s in walk(block, x, parent, edge, needed):
            mine = other[int(label[i])][at]
            mine_at, mine_s = at[mine], s[mine]
            for p in asked[i]:
                least, most = window(p)
                ok = (mine_s >= least) & (mine_s <= most)
                found, got = block.first(mine_at[ok], mine_s[ok], keep)
                yield np.full(len(found), ids[i]), np.full(len(found), p), found, got
    return run


def _cell(pass_: Callable):
    def run(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        out = [(np.empty(0, np.int64),) * 4]
        if anchors.num_rows and candidates.num_rows:
            dim = candidates.column("dim")[0].as_py()
            block = Block.of(candidates, dim)
            anchors = anchors.sort_by([("chunk", "ascending"), ("place", "ascending")])
            starts = [*C.group_starts(anchors, ["chunk"]).tolist(), anchors.num_rows]
            for lo, hi in zip(starts, starts[1:]):
                part = anchors.slice(lo, hi - lo)
                parent, edge = (np.asarray(part.column(c).combine_chunks()) for c in ("parent", "edge"))
                out += pass_(block, part, matrix(part.column("v"), dim), parent, edge)
        return pa.table([pa.array(np.concatenate(c), type=pa.int64()) for c in zip(*out, strict=True)],
                        names=["anchor_id", "asked", "vec_id", "score"])
    return run


def _planted(chunk: pa.Table) -> pa.Table:
    """A chunk's anchors in the order of its tree."""
    chunk = chunk.sort_by("vec_id")
    order, parent, edge = spanning_tree(matrix(chunk.column("v"), chunk.column("dim")[0].as_py()))
    chunk = chunk.take(pa.array(order))
    return pa.table({c: chunk.column(c) for c in ("chunk", "span", "dim", "vec_id", "label", "v")}
                    | {"place": pa.array(np.arange(len(order)), type=pa.int32()),
                       "parent": pa.array(parent, type=pa.int32()), "edge": pa.array(edge)})


def usable(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``vec_id, label, dim, v`` of the rows that take part, labels changed, vectors scaled and packed."""
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    label = F.col(label_col).cast("bigint")
    rows = (vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), label.alias("label"), v.alias("v"))
            .where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()
                   & F.coalesce(whole, F.lit(False)))
            .withColumn("label", F.when(F.col("vec_id") % FLIP_STEP == 0, (F.col("label") + 1) % LABELS)
                        .otherwise(F.col("label"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = b.column("v")
            flat, ends = np.asarray(col.values, dtype=np.float64), np.asarray(col.offsets)
            with np.errstate(over="ignore"):
                flat = np.clip(np.floor(flat * SCALE), -np.finfo(float).max, np.finfo(float).max) + 0.0
            yield pa.record_batch([
                b.column("vec_id"), b.column("label"), pa.array(np.diff(ends), type=pa.int32()),
                C.binary([packed(flat[p:q]) for p, q in zip(ends[:-1], ends[1:])])], names=["vec_id", "label", "dim", "v"])
    return (rows.mapInArrow(run, "vec_id bigint, label bigint, dim int, v binary")
            .groupBy("vec_id").agg(F.min(F.struct("label", "dim", "v")).alias("s")).select("vec_id", "s.*"))


def planted(anchors: DataFrame, chunk: int, pivots: int, span: int) -> tuple[DataFrame, dict[int, int]]:
    """(the anchors in trees: ``chunk, span, dim, vec_id, label, v, place, parent, edge``; spans of each dimension)."""
    spark = anchors.sparkSession
    wanted = min(pivots, C.parts_for(anchors.count(), chunk))
    near: dict[int, list[bytes]] = {}
    for r in anchors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(wanted).select("dim", "v").collect():
        near.setdefault(r["dim"], []).append(bytes(r["v"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piv = {d: matrix(pa.chunked_array([C.binary(v)]), d) for d, v in near.items()}
        for b in batches:
            dims = np.asarray(b.column("dim"))
            got = np.zeros(len(dims), dtype=np.int64)
            for d in set(dims.tolist()) & set(piv):
                at = np.flatnonzero(dims == d)
                x = matrix(pa.chunked_array([b.column("v").take(pa.array(at))]), d)
                with np.errstate(over="ignore", invalid="ignore"):
                    got[at] = np.argmin(np.nan_to_num((piv[d] ** 2).sum(axis=1) - 2 * (x @ piv[d].T), nan=np.inf), axis=1)
            yield pa.record_batch([b.column("vec_id"), pa.array(got, type=pa.int32()), *[b.column(c) for c in _ROW]],
                                  names=["vec_id", "pivot", *_ROW])
    placed = C.cut_lineage(anchors.select("vec_id", *_ROW).mapInArrow(
        run, "vec_id bigint, pivot int, label bigint, dim int, v binary"), "negatives-anchors")
    # one row per pivot and dimension: their chunks get consecutive numbers
    first, spans, sizes = [], {}, placed.groupBy("dim", "pivot").agg(F.count(F.lit(1)).alias("n")).collect()
    number = 0
    for r in sorted(sizes, key=lambda r: (r["dim"], r["pivot"])):
        parts = C.parts_for(r["n"], chunk)
        first.append((r["dim"], r["pivot"], number, parts))
        number += parts
        spans[r["dim"]] = spans.get(r["dim"], 0) + parts
    spans = {d: C.parts_for(n, span) for d, n in spans.items()}
    groups = spark.createDataFrame([(*f, spans[f[0]]) for f in first],
                                   "dim int, pivot int, first bigint, parts int, spans int")
    chunk_no = F.col("first") + F.pmod(F.xxhash64("vec_id"), F.col("parts"))
    cut = (placed.join(F.broadcast(groups), ["dim", "pivot"]).withColumn("chunk", chunk_no)
           .withColumn("span", F.pmod("chunk", "spans").cast("int")))
    return C.cut_lineage(
        cut.select("chunk", "span", "vec_id", *_ROW).groupBy("chunk").applyInArrow(
            _planted, "chunk bigint, span int, dim int, vec_id bigint, label bigint, v binary, place int, parent int, "
                      "edge double"), "negatives-trees"), spans


_ROW = ["label", "dim", "v"]


def mine(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
         anchor_step: int = ANCHOR_STEP, positives: int = POSITIVES, negatives: int = NEGATIVES,
         chunk: int = CHUNK, block: int = BLOCK, pivots: int = PIVOTS, span: int = SPAN) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``:
    for every anchor and each of its positives the first ``negatives`` rows of
    another label whose score is 50 to 95 hundredths of the positive's.

    Rows without id, label or vector, or with a null or non-finite part, take
    no part; zero and empty vectors do.  Rows of another dimension than the
    anchor's are neither its positives nor its negatives.  Rows repeated under
    one id count once (the least label, then vector).  An anchor without
    positives, or a positive with no row in its window, gives no rows; ties go
    to the smaller id.  A pair whose product passes 64 bits counts as the
    least 64-bit number.  Other columns are not read; an empty table gives no
    rows.
    """
    spark = vectors.sparkSession
    rows = C.cut_lineage(usable(vectors, id_col, vector_col, label_col), "negatives-rows")
    # the limit on the number is applied before the shuffle too
    keep = max(positives + 1, negatives)
    same = Window.partitionBy(*_ROW).orderBy("vec_id")
    candidates = C.cut_lineage(
        rows.withColumn("at", F.row_number().over(same)).where(F.col("at") <= keep)
        .groupBy(*_ROW).agg(F.array_sort(F.collect_list("vec_id")).alias("ids")), "negatives-candidates")
    trees, spans = planted(rows.where(F.col("vec_id") % anchor_step == 0), chunk, pivots, span)
    counts = candidates.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()            # one row per dimension
    grid = spark.createDataFrame([(r["dim"], C.parts_for(r["n"], block), spans[r["dim"]]) for r in counts if r["dim"] in spans],
                                 "dim int, blocks int, spans int")
    laid = (candidates.join(F.broadcast(grid), "dim")
            .withColumn("block", F.pmod(F.xxhash64(F.col("ids")[0]), F.col("blocks")).cast("int"))
            .withColumn("span", F.explode(F.sequence(F.lit(0), F.col("spans") - 1)))
            .select("dim", "block", "span", "ids", "label", "v"))
    key = ["dim", "block", "span"]

    def found(anchors: DataFrame, pass_: Callable, limit: int, by: list[str]) -> DataFrame:
        spread = (anchors.join(F.broadcast(grid.select("dim", "blocks")), "dim")
                  .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks"))
        near = spread.groupBy(key).cogroup(laid.groupBy(key)).applyInArrow(
            _cell(pass_), "anchor_id bigint, asked bigint, vec_id bigint, score bigint")
        order = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id")
        return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit)
    best = C.cut_lineage(found(trees, _positives(positives), positives, ["anchor_id"]).select(
        "anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "negatives-positives")
    asked = best.groupBy("anchor_id").agg(F.collect_set("positive_score").alias("asked"))      # a few per anchor
    second = trees.join(asked.withColumnRenamed("anchor_id", "vec_id"), "vec_id")
    worst = found(second, _negatives(negatives), negatives, ["anchor_id", "asked"])
    return best.join(worst.withColumnRenamed("asked", "positive_score"), ["anchor_id", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
