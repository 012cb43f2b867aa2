"""Approximate nearest neighbours by cross-polytope hashing.

Every vector is scaled to unit length and turned by pseudo-random rotations
(sign flips and fast Hadamard transforms, three times); each rotation assigns
it to the nearest of the signed axes, and two rotations name its bucket in a
table.  All vectors are in the index, with their buckets in ``TABLES``
tables; blocks of it of bounded size each hold their part of every table.  A
query ranks a table's buckets by its own two coordinates along their axes,
probes the best, and the vectors found in them, together, are its candidates:
these alone are ranked by their exact inner product in double precision.

The number of probes follows from the number of vectors: together they reach
a share ``reach`` of evenly spread vectors, that falls with their number.
Angles don't tell lengths, so the longest vectors are candidates of every
query: those above a quantile of the lengths, ``longest(n)`` of the vectors
at most.

Equal vectors are searched once: a class of equal vectors is one index entry
that carries its smallest ids (as many as a result can hold), and queries of
one vector share one search.  A query that its probes leave with too few
candidates is searched again with all buckets probed, which is exact.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promo_engine.llm import common as C

NEIGHBOURS = 20
QUERY_STEP = 20
TABLES = 16
REACH, REACH_AT, REACH_POWER = 0.185, 10_000, 0.3       # share of the vectors reached, at so many, and its fall
LONGEST = 0.2            # of that share, the longest vectors are candidates of all queries
BLOCK_VALUES = 1 << 20    # numbers in the vectors of a block
CHUNK = 4096              # queries that meet a block in one cell
QUERIES_AT_ONCE = 256
PAIRS_AT_ONCE = 1 << 15
DENSE = 256               # rotations of so many axes are applied as matrices


def hadamard(x: np.ndarray) -> np.ndarray:
    """The orthonormal fast Walsh-Hadamard transform of each row (length a power of 2)."""
    n, d = x.shape
    h = 1
    while h < d:
        y = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


def rotated(x: np.ndarray, table: int, seed: int) -> np.ndarray:
    """Unit vectors of ``x`` after the pseudo-rotation of ``table``; zeros pad to a power of 2."""
    # scaled by the largest part first, so that no square overflows or vanishes
    x = x / np.abs(x).max(axis=1, keepdims=True)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    d = 1 << max(0, (x.shape[1] - 1).bit_length())
    x = np.pad(x, ((0, 0), (0, d - x.shape[1])))
    signs = np.random.default_rng([seed, table, d]).choice([-1.0, 1.0], (3, d))
    for s in signs:
        x = hadamard(x * s)
    return x


@functools.lru_cache(maxsize=4)
def _matrices(d: int, tables: int, seed: int) -> np.ndarray | None:
    """The rotations of all tables side by side, for vectors of ``d`` parts."""
    return np.concatenate([rotated(np.eye(d), t, seed) for t in range(2 * tables)], axis=1) if d <= DENSE else None


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)       # by the largest part first: no square overflows or vanishes
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def turned(x: np.ndarray, tables: int, seed: int) -> np.ndarray:
    """Unit vectors of ``x`` after both rotations of every table: rows x (2 tables) x axes."""
    every = _matrices(x.shape[1], tables, seed)
    if every is None:
        return np.stack([rotated(x, t, seed) for t in range(2 * tables)], axis=1)
    return (unit(x) @ every).reshape(len(x), 2 * tables, -1)


def buckets(r: np.ndarray) -> np.ndarray:
    """The bucket of each row in every table: its nearest signed axes (2k: +k, 2k+1: -k) in both rotations."""
    at = np.abs(r).argmax(axis=2)
    axis = 2 * at + (np.take_along_axis(r, at[:, :, None], 2)[:, :, 0] < 0)
    return (axis[:, 0::2] * (2 * r.shape[2]) + axis[:, 1::2]).astype(np.int32)


def probed(a: np.ndarray, b: np.ndarray, probes: int) -> np.ndarray:
    """For each query the ``probes`` buckets of a table with the largest sum
    of its coordinates ``a`` and ``b`` along their axes."""
    axes = 2 * a.shape[1]
    signed = [np.stack([c, -c], axis=2).reshape(len(c), axes) for c in (a, b)]
    m = min(axes, max(48, 4 * math.isqrt(probes) + 4))         # the best sums are of large coordinates
    if m < axes:
        at = [np.argpartition(-c, m - 1, axis=1)[:, :m] for c in signed]
    else:
        at = [np.tile(np.arange(axes), (len(a), 1))] * 2
    top = [np.take_along_axis(c, i, 1) for c, i in zip(signed, at, strict=True)]
    sums = (top[0][:, :, None] + top[1][:, None, :]).reshape(len(a), m * m)
    pick = np.argpartition(-sums, probes - 1, axis=1)[:, :probes] if probes < m * m else np.tile(np.arange(m * m), (len(a), 1))
    return np.take_along_axis(at[0], pick // m, 1) * axes + np.take_along_axis(at[1], pick % m, 1)


def reach(n: int) -> float:
    """Share of ``n`` evenly spread vectors that the probes of all tables find together."""
    return min(1.0, REACH * (REACH_AT / max(n, 1)) ** REACH_POWER)


def longest(n: int) -> float:
    """Share of ``n`` vectors that are long enough to be compared with every query."""
    return LONGEST * reach(n)


def probes_for(n: int, dim: int, tables: int) -> int:
    """Probes a table: together the tables reach ``reach(n)`` of the vectors."""
    every = (2 << max(0, (dim - 1).bit_length())) ** 2
    return max(1, math.ceil((1 - (1 - reach(n)) ** (1 / tables)) * every))


def found_in(block: np.ndarray, r: np.ndarray, probes: int) -> np.ndarray:
    """Queries x entries: whether a probe of the query (rotated: ``r``) hits a bucket of the entry (``block``)."""
    out = np.zeros((len(r), len(block)), dtype=bool)
    for t in range(block.shape[1]):
        order = np.argsort(block[:, t], kind="stable")
        keys = block[order, t]
        ask = probed(r[:, 2 * t], r[:, 2 * t + 1], probes)
        lo, hi = np.searchsorted(keys, ask, "left").ravel(), np.searchsorted(keys, ask, "right").ravel()
        n = hi - lo
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
        out[np.repeat(np.repeat(np.arange(len(r)), ask.shape[1]), n), order[place]] = True
    return out


def pack(x: np.ndarray) -> bytes:
    """A vector as 4-byte floats where these are exact, else as 8-byte ones."""
    with np.errstate(over="ignore"):
        small = x.astype("<f4")
    return (small if np.array_equal(small.astype(np.float64), x) else x.astype("<f8")).tobytes()


def unpack(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    raw = column.to_pylist()
    if all(len(b) == 4 * dim for b in raw):
        return np.frombuffer(b"".join(raw), dtype="<f4").reshape(len(raw), dim).astype(np.float64)
    return np.array([np.frombuffer(b, dtype="<f4" if len(b) == 4 * dim else "<f8") for b in raw]).astype(np.float64)


def index(distinct: DataFrame, tables: int, seed: int) -> DataFrame:
    """``rep, asked, dim, length, v, codes`` of every distinct vector: its length, packed parts and buckets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 1024):
                part = b.slice(lo, 1024)
                vecs = part.column("v")
                ends, flat = np.asarray(vecs.offsets), np.asarray(vecs.values, dtype=np.float64)
                for d in np.unique(np.diff(ends)).tolist():
                    at = np.flatnonzero(np.diff(ends) == d)
                    x = flat[(ends[at][:, None] + np.arange(d)).ravel()].reshape(len(at), d)
                    with np.errstate(over="ignore"):
                        length = np.sqrt((x * x).sum(axis=1))
                    codes = buckets(turned(x, tables, seed))
                    pick = pa.array(at)
                    yield pa.record_batch([
                        part.column("rep").take(pick), part.column("asked").take(pick),
                        pa.array(np.full(len(at), d), type=pa.int32()), pa.array(length), C.binary([pack(v) for v in x]),
                        C.binary([c.tobytes() for c in codes])], names=["rep", "asked", "dim", "length", "v", "codes"])
    return distinct.select("rep", F.col("asked").isNotNull().alias("asked"), "v").mapInArrow(
        run, "rep bigint, asked boolean, dim int, length double, v binary, codes binary")


def _ranked(keep: int, tables: int, seed: int, plan: dict[int, tuple[int, float]], everything: bool):
    """Of a block and queries: each query's best ``keep`` candidates in the block."""
    def run(table_q: pa.Table, table_x: pa.Table) -> pa.Table:
        out = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
        if table_q.num_rows and table_x.num_rows:
            dim = table_x.column("dim")[0].as_py()
            probes, long = plan[dim]
            x, q = unpack(table_x.column("v"), dim), unpack(table_q.column("v"), dim)
            rx, rq = (np.asarray(t.column("rep").combine_chunks()) for t in (table_x, table_q))
            order = np.argsort(rx, kind="stable")
            x, rx = x[order], rx[order]
            always = np.asarray(table_x.column("length").combine_chunks())[order] > long
            block = np.frombuffer(b"".join(table_x.column("codes").to_pylist()), dtype=np.int32).reshape(len(x), -1)[order]
            for lo in range(0, len(q), QUERIES_AT_ONCE):
                part = q[lo:lo + QUERIES_AT_ONCE]
                if everything:
                    hit = np.ones((len(part), len(x)), dtype=bool)
                else:
                    hit = found_in(block, turned(part, tables, seed), probes)
                    hit[:, always] = True
                i, j = np.nonzero(hit)
                score = np.empty(len(i))
                for k in range(0, len(i), PAIRS_AT_ONCE):
                    at = slice(k, k + PAIRS_AT_ONCE)
                    score[at] = (part[i[at]] * x[j[at]]).sum(axis=1)
                ends = np.searchsorted(i, np.arange(len(part) + 1))
                for n, (a, z) in enumerate(zip(ends[:-1], ends[1:])):
                    s, c = score[a:z], j[a:z]
                    if z - a > keep:
                        ok = s >= np.partition(s, z - a - keep)[z - a - keep]
                        s, c = s[ok], c[ok]
                    by = np.lexsort((rx[c], -s))[:keep]
                    out.append((np.full(len(by), rq[lo + n]), rx[c[by]], s[by]))
        return pa.table([pa.array(np.concatenate(c), type=t) for c, t in zip(
            zip(*out, strict=True), (pa.int64(), pa.int64(), pa.float64()), strict=True)], names=["q", "rep", "score"])
    return run


def _search(entries: DataFrame, queries: DataFrame, cell, block_values: int, chunk: int) -> DataFrame:
    """``q, rep, score``: every query against every block of the entries of its dimension."""
    spark = entries.sparkSession
    sizes = {r["dim"]: r["n"] for r in entries.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}
    asked = {r["dim"]: r["n"] for r in queries.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}
    grid = F.broadcast(spark.createDataFrame(
        [(d, C.parts_for(n * d, block_values), C.parts_for(asked[d], chunk)) for d, n in sizes.items() if d in asked],
        "dim int, blocks int, groups int"))                                 # one row per dimension
    place = lambda n: F.pmod(F.xxhash64("rep"), F.col(n)).cast("int")
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    key = ["dim", "block", "grp"]
    have = (entries.join(grid, "dim").withColumn("block", place("blocks")).withColumn("grp", spread("groups"))
            .select(*key, "rep", "length", "v", "codes"))
    ask = (queries.join(grid, "dim").withColumn("grp", place("groups")).withColumn("block", spread("blocks"))
           .select(*key, "rep", "v").toDF(*key, "rep", "v"))
    return ask.groupBy(key).cogroup(have.groupBy(key)).applyInArrow(cell, "q bigint, rep bigint, score double")


def _usable(v: Column) -> Column:
    whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return v.isNotNull() & F.coalesce(whole, F.lit(False)) & F.exists(v, lambda x: x != 0)


def nearest(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", neighbours: int = NEIGHBOURS,
            query_step: int = QUERY_STEP, tables: int = TABLES, seed: int = 5, chunk: int = CHUNK,
            block_values: int = BLOCK_VALUES) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every row whose id is divisible
    by ``query_step`` the ``neighbours`` rows found with the largest inner
    product, nearest first, ties to the smaller id; all, if there are fewer.

    Vectors that are null, empty, zero or hold null or non-finite parts take
    no part, nor do rows without an id.  Rows repeated under one id count
    once (of different vectors the least in array order).  Vectors of another
    dimension than the query's are no candidates.  Equal vectors are ordered
    by id.  Other columns are not read; an empty table gives no rows.
    """
    keep = neighbours + 1                                     # the query itself is among the found
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    rows = (vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), v.alias("v"))
            .where(F.col("vec_id").isNotNull() & _usable(F.col("v")))
            .select("vec_id", F.transform("v", lambda x: x + F.lit(0.0)).alias("v"))          # -0.0 is 0.0
            .groupBy("vec_id").agg(F.min("v").alias("v")))
    rows = C.cut_lineage(rows, "vectors")
    # the least ids of every distinct vector; the limit on the rank is applied before the shuffle too
    first = (rows.withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).where(F.col("r") <= keep)
             .groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
             .select(F.get("ids", F.lit(0)).alias("rep"), "v", "ids"))
    asked = rows.where(F.col("vec_id") % query_step == 0)
    distinct = C.cut_lineage(
        first.join(asked.groupBy("v").agg(F.count(F.lit(1)).alias("asked")), "v", "left"), "distinct-vectors")
    entries = C.cut_lineage(index(distinct, tables, seed), "hashed-vectors")
    queries = entries.where("asked")
    # one row per dimension
    quantiles = [i / 200 for i in range(150, 200)]
    stats = entries.groupBy("dim").agg(F.count(F.lit(1)).alias("n"),
                                       F.percentile_approx("length", quantiles, 10_000).alias("long")).collect()
    plan = {r["dim"]: (probes_for(r["n"], r["dim"], tables),
                       r["long"][min(i for i, p in enumerate([*quantiles[:-1], 2.0]) if p >= 1 - longest(r["n"]))]) for r in stats}

    def searched(asked: DataFrame, everything: bool) -> DataFrame:
        cell = _ranked(keep, tables, seed, plan, everything)
        return C.cut_lineage(_best(_search(entries, asked, cell, block_values, chunk), keep), "found")
    found = searched(queries, False)
    ids = distinct.select("rep", "ids")

    def expanded(best: DataFrame) -> DataFrame:
        return best.join(ids, "rep").select("q", F.explode("ids").alias("vec_id"), "score")
    # probes that gathered too little: all buckets
    short = C.cut_lineage(queries.join(
        expanded(found).groupBy(F.col("q").alias("rep")).agg(F.count(F.lit(1)).alias("n")), "rep", "left")
        .where(F.coalesce("n", F.lit(0)) < keep).select("rep", "dim", "v"), "short")
    if not short.isEmpty():
        found = (found.join(short.select(F.col("rep").alias("q")), "q", "left_anti")
                 .unionByName(searched(short, True)))
    lists = (expanded(found).withColumn("r", F.row_number().over(
        Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))).where(F.col("r") <= keep)
        .groupBy("q").agg(F.array_sort(F.collect_list(F.struct("r", "vec_id", "score"))).alias("near")))
    named = (asked.withColumnRenamed("vec_id", "query_id")
             .join(distinct.where("asked is not null").select("v", F.col("rep").alias("q")), "v").select("query_id", "q"))
    others = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, neighbours)
    return (named.join(lists, "q").select("query_id", F.posexplode(others).alias("at", "x"))
            .select("query_id", (F.col("at") + 1).alias("rank"), "x.vec_id", "x.score"))


def _best(found: DataFrame, keep: int) -> DataFrame:
    """The best ``keep`` entries of each query."""
    w = Window.partitionBy("q").orderBy(F.desc("score"), "rep")
    return found.withColumn("r", F.row_number().over(w)).where(F.col("r") <= keep).drop("r")
