"""Sharding by sampled splitters (DataFrame functions only).

Keys order the rows: the hash of the text, then the id, then a row number,
so equal texts lie side by side and every key is its own.  Size-weighted
samples of the text hashes give quantile boundaries of many small ranges;
the ranges' exact sizes are counted, and a range that is overfull (a hot
group of copies) is subdivided by samples of whole keys inside it until it
isn't.  A window inside each range and the ranges' totals give every row the
bytes and rows that come before it, hence its shard and slot.

Only splitters and range totals, a number set by parameters, reach the
driver; the texts are read once and never moved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promo_engine.llm import common as C

LAW = "bytes"
SHARDS = 24
ROWS_PER_RANGE = 50_000
LEAST_RANGES, MOST_RANGES = 96, 4096
SAMPLES_PER_RANGE = 24
#: A group of equal texts up to this share of a shard's bytes stays in one shard.
WHOLE_GROUP = 0.01
_LOWEST = "0" * 16


def _hex(c: Column) -> Column:
    """Fixed-width text that sorts as the signed 64-bit value."""
    return F.lpad(F.hex(c.bitwiseXOR(F.lit(-2 ** 63))), 16, "0")


def _array(values: list, kind: str) -> Column:
    """A constant array, as one literal however long."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def _range_of(key: Column, splitters: list[str]) -> Column:
    """How many splitters are at or below ``key``: a search in two steps."""
    if not splitters:
        return F.lit(0)
    step = max(1, round(len(splitters) ** 0.5))
    leads = splitters[::step]
    groups = F.transform(F.split(F.lit(";".join(",".join(splitters[i:i + step]) for i in range(0, len(splitters), step))),
                                 ";"), lambda g: F.split(g, ","))
    lead = F.size(F.filter(F.split(F.lit(",".join(leads)), ","), lambda s: s <= key))
    inside = F.size(F.filter(F.get(groups, lead - 1), lambda s: s <= key))
    return F.when(lead == 0, 0).otherwise((lead - 1) * step + inside).cast("int")


def _sample(rows: DataFrame, step: float, seed: int, cut: Column) -> list[tuple[str, int]]:
    """Keys (cut as given) drawn with a chance in proportion to their size, one in ``step``
    bytes on average; a row above ``step`` bytes is always drawn and counts in full."""
    got = (rows.where(F.rand(seed) * F.lit(float(step)) < F.col("size"))
           .groupBy(cut.alias("k")).agg(F.sum(F.greatest("size", F.lit(int(step)))).alias("w")).orderBy("k").collect())
    return [(r["k"], r["w"]) for r in got]


def _quantiles(sample: list[tuple[str, int]], n: int) -> list[str]:
    """Boundaries of ``n`` parts of equal weight."""
    total = sum(w for _, w in sample)
    out, run = [], 0
    for k, w in sample:
        if run >= (len(out) + 1) * total / n and (not out or k > out[-1]):
            out.append(k)
            while run >= (len(out) + 1) * total / n:
                n, total, run = max(2, n - 1), total, run   # a heavy key fills several parts
                if n <= len(out) + 1:
                    break
        run += w
    return out


def shard(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", seed: int = 11,
          rows_per_range: int = ROWS_PER_RANGE, whole_group: float = WHOLE_GROUP) -> DataFrame:
    """One row per input row: ``doc_id, size, text_crc32, law, shard, slot,
    grown_shard`` by the law ``bytes``: shards 0 to ``shards - 1`` hold nearly
    equal bytes, off by a document or a small group at most.

    ``size`` is the text's UTF-8 bytes plus 8 (null: 8, crc32 of nothing: 0);
    ``slot`` counts from 0 without gaps in each shard; ``grown_shard`` is null
    under this law.  Equal texts stay together unless the group has over
    ``whole_group`` of a shard's bytes; null and empty texts are one group.
    Null ids sort first; repeated rows are rows of their own.  A table with
    fewer rows than shards leaves shards empty; an empty one gives no rows.
    Other columns are not read.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    hashed = _hex(F.xxhash64(text))
    rows = C.cut_lineage(
        C.id_text(docs, id_col, text_col)
        .select("doc_id", (F.octet_length(text).cast("bigint") + 8).alias("size"),
                F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), hashed.alias("group"),
                F.concat(F.coalesce(_hex(F.col("doc_id")), F.lit(_LOWEST)),
                         _hex(F.monotonically_increasing_id())).alias("rest"))
        .select("doc_id", "size", "text_crc32", "group", F.concat("group", "rest").alias("key")), "shard-rows")
    total, n = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    n_ranges = min(MOST_RANGES, max(LEAST_RANGES, -(-n // rows_per_range)))
    target = max(1.0, total / n_ranges)
    step = target / SAMPLES_PER_RANGE
    lowest = F.concat("group", F.lit(_LOWEST * 2))            # so a boundary never parts equal texts
    splitters = _quantiles(_sample(rows, step, seed, lowest), n_ranges)

    def totals(cuts: list[str]) -> dict[int, tuple[int, int]]:
        got = rows.groupBy(_range_of(F.col("key"), cuts).alias("r")).agg(
            F.sum("size").alias("b"), F.count(F.lit(1)).alias("c"), F.max("size").alias("m")).collect()
        return {x["r"]: (x["b"], x["c"], x["m"]) for x in got}

    sizes = totals(splitters)
    for again in range(1, 9):
        over = [r for r, (b, c, m) in sizes.items() if b > 2 * target + m and c > 1]
        if not over:
            break
        inside = rows.where(_range_of(F.col("key"), splitters).isin(over))
        drawn = _sample(inside, step, seed + again, F.col("key"))
        more = set()
        for r in over:
            lo = splitters[r - 1] if r else ""
            hi = splitters[r] if r < len(splitters) else "~"
            more |= set(_quantiles([x for x in drawn if lo <= x[0] < hi], -(-int(sizes[r][0]) // int(target))))
        if more <= set(splitters):
            break
        splitters = sorted(set(splitters) | more)
        sizes = totals(splitters)

    bytes_before, rows_before, at, count = [], [], 0, 0
    for r in range(len(splitters) + 1):
        bytes_before.append(at)
        rows_before.append(count)
        at, count = at + sizes.get(r, (0, 0, 0))[0], count + sizes.get(r, (0, 0, 0))[1]
    r = F.col("range")
    w = Window.partitionBy("range").orderBy("key")
    ranged = (rows.withColumn("range", _range_of(F.col("key"), splitters))
              .withColumn("before", F.element_at(_array(bytes_before, "bigint"), r + 1) + F.sum("size").over(
                  w.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size"))
              .withColumn("place", F.element_at(_array(rows_before, "bigint"), r + 1) + F.row_number().over(w) - 1))
    by_group = Window.partitionBy("range", "group")
    group_bytes, group_before = F.sum("size").over(by_group), F.min("before").over(by_group)
    start = F.when(group_bytes <= F.lit(whole_group * total / shards), group_before).otherwise(F.col("before"))
    placed = C.cut_lineage(
        ranged.withColumn("start", start).withColumn(
            "shard", F.expr(f"cast((cast(start as decimal(38,0)) * {shards}) div {max(total, 1)} as int)"))
        .select("doc_id", "size", "text_crc32", "shard", "place"), "shard-places")
    first = {x["shard"]: x["p"] for x in placed.groupBy("shard").agg(F.min("place").alias("p")).collect()}
    starts = _array([first.get(s, 0) for s in range(shards)], "bigint")
    return placed.select("doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard",
                         (F.col("place") - F.element_at(starts, F.col("shard") + 1)).alias("slot"),
                         F.lit(None).cast("int").alias("grown_shard"))
