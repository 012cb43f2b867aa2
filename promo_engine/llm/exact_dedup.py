"""Exact dedup by content-defined chunk recipes.

Texts are compared after deleting white space.  A rolling hash over the
bytes cuts each normalised text into chunks at places that depend on the
bytes around them alone, and a text becomes its recipe: the ordered hashes
and sizes of its chunks.

1. Every chunk's content is deduplicated: (hash, bytes) pairs are combined
   before the shuffle, so bytes decide, not the hash, and a group of copies
   of any size moves its chunks once per task.  A hash that stands for one
   content is that content's verified identifier; where contents collide,
   each gets an identifier of its own.
2. Rows carry their ordered identifier lists, a few numbers per document;
   equal lists are equal texts.  The texts themselves are never moved.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from promo_engine.llm import common as C

SPACES = b" \t\n\x0b\x0c\r"
WINDOW_BYTES = 48
AVERAGE_BYTES = 4096
LEAST_BYTES = 1024
MOST_BYTES = 65536


def normalise(raw: bytes) -> bytes:
    return raw.translate(None, SPACES)


def cut_points(data: bytes, average: int = AVERAGE_BYTES, least: int = LEAST_BYTES,
               most: int = MOST_BYTES) -> list[int]:
    """Ends of the chunks of ``data``: where the hash of the last
    ``WINDOW_BYTES`` bytes is 0 modulo ``average``, at least ``least`` and at
    most ``most`` bytes after the last cut.  Empty data has no chunk."""
    n = len(data)
    if n == 0:
        return []
    if n <= least:
        return [n]
    marks: list[np.ndarray] = []
    for lo in range(0, n, 1 << 20):                    # slices overlap by a window
        from_ = max(0, lo - WINDOW_BYTES)
        buf = np.frombuffer(data[from_:lo + (1 << 20)], dtype=np.uint8)
        if len(buf) < WINDOW_BYTES:
            continue
        h = C.gram_hashes(C._LETTERS[0][buf], WINDOW_BYTES)
        hit = np.flatnonzero(h % np.uint64(average) == 0) + from_ + WINDOW_BYTES
        marks.append(hit[hit > lo])
    cuts, last = [], 0
    for m in (np.concatenate(marks) if marks else np.empty(0, int)).tolist():
        while m - last > most:
            last += most
            cuts.append(last)
        if m - last >= least and m < n:
            cuts.append(m)
            last = m
    while n - last > most:
        last += most
        cuts.append(last)
    if last < n:
        cuts.append(n)
    return cuts


def _hash(chunk: bytes, bits: int) -> int:
    return (xxhash.xxh3_64_intdigest(chunk) >> (64 - bits)) - (1 << 63)


def _chunks_of(raw: bytes, bits: int) -> tuple[bytes, list[tuple[int, bytes]]]:
    data = normalise(raw)
    cuts = cut_points(data)
    return data, [(_hash(data[a:z], bits), data[a:z]) for a, z in zip([0, *cuts], cuts)]


def recipes(rows: DataFrame, bits: int = 64) -> DataFrame:
    """``doc_id, n_points, text_sha256, recipe`` of each ``doc_id, text`` row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            points, shas, lists = [], [], []
            for raw in C.texts_of(b):
                data, chunks = _chunks_of(raw, bits)
                points.append(len(raw.decode("utf-8")))
                shas.append(hashlib.sha256(data).hexdigest())
                lists.append([h for h, _ in chunks])
            yield pa.record_batch([b.column("doc_id"), pa.array(points, type=pa.int64()),
                                   pa.array(shas, type=pa.string()), pa.array(lists, type=pa.list_(pa.int64()))],
                                  names=["doc_id", "n_points", "text_sha256", "recipe"])
    return rows.mapInArrow(run, "doc_id bigint, n_points bigint, text_sha256 string, recipe array<bigint>")


def chunk_contents(rows: DataFrame, bits: int = 64) -> DataFrame:
    """Distinct ``hash, bytes`` of all chunks of ``rows.text``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen = {c: None for raw in C.texts_of(b) for c in _chunks_of(raw, bits)[1]}
            yield pa.record_batch([pa.array([h for h, _ in seen], type=pa.int64()),
                                   C.binary([c for _, c in seen])], names=["hash", "bytes"])
    return rows.select("text").mapInArrow(run, "hash bigint, bytes binary").distinct()


def _told_apart(rows: DataFrame, known: DataFrame, collided: DataFrame, bits: int) -> DataFrame:
    """``known`` with identifier lists in which colliding contents differ."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = {(hashlib.sha256(data).hexdigest(), k, h, c) for data, chunks in
                     (_chunks_of(raw, bits) for raw in C.texts_of(b)) for k, (h, c) in enumerate(chunks)}
            cols = list(zip(*found, strict=True)) if found else [[], [], [], []]
            yield pa.record_batch([pa.array(list(c), type=t) for c, t in zip(
                cols, (pa.string(), pa.int32(), pa.int64(), pa.binary()), strict=True)],
                names=["text_sha256", "seq", "hash", "bytes"])
    contents = (chunk_contents(rows, bits).join(collided, "hash", "left_semi")
                .withColumn("ident", F.row_number().over(Window.partitionBy("hash").orderBy("bytes")).cast("bigint")))
    lists = (rows.select("text").mapInArrow(run, "text_sha256 string, seq int, hash bigint, bytes binary").distinct()
             .join(contents, ["hash", "bytes"], "left")
             .groupBy("text_sha256").agg(F.array_sort(F.collect_list(F.struct(
                 "seq", "hash", F.coalesce("ident", F.lit(0)).alias("ident")))).alias("found"))
             .select("text_sha256", F.flatten(F.transform("found", lambda x: F.array(x["hash"], x["ident"])))
                     .alias("told")))
    return (known.join(lists, "text_sha256", "left")
            .withColumn("recipe", F.coalesce("told", "recipe")).drop("told"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_bits: int = 64) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical without white space (space, \\x09-\\x0D);
    null counts as empty, and empty texts equal each other.  Of equal texts
    the row with the most code points of original text stays, then the one
    with the smallest id (a null id comes last).  Of rows that tie in both,
    repeated rows for example, exactly one stays.  ``hash_bits`` below 64 is
    for tests of colliding chunks.  Other columns are not read; an empty
    table gives no rows.
    """
    rows = C.id_text(docs, id_col, text_col)
    known = C.cut_lineage(recipes(rows, hash_bits).withColumn("row", F.monotonically_increasing_id()), "recipes")
    collided = C.cut_lineage(chunk_contents(rows, hash_bits).groupBy("hash").agg(F.count(F.lit(1)).alias("n"))
                             .where("n > 1").select("hash"), "collided")
    if not collided.isEmpty():
        known = C.cut_lineage(_told_apart(rows, known, collided, hash_bits), "identifiers")
    best = F.struct(-F.col("n_points"), F.col("doc_id").isNull(), "doc_id", "row")
    groups = C.cut_lineage(known.groupBy("recipe").agg(F.min(best).alias("best"), F.count(F.lit(1)).alias("group_size")),
                           "groups")
    return (known.join(groups, "recipe")
            .select("doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
                    (F.col("row") == F.col("best.row")).alias("kept"), "text_sha256"))
