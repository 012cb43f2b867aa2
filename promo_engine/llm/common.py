"""Helpers shared by the operators: input columns, sizes, lineage cuts and
the arrow plumbing of block-wise Python stages."""

from __future__ import annotations

import math
import os
import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from promo_engine.session import cut_lineage  # noqa: F401  (re-exported for the operators)
from promo_engine.sources.tables import read_table

#: ASCII white space that separates words in every contract: space, \t \n \v \f \r.
WORD_CLASS = "[^\\x20\\x09-\\x0D]+"
SPACE_CLASS = "[\\x20\\x09-\\x0D]"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text of ``docs`` (pruned at the scan), so that no
    other column of the input can clash with the operators' own names."""
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"))


def text_bytes(rows: DataFrame) -> int:
    """UTF-8 bytes of all texts (one aggregate over the scan)."""
    return rows.agg(F.coalesce(F.sum(F.octet_length("text").cast("bigint")), F.lit(0))).first()[0]


def parts_for(total: int, each: int, least: int = 1) -> int:
    """How many parts of about ``each`` units ``total`` makes."""
    return max(least, math.ceil(total / each))


def doc_fold(id_col: str | Column = "doc_id", folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(c.cast("string").cast("binary")) % F.lit(folds)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` doesn't have, one for each of ``names``."""
    have = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in have:
            n = "_" + n
        have.add(n.lower())
        out.append(n)
    return out


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective avalanche of 64-bit values (splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


_BASE = 0x9E3779B97F4A7C15 | 1
_SLICE = 1 << 17        # bytes hashed at once: the tables of powers, kept per worker, stay at a few MB
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n (kept and doubled on demand)."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = 1 << max(10, (n - 1).bit_length())
        inv = pow(base, -1, 1 << 64)

        def table(b):
            t = np.full(size, np.uint64(b), dtype=np.uint64)
            t[0] = 1
            with np.errstate(over="ignore"):
                return np.cumprod(t, dtype=np.uint64)
        have = _POWERS[base] = (table(base), table(inv))
    return have


def _letters(seed: int) -> np.ndarray:
    return mix64(np.arange(256, dtype=np.uint64) + np.uint64(1 + 1000 * seed))


_LETTERS = [_letters(s) for s in range(4)]


LONG_WORD = 256


def word_hashes(words: list[bytes], seed: int = 0) -> np.ndarray:
    """A 64-bit hash of every word: a polynomial over its bytes by prefix
    sums, then mixed.  Works on slices, so a very long list stays cheap.

    Words of over ``LONG_WORD`` bytes take xxh3 instead: polynomials modulo
    2**64 have words that are equal under every base, of a thousand letters
    or more."""
    n = len(words)
    out = np.empty(n, dtype=np.uint64)
    if n == 0:
        return out
    lens = np.fromiter(map(len, words), dtype=np.int64, count=n)
    ends_all = np.cumsum(lens)
    at = 0
    base = _BASE + 2 * (2 * seed + 1) * 7919
    while at < n:
        before = ends_all[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends_all, before + _SLICE, side="right")))
        buf = np.frombuffer(b"".join(words[at:to]), dtype=np.uint8)
        pw, inv = powers(base, len(buf) + 1)
        with np.errstate(over="ignore"):
            sums = np.zeros(len(buf) + 1, dtype=np.uint64)
            np.cumsum(_LETTERS[seed][buf] * pw[:len(buf)], out=sums[1:])
            ends = ends_all[at:to] - before
            starts = ends - lens[at:to]
            out[at:to] = (sums[ends] - sums[starts]) * inv[starts] + lens[at:to].astype(np.uint64)
        at = to
    out = mix64(out)
    for i in np.flatnonzero(lens > LONG_WORD):
        out[i] = xxhash.xxh3_64_intdigest(words[i], seed)
    return out


def gram_hashes(words: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """Rabin-Karp hash of every run of ``size`` consecutive word hashes
    (empty when there are fewer words)."""
    n = len(words)
    if n < size:
        return np.empty(0, dtype=np.uint64)
    pw, inv = powers(_BASE + 2 * (104729 + 2 * seed), n + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(words * pw[:n], out=sums[1:])
        return mix64((sums[size:] - sums[:n - size + 1]) * inv[:n - size + 1])


def binary(values: list[bytes]) -> pa.Array:
    return pa.array(values, type=pa.binary())


def texts_of(table: pa.Table | pa.RecordBatch, name: str = "text") -> list[bytes]:
    """UTF-8 bytes of each text; null counts as empty."""
    col = table.column(name)
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return [b"" if v is None else v for v in col.cast(pa.large_binary() if pa.types.is_large_string(col.type)
                                                      else pa.binary()).to_pylist()]


def byte_strings(values: pa.Array) -> list[bytes]:
    """The values of a binary array without nulls (a third of the time of ``to_pylist``, for many short ones)."""
    values = values.cast(pa.large_binary())
    if len(values) == 0:
        return []
    at = np.frombuffer(values.buffers()[1], dtype="<i8")[values.offset:values.offset + len(values) + 1]
    lo, hi = int(at[0]), int(at[-1])
    data = values.buffers()[2].slice(lo, hi - lo).to_pybytes() if hi > lo else b""
    at = (at - lo).tolist()
    return [data[a:z] for a, z in zip(at, at[1:], strict=False)]


def each_row(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows as dicts, one at a time: for batches of few, large rows."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


@contextmanager
def settings(spark: SparkSession, given: dict[str, str]) -> Iterator[None]:
    """Jobs started inside run with these session settings; they are put back."""
    before = {k: spark.conf.get(k, None) for k in given}
    for k, v in given.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def arrow_rows(spark: SparkSession, rows: int):
    """Jobs started inside send Python at most ``rows`` rows a batch (large
    rows would else fill batches of tens of MB)."""
    return settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows)})


def key_filters(spark: SparkSession):
    """Joins inside that would shuffle both sides first filter the large one
    by a Bloom filter of the other's keys, where that one has a comparison in
    its ``where`` (Spark's runtime filter).  The filter has 2 MB whatever the
    number of keys; beyond some two million it lets more rows through, and
    the join that follows is exact at any size."""
    name = "spark.sql.optimizer.runtime.bloomFilter."
    return settings(spark, {name + "enabled": "true", name + "creationSideThreshold": "100g",
                            name + "applicationSideScanSizeThreshold": "1m", name + "expectedNumItems": str(1 << 21),
                            name + "maxNumItems": str(1 << 21), name + "numBits": str(1 << 24),
                            name + "maxNumBits": str(1 << 24)})


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> SparkSession:
    """Send this package to the executors (once per application), so that
    Python stages import it wherever they run."""
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        target = os.path.join(tempfile.mkdtemp(prefix="ship-"), "promo_engine_package.zip")
        with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
            for folder, _, names in os.walk(root):
                for name in sorted(names):
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        z.write(path, os.path.relpath(path, os.path.dirname(root)))
        sc.addPyFile(target)                       # served by the driver, no shared folder needed
        _SHIPPED.add(sc.applicationId)
    return spark


def group_starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Row numbers where a new combination of the (sorted, non-null) integer ``keys`` begins."""
    n = table.num_rows
    new = np.zeros(n, dtype=bool)
    if n:
        new[0] = True
    for k in keys:
        v = np.asarray(table.column(k).combine_chunks())
        new[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(new)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int) -> Iterator[pa.Table]:
    """Tables of about ``rows`` rows that hold groups of equal ``keys`` in full,
    from batches of a partition that is sorted by them."""
    held: list[pa.RecordBatch] = []
    n = 0
    for b in batches:
        if b.num_rows == 0:
            continue
        held.append(b)
        n += b.num_rows
        if n >= rows:
            table = pa.Table.from_batches(held).combine_chunks()
            last = int(group_starts(table, keys)[-1])
            if last:
                yield table.slice(0, last)
            held = table.slice(last).to_batches()
            n = table.num_rows - last
    if held:
        yield pa.Table.from_batches(held).combine_chunks()
