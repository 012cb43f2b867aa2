"""N-gram Jaccard join by chosen paths: near duplicates on five-word shingles.

1. Every text becomes its set of shingle hashes.  Texts of equal sets are one
   entry with a multiplicity, so exact copies never meet.
2. *Chosen paths.*  In each run an entry samples shared tokens: a shingle is
   chosen with probability 1 / (threshold * size) by a hash that all entries
   share, and the chosen ones name the buckets it goes to.  A bucket over
   ``BUCKET`` entries splits again by shingles sampled anew on its path, up to
   ``DEPTH`` times.  Buckets that are still large are compared block against
   block, so none is capped.  ``runs_for`` gives the runs for a target recall.
3. *Brute force in buckets.*  Entries are compared by 256-bit minwise sketches
   at a margin below the threshold; each bucket returns a spanning forest of
   its candidates, never all pairs.
4. *Exact check.*  Candidates' components gather their texts once, and block
   pairs of bounded size count exact intersections.  Every pair of entries
   meets once, so links are counted exactly and edges shrink to a forest per
   block pair; components of those are the classes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promo_engine.llm import common as C
from promo_engine.llm.components import components

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.99
DEPTH = 3
BUCKET = 2048
SKETCH_BITS = 256
MARGIN = 0.18          # of the sketches' estimate: over 4.5 standard deviations
BLOCK_ENTRIES = 1024
BLOCK_SHINGLES = 1_000_000
TEMPORARY = 1 << 19      # numbers in a temporary array
TEXTS_AT_ONCE = 128
_NO_ID = 2 ** 63 - 1
_ODD = C.mix64(np.arange(1, SKETCH_BITS + 1, dtype=np.uint64)) | np.uint64(1)


def runs_for(recall: float, depth: int = DEPTH) -> int:
    """Runs that find a pair at the threshold with probability ``recall``: one run
    keeps it together through ``depth`` splits with probability 1 / (depth + 1) at least."""
    return math.ceil(math.log(1 - recall) / math.log(1 - 1 / (depth + 1)))


def shingles(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes; a text of 1 to ``size`` - 1 words is one shingle, without words none."""
    words = C.word_hashes(text.split())
    if len(words) == 0:
        return words
    if len(words) < size:
        return C.gram_hashes(words, len(words), seed=10 + len(words))
    return np.unique(C.gram_hashes(words, size, seed=10))


def sketch(x: np.ndarray) -> np.ndarray:
    """256 bits, one of the least value of the set under each of 256 multiplicative hashes."""
    low = np.empty(SKETCH_BITS, dtype=np.uint64)
    step = max(1, TEMPORARY // max(1, len(x)))
    with np.errstate(over="ignore"):
        for f in range(0, SKETCH_BITS, step):
            low[f:f + step] = (x[None, :] * _ODD[f:f + step, None]).min(axis=1)
    return np.packbits(((C.mix64(low) >> np.uint64(13)) & np.uint64(1)).astype(np.uint8)).view("<u8")


def _chosen(x: np.ndarray, paths: np.ndarray, rate: float) -> list[np.ndarray]:
    """For each path, the next paths of set ``x``: shingles whose hash on that path is under the rate."""
    bound = np.uint64(min(2 ** 64 - 1, int(rate * 2 ** 64)))
    out = []
    step = max(1, TEMPORARY // max(1, len(x)))
    with np.errstate(over="ignore"):
        for lo in range(0, len(paths), step):
            p = paths[lo:lo + step]
            h = x[None, :] * (p | np.uint64(1))[:, None]
            row, col = np.nonzero(h <= bound)
            found = C.mix64(x[col] ^ (p[row] * np.uint64(0xD6E8FEB86659FD93)))
            out += np.split(found, np.searchsorted(row, np.arange(1, len(p))))
    return out


def paths(x: np.ndarray, runs: int, threshold: float, depth: int = DEPTH) -> list:
    """The set's path tree, nested ``depth`` deep: [path, [path, [...]], ...] by level.

    Run and first choice come from one hash: its leading part is the shingle's run, the rest decides."""
    rate = 1 / (threshold * len(x))
    with np.errstate(over="ignore"):
        u = C.mix64(x ^ np.uint64(0xA0761D6478BD642F))
        rest = u * np.uint64(runs)                     # the fraction below the run number
    first = C.mix64(x[rest <= np.uint64(min(2 ** 64 - 1, int(min(1.0, runs * rate) * (2 ** 64 - 1))))])
    two = _chosen(x, first, rate)
    three = _chosen(x, np.concatenate(two), rate) if len(first) and depth > 2 else []
    return [first, two, three]


_ROW = ("doc_id bigint, hash bigint, digest binary, size int, sketch binary, "
        "paths array<struct<p: bigint, next: array<struct<p: bigint, next: array<bigint>>>>>")


def _nested(trees: list[list]) -> pa.Array:
    """Arrow form of the path trees."""
    as_i8 = lambda parts: pa.array((np.concatenate(parts) if parts else np.empty(0, np.uint64)).view(np.int64))
    offsets = lambda sizes: pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
    first = [t[0] for t in trees]
    two = [x for t in trees for x in t[1]]
    three = [x for t in trees for x in t[2]]
    leaf = pa.ListArray.from_arrays(offsets([len(x) for x in three]), as_i8(three))
    mid = pa.StructArray.from_arrays([as_i8(two), leaf], names=["p", "next"])
    mid = pa.ListArray.from_arrays(offsets([len(x) for x in two]), mid)
    top = pa.StructArray.from_arrays([as_i8(first), mid], names=["p", "next"])
    return pa.ListArray.from_arrays(offsets([len(x) for x in first]), top)


def _entries(runs: int, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = [np.empty(0, np.uint64), [], []]
        for whole in batches:
            for lo in range(0, whole.num_rows, TEXTS_AT_ONCE):
                b = whole.slice(lo, TEXTS_AT_ONCE)
                sets = [shingles(t) for t in C.texts_of(b)]
                yield pa.record_batch([
                    b.column("doc_id"), b.column("hash"),
                    C.binary([xxhash.xxh3_128_digest(x.tobytes()) if len(x) else None for x in sets]),
                    pa.array([len(x) for x in sets], type=pa.int32()),
                    C.binary([sketch(x).tobytes() if len(x) else None for x in sets]),
                    _nested([paths(x, runs, threshold) if len(x) else none for x in sets])],
                    names=["doc_id", "hash", "digest", "size", "sketch", "paths"])
    return run


# ------------------------------------------------------- candidates by bucket

def _forest(adj: np.ndarray) -> np.ndarray:
    """For each row of a symmetric adjacency matrix the least row of its component."""
    n = len(adj)
    label = np.arange(n)
    while True:
        new = np.where(adj, label[None, :], n).min(axis=1)
        new = np.minimum(label, new)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _alike(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs of sketches may reach the threshold: by their sizes, and by the estimate with its margin."""
    differ = sum(np.bitwise_count(a[..., k] ^ b[..., k]).astype(np.int16) for k in range(a.shape[-1]))
    near = 1 - 2 * differ / SKETCH_BITS >= threshold - MARGIN
    return near & (np.minimum(na, nb) >= threshold * np.maximum(na, nb) - 1e-9)


def _bucket_edges(threshold: float):
    """Edges of a spanning forest of the candidates of every (bucket, i, j) group."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in C.whole_groups(batches, ["bucket", "i", "j"], 20_000):
            starts = C.group_starts(t, ["bucket", "i", "j"])
            sizes = np.diff(np.append(starts, t.num_rows))
            rep = np.asarray(t.column("rep").combine_chunks())
            size = np.asarray(t.column("size").combine_chunks())
            side = np.asarray(t.column("side").combine_chunks())
            across = np.asarray(t.column("i").combine_chunks()) != np.asarray(t.column("j").combine_chunks())
            sk = np.frombuffer(b"".join(t.column("sketch").to_pylist()), dtype="<u8").reshape(t.num_rows, -1)
            a, b = [], []
            group = np.repeat(np.arange(len(starts)), sizes)
            few = sizes <= 48
            left = np.flatnonzero(few[group])
            for k in range(1, int(sizes[few].max(initial=0))):     # pairs at distance k in their group
                left = left[(left + k < t.num_rows)]
                left = left[group[np.minimum(left + k, t.num_rows - 1)] == group[left]]
                x, y = left, left + k
                ok = (~across[x] | (side[x] != side[y])) & _alike(sk[x], sk[y], size[x], size[y], threshold)
                a.append(rep[x[ok]])
                b.append(rep[y[ok]])
            for g in np.flatnonzero(~few):
                at = np.arange(starts[g], starts[g] + sizes[g])
                adj = np.zeros((len(at), len(at)), dtype=bool)
                for lo in range(0, len(at), 256):
                    r = at[lo:lo + 256]
                    adj[lo:lo + 256] = _alike(sk[r][:, None], sk[at][None, :], size[r][:, None], size[at][None, :],
                                              threshold)
                    if across[starts[g]]:
                        adj[lo:lo + 256] &= side[r][:, None] != side[at][None, :]
                root = _forest(adj)
                out = root != np.arange(len(at))
                a.append(rep[at[out]])
                b.append(rep[at[root[out]]])
            yield pa.record_batch([pa.array(np.concatenate(a) if a else [], type=pa.int64()),
                                   pa.array(np.concatenate(b) if b else [], type=pa.int64())], names=["a", "b"])
    return run


def _counted(rows: DataFrame) -> DataFrame:
    """Rows of buckets with two entries or more, with the number ``n``."""
    n = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return rows.join(C.cut_lineage(n, "buckets").where("n > 1"), "bucket")


def _block_pairs(rows: DataFrame, key: str, blocks) -> DataFrame:
    """Each row once for every pair (i, j), i <= j, of its group's blocks that its own block is part of."""
    nb, own = F.col("__nb"), F.col("side")
    others = F.sequence(F.lit(0), nb - 1)
    return (rows.withColumn("__nb", blocks.cast("int")).withColumn("side", F.pmod(F.xxhash64("rep"), nb).cast("int"))
            .withColumn("__other", F.explode(others))
            .withColumn("i", F.least(own, F.col("__other"))).withColumn("j", F.greatest(own, F.col("__other")))
            .drop("__nb", "__other")
            .repartition(key, "i", "j").sortWithinPartitions(key, "i", "j"))


def candidate_edges(entries: DataFrame, trees: DataFrame, threshold: float, bucket: int) -> DataFrame:
    """``a, b``: edges that join all entries (rep, size, sketch, row, first) that share a bucket and look alike.

    Buckets are counted on pairs of path and entry alone; sketches join the
    buckets that hold two entries or more, and only entries of buckets that
    split look up their deeper paths in ``trees`` (row, paths)."""
    one = C.cut_lineage(_counted(entries.select("rep", F.explode("first").alias("bucket"))), "level-1")
    wanted = C.cut_lineage(
        one.where(F.col("n") > bucket).groupBy("rep").agg(F.collect_list("bucket").alias("split"))
        .join(entries.select("rep", "row"), "rep"), "split-buckets")
    two = C.cut_lineage(_counted(
        trees.join(wanted.where(F.size("split") > 0), "row")
        .select("rep", F.explode(F.filter("paths", lambda x: F.array_contains("split", x["p"]))).alias("x"))
        .select("rep", F.explode("x.next").alias("x"))
        .select("rep", F.col("x.p").alias("bucket"), F.col("x.next").alias("next"))), "level-2")
    three = _counted(two.where(F.col("n") > bucket).select("rep", F.explode("next").alias("bucket")))
    cols = ["rep", "bucket", "n"]
    leaves = (one.where(F.col("n") <= bucket).select(cols)
              .unionByName(two.where(F.col("n") <= bucket).select(cols)).unionByName(three.select(cols)))
    rows = leaves.join(entries.select("rep", "size", "sketch"), "rep")
    blocked = _block_pairs(rows, "bucket", F.ceil(F.col("n") / bucket))
    return blocked.select("bucket", "i", "j", "side", "rep", "size", "sketch").mapInArrow(
        _bucket_edges(threshold), "a bigint, b bigint")


# ------------------------------------------------------------- exact checking

def _intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every left with every right set."""
    both = np.concatenate([*left, *right])
    owner = np.repeat(np.arange(len(left) + len(right)), [len(x) for x in (*left, *right)])
    found, code, count = np.unique(both, return_inverse=True, return_counts=True)
    shared = count[code] > 1
    code, owner = (np.cumsum(count > 1) - 1)[code[shared]], owner[shared]
    order = np.argsort(code, kind="stable")
    code, owner = code[order], owner[order]
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    width = max(1, (1 << 24) // (4 * (len(left) + len(right))))
    for lo in range(0, int((count > 1).sum()), width):
        a, z = np.searchsorted(code, [lo, lo + width])
        m = np.zeros((len(left) + len(right), width), dtype=np.float32)
        m[owner[a:z], code[a:z] - lo] = 1
        out += m[:len(left)] @ m[len(left):].T
    return out


def _exact(threshold: float):
    """Links and forest edges of every (comp, i, j) group: rows (kind, rep, other, links)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = ["comp", "i", "j"]
        for t in C.whole_groups(batches, keys, 256):
            starts = C.group_starts(t, keys)
            reps = np.asarray(t.column("rep").combine_chunks())
            mult = np.asarray(t.column("copies").combine_chunks())
            side = np.asarray(t.column("side").combine_chunks())
            i, j = (np.asarray(t.column(c).combine_chunks()) for c in ("i", "j"))
            texts = t.column("text").combine_chunks()
            node, other, links = [], [], []
            for lo, hi in zip(starts, np.append(starts[1:], t.num_rows)):
                at = np.arange(lo, hi)
                _, one = np.unique(reps[at], return_index=True)     # a key that repeats in the input came twice
                at = at[one]
                sets = [shingles(x) for x in C.texts_of(pa.record_batch([texts.take(pa.array(at))], names=["text"]))]
                size = np.array([len(x) for x in sets], dtype=np.float64)
                if i[lo] == j[lo]:
                    a = b = np.arange(len(at))
                else:
                    a, b = (np.flatnonzero(side[at] == s) for s in (i[lo], j[lo]))
                if len(a) == 0 or len(b) == 0:
                    continue
                inter = _intersections([sets[k] for k in a], [sets[k] for k in b]).astype(np.float64)
                near = inter >= threshold * (size[a][:, None] + size[b][None, :] - inter) - 1e-9
                adj = np.zeros((len(at), len(at)), dtype=bool)
                adj[np.ix_(a, b)] = near
                adj |= adj.T
                np.fill_diagonal(adj, False)
                root = _forest(adj)
                node.append(reps[at])
                other.append(reps[at[root]])
                links.append(adj @ mult[at])
            cat = lambda v: pa.array(np.concatenate(v) if v else [], type=pa.int64())
            yield pa.record_batch([cat(node), cat(other), cat(links)], names=["rep", "root", "links"])
    return run


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
                recall: float = RECALL, bucket: int = BUCKET, block_entries: int = BLOCK_ENTRIES,
                block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """One row per input row: ``doc_id, hash, class_id, n_links, class_size, kept``.

    Two documents are linked when the Jaccard similarity of their sets of
    five-word shingles is ``threshold`` or more; words are maximal runs of
    characters other than space and \\\\x09-\\\\x0D, unchanged.  A class is a
    connected component of links, ``class_id`` its least id, ``n_links`` the
    number of documents linked to this one, copies included, and ``kept``
    true for one row of each class, that of the least id.  ``hash`` is
    xxhash64 of the text.

    A text of fewer than five words is one shingle of all its words; texts
    without words (null, empty) have no shingles, no links and classes of
    their own.  Rows without an id come last in the order of ids; a class
    that has no id at all has a null ``class_id``.  Repeated rows are copies
    of each other.  Other columns are not read; an empty table gives no rows.
    """
    runs = runs_for(recall)
    rows = C.id_text(docs, id_col, text_col).withColumn("hash", F.xxhash64("text"))
    known = C.cut_lineage(rows.mapInArrow(_entries(runs, threshold), _ROW)
                          .withColumn("row", F.monotonically_increasing_id()), "shingled")
    order = F.struct(F.coalesce("doc_id", F.lit(_NO_ID)).alias("id"), "hash", "row")
    first = F.transform("paths", lambda x: x["p"])
    entries = C.cut_lineage(
        known.where("digest is not null").groupBy("digest")
        .agg(F.count(F.lit(1)).alias("copies"), F.min(order).alias("least"),
             F.max(F.struct("row", "size", "sketch", first.alias("first"))).alias("s"))
        .select(F.monotonically_increasing_id().alias("rep"), "digest", "copies", "least", "s.row", "s.size", "s.sketch",
                "s.first"),
        "entries")
    with C.key_filters(docs.sparkSession):
        coarse = C.cut_lineage(components(candidate_edges(entries, known.select("row", "paths"), threshold, bucket)),
                               "candidates")
    sizes = C.cut_lineage(
        coarse.join(entries.select(F.col("rep").alias("node"), "size"), "node").groupBy(F.col("root").alias("comp"))
        .agg(F.greatest(F.ceil(F.count(F.lit(1)) / block_entries), F.ceil(F.sum("size") / block_shingles)).alias("nb")),
        "candidate-blocks")
    members = (coarse.select(F.col("node").alias("rep"), F.col("root").alias("comp")).join(sizes, "comp")
               .join(entries.select("rep", "copies", F.col("least.id").alias("id"), F.col("least.hash").alias("hash")),
                     "rep"))
    members = C.cut_lineage(members, "members")
    texts = (rows.select(F.coalesce("doc_id", F.lit(_NO_ID)).alias("id"), "hash", "text")
             .join(members.where("copies > 0"), ["id", "hash"]))
    with C.key_filters(docs.sparkSession):      # so texts that are no candidates aren't shuffled
        checked = C.cut_lineage(
            _block_pairs(texts.select("comp", "nb", "rep", "copies", "text"), "comp", F.col("nb"))
            .select("comp", "i", "j", "side", "rep", "copies", "text")
            .mapInArrow(_exact(threshold), "rep bigint, root bigint, links bigint"), "checked")
    links = checked.groupBy("rep").agg(F.sum("links").alias("links"))
    edges = checked.where("rep <> root").select(F.col("rep").alias("a"), F.col("root").alias("b"))
    classes = components(edges).select(F.col("node").alias("rep"), "root")
    info = C.cut_lineage(
        entries.select("rep", "digest", "copies", "least").join(links, "rep", "left").join(classes, "rep", "left")
        .withColumn("root", F.coalesce("root", "rep"))
        .select("digest", "root", "least", "copies", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")),
        "classes")
    by_class = C.cut_lineage(info.groupBy("root").agg(F.min("least").alias("first"), F.sum("copies").alias("class_size")),
                             "class-sizes")
    per_set = C.cut_lineage(info.join(by_class, "root").select("digest", "first", "n_links", "class_size"), "per-set")
    alone = F.col("first").isNull()
    return (known.select("doc_id", "hash", "digest", "row").join(per_set, "digest", "left")
            .select("doc_id", "hash",
                    F.when(alone, F.col("doc_id")).otherwise(F.nullif("first.id", F.lit(_NO_ID))).alias("class_id"),
                    F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                    F.coalesce("class_size", F.lit(1)).cast("bigint").alias("class_size"),
                    (alone | (F.col("row") == F.col("first.row"))).alias("kept")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs``, unchanged, that stay: one of each class of near
    duplicates, and every text without words.  Of rows that repeat an id and
    its text one is kept."""
    key, hashed = C.fresh(docs, "__id", "__hash")
    kept = (near_groups(docs, id_col, text_col, **how).where("kept")
            .select(F.coalesce("doc_id", F.lit(_NO_ID)).alias(key), F.col("hash").alias(hashed)).distinct())
    kept = C.cut_lineage(kept, "kept")
    words = F.length(F.regexp_replace(F.coalesce(F.col(text_col).cast("string"), F.lit("")), f"{C.SPACE_CLASS}+", "")) > 0
    (flag,) = C.fresh(docs, "__words")
    rows = (docs.withColumn(key, F.coalesce(F.col(id_col).cast("bigint"), F.lit(_NO_ID)))
            .withColumn(hashed, F.xxhash64(F.col(text_col).cast("string"))).withColumn(flag, words)
            .join(kept, [key, hashed], "left_semi"))
    return rows.where(flag).dropDuplicates([key, hashed]).unionByName(rows.where(~F.col(flag))).select(docs.columns)
