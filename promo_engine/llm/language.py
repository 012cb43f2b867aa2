"""Language identification by compression.

Every language has a zstandard raw-content dictionary made of pieces of its
training texts.  A text is cut into pieces of bounded size, each piece is
compressed with every dictionary, and the language whose sizes add up to the
least wins: its dictionary holds the most of what the text is made of.  A
narrow margin to the second language rejects the answer.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promo_engine.llm import common as C

FOLDS, HELD_FOLD = 4, 2
SAMPLES = 128          # training pieces of a language, at most
SAMPLE_CHARS = 1024    # characters of a training piece
PIECE = 2048           # bytes compressed at once
LEVEL = 5
MARGIN = 0.01          # share of the second best size
SHARP = 100.0          # how fast the score falls with the relative size
UNKNOWN = "und"
_SHARES = 1 << 30


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def normal(text: str) -> bytes:
    """What is compressed: lower case, one space for each run of white space."""
    return " ".join(text.lower().split()).encode("utf-8", "replace")


def training_pieces(docs: DataFrame, id_col: str, text_col: str, lang_col: str, samples: int = SAMPLES,
                    chars: int = SAMPLE_CHARS) -> dict[str, list[str]]:
    """At most ``samples`` pieces of ``chars`` characters for each language, from different texts drawn by a
    hash over all training rows, each from a hashed place of its text."""
    h = F.xxhash64("text")
    known = (docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"),
                         F.col(lang_col).cast("string").alias("lang"))
             .where(F.col("lang").isNotNull() & (C.doc_fold("id", FOLDS) != HELD_FOLD) & F.col("text").rlike(r"\p{L}"))
             .withColumn("h", h))
    sizes = known.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()      # one row per language
    if not sizes:
        return {}
    share = docs.sparkSession.createDataFrame(
        [(r["lang"], min(_SHARES, math.ceil(2 * samples / max(1, r["n"]) * _SHARES))) for r in sizes],
        "lang string, share bigint")
    drawn = (known.join(F.broadcast(share), "lang").where(F.pmod(F.xxhash64("h"), F.lit(_SHARES)) < F.col("share")))
    start = F.lit(1) + F.pmod(F.xxhash64("h", F.lit(7)), F.greatest(F.lit(1), F.length("text") - chars + 1)).cast("int")
    piece: Column = F.substring(F.col("text"), start, F.lit(chars))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("h"), "h")
    rows = (drawn.select("lang", "h", piece.alias("piece")).groupBy("lang", "h").agg(F.min("piece").alias("piece"))
            .withColumn("at", F.row_number().over(order)).where(F.col("at") <= samples).collect())
    out: dict[str, list[tuple[int, str]]] = {}
    for r in rows:
        out.setdefault(r["lang"], []).append((r["at"], r["piece"]))
    return {k: [p for _, p in sorted(v)] for k, v in sorted(out.items())}


class Classifier:
    """Compressors with a dictionary per language."""

    def __init__(self, dictionaries: dict[str, bytes], level: int = LEVEL):
        self.langs = sorted(dictionaries)
        self.coders = []
        for name in self.langs:
            d = zstandard.ZstdCompressionDict(dictionaries[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            self.coders.append(zstandard.ZstdCompressor(dict_data=d, write_checksum=False, write_content_size=False,
                                                        write_dict_id=False))

    def sizes(self, text: str, piece: int = PIECE) -> np.ndarray:
        """Compressed bytes of the whole text under each dictionary."""
        raw = normal(text)
        out = np.zeros(len(self.coders), dtype=np.int64)
        for lo in range(0, len(raw), piece):
            part = raw[lo:lo + piece]
            out += [len(c.compress(part)) for c in self.coders]
        return out

    def answer(self, text: str | None, sharp: float = SHARP) -> tuple[str, float, float | None]:
        """Language, score and margin of one text."""
        if not self.langs or not text or not has_letter(text):
            return UNKNOWN, 0.0, None
        size = self.sizes(text).astype(np.float64)
        best = int(np.argmin(size))
        score = 1.0 / np.exp(-sharp * (size / size[best] - 1.0)).sum()
        second = np.delete(size, best).min() if len(size) > 1 else math.inf
        return self.langs[best], float(score), 1.0 if math.isinf(second) else float(1.0 - size[best] / second)


def agreed(pieces: dict[str, list[str]]) -> dict[str, list[str]]:
    """The pieces that the other half of the pieces gives the language they came with: wrong labels and
    passages of another language don't get into a dictionary.  A language of which none would stay keeps all."""
    out = {k: [] for k in pieces}
    for half in (0, 1):
        model = Classifier(dictionaries({k: v[half::2] or v for k, v in pieces.items()}))
        for k, v in pieces.items():
            out[k] += [p for p in v[1 - half::2] if model.langs[int(np.argmin(model.sizes(p)))] == k]
    return {k: v or pieces[k] for k, v in out.items()}


def dictionaries(pieces: dict[str, list[str]]) -> dict[str, bytes]:
    """Raw content of each language; zstandard wants 8 bytes at least."""
    return {k: b"\n".join(map(normal, v)).ljust(8) for k, v in pieces.items()}


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             margin: float = MARGIN, reject: bool = False, level: int = LEVEL) -> DataFrame:
    """One row per input row: ``doc_id, held_out, lang_pred, score, margin, rejected``.

    Dictionaries come from rows with a text, a language and an id whose fold
    isn't held out, and hold only pieces that agree with their label
    (``agreed``).  ``lang_pred`` is ``und`` with score 0 if the text is null
    or has no letter, or if no language was learned; it is the best language
    otherwise, and ``rejected`` tells margins under ``margin``, which
    ``reject=True`` turns into ``und`` too.  Equal sizes go to the first
    language by name.  Texts of any length are compressed in full; a null id
    counts as not held out; repeated rows are answered each.  Bytes that are
    no UTF-8 count as the replacement character.  Other columns are not read;
    an empty table gives no rows.
    """
    given = dictionaries(agreed(training_pieces(docs, id_col, text_col, lang_col)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Classifier(given, level)
        for b in batches:
            got = [model.answer(None if t is None else t.decode("utf-8", "replace"))
                   for t in (x.as_py() for x in b.column("text"))]
            narrow = [m is not None and m < margin for _, _, m in got]
            lang = [UNKNOWN if reject and n else x for (x, _, _), n in zip(got, narrow, strict=True)]
            yield pa.record_batch([b.column("doc_id"), pa.array(lang, type=pa.string()),
                                   pa.array([s for _, s, _ in got], type=pa.float64()),
                                   pa.array([m for _, _, m in got], type=pa.float64()), pa.array(narrow, type=pa.bool_())],
                                  names=["doc_id", "lang_pred", "score", "margin", "rejected"])
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.col(text_col).cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, lang_pred string, score double, margin double, rejected boolean").select(
        "doc_id", F.coalesce(C.doc_fold("doc_id", FOLDS) == HELD_FOLD, F.lit(False)).alias("held_out"), "lang_pred", "score",
        "margin", "rejected")
