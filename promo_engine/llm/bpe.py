"""Byte-level BPE encoding and decoding with the tiktoken library and a
local rank file.

A long text is cut before encoding at places where the splitting pattern
must end a match whatever stands around them, so the pieces' ids, joined,
are those of the whole text, while the library never holds more than a
piece at a time.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark import SparkFiles
from pyspark.sql import DataFrame

from promo_engine.llm import common as C

PIECE_CHARS = 1 << 16
ROWS = 256

#: Safe cuts (the pattern looks ahead, never behind; no alternative of it spans these):
#: a letter or digit, then a blank or line end; an ASCII letter beside an ASCII digit;
#: blanks and line ends, cut before the last of them if a letter or digit follows.
_SAFE = regex.compile(
    r"(?<=[\p{L}\p{N}])(?=[ \n])|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])"
    r"|(?<=[ \n])(?=[ \n][\p{L}\p{N}])")
#: White space too long for the library's pattern matcher: one match of the pattern, all but the last
#: character of it, or all of it at the text's end.
_LONG_SPACE = regex.compile(r"\p{White_Space}{%d,}" % PIECE_CHARS)


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


@functools.lru_cache(maxsize=4)
def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    """One encoder per worker process, rank file and pattern."""
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=load_ranks(path), special_tokens={})


def pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """``text`` cut at the first safe place after each ``size`` characters;
    a stretch without one stays whole, however long."""
    at = 0
    while len(text) - at > size:
        m = _SAFE.search(text, at + size)
        if m is None:
            break
        yield text[at:m.start()]
        at = m.start()
    yield text[at:]


def encode_text(enc: tiktoken.Encoding, text: str, size: int = PIECE_CHARS) -> list[int]:
    if len(text) <= size:
        return enc.encode_ordinary(text)
    ids: list[int] = []
    at = 0
    for m in _LONG_SPACE.finditer(text):
        end = m.end() if m.end() == len(text) else m.end() - 1
        ids += [i for p in pieces(text[at:m.start()], size) for i in enc.encode_ordinary(p)]
        ids += enc._encode_single_piece(text[m.start():end])   # a run that is one match: merges only
        at = end
    return ids + [i for p in pieces(text[at:], size) for i in enc.encode_ordinary(p)]


def encode_array(enc: tiktoken.Encoding, text: str, size: int = PIECE_CHARS) -> np.ndarray:
    """The ids as int32."""
    if len(text) <= size:
        return enc.encode_to_numpy(text, disallowed_special=()).astype(np.int32)
    return np.array(encode_text(enc, text, size), dtype=np.int32)


def _shipped(path: str) -> str:
    """The rank file where this task runs: the given path, else Spark's copy of it."""
    return path if os.path.exists(path) else SparkFiles.get(os.path.basename(path))


def encode(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id",
           text_col: str = "text", piece_chars: int = PIECE_CHARS) -> DataFrame:
    """One row per input row: ``doc_id, ids`` (array<int>), without special
    tokens; special tokens' strings are ordinary text.

    A null text counts as empty and an empty text has no ids.  Null ids of
    documents stay null, repeated rows are encoded each, other columns are
    not read; an empty table gives no rows.  The rank file must exist on the
    driver; Spark ships it to executors that lack it.
    """
    rows = C.id_text(docs, id_col, text_col)
    rows.sparkSession.sparkContext.addFile(rank_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(_shipped(rank_path), pattern)
        for b in batches:
            ids, texts = b.column("doc_id"), b.column("text")
            for lo in range(0, b.num_rows, ROWS):            # small outputs, whatever the batch
                got = [encode_array(enc, t.as_py() or "", piece_chars) for t in texts.slice(lo, ROWS)]
                yield pa.record_batch([ids.slice(lo, ROWS), _lists(got)], names=["doc_id", "ids"])
    return rows.mapInArrow(run, "doc_id bigint, ids array<int>")


def _lists(got: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0] + [len(g) for g in got])
    return pa.ListArray.from_arrays(pa.array(ends, type=pa.int32()), pa.array(np.concatenate(got) if got else []))


def _arrays(b: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray | None]]]:
    """Slices of a batch with their ids as arrays."""
    for lo in range(0, b.num_rows, ROWS):
        part = b.slice(lo, ROWS)
        col = part.column("ids")
        flat, ends = np.asarray(col.values), np.asarray(col.offsets)
        yield part, [flat[a:z] if ok else None for a, z, ok in
                     zip(ends[:-1], ends[1:], col.is_valid().to_pylist(), strict=True)]


def decode(tokens: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """``doc_id, ids, raw``: the exact bytes of the ids.  They are not forced
    into text, so ids that break a character keep every byte.  Null ids give
    null bytes, no ids give no bytes; an unknown id raises."""
    rows = tokens.select("doc_id", "ids")
    rows.sparkSession.sparkContext.addFile(rank_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(_shipped(rank_path), pattern)
        for b in batches:
            for part, ids in _arrays(b):
                raw = [None if v is None else enc.decode_bytes(v.tolist()) for v in ids]
                yield pa.record_batch([part.column("doc_id"), part.column("ids"), C.binary(raw)],
                                      names=["doc_id", "ids", "raw"])
    return rows.mapInArrow(run, "doc_id bigint, ids array<int>, raw binary")


def _digested(enc: tiktoken.Encoding, written: list[bytes], doc_ids: pa.Array, ids: list[np.ndarray],
              with_ids: bool) -> pa.RecordBatch:
    lists = [v.tolist() for v in ids]
    texts = [b"".join(map(written.__getitem__, v))[:-1] for v in lists]
    out = {"doc_id": doc_ids, "n_tokens": pa.array(map(len, lists), type=pa.int64()),
           "ids_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in texts], type=pa.string()),
           "decoded_sha256": pa.array([hashlib.sha256(enc.decode_bytes(v)).hexdigest() for v in lists], type=pa.string())}
    return pa.RecordBatch.from_pydict(out | ({"ids": _lists(ids)} if with_ids else {}))


_DIGEST = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def digest(tokens: DataFrame, rank_path: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """The contract's columns of ``encode``'s rows, decoded as ``decode`` does, and the ids if asked for."""
    rows = tokens.select("doc_id", "ids")
    rows.sparkSession.sparkContext.addFile(rank_path)
    none = np.empty(0, dtype=np.int32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(_shipped(rank_path), pattern)
        written = [b"%d " % i for i in range(enc.n_vocab)]
        for b in batches:
            for part, arrays in _arrays(b):
                yield _digested(enc, written, part.column("doc_id"), [none if v is None else v for v in arrays], with_ids)
    return rows.mapInArrow(run, _DIGEST + ", ids array<int>" * with_ids)


def encode_digest(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                  piece_chars: int = PIECE_CHARS, with_ids: bool = False) -> DataFrame:
    """``digest`` of ``encode`` in one stage, so that a task slot has one
    Python worker with one encoder and the ids needn't leave it."""
    rows = C.id_text(docs, id_col, text_col)
    rows.sparkSession.sparkContext.addFile(rank_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(_shipped(rank_path), pattern)
        written = [b"%d " % i for i in range(enc.n_vocab)]
        for b in batches:
            ids, texts = b.column("doc_id"), b.column("text")
            for lo in range(0, b.num_rows, ROWS):
                got = [encode_array(enc, t.as_py() or "", piece_chars) for t in texts.slice(lo, ROWS)]
                yield _digested(enc, written, ids.slice(lo, ROWS), got, with_ids)
    return rows.mapInArrow(run, _DIGEST + ", ids array<int>" * with_ids)
