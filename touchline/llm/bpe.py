"""Byte-level BPE encoding and decoding with the tiktoken library (op 5).

The ranks come from a local file.  Texts are split before encoding, at places where the
splitting pattern ends a match whatever follows, so that no call to the library grows with
the text:

* before white space that follows anything else: no match holds both, except for the one
  space that starts a match;
* between letters and numbers in either order, and after letters or numbers before any
  other sign: such runs end there.  A sign before a letter is no such place ('s, 'll).

A single run without such a place (a megabyte of letters, say) is cut by the pattern
itself, match by match, and each match goes to the merges alone; the library merges one
long match in near-linear time.

Python works on Arrow batches inside the scan's tasks; nothing is shuffled.  Memory is one
batch of texts and one text's ids.

Edge cases: null and empty texts have no ids and the digests of nothing; special tokens are
ordinary text; repeated rows give repeated results; other columns are not read.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import text_of

SEGMENT = 50_000
_SAFE = regex.compile(
    r"(?<=\S)(?=\s)|(?<=\p{L})(?=\p{N})|(?<=\p{N})(?=\p{L})|(?<=[\p{L}\p{N}])(?=[^\s\p{L}\p{N}])"
)


@functools.lru_cache(maxsize=4)
def encoding(rank_file: str, pattern: str) -> tiktoken.Encoding:
    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@functools.lru_cache(maxsize=4)
def _matches(pattern: str) -> regex.Pattern:
    return regex.compile(pattern)


def segments(text: str, size: int = SEGMENT) -> Iterator[str]:
    """The text in order, cut at safe places at least ``size`` characters apart."""
    start = 0
    while len(text) - start > size:
        found = _SAFE.search(text, start + size)
        if found is None:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:]


def encode(text: str, codec: tiktoken.Encoding, pattern: str, size: int = SEGMENT) -> np.ndarray:
    """Ids of the whole text, equal to the library's for the text in one piece."""
    parts = []
    for part in segments(text, size):
        if len(part) <= 2 * size:
            ids = codec.encode_ordinary(part)
        else:
            ids = []
            for match in _matches(pattern).finditer(part):
                ids += codec.encode_ordinary(match[0])
        parts.append(np.array(ids, dtype="<u4"))
    return np.concatenate(parts) if parts else np.empty(0, "<u4")


def decode(ids: np.ndarray, codec: tiktoken.Encoding, step: int = 1 << 20) -> bytes:
    """The raw bytes of the ids; a character may span ids, so bytes are joined first."""
    return b"".join(
        codec.decode_bytes(ids[i : i + step].tolist()) for i in range(0, len(ids), step)
    )


def token_digests(
    docs: DataFrame, rank_file: str, pattern: str, text: str = "text", id_column: str = "doc_id"
) -> DataFrame:
    """Per text: doc_id, n_tokens, ids_sha256, decoded_sha256."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoding(rank_file, pattern)
        for batch in batches:
            counts, ids_digests, text_digests = [], [], []
            for value in batch.column(1):
                ids = encode(value.as_py(), codec, pattern)
                counts.append(len(ids))
                ids_digests.append(hashlib.sha256(ids.tobytes()).hexdigest())
                text_digests.append(hashlib.sha256(decode(ids, codec)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(counts, pa.int64()),
                    pa.array(ids_digests, pa.string()),
                    pa.array(text_digests, pa.string()),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select(
        F.col(id_column).cast("long").alias("doc_id"), text_of(text).alias("text")
    ).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def token_ids(
    docs: DataFrame, rank_file: str, pattern: str, text: str = "text", id_column: str = "doc_id"
) -> DataFrame:
    """Per text: doc_id, ids (array of int)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoding(rank_file, pattern)
        for batch in batches:
            ids = [encode(v.as_py(), codec, pattern).astype("i4") for v in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"]
            )

    return docs.select(
        F.col(id_column).cast("long").alias("doc_id"), text_of(text).alias("text")
    ).mapInArrow(run, "doc_id long, ids array<int>")


def texts_of_ids(
    encoded: DataFrame, rank_file: str, pattern: str, ids: str = "ids", id_column: str = "doc_id"
) -> DataFrame:
    """Per row of ids: doc_id, bytes.  Null ids give no bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoding(rank_file, pattern)
        for batch in batches:
            raw = [decode(np.array(v.as_py() or [], "<u4"), codec) for v in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(raw, pa.binary())], ["doc_id", "bytes"]
            )

    return encoded.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(ids).cast("array<int>").alias("ids")
    ).mapInArrow(run, "doc_id long, bytes binary")
