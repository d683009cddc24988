"""MinHash near-deduplication by an inverted join of signature coordinates (op 7).

1. Each text becomes its set of 5-word shingles and a MinHash signature.  Texts with equal
   sets are one node, combined map-side, whatever their ids are.
2. The nodes are posted under each (coordinate, value) of their signatures.  A pair above
   the similarity agrees in at least ``AGREE`` of ``COORDINATES`` coordinates but for one
   case in 1e9.  So by the prefix principle a node needs posting only under its
   ``COORDINATES - AGREE + 1`` rarest values, and values of one node alone are the rarest
   of all: a node with fewer than ``AGREE`` shared values is out, and a passage or licence
   that a third of all documents share is skipped wherever it is not most of a document.
3. The lists are merged without emitting their pairs (``linking``): members meet one centre of
   their list, and what stays open meets under the rarest real shingles, where size and place
   leave room for the overlap.  So no link between components is lost, a large group of copies
   costs one comparison per member, and texts that share only a common passage do not meet.
4. Collisions of a pair are counted on the full signatures (``AGREE`` or more); what is above is
   confirmed on the full shingle sets.  Components are found by smallest labels with pointer
   jumping.

All tables between the steps are written to the shared scratch folder.  Nothing is collected
but the number of changed labels.

Edge cases: null, empty and all-white texts have no shingles, link with nothing and stay;
texts of fewer than five words are one shingle; repeated rows, rows with one id and unlike
texts, and rows with a null id are documents of their own; a component takes its smallest id
that is not null, so null ids beside another one go, and a component of null ids alone stays
with a null component; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.linking import (
    digest_of,
    linked,
    node_of,
    numbered,
    placed,
    possibly_in,
    set_table,
    whole_texts,
)
from touchline.llm.shingles import shingle_set
from touchline.scratch import spill

COORDINATES = 96
AGREE = 45
PERCENT = 75
STARS = 4

_rng = np.random.default_rng(11)
_FACTOR = _rng.integers(0, 1 << 32, COORDINATES, dtype="u4") | np.uint32(1)
_SHIFT = _rng.integers(0, 1 << 32, COORDINATES, dtype="u4")
_CHUNK = 2048


def signature(hashes: np.ndarray) -> np.ndarray:
    """Smallest value of each coordinate's hash over the set."""
    low = (hashes >> np.uint64(32)).astype("u4") ^ hashes.astype("u4")
    best = np.full(COORDINATES, 0xFFFFFFFF, "u4")
    for i in range(0, len(low), _CHUNK):
        part = low[i : i + _CHUNK, None] * _FACTOR + _SHIFT
        part ^= part >> np.uint32(15)
        part *= np.uint32(0x2C1B3C6D)
        np.minimum(best, part.min(axis=0), out=best)
    return best


def _batch(names: list[str], columns: list[pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(columns, names)


def described(docs: DataFrame, text: str, id_column: str, salt: int = 0) -> DataFrame:
    """doc_id, n_shingles, node, digest and signature of each row's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(value.as_buffer()) for value in batch.column(1)]
            digests = [digest_of(s, salt) for s in sets]
            yield _batch(
                ["doc_id", "n_shingles", "node", "digest", "signature"],
                [
                    batch.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([node_of(d) for d in digests], pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array([signature(s).tobytes() if len(s) else None for s in sets], pa.binary()),
                ],
            )

    rows = whole_texts(docs, text, F.col(id_column).cast("long").alias("doc_id"))
    return rows.mapInArrow(
        run, "doc_id long, n_shingles long, node long, digest binary, signature binary"
    )


def _tokens(nodes: DataFrame) -> DataFrame:
    """(token, node): coordinate number above the 32 bits of its value."""
    high = np.arange(COORDINATES, dtype="i8") << 32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.repeat(batch.column(0).to_numpy(), COORDINATES)
            values = np.frombuffer(b"".join(batch.column(1).to_pylist()), "u4").astype("i8")
            tokens = values + np.tile(high, len(batch))
            yield _batch(["token", "node"], [pa.array(tokens), pa.array(ids, pa.int64())])

    return nodes.select("node", "signature").mapInArrow(run, "token long, node long")


def postings(nodes: DataFrame) -> DataFrame:
    """(token, node) under each node's rarest shared tokens, as many as the prefix takes."""
    tokens = _tokens(nodes)
    shared = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("times")).filter("times > 1")
    ranked = (
        tokens.join(shared, "token")
        .groupBy("node")
        .agg(F.sort_array(F.collect_list(F.struct("times", "token"))).alias("found"))
    )
    alone = COORDINATES - F.size("found")
    quota = COORDINATES - AGREE + 1 - alone
    return ranked.filter(quota > 0).select(
        "node", F.explode(F.slice("found", F.lit(1), quota)).alias("one")
    ).select(F.col("one")["token"].alias("token"), "node")


def agreeing(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose signatures collide in ``AGREE`` coordinates or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            left, right = (
                np.frombuffer(b"".join(batch.column(k).to_pylist()), "u4").reshape(-1, COORDINATES)
                for k in (2, 3)
            )
            good = pa.array((left == right).sum(axis=1) >= AGREE)
            yield batch.select([0, 1]).filter(good)

    def side(name: str) -> DataFrame:
        return nodes.select(F.col("node").alias(name), F.col("signature").alias(f"of_{name}"))

    met = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "of_a", "of_b")
    return met.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept."""
    rows, nodes, salt = numbered(lambda salt: described(docs, text, id_column, salt))
    signatures = spill(
        rows.filter("n_shingles > 0")
        .select("node", F.col("n_shingles").alias("n"), "signature")
        .dropDuplicates(["node"]),
        "near-signatures",
    )
    sizes = signatures.select(F.col("node").alias("__node"), "n")
    posted = spill(
        postings(signatures)
        .join(sizes, F.col("node") == F.col("__node"))
        .select("token", "node", "n"),
        "near-postings",
    )
    members = posted.select(F.col("node").alias("__node")).distinct()
    members = spill(
        members.join(nodes, F.col("node") == F.col("__node")).select("__node", "first"), "near-members"
    )
    sets = spill(set_table(docs, text, 1, salt, members, id_column), "near-texts")
    few = possibly_in(signatures, "node", members.select("__node"))
    held = few.join(members, F.col("node") == F.col("__node"), "left_semi")
    held = spill(held.select("node", "signature"), "near-held")
    labels, _ = linked(
        posted, sets, PERCENT, lambda pairs, sets, percent: agreeing(pairs, held), STARS
    )
    return placed(rows.drop("signature"), nodes, labels)
