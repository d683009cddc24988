"""Jaccard join of word n-grams by universe partition and pigeonhole (op 12).

1. Each text becomes its set of 5-word shingles; texts of equal sets are one node, combined
   map-side.  A node's number is half of a 128-bit digest of its set; should two sets ever get
   one number, all numbers are drawn again with another salt.
2. Sets are dealt to bands by size.  The universe of shingles is cut into m segments per band by
   hash.  Two sets of similarity t differ in at most H elements, so if segments are compared
   exactly (weight 1), or with one element more or less (weight 2), and the weights add up to
   more than H, some segment agrees: by pigeonhole, more than that, agreeing segments have a
   weight of at least W - H, where W is the sum of all weights.
3. ``allocation`` chooses per band, from the number of its sets, how many segments are compared
   exactly and how many with their one-deletion neighbourhoods, by the expected number of index
   entries and of pairs that meet under empty segments.  Small sets get neighbourhoods, large
   ones many exact segments.  The numbers of sets are guessed from the lengths of the texts, so
   that texts are split once only; a guess changes the cost, never a result.
4. A set is posted in its own band, and in the band below if smaller partners may be there.  It
   may leave out keys, as long as their weights stay below W - H and all sets leave out the last
   ones of one order: of the keys under which two similar sets agree, the first is left out by
   neither.  Segments of few elements are left out at once, down to ``SLACK`` more than needed;
   by the counts of all keys, the hottest of these go then.  So common segments (empty ones, parts
   of a passage in very many texts) bring no candidates.
5. Lists are compared by stars and, for what stays open, by the rarest shingles themselves
   (``linking``); every link is confirmed on full sets, and components are found by smallest
   labels with pointer jumping.

Edge cases: null, empty and all-white texts have no shingles and link with nothing; texts of
fewer than five words are one shingle; repeated rows, rows with one id and unlike texts, and rows
with a null id are documents of their own; the component of rows with null ids alone is null; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from touchline.llm.linking import (
    difference_bound,
    digest_of,
    linked,
    node_of,
    numbered,
    parity_sketch,
    placed,
    possibly_in,
    whole_texts,
)
from touchline.llm.shingles import mix, shingle_set
from touchline.scratch import spill

PERCENT = 80
BAND_RATIO = 1.5
SLACK = 6  # keys that the counts may still leave out
PAIR_COST = 0.5  # cost of a pair that meets, in index entries
LARGEST = 1 << 31  # no text holds more shingles
SHINGLE_BYTES = 6.5
_LOW_BITS = np.uint64(0xFFFFFFFFFFFFFFFC)


@dataclass(frozen=True)
class Band:
    """Sets of low to high elements: m segments, the first ``wide`` with neighbourhoods."""

    low: int
    high: int
    segments: int
    wide: int

    @property
    def weight(self) -> int:
        return self.segments + self.wide


def band_edges(largest: int, percent: int) -> list[int]:
    """First sizes of the bands; smaller sets than the first can only link with equal ones."""
    first = -(-percent // (100 - percent))
    edges = [first]
    while edges[-1] <= largest:
        edges.append(max(edges[-1] + 1, int(edges[-1] * BAND_RATIO)))
    return edges


def allocation(edges: list[int], counts: dict[int, int], percent: int) -> list[Band]:
    """Segments and neighbourhoods per band, by the least expected cost.

    The smallest sets of a band have the fewest elements per segment, but need less weight.
    """

    def needed(size: int) -> int:
        return difference_bound(size, 100 * size // percent, percent) + 1

    bands = []
    for b, low in enumerate(edges[:-1]):
        high = edges[b + 1] - 1
        need = needed(high)
        sets = max(counts.get(b, 0), 1)
        best = None
        for spare in sorted({0, 1, 2, 3, 4, 6, 8, 12, need // 10, need // 5, need // 3}):
            for share in (0.0, 0.25, 0.5, 1.0):
                weight = need + spare
                wide = min(round(weight * share / (1 + share)), weight // 2)
                segments = weight - wide
                entries = sets * (segments + wide * (high / segments + 1))
                forced = max(
                    _tail(segments * np.exp(-size / segments), weight - needed(size))
                    for size in (low, high)
                )
                pairs = (sets * forced) ** 2 / segments
                cost = (entries + PAIR_COST * pairs, segments, wide)
                best = min(best or cost, cost)
        bands.append(Band(low, high, best[1], best[2]))
    return bands


def _tail(mean: float, spare: int) -> float:
    """Chance that a Poisson number exceeds ``spare``; by the normal curve where the mean is large."""
    if mean > 500:
        return 0.5 * math.erfc((spare + 0.5 - mean) / math.sqrt(2 * mean))
    term = total = math.exp(-mean)
    for k in range(1, spare + 1):
        term *= mean / k
        total += term
        if k > mean and term < 1e-18:
            break
    return max(0.0, 1.0 - total)


def segment_keys(hashes: np.ndarray, band: Band, number: int, most: int) -> np.ndarray:
    """Keys of a set in one band: its segments and the neighbourhoods of wide ones.

    The lowest two bits of a key tell the band's parity and whether the segment is wide.  In a
    band without wide segments only the ``most`` fullest segments count.
    """
    spread = mix(hashes ^ np.uint64(0x5851F42D4C957F2D * (number + 1) & 0xFFFFFFFFFFFFFFFF))
    segment = ((spread >> np.uint64(32)) * np.uint64(band.segments)) >> np.uint64(32)
    order = np.argsort(segment, kind="stable")
    segment, values = segment[order].astype("i8"), mix(spread[order])
    sums = np.zeros(band.segments, "u8")
    edges = np.flatnonzero(np.diff(segment, prepend=-1))
    sums[segment[edges]] = np.add.reduceat(values, edges)
    names = mix(np.arange(band.segments, dtype="u8") + np.uint64((number + 1) << 32))
    kind = np.where(np.arange(band.segments) < band.wide, 2, 0).astype("u8") | np.uint64(number & 1)
    keys = (mix(sums ^ names) & _LOW_BITS) | kind
    if band.wide:
        near = segment < band.wide
        at = segment[near]
        deleted = mix((sums[at] - values[near]) ^ names[at])
        return np.concatenate([keys, (deleted & _LOW_BITS) | kind[at]])
    if most < len(keys):
        sizes = np.bincount(segment, minlength=band.segments)
        return keys[np.lexsort((keys, -sizes))[:most]]
    return keys


def guessed_counts(docs: DataFrame, text: str, edges: list[int]) -> dict[int, int]:
    """About how many texts each band holds, by their lengths."""
    n = F.floor(F.octet_length(F.col(text).cast("string")) / SHINGLE_BYTES)
    lows = F.array(*[F.lit(e) for e in edges])
    band = (F.size(F.filter(lows, lambda low: low <= n)) - 1).alias("band")
    found = docs.groupBy(band).agg(F.count(F.lit(1)).alias("sets")).filter("band >= 0")
    return {r["band"]: r["sets"] for r in found.collect()}  # one row per band


def _tokens(hashes: np.ndarray, bands: list[Band], lows: list[int], percent: int) -> np.ndarray:
    """Keys of a set in its band and, where partners may be there, in the one below."""
    n = len(hashes)
    own = bisect_right(lows, n) - 1
    most = difference_bound(n, 100 * n // percent, percent) + 1 + SLACK
    keys = segment_keys(hashes, bands[own], own, most)
    if own and percent * n <= 100 * bands[own - 1].high:
        below = bands[own - 1]
        most = difference_bound(n, below.high, percent) + 1 + SLACK
        keys = np.concatenate([keys, segment_keys(hashes, below, own - 1, most)])
    return keys.view("i8")


def described(
    docs: DataFrame, text: str, id_column: str, salt: int, bands: list[Band], percent: int
) -> DataFrame:
    """doc_id, n_shingles, node and digest of each row's set, its text, sketch and tokens.

    A task gives the tokens of a set once; copies in other tasks repeat them.
    """
    lows = [b.low for b in bands]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            sizes, digests, nodes, sketches, tokens = [], [], [], [], []
            for value in batch.column(1):
                hashes = shingle_set(value.as_buffer())
                digest = digest_of(hashes, salt)
                node = node_of(digest)
                sizes.append(len(hashes))
                digests.append(digest)
                nodes.append(node)
                sketches.append(parity_sketch(hashes) if len(hashes) else None)
                posted = len(hashes) >= lows[0] and node not in seen
                tokens.append(_tokens(hashes, bands, lows, percent) if posted else None)
                seen.add(node)
            columns = [
                batch.column(0),
                pa.array(sizes, pa.int64()),
                pa.array(nodes, pa.int64()),
                pa.array(digests, pa.binary()),
                batch.column(1),
                pa.array(sketches, pa.binary()),
                pa.array(tokens, pa.list_(pa.int64())),
            ]
            names = ["doc_id", "n_shingles", "node", "digest", "text", "sketch", "tokens"]
            yield pa.RecordBatch.from_arrays(columns, names)

    rows = whole_texts(docs, text, F.col(id_column).cast("long").alias("doc_id"))
    return rows.mapInArrow(
        run,
        "doc_id long, n_shingles long, node long, digest binary, text binary, sketch binary, "
        "tokens array<long>",
    )


def _allowance(bands: list[Band], percent: int) -> Column:
    """Weight of keys that a set may leave out in the band of a key, by its size.

    In its own band a set may meet larger ones; in the band below it only meets smaller ones.
    """
    n, parity = F.col("n"), F.col("token").bitwiseAND(F.lit(1))
    lows = F.array(*[F.lit(b.low) for b in bands])
    highs = F.array(*[F.lit(b.high).cast("long") for b in bands])
    weights = F.array(*[F.lit(b.weight) for b in bands])
    slack = F.array(*[F.lit(b.weight if b.wide else SLACK) for b in bands])
    own = F.size(F.filter(lows, lambda low: low <= n)) - 1
    at = F.when(own % 2 == parity, own).otherwise(own - 1)
    largest = F.floor(100 * n / percent).cast("long")
    other = F.when(at == own, largest).otherwise(F.least(n, F.get(highs, at)))
    differ = F.floor((100 - percent) * (n + other) / (100 + percent))
    return F.least(F.get(weights, at) - differ - 1, F.get(slack, at))


def postings(
    rows: DataFrame, sizes: DataFrame, bands: list[Band], percent: int = PERCENT
) -> DataFrame:
    """(token, node, n) of every set without the hottest keys that it may leave out.

    ``rows`` holds (node, tokens), ``sizes`` (__node, n), one row per set.
    """
    keys = rows.select(F.explode("tokens").alias("token"), "node")
    shared = keys.groupBy("token").agg(F.count(F.lit(1)).alias("times")).filter("times > 1")
    shared = spill(shared, "jaccard-shared")
    wide = F.col("token").bitwiseAND(F.lit(2))
    band = F.col("token").bitwiseAND(F.lit(1))
    hottest = Window.partitionBy("node", band).orderBy(F.desc("times"), F.desc("token"))
    spent = F.sum(F.when(wide != 0, 2).otherwise(1)).over(
        hottest.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        keys.join(shared, "token")
        .join(sizes, F.col("node") == F.col("__node"))
        .withColumn("allowed", _allowance(bands, percent))
        .withColumn("spent", spent)
        .filter("spent > allowed")
        .select("token", "node", "n")
        .distinct()
    )


def similar_documents(
    docs: DataFrame, text: str = "text", id_column: str = "doc_id", percent: int = PERCENT
) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept."""
    edges = band_edges(LARGEST, percent)
    bands = allocation(edges, guessed_counts(docs, text, edges), percent)
    rows, nodes, _ = numbered(lambda salt: described(docs, text, id_column, salt, bands, percent))
    sizes = nodes.select(F.col("node").alias("__node"), "n")
    posted = spill(postings(rows, sizes, bands, percent), "jaccard-postings")
    members = spill(posted.select(F.col("node").alias("__node")).distinct(), "jaccard-members")
    sets = (
        possibly_in(rows, "node", members)
        .join(members, F.col("node") == F.col("__node"), "left_semi")
        .select("node", F.col("n_shingles").alias("n"), "text", "sketch")
        .dropDuplicates(["node"])
    )
    labels, _ = linked(posted, spill(sets, "jaccard-sets"), percent)
    return placed(rows.drop("text", "sketch", "tokens"), nodes, labels)
