"""From lists of candidates to components of similar sets; shared by set-similarity operators.

Sets are nodes (long ids) of a table ``sets`` (node, n, text, sketch), one row per distinct set.
Lists are postings (token, node, n).  Pairs of a list are never emitted as a whole:

* ``star_pairs`` compares the members of a list with one centre, where they are in other
  components than it; a list within one component is done;
* ``prefix_pairs`` does the rest exactly: members of lists that still hold several components
  meet under their rarest shingles only, the longer set under its probing prefix, the shorter
  under its shorter indexing prefix, and only where the sizes of both and the place of the
  shingle leave room for the overlap that the similarity asks for.  The room is part of the
  join key (buckets of sizes), so what cannot reach the similarity does not meet.

Candidates pass a parity sketch, which can only be too lenient, and are confirmed on full sets.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from touchline.llm.common import text_of
from touchline.llm.shingles import shingle_set, similar
from touchline.scratch import spill

Screen = Callable[[DataFrame, DataFrame, int], DataFrame]

STARS = 2
PARTS = 64  # copies of a centre's text that its members meet, at most
_MIN_BITS = 256
_SIZE_STEP = math.log(1.12)
CELLS, CELL_BITS = 1 << 10, 1 << 15  # the bits that bitmap_construct_agg puts into one value


def difference_bound(a: int, b: int, percent: int) -> int:
    """Most elements in which sets of a and b elements may differ at that similarity."""
    return (100 - percent) * (a + b) // (100 + percent)


def parity_sketch(hashes: np.ndarray) -> bytes:
    """Parity of the elements per bit: two sets differ in at least as many elements as bits."""
    bits = max(_MIN_BITS, 1 << (2 * len(hashes) - 1).bit_length())
    places = (hashes >> np.uint64(17)) & np.uint64(bits - 1)
    return np.packbits((np.bincount(places.astype("i8"), minlength=bits) & 1).astype("u1")).tobytes()


def digest_of(hashes: np.ndarray, salt: int) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16, salt=salt.to_bytes(4, "little")).digest()


def node_of(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


def whole_texts(docs: DataFrame, text: str, *ids: Column) -> DataFrame:
    return docs.select(*ids, text_of(text).cast("binary").alias("text"))


def numbered(describe: Callable[[int], DataFrame]) -> tuple[DataFrame, DataFrame, int]:
    """Rows with ``node`` and ``digest`` of their set; the nodes (node, n, first); their salt.

    A node's number is half of its digest.  Should two sets get one number, all numbers are
    drawn again with another salt.
    """
    salt = 0
    while True:
        rows = spill(describe(salt), "linking-described")
        nodes = (
            rows.filter("n_shingles > 0")
            .groupBy("node", "digest")
            .agg(F.min("doc_id").alias("first"), F.max("n_shingles").alias("n"))
        )
        nodes = spill(nodes, "linking-nodes")
        twice = nodes.groupBy("node").agg(F.count(F.lit(1)).alias("sets")).filter("sets > 1")
        if twice.isEmpty():
            return rows, nodes, salt
        salt += 1


def possibly_in(rows: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """All rows whose ``column`` is among the values of ``wanted`` (one column), and few others.

    So wide rows need not be shuffled to be met.  Null is a value.  A bitmap of hashes is
    broadcast, of 4 MB at most whatever the input: with very many values more others stay.
    """

    def hashed(name: str) -> Column:
        return F.pmod(F.xxhash64(name), F.lit(CELLS * CELL_BITS))

    place = hashed(wanted.columns[0])
    cells = wanted.groupBy(F.floor(place / CELL_BITS).alias("__cell")).agg(
        F.bitmap_construct_agg(place % CELL_BITS).alias("__bits")
    )
    at = hashed(column)
    byte = F.substring("__bits", (F.floor(at % CELL_BITS / 8) + 1).cast("int"), F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    met = (F.floor(at / CELL_BITS) == F.col("__cell")) & (F.getbit(value, (at % 8).cast("int")) == 1)
    return rows.join(F.broadcast(cells), met, "left_semi")


def set_table(
    docs: DataFrame,
    text: str,
    least: int,
    salt: int,
    members: DataFrame | None = None,
    id_column: str | None = None,
) -> DataFrame:
    """(node, n, text, sketch): one text of each distinct set of ``least`` elements or more.

    With ``members`` (__node, first: the least id of the node's rows), only of those; the texts
    of other ids in ``id_column`` are mostly not looked at.
    """
    if members is not None and id_column is not None:
        ids = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))
        docs, text = possibly_in(ids, "doc_id", members.select("first")), "text"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(value.as_buffer()) for value in batch.column(0)]
            keep = [k for k, s in enumerate(sets) if len(s) >= least]
            columns = [
                pa.array([node_of(digest_of(sets[k], salt)) for k in keep], pa.int64()),
                pa.array([len(sets[k]) for k in keep], pa.int64()),
                batch.column(0).take(pa.array(keep, pa.int64())),
                pa.array([parity_sketch(sets[k]) for k in keep], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["node", "n", "text", "sketch"])

    rows = whole_texts(docs, text).mapInArrow(run, "node long, n long, text binary, sketch binary")
    if members is not None:
        rows = rows.join(members, F.col("node") == F.col("__node"), "left_semi")
    return rows.dropDuplicates(["node"])


def _differing_bits(a: bytes, b: bytes) -> int:
    """Lower bound of the difference; the longer sketch is folded onto the shorter."""
    small, large = sorted((np.frombuffer(a, "u1"), np.frombuffer(b, "u1")), key=len)
    folded = np.bitwise_xor.reduce(large.reshape(-1, len(small)), axis=0)
    return int(np.bitwise_count(folded ^ small).sum())


def sketched(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sketches allow the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of_a, of_b, n_a, n_b = (batch.column(k).to_pylist() for k in (2, 3, 4, 5))
            good = [
                _differing_bits(x, y) <= difference_bound(m, n, percent)
                for x, y, m, n in zip(of_a, of_b, n_a, n_b, strict=True)
            ]
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    def side(name: str) -> DataFrame:
        return sets.select(
            F.col("node").alias(name), F.col("sketch").alias(f"of_{name}"), F.col("n").alias(f"n_{name}")
        )

    met = pairs.join(side("a"), "a").join(side("b"), "b")
    return met.select("a", "b", "of_a", "of_b", "n_a", "n_b").mapInArrow(run, "a long, b long")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int, screen: Screen = sketched) -> DataFrame:
    """The pairs (a, b) that reach the similarity on full sets.

    Members of a centre b are dealt to up to ``PARTS`` parts; the centre's text travels once
    per part, in front of the part's members, and is split into shingles once.
    """
    part = F.pmod(F.xxhash64("a"), F.lit(PARTS)).cast("int")
    close = spill(screen(pairs, sets, percent).withColumn("part", part), "linking-close")
    texts = sets.select("node", "text").hint("merge")  # they move to the pairs at every size alike
    members = close.join(texts, F.col("a") == F.col("node")).select("b", "part", "a", "text")
    centres = (
        close.select("b", "part")
        .distinct()
        .join(texts, F.col("b") == F.col("node"))
        .select("b", "part", F.lit(None).cast("long").alias("a"), "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre = None
        for batch in batches:
            good = []
            for a, text in zip(batch.column(2).to_pylist(), batch.column(3), strict=True):
                hashes = shingle_set(text.as_buffer())
                if a is None:  # sorts first
                    centre = hashes
                good.append(a is not None and similar(centre, hashes, percent))
            kept = batch.filter(pa.array(good, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column(2), kept.column(0)], ["a", "b"])

    return (
        members.unionByName(centres)
        .repartition("b", "part")
        .sortWithinPartitions("b", "part", F.col("a").asc_nulls_first())
        .mapInArrow(run, "a long, b long")
    )


def _labelled(posted: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Postings with the component of their node, its own where it has no link yet."""
    if labels is None:
        return posted.withColumn("component", F.col("node"))
    own = labels.select(F.col("doc_id").alias("__node"), "component")
    return posted.join(own, F.col("node") == F.col("__node"), "left").select(
        *posted.columns, F.coalesce("component", "node").alias("component")
    )


def _fits(percent: int) -> Column:
    return 100 * F.least("n", "n2") >= percent * F.greatest("n", "n2")


def star_pairs(posted: DataFrame, labels: DataFrame | None, turn: int, percent: int) -> DataFrame:
    """(a, b): each member outside the component of its list's centre b, with that centre."""
    rows = _labelled(posted, labels)
    order = F.xxhash64("node", F.lit(turn)) if turn else F.col("node")
    centres = (
        rows.groupBy("token")
        .agg(
            F.min(F.struct(order.alias("o"), "node", "component", "n")).alias("c"),
            F.min("component").alias("low"),
            F.max("component").alias("high"),
        )
        .filter("low != high")
        .select(
            "token",
            F.col("c")["node"].alias("b"),
            F.col("c")["component"].alias("component2"),
            F.col("c")["n"].alias("n2"),
        )
    )
    # Written first: the join then has an exchange on either side, and a hot list is split.
    centres = spill(centres, "linking-centres")
    apart = (F.col("component") != F.col("component2")) & _fits(percent)
    return rows.join(centres, "token").filter(apart).select(F.col("node").alias("a"), "b").distinct()


def _open_lists(posted: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Labelled postings of lists of several components, with each list's largest (main)."""
    rows = _labelled(posted, labels)
    sizes = rows.groupBy("token", "component").agg(F.count(F.lit(1)).alias("k"))
    main = (
        sizes.groupBy("token")
        .agg(F.max(F.struct("k", "component")).alias("m"), F.count(F.lit(1)).alias("c"))
        .filter("c > 1")
        .select("token", F.col("m")["component"].alias("main"))
    )
    return rows.join(spill(main, "linking-main"), "token")


def _shingles(texts: DataFrame) -> DataFrame:
    """(node, n, token) of whole texts, one row per distinct shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                hashes = shingle_set(value.as_buffer()).view("i8")
                n = len(hashes)
                columns = [np.full(n, key, "i8"), np.full(n, n, "i8"), hashes]
                yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["node", "n", "token"])

    return texts.select("node", "text").mapInArrow(run, "node long, n long, token long")


def _prefixes(texts: DataFrame, percent: int) -> DataFrame:
    """(token, node, n, place) of shared shingles inside the probing prefix, rarest first."""
    rows = _shingles(texts)
    shared = rows.groupBy("token").agg(F.count(F.lit(1)).alias("times")).filter("times > 1")
    found = rows.join(spill(shared, "linking-shared"), "token")
    inside = Window.partitionBy("node")
    n, alone = F.col("n"), F.col("n") - F.count(F.lit(1)).over(inside)
    place = F.row_number().over(inside.orderBy("times", "token"))
    probing = n - F.ceil(n * percent / 100) + 1
    return (
        found.withColumn("alone", alone)
        .withColumn("place", F.col("alone") + place)
        .filter(F.col("place") <= probing)
        .select("token", "node", "n", "place")
    )


def prefix_pairs(
    posted: DataFrame, labels: DataFrame | None, sets: DataFrame, percent: int
) -> DataFrame:
    """(a, b): what the open lists still hold, exactly; see the module's description."""
    members = _open_lists(posted, labels).select(F.col("node").alias("__node")).distinct()
    members = spill(members, "linking-open")
    texts = sets.join(members, F.col("node") == F.col("__node"), "left_semi")
    again = spill(_prefixes(texts, percent), "linking-prefixes")
    rows = spill(_open_lists(again, labels), "linking-rows")

    n, place = F.col("n"), F.col("place")
    whole = 100 + percent
    # Sizes of the other set for which this place leaves room, if all that follows is shared.
    room = F.floor((whole * (n - place + 1)) / percent).cast("long") - n
    least = F.ceil(n * percent / 100).cast("long")

    def bucket(size: Column) -> Column:
        return F.floor(F.log(size.cast("double")) / _SIZE_STEP).cast("int")

    most = F.least(n, room)
    probes = (
        rows.filter(most >= least)
        .withColumn("most", most)
        .withColumn("bucket", F.explode(F.sequence(bucket(least), bucket(most))))
    )
    indexing = n - F.ceil(2 * percent * n / whole) + 1
    index = rows.filter(place <= indexing).select(
        "token",
        bucket(n).alias("bucket"),
        F.col("node").alias("b"),
        F.col("component").alias("component2"),
        F.col("n").alias("n2"),
        F.col("place").alias("place2"),
        "main",
    )
    shorter = (F.col("n2") < n) | ((F.col("n2") == n) & (F.col("b") < F.col("node")))
    overlap = 1 + F.least(n - place, F.col("n2") - F.col("place2"))
    enough = whole * overlap >= percent * (n + F.col("n2"))
    wanted = (F.col("component") != F.col("component2")) & _fits(percent) & shorter & enough

    def met(left: DataFrame, right: DataFrame) -> DataFrame:
        return left.drop("main").join(right.drop("main"), ["token", "bucket"]).filter(wanted)

    outside, inside = "component != main", "component = main"
    pairs = met(probes.filter(outside), index).unionByName(
        met(probes.filter(inside), index.filter("component2 != main"))
    )
    return pairs.select(F.col("node").alias("a"), "b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(doc_id, component) of all ends of links; smallest label, with pointer jumping."""
    ends = spill(
        links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct(), "linking-ends"
    )
    first = ends.groupBy(F.col("a").alias("doc_id")).agg(F.min("b").alias("b"))
    labels = spill(first.select("doc_id", F.least("doc_id", "b").alias("component")), "linking-labels")
    while True:
        around = (
            ends.join(labels, ends["b"] == labels["doc_id"])
            .groupBy("a")
            .agg(F.min("component").alias("other"))
        )
        lower = labels.join(around, F.col("doc_id") == F.col("a")).select(
            "doc_id",
            F.col("component").alias("before"),
            F.least("component", "other").alias("component"),
        )
        jump = labels.select(F.col("doc_id").alias("__to"), F.col("component").alias("__next"))
        moved = spill(
            lower.join(jump, F.col("component") == F.col("__to"), "left").select(
                "doc_id", "before", F.least("component", "__next").alias("component")
            ),
            "linking-labels",
        )
        changed = moved.filter("before != component").limit(1).count()
        labels = moved.drop("before")
        if not changed:
            return labels


def linked(
    posted: DataFrame,
    sets: DataFrame,
    percent: int,
    screen: Screen = sketched,
    stars: int = STARS,
) -> tuple[DataFrame, DataFrame]:
    """Labels (doc_id = node, component) of all linked nodes, and the links (a, b) behind them.

    ``screen`` leaves the candidates (a, b) that are worth a look at their full sets.  More turns
    of ``stars`` leave fewer members of a large group to the exact rest; no result depends on them.
    """
    labels = links = None
    for turn in range(stars + 1):
        if turn < stars:
            pairs = star_pairs(posted, labels, turn, percent)
        else:
            pairs = prefix_pairs(posted, labels, sets, percent)
        found = spill(confirmed(pairs, sets, percent, screen), "linking-links")
        if labels is None or not found.isEmpty():
            links = found if links is None else links.unionByName(found)
            labels = components(links)
    return labels, links


def placed(rows: DataFrame, nodes: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest id of its component), kept."""
    component = F.col("node")
    if labels is not None:
        own = labels.select(F.col("doc_id").alias("__of"), "component")
        nodes = nodes.join(own, F.col("node") == F.col("__of"), "left")
        component = F.coalesce("component", "node")
    members = spill(nodes.select("node", component.alias("component"), "first"), "linking-members")
    smallest = members.groupBy("component").agg(F.min("first").alias("least"))
    groups = members.join(smallest, "component").select(F.col("node").alias("__of"), "least")
    component_id = F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(F.col("doc_id"))
    return (
        rows.join(spill(groups, "linking-groups"), F.col("node") == F.col("__of"), "left")
        .withColumn("component_id", component_id)
        .select(
            "doc_id",
            "n_shingles",
            "component_id",
            ((F.col("n_shingles") == 0) | F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("kept"),
        )
    )
