"""Mixing sources to target weights by the cube method (op 3).

Targets.  Sources in code-point order (null last) weigh 5, 2, 1, repeating.  They share all
words by weight; a target stops at ``max_repeats`` times its source's size and the excess is
shared again by weight until none is above.

Copies.  A source with target t and size s takes each document t / s times: the whole part
outright, the fraction as an inclusion probability.  A balanced sample decides the rest: the
cube method moves the vector of probabilities along directions that leave the number of
documents and of words unchanged until nearly all are 0 or 1.  Every step takes three open
documents; two constraints leave them one direction; one of the two signs is drawn with the
odds that keep the expectations; at least one document closes.

Scale.  Documents of a source are dealt by a hash of their id into blocks of about
``block`` rows, each balanced on its own in one task; at most two documents per block stay
open, and those are blocked and balanced again, until one block per source is left.  There
``LANDING`` documents spread over the sizes are kept out of the flight; they and the last
one or two open ones are the landing problem: of all their combinations with the owed number
of documents, give or take one, the one nearest to the owed words.  So the error of a source
is a landing's, however many blocks it had, and a source with a third of all rows is a
matter of more blocks.  Only (id, source, size) is ever shuffled.

Draws come from hashes of the ids with a seed, so reruns agree whatever the partitioning.
Rows that repeat an id are separate documents with the same draw, told apart by a running
number within equal (id, size) rows; texts of size 0 take 0 words.

Edge cases: null texts have size 0 and target shares follow sizes alone; a source of size 0
has target 0; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from touchline.llm.common import BLANKS, text_of
from touchline.scratch import spill

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
BLOCK = 4000
LANDING = 12
SEED = 20240
_EPS = 1e-9


def sized(docs: DataFrame, text: str, id_column: str, source: str) -> DataFrame:
    """doc_id, source, size in words."""
    words = F.array_remove(F.split(text_of(text), f"{BLANKS}+"), "")
    return docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.col(source).cast("string").alias("source"),
        F.size(words).cast("long").alias("size"),
    )


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS
) -> DataFrame:
    """Per source: source, source_size, target.

    Sources are ranked by the share of their limit that one unit of weight uses up.  The
    level at which sharing stops is found from running sums over that order, exactly and
    in one pass, however many sources reach their limit.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # Tables of sources, not of rows: one number per source orders them.
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(
        F.array(*(F.lit(float(w)) for w in weights)), (place % len(weights) + 1).cast("int")
    )
    ranked = totals.withColumn("weight", weight).withColumn(
        "cap", F.col("source_size").cast("double") * max_repeats
    )
    order = W.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    after = order.rowsBetween(0, W.unboundedFollowing)
    everything = W.partitionBy()
    ranked = ranked.withColumns(
        {
            "left": F.sum("source_size").over(everything).cast("double")
            - F.coalesce(F.sum("cap").over(before), F.lit(0.0)),
            "open_weight": F.sum("weight").over(after),
        }
    )
    # While all before are at their limits, the level among the rest is left / open_weight;
    # the first source whose limit lies above its share sets it for all that follow.
    level = F.col("left") / F.col("open_weight")
    fits = F.col("cap") >= F.col("weight") * level
    first_fit = F.first(F.when(fits, level), ignorenulls=True).over(
        order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    )
    ranked = ranked.withColumn("level", first_fit)
    target = F.least(F.col("cap"), F.col("weight") * F.coalesce("level", F.lit(float("inf"))))
    return ranked.select("source", "source_size", target.alias("target"))


def _unit(ids: np.ndarray, twins: np.ndarray, step: int) -> np.ndarray:
    """Numbers in [0, 1) from ids; splitmix-style mixing."""
    with np.errstate(over="ignore"):
        x = ids.astype("u8") * np.uint64(0x9E3779B97F4A7C15)
        x += twins.astype("u8") * np.uint64(0xD1B54A32D192ED03) + np.uint64(SEED + 977 * step)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        x ^= x >> np.uint64(31)
    return (x >> np.uint64(11)).astype("f8") / float(1 << 53)


def flight(p: np.ndarray, size: np.ndarray, draw: np.ndarray) -> np.ndarray:
    """Probabilities moved to 0 or 1 but for at most two; sums of p and p * size kept.

    Three open documents a, b, c move along (u, v, w) with u + v + w = 0 and
    u s_a + v s_b + w s_c = 0.  Equal sizes leave the direction (1, -1, 0).
    """
    p = p.copy()
    open_at: list[int] = []
    for i in np.flatnonzero((p > _EPS) & (p < 1 - _EPS)):
        open_at.append(int(i))
        if len(open_at) < 3:
            continue
        a, b, c = open_at
        sa, sb, sc = float(size[a]), float(size[b]), float(size[c])
        move = (sb - sc, sc - sa, sa - sb)
        if move == (0.0, 0.0, 0.0):
            move = (1.0, -1.0, 0.0)
        up = down = float("inf")
        for j, u in zip((a, b, c), move, strict=True):
            if u > 0:
                up, down = min(up, (1 - p[j]) / u), min(down, p[j] / u)
            elif u < 0:
                up, down = min(up, p[j] / -u), min(down, (1 - p[j]) / -u)
        step = up if draw[i] * (up + down) < down else -down
        for j, u in zip((a, b, c), move, strict=True):
            p[j] += step * u
        still = []
        for j in (a, b, c):
            if p[j] <= _EPS:
                p[j] = 0.0
            elif p[j] >= 1 - _EPS:
                p[j] = 1.0
            else:
                still.append(j)
        open_at = still
    return p


def held_back(p: np.ndarray, size: np.ndarray, n: int = LANDING) -> np.ndarray:
    """Positions of ``n`` open documents spread over the sizes, which only the landing closes."""
    at = np.flatnonzero((p > _EPS) & (p < 1 - _EPS))
    by_size = at[np.argsort(size[at], kind="stable")]
    if len(by_size) <= n:
        return by_size
    return by_size[np.linspace(0, len(by_size) - 1, n).round().astype(int)]


def landing(p: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The last open documents closed: of all combinations whose number is within one of what
    they owe, the one nearest to the words they owe."""
    p = p.copy()
    at = np.flatnonzero((p > _EPS) & (p < 1 - _EPS))
    if not len(at):
        return p
    taken = (np.arange(1 << len(at))[:, None] >> np.arange(len(at))) & 1
    off_words = np.abs(taken @ size[at] - p[at] @ size[at])
    off_number = np.abs(taken.sum(axis=1) - p[at].sum())
    p[at] = taken[np.lexsort((off_number, off_words, off_number > 1))[0]]
    return p


_OPEN = "source string, doc_id long, twin long, size long, p double"


def _balance(rows: DataFrame, blocks: int, step: int, last: bool) -> DataFrame:
    """One round: flight in every block of every source; the last round also lands."""

    def run(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["doc_id", "size", "twin"], kind="stable", na_position="last")
        ids = block["doc_id"].fillna(-1).to_numpy("i8")
        twins, size = block["twin"].to_numpy("i8"), block["size"].to_numpy("f8")
        p = block["p"].to_numpy("f8")
        free = np.ones(len(p), bool)
        if last:
            free[held_back(p, size)] = False
        p = p.copy()
        p[free] = flight(p[free], size[free], _unit(ids, twins, step)[free])
        if last:
            p = landing(p, size)
        return block.assign(p=p)[["source", "doc_id", "twin", "size", "p"]]

    block = F.pmod(F.xxhash64("doc_id", "twin", F.lit(step)), F.lit(blocks))
    return rows.groupBy("source", block.alias("block")).applyInPandas(run, _OPEN)


def mixed(
    docs: DataFrame,
    text: str = "text",
    id_column: str = "doc_id",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
    block: int = BLOCK,
) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, copies, taken."""
    sizes = spill(sized(docs, text, id_column, source), "mix-sizes")
    targets = source_targets(sizes, weights, max_repeats).withColumnRenamed("source", "__source")
    targets = spill(targets, "mix-targets")
    # Rows that agree in id, source and size are counted, not numbered in one task.
    counted = sizes.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("times"))
    twin = F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1))
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = (
        counted.select("doc_id", "source", "size", twin.alias("twin"))
        .join(targets, F.col("source").eqNullSafe(F.col("__source")))
        .select(
            "source",
            "doc_id",
            "twin",
            "size",
            "source_size",
            "target",
            F.floor(share + _EPS).alias("whole"),
            F.greatest(share - F.floor(share + _EPS), F.lit(0.0)).alias("p"),
        )
    )
    rows = spill(rows, "mix-shares")
    at_most = rows.groupBy("source").count().agg(F.max("count")).first()[0] or 0
    left = rows.select("source", "doc_id", "twin", "size", "p")
    closed: list[DataFrame] = []
    step = 0
    while True:
        blocks = max(1, -(-at_most // block))
        done = spill(_balance(left, blocks, step, blocks == 1), "mix-round")
        is_open = (F.col("p") > 0) & (F.col("p") < 1)
        closed.append(done.filter(~is_open))
        if blocks == 1:
            break
        left, at_most, step = done.filter(is_open), 2 * blocks, step + 1
    chosen = closed[0]
    for more in closed[1:]:
        chosen = chosen.unionByName(more)
    chosen = chosen.filter("p = 1").select(
        F.col("source").alias("__s"),
        F.col("doc_id").alias("__id"),
        F.col("twin").alias("__twin"),
        F.col("size").alias("__size"),
    )
    same = (
        F.col("doc_id").eqNullSafe(F.col("__id"))
        & (F.col("twin") == F.col("__twin"))
        & (F.col("size") == F.col("__size"))
        & F.col("source").eqNullSafe(F.col("__s"))
    )
    copies = (F.col("whole") + F.col("__id").isNotNull().cast("long")).cast("long")
    return rows.join(chosen, same, "left").select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )
