"""Change history: slowly changing dimensions of type 2 (K1-K3)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from touchline.scratch import spill

START, END = "__START_AT", "__END_AT"


def newest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the largest by ``order``, then by the remaining columns.

    The comparison uses every column, so the choice never depends on the row order.  It
    is a plain maximum: copies are reduced before the shuffle.
    """
    rest = [c for c in df.columns if c not in {*keys, *order}]
    if not order and not rest:
        return df.distinct()
    best = df.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("__best"))
    return best.select(
        *[F.col(c) if c in keys else F.col("__best")[c].alias(c) for c in df.columns]
    )


def current(history: DataFrame) -> DataFrame:
    """K3: open versions only."""
    return history.filter(F.col(END).isNull())


def history_from_changes(
    changes: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    ignore: Sequence[str] | None = None,
    tie_break: Sequence[str] = (),
    delete_when: Column | None = None,
) -> DataFrame:
    """K1: all versions of each key from the full log of its changes.

    Rows of one key are ordered by ``sequence_by``; a row opens a version when a column
    outside ``keys`` and ``ignore`` differs (nulls equal) from the row before, and the next
    version closes it.  By default only the sequence column is ignored; pass ``()`` to make
    every new sequence value a version.  Working from the log makes late and out-of-order
    rows exact.  Equal sequence values of a key are reduced to one row by ``tie_break`` and
    then by all columns.  A row for which ``delete_when`` holds closes the version before it
    and opens none; the next other row of the key opens one again, whatever it says.

    Works for any orderable sequence and for null keys, by one way at every size: rows are
    dealt by range of key and sequence and written to scratch, so a key with many changes
    spreads over slices by itself.  States and ends are found inside the slices, in one
    exchange; one row per slice carries the last state, and the next turn, across its border.
    """
    ignored = {sequence_by} if ignore is None else set(ignore)
    tracked = [c for c in changes.columns if c not in {*keys, *ignored}]
    order = [*keys, sequence_by]
    deleted = F.lit(False) if delete_when is None else F.coalesce(delete_when, F.lit(False))
    rows = newest_per_key(changes, order, tie_break).withColumn("__gone", deleted)
    sliced = rows.repartitionByRange(*order).withColumn("__slice", F.spark_partition_id())
    sliced = spill(sliced, "history-slices")
    key, state = F.struct(*keys), _state(tracked)
    if delete_when is not None:  # a deletion is a state of its own, whatever its row holds
        state = F.when(~F.col("__gone"), state)
    place = F.struct(*order)
    across = Window.orderBy("__slice")  # one row per slice: at most the shuffle partitions
    in_slice = Window.partitionBy("__slice", *keys).orderBy(sequence_by)

    last = sliced.groupBy("__slice").agg(
        F.max_by(F.struct(key.alias("key"), state.alias("state")), place).alias("__last")
    )
    entered = last.select(
        F.col("__slice").alias("__of"),
        F.lag("__last").over(across)["key"].alias("__key"),
        F.lag("__last").over(across)["state"].alias("__entry"),
    )
    # The join comes first, so that the windows share one exchange and one sort.
    turns = (
        sliced.join(F.broadcast(entered), F.col("__slice") == F.col("__of"))
        .withColumn("__first", F.row_number().over(in_slice) == 1)
        .withColumn("__before", F.lag(state).over(in_slice))
        .withColumn(
            "__before",
            F.when(~F.col("__first"), F.col("__before")).when(
                F.col("__key").eqNullSafe(key), F.col("__entry")
            ),
        )
        .filter(~F.col("__before").eqNullSafe(state))
        .withColumn("__next_turn", F.lead(sequence_by).over(in_slice))
        .select(*changes.columns, "__gone", "__slice", "__next_turn")
    )
    turns = spill(turns, "history-turns")

    begins = turns.groupBy("__slice").agg(
        F.min_by(F.struct(key.alias("key"), F.col(sequence_by).alias("begin")), place).alias("__begin")
    )
    following = begins.select(
        F.col("__slice").alias("__of"),
        F.lead("__begin").over(across)["key"].alias("__key"),
        F.lead("__begin").over(across)["begin"].alias("__next"),
    )
    # Null sequence values come first, so a missing next turn means the last one of its slice.
    beyond = F.when(F.col("__key").eqNullSafe(key), F.col("__next"))
    return (
        turns.join(F.broadcast(following), F.col("__slice") == F.col("__of"))
        .filter(~F.col("__gone"))
        .select(
            *changes.columns,
            F.col(sequence_by).alias(START),
            F.coalesce("__next_turn", beyond).alias(END),
        )
    )


def _state(tracked: Sequence[str]) -> Column:
    return F.struct(*tracked) if tracked else F.struct(F.lit(True).alias("__present"))


def history_from_snapshot(
    history: DataFrame | None,
    snapshot: DataFrame,
    keys: Sequence[str],
    at: Column,
    ignore: Sequence[str] = (),
) -> DataFrame:
    """K2: the history after one full snapshot taken at ``at``.

    A new key opens a version, a changed row closes its version and opens another, a key
    that is missing closes.  Open versions meet the snapshot in one full outer join; closed
    versions pass through untouched.  A key twice in one snapshot, or a snapshot that is not
    newer than an open version, is refused when the result is computed.  A null key is a key
    like any other.
    """
    columns = snapshot.columns
    fresh = F.struct(*columns, at.alias(START), F.lit(None).alias(END))
    if history is None:
        ends = snapshot.select(at.alias(START)).schema[START].dataType
        return _one_row_per_key(snapshot, keys).select(
            *columns, at.alias(START), F.lit(None).cast(ends).alias(END)
        )

    tracked = [c for c in columns if c not in {*keys, *ignore}]
    ends = history.schema[END].dataType
    fresh = F.struct(*columns, at.cast(ends).alias(START), F.lit(None).cast(ends).alias(END))
    old = current(history).select(
        *[F.col(k).alias(f"__old_{k}") for k in keys], F.struct(*columns, START, END).alias("__old")
    )
    new = _one_row_per_key(snapshot, keys).select(
        *[F.col(k).alias(f"__new_{k}") for k in keys], fresh.alias("__new")
    )

    def values(side: str) -> Column:
        return F.struct(*[F.col(side)[c].alias(c) for c in [*keys, *tracked]])

    had, has = F.col("__old").isNotNull(), F.col("__new").isNotNull()
    same = had & has & values("__old").eqNullSafe(values("__new"))
    stale = F.raise_error(F.lit("snapshot is not newer than an open version")).cast(ends)
    closing = F.when(F.col("__old")[START] >= at.cast(ends), stale).otherwise(at.cast(ends))
    outcome = F.array(
        F.when(had, F.col("__old").withField(END, F.when(~same, closing))),
        F.when(has & ~same, F.col("__new")),
    )
    same_key = reduce(
        lambda a, b: a & b, (F.col(f"__old_{k}").eqNullSafe(F.col(f"__new_{k}")) for k in keys)
    )
    moved = old.join(new, same_key, "full_outer").select(
        F.inline(F.filter(outcome, lambda v: v.isNotNull()))
    )
    closed = history.filter(F.col(END).isNotNull())
    return closed.select(*columns, START, END).unionByName(moved)


def _one_row_per_key(snapshot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The snapshot itself; fails when it holds a key twice."""
    grouped = snapshot.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__copies"), F.first(F.struct(*snapshot.columns)).alias("__row")
    )
    checked = F.when(
        F.col("__copies") > 1, F.raise_error(F.lit("snapshot holds a key twice"))
    ).otherwise(F.col("__row"))
    return grouped.select(checked.alias("__row")).select("__row.*")
