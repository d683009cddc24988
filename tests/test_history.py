"""K1-K3"""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from touchline.operators.history import (
    current,
    history_from_changes,
    history_from_snapshot,
    newest_per_key,
)

DAY = datetime(2024, 8, 1)
PARTITIONS = "spark.sql.shuffle.partitions"
COALESCE = "spark.sql.adaptive.coalescePartitions.enabled"


def at(n):
    return DAY + timedelta(days=n)


def log(spark, entries):
    return spark.createDataFrame(
        [(k, at(n), v) for k, n, v in entries], "k INT, seq TIMESTAMP, v STRING"
    )


def versions(df):
    return sorted(
        (r.k, r.v, (r["__START_AT"] - DAY).days, r["__END_AT"] and (r["__END_AT"] - DAY).days)
        for r in df.collect()
    )


def brute(entries):
    """Versions by walking the sorted log in Python."""
    found = []
    for key in {k for k, _, _ in entries}:
        latest = {}
        for _, n, v in sorted((e for e in entries if e[0] == key), key=lambda e: (e[2] is not None, e[2] or "")):
            latest[n] = v
        opened = []
        for n in sorted(latest):
            if not opened or opened[-1][1] != latest[n]:
                opened.append((n, latest[n]))
        ends = [n for n, _ in opened[1:]] + [None]
        found += [(key, v, n, e) for (n, v), e in zip(opened, ends)]
    return sorted(found, key=str)


@pytest.mark.parametrize(
    ("entries", "want"),
    [
        ([(1, 0, "a")], [(1, "a", 0, None)]),
        ([(1, 0, "a"), (1, 1, "a")], [(1, "a", 0, None)]),
        ([(1, 0, "a"), (1, 1, "b")], [(1, "a", 0, 1), (1, "b", 1, None)]),
        (
            [(1, 0, "a"), (1, 1, "b"), (1, 2, "a")],
            [(1, "a", 0, 1), (1, "a", 2, None), (1, "b", 1, 2)],
        ),
        # a late row splits what looked like one version
        (
            [(1, 1, "a"), (1, 5, "a"), (1, 3, "b")],
            [(1, "a", 1, 3), (1, "a", 5, None), (1, "b", 3, 5)],
        ),
        ([(1, 1, "a"), (1, 1, "b")], [(1, "b", 1, None)]),
    ],
)
def test_change_cases(spark, entries, want):
    assert versions(history_from_changes(log(spark, entries), ["k"], "seq")) == want


def test_nulls_are_values(spark):
    df = log(spark, [(1, 0, None), (1, 1, None), (1, 2, "x"), (1, 3, None)])
    got = history_from_changes(df, ["k"], "seq").orderBy("__START_AT").collect()
    assert [r.v for r in got] == [None, "x", None]


def test_every_sequence_value_is_a_version_when_nothing_is_ignored(spark):
    df = log(spark, [(1, 0, "a"), (1, 1, "a")])
    assert versions(history_from_changes(df, ["k"], "seq", ignore=())) == [
        (1, "a", 0, 1), (1, "a", 1, None),
    ]


def test_tie_break_comes_before_the_other_columns(spark):
    df = spark.createDataFrame(
        [(1, at(0), "z", "file1"), (1, at(0), "a", "file2")],
        "k INT, seq TIMESTAMP, v STRING, f STRING",
    )
    got = history_from_changes(df, ["k"], "seq", ["seq", "f"], ["f"]).collect()
    assert [r.v for r in got] == ["a"]


@pytest.mark.parametrize("slices", [1, 4, 23])
def test_against_brute_force_with_hot_keys(spark, slices):
    rng = random.Random(5)
    entries = []
    for _ in range(400):
        key = 1 if rng.random() < 0.4 else rng.randrange(2, 40)
        entries.append((key, rng.randrange(120), rng.choice("abc")))
    old = {k: spark.conf.get(k) for k in (PARTITIONS, COALESCE)}
    spark.conf.set(PARTITIONS, str(slices))
    spark.conf.set(COALESCE, "false")
    try:
        got = versions(history_from_changes(log(spark, entries), ["k"], "seq"))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sorted(got, key=str) == brute(entries)


@pytest.mark.parametrize("kind", ["int", "bigint", "string", "date", "timestamp_ntz"])
def test_sequence_types_and_null_keys(spark, kind):
    rows = [(k, n, "ab"[n // 20 % 2]) for n in range(100) for k in (1, None)]
    df = spark.createDataFrame(rows, "k INT, n INT, v STRING")
    seq = {
        "int": F.col("n"),
        "bigint": F.col("n") + F.lit(1 << 60),
        "string": F.lpad(F.col("n").cast("string"), 4, "0"),
    }.get(kind, F.date_add(F.lit(DAY).cast("date"), F.col("n")).cast(kind if kind[0] in "dt" else "date"))
    got = history_from_changes(df.select("k", seq.alias("seq"), "v"), ["k"], "seq").collect()
    for key in (1, None):
        mine = sorted((r for r in got if r.k == key), key=lambda r: r["__START_AT"])
        assert [r.v for r in mine] == list("ababa")
        assert all(a["__END_AT"] == b["__START_AT"] for a, b in zip(mine, mine[1:]))
        assert mine[-1]["__END_AT"] is None


def test_hot_key_with_one_sequence_value(spark):
    df = log(spark, [(1, 0, "abc"[i % 3]) for i in range(50)])
    assert versions(history_from_changes(df, ["k"], "seq")) == [(1, "c", 0, None)]


def test_intervals_have_no_gaps_and_one_is_open(spark):
    rng = random.Random(9)
    entries = [(rng.randrange(5), rng.randrange(50), rng.choice("ab")) for _ in range(200)]
    got = versions(history_from_changes(log(spark, entries), ["k"], "seq"))
    for key in {g[0] for g in got}:
        mine = sorted((g for g in got if g[0] == key), key=lambda g: g[2])
        assert all(a[3] == b[2] for a, b in zip(mine, mine[1:]))
        assert [g[3] for g in mine].count(None) == 1


def test_newest_per_key(spark, rows):
    df = log(spark, [(1, 0, "z"), (1, 2, "a"), (2, 1, "b"), (2, 1, "c"), (2, 1, "c")])
    assert rows(newest_per_key(df, ["k"], ["seq"]), "k", "v") == [(1, "a"), (2, "c")]
    assert newest_per_key(df.select("k"), ["k"]).count() == 2


def snap(spark, pairs):
    return spark.createDataFrame(pairs, "k INT, v STRING")


def test_snapshots(spark):
    first = history_from_snapshot(None, snap(spark, [(1, "a"), (2, "b"), (3, None)]), ["k"], F.lit(at(0)))
    assert versions(first.filter("k < 3")) == [(1, "a", 0, None), (2, "b", 0, None)]
    second = history_from_snapshot(first, snap(spark, [(1, "a"), (3, "c"), (4, "d")]), ["k"], F.lit(at(1)))
    third = history_from_snapshot(second, snap(spark, [(1, "x"), (2, "b"), (3, "c"), (4, "d")]), ["k"], F.lit(at(2)))
    got = [(r.k, r.v, (r["__START_AT"] - DAY).days, r["__END_AT"] and (r["__END_AT"] - DAY).days)
           for r in third.collect()]
    assert sorted(got, key=str) == sorted([
        (1, "a", 0, 2), (1, "x", 2, None),      # changed later
        (2, "b", 0, 1), (2, "b", 2, None),      # missing, then back
        (3, None, 0, 1), (3, "c", 1, None),     # null to value
        (4, "d", 1, None),                      # new
    ], key=str)
    assert current(third).count() == 4


def test_snapshot_ignores_named_columns(spark):
    first = history_from_snapshot(None, snap(spark, [(1, "a")]), ["k"], F.lit(at(0)))
    second = history_from_snapshot(first, snap(spark, [(1, "b")]), ["k"], F.lit(at(1)), ["v"])
    assert versions(second) == [(1, "a", 0, None)]


def test_snapshot_refusals(spark):
    twice = snap(spark, [(1, "a"), (1, "b")])
    with pytest.raises(PySparkException, match="key twice"):
        history_from_snapshot(None, twice, ["k"], F.lit(at(0))).collect()
    first = history_from_snapshot(None, snap(spark, [(1, "a")]), ["k"], F.lit(at(3)))
    with pytest.raises(PySparkException, match="not newer"):
        history_from_snapshot(first, snap(spark, [(1, "b")]), ["k"], F.lit(at(3))).collect()


def test_null_key_of_a_snapshot_stays_open(spark):
    one = spark.createDataFrame([(None, "a"), (1, "b")], "k INT, v STRING")
    first = history_from_snapshot(None, one, ["k"], F.lit(at(0)))
    second = history_from_snapshot(first, one, ["k"], F.lit(at(1)))
    assert second.count() == 2 and current(second).count() == 2
