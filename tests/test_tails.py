"""Stored histories: any cut of the log into batches gives the history of the whole log."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from touchline.operators import tails
from touchline.operators.history import history_from_changes
from touchline.operators.tails import History, read_history
from touchline.sinks.snapshots import Snapshots, ripe

T0 = datetime(2024, 8, 1)
DDL = "k INT, seq TIMESTAMP, v STRING"


def frame(spark, entries):
    return spark.createDataFrame([(k, T0 + timedelta(days=n), v) for k, n, v in entries], DDL)


def stored(spark, root, layout, **options):
    return History(Snapshots(spark, root), "history", layout, ["k"], "seq", buckets=3, **options)


def batches(spark, root, parts, **options):
    for part in parts:
        df = frame(spark, part)
        history = stored(spark, root, df.schema, **options)
        base = history.snapshots.newest()
        history.snapshots.commit(base, history.advanced(base, df))


def log(seed, n=60, keys=(1, 2, 3, 4, None)):
    rng = random.Random(seed)
    return [(rng.choice(keys), rng.randrange(25), rng.choice(["a", "b", None, "x"])) for _ in range(n)]


@pytest.mark.parametrize("order", ["in order", "late"])
@pytest.mark.parametrize("deleted", [None, "v = 'x'"])
def test_batches_equal_the_whole_log(spark, rows, tmp_path, order, deleted):
    entries = log(5)
    if order == "in order":
        entries.sort(key=lambda e: e[1])
    gone = None if deleted is None else F.expr(deleted)
    parts = [entries[i : i + 15] for i in range(0, 60, 15)]
    batches(spark, str(tmp_path), parts, delete_when=gone)
    want = history_from_changes(frame(spark, entries), ["k"], "seq", delete_when=gone)
    assert rows(read_history(spark, str(tmp_path))) == rows(want)


def test_the_same_batch_twice_changes_nothing(spark, rows, tmp_path):
    entries = log(7, 30)
    batches(spark, str(tmp_path), [entries, entries[10:20]])
    want = history_from_changes(frame(spark, entries), ["k"], "seq")
    assert rows(read_history(spark, str(tmp_path))) == rows(want)


def test_merged_parts_keep_the_history(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(tails, "ripe", lambda parts: ripe(parts, 2))
    entries = log(9, 40)
    batches(spark, str(tmp_path), [entries[i : i + 8] for i in range(0, 40, 8)])
    want = history_from_changes(frame(spark, entries), ["k"], "seq")
    assert rows(read_history(spark, str(tmp_path))) == rows(want)
    parts = Snapshots(spark, str(tmp_path)).newest().parts("history_log")
    assert max(p.notes["level"] for p in parts.values()) > 0


def test_rows_in_order_read_no_closed_versions(spark, tmp_path, monkeypatch):
    """A later row of one key reads the open part of its bucket and no log but its own."""
    entries = [(k, n, "ab"[n % 2]) for k in range(9) for n in range(10)]
    batches(spark, str(tmp_path), [[e for e in entries if e[1] < 5], [e for e in entries if e[1] >= 5]])
    read = []
    plain = Snapshots.read
    monkeypatch.setattr(Snapshots, "read", lambda s, parts, *a: read.append(set(parts)) or plain(s, parts, *a))
    batches(spark, str(tmp_path), [[(4, 20, "z")]])
    came, versions, tail = read[0], read[1], read[2]
    (bucket,) = came
    assert versions == {f"{bucket}.open"} and tail == came
    read.clear()
    batches(spark, str(tmp_path), [[(4, 7, "late")]])  # reaches back into the second batch only
    closed = [n for n in read[1] if ".closed." in n]
    assert closed and len(closed) < len([n for n in Snapshots(spark, str(tmp_path)).newest().parts("history")
                                         if n.startswith(f"{bucket}.closed")]) + 1
    want = history_from_changes(frame(spark, [*entries, (4, 20, "z"), (4, 7, "late")]), ["k"], "seq")
    assert read_history(spark, str(tmp_path)).exceptAll(want).count() == 0
    assert want.exceptAll(read_history(spark, str(tmp_path))).count() == 0


def test_failed_batch_leaves_the_history(spark, rows, tmp_path, monkeypatch):
    batches(spark, str(tmp_path), [[(1, 1, "a")]])
    before = rows(read_history(spark, str(tmp_path)))
    with monkeypatch.context() as patch:
        patch.setattr(Snapshots, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            batches(spark, str(tmp_path), [[(1, 2, "b")]])
    assert rows(read_history(spark, str(tmp_path))) == before
    with pytest.raises(PySparkException, match="null in seq"):
        nulls = spark.createDataFrame([(1, None, "c")], DDL)
        history = stored(spark, str(tmp_path), nulls.schema)
        history.advanced(history.snapshots.newest(), nulls)
    batches(spark, str(tmp_path), [[(1, 2, "b")]])
    assert read_history(spark, str(tmp_path)).count() == 2


def test_empty_batches(spark, rows, tmp_path):
    batches(spark, str(tmp_path), [[], [(1, 1, "a")], []])
    assert rows(read_history(spark, str(tmp_path)), "k", "v") == [(1, "a")]


@pytest.mark.parametrize("kind", ["STRING", "DATE", "BIGINT", "DECIMAL(9,2)", "TIMESTAMP_NTZ"])
def test_any_orderable_sequence(spark, rows, tmp_path, kind):
    def typed(entries):
        df = spark.createDataFrame(entries, "k INT, seq INT, v STRING")
        if kind in ("DATE", "TIMESTAMP_NTZ"):
            return df.withColumn("seq", F.date_add(F.lit("2024-01-01"), F.col("seq")).cast(kind))
        text = F.lpad(F.col("seq").cast("string"), 5, "0")
        return df.withColumn("seq", text if kind == "STRING" else F.col("seq").cast(kind))

    entries = log(11, 30, keys=(1, 2))
    for part in (entries[:10], entries[10:20], entries[20:]):
        df = typed(part)
        history = stored(spark, str(tmp_path), df.schema)
        base = history.snapshots.newest()
        history.snapshots.commit(base, history.advanced(base, df))
    want = history_from_changes(typed(entries), ["k"], "seq")
    assert rows(read_history(spark, str(tmp_path))) == rows(want)
