"""Physical plans: nothing data-sized in one task, no pairwise joins, narrow scans."""

import os
import re

import pytest
from pyspark.sql import functions as F

from touchline.operators import progress
from touchline.scratch import spill
from workload import queries as q
from workload.frames import table

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="tables not present")

SHUFFLED = (
    "dim_leagues dim_teams dim_fixtures dim_fixture_stats fact_match_result fact_team_result "
    "team_result_summary fact_match_stats team_match_stats goals_by_team_fixture wdl_crosscheck "
    "pivot_events scd2_events scd2_hot_keys scd2_snapshot upsert_coalesce mark_fetched "
    "reset_tracking reconcile untracked next_batch raw_fixture_to_silver raw_stats_to_silver"
).split()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("name", SHUFFLED)
def test_large_side_plans(no_broadcast, name):
    """With every dimension too large to broadcast, only slice offsets still are."""
    text = plan(q.QUERIES[name](no_broadcast, SF_DIR))
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    lines = text.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:  # only below an aggregate's partial result
            assert "Aggregate" in lines[i + 1], text
        if "BroadcastExchange" in line:
            assert "__slice" in "".join(lines[i : i + 4]), text


def test_scans_are_narrow(spark):
    text = plan(q.goals_by_team_fixture(spark, SF_DIR))
    read = re.search(r"ReadSchema: struct<([^>]*)", text).group(1)
    assert "o_orderpriority" not in read and "o_orderdate" not in read


def test_filters_reach_the_scan(spark):
    tracking = table(spark, SF_DIR, "orders").select(
        F.col("o_orderkey").alias("fixture_id"), F.col("o_custkey").alias("league_id")
    )
    assert "EqualTo(o_custkey,7)" in plan(progress.of_league(tracking, 7))
    assert "EqualTo(o_orderkey,11)" in plan(progress.fixture_status(tracking, 11))


def test_top_k_does_not_sort_everything(spark):
    assert "TakeOrderedAndProject" in plan(q.next_batch(spark, SF_DIR))


def test_team_summary_combines_before_the_shuffle(spark):
    text = plan(q.team_result_summary(spark, SF_DIR))
    assert text.index("partial_count") > text.index("Exchange hashpartitioning(dim_team_key")


def test_few_updates_leave_a_large_target_unshuffled(spark):
    target = table(spark, SF_DIR, "orders").select("o_orderkey", "o_orderstatus")
    updates = spill(target.filter("o_orderstatus = 'P'").limit(3), "updates")
    merged = plan(progress.upsert(target, updates, ["o_orderkey"], few=True))
    assert "Exchange hashpartitioning" not in merged


def test_upsert_reads_its_target_once(spark):
    target = table(spark, SF_DIR, "orders").select("o_orderkey", "o_orderstatus")
    updates = spill(target.limit(3), "updates")
    assert plan(progress.upsert(target, updates, ["o_orderkey"])).count("orders.parquet") == 1
