"""Every registered query against its SQL, and the shape of its plan."""

import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry
from obsflow.plans.oracle import ORACLE
from obsflow.plans.registry import QUERIES
from tools.compare import compare, connect

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
ROWS_ONLY = set()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    count, problem = compare(spark, con, FOLDER, name)
    assert not problem and count > 0


def test_every_query_has_sql_where_sql_can_say_it():
    assert set(QUERIES) - set(ORACLE) == ROWS_ONLY
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql()) <= set(entry.queries())


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


STREAMED = {n for n in QUERIES if n.startswith("stream_")} | {"anomaly_log"}


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in STREAMED | ROWS_ONLY])
def test_plans_have_no_products_and_no_python(spark, name):
    plan = plan_of(entry.queries()[name](spark, FOLDER))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "SinglePartition, REPARTITION"):
        assert bad not in plan


def test_scans_read_only_what_is_used(spark):
    plan = plan_of(entry.queries()["weekly_day"](spark, FOLDER))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>" in plan
    plan = plan_of(entry.queries()["count_by_topic_sorted"](spark, FOLDER))
    assert "ReadSchema: struct<event_type:string>" in plan


def test_scoring_join_does_not_move_the_averages_again(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(entry.queries()["flagship_zscore"](spark, FOLDER))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan
    # Averages: slots, then days. Baseline: panes, weeks, then the join.
    assert plan.count("Exchange hashpartitioning") == 5


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert "z_score" in df.columns and df.count() == 341


def test_queries_run_in_a_session_built_elsewhere():
    """A plain session in another zone: the settings that may change are set, the others left."""
    script = (
        "from pyspark.sql import SparkSession\n"
        "import __spark_entry__ as entry\n"
        "from tools.compare import compare, connect\n"
        "builder = SparkSession.builder.master('local[4]').config('spark.ui.enabled', 'false')\n"
        "spark = builder.config('spark.sql.session.timeZone', 'America/New_York').getOrCreate()\n"
        f"con = connect('{FOLDER}')\n"
        "for name in ('flagship_zscore', 'weekly_day', 'stream_weekly'):\n"
        f"    count, problem = compare(spark, con, '{FOLDER}', name)\n"
        "    assert count and not problem, (name, problem)\n"
    )
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", script], cwd=root, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
