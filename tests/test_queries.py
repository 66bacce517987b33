"""Every registered query against its SQL, and the shape of its plan."""

import re

import pytest

import __spark_entry__
from riskpanel.catalog.compare import differences
from riskpanel.catalog.inputs import derive_panel
from riskpanel.catalog.oracle import oracle_sql
from riskpanel.catalog.queries import queries
from riskpanel.sources import write_snapshot

SMALL = "/root/testdata/sf0.001"
QUERIES, SQL = queries(), oracle_sql()
FORBIDDEN = re.compile(r"CartesianProduct|BroadcastNestedLoopJoin|EvalPython|InPandas|InArrow|PythonUDF")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_all_queries_have_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(__spark_entry__.queries()) and set(SQL) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("key", list(QUERIES))
def test_query_equals_sql(spark, key):
    result = QUERIES[key](spark, SMALL)
    assert differences(result.toArrow(), SMALL, SQL[key]) is None
    assert not FORBIDDEN.search(plan_of(result))


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_base_returns_read_once_and_shuffle_once(spark):
    plan = plan_of(QUERIES["base_returns_completed"](spark, SMALL))
    initial = plan.split("== Initial Plan ==")[-1]
    assert len(re.findall(r"FileScan parquet", initial)) == 1
    assert len(re.findall(r"Exchange hashpartitioning", initial)) == 1
    assert "partial_sum" in initial


def initial_plan(df) -> str:
    return plan_of(df).split("== Initial Plan ==")[-1]


def scans(df) -> list[str]:
    """The first column that each scan of the initial plan reads."""
    return re.findall(r"FileScan parquet \[(\w+)#", initial_plan(df))


def test_completion_reads_the_history_four_times(spark):
    read = scans(QUERIES["complete_history"](spark, SMALL))
    assert read.count("fecha") == 4 and len(read) == 8  # the others read the stored universe


def test_report_reads_base_returns_four_times(spark):
    assert len(scans(QUERIES["risk_report"](spark, SMALL))) == 4  # returns, weights, their totals, daily sums


def test_summary_reads_one_stored_table_per_rule(spark):
    assert len(scans(QUERIES["qc_summary"](spark, SMALL))) == 9


@pytest.mark.parametrize("key", [k for k in QUERIES if k.endswith("_found") and k != "qc_summary_found"])
def test_every_check_finds_its_disturbance(spark, key):
    rows = QUERIES[key](spark, SMALL).collect()
    assert rows and all(r["violations"] > 0 for r in rows if "violations" in r)


def test_cutoff_weights_push_the_date_to_the_scan(spark):
    plan = plan_of(QUERIES["base_weights"](spark, SMALL))
    assert "EqualTo(fecha,2001-09-17)" in plan


def test_scans_read_only_needed_columns(spark):
    plan = plan_of(QUERIES["beta_summary"](spark, SMALL))
    schema = re.search(r"ReadSchema: (struct<[^>]*>)", plan).group(1)
    assert "return_calc" in schema and "weight_calc" not in schema and "c1:" not in schema


def test_panel_is_dealt_out_once(spark):
    plan = initial_plan(derive_panel(spark, SMALL))
    assert len(re.findall("Exchange hashpartitioning", plan)) == 1 and "REPARTITION_BY_NUM" in plan


def test_dealt_rows_are_written_by_their_tasks(spark, tmp_path):
    rows = spark.range(9).selectExpr("DATE'2024-03-15' AS corte", "date_add(DATE'2024-01-01', CAST(9 - id AS INT)) AS fecha", "id")
    write_snapshot(rows.repartition(3, "id"), str(tmp_path / "t"), "2024-03-15", ["fecha"], dealt=True)
    files = [str(f) for f in tmp_path.glob("t/corte=2024-03-15/*.parquet")]
    days = [[r.fecha for r in spark.read.parquet(f).collect()] for f in files]
    assert len(files) == len({r[0] for r in rows.repartition(3, "id").selectExpr("spark_partition_id()").collect()}) > 1
    assert sum(map(len, days)) == 9 and all(d == sorted(d) for d in days)
