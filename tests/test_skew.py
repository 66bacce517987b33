"""One key holding a third or more of all rows: joins split it, and results stay whole."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from riskpanel import RiskConfig, schemas
from riskpanel.operators import history, imputation, returns

from tests.frames import CORTE, base, collect, completed_row, day, panel_row

CFG = RiskConfig(CORTE)


@contextmanager
def large_cluster(spark):
    """Thresholds of a large input, scaled down: no broadcast by size, small partitions, eager splits."""
    values = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.fixture(scope="module")
def stored_panel(spark, tmp_path_factory):
    """12,000 rows of many instruments and as many of one, on 30 days."""
    template = spark.createDataFrame([tuple(panel_row()[f] for f in schemas.PANEL.fieldNames())], schemas.PANEL)
    many = spark.range(24_000, numPartitions=8).withColumn("hot", F.col("id") % 2 == 0)
    rows = many.join(F.broadcast(template)).withColumns(
        {
            "nemotecnico": F.when(F.col("hot"), F.lit("HOT")).otherwise(F.concat(F.lit("N"), F.expr("id DIV 30"))),
            "fecha": F.date_sub(F.lit(CORTE), F.expr("CAST(id % 60 DIV 2 AS INT)")),
            "retorno": F.when(F.col("id") % 7 > 0, (F.col("id") % 13) / 1000),
            "aporte_retorno": F.rand(7),
        }
    )
    path = str(tmp_path_factory.mktemp("skew") / "panel")
    schemas.conform(rows, schemas.PANEL).write.parquet(path)
    return spark.read.parquet(path)


def run_to_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_real_history_splits_a_hot_instrument(spark, stored_panel):
    plain = history.real_history(stored_panel, CORTE)
    expected = collect(plain.groupBy("nemotecnico").count())
    with large_cluster(spark):
        split = history.real_history(stored_panel, CORTE)
        assert "skew=true" in run_to_plan(split)
        assert collect(split.groupBy("nemotecnico").count()) == expected
    assert dict(expected)["HOT"] == 12_000


def test_completion_splits_a_hot_instrument(spark, stored_panel):
    real = history.real_history(stored_panel, CORTE)
    calendar = spark.createDataFrame([(day(-i), True) for i in range(30)], schemas.CALENDAR)

    def summary(df):
        sums = df.groupBy("nemotecnico", "origen_completado", "jerarquia_usada").agg(F.count("*"), F.round(F.sum("retorno"), 9))
        return collect(sums)

    expected = summary(imputation.complete_history(real, calendar, CORTE, 30))
    with large_cluster(spark):
        split = imputation.complete_history(real, calendar, CORTE, 30)
        assert "skew=true" in run_to_plan(split)
        assert summary(split) == expected


def test_hot_groups_are_combined_before_the_shuffle(spark):
    rows = [completed_row(nemotecnico=str(i), clase="MON", C1="USD") for i in range(3000)] + [completed_row(nemotecnico="X")]
    names = schemas.COMPLETED.fieldNames()
    df = spark.createDataFrame([tuple(r[f] for f in names) for r in rows], schemas.COMPLETED)
    got = returns.base_returns(df, CFG)
    assert collect(got, "asset_key", "source_record_count") == [("MON|USD", 3000), ("X", 1)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan


def test_a_dominating_side_is_not_gathered_by_a_window(spark):
    from riskpanel.operators import weights

    df = base(spark, [{"asset_key": str(i)} for i in range(50)] + [{"manager": "BENCHMARK"}])
    plan = weights.side_weights(df, CFG)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_sum" in plan
