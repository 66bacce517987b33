from datetime import date

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from riskpanel.operators.staging import incremental_range, incremental_stage
from riskpanel.sources import (
    SourceConfig, audit_counts, delete_statement, jdbc_options, jdbc_predicates, read_panel, read_snapshot, source_max_date,
    staging_watermark, warehouse_options, write_partitions, write_snapshot,
)

from tests.frames import collect, panel


def store(spark, path, days, **values):
    panel(spark, [{"fecha": d, **values} for d in days]).write.mode("overwrite").parquet(str(path))
    return SourceConfig(path=str(path))


def staged_days(spark, path):
    return [r[0] for r in collect(read_panel(spark, str(path)), "fecha")]


def march(*days):
    return [date(2024, 3, d) for d in days]


def test_range():
    assert incremental_range(date(2024, 3, 5), None) == (date(2024, 2, 4), date(2024, 3, 5))
    assert incremental_range(date(2024, 3, 5), date(2024, 3, 4)) == (date(2024, 3, 5), date(2024, 3, 5))
    assert incremental_range(date(2024, 3, 5), date(2024, 3, 5)) is None
    assert incremental_range(date(2024, 3, 5), date(2024, 3, 5), lookback_days=3)[0] == date(2024, 3, 3)


def test_load_in_the_middle_of_a_month_keeps_its_earlier_days(spark, tmp_path):
    staging = str(tmp_path / "staging")
    incremental_stage(spark, store(spark, tmp_path / "s1", march(1, 2, 3, 4)), staging)
    second = incremental_stage(spark, store(spark, tmp_path / "s2", march(1, 2, 3, 4, 5)), staging)
    assert staged_days(spark, staging) == march(1, 2, 3, 4, 5)
    assert (second.start, second.end, second.rows) == (date(2024, 3, 5), date(2024, 3, 5), 1)


def test_days_that_the_source_has_dropped_stay_staged(spark, tmp_path):
    staging = str(tmp_path / "staging")
    incremental_stage(spark, store(spark, tmp_path / "s1", march(1, 2, 3)), staging)
    incremental_stage(spark, store(spark, tmp_path / "s2", march(4)), staging)
    assert staged_days(spark, staging) == march(1, 2, 3, 4)


def test_unreadable_values_stop_a_load_unless_allowed(spark, tmp_path):
    path, staging = str(tmp_path / "s"), str(tmp_path / "staging")
    rows = panel(spark, [{"fecha": march(1)[0]}, {"fecha": march(2)[0]}])
    rows.withColumn("retorno", F.when(F.col("fecha") == march(2)[0], "1,5").otherwise("0.01")).write.parquet(path)
    with pytest.raises(Exception, match="unreadable value in retorno: 1,5"):
        incremental_stage(spark, SourceConfig(path=path), staging)
    loaded = incremental_stage(spark, SourceConfig(path=path, allow_unreadable=True), staging)
    assert (loaded.rows, loaded.unreadable) == (2, 1)
    assert {r.retorno for r in read_panel(spark, staging).collect()} == {None, 0.01}


def test_repeated_and_empty_loads(spark, tmp_path):
    staging = str(tmp_path / "staging")
    source = store(spark, tmp_path / "s", march(1, 2))
    assert incremental_stage(spark, source, staging).rows == 2
    assert incremental_stage(spark, source, staging) is None
    assert incremental_stage(spark, source, staging, lookback_days=2).rows == 2
    assert staged_days(spark, staging) == march(1, 2)


def test_lookback_picks_up_late_rows(spark, tmp_path):
    staging = str(tmp_path / "staging")
    incremental_stage(spark, store(spark, tmp_path / "s1", march(1, 3)), staging)
    incremental_stage(spark, store(spark, tmp_path / "s2", march(1, 2, 3)), staging, lookback_days=2)
    assert staged_days(spark, staging) == march(1, 2, 3)


def test_bootstrap_length(spark, tmp_path):
    source = store(spark, tmp_path / "s", [date(2023, 1, 10), date(2024, 1, 10), date(2024, 3, 10)])
    incremental_stage(spark, source, str(tmp_path / "short"))
    incremental_stage(spark, source, str(tmp_path / "long"), bootstrap_days=90)
    assert staged_days(spark, tmp_path / "short") == [date(2024, 3, 10)]
    assert staged_days(spark, tmp_path / "long") == [date(2024, 1, 10), date(2024, 3, 10)]


def test_only_a_missing_path_means_a_first_load(spark, tmp_path):
    assert staging_watermark(spark, str(tmp_path / "nothing")) is None
    broken = tmp_path / "broken" / "year=2024" / "month=3"
    broken.mkdir(parents=True)
    (broken / "part.parquet").write_bytes(b"not a parquet file")
    with pytest.raises(Exception) as raised:
        staging_watermark(spark, str(tmp_path / "broken"))
    assert not isinstance(raised.value, AnalysisException) or "PATH_NOT_FOUND" not in str(raised.value)


def test_watermark_reads_the_newest_month(spark, tmp_path):
    df = panel(spark, [{"fecha": date(2023, 12, 31)}, {"fecha": date(2024, 1, 2)}])
    write_partitions(df.withColumn("year", F.year("fecha")).withColumn("month", F.month("fecha")), str(tmp_path / "p"), ["year", "month"])
    assert staging_watermark(spark, str(tmp_path / "p")) == date(2024, 1, 2)


def test_source_without_data_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError):
        source_max_date(spark, store(spark, tmp_path / "s", [None]))


def test_jdbc_scan_is_parallel_over_days():
    source = SourceConfig(url="jdbc:x", user="u", num_partitions=16)
    options = jdbc_options(source, date(2024, 3, 1), date(2024, 3, 5))
    assert options["partitionColumn"] == "fecha" and options["fetchsize"] == "50000"
    assert (options["lowerBound"], options["upperBound"], options["numPartitions"]) == ("2024-03-01", "2024-03-06", "5")
    assert "password" not in options
    with pytest.raises(ValueError):
        SourceConfig()


def test_staging_filters_reach_the_partitions(spark, tmp_path):
    staging = str(tmp_path / "staging")
    incremental_stage(spark, store(spark, tmp_path / "s", march(1, 2)), staging)
    plan = read_panel(spark, staging, start="2024-02-10", end="2024-03-01")._jdf.queryExecution().executedPlan().toString()
    assert "year" in plan.split("PartitionFilters:")[1].split("]")[0]
    assert "fecha" in plan.split("PartitionFilters:")[1].split("DataFilters")[0].split("PushedFilters")[0]


def test_snapshot_replacement_keeps_other_cutoffs_and_clears_with_empty(spark, tmp_path):
    root = str(tmp_path / "snap")
    rows = panel(spark, [{"nemotecnico": "A"}, {"nemotecnico": "B"}])
    write_snapshot(rows, root, "2024-03-14")
    write_snapshot(rows, root, "2024-03-15")
    write_snapshot(rows.filter("nemotecnico = 'A'"), root, "2024-03-15")
    assert read_snapshot(spark, root, "2024-03-14").count() == 2
    assert read_snapshot(spark, root, "2024-03-15").count() == 1
    write_snapshot(rows.filter("false"), root, "2024-03-15")
    assert read_snapshot(spark, root, "2024-03-15").count() == 0
    assert read_snapshot(spark, root, "2024-03-14").count() == 2


def test_a_failed_write_leaves_the_old_snapshot(spark, tmp_path):
    root = str(tmp_path / "snap")
    rows = panel(spark, [{"nemotecnico": "A"}, {"nemotecnico": "B"}])
    write_snapshot(rows, root, "2024-03-15")
    broken = rows.withColumn("retorno", F.expr("if(nemotecnico = 'B', raise_error('lost'), retorno)").cast("double"))
    with pytest.raises(Exception, match="lost"):
        write_snapshot(broken, root, "2024-03-15")
    assert read_snapshot(spark, root, "2024-03-15").count() == 2


def test_jdbc_predicates_split_days_by_instrument():
    source = SourceConfig(url="jdbc:x", bucket_sql="MOD(HASH(nemotecnico), {n})", buckets=3)
    found = jdbc_predicates(source, date(2024, 2, 29), date(2024, 3, 1))
    assert len(found) == 6 and found[0] == "fecha = DATE '2024-02-29' AND MOD(HASH(nemotecnico), 3) = 0"
    assert found[-1] == "fecha = DATE '2024-03-01' AND MOD(HASH(nemotecnico), 3) = 2"


def test_warehouse_sink():
    assert delete_statement("te_pesos_base", {"corte": date(2024, 3, 15)}) == "DELETE FROM te_pesos_base WHERE corte = DATE '2024-03-15'"
    assert delete_statement("t", {"fund_type": "O'B", "corte": "x"}) == "DELETE FROM t WHERE fund_type = 'O''B' AND corte = 'x'"
    options = warehouse_options("jdbc:x", "t", driver="d")
    assert options["dbtable"] == "t" and options["numPartitions"] == "16" and "password" not in options


def test_snapshot_read_prunes_by_cutoff(spark, tmp_path):
    root = str(tmp_path / "snap")
    write_snapshot(panel(spark, [{}]), root, "2024-03-14")
    plan = read_snapshot(spark, root, "2024-03-14")._jdf.queryExecution().executedPlan().toString()
    assert "corte" in plan.split("PartitionFilters:")[1].split("]")[0]


def test_audit_counts(spark):
    df = spark.sql("SELECT DATE'2024-03-15' AS corte UNION ALL SELECT DATE'2024-03-14'")
    assert collect(audit_counts({"x": df, "y": df.filter("false")}, "2024-03-15")) == [("x", 1), ("y", 0)]
