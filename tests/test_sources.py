import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriema.session import scratch_path
from seriema.sources import files, payloads, sinks
from seriema.streaming.ingest import ingest_new_files
from tests.conftest import rows

D = dt.date
RUN = dt.datetime(2024, 1, 2, 3, 4, 5)


def payload(spark, document, **columns):
    text = document if isinstance(document, str) else json.dumps(document)
    names = ", ".join(f"{c} string" for c in columns)
    return spark.createDataFrame([(text, *columns.values())], "payload string" + (", " + names if names else ""))


def test_flat(spark):
    df = payload(spark, [{"data": "01/01/2023", "valor": "0.53"}, {"data": "x", "valor": ""}], indicator="ipca")
    got = payloads.parse_flat(df, keep=("indicator",))
    assert set(rows(got)) == {("ipca", D(2023, 1, 1), 0.53), ("ipca", None, None)}
    assert payloads.parse_flat(payload(spark, "not json")).isEmpty()
    assert payloads.parse_flat(payload(spark, [])).isEmpty()
    assert payloads.name_value_column(got, "ipca").columns == ["indicator", "data", "ipca"]


def sidra(*series):
    return [{"id": "63", "resultados": [{"series": list(series)}, {"series": [{"serie": [{"periodo": "209901", "valor": "9"}]}]}]}]


def test_sidra_list_object_and_plain_forms(spark):
    place = {"localidade": {"id": "1", "nome": "Norte"}}
    listed = {**place, "serie": [{"periodo": "202301", "valor": "0,53"}, {"periodo": "202302", "valor": 0.84}]}
    keyed = {"serie": {"202201": {"data": "2022-01", "valor": "0,54"}, "202202": "1,01"}}
    got = payloads.parse_sidra(payload(spark, sidra(listed, keyed), frequency="monthly"))
    assert sorted(rows(got)) == [
        (D(2022, 1, 1), 0.54, "Brasil"), (D(2022, 2, 1), 1.01, "Brasil"),
        (D(2023, 1, 1), 0.53, "Norte"), (D(2023, 2, 1), 0.84, "Norte")]
    for period, frequency, date in (("2023Q2", "quarterly", D(2023, 4, 1)), ("2023", "annual", D(2023, 1, 1))):
        df = payload(spark, sidra({"serie": [{"periodo": period, "valor": "..."}]}), frequency=frequency)
        assert rows(payloads.parse_sidra(df)) == [(date, None, "Brasil")]
    assert payloads.parse_sidra(payload(spark, [], frequency="monthly")).isEmpty()


def test_pnad(spark):
    document = [{"nome": "População", "valoresDeReferencia": [{"valor": "1"}]},
                {"nome": "Taxa de Desocupação", "valoresDeReferencia": [{"valor": "8.8"}, {"valor": "0"}]},
                {"nome": "desocupados", "valoresDeReferencia": [{"valor": "2"}]}]
    got = payloads.parse_pnad(payload(spark, document, period_id="20232"))
    assert rows(got) == [(D(2023, 4, 1), 8.8, "20232")]
    without = payload(spark, document[:1], period_id="20232")
    assert payloads.parse_pnad(without).isEmpty()
    empty = payload(spark, [{"nome": "Desocupação", "valoresDeReferencia": []}], period_id="202304")
    assert rows(payloads.parse_pnad(empty)) == [(D(2023, 10, 1), None, "202304")]


def test_periods_between(spark):
    df = spark.createDataFrame([("20224",), ("202301",), ("2023Q3",), ("20234",), ("x",)], "period_id string")
    got = payloads.periods_between(df, D(2023, 2, 15), D(2023, 9, 1))
    assert [r[0] for r in rows(got, "period_id")] == ["202301", "2023Q3"]


def layer_rows(spark, *data):
    return spark.createDataFrame(data, "indicator string, value double")


def test_latest_snapshot_matches_names_exactly(spark):
    root = scratch_path(spark, "bronze")
    sinks.write_snapshot(layer_rows(spark, ("pib", 1.0), ("pib_ibge", 2.0)), root, RUN)
    later = RUN + dt.timedelta(seconds=1)
    sinks.write_snapshot(layer_rows(spark, ("pib_ibge", 3.0), ("pib_ibge", 4.0)), root, later)
    got = files.read_latest(spark, root).select("indicator", "value")
    assert rows(got, "indicator", "value") == [("pib", 1.0), ("pib_ibge", 3.0), ("pib_ibge", 4.0)]
    assert files.read_latest(spark, root, ["pib", "absent"]).count() == 1
    assert sorted(r[0] for r in files.discover_indicators(spark, root).collect()) == ["pib", "pib_ibge"]


def test_latest_snapshot_reads_only_its_folders(spark):
    root = scratch_path(spark, "bronze")
    for n in range(3):
        sinks.write_snapshot(layer_rows(spark, ("a", float(n)), ("b", 0.0)), root, RUN + dt.timedelta(seconds=n))
    newest = files.read_latest(spark, root)
    assert all("snapshot_ts=20240102_030407" in f for f in newest.inputFiles()) and len(newest.inputFiles()) == 2
    assert {r.snapshot_ts for r in newest.collect()} == {"20240102_030407"}


def test_snapshots_are_listed_without_reading_data(spark):
    root = scratch_path(spark, "bronze")
    sinks.write_snapshot(layer_rows(spark, ("a/b=c +%", 1.0)).withColumn("source", F.lit("x y")), root, RUN)
    listed = files.snapshots(spark, root)
    plan = listed._jdf.queryExecution().executedPlan().toString().lower()
    assert "parquet" not in plan.split("location")[0] and "content" not in plan
    assert [(r.source, r.indicator, r.snapshot_ts) for r in listed.collect()] == [("x y", "a/b=c +%", "20240102_030405")]
    assert files.read_latest(spark, root).count() == 1


def test_a_snapshot_written_twice_is_one(spark):
    root = scratch_path(spark, "bronze")
    for _ in range(2):
        sinks.write_snapshot(layer_rows(spark, ("a", 1.0), ("b", 2.0)), root, RUN)
    sinks.write_snapshot(layer_rows(spark, ("a", 3.0)), root, RUN)
    assert sorted(r.value for r in files.read_layer(spark, root).collect()) == [2.0, 3.0]


def test_empty_snapshot_is_refused(spark):
    df = layer_rows(spark, ("a", 1.0)).filter("false")
    assert sinks.write_snapshot(df, scratch_path(spark, "bronze"), RUN, refuse_empty=True) is False


def test_csv_round_trip_and_delivered_table(spark):
    path = scratch_path(spark, "t") + ".csv"
    df = spark.createDataFrame([("01/2023", "0.5"), ("02/2023", ""), ("13/2023", "1"), ("03/2023", "0.7")],
                               "`Mês` string, Var string")
    sinks.write_csv(df, path, sep=";")
    back = files.read_any(spark, path, sep=";")
    assert back.columns == ["Mês", "Var"] and back.count() == 4
    got = files.indicator_table(back, "ipca15", "Mês", "Var", "MM/yyyy", end=D(2023, 2, 28))
    assert rows(got) == [(D(2023, 1, 1), 0.5)]


def test_folders_per_indicator(spark):
    assert sinks.folder_columns("selic") == ("year", "month")
    assert sinks.folder_columns("pnad") == ("year", "quarter")
    assert sinks.folder_columns("pib") == ("year",)


def test_conform(spark):
    schema = T.StructType([T.StructField("last_date", T.DateType()), T.StructField("v", T.DoubleType()),
                           T.StructField("updated_at", T.TimestampType()), T.StructField("gone", T.StringType())])
    df = spark.createDataFrame([("05/02/2023", "x", "2023-01-01 10:00:00")],
                               "last_date string, v string, updated_at string")
    assert rows(sinks.conform(df, schema)) == [(D(2023, 2, 5), None, dt.datetime(2023, 1, 1, 10), None)]


def test_ingest_reads_every_file_once(spark):
    landing, bronze, marks = (scratch_path(spark, p) for p in ("landing", "bronze", "marks"))
    df = layer_rows(spark, ("a", 1.0), ("b", 2.0)).withColumns({
        "snapshot_ts": F.lit("20240101_000000"), "source": F.lit("bcb")})
    df.write.parquet(landing)
    for _ in range(2):
        ingest_new_files(spark, landing, bronze, marks, df.schema)
    assert files.read_layer(spark, bronze).count() == 2
    df.filter("indicator = 'a'").write.mode("append").parquet(landing)
    ingest_new_files(spark, landing, bronze, marks, df.schema, max_files=1)
    assert files.read_layer(spark, bronze).count() == 3


@pytest.mark.parametrize("name", ["ipca_20240102_030405", "ipca_20240102_030405/part"])
def test_names_in_foreign_layouts(spark, name):
    root = scratch_path(spark, "economic_indicators")
    layer_rows(spark, ("a", 1.0)).write.parquet(f"{root}/{name}")
    found = files.discover_in_file_names(spark, f"{root}")
    assert rows(found) == [("ipca",)]


# ---- commits ---------------------------------------------------------------------------------


def test_a_half_written_snapshot_is_never_the_newest(spark):
    root, later = scratch_path(spark, "bronze"), RUN + dt.timedelta(days=1)
    sinks.write_snapshot(layer_rows(spark, ("a", 1.0), ("b", 2.0)), root, RUN)
    # As left by a run that ended before its manifest: files, but no manifest.
    late = layer_rows(spark, ("a", 9.0)).withColumns({"source": F.lit(None).cast("string"), "snapshot_ts": F.lit(sinks.snapshot_id(later))})
    late.write.mode("append").partitionBy(*files.PARTITIONS).parquet(root)
    assert {(r.indicator, r.value) for r in files.read_latest(spark, root).collect()} == {("a", 1.0), ("b", 2.0)}
    assert files.read_latest(spark, root, ["a"], committed=False).first().value == 9.0
    assert sinks.commit_snapshots(spark, root) == 1 and sinks.commit_snapshots(spark, root) == 0
    assert files.read_latest(spark, root, ["a"]).first().value == 9.0
    # A folder that changed after its manifest is not whole either.
    late.write.mode("append").partitionBy(*files.PARTITIONS).parquet(root)
    assert files.read_latest(spark, root, ["a"]).first().value == 1.0


def test_a_layer_without_manifests_is_adopted(spark):
    root = scratch_path(spark, "foreign")
    df = layer_rows(spark, ("a", 1.0)).withColumns({"source": F.lit("x"), "snapshot_ts": F.lit("20240101_000000")})
    df.write.partitionBy(*files.PARTITIONS).parquet(root)
    assert files.newest_snapshots(spark, root) == []
    assert sinks.commit_snapshots(spark, root) == 1
    assert files.read_latest(spark, root).first().value == 1.0


def test_jobs_commit_their_own_folders_only(spark):
    root = scratch_path(spark, "bronze")
    sinks.write_snapshot(layer_rows(spark, ("a", 1.0)), root, RUN)
    other = layer_rows(spark, ("b", 5.0)).withColumns({"source": F.lit(None).cast("string"), "snapshot_ts": F.lit(sinks.snapshot_id(RUN))})
    other.write.mode("append").partitionBy(*files.PARTITIONS).parquet(root)  # another job is writing this one
    folder = files.newest_snapshots(spark, root)[0]["folder"]
    sinks.write_snapshot(layer_rows(spark, ("a", 2.0)), root, RUN, folders=[folder])
    assert [(r.indicator, r.value) for r in files.read_latest(spark, root).collect()] == [("a", 2.0)]
