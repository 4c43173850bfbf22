import datetime as dt
import time

from pyspark.sql import functions as F

from seriema.operators import quality
from seriema.plans import pipeline, silver
from seriema.session import scratch_path
from seriema.sources import files, sinks
from tests import fixtures as fx

RUN = dt.datetime(2024, 1, 2, 3, 4, 5)


def landed(spark):
    parts = None
    for name, values, step in (("ipca", fx.IPCA, 1), ("selic", fx.SELIC, 1), ("pib", fx.PIB, 3),
                               ("cambio", fx.CAMBIO, 1), ("desemprego", fx.UNEMPLOYMENT, 3),
                               ("inpc", fx.IPCA, 1)):
        df = fx.bronze(spark, name, values, step).select(
            F.lit("bcb").alias("source"), F.date_format("data", "dd/MM/yyyy").alias("data"),
            F.col(name).cast("string").alias("valor"), "indicator")
        parts = df if parts is None else parts.unionByName(df)
    root = scratch_path(spark, "bronze")
    sinks.write_snapshot(parts, root, RUN)
    return root


def test_bronze_to_silver_to_gold(spark):
    bronze, target, root = landed(spark), scratch_path(spark, "silver"), scratch_path(spark, "gold")
    report = {r.indicator: r for r in pipeline.bronze_to_silver(spark, bronze, target, RUN).collect()}
    assert {i for i, r in report.items() if r.success} == {"ipca", "selic", "pib", "cambio", "desemprego"}
    assert report["inpc"].message == "no transform" and report["ipca"].rows == 12
    frames = pipeline.load_latest_silver(spark, target)
    assert set(frames) == {"ipca", "selic", "pib", "cambio", "desemprego"}
    checks = {r["check"]: r["passed"] for r in pipeline.process_validation(frames["ipca"]).collect()
              if r["check"] == "presence"}
    assert checks == {"presence": True}
    done = dict(pipeline.silver_to_gold(spark, target, root, RUN).collect())
    assert done == {"monthly_indicators": True, "labor_market": True, "macro_dashboard": True}
    panel = spark.read.parquet(f"{root}/monthly_indicators")
    assert panel.count() == 12 and panel.filter("selic is null").isEmpty()


def test_failures_stay_with_their_indicator(spark):
    def broken(df, **_):
        return df.select("no_such_column")

    target = scratch_path(spark, "silver")
    report = {r.indicator: r for r in pipeline.bronze_to_silver(
        spark, landed(spark), target, RUN, ["ipca", "selic", "absent"],
        transforms={"ipca": broken, "selic": silver.TRANSFORMS["selic"], "absent": silver.TRANSFORMS["pib"]},
    ).collect()}
    assert report["selic"].success and report["selic"].rows == 12
    assert not report["ipca"].success and "no_such_column" in report["ipca"].message
    assert not report["absent"].success and report["absent"].message == "no data"


def test_missing_values_are_a_warning(spark):
    rows = fx.bronze(spark, "ipca", fx.IPCA).select(
        F.lit("bcb").alias("source"), F.col("data").cast("string").alias("data"),
        F.when(F.month("data") > 2, F.col("ipca").cast("string")).otherwise("n/d").alias("valor"), "indicator")
    bronze, target = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    sinks.write_snapshot(rows, bronze, RUN)
    report = pipeline.bronze_to_silver(spark, bronze, target, RUN).first()
    assert report.success and report.message == "16.7% of value missing"


def test_gold_from_one_indicator_writes_what_it_can(spark):
    bronze, target, root = landed(spark), scratch_path(spark, "silver"), scratch_path(spark, "gold")
    pipeline.bronze_to_silver(spark, bronze, target, RUN, ["desemprego"])
    done = dict(pipeline.silver_to_gold(spark, target, root, RUN).collect())
    assert done == {"monthly_indicators": False, "labor_market": True, "macro_dashboard": False}


def test_nothing_to_do(spark):
    report = pipeline.bronze_to_silver(spark, landed(spark), scratch_path(spark, "silver"), RUN, ["inpc"])
    assert [tuple(r) for r in report.collect()] == [("bcb", "inpc", 0, False, "no transform")]


def test_transforms_always_get_the_same_arguments(spark):
    def own(df, keys, style, run_ts, value):
        return silver.standardize(df, value)

    for times in (1, 400):  # many rows per period, as no indicator should have
        rows = fx.bronze(spark, "ipca", fx.IPCA).select(
            F.lit("bcb").alias("source"), "indicator", F.col("ipca").cast("string").alias("valor"), "data",
            F.explode(F.sequence(F.lit(1), F.lit(times))).alias("n")).select(
            "source", "indicator", "valor", F.col("data").cast("string").alias("data"))
        bronze, target = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
        sinks.write_snapshot(rows, bronze, RUN)
        line = pipeline.bronze_to_silver(spark, bronze, target, RUN, transforms={"ipca": own}).first()
        assert (line.success, line.rows) == (True, 12)
        assert ("has a later one" in line.message) == (times > 1)


def test_many_indicators_are_treated_like_few(spark):
    names = [f"x{k}" for k in range(1_500)]
    frame = spark.createDataFrame([("bcb", n, "2023-01-01", "1") for n in names[:3]], "source string, indicator string, data string, valor string")
    root = scratch_path(spark, "bronze")
    sinks.write_snapshot(frame, root, RUN)
    found = files.newest_snapshots(spark, root, names)
    assert [r["indicator"] for r in found] == names[:3]
    assert pipeline.load_latest_silver(spark, root, names).keys() == set(names[:3])


def test_any_failure_stays_with_its_indicator(spark):
    def at_once(df, **_):
        raise ValueError("no such thing")

    def on_rows(df, keys, style, run_ts, value):
        return silver.standardize(df, value).withColumn("value", F.raise_error(F.lit("a bad row")).cast("double"))

    report = {r.indicator: r for r in pipeline.bronze_to_silver(
        spark, landed(spark), scratch_path(spark, "silver"), RUN, ["ipca", "selic", "pib"],
        transforms={"ipca": at_once, "pib": on_rows, "selic": silver.TRANSFORMS["selic"]}).collect()}
    assert report["ipca"].message == "no such thing" and "a bad row" in report["pib"].message
    assert report["selic"].success and not report["pib"].success


def test_a_repeated_run_replaces_its_snapshot(spark):
    bronze, target = landed(spark), scratch_path(spark, "silver")
    for _ in range(2):
        pipeline.bronze_to_silver(spark, bronze, target, RUN, ["ipca"])
    assert spark.read.parquet(target).count() == 12


def test_silver_in_folders(spark):
    folders = scratch_path(spark, "folders")
    pipeline.bronze_to_silver(spark, landed(spark), scratch_path(spark, "silver"), RUN, ["ipca", "desemprego"], partitioned=folders)
    assert spark.read.parquet(f"{folders}/bcb/ipca").where("year = 2023 AND month = 5").count() == 1
    assert spark.read.parquet(f"{folders}/bcb/desemprego").where("year = 2023").count() == 4


def test_the_newest_snapshot_of_each_source(spark):
    bronze, target = landed(spark), scratch_path(spark, "silver")
    other = spark.createDataFrame([("ibge", "ipca", "2024-01-01", "7", "Norte")],
                                  "source string, indicator string, data string, valor string, localidade string")
    sinks.write_snapshot(other, bronze, RUN + dt.timedelta(days=1))
    report = {(r.source, r.indicator): r.rows for r in pipeline.bronze_to_silver(spark, bronze, target, RUN).collect()}
    assert report["bcb", "ipca"] == 12 and report["ibge", "ipca"] == 1
    frame = pipeline.load_latest_silver(spark, target, ["ipca"])["ipca"]
    assert frame.count() == 13 and {r.localidade for r in frame.collect()} == {None, "Norte"}
    alone = pipeline.bronze_to_silver(spark, bronze, scratch_path(spark, "silver"), RUN, sources=["ibge"])
    assert [(r.source, r.indicator) for r in alone.collect()] == [("ibge", "ipca")]


def test_places_are_series_in_a_run(spark):
    one = fx.bronze(spark, "ipca", fx.IPCA).select(
        F.lit("ibge").alias("source"), F.col("data").cast("string").alias("data"),
        F.col("ipca").cast("string").alias("valor"), "indicator")
    both = one.withColumn("localidade", F.lit("A")).unionByName(one.withColumn("localidade", F.lit("B")))
    bronze, target = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    sinks.write_snapshot(both, bronze, RUN)
    assert pipeline.bronze_to_silver(spark, bronze, target, RUN).first().rows == 24
    firsts = spark.read.parquet(target).filter("month(date) = 1")
    assert [r.monthly_change_pct for r in firsts.collect()] == [None, None]


def test_members_run_together_under_the_callers_job_group(spark):
    groups, running, most = [], [], []

    def own(df, keys, style, run_ts, value):
        groups.append(spark.sparkContext.getLocalProperty("spark.jobGroup.id"))
        running.append(1)
        most.append(len(running))
        time.sleep(1)
        running.pop()
        return silver.standardize(df, value)

    def broken(df, **options):
        own(df, **options)
        raise ValueError("no such thing")

    names = ["ipca", "selic", "pib", "cambio", "desemprego"]
    spark.sparkContext.setJobGroup("nightly", "a run")
    try:
        report = pipeline.bronze_to_silver(
            spark, landed(spark), scratch_path(spark, "silver"), RUN, names, transforms={**dict.fromkeys(names, own), "pib": broken},
            workers=3).collect()
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert [r.indicator for r in report] == sorted(names) and groups == ["nightly"] * 5 and 1 < max(most) <= 3
    assert {r.indicator for r in report if not r.success} == {"pib"}


def test_checks_are_counted_while_writing(spark):
    """After the write silver is read for duplicates only."""
    seen, original = [], pipeline.check_duplicates
    pipeline.check_duplicates = lambda rows, columns: seen.append(rows.count()) or original(rows, columns)
    try:
        report = pipeline.bronze_to_silver(spark, landed(spark), scratch_path(spark, "silver"), RUN, ["ipca"])
    finally:
        pipeline.check_duplicates = original
    assert report.first().rows == 12 and seen == [12]
    df = spark.createDataFrame([("a", 1.0), ("a", None), (None, float("nan"))], "k string, value double")
    for threshold in (10.0, 70.0):
        out, checks = quality.observe_checks(df, ["k", "absent"], {"value": "numeric"}, {"value": (2, 3)}, threshold)
        assert out.count() == 3
        want = quality.validate(df, ["k", "absent"], {"value": "numeric"}, {"value": (2, 3)}, threshold, duplicates=False)
        assert sorted(map(tuple, checks().collect()), key=repr) == sorted((tuple(r) for r in want.collect() if r["check"] != "dataset"), key=repr)
