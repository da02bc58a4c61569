import json
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayloom.operators import scenarios
from dayloom.plans import staging
from dayloom.session import scratch_path, shared_dir
from dayloom.sources import datasets, records
from tests import cases


def test_absent_feed_is_empty_and_typed(spark):
    df = datasets.read_feed(spark, scratch_path(spark, "none"), "weather")
    assert df.count() == 0
    assert df.columns == ["observation_ts", "rain_mm", "temperature_c"]


def test_parts_at_any_depth_and_with_missing_columns(spark):
    base = scratch_path(spark, "raw")
    whole = cases.feeds(spark)["weather"]
    whole.write.parquet(f"{base}/weather/a/b/c")
    whole.drop("rain_mm").withColumn("extra", F.lit(1)).write.parquet(f"{base}/weather/d")
    df = datasets.read_feed(spark, base, "weather")
    assert df.count() == 8
    assert df.where("rain_mm IS NULL").count() == 4


def test_landing_appends_and_prunes(spark):
    base = scratch_path(spark, "raw")
    feed = {"personal": cases.feeds(spark)["personal"]}
    for day in (date(2025, 1, 3), date(2025, 1, 4), date(2025, 1, 4)):
        datasets.land_feeds(feed, base, day)
    assert datasets.read_feed(spark, base, "personal").count() == 6
    late = datasets.read_feed(spark, base, "personal", first_ingest=date(2025, 1, 4))
    assert late.count() == 4
    assert "PartitionFilters: [isnotnull(ingest_date" in late._jdf.queryExecution().executedPlan().toString()
    assert datasets.read_feed(spark, base, "personal", last_ingest=date(2025, 1, 3)).count() == 2
    twice = staging.stg_personal_day(datasets.read_feed(spark, base, "personal")).orderBy("date").first()
    assert twice["steps"] == 3 * 10342
    assert "ingest_date" in datasets.read_feed(spark, base, "personal", keep_ingest_date=True).columns


def test_landing_names_missing_columns(spark):
    with pytest.raises(ValueError, match="weather lacks required columns: rain_mm"):
        datasets.land_feeds({"weather": cases.feeds(spark)["weather"].drop("rain_mm")}, scratch_path(spark, "raw"), date(2025, 1, 1))


def test_stored_schema_skips_inference(spark):
    base = scratch_path(spark, "raw")
    feed = cases.feeds(spark)["weather"]
    datasets.land_feeds({"weather": feed}, base, date(2025, 1, 1))
    assert datasets.read_feed(spark, base, "weather", schema=feed.schema).count() == 4


def test_views_cover_absent_feeds(spark):
    base = scratch_path(spark, "raw")
    datasets.land_feeds({"weather": cases.feeds(spark)["weather"]}, base, date(2025, 1, 1))
    names = datasets.register_feed_views(spark, base, "v_")
    assert set(names) == {"v_commute_trips", "v_air_quality", "v_weather", "v_beachwatch", "v_personal"}
    assert spark.sql("SELECT count(*) FROM v_weather").first()[0] == 4
    assert spark.sql("SELECT count(*) FROM v_commute_trips").first()[0] == 0


def test_scenario_file(spark):
    path = scratch_path(spark, "scenarios")
    datasets.write_csv(datasets.default_scenarios(spark), path)
    got = datasets.read_scenarios(spark, path)
    assert got.count() == 5
    assert got.where("scenario = 'Rainy Commute'").first()["delta_reliability"] == -0.15
    broken = scratch_path(spark, "scenarios")
    datasets.write_csv(datasets.default_scenarios(spark).drop("delta_steps"), broken)
    with pytest.raises(ValueError, match="delta_steps"):
        datasets.read_scenarios(spark, broken)


def test_saved_fact_for_analysis(spark):
    path = scratch_path(spark, "fact")
    spark.createDataFrame([("2025-01-01", True)], "date string, beach_ok boolean").write.parquet(path)
    row = datasets.read_fact(spark, path).first()
    assert tuple(row) == (date(2025, 1, 1), 1)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        datasets.read_fact(spark, path + "-absent")


def test_sorted_and_monthly_exports(spark):
    df = spark.createDataFrame([(f"2025-0{1 + i % 3}-{10 + i:02d}", i) for i in range(15)], "date string, v int")
    path = scratch_path(spark, "sorted")
    datasets.write_sorted(df.repartition(4), path)
    assert [r["date"] for r in spark.read.parquet(path).orderBy("date").collect()] == sorted(r["date"] for r in df.collect())
    months = scratch_path(spark, "months")
    datasets.write_by_month(df, months)
    part = spark.read.parquet(months).where("year_month = '2025-02'")
    assert part.count() == 5
    assert "PartitionFilters: [isnotnull(year_month" in part._jdf.queryExecution().executedPlan().toString()


def test_manifest(spark):
    feeds = cases.feeds(spark)
    got = {r["dataset"]: tuple(r)[1:] for r in datasets.feed_manifest({"personal": (feeds["personal"], "date")}).collect()}
    assert got == {"personal": (2, date(2025, 1, 1), date(2025, 1, 2))}


def test_record_pages(spark, tmp_path):
    for page, ids in enumerate([[1, 2, 3], [4, 5], []]):
        body = {"success": True, "result": {"total": 5, "records": [{"id": i, "site": f"s{i}"} for i in ids]}}
        (tmp_path / f"page-{page}.json").write_text(json.dumps(body))
    record = T.StructType([T.StructField("id", T.LongType()), T.StructField("site", T.StringType())])
    got = records.read_record_pages(spark, str(tmp_path), record)
    assert sorted(r["id"] for r in got.collect()) == [1, 2, 3, 4, 5]
    assert records.filter_records(got, {"site": "s4"}).count() == 1
    assert records.filter_records(got).count() == 5


def test_payload_files(spark, tmp_path):
    (tmp_path / "sydneytrains.zip").write_bytes(b"PK\x03\x04abc")
    (tmp_path / "buses.zip").write_bytes(b"x")
    got = {r["feed_code"]: r for r in records.read_payloads(spark, str(tmp_path), "*.zip").collect()}
    assert bytes(got["sydneytrains"]["content"]) == b"PK\x03\x04abc"
    assert got["buses"]["size_bytes"] == 1


def test_filter_pushdown(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).selectExpr("id", "cast(id % 2 as string) AS kind", "id AS unused").write.parquet(path)
    plan = records.filter_records(spark.read.parquet(path), {"kind": "1"}).select("id")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(kind,1)" in text and "unused" not in text.split("ReadSchema")[1]


def test_shared_dir_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_custom_scenarios_reject_unknown_features(spark):
    with pytest.raises(ValueError, match="humidity"):
        scenarios.custom_scenario(spark, {"humidity": 1.0})


def test_a_file_of_many_pages_is_read_by_many_tasks(spark, tmp_path):
    record = T.StructType([T.StructField("a", T.LongType())])
    folder = tmp_path / "many pages"
    folder.mkdir()
    pages = [json.dumps({"result": {"records": [{"a": 10 * i + j} for j in range(10)], "total": 20_001}}) for i in range(2000)]
    (folder / "lines.json").write_text("\n".join(pages) + "\n\n")
    (folder / "one page.json").write_text(json.dumps({"result": {"records": [{"a": 20_000}], "total": 20_001}}, indent=1))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        got = records.read_record_pages(spark, str(folder), record)
        assert sorted(r["a"] for r in got.collect()) == list(range(20_001))
        assert records._page_texts(spark, str(folder)).where("file LIKE '%lines.json'").rdd.getNumPartitions() > 4
        assert tuple(records.record_page_totals(spark, str(folder), record).first()) == (2001, 20_001, 20_001, True)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    with open(folder / "lines.json", "a") as file:
        file.write('{"result": {"records": [\n')
    with pytest.raises(Exception, match="does not parse.*lines.json"):
        records.read_record_pages(spark, str(folder), record).collect()


def test_many_parts_of_differing_types_take_few_schema_reads(spark, monkeypatch):
    base = scratch_path(spark, "raw")
    kinds = ["double", "double", "double", "string", "string", "int", "int", "int"]
    for day, kind in enumerate(kinds, 1):
        rows = spark.range(0, 100, 1, 25).selectExpr("timestamp_ntz'2024-05-01 10:00:00' AS observation_ts", f"CAST(id AS {kind}) AS rain_mm", "1.5D AS temperature_c")
        rows.write.parquet(f"{base}/{datasets.LANDING_SOURCES.get('weather', 'weather')}/ingest_date=2024-05-{day:02d}")
    reads = []
    real = type(spark.read).parquet
    monkeypatch.setattr(type(spark.read), "parquet", lambda self, *paths, **options: reads.append(len(paths)) or real(self, *paths, **options))
    got = datasets.read_feed(spark, base, "weather")
    assert got.count() == 800 and got.agg(F.sum("rain_mm")).first()[0] == 8 * 4950
    assert len(reads) < 40  # of 200 parts
    by_date = datasets.read_feed(spark, base, "weather", keep_ingest_date=True, first_ingest=date(2024, 5, 4))
    assert by_date.count() == 500 and by_date.select("ingest_date").distinct().count() == 5
