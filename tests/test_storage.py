import json
from datetime import date, datetime

from pyspark.sql import functions as F

from stratus.session import work_path
from stratus.sources import bronze, export, landing, replay, shaping

ROWS = [
    ("Paris", "weather_current", datetime(2025, 6, 14, 23, 59), '{"main":{"temp":1.5},"weather":[]}'),
    ("Lyon", "weather_current", datetime(2025, 6, 15, 0, 0), '{"main":{"temp":"x"},"weather":[{"main":"Rain"}],"dt":5}'),
    ("Paris", "weather_forecast", datetime(2025, 6, 16, 12), '{"cnt":40,"city":{"name":"Paris"}}'),
    ("Nice", "weather_current", datetime(2025, 6, 17, 1), '{"main":{"temp":2}}'),
]
SCHEMA = "city string, source string, extracted_at timestamp_ntz, raw_json string"


def lake(spark, rows=ROWS):
    path = work_path(spark, "lake")
    bronze.write_bronze(spark.createDataFrame(rows, SCHEMA), path)
    return path


def test_layout_ranges_and_payload_read(spark):
    path = lake(spark)
    df = bronze.read_bronze(spark, path)
    files = [r.file_path for r in bronze.file_inventory(df).collect()]
    assert any("/source=weather_current/year=2025/month=06/day=14/" in f for f in files)

    def cities(a, b):
        return sorted(r.city for r in bronze.in_date_range(df, a, b).collect())

    assert cities("2025-06-15", "2025-06-15") == ["Lyon"]
    assert cities(date(2025, 6, 14), date(2025, 6, 16)) == ["Lyon", "Paris", "Paris"]
    assert cities("2025-01-01", "2025-01-01") == []
    one = bronze.read_payload(df, "weather_forecast", "Paris", datetime(2025, 6, 16, 12)).collect()
    assert [json.loads(r.raw_json)["cnt"] for r in one] == [40]


def test_date_ranges_prune_partitions(spark):
    df = bronze.in_date_range(bronze.read_bronze(spark, lake(spark)), "2025-06-15", "2025-06-15")
    assert len(df.inputFiles()) == 1 or "PartitionFilters: [isnotnull" in df._jdf.queryExecution().executedPlan().toString()
    scan = df._jdf.queryExecution().executedPlan().toString()
    assert "make_date" in scan.split("PartitionFilters:")[1].split("PushedFilters")[0]


def test_appends_never_replace(spark):
    path = lake(spark)
    bronze.write_bronze(spark.createDataFrame(ROWS[:1], SCHEMA), path)
    assert bronze.read_bronze(spark, path).count() == 5


def test_promoted_fields(spark):
    df = landing.promote_fields(spark.createDataFrame(ROWS, SCHEMA)).orderBy("extracted_at").collect()
    assert [r.temperature for r in df] == [1.5, None, None, 2.0]
    assert [r.weather_main for r in df] == ["", "Rain", None, ""]
    assert [(r.forecast_count, r.city_name) for r in df][2] == (40, "Paris")


def test_landing_marks_bad_documents_and_goes_on(spark):
    path = work_path(spark, "landing")
    spark.createDataFrame([('{"name":"a","dt":1}',), ("{bad",), ('{"name":"b","dt":"x"}',)], "v string").write.text(path)
    landed = landing.scan_landing(spark, path)
    assert landed.where("malformed").count() == 1
    parsed = landing.parse_payload(landing.readable(landed), "raw_json", landing.CURRENT_PAYLOAD)
    assert sorted((r.name, r.dt) for r in parsed.select("name", "dt").collect()) == [("a", 1), ("b", None)]


def test_load_ids_are_unique_and_repeatable(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (3, "x")], "k int, v string")
    first = bronze.with_load_ids(df, "l1", "k", "v")
    again = bronze.with_load_ids(df, "l1", "k", "v")
    assert first.select("row_id").distinct().count() == 3
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, again.collect()), key=lambda r: r[0])
    assert first.join(bronze.with_load_ids(df, "l2", "k", "v"), "row_id").count() == 0


def test_flatten_unnest_merge(spark):
    df = spark.sql("SELECT 1 AS id, named_struct('b', named_struct('c', 5), 'd', array(1)) AS a")
    assert shaping.flatten_struct(df).columns == ["id", "a__b__c", "a__d"]
    parents = spark.sql(
        "SELECT 'p' AS id, array(named_struct('x', 1), named_struct('x', 2)) AS l"
        " UNION ALL SELECT 'q', filter(array(named_struct('x', 1)), e -> false) UNION ALL SELECT 'r', null"
    )
    child = shaping.unnest_child(parents, "l", "id")
    assert sorted((r._parent_id, r._position, r.x) for r in child.collect()) == [("p", 0, 1), ("p", 1, 2)]
    assert child.select("_row_id").distinct().count() == 2
    merged = shaping.merge_by_name(spark.sql("SELECT 1 a"), spark.sql("SELECT 2 b, 3 a"))
    assert sorted(map(tuple, merged.collect()), key=repr) == [(1, None), (3, 2)]


def test_exports_round_trip(spark):
    df = spark.createDataFrame(
        [(1, "a,b", 0.1, datetime(2024, 1, 1, 1, 2, 3, 456789)), (2, None, None, None), (3, 'q"uote', 2.0, datetime(2024, 1, 1))],
        "id int, v string, d double, at timestamp_ntz",
    )
    parquet = export.export_parquet(df, work_path(spark, "p"))
    csv = export.export_csv(df, work_path(spark, "c"))
    expected = sorted(map(tuple, df.collect()))
    assert sorted(map(tuple, spark.read.parquet(parquet).collect())) == expected
    assert sorted(map(tuple, export.read_csv_export(spark, csv, df).collect())) == expected
    assert any(f.endswith(".zstd.parquet") for f in spark.read.parquet(parquet).inputFiles())


def test_bound_parameters(spark):
    df = spark.createDataFrame([("Paris", 1), ("Lyon", 2)], "city string, n int")
    got = export.run_sql(spark, "SELECT n FROM cities WHERE city = :c", {"cities": df}, c="Paris' OR '1'='1")
    assert got.count() == 0


def test_reports_are_kept_per_run(spark):
    path = work_path(spark, "reports")
    df = spark.createDataFrame([("c", True)], "check string, success boolean")
    export.write_report(df, path, "nightly", datetime(2024, 1, 1))
    export.write_report(df, path, "nightly", "20240102T000000")
    assert spark.read.json(path).select("run_ts").distinct().count() == 2


def test_replay(spark):
    path, target = lake(spark), work_path(spark, "target")
    bronze.read_bronze(spark, path).write.partitionBy(*bronze.PARTITIONS).parquet(target)
    empty = replay.replay_range(spark, path, target, date(2025, 1, 1), date(2025, 1, 1)).first()
    assert (empty.status, empty.files_found, empty.records_loaded) == ("no_data", 0, 0)
    seen = []
    for _ in range(2):
        done = replay.replay_range(
            spark, path, target, date(2025, 6, 15), date(2025, 6, 16), lambda df: seen.append(df.count())
        ).first()
        assert (done.status, done.files_found, done.records_loaded, done.transformed) == ("success", 2, 2, True)
        assert bronze.read_bronze(spark, target).count() == 4
    assert seen == [2, 2]
    skipped = replay.replay_range(spark, path, target, date(2025, 6, 14), date(2025, 6, 17)).first()
    assert (skipped.status, skipped.records_loaded, skipped.transformed) == ("success", 4, False)


def test_provenance(spark):
    df = spark.createDataFrame([("Paris",)], "c string")
    row = landing.stamp_provenance(df, "c", "2024-01-01 00:00:00.5").first()
    assert (row._extraction_city, row._extraction_timestamp) == ("Paris", 1704067200.5)
    assert landing.stamp_provenance(df, F.lit("x")).first()._extraction_timestamp > 1.7e9
