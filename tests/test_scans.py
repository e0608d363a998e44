"""Scans that bind by name and report what they cannot read; file order; committed runs."""

import json

import pytest
from gaugeline.operators.indexing import index_rows
from gaugeline.operators.projections import prefix_rows
from gaugeline.operators.windows import count_windows
from gaugeline.plans import job
from gaugeline.sinks import predictions as prediction_sink
from gaugeline.sinks import runs
from gaugeline.sources import predictions, telemetry
from gaugeline.sources.checked import read_json
from gaugeline.sources.file_order import FILE_ORDER, in_file_order
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

SCHEMA = "id bigint, Date string, time string, `%used` double"


def put(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)
    return str(folder)


@pytest.fixture()
def mixed(tmp_path):
    put(tmp_path / "in", "a.csv", "id,Date,time,%used\n1,2021/04/08,01:00:00,10.5\n2,2021/04/08,02:00:00,abc\n3,2021/04/08,03:00:00\n4,2021/04/08,04:00:00,1,2\n")
    put(tmp_path / "in", "b.csv", '﻿%used,time,"Date",id,more\n7.25,05:00:00,2021/04/08,5,x\n,06:00:00,2021/04/08,6,"y,z"\n')
    return put(tmp_path / "in", "c.csv", "id,id,Date,time,%used\n7,99,2021/13/41,07:00:00,3\n")


def test_columns_are_found_by_name_in_each_file(spark, mixed):
    scan = telemetry.scan_telemetry(spark, mixed, SCHEMA)
    assert sorted((r.id, r.time, r["%used"]) for r in scan.rows.collect()) == [
        (1, "01:00:00", 10.5), (5, "05:00:00", 7.25), (6, "06:00:00", None), (7, "07:00:00", 3.0)
    ]
    assert sorted((r.file[-5:], r.record) for r in scan.rejects.collect()) == [
        ("a.csv", "2,2021/04/08,02:00:00,abc"), ("a.csv", "3,2021/04/08,03:00:00"), ("a.csv", "4,2021/04/08,04:00:00,1,2")
    ]


def test_a_record_is_judged_by_all_columns_whatever_is_selected(spark, mixed):
    scan = telemetry.scan_telemetry(spark, mixed, SCHEMA)
    assert (scan.rows.count(), scan.rejects.count()) == (4, 3)
    assert sorted(r.id for r in scan.rows.select("id").collect()) == [1, 5, 6, 7]
    with pytest.raises(PySparkException, match="malformed record in .*a.csv"):
        telemetry.read_telemetry(spark, mixed, SCHEMA).select("id").collect()


def test_both_sides_are_stored_in_one_pass(spark, mixed, tmp_path):
    kept = telemetry.scan_telemetry(spark, mixed, SCHEMA).stored(str(tmp_path / "out"))
    assert (kept.rows.count(), kept.rejects.count()) == (4, 3)
    assert kept.rows.columns == ["id", "Date", "time", "%used"] and kept.rejects.columns == ["file", "reason", "record"]


def test_no_event_time_is_a_reject(spark, mixed):
    scan = telemetry.with_event_times(telemetry.scan_telemetry(spark, mixed, SCHEMA))
    assert {r.reason: json.loads(r.record)["id"] for r in scan.rejects.collect() if r.reason != "malformed record"} == {"no event time": 7}
    rows = telemetry.normalize_telemetry(scan.rows, keep=["id"])
    assert sorted(r.id for r in rows.where(F.col("ts").isNotNull()).collect()) == [1, 5, 6]


def test_absent_columns_empty_folders_and_inferred_types(spark, mixed, tmp_path):
    with pytest.raises(ValueError, match="a.csv: no column load in its header"):
        telemetry.scan_telemetry(spark, mixed, "id bigint, load double")
    put(tmp_path / "none", "a.csv", "")
    scan = telemetry.scan_telemetry(spark, str(tmp_path / "none"), SCHEMA)
    assert scan.rows.count() == scan.rejects.count() == 0
    put(tmp_path / "one", "a.csv", "id,%used\n1,2.5\n")
    plain = telemetry.read_telemetry(spark, put(tmp_path / "one", "b.csv", "%used,id\n3.5,2\n"))
    assert sorted(map(tuple, plain.collect())) == [(1, 2.5), (2, 3.5)]


def test_broken_json_lines_are_reported(spark, tmp_path):
    lines = ['{"Datetime":["a"],"prediction":[1.5]}', '{"prediction":[2.0', '{"prediction":["x"]}', '{"other":1}', '{"prediction":null}', ""]
    folder = put(tmp_path / "run", "part-0.json", "\n".join(lines))
    scan = predictions.scan_predictions(spark, folder)
    assert [tuple(r) for r in scan.rows.collect()] == [(["a"], [1.5])]
    assert sorted((r.reason, r.record) for r in scan.rejects.collect()) == [
        ("malformed record", lines[2]), ("malformed record", lines[1]), ("no prediction", "{}"), ("no prediction", "{}")
    ]
    with pytest.raises(PySparkException, match="malformed record|no prediction"):
        predictions.read_predictions(spark, folder).collect()
    assert read_json(spark, [], "a int", ["a"]).rows.count() == 0


def test_schema_is_inferred_once_and_kept(spark, tmp_path):
    folder = put(tmp_path / "run", "part-0.json", '{"prediction":[1.5]}\n{"prediction":[2.5]}\nbroken\n')
    first = predictions.inferred_schema(spark, folder, lines=3)
    assert first.simpleString() == "struct<prediction:array<double>>"
    put(tmp_path / "run", "part-1.json", '{"Datetime":["a"],"prediction":[1.5]}\n')
    assert predictions.inferred_schema(spark, folder) == first
    assert predictions.scan_predictions(spark, folder, first).rows.count() == 3


@pytest.mark.parametrize("piece", [1 << 30, 700, 90])
@pytest.mark.parametrize("kind", ["csv", "parquet"])
def test_file_order_does_not_depend_on_partitions(spark, tmp_path, piece, kind):
    """Files of 40, 300 and 7 rows in no order of their values, cut into pieces of some bytes."""
    rows, start = [], 0
    for name, n in (("a", 40), ("b", 300), ("c", 7)):
        part = [(start + i, (start + i) * 7919 % 347) for i in range(n)]
        frame = spark.createDataFrame(part, "id int, v int").coalesce(1).sortWithinPartitions("id")
        target = str(tmp_path / kind / f"file={name}")
        frame.write.parquet(target) if kind == "parquet" else frame.write.option("header", True).csv(target)
        rows += part
        start += n
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", piece)
    try:
        reader = spark.read.schema("id int, v int").option("header", True)
        scan = reader.parquet(str(tmp_path / kind)) if kind == "parquet" else reader.csv(str(tmp_path / kind))
        placed = index_rows(in_file_order(scan), FILE_ORDER, split_rows=50).select("row_idx", "id", "v").collect()
        assert sorted(map(tuple, placed)) == [(i, *r) for i, r in enumerate(rows)]
        assert [r.id for r in prefix_rows(in_file_order(scan), 45, FILE_ORDER).collect()] == list(range(45))
        cut = count_windows(in_file_order(scan), FILE_ORDER, 60).select("id", "window_id", "pos").collect()
        assert sorted(map(tuple, cut)) == [(i, i // 60, i % 60) for i in range(347)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_repeated_run_is_committed_once(spark, tmp_path):
    rows = spark.createDataFrame([("s", i, float(i % 7)) for i in range(100)], "series string, ts int, value double")
    rows = rows.withColumn("ts", F.timestamp_seconds("ts"))
    for _ in range(2):
        run = job.forecast_run(rows, str(tmp_path), 10, run="r-prediction", threshold=-1e9)
        assert predictions.read_predictions(spark, run.folder).count() == 10
        assert predictions.read_report(spark, run.report).count() == run.alerts.count() == 10


def test_only_committed_files_are_read(spark, tmp_path):
    df, target = spark.createDataFrame([(1.0,), (2.0,)], "prediction double"), f"{tmp_path}/r"
    assert runs.committed_files(spark, target) is None
    with pytest.raises(RuntimeError):
        runs.commit(spark, target, lambda d: (df.write.json(d), (_ for _ in ()).throw(RuntimeError("lost")))[0])
    assert runs.committed_files(spark, target) is None
    prediction_sink.commit_predictions(df, str(tmp_path), "r", time=None)
    assert predictions.read_predictions(spark, target, "prediction array<double>").count() == 2
    # two attempts that commit at the same moment: readers agree on one
    first = runs.manifest(spark, target)["attempt"]
    line = json.dumps({"attempt": "attempt-0", "files": []})
    spark.createDataFrame([(line,)], "value string").write.mode("append").text(f"{target}/_committed")
    assert runs.manifest(spark, target)["attempt"] == min(first, "attempt-0")


def test_an_empty_run_is_committed_too(spark, tmp_path):
    df = spark.createDataFrame([], "prediction double")
    folder = prediction_sink.commit_predictions(df, str(tmp_path), "r", time=None)
    prediction_sink.commit_report(df, f"{folder}-report")
    assert runs.manifest(spark, folder) is not None
    assert predictions.read_predictions(spark, folder).count() == predictions.read_report(spark, f"{folder}-report").count() == 0
