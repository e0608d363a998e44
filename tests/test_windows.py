"""Row index, windows, tails and scaling: invariance, properties and edge cases."""

import math
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeline.operators.indexing import index_rows
from gaugeline.operators.windows import apply_tail, left_out, window_vectors
from gaugeline.plans.forecast import predict_windows, scaled_windows

START = datetime(2024, 1, 1)
SCHEMA = "s string, ts timestamp, id bigint, v double"


def rows_of(name, n, value=lambda i: float(i), step=60):
    return [(name, START + timedelta(seconds=step * i), i, value(i)) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def positions(df):
    return {(r.s, r.id): r.row_idx for r in df.collect()}


def predictions(df, **options):
    out = predict_windows(df, ["ts", "id"], "v", 6, "s", "ts", **options)
    return {(r.s, r.window_id): (r.window_end, r.prediction) for r in out.collect()}


@pytest.mark.parametrize("split", [1, 7, 40, 10_000])
def test_index_matches_brute_force(spark, split):
    rng = np.random.default_rng(3)
    rows = rows_of("hot", 300) + rows_of("warm", 60) + rows_of("one", 1)
    rows += [(None, START, i, 0.0) for i in range(50)]  # a null key, all at one time
    rng.shuffle(rows)
    want, by_key = {}, {}
    for r in rows:
        by_key.setdefault(r[0], []).append(r)
    for key, members in by_key.items():
        for i, r in enumerate(sorted(members, key=lambda r: (r[1], r[2]))):
            want[(key, r[2])] = i
    got = positions(index_rows(frame(spark, [tuple(r) for r in rows]), ["ts", "id"], "s", split_rows=split))
    assert got == want


def test_index_cuts_one_busy_instant(spark):
    """A third of a series at a single time is still cut, by the tie-breaker."""
    rows = rows_of("a", 200) + [("a", START, 1000 + i, 0.0) for i in range(100)]
    out = index_rows(frame(spark, rows), ["ts", "id"], "s", split_rows=20, keep_range=True)
    instant = out.where(F.col("ts") == F.lit(START)).groupBy("__range").count().collect()
    assert len(instant) >= 3 and max(r["count"] for r in instant) < 90
    assert sorted(r.row_idx for r in out.collect()) == list(range(300))


def test_index_without_series_and_null_times(spark):
    rows = rows_of("a", 90) + [("a", None, 500 + i, 0.0) for i in range(30)]
    out = index_rows(frame(spark, rows), ["ts", "id"], split_rows=10)
    got = {r.id: r.row_idx for r in out.collect()}
    assert [got[500 + i] for i in range(30)] == list(range(30))
    assert [got[i] for i in range(90)] == list(range(30, 120))


@pytest.mark.parametrize("split", [5, 10_000])
def test_first_rows(spark, split):
    df = frame(spark, rows_of("a", 100) + rows_of("b", 10))
    kept = positions(index_rows(df, ["ts", "id"], "s", first=25, split_rows=split))
    assert sorted(k for k in kept if k[0] == "a") == [("a", i) for i in range(25)]
    assert len(kept) == 35


@pytest.mark.parametrize("first", [None, 150])
def test_ranges_stay_small_beyond_the_broadcast(spark, first):
    """400 ranges where 4 may be broadcast: coarse ranges are cut again, also those of smaller series."""
    df = frame(spark, rows_of("a", 4_000) + rows_of(None, 1_500) + rows_of("b", 45))
    out = index_rows(df, ["ts", "id"], "s", split_rows=10, max_ranges=4, keep_range=True, first=first)
    rows = out.collect()
    sizes = {}
    for r in rows:
        assert r.row_idx == r.id
        sizes[r.s, r["__range"]] = sizes.get((r.s, r["__range"]), 0) + 1
    assert len(rows) == (5_545 if first is None else 345)
    assert max(sizes.values()) <= 40


def test_plan_without_a_hot_series_reads_once(spark):
    df = frame(spark, rows_of("a", 90) + rows_of("b", 10))
    plan = index_rows(df, ["ts", "id"], "s")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("LogicalRDD") == 1


def test_plan_of_a_hot_series_reads_once(spark, tmp_path):
    """Cut points and counts are written before, so the result's plan has one scan of the source."""
    frame(spark, rows_of("a", 900)).write.parquet(f"{tmp_path}/rows")
    source = spark.read.parquet(f"{tmp_path}/rows")
    plan = index_rows(source, ["ts", "id"], "s", split_rows=50)._jdf.queryExecution().optimizedPlan()
    leaves = plan.collectLeaves()
    columns = [{a.name() for a in map(leaves.apply(i).output().apply, range(leaves.apply(i).output().size()))} for i in range(leaves.size())]
    assert sum({"s", "ts", "id"} <= c for c in columns) == 1


def test_same_result_for_any_partitioning(spark):
    df = frame(spark, rows_of("a", 125, lambda i: math.sin(i) * 40) + rows_of("b", 61, lambda i: float(i * i % 17)))
    base = predictions(df.repartition(1))
    assert len(base) == 125 // 6 + 61 // 6
    for parts in (4, 8):
        for batch in (1, 10, 100):
            shuffled = df.orderBy(F.rand(parts)).repartition(parts)
            got = predictions(shuffled, batch_size=batch, index_options={"split_rows": 9})
            assert got.keys() == base.keys()
            assert all(got[k][0] == base[k][0] and math.isclose(got[k][1], base[k][1]) for k in base)


def test_tail_policies(spark):
    df = frame(spark, rows_of("a", 20) + rows_of("b", 18) + rows_of("c", 4))
    cut = window_vectors(df, ["ts", "id"], "v", 6, "s")
    assert apply_tail(cut, 6, "drop", "s").count() == 3 + 3
    assert {r.s: (r.n_rows, r.n_left_out) for r in left_out(cut, 6, "s").collect()} == {
        "a": (20, 2), "b": (18, 0), "c": (4, 4)
    }
    scaled = scaled_windows(df, ["ts", "id"], "v", 6, "s", tail="reuse_previous")
    got = {(r.s, r.window_id): r for r in scaled.collect()}
    assert set(got) == {("a", i) for i in range(4)} | {("b", i) for i in range(3)}
    tail = got["a", 3]
    assert tail.n == 2 and tail.v_scaled == got["a", 2].v_scaled
    assert (tail.v_center, tail.v_scale) == (18.5, 0.5)
    with pytest.raises(ValueError):
        apply_tail(cut, 6, "pad", "s")


def test_robust_scaling_and_inverse(spark):
    rng = np.random.default_rng(5)
    values = rng.normal(50, 12, 120).round(3)
    df = frame(spark, rows_of("a", 120, lambda i: float(values[i])))
    for r in scaled_windows(df, ["ts", "id"], "v", 60, "s").collect():
        block = values[r.window_id * 60 : (r.window_id + 1) * 60]
        low, mid, high = np.percentile(block, [25, 50, 75])
        assert math.isclose(r.v_center, mid) and math.isclose(r.v_scale, high - low)
        assert np.allclose(r.v_scaled, (block - mid) / (high - low))
        assert np.allclose(np.array(r.v_scaled) * r.v_scale + r.v_center, block)


def test_constant_and_missing_values(spark):
    flat = frame(spark, rows_of("a", 6, lambda i: 7.0))
    assert predictions(flat)["a", 0][1] == 7.0
    gaps = rows_of("a", 6, lambda i: [1.0, None, 2.0, float("nan"), 3.0, 4.0][i])
    (row,) = scaled_windows(frame(spark, gaps), ["ts", "id"], "v", 6, "s").collect()
    assert row.n == 6 and row.v_center == 2.5 and row.v_scale == 1.5
    assert [x is None for x in row.v_scaled] == [False, True, False, True, False, False]
    assert predictions(frame(spark, gaps))["a", 0][1] is None


def test_empty_input(spark):
    assert predictions(frame(spark, [])) == {}


def test_windows_lead_into_the_next(spark):
    df = frame(spark, rows_of("a", 15))
    got = {
        r.window_id: (r.n, r.v, r.v_ahead)
        for r in window_vectors(df, ["ts", "id"], "v", 6, "s", ahead=2, split_rows=4).collect()
    }
    assert got[0] == (6, [0, 1, 2, 3, 4, 5], [6, 7])
    assert got[1] == (6, [6, 7, 8, 9, 10, 11], [12, 13])
    assert got[2] == (3, [12, 13, 14], [])


def test_scoring_plan_runs_the_model_once(spark):
    df = frame(spark, rows_of("a", 60))
    out = predict_windows(df, ["ts", "id"], "v", 6, "s").where("prediction >= 50")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


@pytest.mark.parametrize("ranges", [4_000, 10_000])
def test_many_ranges(spark, ranges):
    """Thousands of ranges in one series: the cut points are one array, not a row for each beside it."""
    df = spark.range(200_000).select((F.col("id") * 7919 % 200_003).alias("at"), "id")
    got = index_rows(df, ["at", "id"], split_rows=10, max_ranges=ranges)
    wrong = got.groupBy().agg(F.count_distinct("row_idx").alias("n"), F.max("row_idx").alias("top"), F.sum(F.col("row_idx")).alias("total"))
    assert tuple(wrong.first()) == (200_000, 199_999, 199_999 * 100_000)
    ordered = got.orderBy("row_idx").limit(5_000).collect()
    assert [r["at"] for r in ordered] == sorted(r["at"] for r in ordered)
