"""Distributed building blocks against plain Spark forms."""

import os
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from threadwarden.operators import distributed
from threadwarden.operators.distributed import keep_first, move_rows, ranked_top_n, row_position, running_total, semi_join_stored, store_rows, top_n_per_group
from threadwarden.sources.staging import stage


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    keys = ["hot", None] + [f"k{i}" for i in range(60)]
    data = [(i, rng.choices(keys, [40, 15] + [1] * 60)[0], rng.randrange(100)) for i in range(3000)]
    return spark.createDataFrame(data, "id bigint, key string, v bigint").repartition(8)


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_running_total_within_groups(rows):
    window = Window.partitionBy("key").orderBy("v", "id").rowsBetween(Window.unboundedPreceding, -1)
    plain = rows.withColumn("before", F.coalesce(F.sum("v").over(window), F.lit(0))).withColumn(
        "n", F.count("id").over(Window.partitionBy("key"))
    )
    got = running_total(rows.withColumn("one", F.lit(1)), ["v", "id"], F.col("v"), "before", ["key"], {"n": (F.sum, "one")})
    assert collected(got.select(*plain.columns)) == collected(plain)


def test_position_over_the_whole_table_falls_with_the_order(rows):
    got = row_position(rows, [F.col("v").desc(), "id"], "position").orderBy("position").collect()
    assert [r.position for r in got] == list(range(3000))
    assert [(r.v, r.id) for r in got] == sorted(((r.v, r.id) for r in got), key=lambda p: (-p[0], p[1]))


def test_null_groups_can_be_dropped(rows):
    got = running_total(rows, ["id"], F.lit(1), "before", ["key"], null_groups=False)
    assert got.count() == rows.filter("key is not null").count()


def test_running_total_of_nothing(spark):
    empty = spark.createDataFrame([], "id bigint, v bigint")
    assert running_total(empty, ["id"], F.col("v"), "before").collect() == []


def test_top_n_below_and_above_the_window_limit(spark, rows):
    order = [F.col("v").desc(), F.col("id")]
    for n in (5, 1200):
        window = Window.partitionBy("key").orderBy(*order)
        plain = rows.withColumn("r", F.row_number().over(window)).filter(F.col("r") <= n)
        assert collected(ranked_top_n(rows, ["key"], order, n, "r")) == collected(plain)
        assert top_n_per_group(rows, ["key"], order, n).count() == plain.count()


def test_top_n_is_cut_before_the_shuffle(rows):
    plan = top_n_per_group(rows, ["key"], [F.col("v"), F.col("id")], 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_keep_first_collapses_copies(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 1, "z"), ("b", 1, "z"), ("c", None, "n")], "id string, o int, t string")
    assert collected(keep_first(df, ["id"], ["o"])) == [("a", 1, "y"), ("b", 1, "z"), ("c", None, "n")]
    assert keep_first(df.select("id"), ["id"]).count() == 3


@pytest.mark.parametrize("few", [500_000, 0])
def test_semi_join_without_a_shuffle_of_the_rows(spark, rows, monkeypatch, few):
    monkeypatch.setattr(distributed, "BROADCAST_ROWS", few)
    monkeypatch.setattr(distributed, "SLICE_ROWS", 500)
    keys = spark.createDataFrame([("hot",), ("hot",), ("k3",), (None,), ("not there",)], "key string")
    assert collected(semi_join_stored(rows, keys, "key")) == collected(rows.join(keys, "key", "left_semi").select(*rows.columns))
    assert semi_join_stored(rows, keys.limit(0), "key").collect() == semi_join_stored(rows.limit(0), keys, "key").collect() == []


def test_rows_are_moved_a_slice_at_a_time(spark, rows, folder, monkeypatch):
    monkeypatch.setattr(distributed, "SLICE_ROWS", 500)
    left, drop = [], distributed.drop
    stored = store_rows(rows)
    source = os.path.dirname(stored.inputFiles()[0].removeprefix("file://"))
    monkeypatch.setattr(distributed, "drop", lambda *a: drop(*a) or left.append(sum(f.endswith(".parquet") for f in os.listdir(source))))
    places = stage(stored.filter("v < 90").select("_row", (F.col("v") % 3).alias("third")), "places")
    move_rows(stored, places, f"{folder}/moved", "third")
    assert left[-1] == 0 and len(left) > 3 and left == sorted(left, reverse=True)
    got = [r for k in range(3) for r in spark.read.parquet(f"{folder}/moved/third={k}").filter(F.col("v") % 3 == k).collect()]
    assert sorted((tuple(r) for r in got), key=repr) == collected(rows.filter("v < 90"))
