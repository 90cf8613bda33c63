"""Positions and quantiles against brute force, with one group holding most rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.operators import charts, ordering
from tallyloom.operators.features import bin_number, category_index, quantile_bins, with_category_index
from tallyloom.operators.ordering import discrete_quantiles, quantiles, with_position


@pytest.fixture(scope="module")
def skewed(spark):
    # group 0 holds two thirds of the rows, and one value half of those
    return spark.range(6000).select(
        "id", F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id") % 50).alias("g"),
        F.when(F.col("id") % 2 == 0, 7.0).otherwise((F.col("id") * 37 % 1000) / 10).alias("x"))


def test_positions_of_a_huge_group(skewed):
    got = with_position(skewed, ["g"], ["x", "id"], total="size").toPandas()
    got = got.sort_values(["g", "x", "id"])
    assert (got["position"] == got.groupby("g").cumcount() + 1).all()
    assert (got["size"] == got.groupby("g")["id"].transform("count")).all()


def test_a_huge_group_is_spread_over_slices(spark, skewed):
    slices = (skewed.repartitionByRange(8, "g", "x", "id").filter("g = 0")
              .groupBy(F.spark_partition_id()).count().collect())
    assert len(slices) > 3


def test_positions_do_not_depend_on_the_number_of_partitions(spark, skewed):
    wanted = None
    for n in ("1", "3", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = sorted(map(tuple, with_position(skewed, [], ["x", "id"]).select("id", "position").collect()))
        wanted = wanted or got
        assert got == wanted
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_null_groups_and_empty_input(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "g string, x int")
    got = {(r["g"], r["x"]): r["position"] for r in with_position(df, ["g"], ["x"]).collect()}
    assert got == {(None, 1): 1, (None, 2): 2, ("a", 3): 1}
    assert with_position(df.limit(0), ["g"], ["x"]).count() == 0


def test_quantiles_like_numpy(skewed):
    frame = skewed.toPandas()
    for row in quantiles(skewed, ["g"], "x", [0.0, 0.1, 0.5, 0.9, 1.0]).collect():
        assert row["quantile"] == pytest.approx(np.quantile(frame[frame.g == row["g"]].x, row["p"]))


def test_names_of_keys_do_not_matter(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0)], "n string, value double")
    assert {r["n"]: r["quantile"] for r in quantiles(df, ["n"], "value", [0.5]).collect()} == {"a": 2.0, "b": 5.0}
    swapped = df.select(F.col("n").alias("value"), F.col("value").alias("n"))
    assert {r["value"]: r["q1"] for r in charts.box_stats(swapped, ["value"], "n").collect()} == {"a": 1.5, "b": 5.0}
    assert charts.histogram(swapped, "n", 2, ["value"]).count() == 3


def test_quantiles_without_the_shortcut_and_with_null_keys(spark, skewed, monkeypatch):
    monkeypatch.setattr(ordering, "MAX_WANTED", 0)
    df = skewed.withColumn("g", F.when(F.col("g") != 0, F.col("g")))
    frame = skewed.toPandas()
    got = {r["g"]: r["quantile"] for r in quantiles(df, ["g"], "x", [0.3]).collect()}
    assert got[None] == pytest.approx(np.quantile(frame[frame.g == 0].x, 0.3))
    assert got[7] == pytest.approx(np.quantile(frame[frame.g == 7].x, 0.3))


def test_discrete_quantiles_and_bins(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 1, 1, 1, 2, 3, 4, 5, 6, 7]] + [(None,)], "x double")
    assert discrete_quantiles(df, "x", [0.25, 0.5, 1.0]) == [1.0, 2.0, 7.0]
    got = quantile_bins(df, "x", 4, "b").orderBy("x").collect()
    assert [r["b"] for r in got] == [None, 1, 1, 1, 1, 2, 2, 2, 3, 3, 3]
    assert spark.range(1).select(bin_number(F.lit(3.0), [])).first()[0] == 0.0


def test_category_index_order_and_unseen(spark):
    df = spark.createDataFrame([(c,) for c in "bbaacd"] + [(None,)], "c string")
    got = {r["c"]: r["category_index"] for r in category_index(df, "c").collect()}
    assert got == {"a": 0.0, "b": 1.0, "c": 2.0, "d": 3.0}
    assert {r["c"]: r["i"] for r in with_category_index(df, "c", "i").collect()}[None] == 4.0


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (10.0,), (None,)], "x double")
    assert {r["bin"]: r["n"] for r in charts.histogram(df, "x", 2).collect()} == {0: 1, 1: 2}
    flat = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert [(r["bin"], r["n"]) for r in charts.histogram(flat, "x", 5).collect()] == [(0, 2)]


def test_box_plot_of_a_single_row_and_a_constant(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("b", 2.0)], "k string, x double")
    got = {r["k"]: (r["q1"], r["low_whisker"], r["outliers"]) for r in charts.box_stats(df, ["k"], "x").collect()}
    assert got == {"a": (1.0, 1.0, 0), "b": (2.0, 2.0, 0)}
    assert charts.box_outliers(df, ["k"], "x").count() == 0


def test_loess_follows_a_line_exactly_and_survives_hot_points(spark):
    line = spark.range(200).select((F.col("id") / 10).alias("x"), (F.col("id") / 5 + 3).alias("y"))
    for row in charts.loess(line, "x", "y", 0.4, 10).collect():
        assert row["fitted"] == pytest.approx(2 * row["x"] + 3)
    hot = line.unionByName(spark.range(500).select(F.lit(0.0).alias("x"), F.lit(3.0).alias("y")))
    first = charts.loess(hot, "x", "y", 0.3, 5).filter("cell = 0").first()
    assert first["fitted"] == pytest.approx(3.0)


def test_density_adds_up_to_one(spark):
    curve = charts.kernel_density(spark.range(1000).select((F.col("id") / 10).alias("x")), "x", 1.0, 200)
    rows = sorted((r["x"], r["density"]) for r in curve.collect())
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(rows, rows[1:]))
    assert area == pytest.approx(1.0, abs=0.02)


def test_correlation_of_a_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0)], "a double, b double")
    got = {(r["first"], r["second"]): r["correlation"] for r in charts.correlation_matrix(df, ["a", "b"]).collect()}
    assert got[("a", "a")] == pytest.approx(1.0) and got[("a", "b")] is None and got[("b", "a")] is None
