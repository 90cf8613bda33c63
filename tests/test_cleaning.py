import pytest
from pyspark.sql import functions as F

from tallyloom import fixed_values as fixed
from tallyloom.functions import cleaning as clean
from tallyloom.functions.statistics import geometric_mean, normal_quantile


def values(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_decode_leaves_unmapped_null(spark):
    got = values(spark, [(1,), (3,), (None,)], "c int", clean.decode("c", fixed.SIDES))
    assert got == ["Home", None, None]


def test_every_book_decodes_all_of_its_codes(spark):
    for book in fixed.MATCH_EVENT_BOOKS.values():
        got = values(spark, [(k,) for k in book], "c int", clean.decode("c", book))
        assert got == list(book.values())


@pytest.mark.parametrize("text,expected", [
    ("10.5K", 10.5), ("2M", 2000.0), ("1.5B", 1500000.0), ("0", None), (None, 0.0), ("K", None),
    ("", None), ("xM", None), ("10k", None)])
def test_parse_magnitude(spark, text, expected):
    assert values(spark, [(text,)], "t string", clean.parse_magnitude("t")) == [expected]


def test_merge_labels_finds_the_pattern_anywhere(spark):
    got = values(spark, [("Marine Thunderstorm Wind",), ("TORNADO F2",), ("hail",), (None,)],
                 "t string", clean.merge_labels("t", fixed.STORM_LABELS))
    assert got == ["THUNDERSTORM WIND", "TORNADO", "HAIL", None]


def test_scale_by_unit_and_its_historic_rule(spark):
    rows = [(5.0, "K"), (5.0, "M"), (5.0, "B"), (5.0, "?")]
    assert values(spark, rows, "a double, u string", clean.scale_by_unit("a", "u")) == [
        0.005, 5.0, 5000.0, 5.0]
    assert values(spark, rows, "a double, u string",
                  clean.scale_by_unit("a", "u", legacy_crop=True)) == [0.005, 5.0, 5.0, 5.0]


def test_typed_value_and_unit(spark):
    rows = [("Yes/No", "Yes"), ("Yes/No", "No"), ("Number", "12"), ("Number", "-"), ("Number", None)]
    assert values(spark, rows, "k string, t string", clean.typed_value("k", "t")) == [
        1.0, 0.0, 12.0, None, None]
    assert values(spark, rows[:3], "k string, t string", clean.value_unit("k")) == [
        "Binary", "Binary", "Number"]


def test_blank_sum_dates_and_names(spark):
    rows = [(" ", 1, "4/18/1950 0:00:00"), ("a", None, "12/1/2001 0:00:00"), (None, 3, "no date")]
    df = spark.createDataFrame(rows, "t string, n int, day string")
    assert df.filter(clean.not_blank("t")).count() == 1
    got = df.select(clean.add_columns(["n", F.lit(1)]), clean.year_of_text_date("day")).collect()
    assert [tuple(r) for r in got] == [(2, 1950), (None, 2001), (4, None)]
    assert values(spark, [("a (b).json",)], "t string", clean.safe_file_name("t")) == ["ab.json"]


def test_geometric_mean_applies_its_seed_once(spark):
    df = spark.range(1, 20).repartition(7).withColumn("g", F.col("id") % 3)
    got = df.groupBy("g").agg(geometric_mean("id").alias("a"), geometric_mean("id", 1, 1.1).alias("b"))
    for row in got.collect():
        ids = [i for i in range(1, 20) if i % 3 == row["g"]]
        product = 1.0
        for i in ids:
            product *= i
        assert row["a"] == pytest.approx(product ** (1 / len(ids)))
        assert row["b"] == pytest.approx((1.1 * product) ** (1 / (1 + len(ids))))


def test_geometric_mean_edges(spark):
    def mean(*xs):
        return spark.createDataFrame([(x,) for x in xs], "x double").agg(geometric_mean("x")).first()[0]

    assert mean(2.0, 0.0) == 0.0
    assert mean(-2.0, -8.0) == pytest.approx(4.0)
    assert mean(-1.0, 2.0) != mean(-1.0, 2.0)
    assert mean(*[1e300] * 10) == pytest.approx(1e300)


def test_normal_quantile(spark):
    got = values(spark, [(0.5,), (0.975,), (0.001,), (0.0,)], "p double", normal_quantile("p"))
    assert got[0] == pytest.approx(0.0, abs=1e-9)
    assert got[1] == pytest.approx(1.959963985, abs=1e-7)
    assert got[2] == pytest.approx(-3.090232306, abs=1e-7)
    assert got[3] is None
