"""Random inputs against plain Python."""

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.feature import QuantileDiscretizer, StringIndexer
from pyspark.sql import functions as F

from tallyloom.functions import cleaning as clean
from tallyloom.operators import features, sequences
from tallyloom.operators.ordering import quantiles, with_position
from tallyloom.sources.files import read_table

FEW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def money(text):
    text = "0.00K" if text is None else text
    for suffix, factor in (("K", 1.0), ("M", 1000.0), ("B", 1000000.0)):
        if text.endswith(suffix):
            digits = text.replace(suffix, "")
            return float(digits) * factor if re.fullmatch(r"-?\d+(\.\d+)?", digits) else None
    return None


@FEW
@given(st.lists(st.one_of(st.none(), st.from_regex(r"\A-?[0-9]{1,4}(\.[0-9]{1,2})?[KMBk]?\Z"),
                          st.sampled_from(["", "K", "1K2K", "abcM", "5KB"])), min_size=1, max_size=60))
def test_money_text(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(clean.parse_magnitude("t")).collect()] == [money(t) for t in texts]


@FEW
@given(st.lists(st.tuples(st.one_of(st.none(), st.sampled_from("abc")), st.integers(-5, 5)), min_size=1, max_size=80))
def test_positions(spark, pairs):
    rows = [(g, x, i) for i, (g, x) in enumerate(pairs)]
    df = spark.createDataFrame(rows, "g string, x int, i int")
    got = {r["i"]: (r["position"], r["size"]) for r in with_position(df, ["g"], ["x", "i"], total="size").collect()}
    for g, x, i in rows:
        group = sorted((b, c) for a, b, c in rows if a == g)
        assert got[i] == (group.index((x, i)) + 1, len(group))


@FEW
@given(st.lists(st.floats(-100, 100).map(lambda x: round(x, 1)), min_size=1, max_size=80), st.floats(0, 1))
def test_quantiles(spark, xs, p):
    import numpy as np

    df = spark.createDataFrame([(x,) for x in xs], "x double")
    assert quantiles(df, [], "x", [p]).first()["quantile"] == pytest.approx(np.quantile(xs, p), abs=1e-9)


@FEW
@given(st.text(alphabet="aé😀\n", max_size=60), st.integers(1, 6), st.integers(1, 9))
def test_text_windows(spark, text, length, stride):
    df = spark.createDataFrame([(text,)], "text string")
    got = sorted((r["start"], r["prefix"], r["next_char"]) for r in sequences.char_windows(df, "text", length, stride).collect())
    assert got == [(i, text[i:i + length], text[i + length]) for i in range(0, len(text) - length, stride)]


@FEW
@given(st.integers(1, 40), st.integers(1, 8), st.integers(0, 7), st.booleans())
def test_series_windows(spark, length, size, overlap, legacy):
    overlap = min(overlap, size - 1)
    stride = size - overlap
    df = spark.range(length).select(F.lit("s").alias("s"), "id")
    got = [r["items"] for r in sequences.series_windows(df, ["s"], ["id"], "id", size, overlap, legacy).orderBy("window_id").collect()]
    if legacy:
        count = (length - (size - 1)) // stride if length > size else 0
    else:
        count = (length - size) // stride + 1 if length >= size else 0
    assert got == [list(range(i * stride, i * stride + size)) for i in range(count)]


def test_category_index_is_the_library_indexer(spark, folder):
    part = read_table(spark, folder, "part", "p_partkey", "p_name")
    ours = features.with_category_index(part, "p_name", "ours")
    model = StringIndexer(inputCol="p_name", outputCol="theirs").fit(part)
    assert model.transform(ours).filter("ours <> theirs").count() == 0


def test_quantile_bins_are_the_exact_library_bins(spark, folder):
    orders = read_table(spark, folder, "orders", "o_orderkey", "o_totalprice")
    ours = features.quantile_bins(orders, "o_totalprice", 10, "ours")
    bins = QuantileDiscretizer(inputCol="o_totalprice", outputCol="theirs", numBuckets=10, relativeError=0.0)
    assert bins.fit(orders).transform(ours).filter("ours <> theirs").count() == 0
