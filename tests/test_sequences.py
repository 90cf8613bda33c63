import pytest
from pyspark.sql import functions as F

from tallyloom.operators import sequences
from tallyloom.operators.aggregates import concatenated


def expected_windows(values, size, overlap, legacy):
    stride = size - overlap
    if legacy:
        count = (len(values) - (size - 1)) // stride if len(values) > size else 0
    else:
        count = (len(values) - size) // stride + 1 if len(values) >= size else 0
    return [values[i * stride:i * stride + size] for i in range(count)]


@pytest.mark.parametrize("legacy", [True, False])
@pytest.mark.parametrize("length,size,overlap", [
    (20, 5, 1), (20, 5, 2), (20, 5, 4), (4, 5, 1), (5, 5, 1), (6, 5, 4), (8, 5, 1), (60, 50, 49), (7, 1, 0)])
def test_windows_against_slicing(spark, monkeypatch, legacy, length, size, overlap):
    monkeypatch.setattr(sequences, "CHUNK", 6)  # many chunk borders
    df = spark.range(length).select(F.lit("s").alias("s"), "id", (F.col("id") * 1.0).alias("v"))
    got = sequences.series_windows(df, ["s"], ["id"], "v", size, overlap, legacy)
    rows = [r["items"] for r in got.orderBy("window_id").collect()]
    assert rows == expected_windows([float(i) for i in range(length)], size, overlap, legacy)


def test_historic_count_loses_a_complete_window(spark):
    assert len(expected_windows(list(range(20)), 5, 2, True)) == 5
    assert len(expected_windows(list(range(20)), 5, 2, False)) == 6


def test_null_values_keep_their_place(spark):
    df = spark.createDataFrame([("s", i, None if i == 2 else float(i)) for i in range(5)], "s string, i int, v double")
    got = sequences.series_windows(df, ["s"], ["i"], "v", 3, 2, False).orderBy("window_id").collect()
    assert [r["items"] for r in got] == [[0.0, 1.0, None], [1.0, None, 3.0], [None, 3.0, 4.0]]


def test_bad_window_arguments(spark):
    with pytest.raises(ValueError):
        sequences.series_windows(spark.range(3), [], ["id"], "id", 3, 3)


@pytest.mark.parametrize("text", ["", "ab", "abc", "abcd", "àéîöü∂ƒ" * 30, "a😀\n\r😀b" * 20, "x" * 1000])
@pytest.mark.parametrize("length,stride", [(3, 1), (3, 2), (40, 3)])
def test_char_windows_against_slicing(spark, text, length, stride):
    df = spark.createDataFrame([(1, text)], "id int, text string")
    got = sequences.char_windows(df, "text", length, stride).orderBy("start").collect()
    assert [(r["start"], r["prefix"], r["next_char"]) for r in got] == [
        (i, text[i:i + length], text[i + length]) for i in range(0, len(text) - length, stride)]


def test_long_texts_are_cut_without_loss(spark):
    text = "".join(chr(97 + i * i % 26) for i in range(40_000))
    df = spark.createDataFrame([(text,)], "text string")
    got = {r["start"]: r["prefix"] + r["next_char"] for r in sequences.char_windows(df, "text", 5, 2).collect()}
    assert got == {i: text[i:i + 6] for i in range(0, len(text) - 5, 2)}


def test_transitions(spark):
    df = spark.createDataFrame([("u", i, s) for i, s in enumerate("aabab")] + [("v", 0, "a"), ("w", 0, "b"), ("w", 1, "a")],
                               "u string, i int, s string")
    got = {(r["previous"], r["following"]): (r["n"], r["share"])
           for r in sequences.transitions(df, ["u"], ["i"], "s").collect()}
    assert got == {("a", "a"): (1, pytest.approx(1 / 3)), ("a", "b"): (2, pytest.approx(2 / 3)), ("b", "a"): (2, 1.0)}


def test_chronological_split_adds_up(spark):
    df = spark.range(103).withColumn("s", F.col("id") % 2)
    marked = sequences.chronological_split(df, ["s"], ["id"], 0.7)
    counts = {(r["s"], r["is_train"]): r["count"] for r in marked.groupBy("s", "is_train").count().collect()}
    assert counts == {(0, True): 36, (0, False): 16, (1, True): 35, (1, False): 16}


def test_concatenation_splits_a_frequent_key(spark):
    df = spark.range(25).select(F.lit("k").alias("k"), F.format_string("%02d", "id").alias("v"))
    parts = concatenated(df, ["k"], "v", ",", 10).orderBy("part").collect()
    assert [len(p["text"].split(",")) for p in parts] == [10, 10, 5]
    assert ",".join(p["text"] for p in parts) == ",".join(f"{i:02d}" for i in range(25))


def test_one_hot_and_corruption(spark):
    texts = spark.createDataFrame([(1, "abca")], "id int, text string")
    samples = sequences.char_windows(texts, "text", 2, 1)
    hot = sequences.one_hot_positions(samples, "prefix", sequences.vocabulary(texts, "text"))
    assert sorted((r["start"], r["place"], r["code"]) for r in hot.collect()) == [
        (0, 0, 0), (0, 1, 1), (1, 0, 1), (1, 1, 2)]
    variants = sequences.corrupted(samples, "prefix", 2).orderBy("start", "place").collect()
    assert [r["variant"] for r in variants] == ["?b", "a?", "?c", "b?"]


def test_autoregression_against_least_squares(spark):
    import numpy as np

    from tallyloom.operators.autoregression import fit_autoregression, predicted_next

    rng = np.random.default_rng(4)
    series = {"a": [10.0, 12.0], "b": [500.0, 501.0], "c": [3.0] * 9, "d": [1.0, 2.0, 4.0], "e": [float(i % 2) for i in range(12)]}
    for name, (x, y) in {"a": (0.5, 0.3), "b": (-0.4, 0.9)}.items():
        for _ in range(200):
            series[name].append(x * series[name][-2] + y * series[name][-1] + 7 + rng.normal())
    rows = [(k, i, v) for k, vs in series.items() for i, v in enumerate(vs)] + [("f", 0, None), ("f", 1, 2.0), ("f", 2, 3.0)]
    df = spark.createDataFrame(rows, "k string, t int, v double").repartition(4)
    fits = fit_autoregression(df, ["k"], ["t"], "v", 2)
    found = {r["k"]: r for r in fits.collect()}
    for name in "ab":
        v = np.array(series[name])
        design = np.column_stack([np.ones(len(v) - 2), v[:-2], v[1:-1]])
        best, left, *_ = np.linalg.lstsq(design, v[2:], rcond=None)
        got = found[name]
        assert [got["intercept"], *got["coefficients"]] == pytest.approx(best, rel=1e-6)
        assert got["rmse"] == pytest.approx(np.sqrt(left[0] / len(design)), rel=1e-6)
        assert got["last_value_rmse"] == pytest.approx(np.sqrt(((v[2:] - v[1:-1]) ** 2).mean()), rel=1e-6)
        assert got["rmse"] < got["last_value_rmse"]
    # values that never change, too few windows, and lags that tell the same are not fitted
    assert [found[k]["coefficients"] for k in "cde"] == [None] * 3 and found["c"]["last_value_rmse"] == 0
    assert found["e"]["last_value_rmse"] == pytest.approx(1) and "f" not in found
    told = {r["k"]: r["prediction"] for r in predicted_next(df, fits, ["k"], ["t"], "v", 2).collect()}
    a, v = found["a"], series["a"]
    assert told["a"] == pytest.approx(a["intercept"] + a["coefficients"][0] * v[-2] + a["coefficients"][1] * v[-1])
    assert (told["c"], told["d"]) == (3.0, 4.0)


@pytest.mark.parametrize("size", [0, 1, 7, 250, 299, 300, 400])
def test_exact_samples(spark, size):
    from tallyloom.operators.sampling import sample_exact

    keys = [i * 37 - 2000 for i in range(200)] + [5] * 60 + [None] * 40
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k long, i int").repartition(5)
    rows = sample_exact(df, "k", size).collect()
    assert len(rows) == min(size, 300) == len({r["i"] for r in rows})
    order = sorted(keys, key=lambda k: ((k % 2147483648) * 2654435761 % 4294967296 if k is not None else 1 << 32, k or 0))
    assert sorted((r["k"] for r in rows), key=str) == sorted(order[:size], key=str)
    assert df.columns == (rows[0].__fields__ if rows else df.columns)


def test_exact_fraction_is_the_same_for_every_layout(spark):
    from tallyloom.operators.sampling import sample_exact

    df = spark.range(1003)
    first, second = ({r[0] for r in sample_exact(d, "id", fraction=0.8).collect()} for d in (df, df.repartition(13)))
    assert first == second and len(first) == 802
