import numpy as np
import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from tallyloom.operators import effects, models, sampling
from tallyloom.workspace import materialise


def test_splits_are_whole_and_repeatable(spark):
    df = spark.range(1000).withColumn("label", F.col("id") % 2)
    marked = sampling.hash_split(df, "id", 70)
    assert marked.filter("is_train").count() + marked.filter("not is_train").count() == 1000
    assert 600 < marked.filter("is_train").count() < 800
    again = sampling.hash_split(df.repartition(5), "id", 70)
    assert marked.exceptAll(again).count() == 0
    strata = sampling.stratified_split(df, "id", "label", {0: 100})
    counts = {(r["label"], r["is_train"]): r["count"] for r in strata.groupBy("label", "is_train").count().collect()}
    assert counts == {(0, True): 500, (1, False): 500}


def test_difference_is_distinct_and_sample_has_no_repeats(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (3,)], "x int")
    assert sorted(r["x"] for r in sampling.difference(df, df.filter("x = 3")).collect()) == [1, 2]
    sample = sampling.random_sample(spark.range(1000), 0.5, 3)
    assert sample.count() == sample.distinct().count()
    assert sampling.rows_not_in(spark.range(1000), sample, "id").count() == 1000 - sample.count()


def test_logistic_beats_guessing_and_gives_probabilities(spark):
    rng = np.random.default_rng(1)
    rows = [([float(a), float(b)], float(a + b > 0)) for a, b in rng.normal(size=(300, 2))]
    df = models.vector_features(spark.createDataFrame(rows, "v array<float>, y double"), "v")
    scored = models.class_probabilities(models.logistic("y", maxIter=20).fit(df).transform(df))
    assert scored.filter("p0 < 0 or p1 < 0 or abs(p0 + p1 - 1) > 1e-9").count() == 0
    assert scored.agg(models.accuracy(F.col("prediction"), F.col("y"))).first()[0] > 0.95


def test_svm_keeps_an_unseen_category(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("b", "y", 5.0)] * 20, "label string, c string, n double")
    model = models.formula_svm("label", "c + n").fit(df)
    scored = model.transform(df.unionByName(spark.createDataFrame([("a", "new", 1.0)], df.schema)))
    assert scored.count() == 41
    assert scored.filter("c <> 'new' and prediction <> label_idx").count() == 0


@pytest.mark.parametrize("cells", [1, 4, 1_000_000])
@pytest.mark.parametrize("kind", ["int", "string"])
def test_top_classes_of_any_model_size(spark, monkeypatch, cells, kind):
    monkeypatch.setattr(models, "BLOCK_CELLS", cells)
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [0.7, 0.6]), (4, None), (5, [1.0, None]), (6, [1.0])],
                               "id int, v array<float>")
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.5, 0.5]), (3, [0.5, 0.5])]
    weights = spark.createDataFrame(rows, "c int, weights array<double>").withColumn("c", F.col("c").cast(kind))
    best = models.top_classes(df, "v", weights, "c", 3)
    assert dict(best.schema["top"].dataType.elementType.jsonValue()["fields"][0])["type"] == {"int": "integer"}.get(kind, kind)
    top = {r["id"]: r["top"] and [int(t["label"]) for t in r["top"]] for r in best.collect()}
    assert top == {1: [0, 2, 3], 2: [1, 2, 3], 3: [0, 2, 3], 4: None, 5: None, 6: None}
    assert {len(r["top"]) for r in models.top_classes(df.where("id < 4"), "v", weights, "c", 9).collect()} == {4}
    assert [r["top"] for r in models.top_classes(df.where("id < 4"), "v", weights.limit(0), "c", 9).collect()] == [[]] * 3


def test_block_product_has_one_python_stage_and_is_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(8)
    x, w = rng.normal(size=(120, 4)).round(1), rng.normal(size=(30, 4)).round(1)
    df = spark.createDataFrame([(i, [float(v) for v in r], "kept") for i, r in enumerate(x)], "id int, v array<float>, _row string").repartition(5)
    weights = spark.createDataFrame([(f"c{i:02}", [float(v) for v in r]) for i, r in enumerate(w)], "c string, weights array<double>")
    plans = []
    for cells, rows in ((1_000_000, 4096), (8, 4096), (8, 7)):
        monkeypatch.setattr(models, "BLOCK_CELLS", cells)
        monkeypatch.setattr(models, "BLOCK_ROWS", rows)
        best = models.top_classes(df, "v", weights, "c", 3)
        plans.append(best._jdf.queryExecution().executedPlan().toString())
        for r in best.collect():
            scores = np.array([sum(np.float64(np.float32(a)) * b for a, b in zip(x[r["id"]], q)) for q in w])
            order = sorted(range(30), key=lambda i: (-scores[i].round(9), i))[:3]
            assert [t["score"] for t in r["top"]] == pytest.approx([scores[i] for i in order])
            assert r["_row"] == "kept"
    for plan in plans:
        assert plan.count("FlatMapCoGroupsInArrow") == 1 and "MapInArrow" not in plan.replace("FlatMapCoGroupsInArrow", "")


def test_centroids_are_means(spark):
    df = spark.createDataFrame([("a", [1.0, 3.0]), ("a", [3.0, 5.0]), ("b", [1.0, 1.0]), ("b", None), (None, [2.0, 2.0])],
                               "label string, v array<float>")
    found = {r["label"]: r["weights"] for r in models.centroids(df, "v", "label").collect()}
    assert found == {"a": [2.0, 4.0], "b": [1.0, 1.0], None: [2.0, 2.0]}


def test_null_levels_and_categories_keep_their_rows(spark):
    from tallyloom.operators import features

    df = spark.createDataFrame([("x", 1.0), (None, 2.0), ("b", 3.0), (None, 4.0), ("b", 5.0)], "f string, y double")
    codes = sorted(((r["f"] or "", r["code"]) for r in features.category_codes(df, "f", "code").collect()))
    assert codes == [("", -1), ("", -1), ("b", 0), ("b", 0), ("x", 1)]
    found = {r["level"]: r["n"] for r in effects.backfitted(effects.cells(df, ["f"], F.col("y")), ["f"], 5.0, 2).collect()}
    assert found == {"x": 1, None: 2, "b": 2}


def test_trees_take_many_categories(spark):
    df = spark.range(400).select((F.col("id") % 50).cast("string").alias("c"), (F.col("id") % 50 * 1.0).alias("y"))
    pipeline = models.boosted_regression(df, ["c"], [], "y", iterations=2)
    assert pipeline.fit(df).transform(df).count() == 400


def test_ols_against_numpy(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=200)
    y = 3 * x + 1 + rng.normal(size=200)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    slope, intercept = np.polyfit(x, y, 1)
    row = models.ols(df, "x", "y").first()
    assert (row["slope"], row["intercept"]) == (pytest.approx(slope), pytest.approx(intercept))
    residual = y - slope * x - intercept
    assert row["rmse"] == pytest.approx(np.sqrt((residual ** 2).mean()))


def test_backfitted_effects_against_a_loop(spark):
    rng = np.random.default_rng(3)
    rows = [(f"s{rng.integers(3)}", int(rng.integers(4)), float(rng.normal())) for _ in range(300)]
    df = spark.createDataFrame(rows, "a string, b int, y double")
    got = effects.backfitted(effects.cells(df, ["a", "b"], F.col("y")), ["a", "b"], 5.0, 3)
    y = np.array([r[2] for r in rows])
    keys = {"a": np.array([r[0] for r in rows]), "b": np.array([str(r[1]) for r in rows])}
    current = {f: np.zeros(len(y)) for f in keys}
    for _ in range(3):
        for f in keys:
            rest = y - y.mean() - sum(current[o] for o in keys if o != f)
            for level in set(keys[f]):
                at = keys[f] == level
                current[f][at] = rest[at].sum() / (at.sum() + 5.0)
    for row in got.collect():
        at = keys[row["factor"]] == row["level"]
        assert row["n"] == at.sum()
        assert row["effect"] == pytest.approx(current[row["factor"]][at][0])


def _planted(spark, seed=5, rows=6000):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(0, 60, rows), rng.integers(0, 50, rows)
    u, v = rng.normal(0, 2.0, 60), rng.normal(0, 1.0, 50)
    x = rng.integers(0, 2, rows)
    y = 1000 + 1.5 * x + u[a] + v[b] + rng.normal(0, 0.7, rows)
    df = spark.createDataFrame([(int(p), f"b{q}", int(r), float(s)) for p, q, r, s in zip(a, b, x, y)], "a int, b string, x int, y double")
    return df, u, v


def test_mixed_model_recovers_planted_variances(spark):
    df, u, v = _planted(spark)
    fit = effects.mixed_model(df.repartition(3), ["a", "b"], F.col("y"), F.col("x"))
    found = {r["term"]: r["estimate"] for r in fit.terms.collect()}
    assert fit.passes < 50
    assert found["slope"] == pytest.approx(1.5, abs=0.08)
    assert found["variance a"] == pytest.approx(u.var(), rel=0.1)
    assert found["variance b"] == pytest.approx(v.var(), rel=0.1)
    assert found["variance residual"] == pytest.approx(0.49, rel=0.05)
    assert found["intercept"] == pytest.approx(1000 + u.mean() + v.mean(), abs=0.3)
    rows = {(r["factor"], r["level"]): r for r in fit.levels.collect()}
    assert len(rows) == 110 and sum(r["n"] for k, r in rows.items() if k[0] == "a") == 6000
    assert np.corrcoef([rows["a", str(i)]["effect"] for i in range(60)], u)[0, 1] > 0.99
    assert all(0 < r["deviation"] < 0.3 for r in rows.values())


def test_mixed_model_sees_no_effect_where_there_is_none(spark):
    df, _, _ = _planted(spark)
    shuffled = df.withColumn("a", (F.xxhash64("y", "x") % 60).cast("int"))
    found = {r["term"]: r["estimate"] for r in effects.mixed_model(shuffled, ["a"], F.col("y"), F.col("x")).terms.collect()}
    assert found["variance a"] < 0.05 * found["variance residual"]


def test_mixed_model_edges(spark):
    rows = [("p", 1.0, 0), ("p", 2.0, 0), (None, 5.0, 0), (None, 6.0, 0), ("q", None, 0), ("q", 3.0, None)]
    df = spark.createDataFrame(rows, "a string, y double, x int")
    fit = effects.mixed_model(df, ["a"], F.col("y"), F.col("x"), passes=5)
    assert {r["level"]: r["n"] for r in fit.levels.collect()} == {"p": 2, None: 2}
    assert {r["term"]: r["estimate"] for r in fit.terms.collect()}["slope"] == 0  # x never changes
    assert effects.mixed_model(df.where("y > 99"), ["a"], F.col("y"), F.col("x")) is None
    same = effects.mixed_model(df.withColumn("y", F.lit(2.0)), ["a"], F.col("y"), F.lit(1))
    assert all(abs(r["estimate"]) < 1e-9 or r["term"] == "intercept" for r in same.terms.collect())


def _noise(*columns):
    return F.pmod(F.xxhash64(*columns, F.lit("noise")), F.lit(2)) == 0


def test_facts_fail_for_labels_that_nothing_predicts(spark, folder):
    from tallyloom.plans import model_queries as q
    from tallyloom.sources.files import read_table

    lines = read_table(spark, folder, "lineitem", "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_quantity", "l_discount",
                       "l_extendedprice")
    target = F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(1000)).cast("double")
    assert not q.regression_fact(lines.withColumn("target", target)).first()["explains_most"]
    docs = read_table(spark, folder, "documents", "doc_id", "lang", "source", "n_chars")
    kinds = q.classification_fact(docs.withColumn("kind", F.when(_noise("doc_id"), "yes").otherwise("no"))).collect()
    assert not any(r["accurate"] for r in kinds)
    vectors = models.vector_features(read_table(spark, folder, "embeddings", "vec_id", "embedding"), "embedding")
    assert not q.logistic_fact(vectors.withColumn("target", _noise("vec_id").cast("double"))).first()["accurate"]
    orders = read_table(spark, folder, "orders", "o_orderkey", "o_totalprice", "o_orderpriority")
    prices = q.svm_fact(orders.withColumn("price", F.when(_noise("o_orderkey"), "high").otherwise("low"))).collect()
    assert not any(r["accurate"] for r in prices)


def test_r_squared(spark):
    df = spark.createDataFrame([(1.0, 1.0, 2.5), (2.0, 2.0, 2.5), (3.0, 3.0, 2.5), (4.0, 4.0, 2.5)], "y double, right double, mean double")
    assert tuple(df.agg(models.r_squared(F.col("right"), F.col("y")), models.r_squared(F.col("mean"), F.col("y"))).first()) == (1.0, 0.0)


def test_texts_are_hashed_once_for_all_folds(spark):
    calls = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def text(i):
        calls.add(1)
        return f"{'abc'[i % 3]} {'xyz'[i % 3] if i % 5 else 'q'} w{i % 7}"

    rows = spark.range(90).select(F.col("id").alias("doc_id"), F.col("id").cast("int").alias("i")).withColumns(
        {"lang": F.concat(F.lit("l"), F.col("i") % 3), "fold": F.floor(F.col("i") / 9).cast("int") % 3})
    pipeline = models.text_pipeline("text", "lang", iterations=5)
    tuned = models.cross_validated(rows.withColumn("text", text("i")), pipeline, [2, 64], "fold", 3)
    assert 90 <= calls.value < 3 * 90
    fixed = materialise(rows.withColumn("text", text("i")), "fixed")
    hashing = pipeline.getStages()[2]
    plain = CrossValidator(
        estimator=pipeline, estimatorParamMaps=ParamGridBuilder().addGrid(hashing.numFeatures, [2, 64]).build(),
        evaluator=MulticlassClassificationEvaluator(labelCol="label_idx", metricName="accuracy"), numFolds=3, foldCol="fold").fit(fixed)
    assert tuned.avgMetrics == pytest.approx(plain.avgMetrics) and len(tuned.bestModel.stages) == len(plain.bestModel.stages) == 4
    assert tuned.bestModel.stages[2].getNumFeatures() == plain.bestModel.stages[2].getNumFeatures() == 64
    one, other = (m.bestModel.transform(fixed).select("doc_id", "features", "prediction", "label_idx").orderBy("doc_id").collect() for m in (tuned, plain))
    assert one == other


def _languages(spark, text):
    rows = spark.range(90).select(F.col("id").alias("doc_id"), F.col("id").cast("int").alias("i"))
    return rows.select("doc_id", text("i").alias("text"), F.concat(F.lit("l"), F.col("i") % 3).alias("lang"),
                       (F.floor(F.col("i") / 9).cast("int") % 3).alias("fold"))


def test_no_fold_is_kept_in_memory(spark, monkeypatch):
    rows = _languages(spark, lambda i: F.concat(F.lit("w"), F.col(i) % 3))
    kept = []
    for name in ("persist", "cache"):
        monkeypatch.setattr(type(rows), name, lambda self, *level: kept.append(self) or self)
    tuned = models.cross_validated(rows, models.text_pipeline("text", "lang", iterations=5), [2, 64], "fold", 3)
    assert not kept and len(tuned.avgMetrics) == len(tuned.stdMetrics) == 2 and tuned.avgMetrics[1] == 1
    assert tuned.bestModel.stages[-1].getMaxBlockSizeInMB() < 0.5


def test_folds_out_of_range_are_refused(spark):
    rows = _languages(spark, lambda i: F.lit("a b"))
    pipeline = models.text_pipeline("text", "lang", iterations=2)
    for fold in (F.lit(3), F.lit(None).cast("int")):
        with pytest.raises(Exception, match="Fold number|fold"):
            models.cross_validated(rows.withColumn("fold", fold), pipeline, [2], "fold", 3)
    with pytest.raises(ValueError, match="empty"):
        models.cross_validated(rows.withColumn("fold", F.lit(0)), pipeline, [2], "fold", 3)


def test_the_best_model_scores_every_text(spark):
    from tallyloom.plans import model_queries as q

    calls = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def text(i):
        calls.add(1)
        return f"w{i % 3}"

    facts = [tuple(r) for r in q.cross_validation_facts(_languages(spark, text)).collect()]
    assert facts == [(1000, True, 90), (2000, True, 90)] and calls.value >= 2 * 90
