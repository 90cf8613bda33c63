"""Feature preparation, models, metrics and group effects."""

from __future__ import annotations

from pyspark.ml.feature import HashingTF, Tokenizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions import cleaning as clean
from tallyloom.functions import statistics
from tallyloom.operators import effects, features, models
from tallyloom.operators.ordering import quantiles
from tallyloom.operators.sampling import hash_bucket
from tallyloom.plans.registry import query
from tallyloom.sources import sinks
from tallyloom.sources.files import read_table
from tallyloom.workspace import materialise, scratch_path

CUTS = "[" + ", ".join(f"{i / 10}::double" for i in range(1, 10)) + "]"


@query("quantile_bins", f"""
with cuts as (select quantile_disc(l_extendedprice, {CUTS}) as c from lineitem)
select l_orderkey, l_linenumber, l_extendedprice,
       cast(len(list_filter(c, lambda x: x <= l_extendedprice)) as double) as price_bin
from lineitem, cuts
""")
def quantile_bins(spark: SparkSession, d: str) -> DataFrame:
    lines = read_table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_extendedprice")
    return features.quantile_bins(lines, "l_extendedprice", 10, "price_bin")


@query("index_category", """
select event_type, count(*) as n,
       cast(row_number() over (order by count(*) desc, event_type) - 1 as double) as category_index
from events group by 1
""")
def category_index(spark: SparkSession, d: str) -> DataFrame:
    return features.category_index(read_table(spark, d, "events", "event_type"), "event_type")


@query("index_category_rows", """
with idx as (select p_name, row_number() over (order by count(*) desc, p_name) - 1 as i
             from part group by 1)
select p_partkey, cast(i as double) as name_index from part join idx using (p_name)
""")
def category_index_rows(spark: SparkSession, d: str) -> DataFrame:
    part = read_table(spark, d, "part", "p_partkey", "p_name")
    return features.with_category_index(part, "p_name", "name_index").drop("p_name")


@query("category_codes", """
select c_custkey, dense_rank() over (order by c_mktsegment) - 1 as code from customer
""")
def category_codes(spark: SparkSession, d: str) -> DataFrame:
    customers = read_table(spark, d, "customer", "c_custkey", "c_mktsegment")
    return features.category_codes(customers, "c_mktsegment", "code").drop("c_mktsegment")


@query("category_codes_null", """
select c_custkey, case when c_mktsegment = 'BUILDING' then -1
  else dense_rank() over (order by nullif(c_mktsegment, 'BUILDING') nulls last) - 1 end as code from customer
""")
def category_codes_null(spark: SparkSession, d: str) -> DataFrame:
    """Rows without a category keep their place, with code -1."""
    customers = read_table(spark, d, "customer", "c_custkey", "c_mktsegment").select(
        "c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"))
    return features.category_codes(customers, "segment", "code").drop("segment")


@query("token_counts", r"""
select token, count(*) as n
from (select unnest(regexp_split_to_array(lower(text), '[ \t\n\v\f\r]')) as token from documents)
group by 1
""")
def token_counts(spark: SparkSession, d: str) -> DataFrame:
    return features.token_counts(read_table(spark, d, "documents", "text"), "text")


@query("text_features", r"""
select doc_id, cast(len(regexp_split_to_array(lower(text), '[ \t\n\v\f\r]')) as double) as words, true as spread
from documents
""")
def text_features(spark: SparkSession, d: str) -> DataFrame:
    """Hashed term frequencies: their sum is the number of words, and few distinct words share a place."""
    words = Tokenizer(inputCol="text", outputCol="words").transform(
        read_table(spark, d, "documents", "doc_id", "text"))
    hashed = HashingTF(inputCol="words", outputCol="features").transform(words)
    values = F.get_json_object(F.to_json(F.struct("features")), "$.features.values")
    counts = F.from_json(values, "array<double>")
    distinct = F.size(F.array_distinct("words"))
    return hashed.select("doc_id", F.aggregate(counts, F.lit(0.0), lambda total, x: total + x).alias("words"),
                         (F.size(counts).between(0.97 * distinct - 2, distinct)).alias("spread"))


def _prices(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_quantity",
                      "l_extendedprice")


OLS = """
select round(regr_intercept(l_extendedprice, l_quantity), 4) as intercept,
       round(regr_slope(l_extendedprice, l_quantity), 6) as slope,
       round(regr_r2(l_extendedprice, l_quantity), 8) as r2,
       round(sqrt(regr_syy(l_extendedprice, l_quantity)
                  * (1 - regr_r2(l_extendedprice, l_quantity)) / count(*)), 4) as rmse
from lineitem
"""


@query("ols_simple", OLS)
def ols_simple(spark: SparkSession, d: str) -> DataFrame:
    fit = models.ols(_prices(spark, d), "l_quantity", "l_extendedprice")
    return fit.select(F.round("intercept", 4).alias("intercept"), F.round("slope", 6).alias("slope"),
                      F.round("r2", 8).alias("r2"), F.round("rmse", 4).alias("rmse"))


@query("ml_linear", OLS)
def ml_linear(spark: SparkSession, d: str) -> DataFrame:
    """The same fit by the machine-learning library."""
    model = models.linear_regression(["l_quantity"], "l_extendedprice", solver="normal").fit(
        _prices(spark, d)).stages[-1]
    numbers = (model.intercept, model.coefficients[0], model.summary.r2,
               model.summary.rootMeanSquaredError)
    names, digits = ("intercept", "slope", "r2", "rmse"), (4, 6, 8, 4)
    return spark.range(1).select(*[
        F.round(F.lit(float(v)), k).alias(n) for v, n, k in zip(numbers, names, digits)])


@query("ols_residuals", """
with fit as (select regr_intercept(l_extendedprice, l_quantity) as a,
                    regr_slope(l_extendedprice, l_quantity) as b from lineitem)
select l_orderkey, l_linenumber, l_quantity, round(l_extendedprice - (a + b * l_quantity), 3) as residual
from lineitem, fit
""")
def ols_residuals(spark: SparkSession, d: str) -> DataFrame:
    rows = models.with_ols_residual(_prices(spark, d), "l_quantity", "l_extendedprice")
    return rows.select("l_orderkey", "l_linenumber", "l_quantity",
                       F.round("residual", 3).alias("residual"))


@query("worst_errors", """
with fit as (select regr_intercept(l_extendedprice, l_quantity) as a,
                    regr_slope(l_extendedprice, l_quantity) as b from lineitem)
select l_orderkey, l_linenumber, round(abs(a + b * l_quantity - l_extendedprice), 3) as error
from lineitem, fit order by abs(a + b * l_quantity - l_extendedprice) desc, l_orderkey limit 10
""")
def worst_errors(spark: SparkSession, d: str) -> DataFrame:
    rows = models.with_ols_residual(_prices(spark, d), "l_quantity", "l_extendedprice")
    worst = models.worst_rows(rows, "prediction", "l_extendedprice", "l_orderkey")
    return worst.select("l_orderkey", "l_linenumber",
                        F.round(F.abs("residual"), 3).alias("error"))


@query("corr_pearson", """
select round(corr(l_quantity, l_extendedprice), 8) as correlation from lineitem
""")
def correlation(spark: SparkSession, d: str) -> DataFrame:
    return _prices(spark, d).agg(
        F.round(statistics.pearson("l_quantity", "l_extendedprice"), 8).alias("correlation"))


@query("metric_accuracy", """
with scored as (select quality, case when n_chars > (select quantile_cont(n_chars, 0.5) from documents)
                then 1 else 0 end as predicted from labels join documents using (doc_id))
select count(*) as rows, round(avg(case when quality = predicted then 1.0 else 0.0 end), 8) as accuracy,
       round(1 - avg(case when quality = predicted then 1.0 else 0.0 end), 8) as test_error
from scored
""")
def metric_accuracy(spark: SparkSession, d: str) -> DataFrame:
    documents = read_table(spark, d, "documents", "doc_id", "n_chars")
    middle = quantiles(documents, [], "n_chars", [0.5]).select("quantile").scalar()
    scored = documents.withColumn("predicted", (F.col("n_chars") > middle).cast("int")).join(
        read_table(spark, d, "labels", "doc_id", "quality"), "doc_id")
    right = models.accuracy(F.col("predicted"), F.col("quality"))
    return scored.agg(F.count(F.lit(1)).alias("rows"), F.round(right, 8).alias("accuracy"),
                      F.round(1 - right, 8).alias("test_error"))


@query("metric_rmse", """
select round(sqrt(avg((l_extendedprice - m) * (l_extendedprice - m))), 4) as rmse
from lineitem, (select avg(l_extendedprice) as m from lineitem)
""")
def metric_rmse(spark: SparkSession, d: str) -> DataFrame:
    lines = read_table(spark, d, "lineitem", "l_extendedprice")
    mean = lines.select(F.avg("l_extendedprice")).scalar()
    scored = lines.withColumn("predicted", mean)
    return scored.agg(F.round(
        models.rmse(F.col("predicted"), F.col("l_extendedprice")), 4).alias("rmse"))


BUCKET = "({key} % 2147483648 * 2654435761 % 4294967296) % 100"


def _held_out(key: str, share: int) -> tuple:
    """Conditions for rows to fit and rows kept from the fit."""
    return hash_bucket(key) < share, hash_bucket(key) >= share


@query("ml_gbt_regress", f"""
select count(*) as test_rows, true as explains_most from lineitem where {BUCKET.format(key='l_orderkey')} >= 70
""")
def gbt_regress(spark: SparkSession, d: str) -> DataFrame:
    """Boosted trees on the price after discount; on rows kept from the fit they explain over 80 % of its variance."""
    lines = read_table(spark, d, "lineitem", "l_orderkey", "l_returnflag", "l_linestatus",
                       "l_quantity", "l_discount", "l_extendedprice")
    return regression_fact(lines.withColumn("target", F.col("l_extendedprice") * (1 - F.col("l_discount"))))


def regression_fact(lines: DataFrame) -> DataFrame:
    train, test = _held_out("l_orderkey", 70)
    model = models.boosted_regression(
        lines, ["l_returnflag", "l_linestatus"], ["l_quantity", "l_discount", "l_extendedprice"], "target").fit(lines.filter(train))
    return model.transform(lines.filter(test)).agg(
        F.count(F.lit(1)).alias("test_rows"), (models.r_squared(F.col("prediction"), F.col("target")) > 0.8).alias("explains_most"))


def _labelled_documents(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """Documents with their label, joined once and written, as training reads them often."""
    rows = read_table(spark, d, "documents", "doc_id", *columns).join(
        read_table(spark, d, "labels", "doc_id", "quality"), "doc_id")
    return materialise(rows, "labelled")


@query("ml_gbt_classify", f"""
with middle as (select quantile_cont(n_chars, 0.5) as m from documents)
select case when n_chars > m and lang <> 'en' then 'yes' else 'no' end as kind, count(*) as n, true as known_labels, true as accurate
from documents cross join middle where {BUCKET.format(key='doc_id')} >= 70 group by 1
""")
def gbt_classify(spark: SparkSession, d: str) -> DataFrame:
    """Long documents that are not English, by boosted trees on length bins and categories; over 90 % right on rows kept from the fit."""
    rows = read_table(spark, d, "documents", "doc_id", "lang", "source", "n_chars")
    middle = quantiles(rows, [], "n_chars", [0.5]).select("quantile").scalar()
    kind = F.when((F.col("n_chars") > middle) & (F.col("lang") != "en"), "yes").otherwise("no")
    return classification_fact(materialise(rows.withColumn("kind", kind), "kinds"))


def classification_fact(rows: DataFrame) -> DataFrame:
    train, test = _held_out("doc_id", 70)
    model = models.boosted_classifier(rows, "kind", "n_chars", ["lang", "source"]).fit(rows.filter(train))
    scored = materialise(model.transform(rows.filter(test)).select("kind", "predicted_label"), "scored")
    right = scored.agg(models.accuracy(F.col("predicted_label"), F.col("kind"))).scalar()
    return scored.groupBy("kind").agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(F.col("predicted_label").isin("yes", "no")).alias("known_labels")
    ).withColumn("accurate", right > 0.9)


@query("ml_logistic", f"""
select count(*) as test_rows, true as sums_to_one, true as accurate
from embeddings where {BUCKET.format(key='vec_id')} >= 70
""")
def ml_logistic(spark: SparkSession, d: str) -> DataFrame:
    """On which side of a plane a vector lies, by logistic regression; over 85 % right on rows kept from the fit."""
    rows = read_table(spark, d, "embeddings", "vec_id", "embedding")
    side = (F.aggregate("embedding", F.lit(0.0), lambda s, x: F.lit(-0.5) * s + x) > 0).cast("double")
    return logistic_fact(models.vector_features(rows.withColumn("target", side), "embedding"))


def logistic_fact(rows: DataFrame) -> DataFrame:
    train, test = _held_out("vec_id", 70)
    model = models.logistic("target", maxIter=50, regParam=0.001).fit(rows.filter(train))
    scored = models.class_probabilities(model.transform(rows.filter(test)))
    return scored.agg(
        F.count(F.lit(1)).alias("test_rows"), F.bool_and(F.abs(F.col("p0") + F.col("p1") - 1) < 1e-9).alias("sums_to_one"),
        (models.accuracy(F.col("prediction"), F.col("target")) > 0.85).alias("accurate"))


@query("ml_linear_svm", f"""
with middle as (select quantile_cont(o_totalprice, 0.5) as m from orders)
select case when o_totalprice > m then 'high' else 'low' end as price, count(*) as n, true as known_labels, true as accurate
from orders cross join middle where {BUCKET.format(key='o_orderkey')} >= 75 group by 1
""")
def linear_svm(spark: SparkSession, d: str) -> DataFrame:
    """Orders above the middle price by a support vector machine on a formula; over 90 % right on rows kept from the fit."""
    rows = read_table(spark, d, "orders", "o_orderkey", "o_totalprice", "o_orderpriority")
    middle = quantiles(rows, [], "o_totalprice", [0.5]).select("quantile").scalar()
    return svm_fact(rows.withColumn("price", F.when(F.col("o_totalprice") > middle, "high").otherwise("low")))


def svm_fact(rows: DataFrame) -> DataFrame:
    train, test = _held_out("o_orderkey", 75)
    model = models.formula_svm("price", "o_totalprice + o_orderpriority", iterations=50).fit(rows.filter(train))
    scored = materialise(model.transform(rows.filter(test)).select("price", "prediction", "label_idx"), "scored")
    right = scored.agg(models.accuracy(F.col("prediction"), F.col("label_idx"))).scalar()
    return scored.groupBy("price").agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(F.col("prediction").isin(0.0, 1.0)).alias("known_labels")
    ).withColumn("accurate", right > 0.9)


@query("ml_cross_validate", """
select unnest([1000, 2000]) as features, true as accurate,
  (select count(*) from documents) as scored_rows
""")
def cross_validate(spark: SparkSession, d: str) -> DataFrame:
    """Languages told apart by hashed text features, over 80 % right in every setting, and the best model over all rows."""
    rows = materialise(read_table(spark, d, "documents", "doc_id", "text", "lang"), "texts")
    return cross_validation_facts(rows.withColumn("fold", hash_bucket("doc_id", 3).cast("int")))


def cross_validation_facts(rows: DataFrame) -> DataFrame:
    sizes = [1000, 2000]
    tuned = models.cross_validated(rows, models.text_pipeline("text", "lang"), sizes, "fold", 3)
    # a test of the value: a prediction is never null, and to test only that no row is scored
    scored = tuned.bestModel.transform(rows).filter(F.col("prediction") >= 0).count()
    return rows.sparkSession.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("features"), F.lit(bool(m > 0.8)).alias("accurate"), F.lit(scored).cast("long").alias("scored_rows"))
        for n, m in zip(sizes, tuned.avgMetrics)])))


@query("ml_save_load_score", """
select count(*) as rows, cast(0 as bigint) as different from documents join labels using (doc_id)
""")
def save_load(spark: SparkSession, d: str) -> DataFrame:
    """A saved text pipeline scores like the one in memory."""
    rows = _labelled_documents(spark, d, "text")
    model = models.text_pipeline("text", "quality").fit(rows)
    again = sinks.save_and_reload(model, scratch_path(spark, "model"))
    first = models.class_probabilities(model.transform(rows)).select("doc_id", F.col("p1").alias("a"))
    second = models.class_probabilities(again.transform(rows)).select("doc_id", F.col("p1").alias("b"))
    return first.join(second, "doc_id").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("a") != F.col("b")).alias("different"))


SCORES = """
with cells as (select vec_id, label, unnest(embedding)::double as x,
                      unnest(range(len(embedding))) as place from embeddings),
model as (select label, place, avg(x) as w from cells group by 1, 2),
scores as (select c.vec_id, m.label, sum(c.x * m.w) as score
           from cells c join model m using (place) group by 1, 2),
ranked as (select *, row_number() over (partition by vec_id order by score desc, label) as nth from scores)
"""


@query("score_topk", SCORES + """
select vec_id, string_agg(cast(label as varchar), ',' order by nth) as classes,
       round(max(score), 6) as best_score
from ranked where nth <= 3 group by 1
""")
def score_topk(spark: SparkSession, d: str) -> DataFrame:
    rows = read_table(spark, d, "embeddings", "vec_id", "embedding", "label")
    best = models.top_classes(rows, "embedding", models.centroids(rows, "embedding", "label"), "label", 3)
    return best.select(
        "vec_id", F.array_join(F.col("top.label").cast("array<string>"), ",").alias("classes"),
        F.round(F.col("top")[0]["score"], 6).alias("best_score"))


@query("batch_inference", SCORES + """
select vec_id, label as best_class, round(score, 6) as score from ranked where nth = 1
""")
def batch_inference(spark: SparkSession, d: str) -> DataFrame:
    rows = read_table(spark, d, "embeddings", "vec_id", "embedding", "label")
    best = models.top_classes(rows.select("vec_id", "embedding"), "embedding",
                              models.centroids(rows, "embedding", "label"), "label")
    return best.select("vec_id", F.col("top")[0]["label"].alias("best_class"),
                       F.round(F.col("top")[0]["score"], 6).alias("score"))


FACTORS = ("c_mktsegment", "c_nationkey", "o_orderpriority")
SHRINKAGE = 10.0


def order_cells(spark: SparkSession, d: str) -> DataFrame:
    """Order prices summed per segment, nation and priority; customers are joined to sums."""
    price = clean.exact("o_totalprice")
    orders = read_table(spark, d, "orders", "o_custkey", "o_orderpriority", "o_totalprice")
    per_customer = orders.groupBy("o_custkey", "o_orderpriority").agg(
        F.count(price).alias("n"), F.sum(price).alias("total"))
    customers = read_table(spark, d, "customer", "c_custkey", "c_mktsegment", "c_nationkey")
    return (
        per_customer.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(*FACTORS).agg(F.sum("n").alias("n"),
                               F.sum("total").cast("double").alias("total")))


def _effect_sql(factor: str) -> str:
    return f"""
select '{factor}' as factor, cast({factor} as varchar) as level, count(*) as n,
       avg(o_totalprice) - any_value(m) as raw,
       count(*) * (avg(o_totalprice) - any_value(m)) / (count(*) + 10.0::double) as effect
from orders join customer on o_custkey = c_custkey, (select avg(o_totalprice) as m from orders)
group by {factor}"""


EFFECTS = "with effects as (" + " union all ".join(_effect_sql(f) for f in FACTORS) + ")"


@query("group_effects", EFFECTS + """
select factor, level, n, round(effect, 4) as effect from effects
""")
def group_effects(spark: SparkSession, d: str) -> DataFrame:
    table = effects.effects(order_cells(spark, d), FACTORS, SHRINKAGE)
    return table.select("factor", "level", "n", F.round("effect", 4).alias("effect"))


def _backfit_sql(passes: int, segment: str = "c_mktsegment", digits: int = 3) -> str:
    """The refitting steps written out one after the other; null is a level like any other."""
    steps = [f"""cells as (
  select {segment} as c_mktsegment, c_nationkey, o_orderpriority, count(*) as n, sum(o_totalprice) as total
  from orders join customer on o_custkey = c_custkey group by 1, 2, 3),
mean as (select sum(total) / sum(n) as m from cells)"""]
    latest: dict[str, str] = {}
    for step in range(passes):
        for factor in FACTORS:
            name = f"e{step}_{factor}"
            others = [f for f in FACTORS if f != factor and f in latest]
            joins = "".join(f" join {latest[f]} on cells.{f} is not distinct from {latest[f]}.{f}" for f in others)
            expected = " + ".join(["m", *[f"{latest[f]}.effect" for f in others]])
            steps.append(f"""{name} as (
  select cells.{factor}, sum(n) as size, sum(total - n * ({expected})) / (sum(n) + 10.0::double) as effect
  from cells cross join mean{joins} group by cells.{factor})""")
            latest[factor] = name
    return "with " + ",\n".join(steps) + " union all ".join(
        f"\nselect '{f}' as factor, cast({f} as varchar) as level, cast(size as bigint) as n, "
        f"round(effect, {digits}) as effect from {latest[f]}" for f in FACTORS)


@query("group_effects_backfit", _backfit_sql(2))
def group_effects_backfit(spark: SparkSession, d: str) -> DataFrame:
    table = effects.backfitted(order_cells(spark, d), FACTORS, SHRINKAGE, passes=2)
    return table.withColumn("effect", F.round("effect", 3))


@query("group_effects_backfit_null", _backfit_sql(2, "nullif(c_mktsegment, 'BUILDING')"))
def group_effects_backfit_null(spark: SparkSession, d: str) -> DataFrame:
    """One factor has a null level, which is a level like any other."""
    rows = order_cells(spark, d).withColumn("c_mktsegment", F.nullif("c_mktsegment", F.lit("BUILDING")))
    return effects.backfitted(rows, FACTORS, SHRINKAGE, passes=2).withColumn("effect", F.round("effect", 3))


@query("effects_compare", "with alone as (" + EFFECTS + """
select factor, level, effect from effects), together as (""" + _backfit_sql(2, digits=12) + """)
select factor, count(*) as levels, round(corr(a.effect, b.effect), 4) as correlation,
       round(max(abs(a.effect - b.effect)), 2) as largest_difference
from alone a join together b using (factor, level) group by 1
""")
def effects_compare(spark: SparkSession, d: str) -> DataFrame:
    """Each factor on its own against all factors together."""
    rows = order_cells(spark, d)
    same = effects.compared(effects.effects(rows, FACTORS, SHRINKAGE), effects.backfitted(rows, FACTORS, SHRINKAGE, passes=2),
                            ["factor", "level"], "effect", "effect")
    return same.select("factor", "levels", F.round("correlation", 4).alias("correlation"),
                       F.round("largest_difference", 2).alias("largest_difference"))


def _mixed_sql(passes: int) -> str:
    """The passes of the mixed model written out: effects of each factor, its variance, then level, slope and noise."""
    steps = ["""means as (
  select avg(o_totalprice / 1000) as my, avg((o_orderstatus = 'F')::int) as mx from orders join customer on o_custkey = c_custkey),
cells as (
  select c_mktsegment, c_nationkey, o_orderpriority, count(*) as n, sum(y) as y, sum(x) as x, sum(y * y) as yy, sum(x * x) as xx,
         sum(x * y) as xy
  from (select c_mktsegment, c_nationkey, o_orderpriority, o_totalprice / 1000 - my as y, (o_orderstatus = 'F')::int - mx as x
        from orders join customer on o_custkey = c_custkey cross join means) group by 1, 2, 3),
p0 as (select 0.0::double as m, 0.0::double as b, sum(yy) / sum(n) / 4 as noise from cells)"""]
    steps += [f"v0_{f} as (select noise as v from p0)" for f in FACTORS]
    latest: dict[str, str] = {}
    for k in range(1, passes + 1):
        for factor in FACTORS:
            others = [f for f in FACTORS if f != factor and f in latest]
            joins = "".join(f" join {latest[f]} on cells.{f} = {latest[f]}.{f}" for f in others)
            expected = " + ".join(["m", *[f"{latest[f]}.effect" for f in others]])
            name = f"e{k}_{factor}"
            steps.append(f"""{name} as (
  select {factor}, size, excess / (size + noise / v) as effect, noise / (size + noise / v) as width
  from (select cells.{factor}, sum(n) as size, sum(y - b * x - n * ({expected})) as excess
        from cells cross join p{k - 1}{joins} group by 1) cross join p{k - 1} cross join v{k - 1}_{factor})""")
            steps.append(f"v{k}_{factor} as (select avg(effect * effect + width) as v from {name})")
            latest[factor] = name
        joins = "".join(f" join {latest[f]} on cells.{f} = {latest[f]}.{f}" for f in FACTORS)
        offset = " + ".join(f"{latest[f]}.effect" for f in FACTORS)
        widths = " + ".join(f"(select sum(size * width) from {latest[f]})" for f in FACTORS)
        steps.append(f"""left{k} as (
  select sum(n) as n, sum(y - n * o) as y, sum(x) as x, sum(xx) as xx, sum(xy - x * o) as xy, sum(yy - 2 * o * y + n * o * o) as yy
  from (select cells.*, {offset} as o from cells{joins})),
fit{k} as (select *, (n * xy - x * y) / (n * xx - x * x) as b from left{k}),
p{k} as (
  select (y - b * x) / n as m, b,
    (yy - 2 * (y - b * x) / n * y - 2 * b * xy + pow((y - b * x) / n, 2) * n + 2 * (y - b * x) / n * b * x + b * b * xx + {widths}) / n as noise
  from fit{k})""")
    terms = [f"select 'intercept' as term, my + m - b * mx as estimate from p{passes}, means", f"select 'slope', b from p{passes}",
             *[f"select 'variance {f}', v from v{passes}_{f}" for f in FACTORS], f"select 'variance residual', noise from p{passes}"]
    return "with " + ",\n".join(steps) + "\nselect term, round(estimate, 3) as estimate from (" + " union all ".join(terms) + ")"


@query("group_effects_variance", _mixed_sql(3))
def group_effects_variance(spark: SparkSession, d: str) -> DataFrame:
    """Variances of three crossed factors of order prices, besides a level and the slope of a finished order."""
    rows = read_table(spark, d, "orders", "o_custkey", "o_totalprice", "o_orderpriority", "o_orderstatus").join(
        read_table(spark, d, "customer", "c_custkey", "c_mktsegment", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    fit = effects.mixed_model(rows, FACTORS, F.col("o_totalprice") / 1000, (F.col("o_orderstatus") == "F").cast("int"),
                              passes=3, tolerance=0)
    return fit.terms.withColumn("estimate", F.round("estimate", 3))
