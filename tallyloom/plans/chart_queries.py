"""Chart reductions over line items and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.statistics import (
    _CENTRE_BOTTOM,
    _CENTRE_TOP,
    _TAIL_BOTTOM,
    _TAIL_TOP,
)
from tallyloom.operators import charts
from tallyloom.operators.ordering import quantiles
from tallyloom.plans.registry import query
from tallyloom.sources.files import read_table

DECILES = tuple(i / 10 for i in range(1, 10))
SQL_DECILES = "[" + ", ".join(f"{p}::double" for p in DECILES) + "]"


@query("histogram", """
with range as (select min(l_extendedprice) as low, max(l_extendedprice) as high from lineitem)
select cast(least(floor((l_extendedprice - low) / ((high - low) / 20.0::double)), 19) as bigint) as bin,
       count(*) as n, round(any_value(low) + bin * any_value((high - low) / 20.0::double), 6) as bin_start
from lineitem, range group by 1
""")
def histogram(spark: SparkSession, d: str) -> DataFrame:
    bins = charts.histogram(read_table(spark, d, "lineitem", "l_extendedprice"),
                            "l_extendedprice", 20)
    return bins.withColumn("bin_start", F.round("bin_start", 6))


@query("histogram_by_key", """
with range as (select min(l_quantity) as low, max(l_quantity) as high from lineitem)
select l_returnflag, l_linestatus,
       cast(least(floor((l_quantity - low) / ((high - low) / 10.0::double)), 9) as bigint) as bin,
       count(*) as n
from lineitem, range group by 1, 2, 3
""")
def histogram_by_key(spark: SparkSession, d: str) -> DataFrame:
    lines = read_table(spark, d, "lineitem", "l_returnflag", "l_linestatus", "l_quantity")
    return charts.histogram(lines, "l_quantity", 10, ["l_returnflag", "l_linestatus"]).drop("bin_start")


@query("agg_median", """
select l_returnflag, round(quantile_cont(l_extendedprice, 0.5), 6) as median from lineitem group by 1
""")
def median(spark: SparkSession, d: str) -> DataFrame:
    lines = read_table(spark, d, "lineitem", "l_returnflag", "l_extendedprice")
    return quantiles(lines, ["l_returnflag"], "l_extendedprice", [0.5]).select(
        "l_returnflag", F.round("quantile", 6).alias("median"))


@query("quantile_table", f"""
select l_returnflag, l_linestatus, unnest({SQL_DECILES}) as p,
       round(unnest(quantile_cont(l_extendedprice, {SQL_DECILES})), 4) as quantile
from lineitem group by 1, 2
""")
def quantile_table(spark: SparkSession, d: str) -> DataFrame:
    lines = read_table(spark, d, "lineitem", "l_returnflag", "l_linestatus", "l_extendedprice")
    table = charts.quantile_table(lines, ["l_returnflag", "l_linestatus"], "l_extendedprice", DECILES)
    return table.withColumn("quantile", F.round("quantile", 4))


@query("qq_two_sample", f"""
select l_returnflag, unnest({SQL_DECILES}) as p,
       round(unnest(quantile_cont(l_quantity, {SQL_DECILES})), 6) as first,
       round(unnest(quantile_cont(l_extendedprice, {SQL_DECILES})), 4) as second
from lineitem group by 1
""")
def qq_two(spark: SparkSession, d: str) -> DataFrame:
    lines = read_table(spark, d, "lineitem", "l_returnflag", "l_quantity", "l_extendedprice")
    pairs = charts.qq_two_sample(lines, ["l_returnflag"], "l_quantity", "l_extendedprice", DECILES)
    return pairs.withColumns({"first": F.round("first", 6), "second": F.round("second", 4)})


def _sql_polynomial(coefficients: tuple[float, ...], x: str) -> str:
    text = f"({coefficients[0]!r}::double)"
    for c in coefficients[1:]:
        text = f"({text} * {x} + ({c!r}::double))"
    return text


_R = "(p - 0.5::double)"
_Q_LOW = "sqrt(-2 * ln(p))"
_Q_HIGH = "sqrt(-2 * ln(1 - p))"
SQL_NORMAL = f"""case
  when p < 0.02425 then {_sql_polynomial(_TAIL_TOP, _Q_LOW)} / {_sql_polynomial(_TAIL_BOTTOM, _Q_LOW)}
  when p > 0.97575 then -({_sql_polynomial(_TAIL_TOP, _Q_HIGH)}) / {_sql_polynomial(_TAIL_BOTTOM, _Q_HIGH)}
  else {_sql_polynomial(_CENTRE_TOP, f"({_R} * {_R})")} * {_R}
       / {_sql_polynomial(_CENTRE_BOTTOM, f"({_R} * {_R})")} end"""
TAILS = (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99)
SQL_TAILS = "[" + ", ".join(f"{p}::double" for p in TAILS) + "]"


@query("qq_normal", f"""
with q as (select event_type, unnest({SQL_TAILS}) as p,
                  round(unnest(quantile_cont(value, {SQL_TAILS})), 6) as quantile
           from events group by 1)
select event_type, p, quantile, round({SQL_NORMAL}, 8) as normal from q
""")
def qq_normal(spark: SparkSession, d: str) -> DataFrame:
    table = charts.qq_normal(read_table(spark, d, "events", "event_type", "value"),
                             ["event_type"], "value", TAILS)
    return table.withColumns({"quantile": F.round("quantile", 6), "normal": F.round("normal", 8)})


FENCES = """
with parts as (
  select event_type, quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.5) as median,
         quantile_cont(value, 0.75) as q3 from events group by 1),
fences as (select *, q1 - 1.5 * (q3 - q1) as low, q3 + 1.5 * (q3 - q1) as high from parts)
"""


@query("boxplot_stats", FENCES + """
select event_type, round(q1, 6) as q1, round(median, 6) as median, round(q3, 6) as q3,
       min(value) filter (where value between low and high) as low_whisker,
       max(value) filter (where value between low and high) as high_whisker,
       count(*) filter (where not value between low and high) as outliers
from events join fences using (event_type) group by all
""")
def box_stats(spark: SparkSession, d: str) -> DataFrame:
    stats = charts.box_stats(read_table(spark, d, "events", "event_type", "value"),
                             ["event_type"], "value")
    return stats.withColumns({c: F.round(c, 6) for c in ("q1", "median", "q3")})


@query("boxplot_outliers", FENCES + """
select event_id, event_type, value from events join fences using (event_type)
where not value between low and high
""")
def box_outliers(spark: SparkSession, d: str) -> DataFrame:
    return charts.box_outliers(read_table(spark, d, "events", "event_id", "event_type", "value"),
                               ["event_type"], "value")


@query("kde_grid", """
with bounds as (select min(value) as low, max(value) as high from events),
grid as (select cast(i as integer) as cell, low + i * ((high - low) / 49.0::double) as x
         from bounds, range(50) t(i))
select cell, round(x, 6) as x,
       round(sum(exp(-0.5 * ((x - value) / 10) * ((x - value) / 10)) / sqrt(2 * pi()))
             / count(*) / 10, 9) as density
from events, grid group by cell, x
""")
def density(spark: SparkSession, d: str) -> DataFrame:
    curve = charts.kernel_density(read_table(spark, d, "events", "value"), "value", 10.0, 50)
    return curve.select("cell", F.round("x", 6).alias("x"), F.round("density", 9).alias("density"))


@query("loess_grid", """
with points as (select cast(json_extract_string(props, '$.k') as double) as px, value as py from events),
bounds as (select min(px) as low, max(px) as high, count(*) as total from points),
grid as (select cast(i as integer) as cell, low + i * ((high - low) / 19.0::double) as x,
                cast(ceil(0.3::double * total) as bigint) as needed
         from bounds, range(20) t(i)),
placed as (select cell, x, needed, px, py, abs(px - x) as distance,
                  row_number() over (partition by cell order by abs(px - x)) as nth
           from grid, points),
reach as (select cell, min(distance) as reach from placed where nth >= needed group by 1),
weighted as (
  select cell, x, px - x as dx, py,
         pow(1 - pow(distance / reach, 3), 3) as w
  from placed join reach using (cell) where distance < reach),
sums as (
  select cell, x, sum(w) as s0, sum(w * dx) as s1, sum(w * dx * dx) as s2, sum(w * py) as t0,
         sum(w * py * dx) as t1 from weighted group by 1, 2)
select cell, round(x, 6) as x, round((s2 * t0 - s1 * t1) / (s0 * s2 - s1 * s1), 6) as fitted from sums
""")
def local_fit(spark: SparkSession, d: str) -> DataFrame:
    points = read_table(spark, d, "events", "value", "props").select(
        "value", F.get_json_object("props", "$.k").cast("double").alias("k"))
    curve = charts.loess(points, "k", "value", 0.3, 20)
    return curve.select("cell", F.round("x", 6).alias("x"), F.round("fitted", 6).alias("fitted"))


MEASURES = ("l_quantity", "l_extendedprice", "l_discount")


@query("corr_matrix", " union all ".join(
    f"select '{a}' as first, '{b}' as second, round(corr({a}, {b}), 8) as correlation from lineitem"
    for a in MEASURES for b in MEASURES))
def correlations(spark: SparkSession, d: str) -> DataFrame:
    matrix = charts.correlation_matrix(read_table(spark, d, "lineitem", *MEASURES), MEASURES)
    return matrix.withColumn("correlation", F.round("correlation", 8))


@query("scatter_by_key", """
select l_returnflag, round(corr(l_quantity, l_extendedprice), 8) as correlation
from lineitem group by 1
""")
def scatter_by_key(spark: SparkSession, d: str) -> DataFrame:
    lines = read_table(spark, d, "lineitem", "l_returnflag", "l_quantity", "l_extendedprice")
    stats = charts.scatter_sample_stats(lines, ["l_returnflag"], "l_quantity", "l_extendedprice")
    return stats.withColumn("correlation", F.round("correlation", 8))
