"""Joins, aggregates, ranking and limits over the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions import cleaning as clean
from tallyloom.functions.statistics import geometric_mean
from tallyloom.operators import aggregates, joins, ranking
from tallyloom.plans.registry import query
from tallyloom.sources import files, sinks
from tallyloom.sources.files import read_table
from tallyloom.workspace import scratch_path


def revenue() -> Column:
    return (F.col("l_extendedprice").cast("decimal(12,2)")
            * (F.lit(1).cast("decimal(4,2)") - F.col("l_discount").cast("decimal(4,2)")))


SQL_REVENUE = "cast(l_extendedprice as decimal(12,2)) * (1 - cast(l_discount as decimal(4,2)))"


def revenue_by_segment_year(spark: SparkSession, d: str) -> DataFrame:
    """Revenue per (year, segment); each step is aggregated before the next join.

    Lines shrink to one row per order, orders to one row per customer and
    year, so neither a frequent order nor a frequent customer skews a join.
    """
    lines = read_table(spark, d, "lineitem", "l_orderkey", "l_extendedprice", "l_discount")
    orders = read_table(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    customers = read_table(spark, d, "customer", "c_custkey", "c_mktsegment")
    per_order = lines.groupBy("l_orderkey").agg(F.sum(revenue()).alias("revenue"))
    per_customer = (
        per_order.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("o_custkey", F.year("o_orderdate").alias("year"))
        .agg(F.sum("revenue").alias("revenue")))
    return (
        per_customer.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("year", F.col("c_mktsegment").alias("segment"))
        .agg(F.sum("revenue").cast("double").alias("revenue")))


SQL_SEGMENT_YEAR = f"""
  select cast(year(o_orderdate) as integer) as year, c_mktsegment as segment,
         cast(sum({SQL_REVENUE}) as double) as revenue
  from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
  group by 1, 2"""


@query("topn_per_group", f"""
select year, segment, revenue, cast(place as integer) as place from (
  select *, rank() over (partition by year order by revenue desc nulls last) as place
  from ({SQL_SEGMENT_YEAR}) where revenue is not null and revenue <> 0)
where place <= 3
""")
def best_segments(spark: SparkSession, d: str) -> DataFrame:
    return ranking.top_per_group(revenue_by_segment_year(spark, d), ["year"], "revenue", 3)


@query("topn_unknown_after_rank", """
with banded as (
  select event_type, coalesce(case when k < 30 then 'low' when k < 50 then 'middle'
         when k < 60 then 'upper' when k < 66 then 'top' end, 'Unknown') as band
  from (select event_type, cast(json_extract_string(props, '$.k') as integer) as k from events)),
counted as (select event_type, band, count(*) as n from banded group by 1, 2)
select event_type, band, n, cast(place as integer) as place from (
  select *, rank() over (partition by event_type order by n desc) as place from counted)
where place <= 3 and band <> 'Unknown'
""")
def best_known_bands(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("k")
    events = read_table(spark, d, "events", "event_type", "props").select(
        "event_type", F.get_json_object("props", "$.k").cast("int").alias("k"))
    band = (F.when(k < 30, "low").when(k < 50, "middle").when(k < 60, "upper").when(k < 66, "top"))
    counts = events.groupBy("event_type", clean.unknown_bucket(band).alias("band")).agg(
        F.count(F.lit(1)).alias("n"))
    return ranking.top_known_per_group(counts, ["event_type"], "n", 3, ["band"])


@query("join_inner", """
select o_orderkey, o_totalprice, c_name, c_mktsegment
from orders join customer on o_custkey = c_custkey
""")
def inner(spark: SparkSession, d: str) -> DataFrame:
    return joins.inner_join(
        read_table(spark, d, "orders"), read_table(spark, d, "customer"),
        [("o_custkey", "c_custkey")], ["o_orderkey", "o_totalprice", "c_name", "c_mktsegment"])


@query("join_using_filtered", """
select l_orderkey as order_id, l_linenumber, o_orderstatus
from lineitem join orders on l_orderkey = o_orderkey
where o_orderkey % 3 <> 0 and o_orderkey % 4 <> 0
""")
def using_filtered(spark: SparkSession, d: str) -> DataFrame:
    lines = read_table(spark, d, "lineitem", "l_orderkey", "l_linenumber").withColumnRenamed(
        "l_orderkey", "order_id")
    key = F.col("o_orderkey")
    orders = read_table(spark, d, "orders").select(
        key.alias("order_id"), F.when(key % 3 != 0, F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(key % 4 != 0, F.col("o_orderpriority")).alias("o_orderpriority"))
    kept = orders.filter(F.col("o_orderstatus").isNotNull() & F.col("o_orderpriority").isNotNull())
    return lines.join(kept, ["order_id"]).select("order_id", "l_linenumber", "o_orderstatus")


def _key_sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Nations and customers under names that only agree once normalised."""
    nations = read_table(spark, d, "nation").withColumn(
        "name", F.regexp_replace("n_name", "_", " "))
    customers = read_table(spark, d, "customer").withColumn(
        "page", F.concat(F.lit("Nation_"), F.col("c_nationkey").cast("string")))
    left = joins.per_key(nations, clean.normal_key("name"),
                         {"region_total": F.col("n_regionkey").cast("long")}, "left")
    right = joins.per_key(customers, clean.normal_key("page"),
                          {"balance": clean.exact("c_acctbal")}, "right")
    return left, right


@query("join_normalised_key", """
select lower(n_name) as name, count(*) as matches
from nation join customer on lower(replace(n_name, '_', ' ')) = 'nation ' || cast(c_nationkey as varchar)
group by 1
""")
def normalised_key(spark: SparkSession, d: str) -> DataFrame:
    left, right = _key_sides(spark, d)
    return joins.fanout_sums(left, right, [], []).select(
        F.col("join_key").alias("name"), F.col("matches").cast("long").alias("matches"))


@query("join_fanout_naive", """
select lower(n_name) as name, cast(sum(n_regionkey) as bigint) as region_total,
       cast(sum(cast(c_acctbal as decimal(18,2))) as double) as balance
from nation join customer on n_nationkey = c_nationkey group by 1
""")
def fanout_naive(spark: SparkSession, d: str) -> DataFrame:
    left, right = _key_sides(spark, d)
    return joins.fanout_sums(left, right, ["region_total"], ["balance"]).select(
        F.col("join_key").alias("name"), F.col("region_total").cast("long").alias("region_total"),
        F.col("balance").cast("double").alias("balance"))


@query("join_preagg", """
select lower(n_name) as name, cast(n_regionkey as bigint) as region_total, balance
from nation join (select c_nationkey, cast(sum(cast(c_acctbal as decimal(18,2))) as double) as balance
                  from customer group by 1) on n_nationkey = c_nationkey
""")
def fanout_aggregated(spark: SparkSession, d: str) -> DataFrame:
    left, right = _key_sides(spark, d)
    return joins.aggregated_sums(left, right).select(
        F.col("join_key").alias("name"), "region_total",
        F.col("balance").cast("double").alias("balance"))


@query("join_agg_back", """
with means as (select p_type, p_brand, cast(sum(cast(p_retailprice as decimal(18,2))) as double) / count(*) as mean_price
               from part group by 1, 2)
select mean_price, p_partkey, p_size from means join part using (p_type)
""")
def aggregate_joined_back(spark: SparkSession, d: str) -> DataFrame:
    part = read_table(spark, d, "part", "p_type", "p_brand", "p_partkey", "p_size", "p_retailprice")
    return joins.join_aggregate_back(
        part, ["p_type", "p_brand"], ["p_type"], {"mean_price": clean.exact_mean("p_retailprice")}, ["p_partkey", "p_size"])


@query("join_concat_key", """
with runs as (select distinct user_id, user_id % 7 as nr from events where event_type = 'error'),
machines as (select 'job-' || cast(c_custkey as varchar) || '-run-' || cast(c_custkey % 7 as varchar)
                      as name, c_mktsegment, c_nationkey from customer)
select distinct user_id, c_mktsegment, c_nationkey from runs
join machines on 'job-' || cast(user_id as varchar) || '-run-' || cast(nr as varchar) = name
""")
def concat_key(spark: SparkSession, d: str) -> DataFrame:
    runs = read_table(spark, d, "events", "user_id", "event_type").filter(
        "event_type = 'error'").select(
        "user_id", joins.run_name(F.col("user_id").cast("string"),
                                  (F.col("user_id") % 7).cast("string")).alias("name"))
    machines = read_table(spark, d, "customer").select(
        joins.run_name(F.col("c_custkey").cast("string"),
                       (F.col("c_custkey") % 7).cast("string")).alias("name"),
        "c_mktsegment", "c_nationkey")
    return joins.distinct_match(runs, machines, "name",
                                ["user_id", "c_mktsegment", "c_nationkey"])


@query("join_distinct_count", """
select c_mktsegment, count(*) as n from (select distinct user_id, event_type from events)
join customer on user_id = c_custkey group by 1
""")
def distinct_count(spark: SparkSession, d: str) -> DataFrame:
    pairs = read_table(spark, d, "events", "user_id", "event_type")
    names = read_table(spark, d, "customer").select(
        F.col("c_custkey").alias("user_id"), "c_mktsegment")
    counted = joins.distinct_pair_count(pairs, names, "user_id", "event_type", "c_mktsegment")
    return counted.withColumn("n", F.col("n").cast("long"))


@query("join_three_way", """
select n_regionkey, count(*) as lines, cast(sum(cast(l_quantity as bigint)) as bigint) as quantity
from lineitem join orders on l_orderkey = o_orderkey
join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey
where o_orderstatus = 'O' group by 1
""")
def three_way(spark: SparkSession, d: str) -> DataFrame:
    """Big with big with small; lines are counted per supplier before the small joins."""
    lines = read_table(spark, d, "lineitem", "l_orderkey", "l_suppkey", "l_quantity")
    open_orders = read_table(spark, d, "orders", "o_orderkey", "o_orderstatus").filter(
        "o_orderstatus = 'O'").select("o_orderkey")
    per_supplier = (
        lines.join(open_orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("l_suppkey")
        .agg(F.count(F.lit(1)).alias("lines"), F.sum(F.col("l_quantity").cast("long"))
             .alias("quantity")))
    suppliers = read_table(spark, d, "supplier", "s_suppkey", "s_nationkey")
    nations = read_table(spark, d, "nation", "n_nationkey", "n_regionkey")
    return (
        per_supplier.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .groupBy("n_regionkey")
        .agg(F.sum("lines").alias("lines"), F.sum("quantity").alias("quantity")))


@query("join_three_way_statistics", """
select n_regionkey, count(*) as lines
from lineitem join orders on l_orderkey = o_orderkey
join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey
where o_orderstatus = 'O' group by 1
""")
def three_way_by_statistics(spark: SparkSession, d: str) -> DataFrame:
    """Tables with column statistics, joined in the order the optimiser finds cheapest.

    The statistics are used in a session of its own, so the caller's settings stay.
    """
    costs = spark.newSession()
    costs.conf.set("spark.sql.cbo.enabled", "true")
    costs.conf.set("spark.sql.cbo.joinReorder.enabled", "true")
    names = {}
    for name, columns in (("lineitem", ("l_orderkey", "l_suppkey")), ("orders", ("o_orderkey", "o_orderstatus")),
                          ("supplier", ("s_suppkey", "s_nationkey")), ("nation", ("n_nationkey", "n_regionkey"))):
        path = scratch_path(spark, name)
        names[name] = path.rsplit("/", 1)[1].replace("-", "_")
        sinks.create_table_as(read_table(spark, d, name, *columns), names[name], path)
        sinks.analyze_columns(spark, names[name])
    return costs.sql("""
        select n_regionkey, count(*) as lines
        from {lineitem} join {nation} join {supplier} join {orders}
        on l_suppkey = s_suppkey and s_nationkey = n_nationkey and l_orderkey = o_orderkey
        where o_orderstatus = 'O' group by n_regionkey""".format(**names))


@query("cross_grid", """
with counted as (select c_nationkey, cast(year(o_orderdate) as integer) as year, count(*) as n
                 from orders join customer on o_custkey = c_custkey group by 1, 2),
grid as (select * from (select distinct c_nationkey from counted)
         cross join (select cast(unnest(range(min(year), max(year) + 1)) as integer) as year from counted))
select c_nationkey, year, coalesce(n, 0) as n from grid left join counted using (c_nationkey, year)
""")
def grid(spark: SparkSession, d: str) -> DataFrame:
    """Every nation with every year, with counts where there are any."""
    orders = read_table(spark, d, "orders", "o_custkey", "o_orderdate")
    per_customer = orders.groupBy("o_custkey", F.year("o_orderdate").alias("year")).agg(
        F.count(F.lit(1)).alias("n"))
    customers = read_table(spark, d, "customer", "c_custkey", "c_nationkey")
    counts = (
        per_customer.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey", "year").agg(F.sum("n").alias("n")))
    return joins.fill_grid(counts, "c_nationkey", "year", "n")


@query("agg_count", """
select count(*) as orders, count(*) filter (where o_orderstatus = 'F') as finished from orders
""")
def counts(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "orders", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("orders"),
        F.count_if(F.col("o_orderstatus") == "F").alias("finished"))


@query("agg_group_count", """
select event_type, count(*) as n from events group by 1
""")
def group_count(spark: SparkSession, d: str) -> DataFrame:
    return aggregates.group_counts(read_table(spark, d, "events", "event_type"), "event_type")


@query("agg_two_keys", """
select o_orderpriority, cast(year(o_orderdate) as integer) as year, count(*) as n
from orders where o_orderstatus = 'O' group by 1, 2
""")
def two_keys(spark: SparkSession, d: str) -> DataFrame:
    orders = read_table(spark, d, "orders", "o_orderpriority", "o_orderdate", "o_orderstatus")
    return (
        orders.filter("o_orderstatus = 'O'")
        .groupBy("o_orderpriority", F.year("o_orderdate").alias("year"))
        .agg(F.count(F.lit(1)).alias("n")).orderBy("o_orderpriority", "year"))


@query("agg_multi_sum", f"""
select l_returnflag, l_linestatus, cast(sum(cast(l_quantity as bigint)) as bigint) as quantity,
       cast(sum({SQL_REVENUE}) as double) as revenue
from lineitem group by 1, 2
""")
def multi_sum(spark: SparkSession, d: str) -> DataFrame:
    lines = read_table(spark, d, "lineitem", "l_returnflag", "l_linestatus", "l_quantity",
                       "l_extendedprice", "l_discount")
    return lines.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum(F.col("l_quantity").cast("long")).alias("quantity"),
        F.sum(revenue()).cast("double").alias("revenue"))


@query("agg_count_sum", """
select l_linenumber, count(*) as samples,
       cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as total
from lineitem
where l_returnflag = 'R' and l_linestatus = 'F' and l_linenumber not in (1, 2)
group by 1
""")
def conditioned(spark: SparkSession, d: str) -> DataFrame:
    lines = read_table(spark, d, "lineitem", "l_linenumber", "l_returnflag", "l_linestatus",
                       "l_extendedprice")
    return (
        lines.filter((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
                     & ~F.col("l_linenumber").isin(1, 2))
        .groupBy("l_linenumber")
        .agg(F.count(F.lit(1)).alias("samples"),
             F.sum(clean.exact("l_extendedprice")).cast("double").alias("total")))


@query("agg_avg", """
select p_brand, cast(sum(cast(p_retailprice as decimal(18,2))) as double) / count(*) as mean_price,
       cast(sum(p_size) as double) / count(*) as mean_size
from part group by 1
""")
def averages(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "part", "p_brand", "p_retailprice", "p_size").groupBy("p_brand").agg(
        clean.exact_mean("p_retailprice").alias("mean_price"), F.avg("p_size").alias("mean_size"))


@query("agg_geomean", """
select event_type, round(exp(avg(ln(value))), 6) as geomean from events group by 1
""")
def geomean(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "events", "event_type", "value").groupBy("event_type").agg(
        F.round(geometric_mean("value"), 6).alias("geomean"))


@query("agg_geomean_seeded", """
select event_type, round(exp(sum(ln(value)) / (1 + count(value))), 6) as counted,
       round(exp((ln(1.1) + sum(ln(value))) / (1 + count(value))), 6) as seeded
from events group by 1
""")
def geomean_seeded(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "events", "event_type", "value").groupBy("event_type").agg(
        F.round(geometric_mean("value", 1), 6).alias("counted"),
        F.round(geometric_mean("value", 1, 1.1), 6).alias("seeded"))


@query("distinct_rows", """
select distinct l_returnflag, l_linestatus, l_linenumber from lineitem
""")
def distinct_rows(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "lineitem", "l_returnflag", "l_linestatus", "l_linenumber").distinct()


@query("agg_concat", """
with numbered as (
  select c_nationkey, c_name,
         (row_number() over (partition by c_nationkey order by c_name) - 1) // 50 as part
  from customer)
select c_nationkey, part, string_agg(c_name, ', ' order by c_name) as text
from numbered group by 1, 2
""")
def concatenated(spark: SparkSession, d: str) -> DataFrame:
    customers = read_table(spark, d, "customer", "c_nationkey", "c_name")
    return aggregates.concatenated(customers, ["c_nationkey"], "c_name", ", ", 50)


@query("agg_filtered_sum", """
select cast(sum(cast(json_extract_string(props, '$.k') as bigint)) as bigint) as total
from events where event_type = 'view'
""")
def filtered_sum(spark: SparkSession, d: str) -> DataFrame:
    """Rows rendered as text, split by hand, filtered and summed."""
    events = read_table(spark, d, "events", "event_type", "props")
    line = F.concat_ws(" ", "event_type", F.get_json_object("props", "$.k"))
    fields = F.split("line", " ")
    return (
        events.select(line.alias("line")).filter(F.get(fields, 0) == "view")
        .agg(F.sum(F.get(fields, 1).try_cast("long")).alias("total")))


YEARS = (1995, 1996, 1997, 1998, 1999, 2000, 2001)


def _segment_cells(spark: SparkSession, d: str) -> DataFrame:
    """Order prices summed per customer and year, then joined to the customer's segment and nation."""
    orders = read_table(spark, d, "orders", "o_custkey", "o_orderdate", "o_totalprice")
    cells = aggregates.partial_cells(
        orders.withColumn("year", F.year("o_orderdate")), ["o_custkey", "year"],
        F.col("o_totalprice"), clean.exact("o_totalprice"))
    customers = read_table(spark, d, "customer", "c_custkey", "c_mktsegment", "c_nationkey")
    return cells.join(customers, F.col("o_custkey") == F.col("c_custkey"))


def _pivot_sql(cell: str, prefix: str = "") -> str:
    cells = ", ".join(f'{cell.format(y=y)} as "{prefix}{y}"' for y in YEARS)
    return f"select c_mktsegment, {cells} from orders join customer on o_custkey = c_custkey group by 1"


def _pivot(spark: SparkSession, d: str, how: str) -> DataFrame:
    return aggregates.pivot_cells(_segment_cells(spark, d), "c_mktsegment", "year", YEARS, how)


def _as_double(df: DataFrame) -> DataFrame:
    return df.select("c_mktsegment", *[F.col(f"`{y}`").cast("double").alias(str(y)) for y in YEARS])


@query("pivot_sum", _pivot_sql(
    "cast(sum(cast(o_totalprice as decimal(18,2))) filter (where year(o_orderdate) = {y}) as double)"))
def pivot_sum(spark: SparkSession, d: str) -> DataFrame:
    return _as_double(_pivot(spark, d, "sum"))


@query("pivot_avg", _pivot_sql(
    "cast(sum(cast(o_totalprice as decimal(18,2))) filter (where year(o_orderdate) = {y}) as double)"
    " / count(*) filter (where year(o_orderdate) = {y})"))
def pivot_avg(spark: SparkSession, d: str) -> DataFrame:
    return _pivot(spark, d, "avg")


@query("pivot_minmax",
       "select * from (" + _pivot_sql("min(o_totalprice) filter (where year(o_orderdate) = {y})", "low_")
       + ") join (" + _pivot_sql("max(o_totalprice) filter (where year(o_orderdate) = {y})", "high_")
       + ") using (c_mktsegment)")
def pivot_minmax(spark: SparkSession, d: str) -> DataFrame:
    low, high = (_pivot(spark, d, how).withColumnsRenamed({str(y): f"{side}_{y}" for y in YEARS})
                 for how, side in (("min", "low"), ("max", "high")))
    return low.join(high, "c_mktsegment")


@query("pivot_count", _pivot_sql("count(*) filter (where year(o_orderdate) = {y})"))
def pivot_count(spark: SparkSession, d: str) -> DataFrame:
    wide = _pivot(spark, d, "count")
    return wide.select("c_mktsegment", *[
        F.coalesce(F.col(f"`{y}`"), F.lit(0)).alias(str(y)) for y in YEARS])


@query("pivot_long", """
select c_mktsegment, cast(year(o_orderdate) as integer) as year,
       cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total
from orders join customer on o_custkey = c_custkey group by 1, 2
""")
def pivot_long(spark: SparkSession, d: str) -> DataFrame:
    tall = aggregates.merged_cells(_segment_cells(spark, d), ["c_mktsegment", "year"])
    return tall.select("c_mktsegment", "year", F.col("sum_value").cast("double").alias("total"))


@query("agg_by_location", """
select c_nationkey, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as sum_value,
       cast(sum(cast(o_totalprice as decimal(18,2))) as double) / count(*) as avg_value, min(o_totalprice) as min_value,
       max(o_totalprice) as max_value, count(o_totalprice) as count_value
from orders join customer on o_custkey = c_custkey group by 1
""")
def by_location(spark: SparkSession, d: str) -> DataFrame:
    cells = aggregates.merged_cells(_segment_cells(spark, d), ["c_nationkey"])
    return cells.select(
        "c_nationkey", F.col("sum_value").cast("double").alias("sum_value"), "avg_value",
        "min_value", "max_value", "count_value")


@query("share_of_total", """
with totals as (
  select n_regionkey, n_name, sum(cast(c_acctbal as decimal(18,2))) as balance
  from customer join nation on c_nationkey = n_nationkey group by 1, 2)
select n_regionkey, n_name,
       round(cast(balance as double) / cast(sum(balance) over (partition by n_regionkey) as double), 8)
         as share
from totals
""")
def shares(spark: SparkSession, d: str) -> DataFrame:
    per_nation = read_table(spark, d, "customer", "c_nationkey", "c_acctbal").groupBy(
        "c_nationkey").agg(F.sum(clean.exact("c_acctbal")).cast("double").alias("balance"))
    totals = per_nation.join(read_table(spark, d, "nation"),
                             F.col("c_nationkey") == F.col("n_nationkey"))
    shared = ranking.share_of_total(totals, ["n_regionkey"], "balance")
    return shared.select("n_regionkey", "n_name", F.round("share", 8).alias("share"))


@query("topk_global", """
select c_custkey, orders, total from (
  select o_custkey as c_custkey, count(*) as orders,
         cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total
  from orders group by 1)
order by total desc, c_custkey limit 10
""")
def best_customers(spark: SparkSession, d: str) -> DataFrame:
    totals = read_table(spark, d, "orders", "o_custkey", "o_totalprice").groupBy(
        F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum(clean.exact("o_totalprice")).cast("double").alias("total"))
    return ranking.top_rows(totals, 10, F.desc("total"), F.asc("c_custkey"))


@query("limit_ordered", """
select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 1000
""")
def first_rows(spark: SparkSession, d: str) -> DataFrame:
    return ranking.top_rows(read_table(spark, d, "orders", "o_orderkey", "o_totalprice"), 1000,
                            F.desc("o_totalprice"), F.asc("o_orderkey"))


@query("dim_state_codes", """
select event_id, case user_id % 3 when 0 then 'HI' when 1 then 'TX' end as code
from events where user_id % 3 < 2
""")
def state_codes(spark: SparkSession, d: str) -> DataFrame:
    """The state dimension joined on a trimmed name; unknown states drop out."""
    from tallyloom.fixed_values import STATE_CODES

    state = (F.when(F.col("user_id") % 3 == 0, " HAWAII WATERS").when(F.col("user_id") % 3 == 1, "TEXAS ")
             .otherwise("ATLANTIS"))
    events = read_table(spark, d, "events", "event_id", "user_id").withColumn("state", state)
    dim = files.inline_dimension(spark, STATE_CODES, ["name", "code"])
    return events.join(F.broadcast(dim), F.trim("state") == F.col("name")).select("event_id", "code")
