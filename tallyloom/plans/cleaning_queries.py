"""Projection, filter and scalar expressions.

The standard tables are clean, so each query first respells columns the messy
way (suffixes, blanks, missing values) by a rule the SQL can state too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions import cleaning as clean
from tallyloom.operators import sampling
from tallyloom.plans.registry import query
from tallyloom.sources.files import read_table
from tallyloom.workspace import scratch_name

SQL_K = "cast(json_extract_string(props, '$.k') as integer)"

TYPE_CODES = {"click": 1, "view": 2, "purchase": 3, "signup": 4, "error": 5}
TYPE_LABELS = {1: "Click", 2: "View", 3: "Purchase", 4: "Sign-up"}


@query("proj_expr", """
select l_orderkey, l_linenumber,
       cast(l_quantity as bigint) * 2 as double_quantity,
       cast(cast(l_extendedprice as decimal(12,2)) * (1 - cast(l_discount as decimal(4,2)))
            as double) as net_price
from lineitem
""")
def expression_projection(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "CAST(l_quantity AS BIGINT) * 2 AS double_quantity",
        "CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) "
        "AS DOUBLE) AS net_price")


@query("proj_rename", """
select o_orderkey as order_id, upper(o_orderstatus) as status, o_totalprice as price from orders
""")
def renamed(spark: SparkSession, d: str) -> DataFrame:
    return (
        read_table(spark, d, "orders")
        .withColumnsRenamed({"o_orderkey": "order_id", "o_orderstatus": "status",
                             "o_totalprice": "price"})
        .withColumns({"status": F.upper("status")})
        .drop("o_custkey", "o_orderdate", "o_orderpriority"))


@query("decode_labels", """
select event_id,
       case event_type when 'click' then 'Click' when 'view' then 'View'
            when 'purchase' then 'Purchase' when 'signup' then 'Sign-up' end as type_code_str,
       case when user_id % 3 = 1 then 'Home' when user_id % 3 = 2 then 'Away' end as side_str
from events
""")
def decoded(spark: SparkSession, d: str) -> DataFrame:
    coded = read_table(spark, d, "events", "event_id", "event_type", "user_id").select(
        "event_id", clean.decode("event_type", TYPE_CODES).alias("type_code"),
        (F.col("user_id") % 3).cast("int").alias("side"))
    books = {"type_code": TYPE_LABELS, "side": {1: "Home", 2: "Away"}}
    return clean.decode_all(coded, books).drop("type_code", "side")


@query("null_bucket_count", f"""
select coalesce(case when {SQL_K} < 40 then 'low' when {SQL_K} < 80 then 'middle' end, 'Unknown')
         as band, count(*) as n
from events group by 1
""")
def null_bucket(spark: SparkSession, d: str) -> DataFrame:
    events = read_table(spark, d, "events", "props")
    k = F.get_json_object("props", "$.k").cast("int")
    band = F.when(k < 40, "low").when(k < 80, "middle")
    raw = events.select(band.alias("band")).groupBy("band").agg(F.count(F.lit(1)).alias("n"))
    return raw.withColumn("band", clean.unknown_bucket("band"))


@query("filter_boolean", """
select o_orderkey, o_orderstatus, o_totalprice from orders
where o_totalprice > 100000 and o_orderstatus <> 'F'
  and not (o_orderstatus = 'O' and o_orderpriority = '5-LOW')
""")
def boolean_filter(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "orders").filter(
        (F.col("o_totalprice") > 100000) & (F.col("o_orderstatus") != "F")
        & ~((F.col("o_orderstatus") == "O") & (F.col("o_orderpriority") == "5-LOW"))
    ).select("o_orderkey", "o_orderstatus", "o_totalprice")


@query("filter_in_list", """
select p_partkey, p_brand, p_type from part
where p_type in ('PROMO', 'ECONOMY') and p_brand not in ('Brand#1', 'Brand#2', 'Brand#3')
""")
def in_list(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "part").filter(
        F.col("p_type").isin("PROMO", "ECONOMY")
        & ~F.col("p_brand").isin("Brand#1", "Brand#2", "Brand#3")
    ).select("p_partkey", "p_brand", "p_type")


@query("filter_like", """
select page_id, url from pages where url like 'https://%' and url like '%/e_/%'
""")
def like_filter(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "pages", "page_id", "url").filter(
        F.col("url").like("https://%") & F.col("url").like("%/e_/%"))


@query("filter_contains", """
select doc_id, lang from documents where contains(text, 'the') and starts_with(lang, 'e')
""")
def contains_filter(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "documents", "doc_id", "lang", "text").filter(
        F.col("text").contains("the") & F.col("lang").startswith("e")).select("doc_id", "lang")


@query("filter_not_blank", """
select doc_id, source from documents where doc_id % 3 <> 0 and doc_id % 5 <> 0
""")
def blank_filter(spark: SparkSession, d: str) -> DataFrame:
    messy = F.when(F.col("doc_id") % 3 == 0, "   ").when(F.col("doc_id") % 5 != 0, F.col("source"))
    return read_table(spark, d, "documents", "doc_id", "source").withColumn(
        "source", messy).filter(clean.not_blank("source"))


@query("dropna_all", """
select o_orderkey,
       case when o_orderkey % 2 <> 0 then o_totalprice end as a,
       case when o_orderkey % 3 <> 0 then o_totalprice end as b
from orders where o_orderkey % 6 <> 0
""")
def drop_all_null(spark: SparkSession, d: str) -> DataFrame:
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    bars = read_table(spark, d, "orders", "o_orderkey", "o_totalprice").select(
        "o_orderkey", F.when(key % 2 != 0, price).alias("a"), F.when(key % 3 != 0, price).alias("b"))
    return bars.dropna(how="all", subset=["a", "b"])


@query("merge_labels", """
select p_partkey, case when regexp_matches(p_type, '(?i)eco.*') then 'ECONOMY RANGE'
       when regexp_matches(lower(p_type) || ' set', '(?i)PRO.*') then 'PROMOTION'
       else upper(lower(p_type) || ' set') end as label
from part
""")
def merged_labels(spark: SparkSession, d: str) -> DataFrame:
    part = read_table(spark, d, "part", "p_partkey", "p_type").withColumn(
        "p_type", F.concat(F.lower("p_type"), F.lit(" set")))
    return part.select("p_partkey", clean.merge_labels(
        "p_type", {"ECONOMY RANGE": "Eco.*", "PROMOTION": "PRO.*"}).alias("label"))


@query("parse_magnitude", """
with messy as (
  select o_orderkey, cast(o_orderkey % 1000 as varchar) || '.25' as digits, o_orderkey % 6 as form
  from orders)
select o_orderkey,
       case form when 0 then cast(digits as double) when 1 then cast(digits as double) * 1000
            when 2 then cast(digits as double) * 1000000 when 3 then 0.0 end as thousands,
       case form when 0 then cast(digits as double) when 1 then cast(digits as double) * 1000
            when 2 then cast(digits as double) * 1000000 when 3 then 0.0 end + 1.5 as total
from messy
""")
def money_text(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("o_orderkey")
    digits = F.concat((key % 1000).cast("string"), F.lit(".25"))
    form = key % 6
    text = (F.when(form == 0, F.concat(digits, F.lit("K"))).when(form == 1, F.concat(digits, F.lit("M")))
            .when(form == 2, F.concat(digits, F.lit("B"))).when(form == 4, digits)
            .when(form == 5, "K"))
    parsed = read_table(spark, d, "orders", "o_orderkey").select(
        "o_orderkey", clean.parse_magnitude(text).alias("thousands"))
    return parsed.withColumn("total", clean.add_columns(["thousands", F.lit(1.5)]))


@query("magnitude_column", """
select o_orderkey,
       round(case o_orderkey % 4 when 0 then o_totalprice / 1000 when 2 then o_totalprice * 1000
             else o_totalprice end, 6) as property_millions,
       round(case o_orderkey % 4 when 0 then o_totalprice / 1000 else o_totalprice end, 6)
         as crop_millions
from orders
""")
def magnitude_letters(spark: SparkSession, d: str) -> DataFrame:
    form = F.col("o_orderkey") % 4
    unit = F.when(form == 0, "K").when(form == 1, "M").when(form == 2, "B").otherwise("?")
    return read_table(spark, d, "orders", "o_orderkey", "o_totalprice").select(
        "o_orderkey",
        F.round(clean.scale_by_unit("o_totalprice", unit), 6).alias("property_millions"),
        F.round(clean.scale_by_unit("o_totalprice", unit, legacy_crop=True), 6)
        .alias("crop_millions"))


@query("add_columns", """
select o_orderkey, case when o_orderkey % 4 = 0 then null
       else round(o_totalprice + o_custkey, 2) end as total
from orders
""")
def null_propagating_sum(spark: SparkSession, d: str) -> DataFrame:
    part = F.when(F.col("o_orderkey") % 4 != 0, F.col("o_totalprice"))
    return read_table(spark, d, "orders", "o_orderkey", "o_custkey", "o_totalprice").select(
        "o_orderkey",
        F.round(clean.add_columns([part, F.col("o_custkey").cast("double")]), 2).alias("total"))


@query("typed_value", """
select event_id,
       case when event_type = 'signup' then case when value > 50 then 1.0 else 0.0 end
            when event_id % 7 = 0 then null else value end as number,
       case when event_type = 'signup' then 'Binary' else 'Number' end as unit
from events
""")
def typed_values(spark: SparkSession, d: str) -> DataFrame:
    answer = F.col("event_type") == "signup"
    kind = F.when(answer, "Yes/No").otherwise("Number")
    text = (F.when(answer, F.when(F.col("value") > 50, "Yes").otherwise("No"))
            .when(F.col("event_id") % 7 == 0, "n/a").otherwise(F.col("value").cast("string")))
    messy = read_table(spark, d, "events", "event_id", "event_type", "value").select(
        "event_id", kind.alias("kind"), text.alias("text"))
    return messy.select("event_id", clean.typed_value("kind", "text").cast("double")
                        .alias("number"), clean.value_unit("kind").alias("unit"))


@query("string_functions", """
select page_id, lower(url) as lowered, upper(split_part(url, '/', 3)) as host,
       trim('  ' || split_part(url, '/', 4) || ' ') as first_folder,
       regexp_replace(url, '[0-9]+', '#', 'g') as masked,
       substring(url, 1, 5) as scheme, starts_with(url, 'https') as secure,
       'page-' || cast(page_id as varchar) as name
from pages
""")
def strings(spark: SparkSession, d: str) -> DataFrame:
    parts = F.split("url", "/")
    return read_table(spark, d, "pages", "page_id", "url").select(
        "page_id", F.lower("url").alias("lowered"), F.upper(F.get(parts, 2)).alias("host"),
        F.trim(F.concat(F.lit("  "), F.coalesce(F.get(parts, 3), F.lit("")), F.lit(" ")))
        .alias("first_folder"),
        F.regexp_replace("url", "[0-9]+", "#").alias("masked"),
        F.substring("url", 1, 5).alias("scheme"), F.col("url").startswith("https").alias("secure"),
        F.concat(F.lit("page-"), F.col("page_id").cast("string")).alias("name"))


@query("date_parts", """
select o_orderkey, cast(year(o_orderdate) as integer) as year,
       cast(month(o_orderdate) as integer) as month, cast(day(o_orderdate) as integer) as day,
       cast(year(o_orderdate) as integer) as text_year,
       cast(epoch(o_orderdate) as bigint) as seconds,
       strftime(o_orderdate, '%Y-%m-%d') as again
from orders
""")
def parts_of_dates(spark: SparkSession, d: str) -> DataFrame:
    orders = read_table(spark, d, "orders", "o_orderkey", "o_orderdate")
    text = F.date_format("o_orderdate", "M/d/yyyy' 0:00:00'")
    seconds = F.unix_seconds(F.col("o_orderdate").cast("timestamp"))
    return orders.select("o_orderkey", text.alias("text"), seconds.alias("seconds"),
                         *[c.alias(n) for n, c in clean.date_parts("o_orderdate").items()]
                         ).select(
        "o_orderkey", "year", "month", "day", clean.year_of_text_date("text").alias("text_year"),
        "seconds", F.date_format(clean.epoch_timestamp("seconds"), "yyyy-MM-dd").alias("again"))


@query("date_format_text", """
select event_id, strftime(ts, '%H:%M:%S') as clock, strftime(ts, '%d.%m.%Y') as day from events
""")
def date_text(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "events", "event_id", "ts").select(
        "event_id", F.date_format("ts", "HH:mm:ss").alias("clock"),
        F.date_format("ts", "dd.MM.yyyy").alias("day"))


@query("json_path", """
select event_id, json_extract_string(props, '$.k') as k from events
""")
def json_by_path(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "events", "event_id", "props").select(
        "event_id", F.get_json_object("props", "$.k").alias("k"))


@query("json_tuple_fields", """
select event_id, event_type as channel, strftime(ts, '%Y-%m-%d %H:%M:%S') as stamp,
       cast(user_id as varchar) as page
from events
""")
def json_fields(spark: SparkSession, d: str) -> DataFrame:
    message = F.to_json(F.struct(
        F.col("event_type").alias("channel"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        F.col("user_id").alias("page")))
    return (read_table(spark, d, "events").select("event_id", message.alias("message"))
            .select("event_id", F.json_tuple("message", "channel", "timestamp", "page")
                    .alias("channel", "stamp", "page")))


@query("json_struct", f"""
select event_id, case when event_id % 11 = 0 then null else cast({SQL_K} as double) end as k
from events
""")
def json_to_struct(spark: SparkSession, d: str) -> DataFrame:
    text = F.when(F.col("event_id") % 11 == 0, "{broken").otherwise(F.col("props"))
    return read_table(spark, d, "events", "event_id", "props").select(
        "event_id", F.from_json(text, T.StructType().add("k", "integer")).alias("record")
    ).select("event_id", F.col("record.k").cast("double").alias("k"))


@query("math_functions", """
select l_orderkey, l_linenumber, l_orderkey % 7 as remainder,
       abs(l_quantity - 25) as distance, round(pow(l_discount, 2), 6) as squared,
       round(sin(l_quantity), 8) as wave
from lineitem
""")
def maths(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_orderkey") % 7).alias("remainder"),
        F.abs(F.col("l_quantity") - 25).alias("distance"),
        F.round(F.pow("l_discount", F.lit(2.0)), 6).alias("squared"),
        F.round(F.sin("l_quantity"), 8).alias("wave"))


@query("keep_list_filter", """
select l_orderkey, l_linenumber, l_returnflag, l_linestatus from lineitem
where l_returnflag in ('A', 'R') and l_linestatus in ('O')
  and l_linenumber in (1, 2, 3)
""")
def keep_list(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "lineitem").filter(
        F.col("l_returnflag").isin("A", "R") & F.col("l_linestatus").isin("O")
        & F.col("l_linenumber").isin(1, 2, 3)
    ).select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")


@query("sql_udf_odd", """
select o_orderkey from orders where o_orderkey % 2 = 1
""")
def sql_function(spark: SparkSession, d: str) -> DataFrame:
    is_odd = scratch_name("is_odd")
    spark.sql(f"CREATE TEMPORARY FUNCTION {is_odd}(n BIGINT) RETURNS BOOLEAN RETURN n % 2 = 1")
    return spark.sql(f"SELECT o_orderkey FROM {{orders}} WHERE {is_odd}(o_orderkey)",
                     orders=read_table(spark, d, "orders", "o_orderkey"))


@query("map_partitions_schema", """
select event_id, event_type, round(value * 2 + 1, 2) as scaled from events
""")
def mapped_partitions(spark: SparkSession, d: str) -> DataFrame:
    """The open extension point: a function over Arrow batches with a declared schema."""
    def scale(batches):
        for batch in batches:
            batch["scaled"] = (batch["value"] * 2 + 1).round(2)
            yield batch[["event_id", "event_type", "scaled"]]

    events = read_table(spark, d, "events", "event_id", "event_type", "value")
    return events.mapInPandas(scale, "event_id long, event_type string, scaled double")


@query("split_hash", """
select o_orderkey, (o_orderkey % 2147483648 * 2654435761 % 4294967296) % 100 < 70 as is_train from orders
""")
def split_by_hash(spark: SparkSession, d: str) -> DataFrame:
    return sampling.hash_split(read_table(spark, d, "orders", "o_orderkey"), "o_orderkey", 70)


@query("split_stratified", """
select doc_id, quality,
       (doc_id % 2147483648 * 2654435761 % 4294967296) % 100 < case quality when 0 then 80 else 60 end as is_train
from labels
""")
def split_by_label(spark: SparkSession, d: str) -> DataFrame:
    labels = read_table(spark, d, "labels", "doc_id", "quality")
    return sampling.stratified_split(labels, "doc_id", "quality", {0: 80, 1: 60})


@query("split_anti", """
select o_orderkey, o_totalprice from orders
where not ((o_orderkey % 2147483648 * 2654435761 % 4294967296) % 100 < 20)
""")
def split_by_absence(spark: SparkSession, d: str) -> DataFrame:
    orders = read_table(spark, d, "orders", "o_orderkey", "o_totalprice")
    sample = orders.filter(sampling.hash_bucket("o_orderkey") < 20)
    return sampling.rows_not_in(orders, sample, "o_orderkey")


@query("set_except", """
select l_orderkey, l_returnflag from lineitem
except select l_orderkey, l_returnflag from lineitem where l_linestatus = 'F'
""")
def set_difference(spark: SparkSession, d: str) -> DataFrame:
    lines = read_table(spark, d, "lineitem", "l_orderkey", "l_returnflag", "l_linestatus")
    columns = ["l_orderkey", "l_returnflag"]
    return sampling.difference(
        lines.select(columns), lines.filter("l_linestatus = 'F'").select(columns))


@query("set_union_all", """
select c_name as name, c_acctbal as balance from customer
union all select s_name, s_acctbal from supplier
""")
def union_all(spark: SparkSession, d: str) -> DataFrame:
    return sampling.stacked([
        read_table(spark, d, "customer").select(
            F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")),
        read_table(spark, d, "supplier").select("s_name", "s_acctbal")])


@query("sample_rows", "select 0::bigint as repeats, 0::bigint as outside, true as within_bounds")
def sampled(spark: SparkSession, d: str) -> DataFrame:
    """What holds of any sample without replacement: no repeats, a subset, about the size asked for."""
    orders = read_table(spark, d, "orders", "o_orderkey", "o_totalprice")
    sample = sampling.random_sample(orders, 0.75, 17)
    counted = sample.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("n"))
    joined = orders.select("o_orderkey", F.lit(1).alias("of_all")).join(counted, "o_orderkey", "full")
    return joined.agg(
        F.count_if(F.col("n") > 1).alias("repeats"), F.count_if(F.col("of_all").isNull()).alias("outside"),
        (F.abs(F.sum(F.coalesce("n", F.lit(0))) / F.count("of_all") - 0.75) < 0.05).alias("within_bounds"))


@query("sample_exact", """
select o_orderkey, o_totalprice from orders
qualify row_number() over (order by (o_orderkey % 2147483648) * 2654435761 % 4294967296, o_orderkey)
  <= floor(0.8 * count(*) over ())
""")
def sampled_exactly(spark: SparkSession, d: str) -> DataFrame:
    """Exactly eight tenths of the orders."""
    return sampling.sample_exact(read_table(spark, d, "orders", "o_orderkey", "o_totalprice"), "o_orderkey", fraction=0.8)
