"""Scans: every reader over files staged from the standard tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions import cleaning as clean
from tallyloom.operators.ordering import with_position
from tallyloom.operators.sequences import ordered_batches
from tallyloom.plans.registry import query
from tallyloom.sources import avro_payloads as avro
from tallyloom.sources import files, sinks
from tallyloom.sources.json_arrays import read_json_array
from tallyloom.sources.sinks import json_documents
from tallyloom.workspace import cached, materialise, scratch_path, table_name


@query("src_csv_schema", """
select event_id, user_id, event_type,
       case when event_id % 10 = 0 then null else value end as value,
       strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') as seen
from events
""")
def csv_with_schema(spark: SparkSession, d: str) -> DataFrame:
    events = files.read_table(spark, d, "events")
    messy = events.select(
        "event_id", "user_id",
        F.concat(F.lit("  "), "event_type", F.lit(" ")).alias("event_type"),
        F.when(F.col("event_id") % 10 != 0, F.col("value")).alias("value"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("seen"))
    path = sinks.save_csv(messy, scratch_path(spark, "csv"),
                          ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false")
    return files.read_csv(
        spark, path, "event_id long, user_id long, event_type string, value double, seen string")


@query("src_csv_infer", """
select cast(o_orderkey as bigint) as order_id, o_totalprice as price,
       o_orderstatus as status, 'int' as id_type, 'double' as price_type
from orders
""")
def csv_inferred(spark: SparkSession, d: str) -> DataFrame:
    orders = files.read_table(spark, d, "orders", "o_orderkey", "o_totalprice", "o_orderstatus")
    path = sinks.save_csv(orders, scratch_path(spark, "csv"))
    rows = files.read_csv(spark, path)
    kinds = dict(rows.dtypes)
    return rows.select(
        F.col("o_orderkey").cast("long").alias("order_id"),
        F.col("o_totalprice").alias("price"), F.col("o_orderstatus").alias("status"),
        F.lit(kinds["o_orderkey"]).alias("id_type"),
        F.lit(kinds["o_totalprice"]).alias("price_type"))


@query("src_csv_positional", """
select event_type as project, 'User_' || cast(user_id as varchar) as page,
       case when event_id % 97 = 0 then null else cast(event_id as double) end as requests
from events
""")
def csv_positional(spark: SparkSession, d: str) -> DataFrame:
    events = files.read_table(spark, d, "events", "event_id", "event_type", "user_id", "value")
    line = F.concat_ws(
        " ", "event_type", F.concat(F.lit("User_"), F.col("user_id").cast("string")),
        F.when(F.col("event_id") % 97 == 0, "bad").otherwise(F.col("event_id").cast("string")),
        F.col("value").cast("string"))
    path = scratch_path(spark, "positional")
    events.select(line).write.text(path)
    columns = {"project": "string", "page": "string", "requests": "double", "ignored": "string"}
    return files.read_positional(spark, path, columns).drop("ignored")


LINE_LENGTHS = """
select cast(length(line) as bigint) as line_length, count(*) as lines
from (select unnest(string_split(text, chr(10))) as line from documents)
group by 1
"""


def _staged_lines(spark: SparkSession, d: str) -> str:
    path = scratch_path(spark, "lines")
    (files.read_table(spark, d, "documents", "text").select("text")
     .write.options(compression="gzip", lineSep="\n").text(path))
    return path


def _line_lengths(lines: DataFrame) -> DataFrame:
    return lines.groupBy(F.length("value").cast("long").alias("line_length")).agg(
        F.count(F.lit(1)).alias("lines"))


@query("src_text_lines", LINE_LENGTHS)
def text_lines(spark: SparkSession, d: str) -> DataFrame:
    return _line_lengths(files.read_lines(spark, _staged_lines(spark, d)))


@query("rewrite_splittable", LINE_LENGTHS)
def splittable(spark: SparkSession, d: str) -> DataFrame:
    target = scratch_path(spark, "plain")
    return _line_lengths(files.rewrite_splittable(spark, _staged_lines(spark, d), target))


@query("src_parquet_path", """
select o_orderpriority, count(*) as n from orders where o_orderstatus = 'F' group by 1
""")
def parquet_by_path(spark: SparkSession, d: str) -> DataFrame:
    orders = files.read_path_sql(spark, f"{d}/orders.parquet")
    return orders.filter("o_orderstatus = 'F'").groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"))


@query("src_json_nested", """
select event_id as zip, event_type as city, user_id as pop,
       cast(json_extract_string(props, '$.k') as bigint) as k
from events
""")
def json_nested(spark: SparkSession, d: str) -> DataFrame:
    events = files.read_table(spark, d, "events")
    path = scratch_path(spark, "json")
    (events.select(F.col("event_id").alias("_id"), F.col("event_type").alias("city"),
                   F.struct(F.col("user_id").alias("pop"),
                            F.from_json("props", "k long").alias("props")).alias("detail"))
     .write.json(path))
    schema = "_id long, city string, detail struct<pop: long, props: struct<k: long>>"
    rows = files.read_json_lines(spark, path, schema, {"_id": "zip"})
    return rows.select("zip", "city", "detail.pop", "detail.props.k")


@query("src_json_array", """
select p_partkey as id, p_name as name, p_retailprice as price from part
""")
def json_array(spark: SparkSession, d: str) -> DataFrame:
    part = files.read_table(spark, d, "part", "p_partkey", "p_name", "p_retailprice")
    record = F.struct(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
                      F.col("p_retailprice").alias("price"))
    documents = json_documents(with_position(part, [], ["p_partkey"]), record, "position", 1000)
    path = scratch_path(spark, "arrays")
    documents.select("document").write.option("maxRecordsPerFile", 1).text(path)  # one array per file
    return read_json_array(spark, path, "id long, name string, price double")


@query("src_range", """
select o_orderkey % 10 as digit, count(*) as orders,
       cast(sum(o_orderkey * o_orderkey) as double) as squares
from orders group by 1
""")
def ranges(spark: SparkSession, d: str) -> DataFrame:
    orders = files.read_table(spark, d, "orders", "o_orderkey")
    size = orders.agg(F.max("o_orderkey")).first()[0] + 1
    return (
        files.squares(spark, size)
        .join(orders, F.col("id") == F.col("o_orderkey"))
        .groupBy((F.col("id") % 10).alias("digit"))
        .agg(F.count(F.lit(1)).alias("orders"), F.sum("square").cast("double").alias("squares")))


@query("dim_inline_join", """
select o.o_orderkey, dim.code
from orders o join (values ('1-URGENT', 'U'), ('2-HIGH', 'H'), ('3-MEDIUM', 'M'), ('5-LOW', 'L'))
     as dim(name, code) on trim(o.o_orderpriority) = dim.name
""")
def inline_join(spark: SparkSession, d: str) -> DataFrame:
    orders = files.read_table(spark, d, "orders", "o_orderkey", "o_orderpriority")
    padded = orders.withColumn("o_orderpriority", F.concat(F.lit(" "), "o_orderpriority"))
    dim = files.inline_dimension(
        spark, {"1-URGENT": "U", "2-HIGH": "H", "3-MEDIUM": "M", "5-LOW": "L"}, ["name", "code"])
    return (padded.filter(F.col("o_orderpriority").isNotNull())
            .join(F.broadcast(dim), F.trim("o_orderpriority") == F.col("name"))
            .select("o_orderkey", "code"))


@query("src_generated_series", """
select 'k_' || lpad(cast(event_id % 200 as varchar), 3, '0') as key,
       'group_' || cast(event_id % 3 as varchar) as series,
       cast(event_id * event_id as double) as value
from events
""")
def generated_series(spark: SparkSession, d: str) -> DataFrame:
    return files.cyclic_keys(files.read_table(spark, d, "events", "event_id"), "event_id", 200, 3)


@query("src_binary_files", """
select case when page_id % 2 = 0 then 'even' else 'odd' end as label,
       cast(sum(strlen(html) + 1) as bigint) as bytes
from pages group by 1
""")
def binary_files(spark: SparkSession, d: str) -> DataFrame:
    pages = files.read_table(spark, d, "pages", "page_id", "html")
    path = scratch_path(spark, "binary")
    (pages.select("html", F.when(F.col("page_id") % 2 == 0, "even").otherwise("odd")
                  .alias("kind"))
     .write.option("lineSep", "\n").partitionBy("kind").text(path))
    rows = files.read_labelled_files(
        spark, {"even": f"{path}/kind=even", "odd": f"{path}/kind=odd"}, "*.txt")
    return rows.groupBy("label").agg(F.sum("length").alias("bytes"))


def bitmap_text(width: int, height: int, values: Column) -> Column:
    """An uncompressed bitmap of channel values below 128, which are the same bytes as text."""
    # The header of a bitmap file of 24 bits a pixel; sizes are below 128 here.
    head = [66, 77, 54 + 3 * width * height, 0, 0, 0, 0, 0, 0, 0, 54, 0, 0, 0, 40, 0, 0, 0, width, 0, 0, 0, height, 0, 0, 0, 1, 0, 24, *[0] * 25]
    return F.concat(F.lit("".join(map(chr, head))), F.array_join(F.transform(values, lambda v: F.char(v)), ""))


@query("src_images", """
with pixels as (
  select s_suppkey, unnest(range(48)) as i from supplier where s_suppkey % 10 <> 0),
found as (
  select s_suppkey, sum(case when i < 3 then (s_suppkey // pow(100, i)::bigint) % 100 else (s_suppkey * (i + 1)) % 120 end) as total
  from pixels group by 1)
select 'image' as kind, s_suppkey as id, 16::bigint as pixels, total::bigint as total from found
union all select 'broken', -1, 0, count(*) from supplier where s_suppkey % 10 = 0
""")
def images(spark: SparkSession, d: str) -> DataFrame:
    """Bitmaps of four by four pixels, one file each, read as images; a tenth of the files are none."""
    key = F.col("s_suppkey")
    values = F.transform(F.sequence(F.lit(0), F.lit(47)), lambda i: F.when(
        i < 3, F.floor(key / F.pow(F.lit(100), i)) % 100).otherwise((key * (i + 1)) % 120).cast("int"))
    text = F.when(key % 10 == 0, F.lit("no image")).otherwise(bitmap_text(4, 4, values))
    path = sinks.save_single_rows(files.read_table(spark, d, "supplier", "s_suppkey").select(text.alias("value")), scratch_path(spark, "images"))
    read = files.read_images(spark, path, keep_invalid=True).withColumn("values", files.image_values())
    # rows of a bitmap go from the bottom up, so the key is in the first pixel of the last row
    first = F.slice("values", 37, 3)
    marked = read.select(
        F.when(F.col("values").isNull(), "broken").otherwise("image").alias("kind"),
        F.coalesce(first[0] + 100 * first[1] + 10000 * first[2], F.lit(-1)).cast("long").alias("id"),
        F.coalesce(F.col("image.width") * F.col("image.height"), F.lit(0)).alias("area"),
        F.coalesce(F.aggregate("values", F.lit(0), lambda s, x: s + x), F.lit(1)).alias("total"))
    return marked.groupBy("kind", "id").agg(
        F.max(F.when(F.col("kind") == "image", F.col("area")).otherwise(0)).cast("long").alias("pixels"), F.sum("total").alias("total"))


@query("batch_ids", """
with numbered as (
  select p_type, p_partkey,
         (row_number() over (partition by p_type order by p_partkey) - 1) // 100 as batch
  from part)
select p_type, batch, count(*) as ids,
       string_agg(cast(p_partkey as varchar), ',' order by p_partkey) as id_list,
       'Parts' || p_type || '_Chunk' || cast(batch as varchar) || '.json' as file_name
from numbered group by p_type, batch
""")
def id_batches(spark: SparkSession, d: str) -> DataFrame:
    part = files.read_table(spark, d, "part", "p_type", "p_partkey")
    batches = ordered_batches(part, ["p_type"], "p_partkey", 100)
    return batches.select(
        "p_type", "batch", F.size("items").cast("long").alias("ids"),
        F.array_join("items", ",").alias("id_list"),
        clean.chunk_file_name(F.concat(F.lit("Parts ("), "p_type", F.lit(")")), "batch")
        .alias("file_name"))


@query("decode_versioned_payload", """
select event_id, event_type as str1,
       case when event_id % 2 = 0 then cast(json_extract_string(props, '$.k') as double)
       end as int1
from events
""")
def versioned_payload(spark: SparkSession, d: str) -> DataFrame:
    events = files.read_table(spark, d, "events", "event_id", "event_type", "props")
    k = F.get_json_object("props", "$.k").cast("int")
    even = F.col("event_id") % 2 == 0
    stream = events.select(
        "event_id", F.when(even, "2").otherwise("1").alias("version"),
        F.when(even, F.to_json(F.struct(F.col("event_type").alias("str1"), k.alias("int1"))))
        .otherwise(F.to_json(F.struct(F.col("event_type").alias("str1")))).alias("payload"))
    schemas = {"1": T.StructType().add("str1", "string"),
               "2": T.StructType().add("str1", "string").add("int1", "integer")}
    return files.expand_payload(stream, "payload", "version", schemas, ["str1", "int1"]).select(
        "event_id", "str1", F.col("int1").cast("double").alias("int1"))


AVRO_SCHEMAS = {
    1: '{"type": "record", "name": "r", "fields": [{"name": "str1", "type": "string"}]}',
    2: '{"type": "record", "name": "r", "fields": [{"name": "int1", "type": ["null", "int"]}, {"name": "str1", "type": "string"}]}'}


@query("decode_avro_payload", """
select event_id, case when event_id % 11 <> 0 then event_type end as str1,
       case when event_id % 11 <> 0 and event_id % 2 = 0 then cast(json_extract_string(props, '$.k') as double) end as int1
from events
""")
def avro_payload(spark: SparkSession, d: str) -> DataFrame:
    """Binary payloads of two schema versions; every eleventh has lost its last byte."""
    events = files.read_table(spark, d, "events", "event_id", "event_type", "props")
    k = F.get_json_object("props", "$.k").cast("int")
    branch = F.when(k.isNull(), avro.avro_number(F.lit(0))).otherwise(F.concat(avro.avro_number(F.lit(1)), avro.avro_number(F.coalesce(k, F.lit(0)))))
    whole = F.when(F.col("event_id") % 2 == 0, avro.avro_payload(2, branch, avro.avro_text(F.col("event_type")))).otherwise(
        avro.avro_payload(1, avro.avro_text(F.col("event_type"))))
    payload = F.when(F.col("event_id") % 11 == 0, F.substring(whole, 1, F.octet_length(whole) - 1)).otherwise(whole)
    reader = T.StructType().add("str1", "string").add("int1", "double")
    decoded = avro.decode_avro_payloads(events.select("event_id", payload.alias("payload")), "payload", AVRO_SCHEMAS, reader)
    return decoded.select("event_id", "record.str1", "record.int1")


PRIORITY_TOTALS = """
select o_orderpriority, count(*) as orders,
       cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total
from orders group by 1
"""


def _orders(spark: SparkSession, d: str) -> DataFrame:
    return files.read_table(spark, d, "orders")


def _totals(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum(clean.exact("o_totalprice")).cast("double").alias("total"))


@query("sink_partitioned_table", PRIORITY_TOTALS)
def partitioned_table(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "orders_by_priority")
    table = path.rsplit("/", 1)[1].replace("-", "_")
    return _totals(sinks.save_partitioned(_orders(spark, d), table, path, ["o_orderpriority"]),
                   "o_orderpriority")


@query("sink_partitioned_ym", """
select cast(year(o_orderdate) as integer) as order_year,
       cast(month(o_orderdate) as integer) as order_month, count(*) as orders,
       cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total
from orders where year(o_orderdate) > 1996 group by 1, 2
""")
def partitioned_by_month(spark: SparkSession, d: str) -> DataFrame:
    rows = _orders(spark, d).withColumns({
        "order_year": F.year("o_orderdate"), "order_month": F.month("o_orderdate")})
    path = scratch_path(spark, "orders_by_month")
    table = path.rsplit("/", 1)[1].replace("-", "_")
    saved = sinks.save_partitioned(rows, table, path, ["order_year", "order_month"])
    return _totals(saved.filter("order_year > 1996"), "order_year", "order_month")


@query("ctas_partitioned", PRIORITY_TOTALS)
def create_partitioned(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "ctas")
    table = path.rsplit("/", 1)[1].replace("-", "_")
    return _totals(sinks.create_table_as(_orders(spark, d), table, path, ["o_orderpriority"]),
                   "o_orderpriority")


@query("catalog_scan", PRIORITY_TOTALS)
def catalog_scan(spark: SparkSession, d: str) -> DataFrame:
    """A table read by its name in the catalog."""
    path = scratch_path(spark, "named")
    sinks.create_table_as(_orders(spark, d), table_name(path), path)
    return _totals(spark.table(table_name(path)), "o_orderpriority")


@query("ctas_literal", """
select r_name, count(*) as nations from nation join region on n_regionkey = r_regionkey where r_name <> 'ASIA' group by 1
""")
def literal_table(spark: SparkSession, d: str) -> DataFrame:
    """Nations per region through a table made from literal rows, which replaces an older one of its name."""
    path = scratch_path(spark, "literal")
    names = files.read_table(spark, d, "region", "r_regionkey", "r_name")
    sinks.create_table_as(spark.range(3), table_name(path), f"{path}/old")
    rows = files.inline_dimension(spark, {"AFRICA": "kept", "AMERICA": "kept", "EUROPE": "kept", "MIDDLE EAST": "kept"}, ["r_name", "use"])
    kept = sinks.replace_table(rows, table_name(path), f"{path}/new")
    nations = files.read_table(spark, d, "nation", "n_regionkey")
    return nations.join(names, F.col("n_regionkey") == F.col("r_regionkey")).join(kept, "r_name").groupBy("r_name").agg(
        F.count(F.lit(1)).alias("nations"))


@query("cached_reuse", """
select o_orderpriority, count(*) as orders, (select count(*) from orders where o_totalprice > 1000) as of_all
from orders where o_totalprice > 1000 group by 1
""")
def cached_reuse(spark: SparkSession, d: str) -> DataFrame:
    """Two results of one set of rows that is kept in memory meanwhile."""
    with cached(_orders(spark, d).where("o_totalprice > 1000").select("o_orderpriority")) as kept:
        total = kept.count()
        counts = materialise(kept.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("orders")), "counts")
    return counts.withColumn("of_all", F.lit(total).cast("long"))


@query("ctas_cluster_by", """
select event_id, event_type, value from events
""")
def clustered_table(spark: SparkSession, d: str) -> DataFrame:
    events = files.read_table(spark, d, "events", "event_id", "event_type", "value")
    path = scratch_path(spark, "clustered")
    table = path.rsplit("/", 1)[1].replace("-", "_")
    return sinks.save_clustered(events, table, path, "event_type", "event_id")


@query("sink_bucketed", """
select user_id, count(*) as events, cast(sum(event_id) as double) as id_total
from events group by 1
""")
def bucketed_table(spark: SparkSession, d: str) -> DataFrame:
    events = files.read_table(spark, d, "events", "event_id", "user_id", "ts")
    path = scratch_path(spark, "bucketed")
    table = path.rsplit("/", 1)[1].replace("-", "_")
    saved = sinks.save_bucketed(events, table, path, "user_id", "ts", 40)
    return saved.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("events"), clean.whole_total("event_id").alias("id_total"))


@query("sink_bucketed_join", """
select user_id, c_mktsegment, count(*) as events from events join customer on user_id = c_custkey group by 1, 2
""")
def bucketed_join(spark: SparkSession, d: str) -> DataFrame:
    """Two tables bucketed alike are joined and counted where they lie."""
    events = files.read_table(spark, d, "events", "event_id", "user_id").withColumn("user_id", F.col("user_id").cast("long"))
    customers = files.read_table(spark, d, "customer", "c_custkey", "c_mktsegment").withColumn(
        "c_custkey", F.col("c_custkey").cast("long"))
    saved = []
    for rows, key in ((events, "user_id"), (customers, "c_custkey")):
        path = scratch_path(spark, "bucketed")
        saved.append(sinks.save_bucketed(rows, path.rsplit("/", 1)[1].replace("-", "_"), path, key, key, 40))
    joined = saved[0].join(saved[1].hint("merge"), F.col("user_id") == F.col("c_custkey"))
    return joined.groupBy("user_id", "c_mktsegment").agg(F.count(F.lit(1)).alias("events"))


@query("sink_max_records", """
select count(*) as rows, cast(0 as bigint) as files_over_cap from lineitem
""")
def capped_files(spark: SparkSession, d: str) -> DataFrame:
    lines = files.read_table(spark, d, "lineitem")
    saved = sinks.save_capped(lines, scratch_path(spark, "capped"), 20_000)
    return sinks.rows_per_file(saved).agg(
        F.sum("n").alias("rows"),
        F.sum(F.when(F.col("n") > 20_000, 1).otherwise(0)).alias("files_over_cap"))


@query("partition_discovery", """
select event_type as kind, count(*) as events, cast(sum(event_id) as double) as id_total
from events group by 1
""")
def discovered_partitions(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "discovered")
    table = path.rsplit("/", 1)[1].replace("-", "_")
    (files.read_table(spark, d, "events", "event_id", "event_type")
     .withColumnRenamed("event_type", "kind").write.partitionBy("kind").parquet(path))
    found = sinks.attach_partitions(
        spark, table, path, "event_id BIGINT, kind STRING", "kind",
        {"click": f"{path}/kind=click"})
    return found.groupBy("kind").agg(
        F.count(F.lit(1)).alias("events"), clean.whole_total("event_id").alias("id_total"))


def _profile_sql(columns: dict[str, str]) -> str:
    return " union all ".join(
        f"select '{c}' as column_name, '{kind}' as type, count(*) as rows, "
        f"count(*) - count({c}) as nulls, count(distinct {c}) as distinct_values, "
        f"cast(min({c}) as varchar) as lowest, cast(max({c}) as varchar) as highest "
        "from customer" for c, kind in columns.items())


@query("table_profile", _profile_sql({
    "c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double",
    "c_mktsegment": "string"}))
def table_profile(spark: SparkSession, d: str) -> DataFrame:
    return sinks.profile(files.read_table(spark, d, "customer"))


@query("partition_sizes", """
select count(*) as rows, true as bounded from documents
""")
def partition_sizes(spark: SparkSession, d: str) -> DataFrame:
    """Even partitions of bounded bytes; none holds twice what was asked for and a row more."""
    bound = 1 << 20
    documents = files.read_table(spark, d, "documents", "doc_id", "n_chars")
    spread = sinks.bounded_partitions(documents, F.col("n_chars"), bound)
    sizes = spread.groupBy(F.spark_partition_id().alias("part")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("size"), F.max("n_chars").alias("largest"))
    return sizes.agg(F.sum("n").alias("rows"), (F.max("size") <= 2 * bound + F.max("largest")).alias("bounded"))
