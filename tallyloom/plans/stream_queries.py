"""Streaming jobs: the events table read as a stream of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.fixed_values import WIKI_EDIT
from tallyloom.functions import cleaning as clean
from tallyloom.plans.cleaning_queries import TYPE_CODES, TYPE_LABELS
from tallyloom.plans.registry import query
from tallyloom.sources.files import read_table
from tallyloom.streaming import corrections, envelopes, runner, transforms, upserts
from tallyloom.workspace import scratch_name, scratch_path

EVENTS = ("event_id long, ts timestamp_ntz, user_id long, event_type string, value double, "
          "props string")


def event_stream(spark: SparkSession, d: str) -> DataFrame:
    stream = runner.file_stream(spark, f"{d}/events.parquet*", EVENTS, files_per_trigger=10_000)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def hits(spark: SparkSession, d: str) -> DataFrame:
    """Events as JSON messages in the Kafka envelope."""
    message = F.to_json(F.struct(
        F.get_json_object("props", "$.k").alias("zip"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ssXXX").alias("hittime"),
        F.col("event_type").alias("city")))
    return envelopes.as_kafka(
        event_stream(spark, d), F.col("user_id").cast("string"), message,
        F.concat(F.lit("topic"), (F.col("event_id") % 2).cast("string")), F.col("event_id"),
        F.col("ts"))


ZIP = {"zip": "$.zip", "hittime": "$.hittime"}


@query("st_file_source", """
select event_type, count(*) as n, cast(sum(event_id) as double) as ids from events group by 1
""")
def file_source(spark: SparkSession, d: str) -> DataFrame:
    """CSV files taken two per trigger, with blanks and missing markers."""
    path = scratch_path(spark, "stream_csv")
    (read_table(spark, d, "events", "event_id", "event_type").repartition(6)
     .withColumn("event_type", F.concat(F.lit(" "), "event_type"))
     .write.options(header=True, ignoreLeadingWhiteSpace=False).csv(path))
    stream = runner.file_stream(
        spark, path, "event_id long, event_type string", "csv", 2, header="true",
        nullValue="NA", ignoreLeadingWhiteSpace="true", ignoreTrailingWhiteSpace="true")
    counted = stream.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), clean.whole_total("event_id").alias("ids"))
    return runner.run_complete(counted)


@query("st_kafka_envelope", """
select 'topic' || cast(event_id % 2 as varchar) as topic, count(*) as messages,
       max(event_id) as last_offset
from events group by 1
""")
def kafka_envelope(spark: SparkSession, d: str) -> DataFrame:
    rows = envelopes.value_text(hits(spark, d))
    counted = rows.groupBy("topic").agg(
        F.count("value").alias("messages"), F.max("offset").alias("last_offset"))
    return runner.run_complete(counted)


@query("st_count_by_key", """
select json_extract_string(props, '$.k') as zip, count(*) as n from events group by 1
""")
def count_by_key(spark: SparkSession, d: str) -> DataFrame:
    return runner.run_complete(
        transforms.running_count(envelopes.json_paths(hits(spark, d), {"zip": "$.zip"}), "zip"))


@query("st_sliding_window", """
with hit as (select json_extract_string(props, '$.k') as zip, date_trunc('second', ts) as moment from events),
starts as (
  select zip, time_bucket(interval 5 minutes, moment, timestamp '2000-01-01 00:02:00') as start from hit
  union all
  select zip, time_bucket(interval 5 minutes, moment, timestamp '2000-01-01 00:02:00') - interval 5 minutes
  from hit)
select zip, strftime(start, '%Y-%m-%d %H:%M:%S') as window_start,
       strftime(start + interval 10 minutes, '%Y-%m-%d %H:%M:%S') as window_end, count(*) as n
from starts group by all
""")
def sliding(spark: SparkSession, d: str) -> DataFrame:
    rows = envelopes.json_paths(hits(spark, d), ZIP).withColumn(
        "hittime", F.col("hittime").cast("timestamp"))
    counts = transforms.windowed_count(rows, "hittime", "zip", length="10 minutes",
                                       slide="5 minutes", start="2 minutes")
    return transforms.window_bounds(runner.run_complete(counts))


@query("st_tumbling_window", """
select event_type as channel,
       strftime(time_bucket(interval 10 seconds, ts), '%H:%M:%S') as time, count(*) as n
from events group by event_type, time_bucket(interval 10 seconds, ts)
""")
def tumbling(spark: SparkSession, d: str) -> DataFrame:
    rows = event_stream(spark, d).select(F.col("event_type").alias("channel"), "ts")
    counts = transforms.windowed_count(rows, "ts", "channel", length="10 seconds")
    landed = runner.run_complete(counts).orderBy("window", "channel")
    return landed.select("channel", F.date_format("window.start", "HH:mm:ss").alias("time"), "n")


@query("st_word_count", """
select lower(event_type) as word, count(*) as n from events group by 1
""")
def word_count(spark: SparkSession, d: str) -> DataFrame:
    records = event_stream(spark, d).select(
        F.col("user_id").cast("string").alias("partitionKey"),
        F.initcap("event_type").cast("binary").alias("data"))
    return runner.run_complete(transforms.running_count(envelopes.payload_words(records), "word"))


@query("st_json_tuple", """
select event_type as channel, user_id % 2 = 1 as robot, count(*) as edits from events group by 1, 2
""")
def json_lines(spark: SparkSession, d: str) -> DataFrame:
    """JSON lines from a folder of text files."""
    path = scratch_path(spark, "stream_text")
    (read_table(spark, d, "events")
     .select(F.to_json(F.struct(F.col("event_type").alias("channel"),
                                (F.col("user_id") % 2 == 1).alias("isRobot"))))
     .write.text(path))
    lines = runner.file_stream(spark, path, "value string", "text")
    rows = lines.select(F.json_tuple("value", "channel", "isRobot").alias("channel", "robot"))
    counted = rows.withColumn("robot", F.col("robot").cast("boolean")).groupBy(
        "channel", "robot").agg(F.count(F.lit(1)).alias("edits"))
    return runner.run_complete(counted)


@query("st_decode_labels", """
select event_id, case event_type when 'click' then 'Click' when 'view' then 'View'
       when 'purchase' then 'Purchase' when 'signup' then 'Sign-up' end as code_str
from events
""")
def decoded(spark: SparkSession, d: str) -> DataFrame:
    coded = event_stream(spark, d).select(
        "event_id", clean.decode("event_type", TYPE_CODES).alias("code"))
    return runner.run_to_files(clean.decode_all(coded, {"code": TYPE_LABELS}).drop("code"))


@query("st_parquet_sink", """
select event_type, count(*) as n, cast(sum(event_id) as double) as ids from events group by 1
""")
def parquet_sink(spark: SparkSession, d: str) -> DataFrame:
    rows = event_stream(spark, d).select("event_id", "event_type")
    return runner.run_to_files(rows, ["event_type"]).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), clean.whole_total("event_id").alias("ids"))


@query("st_raw_then_batch", """
select event_type as wikipedia, user_id % 2 = 1 as "isRobot",
       strftime(time_bucket(interval 1 hour, ts), '%Y-%m-%d %H:%M:%S') as window_start, count(*) as n
from events group by event_type, user_id % 2 = 1, time_bucket(interval 1 hour, ts)
""")
def raw_then_batch(spark: SparkSession, d: str) -> DataFrame:
    """Windowed rows are appended raw by the stream and counted by a later batch."""
    message = F.to_json(F.struct(
        F.col("event_type").alias("wikipedia"), F.col("ts").alias("timestamp"),
        F.col("user_id").cast("string").alias("page"),
        (F.col("user_id") % 2 == 1).alias("isRobot")))
    edits = envelopes.json_record(event_stream(spark, d).select(message.alias("value")), WIKI_EDIT)
    raw = edits.select("wikipedia", "isRobot", F.window("timestamp", "1 hour").alias("window"))
    counted = runner.run_to_files(raw).groupBy("wikipedia", "isRobot", "window").agg(
        F.count(F.lit(1)).alias("n"))
    return counted.select("wikipedia", "isRobot", "n", F.date_format(
        "window.start", transforms.STAMP).alias("window_start"))


@query("st_sql_view", """
select event_type, strftime(time_bucket(interval 1 day, ts), '%d.%m.%Y') as day, count(*) as n
from events where event_type <> 'error' group by event_type, time_bucket(interval 1 day, ts)
""")
def sql_view(spark: SparkSession, d: str) -> DataFrame:
    view = scratch_name("event_stream")
    event_stream(spark, d).createOrReplaceTempView(view)
    counted = spark.sql(
        f"SELECT event_type, date_format(window(ts, '1 day').start, 'dd.MM.yyyy') AS day, "
        f"count(*) AS n FROM {view} WHERE event_type <> 'error' "
        f"GROUP BY event_type, window(ts, '1 day')")
    return runner.run_complete(counted)


@query("st_static_join", """
select word, meaning, count(*) as n from events
join (select 'click' as word, 'ECONOMY' as meaning union all select 'view', 'PROMO') on event_type = word
group by 1, 2
""")
def static_join(spark: SparkSession, d: str) -> DataFrame:
    dimension = spark.range(1).select(F.inline(F.array(
        F.struct(F.lit("click").alias("word"), F.lit("ECONOMY").alias("meaning")),
        F.struct(F.lit("view").alias("word"), F.lit("PROMO").alias("meaning")))))
    words = event_stream(spark, d).select(F.col("event_type").alias("word"))
    counts = transforms.running_count(words, "word")
    return runner.run_complete(transforms.with_dimension(counts, dimension, "word")).select(
        "word", "meaning", "n")


@query("st_static_join_rows", """
select event_id, user_id, c_mktsegment from events join customer on user_id = c_custkey
""")
def static_join_rows(spark: SparkSession, d: str) -> DataFrame:
    """Every row of the stream with its static customer, appended to files."""
    customers = read_table(spark, d, "customer").select(
        F.col("c_custkey").alias("user_id"), "c_mktsegment")
    rows = event_stream(spark, d).select("event_id", "user_id")
    return runner.run_to_files(transforms.with_dimension(rows, customers, "user_id", spread_by=["event_id"]))


@query("st_customer_join", """
select c_mktsegment, count(*) as n from events join customer on user_id = c_custkey group by 1
""")
def customer_join(spark: SparkSession, d: str) -> DataFrame:
    """Running counts per user joined to the static customers, added up by segment when read.

    Counting first means a very active user is one row at the join.
    """
    customers = read_table(spark, d, "customer").select(
        F.col("c_custkey").alias("user_id"), "c_mktsegment")
    counts = transforms.running_count(event_stream(spark, d).select("user_id"), "user_id")
    joined = runner.run_complete(transforms.with_dimension(counts, customers, "user_id"))
    return joined.groupBy("c_mktsegment").agg(F.sum("n").alias("n"))


@query("st_late_data", """
select strftime(time_bucket(interval 1 day, ts), '%Y-%m-%d %H:%M:%S') as window_start,
       strftime(time_bucket(interval 1 day, ts) + interval 1 day, '%Y-%m-%d %H:%M:%S') as window_end,
       count(*) as n
from events group by 1, 2
""")
def late_data(spark: SparkSession, d: str) -> DataFrame:
    """Newer events arrive first; older ones in a second file change reported windows."""
    path = scratch_path(spark, "stream_late")
    events = read_table(spark, d, "events", "event_id", "ts").withColumn(
        "ts", F.col("ts").cast("timestamp"))
    newer = F.col("event_id") % 2 == 1
    events.filter(newer).write.mode("append").parquet(path)
    events.filter(~newer).write.mode("append").parquet(path)
    stream = runner.file_stream(spark, path, "event_id long, ts timestamp", "parquet", 1)
    counts = transforms.windowed_count(stream, "ts", length="1 day")
    return transforms.window_bounds(runner.run_complete(counts))


@query("st_partition_by_day", """
select event_type, strftime(ts, '%d.%m.%Y') as day, count(*) as n from events group by 1, 2
""")
def by_day(spark: SparkSession, d: str) -> DataFrame:
    """Raw rows appended into key and day folders, counted when read."""
    rows = transforms.daily(event_stream(spark, d), "ts").select("event_id", "event_type", "day")
    return runner.run_to_files(rows, ["event_type", "day"]).groupBy("event_type", "day").agg(
        F.count(F.lit(1)).alias("n"))


@query("st_upsert_sink", """
select json_extract_string(props, '$.k') as zip, count(*) as n from events group by 1
""")
def upsert(spark: SparkSession, d: str) -> DataFrame:
    """Update-mode counts over several small batches, kept as the latest row per key."""
    path = scratch_path(spark, "stream_updates_in")
    read_table(spark, d, "events", "event_id", "props").repartition(4).write.parquet(path)
    stream = runner.file_stream(spark, path, "event_id long, props string", "parquet", 1)
    zips = stream.select(F.get_json_object("props", "$.k").alias("zip"))
    return upserts.run_upsert(transforms.running_count(zips, "zip"), ["zip"])


@query("st_kv_projection", """
select event_type as key, event_type || ':' || cast(count(*) as varchar) as value from events group by 1
""")
def key_values(spark: SparkSession, d: str) -> DataFrame:
    counts = transforms.running_count(event_stream(spark, d), "event_type")
    return runner.run_upsert(transforms.key_value_text(counts, "event_type", "n"), ["key"])


@query("st_corrections", """
select event_type as key, date_diff('second', timestamp '1970-01-01', time_bucket(interval '1 hour', ts::timestamp)) as window_second,
  count(*) as n, count(*) as latest from events group by 1, 2
""")
def window_corrections(spark: SparkSession, d: str) -> DataFrame:
    """Hourly counts added up from the corrections that four batches gave, and the last count each window was given."""
    path = scratch_path(spark, "stream_corrections_in")
    read_table(spark, d, "events", "event_type", "ts").repartition(4).write.parquet(path)
    stream = runner.file_stream(spark, path, spark.read.parquet(path).schema, "parquet", 1)
    changes = runner.run_to_files(corrections.window_corrections(stream, "ts", "event_type", 3600, 10 * 365 * 86400))
    return changes.groupBy("key", F.unix_timestamp("window_start").alias("window_second")).agg(
        F.sum(F.col("after") - F.col("before")).alias("n"), F.max("after").alias("latest"))
