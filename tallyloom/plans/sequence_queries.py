"""Series and text windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators import autoregression, sequences
from tallyloom.plans.registry import query
from tallyloom.sources.files import read_table


def _series(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "events", "user_id", "ts", "event_id", "value")


def _windows(spark: SparkSession, d: str, size: int, overlap: int, legacy: bool = True) -> DataFrame:
    return sequences.series_windows(
        _series(spark, d), ["user_id"], ["ts", "event_id"], "value", size, overlap, legacy)


def sql_windows(size: int, overlap: int, legacy: bool = True) -> str:
    stride = size - overlap
    count, least = (f"(len - {size - 1}) // {stride}", size + 1) if legacy else (f"(len - {size}) // {stride} + 1", size)
    return f"""
with placed as (
  select user_id, value, row_number() over (partition by user_id order by ts, event_id) - 1 as seat,
         count(*) over (partition by user_id) as len from events),
starts as (
  select distinct user_id, len, unnest(range({count})) as window_id
  from (select distinct user_id, len from placed where len >= {least})),
windows as (
  select s.user_id, s.window_id, list(value order by seat) as items
  from starts s join placed p on p.user_id = s.user_id
   and p.seat between s.window_id * {stride} and s.window_id * {stride} + {size - 1}
  group by 1, 2)
"""


JOINED = "array_to_string(list_transform({items}, lambda x: printf('%.2f', x)), ' ')"


def _text(items: str):
    return F.array_join(F.transform(F.col(items), lambda x: F.format_string("%.2f", x)), " ")


@query("series_windows", sql_windows(5, 1) + f"""
select user_id, window_id, {JOINED.format(items='items')} as items from windows
""")
def windows(spark: SparkSession, d: str) -> DataFrame:
    return _windows(spark, d, 5, 1).withColumn("items", _text("items"))


@query("series_windows_all", sql_windows(5, 2, False) + f"""
select user_id, window_id, {JOINED.format(items='items')} as items from windows
""")
def all_windows(spark: SparkSession, d: str) -> DataFrame:
    """Every complete window."""
    return _windows(spark, d, 5, 2, False).withColumn("items", _text("items"))


@query("window_split", sql_windows(5, 2, False) + f"""
select user_id, window_id, {JOINED.format(items='items')} as items,
       window_id < floor(0.7 * count(*) over (partition by user_id)) as is_train from windows
""")
def window_split(spark: SparkSession, d: str) -> DataFrame:
    """The first seven tenths of each series' windows are for training."""
    marked = sequences.chronological_window_split(_windows(spark, d, 5, 2, False), ["user_id"], 0.7)
    return marked.withColumn("items", _text("items"))


@query("window_features_label", sql_windows(5, 4) + f"""
select user_id, window_id, {JOINED.format(items='items[1:4]')} as features, items[5] as label
from windows
""")
def features(spark: SparkSession, d: str) -> DataFrame:
    samples = sequences.features_and_label(_windows(spark, d, 5, 4))
    return samples.withColumn("features", _text("features"))


@query("one_step_baseline", sql_windows(5, 4) + """
select user_id, count(*) as windows, round(sqrt(avg((items[4] - items[5]) * (items[4] - items[5]))), 6)
  as rmse
from windows group by 1
""")
def baseline(spark: SparkSession, d: str) -> DataFrame:
    samples = sequences.last_value_error(sequences.features_and_label(_windows(spark, d, 5, 4)))
    return samples.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("windows"),
        F.round(F.sqrt(F.avg(F.col("error") * F.col("error"))), 6).alias("rmse"))


@query("one_step_autoregression", sql_windows(3, 2, False) + """,
sums as (
  select user_id, count(*) as n, avg(items[1]) as m1, avg(items[2]) as m2, avg(items[3]) as my,
    var_pop(items[1]) as s11, var_pop(items[2]) as s22, covar_pop(items[1], items[2]) as s12,
    covar_pop(items[1], items[3]) as s1y, covar_pop(items[2], items[3]) as s2y, var_pop(items[3]) as syy,
    avg((items[2] - items[3]) * (items[2] - items[3])) as last
  from windows group by 1),
fits as (
  select *, n >= 4 and s11 > 0 and s22 > 0 and s11 * s22 - s12 * s12 > 1e-9 * s11 * s22 as fitted,
    (s1y * s22 - s2y * s12) / (s11 * s22 - s12 * s12) as b1, (s2y * s11 - s1y * s12) / (s11 * s22 - s12 * s12) as b2 from sums)
select user_id, n as windows, round(case when fitted then my - b1 * m1 - b2 * m2 end, 4) as intercept,
  round(case when fitted then b1 end, 5) as lag2, round(case when fitted then b2 end, 5) as lag1,
  round(case when fitted then sqrt(greatest(syy - b1 * s1y - b2 * s2y, 0)) end, 4) as rmse, round(sqrt(last), 4) as last_value_rmse
from fits
""")
def one_step_autoregression(spark: SparkSession, d: str) -> DataFrame:
    """Each user's next value from the two before it, next to the error of taking the last value."""
    fits = autoregression.fit_autoregression(_series(spark, d), ["user_id"], ["ts", "event_id"], "value", 2)
    return fits.select(
        "user_id", "windows", F.round("intercept", 4).alias("intercept"), F.round(F.col("coefficients")[0], 5).alias("lag2"),
        F.round(F.col("coefficients")[1], 5).alias("lag1"), F.round("rmse", 4).alias("rmse"), F.round("last_value_rmse", 4).alias("last_value_rmse"))


@query("split_chronological", """
with placed as (
  select event_id, user_id, row_number() over (partition by user_id order by ts, event_id) as position,
         count(*) over (partition by user_id) as len from events)
select event_id, user_id, position, position <= floor(0.7::double * len) as is_train from placed
""")
def by_time(spark: SparkSession, d: str) -> DataFrame:
    rows = read_table(spark, d, "events", "event_id", "user_id", "ts")
    return sequences.chronological_split(rows, ["user_id"], ["ts", "event_id"], 0.7).drop("ts")


def sql_char_windows(table: str, key: str, length: int, stride: int) -> str:
    return f"""
with windows as (
  select {key}, start, substring(text, start + 1, {length}) as prefix,
         substring(text, start + {length + 1}, 1) as next_char
  from (select {key}, text, cast(unnest(range(0, length(text) - {length}, {stride})) as integer) as start
        from {table}))
"""


@query("char_windows", sql_char_windows("documents", "doc_id", 40, 3) + """
select doc_id, next_char, count(*) as windows, cast(sum(unicode(prefix)) as bigint) as first_codes,
       max(start) as last_start
from windows group by 1, 2
""")
def char_windows(spark: SparkSession, d: str) -> DataFrame:
    """Windows over whole documents, summed up per document and next character."""
    windows = sequences.char_windows(read_table(spark, d, "documents", "doc_id", "text"), "text", 40, 3)
    return windows.groupBy("doc_id", "next_char").agg(
        F.count(F.lit(1)).alias("windows"), F.sum(F.ascii("prefix").cast("long")).alias("first_codes"),
        F.max("start").alias("last_start"))


@query("char_windows_rows", sql_char_windows("benchmark", "item_id", 3, 1) + """
select item_id, start, prefix, next_char from windows
""")
def char_window_rows(spark: SparkSession, d: str) -> DataFrame:
    return sequences.char_windows(read_table(spark, d, "benchmark", "item_id", "text"), "text", 3, 1)


@query("char_vocab", """
with letters as (select distinct unnest(string_split(text, '')) as character from documents),
coded as (select character, row_number() over (order by encode(character)) - 1 as code,
                 count(*) over () as size
          from letters where character <> '')
select character, code, code / size as scaled from coded
""")
def vocabulary(spark: SparkSession, d: str) -> DataFrame:
    return sequences.vocabulary(read_table(spark, d, "documents", "text"), "text")


@query("char_onehot_sparse", sql_char_windows("benchmark", "item_id", 3, 1) + """
, coded as (
  select character, row_number() over (order by encode(character)) - 1 as code
  from (select distinct unnest(string_split(text, '')) as character from benchmark)
  where character <> '')
select item_id, start, next_char, cast(place as integer) as place, code
from (select *, unnest(range(3)) as place from windows)
join coded on character = substring(prefix, cast(place as integer) + 1, 1)
""")
def one_hot(spark: SparkSession, d: str) -> DataFrame:
    texts = read_table(spark, d, "benchmark", "item_id", "text")
    samples = sequences.char_windows(texts, "text", 3, 1)
    return sequences.one_hot_positions(samples, "prefix", sequences.vocabulary(texts, "text"))


@query("transition_matrix", """
with pairs as (
  select event_type as previous,
         lead(event_type) over (partition by user_id order by ts, event_id) as following from events),
counted as (select previous, following, count(*) as n from pairs where following is not null group by 1, 2)
select previous, following, n, round(n / sum(n) over (partition by previous), 8) as share from counted
""")
def transition_matrix(spark: SparkSession, d: str) -> DataFrame:
    rows = read_table(spark, d, "events", "user_id", "ts", "event_id", "event_type")
    table = sequences.transitions(rows, ["user_id"], ["ts", "event_id"], "event_type")
    return table.withColumn("share", F.round("share", 8))


@query("corrupt_sequences", sql_char_windows("benchmark", "item_id", 3, 1) + """
select item_id, start, prefix, next_char, cast(place as integer) as place,
       substring(prefix, 1, cast(place as integer) - 1) || '?' || substring(prefix, cast(place as integer) + 1)
         as variant
from (select *, unnest(range(1, 4)) as place from windows)
""")
def corrupt(spark: SparkSession, d: str) -> DataFrame:
    samples = sequences.char_windows(read_table(spark, d, "benchmark", "item_id", "text"), "text", 3, 1)
    return sequences.corrupted(samples, "prefix", 3)
