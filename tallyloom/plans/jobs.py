"""Whole jobs: raw records in, clean table and the questions asked of it out.

Each job is a few operator calls; the registered queries at the end run the
jobs on records respelled from the standard tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom import fixed_values as fixed
from tallyloom.functions import cleaning as clean
from tallyloom.operators import features, joins, ranking
from tallyloom.plans.registry import query
from tallyloom.sources.files import inline_dimension, read_table


# Match events ---------------------------------------------------------------

def match_events(events: DataFrame, games: DataFrame) -> DataFrame:
    """Decoded match events with their country's code and ten bins of match time."""
    coded = games.select("id_odsp", clean.decode("country", fixed.COUNTRY_CODES)
                         .alias("country_code"))
    rows = clean.decode_all(events, fixed.MATCH_EVENT_BOOKS).drop("text", "fast_break")
    return features.quantile_bins(rows.join(coded, "id_odsp"), "time", 10, "time_bin")


def goals(events: DataFrame) -> DataFrame:
    return events.filter("is_goal = 1")


def goals_by_shot_place(events: DataFrame) -> DataFrame:
    """Grouped by the decoded place itself; the missing place is renamed afterwards."""
    counts = goals(events).groupBy("shot_place_str").agg(F.count(F.lit(1)).alias("tot_goals"))
    return counts.select(clean.unknown_bucket("shot_place_str").alias("shot_place"), "tot_goals")


def goals_by_country(events: DataFrame) -> DataFrame:
    return goals(events).groupBy("country_code").agg(F.count(F.lit(1)).alias("tot_goals"))


def best_locations_by_place(events: DataFrame, country: str, n: int = 3) -> DataFrame:
    counts = goals(events).filter(F.col("country_code") == country).groupBy(
        clean.unknown_bucket("shot_place_str").alias("shot_place_str"),
        clean.unknown_bucket("location_str").alias("location_str"),
    ).agg(F.count(F.lit(1)).alias("tot_goals"))
    return ranking.top_known_per_group(
        counts, ["shot_place_str"], "tot_goals", n, ["location_str", "shot_place_str"])


def goals_by_time_bin(events: DataFrame) -> DataFrame:
    return goals(events).groupBy("country_code", "time_bin").agg(
        F.count(F.lit(1)).alias("tot_goals")).orderBy("country_code", "time_bin")


# Storm events ---------------------------------------------------------------

STORM_COLUMNS = ("EPISODE_ID", "EVENT_ID", "STATE_CODE", "STATE_NAME", "YEAR", "MONTH_NAME",
                 "EVENT_TYPE", "CZ_TYPE", "CZ_NAME", "TOT_INJURIES", "TOT_DEATHS",
                 "DAMAGE_PROPERTY_THDS", "DAMAGE_CROPS_THDS", "TOT_DAMAGE_THDS",
                 "EPISODE_NARRATIVE", "EVENT_NARRATIVE")


def storm_events(details: DataFrame) -> DataFrame:
    """Clean storm events of known states, damage in thousands."""
    states = inline_dimension(details.sparkSession, fixed.STATE_CODES, ["STATE_NAME", "STATE_CODE"])
    rows = details.filter(F.col("STATE").isNotNull()).join(
        F.broadcast(states), F.trim("STATE") == F.col("STATE_NAME"))
    rows = rows.withColumns({
        "EVENT_TYPE": clean.merge_labels("EVENT_TYPE", fixed.STORM_LABELS),
        "TOT_INJURIES": clean.add_columns(["INJURIES_DIRECT", "INJURIES_INDIRECT"]),
        "TOT_DEATHS": clean.add_columns(["DEATHS_DIRECT", "DEATHS_INDIRECT"]),
        "DAMAGE_PROPERTY_THDS": clean.parse_magnitude("DAMAGE_PROPERTY"),
        "DAMAGE_CROPS_THDS": clean.parse_magnitude("DAMAGE_CROPS")})
    rows = rows.withColumn("TOT_DAMAGE_THDS", clean.add_columns(
        ["DAMAGE_PROPERTY_THDS", "DAMAGE_CROPS_THDS"]))
    return rows.select(*[c for c in STORM_COLUMNS if c in rows.columns])


def harm_by_event_type(storms: DataFrame) -> DataFrame:
    return storms.groupBy("EVENT_TYPE").agg(
        F.sum("TOT_DEATHS").alias("AGG_TOT_DEATHS"), F.sum("TOT_INJURIES").alias("AGG_TOT_INJURIES"))


def damage_by_state(storms: DataFrame, left_out: Sequence[str] = ("GU", "PR", "VI", "AS")) -> DataFrame:
    return storms.filter(~F.col("STATE_CODE").isin(*left_out)).groupBy("STATE_CODE").agg(
        F.sum("TOT_DAMAGE_THDS").alias("AGG_TOT_DMG_THDS"))


def worst_event_types_by_year(storms: DataFrame, state: str, after: int, n: int = 5) -> DataFrame:
    totals = (
        storms.filter((F.col("STATE_CODE") == state) & (F.col("YEAR") > after))
        .groupBy("EVENT_TYPE", "YEAR").agg(F.sum("TOT_DAMAGE_THDS").alias("AGG_TOT_DMG_THDS")))
    return ranking.top_per_group(totals, ["YEAR"], "AGG_TOT_DMG_THDS", n)


def fatal_events(storms: DataFrame, fatalities: DataFrame) -> DataFrame:
    known = fatalities.filter(F.col("FATALITY_AGE").isNotNull() & F.col("FATALITY_SEX").isNotNull())
    return storms.join(known, ["EVENT_ID"])


def storm_impact(records: DataFrame) -> DataFrame:
    """Impact per record of the older file layout, damage in millions."""
    letters = fixed.MAGNITUDE_LETTERS
    kept = records.filter(
        F.col("EVTYPE").isin(*fixed.PERMITTED_STORM_EVENTS)
        & F.col("PROPDMGEXP").isin(*letters) & F.col("CROPDMGEXP").isin(*letters))
    return kept.select(
        "EVTYPE", clean.year_of_text_date("BGN_DATE").alias("YEAR"),
        clean.add_columns([F.col("FATALITIES").cast("int"), F.col("INJURIES").cast("int")])
        .alias("POPIMPACT"),
        clean.add_columns([clean.scale_by_unit("PROPDMG", "PROPDMGEXP"),
                           clean.scale_by_unit("CROPDMG", "CROPDMGEXP", legacy_crop=True)])
        .alias("ECOIMPACT"))


def impact_totals(impact: DataFrame, *by: str) -> DataFrame:
    return impact.groupBy(*by).agg(F.sum("POPIMPACT").alias("TOTPOPIMPACT"),
                                   F.sum("ECOIMPACT").alias("TOTECOIMPACT"))


def most_harmful(impact: DataFrame, measure: str, n: int = 10) -> DataFrame:
    return ranking.top_rows(impact_totals(impact, "EVTYPE"), n, F.desc(measure), F.asc("EVTYPE"))


# Health indicators ------------------------------------------------------------

def health_indicators(records: DataFrame) -> DataFrame:
    """Single-year indicators with a value, typed; the unit follows the historic rule."""
    kept = records.filter(
        (F.col("YearStart") == F.col("YearEnd")) & clean.not_blank("DataValue"))
    renamed = kept.withColumnsRenamed({
        "YearStart": "Year", "LocationAbbr": "State_Code", "LocationDesc": "State",
        "Stratification1": "Stratification"})
    return renamed.select(
        "Year", "State_Code", "State", "Topic", "Question", "DataValueType",
        clean.value_unit("DataValueType").alias("DataValueUnit"), "Stratification", "DataValue",
        clean.typed_value("DataValueType", "DataValue").alias("DataValueNum"))


def counted_cases(indicators: DataFrame, topic: str,
                  left_out: Sequence[str] = ("Overall", "Male", "Female")) -> DataFrame:
    return indicators.filter(
        (F.col("DataValueType") == "Number") & (F.col("Topic") == topic)
        & ~F.col("Stratification").isin(*left_out))


def cases_by(cases: DataFrame, *by: str) -> DataFrame:
    return cases.groupBy(*by).agg(
        F.count(F.lit(1)).alias("Sample_Count"), F.sum("DataValueNum").alias("Tot_Cases"))


def most_affected(cases: DataFrame, states: Sequence[str], n: int = 3) -> DataFrame:
    totals = cases.filter(F.col("State_Code").isin(*states)).groupBy(
        "State_Code", "Stratification").agg(F.sum("DataValueNum").alias("Tot_Cases"))
    return ranking.top_per_group(totals, ["State_Code"], "Tot_Cases", n)


# Minute bars and page views ---------------------------------------------------

def minute_bars(bars: DataFrame) -> DataFrame:
    """Bars with a price, a real timestamp and its parts, and plain column names."""
    kept = bars.dropna(how="all", subset=["Open", "High", "Low", "Close"])
    stamped = kept.withColumn("Timestamp", clean.epoch_timestamp("Timestamp")).withColumnsRenamed(
        {"Volume_(BTC)": "Volume_BTC", "Volume_(Currency)": "Volume_Currency"})
    parts = clean.date_parts("Timestamp")
    return stamped.withColumns(
        {"Year": parts["year"], "Month": parts["month"], "DayOfMonth": parts["day"]})


def daily_price_means(bars: DataFrame, year: int) -> DataFrame:
    return bars.filter(F.col("Year") == year).groupBy("DayOfMonth", "Month").agg(
        F.avg("Open").alias("mean_open"), F.avg("High").alias("mean_high"))


def page_requests(views: DataFrame, project: str, prefix: str) -> DataFrame:
    """Total requests of a project's pages that start with a prefix, whatever their case."""
    return views.filter(
        (F.col("project") == project) & F.lower("page").startswith(prefix.lower())
    ).agg(F.sum("requests").alias("requests"))


def city_requests_and_population(views: DataFrame, zips: DataFrame, project: str,
                                 per_match: bool) -> DataFrame:
    """Requests and population of the cities whose page carries their name.

    ``per_match`` repeats each side per match as a plain join does, which
    counts people several times; without it both sides are added up first.
    """
    left = joins.per_key(views.filter(F.col("project") == project), F.lower("page"),
                         {"requests": F.col("requests").cast("long")}, "left")
    right = joins.per_key(zips, clean.normal_key("city"), {"pop": F.col("pop").cast("long")}, "right",
                          also=["city", "state"])
    sums = (joins.fanout_sums(left, right, ["requests"], ["pop"]) if per_match
            else joins.aggregated_sums(left, right))
    return sums.select("city", "state", "pop", "requests").orderBy(F.desc("requests"), "city", "state")


# Registered runs --------------------------------------------------------------

def _match_records(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    n = F.col("event_id")
    coded = {c: n % (len(book) + 2) for c, book in fixed.MATCH_EVENT_BOOKS.items()}
    events = read_table(spark, d, "events", "event_id", "user_id", "value").select(
        F.col("user_id").cast("string").alias("id_odsp"), n.cast("string").alias("id_event"),
        F.col("value").alias("time"), (n % 4 == 0).cast("int").alias("is_goal"),
        *[c.cast("int").alias(name) for name, c in coded.items()],
        F.lit(None).cast("string").alias("text"), F.lit(0).alias("fast_break"))
    customer = F.col("c_custkey")
    country = (F.when(customer % 3 == 0, "spain").when(customer % 3 == 1, "italy")
               .otherwise("portugal"))
    games = read_table(spark, d, "customer", "c_custkey").select(
        customer.cast("string").alias("id_odsp"), country.alias("country"))
    return events, games


def _sql_book(book: dict, number: str) -> str:
    return (f"case {number} " + " ".join(f"when {k} then '{v}'" for k, v in book.items())
            + " else 'Unknown' end")


@query("job_match_goals", f"""
with joined as (select event_id, value, user_id % 3 as c
                from events join customer on user_id = c_custkey),
cuts as (select quantile_disc(value, [{', '.join(f'{i / 10}::double' for i in range(1, 10))}]) as cut
         from joined),
counted as (
  select {_sql_book(fixed.SHOT_PLACES, f'event_id % {len(fixed.SHOT_PLACES) + 2}')} as shot_place_str,
         {_sql_book(fixed.LOCATIONS, f'event_id % {len(fixed.LOCATIONS) + 2}')} as location_str,
         count(*) as tot_goals,
         cast(sum(len(list_filter(cut, lambda x: x <= value))) as double) as bins
  from joined, cuts where event_id % 4 = 0 and c = 0 group by 1, 2)
select shot_place_str, location_str, tot_goals, bins, cast(place as integer) as place from (
  select *, rank() over (partition by shot_place_str order by tot_goals desc) as place from counted)
where place <= 3 and location_str <> 'Unknown' and shot_place_str <> 'Unknown'
""")
def match_goals(spark: SparkSession, d: str) -> DataFrame:
    """The best shot locations per place, with the time bins of those goals added up."""
    events = match_events(*_match_records(spark, d))
    best = best_locations_by_place(events, "ESP")
    bins = goals(events).filter("country_code = 'ESP'").groupBy(
        "shot_place_str", "location_str").agg(F.sum("time_bin").alias("bins"))
    return best.join(bins, ["shot_place_str", "location_str"])


def storm_details(spark: SparkSession, d: str) -> DataFrame:
    """Orders spelled as raw storm reports."""
    n = F.col("o_orderkey")
    amount = F.concat((n % 90).cast("string"), F.lit(".5"))
    money = (F.when(n % 5 == 0, F.concat(amount, F.lit("K"))).when(n % 5 == 1, F.concat(amount, F.lit("M")))
             .when(n % 5 == 2, F.concat(amount, F.lit("B"))).when(n % 5 == 3, "0"))
    state = (F.when(n % 4 == 0, " TEXAS").when(n % 4 == 1, "GUAM").when(n % 4 == 2, "HAWAII WATERS ")
             .otherwise("NOWHERE"))
    kind = (F.when(n % 7 == 0, "Marine Thunderstorm Wind").when(n % 7 == 1, "Thunderstorm Wind (G50)")
            .when(n % 7 == 2, "tornado F1").when(n % 7 == 3, "Hail").otherwise("Flood"))
    return read_table(spark, d, "orders", "o_orderkey", "o_orderdate").select(
        n.alias("EVENT_ID"), F.year("o_orderdate").alias("YEAR"), state.alias("STATE"),
        kind.alias("EVENT_TYPE"), (n % 3).alias("DEATHS_DIRECT"),
        F.when(n % 11 != 0, n % 2).alias("DEATHS_INDIRECT"), (n % 5).alias("INJURIES_DIRECT"),
        F.lit(0).alias("INJURIES_INDIRECT"), money.alias("DAMAGE_PROPERTY"),
        F.lit(None).cast("string").alias("DAMAGE_CROPS"))


STORMS = """
with storms as (
  select cast(year(o_orderdate) as integer) as "YEAR",
         case o_orderkey % 4 when 0 then 'TX' when 1 then 'GU' when 2 then 'HI' end as "STATE_CODE",
         case when o_orderkey % 7 < 2 then 'THUNDERSTORM WIND' when o_orderkey % 7 = 2 then 'TORNADO'
              when o_orderkey % 7 = 3 then 'HAIL' else 'FLOOD' end as "EVENT_TYPE",
         case o_orderkey % 5 when 0 then o_orderkey % 90 + 0.5::double
              when 1 then (o_orderkey % 90 + 0.5::double) * 1000
              when 2 then (o_orderkey % 90 + 0.5::double) * 1000000 when 4 then 0.0 end as damage,
         o_orderkey % 5 as injuries,
         case when o_orderkey % 11 <> 0 then o_orderkey % 3 + o_orderkey % 2 end as deaths
  from orders where o_orderkey % 4 <> 3)
"""


@query("job_storm_damage", STORMS + """
select "YEAR", "EVENT_TYPE", total as "AGG_TOT_DMG_THDS", cast(place as integer) as place from (
  select "YEAR", "EVENT_TYPE", sum(damage) as total,
         rank() over (partition by "YEAR" order by sum(damage) desc nulls last) as place
  from storms where "STATE_CODE" = 'TX' and "YEAR" > 1995 group by 1, 2
  having sum(damage) is not null and sum(damage) <> 0)
where place <= 2
""")
def storm_damage(spark: SparkSession, d: str) -> DataFrame:
    return worst_event_types_by_year(storm_events(storm_details(spark, d)), "TX", 1995, 2)


@query("job_storm_harm", STORMS + """
select "EVENT_TYPE", cast(sum(deaths) as bigint) as "AGG_TOT_DEATHS",
       cast(sum(injuries) as bigint) as "AGG_TOT_INJURIES" from storms group by 1
""")
def storm_harm(spark: SparkSession, d: str) -> DataFrame:
    return harm_by_event_type(storm_events(storm_details(spark, d)))


@query("job_storm_states", STORMS + """
select "STATE_CODE", sum(damage) as "AGG_TOT_DMG_THDS" from storms where "STATE_CODE" <> 'GU' group by 1
""")
def storm_states(spark: SparkSession, d: str) -> DataFrame:
    return damage_by_state(storm_events(storm_details(spark, d)))


@query("job_city_requests", """
with views as (select lower(event_type) || '_' || cast(user_id % 20 as varchar) as page,
                      cast(json_extract_string(props, '$.k') as bigint) as requests
               from events where event_id % 3 = 0),
zips as (select ['click', 'VIEW', 'Sign'][c_custkey % 3 + 1] || ' ' || cast(c_nationkey as varchar) as city,
                c_mktsegment as state, c_custkey as pop from customer)
select city, state, cast(sum(pop) as bigint) as pop, cast(sum(requests) as bigint) as requests
from views join zips on page = replace(lower(city), ' ', '_') group by 1, 2
""")
def city_requests(spark: SparkSession, d: str) -> DataFrame:
    """Requests and population per city as the plain join of the details gives them."""
    n = F.col("event_id")
    views = read_table(spark, d, "events", "event_id", "event_type", "user_id", "props").select(
        F.when(n % 3 == 0, "en").otherwise("de").alias("project"),
        F.concat(F.initcap("event_type"), F.lit("_"), (F.col("user_id") % 20).cast("string")).alias("page"),
        F.get_json_object("props", "$.k").cast("int").alias("requests"))
    names = F.array(F.lit("click"), F.lit("VIEW"), F.lit("Sign"))
    zips = read_table(spark, d, "customer", "c_custkey", "c_nationkey", "c_mktsegment").select(
        F.concat(F.get(names, (F.col("c_custkey") % 3).cast("int")), F.lit(" "),
                 F.col("c_nationkey").cast("string")).alias("city"),
        F.col("c_mktsegment").alias("state"), F.col("c_custkey").alias("pop"))
    sums = city_requests_and_population(views, zips, "en", per_match=True)
    return sums.withColumns({c: F.col(c).cast("long") for c in ("pop", "requests")})


def old_storm_records(spark: SparkSession, d: str) -> DataFrame:
    """Orders spelled as records of the older storm file."""
    n = F.col("o_orderkey")
    kind = (F.when(n % 3 == 0, "HAIL").when(n % 3 == 1, "TORNADO").otherwise("SUMMARY OF MAY"))

    def letter(shift: int):
        m = (n + shift) % 5
        return (F.when(m == 0, "K").when(m == 1, "M").when(m == 2, "B").when(m == 3, "k").otherwise("K"))

    return read_table(spark, d, "orders", "o_orderkey", "o_orderdate").select(
        kind.alias("EVTYPE"), F.date_format("o_orderdate", "M/d/yyyy' 0:00:00'").alias("BGN_DATE"),
        (n % 4).cast("double").alias("FATALITIES"), (n % 6).cast("double").alias("INJURIES"),
        (n % 80 + 0.5).alias("PROPDMG"), letter(0).alias("PROPDMGEXP"),
        (n % 40 + 0.25).alias("CROPDMG"), letter(1).alias("CROPDMGEXP"))


@query("job_storm_impact", """
with impact as (
  select case o_orderkey % 3 when 0 then 'HAIL' else 'TORNADO' end as "EVTYPE",
         cast(year(o_orderdate) as integer) as "YEAR", o_orderkey % 4 + o_orderkey % 6 as people,
         case o_orderkey % 5 when 2 then (o_orderkey % 80 + 0.5) * 1000 when 1 then o_orderkey % 80 + 0.5
              else (o_orderkey % 80 + 0.5) / 1000 end
         + case (o_orderkey + 1) % 5 when 2 then o_orderkey % 40 + 0.25 when 1 then o_orderkey % 40 + 0.25
              else (o_orderkey % 40 + 0.25) / 1000 end as money
  from orders where o_orderkey % 3 < 2 and o_orderkey % 5 <> 3 and (o_orderkey + 1) % 5 <> 3)
select "EVTYPE", "YEAR", cast(sum(people) as bigint) as "TOTPOPIMPACT",
       round(cast(sum(money) as double), 6) as "TOTECOIMPACT"
from impact group by 1, 2
""")
def storm_impact_totals(spark: SparkSession, d: str) -> DataFrame:
    totals = impact_totals(storm_impact(old_storm_records(spark, d)), "EVTYPE", "YEAR")
    return totals.withColumn("TOTECOIMPACT", F.round("TOTECOIMPACT", 6))


def indicator_records(spark: SparkSession, d: str) -> DataFrame:
    """Events spelled as health indicator records."""
    n = F.col("event_id")
    kind = F.when(n % 3 == 0, "Yes/No").when(n % 3 == 1, "Number").otherwise("Crude Rate")
    text = (F.when(n % 3 == 0, F.when(n % 2 == 0, "Yes").otherwise("No")).when(n % 13 == 0, "  ")
            .when(n % 17 == 0, "-").otherwise((n % 100).cast("string")))
    group = F.element_at(F.array(*[F.lit(g) for g in ("Male", "Hispanic", "White", "Black", "Asian")]),
                         (n % 5 + 1).cast("int"))
    state = F.element_at(F.array(*[F.lit(s) for s in ("FL", "CA", "NY", "TX")]),
                         (F.col("user_id") % 4 + 1).cast("int"))
    return read_table(spark, d, "events", "event_id", "user_id", "event_type").select(
        F.lit(2010).alias("YearStart"), F.when(n % 10 == 0, 2011).otherwise(2010).alias("YearEnd"),
        state.alias("LocationAbbr"), state.alias("LocationDesc"), F.col("event_type").alias("Topic"),
        F.lit("How many").alias("Question"), kind.alias("DataValueType"),
        F.lit("%").alias("DataValueUnit"), group.alias("Stratification1"), text.alias("DataValue"))


@query("job_health_cases", """
with cases as (
  select ['FL', 'CA', 'NY', 'TX'][user_id % 4 + 1] as state,
         ['Male', 'Hispanic', 'White', 'Black', 'Asian'][event_id % 5 + 1] as grp,
         case when event_id % 17 <> 0 then cast(event_id % 100 as double) end as number
  from events
  where event_type = 'view' and event_id % 10 <> 0 and event_id % 3 = 1 and event_id % 13 <> 0),
totals as (select state, grp, sum(number) as total from cases
           where grp <> 'Male' and state in ('FL', 'CA', 'NY') group by 1, 2)
select state as "State_Code", grp as "Stratification", total as "Tot_Cases", cast(place as integer) as place
from (select *, rank() over (partition by state order by total desc) as place from totals
      where total is not null and total <> 0) where place <= 3
""")
def health_cases(spark: SparkSession, d: str) -> DataFrame:
    cases = counted_cases(health_indicators(indicator_records(spark, d)), "view")
    return most_affected(cases, ["FL", "CA", "NY"])


@query("job_daily_prices", """
select cast(day(o_orderdate) as integer) as "DayOfMonth", cast(month(o_orderdate) as integer) as "Month",
       avg(case when o_orderkey % 2 = 0 then floor(o_totalprice) end) as mean_open,
       avg(floor(o_totalprice) + 1) as mean_high
from orders where o_orderkey % 5 <> 0 and year(o_orderdate) = 1996 group by 1, 2
""")
def daily_prices(spark: SparkSession, d: str) -> DataFrame:
    n, price = F.col("o_orderkey"), F.floor("o_totalprice").cast("double")
    bars = read_table(spark, d, "orders", "o_orderkey", "o_orderdate", "o_totalprice").select(
        F.unix_seconds(F.col("o_orderdate").cast("timestamp")).alias("Timestamp"),
        F.when((n % 5 != 0) & (n % 2 == 0), price).alias("Open"),
        F.when(n % 5 != 0, price + 1).alias("High"), F.when(n % 5 != 0, price - 1).alias("Low"),
        F.lit(None).cast("double").alias("Close"), F.lit(1.0).alias("Volume_(BTC)"),
        F.lit(1.0).alias("Volume_(Currency)"))
    return daily_price_means(minute_bars(bars), 1996)
