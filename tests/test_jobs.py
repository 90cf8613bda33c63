from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallyloom import fixed_values as fixed
from tallyloom.operators import audit, governance, ranking
from tallyloom.plans import jobs


def test_rank_keeps_ties_and_drops_zero(spark):
    df = spark.createDataFrame([("g", "a", 5), ("g", "b", 5), ("g", "c", 4), ("g", "d", 3), ("h", "a", 0), ("h", "b", None)],
                               "g string, x string, n int")
    got = ranking.top_per_group(df, ["g"], "n", 2).collect()
    assert sorted((r["x"], r["place"]) for r in got) == [("a", 1), ("b", 1)]


def test_shares(spark):
    df = spark.createDataFrame([("g", 1), ("g", 3), (None, 2), ("z", 0)], "g string, n int")
    got = sorted((str(r["g"]), r["n"], r["share"]) for r in ranking.share_of_total(df, ["g"], "n").collect())
    assert got == [("None", 2, 1.0), ("g", 1, 0.25), ("g", 3, 0.75), ("z", 0, None)]
    assert ranking.share_of_total(df, [], "n").agg({"share": "sum"}).first()[0] == pytest.approx(1.0)


def test_unknown_uses_up_a_place(spark):
    df = spark.createDataFrame([("g", "Unknown", 9), ("g", "a", 5), ("g", "b", 4)], "g string, x string, n int")
    got = ranking.top_known_per_group(df, ["g"], "n", 2, ["x"]).collect()
    assert [r["x"] for r in got] == ["a"]


def test_match_events(spark):
    names = fixed.MATCH_EVENTS.names
    base = dict.fromkeys(names) | {"id_odsp": "g1", "is_goal": 1, "time": 10}
    rows = [base | {"id_event": "1", "shot_place": 3, "location": 3},
            base | {"id_event": "2", "shot_place": None, "location": 99, "time": 80},
            base | {"id_event": "3", "id_odsp": "nowhere"}]
    events = spark.createDataFrame([tuple(r[n] for n in names) for r in rows], fixed.MATCH_EVENTS)
    games = spark.createDataFrame([("g1", "spain"), ("g2", "portugal")], "id_odsp string, country string")
    clean = jobs.match_events(events, games)
    assert clean.count() == 2
    places = {r["shot_place"]: r["tot_goals"] for r in jobs.goals_by_shot_place(clean).collect()}
    assert places == {"Bottom left corner": 1, "Unknown": 1}
    assert [tuple(r) for r in jobs.goals_by_country(clean).collect()] == [("ESP", 2)]
    best = jobs.best_locations_by_place(clean, "ESP").collect()
    assert [(r["shot_place_str"], r["location_str"]) for r in best] == [("Bottom left corner", "Centre of the box")]
    assert jobs.goals_by_time_bin(clean).count() == 2


def test_storm_events(spark):
    schema = ("EVENT_ID int, YEAR int, STATE string, EVENT_TYPE string, INJURIES_DIRECT int, INJURIES_INDIRECT int, "
              "DEATHS_DIRECT int, DEATHS_INDIRECT int, DAMAGE_PROPERTY string, DAMAGE_CROPS string")
    details = spark.createDataFrame([
        (1, 2010, " TEXAS ", "Thunderstorm Wind", 1, 2, 0, 0, "1M", None),
        (2, 2010, "TEXAS", "hail", 1, None, 1, 1, "5", "1K"),
        (3, 2010, "ATLANTIS", "hail", 0, 0, 0, 0, "1K", "1K"),
        (4, 2010, None, "hail", 0, 0, 0, 0, "1K", "1K")], schema)
    storms = jobs.storm_events(details)
    got = {r["EVENT_ID"]: (r["STATE_CODE"], r["EVENT_TYPE"], r["TOT_INJURIES"], r["TOT_DAMAGE_THDS"]) for r in storms.collect()}
    assert got == {1: ("TX", "THUNDERSTORM WIND", 3, 1000.0), 2: ("TX", "HAIL", None, None)}
    worst = jobs.worst_event_types_by_year(storms, "TX", 2007).collect()
    assert [(r["EVENT_TYPE"], r["place"]) for r in worst] == [("THUNDERSTORM WIND", 1)]
    ages = spark.createDataFrame([(1, 30, "F"), (1, None, "M"), (2, 40, None)], "EVENT_ID int, FATALITY_AGE int, FATALITY_SEX string")
    assert jobs.fatal_events(storms, ages).count() == 1


def test_old_storm_layout(spark):
    schema = "EVTYPE string, BGN_DATE string, FATALITIES double, INJURIES double, PROPDMG double, PROPDMGEXP string, CROPDMG double, CROPDMGEXP string"
    records = spark.createDataFrame([
        ("HAIL", "4/18/1950 0:00:00", 1.0, 2.0, 5.0, "B", 3.0, "B"),
        ("HAIL", "4/18/1950 0:00:00", 1.0, 2.0, 5.0, "?", 3.0, "K"),
        ("SUMMARY", "4/18/1950 0:00:00", 1.0, 2.0, 5.0, "K", 3.0, "K")], schema)
    impact = jobs.storm_impact(records)
    assert [tuple(r) for r in impact.collect()] == [("HAIL", 1950, 3, 5003.0)]
    assert jobs.most_harmful(impact, "TOTECOIMPACT").count() == 1


def test_health_indicators(spark):
    schema = ("YearStart int, YearEnd int, LocationAbbr string, LocationDesc string, Topic string, Question string, "
              "DataValueType string, DataValueUnit string, Stratification1 string, DataValue string")
    rows = [(2010, 2010, "FL", "Florida", "Diabetes", "q", "Number", "cases", "Asian", "12"),
            (2010, 2011, "FL", "Florida", "Diabetes", "q", "Number", "cases", "Asian", "12"),
            (2010, 2010, "FL", "Florida", "Diabetes", "q", "Yes/No", "", "Male", "Yes"),
            (2010, 2010, "FL", "Florida", "Diabetes", "q", "Number", "cases", "Black", " "),
            (2010, 2010, "FL", "Florida", "Diabetes", "q", "Number", "cases", "Black", "-")]
    indicators = jobs.health_indicators(spark.createDataFrame(rows, schema))
    got = [(r["DataValueUnit"], r["DataValueNum"]) for r in indicators.orderBy("DataValue").collect()]
    assert got == [("Number", None), ("Number", 12.0), ("Binary", 1.0)]
    cases = jobs.counted_cases(indicators, "Diabetes")
    assert {r["Stratification"]: r["Sample_Count"] for r in jobs.cases_by(cases, "Stratification").collect()} == {"Asian": 1, "Black": 1}
    assert [r["Stratification"] for r in jobs.most_affected(cases, ["FL"]).collect()] == ["Asian"]


def test_minute_bars(spark):
    bars = spark.createDataFrame([(0, 1.0, None, None, None, 1.0), (86400, None, None, None, None, 1.0)],
                                 "Timestamp long, Open double, High double, Low double, Close double, `Volume_(BTC)` double")
    row = jobs.minute_bars(bars).collect()
    assert len(row) == 1 and (row[0]["Year"], row[0]["Month"], row[0]["DayOfMonth"], row[0]["Volume_BTC"]) == (1970, 1, 1, 1.0)
    assert jobs.daily_price_means(jobs.minute_bars(bars), 1970).first()["mean_open"] == 1.0


def test_page_views(spark):
    views = spark.createDataFrame([("en", "Apache_Spark", 3), ("en", "apache_x", 4), ("fr", "Apache_Spark", 9), ("en", "New_York", 5)],
                                  "project string, page string, requests int")
    assert jobs.page_requests(views, "en", "Apache_").first()["requests"] == 7
    zips = spark.createDataFrame([("NEW YORK", "NY", 100), ("NEW YORK", "NY", 50), ("NEW YORK", "TX", 1), ("BOSTON", "MA", 7)],
                                 "city string, state string, pop long")
    views = views.unionByName(spark.createDataFrame([("en", "new_york", 2)], views.schema))
    repeated = jobs.city_requests_and_population(views, zips, "en", per_match=True).collect()
    assert [tuple(r) for r in repeated] == [("NEW YORK", "NY", 300, 14), ("NEW YORK", "TX", 2, 7)]
    single = jobs.city_requests_and_population(views, zips, "en", per_match=False).collect()
    assert [tuple(r) for r in single] == [("NEW YORK", "NY", 150, 7), ("NEW YORK", "TX", 1, 7)]


@pytest.fixture
def grants(spark):
    log = spark.createDataFrame([
        (1, "GRANT", "ann", "SELECT", "TABLE", "t1"), (2, "REVOKE", "ann", "SELECT", "TABLE", "t1"),
        (3, "GRANT", "staff", "SELECT", "DATABASE", "db"), (4, "GRANT", "bob", "ALL PRIVILEGES", "TABLE", "t2"),
        (5, "REVOKE", "bob", "MODIFY", "TABLE", "t2")],
        "seq int, action string, principal string, privilege string, object_type string, object string")
    members = spark.createDataFrame([("staff", "eve")], "group string, user string")
    tables = spark.createDataFrame([("db", "t1"), ("db", "t2"), ("other", "t3")], "database string, table string")
    owners = spark.createDataFrame([("olga", "t3")], "owner string, table string")
    return governance.effective_grants(log, members, tables, owners)


def test_effective_grants(grants):
    held = {(r["user"], r["privilege"], r["table"]) for r in grants.collect()}
    assert not any(u == "ann" for u, _, _ in held)
    assert ("eve", "SELECT", "t1") in held and ("eve", "SELECT", "t2") in held and ("eve", "SELECT", "t3") not in held
    assert ("bob", "SELECT", "t2") in held and ("bob", "MODIFY", "t2") not in held
    assert ("olga", "MODIFY", "t3") in held


def test_groups_in_groups_views_and_catalogs(spark):
    log = spark.createDataFrame([
        (1, "GRANT", "all", "SELECT", "CATALOG", "main"), (2, "GRANT", "a", "MODIFY", "VIEW", "v1"), (3, "GRANT", "b", "CREATE", "DATABASE", "db2"),
        (4, "GRANT", "b", "SELECT", "TABLE", "v1"), (5, "REVOKE", "b", "SELECT", "TABLE", "v1")],
        "seq int, action string, principal string, privilege string, object_type string, object string")
    members = spark.createDataFrame([("all", "a"), ("a", "b"), ("b", "a"), ("b", "eve"), ("b", "eve"), (None, "x"), ("a", None)],
                                    "group string, user string")
    tables = spark.createDataFrame([("main", "db1", "t1"), ("main", "db1", "v1"), ("other", "db2", "t2")], "catalog string, database string, table string")
    owners = spark.createDataFrame([], "owner string, table string")
    held = {tuple(r) for r in governance.effective_grants(log, members, tables, owners).select("user", "privilege", "table").collect()}
    everyone = ("all", "a", "b", "eve")
    expected = {(u, "SELECT", t) for u in everyone for t in ("t1", "v1")}
    expected |= {(u, "MODIFY", "v1") for u in ("a", "b", "eve")} | {(u, "CREATE", "t2") for u in ("a", "b", "eve")}
    assert held == expected
    pairs = {tuple(r) for r in governance.closed_members(members).select("group", "user").collect()}
    assert pairs == {(g, u) for g in ("all", "a", "b") for u in ("a", "b", "eve")}


def test_closure_of_a_long_chain(spark):
    chain = spark.createDataFrame([(f"g{i}", f"g{i + 1}") for i in range(5)], "group string, user string")
    assert governance.closed_members(chain).count() == 15
    with pytest.raises(RuntimeError):
        governance.closed_members(chain, max_depth=2)
    assert governance.closed_members(chain.limit(0)).count() == 0


def test_entitled_rows(spark, grants):
    rows = spark.createDataFrame([("t1", 1), ("t2", 2), ("t3", 3)], "name string, x int")
    assert sorted(r["x"] for r in governance.entitled_rows(rows, grants, "eve", "name").collect()) == [1, 2]
    assert governance.entitled_rows(rows, grants, "ann", "name").count() == 0


def test_audit_of_bad_json(spark):
    log = spark.range(2).select(
        F.lit("clusters").alias("serviceName"), F.lit("create").alias("actionName"),
        F.struct(F.lit("a").alias("email")).alias("userIdentity"),
        F.struct(F.when(F.col("id") == 0, '{"ebs_volume_count":2,"ebs_volume_type":"SSD","ebs_volume_size":5}')
                 .otherwise("{bad").alias("aws_attributes")).alias("requestParams"))
    assert [tuple(r) for r in audit.disk_totals(log).collect()] == [("a", "SSD", 2, 5)]


def test_dates_are_real(spark):
    df = spark.createDataFrame([(datetime(2024, 2, 29),)], "d timestamp")
    from tallyloom.functions.cleaning import date_parts

    assert tuple(df.select(*date_parts("d").values()).first()) == (2024, 2, 29)


def test_layouts_are_used(spark, folder):
    """No rows move for an aggregate or a join on the bucket key; clustered files hold disjoint key ranges."""
    from pyspark.sql import functions as F

    from tallyloom.plans.catalog import QUERIES

    for name in ("sink_bucketed", "sink_bucketed_join"):
        plan = QUERIES[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
    clustered = QUERIES["ctas_cluster_by"](spark, folder)
    ends = clustered.groupBy(F.input_file_name().alias("f")).agg(
        F.min(F.struct("event_type", "event_id")).alias("lo"), F.max(F.struct("event_type", "event_id")).alias("hi")).orderBy("lo").collect()
    assert all(tuple(a["hi"]) <= tuple(b["lo"]) for a, b in zip(ends, ends[1:]))
    assert "Expand" not in QUERIES["table_profile"](spark, folder)._jdf.queryExecution().executedPlan().toString()


def test_users_of_one_group_are_spread_and_nothing_comes_twice(spark, monkeypatch):
    monkeypatch.setattr(governance, "TASK_RESULTS", 500, raising=False)
    grants = [("g", "SELECT", "TABLE", f"t{i}") for i in range(20)] + [("h", "SELECT", "TABLE", f"t{i}") for i in range(10, 30)]
    grants += [("u1", "SELECT", "TABLE", "t3"), ("u1", "MODIFY", "TABLE", "t3"), (None, "SELECT", "TABLE", "t1"), ("g", None, "TABLE", "t1"),
               ("u2", None, "TABLE", "t1"), ("u3", None, "TABLE", "t2"), ("h", "SELECT", "DATABASE", "d"), ("g", "CREATE", "TABLE", None),
               ("u4", "CREATE", "TABLE", None), ("nobody", "SELECT", "DATABASE", "d")]
    rows = [(i, "GRANT", *g) for i, g in enumerate(grants)]
    rows += [(100, "REVOKE", "g", "SELECT", "TABLE", "t0"), (None, "GRANT", "u5", "SELECT", "TABLE", "t0"), (101, None, "u1", "MODIFY", "TABLE", "t3")]
    log = spark.createDataFrame(rows + rows[:30], "seq int, action string, principal string, privilege string, object_type string, object string")
    pairs = [(g, f"u{i}") for g, few in (("g", range(0, 200)), ("h", range(100, 300))) for i in few] + [("g", "u1"), ("none", "u7")]
    members = spark.createDataFrame(pairs, "group string, user string")
    tables = spark.createDataFrame([("d", "t1"), ("d", "t40"), ("d", "t40"), (None, "t41"), ("d", None)], "database string, table string")
    owners = spark.createDataFrame([("u0", "t5"), ("u0", "t99"), ("u0", "t99"), (None, "t98"), ("g", "t50")], "owner string, table string")
    of = {}
    for p, privilege, kind, name in grants:
        of.setdefault(p, set()).update((privilege, t) for t in ([name] if kind == "TABLE" else ["t1", "t40", None]))
    of["g"].remove(("SELECT", "t0"))
    of["u1"].remove(("MODIFY", "t3"))
    expected = {(u, *held) for u, some in of.items() for held in some}
    expected |= {(u, *held) for g, u in pairs for held in of.get(g, ())}
    expected |= {(u, p, t) for u, t in (("u0", "t5"), ("u0", "t99"), (None, "t98"), ("g", "t50")) for p in governance.PRIVILEGES}
    result = governance.effective_grants(log, members, tables, owners).select("user", "privilege", "table")
    found = [tuple(r) for r in result.collect()]
    assert len(found) == len(set(found)) and set(found) == expected
    # rows that come from the group are spread by their number, however small the table of members is
    sizes = result.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) >= len(expected) // 500
