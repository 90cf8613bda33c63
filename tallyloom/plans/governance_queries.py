"""Log analytics and privileges on a service log derived from the events table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators import audit, governance
from tallyloom.plans.registry import query
from tallyloom.sources.files import read_table
from tallyloom.workspace import scratch_name

# How an event type reads as a service action.
ACTIONS = {
    "click": ("clusters", "create"), "view": ("notebook", "attachNotebook"),
    "purchase": ("jobs", "runFailed"), "signup": ("accounts", "login"),
    "error": ("sqlPermissions", "grantPermission"),
}


def service_log(spark: SparkSession, d: str) -> DataFrame:
    events = read_table(spark, d, "events", "event_id", "ts", "user_id", "event_type", "props")
    k = F.get_json_object("props", "$.k").cast("int")
    service = F.create_map(*[F.lit(x) for t, (s, _) in ACTIONS.items() for x in (t, s)])
    action = F.create_map(*[F.lit(x) for t, (_, a) in ACTIONS.items() for x in (t, a)])
    user = F.col("user_id")
    disks = F.when(F.col("event_id") % 11 == 0, "{bad").otherwise(F.to_json(F.struct(
        F.lit("SPOT").alias("availability"), (k % 5).alias("ebs_volume_count"),
        F.when(k % 3 == 0, "SSD").when(k % 3 == 1, "HDD").alias("ebs_volume_type"),
        (k * 10).alias("ebs_volume_size"))))
    return events.select(
        "event_id", service[F.col("event_type")].alias("serviceName"),
        action[F.col("event_type")].alias("actionName"),
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        F.struct(F.when(user % 10 == 0, "Unknown").otherwise(
            F.concat(F.lit("user"), user.cast("string"))).alias("email")).alias("userIdentity"),
        F.struct(
            F.when(user % 20 == 0, "JOB_LAUNCHER").otherwise("PERSON").alias("cluster_creator"),
            disks.alias("aws_attributes"), k.alias("jobId"), (user % 4).alias("idInJob"),
            F.concat(F.lit("job-"), k.cast("string"), F.lit("-run-"), (user % 4).cast("string"))
            .alias("cluster_name"),
            F.concat(F.lit("node"), (user % 3).cast("string")).alias("node_type_id"),
            F.concat(F.lit("v"), (k % 2).cast("string")).alias("spark_version"),
            F.concat(F.lit("user"), user.cast("string")).alias("user"),
            F.when(k % 2 == 0, "SELECT").otherwise("MODIFY").alias("permission"),
            (k % 50).alias("clusterId"), user.alias("notebookId"),
            F.concat(F.lit("cluster "), (k % 20).cast("string")).alias("clusterName"),
        ).alias("requestParams"),
        F.struct(F.when(k < 70, 200).otherwise(403).alias("statusCode")).alias("response"))


LOG = """
with log as (
  select event_id, strftime(ts, '%Y-%m-%d') as date, user_id,
         cast(json_extract_string(props, '$.k') as integer) as k,
         case event_type when 'click' then 'clusters' when 'view' then 'notebook'
              when 'purchase' then 'jobs' when 'signup' then 'accounts' else 'sqlPermissions' end as service,
         case event_type when 'click' then 'create' when 'view' then 'attachNotebook'
              when 'purchase' then 'runFailed' when 'signup' then 'login' else 'grantPermission' end as action,
         case when user_id % 10 = 0 then 'Unknown' else 'user' || cast(user_id as varchar) end as email
  from events)
"""


@query("nested_field_group", LOG + """
select email, case when user_id % 20 = 0 then 'JOB_LAUNCHER' else 'PERSON' end as creator,
       count(*) as cnt
from log where service = 'clusters' and not (email = 'Unknown' and user_id % 20 = 0)
group by 1, 2
""")
def nested_group(spark: SparkSession, d: str) -> DataFrame:
    rows = audit.creations_by_people(service_log(spark, d))
    return audit.count_by(rows, email="userIdentity.email", creator="requestParams.cluster_creator")


@query("audit_actions", LOG + """
select service as "serviceName", action as "actionName", count(*) as cnt from log group by 1, 2
""")
def actions(spark: SparkSession, d: str) -> DataFrame:
    return audit.actions_per_service(service_log(spark, d))


@query("audit_creates_by_user", LOG + """
select email, count(*) as cnt from log where service = 'clusters' group by 1
""")
def creates(spark: SparkSession, d: str) -> DataFrame:
    return audit.cluster_creations_by_user(service_log(spark, d))


@query("audit_failed_jobs", LOG + """
select k as "jobId", count(*) as cnt from log where service = 'jobs' group by 1
""")
def failed_jobs(spark: SparkSession, d: str) -> DataFrame:
    return audit.failed_runs_by_job(service_log(spark, d))


@query("audit_failed_logins", LOG + """
select distinct email, date, 'user' || cast(user_id as varchar) as "user",
       cast(403 as integer) as "statusCode"
from log where service = 'accounts' and k >= 70
""")
def logins(spark: SparkSession, d: str) -> DataFrame:
    return audit.failed_logins(service_log(spark, d))


@query("audit_permission_grants", LOG + """
select email, case when k % 2 = 0 then 'SELECT' else 'MODIFY' end as permission, date
from log where service = 'sqlPermissions'
""")
def grants_by_date(spark: SparkSession, d: str) -> DataFrame:
    return audit.permission_grants(service_log(spark, d))


@query("agg_json_fields", LOG + """
select email, case when k % 3 = 0 then 'SSD' else 'HDD' end as ebs_volume_type,
       cast(sum(k % 5) as bigint) as tot_ebs_vols, cast(sum(k * 10) as bigint) as tot_ebs_vol_size
from log where service = 'clusters' and event_id % 11 <> 0 and k % 3 < 2
group by 1, 2
""")
def disks(spark: SparkSession, d: str) -> DataFrame:
    return audit.disk_totals(service_log(spark, d))


@query("audit_failed_job_settings", LOG + """
select distinct f.k as "jobId", 'node' || cast(c.user_id % 3 as varchar) as node_type_id,
       'v' || cast(c.k % 2 as varchar) as spark_version
from (select distinct k, user_id % 4 as run from log where service = 'jobs') f
join (select distinct k, user_id from log where service = 'clusters' and user_id % 20 = 0) c
  on f.k = c.k and f.run = c.user_id % 4
""")
def job_settings(spark: SparkSession, d: str) -> DataFrame:
    return audit.failed_job_settings(service_log(spark, d))


@query("audit_notebooks_per_cluster", LOG + """
select 'cluster ' || cast(n.k % 20 as varchar) as "clusterName", cast(count(*) as bigint) as n
from (select distinct k % 50 as cluster, user_id from log where service = 'notebook') a
join (select k from log where service = 'clusters') n on a.cluster = n.k % 50
group by 1
""")
def notebooks(spark: SparkSession, d: str) -> DataFrame:
    log = service_log(spark, d).withColumn(
        "actionName", F.when(F.col("serviceName") == "clusters", "createResult")
        .otherwise(F.col("actionName")))
    return audit.notebooks_per_cluster_name(log).withColumn("n", F.col("n").cast("long"))


@query("secured_view", """
select c_custkey, c_mktsegment from customer where c_acctbal > 0 and c_nationkey = 2
""")
def guarded_view(spark: SparkSession, d: str) -> DataFrame:
    return governance.secured_view(
        read_table(spark, d, "customer"), scratch_name("guarded_customers"),
        ["c_custkey", "c_mktsegment"], "c_acctbal > 0 AND c_nationkey = 2")


def grant_tables(spark: SparkSession, d: str) -> tuple[DataFrame, ...]:
    """A grant log, group members, tables and owners made from events and nations."""
    events = read_table(spark, d, "events", "event_id", "event_type", "user_id", "props")
    k = F.get_json_object("props", "$.k").cast("int")
    log = events.select(
        F.col("event_id").alias("seq"),
        F.when(F.col("event_type") == "error", "REVOKE").otherwise("GRANT").alias("action"),
        F.when(F.col("user_id") % 5 == 0, F.concat(F.lit("group"), (F.col("user_id") % 3)
                                                   .cast("string")))
        .otherwise(F.concat(F.lit("user"), F.col("user_id").cast("string"))).alias("principal"),
        F.when(k % 7 == 0, "ALL PRIVILEGES").when(k % 2 == 0, "SELECT").otherwise("MODIFY")
        .alias("privilege"),
        F.when(k % 10 == 9, "DATABASE").otherwise("TABLE").alias("object_type"),
        F.when(k % 10 == 9, F.concat(F.lit("db"), (k % 5).cast("string")))
        .otherwise(F.concat(F.lit("NATION_"), (k % 25).cast("string"))).alias("object"))
    customers = read_table(spark, d, "customer", "c_custkey")
    members = customers.filter("c_custkey % 4 = 1").select(
        F.concat(F.lit("group"), (F.col("c_custkey") % 3).cast("string")).alias("group"),
        F.concat(F.lit("user"), F.col("c_custkey").cast("string")).alias("user"))
    nations = read_table(spark, d, "nation")
    tables = nations.select(F.concat(F.lit("db"), F.col("n_regionkey").cast("string"))
                            .alias("database"), F.col("n_name").alias("table"))
    owners = nations.select(F.concat(F.lit("user"), F.col("n_nationkey").cast("string"))
                            .alias("owner"), F.col("n_name").alias("table"))
    return log, members, tables, owners


GRANTS = """
with raw as (
  select event_id, event_type, user_id, cast(json_extract_string(props, '$.k') as integer) as k
  from events),
names(privilege) as (values ('SELECT'), ('CREATE'), ('MODIFY'), ('READ_METADATA'),
                            ('CREATE_NAMED_FUNCTION')),
single as (
  select raw.*, names.privilege from raw join names on
    case when k % 7 = 0 then true when k % 2 = 0 then names.privilege = 'SELECT'
         else names.privilege = 'MODIFY' end),
log as (
  select event_id, event_type <> 'error' as granted, privilege,
         case when user_id % 5 = 0 then 'group' || cast(user_id % 3 as varchar)
              else 'user' || cast(user_id as varchar) end as principal,
         k % 10 = 9 as is_database,
         case when k % 10 = 9 then 'db' || cast(k % 5 as varchar)
              else 'NATION_' || cast(k % 25 as varchar) end as object
  from single),
latest as (
  select *, row_number() over (partition by principal, privilege, is_database, object
                               order by event_id desc) as age from log),
standing as (select principal, privilege, is_database, object from latest where age = 1 and granted),
members as (select 'group' || cast(c_custkey % 3 as varchar) as grp,
                   'user' || cast(c_custkey as varchar) as usr from customer where c_custkey % 4 = 1),
held as (
  select principal as usr, privilege, is_database, object from standing
  union select usr, privilege, is_database, object from standing join members on principal = grp),
effective as (
  select usr as "user", privilege, object as "table" from held where not is_database
  union select usr, privilege, n_name from held join nation on is_database
        and object = 'db' || cast(n_regionkey as varchar)
  union select 'user' || cast(n_nationkey as varchar), privilege, n_name
        from nation cross join names)
"""


@query("effective_grants", GRANTS + 'select "user", privilege, "table" from effective')
def resolved_grants(spark: SparkSession, d: str) -> DataFrame:
    return governance.effective_grants(*grant_tables(spark, d))


def nested_grant_tables(spark: SparkSession, d: str) -> tuple[DataFrame, ...]:
    """As ``grant_tables``, with grants on views and a catalog, and groups in groups of which two hold each other."""
    log, members, tables, owners = grant_tables(spark, d)
    number = F.regexp_extract("object", "[0-9]+$", 0).cast("int")
    on_table = F.col("object_type") == "TABLE"
    log = log.withColumns({
        "object_type": F.when(on_table & (number % 3 == 1), "VIEW").when(on_table & (number == 15), "CATALOG")
        .otherwise(F.col("object_type")),
        "object": F.when(on_table & (number % 3 == 1), F.concat(F.lit("VIEW_"), number.cast("string")))
        .when(on_table & (number == 15), F.lit("main")).otherwise(F.col("object")),
        "principal": F.when(F.col("principal").isin("group1", "group2"), F.concat(F.lit("team"), (F.col("seq") % 4).cast("string")))
        .otherwise(F.col("principal"))})
    nested = spark.createDataFrame(NESTED_GROUPS, "group string, user string")
    views = read_table(spark, d, "nation").select(
        F.concat(F.lit("db"), F.col("n_regionkey").cast("string")).alias("database"),
        F.concat(F.lit("VIEW_"), F.col("n_nationkey").cast("string")).alias("table"))
    placed = tables.unionByName(views).withColumn(
        "catalog", F.when(F.col("database").isin("db0", "db1"), "main").otherwise("other"))
    return log, members.unionByName(nested), placed, owners


NESTED_GROUPS = [("team0", "group1"), ("team1", "team0"), ("team1", "team2"), ("team2", "team1"), ("team2", "group0"), ("team3", "team2")]


NESTED = """
with recursive raw as (
  select event_id, event_type, user_id, cast(json_extract_string(props, '$.k') as integer) as k
  from events),
names(privilege) as (values ('SELECT'), ('CREATE'), ('MODIFY'), ('READ_METADATA'),
                            ('CREATE_NAMED_FUNCTION')),
single as (
  select raw.*, names.privilege from raw join names on
    case when k % 7 = 0 then true when k % 2 = 0 then names.privilege = 'SELECT'
         else names.privilege = 'MODIFY' end),
log as (
  select event_id, event_type <> 'error' as granted, privilege,
         case when user_id % 5 = 0 and user_id % 3 = 0 then 'group0'
              when user_id % 5 = 0 then 'team' || cast(event_id % 4 as varchar)
              else 'user' || cast(user_id as varchar) end as principal,
         case when k % 10 = 9 then 'DATABASE' when k % 25 % 3 = 1 then 'VIEW' when k % 25 = 15 then 'CATALOG' else 'TABLE' end as kind,
         case when k % 10 = 9 then 'db' || cast(k % 5 as varchar) when k % 25 % 3 = 1 then 'VIEW_' || cast(k % 25 as varchar)
              when k % 25 = 15 then 'main' else 'NATION_' || cast(k % 25 as varchar) end as object
  from single),
standing as (
  select principal, privilege, kind, object from log
  qualify row_number() over (partition by principal, privilege, kind, object order by event_id desc) = 1 and granted),
member as (
  select 'group' || cast(c_custkey % 3 as varchar) as grp, 'user' || cast(c_custkey as varchar) as usr from customer where c_custkey % 4 = 1
  union select * from (values """ + ", ".join(f"('{g}', '{u}')" for g, u in NESTED_GROUPS) + """)),
closed as (select grp, usr from member union select closed.grp, member.usr from closed join member on closed.usr = member.grp),
held as (
  select principal as usr, privilege, kind, object from standing
  union select usr, privilege, kind, object from standing join closed on principal = grp),
placed as (
  select n_name as name, n_regionkey as r from nation
  union all select 'VIEW_' || cast(n_nationkey as varchar), n_regionkey from nation)
select usr as "user", privilege, object as "table" from held where kind in ('TABLE', 'VIEW')
union select usr, privilege, name from held join placed on kind = 'DATABASE' and object = 'db' || cast(r as varchar)
union select usr, privilege, name from held join placed on kind = 'CATALOG' and object = case when r < 2 then 'main' else 'other' end
union select 'user' || cast(n_nationkey as varchar), privilege, n_name from nation cross join names
"""


@query("effective_grants_nested", NESTED)
def nested_grants(spark: SparkSession, d: str) -> DataFrame:
    """Grants on catalogs, databases, tables and views through groups of any nesting."""
    return governance.effective_grants(*nested_grant_tables(spark, d))


@query("entitled_rows", GRANTS + """
select c_custkey, n_name from customer join nation on c_nationkey = n_nationkey
where n_name in (select "table" from effective where "user" = 'user1' and privilege = 'SELECT')
""")
def entitled(spark: SparkSession, d: str) -> DataFrame:
    grants = governance.effective_grants(*grant_tables(spark, d))
    nations = read_table(spark, d, "nation")
    rows = read_table(spark, d, "customer", "c_custkey", "c_nationkey").join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")
    return governance.entitled_rows(rows, grants, "user1", "n_name")
