"""Who may read what: privileges resolved from a grant log, and guarded reads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.workspace import materialise, small_side

# The privileges that ALL PRIVILEGES stands for.
PRIVILEGES = ("SELECT", "CREATE", "MODIFY", "READ_METADATA", "CREATE_NAMED_FUNCTION")

TASK_ROWS = 1 << 18  # rows of a task that holds them while it groups them
TASK_RESULTS = 1 << 20  # rows of a task that only passes them on


def secured_view(df: DataFrame, name: str, columns: Sequence[str], condition: str) -> DataFrame:
    """A view that shows only some columns and rows."""
    base = f"{name}_base"
    spark = df.sparkSession
    df.createOrReplaceTempView(base)
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} AS "
              f"SELECT {', '.join(columns)} FROM {base} WHERE {condition}")
    return spark.table(name)


def standing_grants(log: DataFrame) -> DataFrame:
    """Grants still in force: the last event per (principal, privilege, object) wins.

    ``log`` has seq, action (GRANT or REVOKE), principal, privilege,
    object_type and object.  ALL PRIVILEGES counts as each single privilege.
    """
    single = _spread(log, "principal", "object_type", "object").withColumn("privilege", F.explode(
        F.when(F.col("privilege") == "ALL PRIVILEGES", F.array(*[F.lit(p) for p in PRIVILEGES]))
        .otherwise(F.array("privilege"))))
    return (
        single.groupBy("principal", "privilege", "object_type", "object")
        .agg(F.max_by(F.col("action") == "GRANT", "seq").alias("_granted"))
        .filter("_granted").drop("_granted"))


def _spread(rows: DataFrame, *keys: str) -> DataFrame:
    """``rows`` by key over as many tasks as their number calls for, so that none groups more the more there are."""
    return rows.repartition(max(1, -(-rows.count() // TASK_ROWS)), *keys)


def closed_members(members: DataFrame, max_depth: int = 1000) -> DataFrame:
    """(group, user) with the members of groups that are members themselves, at any depth.

    Pairs are followed one membership further in each round, and only those not
    known yet go on, so groups that hold each other end the search and many
    ways to one member count once.  Each round is a written table; there are as
    many as groups are nested.
    """
    edges = members.select("group", "user").where("group is not null and user is not null").distinct()
    if edges.join(edges.select(F.col("group").alias("user")), "user", "left_semi").isEmpty():
        return edges  # no group is a member
    known = frontier = edges = materialise(edges, "edges")
    for _ in range(max_depth):
        further = frontier.join(edges.select(F.col("group").alias("user"), F.col("user").alias("_next")), "user").select(
            "group", F.col("_next").alias("user")).distinct()
        frontier = materialise(further.join(known, ["group", "user"], "left_anti"), "frontier")
        if frontier.isEmpty():
            return known
        known = materialise(known.unionByName(frontier), "members")
    raise RuntimeError(f"groups are nested more than {max_depth} deep")


def effective_grants(log: DataFrame, members: DataFrame, tables: DataFrame,
                     owners: DataFrame) -> DataFrame:
    """(user, privilege, table) after expanding groups, databases and catalogs and adding owners.

    ``members`` has group and user, where a user may be a group of its own;
    ``tables`` has database and table (or view), and catalog where there are
    several; ``owners`` has owner and table.  A grant on a CATALOG reaches all
    tables and views in it, one on a DATABASE those of the database, one on a
    TABLE or VIEW that one.  Groups are named in the result next to users.

    Users in the same groups hold the same through them, so each combination of
    groups is resolved once and its users are joined to that; what a user holds
    besides is added where it is not among it.  No row of the result is held
    or sent to find out whether it is there twice.
    """
    standing = materialise(standing_grants(log), "standing")
    places = ("DATABASE", "CATALOG") if "catalog" in tables.columns else ("DATABASE",)
    contained = tables.select("table", F.explode(F.array(*[
        F.struct(F.lit(p).alias("object_type"), F.col(p.lower()).alias("object")) for p in places])).alias("_in")).select(
        "table", "_in.*").distinct()
    on_table = standing.filter("object_type in ('TABLE', 'VIEW')").select("principal", "privilege", F.col("object").alias("table"))
    inside = standing.join(contained, ["object_type", "object"]).select("principal", "privilege", "table")
    granted = on_table.unionByName(inside)
    users = materialise(closed_members(members).groupBy("user").agg(F.sort_array(F.collect_set("group")).alias("_groups")), "users")
    sets = users.groupBy("_groups").agg(F.count(F.lit(1)).alias("_users"))
    through = materialise(sets.select("_groups", "_users", F.explode("_groups").alias("principal")).join(granted, "principal")
                          .select("_groups", "_users", "privilege", "table").distinct(), "through")
    results = through.agg(F.sum("_users")).first()[0] or 0
    through = small_side(through.drop("_users"))
    through_group = users.repartition(max(1, -(-results // TASK_RESULTS))).join(through, "_groups").select("user", "privilege", "table")
    owned = owners.select(F.col("owner").alias("user"), F.explode(
        F.array(*[F.lit(p) for p in PRIVILEGES])).alias("privilege"), "table")
    own = _spread(granted.withColumnRenamed("principal", "user").unionByName(owned), "user").distinct().join(users, "user", "left")
    known = through.toDF("_of", "_privilege", "_table")
    apart = own.join(known, (F.col("_groups") == F.col("_of")) & F.col("privilege").eqNullSafe(F.col("_privilege"))
                     & F.col("table").eqNullSafe(F.col("_table")), "left_anti")
    return through_group.unionByName(apart.select("user", "privilege", "table"))


def entitled_rows(df: DataFrame, grants: DataFrame, user: str, object_column: str,
                  privilege: str = "SELECT") -> DataFrame:
    """Rows whose object the user holds the privilege on."""
    allowed = grants.filter(
        (F.col("user") == user) & (F.col("privilege") == privilege)
    ).select(F.col("table").alias(object_column)).distinct()
    return df.join(small_side(allowed), object_column, "left_semi")
