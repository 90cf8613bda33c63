"""Questions asked of a nested service log.

The log has serviceName, actionName, date, and the structs userIdentity,
requestParams and response.  Grouping happens on the nested fields directly,
so only the fields in use are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.fixed_values import DISK_ATTRIBUTES
from tallyloom.operators.joins import distinct_match, distinct_pair_count, run_name

# Service and action names, and special users, as the log spells them.
CREATE_CLUSTER = ("clusters", "create")
CLUSTER_CREATED = ("clusters", "createResult")
RUN_FAILED = ("jobs", "runFailed")
LOGIN = ("accounts", "login")
GRANT_PERMISSION = ("sqlPermissions", "grantPermission")
ATTACH_NOTEBOOK = ("notebook", "attachNotebook")
UNKNOWN_USER = "Unknown"
JOB_LAUNCHER = "JOB_LAUNCHER"
SUCCESS = 200


def of_action(log: DataFrame, service: str, action: str) -> DataFrame:
    return log.filter((F.col("serviceName") == service) & (F.col("actionName") == action))


def count_by(log: DataFrame, **fields: Column | str) -> DataFrame:
    keys = [(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in fields.items()]
    return log.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt")).orderBy(F.desc("cnt"), *fields)


def actions_per_service(log: DataFrame) -> DataFrame:
    return count_by(log, serviceName="serviceName", actionName="actionName")


def cluster_creations_by_user(log: DataFrame) -> DataFrame:
    return count_by(of_action(log, *CREATE_CLUSTER), email="userIdentity.email")


def creations_by_people(log: DataFrame, unknown: str = UNKNOWN_USER,
                        launcher: str = JOB_LAUNCHER) -> DataFrame:
    """Cluster creations that are not an unknown user acting for the job launcher."""
    by_launcher = ((F.col("userIdentity.email") == unknown)
                   & (F.col("requestParams.cluster_creator") == launcher))
    return of_action(log, *CREATE_CLUSTER).filter(~by_launcher)


def failed_runs_by_job(log: DataFrame) -> DataFrame:
    return count_by(of_action(log, *RUN_FAILED), jobId="requestParams.jobId")


def failed_logins(log: DataFrame) -> DataFrame:
    return (
        of_action(log, *LOGIN).filter(F.col("response.statusCode") != SUCCESS)
        .select("userIdentity.email", "date", "requestParams.user", "response.statusCode")
        .distinct())


def permission_grants(log: DataFrame) -> DataFrame:
    return of_action(log, *GRANT_PERMISSION).select(
        "userIdentity.email", "requestParams.permission", "date")


def disk_totals(log: DataFrame) -> DataFrame:
    """Disk counts and sizes per user and disk type, from JSON text inside the log."""
    parsed = of_action(log, *CREATE_CLUSTER).select(
        "userIdentity.email",
        F.from_json("requestParams.aws_attributes", DISK_ATTRIBUTES).alias("disk"))
    return (
        parsed.groupBy("email", "disk.ebs_volume_type")
        .agg(F.sum("disk.ebs_volume_count").alias("tot_ebs_vols"),
             F.sum("disk.ebs_volume_size").alias("tot_ebs_vol_size"))
        .filter(F.col("ebs_volume_type").isNotNull())
        .orderBy(F.desc("tot_ebs_vols")))


def failed_job_settings(log: DataFrame, launcher: str = JOB_LAUNCHER) -> DataFrame:
    """Cluster settings used by failed job runs, matched on the cluster's name."""
    failed = of_action(log, *RUN_FAILED).select(
        F.col("requestParams.jobId").alias("jobId"),
        run_name("requestParams.jobId", "requestParams.idInJob").alias("cluster_name"))
    clusters = (
        of_action(log, *CREATE_CLUSTER)
        .filter(F.col("requestParams.cluster_creator") == launcher)
        .select("requestParams.cluster_name", "requestParams.node_type_id",
                "requestParams.spark_version"))
    return distinct_match(failed, clusters, "cluster_name",
                          ["jobId", "node_type_id", "spark_version"])


def notebooks_per_cluster_name(log: DataFrame) -> DataFrame:
    attached = of_action(log, *ATTACH_NOTEBOOK).select(
        "requestParams.clusterId", "requestParams.notebookId")
    named = of_action(log, *CLUSTER_CREATED).select(
        "requestParams.clusterId", "requestParams.clusterName")
    return distinct_pair_count(attached, named, "clusterId", "notebookId", "clusterName")
