"""Audience attributes and exclusions.

The driving relation here is the active set (rows that met a rule), which is
small next to the user dimensions. A dimension that is left-joined is semi-joined to
the active keys first, so that only its matching rows take part. The pipelines store
the active set before these joins; Spark then knows its size and picks the strategy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.functions.columns import email_domain
from cohortline.operators.joins import restrict_to
from cohortline.params import INTERNAL_STATUS


def attach_profile(df: DataFrame, profile: DataFrame) -> DataFrame:
    """Inner join to the profile (country, email, login list); unknown actors drop out."""
    return df.join(profile.select("actor_id", "country", "email", "login_list"), "actor_id").select(
        *df.columns, "country", "email", "login_list")


def _internal_flags(df: DataFrame, domains: DataFrame, statuses: DataFrame) -> DataFrame:
    keyed = df.withColumn("_domain", email_domain(F.col("email")))
    dom = domains.select("domain", F.col("company").alias("_company")).distinct()
    st = restrict_to(statuses.select("actor_id", "status_code"), df, "actor_id")
    return (keyed
              .join(dom, F.col("_domain") == F.col("domain"), "left")
              .join(st, "actor_id", "left")
              .withColumn("_internal", F.col("_company").isNotNull()
                          | F.coalesce(F.col("status_code") == INTERNAL_STATUS, F.lit(False))))


def exclude_internal(df: DataFrame, domains: DataFrame, statuses: DataFrame,
                     mode: str = "rowwise") -> DataFrame:
    """C14: drop internal users.

    ``rowwise`` (the reference): the verdict is taken per joined status row, so a
    user with one internal and one other status survives through the other row,
    and every surviving status row stays (it takes its own rank later).
    ``strict``: drop every user that is internal by domain or by any status.
    """
    cols = df.columns
    flagged = _internal_flags(df, domains, statuses)
    if mode == "rowwise":
        return flagged.filter(~F.col("_internal")).select(*cols)
    if mode == "strict":
        internal = flagged.filter(F.col("_internal")).select("actor_id").distinct()
        return df.join(internal, "actor_id", "left_anti").select(*cols)
    raise ValueError(f"unknown mode {mode!r}")


def exclude_unsubscribed(df: DataFrame, preferences: DataFrame) -> DataFrame:
    """Drop users whose preference says unsubscribed; no preference row = subscribed."""
    cols = df.columns
    keyed = df.withColumn("_user_ref", F.col("actor_id").cast("string"))
    prefs = restrict_to(preferences.select(F.col("user_ref").alias("_user_ref"), "unsubscribed"),
                        keyed, "_user_ref")
    joined = keyed.join(prefs, "_user_ref", "left")
    return joined.filter(F.coalesce(F.col("unsubscribed"), F.lit("false")) != "true").select(*cols)
