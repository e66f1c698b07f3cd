"""Client names and the one-row-per-user output."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.operators.joins import restrict_to


def client_names(selected: DataFrame, clients: DataFrame, mode: str = "max") -> DataFrame:
    """C20: ``first_name`` / ``last_name`` per selected actor (NULL without a client row).

    ``max``: the reference's result, the greatest name of each kind (its
    LAST_VALUE uses the default frame, so every row sees its own name and the
    outer MAX picks the greatest). ``latest``: the names of the latest client
    row by ``joined_at``, ties broken by ``client_seq``.
    ``last_value``: LAST_VALUE with its default RANGE frame taken literally. A row sees the last row of its
    peers, the client rows of the same ``joined_at`` (NULL ones are peers too); the last peer is the one with the greatest
    ``client_seq`` (then the greatest names, NULL least). The outer MAX then takes the greatest of these, so it
    differs from ``max`` only where rows tie on ``joined_at``. Peers are rolled up first, a hot
    actor's rows never meet in one window.
    The client relation is semi-joined to the selected actors first and rolled
    up per actor with map-side partial aggregation.
    """
    rows = restrict_to(clients, selected, "actor_id")
    if mode == "max":
        names = rows.groupBy("actor_id").agg(F.max("first_name").alias("first_name"),
                                             F.max("last_name").alias("last_name"))
    elif mode == "latest":
        latest = F.max_by(F.struct("first_name", "last_name"), F.struct("joined_at", "client_seq"))
        names = rows.groupBy("actor_id").agg(latest.alias("_n")).select(
            "actor_id", F.col("_n.first_name").alias("first_name"),
            F.col("_n.last_name").alias("last_name"))
    elif mode == "last_value":
        last = F.max(F.struct("client_seq", "first_name", "last_name"))
        peers = rows.groupBy("actor_id", "joined_at").agg(last.alias("_n"))
        names = peers.groupBy("actor_id").agg(F.max("_n.first_name").alias("first_name"),
                                              F.max("_n.last_name").alias("last_name"))
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return selected.join(names, "actor_id", "left")


def one_row_per_user(df: DataFrame, keys, columns) -> DataFrame:
    """MAX of each attribute per key (the reference's final GROUP BY)."""
    return df.groupBy(*keys).agg(*[F.max(c).alias(c) for c in columns])
