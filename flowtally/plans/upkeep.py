"""Upkeep of rollup tables: key checks and repair. Days are removed in ``streaming.served``."""

from pyspark.sql import functions as F


def duplicate_keys(rows, keys):
    """Keys that occur more than once, with how often."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


def key_counts(rows, keys):
    """One row: how many rows and how many different keys a table has."""
    per_key = rows.groupBy(*keys).agg(F.count("*").alias("n"))
    return per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count("*").alias("n_keys"))


def drop_duplicates(rows, keys, order_by):
    """One row per key: the first by ``order_by``, ties broken by the other columns.

    A minimum per key instead of a ranking: tasks keep one candidate per key
    before the shuffle, so a key with very many copies is no burden.
    """
    rest = [c for c in rows.columns if c not in keys]
    ranked = [order_by, *[c for c in rest if c != order_by]]
    return rows.groupBy(*keys).agg(F.min(F.struct(*ranked)).alias("first")).select(
        *[F.col(c) if c in keys else F.col(f"first.{c}").alias(c) for c in rows.columns])

