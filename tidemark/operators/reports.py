"""Verification reports over lot tables: counts, lot summary, rescued rows, table profile."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.csv_lots import RESCUED

# The output names of the two lot reports.


def group_counts(df: DataFrame, *keys: str, name: str = "count") -> DataFrame:
    """Rows per key combination, NULL being a group, in key order with NULLs first."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)).orderBy(*keys)


def lot_summary(df: DataFrame, lot: str, client: str, amount: str, flag: str) -> DataFrame:
    """Per lot: rows, distinct clients, rounded amount, rows with ``flag`` set."""
    has_flag = F.when(F.col(flag).isNotNull(), F.lit(1)).otherwise(F.lit(0))
    return (
        df.groupBy(lot)
        .agg(
            F.count(F.lit(1)).alias("total_ordenes"),
            F.count_distinct(client).alias("clientes_unicos"),
            F.round(F.sum(amount), 2).alias("facturacion_total"),
            F.sum(has_flag).alias(f"con_{flag}"),
        )
        .orderBy(lot)
    )


def rescued_summary(df: DataFrame, lot: str, rescued: str = RESCUED) -> DataFrame:
    """Per lot: rows, and rows that carry rescued data."""
    return df.groupBy(lot).agg(
        F.count(F.lit(1)).alias("total_registros"), F.count(rescued).alias("con_rescued_data")
    )


def rescued_rows(df: DataFrame, key: str, n: int | None = None, rescued: str = RESCUED) -> DataFrame:
    """Rows with rescued data: key and JSON text; all of them, or the first ``n`` by key."""
    found = df.where(F.col(rescued).isNotNull()).select(key, rescued)
    return found if n is None else found.orderBy(key, rescued).limit(n)


def table_profile(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, and the table's row and column counts."""
    fields = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("column_type"),
        )
        for i, f in enumerate(df.schema)
    ]
    return (
        df.agg(F.count(F.lit(1)).alias("row_count"))
        .withColumn("column_count", F.lit(len(fields)))
        .select("row_count", "column_count", F.inline(F.array(*fields)))
    )
