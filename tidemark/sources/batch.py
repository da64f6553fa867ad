"""Batch reads: CSV with and without a header, tables, named SQL reads, file inventories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_csv(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """All columns as text; without a header they are named ``_c0, _c1, ...``."""
    return spark.read.option("header", header).csv(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table or view, by a name that may come from run parameters."""
    return spark.sql("SELECT * FROM IDENTIFIER(:name)", args={"name": name})


def file_inventory(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Files below ``path`` with length and modification time; their contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(path)
        .select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "length", "modificationTime")
    )
