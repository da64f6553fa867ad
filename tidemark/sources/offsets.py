"""Offsets of a topic that were read: runs, gaps, where to go on, and what to do about lost data.

A partition's offsets are first summed up per block of ``BLOCK`` offsets (an aggregation with map-side combine); a
block whose distinct offsets fill its span is one run. Only blocks with holes are sorted, each for itself, so a
partition that holds most of a topic does not end up in one task. Windows along a partition then see runs, not offsets.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BLOCK = 1_000_000
_PLACE = ["topic", "partition"]


class DataLossError(RuntimeError):
    """Offsets are missing between those that were read."""


def offset_runs(messages: DataFrame, block: int = BLOCK) -> DataFrame:
    """(topic, partition, first_offset, last_offset): the longest runs of offsets without a hole.

    Offsets that were read twice count once; rows without a topic, partition or offset count for nothing.
    """
    read = messages.select(*_PLACE, "offset").where("topic is not null and partition is not null and offset is not null")
    read = read.withColumn("block", F.floor(F.col("offset") / block))
    distinct = read.distinct()
    spans = distinct.groupBy(*_PLACE, "block").agg(
        F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"), F.count(F.lit(1)).alias("n")
    )
    whole = F.col("last_offset") - F.col("first_offset") + 1 == F.col("n")
    full = spans.where(whole).select(*_PLACE, "first_offset", "last_offset")
    holes = spans.where(~whole).select(*_PLACE, "block")
    within = Window.partitionBy(*_PLACE, "block").orderBy("offset")
    island = distinct.join(holes, [*_PLACE, "block"], "left_semi").withColumn("island", F.col("offset") - F.row_number().over(within))
    parts = island.groupBy(*_PLACE, "block", "island").agg(F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"))
    runs = full.unionByName(parts.drop("block", "island"))
    # Runs that touch across an edge of blocks are one.
    along = Window.partitionBy(*_PLACE).orderBy("first_offset")
    starts = F.coalesce((F.lag("last_offset").over(along) + 1 < F.col("first_offset")).cast("long"), F.lit(1))
    numbered = runs.withColumn("starts", starts).withColumn("run", F.sum("starts").over(along))
    return numbered.groupBy(*_PLACE, "run").agg(F.min("first_offset").alias("first_offset"), F.max("last_offset").alias("last_offset")).drop("run")


def offset_gaps(runs: DataFrame) -> DataFrame:
    """(topic, partition, first_missing, last_missing, missing): the holes between runs of one partition."""
    along = Window.partitionBy(*_PLACE).orderBy("first_offset")
    before = runs.withColumn("before", F.lag("last_offset").over(along)).where("before is not null")
    gaps = before.select(*_PLACE, (F.col("before") + 1).alias("first_missing"), (F.col("first_offset") - 1).alias("last_missing"))
    return gaps.withColumn("missing", F.col("last_missing") - F.col("first_missing") + 1)


def resume_offsets(runs: DataFrame, skip_gaps: bool = True) -> DataFrame:
    """(topic, partition, next_offset): where reading goes on; behind all that was read, or with ``skip_gaps`` False
    at the first hole, so that what is missing is asked for again."""
    if skip_gaps:
        return runs.groupBy(*_PLACE).agg((F.max("last_offset") + 1).alias("next_offset"))
    first = F.min_by("last_offset", "first_offset")
    return runs.groupBy(*_PLACE).agg((first + 1).alias("next_offset"))


def starting_offsets(resume: DataFrame) -> str:
    """``resume`` as the text that the topic reader takes as its start; a topic's partitions are few."""
    found: dict[str, dict[str, int]] = {}
    for row in resume.collect():
        found.setdefault(row["topic"], {})[str(row["partition"])] = row["next_offset"]
    return json.dumps(found, sort_keys=True)


def check_offsets(runs: DataFrame, fail_on_data_loss: bool = True) -> DataFrame:
    """The gaps; with ``fail_on_data_loss`` any gap is an error that names the first of them."""
    gaps = offset_gaps(runs)
    if fail_on_data_loss and (first := gaps.orderBy(*_PLACE, "first_missing").first()):
        raise DataLossError(
            f"topic {first['topic']} partition {first['partition']}: offsets {first['first_missing']} to {first['last_missing']} are missing"
        )
    return gaps
