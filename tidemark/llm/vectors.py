"""Helpers of the vector searches: equal vectors are searched once, results are given to every row.

A class is a set of rows with equal vectors. Only the ``keep`` smallest ids of a class can be among the
first ``keep`` results of any query, as they tie, so a class carries no more than those.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import with_row_id, written

SALTS = 16


def usual_length(df: DataFrame, vector: str) -> int:
    """The length that most vectors have, the greater among equals; 0 if there are none."""
    sizes = df.where(F.col(vector).isNotNull()).groupBy(F.size(vector).alias("size")).count()
    first = sizes.orderBy(F.desc("count"), F.desc("size")).first()
    return first["size"] if first else 0


def matrix(lists: pa.Array, width: int) -> np.ndarray:
    """An Arrow column of lists of ``width`` numbers as rows of a matrix."""
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return np.asarray(flat, np.float64).reshape(len(lists), width)


def classes(df: DataFrame, keep: int) -> DataFrame:
    """(class_id, vector, ids) from rows (id long, vector array<double> without nulls or NaN), written.

    Rows that agree in id and vector count once. ``ids`` are the ``keep`` smallest of the class, sorted;
    ``class_id`` is a number of its own, as an id can be repeated in several classes. Ids are cut to
    ``keep`` within each partition first, then per salt, so a vector that a third of the rows share
    makes no large group.
    """

    def fold(parts):
        for batch in parts:
            ids = batch.column(0).to_numpy()
            order = np.argsort(ids, kind="stable")
            rows = batch.take(pa.array(order))
            # Equal vectors of a batch by their bytes; -0.0 was made 0.0 before.
            lists = rows.column(1)
            flat = np.asarray(lists.flatten().to_numpy(zero_copy_only=False), np.float64)
            bounds = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
            names = [flat[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]
            frame = pd.DataFrame({"name": names, "id": ids[order]})
            once = ~frame.duplicated().to_numpy()
            place = frame[once].groupby("name", sort=False).cumcount().to_numpy()
            yield rows.filter(pa.array(once)).filter(pa.array(place < keep))

    schema = df.select("id", "vector").schema
    few = df.select("id", "vector").mapInArrow(fold, schema)
    smallest = F.slice(F.sort_array(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, keep).alias("ids")
    salted = few.select("vector", F.array("id").alias("ids"), F.pmod(F.xxhash64("id"), F.lit(SALTS)).alias("salt"))
    per_salt = salted.groupBy("vector", "salt").agg(smallest)
    merged = per_salt.groupBy("vector").agg(smallest)
    return written(with_row_id(merged, "class_id").select("class_id", "vector", "ids"), "classes")


def give_results(queries: DataFrame, found: DataFrame, limit: int, ascending: bool) -> DataFrame:
    """(query_id, rank, vec_id, score) for ``queries`` (query_id, class_id).

    ``found`` has (class_id, ids, score): the classes found for a class of queries. A query's own row is
    left out; ties go to the smaller id.
    """
    order = F.col("score") if ascending else -F.col("score")
    each = found.select("class_id", F.explode("ids").alias("vec_id"), "score").select(
        "class_id", F.struct(order.alias("order"), "vec_id", "score").alias("hit")
    )
    # A class has at most a few dozen hits: what the search kept for it.
    hits = each.groupBy("class_id").agg(F.slice(F.sort_array(F.collect_set("hit")), 1, limit + 1).alias("hits"))
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    asked = queries.withColumn("salt", F.pmod(F.xxhash64("query_id"), F.lit(SALTS)).cast("int"))
    rows = asked.join(hits.select("class_id", "hits", salts), ["class_id", "salt"])
    own = F.filter("hits", lambda h: h["vec_id"] != F.col("query_id"))
    ranked = rows.select("query_id", F.posexplode(F.slice(own, 1, limit)).alias("place", "hit"))
    return ranked.select("query_id", (F.col("place") + 1).alias("rank"), "hit.vec_id", "hit.score")
