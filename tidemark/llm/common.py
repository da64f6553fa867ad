"""Helpers shared by the operators: tables, row ids, scratch tables, text chunks."""

from __future__ import annotations

import gc
import re
import sys
import types
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import tidemark.llm
from tidemark.workspace import scratch_path

# Functions go to the workers with their tasks, wherever the driver found this package.
cloudpickle.register_pickle_by_value(tidemark.llm)

# The characters of Unicode's White_Space property, which the tokenizers' \s stands for.
WHITE_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

#: Text falls apart here without crossing any pre-token of the byte-level pattern: a pre-token holds
#: white space only as one leading space or as a run of nothing else.
CHUNKS = re.compile(f" ?[^{WHITE_SPACE}]+|[{WHITE_SPACE}]+(?![^{WHITE_SPACE}])|[{WHITE_SPACE}]+")

#: Rows in an Arrow batch of texts. Spark bounds a batch in bytes as well.
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Texts go to Python in batches that fit beside the heap of a small executor."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table below the shared folder: computed once, its lineage cut, safe from lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_row_id(df: DataFrame, name: str = "row_id") -> DataFrame:
    """Adds an id per row. It is stable only once the result is written."""
    return df.withColumn(name, F.monotonically_increasing_id())


class Cache(dict):
    """Results by string in a Python worker. Beyond ``bound`` entries only those still in use are kept."""

    def __init__(self, bound: int):
        super().__init__()
        self.bound = bound

    def missing(self, wanted: set[str]) -> list[str]:
        """What is wanted and not known; makes room for it first if the bound would be passed."""
        new = [w for w in wanted if w not in self]
        if len(self) + len(new) > self.bound:
            kept = {w: self[w] for w in wanted if w in self}
            self.clear()
            self.update(kept)
        return new

    def of(self, wanted: list[str], make: Callable[[list[str]], list]) -> list:
        """The results of ``wanted``, distinct strings; ``make`` gives those that are not known, never None."""
        found = list(map(self.get, wanted))
        new = [w for w, value in zip(wanted, found) if value is None]
        if not new:
            return found
        if len(self) + len(new) > self.bound:
            self.clear()
            self.update((w, value) for w, value in zip(wanted, found) if value is not None)
        made = make(new)
        self.update(zip(new, made, strict=True))
        following = iter(made)
        return [next(following) if value is None else value for value in found]


def worker_store() -> dict:
    """A dict that lives as long as the Python worker, for what one task can leave to the next."""
    return sys.modules.setdefault("tidemark_worker_store", types.ModuleType("tidemark_worker_store")).__dict__


def kept_in_worker(name: str, make):
    """What ``make`` gives, made once per worker. A worker keeps one such thing: the next operator's takes its
    place, so that the caches of operators that run after one another do not add up."""
    store = worker_store()
    kept = store.get("kept")
    if kept is None or kept[0] != name:
        store["kept"] = kept = None
        store["kept"] = kept = (name, make())
    return kept[1]


#: Characters of texts that are looked up together.
GROUP_CHARS = 1 << 22


def groups_of(texts: list[str]) -> Iterator[list[str]]:
    """Runs of whole texts of about ``GROUP_CHARS`` characters."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= GROUP_CHARS:
            yield texts[first : i + 1]
            first, size = i + 1, 0
    if first < len(texts):
        yield texts[first:]


class Places:
    """The strings of many lists: the distinct ones, and which of them stands where."""

    def __init__(self, lists: list[list[str]]):
        found = pa.array(list(chain.from_iterable(lists)), pa.large_string()).dictionary_encode()
        self.distinct: list[str] = found.dictionary.to_pylist()
        self.at = found.indices
        self.begin = np.cumsum([0, *map(len, lists)])

    def joined(self, values: list[bytes]) -> tuple[memoryview, np.ndarray]:
        """The values of all strings one after the other, and where each list's begin and the last one's end;
        ``values`` are those of ``distinct``."""
        return taken(pa.array(values, pa.large_binary()), self.at, self.begin)


def taken(values: pa.Array, at: pa.Array, begin: np.ndarray) -> tuple[memoryview, np.ndarray]:
    """The bytes of ``values`` at the places ``at`` in a row, and where those of the places ``begin`` begin."""
    row = values.take(at)
    _, offsets, content = row.buffers()
    if not len(row) or content is None:
        return memoryview(b""), np.zeros(len(begin), np.int64)
    return memoryview(content), np.frombuffer(offsets, np.int64)[begin]


@contextmanager
def no_cycle_search() -> Iterator[None]:
    """For work that makes very many small objects and no cycles: Python does not search them for cycles again and again."""
    if not gc.isenabled():
        yield
        return
    gc.disable()
    try:
        yield
    finally:
        gc.enable()
