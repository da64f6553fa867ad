"""Best-fit packing, certified by lower bounds and repaired by exchange.

Rows with a length go into sequences of ``capacity``. A round packs each partition by best-fit decreasing
and compares its number of sequences with a lower bound from dual feasible functions: if they are equal
the partition is certified, nothing can pack its rows tighter. In a partition with a gap, sequences that
are full stay; the others are dealt out anew, whole sequences together, over fewer partitions, where their
rows are packed again. The old sequences are kept wherever the new packing needs as many, so no round makes
things worse. Rounds end when nothing with a gap is left, or after ``rounds``.

A partition holds about ``rows_per_task`` rows of a few numbers each, whatever the size of the input; the
rows of the next round are what the last one could not certify.
"""

from __future__ import annotations

import math
import unicodedata
import zlib
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import (
    WHITE_SPACE,
    Cache,
    Places,
    groups_of,
    kept_in_worker,
    no_cycle_search,
    small_batches,
    table,
    with_row_id,
    written,
)
from tidemark.llm.token_counts import load_tokenizer

VOCABULARY = "word_bpe_49k.json"
CAPACITY = 2048
ROWS_PER_TASK = 100_000
ROUNDS = 4


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """The least number of sequences that dual feasible functions prove necessary; 0 for no rows.

    Two families are tried. The first counts a length above ``capacity - cut`` as a whole sequence, one
    below ``cut`` as nothing and others as they are, for every cut up to half. The second rounds lengths
    down to multiples of 1/k of a sequence by floor((k + 1) x), unless (k + 1) x is whole.
    """
    if not len(lengths):
        return 0
    counts = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    number = np.concatenate([[0], np.cumsum(counts)])
    total = np.concatenate([[0], np.cumsum(counts * np.arange(capacity + 1))])
    cuts = np.arange(capacity // 2 + 1)
    large = number[-1] - number[capacity - cuts + 1]
    middle = total[capacity - cuts + 1] - total[cuts]
    best = int(np.max(-(-(large * capacity + middle) // capacity)))
    sizes = np.arange(capacity + 1, dtype=np.int64)
    for k in range(1, 33):
        scaled = (k + 1) * sizes
        whole = scaled % capacity == 0
        # In units of 1 / (k * capacity) of a sequence, so that all sums are exact.
        value = np.where(whole, sizes * k, scaled // capacity * capacity)
        best = max(best, -(-int((counts * value).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Sequence number per row. Sequences by free space: a bit set of the spaces in use finds the tightest fit."""
    order = np.argsort(-lengths, kind="stable")
    place = np.empty(len(lengths), np.int64)
    by_space: list[list[int]] = [[] for _ in range(capacity + 1)]
    used = 0
    opened = 0
    for row, length in zip(order.tolist(), lengths[order].tolist()):
        fits = used >> length
        if fits:
            space = length + (fits & -fits).bit_length() - 1
            stack = by_space[space]
            sequence = stack.pop()
            if not stack:
                used ^= 1 << space
        else:
            space, sequence = capacity, opened
            opened += 1
        place[row] = sequence
        space -= length
        if space:
            if not by_space[space]:
                used |= 1 << space
            by_space[space].append(sequence)
    return place


def pack_rows(rows: pd.DataFrame, capacity: int, prefix: int) -> pd.DataFrame:
    """One partition's rows with ``sequence_id``, ``offset``, ``certified`` and ``released``."""
    lengths = rows["length"].to_numpy(np.int64)
    place = best_fit_decreasing(lengths, capacity)
    needed = int(place.max()) + 1
    before = pd.factorize(rows["sequence_id"])[0]
    if (before >= 0).all() and int(before.max()) + 1 <= needed:
        place, needed = before, int(before.max()) + 1
    certified = needed == lower_bound(lengths, capacity)
    filled = np.bincount(place, weights=lengths, minlength=needed).astype(np.int64)
    order = np.lexsort((rows["row_id"].to_numpy(np.int64), place))
    sums = np.cumsum(lengths[order])
    starts = sums - lengths[order]
    sorted_place = place[order]
    first = np.concatenate([[True], sorted_place[1:] != sorted_place[:-1]])
    offset = np.empty(len(rows), np.int64)
    offset[order] = starts - np.maximum.accumulate(np.where(first, starts, 0))
    return rows.assign(
        sequence_id=prefix + place,
        offset=offset,
        certified=certified | (filled[place] == capacity),
        released=(not certified) & (filled[place] < capacity),
    )


def pack(
    df: DataFrame, capacity: int = CAPACITY, rows_per_task: int = ROWS_PER_TASK, rounds: int = ROUNDS
) -> DataFrame:
    """Adds ``sequence_id``, ``offset`` and ``certified`` to rows with ``length`` from 1 to ``capacity``.

    Other columns are carried along; one named like a result gives way to it. Rows whose length is null
    or out of range are an error. An empty table gives an empty result. ``row_id`` (long, unique) must be
    there; it breaks ties. Ids of sequences are unique, not dense.
    """
    df = df.drop("sequence_id", "offset", "certified", "released")
    wrong = F.col("length").isNull() | (F.col("length") < 1) | (F.col("length") > capacity)
    length = F.when(wrong, F.raise_error(F.lit(f"a length is not from 1 to {capacity}"))).otherwise(F.col("length"))
    current = df.withColumn("length", length.cast("long")).withColumns(
        {"sequence_id": F.lit(None).cast("long"), "offset": F.lit(0).cast("long"), "certified": F.lit(False), "released": F.lit(True)}
    )
    names, schema = current.columns, current.schema
    settled = []
    for turn in range(rounds):
        tasks = max(1, math.ceil(current.count() / rows_per_task))
        key = F.xxhash64(F.coalesce("sequence_id", "row_id"), F.lit(turn))

        def partition(parts, turn=turn):
            from pyspark import TaskContext

            frames = [b.to_pandas() for b in parts if b.num_rows]
            if frames:
                # Room for 2^12 rounds, 2^20 partitions and 2^31 sequences in each.
                prefix = turn << 51 | TaskContext.get().partitionId() << 31
                packed = pack_rows(pd.concat(frames, ignore_index=True), capacity, prefix)
                yield pa.RecordBatch.from_pandas(packed[names], preserve_index=False)

        done = written(current.repartition(tasks, key).mapInArrow(partition, schema), "packing")
        settled.append(done.where(~F.col("released") | F.lit(turn == rounds - 1)))
        current = done.where("released")
        if turn == rounds - 1 or not current.take(1):
            break
    result = settled[0]
    for more in settled[1:]:
        result = result.unionByName(more)
    return result.drop("released")


class WordEncoder:
    """Ids of texts under a tokenizer that lower-cases and drops white space, unit by unit.

    A unit is a run without white space; the tokenizer never joins two of them, so a text's ids are its
    units' ids in order. Units of Latin letters are cut further by the tokenizer's own pattern. Each
    distinct word goes through the library once while it stays in the cache.
    """

    # Fixed value: the pattern by which the tokenizer file splits lower-cased text.
    SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
    PLAIN = regex.compile(r"[!-ɏ]+")
    UNITS = regex.compile(f"[^{WHITE_SPACE}]+")
    ODD_SPACE = regex.compile("[\x1c-\x1f]")

    JOINED = 1000

    def __init__(self, path: str, bound: int = 600_000):
        self.tokenizer = load_tokenizer(path)
        self.units, self.words = Cache(bound), Cache(bound)
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def split(self, text: str) -> list[str]:
        # str.split takes four control characters for white space that the tokenizer keeps.
        return self.UNITS.findall(text) if self.ODD_SPACE.search(text) else text.split()

    def library(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def merged(self, words: list[str]) -> list[bytes]:
        """Ids of each word, encoded many at a time: a word's last token is the one that closes it."""
        texts = [" ".join(words[i : i + self.JOINED]) for i in range(0, len(words), self.JOINED)]
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.concatenate([np.array(e.ids, "<u4") for e in found]) if found else np.zeros(0, "<u4")
        raw, ends = ids.tobytes(), (4 * np.flatnonzero(self.closes[ids]) + 4).tolist()
        return [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)] if len(ends) == len(words) else self.library(words)

    def words_of(self, unit: str) -> list[str]:
        """The pre-tokens of a unit of Latin letters; mostly it is one word, with a mark after it or not."""
        lowered = unit.lower() if unit.isascii() else unicodedata.normalize("NFC", unit).lower()
        if lowered.isalpha():
            return [lowered]
        if lowered[-1] in ".,;:!?" and lowered[:-1].isalpha():
            return [lowered[:-1], lowered[-1]]
        return self.SPLIT.findall(lowered)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        with no_cycle_search():
            return [ids for group in groups_of(texts) for ids in self._encode(group)]

    def _encode(self, texts: list[str]) -> list[bytes]:
        places = Places([self.split(t) for t in texts])
        ids, begin = places.joined(self.units.of(places.distinct, self.ids_of))
        return [bytes(ids[a:b]) for a, b in pairwise(begin.tolist())]

    def ids_of(self, units: list[str]) -> list[bytes]:
        """Ids of units that are not known yet."""
        plain, other, words = {}, [], {}
        for unit in units:
            if unit.isascii() and unit.isalpha():
                words[unit.lower()] = None
            elif "<|" not in unit and "İ" not in unit and self.PLAIN.fullmatch(unit):
                plain[unit] = found = self.words_of(unit)
                words.update(dict.fromkeys(found))
            else:
                other.append(unit)
        names = list(words)
        word = dict(zip(names, self.words.of(names, self.merged))).__getitem__
        rest = dict(zip(other, self.library(other) if other else []))
        return [
            b"".join(map(word, plain[u])) if u in plain else rest[u] if u in rest else word(u.lower())
            for u in units
        ]


def token_pieces(df: DataFrame, key: str, text: str, path: str, capacity: int = CAPACITY, end: int = 0) -> DataFrame:
    """The pieces of every row's ids: (``key``, piece, start, length, ids_crc32).

    A null text counts as an empty one. The ids are closed by ``end``, so every row has a piece. Only
    rows of more than ``capacity`` ids are cut.
    """
    small_batches(df.sparkSession)
    close = end.to_bytes(4, "little")

    def batches(parts):
        encoder = kept_in_worker(f"words {path}", lambda: WordEncoder(path))
        for batch in parts:
            rows, numbers, starts, lengths, sums = [], [], [], [], []
            for row, ids in enumerate(encoder.encode([t or "" for t in batch.column(1).to_pylist()])):
                ids += close
                count = len(ids) // 4
                for number, start in enumerate(range(0, count, capacity)):
                    piece = ids[4 * start : 4 * (start + capacity)]
                    rows.append(row)
                    numbers.append(number)
                    starts.append(start)
                    lengths.append(len(piece) // 4)
                    sums.append(zlib.crc32(piece))
            longs = [pa.array(x, pa.int64()) for x in (starts, lengths, sums)]
            columns = [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(numbers, pa.int32()), *longs]
            yield pa.RecordBatch.from_arrays(columns, names=[key, "piece", "start", "length", "ids_crc32"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text).mapInArrow(batches, f"`{key}` {kind}, piece int, start long, length long, ids_crc32 long")


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    pieces = written(with_row_id(token_pieces(docs, "doc_id", "text", path, capacity)), "pieces")
    packed = pack(pieces, capacity)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "certified")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most ``CAPACITY`` tokens."""
    import public_tokenizers

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
