"""Token counts by the whole-token shortcut.

Offline, on the driver, every vocabulary string is tried: one that is a pre-token by itself and that the
library encodes as one token is *whole*. The set is bounded by the vocabulary and is broadcast. In the
tasks a text falls into pre-tokens; whole ones count 1 by a look-up, and only the rest is merged, each
distinct one once per batch.

Defined results: a null text counts as an empty one (0 bytes, 0 tokens); special strings inside a text
are one token each, as the library does by default; repeated rows give repeated results; other columns
of the input are left alone and may have any names.
"""

from __future__ import annotations

import os
import re

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import CHUNKS, Cache, kept_in_worker, small_batches, table

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 512


def load_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def whole_tokens(path: str, pattern: str) -> frozenset[str]:
    """The vocabulary strings proven to be one pre-token that encodes alone as one token."""
    tokenizer = load_tokenizer(path)
    special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    split = regex.compile(pattern)
    ids = sorted(tokenizer.get_vocab().values())
    texts = tokenizer.decode_batch([[i] for i in ids], skip_special_tokens=False)
    tried = [(i, t) for i, t in zip(ids, texts) if t and t not in special and split.findall(t) == [t]]
    found = tokenizer.encode_batch([t for _, t in tried], add_special_tokens=False)
    return frozenset(t for (i, t), e in zip(tried, found) if e.ids == [i])


class Counter:
    """Counts tokens of texts in one Python worker."""

    def __init__(self, path: str, pattern: str, whole: frozenset[str], bound: int = 400_000):
        self.tokenizer, self.whole, self.split = load_tokenizer(path), whole, regex.compile(pattern)
        special = sorted((t.content for t in self.tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.known = Cache(bound)

    def chunks(self, text: str) -> tuple[list[str], int]:
        """The chunks of a text, and how many special strings stood between them."""
        parts = self.special.split(text) if self.special and self.special.search(text) else [text]
        return [c for part in parts for c in CHUNKS.findall(part)], len(parts) - 1

    def count(self, texts: list[str]) -> list[int]:
        parts = [self.chunks(t) for t in texts]
        fresh = set()
        for chunks, _ in parts:
            fresh.update(chunks)
        self.learn(self.known.missing(fresh))
        tokens = self.known.__getitem__
        return [sum(map(tokens, chunks)) + specials for chunks, specials in parts]

    def learn(self, fresh: list[str]) -> None:
        """Counts for chunks: whole pre-tokens are 1, others are merged by the library."""
        rest: dict[str, int] = {}
        mixed = []
        for chunk in fresh:
            if chunk in self.whole:
                self.known[chunk] = 1
            else:
                pre = self.split.findall(chunk)
                mixed.append((chunk, pre))
                rest.update((p, 0) for p in pre if p not in self.whole)
        if rest:
            for p, e in zip(rest, self.tokenizer.encode_batch_fast(list(rest), add_special_tokens=False)):
                rest[p] = len(e)
        for chunk, pre in mixed:
            self.known[chunk] = sum(rest.get(p, 1) for p in pre)


def count_tokens(df: DataFrame, key: str, text: str, path: str, pattern: str) -> DataFrame:
    """(``key``, n_bytes, n_tokens) per row of ``df``."""
    small_batches(df.sparkSession)
    whole = df.sparkSession.sparkContext.broadcast(whole_tokens(path, pattern))

    def batches(parts):
        counter = kept_in_worker(f"counts {path} {pattern}", lambda: Counter(path, pattern, whole.value))
        for batch in parts:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            sizes = [len(t.encode()) for t in texts]
            counts = counter.count(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())],
                names=[key, "n_bytes", "n_tokens"],
            )

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text).mapInArrow(batches, f"`{key}` {kind}, n_bytes long, n_tokens long")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, and whether they exceed ``LIMIT``."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    counts = count_tokens(docs, "doc_id", "text", public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    return counts.withColumn("over_limit", F.col("n_tokens") > LIMIT)
