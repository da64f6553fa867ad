"""Byte-level BPE through sentencepiece: the model is written directly from the ranks, never trained.

Every vocabulary entry becomes a piece: its bytes are mapped one by one to printable characters (the map
below), its score is its negative rank, its id its rank. Normalisation is the identity, so the library
merges exactly the pairs that the ranks ask for, lowest rank first, leftmost among equals. Texts are cut
by the pattern; each distinct pre-token is encoded once per batch. A pre-token that is itself an entry is
that entry. Decoding maps ids back to pieces and pieces to bytes.

Defined results: a null text counts as an empty one (0 ids); strings that look like special tokens are
ordinary text; repeated rows give repeated results; other columns of the input are left alone.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from array import array
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import CHUNKS, Cache, Places, groups_of, kept_in_worker, no_cycle_search, small_batches, table, taken

VOCABULARY = "byte_bpe_50k.tiktoken"


def read_ranks(path: str) -> list[bytes]:
    """Vocabulary entries by rank; ranks must be 0 to n-1."""
    with open(path, "rb") as file:
        pairs = [line.split() for line in file if line.strip()]
    entries: list[bytes] = [b""] * len(pairs)
    for entry, rank in pairs:
        entries[int(rank)] = base64.b64decode(entry)
    if not all(entries):
        raise ValueError(f"{path}: ranks are not 0 to {len(pairs) - 1}")
    return entries


#: Byte to character: U+0100 to U+01FF. None is white space, a control or sentencepiece's own space mark.
def to_characters(raw: bytes) -> str:
    return raw.decode("latin-1").translate({b: b + 0x100 for b in range(256)})


_CHARACTERS = {b: b + 0x100 for b in range(256)}


def _varint(value: int) -> bytes:
    out = bytearray()
    while True:
        value, low = value >> 7, value & 127
        out.append(low | (128 if value else 0))
        if not value:
            return bytes(out)


def _field(number: int, value) -> bytes:
    """A protobuf field: bytes and text by length, floats as four bytes, integers and booleans as varints."""
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    raw = value.encode() if isinstance(value, str) else value
    return _varint(number << 3 | 2) + _varint(len(raw)) + raw


def serialise_model(entries: list[bytes]) -> bytes:
    """A sentencepiece BPE model of ``entries``; the piece after the last one is the unknown piece, never used."""
    # Field numbers and enum values of sentencepiece's published model format.
    piece, score, kind = 1, 2, 3
    normal, unknown, bpe = 1, 2, 2
    pieces = [_field(piece, to_characters(e)) + _field(score, float(-rank)) + _field(kind, normal) for rank, e in enumerate(entries)]
    pieces.append(_field(piece, "<unk>") + _field(score, 0.0) + _field(kind, unknown))
    trainer = _field(3, bpe) + _field(4, len(pieces)) + _field(40, len(entries))
    normalizer = _field(1, "identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(_field(1, p) for p in pieces) + _field(2, trainer) + _field(3, normalizer)


class Codec:
    """Encodes and decodes in one Python worker."""

    def __init__(self, model: bytes, entries: list[bytes], pattern: str, bound: int = 500_000):
        from sentencepiece import SentencePieceProcessor

        self.processor = SentencePieceProcessor(model_proto=model)
        self.entries, self.ranks = entries, {e: i for i, e in enumerate(entries)}
        self.split = regex.compile(pattern)
        self.known = Cache(bound)
        self.packed = [struct.pack("=I", i) for i in range(len(entries))]
        self.bytes_of = pa.array(entries, pa.large_binary())
        self.decimal = pa.array([b"%d " % i for i in range(len(entries))], pa.large_binary())

    #: A chunk of this form is one pre-token.
    WORD = re.compile(" ?[A-Za-z]+")

    def encode_chunks(self, chunks: list[str]) -> list[bytes]:
        """Ids per chunk, as unsigned 32-bit numbers: pre-token by pre-token."""
        word = self.WORD.fullmatch
        parts = [[c.encode()] if word(c) else [p.encode() for p in self.split.findall(c)] for c in chunks]
        ids: dict[bytes, bytes] = {}
        merge = []
        for pre in parts:
            for p in pre:
                if p not in ids:
                    whole = self.ranks.get(p)
                    ids[p] = b"" if whole is None else self.packed[whole]
                    if whole is None:
                        merge.append(p)
        if merge:
            mapped = [p.decode("latin-1").translate(_CHARACTERS) for p in merge]
            found = self.processor.encode(mapped, out_type=int, num_threads=1)
            ids.update((p, array("I", i).tobytes()) for p, i in zip(merge, found))
        return [ids[pre[0]] if len(pre) == 1 else b"".join([ids[p] for p in pre]) for pre in parts]

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(b"".join(self.encode_chunks(CHUNKS.findall(text))), np.uint32).tolist()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.entries[i] for i in ids])

    def look_up(self, texts: list[str]) -> Iterator[tuple[int, memoryview, memoryview]]:
        """Per text: the number of its ids, the ids in decimal with a blank after each, the bytes decoded from the ids."""
        for group in groups_of(texts):
            with no_cycle_search():
                places = Places([CHUNKS.findall(t) for t in group])
                ids, begin = places.joined(self.known.of(places.distinct, self.encode_chunks))
                numbers, begin = pa.array(np.frombuffer(ids, np.uint32)), begin // 4
                told, of_told = taken(self.decimal, numbers, begin)
                raw, of_raw = taken(self.bytes_of, numbers, begin)
            for count, (a, b), (c, d) in zip(np.diff(begin).tolist(), pairwise(of_told.tolist()), pairwise(of_raw.tolist())):
                yield count, told[a:b], raw[c:d]


def encode_documents(df: DataFrame, key: str, text: str, path: str, pattern: str) -> DataFrame:
    """(``key``, ids, decoded) per row of ``df``: the ids, and the bytes that they decode to."""
    small_batches(df.sparkSession)
    shared = _broadcast(df.sparkSession, path)

    def batches(parts):
        codec = kept_in_worker(f"codec {path} {pattern}", lambda: Codec(*shared.value, pattern))
        for batch in parts:
            ids = [codec.encode(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(map(codec.decode, ids), pa.binary())],
                names=[key, "ids", "decoded"],
            )

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text).mapInArrow(batches, f"`{key}` {kind}, ids array<int>, decoded binary")


def digest_documents(df: DataFrame, key: str, text: str, path: str, pattern: str) -> DataFrame:
    """As ``encode_documents``, with digests in place of the ids and the bytes."""
    small_batches(df.sparkSession)
    shared = _broadcast(df.sparkSession, path)

    def batches(parts):
        codec = kept_in_worker(f"codec {path} {pattern}", lambda: Codec(*shared.value, pattern))
        for batch in parts:
            counts, digests, decoded = [], [], []
            for count, ids, raw in codec.look_up([t or "" for t in batch.column(1).to_pylist()]):
                counts.append(count)
                digests.append(hashlib.sha256(ids[:-1]).hexdigest())
                decoded.append(hashlib.sha256(raw).hexdigest())
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[key, "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = df.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return df.select(key, text).mapInArrow(batches, schema)


def _broadcast(spark: SparkSession, path: str):
    """The model and its entries; bounded by the vocabulary file."""
    entries = read_ranks(path)
    return spark.sparkContext.broadcast((serialise_model(entries), entries))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again, as digests."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return digest_documents(docs, "doc_id", "text", public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
