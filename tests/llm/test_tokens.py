"""Token operators against the libraries, and packing against its own rules."""

import hashlib
import zlib
from itertools import pairwise

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import tiktoken

from tidemark.llm import byte_bpe, common, packing, token_counts
from tidemark.llm.common import Cache, Places, groups_of, kept_in_worker, with_row_id, written

ODD = [
    None, "", " ", "  a\n\n b  \t\tc ", "x<|endoftext|>y  <|endoftext|>", "<|startoftext|>", "can't WE'LL don''s", "12三 日本語　é́ ​",
    "x\x1cy\x85z", "a" * 5000, " \n \n", "\n b", "½² ٣ ﬁ ŉ ǅ İstanbul ΣΑΣ ß Å K ſ", "word, Word. ,, É. A. 1. x1.", "same", "same",
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, i, "x") for i, t in enumerate(ODD)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens long, piece string").repartition(3)


@pytest.fixture(scope="module")
def some(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")


def texts_of(df):
    return {r["doc_id"]: r["text"] or "" for r in df.select("doc_id", "text").collect()}


def test_counts_agree_with_the_library(odd, some):
    path = public_tokenizers.path(token_counts.VOCABULARY)
    tokenizer = token_counts.load_tokenizer(path)
    for df in (odd, some):
        texts = texts_of(df)
        found = token_counts.count_tokens(df, "doc_id", "text", path, public_tokenizers.PATTERN).collect()
        assert len(found) == len(texts)
        for row in found:
            text = texts[row["doc_id"]]
            expected = len(tokenizer.encode(text, add_special_tokens=False).ids)
            assert (row["n_bytes"], row["n_tokens"]) == (len(text.encode()), expected)


def test_whole_tokens_encode_alone_as_one():
    path = public_tokenizers.path(token_counts.VOCABULARY)
    whole = token_counts.whole_tokens(path, public_tokenizers.PATTERN)
    tokenizer = token_counts.load_tokenizer(path)
    assert len(whole) > 40_000
    assert all(len(tokenizer.encode(t, add_special_tokens=False).ids) == 1 for t in sorted(whole)[::97])


def test_cache_stays_bounded_and_right():
    path = public_tokenizers.path(token_counts.VOCABULARY)
    counter = token_counts.Counter(path, public_tokenizers.PATTERN, frozenset(), bound=50)
    tokenizer = token_counts.load_tokenizer(path)
    for start in range(0, 400, 20):
        texts = [f"w{start} q{i} common" for i in range(start, start + 20)]
        assert counter.count(texts) == [len(e.ids) for e in tokenizer.encode_batch(texts)]
        assert len(counter.known) <= 100


def test_encoding_agrees_with_tiktoken_and_decodes(odd, some):
    path = public_tokenizers.path(byte_bpe.VOCABULARY)
    entries = byte_bpe.read_ranks(path)
    ranks = {e: i for i, e in enumerate(entries)}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for df in (odd, some):
        texts = texts_of(df)
        full = byte_bpe.encode_documents(df, "doc_id", "text", path, public_tokenizers.PATTERN).collect()
        short = {r["doc_id"]: r for r in byte_bpe.digest_documents(df, "doc_id", "text", path, public_tokenizers.PATTERN).collect()}
        assert len(full) == len(short) == len(texts)
        for row in full:
            text = texts[row["doc_id"]]
            ids = own.encode_ordinary(text)
            assert row["ids"] == ids and bytes(row["decoded"]) == text.encode()
            digest = short[row["doc_id"]]
            assert digest["n_tokens"] == len(ids)
            assert digest["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
            assert digest["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_pieces_agree_with_the_library(odd, some):
    path = public_tokenizers.path(packing.VOCABULARY)
    tokenizer = packing.load_tokenizer(path)
    for df in (odd, some):
        texts = texts_of(df)
        rows = packing.token_pieces(df, "doc_id", "text", path, capacity=100).collect()
        found = {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in rows}
        expected = {}
        for key, text in texts.items():
            ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 0], "<u4")
            for start in range(0, len(ids), 100):
                piece = ids[start : start + 100]
                expected[key, start // 100] = (start, len(piece), zlib.crc32(piece.tobytes()))
        assert found == expected and len(rows) == len(expected)


def check_packing(frame: pd.DataFrame, capacity: int):
    for _, group in frame.sort_values("offset").groupby("sequence_id"):
        lengths = group["length"].to_numpy()
        assert lengths.sum() <= capacity
        assert (group["offset"].to_numpy() == np.cumsum(lengths) - lengths).all()


@pytest.mark.parametrize("rows_per_task", [40, 100_000])
def test_packing_is_whole_gapless_and_near_the_bound(spark, rows_per_task):
    random = np.random.default_rng(3)
    lengths = np.concatenate([random.integers(1, 65, 300), np.full(100, 40), np.full(30, 64), random.integers(1, 6, 200)])
    df = spark.createDataFrame([(i, int(n), "a", 5) for i, n in enumerate(lengths)], "row_id long, length long, tag string, sequence_id int")
    df = written(df.repartition(5), "lengths")
    frame = packing.pack(df, capacity=64, rows_per_task=rows_per_task).toPandas()
    assert sorted(frame["row_id"]) == list(range(len(lengths))) and (frame["tag"] == "a").all()
    check_packing(frame, 64)
    bound = packing.lower_bound(lengths, 64)
    # Forty rows to a task leave gaps that no exchange among so few can close.
    assert bound <= frame["sequence_id"].nunique() <= bound * (1.05 if rows_per_task == 40 else 1) + 1


def test_lower_bound_holds_and_sees_more_than_the_sum():
    assert packing.lower_bound(np.array([], np.int64), 10) == 0
    assert packing.lower_bound(np.array([6, 6, 6]), 10) == 3
    assert packing.lower_bound(np.array([4, 4, 4, 4]), 10) == 2
    random = np.random.default_rng(1)
    for _ in range(100):
        lengths = random.integers(1, 21, random.integers(1, 30))
        assert packing.lower_bound(lengths, 20) <= packing.best_fit_decreasing(lengths, 20).max() + 1


def test_a_worse_packing_never_replaces_the_old_one():
    rows = pd.DataFrame({"row_id": range(6), "length": [5, 5, 4, 3, 3, 10], "sequence_id": [7, 7, 8, 8, 8, 9]})
    packed = packing.pack_rows(rows.assign(offset=0, certified=False, released=True), 10, 0)
    assert packed["sequence_id"].nunique() == 3 and packed["certified"].all()


def test_bad_lengths_fail_and_empty_tables_do_not(spark):
    shape = "row_id long, length long"
    assert packing.pack(spark.createDataFrame([], shape)).count() == 0
    for wrong in (0, 3000, None):
        with pytest.raises(Exception, match="a length is not from"):
            packing.pack(spark.createDataFrame([(1, wrong)], shape)).count()


def test_documents_without_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    counts = public_tokenizers.path(token_counts.VOCABULARY)
    ranks = public_tokenizers.path(byte_bpe.VOCABULARY)
    assert token_counts.count_tokens(empty, "doc_id", "text", counts, public_tokenizers.PATTERN).count() == 0
    assert byte_bpe.encode_documents(empty, "doc_id", "text", ranks, public_tokenizers.PATTERN).count() == 0
    assert packing.pack_documents(empty, public_tokenizers.path(packing.VOCABULARY)).count() == 0


def test_repeated_documents_are_packed_each(spark):
    rows = [(1, "one two three")] * 5
    packed = packing.pack_documents(spark.createDataFrame(rows, "doc_id long, text string"), public_tokenizers.path(packing.VOCABULARY), 8)
    frame = packed.toPandas()
    assert len(frame) == 5 and frame["sequence_id"].nunique() == 3
    check_packing(frame, 8)
    assert with_row_id(packed).columns[-1] == "row_id"


def test_caches_give_values_in_order_and_make_each_once():
    cache, made = Cache(4), []

    def make(new):
        made.extend(new)
        return [w.upper().encode() for w in new]

    assert cache.of(["a", "b", "c"], make) == [b"A", b"B", b"C"]
    assert cache.of(["d", "b", "e"], make) == [b"D", b"B", b"E"]
    assert made == ["a", "b", "c", "d", "e"] and set(cache) == {"b", "d", "e"}


def test_a_worker_keeps_one_operators_caches():
    with_cache = kept_in_worker("one", dict)
    assert kept_in_worker("one", dict) is with_cache
    kept_in_worker("two", dict)
    assert kept_in_worker("one", dict) is not with_cache


@pytest.mark.parametrize("lists", [[], [[]], [[], ["a"], [], ["b", "a", "\U0001f600"], [""]], [[""], [""]]])
def test_strings_of_lists_are_joined_by_place(lists):
    places = Places(lists)
    raw, begin = places.joined([w.encode() * 2 for w in places.distinct])
    assert len(places.distinct) == len({w for words in lists for w in words})
    assert [bytes(raw[a:b]) for a, b in pairwise(begin.tolist())] == [b"".join(w.encode() * 2 for w in words) for words in lists]


def test_texts_fall_into_groups_without_loss(monkeypatch):
    monkeypatch.setattr(common, "GROUP_CHARS", 4)
    texts = ["", "abcdefgh", "a", "bcd", "", "e"]
    assert [t for group in groups_of(texts) for t in group] == texts
    assert list(groups_of(texts)) == [["", "abcdefgh"], ["a", "bcd"], ["", "e"]]
