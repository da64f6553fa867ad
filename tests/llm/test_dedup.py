"""Near-duplicates and repeated strings against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import components, hashing, minhash, suffix_dedup
from tidemark.llm.common import with_row_id, written

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def word_sets(text, words):
    found = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    if not found:
        return frozenset()
    width = min(words, len(found))
    return frozenset(tuple(found[i : i + width]) for i in range(len(found) - width + 1))


def by_brute_force(rows, words, percent):
    """{row: component} by comparing all pairs."""
    sets = [word_sets(t, words) for _, t in rows]
    root = list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                root[find(a)] = find(b)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(least.get(find(i), key), key)
    return [(key, len(sets[i]), least.get(find(i)) if sets[i] else key) for i, (key, _) in enumerate(rows)]


def near_copies(seed, groups, copies, length, edits):
    r = random.Random(seed)
    rows = []
    for _ in range(groups):
        base = [f"w{r.randrange(200)}" for _ in range(length)]
        for _ in range(copies):
            own = list(base)
            for _ in range(r.randrange(edits + 1)):
                own[r.randrange(length)] = f"x{r.randrange(10_000)}"
            rows.append(" ".join(own))
    r.shuffle(rows)
    return list(enumerate(rows))


def found_by(spark, rows, words, percent):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = minhash.near_duplicates(written(with_row_id(df), "documents"), words, percent).collect()
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found), key=str), found


@pytest.mark.parametrize(("words", "percent"), [(3, 85), (5, 80)])
def test_components_equal_all_pairs(spark, words, percent):
    rows = near_copies(words, 6, 25, 60, 4)
    extra = [
        (1000, None), (1001, ""), (1002, " \t\n"), (1003, "one"), (1004, "ONE"), (1005, "one two"), (1006, "One\x0bTwo"),
        (1007, "a b c d e f"), (1007, "a b c d e f"), (None, "a b c d e f"), (None, "q r s t u v w"), (1008, "É a b"), (1009, "é a b"), (1010, "ab c"), (1011, "a bc"),
    ]
    found, rows_found = found_by(spark, rows + extra, words, percent)
    assert found == sorted(by_brute_force(rows + extra, words, percent), key=str)
    firsts = defaultdict(set)
    for r in rows_found:
        if r["n_shingles"]:
            firsts[r["first_row"]].add(r["row_id"])
    assert all(first in members for first, members in firsts.items())


def test_large_buckets_lose_no_link(spark, monkeypatch):
    """Blocks of a few members: links between blocks are found in the second pass."""
    monkeypatch.setattr(minhash, "BLOCK_MEMBERS", 7)
    rows = near_copies(9, 2, 70, 50, 5)
    found, _ = found_by(spark, rows, 3, 85)
    assert found == sorted(by_brute_force(rows, 3, 85), key=str)


def test_near_duplicates_of_nothing(spark):
    empty = spark.createDataFrame([], "row_id long, doc_id long, text string")
    assert minhash.near_duplicates(empty).count() == 0
    assert found_by(spark, [(1, None), (2, "")], 3, 85)[0] == [(1, 0, 1), (2, 0, 2)]


def test_bands_miss_hardly_a_pair():
    for similarity in (0.8, 0.85):
        rows = minhash.rows_per_band(similarity)
        assert (1 - similarity**rows) ** (minhash.VALUES // rows) <= minhash.MISS


def test_signatures_estimate_similarity():
    r = np.random.default_rng(2)
    signer, errors = minhash.Signer(0.8), []
    for _ in range(40):
        every = r.integers(0, 2**64, 400, dtype=np.uint64)
        a, b = np.unique(every[:300]), np.unique(every[100:])
        first, second = signer.signatures([a, b])
        errors.append((first == second).mean() - 0.5)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(100, 100), (130, 101)]
    found = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    expected = {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 131)}}
    assert {r["node"]: r["root"] for r in found} == expected and len(found) == len(expected)
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_word_hashes_do_not_depend_on_blocks(monkeypatch):
    text = ("some words of a text, " * 500).encode()
    whole = hashing.word_hashes(text)
    monkeypatch.setattr(hashing, "BLOCK", 64)
    assert (hashing.word_hashes(text) == whole).all() and len(np.unique(whole)) == 5


def repeats(texts, length):
    starts = defaultdict(list)
    for d, text in enumerate(texts):
        for p in range(len(text) - length + 1):
            starts[text[p : p + length]].append((d, p))
    gone = [np.zeros(len(t), bool) for t in texts]
    for places in starts.values():
        if len(places) > 1:
            for d, p in places:
                gone[d][p : p + length] = True
    return gone


@pytest.mark.parametrize(("length", "shard"), [(40, 1500), (200, 5000), (200, 8 << 20)])
def test_repeated_strings_go_byte_for_byte(spark, monkeypatch, length, shard):
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", shard)
    monkeypatch.setattr(suffix_dedup, "PARSE_BYTES", shard // 3)
    r = random.Random(length)
    base = ["".join(r.choice("ab cdé") for _ in range(length * 3)) for _ in range(6)]
    texts = ["a" * length * 5, "ab" * length * 2, "", None, "x" * (length - 1), "y" * length, "y" * length, base[0], base[0], base[1][:length], base[1]]
    for _ in range(50):
        text = ""
        for _ in range(r.randrange(1, 6)):
            b = r.choice(base)
            i = r.randrange(len(b))
            text += b[i : i + r.randrange(1, length * 2)]
            text += "".join(r.choice("abcdefgh") for _ in range(r.randrange(length))) if r.random() < 0.5 else ""
            text += "a" * r.randrange(3 * length) if r.random() < 0.1 else ""
        texts.append(text)
    df = spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)], "shard long, text string, rows string").repartition(3)
    found = suffix_dedup.remove_repeats(df, length=length).collect()
    assert len(found) == len(texts)
    raw = [(t or "").encode() for t in texts]
    gone = repeats(raw, length)
    for row in found:
        i = row["row"]["shard"]
        spans = int(gone[i][:1].sum() + (gone[i][1:] & ~gone[i][:-1]).sum())
        kept = np.frombuffer(raw[i], np.uint8)[~gone[i]].tobytes()
        assert (bytes(row["kept"]), row["n_bytes"], row["n_removed"], row["n_spans"]) == (kept, len(raw[i]), int(gone[i].sum()), spans)


def test_repeats_as_text_and_of_nothing(spark):
    half = "é" * 101
    rows = [(1, "x" + half), (2, "y" + half)]
    found = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), as_text=True).collect()
    assert {r["row"]["doc_id"]: r["kept"] for r in found} == {1: "x", 2: "y"}
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_suffix_order_is_sorted_with_common_prefixes():
    r = np.random.default_rng(4)
    name = r.integers(1, 4, 60).astype(np.uint64)
    is_end = np.zeros(60, bool)
    is_end[[20, 59]] = True
    order, shared = suffix_dedup.suffix_order(name, is_end, 64)
    suffixes = [tuple(name[i:].tolist()) for i in order]
    assert sorted(suffixes) == suffixes and len(order) == 58
    for a, b, n in zip(suffixes, suffixes[1:], shared[1:]):
        assert a[:n] == b[:n] and (len(a) <= n or len(b) <= n or a[n] != b[n])


def test_query_digests(spark):
    found = suffix_dedup.op3_suffix_dedup(spark, "/root/testdata/sf0.001")
    docs = {r["doc_id"]: (r["text"] or "").encode() for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    gone = dict(zip(docs, repeats(list(docs.values()), 200)))
    for row in found.collect():
        kept = np.frombuffer(docs[row["doc_id"]], np.uint8)[~gone[row["doc_id"]]].tobytes()
        assert row["kept_sha256"] == hashlib.sha256(kept).hexdigest() and row["n_removed"] == int(gone[row["doc_id"]].sum())
    kept = minhash.op7_minhash_dedup(spark, "/root/testdata/sf0.001")
    rows = [(k, v.decode()) for k, v in docs.items()]
    expected = sorted((k, n, c, k == c) for k, n, c in by_brute_force(rows, 3, 85))
    assert sorted(map(tuple, kept.select("doc_id", "n_shingles", "component_id", "kept").collect())) == expected
    assert kept.where(F.col("kept")).count() < len(docs)
