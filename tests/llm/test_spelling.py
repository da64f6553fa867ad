"""Spelling variants against a comparison of all pairs."""

import random
import re
import zlib
from collections import Counter

import pytest

import __spark_entry__ as contract
from compare import DATA
from tidemark.llm import spelling

DOCS = "doc_id long, text string, word string, n string"


def counted(rows, every=199):
    found = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 6}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(words, near):
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * n else None
    rows = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(rows)


def all_pairs(words):
    return {w: {v for v in words if one_edit(w, v)} for w in words}


def collected(df):
    return sorted((r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect())


def made_up(seed, count):
    """Words of few letters, so that many are near, with counts far apart."""
    pick = random.Random(seed)
    words = {}
    for _ in range(count):
        word = "".join(pick.choice("abé") for _ in range(pick.randrange(6, 11)))
        words[word] = 5 ** pick.randrange(1, 7)
    return words


@pytest.mark.parametrize("cells, small", [(1 << 14, 4096), (60, 4096), (300, 1), (1 << 14, 1)])
def test_equals_all_pairs(spark, monkeypatch, cells, small):
    """One tile, many tiles, dense tiles and pooled ones."""
    monkeypatch.setattr(spelling, "CELLS", cells)
    monkeypatch.setattr(spelling, "SMALL", small)
    words = made_up(cells, 300) | {"x" * 50: 5, "x" * 51: 25, "x" * 25 + "y" + "x" * 25: 125, "x" * 2000: 7, "x" * 1999 + "y": 9}
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    assert collected(spelling.variants(df)) == brute(words, all_pairs(words))


def test_counts_of_odd_texts(spark):
    rows = [
        (1, "Spelling SPELLING spelling's Éclairs éclairs ÷×÷×÷× naïveté"), (2, None), (3, ""), (None, "spelling spelling"), (3, "12 ..;"),
        (4, "spelling_" * 400 + "İstanbul ſpelling ßtrassen 漢字漢字漢字漢字 \U0001f600abcdefg"), (4, "spelling " * 3),
    ]
    rows += [(k, "spelling variant letters") for k in range(500)]
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], DOCS)
    found = {r["word"]: r["n"] for r in spelling.count_words(df, "doc_id", "text").collect()}
    assert found == counted(rows) and "Éclairs" in found and "éclairs" in found
    assert found["letters"] < 500
    assert spelling.count_words(df.where("false"), "doc_id", "text").collect() == []
    assert collected(spelling.variants(spark.createDataFrame([], "word string, n long"))) == []


def test_very_long_texts_and_runs(spark, monkeypatch):
    monkeypatch.setattr(spelling, "SLICE", 50)
    monkeypatch.setattr(spelling, "FLUSH", 10)
    rows = [(1, "a" * 500 + " bcdefgh" * 100 + "z" * 120), (2, "q" * 49 + "Q rrrrrrr")]
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], DOCS)
    assert {r["word"]: r["n"] for r in spelling.count_words(df, "doc_id", "text").collect()} == counted(rows)


def test_ties_go_to_the_smallest_and_chains_to_the_last(spark):
    words = {"abcdef": 5, "abcdeg": 25, "abcdeé": 25, "abcdegg": 125, "abcdeggg": 625, "zzzzzz": 9}
    found = {r["word"]: (r["form"], r["root"]) for r in spelling.variants(spark.createDataFrame(list(words.items()), "word string, n long")).collect()}
    assert found["abcdef"] == ("abcdeg", "abcdeggg") and found["abcdeggg"] == (None, "abcdeggg") and found["zzzzzz"] == (None, "zzzzzz")


def test_registered_query_equals_deletion_neighbourhoods(spark):
    sf_dir = f"{DATA}/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    words = {w: n for w, n in counted([tuple(r) for r in docs]).items() if n >= 5}
    near, gaps = {w: set() for w in words}, {}
    for w in words:
        for i in range(len(w)):
            gaps.setdefault((i, w[:i] + w[i + 1 :]), set()).add(w)
            if (v := w[:i] + w[i + 1 :]) in words:
                near[w].add(v)
                near[v].add(w)
    for group in gaps.values():
        for w in group:
            near[w] |= group - {w}
    assert collected(contract.queries()["op13_spelling_variants"](spark, sf_dir)) == brute(words, near)
