"""Language identification: script ranges, scores per word, and Viterbi over the words of a text.

A word is a run of letters of one script. The scripts seen in a language's training texts narrow its words'
candidates; a word of a script that no language uses scores nothing for any. A candidate's score is the
mean log probability of the word's character n-grams, times the number of n-grams of one length, under that
language's counts, hashed into ``BUCKETS``. Viterbi then finds the languages of the words that maximise the
sum of scores less ``PENALTY`` for every switch, which labels the spans of a mixed text. The language of a
text is the one with the most letters; the score is its share of the letters.

The counts are fitted on a bounded sample of the labelled texts (about ``SAMPLE`` distinct ones, chosen by hash, an
equal share per language); copies of a text count once. They are ``BUCKETS`` numbers per language whatever the
size of the input.

Defined results: null texts and texts without a letter are ``und`` with score 0; a text whose letters are
all of unknown scripts gets the most frequent language and score 0; ties go to the language that sorts
first; with no labelled rows everything is ``und``, and ``keep_identified`` keeps the texts with a letter all the
same; other columns are left alone.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import BATCH_ROWS, kept_in_worker, small_batches, table
from tidemark.llm.hashing import BASE, INVERSE, mixed, powers

SAMPLE = 20_000
FIT_ROWS = 100
#: Bytes of texts that are taken together, and characters of distinct words whose n-grams are.
GROUP_BYTES = 1 << 21
SLAB_CHARS = 1 << 16
BUCKETS = 1 << 16
ORDERS = (1, 2, 3, 4)
PENALTY = 8.0
SCRIPT_SHARE = 0.001
UNKNOWN = "und"

# First and last code points of the blocks of common scripts.
SCRIPTS = (
    ("latin", ((0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xBA, 0xBA), (0xC0, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF))),
    ("greek", ((0x370, 0x3FF), (0x1F00, 0x1FFF))),
    ("cyrillic", ((0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F))),
    ("armenian", ((0x530, 0x58F),)),
    ("hebrew", ((0x590, 0x5FF),)),
    ("arabic", ((0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF))),
    ("devanagari", ((0x900, 0x97F),)),
    ("bengali", ((0x980, 0x9FF),)),
    ("tamil", ((0xB80, 0xBFF),)),
    ("thai", ((0xE00, 0xE7F),)),
    ("georgian", ((0x10A0, 0x10FF),)),
    ("hangul", ((0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF))),
    ("kana", ((0x3040, 0x30FF), (0x31F0, 0x31FF))),
    ("han", ((0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF))),
)
OTHER = len(SCRIPTS) + 1


def script_table() -> np.ndarray:
    """Script number per code point: 0 for what is no letter, ``OTHER`` for letters of other scripts."""
    letters = np.frombuffer(bytes(chr(c).isalpha() for c in range(0x110000)), np.uint8).astype(bool)
    found = np.where(letters, OTHER, 0).astype(np.uint8)
    for number, (_, blocks) in enumerate(SCRIPTS, 1):
        for first, last in blocks:
            found[first : last + 1][letters[first : last + 1]] = number
    return found


class Words:
    """The words of a batch of texts: where they are, and which are equal."""

    BLOCK = 1 << 19

    def __init__(self, texts: list[str], scripts: np.ndarray):
        starts, ends, owners, hashes, self.codes = [], [], [], [], []
        self.begins = np.zeros(len(texts), np.int64)
        base = 0
        for first, last, joined in self._blocks(texts):
            codes = np.frombuffer(joined.lower().encode("utf-32-le"), np.uint32)
            if len(codes) != len(joined):
                # Lower-casing can lengthen a text; then each character is taken alone.
                lowered = "".join(c if len(c.lower()) != 1 else c.lower() for c in joined)
                codes = np.frombuffer(lowered.encode("utf-32-le"), np.uint32)
            kinds = np.concatenate([[0], scripts[codes], [0]])
            change = kinds[1:] != kinds[:-1]
            start = np.flatnonzero(change & (kinds[1:] > 0))
            end = np.flatnonzero(change & (kinds[:-1] > 0))
            sizes = np.cumsum([len(texts[i]) + 1 for i in range(first, last)])
            self.begins[first:last] = base + np.concatenate([[0], sizes[:-1]])
            values = mixed(codes.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(codes))
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values)])
            hashes.append(mixed((sums[end] - sums[start]) * powers(INVERSE, len(codes) + 1)[start]))
            owners.append(first + np.searchsorted(sizes, start, side="right"))
            starts.append(start + base)
            ends.append(end + base)
            self.codes.append(codes)
            base += len(codes)
        self.codes = np.concatenate(self.codes) if self.codes else np.zeros(0, np.uint32)
        empty = np.zeros(0, np.int64)
        self.start, self.end = (np.concatenate(x) if x else empty for x in (starts, ends))
        self.owner = np.concatenate(owners) if owners else empty
        names = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        _, self.first, self.same = np.unique(names, return_index=True, return_inverse=True)
        self.length = self.end - self.start
        self.script = scripts[self.codes[self.start]]

    def _blocks(self, texts: list[str]):
        """Runs of whole texts, joined by line feeds, of about ``BLOCK`` characters."""
        first = 0
        while first < len(texts):
            last, size = first, 0
            while last < len(texts) and (size < self.BLOCK or last == first):
                size += len(texts[last]) + 1
                last += 1
            yield first, last, "\n".join(texts[first:last])
            first = last

    def slabs(self):
        """(first, last): runs of distinct words of about ``SLAB_CHARS`` characters. The n-grams of all of them at
        once take some hundred times the texts' size."""
        ends = np.cumsum(self.length[self.first] + 2)
        first = 0
        while first < len(ends):
            room = SLAB_CHARS + (ends[first - 1] if first else 0)
            last = max(first + 1, int(np.searchsorted(ends, room, side="right")))
            yield first, last
            first = last

    def features(self, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
        """N-gram buckets of a run of the distinct words, and where each word's begin."""
        chosen = self.first[first:last]
        starts, lengths = self.start[chosen], self.length[chosen]
        # Words one after the other, each between two marks.
        padded = lengths + 2
        begin = np.cumsum(padded) - padded
        text = np.zeros(int(padded.sum()), np.uint64)
        inside = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        text[np.repeat(begin + 1, lengths) + inside] = self.codes[np.repeat(starts, lengths) + inside]
        place = np.arange(len(text)) - np.repeat(begin, padded)
        room = np.repeat(padded, padded) - place
        found, owner = [], []
        index = np.repeat(np.arange(len(padded)), padded)
        for order in ORDERS:
            at = np.flatnonzero(room >= order)
            value = np.full(len(at), order, np.uint64)
            for i in range(order):
                value = mixed(value + text[at + i] * np.uint64(0x9E3779B97F4A7C15))
            found.append((value & np.uint64(BUCKETS - 1)).astype(np.int64))
            owner.append(index[at])
        owners = np.concatenate(owner) if owner else np.zeros(0, np.int64)
        order = np.argsort(owners, kind="stable")
        return np.concatenate(found)[order], np.searchsorted(owners[order], np.arange(len(padded)))


def viterbi(scores: np.ndarray, owner: np.ndarray, penalty: float) -> np.ndarray:
    """The best language of each word. ``owner`` is sorted; a switch within an owner costs ``penalty``.

    All texts advance together, word by word, the longest first, so that those still running are a prefix.
    """
    label = np.zeros(len(owner), np.int64)
    if not len(owner):
        return label
    begin = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    length = np.diff(np.concatenate([begin, [len(owner)]]))
    order = np.argsort(-length, kind="stable")
    begin, length = begin[order], length[order]
    # How many texts have a word number t: lengths are sorted, longest first.
    running = np.searchsorted(-length, -np.arange(1, length[0] + 1), side="right")
    stay = np.zeros(scores.shape, bool)
    came = np.zeros(len(owner), np.int16)
    value = scores[begin].copy()
    for t in range(1, length[0]):
        n = running[t]
        at = begin[:n] + t
        value = value[:n]
        best = value.argmax(1)
        switch = value[np.arange(n), best] - penalty
        keep = value >= switch[:, None]
        stay[at] = keep
        came[at] = best
        value = np.where(keep, value, switch[:, None]) + scores[at]
        ending = np.arange(running[t + 1] if t + 1 < length[0] else 0, n)
        label[at[ending]] = value[ending].argmax(1)
    single = np.arange(running[1] if length[0] > 1 else 0, len(begin))
    label[begin[single]] = scores[begin[single]].argmax(1)
    for t in range(length[0] - 1, 0, -1):
        at = begin[: running[t]] + t
        now = label[at]
        label[at - 1] = np.where(stay[at, now], now, came[at])
    return label


class Model:
    """Log probabilities per bucket and language, and the scripts that each language uses."""

    def __init__(self, languages: list[str], counts: np.ndarray, scripts: np.ndarray, usual: int):
        self.languages, self.usual = languages, usual
        total = counts.sum(0, keepdims=True)
        self.log = np.log((counts + 0.5) / (total + 0.5 * BUCKETS))
        self.uses = scripts >= SCRIPT_SHARE * np.maximum(1, scripts.sum(0, keepdims=True))

    def arrays(self):
        return self.languages, self.log, self.uses, self.usual

    @classmethod
    def of(cls, arrays) -> Model:
        model = cls.__new__(cls)
        model.languages, model.log, model.uses, model.usual = arrays
        return model

    def scores(self, words: Words) -> np.ndarray:
        """A score per word and language."""
        if not len(words.first):
            return np.zeros((0, len(self.languages)))
        each = np.empty((len(words.first), len(self.languages)))
        for first, last in words.slabs():
            buckets, begin = words.features(first, last)
            each[first:last] = np.add.reduceat(self.log[buckets], begin, axis=0) / len(ORDERS)
        uses = self.uses[words.script[words.first]]
        lowest = np.where(uses, each, np.inf).min(1, keepdims=True)
        each = np.where(uses.any(1, keepdims=True), np.where(uses, each, lowest - 20.0), 0.0)
        return each[words.same]

    def spans(self, texts: list[str], scripts: np.ndarray):
        """(words, label per word)."""
        words = Words(texts, scripts)
        return words, viterbi(self.scores(words), words.owner, PENALTY)

    def predict(self, texts: list[str], scripts: np.ndarray) -> tuple[list[str], np.ndarray]:
        words, labels = self.spans(texts, scripts)
        letters = np.zeros((len(texts), len(self.languages)))
        known = self.uses[words.script].any(1)
        np.add.at(letters, (words.owner[known], labels[known]), words.length[known])
        every = np.bincount(words.owner, weights=words.length, minlength=len(texts))
        best = np.where(letters.any(1), letters.argmax(1), self.usual)
        share = letters[np.arange(len(texts)), best] / np.maximum(1, every)
        return [self.languages[b] if e else UNKNOWN for b, e in zip(best, every)], share


def fit(labelled: DataFrame, sample: int = SAMPLE) -> Model | None:
    """A model from rows (lang, text), about ``sample`` distinct ones by a hash of the text; None without rows."""
    small_batches(labelled.sparkSession)
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    # Copies of a text are drawn or left together, so shares are of distinct texts, and a drawn text counts once.
    per_text = rows.groupBy("lang", F.xxhash64("text").alias("hash")).count()
    sizes = per_text.groupBy("lang").agg(F.sum("count").alias("rows"), F.count("*").alias("texts")).collect()
    per_language = {r["lang"]: r["rows"] for r in sizes}
    if not per_language:
        return None
    languages = sorted(per_language)
    # Equal shares of the sample for all languages, as far as they have texts.
    share = {r["lang"]: min(1.0, sample / len(languages) / r["texts"]) for r in sizes}
    chosen = F.create_map(*[F.lit(x) for pair in share.items() for x in pair])[F.col("lang")]
    rows = rows.where(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < chosen * 1_000_000).distinct()

    def count(parts):
        table_of = kept_in_worker("scripts", script_table)
        counts = np.zeros((len(languages), BUCKETS), np.int64)
        scripts = np.zeros((len(languages), OTHER + 1), np.int64)
        place = {k: i for i, k in enumerate(languages)}
        for batch in _few(parts, 1, FIT_ROWS):
            owners = np.array([place[k] for k in batch.column(0).to_pylist()], np.int64)
            words = Words(batch.column(1).to_pylist(), table_of)
            if len(words.owner):
                language = owners[words.owner]
                np.add.at(scripts, (language, words.script), words.length)
                times = [np.bincount(words.same[language == i], minlength=len(words.first)) for i in range(len(languages))]
                for first, last in words.slabs():
                    buckets, begin = words.features(first, last)
                    size = np.diff(np.concatenate([begin, [len(buckets)]]))
                    for i in range(len(languages)):
                        weights = np.repeat(times[i][first:last], size)
                        counts[i] += np.bincount(buckets, weights=weights, minlength=BUCKETS).astype(np.int64)
        for kind, values in ((0, counts), (1, scripts)):
            language, number = np.nonzero(values)
            arrays = [pa.array(np.full(len(number), kind), pa.int32()), pa.array(language, pa.int32()), pa.array(number, pa.int32())]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(values[language, number], pa.int64())], names=["kind", "lang", "number", "n"])

    counted = rows.select("lang", "text").mapInArrow(count, "kind int, lang int, number int, n long")
    sums = counted.groupBy("kind", "lang", "number").agg(F.sum("n").alias("n")).toPandas()
    counts, scripts = np.zeros((BUCKETS, len(languages))), np.zeros((OTHER + 1, len(languages)))
    for kind, into in ((0, counts), (1, scripts)):
        part = sums[sums["kind"] == kind]
        into[part["number"], part["lang"]] = part["n"]
    usual = max(range(len(languages)), key=lambda i: (per_language[languages[i]], -i))
    return Model(languages, counts, scripts, usual)


def _few(parts, text: int, rows: int = BATCH_ROWS):
    """The batches, cut into slices of at most ``rows`` rows and about ``GROUP_BYTES`` of the texts in column number
    ``text``: the words of a slice take many times its size."""
    for batch in parts:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < len(batch):
            room = GROUP_BYTES + (ends[start - 1] if start else 0)
            end = max(start + 1, min(start + rows, int(np.searchsorted(ends, room, side="right"))))
            yield batch.slice(start, end - start)
            start = end


def _in_worker(spark: SparkSession, model: Model) -> Callable[[], tuple[Model, np.ndarray]]:
    """A function for tasks that gives the model and the scripts, made once per worker."""
    shared, name = spark.sparkContext.broadcast(model.arrays()), f"languages {uuid.uuid4().hex}"
    return lambda: kept_in_worker(name, lambda: (Model.of(shared.value), script_table()))


def predict(df: DataFrame, key: str, text: str, model: Model | None) -> DataFrame:
    """(``key``, lang_pred, score) per row of ``df``."""
    spark = df.sparkSession
    small_batches(spark)
    if model is None:
        return df.select(key, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    model_of = _in_worker(spark, model)

    def batches(parts):
        own, table_of = model_of()
        for batch in _few(parts, 1):
            names, share = own.predict([t or "" for t in batch.column(1).to_pylist()], table_of)
            columns = [batch.column(0), pa.array(names, pa.string()), pa.array(share, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[key, "lang_pred", "score"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text).mapInArrow(batches, f"`{key}` {kind}, lang_pred string, score double")


def keep_identified(df: DataFrame, text: str, model: Model | None) -> DataFrame:
    """The rows of ``df`` whose text has a language; without a model, those whose text has a letter."""
    small_batches(df.sparkSession)
    place = df.columns.index(text)
    if model is None:

        def lettered(parts):
            for batch in parts:
                yield batch.filter(pa.array([any(map(str.isalpha, t or "")) for t in batch.column(place).to_pylist()], pa.bool_()))

        return df.mapInArrow(lettered, df.schema)
    model_of = _in_worker(df.sparkSession, model)

    def batches(parts):
        own, table_of = model_of()
        for batch in _few(parts, place):
            names, _ = own.predict([t or "" for t in batch.column(place).to_pylist()], table_of)
            yield batch.filter(pa.array([n != UNKNOWN for n in names], pa.bool_()))

    return df.mapInArrow(batches, df.schema)


def label_spans(df: DataFrame, key: str, text: str, model: Model) -> DataFrame:
    """(``key``, start, end, lang): spans of equal language in code points, from a first word to a last one."""
    small_batches(df.sparkSession)
    model_of = _in_worker(df.sparkSession, model)

    def batches(parts):
        own, table_of = model_of()
        for batch in _few(parts, 1):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            words, labels = own.spans(texts, table_of)
            if len(labels):
                new = np.concatenate([[True], (words.owner[1:] != words.owner[:-1]) | (labels[1:] != labels[:-1])])
                first = np.flatnonzero(new)
                last = np.concatenate([first[1:], [len(new)]]) - 1
                owner = words.owner[first]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(owner)), pa.array(words.start[first] - words.begins[owner], pa.int64()),
                        pa.array(words.end[last] - words.begins[owner], pa.int64()), pa.array([own.languages[i] for i in labels[first]]),
                    ],
                    names=[key, "start", "end", "lang"],
                )

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text).mapInArrow(batches, f"`{key}` {kind}, start long, end long, lang string")


def held_out(key: str) -> Column:
    """Whether a row is kept from training; a null key is not, and is not trained on either."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learned(docs: DataFrame) -> Model | None:
    """A model of the documents that are not held out."""
    return fit(docs.where(~held_out("doc_id") & F.col("doc_id").isNotNull()).select("lang", "text"))


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score), learned from the rows that are not held out."""
    found = predict(docs, "doc_id", "text", learned(docs))
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    return identify(table(spark, sf_dir, "documents"))
