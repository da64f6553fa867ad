"""Chat formatting: speakers of a transcript recovered by a hidden Markov model, turns rendered canonically.

A row of a conversation is a piece of transcript. Lines that begin with a speaker marker ("User:", "AI:",
"### System") open a turn, as does every row; a turn is the lines from one opening to the next. The hidden
state of a line is the role of its speaker. It can change where a turn opens, and stays otherwise, so the
lines of a turn are scored together: each role's log probabilities of the marker, of the lines' features
(length, ending, list or code marks) and of the turn's size. Viterbi over the turns of a conversation finds
the roles. Counts are fitted on a bounded sample of rows with a known role: the ``SAMPLE`` rows whose
conversations hash lowest. Before any marker is seen, one is taken to name its speaker: the role whose name is
among its group's words gets a share of ``NAMED`` of its turns for it, other roles next to nothing, so that a
marker outweighs transitions and line shapes unless the sample shows it otherwise.

Conversations are sorted by range over the cluster, so one that holds a third of all rows is spread over many
parts. A part sends the driver two small matrices: how the best score passes through its first conversation,
and how it leaves its last one. Combining them in order, forwards and backwards, fixes the state at every
border; each part then traces its own rows. This gives exactly the path of one pass over all rows.

Defined results: rows are ordered by turn, null first, then by a hash of role and text, so repeated rows and
ties have one order; a null text is an empty turn; rows without a conversation id form one conversation;
roles that are given are not used to predict, only to fit; without any given role the result is empty of
roles (null). The control strings of the format are escaped where they occur in a text.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import small_batches, table, written

SAMPLE = 20_000
ROWS_PER_PART = 20_000
NAMED, OTHERWISE = 0.05, 1e-20

# Words by which transcripts name a speaker.
SPEAKERS = (
    ("system", "instructions", "context"),
    ("user", "human", "customer", "question", "q", "me", "student"),
    ("assistant", "ai", "bot", "agent", "answer", "a", "model", "tutor"),
)
_WORDS = "|".join(w for group in SPEAKERS for w in sorted(group, key=len, reverse=True))
MARKER = re.compile(rf"\s*(?:#{{1,4}}\s*|\*\*|\[|<\|?)?({_WORDS})(?:\*\*|\]|\|?>)?\s*(?::|$)(?:\*\*)?\s*", re.IGNORECASE)
_GROUP = {w: i + 1 for i, group in enumerate(SPEAKERS) for w in group}

#: Values per feature: marker, line length, line ending, line beginning, lines of a turn, length of a turn.
SHAPE = (len(SPEAKERS) + 1, 12, 6, 5, 8, 16)
_BEGIN = np.concatenate([[0], np.cumsum(SHAPE)])
ENDINGS = {"?": 1, ".": 2, "!": 3, ":": 4}


def _size(number: int, most: int) -> int:
    return min(most - 1, number.bit_length())


def turns(text: str) -> list[tuple[int, list[str]]]:
    """(marker group or 0, lines) of each turn of a row; the marker itself is taken off."""
    found: list[tuple[int, list[str]]] = []
    for line in text.split("\n"):
        match = MARKER.match(line)
        if match:
            found.append((_GROUP[match[1].lower()], [line[match.end() :]]))
        elif found:
            found[-1][1].append(line)
        else:
            found.append((0, [line]))
    return found


def counts(marker: int, lines: list[str]) -> list[int]:
    """How often each feature value occurs in a turn."""
    out = [0] * int(_BEGIN[-1])
    out[marker] += 1
    for line in lines:
        line = line.strip()
        out[_BEGIN[1] + _size(len(line), SHAPE[1])] += 1
        out[_BEGIN[2] + (ENDINGS.get(line[-1], 0) if line else 5)] += 1
        first = line[:1]
        out[_BEGIN[3] + (0 if not first else 1 if first.isupper() else 2 if first.isdigit() else 3 if first.isalpha() else 4)] += 1
    out[_BEGIN[4] + _size(len(lines), SHAPE[4])] += 1
    out[_BEGIN[5] + _size(sum(map(len, lines)), SHAPE[5])] += 1
    return out


class Model:
    """Log probabilities: of the first role, of a role after a role, of feature values given a role."""

    def __init__(self, roles: list[str], start: np.ndarray, step: np.ndarray, emit: np.ndarray):
        self.roles, self.start, self.step, self.emit = roles, start, step, emit

    @classmethod
    def fitted(cls, rows: list[tuple]) -> Model | None:
        """From (conversation, role, counts per turn) in order."""
        roles = sorted({role for _, role, _ in rows if role is not None})
        if not roles:
            return None
        place, n = {r: i for i, r in enumerate(roles)}, len(roles)
        start, step, emit = np.full(n, 0.1), np.full((n, n), 0.1), np.full((int(_BEGIN[-1]), n), 0.5)
        emit[1 : _BEGIN[1]] = 0.0
        before = last = None
        for conversation, role, each in rows:
            state = place.get(role)
            if state is not None:
                if (conversation,) != before:
                    start[state] += 1
                elif last is not None:
                    step[last, state] += 1
                # A row that holds several turns does not tell whose they are.
                if len(each) == 1:
                    emit[:, state] += each[0]
            before, last = (conversation,), state
        # Shares of each role's turns, so that rare roles get no advantage.
        seen = emit[: _BEGIN[1]].sum(0)
        for group, names in enumerate(SPEAKERS, 1):
            emit[group] += seen * np.where([r.strip().lower() in names for r in roles], NAMED, OTHERWISE)
        for a, b in zip(_BEGIN, _BEGIN[1:]):
            emit[a:b] /= emit[a:b].sum(0)
        return cls(roles, np.log(start / start.sum()), np.log(step / step.sum(1, keepdims=True)), np.log(emit))

    def scores(self, text: str) -> np.ndarray:
        """A row per turn, a column per role."""
        return np.array([counts(*turn) for turn in turns(text)]) @ self.emit

    def arrays(self):
        return self.roles, self.start, self.step, self.emit


def forward(scores: np.ndarray, begin: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Best scores by last state (last axis), from ``begin``: scores by state before the first turn's own."""
    best = begin + scores[0]
    for score in scores[1:]:
        best = (best[..., :, None] + step).max(-2) + score
    return best


def passing(scores: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Best score from each state before the first turn to each state at the last one."""
    return forward(scores, step, step)


def path(scores: np.ndarray, begin: np.ndarray, step: np.ndarray, last: int | None) -> list[int]:
    """The best states, ending in ``last`` if it is given. Ties go to the role that sorts first."""
    best, came = begin + scores[0], []
    for score in scores[1:]:
        options = best[:, None] + step
        came.append(options.argmax(0))
        best = options.max(0) + score
    state = int(best.argmax()) if last is None else last
    states = [state]
    for back in reversed(came):
        states.append(int(back[states[-1]]))
    return states[::-1]


def borders(heads: list[dict], model: Model) -> dict[int, tuple[int | None, int | None]]:
    """The state before each part's first turn and at its last one, where a conversation crosses a border.

    ``heads`` has per part, in order: part, first and last conversation, single (it holds one conversation
    only), through (``passing`` of its first), leaving (``forward`` of its last from the start).
    """
    joined = [i > 0 and heads[i - 1]["last"] == heads[i]["first"] for i in range(len(heads))]
    out, into = [], []
    for i, head in enumerate(heads):
        entering = out[i - 1] if joined[i] else None
        into.append(None if entering is None else (entering[:, None] + head["through"]).max(0))
        out.append(into[i] if joined[i] and head["single"] else head["leaving"])
    states: dict[int, tuple[int | None, int | None]] = {}
    end: list[int | None] = [None] * len(heads)
    entry: list[int | None] = [None] * len(heads)
    for i in range(len(heads) - 1, 0, -1):
        if joined[i]:
            # Where the first conversation of part i ends: fixed by a later part, or free.
            goal = end[i] if heads[i]["single"] and end[i] is not None else int(into[i].argmax())
            end[i - 1] = int((out[i - 1] + heads[i]["through"][:, goal]).argmax())
            entry[i] = end[i - 1]
            if not heads[i]["single"]:
                continue
            end[i] = goal
    for i, head in enumerate(heads):
        states[head["part"]] = (entry[i], end[i])
    return states


_ESCAPED = re.compile(r"<\|(?=im_(?:start|end)\|>)")


def rendered(role: str | None, lines: list[str]) -> str:
    content = _ESCAPED.sub(r"<\\|", "\n".join(lines).strip("\n"))
    return f"<|im_start|>{role or ''}\n{content}<|im_end|>\n"


def _fit(rows: DataFrame) -> Model | None:
    def features(parts):
        for batch in parts:
            each = [[counts(*turn) for turn in turns(t or "")] for t in batch.column(4).to_pylist()]
            kind = pa.list_(pa.list_(pa.int32()))
            columns = [*batch.columns[:4], pa.array(each, kind)]
            yield pa.RecordBatch.from_arrays(columns, names=["conv", "turn", "tie", "role", "each"])

    known = rows.where(F.col("role").isNotNull())
    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("conv", "turn")}
    shape = f"conv {kinds['conv']}, turn {kinds['turn']}, tie long, role string, each array<array<int>>"
    counted = known.select("conv", "turn", "tie", "role", "text").mapInArrow(features, shape)
    order = [F.xxhash64("conv"), F.col("conv"), F.col("turn"), F.col("tie")]
    sample = counted.orderBy(*order).limit(SAMPLE).select("conv", "role", "each").collect()
    return Model.fitted([(r["conv"], r["role"], r["each"]) for r in sample])


def format_chats(df: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv_id, turn, segment, role, role_pred, rendered): a row per turn found, ``segment`` from 0 within a row."""
    spark = df.sparkSession
    small_batches(spark)
    rows = df.select(
        df[conversation].alias("conv"), df[turn].alias("turn"), F.xxhash64(df[role], df[text]).alias("tie"), df[role].cast("string").alias("role"), df[text].cast("string").alias("text")
    )
    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("conv", "turn")}
    model = _fit(rows)
    if model is None:
        model = Model([], np.zeros(0), np.zeros((0, 0)), np.zeros((int(_BEGIN[-1]), 0)))
    shared = spark.sparkContext.broadcast(model.arrays())
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows.count() / ROWS_PER_PART))
    order = ["conv", "turn", "tie"]
    ranged = rows.repartitionByRange(tasks, *order).sortWithinPartitions(*order)

    def score(parts):
        """The rows with their place; after them one row that sums the part up."""
        from pyspark import TaskContext

        own, part, place = Model(*shared.value), TaskContext.get().partitionId(), 0
        first = last = None
        run: list[np.ndarray] = []
        through = None
        single = True
        for batch in parts:
            for conv, text in zip(batch.column(0).to_pylist(), batch.column(4).to_pylist()):
                if last is None:
                    first = (conv,)
                elif (conv,) != last:
                    through = passing(np.concatenate(run), own.step) if through is None and own.roles else through
                    run, single = [], False
                last = (conv,)
                run.append(own.scores(text or ""))
            size = len(batch)
            extra = [
                pa.array(np.full(size, part), pa.int32()), pa.array(np.arange(place, place + size), pa.int64()),
                pa.nulls(size, pa.list_(pa.float64())), pa.nulls(size, pa.bool_()), batch.column(0),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names=[*batch.schema.names, "part", "place", "head", "single", "last"])
            place += size
            kinds_of = batch.schema
        if last is not None and own.roles:
            turned = np.concatenate(run)
            through = passing(turned, own.step) if through is None else through
            leaving = forward(turned, own.start, own.step)
            values = {
                "conv": first[0], "part": part, "head": [*through.ravel().tolist(), *leaving.tolist()], "single": single, "last": last[0],
            }
            fields = [*kinds_of, pa.field("part", pa.int32()), pa.field("place", pa.int64()), pa.field("head", pa.list_(pa.float64()))]
            fields += [pa.field("single", pa.bool_()), pa.field("last", kinds_of.field("conv").type)]
            yield pa.RecordBatch.from_arrays([pa.array([values.get(f.name)], f.type) for f in fields], names=[f.name for f in fields])

    shape = f"conv {kinds['conv']}, turn {kinds['turn']}, tie long, role string, text string, part int, place long, head array<double>, single boolean, last {kinds['conv']}"
    scored = written(ranged.mapInArrow(score, shape), "chats")
    n = len(model.roles)
    heads = [
        {
            "part": r["part"], "first": (r["conv"],), "last": (r["last"],), "single": r["single"],
            "through": np.array(r["head"][: n * n]).reshape(n, n), "leaving": np.array(r["head"][n * n :]),
        }
        for r in scored.where("head is not null").select("part", "conv", "last", "single", "head").orderBy("part").collect()
    ]
    at_border = spark.sparkContext.broadcast(borders(heads, model))

    def render(parts):
        own, states = Model(*shared.value), at_border.value

        def answer(run, entry, end):
            found = [turns(text or "") for _, _, _, _, text in run]
            if own.roles:
                scores = np.concatenate([own.scores(text or "") for _, _, _, _, text in run])
                begin = own.start if entry is None else own.step[entry]
                roles = iter([own.roles[s] for s in path(scores, begin, own.step, end)])
            else:
                roles = iter(lambda: None, 0)
            for (conv, number, _, given, _), each in zip(run, found):
                for segment, (_, lines) in enumerate(each):
                    role = next(roles)
                    yield conv, number, segment, given, role, rendered(role, lines)

        def grouped():
            """(rows of a conversation within a part, state before it, state at its end)."""
            run, part, entry = [], None, None
            for batch in parts:
                for row in zip(*(batch.column(k).to_pylist() for k in range(6))):
                    if run and row[5] != part:
                        yield run, entry, states.get(part, (None, None))[1]
                        run = []
                    elif run and run[-1][0] != row[0]:
                        yield run, entry, None
                        run, entry = [], None
                    if row[5] != part:
                        part = row[5]
                        entry = states.get(part, (None, None))[0]
                    run.append(row[:5])
            if run:
                yield run, entry, states.get(part, (None, None))[1]

        out = []
        for run, entry, end in grouped():
            for row in answer(run, entry, end):
                out.append(row)
                if len(out) >= 1000:
                    yield batch_of(out)
                    out = []
        if out:
            yield batch_of(out)

    types = {c: ranged.select(c).limit(0).toArrow().schema.field(c).type for c in ("conv", "turn")}
    fields = pa.schema(
        [("conv_id", types["conv"]), ("turn", types["turn"]), ("segment", pa.int32()), ("role", pa.string()), ("role_pred", pa.string()), ("rendered", pa.string())]
    )

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), fields)], schema=fields)

    placed = scored.where("head is null").repartition(tasks, "part").sortWithinPartitions("part", "place")
    shape = f"conv_id {kinds['conv']}, turn {kinds['turn']}, segment int, role string, role_pred string, rendered string"
    return placed.select("conv", "turn", "tie", "role", "text", "part").mapInArrow(render, shape)


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn of ``conversations`` with the role recovered, in canonical form."""
    return format_chats(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")
