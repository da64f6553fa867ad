"""Secret scans over a trigram index, in DataFrame operations only.

Each rule's regular expression gives a Boolean trigram query (``trigram_query``). The index holds postings
(trigram, text key) of the trigrams that some rule asks for; a text's postings meet in one aggregation,
where the queries are evaluated. Only candidates are verified by the regular expression. A rule without
mandatory trigrams scans every text.

Positions come from the texts between matches: splitting by the expression gives the gaps, extracting it
gives the matches, and a running sum over both gives where each match starts. Matches are rows, so a text
with very many of them is no problem.

Keys are hashes of the key columns and the text: rows that agree in both have the same result, and a
collision can only add candidates, never lose one. Defined results: a null text counts as an empty one and
has no spans; repeated rows give repeated results; other columns may have any names.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import table
from tidemark.llm.trigram_query import mandatory_trigrams


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern`` whose ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(either_case(w) for w in ("password", "passwd", "secret", "token")) + f"|{either_case('api')}_?{either_case('key')}"

RULES = (
    Rule("assign", rf"({_NAMES})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", group=2, least=8),
    Rule("access", r"AKIA[A-Z0-9]+", least=16),
    Rule("hex", r"[0-9a-f]+", least=32),
)


def at_least(rule: Rule) -> str:
    """The pattern to search with. A pattern that ends in one repeated class, and is judged as a whole, can ask
    for its length at once: no shorter match of it hides a longer one, as all reach to the end of a run."""
    fixed = {"access": r"AKIA[A-Z0-9]{12,}", "hex": r"[0-9a-f]{32,}"}
    return fixed.get(rule.kind, rule.pattern) if rule in RULES else rule.pattern


def text_key(df: DataFrame, keys: list[str], text: str) -> Column:
    return F.xxhash64(*[df[k] for k in keys], df[text])


def holds(clauses, grams: Column) -> Column:
    """The query over an array of trigrams."""

    def clause(alternatives) -> Column:
        each = [reduce(Column.__and__, [F.array_contains(grams, g) for g in sorted(a)]) for a in sorted(alternatives, key=sorted)]
        return reduce(Column.__or__, each)

    return reduce(Column.__and__, [clause(c) for c in clauses])


def candidates(texts: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(key, kinds): for each text of ``texts`` (key, text) the indexed rules that it may match, if any."""
    queries = {r.kind: q for r in rules if (q := mandatory_trigrams(r.pattern))}
    wanted = sorted({g for q in queries.values() for clause in q for a in clause for g in a})
    if not wanted:
        return texts.select("key", F.array().cast("array<string>").alias("kinds")).where("false")
    lowered = F.col("lowered")
    present = F.filter(F.array(*[F.when(F.contains(lowered, F.lit(g)), F.lit(g)) for g in wanted]), lambda g: g.isNotNull())
    postings = texts.select("key", F.lower("text").alias("lowered")).select("key", F.explode(present).alias("trigram"))
    met = postings.groupBy("key").agg(F.collect_set("trigram").alias("grams"))
    kinds = F.array_compact(F.array(*[F.when(holds(q, F.col("grams")), F.lit(k)) for k, q in queries.items()]))
    return met.select("key", kinds.alias("kinds")).where(F.size("kinds") > 0)


def matches(texts: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(key, place, kind, start, end) of every match in ``texts`` (key, text); code points, end exclusive.

    ``place`` is the position of the rule in ``rules``.
    """
    found = texts.join(candidates(texts, rules), "key", "left")
    indexed = {r.kind for r in rules if mandatory_trigrams(r.pattern)}
    hits = []
    for rule in rules:
        pattern = F.lit(at_least(rule))
        applies = F.array_contains("kinds", rule.kind) if rule.kind in indexed else F.lit(True)
        whole = F.when(applies, F.regexp_extract_all("text", pattern, F.lit(0)))
        hits.append(F.when(F.size(whole) > 0, whole).alias(f"whole_{rule.kind}"))
    scanned = found.select("key", "text", *hits).where(F.coalesce(*[F.col(f"whole_{r.kind}") for r in rules]).isNotNull())
    parts = []
    for place, rule in enumerate(rules):
        whole, pattern = F.col(f"whole_{rule.kind}"), F.lit(at_least(rule))
        judged = F.regexp_extract_all("text", pattern, F.lit(rule.group)) if rule.group else whole
        zipped = F.arrays_zip(
            F.transform(F.split("text", at_least(rule), -1), F.length).alias("gap"),
            F.transform(whole, F.length).alias("size"),
            F.transform(judged, F.length).alias("judged"),
        )
        kind = F.struct(F.lit(place).alias("place"), F.lit(rule.kind).alias("kind"), zipped.alias("zipped"))
        parts.append(F.when(whole.isNotNull(), kind))
    rows = scanned.select("key", F.explode(F.array_compact(F.array(*parts))).alias("of")).select(
        "key", "of.place", "of.kind", F.posexplode("of.zipped").alias("number", "at")
    )
    # The gap after the last match has no match; repeated rows fall together here.
    rows = rows.select("key", "place", "kind", "number", "at.gap", "at.size", "at.judged").where("size is not null").distinct()
    order = Window.partitionBy("key", "place").orderBy("number")
    end = F.sum(F.col("gap") + F.col("size")).over(order)
    least = F.create_map(*[x for place, r in enumerate(rules) for x in (F.lit(place), F.lit(r.least))])
    spans = rows.select("key", "place", "kind", (end - F.col("size")).alias("start"), end.alias("end"), "judged")
    return spans.where(F.col("judged") >= least[F.col("place")]).drop("judged")


def find_secrets(df: DataFrame, keys: list[str], text: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``keys``, a count n_<kind> per rule and ``spans`` (sorted structs) for every row of ``df``."""
    key = text_key(df, keys, text)
    texts = df.select(key.alias("key"), df[text].alias("text"))
    counts = [F.count_if(F.col("kind") == r.kind).alias(f"n_{r.kind}") for r in rules]
    spans = F.sort_array(F.collect_list(F.struct("start", "place", "end", "kind")))
    each = matches(texts, rules).groupBy("key").agg(*counts, spans.alias("spans"))
    rows = df.select(*[df[k] for k in keys], key.alias("key"))
    zeros = {f"n_{r.kind}": F.coalesce(f"n_{r.kind}", F.lit(0).cast("long")) for r in rules}
    empty = F.array().cast("array<struct<start:bigint,place:int,end:bigint,kind:string>>")
    return rows.join(each, "key", "left").drop("key").withColumns(zeros | {"spans": F.coalesce("spans", empty)})


def redact(df: DataFrame, keys: list[str], text: str, rules: tuple[Rule, ...] = RULES, mark: str = "[secret]") -> DataFrame:
    """``df`` with every span of its ``text`` replaced; overlapping and touching spans by one mark."""
    rows = df.select(text_key(df, keys, text).alias("key"), F.struct(*[df[c] for c in df.columns]).alias("row"))
    own = F.col("row")[text]
    spans = matches(rows.select("key", own.alias("text")), rules)
    order = Window.partitionBy("key").orderBy("start", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(F.col("start") > F.coalesce(before, F.lit(-1)), 1).otherwise(0)
    islands = spans.withColumn("new", new).withColumn("island", F.sum("new").over(order))
    merged = islands.groupBy("key", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    cuts = merged.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("cuts"))
    # What stays: from each cut's end (first: 0) to the next one's start (last: the text's end).
    begins = F.concat(F.array(F.lit(0).cast("long")), F.col("cuts.end"))
    ends = F.concat(F.col("cuts.start"), F.array(F.length(own).cast("long")))
    kept = F.zip_with(begins, ends, lambda b, e: F.substring(own, (b + 1).cast("int"), (e - b).cast("int")))
    changed = F.when(F.col("cuts").isNotNull(), F.array_join(kept, mark)).otherwise(own)
    values = [changed.alias(c) if c == text else F.col("row")[c].alias(c) for c in df.columns]
    return rows.join(cuts, "key", "left").select(*values)


def op8_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document by the base rules."""
    found = find_secrets(table(spark, sf_dir, "documents"), ["doc_id"], "text")
    named = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    counts = [f"n_{r.kind}" for r in RULES]
    return found.select("doc_id", *counts, F.sha2(named, 256).alias("base_sha256"), named.alias("spans"))


def oracle() -> str:
    """The base rules in SQL."""

    def one(place: int, rule: Rule) -> str:
        quoted = rule.pattern.replace("'", "''")
        return (
            f"select r, {place} as place, '{rule.kind}' as kind, string_split_regex(t, '{quoted}') as gaps, "
            f"regexp_extract_all(t, '{quoted}', 0) as found, regexp_extract_all(t, '{quoted}', {rule.group}) as judged, "
            f"{rule.least} as least from d"
        )

    return f"""
with d as (select doc_id, coalesce(text, '') as t, row_number() over () as r from documents),
m as ({" union all ".join(one(i, r) for i, r in enumerate(RULES))}),
n as (select *, unnest(range(1, len(found) + 1)) as i from m where len(found) > 0),
s as (
  select r, place, kind, len(found[i]) as size,
    list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0) as start
  from n where length(judged[i]) >= least
),
g as (
  select r, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access,
    count(*) filter (kind = 'hex') as n_hex,
    string_agg(kind || ':' || start::bigint || ':' || (start + size)::bigint, ',' order by start, place) as spans
  from s group by r
)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
  sha256(coalesce(spans, '')) as base_sha256, coalesce(spans, '') as spans
from d left join g on d.r = g.r"""
