"""The corpus pipeline: documents by stages, each on all that its predecessor kept.

1. Language identification: documents without any letter go.
2. Near-duplicates: of each group (five-word shingles, similarity 0.8) the document of the least id stays.
3. Repeated strings of 200 bytes are cut out of the texts.
4. Secrets are replaced by a mark.
5. What is left is packed into sequences; this returns pieces, not documents.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import language_id, minhash, packing, secret_scans, suffix_dedup
from tidemark.llm.common import table, written


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.keep_identified(docs, "text", language_id.learned(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = _identified(docs)
    found = minhash.near_duplicates(rows.select("row_id", "row.doc_id", "row.text"))
    kept = found.where("row_id = first_row").select("row_id")
    return rows.join(kept, "row_id", "left_semi").select("row.*")


def _identified(docs: DataFrame) -> DataFrame:
    """(row_id, row): a row of a Parquet table is known by its file and its place there, however the scan is
    split; other rows are written with an id first."""
    row = F.struct(*docs.columns).alias("row")
    try:
        return docs.select(F.concat_ws(":", "_metadata.file_path", "_metadata.row_index").alias("row_id"), row)
    except AnalysisException:
        return written(docs.select(F.monotonically_increasing_id().alias("row_id"), row), "documents")


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(docs, as_text=True)
    values = [F.col("kept").alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns]
    return _counted(found.select(*values), docs)


def replace_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(secret_scans.redact(docs, ["doc_id"], "text"), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path(packing.VOCABULARY))


def _counted(changed: DataFrame, docs: DataFrame) -> DataFrame:
    """``n_chars`` follows the text, where the table has it."""
    if "n_chars" not in docs.columns:
        return changed
    return changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


STAGES = [
    ("language_id", identify_languages),
    ("near_dedup", drop_near_duplicates),
    ("suffix_dedup", cut_repeats),
    ("secret_scans", replace_secrets),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: SQL cannot tokenize or sign documents; tests compare the stages with brute force.
ORACLE_SQL = None
