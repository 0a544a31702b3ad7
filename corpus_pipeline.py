"""From raw documents to packed training sequences: five stages, each written before the next.

Null and empty texts, and others without a letter, go in the first stage. Repeated rows are rows of one
document and stay until near-dedup keeps one of each class; null ids do not make documents equal. Long
texts are worked on whole. Other columns go along, whatever their names. An empty table gives no pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.llm import language_id, line_dedup, near_dedup, packing, secret_scan
from ledgerlark.llm.columns import fresh, quoted
from ledgerlark.llm.queries import WORD_TOKENIZER, tokenizer_path
from ledgerlark.sources.scratch import stored


def _as_before(docs: DataFrame, changed: DataFrame) -> DataFrame:
    """The columns of ``docs``, with ``n_chars`` following the text."""
    columns = [
        F.length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else quoted(c) for c in docs.columns
    ]
    return changed.select(*columns)


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: rows whose text has no letter to tell a language by go, and no others, also where
    no language could be learned. A row without a language gets the one that is found."""
    model = language_id.train(docs)
    if not model.languages:
        return docs.where(language_id.lettered(F.col("text")))
    name = fresh(docs, "lang_pred")
    found = language_id.identify(docs, model).where(quoted(name) != language_id.UNDETERMINED)
    return found.select(
        *(F.coalesce(quoted(c), quoted(name)).alias(c) if c == "lang" else quoted(c) for c in docs.columns)
    )


def cut_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: lines of five and more documents stay in one of them."""
    return _as_before(docs, line_dedup.drop_shared_lines(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup: the row with the smallest doc_id of each class stays."""
    return near_dedup.drop_near_duplicates(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret scans: what the rules find is replaced by a mark; all rows stay."""
    spans = fresh(docs, "spans")
    found = secret_scan.scan_secrets(docs)
    clean = secret_scan.redacted(F.col("text"), F.col(spans))
    return _as_before(docs, found.withColumn("text", clean))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: where each piece of each document lies in the training sequences."""
    return packing.pack_documents(docs, tokenizer_path(WORD_TOKENIZER))


STAGES = [
    ("language_id", keep_identified),
    ("line_dedup", cut_shared_lines),
    ("near_dedup", drop_near_copies),
    ("secret_scan", redact_secrets),
    ("packing", pack_sequences),
]

#: SQL can express neither the learned model, nor the hash bands, nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES) - 1:
            docs = stored(docs, f"stage-{name}")
    return docs
