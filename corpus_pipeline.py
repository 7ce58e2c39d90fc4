"""A training-corpus pipeline: five operators one after another over ``documents``.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last return
the columns of ``documents``. ``n_chars`` follows the text. Null texts stay null, empty ones stay
rows, and every stage is defined for empty tables as its operator says.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telmark.llm import line_dedup, ngram_join, packing, secret_scan, toxicity
from telmark.llm.queries import vocabulary
from telmark.llm.shared import checkpoint_folder, free_name, table


#: Bytes of texts that a Python worker gets at once.
BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def _bounded(spark: SparkSession) -> None:
    """Bounds the session's Arrow batches by bytes, so that workers' memory does not follow the length of texts; a bound that the session has stays."""
    spark.conf.set(_BATCH, spark.conf.get(_BATCH, str(BATCH_BYTES)))


def _counted(new: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of the documents, with ``n_chars`` of the new text."""
    if "n_chars" in columns:
        new = new.withColumn("n_chars", F.length("text").cast(new.schema["n_chars"].dataType))
    return new.select(columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.5 or more go."""
    _bounded(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))
    name = free_name(docs.columns, "toxic_score")
    return toxicity.score(docs, model, name).filter(F.col(name) < 0.5).select(docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of 20 characters or more that three documents share stay in one."""
    _bounded(spark)
    return _counted(line_dedup.drop_lines(docs, counts=None), docs.columns)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a Jaccard similarity of 0.8 on five-word shingles the smallest doc_id stays."""
    _bounded(spark)
    return ngram_join.keep_one(docs, k=5, percent=80)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Findings, in plain text or wrapped in encodings, are replaced."""
    _bounded(spark)
    return _counted(secret_scan.redact_documents(docs), docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All token pieces of the documents that are left, placed in sequences of 4096."""
    _bounded(spark)
    return packing.pack_documents(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", dedup_lines),
    ("n-gram Jaccard join", dedup_near),
    ("secret scans", redact_secrets),
    ("best-fit packing", pack),
]

#: No SQL runs the classifier, the join's components and the tokenizer; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each but the last is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            path = f"{checkpoint_folder(spark)}/pipeline-{uuid.uuid4().hex}-{i}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
