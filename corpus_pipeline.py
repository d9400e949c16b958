"""From raw documents to packed training sequences: five stages, each an operator of wardline.llm.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as
the next stage's documents. All but the last return the columns of documents.

1. quality: documents that score below 0.7 go. The classifier learns from labelled documents of the
   training folds that are among the stage's own documents.
2. near duplicates: of each component of documents with similarity 0.8 or more the one with the
   smallest id stays. Bands of 6 bins: a pair at 0.8 is missed with a chance of about 3e-6. Documents without words, or without id, are nobody's duplicate and stay.
3. decontamination: documents that hold a benchmark item go.
4. secrets: every span of a secret is replaced by a mark, and n_chars counted anew.
5. packing: the documents' tokens in sequences of 4096, sources mixed by their share.

Null text counts as empty. Other columns are carried along unchanged. An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wardline.llm import decontam, neardup, packing, quality, secretscan
from wardline.llm.common import without_rows
from wardline.llm.queries import (
    END_ID,
    KEEP_SCORE,
    load_tokenizer,
    quality_model,
    secret_model,
    table,
)
from wardline.sources.layers import materialize

PERCENT, BAND_ROWS = 80, 6


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, quality_model(docs, table(spark, sf_dir, "labels")), KEEP_SCORE)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = neardup.near_duplicates(docs, PERCENT, BAND_ROWS).where("NOT kept").select("doc_id")
    return without_rows(docs, "doc_id", materialize(found, "duplicates"))


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    leaks = decontam.find_leaks(docs, table(spark, sf_dir, "benchmark")).select("doc_id")
    return without_rows(docs, "doc_id", materialize(leaks, "leaks"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secretscan.redact(docs, secret_model(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, load_tokenizer, END_ID, packing.WINDOW, width="<u2")


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("secrets", redact_secrets),
    ("packing", pack_sequences),
]

# No SQL form: the classifier, the tokenizer and the Markov models are not SQL. Tested against
# brute force in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
