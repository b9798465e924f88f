"""A corpus pipeline of five stages over documents: STAGES, run() and ORACLE_SQL.

Each stage takes what its predecessor kept, as a written table. The stages before the last
return the columns of documents: toxicity drops documents, near_duplicates keeps one of each
class, pii replaces personal data in the texts, mix takes documents of each source up to its
target (some twice), and bpe encodes what is left and decodes it again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import op03_mix, op05_toxicity, op06_bpe, op09_pii, op10_dartminhash
from millrace.llm.common import durable
from millrace.sources import read_table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that score THRESHOLD or more; the model learns from labels."""
    model = op05_toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    return op05_toxicity.without_toxic(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: that with the least id."""
    return op10_dartminhash.one_of_each_class(docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced; n_chars follows the text."""
    clean = op09_pii.redacted(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, as often as it takes them."""
    return op03_mix.mixed_rows(docs)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row a document: doc_id, n_tokens, digests of the ids and of what they decode to, ids."""
    return op06_bpe.digests(docs, with_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("pii", pii),
    ("mix", mix),
    ("bpe", bpe),
]

# The model of the first stage is trained, which SQL cannot express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over documents."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir))
    return docs
