"""Corpus preparation in stages; each is written as Parquet and reread by the next.

Every stage keeps the columns of documents but the last, which gives the places of the packed pieces. Texts that a stage
changes have their ``n_chars`` counted anew.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from curbside.llm import language_id, line_dedup, packing, secret_scan, simhash
from curbside.llm.common import staged
from curbside.llm.queries import RANKS, TOKENIZER

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
OWN = ("doc_id", "text", "lang", "source", "n_chars")
MIN_SCORE = 0.3  # in the gap that README.md gives; a document that is farther from every language's profile is no text in a learned language


def keeping(stage: Stage) -> Stage:
    """The stage with all other columns of its input under names that no operator uses, and back again after it."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = {c: c if c in OWN else f"_pipeline_extra_{i}" for i, c in enumerate(docs.columns)}
        quoted = lambda c: F.col("`" + c.replace("`", "``") + "`")
        out = stage(spark, docs.select(*[quoted(c).alias(n) for c, n in names.items()]), sf_dir)
        return out.select(*[F.col(n).alias(c) for c, n in names.items()])

    return run


def recounted(docs: DataFrame) -> DataFrame:
    """n_chars as the text has them; a null text keeps what it had."""
    return docs.withColumn("n_chars", F.coalesce(F.char_length("text").cast("long"), F.col("n_chars")))


@keeping
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or unlike all languages, go; the others get the predicted language."""
    found = language_id.predicted(docs, language_id.learned(docs))
    kept = found.filter((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= MIN_SCORE))
    return kept.withColumn("lang", F.col("lang_pred")).select(*docs.columns)


@keeping
def drop_common_blocks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blocks of lines that an earlier document has go; a document of which no word is left goes whole."""
    shorter = line_dedup.deduplicated(docs, every=True)
    left = shorter.filter(F.col("removed").isNull() | F.col("text").rlike(r"\S"))
    return recounted(left.select(*docs.columns))


@keeping
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return simhash.representatives(docs)


@keeping
def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; the documents stay."""
    return recounted(secret_scan.redacted(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in training sequences."""
    return packing.pack(docs, TOKENIZER, RANKS)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("line_dedup", drop_common_blocks),
    ("simhash", drop_near_duplicates),
    ("secret_scan", hide_secrets),
    ("packing", pack_sequences),
]

# A learned language model, patience diff and greedy packing are beyond SQL; tests compare run() with plain stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs, _ = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
