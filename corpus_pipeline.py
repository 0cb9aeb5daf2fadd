"""From raw documents to token ids, in five stages.

Every stage takes ``(spark, docs, sf_dir)``, works on all rows its
predecessor kept and returns the columns of ``documents`` (the last one
tokens).  ``run`` writes each stage as Parquet and reads it again, so a lost
executor never reaches back over a stage.

Null texts pass as empty ones; rows without an id stay; an empty table goes
through every stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightmart.llm import bpe, mixing, near_dups, site_lines, toxicity
from flightmart.llm._common import stored, table
from flightmart.llm.queries import tokenizer_path, toxicity_model

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the neighbours' votes call toxic go."""
    model = toxicity_model(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).where("predicted = 0").select(COLUMNS)


def drop_site_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that a source repeats over its pages go; documents stay."""
    out = site_lines.drop_boilerplate(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return near_dups.keep_one(docs).select(COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources, languages and topics come nearer to equal shares of tokens."""
    return mixing.mix(docs, {"source": "source", "lang": "lang", "topic": mixing.topic()}).select(COLUMNS)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and what they decode to, as digests beside the ids."""
    out = bpe.encode(docs, tokenizer_path())
    return out.select(F.col("id").alias("doc_id"), "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_site_lines),
    ("near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("bpe", to_tokens),
]

#: Neighbour votes, signatures and merges are beyond SQL.  The tests hold the operators against plain versions; of the
#: stages in a row they check counts, columns and empty tables only.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
