"""From raw documents to encoded training text: rules, line dedup, near dedup, mixing, encoding.

Each stage reads what the one before wrote to the shared folder, so a lost executor costs one stage's tasks at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from audience_engine.llm import line_dedup, mixing, near_texts, pieces, quality_rules
from audience_engine.plans.views import table
from audience_engine.session import cut_lineage


def _with_length(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows the text."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without the lines over their host's limit."""
    return _with_length(quality_rules.apply_rules(docs))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the lines that many of them share."""
    return _with_length(line_dedup.apply_dedup(docs))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity of 0.8 or more."""
    return near_texts.apply_dedup(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them."""
    return mixing.apply_mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of each document, encoded and decoded again.

    ``doc_id``, ``source``, ``lang``, ``n_pieces``, ``score``, ``ids``, ``other_scores`` (of the next best segmentations, best
    first) and ``round_trip`` (whether ``ids`` decode to the text).
    """
    named = docs.select("doc_id", "source", "lang", "text")
    coded = pieces.encode(named, carry=("doc_id", "source", "lang"), check=True)
    size = F.size("pieces.ids").cast("long").alias("n_pieces")
    others = F.col("pieces.alternatives.score").alias("other_scores")
    same = F.col("pieces.round_trip").alias("round_trip")
    return coded.select("doc_id", "source", "lang", size, F.col("pieces.score").alias("score"), F.col("pieces.ids").alias("ids"), others, same)


STAGES = [("quality rules", quality), ("line dedup", lines), ("near dedup", near_copies), ("mixing", mix), ("sentencepiece", encode)]

#: Fingerprints, entropy balancing and the piece lattice have no SQL form; tests/llm holds the run against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
