"""A corpus pipeline: filter, dedup and decontaminate documents, then mix their sources.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written and
read again as the next one's documents. All stages but the last return the columns of
``documents``, with ``n_chars`` of the text they leave.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medvoice.llm.decontaminate import find_benchmark, is_contaminated
from medvoice.llm.frames import stored, table
from medvoice.llm.line_dedup import drop_repeated_lines
from medvoice.llm.mixing import Mix
from medvoice.llm.near_dedup import drop_near_duplicates
from medvoice.llm.toxicity import fit, score


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the field finds toxic go."""
    columns = docs.columns
    field = fit(docs, table(spark, sf_dir, "labels"))
    scored = score(docs, field)
    return scored.where(F.col(scored.columns[-1]) == 0).select(*columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document has go."""
    columns = docs.columns
    kept = drop_repeated_lines(docs)
    if "n_chars" in columns:
        kept = kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(*columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more is benchmark text go."""
    columns = docs.columns
    found = find_benchmark(docs, table(spark, sf_dir, "benchmark"))
    n_words, n_hit = found.columns[len(columns)], found.columns[-1]
    return found.where(~is_contaminated(n_hit, n_words)).select(*columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each remaining document the mix takes."""
    return Mix(docs).taken().select(
        F.col("id").alias("doc_id"), "source", "size", "source_size", "target", "taken"
    )


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

#: A trained field, signatures and permutations have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


PIPELINE_QUERIES = {"pipeline": run}
PIPELINE_ORACLES: dict[str, str] = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
