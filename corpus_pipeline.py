"""Training-data pipeline over ``documents``: quality, near duplicates, repeated passages, benchmark leaks, packing.

Each stage works on all that the one before it kept; all but the last return the columns of ``documents``.  ``run`` writes
every stage's result to the shared folder and goes on from there.

Defined results: a null or empty text is a document of its own to every stage (its quality is that of a text without words);
rows with a null id are never near duplicates; repeated rows stay once; rows of one id with unlike texts are judged each by
its own text; columns other than the id, the text and ``n_chars`` are handed on as they are; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekpi.llm import decontaminate as bd
from lakekpi.llm import near_dups as nd
from lakekpi.llm import packing as pk
from lakekpi.llm import quality as qc
from lakekpi.llm import substring_dups as sd
from lakekpi.llm.common import read_table, session, stage

PASSAGE_WORDS = 50  # repeated passages from this length on are cut


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier does not reject."""
    model = qc.fit(docs, read_table(session(spark), sf_dir, "labels"), "doc_id", "text", "quality", 3, 1)
    return qc.keep_good(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near duplicates (five-word shingles, 0.8)."""
    session(spark)
    return nd.drop_near_duplicates(docs, shingle_words=5, percent=80)


def substring_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that occur earlier too; documents of which nothing is left go."""
    session(spark)
    cut = sd.drop_repeats(docs, window=PASSAGE_WORDS).where("_removed = 0 or _removed < _words")
    length = F.when(F.col("_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return bd.decontaminate(docs, read_table(session(spark), sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens, with their token ids."""
    session(spark)
    return pk.pack(docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("substring_duplicates", substring_duplicates),
          ("decontaminate", decontaminate), ("packing", packing)]
ORACLE_SQL = None  # a trained classifier and a tokenizer: tested against brute force instead


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pl-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
