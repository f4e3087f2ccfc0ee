"""A training-data pipeline over `documents`; its stages are operators of txloom.llm.

Every stage but the last returns the columns of `documents`. Rows are told apart by doc_id where a stage
has to choose; of rows that share an id and a text each stage keeps or drops all alike, but for the join of
near copies, which keeps one row of a group. Nulls, empty texts and empty tables are as the operators say.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txloom.llm import jaccard, packing, pii, suffixes, toxicity
from txloom.llm.queries import END_ID, TOKENIZER
from txloom.llm.shared import session, stored, table
from txloom.llm.tokens import read_tokenizer

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Documents at or above this score go.
TOXIC = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text scores below TOXIC. The classifier learns from the labelled rows of `docs`."""
    model = toxicity.fit(docs, table(session(spark), sf_dir, "labels"))
    scored = toxicity.score(docs, model, into="_llm_score")
    return scored.where(F.col("_llm_score") < TOXIC).drop("_llm_score")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: the one with the smallest doc_id, of equal ones the first by its text's hash
    and then by its columns.

    Each row counts with the group of its own text, so rows that reuse an id for other texts lose nothing. Rows
    without words stay, as do rows without an id: neither links with anything that could stand for them.
    """
    words = F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]") & F.col("doc_id").isNotNull()
    worded = docs.where(words)
    classes = jaccard.jaccard_components(worded)
    kept = classes.groupBy("class").agg(F.min(F.struct("doc_id", "text_hash")).alias("_llm_first")).select("_llm_first").distinct()
    named = worded.withColumn("_llm_first", F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash")))
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    order = Window.partitionBy("_llm_first").orderBy(*(others or [F.lit(0)]))
    one = named.join(kept, "_llm_first", "left_semi").withColumn("_llm_n", F.row_number().over(order)).where("_llm_n = 1")
    return one.select(*[F.col(f"`{c}`") for c in docs.columns]).unionByName(docs.where(~words))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, without the passages of 50 words or more that occur before; n_chars, where it is kept, is that of the new text."""
    shorter = suffixes.without_repeats(docs, suffixes.repeated_spans(docs))
    return shorter.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else shorter


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with personal data in their texts replaced by pseudonyms of the same format."""
    return pii.pseudonymise(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all texts in sequences of at most 1024 ids."""
    return packing.pack(packing.token_pieces(docs, read_tokenizer(public_tokenizers.path(TOKENIZER)), END_ID))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", lambda spark, docs, sf_dir: drop_toxic(session(spark), docs, sf_dir)),
    ("near-copies", lambda spark, docs, sf_dir: drop_near_copies(session(spark), docs, sf_dir)),
    ("repeats", lambda spark, docs, sf_dir: cut_repeats(session(spark), docs, sf_dir)),
    ("personal-data", lambda spark, docs, sf_dir: hide_personal_data(session(spark), docs, sf_dir)),
    ("packing", lambda spark, docs, sf_dir: pack_sequences(session(spark), docs, sf_dir)),
]

#: The classifier, the suffix matches and the keyed rounds have no SQL form; tests/llm compares the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each written and read again."""
    docs = table(session(spark), str(sf_dir), "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, str(sf_dir)), f"pipeline-{name}")
    return docs
