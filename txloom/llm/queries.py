"""A query for each operator, over its whole table, with the settings for production."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txloom.llm import ann, bpe, decontaminate, jaccard, licenses, negatives, packing, pii, records, repetition, resample, suffixes, toxicity
from txloom.llm.shared import session, shared_folder, table
from txloom.llm.tokens import read_tokenizer

TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
END_ID = 0


def _tokenizer() -> str:
    return read_tokenizer(public_tokenizers.path(TOKENIZER))


def op1_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/records-{uuid4().hex}"
    index = records.write_records(table(spark, sf_dir, "documents"), folder, _tokenizer(), END_ID)
    back = records.read_records(index).select(
        "part", "record", "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )
    earlier = Window.partitionBy("part").orderBy("record").rowsBetween(Window.unboundedPreceding, -1)
    return back.withColumn("before", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0))).join(records.starts(index), "part").select(
        "doc_id", (F.col("first") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_matches(table(spark, sf_dir, "documents"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path(RANKS))
    back = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN), ranks)
    return back.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op5_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.col("text").alias("before"))
    made = pii.pseudonymise(docs)
    return made.select("doc_id", "text", pii.replaced(F.col("before"), F.col("text")).alias("n_replaced"))


def held_out(doc_id: Column) -> Column:
    """The fifth of the rows whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id")))
    scored = toxicity.score(docs.select("doc_id", "text"), toxicity.fit(docs, labels))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op8_repetition_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.repetition(table(spark, sf_dir, "documents"))


def op9_packed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.token_pieces(table(spark, sf_dir, "documents"), _tokenizer(), END_ID))


def op10_repeated_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeated_spans(table(spark, sf_dir, "documents"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return made.select("doc_id", "n_features", "weight", "score", "rank")


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["after"] - s["first"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    relabelled = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", relabelled)
    return negatives.hard_negatives(rows, F.col("vec_id") % 50 == 0)


_ALL: list[Callable[[SparkSession, str], DataFrame]] = [
    op1_token_records,
    op2_license_scan,
    op3_byte_bpe,
    op4_jaccard_join,
    op5_pseudonyms,
    op6_toxicity,
    op7_neighbours,
    op8_repetition_rules,
    op9_packed_sequences,
    op10_repeated_spans,
    op11_importance_resampling,
    op12_decontamination,
    op13_hard_negatives,
]


def _over(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: query(session(spark), str(sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {q.__name__: _over(q) for q in _ALL}

ORACLE_SQL: dict[str, str] = {
    "op2_license_scan": licenses.duckdb_sql(),
    "op11_importance_resampling": resample.duckdb_sql(),
    "op12_decontamination": decontaminate.duckdb_sql(),
    "op13_hard_negatives": negatives.duckdb_sql(),
}
