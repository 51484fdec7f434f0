"""The corpus queries over the driver's tables, one per operator, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    collocations, exact_dedup, lexical_search, license_scan, line_dedup, mixing, ngram_join, packing, pii, quality, repeats,
    toxicity, url_filter,
)
from .oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_keep_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs), with_text=False)


def op2_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    scored = toxicity.score_documents(docs, model)
    return scored.select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op3_shape_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")

    def of_base(kind: str | None = None):
        return F.filter("spans", lambda s: s["base"] & (F.lit(True) if kind is None else s["kind"] == kind))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    return found.select(
        "doc_id",
        *[F.size(of_base(k)).cast("long").alias(f"n_{k}") for k in pii.KINDS],
        F.sha2(joined(of_base()).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def op4_set_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = ngram_join.near_groups(_table(spark, sf_dir, "documents"), size=4, percent=85)
    return groups.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


def op5_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_quality(_table(spark, sf_dir, "documents"))


def op6_fair_queueing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(_table(spark, sf_dir, "documents")).drop("text_hash", "source")


def op7_induced_sorting(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op8_heavy_hitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents"))


def tokenizer_path() -> str:
    """The public tokenizer of op9."""
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def op9_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(_table(spark, sf_dir, "documents"), tokenizer_path())
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


#: host, path, verdict of the rules of op10
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def op10_filter_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge_urls(_table(spark, sf_dir, "pages"), rules)


def op11_aho_corasick(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_rollup_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op13_license_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_keep_bitmaps": op1_keep_bitmaps,
    "op2_kneser_ney": op2_kneser_ney,
    "op3_shape_field": op3_shape_field,
    "op4_set_relations": op4_set_relations,
    "op5_line_frequency": op5_line_frequency,
    "op6_fair_queueing": op6_fair_queueing,
    "op7_induced_sorting": op7_induced_sorting,
    "op8_heavy_hitters": op8_heavy_hitters,
    "op9_squares_packing": op9_squares_packing,
    "op10_filter_cascade": op10_filter_cascade,
    "op11_aho_corasick": op11_aho_corasick,
    "op12_rollup_phrases": op12_rollup_phrases,
    "op13_license_join": op13_license_join,
}
