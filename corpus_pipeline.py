"""The corpus pipeline: toxic documents go, exact and near copies go, sources are mixed, the rest is packed.

Each stage is a function of (spark, docs, sf_dir).  All but the last return the columns of ``documents``; between stages the
documents are written as Parquet and read again, so no stage runs twice and a lost executor costs at most one stage's tasks.

Defined results: null and empty texts are no evidence of toxicity and stay there, are one group of exact copies, are linked with nothing, have no
words to mix (so the mixture takes none), and would be packed as one end token.  Rows equal in all columns are copies like any others; of rows with
equal id and text one stays.  Very long texts pass whole.  Extra columns travel along unchanged, whatever their names.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eavesgrid.llm import exact_dedup, mixing, ngram_join, packing, toxicity
from eavesgrid.llm.common import fresh
from eavesgrid.llm.queries import tokenizer_path
from eavesgrid.session import scratch_path

THRESHOLD = 0.5
SHINGLE = 5
SIMILAR_PERCENT = 80
REMEMBERED_WORDS = 50_000  # fewer than by default: the workers serve the other stages, too


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the Kneser-Ney models, trained on the labels of the corpus, don't call toxic."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = fresh("__score", docs)
    scored = toxicity.score_documents(docs, model, score_col=score)
    return scored.where(F.col(score) < THRESHOLD).drop(score)


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_exact_copies(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by shingles of five words and a similarity of 0.8."""
    return ngram_join.drop_near_copies(docs, size=SHINGLE, percent=SIMILAR_PERCENT)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mixture takes, as often as it takes them."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token ids in windows of at most 2048."""
    return packing.pack_documents(docs, tokenizer_path(), most_words=REMEMBERED_WORDS)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact copies", drop_exact),
    ("near copies", drop_near),
    ("mixing", mix),
    ("packing", pack),
]

#: Language models and a tokenizer are beyond SQL; the tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, in order."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
