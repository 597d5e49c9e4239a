"""From raw documents to packed token ids, in stages that each apply one operator of terrier.llm.

``STAGES`` lists name and function. A function takes the session, the documents that the stage before
it kept, and the folder of the input tables; ``run`` writes each result as Parquet in the shared
folder and reads it again, so a lost executor costs at most one stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrier.llm import bit_packing, decontaminate, gam_quality, mixing, order_minhash
from terrier.llm.ship import ship
from terrier.session import scratch_path, written

#: Weights by level: domains (by source number), languages, sources.
WEIGHTS = [{"domain0": 4, "domain1": 3, "domain2": 2, "domain3": 1},
           {"en": 5, "de": 2, "fr": 2, "es": 1}, {}]


def mixed(docs: DataFrame, tokens: Column | None = None, share: float = 0.8) -> DataFrame:
    """Documents mixed to ``WEIGHTS``; a source belongs to one of four domains by its number."""
    number = F.regexp_extract("source", "[0-9]+", 0)
    domain = F.concat(F.lit("domain"), F.when(number != "", F.pmod(number.try_cast("long"), F.lit(4))))
    return mixing.mixed_documents(
        docs, [domain, F.col("lang"), F.col("source")], WEIGHTS, tokens=tokens, share=share)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from all labels of these documents, does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = gam_quality.fit(docs, labels, F.lit(True))
    scored = gam_quality.scored(docs, model, score_column="gam_score")
    return scored.filter("gam_score >= 0.3").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the row that the stage before stored first.

    Rows are told apart by their place in that table, so documents that share an id, or have none, are
    compared and kept by their texts like any others.
    """
    key = "row_key"
    while key in docs.columns:
        key += "_"
    keyed = written(docs.withColumn(key, F.monotonically_increasing_id()), "keyed")
    classes = order_minhash.near_duplicates(keyed, id_column=key)
    first = classes.filter("id = class_id").select(F.col("id").alias(key))
    return keyed.join(first, key, "left_semi").select(*docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontaminate.without_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents by source budgets, one row for every copy taken."""
    copies = F.explode(F.sequence(F.lit(1), F.col("mix_copies").cast("int")))
    return mixed(docs).withColumn("mix_copy", copies).select(*docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Start, number and checksum of every document's ids, read from the packed files."""
    return bit_packing.packed(docs, tokenizer_path())


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminated),
    ("mixing", mix),
    ("token_ids", token_ids),
]

#: Neither the classifier nor the tokenizer can be put in SQL; tests use brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
