"""A corpus from raw documents: toxicity, near-duplicates, personal data, source mix, pieces.

Each stage takes (spark, docs, sf_dir) and all that the stage before it kept. All but the last return the columns of
documents. Null texts count as empty where a stage reads them; an empty table passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteweave.llm import mixing, near_duplicates, pii, sentence_pieces, toxicity
from siteweave.llm.common import fresh, table
from siteweave.shipping import ship

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below one half; the model is fitted on the labels of the documents at hand."""
    ship(spark)
    model = toxicity.fit_bags(*toxicity.labelled(docs.select("doc_id", "text"), table(spark, sf_dir, "labels").select("doc_id", "toxic")))
    return toxicity.score(docs, model, into="toxic_score").where("toxic_score < 0.5").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares shingles of five words to 80 % or more."""
    ship(spark)
    return near_duplicates.deduplicate(docs, width=5).select(*docs.columns)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with pseudonyms; n_chars follows the text."""
    out = pii.pseudonymise(docs, pii.configured_key(spark)).select(*docs.columns)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns) if "n_chars" in docs.columns else out


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as the mix takes them; a document taken twice is there twice."""
    ship(spark)
    return mixing.mix(docs).select(*docs.columns)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of the best segmentation of each document, summed up, and the scores of the next ones."""
    ship(spark)
    return sentence_pieces.digest(docs.select("doc_id", "source", "text"), sentence_pieces.model_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", hide_personal_data),
    ("source_mix", mix_sources),
    ("sentence_pieces", encode_pieces),
]
#: The stages score, hash and segment by models that SQL can't express; tests/llm/test_pipeline.py holds each stage against brute
#: force, SQL or its own parts on the driver.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = fresh(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
