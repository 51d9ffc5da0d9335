"""From raw documents to packed training sequences: five stages, each one of the operators in
``userlens.llm``, each over all that its predecessor kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet to the
shared folder and rereads it as the next one's docs. All stages but the last return the columns of
``documents``. The stages' docstrings say what becomes of odd rows. A CRF, a tokenizer and a
connected-components search have no SQL form, so ``ORACLE_SQL`` is None; tests hold every stage
against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from userlens.llm import decontaminate, jaccard, packing, quality, secrets
from userlens.llm.queries import tokenizer
from userlens.llm.shared import ship, written

ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or the line labels reject go. Null and empty texts have no words and go, so
    do repeated rows of a rejected text, each by itself; rows without an id are judged alike. An empty
    table stays empty; extra columns stay."""
    ship(spark)
    return quality.retain(docs, quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of linked documents (5-word shingles, Jaccard similarity 0.8 or more) the
    smallest doc_id stays; rows without an id stay. Texts without words are linked with nothing and stay;
    repeated rows (one id, one text) leave one; rows that share an id but not a text follow their own
    text. An empty table stays empty; extra columns stay, whatever their names."""
    ship(spark)
    return jaccard.one_of_each(docs, words=5, percent=80, prune=True)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go. Null and empty texts, and rows without an id, have no
    window of their own to go for and are judged by their text; repeated rows go or stay together; an empty
    table, or an empty benchmark, changes nothing; extra columns stay."""
    return decontaminate.remove_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text, and n_chars follows; all documents stay. A null text stays null, and
    repeated rows and rows without an id are masked each; an empty table stays empty; extra columns stay."""
    return secrets.redact(docs, secrets.ledger_path(spark))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens. A null or empty text has the end id alone, repeated
    rows are packed each, a null id stays, and extra columns aren't looked at."""
    ship(spark)
    return packing.pack_documents(docs, tokenizer("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
