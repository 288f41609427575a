"""From raw documents to tokens: toxic documents out, boilerplate lines out, one document of each group of
near-duplicates, benchmark leaks out, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; ``run`` writes each
result to the shared folder and reads it for the next stage. All stages but the last return the columns
of the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asiento.llm import byte_bpe, decontaminate, line_dedup, simhash_dedup, toxicity
from asiento.llm.common import stored
from asiento.llm.queries import tokenizer, toxicity_model


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; the labels are those of ``sf_dir``."""
    scored = toxicity.score_toxicity(docs, toxicity_model(spark, docs, sf_dir))
    return scored.filter(F.col(scored.columns[-1]) < toxicity.THRESHOLD).select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines out of every text; no document goes. ``n_chars`` counts what is left.

    Copies of a document in its source count once, so that they do not empty each other.
    """
    cleaned = line_dedup.drop_boilerplate(docs, copies_once=True).select(*docs.columns)
    return cleaned.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_dedup.keep_representatives(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, ids, n_tokens, ids_sha256, decoded_sha256`` of every document that is left."""
    return byte_bpe.tokenize(docs, *tokenizer())


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_lines),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_leaks),
    ("byte-level BPE", encode),
]

#: No SQL trains the classifier of the first stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stored(docs, f"stage_{number}")
    return docs
