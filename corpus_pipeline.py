"""A corpus in five stages; each reads what the one before it wrote."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.llm import bpe, decontaminate, pii, simhash, toxicity
from lamina.llm.shared import stage, table
from lamina.session import run_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the toxicity model, trained on this corpus' labels, rejects."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, model, COLUMNS).where("predicted = 0").select(*COLUMNS)


#: Bytes of row addresses that may be broadcast; beyond, the rows to drop are joined by a shuffle.
MOST_ADDRESSES, ADDRESS = 64 << 20, 200


def addressed(docs: DataFrame) -> DataFrame:
    """The documents with each row's place: its file and its number there.  What isn't a plain scan is written first."""
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")]
    try:
        return docs.select(*COLUMNS, *place)
    except AnalysisException:
        return stage(docs.select(*COLUMNS), "documents").select(*COLUMNS, *place)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each SimHash component the row with its smallest doc_id; of several such rows the first by its place.

    The rule is that of the operator's query: three-word shingles and three
    bits.  Rows without a doc_id come after all others.  Decisions are made on
    ids, fingerprints and places; what joins the texts are the places of the
    rows to drop.
    """
    own = addressed(docs)
    found = stage(simhash.near_duplicates(own, ("file", "row")).select("root", "doc_id", "file", "row"), "found")
    head = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "file", "row")).alias("head")
    kept = found.groupBy("root").agg(head).select("root", F.col("head.file").alias("kept_file"), F.col("head.row").alias("kept_row"))
    others = (F.col("file") != F.col("kept_file")) | (F.col("row") != F.col("kept_row"))
    dropped = stage(found.join(kept, "root").where(others).select("file", "row"), "dropped")
    dropped = F.broadcast(dropped) if dropped.count() * ADDRESS <= MOST_ADDRESSES else dropped
    return own.join(dropped, ["file", "row"], "left_anti").select(*COLUMNS)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), COLUMNS)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind's name; n_chars follows."""
    return pii.redact(docs, COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the text decoded from them."""
    return bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", keep_civil),
    ("near_dedup", keep_one_of_near_copies),
    ("decontamination", keep_uncontaminated),
    ("pii", mask_personal_data),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    root = f"{run_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, step in STAGES[:-1]:
        step(spark, docs, sf_dir).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: The classifier, the tokenizer and XXH64 are beyond DuckDB's SQL; tests hold the stages against brute force.
ORACLE_SQL = None
