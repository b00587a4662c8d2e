"""The preparation of a training corpus, stage by stage.

Every stage takes the documents that its predecessor kept. All but the last return the
columns of documents, whatever others these have.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsprep.llm.compression_bands import compression_verdicts
from newsprep.llm.decontamination import decontaminate
from newsprep.llm.packing import pack_binary
from newsprep.llm.pii_votes import find_personal_data
from newsprep.llm.queries import tokenizer
from newsprep.llm.shared import table, written
from newsprep.llm.simhash_tiles import keep_one_each
from newsprep.session import configure


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within the base rules and the compression bands stay."""
    judged = compression_verdicts(docs, prefix="quality_of_")
    return judged.filter("quality_of_kept").select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the least id."""
    return keep_one_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a twentieth of their words or more in benchmark windows go."""
    searched = decontaminate(docs, table(spark, sf_dir, "benchmark"), prefix="benchmark_of_")
    return searched.filter("NOT benchmark_of_contaminated").select(docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; n_chars follows where a text has changed."""
    found = find_personal_data(docs, prefix="private_")
    same = F.col("private_redacted").eqNullSafe(F.col("text"))
    length = F.length("private_redacted").cast("bigint")
    changes = {"text": F.col("private_redacted")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changes["n_chars"] = F.when(same, F.col("n_chars")).otherwise(length.cast(kind))
    return found.select(*(changes[c].alias(c) if c in changes else c for c in docs.columns))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are cut into sequences without padding."""
    return pack_binary(docs, tokenizer("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality),
    ("near-duplicate removal", near_dedup),
    ("benchmark decontamination", decontamination),
    ("personal data", personal_data),
    ("packing", packing),
]

#: Compression, SimHash, the label model and the tokenizer can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents, each reading what the one before has written."""
    docs = table(configure(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
