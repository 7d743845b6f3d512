"""Five stages from raw documents to token ids; each works on all that the one before kept.

Extra columns, whatever their names, go through to the last stage. Null and empty texts pass until the mixing, which never
takes documents without words. Empty tables give empty results. Rows that share an id or have none are documents of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeforge.llm import bpe, minhash, mixing, pii, toxicity
from lakeforge.llm.common import staged, table
from lakeforge.llm.queries import tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator predicts as toxic go; null and empty texts stay."""
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, model).where("predicted = 0").select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays; rows are told apart by id and text, and texts without words all stay."""
    return minhash.deduplicated(docs, k=5, percent=80)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; the length is counted anew."""
    kind, length = docs.schema["n_chars"].dataType, F.length(F.col("text"))
    return pii.redact(docs).withColumn("n_chars", F.coalesce(length, F.col("n_chars")).cast(kind))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    mixed = mixing.mix(docs).where("copies > 0")
    return mixed.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and digests of them and of what they decode to."""
    coded = bpe.round_trip(docs, tokenizer_path())
    return bpe.digest(coded)


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash near-dedup", drop_near_duplicates),
    ("pii", mask_personal_data),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: Learned scores, hash tables and tokenizer ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), []
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), *before)
        before = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
