"""A corpus pipeline of five stages over ``documents``.

Toxic documents go, one document of each group of near-duplicates stays,
documents with benchmark passages go, sources are mixed to target weights, and
what remains is written as token ids and read back as an index (doc_id, start,
n_tokens, ids_crc32).  Each stage works on all that its predecessor kept and
returns the columns it was given, of any names; the last returns the index.

Defined results: null text is empty, is not toxic or contaminated by itself, has no
near-duplicates, 0 tokens for the mixing (which keeps it) and the end id alone in the index;
null lang and source are values like others; a null doc_id is never a duplicate; rows that
repeat a doc_id go or stay together, but for toxicity and decontamination, which look at each row; an
empty table gives an empty index.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dssforge.llm import decontam, minhash, mixing, token_store, toxicity
from dssforge.llm.store import Scratch, small

#: Words of a shingle in the near-duplicate stage.
SHINGLE_WORDS = 5

#: The fields learned and the hash samples drawn have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


NEEDED = ("doc_id", "text", "lang", "source")


def _apart(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """``docs`` with its further columns named by their place, so that no stage's own column can clash with one of them, and the names to give back."""
    return docs.toDF(*(name if name in NEEDED else f"further_{i}" for i, name in enumerate(docs.columns))), docs.columns


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays under the threshold."""
    rows, names = _apart(docs)
    model = toxicity.learn(rows, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(rows, model).where(F.col("toxicity") < toxicity.THRESHOLD).select(*rows.columns).toDF(*names)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest doc_id of each group; rows without words or without a doc_id stay."""
    rows, names = _apart(docs)
    found = minhash.near_duplicates(rows, width=SHINGLE_WORDS)
    gone = Scratch(spark).keep(found.where(~F.col("kept")).select(F.col("doc_id").alias("gone")).distinct(), "gone")
    return rows.join(small(gone), F.col("doc_id") == F.col("gone"), "left_anti").toDF(*names)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark window occurs."""
    rows, names = _apart(docs)
    return decontam.decontaminate(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), remove="documents").toDF(*names)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens follow the tempered shares of sources, languages and topics."""
    rows, names = _apart(docs)
    return mixing.mix(rows).where("mix_kept").select(*rows.columns).toDF(*names)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Index of the token ids of all documents, read back from the written blocks."""
    path = Scratch(spark).path("tokens")
    token_store.write_tokens(docs.select("doc_id", "text"), path, token_store.tokenizer_path())
    return token_store.read_index(spark, path)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_output", write_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again."""
    docs, scratch = spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark)
    for name, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return docs
