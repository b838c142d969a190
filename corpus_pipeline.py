"""The corpus pipeline: toxicity, near-duplicates, decontamination, mixing, token files."""

from pyspark.sql import DataFrame, SparkSession

from chronolex.llm import decontaminate, mixing, near_copies, token_files, toxicity
from chronolex.sources.scratch import fresh_path, materialize, name_folder


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are predicted to be toxic go."""
    return toxicity.keep_clean(docs, _table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component stays, the one with the smallest id.

    By SimHash blocks at the default of this kind of stage: shingles of five words, a similarity of 0.8 or more.
    """
    return near_copies.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.keep_uncontaminated(docs, _table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.mix(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files, and per document what they hold: doc_id, start, n_tokens, ids_crc32."""
    folder = fresh_path(spark, "pipeline-token-files")
    return token_files.read(token_files.write(docs, folder), folder)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("token_files", write_tokens),
]

# Learned scores, SimHash, a latent search and byte-pair ids: no stage but mixing's sums is one for SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to `documents`; each one's result is written and read again. Runs actions."""
    name_folder(spark)
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
