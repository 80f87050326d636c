"""The corpus pipeline: toxicity, line dedup, SimHash near-dedup, substring dedup, best-fit packing.

Each stage takes (spark, docs, sf_dir); docs has the columns of documents. ``run`` writes every
stage's result to the shared folder and goes on from the written table. Rows without a doc_id leave in the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sumac.session import freeze

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
CARRIED = ("lang", "source", "n_chars")


def _documents(found: DataFrame) -> DataFrame:
    """The columns of documents; a changed text has its new length. A null text has become an empty one."""
    length = F.when(F.col("n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return found.withColumn("n_chars", length).select(*COLUMNS)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below one half stay; a null text is scored as an empty one, rows that repeat an id are judged each."""
    from sumac.llm.toxicity import fit, keep_clean

    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return keep_clean(docs, model).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines nearly equal to an earlier line go; a document that loses its last word so goes with them."""
    from sumac.llm.lines import deduplicated_lines

    found = deduplicated_lines(docs, similarity=0.8, carry=CARRIED)
    emptied = (F.col("n_removed") > 0) & ~F.col("text").rlike(r"\S")
    return _documents(found.filter(~emptied))


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints of three-word shingles link at 3 or fewer bits, directly or over others, the one of the smallest doc_id stays."""
    from sumac.llm.simhash import simhash_groups

    groups = simhash_groups(docs, shingle=3, distance=3)
    return docs.join(groups.filter("doc_id = component_id").select("doc_id"), "doc_id", "left_semi").select(*COLUMNS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of 50 words that occur earlier go."""
    from sumac.llm.substrings import without_repeats

    found = without_repeats(docs, window=50, period=31, cover=(1, 5, 11, 24, 25, 27), carry=CARRIED, as_written=True)
    return _documents(found.withColumnRenamed("kept", "text"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in sequences of at most 2048 ids; a null text has the end id alone, rows that repeat an id are packed each."""
    import public_tokenizers

    from sumac.llm.packing import packed_sequences

    return packed_sequences(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=2048, end_id=0)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("simhash", simhash),
    ("substring_dedup", substring_dedup),
    ("packing", packing),
]

#: SQL expresses neither the classifier nor the tokenizer; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = freeze(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
