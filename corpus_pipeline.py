"""From raw documents to token ids: five stages over whole tables.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet
and read again as the next stage's documents. All but the last return the columns of ``documents``.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from feedback_loom.llm import decontaminate, line_dedup, minhash, sentencepiece_codec, toxicity, vocabularies
from feedback_loom.session import to_table


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are no more likely toxic than not, by a model of all labels."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def repeated_lines_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without blocks of lines, and passages inside lines, that an earlier document holds; ``n_chars`` is counted anew."""
    return line_dedup.without_repeats(docs).withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def near_duplicates_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates over shingles of five words at 0.8."""
    return minhash.without_near_duplicates(docs)


def benchmark_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The piece ids of each text and their number in place of the text."""
    found = sentencepiece_codec.encoded(docs, vocabularies.path("piece_bpe_32k.model"))
    return found.withColumn("n_tokens", F.size("ids")).drop("text")


STAGES = [
    ("toxicity", toxic_out),
    ("line dedup", repeated_lines_out),
    ("near-duplicates", near_duplicates_out),
    ("benchmark decontamination", benchmark_out),
    ("SentencePiece encoding", token_ids),
]

#: Models, alignment and a vocabulary file have no SQL form; the tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = to_table(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
