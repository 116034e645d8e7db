"""Reading texts and stop words; previewing, writing and reading back results."""

import uuid

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..session import to_table

DEFAULT_LANGUAGES = ("english", "french", "german", "spanish")
BAD_LINE = "__bad_line"
RESULT_TABLES = ("cluster_summary", "classified", "class_summary", "conclusion")
#: File that names the complete attempt of ``save_results``.
MARKER = "COMMITTED"
#: Bytes of text that a task of word work is given.
TEXT_BYTES = 16 << 20


def read_texts_csv(spark: SparkSession, path: str, schema: T.StructType | str = "content STRING",
                   sep: str = ",", quote: str = '"', escape: str = '"',
                   multi_line: bool = False) -> DataFrame:
    """CSV with a header line, an explicit schema and explicit quoting.

    ``multi_line`` lets quoted texts hold line breaks; a file is then read by one
    task, so keep such files many and small. Lines that do not fit the schema are left
    out; ``split_texts_csv`` gives them too.
    """
    return split_texts_csv(spark, path, schema, sep, quote, escape, multi_line)[0]


def split_texts_csv(spark: SparkSession, path: str, schema: T.StructType | str = "content STRING",
                    sep: str = ",", quote: str = '"', escape: str = '"',
                    multi_line: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows of a CSV, lines that do not fit its schema as ``line``); one bad line ends no job."""
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    read = (
        spark.read.schema(T.StructType([*fields.fields, T.StructField(BAD_LINE, T.StringType())]))
        .option("header", True)
        .option("sep", sep)
        .option("quote", quote)
        .option("escape", escape)
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", BAD_LINE)
        .option("columnPruning", False)
        .csv(path)
    )
    # the parsed rows are written once: Spark tells bad lines from good ones only while it reads all columns
    read = to_table(read, "parsed_csv")
    good = read.filter(F.col(BAD_LINE).isNull()).select(*fields.names)
    bad = read.filter(F.col(BAD_LINE).isNotNull()).select(F.col(BAD_LINE).alias("line"))
    return good, bad


def texts_from(df: DataFrame, content_col: str = "content", key: str | None = None,
               partitions: int | None = None) -> DataFrame:
    """Give any frame the columns ``row_id`` and ``content`` first.

    With no ``key`` ids are generated and written once, so that they stay the
    same whenever a task is run again. ``partitions`` spreads the rows over that many
    tasks, at the price of a shuffle of whole texts: for one small or unsplittable file.
    """
    others = [c for c in df.columns if c not in (content_col, key, "row_id", "content")]
    if key is not None:
        texts = df.select(F.col(key).alias("row_id"), F.col(content_col).alias("content"), *others)
        return texts.repartition(partitions, "row_id") if partitions else texts
    numbered = df.select(F.monotonically_increasing_id().alias("row_id"),
                         F.col(content_col).alias("content"), *others)
    return to_table(numbered, "texts")


def text_tasks(df: DataFrame, content_col: str = "content") -> int:
    """Tasks for word work: one per core, or as many more as keep ``TEXT_BYTES`` to each.

    What a task holds of its texts' words (counts per text, say) thus stays the same however many texts there are.
    """
    size = df.agg(F.sum(F.octet_length(content_col))).first()[0] or 0
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-size // TEXT_BYTES))


def split_usable(df: DataFrame, content_col: str = "content") -> tuple[DataFrame, DataFrame]:
    """(rows with text, rows whose text is null or blank)."""
    usable = F.coalesce(F.col(content_col).rlike(r"\S"), F.lit(False))
    return df.filter(usable), df.filter(~usable)


def read_stop_words(spark: SparkSession, path: str) -> DataFrame:
    """Distinct trimmed, lower-cased words of text files with one word per line."""
    return (
        spark.read.text(path)
        .select(F.lower(F.trim("value")).alias("term"))
        .filter(F.col("term").rlike(r"[\p{L}]"))
        .distinct()
    )


def default_stop_words(languages: tuple[str, ...] = DEFAULT_LANGUAGES) -> list[str]:
    """Union of the public stop word lists shipped with Spark, sorted."""
    found: set[str] = set()
    for language in languages:
        found.update(word.lower() for word in StopWordsRemover.loadDefaultStopWords(language))
    return sorted(found)


def preview(df: DataFrame, n: int = 5, order_by: str = "row_id") -> DataFrame:
    """First ``n`` rows in key order (a top-n, not a full sort)."""
    return df.orderBy(order_by).limit(n)


def preview_conclusion(conclusion: DataFrame, n: int = 3) -> DataFrame:
    return conclusion.filter(F.col("rank") <= n)


def save_results(results, path: str) -> None:
    """Write the four result tables as Parquet below ``path``, all or none.

    The tables go to a folder of this attempt; a marker written last names it. Readers follow the marker, so
    they never see some of the tables, or those of two attempts. A failed attempt is removed. The marker is
    made only where there is none: a second writer, at the same time too, ends with an error.
    """
    spark = results.classified.sparkSession
    if _committed(spark, path) is not None:
        raise FileExistsError(f"{path} already holds results")
    attempt = f"attempt-{uuid.uuid4().hex}"
    try:
        for name in RESULT_TABLES:
            getattr(results, name).write.mode("errorifexists").parquet(f"{path}/{attempt}/{name}")
        _commit(spark, path, attempt)
    except BaseException:
        files, place = _files(spark, f"{path}/{attempt}")
        files.delete(place, True)
        raise


def load_results(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The tables of a complete ``save_results``; an error if none was completed."""
    attempt = _committed(spark, path)
    if attempt is None:
        raise FileNotFoundError(f"{path} holds no complete results")
    return {name: spark.read.parquet(f"{path}/{attempt}/{name}") for name in RESULT_TABLES}


def _files(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _commit(spark: SparkSession, path: str, attempt: str) -> None:
    """Write the marker, unless there is one."""
    files, place = _files(spark, f"{path}/{MARKER}")
    out = files.create(place, False)
    out.write(bytearray(f"{attempt}\n".encode()))
    out.close()


def _committed(spark: SparkSession, path: str) -> str | None:
    files, place = _files(spark, f"{path}/{MARKER}")
    if not files.exists(place):
        return None
    # a folder of its own per attempt, 40 characters; a marker that was cut off while written is shorter
    found = [r.value for r in spark.read.text(f"{path}/{MARKER}").collect()]
    return found[0] if found and len(found[0]) == len("attempt-") + 32 else None
