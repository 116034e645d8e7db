"""Words of a text as an array column, without leaving the JVM."""

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

# Fixed patterns: runs of two or more word characters that are not digits only,
# and the range of Han characters, which carry no spaces between words.
WORD_PATTERN = r"(?![0-9]+(?![\p{L}\p{N}_]))[\p{L}\p{N}_]{2,}"
HAN = "一-鿿"
MIXED_PATTERN = rf"[{HAN}]{{2,}}|(?![0-9]+(?![\p{{L}}\p{{N}}_]))[\p{{L}}\p{{N}}_&&[^{HAN}]]{{2,}}"


def words(text: Column) -> Column:
    """Lower-cased words; runs of Han characters give overlapping pairs."""
    lowered = F.lower(text)
    plain = F.regexp_extract_all(lowered, F.lit(WORD_PATTERN), F.lit(0))
    pieces = F.transform(
        F.regexp_extract_all(lowered, F.lit(MIXED_PATTERN), F.lit(0)),
        lambda run: F.when(
            run.rlike(f"^[{HAN}]"),
            F.transform(F.sequence(F.lit(1), F.length(run) - 1), lambda i: F.substring(run, i, F.lit(2))),
        ).otherwise(F.array(run)),
    )
    return F.when(text.rlike(f"[{HAN}]"), F.flatten(pieces)).otherwise(plain)


def sql_list(values: list[str]) -> str:
    """Values as a quoted SQL list; ``IN`` over it becomes one hash lookup per word."""
    quoted = (v.replace("\\", "\\\\").replace("'", "\\'") for v in values)
    return ", ".join(f"'{v}'" for v in quoted)


def segmented_words(segmenter):
    """Pandas UDF around a user function ``list[str] -> list[list[str]]``."""

    def cut_batch(texts: pd.Series) -> pd.Series:
        return pd.Series(list(segmenter(texts.tolist())), dtype="object")

    return F.pandas_udf(cut_batch, "array<string>")


def stop_list(stop_words: list[str] | DataFrame | None) -> list[str]:
    """Stop words as a list; a frame (``read_stop_words``) gives those of its first column.

    A stop list is a few thousand words, so it is read by the driver and becomes part of the plan.
    """
    if isinstance(stop_words, DataFrame):
        return sorted(r[0] for r in stop_words.select(F.lower(F.trim(F.col(stop_words.columns[0])))).distinct().collect() if r[0])
    return list(stop_words or [])


def with_tokens(df: DataFrame, content_col: str = "content", tokens_col: str = "tokens",
                stop_words: list[str] | DataFrame | None = None, segmenter=None) -> DataFrame:
    """Add the cleaned words of ``content_col``; no stop word, one-character or all-digit word."""
    stop_words = stop_list(stop_words)
    if segmenter is None:
        spelled = words(F.col(content_col))
    else:
        spelled = F.filter(
            F.transform(segmented_words(segmenter)(F.col(content_col)), lambda w: F.lower(F.trim(w))),
            lambda w: (F.length(w) > 1) & w.rlike(r"[\p{L}\p{N}_]") & ~w.rlike(r"^[0-9]+$"),
        )
    df = df.withColumn(tokens_col, F.coalesce(spelled, F.array().cast("array<string>")))
    if stop_words:
        df = df.withColumn(tokens_col, F.expr(f"filter(`{tokens_col}`, w -> w NOT IN ({sql_list(stop_words)}))"))
    return df


def term_rows(df: DataFrame, row_id: str = "row_id", tokens_col: str = "tokens",
              distinct: bool = False) -> DataFrame:
    """One row per word occurrence, or per distinct word, of each text."""
    tokens = F.array_distinct(tokens_col) if distinct else F.col(tokens_col)
    return df.select(row_id, F.explode(tokens).alias("term"))
