"""Scores from a polarity lexicon, as a plan over whole tables."""

from pyspark.sql import DataFrame, functions as F

from ..functions.tokens import sql_list, term_rows, with_tokens
from ..session import BROADCAST_BYTES, combined_in_blocks, join_sized, to_table

#: Lexicons up to this size are matched inside the row; larger ones are joined.
ROW_LOCAL_TERMS = 50_000


def induce_lexicon(texts: DataFrame, labels: DataFrame, content_col: str = "content", row_id: str = "row_id",
                   min_texts: int = 5, min_log_odds: float = 0.5) -> DataFrame:
    """(term, polarity) from labelled texts (labels: row_id, positive BOOLEAN).

    Smoothed log odds of a word in positive against negative texts; its sign is the
    polarity. Words in few labelled texts or with weak odds are left out.
    """
    known = labels.filter(F.col("positive").isNotNull()).select(row_id, "positive")
    labelled = join_sized(texts.select(row_id, content_col), known, row_id)
    spelled = with_tokens(labelled, content_col).select(row_id, "positive", "tokens")
    sizes = spelled.agg(
        F.count_if(F.col("positive")).alias("P"), F.count_if(~F.col("positive")).alias("N")).first()
    terms = (
        spelled.select("positive", F.explode(F.array_distinct("tokens")).alias("term"))
        .groupBy("term")
        .agg(F.count_if(F.col("positive")).alias("pos"), F.count_if(~F.col("positive")).alias("neg"))
    )
    odds = (
        F.log((F.col("pos") + 1.0) / F.lit(sizes["P"] + 2.0)) - F.log((F.col("neg") + 1.0) / F.lit(sizes["N"] + 2.0))
    )
    return (
        terms.filter(F.col("pos") + F.col("neg") >= min_texts)
        .withColumn("log_odds", odds)
        .filter(F.abs("log_odds") >= min_log_odds)
        .select("term", F.signum("log_odds").alias("polarity"))
    )


def balance_score(total, weight):
    """0..10 from the sum of polarities and the sum of their sizes; 5 without any hit."""
    balance = F.floor(F.lit(5.5) + F.lit(5.0) * total / weight)
    return F.when(weight > 0, F.least(F.lit(10), F.greatest(F.lit(0), balance))).otherwise(5).cast("int")


def lexicon_scores(texts: DataFrame, lexicon: DataFrame, content_col: str = "content", score_col: str = "score",
                   row_id: str = "row_id", row_local_terms: int = ROW_LOCAL_TERMS,
                   max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Add ``score_col`` from the polarities of the distinct words of each text.

    A term that is listed more than once counts once, with the mean of its polarities; terms
    whose polarities cancel out are left out. A lexicon of signs that is proven small is matched inside each row by hash
    lookup: no exchange, the text is read once and passed on. A larger or weighted
    one is joined by word, in blocks of at most ``max_bytes`` that are broadcast one after the other, so a word of every
    text is no hot key; only ids and partial sums are exchanged before the scores are joined back.
    """
    lexicon = (lexicon.groupBy("term").agg(F.avg("polarity").alias("polarity"))
               .filter(F.col("term").isNotNull() & (F.col("polarity") != 0)))
    head = lexicon.select("term", F.col("polarity").cast("double").alias("polarity")).limit(row_local_terms + 1).collect()
    if len(head) <= row_local_terms and all(r.polarity in (1.0, -1.0) for r in head):
        found = {
            sign: F.expr(f"size(filter(__tokens, w -> w IN ({sql_list([r.term for r in head if r.polarity == sign] or [''])})))")
            for sign in (1.0, -1.0)
        }
        return (
            with_tokens(texts, content_col, "__tokens")
            .withColumn("__tokens", F.array_distinct("__tokens"))
            .withColumns({"__p": found[1.0], "__n": found[-1.0]})
            # explode keeps a later filter on the score from being pushed below it, which
            # would find the words of every text once for each mention of the score
            .select("*", F.explode(F.array(balance_score(
                F.col("__p") - F.col("__n"), F.col("__p") + F.col("__n")))).alias(score_col))
            .drop("__tokens", "__p", "__n")
        )
    hits = term_rows(with_tokens(texts.select(row_id, content_col), content_col), row_id, distinct=True)

    def polarities(joined: DataFrame) -> DataFrame:
        return joined.groupBy(row_id).agg(F.sum("polarity").alias("__p"), F.sum(F.abs("polarity")).alias("__w"))

    parts = combined_in_blocks(hits, to_table(lexicon, "lexicon"), "term", polarities, max_bytes)
    sums = parts.groupBy(row_id).agg(F.sum("__p").alias("__p"), F.sum("__w").alias("__w"))
    return (
        texts.join(sums, row_id, "left")
        .withColumn(score_col, balance_score(F.coalesce("__p", F.lit(0.0)), F.coalesce("__w", F.lit(0.0))))
        .drop("__p", "__w")
    )
