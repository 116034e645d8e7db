"""Column expressions on scores, shares and pending results.

All are stateless built-in expressions: they stay inside code generation, can be
pushed down by the optimizer and also apply to a streaming frame.
"""

from pyspark.sql import Column, functions as F

# Limits of the score bands, [0,3] negative, (3,6] neutral, (6,10] positive.
NEGATIVE_UP_TO = 3
NEUTRAL_UP_TO = 6
SCORE_MIN = 0
SCORE_MAX = 10


def pending_value(data_type: str = "string") -> Column:
    """An empty result column; NULL marks a row that still lacks its result."""
    return F.lit(None).cast(data_type)


def is_pending(result: Column) -> Column:
    return result.isNull()


def as_double(score: Column) -> Column:
    """Score as DOUBLE; text that is no number becomes NULL."""
    return score.try_cast("double")


def sentiment_band(score: Column) -> Column:
    return (
        F.when(score <= NEGATIVE_UP_TO, "negative")
        .when(score <= NEUTRAL_UP_TO, "neutral")
        .when(score.isNotNull(), "positive")
    )


def is_negative(score: Column, up_to: float = NEGATIVE_UP_TO) -> Column:
    return score <= up_to


def percent_value(share: Column) -> Column:
    """Share in percent with two decimals, halves to even."""
    return F.bround(share * 100, 2)


def percent_text(share: Column) -> Column:
    return F.concat(percent_value(share).cast("string"), F.lit("%"))


def line_through(k: Column, first_k: Column, first_y: Column, last_k: Column, last_y: Column) -> Column:
    """Value at ``k`` of the straight line through two points (constant if they coincide)."""
    slope = F.when(last_k == first_k, F.lit(0.0)).otherwise((last_y - first_y) / (last_k - first_k))
    return first_y + slope * (k - first_k)
