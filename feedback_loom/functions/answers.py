"""Reading and checking delimited model answers with column expressions."""

from pyspark.sql import Column, functions as F

# Fixed values of the answer format: delimiters, headings and the fallback label.
ITEM_SEP = "<sep>"
PAIR_ITEM_SEP = "<sep0>"
PAIR_LIST_SEP = "<sep1>"
ISSUES_HEADING = "体验问题"
REASONS_HEADING = "推理原因"
HEADING_COLON = "："
FALLBACK_LABEL = "其他问题"

# Fixed patterns of the answer format. \p{L}\p{N}_ are word characters of any script.
SCORE_LIST_PATTERN = r"^(([0-9]|10)<sep>)*([0-9]|10)$"
NUMBERED_ITEM_PATTERN = r"(?s)[0-9]+.([\p{L}\p{N}_]+)"
NUMBERED_LIST_PATTERN = r"(?s)^([0-9]+.[\p{L}\p{N}_]+,)*[0-9]+.[\p{L}\p{N}_]+$"

# Outcomes of a check.
OK = "ok"
MISSING = "missing"          # no answer at all
COUNT = "count"              # number of items differs from number of texts
FORMAT = "format"            # an item is no whole score 0..10
LABEL = "label"              # an item is outside the label set
OMITTED = "omitted"          # a section heading is absent
SEPARATOR = "separator"      # not exactly two lists
PAIR_COUNT = "pair_count"    # the two lists differ in length


def strip_outer(answer: Column, sep: str = ITEM_SEP) -> Column:
    """Drop outer whitespace, then whole delimiters at either end."""
    bare = F.regexp_replace(answer, r"^\s+|\s+$", "")
    return F.regexp_replace(bare, f"^({sep})+|({sep})+$", "")


def split_items(answer: Column, sep: str = ITEM_SEP) -> Column:
    return F.split(strip_outer(answer, sep), sep, -1)


def item_count(answer: Column, sep: str = ITEM_SEP) -> Column:
    return F.size(split_items(answer, sep))


def without_delimiters(text: Column) -> Column:
    """Text that cannot be mistaken for several items of a batch."""
    return F.regexp_replace(text, "<sep[01]?>", " ")


def score_list_status(answer: Column, expected: Column) -> Column:
    return (
        F.when(answer.isNull(), MISSING)
        .when(item_count(answer) != expected, COUNT)
        .when(~strip_outer(answer).rlike(SCORE_LIST_PATTERN), FORMAT)
        .otherwise(OK)
    )


def label_list_status(answer: Column, expected: Column, labels: Column) -> Column:
    """``labels`` is the label set as an array column; one miss fails the answer."""
    return (
        F.when(answer.isNull(), MISSING)
        .when(item_count(answer) != expected, COUNT)
        .when(F.size(F.array_except(split_items(answer), labels)) > 0, LABEL)
        .otherwise(OK)
    )


def issue_list_status(answer: Column) -> Column:
    """Check of an answer that pairs a list of issues with a list of reasons."""
    lists = split_items(answer, PAIR_LIST_SEP)
    return (
        F.when(answer.isNull(), MISSING)
        .when(~(answer.contains(ISSUES_HEADING) & answer.contains(REASONS_HEADING)), OMITTED)
        .when(F.size(lists) != 2, SEPARATOR)
        .when(F.size(F.split(F.get(lists, F.lit(0)), PAIR_ITEM_SEP, -1))
              != F.size(F.split(F.get(lists, F.lit(1)), PAIR_ITEM_SEP, -1)), PAIR_COUNT)
        .when(issues_of(answer).isNull(), OMITTED)
        .otherwise(OK)
    )


def reason_list_status(answer: Column) -> Column:
    return (
        F.when(answer.isNull(), MISSING)
        .when(~answer.contains(REASONS_HEADING + HEADING_COLON), OMITTED)
        .otherwise(OK)
    )


def _section(answer: Column, pattern: str, sep: str) -> Column:
    found = F.regexp_extract_all(answer, F.lit(pattern), F.lit(1))
    return F.regexp_replace(F.get(found, F.lit(0)), sep, ",")


def issues_of(answer: Column) -> Column:
    """Issues of a paired answer, comma separated."""
    return _section(
        answer,
        f"(?s){ISSUES_HEADING}{HEADING_COLON}(.*){PAIR_LIST_SEP}.*{REASONS_HEADING}{HEADING_COLON}",
        PAIR_ITEM_SEP,
    )


def paired_reasons_of(answer: Column) -> Column:
    """Reasons of a paired answer, comma separated."""
    return _section(
        strip_outer(answer, PAIR_LIST_SEP),
        f"(?s){ISSUES_HEADING}{HEADING_COLON}.*{PAIR_LIST_SEP}.*{REASONS_HEADING}{HEADING_COLON}(.*)",
        PAIR_ITEM_SEP,
    )


def reasons_of(answer: Column) -> Column:
    """Causes after the reasons heading, comma separated."""
    found = F.regexp_extract_all(answer, F.lit(f"(?s){REASONS_HEADING}{HEADING_COLON}(.*)"), F.lit(1))
    bare = F.regexp_replace(F.get(found, F.lit(0)), r"^\s+|\s+$", "")
    return F.regexp_replace(bare, ITEM_SEP, ",")


def numbered_labels(answer: Column) -> Column:
    """Labels of a numbered list; a label ends at the first non-word character."""
    listed = F.regexp_replace(strip_outer(answer), ITEM_SEP, ",")
    return F.regexp_extract_all(listed, F.lit(NUMBERED_ITEM_PATTERN), F.lit(1))


def is_numbered_list(answer: Column) -> Column:
    return F.regexp_replace(strip_outer(answer), ITEM_SEP, ",").rlike(NUMBERED_LIST_PATTERN)


def review_decision(answer: Column) -> Column:
    """accept (``y``), redo (``n`` or ``n<sep>hint``), replace (numbered list) or invalid."""
    return (
        F.when(answer == "y", "accept")
        .when((answer == "n") | answer.startswith("n" + ITEM_SEP), "redo")
        .when(is_numbered_list(answer), "replace")
        .otherwise("invalid")
    )


def review_hint(answer: Column) -> Column:
    """Hint of a redo answer: the part after its last delimiter."""
    return F.when(answer.startswith("n" + ITEM_SEP), F.element_at(F.split(answer, ITEM_SEP, -1), -1))
