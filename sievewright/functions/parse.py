"""Reading the answers of a text service."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from .text import WS, strip

# Texts the results carry.
PARSING_ERROR = "Parsing Error"
API_ERROR = "API Error"
NO_JUSTIFICATION = "Could not parse justification."
ERROR_MARK = "Error:"

EVALUATION_SCHEMA = T.StructType(
    [
        T.StructField("verdict_label", T.StringType()),
        T.StructField("evaluation_note", T.StringType()),
        T.StructField("strengths", T.ArrayType(T.StringType())),
        T.StructField("red_flags", T.ArrayType(T.StringType())),
        T.StructField("examples", T.ArrayType(T.StringType())),
    ]
)


def decision(c: Column, strict: bool = False) -> Column:
    """Decision named by the first non-blank line.

    By default 'no' counts anywhere in the line ('know' included); ``strict``
    asks for the whole word.
    """
    line = F.lower(F.regexp_substr(c, F.lit(f"[^{WS}][^\\n]*")))
    no = line.rlike(r"\bno\b") if strict else line.contains("no")
    return F.when(line.contains("advanced"), "Advanced").when(no, "No").otherwise(PARSING_ERROR)


def justification(c: Column) -> Column:
    """Text after the colon of the first line that starts with 'justification:'.

    UNIX-lines mode makes newline the only line end.
    """
    head = f"(?imd)^[{WS}]*justification:"
    hit = F.regexp_substr(c, F.lit(head + r"[^\n]*"))
    return F.coalesce(strip(F.regexp_replace(hit, r"(?d)\A[^:]*:", "")), F.lit(NO_JUSTIFICATION))


def manual_verdict(c: Column, failure: Column) -> Column:
    """Decision of a manual-review answer; a call that failed, whose exception text is in
    ``failure``, is an API Error."""
    return F.when(failure.isNotNull(), API_ERROR).otherwise(decision(c))


def manual_justification(c: Column, failure: Column) -> Column:
    """Justification of a manual-review answer; a failed call keeps its exception text."""
    return F.coalesce(failure, justification(c))


def is_error(c: Column) -> Column:
    return F.coalesce(c.contains(ERROR_MARK), F.lit(False))


def is_api_error(c: Column) -> Column:
    """The answer reports a key or permission failure."""
    keyed = F.lower(c).contains("api key") | c.contains("401") | c.contains("403")
    return F.coalesce(c.contains("Invalid API key") | (c.contains(ERROR_MARK) & keyed), F.lit(False))


def parse_evaluation(c: Column, schema: T.StructType = EVALUATION_SCHEMA) -> Column:
    """Structured answer as a struct; malformed text gives null fields."""
    return F.from_json(c, schema, {"mode": "PERMISSIVE"})
