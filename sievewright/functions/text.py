"""Text expressions with Python string semantics, built from JVM functions.

Spark's ``trim`` removes U+0020 only, ``\\s`` and ``\\w`` of its regex engine are
ASCII, and ``initcap`` knows blanks as the only word border. The screening rules
are stated for Python strings, so the character classes are spelled out here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Every character Python's str.strip() removes; none lies above U+3000.
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())

# The same set as a regex class body, and the word characters.
WS = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WORD = r"\p{L}\p{N}_"
CASED = r"\p{IsLowercase}\p{IsUppercase}\p{Lt}"

# Patterns and texts the results depend on.
TITLE_PREFIX = rf"(?i)title[{WS}]*[:\-][{WS}]*"
PROFILE_URL = rf"https?://(?:www\.)?linkedin\.com/in/[{WORD}\-/]+"
DEFAULT_ROLE = "the Role"
NO_PROFILE = "Not Present"
# Characters a profile keeps; ")-\[" is a range that spans digits, capitals and + - / < = > @.
PROFILE_KEEP = rf"{WORD}{WS}.,;:!?()-\[\]#*"


def strip(c: Column) -> Column:
    """``str.strip()``: one pass over the ends, no regex."""
    return F.trim(c, F.lit(WHITESPACE))


def has_text(c: Column) -> Column:
    """True when something but white space is present; stops at the first such
    character. Null gives false."""
    return F.coalesce(c.rlike(f"[^{WS}]"), F.lit(False))


def is_blank(c: Column) -> Column:
    return ~has_text(c)


def combined_text(job: Column, resume: Column) -> Column:
    """Job and résumé with one blank between, nulls as empty text."""
    return F.concat(F.coalesce(job, F.lit("")), F.lit(" "), F.coalesce(resume, F.lit("")))


def title_case(c: Column) -> Column:
    """``str.title()``: a capital after every character without case.

    The text is cut into runs with and without case; ``initcap`` then title-cases
    each run, which also gets sharp s, ligatures and final sigma right.
    """
    runs = F.regexp_extract_all(c, F.lit(f"[{CASED}]+|[^{CASED}]+"), F.lit(0))
    return F.array_join(F.transform(runs, F.initcap), "")


def phone_digits(c: Column, dtype: T.DataType | None = None) -> Column:
    """Last ten digits of a phone number; null gives ''.

    Floating columns are written without exponent or decimals first.
    """
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        # NaN is how a frame without nulls marks a missing number.
        c = F.when(~F.isnan(c), F.format_string("%.0f", c.cast("double")))
    elif isinstance(dtype, T.DecimalType):
        c = F.bround(c, 0).cast("decimal(38,0)").cast("string")
    else:
        c = c.cast("string")
    return F.coalesce(F.right(F.regexp_replace(c, r"[^\p{Nd}]", ""), F.lit(10)), F.lit(""))


def clean_phone(df: DataFrame, source: str = "phone", target: str = "phone") -> DataFrame:
    """Clean a phone column of any type and give it the canonical name."""
    cleaned = df.withColumn(source, phone_digits(F.col(f"`{source}`"), df.schema[source].dataType))
    return cleaned if source == target else cleaned.withColumnRenamed(source, target)


def job_title(c: Column) -> Column:
    """Text after the first ``title:`` / ``title -``; 'the Role' without one.

    The long text is searched once; the prefix is cut from the short match.
    """
    hit = F.regexp_substr(c, F.lit(TITLE_PREFIX + r"[^\n\r]+"))
    return F.coalesce(strip(F.regexp_replace(hit, "^" + TITLE_PREFIX, "")), F.lit(DEFAULT_ROLE))


def profile_url(c: Column, pattern: str = PROFILE_URL, default: str = NO_PROFILE) -> Column:
    """First profile address in the raw text (before any case change)."""
    return F.coalesce(F.regexp_substr(c, F.lit(pattern)), F.lit(default))


NO_NAME = "Not Provided"


def first_name(c: Column, default: str = "Candidate") -> Column:
    """Text before the first blank; the default for null, empty and not provided names."""
    return F.when(F.coalesce(c, F.lit("")).isin("", NO_NAME), F.lit(default)).otherwise(F.substring_index(c, " ", 1))


def hyperlink(label: str, url: Column, missing: str | None = None) -> Column:
    """Markdown link, or a note when there is no address."""
    note = missing if missing is not None else f"[{label} Not Provided]"
    present = F.coalesce(url, F.lit("")) != ""
    return F.when(present, F.concat(F.lit(f"[{label}]("), url, F.lit(")"))).otherwise(F.lit(note))


def profile_link(url: Column) -> Column:
    """Link for an extracted profile address, which is 'Not Present' when absent."""
    return F.when(url != NO_PROFILE, F.concat(F.lit("[LinkedIn]("), url, F.lit(")"))).otherwise(
        F.lit("[LinkedIn Not Present]")
    )


def clean_profile(c: Column, keep_lines: bool = False) -> Column:
    """Drop fence words and characters outside the kept class, fold white space.

    Braces fall outside the class. ``keep_lines`` folds only blanks within lines.
    """
    c = F.regexp_replace(c, r"markdown\n?", "")
    c = F.regexp_replace(c, f"[^{PROFILE_KEEP}]", "")
    if keep_lines:
        c = F.regexp_replace(c, f"[{WS}&&[^\\n]]+", " ")
    else:
        c = F.regexp_replace(c, f"[{WS}]+", " ")
    return strip(c)
