"""Label cleaning, verdict normalisation and row masks."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import has_text, is_blank, strip, title_case

# The accepted spellings. Everything else, null included, is No.
YES_WORDS = ("yes", "y", "advanced")
NO_WORDS = ("no", "n", "reject")
MAYBE_WORDS = ("maybe", "may be", "yse", "manual intervention", "manual")
LABELS = ("Maybe", "No", "Yes")  # the closed label set, in index order

REJECT = "Reject"
MANUAL = "Manual Intervention"


def norm(c: Column) -> Column:
    return F.lower(strip(c))


def clean_label(c: Column) -> Column:
    """Free spelling -> Yes / No / Maybe; null, blank and unknown -> No."""
    n = norm(c)
    return F.when(n.isin(*YES_WORDS), "Yes").when(n.isin(*MAYBE_WORDS), "Maybe").otherwise("No")


def reject_applies(verdict: Column, result: Column) -> Column:
    """The row has no verdict yet and the earlier result was a rejection."""
    return is_blank(verdict) & F.coalesce(norm(result) == "reject", F.lit(False))


def map_reject(verdict: Column, result: Column) -> Column:
    return F.when(reject_applies(verdict, result), F.lit("No")).otherwise(verdict)


def normalise_verdict(c: Column) -> Column:
    return title_case(strip(c))


def not_rejected(normalised: Column) -> Column:
    """Keeps errors, unknown answers and nulls: only an exact 'Reject' is dropped."""
    return ~normalised.eqNullSafe(F.lit(REJECT))


def needs_manual(normalised: Column) -> Column:
    return normalised.eqNullSafe(F.lit(MANUAL))


def has_interview(transcript: Column) -> Column:
    return has_text(transcript)


def to_predict(verdict: Column | None, predict_all: bool = False) -> Column:
    """Mask of rows to score: empty verdicts, or all rows on request or when the
    table has no verdict column (``None``)."""
    if predict_all or verdict is None:
        return F.lit(True)
    return is_blank(verdict)


def fill_empty(verdict: Column, mask: Column, predicted: Column) -> Column:
    return F.when(mask, predicted.cast("string")).otherwise(verdict)
