"""Prompt rendering. Template texts are the caller's data; none are shipped."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, functions as F

from .parse import is_error

_SLOT = re.compile(r"\{([a-z_][a-z0-9_]*)\}")

# Texts that take the place of missing input.
NOT_AVAILABLE = "Not Available"
NOT_PROVIDED = "Not Provided"
MISSING_INPUT = "Error: Cannot generate summary because Job Description or Resume Text is missing."
NO_INTERVIEW = "Interview not conducted or transcript unavailable."


def slots_of(template: str) -> list[str]:
    return list(dict.fromkeys(_SLOT.findall(template)))


def render_template(template: str, slots: Mapping[str, Column], null_text: str = "") -> Column:
    """``{slot}`` markers replaced by columns, as one ``concat``.

    Markers without a column raise; null values show as ``null_text``.
    """
    unknown = [s for s in slots_of(template) if s not in slots]
    if unknown:
        raise ValueError(f"Template slots without a column: {unknown}")
    parts: list[Column] = []
    pos = 0
    for m in _SLOT.finditer(template):
        if m.start() > pos:
            parts.append(F.lit(template[pos : m.start()]))
        parts.append(F.coalesce(slots[m.group(1)].cast("string"), F.lit(null_text)))
        pos = m.end()
    if pos < len(template):
        parts.append(F.lit(template[pos:]))
    return F.concat(*parts) if parts else F.lit("")


def input_error(job: Column, resume: Column) -> Column:
    """Error text when job or résumé is null or empty, else null."""
    missing = (F.coalesce(job, F.lit("")) == "") | (F.coalesce(resume, F.lit("")) == "")
    return F.when(missing, F.lit(MISSING_INPUT))


def upstream_error(answer: Column) -> Column:
    """The upstream error text to pass through, else null."""
    return F.when(is_error(answer), answer)


def metric_slot(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(NOT_AVAILABLE))


def interview_metrics(duration: Column) -> dict[str, Column]:
    """Slots of the spoken signals; only the duration is ever measured."""
    na = F.lit(NOT_AVAILABLE)
    return {"duration": metric_slot(duration), "wpm": na, "fillers": na, "pauses": na}
