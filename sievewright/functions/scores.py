"""Score vectors held as ``array<double>`` columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from .labels import LABELS

# Ordered decision rules (label, probability must exceed), then the default.
RULES = (("Yes", 0.25), ("Maybe", 0.15))
DEFAULT_LABEL = "No"


def softmax(logits: Column) -> Column:
    """Exponentials of the distances to the maximum, divided by their sum."""
    shifted = F.transform(logits, lambda x: F.exp(x - F.array_max(logits)))
    return normalise(shifted)


def normalise(weights: Column) -> Column:
    total = F.aggregate(weights, F.lit(0.0), lambda a, x: a + x)
    return F.transform(weights, lambda x: x / total)


def argmax(p: Column) -> Column:
    """Index of the first maximum."""
    return (F.array_position(p, F.array_max(p)) - 1).cast("int")


def label_at(index: Column, labels: Sequence[str] = LABELS) -> Column:
    return F.get(F.array(*[F.lit(x) for x in labels]), index)


def confidence(p: Column) -> Column:
    """The largest probability, whichever label the rules choose."""
    return F.array_max(p)


def threshold_label(
    p: Column,
    labels: Sequence[str] = LABELS,
    rules: Sequence[tuple[str, float]] = RULES,
    default: str = DEFAULT_LABEL,
) -> Column:
    """First rule whose probability is exceeded (strictly); absent labels are skipped."""
    usable = [(name, cut) for name, cut in rules if name in labels]
    if not usable:
        return F.lit(default)
    chain = None
    for name, cut in usable:
        test = F.get(p, F.lit(list(labels).index(name))) > F.lit(cut)
        chain = F.when(test, name) if chain is None else chain.when(test, name)
    return chain.otherwise(default)


def needs_review(conf: Column, threshold: float) -> Column:
    """Flag for a scored row below the threshold; null where nothing was scored."""
    return conf < F.lit(threshold)


def weighted_mean(vectors: Sequence[Column], weights: Sequence[float]) -> Column:
    """Weighted average of probability vectors of equal length."""
    total = float(sum(weights))
    shares = [F.transform(v, _times(w / total)) for v, w in zip(vectors, weights)]
    out = shares[0]
    for share in shares[1:]:
        out = F.zip_with(out, share, lambda a, b: a + b)
    return out


def _times(factor: float):
    return lambda x: x * F.lit(factor)
