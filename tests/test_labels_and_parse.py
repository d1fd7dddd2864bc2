from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from sievewright.functions import labels as lab, parse, scores as sc, templates as tpl


def test_clean_label(column):
    cases = {
        " YES ": "Yes", "y": "Yes", "Advanced": "Yes", "no": "No", "N": "No", "Reject": "No", "maybe": "Maybe",
        "may be": "Maybe", "yse": "Maybe", "Manual Intervention": "Maybe", " manual\t": "Maybe", "nan": "No",
        "": "No", " ": "No", "perhaps": "No",
    }
    assert column(list(cases), lab.clean_label) == list(cases.values())
    assert column([None], lab.clean_label) == ["No"]


def test_reject_mapping(spark):
    df = spark.createDataFrame(
        [(None, " reject "), (" ", "REJECT"), ("Yes", "reject"), (None, "advanced"), (None, None)], "v string, r string"
    )
    out = df.select(lab.map_reject(F.col("v"), F.col("r")), lab.reject_applies(F.col("v"), F.col("r"))).collect()
    assert [tuple(r) for r in out] == [("No", True), ("No", True), ("Yes", False), (None, False), (None, False)]


def test_verdict_filters(column):
    values = ["reject ", "ADVANCED", "manual intervention", "Error: x", None]
    assert column(values, lab.normalise_verdict) == ["Reject", "Advanced", "Manual Intervention", "Error: X", None]
    norm = ["Reject", "Advanced", "Manual Intervention", None]
    assert column(norm, lab.not_rejected) == [False, True, True, True]
    assert column(norm, lab.needs_manual) == [False, False, True, False]


def test_prediction_mask(column):
    values = [None, "", " \t", "nan", "Yes"]
    assert column(values, lab.to_predict) == [True, True, True, False, False]
    assert column(values, lambda c: lab.to_predict(c, predict_all=True)) == [True] * 5
    assert column(values, lambda c: lab.to_predict(None)) == [True] * 5


DECISIONS = [
    ("Final Decision: Advanced\nJustification: a: b", "Advanced", "a: b"),
    ("final decision: NO", "No", parse.NO_JUSTIFICATION),
    ("Unclear", "Parsing Error", parse.NO_JUSTIFICATION),
    ("", "Parsing Error", parse.NO_JUSTIFICATION),
    ("\n \n  Advanced, not no\n  JUSTIFICATION:late ", "Advanced", "late"),
    ("I do not know\nx justification: inline", "No", parse.NO_JUSTIFICATION),
    ("ok\rno\nJustification: first\njustification: second", "No", "first"),
    (None, "Parsing Error", parse.NO_JUSTIFICATION),
    ("Verdict pending\nAdvanced", "Parsing Error", parse.NO_JUSTIFICATION),
    ("NOT ADVANCED", "Advanced", parse.NO_JUSTIFICATION),
    ("no\n  Justification:   \n", "No", ""),
]


@pytest.mark.parametrize(("text", "verdict", "why"), DECISIONS)
def test_decisions(column, text, verdict, why):
    assert column([text], parse.decision) == [verdict]
    assert column([text], parse.justification) == [why]


def test_strict_decision(column):
    assert column(["I do not know", "No.", "answer: no"], lambda c: parse.decision(c, True)) == ["Parsing Error", "No", "No"]


def test_manual_answers_keep_the_error(column):
    failed, answered = F.lit("quota"), F.lit(None).cast("string")
    texts = ["Error: quota", "no"]
    assert column(texts, lambda c: parse.manual_verdict(c, failed)) == ["API Error", "API Error"]
    assert column(texts, lambda c: parse.manual_justification(c, failed)) == ["quota", "quota"]
    # An answer that reads like an error is still an answer.
    assert column(texts, lambda c: parse.manual_verdict(c, answered)) == [parse.PARSING_ERROR, "No"]
    assert column(["Error: a\njustification: b"], lambda c: parse.manual_justification(c, answered)) == ["b"]


def test_api_errors(column):
    values = ["Error: Invalid API key - x", "Error: 401", "Error: api KEY", "Error: timeout", "the api key", "403", None]
    assert column(values, parse.is_api_error) == [True, True, True, False, False, False, False]


def test_structured_answer(column):
    good = '{"verdict_label": "Adequate", "strengths": ["a", "b"], "extra": 1}'
    rows = column([good, '{"verdict_label": "x", "stre', "not json", None], parse.parse_evaluation)
    assert rows[0].verdict_label == "Adequate" and rows[0].strengths == ["a", "b"] and rows[0].examples is None
    assert rows[1].strengths is None and rows[2].verdict_label is None and rows[3] is None


def test_render_template(spark):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    cell = tpl.render_template("{x}-{y}-{x} {{z}}{ }", {"x": F.col("x"), "y": F.col("y"), "z": F.lit("!")}, "none")
    assert df.select(cell).head()[0] == "a-none-a {!}{ }"
    with pytest.raises(ValueError, match="nope"):
        tpl.render_template("{nope}", {})


def test_guards(spark):
    df = spark.createDataFrame([("j", "r"), (None, "r"), ("j", "")], "j string, r string")
    got = [r[0] for r in df.select(tpl.input_error(F.col("j"), F.col("r"))).collect()]
    assert got == [None, tpl.MISSING_INPUT, tpl.MISSING_INPUT]


def test_thresholds_are_strict(column):
    p = [[0.15, 0.60, 0.25], [0.1501, 0.5999, 0.25], [0.0, 0.7499, 0.2501], [0.9, 0.1, 0.0]]
    assert column(p, sc.threshold_label, "array<double>") == ["No", "Maybe", "Yes", "Maybe"]
    two = [[0.8, 0.2], [0.7, 0.3]]
    assert column(two, lambda c: sc.threshold_label(c, ("No", "Yes")), "array<double>") == ["No", "Yes"]
    assert column(two, lambda c: sc.threshold_label(c, ("No",)), "array<double>") == ["No", "No"]


def test_softmax_and_argmax(column):
    logits = [[1000.0, 1001.0, 999.0], [-5.0, -5.0, -5.0]]
    out = column(logits, sc.softmax, "array<double>")
    for row, raw in zip(out, logits):
        e = [math.exp(x - max(raw)) for x in raw]
        assert row == pytest.approx([x / sum(e) for x in e])
        assert sum(row) == pytest.approx(1.0)
    assert column(logits, sc.argmax, "array<double>") == [1, 0]
    assert column(out, sc.confidence, "array<double>") == [max(r) for r in out]
    assert column([0, 1, 2, None], sc.label_at, "int") == ["Maybe", "No", "Yes", None]
