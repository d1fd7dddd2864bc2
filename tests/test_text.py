"""Scalar text expressions against Python's own string methods."""

from __future__ import annotations

import re

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F, types as T

from sievewright.functions import text as tx

ODD = [
    "o'neil and sons", "ßtraße ßx", "ﬁne ﬂow", "ǆabc", "½ cup x²y", "éclair ÉTÉ", "ΑΣ ΑΣΑ σς", "áb",
    " tabs\tand nbsp ", "\x1cfile sep\x1d", "{curly} ```code```", "", " ", "iıİ", "x-ray/y_z 3rd",
]


def test_title_case_is_python_title(column):
    assert column(ODD, tx.title_case) == [s.title() for s in ODD]
    assert column([None], tx.title_case) == [None]


def test_strip_is_python_strip(column):
    values = [f"{w}a{w}b{w}" for w in tx.WHITESPACE] + ODD
    assert column(values, tx.strip) == [v.strip() for v in values]


def test_has_text(column):
    values = [*tx.WHITESPACE, tx.WHITESPACE, "", "x", " x ", None]
    assert column(values, tx.has_text) == [bool(v is not None and v.strip()) for v in values]


def test_whitespace_class_matches_the_list(column):
    every = "".join(chr(c) for c in range(1, 0x3100) if not 0xD800 <= c < 0xE000)
    kept = column([every], lambda c: F.regexp_replace(c, f"[^{tx.WS}]", ""))[0]
    assert kept == "".join(ch for ch in every if ch.isspace())


def test_word_class_matches_python(column):
    every = "".join(chr(c) for c in range(1, 0x2000))
    kept = column([every], lambda c: F.regexp_replace(c, f"[^{tx.WORD}]", ""))[0]
    py = "".join(re.findall(r"\w", every))
    # The two engines know slightly different Unicode versions.
    assert len(set(kept) ^ set(py)) < 40


@pytest.mark.parametrize(
    ("value", "digits"),
    [
        ("+91 98765-43210", "9876543210"), ("(555) 0199", "5550199"), (None, ""), ("n/a", ""),
        ("1.2.3.4", "1234"), ("١٢٣", "١٢٣"),
    ],
)
def test_phone_text(column, value, digits):
    assert column([value], tx.phone_digits) == [digits]


def test_phone_numbers(column):
    assert column([919876543210.0, None, float("nan")], lambda c: tx.phone_digits(c, T.DoubleType()), "double") == [
        "9876543210", "", "",
    ]
    assert column([919876543210], lambda c: tx.phone_digits(c, T.LongType()), "long") == ["9876543210"]


def test_clean_phone_renames(spark):
    df = spark.createDataFrame([("+1 23",)], "`Phone Number` string")
    out = tx.clean_phone(df, "Phone Number")
    assert out.columns == ["phone"] and out.head()[0] == "123"


def test_job_title(column):
    cases = {
        "Job TITLE : Data Engineer \r\nmore": "Data Engineer", "title-\n  Next line\nx": "Next line",
        "no heading": "the Role", "Title: first\nTitle: second": "first", "subtitle - x": "x", "title:": "the Role",
    }
    assert column(list(cases), tx.job_title) == list(cases.values())
    assert column([None], tx.job_title) == ["the Role"]


def test_job_title_at_the_edges(column):
    cases = [
        ("title:\n\n  Lead", "Lead"), ("TiTlE\t-\tCook\tand more", "Cook\tand more"), ("title : : x", ": x"),
        ("title - \r\n", ""), ("tit le: x", "the Role"), ("title:a\rb", "a"), ("entitled: yes title: no", "no"),
        ("title:-", "-"), ("", "the Role"),
    ]
    assert column([c for c, _ in cases], tx.job_title) == [e for _, e in cases]


def test_profile_url(column):
    cases = [
        ("see https://www.linkedin.com/in/jo-é_1/x, thanks", "https://www.linkedin.com/in/jo-é_1/x"),
        ("Https://Www.Linkedin.Com/In/Jo", "Not Present"), ("", "Not Present"), (None, "Not Present"),
    ]
    assert column([c for c, _ in cases], tx.profile_url) == [e for _, e in cases]


def test_names_and_links(column):
    assert column(["Ann Lee", "Bo", "", None, " x", "Not Provided"], tx.first_name) == [
        "Ann", "Bo", "Candidate", "Candidate", "", "Candidate",
    ]
    assert column(["u", "", None], lambda c: tx.hyperlink("Resume", c)) == [
        "[Resume](u)", "[Resume Not Provided]", "[Resume Not Provided]",
    ]
    assert column(["u", "Not Present"], tx.profile_link) == ["[LinkedIn](u)", "[LinkedIn Not Present]"]


def test_clean_profile(column):
    cases = [
        ("```markdown\n# A {b}\n\n* c+d <e> = f@g [h](i)\n```", "# A b * c+d <e> = f@g [h](i)"),
        ("mark{down}", "markdown"), ("markdown", ""), ("markdownmarkdown\n x", "x"), ("\t a \n\n b ", "a b"),
        ("\"q\" 'r' | ~ ^ `z`", "q r z"), ("Zoë's 50% – (ok); #1: yes!?", "Zoës 50 (ok); #1: yes!?"), ("_a-b_", "_a-b_"), ("", ""),
    ]
    assert column([c for c, _ in cases], tx.clean_profile) == [e for _, e in cases]
    kept = column(["a  b\n\n c\td"], lambda c: tx.clean_profile(c, keep_lines=True))
    assert kept == ["a b\n\n c d"]


def test_combined_text(spark):
    df = spark.createDataFrame([("j", "r"), (None, "r"), ("j", None), (None, None)], "j string, r string")
    assert [r[0] for r in df.select(tx.combined_text(F.col("j"), F.col("r"))).collect()] == ["j r", " r", "j ", " "]
