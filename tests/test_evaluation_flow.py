from __future__ import annotations

import sys
from dataclasses import dataclass

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from sievewright.catalog import stub
from sievewright.catalog.stub import TEMPLATES
from sievewright.functions.templates import MISSING_INPUT, NO_INTERVIEW
from sievewright.operators.inference import ResponseCache
from sievewright.plans import evaluation as flow
from sievewright.streaming.arrivals import evaluate_stream

# The client below lives in this module, which executors cannot import.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class Scripted:
    """Answers by what the prompt starts with; verdicts by candidate name."""

    verdict: str = "by-name"

    def complete(self, model, prompt):
        if prompt.startswith("Decide:"):
            return "\nAdvanced it is\nJustification: strong: yes"
        if prompt.startswith("Verdict"):
            if self.verdict != "by-name":
                return self.verdict
            return "REJECT " if "stamp" in prompt else "manual intervention" if "doubt" in prompt else "advanced"
        if prompt.startswith("Sum up"):
            return "stamp" if "Stamps" in prompt else "doubt" if "Doubts" in prompt else "fine"
        if prompt.startswith("Rate the resume"):
            return "Stamps" if "Paper" in prompt else "Doubts" if "Gaps" in prompt else "good"
        if prompt.startswith("Why") and "Broken" in prompt:
            raise RuntimeError("quota")
        return "```markdown\n# {" + prompt.split("\n")[0] + "}\n```"


SCHEMA = (
    "candidate_id long, name string, company string, job_desc string, resume_text string, resume_url string, "
    "phone double, transcript string, duration long, criteria string"
)
ROWS = [
    (1, "ann o'neil", "Acme", "Title: Engineer\nx", "spark https://www.linkedin.com/in/ann", "u1", 919876543210.0, "hi", 9, "c"),
    (2, "bob", "Acme", "Title: Clerk", "paper", "u2", None, None, None, "c"),
    (3, "cy", "Acme", "no heading", "gaps", "u3", 5.0, " ", 3, None),
    (4, "ann again", "Acme", "Title: Engineer", "other", "u1", 1.0, "hi", 9, "c"),
    (5, None, "Acme", None, "spark", "u5", None, "talk", None, "c"),
    (6, "di", "Acme", "Title: X", "broken", "u6", None, None, None, "c"),
]


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def run(people, client, cache=None):
    service = flow.Service(client, "writer", "judge", cache)
    return {r["candidate_id"]: r for r in flow.evaluate(people, service, TEMPLATES).collect()}


def test_whole_flow(people):
    out = run(people, Scripted())
    assert sorted(out) == [1, 2, 3, 5, 6]
    assert out[1]["name"] == "Ann O'Neil" and out[1]["phone"] == "9876543210" and out[2]["phone"] == ""
    assert out[1]["profile_url"] == "https://www.linkedin.com/in/ann"
    assert {k: r["result_llm"] for k, r in out.items()} == {
        1: "Advanced", 2: "Reject", 3: "Manual Intervention", 5: "Advanced", 6: "Advanced",
    }
    assert out[2]["interview_eval"] == out[3]["interview_eval"] == NO_INTERVIEW != out[1]["interview_eval"]
    # Rejected rows keep empty texts; missing input and failed calls pass their error on.
    assert (out[2]["good_fit"], out[2]["profile"]) == ("", "")
    assert out[5]["good_fit"] == MISSING_INPUT and out[5]["profile"].startswith("Error: Cannot generate")
    assert out[6]["good_fit"] == "Error: quota" == out[6]["profile"]
    assert out[1]["good_fit"].startswith("```markdown\n# {Why does Ann O'Neil (Ann) fit Engineer at Acme?}")
    # The apostrophe and the braces go; slashes lie inside the kept range.
    assert out[1]["profile"] == (
        "# Profile of Ann ONeil, Ann, Engineer, Acme, 9876543210, [Resume](u1), "
        "[LinkedIn](https://www.linkedin.com/in/ann)."
    )
    assert {k: (r["manual_verdict"], r["justification"]) for k, r in out.items() if r["manual_verdict"]} == {
        3: ("Advanced", "strong: yes")
    }


def test_same_columns_whatever_the_verdicts(people):
    rejected = run(people, Scripted("Reject"))
    advanced = run(people, Scripted("Advanced"))
    assert set(rejected[1].asDict()) == set(advanced[1].asDict())
    assert {r["profile"] for r in rejected.values()} == {""}
    assert {r["manual_verdict"] for r in advanced.values()} == {None}


def test_without_optional_columns(spark, people):
    bare = people.select("candidate_id", "resume_url", "resume_text")
    out = run(bare, Scripted())
    assert {r["good_fit"] for r in out.values() if r["result_llm"] != "Reject"} == {MISSING_INPUT}
    with pytest.raises(ValueError, match="resume_url"):
        flow.clean_candidates(people.drop("resume_url"))


def test_stream_needs_and_uses_the_cache(spark, people, tmp_path):
    people.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(people.schema).parquet(str(tmp_path / "in"))
    with pytest.raises(ValueError, match="cache"):
        evaluate_stream(stream, flow.Service(Scripted(), "w", "j"), TEMPLATES, None, "x")
    cache = ResponseCache(str(tmp_path / "cache"))

    def sink(batch, batch_id):
        batch.write.mode("overwrite").parquet(str(tmp_path / f"out-{batch_id}"))

    service = flow.Service(Scripted(), "writer", "judge", cache)
    query = evaluate_stream(stream, service, TEMPLATES, sink, str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination(300)
    got = spark.read.parquet(str(tmp_path / "out-0"))
    assert sorted(r["candidate_id"] for r in got.collect()) == [1, 2, 3, 5, 6]
    assert got.where(F.col("result_llm") == "Manual Intervention").count() == 1


def test_files_in_and_out(spark, people, tmp_path):
    """Under the files' own headings, with line breaks and quotes in cells, in file order."""
    from sievewright.sources.csv_ranges import read_ranges
    from sievewright.sources.tables import write_csv

    headings = {"Job → Description": "job_desc", "Résumé (link)?": "resume_url", "Name": "name"}
    outside = {v: k for k, v in headings.items()}
    given = people.drop("candidate_id", "phone").withColumn("criteria", F.concat("criteria", F.lit(',"a"\nb')))
    write_csv(given.withColumnsRenamed(outside).coalesce(1), str(tmp_path / "in"))
    service = flow.Service(Scripted(), "writer", "judge", ResponseCache(str(tmp_path / "cache")))
    out = flow.evaluate_csv(spark, str(tmp_path / "in"), str(tmp_path / "out"), service, TEMPLATES, headings)
    assert set(headings) <= set(out.columns) and "job_desc" not in out.columns
    back = read_ranges(spark, str(tmp_path / "out"))
    assert back.columns == out.columns and back.count() == out.count() == 5
    told = {int(r["candidate_id"]): (r["result_llm"], r["criteria"]) for r in back.collect()}
    note = 'c,"a"\nb'
    assert told == {
        0: ("Advanced", note), 1: ("Reject", note), 2: ("Manual Intervention", None), 4: ("Advanced", note), 5: ("Advanced", note),
    }


def test_candidates_in_buckets_are_not_shuffled_again(spark):
    from sievewright.session import settle_by

    rows = spark.range(50).select(F.col("id").alias("candidate_id"), F.lit("text").alias("a text, (raw)"))
    base = settle_by(rows.union(rows.where("candidate_id = 3")), "candidate_id", "rows")
    assert spark.catalog.listTables() == [] and base.count() == 51
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        one = spark.range(40).select(F.col("id").alias("candidate_id"), F.lit(1).alias("one"))
        two = spark.range(30).select(F.col("id").alias("candidate_id"), F.lit(2).alias("two"))
        both = base.join(one, "candidate_id", "left").join(two, "candidate_id", "left")
        plan = both._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2
        assert both.count() == 51 and both.where("two = 2").count() == 31
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)

def test_profile_rows_are_those_of_the_flow(spark):
    rows = [(1, "job", "cv", "Al B", "x"), (2, None, "cv", "C", "y"), (2, "job", "cv", "C", "y")]
    df = spark.createDataFrame(rows, "candidate_id long, job_desc string, resume_text string, name string, other string")
    kept = flow.profile_rows(df)
    assert kept.columns == ["candidate_id", "job_desc", "resume_text", "name"] and kept.count() == 3
    service = flow.Service(stub.StubClient(), stub.WRITER, stub.JUDGE)
    out = lambda d: sorted(map(str, flow.detailed_profiles(d, service, stub.TEMPLATES).collect()))
    assert out(kept) == out(df)
