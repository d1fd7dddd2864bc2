"""The evaluation flow: clean, four waves, filter, two waves, merge, manual review.

Every wave is a written table keyed by ``candidate_id``; the flow only joins them.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import labels as lab, parse, templates as tpl, text as tx
from ..operators.dedup import dedup_first
from ..operators.inference import CALLS_PER_BATCH, CALLS_PER_TASK, THREADS, Pace, ResponseCache, StoredCache, TextClient, run_wave
from ..operators.merge import scatter, update_merge, write_back
from ..schema import column_or, ensure_columns, rename_out, require_columns
from ..session import new_path, settle, settle_by
from ..sources.tables import land_csv, write_csv

KEY = "candidate_id"


@dataclass(frozen=True)
class Templates:
    """Prompt texts with ``{slot}`` markers, supplied by the caller."""

    resume: str
    interview: str
    summary: str
    verdict: str
    good_fit: str
    profile: str
    manual: str


@dataclass(frozen=True)
class Service:
    """The client, the two model names, and how hard to drive it."""

    client: TextClient
    writer: str
    judge: str
    cache: ResponseCache | StoredCache | None = None
    threads: int = THREADS
    calls_per_task: int = CALLS_PER_TASK
    calls_per_batch: int = CALLS_PER_BATCH
    pace: Pace = Pace()

    def wave(self, requests: DataFrame, model: str, response: str, failure: str | None = None) -> DataFrame:
        return run_wave(
            requests,
            self.client,
            model,
            key=KEY,
            response=response,
            cache=self.cache,
            threads=self.threads,
            calls_per_task=self.calls_per_task,
            calls_per_batch=self.calls_per_batch,
            failure=failure,
            pace=self.pace,
        )


def clean_candidates(df: DataFrame, keep_null_urls: bool = False) -> DataFrame:
    """Profile address from the raw résumé, then title case, phone digits, dedup."""
    require_columns(df, (KEY, "resume_url"))
    changes: dict[str, Column] = {
        "profile_url": tx.profile_url(column_or(df, "resume_text")),
    }
    for name in ("name", "resume_text"):
        if name in df.columns:
            changes[name] = tx.title_case(F.col(name))
    if "phone" in df.columns:
        changes["phone"] = tx.phone_digits(F.col("phone"), df.schema["phone"].dataType)
    return dedup_first(df, keep_null_keys=keep_null_urls).withColumns(changes)


def resume_prompt(df: DataFrame, template: str) -> Column:
    return tpl.render_template(template, _common(df))


def interview_prompt(df: DataFrame, template: str) -> Column:
    """Null without a transcript, so that no call is made."""
    transcript = column_or(df, "transcript")
    slots = {
        **_common(df),
        "transcript": transcript,
        **tpl.interview_metrics(column_or(df, "duration")),
    }
    return F.when(lab.has_interview(transcript), tpl.render_template(template, slots))


def summary_prompt(df: DataFrame, template: str) -> Column:
    slots = {
        **_common(df),
        "resume_eval": F.col("resume_eval"),
        "interview_eval": F.col("interview_eval"),
    }
    return tpl.render_template(template, slots)


def verdict_prompt(template: str) -> Column:
    return tpl.render_template(template, {"summary": F.col("summary")})


def good_fit_prompt(df: DataFrame, template: str) -> Column:
    """Null when job or résumé is missing; the error text takes the answer's place."""
    missing = tpl.input_error(column_or(df, "job_desc"), column_or(df, "resume_text"))
    return F.when(missing.isNull(), tpl.render_template(template, _person(df, "The Candidate", "the Company")))


def profile_prompt(df: DataFrame, template: str) -> Column:
    """Null when the good-fit answer is an error, which is passed through instead."""
    slots = {
        **_person(df, tpl.NOT_PROVIDED, tpl.NOT_PROVIDED),
        "good_fit": F.col("good_fit"),
        "resume_link": tx.hyperlink("Resume", column_or(df, "resume_url")),
        "profile_link": tx.profile_link(column_or(df, "profile_url", tx.NO_PROFILE)),
        "phone": column_or(df, "phone", tpl.NOT_PROVIDED),
        "email": column_or(df, "email", tpl.NOT_PROVIDED),
        "current_salary": column_or(df, "current_salary", tpl.NOT_PROVIDED),
        "experience": column_or(df, "experience", tpl.NOT_PROVIDED),
    }
    return F.when(tpl.upstream_error(F.col("good_fit")).isNull(), tpl.render_template(template, slots))


def manual_prompt(df: DataFrame, template: str) -> Column:
    return tpl.render_template(template, {**_common(df), "profile": F.col("profile")})


def _common(df: DataFrame) -> dict[str, Column]:
    return {c: column_or(df, c, "") for c in ("job_desc", "resume_text", "criteria")}


def _person(df: DataFrame, no_name: str, no_company: str) -> dict[str, Column]:
    name = column_or(df, "name", no_name)
    return {
        **_common(df),
        "name": name,
        "first_name": tx.first_name(name),
        "company": column_or(df, "company", no_company),
        "job_title": tx.job_title(column_or(df, "job_desc", "")),
    }


def initial_evaluations(base: DataFrame, service: Service, templates: Templates) -> DataFrame:
    """``resume_eval, interview_eval, summary, result_llm`` for every candidate."""
    resume = service.wave(
        base.select(KEY, resume_prompt(base, templates.resume).alias("prompt")), service.writer, "resume_eval"
    )
    talks = base.where(lab.has_interview(column_or(base, "transcript")))
    interview = service.wave(
        talks.select(KEY, interview_prompt(base, templates.interview).alias("prompt")),
        service.writer,
        "interview_eval",
    )
    seen = scatter(base.join(resume, KEY, "left"), interview, "interview_eval", tpl.NO_INTERVIEW)
    summary = service.wave(
        seen.select(KEY, summary_prompt(seen, templates.summary).alias("prompt")), service.writer, "summary"
    )
    verdict = service.wave(
        summary.select(KEY, verdict_prompt(templates.verdict).alias("prompt")), service.judge, "result_llm"
    )
    answers = resume.join(summary, KEY).join(verdict, KEY)
    return scatter(answers, interview, "interview_eval", tpl.NO_INTERVIEW).select(
        KEY, "resume_eval", "interview_eval", "summary", lab.normalise_verdict(F.col("result_llm")).alias("result_llm")
    )


#: What the prompts of :func:`detailed_profiles` show, where a table has it.
PROFILE_COLUMNS = (
    "job_desc", "resume_text", "criteria", "name", "company", "resume_url", "profile_url", "phone", "email",
    "current_salary", "experience",
)


def profile_rows(chosen: DataFrame) -> DataFrame:
    """The rows and columns :func:`detailed_profiles` reads, written once in buckets by key,
    for a caller whose rows come from joins of their own."""
    return settle_by(chosen.select(KEY, *[c for c in PROFILE_COLUMNS if c in chosen.columns]), KEY, "chosen")


def detailed_profiles(chosen: DataFrame, service: Service, templates: Templates) -> DataFrame:
    """``good_fit, profile`` for the candidates that were not rejected."""
    asked = service.wave(
        chosen.select(KEY, good_fit_prompt(chosen, templates.good_fit).alias("prompt")),
        service.writer,
        "good_fit",
    )
    guard = tpl.input_error(column_or(chosen, "job_desc"), column_or(chosen, "resume_text"))
    fit = chosen.drop("good_fit").join(asked, KEY).withColumn("good_fit", F.coalesce(guard, "good_fit"))
    told = service.wave(
        fit.select(KEY, profile_prompt(fit, templates.profile).alias("prompt")), service.writer, "profile"
    )
    both = fit.select(KEY, "good_fit").join(told, KEY)
    raw = F.coalesce(tpl.upstream_error(F.col("good_fit")), "profile")
    return both.select(KEY, "good_fit", tx.clean_profile(raw).alias("profile"))


def manual_review(rows: DataFrame, service: Service, templates: Templates) -> DataFrame:
    """``manual_verdict, justification`` for the given rows."""
    answers = service.wave(
        rows.select(KEY, manual_prompt(rows, templates.manual).alias("prompt")), service.judge, "answer", "failure"
    )
    a, failure = F.col("answer"), F.col("failure")
    return answers.select(
        KEY,
        parse.manual_verdict(a, failure).alias("manual_verdict"),
        parse.manual_justification(a, failure).alias("justification"),
    )


def evaluate(
    df: DataFrame, service: Service, templates: Templates, keep_null_urls: bool = False
) -> DataFrame:
    """The whole flow. The result has the same columns whatever the answers were,
    and is written by the caller after the last wave. The candidates are written in buckets
    by key: the waves' answers come to their texts, which stay where they are."""
    base = settle_by(clean_candidates(df, keep_null_urls), KEY, "candidates")
    first = settle(initial_evaluations(base, service, templates), "initial")
    kept = base.drop(*[c for c in first.columns if c != KEY])
    judged = kept.join(first, KEY)

    chosen = judged.where(lab.not_rejected(F.col("result_llm")))
    profiles = settle(detailed_profiles(chosen, service, templates), "profiles")
    merged = update_merge(
        ensure_columns(judged, {"good_fit": "", "profile": ""}), profiles, ("good_fit", "profile")
    )
    open_cases = merged.where(lab.needs_manual(F.col("result_llm")))
    review = settle(manual_review(open_cases, service, templates), "review")
    return write_back(merged, review, ("manual_verdict", "justification"))


def evaluate_csv(
    spark: SparkSession,
    in_csv: str,
    out_csv: str,
    service: Service,
    templates: Templates,
    headings: Mapping[str, str] | None = None,
    keep_null_urls: bool = False,
) -> DataFrame:
    """Land the files, run the whole flow and write its result under the files' headings."""
    headings = headings or {}
    rows = land_csv(spark, in_csv, new_path(spark, "landed"), headings, KEY)
    out = settle(rename_out(evaluate(rows, service, templates, keep_null_urls), headings), "evaluated")
    write_csv(out, out_csv)
    return out
