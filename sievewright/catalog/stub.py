"""A stand-in for the text service: a pure function of the prompt, which SQL can
state as well. Used by the registered queries, the tests and the benchmark."""

from __future__ import annotations

import hashlib
import time
from dataclasses import dataclass

from ..plans.evaluation import Templates

WRITER = "writer"
JUDGE = "judge"
VERDICTS = ("Advanced", " reject ", "manual intervention")
DECISIONS = ("Advanced", "No", "Unclear")

TEMPLATES = Templates(
    resume="Rate the resume for the job.\nJob: {job_desc}\nResume: {resume_text}\nCriteria: {criteria}",
    interview="Rate the talk of {duration} characters, {wpm} words a minute.\nJob: {job_desc}\n"
    "Talk: {transcript}\nResume: {resume_text}\nCriteria: {criteria}",
    summary="Sum up.\nJob: {job_desc}\nResume view: {resume_eval}\nTalk view: {interview_eval}\nCriteria: {criteria}",
    verdict="Verdict on: {summary}",
    good_fit="Why does {name} ({first_name}) fit {job_title} at {company}?\n{job_desc}\n{resume_text}",
    profile="Profile of {name}, {first_name}, {job_title}, {company}, {phone}, {resume_link}, {profile_link}.\n{good_fit}",
    manual="Decide:\nJob: {job_desc}\nResume: {resume_text}\nProfile: {profile}",
)


@dataclass(frozen=True)
class StubClient:
    """Answers by the prompt's hash; one prompt in sixteen is refused."""

    tag: str = "says"
    delay: float = 0.0
    refuse: bool = True

    def complete(self, model: str, prompt: str) -> str:
        if self.delay:
            time.sleep(self.delay)
        digest = hashlib.md5(prompt.encode()).hexdigest()
        if self.refuse and digest[0] == "f":
            raise PermissionError(f"403 denied {digest[:6]}")
        pick = "0123456789abcdef".index(digest[1]) % 3
        if prompt.startswith("Decide:"):
            return f"\nFinal Decision: {DECISIONS[pick]}\nJustification: because {digest}"
        if model == JUDGE:
            return VERDICTS[pick]
        return f"{model} {self.tag} {digest}"
