"""The SQL each registered query is checked against, for DuckDB.

Written from the definitions, not from the Spark code: row numbers where the
library uses thresholds, plain joins where it combines or salts.
"""

from __future__ import annotations

from ..functions.labels import MAYBE_WORDS, NO_WORDS, YES_WORDS
from ..functions.templates import MISSING_INPUT, NO_INTERVIEW
from ..functions.text import WHITESPACE, WORD, WS
from ..operators.features import STOP_WORDS
from ..sources.candidates import PHONE_PATTERN
from ..sources.tables import NA_MARKERS
from . import stub
from .queries import EVENT_TYPES, LOGIT_SCALE, REVIEW_BELOW, linear_weights

KEY = "candidate_id"
NL = "chr(10)"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def listed(words) -> str:
    return ", ".join(q(w) for w in words)


def strip(x: str) -> str:
    return f"trim({x}, {q(WHITESPACE)})"


def title(x: str) -> str:
    cased = r"\p{Lu}\p{Ll}\p{Lt}"
    first = "CASE WHEN left(r, 1) = 'ß' THEN 'Ss' ELSE upper(left(r, 1)) END"
    return (
        f"array_to_string(list_transform(regexp_extract_all({x}, '[{cased}]+|[^{cased}]+'), "
        f"lambda r: {first} || lower(substr(r, 2))), '')"
    )


def clean(x: str) -> str:
    n = f"lower({strip(x)})"
    return (
        f"CASE WHEN {n} IN ({listed(YES_WORDS)}) THEN 'Yes' WHEN {n} IN ({listed(MAYBE_WORDS)}) THEN 'Maybe' "
        f"WHEN {n} IN ({listed(NO_WORDS)}) THEN 'No' ELSE 'No' END"
    )


def blank(x: str) -> str:
    return f"({x} IS NULL OR {strip(x)} = '')"


def phone(x: str) -> str:
    return f"coalesce(right(regexp_replace({x}, '[^0-9]', '', 'g'), 10), '')"


def role(x: str) -> str:
    return (
        f"CASE WHEN regexp_matches({x}, '(?i)title[{WS}]*[:\\-][{WS}]*[^\\n\\r]+') "
        f"THEN {strip(f"regexp_extract({x}, '(?i)title[{WS}]*[:\\-][{WS}]*([^\\n\\r]+)', 1)")} "
        f"ELSE 'the Role' END"
    )


def profile_url(x: str) -> str:
    return f"coalesce(nullif(regexp_extract({x}, 'https?://(?:www\\.)?linkedin\\.com/in/[{WORD}\\-/]+', 0), ''), 'Not Present')"


def link(x: str) -> str:
    return f"CASE WHEN coalesce({x}, '') <> '' THEN '[Resume](' || {x} || ')' ELSE '[Resume Not Provided]' END"


def profile_link(x: str) -> str:
    return f"CASE WHEN {x} <> 'Not Present' THEN '[LinkedIn](' || {x} || ')' ELSE '[LinkedIn Not Present]' END"


def first_name(x: str) -> str:
    return f"CASE WHEN coalesce({x}, '') IN ('', 'Not Provided') THEN 'Candidate' ELSE split_part({x}, ' ', 1) END"


def clean_profile(x: str) -> str:
    x = f"regexp_replace({x}, 'markdown\\n?', '', 'g')"
    x = f"regexp_replace({x}, '[^{WORD}{WS}.,;:!?()-\\[\\]#*]', '', 'g')"
    return strip(f"regexp_replace({x}, '[{WS}]+', ' ', 'g')")


def render(template: str, **slots: str) -> str:
    out = [q("")]
    rest = template
    while rest:
        at = min((rest.find("{" + s + "}") for s in slots if "{" + s + "}" in rest), default=-1)
        if at < 0:
            out.append(q(rest))
            break
        end = rest.index("}", at)
        if at:
            out.append(q(rest[:at]))
        out.append(f"coalesce(CAST({slots[rest[at + 1:end]]} AS VARCHAR), '')")
        rest = rest[end + 1 :]
    return "(" + " || ".join(out) + ")"


def answer(model: str, p: str, tag: str = "says", refuse: bool = True) -> str:
    """The stub service as an expression over the prompt column ``p``."""
    pick = f"(CAST('0x' || substr(md5({p}), 2, 1) AS INTEGER) % 3)"

    def choose(words):
        return f"CASE {pick} " + " ".join(f"WHEN {i} THEN {q(w)}" for i, w in enumerate(words)) + " END"

    decided = f"'Final Decision: ' || {choose(stub.DECISIONS)} || {NL} || 'Justification: because ' || md5({p})"
    other = strip(choose(stub.VERDICTS)) if model == stub.JUDGE else f"'{model} {tag} ' || md5({p})"
    text = f"CASE WHEN starts_with({p}, 'Decide:') THEN {decided} ELSE {other} END"
    if refuse:
        text = (
            f"CASE WHEN left(md5({p}), 1) = 'f' THEN 'Error: Invalid API key - 403 denied ' || left(md5({p}), 6) "
            f"ELSE {text} END"
        )
    return f"CASE WHEN {p} IS NULL THEN NULL ELSE {text} END"


CAND = f"""
cand AS (
  SELECT d.doc_id AS candidate_id, c.c_name AS name, d.source AS company, d.lang AS criteria,
    CASE WHEN d.doc_id % 17 <> 0 THEN 'Role Title: ' || coalesce(p.p_name, '') || {NL} || b.text END AS job_desc,
    CASE WHEN d.doc_id % 5 = 0 THEN d.text || ' https://www.linkedin.com/in/u-' || d.doc_id ELSE d.text END AS resume_text,
    'https://cv.example.com/' || md5(d.text) AS resume_url,
    nullif(regexp_extract(d.text, '{PHONE_PATTERN}', 0), '') AS phone,
    t.transcript, t.duration,
    CASE WHEN l.doc_id IS NULL THEN NULL WHEN l.toxic = 1 THEN ' Reject' WHEN l.quality = 1 THEN 'YES'
      WHEN d.doc_id % 2 = 0 THEN 'may be' ELSE 'manual' END AS verdict,
    CASE d.doc_id % 4 WHEN 0 THEN 'reject ' WHEN 1 THEN 'Advanced' WHEN 2 THEN 'manual intervention'
      ELSE 'Error: 403 denied' END AS result_llm
  FROM documents d
  LEFT JOIN customer c ON c.c_custkey = d.doc_id
  LEFT JOIN part p ON p.p_partkey = d.doc_id
  LEFT JOIN benchmark b ON b.item_id = d.doc_id % (SELECT count(*) FROM benchmark)
  LEFT JOIN labels l ON l.doc_id = d.doc_id
  LEFT JOIN (SELECT page_id, html AS transcript, CAST(length(html) AS BIGINT) AS duration FROM pages) t
    ON t.page_id = d.doc_id
)"""

NORM = title(strip("result_llm"))
COMBINED = "coalesce(job_desc, '') || ' ' || coalesce(resume_text, '')"
MAPPED = f"CASE WHEN {blank('verdict')} AND lower({strip('result_llm')}) = 'reject' THEN 'No' ELSE verdict END"
MAPPED_COL = f"labelled AS (SELECT candidate_id, {MAPPED} AS v FROM cand)"
LABELLED = f"{MAPPED_COL}, lab AS (SELECT candidate_id, {clean('v')} AS verdict_clean FROM labelled)"

TOKENS = f"toks AS (SELECT candidate_id, regexp_extract_all(lower({COMBINED}), '[{WORD}]{{2,}}') AS t FROM cand)"
KEPT = f"{TOKENS}, kept AS (SELECT candidate_id, list_filter(t, lambda x: x NOT IN ({listed(STOP_WORDS)})) AS t FROM toks)"
PAIRS = "list_transform(generate_series(1, len(t) - 1), lambda i: t[i] || ' ' || t[i + 1])"
GRAMS = f"""{KEPT},
grams AS (SELECT candidate_id, unnest(list_concat(t, {PAIRS})) AS term FROM kept),
counts AS (SELECT candidate_id, term, count(*) AS tf FROM grams GROUP BY ALL),
n AS (SELECT count(*) AS n FROM cand),
stats AS (SELECT term, CAST(sum(tf) AS BIGINT) AS tf, count(*) AS df FROM counts GROUP BY term),
vocab AS (SELECT term, tf, df, ln((1.0 + n) / (1.0 + df)) + 1.0 AS idf FROM stats, n
  WHERE df >= 2 AND df <= 0.95 * n ORDER BY tf DESC, term LIMIT 5000)"""

SPLIT = """split AS (SELECT candidate_id, verdict_clean,
  row_number() OVER (PARTITION BY verdict_clean ORDER BY md5('42:' || candidate_id), candidate_id)
    <= floor(0.2 * count(*) OVER (PARTITION BY verdict_clean) + 0.5) AS is_test FROM lab)"""


def _soft(name: str, start: int) -> str:
    return ", ".join(f"exp(l{start + i}) / (exp(l{start}) + exp(l{start + 1}) + exp(l{start + 2})) AS {name}{i}" for i in range(3))


def _sums() -> str:
    """Six sums, each of every sixth vector position."""
    own = "list_sum(list_transform(list_filter(embedding, lambda x, k: (k - 1) % 6 = {i}), lambda x: x::DOUBLE))"
    return ", ".join(f"{LOGIT_SCALE} * {own.format(i=i)} AS l{i}" for i in range(6))


SCORED = f"""sums AS (SELECT vec_id, label, {_sums()} FROM embeddings),
  scored AS (SELECT vec_id,
    CASE label % 3 WHEN 0 THEN 'Maybe' WHEN 1 THEN 'No' ELSE 'Yes' END AS truth,
    {_soft('p', 0)}, {_soft('q', 3)} FROM sums)"""


def best(name: str) -> str:
    a, b, c = (f"{name}{i}" for i in range(3))
    return f"CASE WHEN {a} >= {b} AND {a} >= {c} THEN 0 WHEN {b} >= {c} THEN 1 ELSE 2 END"


def best_label(name: str) -> str:
    return f"CASE {best(name)} WHEN 0 THEN 'Maybe' WHEN 1 THEN 'No' ELSE 'Yes' END"


def ruled(name: str) -> str:
    return f"CASE WHEN {name}2 > 0.25 THEN 'Yes' WHEN {name}0 > 0.15 THEN 'Maybe' ELSE 'No' END"


def top(name: str) -> str:
    return f"greatest({name}0, {name}1, {name}2)"


JUDGED = f"{SCORED}, judged AS (SELECT *, {ruled('p')} AS predicted FROM scored)"

WEIGHT = """CASE {c} WHEN 'Yes' THEN {yes} WHEN 'Maybe' THEN {maybe} ELSE 1.0 END
  * (sum(n) OVER ()) / ((count(*) OVER ()) * n)"""

ANSWERS = f"""ans AS (SELECT candidate_id, CASE candidate_id % 6
    WHEN 0 THEN {NL} || '  Final Decision: ADVANCED ' || {NL} || 'Justification: ' || resume_text
    WHEN 1 THEN 'final decision: no' || {NL} || resume_text
    WHEN 2 THEN 'Unclear' || {NL} || ' ' || chr(9) || 'justification: a: b ' || resume_text
    WHEN 3 THEN resume_text
    WHEN 4 THEN 'I do not know. Justification: inline' || {NL} || resume_text || {NL} || 'JUSTIFICATION:late '
    END AS answer FROM cand)"""


def decision(x: str, no: str) -> str:
    line = f"lower(regexp_extract({x}, '[^{WS}][^\\n]*', 0))"
    return (
        f"CASE WHEN contains({line}, 'advanced') THEN 'Advanced' "
        f"WHEN {no.format(line=line)} THEN 'No' ELSE 'Parsing Error' END"
    )


def justification(x: str) -> str:
    pattern = f"(?im)^[{WS}]*justification:([^\\n]*)"
    return (
        f"CASE WHEN regexp_matches({x}, '{pattern}') THEN {strip(f"regexp_extract({x}, '{pattern}', 1)")} "
        f"ELSE 'Could not parse justification.' END"
    )


def manual(x: str) -> tuple[str, str]:
    failed = f"starts_with({x}, 'Error:')"
    return (
        f"CASE WHEN {failed} THEN 'API Error' ELSE {decision(x, "contains({line}, 'no')")} END",
        f"CASE WHEN {failed} THEN substr({x}, {len('Error: Invalid API key - ') + 1}) ELSE {justification(x)} END",
    )


def flow_ctes(source: str, manual_profile: str) -> dict[str, str]:
    """Prompt expressions of the flow over a relation with canonical columns."""
    t = stub.TEMPLATES
    common = dict(job_desc="job_desc", resume_text="resume_text", criteria="criteria")
    fit = dict(
        **common,
        first_name=first_name("name"),
        company="company",
        job_title=role("coalesce(job_desc, '')"),
        name="name",
    )
    return {
        "resume": render(t.resume, **common),
        "interview": render(
            t.interview, **common, transcript="transcript", duration="coalesce(CAST(duration AS VARCHAR), 'Not Available')",
            wpm="'Not Available'",
        ),
        "summary": render(t.summary, **common, resume_eval="resume_eval", interview_eval="interview_eval"),
        "verdict": render(t.verdict, summary="summary"),
        "good_fit": render(t.good_fit, **fit),
        "profile": render(
            t.profile, **fit, phone="phone", resume_link=link("resume_url"), profile_link=profile_link(source),
            good_fit="good_fit",
        ),
        "manual": render(t.manual, **common, profile=manual_profile),
    }


def _missing() -> str:
    return "(coalesce(job_desc, '') = '' OR coalesce(resume_text, '') = '')"


def _profiles(source: str, prompts: dict[str, str]) -> str:
    """CTEs from ``source`` to ``profiles(candidate_id, good_fit, profile)``."""
    return f"""
  fit_ask AS (SELECT *, CASE WHEN {_missing()} THEN NULL ELSE {prompts['good_fit']} END AS p FROM {source}),
  fit AS (SELECT * EXCLUDE (p), CASE WHEN {_missing()} THEN {q(MISSING_INPUT)} ELSE {answer(stub.WRITER, 'p')} END
    AS good_fit FROM fit_ask),
  prof_ask AS (SELECT candidate_id, good_fit, CASE WHEN contains(good_fit, 'Error:') THEN NULL
    ELSE {prompts['profile']} END AS p FROM fit),
  profiles AS (SELECT candidate_id, good_fit,
    {clean_profile(f"CASE WHEN contains(good_fit, 'Error:') THEN good_fit ELSE {answer(stub.WRITER, 'p')} END")}
    AS profile FROM prof_ask)"""


def _eval_flow() -> str:
    prompts = flow_ctes("profile_url", "profile")
    verdict, why = manual("a")
    return f"""WITH {CAND},
  firsts AS (SELECT min(candidate_id) AS candidate_id FROM cand GROUP BY resume_url),
  base AS (SELECT candidate_id, {title('name')} AS name, company, criteria, job_desc,
    {title('resume_text')} AS resume_text, resume_url, {phone('phone')} AS phone, transcript, duration,
    {profile_url('resume_text')} AS profile_url FROM cand WHERE candidate_id IN (SELECT candidate_id FROM firsts)),
  asked AS (SELECT *, {prompts['resume']} AS rp,
    CASE WHEN {blank('transcript')} THEN NULL ELSE {prompts['interview']} END AS ip FROM base),
  seen AS (SELECT *, {answer(stub.WRITER, 'rp')} AS resume_eval,
    coalesce({answer(stub.WRITER, 'ip')}, {q(NO_INTERVIEW)}) AS interview_eval FROM asked),
  summed_ask AS (SELECT *, {prompts['summary']} AS sp FROM seen),
  summed AS (SELECT *, {answer(stub.WRITER, 'sp')} AS summary FROM summed_ask),
  judge_ask AS (SELECT *, {prompts['verdict']} AS vp FROM summed),
  judged AS (SELECT *, {answer(stub.JUDGE, 'vp')} AS raw_result FROM judge_ask),
  ruled AS (SELECT * EXCLUDE (raw_result), {title(strip('raw_result'))} AS result_llm FROM judged),
  chosen AS (SELECT * FROM ruled WHERE result_llm IS DISTINCT FROM 'Reject'),
  {_profiles('chosen', prompts)},
  merged AS (SELECT ruled.*, coalesce(f.good_fit, '') AS good_fit, coalesce(f.profile, '') AS profile
    FROM ruled LEFT JOIN profiles f USING (candidate_id)),
  man_ask AS (SELECT candidate_id, {prompts['manual']} AS mp FROM merged WHERE result_llm = 'Manual Intervention'),
  man AS (SELECT candidate_id, {answer(stub.JUDGE, 'mp')} AS a FROM man_ask),
  man_done AS (SELECT candidate_id, {verdict} AS manual_verdict, {why} AS justification FROM man)
  SELECT candidate_id, phone, resume_eval, interview_eval, summary, result_llm, good_fit, profile,
    manual_verdict, justification FROM merged LEFT JOIN man_done USING (candidate_id)"""


def _profile_flow() -> str:
    prompts = flow_ctes("'Not Present'", "profile")
    return f"""WITH {CAND},
  chosen AS (SELECT * FROM cand WHERE {NORM} IS DISTINCT FROM 'Reject'),
  {_profiles('chosen', prompts)}
  SELECT candidate_id, good_fit, profile FROM profiles"""


def _manual_flow() -> str:
    prompts = flow_ctes("''", "company")
    ask = render(stub.TEMPLATES.manual, job_desc="job_desc", resume_text="resume_text", profile="company", criteria="''")
    verdict, why = manual("a")
    return f"""WITH {CAND}, asked AS (SELECT candidate_id, {ask} AS mp FROM cand
    WHERE {NORM} = 'Manual Intervention'),
  answered AS (SELECT candidate_id, {answer(stub.JUDGE, 'mp')} AS a FROM asked)
  SELECT candidate_id, {verdict} AS manual_verdict, {why} AS justification FROM answered"""


def _drift() -> str:
    shares = ", ".join(
        f"greatest(count(*) FILTER (event_type = {q(t)}) / count(*)::DOUBLE, 1e-6) AS s{i}"
        for i, t in enumerate(EVENT_TYPES)
    )

    def psi(ref: str) -> str:
        return " + ".join(
            f"(s{i} - {ref.format(i=i)}) * ln(s{i} / {ref.format(i=i)})" for i in range(len(EVENT_TYPES))
        )

    return f"""WITH d AS (SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n, {shares} FROM events GROUP BY 1)
  SELECT day, n, round({psi('first_value(s{i}) OVER (ORDER BY day)')}, 6) AS psi_baseline,
    round({psi('lag(s{i}) OVER (ORDER BY day)')}, 6) AS psi_previous FROM d"""


def _linear() -> str:
    w = linear_weights()
    logits = ", ".join(
        " + ".join(f"{w[i, j]} * embedding[{i + 1}]::DOUBLE" for i in range(w.shape[0])) + f" AS l{j}"
        for j in range(w.shape[1])
    )
    return f"""WITH lin AS (SELECT vec_id, label, {logits} FROM embeddings)
  SELECT vec_id, CASE WHEN label % 2 = 0 THEN {best_label('l')} END AS predicted,
    CASE WHEN label % 2 = 0 THEN round(1.0 / (exp(l0 - {top('l')}) + exp(l1 - {top('l')}) + exp(l2 - {top('l')})), 6)
    END AS confidence FROM lin"""


CENTROIDS = """cen AS (SELECT label AS query_id, list(x ORDER BY pos) AS c FROM (
    SELECT label, pos, avg(x::DOUBLE) AS x FROM (
      SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings)
    GROUP BY label, pos) GROUP BY label)"""

NEAR = f"""{CENTROIDS}, sims AS (SELECT query_id::BIGINT AS query_id, vec_id, label,
    round(list_cosine_similarity(c, embedding::DOUBLE[]), 9) AS s FROM cen, embeddings),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, vec_id) AS rank FROM sims)"""


def _hybrid() -> str:
    stop = listed(STOP_WORDS)

    def grams(text: str) -> str:
        kept = f"list_filter(regexp_extract_all(lower({text}), '[{WORD}]{{2,}}'), lambda x: x NOT IN ({stop}))"
        return kept

    return f"""WITH {NEAR},
  qk AS (SELECT item_id AS query_id, {grams('text')} AS t FROM benchmark),
  qt AS (SELECT DISTINCT query_id, term FROM (SELECT query_id, unnest(list_concat(t, {PAIRS})) AS term FROM qk)),
  dk AS (SELECT doc_id AS vec_id, {grams('text')} AS t FROM documents),
  dt AS (SELECT DISTINCT vec_id, term FROM (SELECT vec_id, unnest(list_concat(t, {PAIRS})) AS term FROM dk)),
  freq AS (SELECT term, count(*) AS df FROM dt GROUP BY term),
  nd AS (SELECT count(*) AS n FROM documents),
  qw AS (SELECT query_id, qt.term, ln((1.0 + n) / (1.0 + coalesce(df, 0))) + 1.0 AS idf
    FROM qt LEFT JOIN freq USING (term), nd),
  mass AS (SELECT query_id, sum(idf) AS mass FROM qw GROUP BY query_id),
  kw AS (SELECT vec_id, qw.query_id, sum(idf) / max(mass) AS keyword FROM dt JOIN qw USING (term)
    JOIN mass ON mass.query_id = qw.query_id GROUP BY 1, 2),
  mixed AS (SELECT coalesce(sims.query_id, kw.query_id) AS query_id, coalesce(sims.vec_id, kw.vec_id) AS vec_id,
    round(0.3 * coalesce(keyword, 0) + 0.7 * coalesce(s, 0), 9) AS score
    FROM sims FULL JOIN kw ON kw.query_id = sims.query_id AND kw.vec_id = sims.vec_id),
  hr AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM mixed)
  SELECT query_id, vec_id, round(score, 6) AS score, rank FROM hr WHERE rank <= 10"""


def _lettered() -> str:
    def count(letter: str) -> str:
        return f"(length(t) - length(replace(t, '{letter}', '')))"

    soft = "exp(l{i} - {top}) / (exp(l0 - {top}) + exp(l1 - {top}) + exp(l2 - {top})) AS p{i}"
    ps = ", ".join(soft.format(i=i, top=top("l")) for i in range(3))
    return f"""{CAND}, texts AS (SELECT candidate_id, verdict, {COMBINED} AS t FROM cand),
  logits AS (SELECT candidate_id, verdict, {count('a')} / 100.0 AS l0, {count('e')} / 200.0 AS l1,
    {count('o')} / 100.0 AS l2 FROM texts),
  probs AS (SELECT candidate_id, verdict, {ps} FROM logits)"""


def oracle_sql() -> dict[str, str]:
    c = f"WITH {CAND} SELECT candidate_id, "
    json_ok = "event_id % 10 <> 0"
    fit = flow_ctes("''", "''")
    return {
        "na_normalise": f"""WITH {CAND}, raw AS (SELECT candidate_id, coalesce(phone, 'NA') AS phone,
            coalesce(verdict, 'nan') AS verdict,
            CASE WHEN result_llm = 'Advanced' THEN 'None' ELSE result_llm END AS result_llm FROM cand)
          SELECT candidate_id, """
        + ", ".join(
            f"CASE WHEN {x} IN ({listed(NA_MARKERS)}) THEN NULL ELSE {x} END AS {x}"
            for x in ("phone", "verdict", "result_llm")
        )
        + " FROM raw",
        "csv_round_trip": c + "md5(resume_text) AS resume_md5, verdict FROM cand",
        "combined_text": c + f"md5({COMBINED}) AS text_md5, length({COMBINED}) AS n_chars FROM cand",
        "title_case": c + f"{title('name')} AS name, md5({title('resume_text')}) AS resume_md5 FROM cand",
        "phone_clean": c + f"{phone('phone')} AS phone FROM cand",
        "job_title": c + f"{role('job_desc')} AS job_title FROM cand",
        "profile_url": c + f"{profile_url('resume_text')} AS profile_url FROM cand",
        "first_name": c + f"{first_name('name')} AS first_name, {first_name('job_desc')} AS first_word FROM cand",
        "hyperlink": c + f"{link('CASE WHEN verdict IS NOT NULL THEN resume_url END')} AS resume_link, "
        f"{profile_link(profile_url('resume_text'))} AS profile_link FROM cand",
        "profile_clean": f"""WITH {CAND}, p AS (SELECT candidate_id, {clean_profile(
            "('```markdown' || chr(10) || '{' || coalesce(job_desc, '') || '}' || chr(10) || resume_text || chr(10) || '```')"
        )} AS x FROM cand) SELECT candidate_id, md5(x) AS profile_md5, length(x) AS n_chars FROM p""",
        "label_clean": c + f"{clean('verdict')} AS verdict_clean, {clean('result_llm')} AS result_clean FROM cand",
        "reject_map": c + f"{MAPPED} AS verdict, {blank('verdict')} AND lower({strip('result_llm')}) = 'reject' AS mapped FROM cand",
        "verdict_norm": c + f"{NORM} AS result_llm FROM cand",
        "label_distribution": f"""WITH {CAND}, {MAPPED_COL}
          SELECT 'raw' AS kind, v AS label, count(*) AS n FROM labelled WHERE v IS NOT NULL GROUP BY v
          UNION ALL SELECT 'clean', {clean('v')}, count(*) FROM labelled GROUP BY 2""",
        "distinct_classes": f"WITH {CAND} SELECT DISTINCT {clean('verdict')} AS label FROM cand ORDER BY 1",
        "empty_verdict_rows": f"WITH {CAND} SELECT candidate_id FROM cand WHERE {blank('verdict')}",
        "nonblank_text": c + f"NOT {blank('job_desc')} AS has_job FROM cand WHERE NOT {blank(f'({COMBINED})')}",
        "non_rejected": f"WITH {CAND}, v AS (SELECT candidate_id, {NORM} AS result_llm FROM cand) "
        "SELECT * FROM v WHERE result_llm IS DISTINCT FROM 'Reject'",
        "manual_rows": f"WITH {CAND} SELECT candidate_id FROM cand WHERE {NORM} = 'Manual Intervention'",
        "has_interview": c + f"md5(transcript) AS transcript_md5, duration FROM cand WHERE NOT {blank('transcript')}",
        "dedup_first": f"""WITH {CAND}, r AS (SELECT *, row_number() OVER (PARTITION BY resume_url
            ORDER BY candidate_id) AS rn FROM cand) SELECT candidate_id, resume_url, company FROM r WHERE rn = 1""",
        "dedup_report": f"""WITH {CAND}, g AS (SELECT resume_url, count(*) AS n FROM cand GROUP BY 1)
          SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_kept, CAST(sum(n) - count(*) AS BIGINT) AS n_removed,
            max(n) AS largest_group FROM g""",
        "stage_funnel": f"""WITH {CAND}, v AS (SELECT {NORM} AS r FROM cand) SELECT count(*) AS n_initial,
          count(*) FILTER (r = 'Reject') AS n_rejected, count(*) FILTER (r IS DISTINCT FROM 'Reject') AS n_remaining FROM v""",
        "interview_scatter": c + f"""CASE WHEN {blank('transcript')} THEN {q(NO_INTERVIEW)}
          ELSE 'seen ' || md5(transcript) END AS interview_eval FROM cand""",
        "update_merge": c + f"""CASE WHEN {NORM} <> 'Reject' THEN upper(company) ELSE company END AS company,
          CASE WHEN {NORM} IN ('Reject', 'Manual Intervention') THEN '' ELSE {NORM} END AS good_fit FROM cand""",
        "fill_empty": c + f"CASE WHEN {blank('verdict')} THEN {clean('result_llm')} ELSE verdict END AS verdict FROM cand",
        "manual_writeback": c + f"""CASE WHEN {NORM} = 'Manual Intervention' THEN 'No' END AS manual_verdict,
          CASE WHEN {NORM} = 'Manual Intervention' THEN 'from ' || company END AS justification FROM cand""",
        "class_weights_boosted": f"""WITH {CAND}, {LABELLED}, k AS (SELECT verdict_clean, count(*) AS n FROM lab GROUP BY 1)
          SELECT verdict_clean, n, round({WEIGHT.format(c='verdict_clean', yes=2.0, maybe=1.5)}, 6) AS weight FROM k""",
        "class_weights_train": f"""WITH {CAND}, {LABELLED}, {SPLIT},
          k AS (SELECT verdict_clean, count(*) AS n FROM split WHERE NOT is_test GROUP BY 1),
          w AS (SELECT verdict_clean, n, {WEIGHT.format(c='verdict_clean', yes=1.0, maybe=1.0)} AS w FROM k)
          SELECT verdict_clean, n, round(w, 6) AS weight, round(w * n, 4) AS total_weight FROM w""",
        "tokens": f"WITH {CAND}, {TOKENS} SELECT candidate_id, len(t) AS n_tokens, md5(array_to_string(t, ' ')) AS tokens_md5 FROM toks",
        "stop_filtered": f"WITH {CAND}, {KEPT} SELECT candidate_id, len(t) AS n_tokens, md5(array_to_string(t, ' ')) AS tokens_md5 FROM kept",
        "bigrams": f"""WITH {CAND}, {KEPT}, b AS (SELECT candidate_id, {PAIRS} AS b FROM kept)
          SELECT candidate_id, len(b) AS n_pairs, md5(array_to_string(b, '|')) AS pairs_md5 FROM b""",
        "vocabulary": f"WITH {CAND}, {GRAMS} SELECT term, tf, df, round(idf, 6) AS idf FROM vocab",
        "tfidf_relational": f"""WITH {CAND}, {GRAMS},
          raw AS (SELECT candidate_id, term, counts.tf AS tf, counts.tf * idf AS raw FROM counts JOIN vocab USING (term))
          SELECT candidate_id, term, tf,
            round(raw / sqrt(sum(raw * raw) OVER (PARTITION BY candidate_id)), 6) AS weight FROM raw""",
        "ml_features": f"""WITH {CAND}, {GRAMS},
          raw AS (SELECT candidate_id, counts.tf * idf AS raw FROM counts JOIN vocab USING (term)),
          v AS (SELECT candidate_id, count(*) AS n_terms, max(raw) / sqrt(sum(raw * raw)) AS w FROM raw GROUP BY 1)
          SELECT candidate_id, coalesce(n_terms, 0) AS n_terms, round(coalesce(w, 0.0), 6) AS top_weight
          FROM cand LEFT JOIN v USING (candidate_id)""",
        "split_stratified": f"WITH {CAND}, {LABELLED}, {SPLIT} SELECT candidate_id, verdict_clean, is_test FROM split",
        "split_plain": """SELECT doc_id AS candidate_id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id)
          <= floor(0.2 * count(*) OVER () + 0.5) AS is_test FROM documents""",
        "split_sequential": """SELECT doc_id AS candidate_id, row_number() OVER (ORDER BY doc_id)
          > floor(0.8 * count(*) OVER ()) AS is_test FROM documents""",
        "softmax_argmax": f"""WITH {SCORED} SELECT vec_id, round(p0, 6) AS p_maybe, round(p1, 6) AS p_no,
          round(p2, 6) AS p_yes, CAST({best('p')} AS BIGINT) AS best, {best_label('p')} AS label FROM scored""",
        "threshold_verdict": f"WITH {SCORED} SELECT vec_id, {ruled('p')} AS verdict, round({top('p')}, 6) AS confidence FROM scored",
        "confidence_summary": f"""WITH {SCORED}, m AS (SELECT {top('p')} AS conf, {best_label('p')} = 'Yes' AS hit FROM scored)
          SELECT count(*) AS n_rows, count(*) FILTER (hit) AS n_predicted,
            round(avg(conf) FILTER (hit), 6) AS mean_confidence,
            count(*) FILTER (hit AND conf < {REVIEW_BELOW}) AS n_low_confidence FROM m""",
        "low_confidence": f"""WITH {SCORED} SELECT vec_id, round({top('p')}, 6) AS confidence,
          {top('p')} < {REVIEW_BELOW} AS needs_review FROM scored""",
        "review_queue": f"""WITH {SCORED}, r AS (SELECT vec_id, round({top('p')}, 6) AS confidence FROM scored)
          SELECT * FROM r WHERE confidence < {REVIEW_BELOW} ORDER BY confidence, vec_id""",
        "confusion_matrix": f"""WITH {JUDGED} SELECT truth, count(*) FILTER (predicted = 'Maybe') AS "Maybe",
          count(*) FILTER (predicted = 'No') AS "No", count(*) FILTER (predicted = 'Yes') AS "Yes" FROM judged GROUP BY truth""",
        "classification_report": f"""WITH {JUDGED},
          per AS (SELECT label, count(*) FILTER (truth = label) AS support,
              coalesce(count(*) FILTER (truth = label AND predicted = label)
                / nullif(count(*) FILTER (predicted = label), 0), 0.0) AS p,
              coalesce(count(*) FILTER (truth = label AND predicted = label)
                / nullif(count(*) FILTER (truth = label), 0), 0.0) AS r
            FROM judged, (VALUES ('Maybe'), ('No'), ('Yes')) l(label) GROUP BY label),
          f AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END AS f1 FROM per),
          acc AS (SELECT count(*) AS n, avg((truth = predicted)::INT) AS a FROM judged),
          rows AS (SELECT label, support, p, r, f1 FROM f
            UNION ALL SELECT 'accuracy', n, a, a, a FROM acc
            UNION ALL SELECT 'macro avg', CAST(sum(support) AS BIGINT), avg(p), avg(r), avg(f1) FROM f
            UNION ALL SELECT 'weighted avg', CAST(sum(support) AS BIGINT), sum(p * support) / sum(support),
              sum(r * support) / sum(support), sum(f1 * support) / sum(support) FROM f)
          SELECT label, support, round(p, 6) AS precision, round(r, 6) AS recall, round(f1, 6) AS f1 FROM rows""",
        "accuracy": f"""WITH {JUDGED}, m AS (SELECT max(n) AS top FROM (SELECT truth, count(*) AS n FROM judged GROUP BY 1))
          SELECT count(*) AS n, round(avg((truth = predicted)::INT), 6) AS accuracy,
            round(max(top) / count(*), 6) AS majority_baseline FROM judged, m""",
        "weighted_log_loss": f"""WITH {SCORED}, k AS (SELECT truth, count(*) AS n FROM scored GROUP BY 1),
          w AS (SELECT truth, {WEIGHT.format(c='truth', yes=2.0, maybe=1.5)} AS w FROM k),
          x AS (SELECT w, CASE truth WHEN 'Maybe' THEN p0 WHEN 'No' THEN p1 ELSE p2 END AS p FROM scored JOIN w USING (truth))
          SELECT count(*) AS n, round(sum(-w * ln(p)) / sum(w), 6) AS log_loss FROM x""",
        "ensemble_avg": f"""WITH {SCORED}, e AS (SELECT *, 0.6 * p0 + 0.4 * q0 AS e0, 0.6 * p1 + 0.4 * q1 AS e1,
            0.6 * p2 + 0.4 * q2 AS e2 FROM scored),
          t AS (SELECT vec_id, e2, {top('e')} AS conf, {best_label('e')} AS label,
            [{best_label('p')}, {ruled('q')}, {best_label('e')}] AS v FROM e),
          n AS (SELECT *, len(list_filter(v, lambda x: x = 'Maybe')) AS n0, len(list_filter(v, lambda x: x = 'No')) AS n1,
            len(list_filter(v, lambda x: x = 'Yes')) AS n2 FROM t)
          SELECT vec_id, round(e2, 6) AS p_yes, round(conf, 6) AS confidence, label, {best_label('n')} AS voted FROM n""",
        "model_agreement": f"""WITH {SCORED}, m AS (SELECT {best_label('p')} AS model_a, {ruled('q')} AS model_b FROM scored)
          SELECT model_a, model_b, count(*) AS n, round(count(*) / (SELECT count(*) FROM m), 6) AS share,
            round((SELECT avg((model_a = model_b)::INT) FROM m), 6) AS agreement_rate FROM m GROUP BY 1, 2""",
        "cv_folds": "SELECT doc_id AS candidate_id, CAST('0x' || left(md5('42:' || doc_id), 7) AS BIGINT) % 5 AS fold FROM documents",
        "label_drift": _drift(),
        "score_batched": _linear(),
        "predict_scorer_flow": f"""WITH {_lettered()} SELECT candidate_id,
          CASE WHEN {blank('verdict')} THEN {best_label('p')} ELSE verdict END AS verdict,
          CASE WHEN {blank('verdict')} THEN round({top('p')}, 6) END AS confidence,
          CASE WHEN {blank('verdict')} THEN {top('p')} < {REVIEW_BELOW} END AS needs_review FROM probs""",
        "predict_all_flow": f"""WITH {_lettered()} SELECT {best_label('p')} AS verdict, count(*) AS n,
          round(avg({top('p')}), 6) AS mean_confidence FROM probs GROUP BY 1""",
        "row_count": "SELECT count(*) AS n_seen, count(*) AS n_landed FROM documents",
        "column_defaults": c + """company, 'Not Provided' AS email,
          coalesce(CAST(duration AS VARCHAR), 'Not Available') AS duration FROM cand""",
        "embed_text": f"""WITH {CAND}, x AS (SELECT candidate_id, {COMBINED} AS t FROM cand) SELECT candidate_id,
          length(t) AS n_chars, length(t) - length(replace(t, 'e', '')) AS n_e,
          length(t) - length(replace(t, 'n', '')) AS n_n, length(t) - length(replace(t, ' ', '')) AS n_blank FROM x""",
        "render_prompt": c + f"""CASE WHEN {_missing()} THEN NULL ELSE md5({fit['good_fit']}) END AS good_fit_md5,
          CASE WHEN {blank('transcript')} THEN NULL ELSE md5({fit['interview']}) END AS interview_md5 FROM cand""",
        "guard_missing": c + f"CASE WHEN {_missing()} THEN {q(MISSING_INPUT)} END AS guard FROM cand",
        "error_propagate": c + "CASE WHEN contains(result_llm, 'Error:') THEN result_llm END AS passed FROM cand",
        "parse_decision": f"""WITH {CAND}, {ANSWERS} SELECT candidate_id,
          {decision('answer', "contains({line}, 'no')")} AS decision,
          {decision('answer', "regexp_matches({line}, '\\bno\\b')")} AS strict_decision FROM ans""",
        "parse_justification": f"WITH {CAND}, {ANSWERS} SELECT candidate_id, {justification('answer')} AS justification FROM ans",
        "parse_json_eval": f"""SELECT event_id, CASE WHEN {json_ok} THEN event_type END AS verdict_label,
          CASE WHEN {json_ok} THEN 'user ' || user_id END AS evaluation_note,
          CASE WHEN {json_ok} THEN event_type END AS first_strength,
          CASE WHEN {json_ok} THEN 2::BIGINT END AS n_strengths, NULL::BIGINT AS n_examples FROM events""",
        "api_errors": f"""WITH {CAND} SELECT company, count(*) AS n, count(*) FILTER (contains(result_llm, 'Error:')) AS n_errors,
          count(*) FILTER (contains(result_llm, 'Invalid API key') OR (contains(result_llm, 'Error:') AND
            (contains(lower(result_llm), 'api key') OR contains(result_llm, '401') OR contains(result_llm, '403'))))
            AS n_api_errors FROM cand GROUP BY company""",
        "wave_map": c + f"{answer(stub.WRITER, 'resume_text')} AS response FROM cand",
        "wave_cache": c + f"""CASE WHEN left(md5(resume_text), 1) = 'f'
          THEN {answer(stub.WRITER, 'resume_text', 'again', False)} ELSE {answer(stub.WRITER, 'resume_text')} END
          AS response FROM cand""",
        "prompt_multiplicity": f"""WITH {CAND} SELECT count(*) AS n_requests, count(DISTINCT resume_text) AS n_calls,
          count(*) - count(DISTINCT resume_text) AS n_saved FROM cand""",
        "eval_flow": _eval_flow(),
        "profile_flow": _profile_flow(),
        "manual_review_flow": _manual_flow(),
        "knn_topk": f"WITH {NEAR} SELECT query_id, vec_id, round(s, 6) AS similarity, rank FROM ranked WHERE rank <= 10",
        "knn_vote": f"""WITH {NEAR}, v AS (SELECT query_id, label, count(*) AS votes, round(sum(s), 6) AS w FROM ranked
            WHERE rank <= 5 GROUP BY 1, 2),
          r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY votes DESC, w DESC, label) AS rn FROM v)
          SELECT query_id, CAST(label AS BIGINT) AS label, votes FROM r WHERE rn = 1""",
        "hybrid_topk": _hybrid(),
        "kmeans_fit": """SELECT count(*) AS n_rows, 5::BIGINT AS n_clusters, 0::BIGINT AS n_misplaced,
          0::BIGINT AS n_off_centre FROM embeddings""",
        "fit_masks": f"WITH {CAND} SELECT candidate_id, {blank('verdict')} AS masked, true AS as_ruled FROM cand",
        "dedup_landed": """SELECT min(doc_id) AS row, 'https://cv.example.com/' || md5(text) AS resume_url,
          arg_min(source, doc_id) AS company FROM documents GROUP BY md5(text)""",
        "upsert_latest": """WITH u AS (SELECT vec_id AS id, 0::BIGINT AS version, label::VARCHAR AS payload FROM embeddings
            UNION ALL SELECT user_id, event_id + 1, event_type FROM events),
          r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY version DESC) AS rn FROM u)
          SELECT id, version, payload FROM r WHERE rn = 1""",
    }
