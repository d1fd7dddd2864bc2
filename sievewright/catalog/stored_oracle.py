"""DuckDB statements for :mod:`.stored_queries`, on top of those of :mod:`.oracle`."""

from __future__ import annotations

#: Quantiles asked for, and the relative error of the sketches.
QUANTILES = (0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0)
RATIO = "(1.01 / 0.99)"

# Values lie between 1e-9 and any double; the first bin's number is 1.
SHIFT = f"(1 - ceil(ln(1e-9) / ln({RATIO})))"
DAILY = f"""bins AS (SELECT strftime(ts, '%Y-%m-%d') AS period,
    CASE WHEN abs(value) < 1e-9 THEN 0 WHEN value > 0 THEN ceil(ln(value) / ln({RATIO})) + {SHIFT}
      ELSE -(ceil(ln(-value) / ln({RATIO})) + {SHIFT}) END AS bin FROM events WHERE value IS NOT NULL),
  daily AS (SELECT period, bin, count(*) AS n FROM bins GROUP BY ALL)"""
MONTHLY = f"{DAILY}, months AS (SELECT left(period, 7) AS period, bin, sum(n) AS n FROM daily GROUP BY ALL)"
ASKED = f"asked AS (SELECT unnest([{', '.join(map(str, QUANTILES))}])::DOUBLE AS q)"

QUANTILE_SKETCH = f"""WITH {MONTHLY}, {ASKED},
  placed AS (SELECT *, sum(n) OVER (PARTITION BY period ORDER BY bin) AS upto, sum(n) OVER (PARTITION BY period) AS total FROM months)
SELECT period, q, round(CASE WHEN bin = 0 THEN 0 ELSE sign(bin) * exp((abs(bin) - {SHIFT}) * ln({RATIO})) * 2 / (1 + {RATIO}) END, 6) AS value
FROM placed, asked WHERE upto >= greatest(ceil(q * total), 1) AND upto - n < greatest(ceil(q * total), 1)"""

QUANTILE_ERROR = f"""WITH {ASKED},
  sorted AS (SELECT strftime(ts, '%Y-%m') AS period, value, row_number() OVER (PARTITION BY strftime(ts, '%Y-%m') ORDER BY value) AS r,
    count(*) OVER (PARTITION BY strftime(ts, '%Y-%m')) AS n FROM events WHERE value IS NOT NULL)
SELECT period, q, round(value, 6) AS exact, true AS within FROM sorted, asked WHERE r = greatest(ceil(q * n), 1)"""

DRIFT = f"""WITH {DAILY},
  base AS (SELECT *, sum(n) OVER (ORDER BY bin) AS upto, sum(n) OVER () AS total FROM daily WHERE period = (SELECT min(period) FROM daily)),
  tops AS (SELECT ceil(upto * 10 / total) AS part, max(bin) AS top FROM base GROUP BY 1 HAVING ceil(upto * 10 / total) < 10),
  dealt AS (SELECT period, n, (SELECT count(*) FROM tops WHERE top < bin) AS part FROM daily),
  counts AS (SELECT period, part, sum(n) AS n FROM dealt GROUP BY ALL),
  grid AS (SELECT * FROM (SELECT DISTINCT period FROM daily), (SELECT DISTINCT part FROM counts)),
  shares AS (SELECT g.period, g.part, coalesce(n, 0) AS n,
    greatest(coalesce(n / sum(n) OVER (PARTITION BY g.period), 0), 1e-6) AS own FROM grid g LEFT JOIN counts c USING (period, part)),
  held AS (SELECT *, first_value(own) OVER (PARTITION BY part ORDER BY period) AS b FROM shares)
SELECT period, sum(n)::BIGINT AS n, round(sum((own - b) * ln(own / b)), 6) AS psi FROM held GROUP BY period"""

UPSERTED = """u AS (SELECT vec_id AS id, 0::BIGINT AS version, label::VARCHAR AS payload FROM embeddings
    UNION ALL SELECT user_id, event_id + 1, event_type FROM events),
  r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY version DESC) AS rn FROM u),
  latest AS (SELECT id, version, payload FROM r WHERE rn = 1)"""

VERSIONS = f"""WITH {UPSERTED}
SELECT 0::BIGINT AS number, count(*) AS n, 0::BIGINT AS versions FROM embeddings
UNION ALL SELECT 1, count(*), sum(version)::BIGINT FROM latest
UNION ALL SELECT 2, count(*), sum(version)::BIGINT FROM latest
  WHERE NOT (id IN (SELECT vec_id FROM embeddings WHERE vec_id % 10 = 0))"""

RETRIEVAL = """WITH asked AS (SELECT vec_id AS query_id, embedding::DOUBLE[] AS c FROM embeddings WHERE vec_id % 25 = 0),
  sims AS (SELECT query_id, vec_id, round(list_cosine_similarity(c, embedding::DOUBLE[]), 9) AS s FROM asked, embeddings),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, vec_id) AS rank FROM sims)
SELECT query_id, vec_id, round(s, 6) AS similarity, rank FROM ranked WHERE rank <= 5"""


def oracle_sql(plain: dict[str, str], candidates: str, labelled: str) -> dict[str, str]:
    """``plain`` are the statements of queries with the same result; ``candidates`` and
    ``labelled`` the views that those use."""
    return {
        "csv_split_scan": f"SELECT *, true AS in_order FROM ({plain['csv_round_trip']})",
        "stored_upsert": plain["upsert_latest"],
        "stored_versions": VERSIONS,
        "knn_indexed": plain["knn_topk"],
        "knn_retrieval": RETRIEVAL,
        "search_work": "SELECT vec_id AS query_id, (SELECT count(*) FROM embeddings) AS stored, true AS within FROM embeddings WHERE vec_id % 25 = 0",
        "hybrid_indexed": plain["hybrid_topk"],
        "stream_dedup": "SELECT 'https://cv.example.com/' || md5(text) AS resume_url, 1::BIGINT AS n FROM documents GROUP BY md5(text)",
        "cv_folds_exact": f"""WITH {candidates}, {labelled} SELECT candidate_id, verdict_clean,
          CAST(floor((row_number() OVER (PARTITION BY verdict_clean ORDER BY md5('42:' || candidate_id), candidate_id) - 1) * 5
            / count(*) OVER (PARTITION BY verdict_clean)) AS BIGINT) AS fold FROM lab""",
        "quantile_sketch": QUANTILE_SKETCH,
        "quantile_error": QUANTILE_ERROR,
        "sketch_drift": DRIFT,
    }
