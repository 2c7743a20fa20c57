"""Registry of named queries and the SQL pieces their counterparts share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.sources.survey import SURVEY_SQL

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under a name, with its SQL counterpart when there is one."""

    def wrap(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap


def pub(expr: str, digits: int = 2) -> str:
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


SILVER_SQL = """
SELECT response_id, respondent_id, team_id, project, location, question_no, raw_score, year, quarter, submitted_at,
       category, is_reverse_scored,
       CASE WHEN is_reverse_scored THEN 6 - raw_score ELSE raw_score END AS score
FROM (SELECT s.*, ROW_NUMBER() OVER (PARTITION BY response_id
             ORDER BY submitted_at DESC, raw_score DESC, question_no DESC, respondent_id DESC) AS rn
      FROM survey s) d
WHERE rn = 1 AND raw_score BETWEEN 1 AND 5
"""

EAV_SQL = f"""
SELECT user_id AS entity_id,
       'P' || CAST(user_id % 3 AS VARCHAR) AS project,
       'T' || CAST(user_id % 10 AS VARCHAR) AS team,
       CASE WHEN CAST(json_extract_string(props, '$.k') AS INT) < 60 THEN event_type
            ELSE 'x' || CAST(user_id % 3 AS VARCHAR) || '_' || CAST(CAST(json_extract_string(props, '$.k') AS INT) % 3 AS VARCHAR)
       END AS attribute,
       {pub("AVG(value)")} AS value
FROM events
GROUP BY 1, 2, 3, 4
"""


def with_survey(body: str) -> str:
    """A body that starts with a comma goes on with further named tables."""
    return f"WITH survey AS ({SURVEY_SQL}){body}" if body.lstrip().startswith(",") else f"WITH survey AS ({SURVEY_SQL})\n{body}"


def with_silver(body: str, more: str = "") -> str:
    return f"WITH survey AS ({SURVEY_SQL}), silver AS ({SILVER_SQL}){more}\n{body}"


def with_eav(body: str, more: str = "") -> str:
    return f"WITH eav AS ({EAV_SQL}){more}\n{body}"
