"""All registered queries and their DuckDB oracles."""

from __future__ import annotations

from lexis.plans import (classify_jobs, classify_oracle, langid_jobs, langid_oracle, relations_jobs,
                         relations_oracle, tagging_jobs, tagging_oracle)

FAMILIES = [
    (langid_jobs.QUERIES, langid_oracle.SQL),
    (classify_jobs.QUERIES, classify_oracle.SQL),
    (tagging_jobs.QUERIES, tagging_oracle.SQL),
    (relations_jobs.QUERIES, relations_oracle.SQL),
]


def all_queries() -> dict:
    q = {}
    for jobs, _ in FAMILIES:
        q.update(jobs)
    return q


def all_oracles() -> dict:
    o = {}
    for _, sql in FAMILIES:
        o.update(sql)
    return o
