"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations


def queries() -> dict:
    import corpus_pipeline
    from lexis.llm import queries as q

    found = {name: f for name, f in vars(q).items() if name.startswith("op") and callable(f)}
    return found | {"pipeline": corpus_pipeline.run}


def oracles() -> dict:
    import corpus_pipeline
    from lexis.llm.sql import SQL

    return SQL | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
