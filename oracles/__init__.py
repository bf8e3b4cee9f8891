"""DuckDB statements that the registered queries are checked against."""

from __future__ import annotations


def oracle_sql() -> dict[str, str]:
    from oracles import cleaning, ingest, lake, models, reports

    return {**reports.ORACLES, **lake.ORACLES, **cleaning.ORACLES, **ingest.ORACLES, **models.ORACLES}
