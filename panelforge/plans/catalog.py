"""All registered queries by name."""

from __future__ import annotations

from panelforge.plans import cleaning, ingest, lake, models, reports


def queries() -> dict:
    return {**reports.queries(), **lake.queries(), **cleaning.queries(), **ingest.queries(), **models.queries()}
