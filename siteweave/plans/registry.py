"""All queries over the driver's tables, with their SQL counterparts."""

from __future__ import annotations

from siteweave.plans import linkage, reports, triage

QUERIES = {**linkage.QUERIES, **triage.QUERIES, **reports.QUERIES}
SQL = {**linkage.SQL, **triage.SQL, **reports.SQL}
