"""All registered queries: name to (Spark callable, checking SQL or None)."""

from __future__ import annotations

from loglattice.registry import business, campaigns, correlation, detection, identified, parsing, streams
from loglattice.registry.shared import Query

CATALOG: dict[str, tuple[Query, str | None]] = {**correlation.QUERIES, **parsing.QUERIES, **business.QUERIES, **detection.QUERIES, **campaigns.QUERIES, **identified.QUERIES, **streams.QUERIES}
