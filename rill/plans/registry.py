"""All registered queries in one mapping (batch and streaming)."""

from __future__ import annotations

from rill.plans.queries import BATCH_QUERIES, site_count_20s
from rill.plans.stream_queries import STREAM_QUERIES

QUERIES = {**BATCH_QUERIES, **STREAM_QUERIES}

flagship = site_count_20s
