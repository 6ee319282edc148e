"""Importing this module registers every query."""

from rollcall.plans import (  # noqa: F401
    queries_addresses,
    queries_documents,
    queries_events,
    queries_hosts,
    queries_people,
    queries_records,
    queries_review,
    queries_sources,
)
