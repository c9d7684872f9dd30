"""Registered queries of the library's own operators."""

from .plans import queries_datasets, queries_records, queries_streams  # noqa: F401  each registers its own
from .plans.registry import ORACLES, QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLES)
