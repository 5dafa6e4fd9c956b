"""The library's operators bound to the given tables, each beside its SQL twin."""

from . import (  # noqa: F401
    aggregates,
    changes,
    indexed,
    jobs,
    joins,
    kept,
    projections,
    reports,
    scalars,
    sources,
    streams,
    windows,
)
from .registry import QUERIES, SQL  # noqa: F401
