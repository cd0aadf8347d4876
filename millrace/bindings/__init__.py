"""All registered queries."""

from millrace.bindings import (  # noqa: F401  (importing registers the queries)
    flows,
    metadata,
    relational,
    rows_and_columns,
    scalars,
    scans_and_sinks,
)
from millrace.bindings.registry import REGISTRY

__all__ = ["REGISTRY"]
