"""Queries over the order, part and customer tables, each with its SQL twin."""

from spokewise.registered.registry import REGISTERED
from spokewise.registered import (  # noqa: F401  (each module registers its queries)
    categories,
    columns,
    files,
    pipelines,
    reshape,
    rows,
    series,
    summaries,
    text,
)

__all__ = ["REGISTERED"]
