"""All registered queries."""

from . import (  # noqa: F401
    dataset_queries,
    evaluation_queries,
    model_queries,
    stream_queries,
    table_queries,
    window_queries,
)
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
