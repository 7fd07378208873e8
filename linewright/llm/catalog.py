"""The queries of this subpackage, and their SQL where SQL can say the same."""

from __future__ import annotations

from . import (  # noqa: F401
    bpe,
    exact_dedup,
    hard_negatives,
    language,
    merkle,
    near_dedup,
    packing,
    personal_data,
    secret_scan,
    sequence_files,
    sharding,
    topk,
    toxicity,
)
from .common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
