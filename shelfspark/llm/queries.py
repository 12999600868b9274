"""All registered queries of the subpackage and their oracle SQL."""

from __future__ import annotations

from . import (  # noqa: F401  (register)
    decontaminate,
    exact_dedup,
    licenses,
    ngram_join,
    packing,
    pii,
    quality,
    secrets,
    token_alignment,
    token_shards,
    toxicity,
    vector_codes,
    vector_search,
)
from .common import ORACLE, QUERIES  # noqa: F401
