"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values (the hashing convention of the public key macro package) ----
NULL_SENTINEL = "_dbt_utils_surrogate_key_null_"
KEY_SEPARATOR = "-"
# ------------------------------------------------------------------------------


def surrogate_key(*cols) -> Column:
    """md5 hex of the key parts joined with '-', nulls replaced by a sentinel
    first (so a null part and an empty-string part give different keys)."""
    parts = []
    for c in cols:
        c = F.col(c) if isinstance(c, str) else c
        parts.append(F.coalesce(c.cast("string"), F.lit(NULL_SENTINEL)))
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))
