"""Surrogate trip key: MD5 over a fixed list of columns, NULL-safe.

Each value is cast to its SQL text form, NULL replaced by a token, the parts
joined by '-', and the result hashed.  This matches the widely used
surrogate-key macro of the dbt-utils package, so keys depend only on the
column values, not on row position or run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The NULL placeholder and separator of the key text.
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
SEPARATOR = "-"


def surrogate_key(columns: Sequence[str]) -> Column:
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_TOKEN)) for c in columns]
    return F.md5(F.concat_ws(SEPARATOR, *parts))


def surrogate_key_sql(columns: Sequence[str]) -> str:
    """The same key as ANSI SQL text (for oracles and ad-hoc SQL)."""
    parts = [f"coalesce(cast({c} as varchar), '{NULL_TOKEN}')" for c in columns]
    return "md5(" + " || '-' || ".join(parts) + ")"
