"""Row scope and column masking by role.

These are DataFrame-level policies for consistent answers, not a security
boundary: anyone who can read the underlying files can read every row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from truetally.sources.reference_data import PRICE_COLUMNS, PRICE_MASKED_ROLES, STEWARD_ROLE


def apply_row_scope(df: DataFrame, scope: DataFrame, role: str | None, col: str = "plant_id",
                    steward: str = STEWARD_ROLE) -> DataFrame:
    """Rows whose ``col`` is in the role's scope (EXISTS -> left semi join).

    The steward sees everything; an unknown role sees nothing; a NULL ``col``
    is invisible to every persona. Spark broadcasts the scope while it is small."""
    if role is None or role == steward:
        return df
    allowed = scope.filter(F.col("role_name") == role).select(F.col("plant_id").alias("_scope_plant"))
    return df.join(allowed, F.col(col) == F.col("_scope_plant"), "left_semi")


def apply_mask(df: DataFrame, role: str | None, cols: Sequence[str] = PRICE_COLUMNS,
               masked_roles: Sequence[str] = PRICE_MASKED_ROLES) -> DataFrame:
    """NULL out ``cols`` for ``masked_roles``; other roles see values. Derived
    columns (goods value, landed cost) stay visible, as in the reference."""
    if role not in masked_roles:
        return df
    return df.withColumns({c: F.lit(None).cast(df.schema[c].dataType) for c in cols if c in df.columns})
