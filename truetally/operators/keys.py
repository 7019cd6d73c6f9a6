"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Rows up to which a master table (parts, suppliers) is sent to every task instead of shuffling the lines to it.
MASTER_ROWS = 2_000_000


def fits(df: DataFrame, max_rows: int | None = None) -> bool:
    """Whether the counted rows of ``df`` fit the bound (``MASTER_ROWS``)."""
    bound = MASTER_ROWS if max_rows is None else max_rows
    return df.limit(bound + 1).count() <= bound


def small_side(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """``df`` hinted for broadcast if its counted rows fit the bound, else as it is (a shuffled join)."""
    return F.broadcast(df) if fits(df, max_rows) else df


def looked_up(rows: DataFrame, master: DataFrame, key: str, dealt: str) -> DataFrame:
    """Distinct pairs (``dealt``, ``key``) of ``rows`` with the rows of ``master`` (same ``key``) that they meet, dealt by
    ``dealt``: for :func:`with_looked_up`, where a master table is too large to be sent to every task.

    Only the pairs travel to the master table and back. Its columns come back as one value, so that all who read the
    look-up, for whatever columns, share its shuffles."""
    found = F.array(F.struct(*[c for c in master.columns if c != key]))
    return (rows.select(dealt, key).distinct().join(master, key).select(dealt, key, found.alias("_found"))
            .repartition(dealt))


def with_looked_up(rows: DataFrame, found: DataFrame, key: str, dealt: str, columns: Sequence[str],
                   found_key: str | None = None) -> DataFrame:
    """``rows`` inner-joined to ``columns`` of the master table of :func:`looked_up`, as by a join on ``key``.

    ``rows`` are dealt by ``dealt``, which is never null, and stay where they are. Both sides are sorted by a hash of
    the pair first, as numbers sort faster than texts with long common beginnings."""
    there = found.select(F.col(dealt).alias("_at"), F.col(found_key or key).alias("_key"), "_found")
    there = there.withColumn("_hash", F.xxhash64("_at", "_key"))
    met = rows.join(there, (F.xxhash64(dealt, key) == F.col("_hash")) & (F.col(dealt) == F.col("_at"))
                    & (F.col(key) == F.col("_key")))
    # a slice and not the value itself: no plan prunes it, whatever is read of it
    met = met.select(*rows.columns, F.explode(F.slice("_found", 1, 1)).alias("_row"))
    return met.select(*rows.columns, *[F.col(f"_row.{c}").alias(c) for c in columns])


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Row with the greatest ``order`` per key (QUALIFY ROW_NUMBER() OVER
    (PARTITION BY keys ORDER BY order DESC) = 1).

    Written as ``max_by(struct(row), struct(order))`` per key: a partial
    (map-side) aggregation, so a key holding a third of all rows is reduced
    per task before the shuffle instead of being sorted in one window task.
    ``order`` should end with a unique tie-break, as with ROW_NUMBER."""
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*[F.col(c) for c in rest]), F.struct(*[F.col(o) for o in order]))
    return df.groupBy(*keys).agg(best.alias("_best")).select(*keys, *[F.col(f"_best.{c}").alias(c) for c in rest]) \
        .select(*df.columns)


def arg_latest(df: DataFrame, keys: Sequence[str], value: str, order: Sequence[str], out: str | None = None,
               earliest: bool = False) -> DataFrame:
    """``max_by(value, struct(order...))`` per key: partial aggregation, so a
    hot key never gathers its rows in one task. ``earliest`` gives ``min_by``."""
    ordering = F.struct(*[F.col(o) for o in order])
    fn = F.min_by if earliest else F.max_by
    return df.groupBy(*keys).agg(fn(F.col(value), ordering).alias(out or value))
