"""Newest version per key (W-3, DQ-2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def latest_by_key(
    df: DataFrame,
    keys: Sequence[str] | str,
    version: Sequence[str] | str,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The row with the greatest version per key, limited to ``columns`` when given.

    One aggregate with a map-side step: each task sends a single row per key into the shuffle, however
    many versions a key has. The whole row of ``df`` settles equal versions, through a hash, so the winner does not
    depend on ``columns``; where the order of such rows matters, their position belongs into ``version``.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    version = [version] if isinstance(version, str) else list(version)
    wanted = list(columns) if columns is not None else df.columns
    order = F.struct(
        *[F.col(f"`{c}`") for c in version], F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    )
    kept = [c for c in wanted if c not in keys]
    newest = F.max_by(F.struct(*[F.col(f"`{c}`") for c in kept]), order).alias("_newest")
    if not kept:
        return df.select(*keys).distinct().select(*wanted)
    best = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(newest)
    return best.select(
        *[F.col(f"`{c}`") if c in keys else F.col(f"_newest.`{c}`").alias(c) for c in wanted]
    )
