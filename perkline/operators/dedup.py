"""Keep-one-per-group, group-size flags and duplicate detection.

Skew-safe building blocks.  A "keep one row per group" is written as an
aggregate of an ordered struct (``min``/``max``), which Spark evaluates with
a partial aggregate before the shuffle: however many rows a hot key has,
each map task sends at most one row per key.  When the discarded rows are
needed too, the winners' unique row ids are joined back on the row id,
whose hash spreads evenly whatever the key skew.  Group sizes are a partial
count, joined back on the key and a salt, instead of an unbounded window sort
over one key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: tasks over which a hot key's rows spread when its size is joined back
SALTS = 32


def _order_struct(df: DataFrame, keys: Sequence[str], order: Sequence[str], payload: bool) -> Column:
    fields = [F.col(c).alias(f"_o{i}") for i, c in enumerate(order)]
    if payload:
        fields += [F.col(c) for c in df.columns if c not in keys]
    return F.struct(*fields)


def keep_one_per_group(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[tuple[str, str]],
    row_id: str | None = None,
) -> DataFrame:
    """One row per ``keys`` group: the first row by ``order``.

    ``order`` is a list of (column, "asc"|"desc"); all directions must agree
    (a struct is compared field by field).  NULLs sort first ascending, i.e.
    they are picked by "asc" and avoided by "desc".
    """
    directions = {d for _, d in order}
    if len(directions) != 1:
        raise ValueError("all order directions must be equal")
    cols = [c for c, _ in order]
    agg = F.min if directions == {"asc"} else F.max
    packed = _order_struct(df, keys, cols, payload=True)
    grouped = df.groupBy(*keys).agg(agg(packed).alias("_w"))
    rest = [c for c in df.columns if c not in keys]
    return grouped.select(*keys, *[F.col(f"_w.{c}").alias(c) for c in rest])


def split_one_per_group(
    df: DataFrame,
    keys: Sequence[str | Column],
    order: Sequence[tuple[str, str]],
    row_id: str,
) -> tuple[DataFrame, DataFrame]:
    """(kept, discarded) for a keep-one-per-group rule.

    ``row_id`` must be unique.  Winners are found by a partial aggregate on
    the key, then every row is matched to the winner ids on ``row_id``.
    """
    directions = {d for _, d in order}
    if len(directions) != 1:
        raise ValueError("all order directions must be equal")
    agg = F.min if directions == {"asc"} else F.max
    packed = F.struct(*[F.col(c).alias(f"_o{i}") for i, (c, _) in enumerate(order)], F.col(row_id).alias("_id"))
    winners = df.groupBy(*keys).agg(agg(packed)["_id"].alias(row_id)).withColumn("_kept", F.lit(True))
    tagged = df.join(winners.select(row_id, "_kept"), row_id, "left")
    kept = tagged.filter(F.col("_kept").isNotNull()).drop("_kept")
    discarded = tagged.filter(F.col("_kept").isNull()).drop("_kept")
    return kept.select(*df.columns), discarded.select(*df.columns)


def with_group_size(df: DataFrame, keys: Sequence[str], name: str = "n_group") -> DataFrame:
    """Attach the number of rows sharing ``keys`` (NULL keys form a group,
    as in pandas ``duplicated``).

    Only groups of several rows are joined back, each under ``SALTS`` salts
    that a row's other columns choose from, so a hot key's rows spread over
    as many tasks (the aggregate's side keeps adaptive splitting from it).
    """
    safe = [F.coalesce(F.col(k).cast("string"), F.lit("\u0000")).alias(f"_k{i}") for i, k in enumerate(keys)]
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(SALTS)).alias("_salt")
    with_keys = df.select("*", *safe, salt)
    knames = [f"_k{i}" for i in range(len(keys))]
    sizes = with_keys.groupBy(*knames).agg(F.count(F.lit(1)).alias(name)).where(F.col(name) > 1)
    sizes = sizes.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("_salt"))
    joined = with_keys.join(sizes, [*knames, "_salt"], "left").drop(*knames, "_salt")
    return joined.withColumn(name, F.coalesce(F.col(name), F.lit(1).cast("long")))


def duplicated_groups(df: DataFrame, keys: Sequence[str], name: str = "n_group") -> DataFrame:
    """Every member of a group with more than one row."""
    return with_group_size(df, keys, name).filter(F.col(name) > 1)
