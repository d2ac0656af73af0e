"""Label canonicalisation and classification (Column expressions).

The canonical lists are tiny configuration, so every mapping compiles to a
literal map lookup or ``isin`` inside whole-stage code — no join needed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from perkline.config import (
    ACTIVE_MODES,
    ENDURANCE_SPORTS,
    NON_ENDURANCE_SPORTS,
    ROUTING_MODES,
    UNKNOWN,
)
from perkline.functions.text import col_, fold_label, fold_literal


_MAPS: dict = {}


def _lookup(labels) -> Column:
    """Literal map folded label -> canonical label, built once per list and
    per running SparkContext (a Column wraps a JVM object)."""
    from pyspark import SparkContext

    key = (tuple(labels), id(SparkContext._active_spark_context))
    if key not in _MAPS:
        pairs = []
        for canon in labels:
            pairs += [F.lit(fold_literal(canon)), F.lit(canon)]
        _MAPS[key] = F.create_map(*pairs)
    return _MAPS[key]


def canonical_label(c: Column | str, labels) -> tuple[Column, Column]:
    """(canonical label or ``INCONNU``, unknown flag).

    The flag is true only for a non-blank value outside the list; NULL or
    blank input gives ``INCONNU`` with flag false.
    """
    x = col_(c)
    blank = x.isNull() | (F.trim(x) == "")
    folded = fold_label(x)
    known = F.try_element_at(_lookup(tuple(labels)), folded)
    label = F.when(blank, F.lit(UNKNOWN)).otherwise(F.coalesce(known, F.lit(UNKNOWN)))
    unknown = ~blank & known.isNull()
    return label, unknown


def activity_category(label: Column | str, unknown: Column | str) -> tuple[Column, Column]:
    """(ENDURANCE / NON_ENDURANCE / INCONNU, category-unknown flag)."""
    folded = fold_label(col_(label))
    endurance = [fold_literal(s) for s in ENDURANCE_SPORTS]
    other = [fold_literal(s) for s in NON_ENDURANCE_SPORTS]
    unk = col_(unknown)
    category = (
        F.when(unk, F.lit(UNKNOWN))
        .when(folded.isin(endurance), F.lit("ENDURANCE"))
        .when(folded.isin(other), F.lit("NON_ENDURANCE"))
        .otherwise(F.lit(UNKNOWN))
    )
    flag = ~unk & ~folded.isin(endurance) & ~folded.isin(other)
    return category, flag


def to_minutes(c: Column | str) -> Column:
    """Seconds -> minutes, exact decimal rounded to 3 places."""
    return F.round(col_(c).cast("decimal(18,3)") / F.lit(60), 3).cast("decimal(18,3)")


def to_km(c: Column | str) -> Column:
    """Metres -> kilometres, exact decimal rounded to 3 places."""
    return F.round(col_(c).cast("decimal(18,3)") / F.lit(1000), 3).cast("decimal(18,3)")


def travel_mode(c: Column | str) -> Column:
    """Declared mode -> routing mode, default ``driving``."""
    pairs = []
    for label, mode in ROUTING_MODES:
        pairs += [F.lit(label), F.lit(mode)]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.trim(col_(c))), F.lit("driving"))


def is_active_mode(label: Column | str) -> Column:
    return col_(label).isin(list(ACTIVE_MODES))


def volume_profile(sport: Column | str, mode_label: Column | str) -> Column:
    """Activity-volume profile from declared sport and active mode.

    A (sport declared and active mode) -> ``eleve``; B (exactly one of the
    two) -> ``moyen``; C (neither) -> ``faible``.
    """
    has_sport = F.coalesce(F.length(F.trim(col_(sport))) > 0, F.lit(False))
    active = F.coalesce(is_active_mode(mode_label), F.lit(False))
    return (
        F.when(has_sport & active, F.lit("eleve"))
        .when(has_sport | active, F.lit("moyen"))
        .otherwise(F.lit("faible"))
    )
