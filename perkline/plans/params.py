"""Versioned key/value parameters: as-of lookup, typed pivot, JSON export."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Typed parameter spec: code -> SQL type of the pivoted column.
PIVOT_SPEC = (
    ("taux_prime", "decimal(10,4)"),
    ("montant_prime_fixe", "decimal(12,2)"),
    ("seuil_km_marche_course", "decimal(6,2)"),
    ("seuil_km_velo_autres", "decimal(6,2)"),
    ("jours_bien_etre", "int"),
    ("min_activites_bien_etre", "int"),
)


def effective_params(params: DataFrame, as_of: dt.date) -> DataFrame:
    """Latest version with ``date_effet <= as_of`` per code.

    Ties on the date are broken by the greater value text so the pick is
    total.  Expressed as an aggregate (max of a struct ordered by date,
    then value), so it combines map-side and never sorts a whole code.
    """
    latest = (
        params.filter(F.col("date_effet") <= F.lit(as_of))
        .groupBy("code_param")
        .agg(F.max(F.struct("date_effet", "valeur_param")).alias("v"))
    )
    return latest.select("code_param", F.col("v.valeur_param").alias("valeur_param"), F.col("v.date_effet").alias("date_effet"))


def effective_params_at(params: DataFrame, days: DataFrame, day_col: str = "jour") -> DataFrame:
    """W3 for many as-of dates at once (as-of join).

    Each parameter version is turned into a validity interval
    [date_effet, next date_effet) with a window over its code (parameter
    history is configuration-sized), then the distinct days are range-
    joined to the intervals.  Output: one row per (day, code).
    """
    from pyspark.sql import Window

    w = Window.partitionBy("code_param").orderBy("date_effet", "valeur_param")
    versions = (
        params.filter(F.col("date_effet").isNotNull())
        .withColumn("valid_to", F.lead("date_effet").over(w))
        # two versions on the same day: the greater value text wins
        .filter(F.col("valid_to").isNull() | (F.col("valid_to") > F.col("date_effet")))
    )
    d = days.select(F.col(day_col).alias("jour")).distinct()
    cond = (F.col("jour") >= F.col("date_effet")) & (F.col("valid_to").isNull() | (F.col("jour") < F.col("valid_to")))
    # no hint: Spark picks the join by the version table's size
    return d.join(versions, cond, "inner").select("jour", "code_param", "valeur_param", "date_effet")


def param_pivot(effective: DataFrame) -> DataFrame:
    """A1: conditional-max pivot to one typed row (ANSI cast: bad text fails)."""
    return effective.agg(
        *[
            F.max(F.when(F.col("code_param") == code, F.col("valeur_param").cast(typ))).alias(code)
            for code, typ in PIVOT_SPEC
        ]
    )


def param_value(pivot: DataFrame, code: str) -> Column:
    """One pivoted parameter, read from a single scalar subquery returning
    the whole pivot row as a struct.  Every use shares the same subquery
    expression, so Spark evaluates it once per query (subquery reuse) and
    inlines the value: no join, nothing collected on the driver."""
    row = pivot.__dict__.get("_row")  # kept with the frame it belongs to
    if row is None:
        row = pivot.__dict__["_row"] = pivot.select(F.struct(*pivot.columns).alias("p")).scalar()
    return row.getField(code)


def params_json(params: DataFrame) -> DataFrame:
    """All parameters as one JSON object {code: {valeur_param, date_effet}}
    ordered by code."""
    entries = F.array_sort(F.collect_list(F.struct("code_param", F.struct("valeur_param", "date_effet"))))
    return params.agg(F.to_json(F.map_from_entries(entries)).alias("param_effectif"))


def mapping_pairs(mapping) -> list[tuple[str, str]]:
    """(code, value text) of a flat mapping; scalars only, keys not
    blank, values not NULL."""
    pairs = mapping.items() if hasattr(mapping, "items") else mapping
    return [
        (str(key).strip(), str(value))
        for key, value in pairs
        if key is not None and str(key).strip() and value is not None and not isinstance(value, (dict, list, tuple, set))
    ]


def params_from_mapping(spark, mapping: dict, day: dt.date) -> DataFrame:
    """Parameter rows of a mapping, in effect from ``day``."""
    rows = [(code, value, day) for code, value in mapping_pairs(mapping)]
    return spark.createDataFrame(rows, "code_param string, valeur_param string, date_effet date")


def params_from_mapping_at(days: DataFrame, mapping) -> DataFrame:
    """S10 for every ``jour`` of ``days``: the mapping's rows in effect from
    that day (the pairs are a literal array, no join)."""
    pairs = [F.struct(F.lit(k).alias("code_param"), F.lit(v).alias("valeur_param")) for k, v in mapping_pairs(mapping)]
    rows = days.select("jour", F.explode(F.array(*pairs)).alias("m"))
    return rows.select("jour", "m.code_param", "m.valeur_param", F.col("jour").alias("date_effet"))
