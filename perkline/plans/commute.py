"""Commute control (K5): thresholds, incoherence flag, usable rows, reload."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perkline.config import DEFAULT_BIKE_THRESHOLD_KM, DEFAULT_WALK_THRESHOLD_KM, RunConfig
from perkline.operators.labels import travel_mode
from perkline.plans.params import effective_params, param_pivot, param_value


def threshold_km(mode, pivot: DataFrame):
    """Threshold (km) of a declared mode: walk/run and bike/other only.

    Values come from the effective parameters, defaulting to 15 / 25 km when
    a parameter is absent; other modes have none.
    """
    m = F.trim(mode)
    walk = F.coalesce(param_value(pivot, "seuil_km_marche_course"), F.lit(DEFAULT_WALK_THRESHOLD_KM).cast("decimal(6,2)"))
    bike = F.coalesce(param_value(pivot, "seuil_km_velo_autres"), F.lit(DEFAULT_BIKE_THRESHOLD_KM).cast("decimal(6,2)"))
    return F.when(m == "Marche/running", walk).when(m == "Vélo/Trottinette/Autres", bike)


def flag_incoherent(checks: DataFrame, params: DataFrame, run: RunConfig) -> DataFrame:
    """``distance_m > int(threshold_km * 1000)``; no threshold -> false."""
    pivot = param_pivot(effective_params(params, run.as_of))
    seuil = threshold_km(F.col("mode_trajet"), pivot).cast("decimal(6,2)")
    limit = F.floor(seuil * 1000).cast("long")
    return checks.select(
        "id_ctrl",
        "cle_salarie",
        "mode_trajet",
        "distance_m",
        "duree_sec",
        seuil.alias("seuil_km"),
        F.coalesce(F.col("distance_m") > limit, F.lit(False)).alias("est_incoherent"),
        "date_ctrl",
    )


def commute_source(link: DataFrame, roster: DataFrame) -> DataFrame:
    """Employees with trimmed address and mode (NULL -> ''), key order."""
    address = F.col("adresse_dom") if "adresse_dom" in roster.columns else F.lit(None).cast("string")
    r = roster.select("id_salarie_brut", address.alias("adresse_dom"), "mod_depl_decl")
    return (
        link.join(r, "id_salarie_brut", "inner")
        .select(
            "cle_salarie",
            F.trim(F.coalesce(F.col("adresse_dom"), F.lit(""))).alias("adresse_dom"),
            F.trim(F.coalesce(F.col("mod_depl_decl"), F.lit(""))).alias("mod_depl_decl"),
        )
        .orderBy("cle_salarie")
    )


def split_usable(source: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with an address and a mode vs. skipped rows (anomalies)."""
    ok = (F.length("adresse_dom") > 0) & (F.length("mod_depl_decl") > 0)
    return source.filter(ok), source.filter(~ok)


def commute_control(source: DataFrame, distances: DataFrame, params: DataFrame, run: RunConfig) -> DataFrame:
    """K5: check table rows from usable employees and their distance result.

    ``distances`` (cle_salarie, distance_m, duree_sec) replaces the external
    routing service; employees without a distance are skipped.  The check
    date is the as-of date (explicit, not the clock).
    """
    usable, _ = split_usable(source)
    rows = usable.join(distances, "cle_salarie", "inner").select(
        "cle_salarie",
        F.col("mod_depl_decl").alias("mode_trajet"),
        travel_mode("mod_depl_decl").alias("mode_routage"),
        "distance_m",
        "duree_sec",
    )
    pivot = param_pivot(effective_params(params, run.as_of))
    seuil = threshold_km(F.col("mode_trajet"), pivot).cast("decimal(6,2)")
    return rows.select(
        "cle_salarie",
        "mode_trajet",
        "mode_routage",
        "distance_m",
        "duree_sec",
        seuil.alias("seuil_km"),
        F.coalesce(F.col("distance_m") > F.floor(seuil * 1000).cast("long"), F.lit(False)).alias("est_incoherent"),
        F.lit(run.as_of).cast("timestamp_ntz").alias("date_ctrl"),
    )
