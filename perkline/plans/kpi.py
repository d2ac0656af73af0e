"""KPI views (K8)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perkline.config import RunConfig
from perkline.functions.dates import age_band, age_years, utc_bounds_of_days
from perkline.plans.params import param_value


def _money(c):
    return F.round(c, 2).cast("decimal(18,2)")


def kpi_bonus_cost(bonus: DataFrame, salaries: DataFrame, pivot: DataFrame) -> DataFrame:
    """A3: eligible count and variable bonus cost (salary x rate).

    One group per effective rate; no employee -> no row (grouped KPI).
    """
    rate = param_value(pivot, "taux_prime")
    s = salaries.select(F.col("cle_salarie").alias("_s_key"), "brut_annuel")
    j = bonus.join(s, F.col("cle_salarie") == s._s_key, "left")
    elig = F.col("est_eligible_prime") == F.lit(True)
    cost = F.when(elig, F.coalesce(F.col("brut_annuel"), F.lit(0).cast("decimal(12,2)")) * rate).otherwise(F.lit(0))
    return (
        j.select(rate.alias("taux_prime"), elig.alias("_e"), cost.alias("_c"))
        .groupBy("taux_prime")
        .agg(F.count_if(F.col("_e")).alias("nb_salaries_eligibles_prime"), _money(F.sum("_c")).alias("cout_annuel_total_prime"))
    )


def kpi_bonus_cost_fixed(bonus: DataFrame, pivot: DataFrame) -> DataFrame:
    """A4: eligible count x fixed amount (always one row)."""
    amount = param_value(pivot, "montant_prime_fixe")
    n = bonus.agg(F.count_if(F.col("est_eligible_prime") == F.lit(True)).alias("nb_salaries_eligibles_prime"))
    return n.select(
        amount.alias("montant_prime"),
        "nb_salaries_eligibles_prime",
        _money(F.col("nb_salaries_eligibles_prime") * amount).alias("cout_annuel_total_prime"),
    )


def kpi_extra_days(wellbeing: DataFrame, pivot: DataFrame) -> DataFrame:
    """A5: eligible count, total extra days, period bounds (grouped)."""
    return (
        wellbeing.select(
            param_value(pivot, "min_activites_bien_etre").alias("min_activites_bien_etre"),
            param_value(pivot, "jours_bien_etre").alias("jours_bien_etre"),
            "est_eligible_bien_etre",
            "jours_bien_etre_attribues",
            "periode_debut",
            "periode_fin",
        )
        .groupBy("min_activites_bien_etre", "jours_bien_etre")
        .agg(
            F.count_if(F.col("est_eligible_bien_etre") == F.lit(True)).alias("nb_salaries_eligibles_bien_etre"),
            F.sum("jours_bien_etre_attribues").cast("int").alias("nb_jours_supplementaires"),
            F.min("periode_debut").alias("periode_debut"),
            F.min("periode_fin").alias("periode_fin"),
        )
    )


def kpi_activity_mix(bi_activities: DataFrame, run: RunConfig) -> DataFrame:
    """Non-excluded activities per canonical type in the window,
    ordered by count desc then label."""
    start, end = run.period()
    lo, hi = utc_bounds_of_days(start, end)
    inside = (
        bi_activities.filter((F.col("date_debut") >= F.lit(lo)) & (F.col("date_debut") < F.lit(hi)))
        .filter(F.col("est_exclue_structurelle") == F.lit(False))
        .filter(F.col("date_activite").between(F.lit(start), F.lit(end)))
    )
    return (
        inside.groupBy("type_activite_normalise")
        .agg(F.count(F.lit(1)).cast("int").alias("nb_activites"))
        .select("type_activite_normalise", "nb_activites", F.lit(start).alias("periode_debut"), F.lit(end).alias("periode_fin"))
        .orderBy(F.col("nb_activites").desc(), F.col("type_activite_normalise"))
    )


def kpi_incoherences(bi_commute: DataFrame) -> DataFrame:
    """Number of incoherent latest checks (one row even when empty)."""
    return bi_commute.agg(F.count_if(F.col("est_incoherent") == F.lit(True)).alias("nb_incoherences_detectees"))


def kpi_age(
    employees: DataFrame,
    bonus: DataFrame,
    wellbeing: DataFrame,
    salaries: DataFrame,
    pivot: DataFrame,
    run: RunConfig,
) -> DataFrame:
    """Eligibility and costs per age band at the as-of date.

    Every side holds one row per employee (asserted by the duplicate checks
    on these views), so distinct employees are plain conditional counts.
    """
    rate = param_value(pivot, "taux_prime")
    amount = param_value(pivot, "montant_prime_fixe")
    as_of = F.lit(run.as_of)
    base = employees.select(
        "cle_salarie", as_of.alias("date_run_paris"), age_band(age_years("date_naissance", as_of)).alias("tranche_age")
    )
    ep = bonus.select(F.col("cle_salarie").alias("_p"), "est_eligible_prime")
    rh = salaries.select(F.col("cle_salarie").alias("_r"), "brut_annuel")
    eb = wellbeing.select(F.col("cle_salarie").alias("_b"), "est_eligible_bien_etre", "jours_bien_etre_attribues")
    j = (
        base.join(ep, F.col("cle_salarie") == F.col("_p"), "left")
        .join(rh, F.col("cle_salarie") == F.col("_r"), "left")
        .join(eb, F.col("cle_salarie") == F.col("_b"), "left")
    )
    elig_p = F.col("est_eligible_prime") == F.lit(True)
    elig_b = F.col("est_eligible_bien_etre") == F.lit(True)
    cost = F.when(elig_p, F.coalesce(F.col("brut_annuel"), F.lit(0).cast("decimal(12,2)")) * rate).otherwise(F.lit(0))
    g = j.groupBy("date_run_paris", "tranche_age").agg(
        F.count("cle_salarie").alias("nb_salaries"),
        F.count_if(elig_p).alias("nb_salaries_eligibles_prime"),
        _money(F.sum(cost)).alias("cout_annuel_total_prime_variable"),
        F.count_if(elig_b).alias("nb_salaries_eligibles_bien_etre"),
        F.sum(F.coalesce(F.col("jours_bien_etre_attribues"), F.lit(0))).cast("int").alias("jours_bien_etre_attribues_total"),
    )
    return g.select(
        "date_run_paris",
        "tranche_age",
        "nb_salaries",
        "nb_salaries_eligibles_prime",
        "cout_annuel_total_prime_variable",
        _money(F.col("nb_salaries_eligibles_prime") * amount).alias("cout_annuel_total_prime_fixe"),
        "nb_salaries_eligibles_bien_etre",
        "jours_bien_etre_attribues_total",
    )
