"""Eligibility views (K7): commuting bonus, well-being days, combination."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perkline.config import (
    ACTIVE_MODES,
    BONUS_REASONS,
    CATEGORY_BOTH,
    CATEGORY_BONUS_ONLY,
    CATEGORY_NONE,
    CATEGORY_WELLBEING_ONLY,
    RunConfig,
)
from perkline.functions.dates import utc_bounds_of_days
from perkline.plans.params import param_value


def bonus_eligibility(employees: DataFrame, commute: DataFrame, salaries: DataFrame) -> DataFrame:
    """Bonus flag and first-match ineligibility reason.

    ``employees`` is the BI employee view, ``commute`` the latest-check view,
    ``salaries`` (cle_salarie, brut_annuel) from link x roster.  Both right
    sides hold at most one row per employee in the bound data model.
    """
    t = commute.select(
        F.col("cle_salarie").alias("_t_key"), "est_incoherent", F.col("est_exclue_structurelle").alias("_t_excl")
    )
    s = salaries.select(F.col("cle_salarie").alias("_s_key"), "brut_annuel")
    j = employees.join(t, employees.cle_salarie == t._t_key, "left").join(s, F.col("cle_salarie") == s._s_key, "left")
    active = F.col("mod_depl_decl_normalise").isin(list(ACTIVE_MODES))
    salary_missing = F.col("brut_annuel").isNull() | (F.col("brut_annuel") <= 0)
    eligible = (
        (F.col("mod_depl_decl_inconnu") == F.lit(False))
        & active
        & F.col("_t_key").isNotNull()
        & (F.col("_t_excl") == F.lit(False))
        & (F.col("est_incoherent") == F.lit(False))
        & F.col("brut_annuel").isNotNull()
        & (F.col("brut_annuel") > 0)
    )
    r = BONUS_REASONS
    reason = (
        F.when(salary_missing, F.lit(r[0]))
        .when(F.col("_t_key").isNull(), F.lit(r[1]))
        .when(F.col("_t_excl") == F.lit(True), F.lit(r[2]))
        .when(F.col("est_incoherent") == F.lit(True), F.lit(r[3]))
        .when(F.col("mod_depl_decl_inconnu") == F.lit(True), F.lit(r[4]))
        .when(~active, F.lit(r[5]))
    )
    return j.select("cle_salarie", eligible.alias("est_eligible_prime"), reason.alias("motif_ineligibilite"))


def salaries(link: DataFrame, roster: DataFrame) -> DataFrame:
    return link.select("id_salarie_brut", "cle_salarie").join(
        roster.select("id_salarie_brut", "brut_annuel"), "id_salarie_brut", "inner"
    ).select("cle_salarie", "brut_annuel")


def activity_count_window(bi_activities: DataFrame, run: RunConfig) -> DataFrame:
    """Non-excluded activities per employee inside the rolling window.

    The window bounds are literals (computed from the explicit as-of date),
    and a coarse bound on the raw instant is added so that the Parquet scan
    can skip row groups outside the window; the exact local-day test stays.
    The count is a partial aggregate: a hot employee costs one row per map
    task in the shuffle.
    """
    start, end = run.period()
    lo, hi = utc_bounds_of_days(start, end)
    inside = (
        bi_activities.filter((F.col("date_debut") >= F.lit(lo)) & (F.col("date_debut") < F.lit(hi)))
        .filter(F.col("est_exclue_structurelle") == F.lit(False))
        .filter(F.col("date_activite").between(F.lit(start), F.lit(end)))
    )
    return inside.groupBy("cle_salarie").agg(F.count(F.lit(1)).cast("int").alias("nb_activites_periode"))


def wellbeing_eligibility(employees: DataFrame, counts: DataFrame, pivot: DataFrame, run: RunConfig) -> DataFrame:
    """Activities in the window vs. minimum; days granted.

    Parameters come in as scalar subqueries of the one-row pivot (evaluated
    once, no join); the period is a literal pair.
    """
    start, end = run.period()
    min_act = param_value(pivot, "min_activites_bien_etre")
    days = param_value(pivot, "jours_bien_etre")
    c = counts.select(F.col("cle_salarie").alias("_a_key"), "nb_activites_periode")
    j = employees.select("cle_salarie").join(c, F.col("cle_salarie") == c._a_key, "left")
    n = F.coalesce(F.col("nb_activites_periode"), F.lit(0))
    eligible = F.when(min_act.isNull(), F.lit(False)).otherwise(n >= min_act)
    granted = F.when(min_act.isNull(), F.lit(0)).when(n >= min_act, F.coalesce(days, F.lit(0))).otherwise(F.lit(0))
    return j.select(
        "cle_salarie",
        F.lit(start).alias("periode_debut"),
        F.lit(end).alias("periode_fin"),
        n.cast("int").alias("nb_activites_periode"),
        min_act.alias("min_activites_bien_etre"),
        F.coalesce(days, F.lit(0)).alias("jours_bien_etre"),
        eligible.alias("est_eligible_bien_etre"),
        granted.cast("int").alias("jours_bien_etre_attribues"),
    )


def benefit_category(employees: DataFrame, bonus: DataFrame, wellbeing: DataFrame) -> DataFrame:
    """Per-employee synthesis of both benefits."""
    p = bonus.select(F.col("cle_salarie").alias("_p_key"), "est_eligible_prime", "motif_ineligibilite")
    b = wellbeing.select(
        F.col("cle_salarie").alias("_b_key"),
        "est_eligible_bien_etre",
        "nb_activites_periode",
        "jours_bien_etre_attribues",
        "periode_debut",
        "periode_fin",
    )
    j = employees.select("cle_salarie").join(p, F.col("cle_salarie") == p._p_key, "left").join(
        b, F.col("cle_salarie") == b._b_key, "left"
    )
    ep, eb = F.col("est_eligible_prime"), F.col("est_eligible_bien_etre")
    cat = (
        F.when((ep == F.lit(True)) & (eb == F.lit(True)), F.lit(CATEGORY_BOTH))
        .when((ep == F.lit(True)) & (eb == F.lit(False)), F.lit(CATEGORY_BONUS_ONLY))
        .when((ep == F.lit(False)) & (eb == F.lit(True)), F.lit(CATEGORY_WELLBEING_ONLY))
        .otherwise(F.lit(CATEGORY_NONE))
    )
    return j.select(
        "cle_salarie",
        "est_eligible_prime",
        "motif_ineligibilite",
        "est_eligible_bien_etre",
        "nb_activites_periode",
        "jours_bien_etre_attribues",
        "periode_debut",
        "periode_fin",
        cat.alias("categorie_avantage"),
    )

