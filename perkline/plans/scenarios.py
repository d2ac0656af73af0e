"""What-if scenarios (K10) over every benefit parameter.

A scenario may change the rate and the fixed amount, but also what decides
who is eligible: the two commute thresholds, the minimum of activities and
the days granted.  Eligibility is not decided again for each scenario; one
pass over the employees yields two distributions:

* ``bonus_distribution``: for employees who meet all other conditions of the
  bonus, count and salaries by the threshold that applies to their latest
  check (walk, bike, none) and its distance;
* ``activity_distribution``: employees by their activities in the window.

A scenario's figures are as-of lookups in the running sums of both (distance
<= threshold, activities >= minimum), so a thousand scenarios cost as much as
one.  Running sums over distances are taken per kilometre first and per metre
inside one, so that no task orders more than the kilometres or the metres of
one.  Employee keys are unique in every input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from perkline.config import (
    ACTIVE_MODES,
    COST_SCENARIOS,
    DEFAULT_BIKE_THRESHOLD_KM,
    DEFAULT_WALK_THRESHOLD_KM,
    SCENARIO_GRID,
    TRAVEL_MODES,
    UNKNOWN,
)
from perkline.operators.labels import canonical_label
from perkline.plans.bi import latest_checks

#: parameters a scenario sets, with their types
SCENARIO_PARAMS = {
    "taux_prime": "decimal(10,4)",
    "montant_prime_fixe": "decimal(12,2)",
    "seuil_km_marche_course": "decimal(6,2)",
    "seuil_km_velo_autres": "decimal(6,2)",
    "jours_bien_etre": "int",
    "min_activites_bien_etre": "int",
}
WALK, BIKE, NO_THRESHOLD = "marche", "velo", "aucun"
_SALARY = "decimal(38,2)"


def _money(c: Column) -> Column:
    return F.round(c, 2).cast("decimal(18,2)")


# -- scenario tables ----------------------------------------------------------
def scenarios_frame(spark: SparkSession, rows: Sequence[Sequence[str]] = COST_SCENARIOS) -> DataFrame:
    """Named parameter sets, each value as text."""
    raw = spark.createDataFrame([tuple(r) for r in rows], ", ".join(f"{c} string" for c in ("scenario", *SCENARIO_PARAMS)))
    return raw.select("scenario", *[F.col(c).cast(t).alias(c) for c, t in SCENARIO_PARAMS.items()])


def scenario_grid(spark: SparkSession, values: dict[str, Sequence[str]] = SCENARIO_GRID) -> DataFrame:
    """Every combination of the listed parameter values, named by them."""
    out = spark.range(1).select()
    for name, kind in SCENARIO_PARAMS.items():
        out = out.select("*", F.explode(F.array(*[F.lit(v).cast(kind) for v in values[name]])).alias(name))
    return out.select(F.concat_ws("/", *[F.col(c).cast("string") for c in SCENARIO_PARAMS]).alias("scenario"), *SCENARIO_PARAMS)


# -- distributions ------------------------------------------------------------
def bonus_distribution(employees: DataFrame, checks: DataFrame, salaries: DataFrame) -> DataFrame:
    """``seuil, distance_m, n, masse``: employees and salaries for whom only
    the commute threshold is open.

    ``employees`` is the BI employee view, ``checks`` the raw checks (their
    stored flag, made with the thresholds of its day, is not read).  A NULL
    distance passes every threshold."""
    latest = latest_checks(checks)
    label, unknown = canonical_label("mode_trajet", TRAVEL_MODES)
    mode = F.trim("mode_trajet")
    kind = F.when(mode == "Marche/running", WALK).when(mode == "Vélo/Trottinette/Autres", BIKE).otherwise(NO_THRESHOLD)
    c = latest.where(label != UNKNOWN).select(
        "cle_salarie", F.when(F.col("distance_m").isNull(), NO_THRESHOLD).otherwise(kind).alias("seuil"), "distance_m"
    )
    active = employees.where(
        (F.col("mod_depl_decl_inconnu") == F.lit(False)) & F.col("mod_depl_decl_normalise").isin(list(ACTIVE_MODES))
    )
    paid = salaries.where("brut_annuel > 0").select("cle_salarie", "brut_annuel")
    open_ = active.select("cle_salarie").join(c, "cle_salarie").join(paid, "cle_salarie")
    metre = F.when(F.col("seuil") != NO_THRESHOLD, F.col("distance_m").cast("long"))
    return open_.groupBy("seuil", metre.alias("distance_m")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("brut_annuel").cast(_SALARY).alias("masse")
    )


def activity_distribution(employees: DataFrame, counts: DataFrame) -> DataFrame:
    """``nb, n``: employees by their activities in the window."""
    c = counts.select("cle_salarie", "nb_activites_periode")
    nb = F.coalesce("nb_activites_periode", F.lit(0)).cast("long")
    return employees.select("cle_salarie").join(c, "cle_salarie", "left").groupBy(nb.alias("nb")).agg(F.count(F.lit(1)).alias("n"))


# -- look-ups -----------------------------------------------------------------
def within_threshold(distribution: DataFrame, limits: DataFrame) -> DataFrame:
    """``seuil, limite, n, masse`` for each row ``(seuil, limite)`` of
    ``limits``: the sums over distances up to ``limite`` metres."""
    km = lambda c: F.floor(F.col(c) / 1000)
    zero = F.lit(0).cast(_SALARY)
    metres = distribution.where(F.col("seuil") != NO_THRESHOLD).withColumn("km", km("distance_m"))
    asked = limits.select("seuil", "limite").distinct().withColumn("km", km("limite"))
    # every kilometre that is asked for is in the running sum, if with nothing
    spine = (
        metres.select("seuil", "km", "n", "masse")
        .unionByName(asked.select("seuil", "km", F.lit(0).cast("long").alias("n"), zero.alias("masse")))
        .groupBy("seuil", "km")
        .agg(F.sum("n").alias("n"), F.sum("masse").cast(_SALARY).alias("masse"))
    )
    before = Window.partitionBy("seuil").orderBy("km").rowsBetween(Window.unboundedPreceding, -1)
    sums = spine.select(
        "seuil",
        "km",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_n"),
        F.coalesce(F.sum("masse").over(before), zero).cast(_SALARY).alias("_masse"),
    )
    near = metres.select("seuil", "km", "distance_m", F.col("n").alias("_mn"), F.col("masse").alias("_mm"))
    inside = F.col("distance_m") <= F.col("limite")
    last = (
        asked.join(near, ["seuil", "km"], "left")
        .groupBy("seuil", "km", "limite")
        .agg(
            F.coalesce(F.sum(F.when(inside, F.col("_mn"))), F.lit(0)).alias("n"),
            F.coalesce(F.sum(F.when(inside, F.col("_mm"))), zero).cast(_SALARY).alias("masse"),
        )
    )
    return last.join(sums, ["seuil", "km"]).select(
        "seuil", "limite", (F.col("n") + F.col("_n")).alias("n"), (F.col("masse") + F.col("_masse")).cast(_SALARY).alias("masse")
    )


def reaching_minimum(distribution: DataFrame, minima: DataFrame) -> DataFrame:
    """``minimum, n`` for each row of ``minima``: employees with as many
    activities or more."""
    asked = minima.select(F.col("minimum").cast("long").alias("nb"), F.lit(0).cast("long").alias("n")).distinct()
    spine = distribution.select("nb", "n").unionByName(asked).groupBy("nb").agg(F.sum("n").alias("n"))
    # distinct counts of activities: few, as their sum is that of all activities
    from_here = Window.orderBy(F.desc("nb")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = spine.select(F.col("nb").alias("_nb"), F.sum("n").over(from_here).alias("n"))
    return minima.select("minimum").distinct().join(sums, F.col("minimum") == F.col("_nb")).select("minimum", "n")


def cost_scenarios(employees: DataFrame, checks: DataFrame, salaries: DataFrame, counts: DataFrame, scenarios: DataFrame) -> DataFrame:
    """Eligible employees, costs and extra days under each scenario.

    A NULL threshold means the default, a NULL minimum that nobody earns
    days, NULL days none, and a NULL rate or amount a NULL cost."""
    default = {"seuil_km_marche_course": DEFAULT_WALK_THRESHOLD_KM, "seuil_km_velo_autres": DEFAULT_BIKE_THRESHOLD_KM}
    limit = {
        c: F.floor(F.coalesce(F.col(c), F.lit(km).cast("decimal(6,2)")) * 1000).cast("long") for c, km in default.items()
    }
    asked = scenarios.select(
        "scenario",
        *SCENARIO_PARAMS,
        limit["seuil_km_marche_course"].alias("_walk"),
        limit["seuil_km_velo_autres"].alias("_bike"),
    )
    open_ = bonus_distribution(employees, checks, salaries)
    limits = asked.select(F.lit(WALK).alias("seuil"), F.col("_walk").alias("limite")).unionByName(
        asked.select(F.lit(BIKE).alias("seuil"), F.col("_bike").alias("limite"))
    )
    found = within_threshold(open_, limits)
    free = open_.where(F.col("seuil") == NO_THRESHOLD).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("masse"), F.lit(0)).cast(_SALARY).alias("masse")
    )
    free = free.select(F.struct("n", "masse").alias("t")).scalar()
    enough = reaching_minimum(
        activity_distribution(employees, counts),
        asked.where("min_activites_bien_etre IS NOT NULL").select(F.col("min_activites_bien_etre").alias("minimum")),
    )

    def of(kind: str, limit: str, prefix: str) -> DataFrame:
        part = found.where(F.col("seuil") == kind)
        return part.select(F.col("limite").alias(limit), F.col("n").alias(f"{prefix}n"), F.col("masse").alias(f"{prefix}m"))

    n = F.col("_wn") + F.col("_bn") + free.getField("n")
    masse = (F.col("_wm") + F.col("_bm") + free.getField("masse")).cast(_SALARY)
    earning = F.coalesce(F.col("_days_n"), F.lit(0))
    return (
        asked.join(of(WALK, "_walk", "_w"), "_walk", "left")
        .join(of(BIKE, "_bike", "_b"), "_bike", "left")
        .join(enough.select(F.col("minimum").alias("min_activites_bien_etre"), F.col("n").alias("_days_n")), "min_activites_bien_etre", "left")
        .select(
            "scenario",
            *SCENARIO_PARAMS,
            n.alias("nb_salaries_eligibles_prime"),
            _money(masse.cast("decimal(24,2)") * F.col("taux_prime")).alias("cout_annuel_total_prime_variable"),
            _money(n * F.col("montant_prime_fixe")).alias("cout_annuel_total_prime_fixe"),
            earning.alias("nb_salaries_eligibles_bien_etre"),
            (earning * F.coalesce("jours_bien_etre", F.lit(0))).alias("nb_jours_supplementaires"),
        )
    )
