"""Scenario figures against a full re-run of the chain per scenario."""

import decimal

from pyspark.sql import functions as F

from perkline.config import COST_SCENARIOS, DEFAULT_RUN
from perkline.plans import bi, eligibility, kpi, scenarios
from perkline.plans.commute import flag_incoherent
from perkline.plans.model import BenefitModel
from perkline.plans.params import effective_params, param_pivot

SF = "/root/testdata/sf0.001"


def test_scenarios_equal_a_full_run_each(spark):
    m = BenefitModel.of(spark, SF)
    odd = spark.createDataFrame(
        [(9_000_001, None), (9_000_002, -5), (9_000_003, 15_000), (9_000_004, 15_001)], "id_ctrl long, distance_m int"
    )
    # latest checks with a NULL, a negative and both border distances
    first = m.bi_employee.select("cle_salarie").orderBy("cle_salarie").limit(40).withColumn(
        "_r", F.row_number().over(scenarios.Window.orderBy("cle_salarie")) % 4 + 9_000_001
    )
    more = first.join(odd, F.col("_r") == F.col("id_ctrl")).select(
        "id_ctrl", "cle_salarie", F.lit(" Marche/running ").alias("mode_trajet"), "distance_m", F.lit(60).alias("duree_sec"),
        F.lit(None).cast("decimal(6,2)").alias("seuil_km"), F.lit(False).alias("est_incoherent"), F.lit(None).cast("date").alias("date_ctrl"),
    )
    checks = m.commute_checks.unionByName(more.select(*[F.col(f.name).cast(f.dataType) for f in m.commute_checks.schema]))
    got = scenarios.cost_scenarios(m.bi_employee, checks, m.salaries, m.activity_counts, scenarios.scenarios_frame(spark))
    got = {r.scenario: r for r in got.collect()}
    assert len(got) == len(COST_SCENARIOS)
    distinct = set()
    for name in ("initiale", "marche_stricte", "velo_strict", "minimum_bas", "tout_change"):
        row = next(r for r in COST_SCENARIOS if r[0] == name)
        params = spark.createDataFrame(
            list(zip(scenarios.SCENARIO_PARAMS, row[1:], strict=True)), "code_param string, valeur_param string"
        ).withColumn("date_effet", F.lit("2020-01-01").cast("date"))
        pivot = param_pivot(effective_params(params, DEFAULT_RUN.as_of))
        commute = bi.bi_commute(flag_incoherent(checks, params, DEFAULT_RUN))
        bonus = eligibility.bonus_eligibility(m.bi_employee, commute, m.salaries)
        well = eligibility.wellbeing_eligibility(m.bi_employee, m.activity_counts, pivot, DEFAULT_RUN)
        cost = kpi.kpi_bonus_cost(bonus, m.salaries, pivot).first()
        fixed = kpi.kpi_bonus_cost_fixed(bonus, pivot).first()
        days = kpi.kpi_extra_days(well, pivot).first()
        r = got[name]
        assert r.nb_salaries_eligibles_prime == cost.nb_salaries_eligibles_prime
        assert r.cout_annuel_total_prime_variable == cost.cout_annuel_total_prime
        assert r.cout_annuel_total_prime_fixe == fixed.cout_annuel_total_prime
        assert r.nb_salaries_eligibles_bien_etre == days.nb_salaries_eligibles_bien_etre
        assert r.nb_jours_supplementaires == days.nb_jours_supplementaires
        distinct.add((r.nb_salaries_eligibles_prime, r.nb_jours_supplementaires))
    assert len(distinct) >= 4


def test_look_ups(spark):
    d = spark.createDataFrame(
        [("marche", 0, 1, 1), ("marche", 999, 2, 2), ("marche", 1000, 4, 4), ("marche", 5001, 8, 8), ("velo", 7, 16, 16), ("aucun", None, 32, 32)],
        "seuil string, distance_m long, n long, masse long",
    ).withColumn("masse", F.col("masse").cast("decimal(38,2)"))
    asked = [("marche", -1), ("marche", 0), ("marche", 999), ("marche", 1000), ("marche", 3500), ("marche", 5000), ("marche", 5001), ("velo", 6), ("velo", 10**6)]
    limits = spark.createDataFrame(asked * 2, "seuil string, limite long")
    got = {(r.seuil, r.limite): (r.n, r.masse) for r in scenarios.within_threshold(d, limits).collect()}
    want = [0, 1, 3, 7, 7, 7, 15, 0, 16]
    assert got == {k: (n, decimal.Decimal(n)) for k, n in zip(asked, want, strict=True)}
    a = spark.createDataFrame([(0, 5), (3, 2), (10, 1)], "nb long, n long")
    m = spark.createDataFrame([(0,), (1,), (3,), (4,), (11,), (3,)], "minimum int")
    assert dict(map(tuple, scenarios.reaching_minimum(a, m).collect())) == {0: 8, 1: 3, 3: 3, 4: 1, 11: 0}
