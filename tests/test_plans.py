"""Eligibility, KPI, quality engine and history on hand-built rows."""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import functions as F

from perkline.config import RunConfig
from perkline.operators import quality
from perkline.plans import eligibility, history, kpi, notify, params
from tests.conftest import rows

RUN = RunConfig(as_of=dt.date(2024, 2, 15))


def _pivot(spark, min_act="15", days="5"):
    p = spark.createDataFrame(
        [
            ("taux_prime", "0.05", dt.date(2023, 1, 1)),
            ("montant_prime_fixe", "1500", dt.date(2023, 1, 1)),
            ("jours_bien_etre", days, dt.date(2023, 1, 1)),
            ("min_activites_bien_etre", min_act, dt.date(2023, 1, 1)),
        ],
        "code_param string, valeur_param string, date_effet date",
    )
    return params.param_pivot(params.effective_params(p, RUN.as_of))


EMP_SCHEMA = "cle_salarie string, mod_depl_decl_normalise string, mod_depl_decl_inconnu boolean, date_naissance date"


def test_bonus_reasons_each_alone_and_priority(spark):
    emps = spark.createDataFrame(
        [
            ("ok", "Marche/running", False, None),
            ("sal0", "Marche/running", False, None),
            ("salneg", "Marche/running", False, None),
            ("salnull", "Marche/running", False, None),
            ("nocheck", "Marche/running", False, None),
            ("excl", "Marche/running", False, None),
            ("incoh", "Marche/running", False, None),
            ("unk", "INCONNU", True, None),
            ("car", "Transports en commun", False, None),
            ("nullmode", "INCONNU", False, None),
            ("two", "Transports en commun", False, None),
        ],
        EMP_SCHEMA,
    )
    commute = spark.createDataFrame(
        [(k, False, False) for k in ("ok", "sal0", "salneg", "salnull", "unk", "car", "nullmode")]
        + [("excl", False, True), ("incoh", True, False)],
        "cle_salarie string, est_incoherent boolean, est_exclue_structurelle boolean",
    )
    sal = spark.createDataFrame(
        [("ok", 100.0), ("sal0", 0.0), ("salneg", -5.0), ("salnull", None), ("nocheck", 1.0), ("excl", 1.0), ("incoh", 1.0),
         ("unk", 1.0), ("car", 1.0), ("nullmode", 1.0), ("two", None)],
        "cle_salarie string, brut_annuel double",
    ).withColumn("brut_annuel", F.col("brut_annuel").cast("decimal(12,2)"))
    out = eligibility.bonus_eligibility(emps, commute, sal)
    assert rows(out) == [
        ("car", False, "mode_non_sportif"),
        ("excl", False, "ctrl_trajet_exclu"),
        ("incoh", False, "ctrl_trajet_incoherent"),
        ("nocheck", False, "ctrl_trajet_manquant"),
        ("nullmode", False, "mode_non_sportif"),  # NULL declared mode (T7)
        ("ok", True, None),
        ("sal0", False, "salaire_manquant"),
        ("salneg", False, "salaire_manquant"),
        ("salnull", False, "salaire_manquant"),
        ("two", False, "salaire_manquant"),  # salary beats commute reasons
        ("unk", False, "mode_inconnu"),
    ]


def test_wellbeing_threshold_and_window_bounds(spark):
    emps = spark.createDataFrame([(k, "x", False, None) for k in ("a14", "a15", "a16", "none")], EMP_SCHEMA)
    start, end = RUN.period()
    acts = []
    for key, n in (("a14", 14), ("a15", 15), ("a16", 16)):
        for i in range(n):
            day = start if i == 0 else end if i == 1 else start + dt.timedelta(days=i)
            acts.append((key, dt.datetime.combine(day, dt.time(11)), day, False))
    acts.append(("a14", dt.datetime.combine(end + dt.timedelta(days=1), dt.time(11)), end + dt.timedelta(days=1), False))
    acts.append(("a14", dt.datetime(2023, 6, 1, 11), dt.date(2023, 6, 1), True))  # excluded row
    bi = spark.createDataFrame(acts, "cle_salarie string, date_debut timestamp_ntz, date_activite date, est_exclue_structurelle boolean")
    counts = eligibility.activity_count_window(bi, RUN)
    well = eligibility.wellbeing_eligibility(emps, counts, _pivot(spark), RUN)
    assert rows(well, "cle_salarie", "nb_activites_periode", "est_eligible_bien_etre", "jours_bien_etre_attribues") == [
        ("a14", 14, False, 0),
        ("a15", 15, True, 5),
        ("a16", 16, True, 5),
        ("none", 0, False, 0),
    ]
    k = kpi.kpi_extra_days(well, _pivot(spark)).first()
    assert (k["nb_salaries_eligibles_bien_etre"], k["nb_jours_supplementaires"]) == (2, 10)


def test_kpi_empty_input(spark):
    empty_bonus = spark.createDataFrame([], "cle_salarie string, est_eligible_prime boolean, motif_ineligibilite string")
    empty_sal = spark.createDataFrame([], "cle_salarie string, brut_annuel decimal(12,2)")
    assert kpi.kpi_bonus_cost(empty_bonus, empty_sal, _pivot(spark)).count() == 0  # grouped KPI: no row
    fixed = kpi.kpi_bonus_cost_fixed(empty_bonus, _pivot(spark)).collect()
    assert len(fixed) == 1 and fixed[0]["nb_salaries_eligibles_prime"] == 0  # global KPI: one row
    empty_ctrl = spark.createDataFrame([], "cle_salarie string, est_incoherent boolean")
    assert kpi.kpi_incoherences(empty_ctrl).first()[0] == 0


def test_quality_engine(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", 5), (3, None, -1)], "id int, k string, d int")
    parent = spark.createDataFrame([("a",)], "k string")
    checks = [
        quality.Check("t", "rows", "row_count", fail_le=0, warn_lt=100),
        quality.Check("t", "missing d", "missing", ("d",)),
        quality.Check("t", "dup k", "duplicates", ("k",)),
        quality.Check("t", "neg", "failed_rows", predicate="d < 0"),
        quality.Check("t", "ref", "reference", ("k",), parent="p", parent_col="k"),
        quality.Check("t", "dom", "domain", ("k",), values=("b",)),
        quality.Check("p", "req", "required", ("k",), values=("a", "z")),
    ]
    out = quality.evaluate({"t": df, "p": parent}, checks)
    assert rows(out, "controle", "metrique", "statut") == [
        ("dom", 2, "FAIL"),
        ("dup k", 1, "FAIL"),
        ("missing d", 1, "FAIL"),
        ("neg", 1, "FAIL"),
        ("ref", 0, "OK"),
        ("req", 1, "FAIL"),
        ("rows", 3, "WARN"),
    ]
    summary = quality.summarise(out).first()
    assert (summary["nb_ok"], summary["nb_warn"], summary["nb_fail"], summary["statut_global"]) == (1, 1, 5, "FAIL")


def test_history_snapshot_success_and_failure(spark):
    p = spark.createDataFrame([("taux_prime", "0.05", dt.date(2023, 1, 1))], "code_param string, valeur_param string, date_effet date")
    kpis = {name: spark.range(2).withColumn("v", F.lit(name)) for name in history.HISTORY_TABLES}
    res = history.snapshot(spark, kpis, p, 7, RUN)
    assert res["status"] == "SUCCESS" and len(res["snapshots"]) == 6
    run_row = spark.read.parquet(res["run"]).first()
    assert run_row["status"] == "SUCCESS" and run_row["id_histo_run"] == 7
    assert run_row["param_effectif"] == '{"taux_prime":{"valeur_param":"0.05","date_effet":"2023-01-01"}}'
    assert spark.read.parquet(res["snapshots"]["age"]).filter(F.col("id_histo_run") == 7).count() == 2
    broken = dict(kpis)
    del broken["jours_sup"]
    res = history.snapshot(spark, broken, p, 8, RUN)
    assert res["status"] == "FAILURE" and res["snapshots"] == {}
    row = spark.read.parquet(res["run"]).first()
    assert row["status"] == "FAILURE" and len(row["error_message"]) <= 4000
    assert os.path.basename(res["run"]).startswith("histo_run")


def test_outbox_force_fallback(spark):
    TS = dt.datetime
    act = spark.createDataFrame(
        [(1, "s1", TS(2024, 1, 5, 11), 1800, "Runing", 5000, "", "csv_gsheet", True),
         (2, "s1", TS(2024, 1, 6, 11), 1800, "Judo", None, "top", "csv_gsheet", True)],
        "id_activite long, cle_salarie string, date_debut timestamp_ntz, duree_sec int, type_activite string, distance_m int, "
        "commentaire string, source_donnee string, flag_slack boolean",
    )
    link = spark.createDataFrame([("1", "s1")], "id_salarie_brut string, cle_salarie string")
    roster = spark.createDataFrame([("1", "Roy", "Ana")], "id_salarie_brut string, nom string, prenom string")
    file_rows = act.select("cle_salarie", "date_debut", "duree_sec", "distance_m", "type_activite", "commentaire", "source_donnee")
    assert notify.outbox(file_rows, act, link, roster, force=False).count() == 0  # all already published
    forced = notify.outbox(file_rows, act, link, roster, force=True)
    assert rows(forced, "id_activite", "origine") == [(1, "pending"), (2, "pending")]
    none_file = file_rows.limit(0)
    fb = notify.outbox(none_file, act, link, roster, force=True, k=1)
    got = fb.collect()
    assert [(r["id_activite"], r["origine"]) for r in got] == [(2, "fallback")]
    assert got[0]["message"].startswith("Félicitations Ana Roy ! Discipline Judo pratiquée pendant 30 min. Bravo ! (top)")


def test_history_readers_and_required_tables(spark):
    import pytest

    runs = spark.createDataFrame([(1, "SUCCESS"), (2, "FAILURE"), (3, "RUNNING")], "id_histo_run long, status string")
    snap = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id_histo_run long, v string")
    assert rows(history.successful_snapshots(runs, snap), "v") == [("a",)]
    with pytest.raises(ValueError):
        history.require_tables(spark, ["histo_kpi_age_absent_table"])


def test_columns_and_expected_volume_checks(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    checks = [
        quality.Check("t", "cols ok", "columns", ("a", "b")),
        quality.Check("t", "cols order", "columns", ("b", "a")),
        quality.Check("t", "volume", "row_count", op="=", expected=2, warn_only=True),
    ]
    out = quality.evaluate({"t": df}, checks)
    assert rows(out, "controle", "metrique", "statut") == [("cols ok", 0, "OK"), ("cols order", 1, "FAIL"), ("volume", 1, "WARN")]


def test_fingerprint_sees_a_value_move_across_a_null(spark):
    from perkline.plans.fingerprint import fingerprint

    schema = "x string, y string, z string"
    a = fingerprint(spark.createDataFrame([("a", None, "b")], schema), "t").first()
    for row in (("a", "b", None), ("a", "", "b"), ("a|", None, "b"), ("ab", None, "")):
        assert fingerprint(spark.createDataFrame([row], schema), "t").first() != a
    same = spark.createDataFrame([("a", None, "b"), ("c", None, None)], schema)
    assert fingerprint(same, "t").first() == fingerprint(same.orderBy(F.col("x").desc()), "t").first()
