"""The daily run end to end on the smallest driver tables."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from perkline.config import DEFAULT_RUN
from perkline.functions.dates import local_day
from perkline.plans import bi, ingest
from perkline.plans.daily import daily_run
from perkline.sources.tables import Tables

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not available")
OUTPUTS = ("rejets", "anomalies", "activite", "rh_salarie", "lien_salarie", "salarie", "sync_rh", "ctrl_trajet", "histo_run",
           "controles", "outbox", "activite_publiee", "run_metrique")


def test_daily_run_writes_every_output(spark):
    out = daily_run(spark, SF, DEFAULT_RUN, force_commute=True)
    for name in OUTPUTS:
        assert name in out, name
    run_row = spark.read.parquet(out["histo_run"]).first()
    assert run_row["status"] == "SUCCESS"
    assert len([k for k in out if k.startswith("histo_kpi_")]) == 6
    # blocking errors exist in the declared rows: the clean file is not written (all-or-nothing)
    assert "declaratifs_normalises" not in out
    metrics = {r["nom_pipeline"]: r for r in spark.read.parquet(out["run_metrique"]).collect()}
    assert len(metrics) == 7
    first = metrics["normalisation_declaratifs"]
    assert first["statut"] == "FAILED" and first["nb_lignes_ecrites"] == 0
    assert first["nb_lignes_lues"] == Tables(spark, SF, DEFAULT_RUN).declared().count()
    # nothing was loaded, so nothing is announced
    assert metrics["chargement_activites"]["statut"] == metrics["publication"]["statut"] == "SKIPPED"
    assert spark.read.parquet(out["outbox"]).isEmpty()
    before = Tables(spark, SF, DEFAULT_RUN).activity_table()
    assert sorted(spark.read.parquet(out["activite_publiee"]).collect()) == sorted(before.collect())


def test_daily_run_reads_what_it_loaded(spark):
    t = Tables(spark, SF, DEFAULT_RUN)
    wrong = ingest.normalised(t, DEFAULT_RUN).errors.select("ligne").distinct()
    good = t.declared().join(wrong, "ligne", "left_anti")
    out = daily_run(spark, SF, DEFAULT_RUN, force_commute=True, versions={"declared": good.select(*t.declared().columns)})
    assert "declaratifs_normalises" in out
    metrics = {r["nom_pipeline"]: r for r in spark.read.parquet(out["run_metrique"]).collect()}
    assert {r["statut"] for r in metrics.values()} == {"SUCCESS"}
    n = {k: (r["nb_lignes_lues"], r["nb_lignes_ecrites"], r["nb_anomalies"]) for k, r in metrics.items()}
    rows = {k: spark.read.parquet(v).count() for k, v in out.items() if k not in ("histo_journal", "registre_publication")}
    assert n["normalisation_declaratifs"] == (good.count(), rows["declaratifs_normalises"], rows["anomalies"])
    assert n["chargement_activites"][0] == rows["declaratifs_normalises"] + rows["fichier_simule"]
    assert n["chargement_activites"][1] == spark.read.parquet(out["activite"]).where("action IN ('insert', 'update')").count()
    changed = spark.read.parquet(out["sync_rh"]).where("etape = 'total'").first()["nb_lignes"]
    assert n["synchronisation_rh"] == (t.roster_v2().count(), changed, 0)
    assert n["controle_trajets"] == (rows["lien_salarie"], rows["ctrl_trajet"], rows["lien_salarie"] - rows["ctrl_trajet"])
    assert n["historisation_kpi"][1] == sum(v for k, v in rows.items() if k.startswith("histo_kpi_"))
    bad = spark.read.parquet(out["controles"]).where("statut <> 'OK'").count()
    assert n["controles_qualite"] == (rows["controles"], rows["controles"], bad)
    assert n["publication"] == (rows["declaratifs_normalises"], rows["outbox"], 0)
    activity = spark.read.parquet(out["activite"]).drop("action")
    forms = spark.read.parquet(out["declaratifs_normalises"])
    keys = ["cle_salarie", "date_debut", "source_donnee"]
    assert forms.join(activity, keys, "left_anti").count() == 0
    assert activity.select("id_activite").distinct().count() == activity.count()
    # the activity KPI counts the loaded version
    start, end = DEFAULT_RUN.period()
    seen = bi.bi_activity(activity.withColumn("jour", local_day("date_debut", DEFAULT_RUN.zone)), DEFAULT_RUN.zone)
    seen = seen.filter(~F.col("est_exclue_structurelle") & F.col("date_activite").between(F.lit(start), F.lit(end)))
    mix = spark.read.parquet(out["histo_kpi_pratique_sport"]).agg(F.sum("nb_activites")).first()[0]
    assert mix == seen.count()
    # the roster is the one after all steps: absent people inactive, new ones with their sport
    roster = {r["id_salarie_brut"]: r for r in spark.read.parquet(out["rh_salarie"]).collect()}
    file = {r["id_salarie_brut"]: r for r in t.roster_v2().collect()}
    assert set(file) <= set(roster)
    for key, row in roster.items():
        assert row["actif"] == (key in file)
        if key in file:
            assert row["sport_declare"] == ((file[key]["sport_declare"] or "").strip() or None)
            assert row["date_embauche"] == file[key]["date_embauche"] and row["type_contrat"] == file[key]["type_contrat"]
    # forms only are announced, and flagged afterwards
    box = spark.read.parquet(out["outbox"])
    flagged = spark.read.parquet(out["activite_publiee"]).filter("flag_slack")
    assert box.count() > 0 and box.join(flagged, "id_activite", "left_anti").count() == 0
