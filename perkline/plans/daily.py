"""One daily run as a single driver program (the scheduled flow, §3.1).

normalise declared rows -> load activities -> synchronise HR -> commute
control (when the check table is incomplete or forced) -> KPIs and their
snapshot -> quality suites -> notification outbox -> run metrics.

Every output is written as a new version under the shared checkpoint folder
(``commit_version``): nothing is overwritten in place, and the returned
mapping ``name -> path`` is what a catalog would publish.  The scheduler
that fires this once a day is not part of the engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perkline.config import DEFAULT_RUN, RunConfig
from perkline.functions.dates import local_day
from perkline.operators import mutate, quality
from perkline.operators.dedup import keep_one_per_group
from perkline.operators.mutate import commit_version
from perkline.plans import checks, commute, history, hr, ingest, loading, notify
from perkline.plans.model import BenefitModel
from perkline.sources.tables import Tables


def daily_run(spark: SparkSession, sf_dir: str, run: RunConfig = DEFAULT_RUN, force_commute: bool = False,
              force_notify: bool = False, run_id: int = 1, versions: dict[str, DataFrame] | None = None,
              ledger: notify.Ledger | None = None) -> dict:
    """Run every step once; returns {output name: path}.

    ``versions`` are the tables to start from, in place of the bound ones;
    each step reads what the steps before it wrote.  ``ledger`` holds the
    messages that earlier runs handed over.
    """
    t = Tables(spark, sf_dir, run, versions)
    out: dict = {}
    seen: dict[str, dict] = {}
    steps: list[tuple] = []

    def write(name: str, df: DataFrame, **counts) -> DataFrame:
        """The next version of an output, its rows counted as they are written."""
        watched, got = history.observed(df, name, **counts)
        out[name] = commit_version(spark, watched, name)
        seen[name] = got()
        return spark.read.parquet(out[name])

    def step(name: str, read: int, written: int, anomalies: int, status: str = "SUCCESS") -> None:
        steps.append((len(steps) + 1, name, status, read, written, anomalies))

    # 1. declared rows -> clean / rejects / anomalies (all-or-nothing gate)
    n = ingest.normalised(t, run, staged=True)
    write("rejets", n.errors)
    write("anomalies", n.anomalies)
    accepted = seen["rejets"]["n"] == 0
    if accepted:
        forms = write("declaratifs_normalises", n.clean.drop("ligne"))
    step("normalisation_declaratifs", n.n_read, seen["declaratifs_normalises"]["n"] if accepted else 0, seen["anomalies"]["n"],
         "SUCCESS" if accepted else "FAILED")

    # 2. activity load (forms + simulated file) -> next activity table
    if accepted:
        simulated = write("fichier_simule", loading.simulated_file(t.activities(), forms, run))
        changed = F.count_if(F.col("action").isin(mutate.INSERT, mutate.UPDATE))
        activity = write("activite", loading.load_activities(t.activity_table(), forms, simulated, run), changed=changed).drop("action")
        step("chargement_activites", seen["declaratifs_normalises"]["n"] + seen["fichier_simule"]["n"], seen["activite"]["changed"], 0)
    else:
        activity = write("activite", t.activity_table())
        step("chargement_activites", 0, 0, 0, "SKIPPED")

    # 3. HR synchronisation (soft delete, upsert, links, employees, sport)
    roster_file = t.roster_v2()
    links = write("lien_salarie", mutate.insert_missing(t.link(), hr.new_links(roster_file, run.salt), "id_salarie_brut").drop("action"))
    hr.require_links(roster_file, links)
    columns = [c for c in t.roster().columns if c != "cle_salarie"]
    both, in_file = history.observed(hr.roster_with_file(t.roster().select(*columns), roster_file), "roster_file", lines=F.count("f"))
    roster = write("rh_salarie", hr.next_roster(both, columns))
    employees = t.link().join(t.roster().select("id_salarie_brut", *hr.EMPLOYEE_COMPARE), "id_salarie_brut").select(
        "cle_salarie", *hr.EMPLOYEE_COMPARE
    )
    write("salarie", hr.sync_employee(employees, roster_file, links).drop("action"))
    total = F.max(F.when(F.col("etape") == "total", F.col("nb_lignes")))
    write("sync_rh", hr.sync_hr_counts(t.roster().select(*columns), t.link(), employees, roster_file, run), changed=total)
    step("synchronisation_rh", in_file()["lines"], seen["sync_rh"]["changed"], 0)

    # from here on the run reads its own versions
    t = Tables(spark, sf_dir, run, {
        **t.versions,
        "activity_table": activity,
        "activities": activity.withColumn("jour", local_day("date_debut", run.zone)),
        "link": links,
        "roster": roster.join(links, "id_salarie_brut"),
    })

    # 4. commute control, only when the check table is incomplete (or forced)
    decision = write("decision_trajets", mutate.should_refresh(t.link(), t.commute_checks(), force_commute)).first()
    if decision["a_rafraichir"]:
        src = commute.commute_source(t.link(), t.roster())
        raw = t.commute_raw().withColumn("_nf", F.col("date_ctrl").isNull())
        distances = keep_one_per_group(raw, ["cle_salarie"], order=[("_nf", "desc"), ("date_ctrl", "desc"), ("id_ctrl", "desc")])
        ctrl = commute.commute_control(src, distances.select("cle_salarie", "distance_m", "duree_sec"), t.params(), run)
        ctrl = write("ctrl_trajet", mutate.assign_ids(ctrl, ["cle_salarie"], F.lit(0), "id_ctrl"))
        t = Tables(spark, sf_dir, run, {**t.versions, "commute_checks": ctrl})
        # employees without an address, a mode or a distance are skipped
        checked = seen["ctrl_trajet"]["n"]
        step("controle_trajets", decision["nb_attendus"], checked, decision["nb_attendus"] - checked)
    else:
        step("controle_trajets", decision["nb_attendus"], 0, 0, "SKIPPED")

    # 5. KPIs and their history snapshot (SUCCESS only when all six exist)
    m = BenefitModel(spark, sf_dir, run, t)
    with m.kept():
        snap = history.snapshot(spark, m.kpis(), m.effective_params, run_id, run)
        out["histo_run"], out["histo_journal"] = snap["run"], snap["journal"]
        out.update({f"histo_kpi_{k}": v for k, v in snap["snapshots"].items()})
        step("historisation_kpi", seen["salarie"]["n"], sum(snap["rows"].values()), 0,
             "SUCCESS" if snap["status"] == history.SUCCESS else "FAILED")

        # 6. quality suites
        from perkline.queries.quality_q import tables as dq_tables

        suites = checks.table_suite(run) + checks.simulation_suite(run)
        write("controles", quality.evaluate(dq_tables(m), suites), bad=F.count_if(F.col("statut") != quality.OK))
        step("controles_qualite", len(suites), seen["controles"]["n"], seen["controles"]["bad"])

    # 7. notification outbox of what was loaded, then the publication flags;
    # after a failed gate nothing was loaded, so nothing is announced
    loaded = forms if accepted else activity.limit(0)
    sent = ledger or notify.Ledger(spark)
    todo = notify.outbox(loaded, activity, t.link(), t.roster(), force=force_notify and accepted)
    box = write("outbox", sent.unsent(todo, f"run-{run_id}", force=force_notify))
    sent.hand_over(box, f"run-{run_id}")
    write("activite_publiee", sent.flagged(activity).drop("action"))
    out["registre_publication"] = sent.path
    step("publication", seen["declaratifs_normalises"]["n"] if accepted else 0, seen["outbox"]["n"], 0, "SUCCESS" if accepted else "SKIPPED")

    # 8. run metrics: the counts that the steps made while they wrote
    names = "ordre int, nom_pipeline string, statut string, nb_lignes_lues long, nb_lignes_ecrites long, nb_anomalies long"
    write("run_metrique", history.run_metrics(spark.createDataFrame(steps, names), run))
    return out


def main(argv=None) -> None:
    import argparse
    import datetime as dt
    import json

    from perkline.session import build_session

    p = argparse.ArgumentParser(description="One daily run over a data directory.")
    p.add_argument("data", help="directory of the driver Parquet tables")
    p.add_argument("--as-of", default=DEFAULT_RUN.as_of.isoformat())
    p.add_argument("--force-commute", action="store_true")
    p.add_argument("--force-notify", action="store_true")
    args = p.parse_args(argv)
    spark = build_session()
    run = RunConfig(as_of=dt.date.fromisoformat(args.as_of))
    print(json.dumps(daily_run(spark, args.data, run, args.force_commute, args.force_notify), indent=1))


if __name__ == "__main__":
    main()
