"""KPI history (K9, K12) and run metrics.

A run is a parent row (id, timestamp, Paris date, status, message,
effective parameters as JSON) plus one snapshot table per KPI tagged with
the run id.  Runs are journalled: a RUNNING event is appended before the
first snapshot, SUCCESS after the last one, FAILURE (message truncated to 4000
characters) on an error.  Events are only ever appended; ``run_states`` folds
them to one row a run, in which a RUNNING event without an end is a failure,
so a driver that died leaves a failed run behind.  Snapshots are staged under
the shared checkpoint folder, and published only when all six are written.
Readers keep SUCCESS runs only.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from perkline.config import ERROR_MESSAGE_MAX, RUN_STATUSES, RunConfig
from perkline.functions.dates import local_day
from perkline.operators.mutate import commit_version
from perkline.plans.params import params_json
from perkline.session import scratch_path

HISTORY_TABLES = ("age", "cout_prime", "cout_prime_fixe", "incoherences", "jours_sup", "pratique_sport")


def run_instant(run: RunConfig) -> dt.datetime:
    """Deterministic run instant: noon UTC of the as-of date."""
    return dt.datetime.combine(run.as_of, dt.time(12, 0))


def tag_snapshot(kpi: DataFrame, run_id: int, ts: dt.datetime) -> DataFrame:
    """One snapshot: the KPI rows with the run id and snapshot instant."""
    return kpi.select(F.lit(run_id).cast("long").alias("id_histo_run"), F.lit(ts).cast("timestamp_ntz").alias("ts_snapshot"), "*")


EVENTS = "id_histo_run long, ts_histo timestamp_ntz, evenement string, message string, param_effectif string"
RUNNING, SUCCESS, FAILURE = RUN_STATUSES
INTERRUPTED = "run interrupted before its end"


class Journal:
    """Run events in a Parquet folder that only grows."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, path or scratch_path(spark, "histo_journal")

    def append(self, params_effective: DataFrame, run_id: int, ts: dt.datetime, event: str, message: str | None = None) -> None:
        """One event, with the effective parameters as JSON."""
        params_json(params_effective).select(
            F.lit(run_id).cast("long").alias("id_histo_run"),
            F.lit(ts).cast("timestamp_ntz").alias("ts_histo"),
            F.lit(event).alias("evenement"),
            F.lit(message).cast("string").alias("message"),
            "param_effectif",
        ).coalesce(1).write.mode("append").parquet(self.path)

    def events(self) -> DataFrame:
        return self.spark.read.schema(EVENTS).parquet(self.path)


def run_states(events: DataFrame, zone: str) -> DataFrame:
    """One row per run: the last end event, or a failure where there is none.

    Of several end events the one with the latest instant counts, and a
    failure before a success at the same one."""
    ended = F.col("evenement") != RUNNING
    last = F.max(F.when(ended, F.struct("ts_histo", (F.col("evenement") == FAILURE).alias("f"), "evenement", "message")))
    folded = events.groupBy("id_histo_run").agg(
        F.min("ts_histo").alias("ts_histo"), last.alias("end"), F.max_by("param_effectif", "ts_histo").alias("param_effectif")
    )
    message = F.when(F.col("end").isNull(), F.lit(INTERRUPTED)).otherwise(F.col("end.message"))
    return folded.select(
        "id_histo_run",
        "ts_histo",
        local_day("ts_histo", zone).alias("date_histo_paris"),
        F.coalesce("end.evenement", F.lit(FAILURE)).alias("status"),
        F.substring(message, 1, ERROR_MESSAGE_MAX).alias("error_message"),
        "param_effectif",
    )


def batch_events(batches: DataFrame, effective: DataFrame, zone: str) -> DataFrame:
    """The events of many runs, one per batch ``(ts, message)``: each is opened
    as RUNNING and ends with FAILURE where the gate left a message, else
    with SUCCESS.  ``effective`` holds (jour, code_param, valeur_param,
    date_effet); a run takes the parameters of its local day."""
    entries = F.array_sort(F.collect_list(F.struct("code_param", F.struct("valeur_param", "date_effet"))))
    days = effective.groupBy("jour").agg(F.to_json(F.map_from_entries(entries)).alias("param_effectif"))
    runs = batches.select(
        F.row_number().over(Window.orderBy("ts")).cast("long").alias("id_histo_run"), "ts", local_day("ts", zone).alias("jour"), "message"
    )
    end = F.when(F.col("message").isNull(), SUCCESS).otherwise(FAILURE)
    steps = F.array(
        F.struct(F.lit(RUNNING).alias("evenement"), F.lit(None).cast("string").alias("message")),
        F.struct(end.alias("evenement"), F.col("message").alias("message")),
    )
    return runs.join(days, "jour", "left").select(
        "id_histo_run", F.col("ts").alias("ts_histo"), F.explode(steps).alias("e"), "param_effectif"
    ).select("id_histo_run", "ts_histo", "e.evenement", "e.message", "param_effectif")


def require_tables(spark: SparkSession, names) -> None:
    """Every history target must exist before a snapshot."""
    missing = [n for n in names if not spark.catalog.tableExists(n)]
    if missing:
        raise ValueError(f"history tables missing: {missing}")


def snapshot(
    spark: SparkSession,
    kpis: dict[str, DataFrame],
    params_effective: DataFrame,
    run_id: int,
    run: RunConfig,
    journal: Journal | None = None,
) -> dict:
    """K9: open the run, stage the six snapshots, close the run.

    Returns ``{"run": path, "journal": path, "snapshots": {name: path},
    "rows": {name: rows}, "status": ...}``; on failure ``snapshots`` is empty
    and the run's row carries the error.
    """
    ts = run_instant(run)
    journal = journal or Journal(spark)
    journal.append(params_effective, run_id, ts, RUNNING)
    staged: dict[str, str] = {}
    rows: dict[str, int] = {}
    try:
        for name in HISTORY_TABLES:
            watched, seen = observed(tag_snapshot(kpis[name], run_id, ts), f"histo_{name}")
            staged[name] = commit_version(spark, watched, f"histo_kpi_{name}")
            rows[name] = seen()["n"]
        status, message = SUCCESS, None
    except Exception as exc:  # noqa: BLE001 - the failure is recorded, not raised
        staged, rows = {}, {}
        status, message = FAILURE, f"{type(exc).__name__}: {exc}"[:ERROR_MESSAGE_MAX]
    journal.append(params_effective, run_id, ts, status, message)
    run_path = commit_version(spark, run_states(journal.events(), run.zone), "histo_run")
    return {"run": run_path, "journal": journal.path, "snapshots": staged, "rows": rows, "status": status}


def observed(df: DataFrame, name: str, **counts: Column) -> tuple[DataFrame, Callable[[], dict]]:
    """``df`` that counts its rows (``n``), and ``counts``, while it is written;
    the second result gives the counts afterwards.

    Counted at the top of a written frame, each partition counts once, also
    when a task had to be repeated; no job runs for it.
    """
    watch = Observation(f"{name}-{uuid.uuid4().hex}")
    watched = df.observe(watch, F.count(F.lit(1)).alias("n"), *[c.alias(k) for k, c in counts.items()])

    def seen() -> dict:
        found = watch.get
        return {k: int(found.get(k) or 0) for k in ("n", *counts)}

    return watched, seen


def run_metrics(steps: DataFrame, run: RunConfig) -> DataFrame:
    """One metric row per step — (name, start, end, status, read,
    written, anomalies, origin), counters checked non-negative, ids in
    step order; ``steps`` holds (nom_pipeline, statut, nb_lignes_lues,
    nb_lignes_ecrites, nb_anomalies, ordre)."""
    ts = F.lit(run_instant(run)).cast("timestamp_ntz")

    def counter(name: str):
        # CHECK (counter >= 0): a negative counter fails the job
        c = F.col(name).cast("int")
        return F.when(c >= 0, c).otherwise(F.raise_error(F.lit(f"negative counter {name}")).cast("int")).alias(name)

    return steps.select(
        F.col("ordre").cast("long").alias("id_run"),
        "nom_pipeline",
        ts.alias("date_debut_exe"),
        ts.alias("date_fin_exe"),
        "statut",
        counter("nb_lignes_lues"),
        counter("nb_lignes_ecrites"),
        counter("nb_anomalies"),
        F.lit("NO PARAM").alias("Origine"),
    )


def successful_snapshots(runs: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Readers' view of a history table: rows of SUCCESS runs only (a
    failed or unfinished run never exposes partial snapshots)."""
    ok = runs.filter(F.col("status") == "SUCCESS").select("id_histo_run").distinct()
    return snapshot.join(ok, "id_histo_run", "left_semi")
