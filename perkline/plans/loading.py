"""Activity load (K2): conflict gate, priority merge, per-day dedup, upsert
of form rows and partial reload of simulated rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perkline.config import SOURCE_FORM, SOURCE_SIMULATED, SOURCES_TO_REPLACE, RunConfig
from perkline.functions.dates import local_day, year_month
from perkline.operators import mutate
from perkline.operators.partitions import Layout
from perkline.plans.ingest import daily_conflicts, dedup_daily  # noqa: F401

KEYS = ["cle_salarie", "date_debut", "source_donnee"]
UPDATE_COLS = ["duree_sec", "distance_m", "type_activite", "commentaire"]
FILE_COLS = ["cle_salarie", "date_debut", "duree_sec", "distance_m", "type_activite", "commentaire", "source_donnee"]


def activity_layout() -> Layout:
    """The activity table by source and month of the start instant, both part
    of its key."""
    return Layout({"source_donnee": F.trim("source_donnee"), "mois": year_month("date_debut")}, "id_activite")


def merge_priority(low: DataFrame, high: DataFrame, keys=("cle_salarie", "date_debut")) -> DataFrame:
    """Drop lower-priority rows whose key exists in the priority set,
    then union both."""
    kept = low.join(high.select(*keys).distinct(), list(keys), "left_anti")
    return kept.select(*low.columns).unionByName(high.select(*low.columns))


def simulated_file(activities: DataFrame, forms: DataFrame, run: RunConfig) -> DataFrame:
    """Simulated-activity file derived from the bound activities: simulated
    rows, one per employee and local day (latest), on days without a form
    declaration — the generator's one-activity-per-day contract."""
    sim = activities.filter(F.col("source_donnee") == SOURCE_SIMULATED)
    one, _ = dedup_daily(sim, keep="latest", zone=run.zone)
    form_days = forms.select("cle_salarie", local_day("date_debut", run.zone).alias("_jour")).distinct()
    one = one.withColumn("_jour", local_day("date_debut", run.zone)).join(form_days, ["cle_salarie", "_jour"], "left_anti")
    return one.select(*FILE_COLS)


def _one_per_day(rows: DataFrame, zone: str) -> DataFrame:
    """W4 keep-latest per (employee, local day); after the gate this is a
    no-op, without it ties on the instant fall back to the row content."""
    from perkline.operators.dedup import keep_one_per_group

    day = rows.withColumn("_jour", local_day("date_debut", zone))
    return keep_one_per_group(day, ["cle_salarie", "_jour"], order=[("date_debut", "desc")]).select(*FILE_COLS)


def assert_no_conflicts(df: DataFrame, label: str, zone: str) -> None:
    """W7 gate: stop (base unchanged) when two rows share employee and day."""
    if not daily_conflicts(df, zone).isEmpty():
        raise ValueError(f"STOP: several activities per employee and local day ({label})")


def conflicting_inputs(inputs: dict[str, DataFrame], zone: str) -> list[str]:
    """W7 gate over several inputs in ONE aggregation: the names of the
    inputs holding two rows for one (employee, local day).  Only existence
    matters, so no member rows are joined back; the result holds at most
    one row per input name."""
    tagged = None
    for name, df in inputs.items():
        part = df.select(F.lit(name).alias("_src"), "cle_salarie", local_day("date_debut", zone).alias("_jour"))
        tagged = part if tagged is None else tagged.unionByName(part)
    groups = tagged.groupBy("_src", "cle_salarie", "_jour").agg(F.count(F.lit(1)).alias("_n"))
    return sorted(r[0] for r in groups.filter(F.col("_n") > 1).select("_src").distinct().collect())


def load_activities(target: DataFrame, forms: DataFrame, simulated: DataFrame, run: RunConfig,
                    check_conflicts: bool = True) -> DataFrame:
    """K2: next version of the activity table with an ``action`` column."""
    forms = forms.select(*FILE_COLS)
    simulated = simulated.select(*FILE_COLS)
    fusion = merge_priority(simulated, forms)
    if check_conflicts:
        bad = conflicting_inputs({"forms": forms, "simulated": simulated, "fusion": fusion}, run.zone)
        if bad:
            raise ValueError(f"STOP: several activities per employee and local day ({', '.join(bad)})")
    forms_eff = _one_per_day(fusion.filter(F.col("source_donnee") == SOURCE_FORM), run.zone)
    sim_eff = _one_per_day(fusion.filter(F.col("source_donnee") == SOURCE_SIMULATED), run.zone)
    ingest_ts = F.lit(run.as_of).cast("timestamp_ntz")
    # the upserted table is the next version: write it once (shared
    # checkpoint folder), so the id bound and the reload read the files
    # instead of re-planning the full outer join and the id assignment
    from perkline.session import materialise

    upserted = materialise(
        mutate.upsert(
            target,
            forms_eff,
            KEYS,
            UPDATE_COLS,
            id_col="id_activite",
            insert_defaults={"date_ingestion": ingest_ts, "flag_slack": F.lit(False)},
        ),
        "activite-upsert",
    )
    has_sim = sim_eff.select(F.lit(1)).limit(1).exists()
    kept = upserted.filter(~(has_sim & F.col("source_donnee").isin(list(SOURCES_TO_REPLACE))))
    start = upserted.agg(F.max("id_activite").alias("m")).select("m").scalar()
    new_sim = mutate.assign_ids(sim_eff, KEYS, start, "id_activite").select(
        "id_activite",
        *FILE_COLS,
        ingest_ts.alias("date_ingestion"),
        F.lit(False).alias("flag_slack"),
        F.lit(mutate.INSERT).alias("action"),
    )
    return kept.unionByName(new_sim.select(*kept.columns))


def prepare_activities(rows: DataFrame) -> DataFrame:
    """Types of an incoming activity file before the load.

    Text trimmed (key) or kept, NULL text -> '' (never the text 'nan'),
    missing duration -> 0, distance nullable; a NULL start instant stops
    the job (an unparseable date makes the whole file invalid).
    """
    start = F.col("date_debut")
    return rows.select(
        F.trim("cle_salarie").alias("cle_salarie"),
        F.when(start.isNotNull(), start).otherwise(F.raise_error(F.lit("date_debut invalide")).cast("timestamp_ntz")).alias("date_debut"),
        F.coalesce(F.col("duree_sec"), F.lit(0)).alias("duree_sec"),
        F.col("distance_m"),
        F.coalesce(F.col("type_activite"), F.lit("")).alias("type_activite"),
        F.coalesce(F.col("commentaire"), F.lit("")).alias("commentaire"),
        F.coalesce(F.col("source_donnee"), F.lit("")).alias("source_donnee"),
    )
