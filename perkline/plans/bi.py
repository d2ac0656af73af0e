"""BI views (K6): deduplicated activities, employees, latest commute check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perkline.config import SPORTS, TRAVEL_MODES, UNKNOWN
from perkline.functions.dates import local_day
from perkline.functions.text import dedup_digest
from perkline.operators.dedup import keep_one_per_group
from perkline.operators.labels import activity_category, canonical_label, to_km, to_minutes

BI_ACTIVITY_COLUMNS = (
    "cle_salarie",
    "date_debut",
    "date_activite",
    "duree_sec",
    "duree_min",
    "distance_m",
    "distance_km",
    "type_activite_normalise",
    "type_activite_inconnu",
    "categorie_activite_normalise",
    "categorie_activite_inconnu",
    "source_donnee",
    "commentaire",
    "cle_dedup_activite",
    "est_exclue_structurelle",
    "motif_exclusion",
)


def enrich_activities(activities: DataFrame, zone: str = "Europe/Paris") -> DataFrame:
    """P1-P5 on activity rows (no deduplication): local day, units, labels,
    category, duplicate digest and structural exclusion."""
    label, unknown = canonical_label("type_activite", SPORTS)
    labelled = activities.select("*", label.alias("type_activite_normalise"), unknown.alias("type_activite_inconnu"))
    return _derive(labelled, zone)


def bi_activity(activities: DataFrame, zone: str = "Europe/Paris") -> DataFrame:
    """W1 + K6: one row per exact-duplicate group, the smallest id kept.

    The duplicate key is (employee, instant, canonical type, duration,
    distance or -1, trimmed source or '').  Rows are spread by the whole key
    (not by employee), and the pick is an aggregate on (key -> min id), so a
    very active employee never lands in a single task.
    """
    label, unknown = canonical_label("type_activite", SPORTS)
    # only what the pick needs crosses the shuffle: the key, the id that
    # orders the group and the columns the key does not determine; every
    # derived column is computed after the dedup, on the kept rows only
    slim = activities.select(
        "id_activite",
        "cle_salarie",
        "date_debut",
        "duree_sec",
        "distance_m",
        "source_donnee",
        "commentaire",
        label.alias("type_activite_normalise"),
        unknown.alias("type_activite_inconnu"),
    ).select(
        "*",
        F.coalesce("distance_m", F.lit(-1)).alias("_k_dist"),
        F.coalesce(F.trim("source_donnee"), F.lit("")).alias("_k_src"),
    )
    # flat grouping keys: a filter on the start instant (e.g. the rolling
    # window) is pushed through the aggregate down to the Parquet scan
    keys = ["cle_salarie", "date_debut", "type_activite_normalise", "duree_sec", "_k_dist", "_k_src"]
    kept = keep_one_per_group(slim, keys, order=[("id_activite", "asc")], row_id="id_activite")
    return _derive(kept, zone).select(*BI_ACTIVITY_COLUMNS)


def _derive(rows: DataFrame, zone: str) -> DataFrame:
    """Local day, units, category, digest and exclusion of labelled rows."""
    df = rows.select(
        "*",
        local_day("date_debut", zone).alias("date_activite"),
        to_minutes("duree_sec").alias("duree_min"),
        to_km("distance_m").alias("distance_km"),
    )
    category, cat_unknown = activity_category("type_activite_normalise", "type_activite_inconnu")
    return df.select(
        "*",
        category.alias("categorie_activite_normalise"),
        cat_unknown.alias("categorie_activite_inconnu"),
        dedup_digest(
            "cle_salarie", "date_debut", "type_activite_normalise", "duree_sec", "distance_m", "source_donnee"
        ).alias("cle_dedup_activite"),
        F.col("type_activite_inconnu").alias("est_exclue_structurelle"),
        F.when(F.col("type_activite_inconnu"), F.lit("Type activité inconnu")).alias("motif_exclusion"),
    )


def bi_employee(link: DataFrame, roster: DataFrame) -> DataFrame:
    """Employee view; salary and address are not exposed."""
    label, unknown = canonical_label("mod_depl_decl", TRAVEL_MODES)
    r = roster.select(
        "id_salarie_brut",
        "nom",
        "prenom",
        "bu",
        *[F.col(c) if c in roster.columns else F.lit(None).cast(t).alias(c) for c, t in (("type_contrat", "string"), ("date_embauche", "date"))],
        "date_naissance",
        label.alias("mod_depl_decl_normalise"),
        unknown.alias("mod_depl_decl_inconnu"),
    )
    return link.select("id_salarie_brut", "cle_salarie").join(r, "id_salarie_brut", "inner").select(
        "cle_salarie",
        "nom",
        "prenom",
        "bu",
        "type_contrat",
        "date_embauche",
        "date_naissance",
        "mod_depl_decl_normalise",
        "mod_depl_decl_inconnu",
    )


def latest_checks(checks: DataFrame) -> DataFrame:
    """The latest check of each employee (date desc, id desc; a NULL date
    ranks first as in SQL ``DESC``), columns as they are.

    The latest row is picked by an aggregate (max of an ordered struct),
    which combines map-side: hot employees are reduced before the shuffle.
    """
    payload = ["mode_trajet", "distance_m", "duree_sec", "seuil_km", "est_incoherent"]
    latest = checks.groupBy("cle_salarie").agg(
        F.max(F.struct(F.col("date_ctrl").isNull().alias("_null_first"), "date_ctrl", "id_ctrl", *payload)).alias("v")
    )
    return latest.select("cle_salarie", *[F.col(f"v.{c}").alias(c) for c in ("date_ctrl", *payload)])


def bi_commute(checks: DataFrame) -> DataFrame:
    """W2 + K6: latest check per employee, canonical mode and exclusion flag."""
    # labels and units are derived on the one kept row per employee
    label, unknown = canonical_label("mode_trajet", TRAVEL_MODES)
    return latest_checks(checks).select(
        "cle_salarie",
        label.alias("mode_trajet_normalise"),
        unknown.alias("mode_trajet_inconnu"),
        "distance_m",
        to_km("distance_m").alias("distance_km"),
        "duree_sec",
        to_minutes("duree_sec").alias("duree_min"),
        "seuil_km",
        "est_incoherent",
        "date_ctrl",
        (label == UNKNOWN).alias("est_exclue_structurelle"),
    )
