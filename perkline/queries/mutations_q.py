"""Table-mutation queries (M1-M10, K2, K3, K5, S11, P7, P9) with twins.

Each query returns the *next version* of the mutated table with an
``action`` column (or the step counts), computed from the current version
and the incoming rows of the bound data.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from perkline.config import DEFAULT_RUN, SOURCE_SIMULATED, SOURCES_TO_REPLACE, SPORTS
from perkline.functions.text import pseudonym
from perkline.operators import mutate
from perkline.operators.partitions import PartitionedTable
from perkline.plans import commute, counters
from perkline.plans.loading import activity_layout, load_activities, simulated_file
from perkline.queries import register
from perkline.session import materialise
from perkline.sources.tables import Tables
from perkline.twins import twin
from perkline.twins import exprs as X

RUN = DEFAULT_RUN
AS_OF_TS = f"CAST(DATE '{RUN.as_of.isoformat()}' AS TIMESTAMP)"


def T(spark, sf_dir) -> Tables:
    return Tables.of(spark, sf_dir, RUN)


ACT_COLS = ["id_activite", "cle_salarie", "date_debut", "duree_sec", "type_activite", "distance_m", "commentaire", "source_donnee",
            "date_ingestion", "flag_slack"]
UPD = ["duree_sec", "distance_m", "type_activite", "commentaire"]


def _upsert_activities_twin(target: str, source: str) -> str:
    sets = ", ".join(f"CASE WHEN s.in_s THEN s.{c} ELSE t.{c} END AS {c}" for c in UPD)
    keys = "t.cle_salarie = s.cle_salarie AND t.date_debut = s.date_debut AND t.source_donnee = s.source_donnee"
    merged = (
        "SELECT coalesce(t.cle_salarie, s.cle_salarie) AS cle_salarie, coalesce(t.date_debut, s.date_debut) AS date_debut, "
        f"coalesce(t.source_donnee, s.source_donnee) AS source_donnee, t.id_activite, {sets}, "
        f"CASE WHEN t.in_t THEN t.date_ingestion ELSE {AS_OF_TS} END AS date_ingestion, "
        "CASE WHEN t.in_t THEN t.flag_slack ELSE false END AS flag_slack, "
        "CASE WHEN t.in_t AND s.in_s THEN 'update' WHEN s.in_s THEN 'insert' ELSE 'unchanged' END AS action "
        f"FROM (SELECT *, true AS in_t FROM {target}) t FULL OUTER JOIN (SELECT *, true AS in_s FROM {source}) s ON {keys}"
    )
    return (
        f"SELECT * REPLACE (CASE WHEN action = 'insert' THEN (SELECT max(id_activite) FROM {target}) + row_number() OVER "
        "(PARTITION BY action = 'insert' ORDER BY cle_salarie, date_debut, source_donnee) ELSE id_activite END AS id_activite) "
        f"FROM ({merged})"
    )


@register("upsert_activities", twin(_upsert_activities_twin("b_act_table", "b_act_v2")))
def q_upsert_activities(spark, sf_dir):
    """M1: unconditional upsert of the incoming activity file."""
    t = T(spark, sf_dir)
    return mutate.upsert(
        t.activity_table(),
        t.activity_source_v2(),
        ["cle_salarie", "date_debut", "source_donnee"],
        UPD,
        id_col="id_activite",
        insert_defaults={"date_ingestion": F.lit(RUN.as_of).cast("timestamp_ntz"), "flag_slack": F.lit(False)},
    ).select(*ACT_COLS, "action")


RH_CMP = ["nom", "prenom", "bu", "date_naissance", "adresse_dom", "mod_depl_decl", "type_contrat", "date_embauche"]
RH_COLS = ["id_salarie_brut", *RH_CMP, "brut_annuel", "sport_declare", "actif"]


def _roster_target(t: Tables):
    return t.roster().select(*RH_COLS)


def _distinct(a: str, b: str) -> str:
    return f"{a} IS DISTINCT FROM {b}"


UPSERT_RH_TWIN = twin(
    "SELECT coalesce(t_id, s_id) AS id_salarie_brut, "
    + ", ".join(f"CASE WHEN act IN ('update', 'insert') THEN s_{c} ELSE t_{c} END AS {c}" for c in RH_CMP)
    + ", t_brut_annuel AS brut_annuel, t_sport_declare AS sport_declare, CASE WHEN act IN ('update', 'insert') THEN true ELSE t_actif END AS actif, "
    "act AS action FROM (SELECT *, CASE WHEN t_in AND s_in AND ("
    + " OR ".join(_distinct(f"t_{c}", f"s_{c}") for c in RH_CMP)
    + " OR t_actif IS DISTINCT FROM true) THEN 'update' WHEN t_in AND s_in THEN 'noop' WHEN s_in THEN 'insert' ELSE 'unchanged' END AS act FROM ("
    "SELECT t.id_salarie_brut AS t_id, s.id_salarie_brut AS s_id, "
    + ", ".join(f"t.{c} AS t_{c}, s.{c} AS s_{c}" for c in RH_CMP)
    + ", t.brut_annuel AS t_brut_annuel, t.sport_declare AS t_sport_declare, t.actif AS t_actif, t.in_t AS t_in, s.in_s AS s_in "
    "FROM (SELECT *, true AS in_t FROM b_roster) t FULL OUTER JOIN (SELECT *, true AS in_s FROM b_roster_v2) s "
    "ON t.id_salarie_brut = s.id_salarie_brut))"
)


@register("upsert_roster", UPSERT_RH_TWIN)
def q_upsert_roster(spark, sf_dir):
    """M2: change-only upsert of the HR roster (reactivates updated rows)."""
    t = T(spark, sf_dir)
    return mutate.upsert_if_changed(_roster_target(t), t.roster_v2(), "id_salarie_brut", RH_CMP, flag_col="actif")


DEACT_TWIN = twin(
    "SELECT r.id_salarie_brut, r.nom, CASE WHEN d THEN false ELSE r.actif END AS actif, CASE WHEN d THEN 'update' ELSE 'unchanged' END AS action "
    "FROM (SELECT r.*, (p.id_salarie_brut IS NULL AND r.actif IS DISTINCT FROM false AND r.actif = true) AS d FROM b_roster r "
    "LEFT JOIN (SELECT DISTINCT id_salarie_brut FROM b_roster_v2) p ON p.id_salarie_brut = r.id_salarie_brut) r"
)


@register("deactivate_absent", DEACT_TWIN)
def q_deactivate_absent(spark, sf_dir):
    """M5: soft delete of active employees missing from the new file."""
    t = T(spark, sf_dir)
    return mutate.deactivate_absent(t.roster().select("id_salarie_brut", "nom", "actif"), t.roster_v2(), "id_salarie_brut")


LINKS_V2 = f"SELECT id_salarie_brut, {X.pseudonym('id_salarie_brut')} AS cle_salarie FROM b_roster_v2"
INS_LINKS_TWIN = twin(
    "SELECT id_salarie_brut, cle_salarie, 'unchanged' AS action FROM b_link UNION ALL "
    f"SELECT s.id_salarie_brut, s.cle_salarie, 'insert' FROM ({LINKS_V2}) s WHERE s.id_salarie_brut NOT IN (SELECT id_salarie_brut FROM b_link)"
)


def _links_v2(t: Tables):
    return t.roster_v2().select("id_salarie_brut", pseudonym("id_salarie_brut", RUN.salt).alias("cle_salarie"))


@register("insert_missing_links", INS_LINKS_TWIN)
def q_insert_missing_links(spark, sf_dir):
    """M4: insert-if-absent of the link rows of new employees."""
    t = T(spark, sf_dir)
    return mutate.insert_missing(t.link(), _links_v2(t), "id_salarie_brut")


EMP_CMP = ["nom", "prenom", "bu", "mod_depl_decl"]
EMP_V1 = "SELECT l.cle_salarie, r.nom, r.prenom, r.bu, r.mod_depl_decl FROM b_link l JOIN b_roster r ON r.id_salarie_brut = l.id_salarie_brut"
EMP_SRC = (
    "SELECT l.cle_salarie, r.nom, r.prenom, r.bu, r.mod_depl_decl FROM b_roster_v2 r JOIN "
    f"(SELECT id_salarie_brut, cle_salarie FROM b_link UNION ALL SELECT * FROM ({LINKS_V2}) WHERE id_salarie_brut NOT IN "
    "(SELECT id_salarie_brut FROM b_link)) l ON l.id_salarie_brut = r.id_salarie_brut"
)
SYNC_EMP_TWIN = twin(
    "SELECT coalesce(t_k, s_k) AS cle_salarie, "
    + ", ".join(f"CASE WHEN act IN ('update', 'insert') THEN s_{c} ELSE t_{c} END AS {c}" for c in EMP_CMP)
    + ", act AS action FROM (SELECT *, CASE WHEN t_in AND s_in AND ("
    + " OR ".join(_distinct(f"t_{c}", f"s_{c}") for c in EMP_CMP)
    + ") THEN 'update' WHEN t_in AND s_in THEN 'noop' WHEN s_in THEN 'insert' ELSE 'unchanged' END AS act FROM ("
    "SELECT t.cle_salarie AS t_k, s.cle_salarie AS s_k, "
    + ", ".join(f"t.{c} AS t_{c}, s.{c} AS s_{c}" for c in EMP_CMP)
    + f", t.in_t AS t_in, s.in_s AS s_in FROM (SELECT *, true AS in_t FROM ({EMP_V1})) t FULL OUTER JOIN "
    f"(SELECT *, true AS in_s FROM ({EMP_SRC})) s ON t.cle_salarie = s.cle_salarie))"
)


def _employees_v1(t: Tables):
    return t.link().join(t.roster().select("id_salarie_brut", *EMP_CMP), "id_salarie_brut").select("cle_salarie", *EMP_CMP)


@register("sync_employee", SYNC_EMP_TWIN)
def q_sync_employee(spark, sf_dir):
    """M3: change-only upsert of the business employee table, through the
    (completed) link table."""
    from perkline.plans.hr import sync_employee

    t = T(spark, sf_dir)
    links = mutate.insert_missing(t.link(), _links_v2(t), "id_salarie_brut").drop("action")
    return sync_employee(_employees_v1(t), t.roster_v2(), links)


UPD_SPORT_TWIN = twin(
    "SELECT r.id_salarie_brut, CASE WHEN c THEN v ELSE r.sport_declare END AS sport_declare, CASE WHEN c THEN 'update' ELSE 'unchanged' END AS action "
    "FROM (SELECT r.*, s.v, (s.in_s IS NOT NULL AND r.sport_declare IS DISTINCT FROM s.v) AS c FROM b_roster r LEFT JOIN "
    "(SELECT id_salarie_brut, CASE WHEN length(trim(sport_declare)) > 0 THEN trim(sport_declare) END AS v, true AS in_s FROM b_roster_v2) s "
    "ON s.id_salarie_brut = r.id_salarie_brut) r"
)


@register("update_declared_sport", UPD_SPORT_TWIN)
def q_update_declared_sport(spark, sf_dir):
    """M6: differential update of the declared sport (blank -> NULL)."""
    t = T(spark, sf_dir)
    return mutate.update_if_distinct(
        t.roster().select("id_salarie_brut", "sport_declare"), t.roster_v2(), "id_salarie_brut", "sport_declare"
    )


def _count(sql: str, actions: str) -> str:
    return f"(SELECT count(*) FROM ({sql}) WHERE action IN ({actions}))"


SPORT_FILE = "SELECT id_salarie_brut, nullif(trim(sport_declare), '') AS v FROM b_roster_v2"
# sports are compared after the inserts: a new employee's old sport is NULL
SPORT_AFTER_INSERTS = twin(
    f"SELECT s.id_salarie_brut FROM ({SPORT_FILE}) s LEFT JOIN b_roster r USING (id_salarie_brut) WHERE r.sport_declare IS DISTINCT FROM s.v"
)
SYNC_COUNTS_TWIN = (
    "SELECT etape, nb_lignes FROM (VALUES "
    f"('desactivation', {_count(DEACT_TWIN, chr(39) + 'update' + chr(39))}), "
    f"('upsert_rh', {_count(UPSERT_RH_TWIN, chr(39) + 'update' + chr(39) + ', ' + chr(39) + 'insert' + chr(39))}), "
    f"('liens', {_count(INS_LINKS_TWIN, chr(39) + 'insert' + chr(39))}), "
    f"('upsert_metier', {_count(SYNC_EMP_TWIN, chr(39) + 'update' + chr(39) + ', ' + chr(39) + 'insert' + chr(39))}), "
    f"('sport_declare', (SELECT count(*) FROM ({SPORT_AFTER_INSERTS})))) AS s(etape, nb_lignes) "
)
SYNC_COUNTS_TWIN = (
    f"WITH steps AS ({SYNC_COUNTS_TWIN}) SELECT etape, CAST(nb_lignes AS BIGINT) AS nb_lignes FROM steps "
    "UNION ALL SELECT 'total', CAST(sum(nb_lignes) AS BIGINT) FROM steps"
)


@register("sync_hr_counts", SYNC_COUNTS_TWIN)
def q_sync_hr_counts(spark, sf_dir):
    """K3: changed rows per HR sync step and in total."""
    from perkline.plans.hr import sync_hr_counts

    t = T(spark, sf_dir)
    return sync_hr_counts(t.roster().select(*RH_COLS), t.link(), _employees_v1(t), t.roster_v2(), RUN)


NEXT_ROSTER_TWIN = twin(
    "SELECT id_salarie_brut, " + ", ".join(RH_CMP) + ", brut_annuel, sport_declare, "
    "(actif AND id_salarie_brut IN (SELECT id_salarie_brut FROM b_roster_v2)) AS actif FROM (SELECT r.id_salarie_brut, "
    + ", ".join(f"CASE WHEN s.id_salarie_brut IS NULL THEN r.{c} ELSE s.{c} END AS {c}" for c in RH_CMP)
    + ", r.brut_annuel, CASE WHEN s.id_salarie_brut IS NULL THEN r.sport_declare ELSE nullif(trim(s.sport_declare), '') END AS sport_declare, "
    "s.id_salarie_brut IS NOT NULL AS actif FROM b_roster r LEFT JOIN b_roster_v2 s ON s.id_salarie_brut = r.id_salarie_brut "
    "UNION ALL SELECT id_salarie_brut, " + ", ".join(RH_CMP) + ", NULL, nullif(trim(sport_declare), ''), true FROM b_roster_v2 "
    "WHERE id_salarie_brut NOT IN (SELECT id_salarie_brut FROM b_roster))"
)


@register("sync_hr_roster", NEXT_ROSTER_TWIN)
def q_sync_hr_roster(spark, sf_dir):
    """K3: the roster after all steps of the sync."""
    from perkline.plans.hr import next_roster, roster_with_file

    t = T(spark, sf_dir)
    return next_roster(roster_with_file(t.roster().select(*RH_COLS), t.roster_v2()), RH_COLS)


@register(
    "reload_by_source",
    twin(
        "SELECT id_activite, cle_salarie, date_debut, duree_sec, type_activite, distance_m, commentaire, source_donnee, date_ingestion, flag_slack "
        "FROM b_act_table WHERE source_donnee <> 'csv_simule' OR NOT EXISTS (SELECT 1 FROM b_act_v2 WHERE source_donnee = 'csv_simule') "
        "UNION ALL SELECT (SELECT max(id_activite) FROM b_act_table) + row_number() OVER (ORDER BY cle_salarie, date_debut, source_donnee), "
        f"cle_salarie, date_debut, duree_sec, type_activite, distance_m, commentaire, source_donnee, {AS_OF_TS}, false "
        "FROM b_act_v2 WHERE source_donnee = 'csv_simule'"
    ),
)
def q_reload_by_source(spark, sf_dir):
    """M8: partial reload — simulated rows replaced by the new simulated file."""
    t = T(spark, sf_dir)
    target = t.activity_table()
    new = t.activity_source_v2().filter(F.col("source_donnee") == SOURCE_SIMULATED)
    start = target.agg(F.max("id_activite").alias("m")).select("m").scalar()
    new = mutate.assign_ids(new, ["cle_salarie", "date_debut", "source_donnee"], start, "id_activite").select(
        *ACT_COLS[:8], F.lit(RUN.as_of).cast("timestamp_ntz").alias("date_ingestion"), F.lit(False).alias("flag_slack")
    )
    return mutate.reload_sources(target, new, SOURCES_TO_REPLACE)


# ---------------------------------------------------------------------------
# Commute control (K5) and its pieces
# ---------------------------------------------------------------------------
SRC_SQL = (
    "SELECT l.cle_salarie, trim(coalesce(r.adresse_dom, '')) AS adresse_dom, trim(coalesce(r.mod_depl_decl, '')) AS mod_depl_decl "
    "FROM b_link l JOIN b_roster r ON r.id_salarie_brut = l.id_salarie_brut"
)
DIST_SQL = (
    "SELECT cle_salarie, distance_m, duree_sec FROM (SELECT *, row_number() OVER (PARTITION BY cle_salarie ORDER BY date_ctrl DESC NULLS FIRST, "
    "id_ctrl DESC) AS rn FROM b_commute_raw) WHERE rn = 1"
)
SEUIL = (
    "CASE WHEN trim(s.mod_depl_decl) = 'Marche/running' THEN coalesce(p.seuil_km_marche_course, CAST(15 AS DECIMAL(6,2))) "
    "WHEN trim(s.mod_depl_decl) = 'Vélo/Trottinette/Autres' THEN coalesce(p.seuil_km_velo_autres, CAST(25 AS DECIMAL(6,2))) END"
)
CONTROL_SQL = (
    "SELECT s.cle_salarie, s.mod_depl_decl AS mode_trajet, CASE trim(s.mod_depl_decl) WHEN 'Marche/running' THEN 'walking' "
    "WHEN 'Vélo/Trottinette/Autres' THEN 'bicycling' WHEN 'Transports en commun' THEN 'transit' ELSE 'driving' END AS mode_routage, "
    f"d.distance_m, d.duree_sec, CAST({SEUIL} AS DECIMAL(6,2)) AS seuil_km, "
    f"coalesce(d.distance_m > CAST(floor(CAST({SEUIL} AS DECIMAL(6,2)) * 1000) AS BIGINT), false) AS est_incoherent, {AS_OF_TS} AS date_ctrl "
    f"FROM ({SRC_SQL}) s JOIN ({DIST_SQL}) d ON d.cle_salarie = s.cle_salarie CROSS JOIN b_pivot p "
    "WHERE length(s.adresse_dom) > 0 AND length(s.mod_depl_decl) > 0"
)


def _distances(t: Tables):
    from perkline.operators.dedup import keep_one_per_group

    raw = t.commute_raw().withColumn("_nf", F.col("date_ctrl").isNull())
    latest = keep_one_per_group(raw, ["cle_salarie"], order=[("_nf", "desc"), ("date_ctrl", "desc"), ("id_ctrl", "desc")])
    return latest.select("cle_salarie", "distance_m", "duree_sec")


@register("commute_source", twin(SRC_SQL + " ORDER BY l.cle_salarie"))
def q_commute_source(spark, sf_dir):
    """Employees through the link table, trimmed, key-ordered."""
    t = T(spark, sf_dir)
    return commute.commute_source(t.link(), t.roster())


@register("commute_anomalies", twin(f"SELECT * FROM ({SRC_SQL}) WHERE NOT (length(adresse_dom) > 0 AND length(mod_depl_decl) > 0)"))
def q_commute_anomalies(spark, sf_dir):
    """Employees skipped for a missing address or mode."""
    t = T(spark, sf_dir)
    _, skipped = commute.split_usable(commute.commute_source(t.link(), t.roster()))
    return skipped


@register("commute_control", twin(CONTROL_SQL))
def q_commute_control(spark, sf_dir):
    """K5: check rows from usable employees and their distance results."""
    t = T(spark, sf_dir)
    src = commute.commute_source(t.link(), t.roster())
    return commute.commute_control(src, _distances(t), t.params(), RUN)


@register(
    "replace_commute_check",
    twin(f"SELECT row_number() OVER (ORDER BY cle_salarie) AS id_ctrl, * FROM ({CONTROL_SQL})"),
)
def q_replace_commute_check(spark, sf_dir):
    """M9: full reload of the check table (ids renumbered in key order)."""
    t = T(spark, sf_dir)
    rows = commute.commute_control(commute.commute_source(t.link(), t.roster()), _distances(t), t.params(), RUN)
    out = mutate.assign_ids(rows, ["cle_salarie"], F.lit(0), "id_ctrl")
    return out.select("id_ctrl", *rows.columns)


@register(
    "commute_incoherence",
    twin("SELECT id_ctrl, cle_salarie, mode_trajet, distance_m, seuil_km, est_incoherent FROM b_ctrl"),
)
def q_commute_incoherence(spark, sf_dir):
    """P7 on every check row: threshold and incoherence flag."""
    return T(spark, sf_dir).commute_checks().select("id_ctrl", "cle_salarie", "mode_trajet", "distance_m", "seuil_km", "est_incoherent")


@register(
    "refresh_decision",
    twin(
        "SELECT e.n AS nb_attendus, x.n AS nb_existants, false AS force, NOT (e.n > 0 AND x.n = e.n) AS a_rafraichir "
        "FROM (SELECT count(*) AS n FROM b_link) e, (SELECT count(*) AS n FROM b_ctrl) x"
    ),
)
def q_refresh_decision(spark, sf_dir):
    """Recompute the check table unless it is complete (not forced)."""
    t = T(spark, sf_dir)
    return mutate.should_refresh(t.link(), t.commute_checks(), force=False)


@register(
    "refresh_decision_variants",
    twin(
        "SELECT v.cas, e.n AS nb_attendus, CASE v.cas WHEN 'complet' THEN e.n WHEN 'force' THEN e.n ELSE 0 END AS nb_existants, "
        "v.cas = 'force' AS force, v.cas <> 'complet' AS a_rafraichir "
        "FROM (VALUES ('complet'), ('force'), ('vide')) v(cas), (SELECT count(*) AS n FROM b_link) e"
    ),
)
def q_refresh_decision_variants(spark, sf_dir):
    """A complete table is skipped, unless forced; an empty one is not."""
    links = T(spark, sf_dir).link()

    def case(name, existing, force):
        return mutate.should_refresh(links, existing, force).select(F.lit(name).alias("cas"), "*")

    return case("complet", links, False).unionByName(case("force", links, True)).unionByName(case("vide", links.where("false"), False))


# ---------------------------------------------------------------------------
# K2 activity load
# ---------------------------------------------------------------------------
def _load_twin() -> str:
    ld = X.local_day
    body = (
        "SELECT id_activite, cle_salarie, date_debut, duree_sec, type_activite, distance_m, commentaire, source_donnee, date_ingestion, "
        "flag_slack, action FROM kept UNION ALL SELECT (SELECT max(id_activite) FROM up) + row_number() OVER "
        "(ORDER BY cle_salarie, date_debut, source_donnee), cle_salarie, date_debut, duree_sec, type_activite, distance_m, commentaire, "
        f"source_donnee, {AS_OF_TS}, false, 'insert' FROM se"
    )
    extra = [
        ("forms", "SELECT cle_salarie, date_parsed AS date_debut, duree_sec, distance_m, sport AS type_activite, commentaire_out AS commentaire, "
                  "'csv_gsheet' AS source_donnee FROM x_day WHERE rn2 = 1"),
        ("sim0", f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cle_salarie, {ld('date_debut')} ORDER BY date_debut DESC, "
                 "id_activite DESC) AS rn_s FROM b_activity WHERE source_donnee = 'csv_simule') WHERE rn_s = 1"),
        ("sim", "SELECT cle_salarie, date_debut, duree_sec, distance_m, type_activite, commentaire, source_donnee FROM sim0 s WHERE NOT EXISTS "
                f"(SELECT 1 FROM forms f WHERE f.cle_salarie = s.cle_salarie AND {ld('f.date_debut')} = {ld('s.date_debut')})"),
        ("fusion", "SELECT * FROM sim s WHERE NOT EXISTS (SELECT 1 FROM forms f WHERE f.cle_salarie = s.cle_salarie AND f.date_debut = s.date_debut) "
                   "UNION ALL SELECT * FROM forms"),
        ("fe", "SELECT * FROM fusion WHERE source_donnee = 'csv_gsheet'"),
        ("se", "SELECT * FROM fusion WHERE source_donnee = 'csv_simule'"),
        ("up", _upsert_activities_twin("b_act_table", "fe")),
        ("kept", "SELECT * FROM up WHERE NOT ((SELECT count(*) FROM se) > 0 AND source_donnee = 'csv_simule')"),
    ]
    from perkline.queries.ingest_q import C as INGEST_CTES

    return twin(body, list(INGEST_CTES) + extra)


@register("load_activities", _load_twin())
def q_load_activities(spark, sf_dir):
    """K2: forms (normalised declarations) + simulated file -> next version
    of the activity table (upsert of forms, reload of simulated rows)."""
    from perkline.plans import ingest

    t = T(spark, sf_dir)
    # the two input files of the load are written once to the shared
    # checkpoint folder: the conflict gates and the merge then read them
    # instead of recomputing the normalisation
    forms = materialise(ingest.normalised(t, RUN).clean.drop("ligne"),
                        "load-forms")
    simulated = materialise(simulated_file(t.activities(), forms, RUN), "load-simulated")
    return load_activities(t.activity_table(), forms, simulated, RUN)


# ---------------------------------------------------------------------------
# M1/M8 by touched partitions, and the counts kept with them
# ---------------------------------------------------------------------------
KEYS_ACT = ["cle_salarie", "date_debut", "source_donnee"]


def _defaults():
    return {"date_ingestion": F.lit(RUN.as_of).cast("timestamp_ntz"), "flag_slack": F.lit(False)}


def _partitioned(t: Tables) -> PartitionedTable:
    return PartitionedTable.create(t.activity_table().select(*ACT_COLS), "activite-partitions", activity_layout())


@register("upsert_partitions", twin(f"SELECT {', '.join(ACT_COLS)} FROM ({_upsert_activities_twin('b_act_table', 'b_act_v2')})"))
def q_upsert_partitions(spark, sf_dir):
    """M1: the activity table after an upsert that reads and replaces only
    the partitions (source, month) of the incoming file."""
    t = T(spark, sf_dir)
    table = _partitioned(t)
    table.publish(table.stage_upsert(t.activity_source_v2(), KEYS_ACT, UPD, _defaults()))
    return table.rows().select(*ACT_COLS)


RELOADED_TWIN = (
    "SELECT id_activite, cle_salarie, date_debut, duree_sec, type_activite, distance_m, commentaire, source_donnee, date_ingestion, flag_slack "
    "FROM b_act_table WHERE source_donnee <> 'csv_simule' OR NOT EXISTS (SELECT 1 FROM b_act_v2 WHERE source_donnee = 'csv_simule') "
    "UNION ALL SELECT (SELECT max(id_activite) FROM b_act_table) + row_number() OVER (ORDER BY cle_salarie, date_debut, source_donnee), "
    f"cle_salarie, date_debut, duree_sec, type_activite, distance_m, commentaire, source_donnee, {AS_OF_TS}, false "
    "FROM b_act_v2 WHERE source_donnee = 'csv_simule'"
)


@register("reload_partitions", twin(RELOADED_TWIN))
def q_reload_partitions(spark, sf_dir):
    """M8: the activity table after the partitions of the simulated source
    were replaced; no row of the table is read for it."""
    t = T(spark, sf_dir)
    table = _partitioned(t)
    new = t.activity_source_v2().filter(F.col("source_donnee") == SOURCE_SIMULATED)
    change = table.stage_reload(new, SOURCES_TO_REPLACE, "source_donnee", KEYS_ACT, _defaults())
    if change:
        table.publish(change)
    return table.rows().select(*ACT_COLS)


_KNOWN_SPORT = X.canonical("type_activite", SPORTS, "type_n", "type_inconnu")
_MONTHLY = (
    "SELECT cle_salarie, strftime({day}, '%Y-%m') AS mois, count(*) AS nb FROM (SELECT *, {known} FROM ({rows})) "
    "WHERE NOT type_inconnu GROUP BY 1, 2"
)


def _counts_twin(body: str) -> str:
    """Counts taken anew from the rows after both changes."""
    upserted = f"SELECT {', '.join(ACT_COLS)} FROM ({_upsert_activities_twin('b_act_table', 'b_act_v2')})"
    late = "SELECT cle_salarie, date_debut - INTERVAL 400 DAY AS date_debut, 'Curling' AS type_activite, source_donnee FROM b_act_v2 WHERE source_donnee = 'csv_simule'"
    rows = (
        f"SELECT cle_salarie, date_debut, type_activite, source_donnee FROM ({upserted}) WHERE source_donnee <> 'csv_simule' UNION ALL "
        "SELECT cle_salarie, date_debut, type_activite, source_donnee FROM b_act_v2 WHERE source_donnee = 'csv_simule' AND duree_sec % 3 <> 0 "
        f"UNION ALL SELECT * REPLACE ('Tennis' AS type_activite) FROM ({late}) WHERE date_debut IS NOT NULL"
    )
    monthly = _MONTHLY.format(day=X.local_day("date_debut"), known=_KNOWN_SPORT, rows=rows)
    return twin(body.format(monthly=monthly))


def _maintained(spark, sf_dir):
    """Counts built once from the table, then corrected by an upsert of all
    sources and by a reload of the simulated one, some of whose rows are
    dropped and others come 400 days late."""
    t = T(spark, sf_dir)
    table = _partitioned(t)
    kept = counters.Counts.create(table.rows(), RUN.zone)
    source = t.activity_source_v2()
    simulated = source.filter(F.col("source_donnee") == SOURCE_SIMULATED)
    late = simulated.withColumns({"date_debut": F.col("date_debut") - F.expr("INTERVAL 400 DAY"), "type_activite": F.lit("Tennis")})
    reloaded = simulated.where("duree_sec % 3 <> 0").unionByName(late)
    for change in (
        lambda: table.stage_upsert(source, KEYS_ACT, UPD, _defaults()),
        lambda: table.stage_reload(reloaded, SOURCES_TO_REPLACE, "source_donnee", KEYS_ACT, _defaults()),
    ):
        staged = change()
        if staged:
            kept.apply(counters.change_delta(table, staged, RUN.zone))
            table.publish(staged)
    return kept


@register("monthly_counts_maintained", _counts_twin("{monthly}"))
def q_monthly_counts_maintained(spark, sf_dir):
    """A10: counts per employee and month, maintained through two changes."""
    return _maintained(spark, sf_dir).rows()


_W0, _W1 = RUN.period()


@register(
    "window_counts_maintained",
    _counts_twin(
        "SELECT cle_salarie, CAST(sum(nb) AS INTEGER) AS nb_activites_periode FROM ({monthly}) "
        f"WHERE mois BETWEEN '{_W0:%Y-%m}' AND '{_W1:%Y-%m}' GROUP BY cle_salarie"
    ),
)
def q_window_counts_maintained(spark, sf_dir):
    """The window counts as sums of maintained months."""
    return _maintained(spark, sf_dir).in_window(RUN)
