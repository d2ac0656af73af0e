"""Notification, history, metrics and remaining operator queries (K9,
K11, M11, M12, F5, F18, F19, J8, L2, P19, P20, P23, T2, A9/Q27, Q26)."""

from __future__ import annotations

from pyspark.sql import functions as F

from perkline.config import DEFAULT_RUN, ERROR_REASONS, NOTIFY_TOP_K
from perkline.functions.display import TEMPLATE_DEFAULT, TEMPLATES, TXT_DISTANCE_MISSING
from perkline.operators import mutate, quality
from perkline.plans import history, ingest, notify
from perkline.plans.loading import merge_priority
from perkline.plans.model import BenefitModel
from perkline.queries import register
from perkline.queries.functions_q import km_text_sql, minutes_text_sql
from perkline.queries.ingest_q import it
from perkline.queries.views_q import EFF_AT, vt
from perkline.session import materialise
from perkline.sources.tables import Tables
from perkline.twins import twin
from perkline.twins import exprs as X

RUN = DEFAULT_RUN


def T(spark, sf_dir) -> Tables:
    return Tables.of(spark, sf_dir, RUN)


LOOKUP_SQL = (
    "SELECT f.cle_salarie, f.date_debut, a.id_activite, a.flag_slack, trim(coalesce(r.prenom, '')) AS prenom, "
    "trim(coalesce(r.nom, '')) AS nom, f.type_activite AS f_type, f.duree_sec AS f_duree, f.distance_m AS f_distance, "
    "f.commentaire AS f_commentaire FROM b_act_v2 f JOIN b_act_table a ON a.cle_salarie = f.cle_salarie AND a.date_debut = f.date_debut "
    "AND a.source_donnee = 'csv_gsheet' JOIN b_link l ON l.cle_salarie = f.cle_salarie JOIN b_roster r ON r.id_salarie_brut = l.id_salarie_brut "
    "WHERE f.source_donnee = 'csv_gsheet'"
)
PENDING_SQL = f"SELECT * FROM ({LOOKUP_SQL}) WHERE NOT coalesce(flag_slack, false)"


def _found(t: Tables):
    return notify.lookup_pairs(t.activity_source_v2(), t.activity_table(), t.link(), t.roster())


@register("composite_key_lookup", twin(LOOKUP_SQL))
def q_composite_key_lookup(spark, sf_dir):
    """(employee, start) pairs of the incoming form file found in
    the table, with names — one bulk join."""
    return _found(T(spark, sf_dir))


@register("pending_notifications", twin(PENDING_SQL))
def q_pending_notifications(spark, sf_dir):
    """Form activities of the file present in the table and not yet
    published."""
    return notify.pending(_found(T(spark, sf_dir)), force=False)


def _sql_template(tpl: str, parts: dict[str, str]) -> str:
    out, rest = [], tpl
    while "{" in rest:
        head, tail = rest.split("{", 1)
        name, rest = tail.split("}", 1)
        if head:
            out.append(X.q(head))
        out.append(parts[name])
    if rest:
        out.append(X.q(rest))
    return " || ".join(out)


def message_sql(first: str, last: str, sport: str, dist: str, dur: str, comment: str) -> str:
    full = f"trim(concat_ws(' ', coalesce({first}, ''), coalesce({last}, '')))"
    c = f"trim(coalesce({comment}, ''))"
    c_txt = f"(CASE WHEN length({c}) > 0 THEN ' (' || {c} || ')' ELSE '' END)"
    d = f"coalesce(CASE WHEN length({dist}) > 0 THEN {dist} END, {X.q(TXT_DISTANCE_MISSING)})"
    parts = {"n": full, "dist": d, "dur": dur, "c": c_txt, "sport": f"coalesce({sport}, '')"}
    whens = " ".join(f"WHEN {sport} = {X.q(label)} THEN {_sql_template(tpl, parts)}" for label, tpl in TEMPLATES.items())
    return f"CASE {whens} ELSE {_sql_template(TEMPLATE_DEFAULT, parts)} END"


MSG_SQL = (
    "SELECT id_activite, "
    + message_sql("prenom", "nom", "f_type", km_text_sql("f_distance"), minutes_text_sql("f_duree"), "f_commentaire")
    + f" AS message FROM ({PENDING_SQL})"
)


@register("notification_messages", twin(MSG_SQL))
def q_notification_messages(spark, sf_dir):
    """message text per pending activity (template by sport)."""
    return notify.messages(notify.pending(_found(T(spark, sf_dir))), "f_type", "f_duree", "f_distance", "f_commentaire")


@register("notification_outbox", twin(f"SELECT id_activite, message, 'pending' AS origine FROM ({MSG_SQL})"))
def q_notification_outbox(spark, sf_dir):
    """The outbox of the run (not forced: pending messages only)."""
    t = T(spark, sf_dir)
    return notify.outbox(t.activity_source_v2(), t.activity_table(), t.link(), t.roster(), force=False)


FORCED_SQL = MSG_SQL.replace(PENDING_SQL, LOOKUP_SQL)


@register("notification_outbox_forced", twin(f"SELECT id_activite, message, 'pending' AS origine FROM ({FORCED_SQL})"))
def q_notification_outbox_forced(spark, sf_dir):
    """K11 forced: published activities of the file again."""
    t = T(spark, sf_dir)
    return notify.outbox(t.activity_source_v2(), t.activity_table(), t.link(), t.roster(), force=True)


LATEST_SQL = (
    "SELECT a.id_activite, r.prenom, r.nom, a.type_activite, a.duree_sec, a.distance_m, coalesce(a.commentaire, '') AS commentaire, "
    f"a.date_debut FROM (SELECT * FROM b_act_table WHERE source_donnee = 'csv_gsheet' ORDER BY date_debut DESC, id_activite DESC "
    f"LIMIT {NOTIFY_TOP_K}) a JOIN b_link l ON l.cle_salarie = a.cle_salarie JOIN b_roster r ON r.id_salarie_brut = l.id_salarie_brut"
)


@register("latest_k_activities", twin(LATEST_SQL))
def q_latest_k_activities(spark, sf_dir):
    """L2: the 10 most recent form activities (fallback of a forced run)."""
    t = T(spark, sf_dir)
    return notify.latest_k(t.activity_table(), t.link(), t.roster(), NOTIFY_TOP_K)


ACT_COLS = ["id_activite", "cle_salarie", "date_debut", "duree_sec", "type_activite", "distance_m", "commentaire", "source_donnee",
            "date_ingestion"]


@register(
    "mark_published",
    twin(
        f"SELECT {', '.join('a.' + c for c in ACT_COLS)}, CASE WHEN p.id_activite IS NOT NULL THEN true ELSE a.flag_slack END AS flag_slack, "
        "CASE WHEN p.id_activite IS NOT NULL AND a.flag_slack IS DISTINCT FROM true THEN 'update' ELSE 'unchanged' END AS action "
        f"FROM b_act_table a LEFT JOIN (SELECT DISTINCT id_activite FROM ({PENDING_SQL})) p ON p.id_activite = a.id_activite"
    ),
)
def q_mark_published(spark, sf_dir):
    """Publication flag set for every message of the outbox."""
    t = T(spark, sf_dir)
    box = notify.outbox(t.activity_source_v2(), t.activity_table(), t.link(), t.roster(), force=False)
    return mutate.mark_published(t.activity_table(), box)


# ---------------------------------------------------------------------------
# F19 anomaly digest
# ---------------------------------------------------------------------------
DCOLS = ingest.DECLARED_COLUMNS
FLOW = "normalisation_declaratifs"
RUN_TAG = RUN.as_of.strftime("%Y%m%d")
SOURCE_FILE = "20240131T090000_decla_sheet.csv"


def _line_sql(cols) -> str:
    vals = "concat_ws(',', " + ", ".join(f"CASE WHEN length(trim({c})) > 0 THEN trim({c}) END" for c in cols) + ")"
    reason = "trim(coalesce(raison, ''))"
    prefix = f"(CASE WHEN length({reason}) > 0 THEN '*' || {reason} || '* ' ELSE '*raison manquante*' END)"
    return f"CASE WHEN length({vals}) > 0 THEN '• ' || {prefix} || ' : ' || {vals} ELSE '• ' || {prefix} END"


ERR_REL = f"SELECT {', '.join(DCOLS)}, err_raison AS raison, ligne FROM x_class WHERE err_raison IS NOT NULL"
ANO_REL = (
    f"SELECT ano_raison AS raison, {', '.join(DCOLS)}, ligne FROM x_valid WHERE ano_raison IS NOT NULL "
    f"UNION ALL SELECT 'doublon_quasi_identique_ecarte', {', '.join(DCOLS)}, ligne FROM x_near WHERE rn1 > 1 "
    f"UNION ALL SELECT 'plusieurs_activites_jour', {', '.join(DCOLS)}, ligne FROM x_day WHERE rn2 > 1"
)
NE = f"(SELECT count(*) FROM ({ERR_REL}))"
NA = f"(SELECT count(*) FROM ({ANO_REL}))"
DIGEST_SQL = (
    f"SELECT 0 AS section, CAST(1 AS BIGINT) AS ordre, '{notify.DIGEST_PREFIX} | {FLOW} | ' || CASE WHEN {NE} > 0 THEN 'FAILURE' ELSE 'ANOMALIES' END "
    f"|| ' | run={RUN_TAG}' AS texte "
    f"UNION ALL SELECT 0, 2, 'Erreurs bloquantes: ' || CAST({NE} AS VARCHAR) || ' | Anomalies: ' || CAST({NA} AS VARCHAR) "
    f"UNION ALL SELECT 0, 3, 'Fichier source: {SOURCE_FILE}' "
    f"UNION ALL SELECT 1, -1, '--- ERREURS BLOQUANTES ---' WHERE {NE} > 0 "
    f"UNION ALL SELECT 1, CAST(ligne AS BIGINT), {_line_sql(DCOLS)} FROM ({ERR_REL}) "
    f"UNION ALL SELECT 2, -2, '--- ANOMALIES ---' WHERE {NA} > 0 "
    f"UNION ALL SELECT 2, -1, 'Anomalies: ' || CAST({NA} AS VARCHAR) || ' (affichage limité à {notify.ANOMALY_EXAMPLES} exemples)' "
    f"WHERE {NA} >= {notify.ANOMALY_FULL_LIST_BELOW} "
    f"UNION ALL SELECT * FROM (SELECT 2, CAST(ligne AS BIGINT) AS o, {_line_sql(DCOLS)} AS t FROM ({ANO_REL}) ORDER BY o, t "
    f"LIMIT {notify.ANOMALY_EXAMPLES}) WHERE {NA} >= {notify.ANOMALY_FULL_LIST_BELOW} "
    f"UNION ALL SELECT 2, CAST(ligne AS BIGINT), {_line_sql(DCOLS)} FROM ({ANO_REL}) WHERE {NA} < {notify.ANOMALY_FULL_LIST_BELOW}"
)


@register("anomaly_digest", it(DIGEST_SQL))
def q_anomaly_digest(spark, sf_dir):
    """Digest lines of the normalisation's errors and anomalies."""

    t = T(spark, sf_dir)
    n = ingest.normalised(t, RUN, staged=True)
    # the reject and anomaly files of the normalisation step (M14), written
    # once; the digest is built from them, as the alert reads the files
    errors = materialise(n.errors, "rejets-formulaire")
    anomalies = materialise(n.anomalies, "anomalies-formulaire")
    return notify.anomaly_digest(errors, anomalies, DCOLS, FLOW, RUN_TAG, SOURCE_FILE)


# ---------------------------------------------------------------------------
# K9 history snapshot, M11 run metrics
# ---------------------------------------------------------------------------
TS_RUN = f"TIMESTAMP '{history.run_instant(RUN).isoformat(sep=' ')}'"


@register("history_snapshot", vt(f"SELECT CAST(1 AS BIGINT) AS id_histo_run, {TS_RUN} AS ts_snapshot, * FROM x_age_kpi"))
def q_history_snapshot(spark, sf_dir):
    """K9: the age KPI tagged with the run id and snapshot instant."""
    m = BenefitModel.of(spark, sf_dir, RUN)
    return history.tag_snapshot(m.kpi_age(), 1, history.run_instant(RUN))


HISTORY_RELATIONS = {
    "cout_prime": "SELECT * FROM x_kpi_cost",
    "cout_prime_fixe": "SELECT p.montant_prime_fixe AS montant_prime, t.n AS nb_salaries_eligibles_prime, "
    + X.money("t.n * p.montant_prime_fixe")
    + " AS cout_annuel_total_prime FROM (SELECT CAST(ifnull(sum(prime), 0) AS BIGINT) AS n FROM x_due) t, b_pivot p",
    "incoherences": "SELECT * FROM x_kpi_inco",
    "jours_sup": "SELECT * FROM x_kpi_days",
    "pratique_sport": "SELECT * FROM x_kpi_mix",
}


def _history_query(name: str, relation: str) -> None:
    def run(spark, sf_dir):
        m = BenefitModel.of(spark, sf_dir, RUN)
        return history.tag_snapshot(m.kpis()[name], 1, history.run_instant(RUN))

    run.__doc__ = f"K9: the {name} KPI tagged with the run id and snapshot instant."
    register(f"history_{name}", vt(f"SELECT CAST(1 AS BIGINT) AS id_histo_run, {TS_RUN} AS ts_snapshot, k.* FROM ({relation}) k"))(run)


for _name, _relation in HISTORY_RELATIONS.items():
    _history_query(_name, _relation)

# a run per minute of submission: the gate decides how it ends
_REASONS = ", ".join(f"CASE WHEN n{i} > 0 THEN {X.q(r + ': ')} || n{i} END" for i, r in enumerate(ERROR_REASONS))
_RUNS = (
    "SELECT CAST(row_number() OVER (ORDER BY minute) AS BIGINT) AS id_histo_run, strptime(minute, '%Y-%m-%d %H:%M') AS ts_histo, "
    f"nullif(concat_ws(', ', {_REASONS}), '') AS message, lignes FROM (SELECT substr(horodateur, 1, 16) AS minute, "
    "count(DISTINCT ligne) AS lignes, "
    + ", ".join(f"count(*) FILTER (WHERE err_raison = {X.q(r)}) AS n{i}" for i, r in enumerate(ERROR_REASONS))
    + " FROM x_class GROUP BY 1)"
)
RUN_ROW_SQL = (
    f"SELECT r.id_histo_run, r.ts_histo, {X.local_day('r.ts_histo')} AS date_histo_paris, "
    "CASE WHEN r.message IS NULL THEN 'SUCCESS' ELSE 'FAILURE' END AS status, r.message AS error_message, j.js AS param_effectif "
    f"FROM ({_RUNS}) r LEFT JOIN (SELECT jour, CAST(to_json(map_from_entries(list((code_param, "
    "{'valeur_param': valeur_param, 'date_effet': date_effet}) "
    f"ORDER BY code_param))) AS VARCHAR) AS js FROM ({EFF_AT}) GROUP BY jour) j ON j.jour = {X.local_day('r.ts_histo')}"
)


def _minute_runs(spark, sf_dir):
    """Minutes of submission with the message of the gate (NULL: passed), and
    the journal of a run for each."""
    from perkline.plans import ingest
    from perkline.plans.params import effective_params_at

    m = BenefitModel.of(spark, sf_dir, RUN)
    lines = ingest.normalised(T(spark, sf_dir), RUN).classified
    found = [F.count_if(F.col("err_raison") == r).alias(f"n{i}") for i, r in enumerate(ERROR_REASONS)]
    minutes = lines.groupBy(F.substring("horodateur", 1, 16).alias("minute")).agg(F.count_if("premiere").alias("lignes"), *found)
    message = F.concat_ws(", ", *[F.when(F.col(f"n{i}") > 0, F.concat(F.lit(f"{r}: "), F.col(f"n{i}"))) for i, r in enumerate(ERROR_REASONS)])
    batches = minutes.select(
        F.to_timestamp_ntz("minute", F.lit("yyyy-MM-dd HH:mm")).alias("ts"), F.nullif(message, F.lit("")).alias("message"), "lignes"
    )
    batches = materialise(batches, "minute-batches")
    events = history.batch_events(batches, effective_params_at(m.params, m.activities, "jour"), RUN.zone)
    return batches, events


@register("history_run_rows", it(RUN_ROW_SQL))
def q_history_run_rows(spark, sf_dir):
    """K9: the run rows folded from the journal of one run per minute of
    submission; a run fails where the gate finds blocking errors (M15), and
    its message counts them."""
    _, events = _minute_runs(spark, sf_dir)
    return history.run_states(events, RUN.zone)


@register("history_successful", it(f"SELECT id_histo_run, ts_histo, lignes FROM ({_RUNS}) WHERE message IS NULL"))
def q_history_successful(spark, sf_dir):
    """K9: readers of a history table see the rows of successful runs only
    (here a snapshot of each minute's declared lines)."""
    batches, events = _minute_runs(spark, sf_dir)
    runs = history.run_states(events, RUN.zone)
    snapshot = runs.select("id_histo_run", "ts_histo").join(batches.select(F.col("ts").alias("ts_histo"), "lignes"), "ts_histo")
    return history.successful_snapshots(runs, snapshot).select("id_histo_run", "ts_histo", "lignes")


def _metrics_twin() -> str:
    from perkline.queries.mutations_q import CONTROL_SQL, SRC_SQL, SYNC_COUNTS_TWIN

    def n(sql: str) -> str:
        return f"(SELECT count(*) FROM ({sql}))"

    written_rh = f"(SELECT nb_lignes FROM ({SYNC_COUNTS_TWIN}) WHERE etape = 'total')"
    rows = [
        (1, "normalisation_declaratifs", n(twin("SELECT * FROM b_declared")), n(it("SELECT * FROM x_day WHERE rn2 = 1")), n(it(ANO_REL))),
        (2, "synchronisation_rh", n(twin("SELECT * FROM b_roster_v2")), written_rh, "0"),
        (3, "controle_trajets", n(twin(SRC_SQL)), n(twin(CONTROL_SQL)),
         n(twin(f"SELECT * FROM ({SRC_SQL}) WHERE NOT (length(adresse_dom) > 0 AND length(mod_depl_decl) > 0)"))),
    ]
    return " UNION ALL ".join(
        f"SELECT CAST({i} AS BIGINT) AS id_run, '{name}' AS nom_pipeline, {TS_RUN} AS date_debut_exe, {TS_RUN} AS date_fin_exe, "
        f"'SUCCESS' AS statut, CAST({r} AS INTEGER) AS nb_lignes_lues, CAST({w} AS INTEGER) AS nb_lignes_ecrites, "
        f"CAST({a} AS INTEGER) AS nb_anomalies, 'NO PARAM' AS \"Origine\""
        for i, name, r, w, a in rows
    )


@register("run_metric_rows", _metrics_twin())
def q_run_metric_rows(spark, sf_dir):
    """Metric rows of one run (normalisation, HR sync, commute control)."""
    from perkline.plans import commute
    from perkline.plans.hr import sync_hr_counts
    from perkline.queries.mutations_q import RH_COLS, _distances, _employees_v1

    t = T(spark, sf_dir)
    n = ingest.normalised(t, RUN, staged=True)
    one = t.declared().agg(F.count(F.lit(1)).alias("lues"))
    step1 = one.select(
        F.lit(1).alias("ordre"),
        F.lit("normalisation_declaratifs").alias("nom_pipeline"),
        F.lit("SUCCESS").alias("statut"),
        F.col("lues").alias("nb_lignes_lues"),
        n.clean.agg(F.count(F.lit(1)).alias("n")).select("n").scalar().alias("nb_lignes_ecrites"),
        n.anomalies.agg(F.count(F.lit(1)).alias("n")).select("n").scalar().alias("nb_anomalies"),
    )
    counts = sync_hr_counts(t.roster().select(*RH_COLS), t.link(), _employees_v1(t), t.roster_v2(), RUN)
    step2 = t.roster_v2().agg(F.count(F.lit(1)).alias("lues")).select(
        F.lit(2).alias("ordre"),
        F.lit("synchronisation_rh").alias("nom_pipeline"),
        F.lit("SUCCESS").alias("statut"),
        F.col("lues").alias("nb_lignes_lues"),
        counts.filter(F.col("etape") == "total").select("nb_lignes").scalar().alias("nb_lignes_ecrites"),
        F.lit(0).alias("nb_anomalies"),
    )
    src = commute.commute_source(t.link(), t.roster())
    ctrl = commute.commute_control(src, _distances(t), t.params(), RUN)
    _, skipped = commute.split_usable(src)
    step3 = src.agg(F.count(F.lit(1)).alias("lues")).select(
        F.lit(3).alias("ordre"),
        F.lit("controle_trajets").alias("nom_pipeline"),
        F.lit("SUCCESS").alias("statut"),
        F.col("lues").alias("nb_lignes_lues"),
        ctrl.agg(F.count(F.lit(1)).alias("n")).select("n").scalar().alias("nb_lignes_ecrites"),
        skipped.agg(F.count(F.lit(1)).alias("n")).select("n").scalar().alias("nb_anomalies"),
    )
    return history.run_metrics(step1.unionByName(step2).unionByName(step3), RUN)


# ---------------------------------------------------------------------------
# Remaining operators
# ---------------------------------------------------------------------------
@register(
    "merge_priority",
    it(
        "SELECT s.cle_salarie, s.date_debut, s.duree_sec, s.distance_m, s.type_activite, s.commentaire, s.source_donnee FROM "
        "(SELECT * FROM b_act_table WHERE source_donnee = 'csv_simule') s WHERE NOT EXISTS (SELECT 1 FROM x_day d WHERE d.rn2 = 1 "
        "AND d.cle_salarie = s.cle_salarie AND d.date_parsed = s.date_debut) UNION ALL SELECT cle_salarie, date_parsed, duree_sec, "
        "distance_m, sport, commentaire_out, 'csv_gsheet' FROM x_day WHERE rn2 = 1"
    ),
)
def q_merge_priority(spark, sf_dir):
    """Simulated rows dropped where a form row has the same
    (employee, start), then the union of both sources."""
    t = T(spark, sf_dir)
    forms = ingest.normalised(t, RUN).clean
    cols = ["cle_salarie", "date_debut", "duree_sec", "distance_m", "type_activite", "commentaire", "source_donnee"]
    sim = t.activity_table().filter(F.col("source_donnee") == "csv_simule").select(*cols)
    return merge_priority(sim, forms.select(*cols))


@register(
    "key_difference",
    twin(
        "SELECT id_salarie_brut FROM b_roster WHERE actif AND id_salarie_brut NOT IN (SELECT id_salarie_brut FROM b_roster_v2) "
    ),
)
def q_key_difference(spark, sf_dir):
    """Active keys of the table missing from the new file."""
    t = T(spark, sf_dir)
    active = t.roster().filter(F.col("actif")).select("id_salarie_brut").distinct()
    return active.join(t.roster_v2().select("id_salarie_brut"), "id_salarie_brut", "left_anti")


PREP_SQL = (
    "SELECT trim(cle_salarie) AS cle_salarie, date_debut, coalesce(duree_sec, 0) AS duree_sec, distance_m, "
    "coalesce(type_activite, '') AS type_activite, coalesce(commentaire, '') AS commentaire, coalesce(source_donnee, '') AS source_donnee "
    "FROM b_act_v2"
)


@register("prepare_activities", twin(PREP_SQL))
def q_prepare_activities(spark, sf_dir):
    """Type preparation of an incoming activity file (text trimmed,
    NULL text -> '', missing duration -> 0, distance kept nullable; an
    unparseable start instant stops the load)."""
    from perkline.plans.loading import prepare_activities

    return prepare_activities(T(spark, sf_dir).activity_source_v2())


FP_SQL = (
    "SELECT '{name}' AS table_name, count(*) AS nb_lignes, sum(CAST('0x' || substring(md5({row}), 1, 16) AS UBIGINT)::DECIMAL(38,0)) "
    "AS somme_haute, sum(CAST('0x' || substring(md5({row}), 17, 16) AS UBIGINT)::DECIMAL(38,0)) AS somme_basse FROM {rel}"
)
FP_COLS = ["id_salarie_brut", "nom", "prenom", "bu", "date_naissance", "adresse_dom", "mod_depl_decl", "sport_declare"]
ROSTER_ROW = (
    "concat_ws('|', "
    + ", ".join(f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in FP_COLS)
    + ")"
)


@register(
    "dataset_fingerprint",
    twin(
        "SELECT a.table_name, a.nb_lignes, a.somme_haute, a.somme_basse, "
        "(a.nb_lignes <> b.nb_lignes OR a.somme_haute <> b.somme_haute OR a.somme_basse <> b.somme_basse) AS modifie FROM ("
        + FP_SQL.format(name="rh_salarie", row=ROSTER_ROW, rel="b_roster")
        + ") a, ("
        + FP_SQL.format(name="rh_salarie", row=ROSTER_ROW, rel="b_roster_v2")
        + ") b"
    ),
)
def q_dataset_fingerprint(spark, sf_dir):
    """order-insensitive fingerprint of the HR file and change flag
    against the previous version (count and sums of row digests)."""
    from perkline.plans.fingerprint import changed, fingerprint

    t = T(spark, sf_dir)
    cur = fingerprint(t.roster().select(*FP_COLS), "rh_salarie")
    base = fingerprint(t.roster_v2().select(*FP_COLS), "rh_salarie")
    return changed(cur, base)


TREE_BUCKETS = 256
_BUCKET = f"CAST(CAST('0x' || substr(md5(coalesce(id_salarie_brut, '')), 1, 8) AS BIGINT) % {TREE_BUCKETS} AS INTEGER)"


def _tree_sql(rel: str, row: str) -> str:
    d = f"md5({row})"
    return (
        "SELECT bucket, n AS nb_lignes, md5(concat_ws('|', CAST(n AS VARCHAR), CAST(h AS VARCHAR), CAST(l AS VARCHAR))) AS empreinte FROM ("
        f"SELECT {_BUCKET} AS bucket, count(*) AS n, sum(CAST('0x' || substr({d}, 1, 16) AS HUGEINT)) AS h, "
        f"sum(CAST('0x' || substr({d}, 17, 16) AS HUGEINT)) AS l FROM {rel} GROUP BY 1)"
    )


@register(
    "fingerprint_buckets",
    twin(
        "SELECT bucket, coalesce(o.nb_lignes, 0) AS nb_avant, coalesce(n.nb_lignes, 0) AS nb_apres, "
        f"o.empreinte IS DISTINCT FROM n.empreinte AS modifie FROM ({_tree_sql('b_roster', ROSTER_ROW)}) o "
        f"FULL OUTER JOIN ({_tree_sql('b_roster_v2', ROSTER_ROW)}) n USING (bucket)"
    ),
)
def q_fingerprint_buckets(spark, sf_dir):
    """F5 in two levels: the buckets of the HR file whose digests differ from
    the previous version's."""
    from perkline.plans.fingerprint import digest_tree, tree_diff

    t = T(spark, sf_dir)
    old, new = (digest_tree(d.select(*FP_COLS), "id_salarie_brut", TREE_BUCKETS) for d in (t.roster(), t.roster_v2()))
    return tree_diff(old, new)


def _roster_sync_twin() -> str:
    from perkline.queries.mutations_q import UPSERT_RH_TWIN

    return UPSERT_RH_TWIN


@register("sync_changed_buckets", _roster_sync_twin())
def q_sync_changed_buckets(spark, sf_dir):
    """M2 by the digest tree: only buckets whose digests differ are joined
    with the file."""
    from perkline.plans.fingerprint import BucketedTable
    from perkline.queries.mutations_q import RH_CMP, RH_COLS

    t = T(spark, sf_dir)
    table = BucketedTable.create(t.roster().select(*RH_COLS), "id_salarie_brut", RH_CMP, "actif", TREE_BUCKETS)
    return table.sync(t.roster_v2())


MID_DAY = RUN.as_of.replace(month=1, day=15).isoformat()


@register(
    "notification_rerun",
    twin(
        f"SELECT id_activite, message, sha256(CAST(id_activite AS VARCHAR) || '|' || message) AS empreinte FROM ({MSG_SQL}) "
        f"WHERE id_activite NOT IN (SELECT id_activite FROM b_act_table WHERE date_debut < TIMESTAMP '{MID_DAY} 00:00:00')"
    ),
)
def q_notification_rerun(spark, sf_dir):
    """What a second run hands over after one that announced the
    activities before a day and failed before it could flag them."""
    t = T(spark, sf_dir)
    ledger = notify.Ledger(spark)
    box = notify.outbox(t.activity_source_v2(), t.activity_table(), t.link(), t.roster())
    early = t.activity_table().where(F.col("date_debut") < F.lit(f"{MID_DAY} 00:00:00").cast("timestamp_ntz"))
    first = materialise(ledger.unsent(box.join(early.select("id_activite"), "id_activite", "left_semi"), "run-1"), "outbox-1")
    ledger.hand_over(first, "run-1")
    return ledger.unsent(box, "run-2").drop("origine")


@register(
    "bootstrap_check",
    twin(
        "SELECT r.n AS nb_salaries, a.n AS nb_activites, r.n + a.n AS nb_total, (r.n = 0 AND a.n = 0) AS bootstrap_requis "
        "FROM (SELECT count(*) AS n FROM b_roster) r, (SELECT count(*) AS n FROM b_act_table) a"
    ),
)
def q_bootstrap_check(spark, sf_dir):
    """First-run detection — both base tables empty."""
    t = T(spark, sf_dir)
    n_act = t.activity_table().agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    return t.roster().agg(F.count(F.lit(1)).alias("nb_salaries")).select(
        "nb_salaries",
        n_act.alias("nb_activites"),
        (F.col("nb_salaries") + n_act).alias("nb_total"),
        ((F.col("nb_salaries") == 0) & (n_act == 0)).alias("bootstrap_requis"),
    )


CONSTRAINTS = [
    quality.Check("metier.activite", "pk id_activite", "duplicates", ("id_activite",)),
    *[quality.Check("metier.activite", f"not null {c}", "missing", (c,)) for c in
      ("id_activite", "cle_salarie", "date_debut", "duree_sec", "type_activite", "source_donnee", "date_ingestion", "flag_slack")],
    quality.Check("metier.activite", "ck distance >= 0", "failed_rows", predicate="distance_m < 0"),
    quality.Check("metier.activite", "ck duree >= 0", "failed_rows", predicate="duree_sec < 0"),
    quality.Check("metier.activite", "uq cle_salarie, date_debut, source_donnee", "duplicates", ("cle_salarie", "date_debut", "source_donnee")),
    quality.Check("metier.activite", "fk cle_salarie", "reference", ("cle_salarie",), parent="metier.salarie", parent_col="cle_salarie"),
    quality.Check("metier.ctrl_trajet", "pk id_ctrl", "duplicates", ("id_ctrl",)),
    *[quality.Check("metier.ctrl_trajet", f"not null {c}", "missing", (c,)) for c in
      ("id_ctrl", "cle_salarie", "mode_trajet", "distance_m", "duree_sec", "est_incoherent", "date_ctrl")],
    quality.Check("metier.ctrl_trajet", "ck distance >= 0", "failed_rows", predicate="distance_m < 0"),
    quality.Check("metier.ctrl_trajet", "ck duree >= 0", "failed_rows", predicate="duree_sec < 0"),
    quality.Check("metier.ctrl_trajet", "fk cle_salarie", "reference", ("cle_salarie",), parent="metier.salarie", parent_col="cle_salarie"),
    quality.Check("metier.salarie", "pk cle_salarie", "duplicates", ("cle_salarie",)),
    quality.Check("metier.salarie", "fk cle_salarie", "reference", ("cle_salarie",), parent="sec.lien_salarie", parent_col="cle_salarie"),
    quality.Check("sec.lien_salarie", "pk id_salarie_brut", "duplicates", ("id_salarie_brut",)),
    quality.Check("sec.lien_salarie", "uq cle_salarie", "duplicates", ("cle_salarie",)),
    quality.Check("sec.lien_salarie", "fk id_salarie_brut", "reference", ("id_salarie_brut",), parent="sec.rh_salarie",
                  parent_col="id_salarie_brut"),
    quality.Check("sec.rh_salarie", "pk id_salarie_brut", "duplicates", ("id_salarie_brut",)),
    *[quality.Check("sec.rh_salarie", f"not null {c}", "missing", (c,)) for c in ("id_salarie_brut", "nom", "prenom", "actif")],
    quality.Check("metier.param", "pk code_param, date_effet", "duplicates", ("code_param", "date_effet")),
    *[quality.Check("metier.param", f"not null {c}", "missing", (c,)) for c in ("code_param", "valeur_param")],
]
CONSTRAINT_SOURCES = {
    "metier.activite": "b_act_table",
    "metier.ctrl_trajet": "b_ctrl",
    "metier.salarie": "x_emp_v1",
    "sec.lien_salarie": "b_link",
    "sec.rh_salarie": "b_roster",
    "metier.param": "b_params",
}


@register("dq_constraints", vt(quality.twin_results(CONSTRAINTS, CONSTRAINT_SOURCES)))
def q_dq_constraints(spark, sf_dir):
    """Q26: the table constraints (PK, UNIQUE, NOT NULL, CHECK, FK) as checks."""
    t = T(spark, sf_dir)
    emp = t.link().join(t.roster().select("id_salarie_brut", "nom", "prenom", "bu", "mod_depl_decl"), "id_salarie_brut").drop(
        "id_salarie_brut"
    )
    tables = {
        "metier.activite": t.activity_table(),
        "metier.ctrl_trajet": t.commute_checks(),
        "metier.salarie": emp,
        "sec.lien_salarie": t.link(),
        "sec.rh_salarie": t.roster(),
        "metier.param": t.params(),
    }
    return quality.evaluate(tables, CONSTRAINTS)

