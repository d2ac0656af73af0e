"""Ingest and dedup queries (K1, J6, S8, S9, W4-W8, M13/M14) with twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from perkline.config import DEFAULT_RUN, NON_ENDURANCE_SPORTS
from perkline.operators.dedup import keep_one_per_group
from perkline.plans import ingest
from perkline.queries import register
from perkline.queries.functions_q import DURATION_SQL, LOCAL_NOON_SQL, distance_sql, quote_sql
from perkline.sources.tables import Tables
from perkline.twins import twin
from perkline.twins import exprs as X

RUN = DEFAULT_RUN
DCOLS = ingest.DECLARED_COLUMNS


def T(spark, sf_dir) -> Tables:
    return Tables.of(spark, sf_dir, RUN)


def _norm(spark, sf_dir) -> ingest.NormalisedDeclared:
    t = T(spark, sf_dir)
    return ingest.normalised(t, RUN)


# ---------------------------------------------------------------------------
# Twin CTEs of the declared-row normalisation
# ---------------------------------------------------------------------------
NE = ", ".join(X.q(s) for s in NON_ENDURANCE_SPORTS)
C = [
    (
        "x_prep",
        "SELECT ligne, "
        + ", ".join(f"{X.strip_quotes(c)} AS {c}" for c in DCOLS)
        + ", coalesce(commentaire, '') AS commentaire_brut FROM b_declared",
    ),
    (
        "x_prep2",
        f"SELECT *, {X.normalise_text('nom')} AS nom_norm, {X.normalise_text('prenom')} AS prenom_norm, "
        f"{LOCAL_NOON_SQL.format(x=X.strip_quotes('date_txt'))} AS date_parsed, "
        f"{DURATION_SQL.format(x=X.strip_quotes('duree_txt'))} AS duree_sec, {distance_sql('distance_txt')} AS distance_m, "
        f"{quote_sql('commentaire_brut')} AS commentaire_out FROM x_prep",
    ),
    (
        "x_names",
        "SELECT id_salarie_brut, nom, prenom, nom_norm, prenom_norm, count(*) OVER (PARTITION BY nom_norm, prenom_norm) > 1 AS ambigu "
        f"FROM (SELECT trim(id_salarie_brut) AS id_salarie_brut, nom, prenom, {X.normalise_text('nom')} AS nom_norm, "
        f"{X.normalise_text('prenom')} AS prenom_norm FROM b_name_ref)",
    ),
    (
        "x_sports",
        "SELECT id_salarie_brut, sport_declare, ligne FROM (SELECT trim(id_salarie_brut) AS id_salarie_brut, trim(sport_declare) AS sport_declare, "
        "ligne, row_number() OVER (PARTITION BY trim(id_salarie_brut) ORDER BY ligne) AS rn FROM b_sport_ref) WHERE rn = 1",
    ),
    (
        "x_match",
        "SELECT p.*, n.id_salarie_brut, n.ambigu, n.nom_norm IS NOT NULL AS rh_trouve FROM x_prep2 p "
        "LEFT JOIN x_names n ON n.nom_norm = p.nom_norm AND n.prenom_norm = p.prenom_norm",
    ),
    (
        "x_class",
        "SELECT m.*, s.sport_declare, CASE WHEN NOT m.rh_trouve THEN 'nom_prenom_inconnu' WHEN m.ambigu THEN 'nom_prenom_ambigu' "
        "WHEN m.sport = '' THEN 'sport_manquant' WHEN m.date_parsed IS NULL OR m.duree_sec IS NULL "
        "OR (m.distance_txt <> '' AND m.distance_m IS NULL) THEN 'parsing_invalide' END AS err_raison "
        "FROM x_match m LEFT JOIN x_sports s ON s.id_salarie_brut = m.id_salarie_brut",
    ),
    (
        "x_valid",
        f"SELECT * REPLACE (CASE WHEN sport IN ({NE}) THEN NULL ELSE distance_m END AS distance_m), "
        f"CASE WHEN {X.normalise_text('coalesce(sport_declare, ' + chr(39) * 2 + ')')} = '' THEN 'sport_non_declare' "
        f"WHEN {X.normalise_text('coalesce(sport_declare, ' + chr(39) * 2 + ')')} <> {X.normalise_text('sport')} THEN 'sport_different' END AS ano_raison, "
        f"{X.pseudonym('id_salarie_brut')} AS cle_salarie, "
        f"concat_ws('|', nom_norm, prenom_norm, date_txt, {X.normalise_text('sport')}, duree_txt, distance_txt) AS key_dedup "
        "FROM x_class WHERE err_raison IS NULL",
    ),
    (
        "x_near",
        "SELECT *, row_number() OVER (PARTITION BY key_dedup ORDER BY horodateur DESC, ligne DESC) AS rn1 FROM x_valid",
    ),
    (
        "x_day",
        f"SELECT *, row_number() OVER (PARTITION BY cle_salarie, {X.local_day('date_parsed')} ORDER BY date_parsed DESC, "
        "key_dedup DESC, ligne DESC) AS rn2 FROM x_near WHERE rn1 = 1",
    ),
]


def it(body: str) -> str:
    import re

    lookup = dict(C)
    want, stack = set(), re.findall(r"\bx_[a-z0-9_]+\b", body)
    while stack:
        n = stack.pop()
        if n in lookup and n not in want:
            want.add(n)
            stack.extend(re.findall(r"\bx_[a-z0-9_]+\b", lookup[n]))
    return twin(body, [c for c in C if c[0] in want])


DC = ", ".join(DCOLS)


@register(
    "normalise_declared",
    it(
        "SELECT cle_salarie, date_parsed AS date_debut, duree_sec, distance_m, sport AS type_activite, commentaire_out AS commentaire, "
        "'csv_gsheet' AS source_donnee, ligne FROM x_day WHERE rn2 = 1"
    ),
)
def q_normalise_declared(spark, sf_dir):
    """K1 clean output."""
    return _norm(spark, sf_dir).clean


@register("normalise_errors", it(f"SELECT {DC}, err_raison AS raison, ligne FROM x_class WHERE err_raison IS NOT NULL"))
def q_normalise_errors(spark, sf_dir):
    """Blocking errors with their reason."""
    return _norm(spark, sf_dir).errors


@register(
    "normalise_anomalies",
    it(
        f"SELECT ano_raison AS raison, {DC}, ligne FROM x_valid WHERE ano_raison IS NOT NULL "
        f"UNION ALL SELECT 'doublon_quasi_identique_ecarte', {DC}, ligne FROM x_near WHERE rn1 > 1 "
        f"UNION ALL SELECT 'plusieurs_activites_jour', {DC}, ligne FROM x_day WHERE rn2 > 1"
    ),
)
def q_normalise_anomalies(spark, sf_dir):
    """Anomalies (sport, near duplicates, several per day)."""
    return ingest.normalised(T(spark, sf_dir), RUN, staged=True).anomalies


@register(
    "error_sample",
    it(
        f"SELECT raison, ligne, {DC} FROM (SELECT *, row_number() OVER (PARTITION BY raison ORDER BY ligne) AS rn FROM "
        "(SELECT DISTINCT err_raison AS raison, * FROM x_class WHERE err_raison IS NOT NULL)) WHERE rn <= 15"
    ),
)
def q_error_sample(spark, sf_dir):
    """L3: the first 15 offending rows of each reason."""
    from pyspark.sql import Window

    first = Window.partitionBy("raison").orderBy("ligne")
    errors = _norm(spark, sf_dir).errors
    return errors.withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= 15).select("raison", "ligne", *DCOLS)


@register(
    "gate_per_minute",
    it(
        "SELECT cle_salarie, date_parsed AS date_debut, sport AS type_activite, ligne FROM x_day WHERE rn2 = 1 AND substr(horodateur, 1, 16) "
        "NOT IN (SELECT substr(horodateur, 1, 16) FROM x_class WHERE err_raison IS NOT NULL AND horodateur IS NOT NULL)"
    ),
)
def q_gate_per_minute(spark, sf_dir):
    """M15 per minute of submission: a minute with any blocking error gives no
    output at all."""
    n = _norm(spark, sf_dir)
    minute = F.substring("horodateur", 1, 16)
    bad = n.errors.select(minute.alias("_minute")).distinct()
    lines = n.classified.select(F.col("ligne").alias("_ligne"), minute.alias("_minute")).where("_minute IS NOT NULL").distinct()
    good = lines.join(bad, "_minute", "left_anti")
    return n.clean.join(good, F.col("ligne") == F.col("_ligne"), "left_semi").select("cle_salarie", "date_debut", "type_activite", "ligne")


@register(
    "match_employee_by_name",
    it("SELECT ligne, nom_norm, prenom_norm, id_salarie_brut, ambigu, rh_trouve FROM x_match"),
)
def q_match_employee_by_name(spark, sf_dir):
    t = T(spark, sf_dir)
    prepared = ingest.prepare_declared(t.declared(), RUN.zone)
    m = ingest.match_by_name(prepared, ingest.name_reference(t.name_reference()))
    return m.select("ligne", "nom_norm", "prenom_norm", "id_salarie_brut", "ambigu", "rh_trouve")


@register("name_reference_ambiguity", it("SELECT * FROM x_names"))
def q_name_reference_ambiguity(spark, sf_dir):
    return ingest.name_reference(T(spark, sf_dir).name_reference())


@register("sport_reference_first", it("SELECT * FROM x_sports"))
def q_sport_reference_first(spark, sf_dir):
    return ingest.sport_reference(T(spark, sf_dir).sport_reference())


@register(
    "dedup_near_identical",
    it(f"SELECT ligne, {DC}, key_dedup AS cle_quasi_doublon, rn1 = 1 AS conserve FROM x_near"),
)
def q_dedup_near_identical(spark, sf_dir):
    """W6 on valid declared rows: every row with its key and kept flag."""
    from perkline.operators.dedup import split_one_per_group

    t = T(spark, sf_dir)
    c = ingest.classify_declared(t.declared(), t.name_reference(), t.sport_reference(), RUN)
    valid = c.filter(F.col("err_raison").isNull()).withColumn("cle_quasi_doublon", ingest.near_duplicate_key())
    kept, dropped = split_one_per_group(valid, ["cle_quasi_doublon"], [("horodateur", "desc"), ("ligne", "desc")], "ligne")
    cols = ["ligne", *DCOLS, "cle_quasi_doublon"]
    return kept.select(*cols, F.lit(True).alias("conserve")).unionByName(dropped.select(*cols, F.lit(False).alias("conserve")))


ACT_COLS = "id_activite, cle_salarie, date_debut, jour, duree_sec, type_activite, distance_m, commentaire, source_donnee"


def _day_rank(order: str) -> str:
    return (
        f"SELECT {ACT_COLS}, row_number() OVER (PARTITION BY cle_salarie, {X.local_day('date_debut')} ORDER BY {order}) AS rn "
        "FROM b_activity"
    )


@register("dedup_daily_latest", twin(f"SELECT {ACT_COLS} FROM ({_day_rank('date_debut DESC, id_activite DESC')}) WHERE rn = 1"))
def q_dedup_daily_latest(spark, sf_dir):
    """W4 keep="latest" on the activity table."""
    kept, _ = ingest.dedup_daily(T(spark, sf_dir).activities(), keep="latest", zone=RUN.zone)
    return kept


@register(
    "dedup_daily_rejected",
    twin(f"SELECT 'plusieurs_activites_jour' AS raison, {ACT_COLS} FROM ({_day_rank('date_debut DESC, id_activite DESC')}) WHERE rn > 1"),
)
def q_dedup_daily_rejected(spark, sf_dir):
    """W4 rejected rows, reason first."""
    _, rejected = ingest.dedup_daily(T(spark, sf_dir).activities(), keep="latest", zone=RUN.zone)
    return rejected


@register("dedup_daily_first", twin(f"SELECT {ACT_COLS} FROM ({_day_rank('id_activite')}) WHERE rn = 1"))
def q_dedup_daily_first(spark, sf_dir):
    """W5 keep="first" (input order = id)."""
    kept, _ = ingest.dedup_daily(T(spark, sf_dir).activities(), keep="first", zone=RUN.zone)
    return kept


@register(
    "daily_conflicts",
    twin(
        f"SELECT * FROM (SELECT {ACT_COLS}, {X.local_day('date_debut')} AS jour_local, "
        f"count(*) OVER (PARTITION BY cle_salarie, {X.local_day('date_debut')}) AS nb_activites_jour FROM b_activity) "
        "WHERE nb_activites_jour > 1"
    ),
)
def q_daily_conflicts(spark, sf_dir):
    """All members of (employee, local day) groups of size > 1."""
    return ingest.daily_conflicts(T(spark, sf_dir).activities(), RUN.zone)


@register(
    "roster_keep_last",
    twin(
        "SELECT id_salarie_brut, nom, prenom, bu, mod_depl_decl, ligne FROM (SELECT *, row_number() OVER "
        "(PARTITION BY id_salarie_brut ORDER BY ligne DESC) AS rn FROM (SELECT id_salarie_brut, nom, prenom, bu, mod_depl_decl, "
        "CAST(id_salarie_brut AS BIGINT) AS ligne FROM b_roster UNION ALL SELECT id_salarie_brut, nom, prenom, bu || '_maj', "
        "mod_depl_decl, CAST(id_salarie_brut AS BIGINT) + 100000000 FROM b_roster WHERE CAST(id_salarie_brut AS BIGINT) % 7 = 0)) "
        "WHERE rn = 1"
    ),
)
def q_roster_keep_last(spark, sf_dir):
    """Last row per id in input order (roster file + later corrections)."""
    r = T(spark, sf_dir).roster()
    base = r.select("id_salarie_brut", "nom", "prenom", "bu", "mod_depl_decl", F.col("id_salarie_brut").cast("long").alias("ligne"))
    fixes = r.filter(F.col("id_salarie_brut").cast("long") % 7 == 0).select(
        "id_salarie_brut",
        "nom",
        "prenom",
        F.concat("bu", F.lit("_maj")).alias("bu"),
        "mod_depl_decl",
        (F.col("id_salarie_brut").cast("long") + 100000000).alias("ligne"),
    )
    return keep_one_per_group(base.unionByName(fixes), ["id_salarie_brut"], order=[("ligne", "desc")])
