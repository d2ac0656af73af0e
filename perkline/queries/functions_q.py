"""Scalar-function queries: each function applied to a column of the bound
tables (so the work grows with the data), with DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from perkline.config import DEFAULT_RUN, SPORTS, TRAVEL_MODES
from perkline.functions import dates, display, parse, text
from perkline.operators import labels
from perkline.plans.bi import enrich_activities
from perkline.queries import register
from perkline.sources.tables import Tables
from perkline.twins import twin
from perkline.twins import exprs as X

AS_OF = f"DATE '{DEFAULT_RUN.as_of.isoformat()}'"


def T(spark, sf_dir) -> Tables:
    return Tables.of(spark, sf_dir, DEFAULT_RUN)


@register(
    "normalise_text",
    twin(f"SELECT ligne, {X.normalise_text('nom')} AS nom_norm, {X.normalise_text('prenom')} AS prenom_norm FROM b_declared"),
)
def q_normalise_text(spark, sf_dir):
    """normalised names of every declared row."""
    d = T(spark, sf_dir).declared()
    return d.select("ligne", text.normalise_text("nom").alias("nom_norm"), text.normalise_text("prenom").alias("prenom_norm"))


@register("fold_label", twin(f"SELECT id_activite, {X.fold('type_activite')} AS type_activite_plie FROM b_activity"))
def q_fold_label(spark, sf_dir):
    """folded activity labels."""
    a = T(spark, sf_dir).activities()
    return a.select("id_activite", text.fold_label("type_activite").alias("type_activite_plie"))


@register("pseudonym", twin(f"SELECT id_salarie_brut, {X.pseudonym('id_salarie_brut')} AS cle_salarie FROM b_roster"))
def q_pseudonym(spark, sf_dir):
    """pseudonym of every HR id."""
    r = T(spark, sf_dir).roster()
    return r.select("id_salarie_brut", text.pseudonym("id_salarie_brut", DEFAULT_RUN.salt).alias("cle_salarie"))


@register(
    "dedup_digest",
    twin(
        "SELECT id_activite, md5(concat_ws('|', cle_salarie, strftime(date_debut, '%Y-%m-%d %H:%M:%S.%f'), t, "
        "CAST(duree_sec AS VARCHAR), CAST(coalesce(distance_m, -1) AS VARCHAR), coalesce(trim(source_donnee), ''))) AS cle_dedup_activite "
        f"FROM (SELECT *, {X.canonical('type_activite', SPORTS, 't', 't_unknown')} FROM b_activity)"
    ),
)
def q_dedup_digest(spark, sf_dir):
    """duplicate digest of every activity."""
    a = enrich_activities(T(spark, sf_dir).activities(), DEFAULT_RUN.zone)
    return a.select("id_activite", "cle_dedup_activite")


@register(
    "local_day",
    twin(f"SELECT id_activite, date_debut, {X.local_day('date_debut')} AS date_activite FROM b_activity"),
)
def q_local_day(spark, sf_dir):
    """Paris local day of every activity instant."""
    a = T(spark, sf_dir).activities()
    return a.select("id_activite", "date_debut", dates.local_day("date_debut", DEFAULT_RUN.zone).alias("date_activite"))


@register(
    "unit_conversions",
    twin(f"SELECT id_activite, {X.minutes('duree_sec')} AS duree_min, {X.km('distance_m')} AS distance_km FROM b_activity"),
)
def q_unit_conversions(spark, sf_dir):
    """Minutes and kilometres of every activity."""
    a = T(spark, sf_dir).activities()
    return a.select("id_activite", labels.to_minutes("duree_sec").alias("duree_min"), labels.to_km("distance_m").alias("distance_km"))


@register(
    "canonical_activity_type",
    twin(f"SELECT id_activite, {X.canonical('type_activite', SPORTS, 'type_activite_normalise', 'type_activite_inconnu')} FROM b_activity"),
)
def q_canonical_activity_type(spark, sf_dir):
    """Canonical activity type and unknown flag."""
    a = T(spark, sf_dir).activities()
    lab, unk = labels.canonical_label("type_activite", SPORTS)
    return a.select("id_activite", lab.alias("type_activite_normalise"), unk.alias("type_activite_inconnu"))


@register(
    "canonical_mode",
    twin(
        f"SELECT id_salarie_brut, {X.canonical('mod_depl_decl', TRAVEL_MODES, 'mod_depl_decl_normalise', 'mod_depl_decl_inconnu')} "
        "FROM b_roster UNION ALL "
        f"SELECT 'ctrl' || CAST(id_ctrl AS VARCHAR), {X.canonical('mode_trajet', TRAVEL_MODES, 'a', 'b')} FROM b_commute_raw"
    ),
)
def q_canonical_mode(spark, sf_dir):
    """P1 on both mode columns: declared (roster) and checked (commute)."""
    t = T(spark, sf_dir)
    lab, unk = labels.canonical_label("mod_depl_decl", TRAVEL_MODES)
    a = t.roster().select("id_salarie_brut", lab.alias("mod_depl_decl_normalise"), unk.alias("mod_depl_decl_inconnu"))
    lab2, unk2 = labels.canonical_label("mode_trajet", TRAVEL_MODES)
    b = t.commute_raw().select(
        F.concat(F.lit("ctrl"), F.col("id_ctrl").cast("string")).alias("id_salarie_brut"),
        lab2.alias("mod_depl_decl_normalise"),
        unk2.alias("mod_depl_decl_inconnu"),
    )
    return a.unionByName(b)


@register(
    "activity_category",
    twin(
        f"SELECT id_activite, {X.category('type_activite_normalise', 'type_activite_inconnu')} FROM "
        f"(SELECT *, {X.canonical('type_activite', SPORTS, 'type_activite_normalise', 'type_activite_inconnu')} FROM b_activity)"
    ),
)
def q_activity_category(spark, sf_dir):
    """Category and category-unknown flag of every activity."""
    a = enrich_activities(T(spark, sf_dir).activities(), DEFAULT_RUN.zone)
    return a.select("id_activite", "categorie_activite_normalise", "categorie_activite_inconnu")


@register(
    "travel_mode",
    twin(
        "SELECT id_salarie_brut, mod_depl_decl, CASE trim(mod_depl_decl) WHEN 'Marche/running' THEN 'walking' "
        "WHEN 'Vélo/Trottinette/Autres' THEN 'bicycling' WHEN 'Transports en commun' THEN 'transit' "
        "WHEN 'véhicule thermique/électrique' THEN 'driving' ELSE 'driving' END AS mode_routage FROM b_roster"
    ),
)
def q_travel_mode(spark, sf_dir):
    """Routing mode of every declared travel mode."""
    r = T(spark, sf_dir).roster()
    return r.select("id_salarie_brut", "mod_depl_decl", labels.travel_mode("mod_depl_decl").alias("mode_routage"))


PROFILE_SQL = (
    "CASE WHEN coalesce(length(trim(sport_declare)) > 0, false) AND coalesce(mod_depl_decl IN ('Marche/running', 'Vélo/Trottinette/Autres'), false) THEN 'eleve' "
    "WHEN coalesce(length(trim(sport_declare)) > 0, false) OR coalesce(mod_depl_decl IN ('Marche/running', 'Vélo/Trottinette/Autres'), false) THEN 'moyen' "
    "ELSE 'faible' END"
)


@register("volume_profile", twin(f"SELECT id_salarie_brut, {PROFILE_SQL} AS profil_volume FROM b_roster"))
def q_volume_profile(spark, sf_dir):
    """Activity-volume profile of every employee."""
    r = T(spark, sf_dir).roster()
    return r.select("id_salarie_brut", labels.volume_profile("sport_declare", "mod_depl_decl").alias("profil_volume"))


@register(
    "volume_profile_counts",
    twin(f"SELECT {PROFILE_SQL} AS profil_volume, count(*) AS nb_salaries FROM b_roster GROUP BY 1"),
)
def q_volume_profile_counts(spark, sf_dir):
    """Employees per volume profile (reporting histogram)."""
    r = T(spark, sf_dir).roster()
    return (
        r.select(labels.volume_profile("sport_declare", "mod_depl_decl").alias("profil_volume"))
        .groupBy("profil_volume")
        .agg(F.count(F.lit(1)).alias("nb_salaries"))
    )


LOCAL_NOON_SQL = (
    "((try_strptime({x}, '%d/%m/%Y') + INTERVAL 12 HOUR) AT TIME ZONE 'Europe/Paris') AT TIME ZONE 'UTC'"
)


@register(
    "parse_local_noon",
    twin(f"SELECT ligne, date_txt, {LOCAL_NOON_SQL.format(x=X.strip_quotes('date_txt'))} AS date_debut FROM b_declared"),
)
def q_parse_local_noon(spark, sf_dir):
    """local-noon instant of every declared date."""
    d = T(spark, sf_dir).declared()
    return d.select("ligne", "date_txt", parse.parse_local_noon("date_txt", DEFAULT_RUN.zone).alias("date_debut"))


DUR_RE = r"^(\d+):(\d+):(\d+)$"
DURATION_SQL = (
    "CASE WHEN regexp_matches({x}, '" + DUR_RE + "') THEN TRY_CAST(TRY_CAST(regexp_extract({x}, '" + DUR_RE + "', 1) AS HUGEINT) * 3600 "
    "+ TRY_CAST(regexp_extract({x}, '" + DUR_RE + "', 2) AS HUGEINT) * 60 + TRY_CAST(regexp_extract({x}, '" + DUR_RE + "', 3) AS HUGEINT) AS INTEGER) END"
)


@register(
    "parse_duration",
    twin(f"SELECT ligne, duree_txt, {DURATION_SQL.format(x=X.strip_quotes('duree_txt'))} AS duree_sec FROM b_declared"),
)
def q_parse_duration(spark, sf_dir):
    """seconds of every declared duration."""
    d = T(spark, sf_dir).declared()
    return d.select("ligne", "duree_txt", parse.parse_duration("duree_txt").alias("duree_sec"))


def distance_sql(x: str) -> str:
    t = f"replace({X.strip_quotes(x)}, ',', '.')"
    v = f"(CASE WHEN length({t}) > 0 THEN TRY_CAST({t} AS DOUBLE) END)"
    return f"CASE WHEN {v} >= 0 AND {v} * 1000 < 2147483647.0 THEN CAST(round_even({v} * 1000, 0) AS INTEGER) END"


@register("parse_distance", twin(f"SELECT ligne, distance_txt, {distance_sql('distance_txt')} AS distance_m FROM b_declared"))
def q_parse_distance(spark, sf_dir):
    """F8: metres of every declared distance."""
    d = T(spark, sf_dir).declared()
    return d.select("ligne", "distance_txt", parse.parse_distance("distance_txt").alias("distance_m"))


def quote_sql(x: str) -> str:
    inner = f"regexp_replace({X.strip_quotes(x)}, '^{X.WS}|{X.WS}$', '', 'g')"
    return f"CASE WHEN length({inner}) > 0 THEN '\"' || {inner} || '\"' ELSE '' END"


@register("quote_comment", twin(f"SELECT ligne, commentaire, {quote_sql('commentaire')} AS commentaire_out FROM b_declared"))
def q_quote_comment(spark, sf_dir):
    """quoted comment of every declared row."""
    d = T(spark, sf_dir).declared()
    return d.select("ligne", "commentaire", text.quote_comment("commentaire").alias("commentaire_out"))


INT_LIKE_INPUT_SQL = (
    "CASE WHEN id_activite % 3 = 0 THEN CAST(duree_sec AS VARCHAR) || '.0' WHEN id_activite % 3 = 1 THEN CAST(duree_sec AS VARCHAR) || ',7' "
    "ELSE ' ' || CAST(duree_sec AS VARCHAR) || ' ' END"
)


@register(
    "parse_int_like",
    twin(
        "SELECT id_activite, txt, CASE WHEN length(t) > 0 AND TRY_CAST(t AS DOUBLE) IS NOT NULL AND NOT isnan(TRY_CAST(t AS DOUBLE)) "
        "AND abs(TRY_CAST(t AS DOUBLE)) < 9.0e18 THEN CAST(trunc(TRY_CAST(t AS DOUBLE)) AS BIGINT) END AS valeur "
        f"FROM (SELECT id_activite, txt, replace(trim(txt), ',', '.') AS t FROM (SELECT id_activite, {INT_LIKE_INPUT_SQL} AS txt FROM b_activity))"
    ),
)
def q_parse_int_like(spark, sf_dir):
    """F11 over integer-like renderings of the activity durations."""
    a = T(spark, sf_dir).activities()
    ident, sec = F.col("id_activite"), F.col("duree_sec").cast("string")
    txt = (
        F.when(ident % 3 == 0, F.concat(sec, F.lit(".0")))
        .when(ident % 3 == 1, F.concat(sec, F.lit(",7")))
        .otherwise(F.concat(F.lit(" "), sec, F.lit(" ")))
    )
    return a.select("id_activite", txt.alias("txt")).select("id_activite", "txt", parse.parse_int_like("txt").alias("valeur"))


@register(
    "parse_iso_instant",
    twin(
        "SELECT id_activite, txt, CAST(txt AS TIMESTAMPTZ) AT TIME ZONE 'UTC' AS date_debut FROM (SELECT id_activite, "
        "CASE WHEN id_activite % 2 = 0 THEN strftime(timezone('Europe/Paris', timezone('UTC', date_debut)), '%Y-%m-%dT%H:%M:%S') || "
        "CASE WHEN date_debut >= TIMESTAMP '2024-03-31 01:00:00' AND date_debut < TIMESTAMP '2024-10-27 01:00:00' THEN '+02:00' ELSE '+01:00' END "
        "ELSE strftime(date_debut, '%Y-%m-%dT%H:%M:%S') || 'Z' END AS txt FROM b_activity)"
    ),
)
def q_parse_iso_instant(spark, sf_dir):
    """F12 over ISO renderings of the activity instants (Paris offset or Z)."""
    a = T(spark, sf_dir).activities()
    paris = F.convert_timezone(F.lit("UTC"), F.lit(DEFAULT_RUN.zone), F.col("date_debut"))
    txt = F.when(
        F.col("id_activite") % 2 == 0,
        F.concat(
            F.date_format(paris, "yyyy-MM-dd'T'HH:mm:ss"),
            F.when(
                (F.col("date_debut") >= F.lit("2024-03-31 01:00:00").cast("timestamp_ntz"))
                & (F.col("date_debut") < F.lit("2024-10-27 01:00:00").cast("timestamp_ntz")),
                F.lit("+02:00"),
            ).otherwise(F.lit("+01:00")),
        ),
    ).otherwise(F.concat(F.date_format("date_debut", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")))
    return a.select("id_activite", txt.alias("txt")).select("id_activite", "txt", parse.parse_iso_instant("txt").alias("date_debut"))


@register(
    "rolling_period",
    twin(
        "SELECT jour, CAST(date_trunc('month', jour) - INTERVAL 12 MONTH AS DATE) AS periode_debut, "
        "CAST(date_trunc('month', jour) - INTERVAL 1 DAY AS DATE) AS periode_fin FROM (SELECT DISTINCT jour FROM b_activity)"
    ),
)
def q_rolling_period(spark, sf_dir):
    """F14 with every activity day as the as-of date."""
    days = T(spark, sf_dir).activities().select("jour").distinct()
    start, end = dates.rolling_period("jour", DEFAULT_RUN.window_months, False)
    return days.select("jour", start.alias("periode_debut"), end.alias("periode_fin"))


@register(
    "last_n_months",
    twin(
        "SELECT jour, i AS rang, strftime(date_trunc('month', jour) - to_months(CAST(13 - i AS INTEGER)), '%Y-%m') AS mois "
        "FROM (SELECT DISTINCT jour FROM b_activity) d, range(1, 13) r(i)"
    ),
)
def q_last_n_months(spark, sf_dir):
    """F15 (complete months, oldest first) for every activity day."""
    days = T(spark, sf_dir).activities().select("jour").distinct()
    months = dates.last_n_months("jour", 12, False)
    return days.select("jour", F.posexplode(months).alias("rang", "mois")).select(
        "jour", (F.col("rang") + 1).cast("bigint").alias("rang"), "mois"
    )


@register(
    "rolling_period_current",
    twin(
        "SELECT jour, CAST(date_trunc('month', jour) - INTERVAL 11 MONTH AS DATE) AS periode_debut, jour AS periode_fin "
        "FROM (SELECT DISTINCT jour FROM b_activity)"
    ),
)
def q_rolling_period_current(spark, sf_dir):
    """F14 with the current month, up to the as-of day."""
    days = T(spark, sf_dir).activities().select("jour").distinct()
    start, end = dates.rolling_period("jour", DEFAULT_RUN.window_months, True)
    return days.select("jour", start.alias("periode_debut"), end.alias("periode_fin"))


@register(
    "last_n_months_current",
    twin(
        "SELECT jour, i AS rang, strftime(date_trunc('month', jour) - to_months(CAST(12 - i AS INTEGER)), '%Y-%m') AS mois "
        "FROM (SELECT DISTINCT jour FROM b_activity) d, range(1, 13) r(i)"
    ),
)
def q_last_n_months_current(spark, sf_dir):
    """F15 with the current month, oldest first."""
    days = T(spark, sf_dir).activities().select("jour").distinct()
    months = dates.last_n_months("jour", 12, True)
    return days.select("jour", F.posexplode(months).alias("rang", "mois")).select(
        "jour", (F.col("rang") + 1).cast("bigint").alias("rang"), "mois"
    )


AGE_SQL = f"CASE WHEN date_naissance IS NULL THEN NULL ELSE CAST(date_part('year', age({AS_OF}, date_naissance)) AS INTEGER) END"


@register("age_years", twin(f"SELECT id_salarie_brut, date_naissance, {AGE_SQL} AS age_annees FROM b_roster"))
def q_age_years(spark, sf_dir):
    """F16: completed years of age at the as-of date."""
    r = T(spark, sf_dir).roster()
    return r.select(
        "id_salarie_brut", "date_naissance", dates.age_years("date_naissance", F.lit(DEFAULT_RUN.as_of)).alias("age_annees")
    )


@register(
    "age_band",
    twin(
        f"SELECT id_salarie_brut, {X.age_band('date_naissance', AS_OF)} AS tranche_age FROM b_roster"
    ),
)
def q_age_band(spark, sf_dir):
    """Age band at the as-of date."""
    r = T(spark, sf_dir).roster()
    return r.select("id_salarie_brut", dates.age_band(dates.age_years("date_naissance", F.lit(DEFAULT_RUN.as_of))).alias("tranche_age"))


def km_text_sql(d: str) -> str:
    # one decimal of the binary quotient, as C's printf rounds it
    return f"CASE WHEN {d} IS NULL THEN 'distance inconnue' ELSE printf('%.1f', CAST({d} AS DOUBLE) / 1000) || ' km' END"


def minutes_text_sql(s: str) -> str:
    q = f"({s} // 60)"
    r = f"({s} % 60)"
    mins = f"(CASE WHEN {r} > 30 THEN {q} + 1 WHEN {r} < 30 THEN {q} ELSE {q} + ({q} % 2) END)"
    return f"CASE WHEN {s} IS NULL OR {s} <= 0 THEN 'durée inconnue' ELSE CAST({mins} AS VARCHAR) || ' min' END"


@register(
    "display_text",
    twin(f"SELECT id_activite, {km_text_sql('distance_m')} AS distance_txt, {minutes_text_sql('duree_sec')} AS duree_txt FROM b_activity"),
)
def q_display_text(spark, sf_dir):
    """distance and duration display texts."""
    a = T(spark, sf_dir).activities()
    return a.select(
        "id_activite", display.display_km("distance_m").alias("distance_txt"), display.display_minutes("duree_sec").alias("duree_txt")
    )
