"""Data-quality queries (Q1-Q27) with twins generated from the same specs."""

from __future__ import annotations

from pyspark.sql import functions as F

from perkline.config import DEFAULT_RUN, REQUIRED_PARAM_CODES
from perkline.operators import quality
from perkline.plans import checks as S
from perkline.plans.model import BenefitModel
from perkline.queries import register
from perkline.queries.views_q import VIEW_CTES, vt
from perkline.twins import exprs as X

RUN = DEFAULT_RUN
TABLE_SUITE = S.table_suite(RUN)
SIM_SUITE = S.simulation_suite(RUN)

# twin relation of each checked table
SOURCES = {
    S.ACT: "b_act_table",
    S.SAL: "x_emp_v1",
    S.V_ACT: "x_bi_act",
    S.V_SAL: "x_bi_emp",
    S.V_CTRL: "x_bi_ctrl",
    S.V_PARAM: "b_eff_params",
    S.E_PRIME: "x_bonus",
    S.E_BE: "x_well",
    S.K_COST: "x_kpi_cost",
    S.K_DAYS: "x_kpi_days",
    S.K_MIX: "x_kpi_mix",
    S.K_INCO: "x_kpi_inco",
    S.SIM: "x_sim",
    "lien_salarie": "b_link",
}
KEYS = {
    S.ACT: "id_activite",
    S.V_ACT: "cle_dedup_activite",
    S.V_SAL: "cle_salarie",
    S.V_CTRL: "cle_salarie",
    S.E_PRIME: "cle_salarie",
    S.E_BE: "cle_salarie",
    S.SIM: "id_activite",
}

PROFILE_SQL = (
    "CASE WHEN coalesce(length(trim(r.sport_declare)) > 0, false) AND coalesce(r.mod_depl_decl IN ('Marche/running', 'Vélo/Trottinette/Autres'), false) "
    "THEN 'eleve' WHEN coalesce(length(trim(r.sport_declare)) > 0, false) OR coalesce(r.mod_depl_decl IN ('Marche/running', 'Vélo/Trottinette/Autres'), false) "
    "THEN 'moyen' ELSE 'faible' END"
)
SIM_SQL = (
    f"SELECT a.*, r.mod_depl_decl, r.sport_declare, {PROFILE_SQL} AS profil, {X.local_day('a.date_debut')} AS jour_local "
    "FROM b_act_table a LEFT JOIN b_roster r ON r.cle_salarie = a.cle_salarie WHERE a.source_donnee = 'csv_simule'"
)

# the simulated rows as a twin relation usable by vt()
if all(n != "x_sim" for n, _ in VIEW_CTES):
    VIEW_CTES.append(("x_sim", SIM_SQL))


def tables(m: BenefitModel, checks=None) -> dict:
    """The checked tables: all, or those that ``checks`` read."""
    t = m.t
    employee = ["id_salarie_brut", "nom", "prenom", "bu", "mod_depl_decl"]
    frames = {
        S.ACT: t.activity_table,
        S.SAL: lambda: t.link().join(t.roster().select(*employee), "id_salarie_brut").drop("id_salarie_brut"),
        S.V_ACT: lambda: m.bi_activity,
        S.V_SAL: lambda: m.bi_employee,
        S.V_CTRL: lambda: m.bi_commute,
        S.V_PARAM: lambda: m.effective_params,
        S.E_PRIME: lambda: m.bonus,
        S.E_BE: lambda: m.wellbeing,
        S.K_COST: m.kpi_bonus_cost,
        S.K_DAYS: m.kpi_extra_days,
        S.K_MIX: m.kpi_activity_mix,
        S.K_INCO: m.kpi_incoherences,
        S.SIM: lambda: S.simulation_frame(t.activity_table(), t.roster(), RUN),
        "lien_salarie": t.link,
    }
    wanted = frames if checks is None else {n for c in checks for n in (c.table, c.parent) if n}
    return {n: frame() for n, frame in frames.items() if n in wanted}


# Injected violations, so that every row check has rows to find: the same SQL
# text replaces a column in the job's table and in the twin's relation.
_SOME = "right(cle_salarie, 1) IN ('0', '7')"
FAULTS: dict[str, dict[str, str]] = {
    S.ACT: {
        "distance_m": "CAST(CASE WHEN id_activite % 13 = 0 THEN -5 ELSE distance_m END AS INT)",
        "date_debut": "CASE WHEN id_activite % 17 = 0 THEN date_debut - INTERVAL '400' DAY ELSE date_debut END",
    },
    S.V_ACT: {
        "duree_sec": "CAST(CASE WHEN right(cle_dedup_activite, 1) = '3' THEN -1 ELSE duree_sec END AS INT)",
        "distance_m": "CAST(CASE WHEN right(cle_dedup_activite, 1) = '5' THEN -1 ELSE distance_m END AS INT)",
        "type_activite_inconnu": "CASE WHEN right(cle_dedup_activite, 2) = 'a1' THEN NOT type_activite_inconnu "
        "WHEN right(cle_dedup_activite, 2) = 'a2' THEN NULL ELSE type_activite_inconnu END",
    },
    S.V_CTRL: {
        "duree_min": f"CASE WHEN {_SOME} THEN NULL ELSE duree_min END",
        "distance_km": "CASE WHEN right(cle_salarie, 1) = '4' THEN -distance_km ELSE distance_km END",
    },
    S.E_PRIME: {
        "motif_ineligibilite": f"CASE WHEN {_SOME} AND est_eligible_prime THEN 'motif' WHEN {_SOME} THEN '' ELSE motif_ineligibilite END"
    },
    S.E_BE: {
        "periode_debut": "CASE WHEN right(cle_salarie, 1) = '1' THEN NULL ELSE periode_debut END",
        "periode_fin": "CASE WHEN right(cle_salarie, 1) = '2' THEN DATE '1999-01-01' ELSE periode_fin END",
        "jours_bien_etre_attribues": f"CAST(CASE WHEN {_SOME} AND est_eligible_bien_etre THEN NULL WHEN {_SOME} THEN 3 "
        "ELSE jours_bien_etre_attribues END AS INT)",
    },
}


def faulty(frames: dict) -> dict:
    """The checked tables with the injected violations."""
    return {name: df.withColumns({c: F.expr(e) for c, e in FAULTS.get(name, {}).items()}) for name, df in frames.items()}


def faulty_sources(sources: dict[str, str]) -> dict[str, str]:
    out = dict(sources)
    for name, columns in FAULTS.items():
        replaced = ", ".join(f"{e} AS {c}" for c, e in columns.items())
        out[name] = f"(SELECT * REPLACE ({replaced}) FROM {sources[name]})"
    return out


def _sel(suite, kinds=None, names=None, tables_=None):
    out = []
    for c in suite:
        if kinds and c.kind not in kinds:
            continue
        if names and c.name not in names:
            continue
        if tables_ and c.table not in tables_:
            continue
        out.append(c)
    return out


def _results_query(key: str, subset, doc: str):
    sql = quality.twin_results(subset, {**SOURCES, S.SIM: "x_sim"})

    def run(spark, sf_dir):
        m = BenefitModel.of(spark, sf_dir, RUN)
        return quality.evaluate(tables(m, subset), subset)

    run.__doc__ = doc
    register(key, _twin_sim(sql))(run)


def _rows_query(key: str, subset, doc: str):
    sql = quality.twin_failed_rows(subset, faulty_sources({**SOURCES, S.SIM: "x_sim"}), KEYS)

    def run(spark, sf_dir):
        m = BenefitModel.of(spark, sf_dir, RUN)
        return quality.failed_rows(faulty(tables(m, subset)), subset, KEYS)

    run.__doc__ = doc
    register(key, _twin_sim(sql))(run)


def _twin_sim(sql: str) -> str:
    return vt(sql)


_results_query("dq_row_count", _sel(TABLE_SUITE, kinds=("row_count",)), "Q1/Q2/Q17: row counts with thresholds.")
_results_query("dq_row_count_same", _sel(TABLE_SUITE, kinds=("same_count",)), "Q3: row count equal to the employee view.")
_results_query("dq_missing", _sel(TABLE_SUITE, kinds=("missing",)), "Q4: NULL counts, one aggregate pass per table.")
_results_query("dq_duplicates", _sel(TABLE_SUITE, kinds=("duplicates",)), "Q5: keys occurring more than once.")
_results_query("dq_reference", _sel(TABLE_SUITE, kinds=("reference",)), "Q6/J10: values missing from the referenced table.")
_results_query("dq_domain", _sel(TABLE_SUITE, kinds=("domain",)), "Q7: values outside the valid domain.")
_results_query("dq_columns", _sel(SIM_SUITE, kinds=("columns",)), "Q16: exact column list and order.")
_rows_query("dq_negative", _sel(TABLE_SUITE, names=("distance negative", "valeurs negatives hors exclusions")), "Q8: negative values.")
_rows_query("dq_outside_window", _sel(TABLE_SUITE, names=("date_debut hors fenetre 12 mois",)), "Q9: local day outside the window.")
_rows_query(
    "dq_flag_label",
    [c for c in TABLE_SUITE if c.name.startswith("coherence ")],
    "Q10: flag <-> INCONNU label coherence (three-valued logic).",
)
_rows_query(
    "dq_numeric_validity",
    _sel(TABLE_SUITE, names=("valeurs negatives hors exclusions", "distance duree manquantes ou negatives hors exclusions")),
    "Q11: numeric validity unless structurally excluded.",
)
_rows_query("dq_reason_coherence", _sel(TABLE_SUITE, names=("motif coherent avec le flag",)), "Q13: reason <-> flag.")
_rows_query("dq_period", _sel(TABLE_SUITE, names=("periode coherente",)), "Q14: period bounds.")
_rows_query("dq_days_coherence", _sel(TABLE_SUITE, names=("attribution jours coherente",)), "Q15: days granted <-> eligibility.")

for _key, _grp, _doc in (
    ("dq_key_format", "format", "Q18/F20: key format, constant source, known keys and labels."),
    ("dq_window_checks", "window", "Q19: parseable dates, one per employee-day, window bounds."),
    ("dq_distance_by_category", "category", "Q20: distance rules per sport category."),
    ("dq_duration_bounds", "duration", "Q21: duration bounds per category."),
    ("dq_distance_ratio", "ratio", "Q22: distance ratio to the mode reference."),
    ("dq_declared_sport", "declared", "Q23: activity type equals the declared sport."),
):
    _results_query(_key, _sel(SIM_SUITE, names=S.SIM_GROUPS[_grp]), _doc)


# one required code comes into effect in the middle of the activity days
LATE = "CASE WHEN code_param = 'seuil_km_velo_autres' THEN DATE '2024-01-10' ELSE date_effet END"


@register(
    "dq_required_params",
    vt(
        "SELECT d.jour, r.code_param AS param_manquant FROM (SELECT DISTINCT jour FROM b_activity) d, "
        f"(VALUES {', '.join('(' + X.q(c) + ')' for c in REQUIRED_PARAM_CODES)}) r(code_param) "
        "WHERE NOT EXISTS (SELECT 1 FROM b_params p WHERE p.code_param = r.code_param AND "
        f"{LATE} <= d.jour)"
    ),
)
def q_dq_required_params(spark, sf_dir):
    """Required parameter codes without a version in effect, for
    every activity day (anti join of required codes per day)."""
    from perkline.plans.params import effective_params_at

    m = BenefitModel.of(spark, sf_dir, RUN)
    eff = effective_params_at(m.params.withColumn("date_effet", F.expr(LATE)), m.activities, "jour")
    days = m.activities.select("jour").distinct()
    # every (day, required code) pair: codes are a fixed list of six values
    pairs = days.select("jour", F.explode(F.array(*[F.lit(c) for c in REQUIRED_PARAM_CODES])).alias("code_param"))
    return pairs.join(eff.select("jour", "code_param"), ["jour", "code_param"], "left_anti").select(
        "jour", F.col("code_param").alias("param_manquant")
    )


@register(
    "dq_window_bounds",
    vt(
        f"SELECT min(date_debut) AS min_date_debut, max(date_debut) AS max_date_debut, "
        f"min({X.local_day('date_debut')}) AS min_jour_local, max({X.local_day('date_debut')}) AS max_jour_local FROM b_act_table "
        "WHERE source_donnee = 'csv_simule'"
    ),
)
def q_dq_window_bounds(spark, sf_dir):
    """Bounds of the simulated activity instants (and local days)."""
    from perkline.functions.dates import local_day

    t = BenefitModel.of(spark, sf_dir, RUN).t
    a = t.activity_table().filter(F.col("source_donnee") == "csv_simule")
    return a.agg(
        F.min("date_debut").alias("min_date_debut"),
        F.max("date_debut").alias("max_date_debut"),
        F.min(local_day("date_debut", RUN.zone)).alias("min_jour_local"),
        F.max(local_day("date_debut", RUN.zone)).alias("max_jour_local"),
    )


MAXIMA = S.SCENARIO_MONTHLY_RANGES[RUN.scenario]


@register(
    "dq_monthly_max",
    _twin_sim(
        "SELECT c.cle_salarie, c.ym, c.nb_activites_mois, p.profil, m.mx AS max_autorise FROM "
        "(SELECT cle_salarie, strftime(jour_local, '%Y-%m') AS ym, count(*) AS nb_activites_mois FROM x_sim GROUP BY 1, 2) c "
        "LEFT JOIN (SELECT DISTINCT cle_salarie, profil FROM x_sim) p ON p.cle_salarie = c.cle_salarie "
        f"LEFT JOIN (VALUES {', '.join(f'({X.q(k)}, {v[1]})' for k, v in MAXIMA.items())}) m(profil, mx) ON m.profil = p.profil "
        "WHERE c.nb_activites_mois > m.mx"
    ),
)
def q_dq_monthly_max(spark, sf_dir):
    """Monthly count above the scenario maximum of the profile."""
    t = BenefitModel.of(spark, sf_dir, RUN).t
    sim = S.simulation_frame(t.activity_table(), t.roster(), RUN)
    return S.monthly_max(sim, RUN.scenario).select("cle_salarie", "ym", "nb_activites_mois", "profil", F.col("max_autorise").cast("int"))


@register(
    "dq_summary",
    _twin_sim(
        "SELECT count(*) FILTER (WHERE statut = 'OK') AS nb_ok, count(*) FILTER (WHERE statut = 'WARN') AS nb_warn, "
        "count(*) FILTER (WHERE statut = 'FAIL') AS nb_fail, CASE WHEN count(*) FILTER (WHERE statut = 'FAIL') > 0 THEN 'FAIL' "
        "WHEN count(*) FILTER (WHERE statut = 'WARN') > 0 THEN 'WARN' ELSE 'OK' END AS statut_global FROM ("
        + quality.twin_results(TABLE_SUITE + SIM_SUITE, {**SOURCES, S.SIM: "x_sim"})
        + ")"
    ),
)
def q_dq_summary(spark, sf_dir):
    """Q25: PASS/WARN/FAIL counters of both suites and the overall status."""
    m = BenefitModel.of(spark, sf_dir, RUN)
    return quality.summarise(quality.evaluate(tables(m), TABLE_SUITE + SIM_SUITE))
