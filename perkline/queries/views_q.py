"""BI, eligibility and KPI queries (K6-K8, K10) with their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from perkline.config import (
    ACTIVE_MODES,
    BONUS_REASONS,
    COST_SCENARIOS,
    DEFAULT_RUN,
    PARAM_MAPPING,
    SCENARIO_GRID,
    SPORTS,
    TRAVEL_MODES,
)
from perkline.operators import mutate
from perkline.plans import scenarios
from perkline.plans.bi import BI_ACTIVITY_COLUMNS
from perkline.plans.model import BenefitModel
from perkline.plans.params import PIVOT_SPEC, effective_params_at, params_from_mapping_at
from perkline.queries import register
from perkline.twins import twin
from perkline.twins import exprs as X

START, END = DEFAULT_RUN.period()
D_START, D_END = f"DATE '{START.isoformat()}'", f"DATE '{END.isoformat()}'"
AS_OF = f"DATE '{DEFAULT_RUN.as_of.isoformat()}'"
ACTIVE = ", ".join(X.q(m) for m in ACTIVE_MODES)


def M(spark, sf_dir) -> BenefitModel:
    return BenefitModel.of(spark, sf_dir, DEFAULT_RUN)


# ---------------------------------------------------------------------------
# Twin CTEs shared by the view queries
# ---------------------------------------------------------------------------
C_ACT_LAB = (
    "x_act_lab",
    f"SELECT *, jour AS date_activite, {X.minutes('duree_sec')} AS duree_min, {X.km('distance_m')} AS distance_km, "
    f"{X.canonical('type_activite', SPORTS, 'type_activite_normalise', 'type_activite_inconnu')} FROM b_activity",
)
C_ACT_CAT = (
    "x_act_cat",
    f"SELECT *, {X.category('type_activite_normalise', 'type_activite_inconnu')}, "
    "md5(concat_ws('|', cle_salarie, strftime(date_debut, '%Y-%m-%d %H:%M:%S.%f'), type_activite_normalise, "
    "CAST(duree_sec AS VARCHAR), CAST(coalesce(distance_m, -1) AS VARCHAR), coalesce(trim(source_donnee), ''))) AS cle_dedup_activite, "
    "type_activite_inconnu AS est_exclue_structurelle, "
    "CASE WHEN type_activite_inconnu THEN 'Type activité inconnu' END AS motif_exclusion FROM x_act_lab",
)
C_BI_ACT = (
    "x_bi_act",
    f"SELECT {', '.join(BI_ACTIVITY_COLUMNS)} FROM x_act_cat WHERE id_activite IN (SELECT min(id_activite) FROM x_act_cat "
    "GROUP BY cle_salarie, date_debut, type_activite_normalise, duree_sec, ifnull(distance_m, -1), ifnull(trim(source_donnee), ''))",
)
C_BI_EMP = (
    "x_bi_emp",
    "SELECT l.cle_salarie, r.nom, r.prenom, r.bu, r.type_contrat, r.date_embauche, "
    f"r.date_naissance, {X.canonical('r.mod_depl_decl', TRAVEL_MODES, 'mod_depl_decl_normalise', 'mod_depl_decl_inconnu')} "
    "FROM b_link l JOIN b_roster r ON r.id_salarie_brut = l.id_salarie_brut",
)
C_BI_CTRL = (
    "x_bi_ctrl",
    "SELECT k.cle_salarie, mode_trajet_normalise, mode_trajet_inconnu, distance_m, "
    f"{X.km('distance_m')} AS distance_km, duree_sec, {X.minutes('duree_sec')} AS duree_min, seuil_km, est_incoherent, date_ctrl, "
    "mode_trajet_normalise = 'INCONNU' AS est_exclue_structurelle FROM (SELECT *, "
    f"{X.canonical('mode_trajet', TRAVEL_MODES, 'mode_trajet_normalise', 'mode_trajet_inconnu')} FROM b_ctrl) k "
    "SEMI JOIN (SELECT cle_salarie, max({'d': ifnull(date_ctrl, DATE '9999-12-31'), 'i': id_ctrl}).i AS id_ctrl FROM b_ctrl GROUP BY cle_salarie) latest "
    "ON latest.id_ctrl = k.id_ctrl AND latest.cle_salarie = k.cle_salarie",
)
C_SAL = ("x_sal", "SELECT l.cle_salarie, r.brut_annuel FROM b_link l JOIN b_roster r ON r.id_salarie_brut = l.id_salarie_brut")
C_COUNTS = (
    "x_counts",
    "SELECT cle_salarie, CAST(count(*) AS INTEGER) AS nb_activites_periode FROM x_bi_act "
    f"WHERE est_exclue_structurelle = false AND date_activite BETWEEN {D_START} AND {D_END} GROUP BY cle_salarie",
)
R = [X.q(r) for r in BONUS_REASONS]
# the reasons in order of priority, each where its test fails; no reason means
# eligible
C_BONUS = (
    "x_bonus",
    "SELECT cle_salarie, motif IS NULL AS est_eligible_prime, motif AS motif_ineligibilite FROM (SELECT e.cle_salarie, coalesce("
    + ", ".join(
        f"CASE WHEN {test} THEN {reason} END"
        for test, reason in zip(
            (
                "ifnull(pay.brut_annuel, 0) <= 0",
                "chk.cle_salarie IS NULL",
                "chk.est_exclue_structurelle",
                "chk.est_incoherent",
                "e.mod_depl_decl_inconnu",
                f"NOT list_contains([{ACTIVE}], e.mod_depl_decl_normalise)",
            ),
            R,
            strict=True,
        )
    )
    + ") AS motif FROM x_bi_emp e LEFT JOIN x_bi_ctrl chk USING (cle_salarie) LEFT JOIN x_sal pay USING (cle_salarie))",
)
C_WELL = (
    "x_well",
    f"SELECT cle_salarie, {D_START} AS periode_debut, {D_END} AS periode_fin, n AS nb_activites_periode, least_n AS min_activites_bien_etre, "
    "given AS jours_bien_etre, enough AS est_eligible_bien_etre, CAST(given * CAST(enough AS INTEGER) AS INTEGER) AS jours_bien_etre_attribues "
    "FROM (SELECT *, ifnull(n >= least_n, false) AS enough FROM (SELECT e.cle_salarie, CAST(ifnull(c.nb_activites_periode, 0) AS INTEGER) AS n, "
    "(SELECT min_activites_bien_etre FROM b_pivot) AS least_n, ifnull((SELECT jours_bien_etre FROM b_pivot), 0) AS given "
    "FROM x_bi_emp e LEFT JOIN x_counts c USING (cle_salarie)))",
)
C_AGE = (
    "x_age",
    f"SELECT cle_salarie, {AS_OF} AS date_run_paris, {X.age_band('date_naissance', AS_OF)} AS tranche_age FROM x_bi_emp",
)

# one row per employee with what the cost figures add up
C_DUE = (
    "x_due",
    "SELECT e.cle_salarie, CAST(e.est_eligible_prime AS INTEGER) AS prime, CASE WHEN e.est_eligible_prime THEN ifnull(s.brut_annuel, 0) ELSE 0 END AS base "
    "FROM x_bonus e LEFT JOIN x_sal s USING (cle_salarie)",
)
C_KPI_COST = (
    "x_kpi_cost",
    "SELECT p.taux_prime, t.nb_salaries_eligibles_prime, "
    + X.money("t.base * p.taux_prime")
    + " AS cout_annuel_total_prime FROM (SELECT CAST(sum(prime) AS BIGINT) AS nb_salaries_eligibles_prime, sum(base) AS base "
    "FROM x_due HAVING count(*) > 0) t, b_pivot p",
)
C_KPI_DAYS = (
    "x_kpi_days",
    "SELECT min_activites_bien_etre, any_value(pj) AS jours_bien_etre, CAST(sum(CAST(est_eligible_bien_etre AS INTEGER)) AS BIGINT) "
    "AS nb_salaries_eligibles_bien_etre, CAST(sum(jours_bien_etre_attribues) AS INTEGER) AS nb_jours_supplementaires, "
    "any_value(periode_debut) AS periode_debut, any_value(periode_fin) AS periode_fin FROM "
    "(SELECT w.*, (SELECT jours_bien_etre FROM b_pivot) AS pj FROM x_well w) GROUP BY min_activites_bien_etre",
)
C_KPI_MIX = (
    "x_kpi_mix",
    f"SELECT type_activite_normalise, CAST(count(*) AS INTEGER) AS nb_activites, {D_START} AS periode_debut, {D_END} AS periode_fin "
    f"FROM x_bi_act WHERE NOT est_exclue_structurelle AND date_activite >= {D_START} AND date_activite <= {D_END} "
    "GROUP BY ALL",
)
C_KPI_INCO = ("x_kpi_inco", "SELECT CAST(ifnull(sum(CAST(est_incoherent AS INTEGER)), 0) AS BIGINT) AS nb_incoherences_detectees FROM x_bi_ctrl")
C_AGE_KPI = (
    "x_age_kpi",
    "SELECT g.date_run_paris, g.tranche_age, g.nb_salaries, g.nb_salaries_eligibles_prime, "
    + X.money("g.base * p.taux_prime")
    + " AS cout_annuel_total_prime_variable, "
    + X.money("g.nb_salaries_eligibles_prime * p.montant_prime_fixe")
    + " AS cout_annuel_total_prime_fixe, g.nb_salaries_eligibles_bien_etre, g.jours_bien_etre_attribues_total FROM ("
    "SELECT a.date_run_paris, a.tranche_age, count(*) AS nb_salaries, CAST(sum(d.prime) AS BIGINT) AS nb_salaries_eligibles_prime, sum(d.base) AS base, "
    "CAST(sum(CAST(w.est_eligible_bien_etre AS INTEGER)) AS BIGINT) AS nb_salaries_eligibles_bien_etre, "
    "CAST(sum(w.jours_bien_etre_attribues) AS INTEGER) AS jours_bien_etre_attribues_total "
    "FROM x_age a JOIN x_due d USING (cle_salarie) JOIN x_well w USING (cle_salarie) GROUP BY ALL) g, b_pivot p",
)
C_EMP_V1 = (
    "x_emp_v1",
    "SELECT l.cle_salarie, r.nom, r.prenom, r.bu, r.mod_depl_decl FROM b_link l JOIN b_roster r ON r.id_salarie_brut = l.id_salarie_brut",
)

VIEW_CTES = [C_ACT_LAB, C_ACT_CAT, C_BI_ACT, C_BI_EMP, C_BI_CTRL, C_SAL, C_COUNTS, C_BONUS, C_WELL, C_AGE, C_DUE, C_KPI_COST, C_KPI_DAYS,
             C_KPI_MIX, C_KPI_INCO, C_EMP_V1, C_AGE_KPI]


def vt(body: str) -> str:
    """Twin with the view CTEs that ``body`` needs (transitively)."""
    import re

    names = {n for n, _ in VIEW_CTES}
    want: set[str] = set()
    stack = re.findall(r"\bx_[a-z0-9_]+\b", body)
    lookup = dict(VIEW_CTES)
    while stack:
        n = stack.pop()
        if n in names and n not in want:
            want.add(n)
            stack.extend(re.findall(r"\bx_[a-z0-9_]+\b", lookup[n]))
    return twin(body, [c for c in VIEW_CTES if c[0] in want])


# ---------------------------------------------------------------------------
# Parameters
# ---------------------------------------------------------------------------
EFF_AT = (
    "SELECT d.jour, p.code_param, p.valeur_param, p.date_effet FROM (SELECT DISTINCT jour FROM b_activity) d "
    "JOIN (SELECT * FROM (SELECT *, lead(date_effet) OVER (PARTITION BY code_param ORDER BY date_effet, valeur_param) AS valid_to "
    "FROM b_params WHERE date_effet IS NOT NULL) WHERE valid_to IS NULL OR valid_to > date_effet) p "
    "ON d.jour >= p.date_effet AND (p.valid_to IS NULL OR d.jour < p.valid_to)"
)


@register("effective_params", twin(EFF_AT))
def q_effective_params(spark, sf_dir):
    """W3 as an as-of join: effective version of every parameter on each
    activity day."""
    m = M(spark, sf_dir)
    return effective_params_at(m.params, m.activities, "jour")


_PIVOT_COLS = ", ".join(
    f"max(CASE WHEN code_param = {X.q(c)} THEN CAST(valeur_param AS {t.upper().replace('INT', 'INTEGER') if t == 'int' else t.upper()}) END) AS {c}"
    for c, t in PIVOT_SPEC
)


@register("param_pivot", twin(f"SELECT jour, {_PIVOT_COLS} FROM ({EFF_AT}) GROUP BY jour"))
def q_param_pivot(spark, sf_dir):
    """A1 per activity day: the typed one-row pivot of that day's parameters."""
    m = M(spark, sf_dir)
    eff = effective_params_at(m.params, m.activities, "jour")
    return eff.groupBy("jour").agg(
        *[F.max(F.when(F.col("code_param") == c, F.col("valeur_param").cast(t))).alias(c) for c, t in PIVOT_SPEC]
    )


@register(
    "params_json",
    twin(
        "SELECT jour, CAST(to_json(map_from_entries(list((code_param, {'valeur_param': valeur_param, 'date_effet': date_effet}) "
        f"ORDER BY code_param))) AS VARCHAR) AS param_effectif FROM ({EFF_AT}) GROUP BY jour"
    ),
)
def q_params_json(spark, sf_dir):
    """A14 per activity day: parameters in effect as one JSON object."""
    m = M(spark, sf_dir)
    eff = effective_params_at(m.params, m.activities, "jour")
    entries = F.array_sort(F.collect_list(F.struct("code_param", F.struct("valeur_param", "date_effet"))))
    return eff.groupBy("jour").agg(F.to_json(F.map_from_entries(entries)).alias("param_effectif"))


def _mapping_values_sql() -> str:
    return "(VALUES " + ", ".join(f"({X.q(k)}, {X.q(v)})" for k, v in PARAM_MAPPING) + ") AS m(code_param, valeur_param)"


MAPPING_SQL = (
    "SELECT d.jour, m.code_param, m.valeur_param, d.jour AS date_effet FROM (SELECT DISTINCT jour FROM b_activity) d "
    f"CROSS JOIN {_mapping_values_sql()}"
)
DIFF_SQL = (
    "SELECT n.jour, n.code_param, e.valeur_param AS valeur_actuelle, n.valeur_param, n.jour AS date_effet, "
    "CASE WHEN e.code_param IS NULL THEN 'insert' WHEN e.valeur_param IS DISTINCT FROM n.valeur_param THEN 'update' ELSE 'noop' END AS action "
    f"FROM ({MAPPING_SQL}) n LEFT JOIN ({EFF_AT}) e ON e.jour = n.jour AND e.code_param = n.code_param"
)


@register("params_from_mapping", twin(MAPPING_SQL))
def q_params_from_mapping(spark, sf_dir):
    """Parameter rows from the flat mapping, dated each activity day."""
    m = M(spark, sf_dir)
    return params_from_mapping_at(m.activities.select("jour").distinct(), PARAM_MAPPING)


def _diff_per_day(spark, sf_dir):
    m = M(spark, sf_dir)
    new = params_from_mapping_at(m.activities.select("jour").distinct(), PARAM_MAPPING)
    return mutate.param_actions(effective_params_at(m.params, m.activities, "jour"), new, ["jour", "code_param"])


@register("param_diff", twin(DIFF_SQL))
def q_param_diff(spark, sf_dir):
    """M7: diff of the mapping against the parameters in effect on each
    activity day (insert absent code, update differing text, noop)."""
    return _diff_per_day(spark, sf_dir)


@register("param_sync", twin(f"SELECT jour, code_param, valeur_param, date_effet, action FROM ({DIFF_SQL}) WHERE action <> 'noop'"))
def q_param_sync(spark, sf_dir):
    """K4: the parameter versions a sync on each activity day would write
    (new codes and changed values, effective that day)."""
    d = _diff_per_day(spark, sf_dir)
    return d.filter(F.col("action") != "noop").select("jour", "code_param", "valeur_param", "date_effet", "action")


@register(
    "param_next_version",
    twin(
        f"SELECT code_param, valeur_param, date_effet FROM b_params UNION ALL SELECT code_param, valeur_param, date_effet FROM ({DIFF_SQL}) "
        "WHERE action <> 'noop' AND jour = (SELECT max(jour) FROM b_activity)"
    ),
)
def q_param_next_version(spark, sf_dir):
    """K4: the parameter table after a sync on the last activity day."""
    m = M(spark, sf_dir)
    last = m.activities.agg(F.max("jour").alias("j")).scalar()
    actions = _diff_per_day(spark, sf_dir).filter(F.col("jour") == last)
    return mutate.next_params(m.params, actions)


# ---------------------------------------------------------------------------
# BI views
# ---------------------------------------------------------------------------
@register("bi_activity", vt("SELECT * FROM x_bi_act"))
def q_bi_activity(spark, sf_dir):
    """Activities without exact duplicates (smallest id kept), canonical labels, category, digest, exclusion."""
    return M(spark, sf_dir).bi_activity


@register("bi_employee", vt("SELECT * FROM x_bi_emp"))
def q_bi_employee(spark, sf_dir):
    """Employees through the link table with the canonical declared mode."""
    return M(spark, sf_dir).bi_employee


@register("bi_commute", vt("SELECT * FROM x_bi_ctrl"))
def q_bi_commute(spark, sf_dir):
    """Latest commute check per employee with canonical mode and exclusion flag."""
    return M(spark, sf_dir).bi_commute


# ---------------------------------------------------------------------------
# Eligibility
# ---------------------------------------------------------------------------
@register("activity_count_window", vt("SELECT * FROM x_counts"))
def q_activity_count_window(spark, sf_dir):
    """A2: non-excluded activities per employee inside the rolling window."""
    return M(spark, sf_dir).activity_counts


@register("bonus_eligibility", vt("SELECT * FROM x_bonus"))
def q_bonus_eligibility(spark, sf_dir):
    """Commuting-bonus flag and first-match ineligibility reason."""
    return M(spark, sf_dir).bonus


@register("wellbeing_eligibility", vt("SELECT * FROM x_well"))
def q_wellbeing_eligibility(spark, sf_dir):
    """Activities in the window against the minimum, days granted."""
    return M(spark, sf_dir).wellbeing


@register("benefit_category", vt(
    "SELECT cle_salarie, p.est_eligible_prime, p.motif_ineligibilite, w.est_eligible_bien_etre, w.nb_activites_periode, "
    "w.jours_bien_etre_attribues, w.periode_debut, w.periode_fin, "
    "(['RIEN', 'PRIME_SEULE', 'BIEN_ETRE_SEUL', 'PRIME+BIEN_ETRE'])[1 + CAST(p.est_eligible_prime AS INTEGER) "
    "+ 2 * CAST(w.est_eligible_bien_etre AS INTEGER)] AS categorie_avantage FROM x_bonus p JOIN x_well w USING (cle_salarie)"
))
def q_benefit_category(spark, sf_dir):
    """Both benefits per employee and the combined category."""
    return M(spark, sf_dir).benefits


# ---------------------------------------------------------------------------
# KPIs
# ---------------------------------------------------------------------------
@register("kpi_bonus_cost", vt("SELECT * FROM x_kpi_cost"))
def q_kpi_bonus_cost(spark, sf_dir):
    """A3: eligible employees and variable bonus cost (salary x rate)."""
    return M(spark, sf_dir).kpi_bonus_cost()


@register("kpi_bonus_cost_fixed", vt(
    "SELECT p.montant_prime_fixe AS montant_prime, t.n AS nb_salaries_eligibles_prime, "
    + X.money("t.n * p.montant_prime_fixe")
    + " AS cout_annuel_total_prime FROM (SELECT CAST(ifnull(sum(prime), 0) AS BIGINT) AS n FROM x_due) t, b_pivot p"
))
def q_kpi_bonus_cost_fixed(spark, sf_dir):
    """A4: eligible employees x fixed amount."""
    return M(spark, sf_dir).kpi_bonus_cost_fixed()


@register("kpi_extra_days", vt("SELECT * FROM x_kpi_days"))
def q_kpi_extra_days(spark, sf_dir):
    """A5: employees earning well-being days and total extra days."""
    return M(spark, sf_dir).kpi_extra_days()


@register("kpi_activity_mix", vt("SELECT * FROM x_kpi_mix ORDER BY nb_activites DESC, type_activite_normalise"))
def q_kpi_activity_mix(spark, sf_dir):
    """Activities per canonical type in the window, count desc."""
    return M(spark, sf_dir).kpi_activity_mix()


@register("kpi_incoherences", vt("SELECT * FROM x_kpi_inco"))
def q_kpi_incoherences(spark, sf_dir):
    """Incoherent latest commute checks."""
    return M(spark, sf_dir).kpi_incoherences()


@register("kpi_age", vt("SELECT * FROM x_age_kpi"))
def q_kpi_age(spark, sf_dir):
    """Eligibility and costs per age band."""
    return M(spark, sf_dir).kpi_age()


_SCN = ", ".join(
    f"CAST({c} AS {'INTEGER' if t == 'int' else t.upper()}) AS {c}" for c, t in scenarios.SCENARIO_PARAMS.items()
)
_SCN_NAMES = ", ".join(scenarios.SCENARIO_PARAMS)


def _scenario_twin(rows: str) -> str:
    """Every scenario decided anew for every employee."""
    limit = "CAST(floor({} * 1000) AS BIGINT)".format
    return vt(
        f"SELECT s.scenario, {', '.join('s.' + c for c in scenarios.SCENARIO_PARAMS)}, "
        "count(*) FILTER (WHERE prime) AS nb_salaries_eligibles_prime, "
        + X.money("coalesce(sum(brut_annuel * taux_prime) FILTER (WHERE prime), 0)")
        + " AS cout_annuel_total_prime_variable, "
        + X.money("count(*) FILTER (WHERE prime) * any_value(montant_prime_fixe)")
        + " AS cout_annuel_total_prime_fixe, count(*) FILTER (WHERE nb >= min_activites_bien_etre) AS nb_salaries_eligibles_bien_etre, "
        "count(*) FILTER (WHERE nb >= min_activites_bien_etre) * any_value(jours_bien_etre) AS nb_jours_supplementaires "
        "FROM (SELECT s.*, e.cle_salarie, ifnull(c.nb_activites_periode, 0) AS nb, p.brut_annuel, "
        f"(p.brut_annuel > 0 AND NOT e.mod_depl_decl_inconnu AND e.mod_depl_decl_normalise IN ({ACTIVE}) AND k.cle_salarie IS NOT NULL "
        "AND NOT k.est_exclue_structurelle AND NOT coalesce(k.distance_m > CASE WHEN trim(r.mode_trajet) = 'Marche/running' THEN "
        + limit("s.seuil_km_marche_course")
        + " WHEN trim(r.mode_trajet) = 'Vélo/Trottinette/Autres' THEN "
        + limit("s.seuil_km_velo_autres")
        + f" END, false)) AS prime FROM (SELECT scenario, {_SCN} FROM ({rows})) s CROSS JOIN x_bi_emp e "
        "LEFT JOIN x_sal p USING (cle_salarie) LEFT JOIN x_counts c USING (cle_salarie) LEFT JOIN x_bi_ctrl k USING (cle_salarie) "
        "LEFT JOIN (SELECT cle_salarie, arg_max(mode_trajet, {'d': date_ctrl, 'i': id_ctrl}) AS mode_trajet FROM b_ctrl GROUP BY 1) r "
        "USING (cle_salarie)) s GROUP BY ALL"
    )


def _scenario_rows() -> str:
    rows = ", ".join("(" + ", ".join(X.q(v) for v in row) + ")" for row in COST_SCENARIOS)
    return f"SELECT * FROM (VALUES {rows}) AS v(scenario, {_SCN_NAMES})"


def _grid_rows() -> str:
    lists = ", ".join(f"unnest([{', '.join(X.q(v) for v in SCENARIO_GRID[c])}]) AS u_{c}({c})" for c in scenarios.SCENARIO_PARAMS)
    return (
        f"SELECT concat_ws('/', {', '.join(f'CAST({c} AS VARCHAR)' for c in scenarios.SCENARIO_PARAMS)}) AS scenario, {_SCN_NAMES} "
        f"FROM (SELECT {_SCN} FROM {lists})"
    )


def _scenario_costs(m: BenefitModel, frame):
    return scenarios.cost_scenarios(m.bi_employee, m.commute_checks, m.salaries, m.activity_counts, frame)


@register("cost_scenarios", _scenario_twin(_scenario_rows()))
def q_cost_scenarios(spark, sf_dir):
    """Eligible employees, costs and days under named scenarios that
    change any of the parameters."""
    return _scenario_costs(M(spark, sf_dir), scenarios.scenarios_frame(spark))


@register("cost_scenario_grid", _scenario_twin(_grid_rows()))
def q_cost_scenario_grid(spark, sf_dir):
    """The same for every combination of a grid of parameter values."""
    return _scenario_costs(M(spark, sf_dir), scenarios.scenario_grid(spark))
