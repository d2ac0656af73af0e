"""DuckDB twins of the registered queries.

Each twin is plain SQL over the driver's tables (pre-registered views
``customer``, ``events``, ``orders`` …).  The domain bindings of FIXTURES.md
part B are prepended as CTEs, then the body computes the same result as the
Spark job, with identical column names and types.
"""

from __future__ import annotations

import re

# Domain bindings (DuckDB dialect), in dependency order.
BINDINGS: dict[str, str] = {
    "b_roster": """SELECT CAST(c_custkey AS VARCHAR) AS id_salarie_brut,
  'sal_' || substring(sha256('salt|' || CAST(c_custkey AS VARCHAR)),1,12) AS cle_salarie,
  c_name AS nom, c_mktsegment AS prenom, 'BU' || CAST(c_nationkey AS VARCHAR) AS bu,
  CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE DATE '1955-01-01' + CAST(c_custkey*7919 % 18000 AS INT) END AS date_naissance,
  CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE CAST(c_acctbal AS DECIMAL(12,2)) END AS brut_annuel,
  CASE c_custkey % 6 WHEN 0 THEN 'Marche/running' WHEN 1 THEN ' VÉLO/trottinette/autres ' WHEN 2 THEN 'Transports en commun'
    WHEN 3 THEN 'véhicule  thermique/électrique' WHEN 4 THEN NULL ELSE 'Hoverboard' END AS mod_depl_decl,
  CASE c_custkey % 4 WHEN 0 THEN 'Natation' WHEN 1 THEN 'Tennis' WHEN 2 THEN '' ELSE NULL END AS sport_declare,
  c_custkey % 23 <> 0 AS actif,
  CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 13 = 1 THEN '  ' ELSE CAST(c_custkey AS VARCHAR) || ' avenue ' || c_mktsegment END AS adresse_dom,
  CASE WHEN c_custkey % 5 = 0 THEN 'CDD' ELSE 'CDI' END AS type_contrat,
  CASE WHEN c_custkey % 31 = 0 THEN NULL ELSE DATE '1990-01-01' + CAST(c_custkey*31 % 12000 AS INT) END AS date_embauche
FROM customer""",
    "b_link": "SELECT id_salarie_brut, cle_salarie FROM b_roster",
    "b_activity": """SELECT ident AS id_activite, 'sal_' || substring(sha256('salt|' || CAST(user_id AS VARCHAR)),1,12) AS cle_salarie,
  ts AS date_debut, CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Paris' AS DATE) AS jour,
  CAST(floor(value*60) AS INT) AS duree_sec,
  CASE event_type WHEN 'view' THEN 'Runing' WHEN 'signup' THEN '  natation ' WHEN 'click' THEN 'Tennis  de   table'
    WHEN 'purchase' THEN 'RANDONNÉE' ELSE 'Curling' END AS type_activite,
  CASE WHEN event_type IN ('view','signup','purchase') AND event_id % 11 <> 0 THEN CAST(event_id*37 % 40000 AS INT) END AS distance_m,
  CASE WHEN event_id % 3 = 0 THEN 'note ' || CAST(event_id AS VARCHAR) ELSE '' END AS commentaire,
  CASE WHEN event_id % 4 = 0 THEN 'csv_simule' ELSE 'csv_gsheet' END AS source_donnee
FROM (SELECT 2 * event_id AS ident, event_id, ts, user_id, event_type, value FROM events
      UNION ALL SELECT 2 * event_id + 1, event_id, ts, user_id, event_type, value FROM events WHERE event_id % 20 = 0)""",
    "b_commute_raw": """SELECT o_orderkey AS id_ctrl,
  'sal_' || substring(sha256('salt|' || CASE WHEN o_custkey % 9 = 0 THEN 'ex-' ELSE '' END || CAST(o_custkey AS VARCHAR)),1,12) AS cle_salarie,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Marche/running' WHEN '2-HIGH' THEN 'Vélo/Trottinette/Autres'
    WHEN '3-MEDIUM' THEN 'Transports en commun' WHEN '5-LOW' THEN 'Trottinette volante' ELSE 'véhicule thermique/électrique' END AS mode_trajet,
  CAST(floor(o_totalprice/10) AS INT) AS distance_m, CAST(floor(o_totalprice/100) AS INT) AS duree_sec, o_orderdate AS date_ctrl
FROM orders""",
    "b_params": """SELECT code_param, valeur_param, CAST(date_effet AS DATE) AS date_effet FROM (VALUES
  ('taux_prime','0.04','2023-01-01'),('taux_prime','0.05','2024-01-01'),('taux_prime','0.06','2099-01-01'),
  ('jours_bien_etre','5','2023-01-01'),('min_activites_bien_etre','55','2023-01-01'),('montant_prime_fixe','1500','2023-01-01'),
  ('seuil_km_marche_course','15','2023-01-01'),('seuil_km_velo_autres','25','2023-01-01'),
  ('adresse_entreprise','1 rue Exemple','2023-01-01')) AS t(code_param, valeur_param, date_effet)""",
    "b_eff_params": """SELECT code_param, valeur_param, date_effet FROM (
  SELECT *, row_number() OVER (PARTITION BY code_param ORDER BY date_effet DESC NULLS FIRST, valeur_param DESC) AS rn
  FROM b_params WHERE date_effet <= DATE '2024-02-15') WHERE rn = 1""",
    "b_pivot": """SELECT
  max(CASE WHEN code_param = 'taux_prime' THEN CAST(valeur_param AS DECIMAL(10,4)) END) AS taux_prime,
  max(CASE WHEN code_param = 'montant_prime_fixe' THEN CAST(valeur_param AS DECIMAL(12,2)) END) AS montant_prime_fixe,
  max(CASE WHEN code_param = 'seuil_km_marche_course' THEN CAST(valeur_param AS DECIMAL(6,2)) END) AS seuil_km_marche_course,
  max(CASE WHEN code_param = 'seuil_km_velo_autres' THEN CAST(valeur_param AS DECIMAL(6,2)) END) AS seuil_km_velo_autres,
  max(CASE WHEN code_param = 'jours_bien_etre' THEN CAST(valeur_param AS INTEGER) END) AS jours_bien_etre,
  max(CASE WHEN code_param = 'min_activites_bien_etre' THEN CAST(valeur_param AS INTEGER) END) AS min_activites_bien_etre
FROM b_eff_params""",
    "b_ctrl": """SELECT r.id_ctrl, r.cle_salarie, r.mode_trajet, r.distance_m, r.duree_sec,
  CASE WHEN trim(r.mode_trajet) = 'Marche/running' THEN coalesce(p.seuil_km_marche_course, CAST(15 AS DECIMAL(6,2)))
       WHEN trim(r.mode_trajet) = 'Vélo/Trottinette/Autres' THEN coalesce(p.seuil_km_velo_autres, CAST(25 AS DECIMAL(6,2))) END AS seuil_km,
  coalesce(r.distance_m > CAST(floor(CASE WHEN trim(r.mode_trajet) = 'Marche/running' THEN coalesce(p.seuil_km_marche_course, 15)
       WHEN trim(r.mode_trajet) = 'Vélo/Trottinette/Autres' THEN coalesce(p.seuil_km_velo_autres, 25) END * 1000) AS BIGINT), false) AS est_incoherent,
  r.date_ctrl
FROM b_commute_raw r, b_pivot p""",
    "b_declared": """SELECT event_id AS ligne, strftime(ts,'%Y-%m-%d %H:%M:%S') AS horodateur,
  CASE WHEN event_id % 97 = 0 THEN 'Inconnu' WHEN event_id % 83 = 0 THEN replace(c_name, 'o', chr(244))
    WHEN event_id % 89 = 0 THEN replace(c_name, 'o', 'o' || chr(770)) WHEN event_id % 101 = 0 THEN replace(c_name, 'o', chr(7897)) WHEN event_id % 103 = 0 THEN replace(c_name, 'o', chr(65359)) WHEN event_id % 107 = 0 THEN replace(c_name, 'st', chr(64262)) WHEN event_id % 5 = 0 THEN ' ' || upper(c_name) || ' ' ELSE c_name END AS nom,
  c_mktsegment AS prenom,
  CASE WHEN event_id % 53 = 0 THEN '31/02/2024' ELSE strftime(ts,'%d/%m/%Y') END AS date_txt,
  CASE event_type WHEN 'view' THEN 'Runing' WHEN 'signup' THEN 'Natation' WHEN 'click' THEN 'Tennis' WHEN 'purchase' THEN 'Randonnée' ELSE '' END AS sport,
  CASE WHEN event_id % 7 = 0 THEN '' WHEN event_id % 59 = 0 THEN 'abc' ELSE CAST(event_id % 30 AS VARCHAR) || ',' || CAST(event_id % 10 AS VARCHAR) END AS distance_txt,
  CASE WHEN event_id % 61 = 0 THEN '1h30' WHEN event_id % 67 = 0 THEN repeat('9', 20) || ':00:00' ELSE '0' || CAST(event_id % 3 AS VARCHAR) || ':' || CAST(10 + event_id % 50 AS VARCHAR) || ':00' END AS duree_txt,
  CASE WHEN event_id % 33 = 0 THEN '"note ' || CAST(event_id AS VARCHAR) || chr(10) || 'suite"'
    WHEN event_id % 3 = 0 THEN '"note ' || CAST(event_id AS VARCHAR) || '"' ELSE '' END AS commentaire
FROM events JOIN customer ON user_id = c_custkey""",
    "b_name_ref": """SELECT CAST(c_custkey AS VARCHAR) AS id_salarie_brut, c_name AS nom, c_mktsegment AS prenom FROM customer
UNION ALL SELECT 'dup' || CAST(c_custkey AS VARCHAR), upper(c_name), c_mktsegment FROM customer WHERE c_custkey % 40 = 0""",
    "b_sport_ref": """SELECT id_salarie_brut, sport_declare, 2 * CAST(id_salarie_brut AS BIGINT) AS ligne FROM b_roster
UNION ALL SELECT id_salarie_brut, 'Judo', 2 * CAST(id_salarie_brut AS BIGINT) + 1 FROM b_roster WHERE CAST(id_salarie_brut AS BIGINT) % 7 = 0""",
    "b_roster_v2": """SELECT id_salarie_brut, nom, prenom, date_naissance, adresse_dom, mod_depl_decl,
  CASE WHEN CAST(id_salarie_brut AS BIGINT) % 7 = 0 THEN bu || '_maj' ELSE bu END AS bu,
  CASE WHEN CAST(id_salarie_brut AS BIGINT) % 7 = 0 THEN 'Judo' ELSE sport_declare END AS sport_declare,
  CASE WHEN CAST(id_salarie_brut AS BIGINT) % 11 = 3 THEN 'CDD' ELSE type_contrat END AS type_contrat,
  CASE WHEN CAST(id_salarie_brut AS BIGINT) % 11 = 4 THEN date_embauche + 1 ELSE date_embauche END AS date_embauche
FROM b_roster WHERE CAST(id_salarie_brut AS BIGINT) % 10 <> 0
UNION ALL SELECT 'N' || id_salarie_brut, nom, prenom, date_naissance, adresse_dom, mod_depl_decl, bu, sport_declare, type_contrat, date_embauche
FROM b_roster WHERE CAST(id_salarie_brut AS BIGINT) % 10 = 0""",
    "b_act_table": """SELECT id_activite, cle_salarie, date_debut, duree_sec, type_activite, distance_m, commentaire, source_donnee,
  CAST(DATE '2024-02-15' AS TIMESTAMP) AS date_ingestion, id_activite % 5 = 0 AS flag_slack
FROM (SELECT *, row_number() OVER (PARTITION BY cle_salarie, date_debut, source_donnee ORDER BY id_activite) AS rn_t FROM b_activity) WHERE rn_t = 1""",
    "b_act_v2": """SELECT cle_salarie, date_debut, CASE WHEN id_activite % 7 = 0 THEN duree_sec + 60 ELSE duree_sec END AS duree_sec,
  distance_m, type_activite, commentaire, source_donnee FROM b_act_table WHERE id_activite % 10 <> 0
UNION ALL SELECT cle_salarie, date_debut + INTERVAL 1 HOUR, duree_sec, distance_m, type_activite, commentaire, source_donnee
FROM b_act_table WHERE id_activite % 10 = 0""",
}

_NAME = re.compile(r"\b(b_[a-z0-9_]+)\b")


def _needed(sql: str) -> list[str]:
    """Binding CTEs referenced (transitively) by ``sql``, dependency order."""
    want: set[str] = set()
    stack = list(_NAME.findall(sql))
    while stack:
        name = stack.pop()
        if name in BINDINGS and name not in want:
            want.add(name)
            stack.extend(_NAME.findall(BINDINGS[name]))
    return [n for n in BINDINGS if n in want]


def twin(body: str, ctes: list[tuple[str, str]] | None = None) -> str:
    """Prepend the binding CTEs used by ``body`` (and by extra ``ctes``)."""
    extra = ctes or []
    text = body + " ".join(sql for _, sql in extra)
    parts = [f"{n} AS ({BINDINGS[n]})" for n in _needed(text)]
    parts += [f"{n} AS ({sql})" for n, sql in extra]
    if not parts:
        return body
    return "WITH " + ",\n".join(parts) + "\n" + body
