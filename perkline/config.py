"""Rule configuration: fixed reference values and run parameters.

Everything here is small driver-side configuration (a few dozen labels and
numbers).  It is turned into literal expressions or tiny DataFrames by the
jobs; no data ever flows through these objects.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# FIXED VALUES — must equal the business reference for identical results.
# Canonical labels, category lists, reason codes, thresholds and bounds.
# ---------------------------------------------------------------------------

TRAVEL_MODES = (
    "Transports en commun",
    "véhicule thermique/électrique",
    "Marche/running",
    "Vélo/Trottinette/Autres",
)

SPORTS = (
    "Randonnée",
    "Triathlon",
    "Runing",
    "Natation",
    "Escalade",
    "Équitation",
    "Voile",
    "Tennis de table",
    "Football",
    "Rugby",
    "Judo",
    "Basketball",
    "Boxe",
    "Tennis",
    "Badminton",
)

ENDURANCE_SPORTS = ("Randonnée", "Triathlon", "Runing", "Natation")

NON_ENDURANCE_SPORTS = (
    "Escalade",
    "Équitation",
    "Voile",
    "Tennis de table",
    "Football",
    "Rugby",
    "Judo",
    "Basketball",
    "Boxe",
    "Tennis",
    "Badminton",
)

# Modes that make an employee a candidate for the commuting bonus.
ACTIVE_MODES = ("Marche/running", "Vélo/Trottinette/Autres")

UNKNOWN = "INCONNU"

# Bonus ineligibility reasons, in priority order (first match wins).
BONUS_REASONS = (
    "salaire_manquant",
    "ctrl_trajet_manquant",
    "ctrl_trajet_exclu",
    "ctrl_trajet_incoherent",
    "mode_inconnu",
    "mode_non_sportif",
)

# Declared-row error reasons, weakest first (a later one overrides).
ERROR_REASONS = ("parsing_invalide", "sport_manquant", "nom_prenom_ambigu", "nom_prenom_inconnu")

# Declared-row anomaly reasons.
ANOMALY_SPORT_NOT_DECLARED = "sport_non_declare"
ANOMALY_SPORT_DIFFERENT = "sport_different"
ANOMALY_NEAR_DUPLICATE = "doublon_quasi_identique_ecarte"
ANOMALY_SEVERAL_PER_DAY = "plusieurs_activites_jour"

# Benefit categories.
CATEGORY_BOTH = "PRIME+BIEN_ETRE"
CATEGORY_BONUS_ONLY = "PRIME_SEULE"
CATEGORY_WELLBEING_ONLY = "BIEN_ETRE_SEUL"
CATEGORY_NONE = "RIEN"

# Age bands (upper bound inclusive; "- de 25" covers every age below 26).
AGE_BANDS = (("- de 25", 25), ("26-35", 35), ("36-45", 45), ("46-55", 55))
AGE_BAND_TOP = "56+"

# Parameter codes.
PARAM_CODES = (
    "adresse_entreprise",
    "taux_prime",
    "seuil_km_marche_course",
    "seuil_km_velo_autres",
    "jours_bien_etre",
    "min_activites_bien_etre",
    "montant_prime_fixe",
)
# Codes the view-level quality suite requires (as published: the fixed
# amount is not in the list, see README "known reference gaps").
REQUIRED_PARAM_CODES = (
    "taux_prime",
    "seuil_km_marche_course",
    "seuil_km_velo_autres",
    "jours_bien_etre",
    "min_activites_bien_etre",
    "adresse_entreprise",
)

# Default commute thresholds in km when no parameter is effective.
DEFAULT_WALK_THRESHOLD_KM = 15
DEFAULT_BIKE_THRESHOLD_KM = 25

# Travel mode -> routing mode; anything else routes as driving.
ROUTING_MODES = (
    ("Marche/running", "walking"),
    ("Vélo/Trottinette/Autres", "bicycling"),
    ("Transports en commun", "transit"),
    ("véhicule thermique/électrique", "driving"),
)

# Data sources of activity rows.
SOURCE_FORM = "csv_gsheet"
SOURCE_SIMULATED = "csv_simule"
SOURCES = (SOURCE_FORM, SOURCE_SIMULATED)
SOURCES_TO_REPLACE = (SOURCE_SIMULATED,)

# Output column order of a normalised activity file.
ACTIVITY_COLUMNS = (
    "cle_salarie",
    "date_debut",
    "duree_sec",
    "distance_m",
    "type_activite",
    "commentaire",
    "source_donnee",
)

# Required columns of a declared-activity form export.
FORM_COLUMNS = (
    "Horodateur",
    "Nom",
    "Prénom",
    "Date",
    "Sport type",
    "Distance parcourue en kms",
    "Durée de l'activité",
)

# Duration bounds in seconds per sport category, distance reference per
# mode (km) and accepted distance ratio.
DURATION_BOUNDS_SEC = {"ENDURANCE": (1200, 10800), "NON_ENDURANCE": (900, 7200)}
DISTANCE_REF_KM = {"marche_running": 15, "velo_trott_autres": 25}
DISTANCE_RATIO = (0.10, 1.00)

# Monthly activity maxima per profile for each volume scenario.
SCENARIO_MONTHLY_RANGES = {
    "pessimiste": {"faible": (0, 1), "moyen": (2, 4), "eleve": (5, 7)},
    "realiste": {"faible": (0, 3), "moyen": (4, 7), "eleve": (8, 12)},
    "optimiste": {"faible": (0, 5), "moyen": (6, 10), "eleve": (11, 16)},
}

# Notification: most recent declared activities shown when forced.
NOTIFY_TOP_K = 10

# Quality thresholds: table row count fails at 0, warns below 100.
MIN_ROWS_WARN = 100

# Key format of a pseudonymised employee.
KEY_PATTERN = r"^sal_[0-9a-f]{12}$"

# Run statuses.
RUN_STATUSES = ("RUNNING", "SUCCESS", "FAILURE")
ERROR_MESSAGE_MAX = 4000

# Alternative parameter sets (what-if cost scenarios): name, rate, fixed amount,
# walk and bike thresholds (km), days granted, minimum of activities.  The first
# three are fixed values, the others change what decides who is eligible.
COST_SCENARIOS = (
    ("initiale", "0.05", "1500", "15", "25", "5", "15"),
    ("simulation_1", "0.04", "1000", "15", "25", "5", "15"),
    ("simulation_2", "0.06", "2000", "15", "25", "5", "15"),
    ("marche_large", "0.05", "1500", "22.5", "25", "5", "15"),
    ("marche_stricte", "0.05", "1500", "0", "25", "5", "15"),
    ("velo_large", "0.05", "1500", "15", "40", "5", "15"),
    ("velo_strict", "0.05", "1500", "15", "9.99", "5", "15"),
    ("jours_doubles", "0.05", "1500", "15", "25", "10", "15"),
    ("minimum_haut", "0.05", "1500", "15", "25", "5", "60"),
    ("minimum_bas", "0.05", "1500", "15", "25", "5", "0"),
    ("tout_change", "0.075", "1800", "18.25", "31.4", "7", "48"),
)

# Values of the scenario grid: every combination is one scenario.
SCENARIO_GRID = {
    "taux_prime": ("0.04", "0.06"),
    "montant_prime_fixe": ("1500",),
    "seuil_km_marche_course": ("2", "5", "8", "11", "14", "17", "20", "23"),
    "seuil_km_velo_autres": ("5", "10", "15", "20", "25", "30", "35", "40"),
    "jours_bien_etre": ("5",),
    "min_activites_bien_etre": ("1", "10", "20", "30", "40", "50", "60", "80"),
}

# ---------------------------------------------------------------------------
# Run parameters (not reference values: they describe one run).
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class RunConfig:
    """Explicit as-of date and zone; results never depend on the clock."""

    as_of: dt.date = dt.date(2024, 2, 15)
    zone: str = "Europe/Paris"
    window_months: int = 12
    include_current_month: bool = False
    salt: str = "salt"
    scenario: str = "realiste"
    extra: dict = field(default_factory=dict)

    def period(self) -> tuple[dt.date, dt.date]:
        """Rolling activity window [start, end] at the as-of date.

        Default: the ``window_months`` complete months before the as-of
        month.  With ``include_current_month`` the window ends at the as-of
        date and starts ``window_months - 1`` months before its month start.
        """
        month_start = self.as_of.replace(day=1)
        if self.include_current_month:
            return _add_months(month_start, -(self.window_months - 1)), self.as_of
        return _add_months(month_start, -self.window_months), month_start - dt.timedelta(days=1)


def _add_months(day: dt.date, months: int) -> dt.date:
    index = day.year * 12 + (day.month - 1) + months
    return dt.date(index // 12, index % 12 + 1, 1)


DEFAULT_RUN = RunConfig()

# ---------------------------------------------------------------------------
# FIXED VALUES — accepted header aliases of the HR export (case-insensitive,
# trimmed), per canonical column, in priority order.
# ---------------------------------------------------------------------------
ROSTER_ALIASES = {
    "id_salarie_brut": ("ID salarié", "id salarié", "id_salarié", "id_salarie", "ID salarié brut", "id salarié brut", "id_salarie_brut"),
    "nom": ("nom",),
    "prenom": ("prenom", "prénom"),
    "bu": ("bu",),
    "type_contrat": ("type_contrat", "type contrat", "type_de_contrat", "type de contrat"),
    "date_naissance": ("date_naissance", "date de naissance"),
    "date_embauche": ("date_embauche", "date embauche", "date_d_embauche", "date d'embauche", "date dembauche"),
    "adresse_dom": ("adresse_dom", "adresse_domicile", "adresse domicile", "adresse du domicile"),
    "mod_depl_decl": ("mod_depl_decl", "moyen_de_deplacement", "moyen de déplacement"),
}
ROSTER_DATE_COLUMNS = ("date_naissance", "date_embauche")
SPORT_ID_ALIASES = ("id_salarie", "id salarié", "id salarié")
SPORT_VALUE_ALIASES = ("sport", "sport_declare", "sport déclaré", "sport declare", "Pratique d'un sport")
ACTIVITY_HEADER_REQUIRED = ("cle_salarie", "date_debut", "duree_sec", "distance_m", "type_activite")

# Flat parameter mapping of a parameter file (new values to synchronise);
# rates and thresholds as configured for the initial run.
PARAM_MAPPING = (
    ("adresse_entreprise", "1 rue Exemple"),
    ("taux_prime", "0.05"),
    ("seuil_km_marche_course", "15"),
    ("seuil_km_velo_autres", "25"),
    ("jours_bien_etre", "5"),
    ("min_activites_bien_etre", "15"),
    ("montant_prime_fixe", "1500"),
)
