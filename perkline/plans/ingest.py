"""Declared-activity normalisation (K1) and the dedup rules it uses.

One lazy plan produces three outputs: clean rows, blocking errors and
anomalies.  Nothing is kept; a run that needs all three writes each once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perkline.config import (
    ANOMALY_NEAR_DUPLICATE,
    ANOMALY_SEVERAL_PER_DAY,
    ANOMALY_SPORT_DIFFERENT,
    ANOMALY_SPORT_NOT_DECLARED,
    ERROR_REASONS,
    NON_ENDURANCE_SPORTS,
    SOURCE_FORM,
    RunConfig,
)
from perkline.functions.dates import local_day
from perkline.functions.parse import parse_distance, parse_duration, parse_local_noon
from perkline.functions.text import normalise_text, pseudonym, quote_comment, strip_quotes
from perkline.operators.dedup import keep_one_per_group, split_one_per_group, with_group_size
from perkline.plans.history import observed
from perkline.session import materialise

DECLARED_COLUMNS = ("horodateur", "nom", "prenom", "date_txt", "sport", "distance_txt", "duree_txt")


def name_reference(ref: DataFrame) -> DataFrame:
    """HR names with normalised columns and the ambiguity flag
    (same normalised name on more than one row)."""
    base = ref.select(
        F.trim("id_salarie_brut").alias("id_salarie_brut"),
        "nom",
        "prenom",
        normalise_text("nom").alias("nom_norm"),
        normalise_text("prenom").alias("prenom_norm"),
    )
    sized = with_group_size(base, ["nom_norm", "prenom_norm"], "_n")
    return sized.withColumn("ambigu", F.col("_n") > 1).drop("_n")


def sport_reference(ref: DataFrame) -> DataFrame:
    """Declared-sport reference, trimmed, first row per id (input order
    given by ``ligne``)."""
    trimmed = ref.select(
        F.trim("id_salarie_brut").alias("id_salarie_brut"), F.trim("sport_declare").alias("sport_declare"), "ligne"
    )
    return keep_one_per_group(trimmed, ["id_salarie_brut"], order=[("ligne", "asc")])


def near_duplicate_key() -> F.Column:
    """Six-part key of a declared row (normalised names, raw date, normalised
    sport, raw duration, raw distance)."""
    return F.concat_ws(
        "|",
        F.col("nom_norm"),
        F.col("prenom_norm"),
        F.col("date_txt"),
        normalise_text("sport"),
        F.col("duree_txt"),
        F.col("distance_txt"),
    )


def prepare_declared(declared: DataFrame, zone: str) -> DataFrame:
    """F10 + F1 + F6-F9 on the raw form rows (everything still text)."""
    cleaned = declared.select(
        "ligne",
        *[strip_quotes(c).alias(c) for c in DECLARED_COLUMNS],
        F.coalesce(F.col("commentaire"), F.lit("")).alias("commentaire_brut"),
    )
    return cleaned.select(
        "*",
        normalise_text("nom").alias("nom_norm"),
        normalise_text("prenom").alias("prenom_norm"),
        parse_local_noon("date_txt", zone).alias("date_parsed"),
        parse_duration("duree_txt").alias("duree_sec"),
        parse_distance("distance_txt").alias("distance_m"),
        quote_comment("commentaire_brut").alias("commentaire_out"),
    )


def match_by_name(prepared: DataFrame, names: DataFrame) -> DataFrame:
    """Left join on the normalised name pair; ``rh_trouve`` marks a match.
    An ambiguous name matches (and is counted) once per HR row (T15)."""
    ref = names.select(
        F.col("nom_norm").alias("_rn"),
        F.col("prenom_norm").alias("_rp"),
        "id_salarie_brut",
        "ambigu",
        F.lit(True).alias("rh_trouve"),
    )
    j = prepared.join(ref, (F.col("nom_norm") == F.col("_rn")) & (F.col("prenom_norm") == F.col("_rp")), "left")
    return j.drop("_rn", "_rp").withColumn("rh_trouve", F.coalesce("rh_trouve", F.lit(False)))


#: tasks over which the declared rows of one name spread
NAME_SALTS = 8


def match_counted(prepared: DataFrame, names: DataFrame) -> DataFrame:
    """As :func:`match_by_name`, without pairing an ambiguous name's rows.

    The HR rows of a name are counted first, so a declared row meets one row
    and is repeated as often as the name occurs (T15); who it is stays open
    (NULL) then.  The counted names are dealt under salts, over which a name
    with very many declared rows spreads.
    """
    ref = (
        names.groupBy(F.col("nom_norm").alias("_rn"), F.col("prenom_norm").alias("_rp"))
        .agg(F.count(F.lit(1)).alias("_n"), F.min("id_salarie_brut").alias("_id"))
        .select("*", F.explode(F.array(*[F.lit(i).cast("long") for i in range(NAME_SALTS)])).alias("_rs"))
    )
    rows = prepared.withColumn("_salt", F.pmod(F.xxhash64("ligne"), F.lit(NAME_SALTS)))
    on = (F.col("nom_norm") == F.col("_rn")) & (F.col("prenom_norm") == F.col("_rp")) & (F.col("_salt") == F.col("_rs"))
    j = rows.join(ref, on, "left")
    times = F.sequence(F.lit(1).cast("long"), F.coalesce("_n", F.lit(1).cast("long")))
    return (
        j.withColumn("_time", F.explode(times))
        .withColumn("id_salarie_brut", F.when(F.col("_n") == 1, F.col("_id")))
        .withColumn("ambigu", F.col("_n") > 1)
        .withColumn("rh_trouve", F.col("_n").isNotNull())
        .withColumn("premiere", F.col("_time") == 1)
        .drop("_rn", "_rp", "_n", "_id", "_rs", "_salt", "_time")
    )


def classify_declared(declared: DataFrame, names: DataFrame, sports: DataFrame, run: RunConfig) -> DataFrame:
    """Prepared rows + HR match + declared sport + error reason."""
    prepared = prepare_declared(declared, run.zone)
    normalised = names.select(
        F.trim("id_salarie_brut").alias("id_salarie_brut"), normalise_text("nom").alias("nom_norm"), normalise_text("prenom").alias("prenom_norm")
    )
    matched = match_counted(prepared, normalised)
    sp = sport_reference(sports).select(F.col("id_salarie_brut").alias("_sid"), "sport_declare")
    j = matched.join(sp, F.col("id_salarie_brut") == F.col("_sid"), "left").drop("_sid")
    parsing = (
        F.col("date_parsed").isNull()
        | F.col("duree_sec").isNull()
        | ((F.col("distance_txt") != "") & F.col("distance_m").isNull())
    )
    e = ERROR_REASONS
    reason = (
        F.when(~F.col("rh_trouve"), F.lit(e[3]))
        .when(F.col("ambigu") == F.lit(True), F.lit(e[2]))
        .when(F.col("sport") == "", F.lit(e[1]))
        .when(parsing, F.lit(e[0]))
    )
    return j.withColumn("err_raison", reason)


#: what the later steps need of a valid row: the declared cells and what was
#: parsed from them
KEPT_COLUMNS = [
    *dict.fromkeys([*(c for c in DECLARED_COLUMNS if c != "horodateur"), "ligne", "cle_salarie", "date_parsed", "duree_sec", "distance_m", "commentaire_out"])
]


@dataclass
class NormalisedDeclared:
    clean: DataFrame
    errors: DataFrame
    anomalies: DataFrame
    classified: DataFrame
    n_read: int | None = None  # declared lines, where they were staged


def normalise_declared(
    declared: DataFrame, names: DataFrame, sports: DataFrame, run: RunConfig, staged: bool = False
) -> NormalisedDeclared:
    """K1: declared rows -> (clean, errors, anomalies).  The anomalies alone
    read the classified rows five times: with ``staged`` they are written once
    and read back, for a caller that wants more than the clean rows or the
    errors.

    Dedup rules (stated, deterministic):
    * near-identical rows (same six-part key) keep the greatest timestamp
      text, ties -> greatest input line;
    * one activity per employee and local day keeps the latest start
      instant, ties -> greatest near-duplicate key, then input line.
    """
    classified = classify_declared(declared, names, sports, run)
    n_read = None
    if staged:
        watched, seen = observed(classified, "declared", lines=F.count_if("premiere"))
        classified = materialise(watched, "declared-classified")
        n_read = seen()["lines"]
    errors = classified.filter(F.col("err_raison").isNotNull()).select(
        *DECLARED_COLUMNS, F.col("err_raison").alias("raison"), "ligne"
    )
    valid = classified.filter(F.col("err_raison").isNull())
    # No distance for non-endurance sports
    valid = valid.withColumn(
        "distance_m", F.when(F.col("sport").isin(list(NON_ENDURANCE_SPORTS)), F.lit(None).cast("int")).otherwise(F.col("distance_m"))
    )
    # Sport anomalies (rows stay valid)
    typed = normalise_text("sport")
    decl = normalise_text(F.coalesce(F.col("sport_declare"), F.lit("")))
    ano = F.when(decl == "", F.lit(ANOMALY_SPORT_NOT_DECLARED)).when(decl != typed, F.lit(ANOMALY_SPORT_DIFFERENT))
    valid = valid.withColumn("ano_raison", ano).withColumn("cle_salarie", pseudonym("id_salarie_brut", run.salt))
    valid = valid.withColumn("_key_dedup", near_duplicate_key())
    anos_sport = valid.filter(F.col("ano_raison").isNotNull())
    # the kept rows are picked by an aggregate alone; only the discarded ones
    # need the winners joined back.  W6: near-identical rows
    order = [("horodateur", "desc"), ("ligne", "desc")]
    unique = keep_one_per_group(valid.select(*KEPT_COLUMNS, "_key_dedup", "horodateur"), ["_key_dedup"], order)
    _, near_dup = split_one_per_group(valid, ["_key_dedup"], order, "ligne")
    # One per employee and local day
    unique = unique.withColumn("date_debut", F.col("date_parsed")).withColumn("_jour", local_day("date_parsed", run.zone))
    day, order = ["cle_salarie", "_jour"], [("date_debut", "desc"), ("_key_dedup", "desc"), ("ligne", "desc")]
    final = keep_one_per_group(unique, day, order)
    _, day_dup = split_one_per_group(unique, day, order, "ligne")
    anomalies = (
        anos_sport.select(F.col("ano_raison").alias("raison"), *DECLARED_COLUMNS, "ligne")
        .unionByName(near_dup.select(F.lit(ANOMALY_NEAR_DUPLICATE).alias("raison"), *DECLARED_COLUMNS, "ligne"))
        .unionByName(day_dup.select(F.lit(ANOMALY_SEVERAL_PER_DAY).alias("raison"), *DECLARED_COLUMNS, "ligne"))
    )
    clean = final.select(
        "cle_salarie",
        "date_debut",
        "duree_sec",
        "distance_m",
        F.col("sport").alias("type_activite"),
        F.col("commentaire_out").alias("commentaire"),
        F.lit(SOURCE_FORM).alias("source_donnee"),
        "ligne",
    )
    return NormalisedDeclared(clean, errors, anomalies, classified, n_read)


# ---------------------------------------------------------------------------
# Stand-alone dedup operators on activity rows
# ---------------------------------------------------------------------------
def dedup_daily(
    activities: DataFrame,
    keep: str = "latest",
    order: str = "date_debut",
    tiebreak: str = "id_activite",
    zone: str = "Europe/Paris",
    reason: str = ANOMALY_SEVERAL_PER_DAY,
) -> tuple[DataFrame, DataFrame]:
    """At most one activity per (employee, local day).

    ``keep="latest"``: greatest ``order`` value, ties -> greatest
    ``tiebreak``.  ``keep="first"``: smallest ``tiebreak`` (the explicit
    input-order column).  Returns (kept, rejected with ``raison`` first).
    """
    day = activities.withColumn("_jour", local_day("date_debut", zone))
    if keep == "latest":
        ordering = [(order, "desc"), (tiebreak, "desc")]
    elif keep == "first":
        ordering = [(tiebreak, "asc")]
    else:
        raise ValueError("keep must be 'latest' or 'first'")
    kept, rejected = split_one_per_group(day, ["cle_salarie", "_jour"], ordering, tiebreak)
    cols = activities.columns
    return kept.select(*cols), rejected.select(F.lit(reason).alias("raison"), *cols)


def daily_conflicts(activities: DataFrame, zone: str = "Europe/Paris") -> DataFrame:
    """Every activity sharing (employee, local day) with another one."""
    day = activities.withColumn("jour_local", local_day("date_debut", zone))
    sized = with_group_size(day, ["cle_salarie", "jour_local"], "nb_activites_jour")
    return sized.filter(F.col("nb_activites_jour") > 1)


def normalised(tables, run: RunConfig, staged: bool = False) -> NormalisedDeclared:
    """K1 over the bound tables."""
    return normalise_declared(tables.declared(), tables.name_reference(), tables.sport_reference(), run, staged)
