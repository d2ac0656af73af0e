"""File-source queries (S1-S7, M13): exports written by Spark from the
bound tables under the shared checkpoint folder, then scanned back."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from perkline.config import DEFAULT_RUN, FORM_COLUMNS
from perkline.plans import ingest
from perkline.queries import register
from perkline.queries.ingest_q import it
from perkline.session import scratch_path
from perkline.sources import files
from perkline.sources.tables import Tables
from perkline.twins import twin

RUN = DEFAULT_RUN
FORM_HEADER = (*FORM_COLUMNS, "Commentaire")
BINDING_COLS = ("horodateur", "nom", "prenom", "date_txt", "sport", "distance_txt", "duree_txt", "commentaire")
# Exports of the form sheet: (folder name, last day included), in the order
# they are written — the newest *name* is written first, so the newest file
# by modification time is another export than the newest by name.
EXPORTS = (
    ("20240131T090000_decla_sheet.csv", None),
    ("20240110T090000_decla_sheet.csv", "2024-01-11"),
    ("20240120T090000_decla_sheet.csv", "2024-01-21"),
)


def T(spark, sf_dir) -> Tables:
    return Tables.of(spark, sf_dir, RUN)


def write_form_exports(spark, sf_dir) -> str:
    """Three cumulative exports of the declared rows (reference headers)."""
    root = scratch_path(spark, "form-exports")
    d = T(spark, sf_dir).declared()
    sheet = d.select(*[F.col(b).alias(h) for b, h in zip(BINDING_COLS, FORM_HEADER)])
    for name, before in EXPORTS:
        part = sheet if before is None else sheet.filter(F.col("Horodateur") < F.lit(before))
        files.write_csv(part, os.path.join(root, name))
    return root


def _sheet_twin(where: str = "") -> str:
    cols = ", ".join(f'{b} AS "{h}"' for b, h in zip(BINDING_COLS, FORM_HEADER))
    return twin(f"SELECT {cols} FROM b_declared {where}")


@register("latest_file_mtime", _sheet_twin("WHERE horodateur < '2024-01-21'"))
def q_latest_file_mtime(spark, sf_dir):
    """Rows of the export modified last."""
    root = write_form_exports(spark, sf_dir)
    newest = files.latest_export(spark, os.path.join(root, "*_decla_sheet.csv"), by="mtime")
    return files.read_declared(spark, newest, FORM_COLUMNS).select(*FORM_HEADER)


@register("latest_file_name", _sheet_twin())
def q_latest_file_name(spark, sf_dir):
    """Rows of the export with the greatest (timestamp-prefixed) name."""
    root = write_form_exports(spark, sf_dir)
    newest = files.latest_export(spark, os.path.join(root, "*_decla_sheet.csv"), by="name")
    return files.read_declared(spark, newest, FORM_COLUMNS).select(*FORM_HEADER)


@register("read_declared", _sheet_twin())
def q_read_declared(spark, sf_dir):
    """S3: all-string scan of an export with the required-column check."""
    d = T(spark, sf_dir).declared()
    path = scratch_path(spark, "form-export")
    files.write_csv(d.select(*[F.col(b).alias(h) for b, h in zip(BINDING_COLS, FORM_HEADER)]), path)
    return files.read_declared(spark, path, FORM_COLUMNS).select(*FORM_HEADER)


def _clean(spark, sf_dir):
    t = T(spark, sf_dir)
    return ingest.normalised(t, RUN).clean


ISO_SQL = (
    "strftime(timezone('Europe/Paris', date_parsed AT TIME ZONE 'UTC'), '%Y-%m-%dT%H:%M:%S') || "
    "CASE WHEN date_diff('minute', date_parsed, timezone('Europe/Paris', date_parsed AT TIME ZONE 'UTC')) < 0 THEN '-' ELSE '+' END || "
    "lpad(CAST(abs(date_diff('minute', date_parsed, timezone('Europe/Paris', date_parsed AT TIME ZONE 'UTC'))) // 60 AS VARCHAR), 2, '0') || "
    "lpad(CAST(abs(date_diff('minute', date_parsed, timezone('Europe/Paris', date_parsed AT TIME ZONE 'UTC'))) % 60 AS VARCHAR), 2, '0')"
)


@register(
    "normalised_output",
    it(
        f"SELECT cle_salarie, {ISO_SQL} AS date_debut, duree_sec, distance_m, sport AS type_activite, commentaire_out AS commentaire, "
        "'csv_gsheet' AS source_donnee FROM x_day WHERE rn2 = 1"
    ),
)
def q_normalised_output(spark, sf_dir):
    """Normalised rows, fixed column order, ISO instant with offset."""
    return files.normalised_output(_clean(spark, sf_dir), RUN.zone)


@register(
    "read_activities",
    it(
        "SELECT cle_salarie, date_parsed AS date_debut, CASE WHEN ligne % 13 <> 5 THEN duree_sec END AS duree_sec, distance_m, sport AS type_activite, "
        "commentaire_out AS commentaire, 'csv_gsheet' AS source_donnee, CAST(ligne % 13 = 5 AS INTEGER) AS nb_nombres_invalides FROM x_day WHERE rn2 = 1"
    ),
)
def q_read_activities(spark, sf_dir):
    """Typed scan of a normalised activity file written by M13, in which
    some numbers stand as decimal text and some cells hold none."""
    path = scratch_path(spark, "normalised")
    clean = _clean(spark, sf_dir)
    duration = F.col("duree_sec").cast("string")
    as_text = F.when(F.col("ligne") % 13 == 5, F.lit("1h30")).when(F.col("ligne") % 3 == 0, F.concat(duration, F.lit(".0"))).otherwise(duration)
    files.write_csv(files.normalised_output(clean.withColumn("duree_sec", as_text), RUN.zone), path)
    return files.read_activities(spark, path)


_TOLERANT = (
    "SELECT cle_salarie, date_parsed AS date_debut, CAST(duree_sec AS BIGINT) AS duree_sec, CAST(distance_m AS BIGINT) AS distance_m, "
    "sport AS type_activite, CASE WHEN ligne % 9 <> 4 THEN commentaire_out ELSE '' END AS commentaire, 'csv_gsheet' AS source_donnee "
    "FROM x_day WHERE rn2 = 1 AND ligne % 50 <> 0 AND ligne % 31 <> 7 AND ligne % 29 <> 3"
)


def _odd_file(spark, sf_dir) -> str:
    """A headerless export by hand: some dates cannot be read, some records
    end after five cells, some after two, and some have nine."""
    clean = _clean(spark, sf_dir).withColumn("_iso", files.iso_offset_text("date_debut", RUN.zone))
    date = F.when(F.col("ligne") % 50 == 0, F.lit("pas une date")).otherwise(F.col("_iso"))
    comment = F.concat(F.lit('"'), F.replace("commentaire", F.lit('"'), F.lit('""')), F.lit('"'))
    head = [F.col("cle_salarie"), date]
    five = [*head, F.col("duree_sec").cast("string"), F.coalesce(F.col("distance_m").cast("string"), F.lit("")), F.col("type_activite")]
    line = (
        F.when(F.col("ligne") % 29 == 3, F.concat_ws(",", *head))
        .when(F.col("ligne") % 31 == 7, F.concat_ws(",", *five, comment, "source_donnee", F.lit("huit"), F.lit('"neuf, neuf"')))
        .when(F.col("ligne") % 9 == 4, F.concat_ws(",", *five))
        .otherwise(F.concat_ws(",", *five, comment, "source_donnee"))
    )
    path = scratch_path(spark, "tolerant")
    clean.select(line.alias("value")).write.text(path)
    return path


@register("read_activities_tolerant", it(_TOLERANT))
def q_read_activities_tolerant(spark, sf_dir):
    """Headerless file with unreadable dates, short and long records; bad
    records are skipped."""
    return files.read_activities_tolerant(spark, _odd_file(spark, sf_dir))[0]


@register(
    "read_activities_skipped",
    it(
        f"SELECT CASE WHEN ligne % 29 = 3 THEN cle_salarie || ',' || d ELSE cle_salarie || ',' || d || ',' || duree_sec || ',' || "
        "coalesce(CAST(distance_m AS VARCHAR), '') || ',' || sport || CASE WHEN ligne % 31 <> 7 AND ligne % 9 = 4 THEN '' ELSE "
        "',\"' || replace(commentaire_out, '\"', '\"\"') || '\",csv_gsheet' END || CASE WHEN ligne % 31 = 7 THEN ',huit,\"neuf, neuf\"' ELSE '' END END "
        f"AS ligne_ignoree FROM (SELECT *, CASE WHEN ligne % 50 = 0 THEN 'pas une date' ELSE {ISO_SQL} END AS d FROM x_day WHERE rn2 = 1) "
        "WHERE ligne % 31 = 7 OR ligne % 29 = 3"
    ),
)
def q_read_activities_skipped(spark, sf_dir):
    """The short and long records that the tolerant scan skips, whole."""
    skipped = files.read_activities_tolerant(spark, _odd_file(spark, sf_dir))[1]
    cells = F.size(F.split("ligne_ignoree", ","))
    return skipped.where((cells == 2) | F.col("ligne_ignoree").endswith(',huit,"neuf, neuf"'))


ROSTER_HEADERS = (
    ("id_salarie_brut", "ID salarié"),
    ("nom", "NOM"),
    ("prenom", "Prénom"),
    ("bu", "BU"),
    ("type_contrat", "Type de contrat"),
    ("date_naissance", "Date de naissance"),
    ("date_embauche", "Date d'embauche"),
    ("adresse_dom", "Adresse domicile"),
    ("mod_depl_decl", "Moyen de déplacement"),
)


@register(
    "read_roster",
    twin(
        "SELECT " + ", ".join(
            f"CASE WHEN length(trim({c})) > 0 THEN trim({c}) END AS {c}"
            for c in ("id_salarie_brut", "nom", "prenom", "bu")
        )
        + ", CAST(NULL AS VARCHAR) AS type_contrat, date_naissance, CAST(NULL AS DATE) AS date_embauche, "
        "CASE WHEN length(trim(adresse_dom)) > 0 THEN trim(adresse_dom) END AS adresse_dom, "
        "CASE WHEN length(trim(mod_depl_decl)) > 0 THEN trim(mod_depl_decl) END AS mod_depl_decl FROM b_roster"
    ),
)
def q_read_roster(spark, sf_dir):
    """HR export with alias headers -> canonical columns."""
    r = T(spark, sf_dir).roster()
    sheet = r.select(
        *[
            (F.lit(None).cast("string") if c in ("type_contrat", "date_embauche") else F.col(c).cast("string")).alias(h)
            for c, h in ROSTER_HEADERS
        ]
    )
    path = scratch_path(spark, "roster-export")
    files.write_csv(sheet, path)
    raw = files.read_declared(spark, path, [h for _, h in ROSTER_HEADERS]).drop("_fichier", "_mtime", "_chemin")
    out = files.read_roster(raw)
    return out.select(
        *[
            F.when(F.length(F.col(c)) > 0, F.col(c)).alias(c) if c not in ("date_naissance", "date_embauche") else F.col(c)
            for c in out.columns
        ]
    )


@register(
    "read_declared_sport",
    twin("SELECT trim(id_salarie_brut) AS id_salarie_brut, coalesce(trim(sport_declare), '') AS sport_declare FROM b_sport_ref"),
)
def q_read_declared_sport(spark, sf_dir):
    """Declared-sport sheet with soft column names."""
    s = T(spark, sf_dir).sport_reference()
    sheet = s.select(F.col("id_salarie_brut").alias("ID salarié"), F.col("sport_declare").alias("Pratique d'un sport"))
    path = scratch_path(spark, "sport-export")
    files.write_csv(sheet, path)
    raw = files.read_declared(spark, path, ["ID salarié", "Pratique d'un sport"]).drop("_fichier", "_mtime", "_chemin")
    return files.read_declared_sport(raw)
