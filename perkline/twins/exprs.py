"""SQL text helpers for the DuckDB twins (same fixed lists as the jobs)."""

from __future__ import annotations

from perkline.config import ENDURANCE_SPORTS, NON_ENDURANCE_SPORTS, UNKNOWN
from perkline.functions.text import fold_literal

WS = "[\\s\\x{00A0}]+"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def fold(col: str) -> str:
    return f"lower(regexp_replace(trim({col}), '{WS}', ' ', 'g'))"


def in_list(labels) -> str:
    return ", ".join(q(fold_literal(x)) for x in labels)


def canonical(col: str, labels, out: str, flag: str) -> str:
    whens = " ".join(f"WHEN {fold(col)} = {q(fold_literal(c))} THEN {q(c)}" for c in labels)
    return (
        f"CASE WHEN {col} IS NULL OR trim({col}) = '' THEN '{UNKNOWN}' {whens} ELSE '{UNKNOWN}' END AS {out}, "
        f"({col} IS NOT NULL AND trim({col}) <> '' AND {fold(col)} NOT IN ({in_list(labels)})) AS {flag}"
    )


def age_band(birth: str, day: str) -> str:
    """Twin of P17, from the same bands as the job."""
    from perkline.config import AGE_BAND_TOP, AGE_BANDS

    age = f"date_part('year', age({day}, {birth}))"
    bands = " ".join(f"WHEN {age} <= {upper} THEN {q(label)}" for label, upper in AGE_BANDS)
    return f"CASE WHEN {birth} IS NULL THEN '{UNKNOWN}' {bands} ELSE {q(AGE_BAND_TOP)} END"


def category(label: str, unknown: str) -> str:
    e, n = in_list(ENDURANCE_SPORTS), in_list(NON_ENDURANCE_SPORTS)
    return (
        f"CASE WHEN {unknown} THEN '{UNKNOWN}' WHEN {fold(label)} IN ({e}) THEN 'ENDURANCE' "
        f"WHEN {fold(label)} IN ({n}) THEN 'NON_ENDURANCE' ELSE '{UNKNOWN}' END AS categorie_activite_normalise, "
        f"(NOT {unknown} AND {fold(label)} NOT IN ({e}) AND {fold(label)} NOT IN ({n})) AS categorie_activite_inconnu"
    )


def minutes(col: str) -> str:
    return f"CAST(round(CAST({col} AS DECIMAL(18,3)) / 60, 3) AS DECIMAL(18,3))"


def km(col: str) -> str:
    return f"CAST(round(CAST({col} AS DECIMAL(18,3)) / 1000, 3) AS DECIMAL(18,3))"


def money(expr: str) -> str:
    return f"CAST(round({expr}, 2) AS DECIMAL(18,2))"


def local_day(col: str, zone: str = "Europe/Paris") -> str:
    return f"CAST(({col} AT TIME ZONE 'UTC') AT TIME ZONE '{zone}' AS DATE)"


def normalise_text(col: str) -> str:
    """Twin of F1: strip, lower, drop accents; NULL -> ''.  DuckDB folds no
    compatibility forms, so those of the fixture are replaced."""
    text = f"lower(regexp_replace(coalesce(CAST({col} AS VARCHAR), ''), '^{WS}|{WS}$', '', 'g'))"
    return f"strip_accents(replace(replace({text}, chr(65359), 'o'), chr(64262), 'st'))"


def strip_quotes(col: str) -> str:
    return f"regexp_replace(regexp_replace(coalesce({col}, ''), '^{WS}|{WS}$', '', 'g'), '^\"+|\"+$', '', 'g')"


def pseudonym(col: str, salt: str = "salt") -> str:
    return f"'sal_' || substring(sha256({q(salt + '|')} || CAST({col} AS VARCHAR)), 1, 12)"
