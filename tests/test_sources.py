"""File sources: newest export, typed and tolerant scans, alias headers."""

from __future__ import annotations

import datetime as dt
import os
import time

import pytest

from perkline.session import scratch_path
from perkline.sources import files


def test_latest_by_mtime_and_by_name(spark):
    root = scratch_path(spark, "exports-test")
    for name, rows in (("20240201_decla_sheet.csv", [("b",)]), ("20240101_decla_sheet.csv", [("a",)])):
        files.write_csv(spark.createDataFrame(rows, "Nom string"), os.path.join(root, name))
        time.sleep(1.1)
    for by, nom in (("mtime", "a"), ("name", "b")):
        newest = files.latest_export(spark, os.path.join(root, "*_decla_sheet.csv"), by)
        assert [r[0] for r in files.read_declared(spark, newest, ["Nom"]).select("Nom").collect()] == [nom]
    with pytest.raises(KeyError):
        files.read_declared(spark, os.path.join(root, "*_decla_sheet.csv"), ["Nom", "Prénom"])


def test_all_strings_blank_kept_and_quotes(spark):
    path = scratch_path(spark, "strings-test")
    files.write_csv(spark.createDataFrame([(" x ", "", '"q"', None)], "a string, b string, c string, d string"), path)
    row = files.read_declared(spark, path, ["a", "b", "c", "d"]).first()
    assert (row["a"], row["b"], row["c"], row["d"]) == (" x ", "", '"q"', "")


def test_tolerant_reader_header_and_positional(spark):
    root = scratch_path(spark, "tolerant-test")
    os.makedirs(root)
    with open(os.path.join(root, "with_header.csv"), "w", encoding="utf-8") as f:
        f.write("type_activite,cle_salarie,date_debut,duree_sec,distance_m,commentaire,source_donnee\n")
        f.write('Runing,sal_a,2024-01-05T12:00:00+01:00,1800.0,5000,"""top""",\n')
        f.write("Judo,sal_b,pas une date,600,,,csv_simule\n")
    with open(os.path.join(root, "no_header.csv"), "w", encoding="utf-8") as f:
        f.write("sal_c,2024-01-06T10:00:00Z,12,7,Natation\n")
        f.write(",2024-01-06T10:00:00Z,12,,Natation\n")
        f.write("sal_d,2024-01-06T10:00:00Z,abc,,Natation\n")
    rows, skipped = files.read_activities_tolerant(spark, root)
    got = sorted(tuple(r) for r in rows.collect())
    assert got == [
        ("sal_a", dt.datetime(2024, 1, 5, 11), 1800, 5000, "Runing", '"top"', "csv_gsheet"),
        ("sal_c", dt.datetime(2024, 1, 6, 10), 12, 7, "Natation", "", "csv_gsheet"),
    ]
    assert skipped.count() == 3


def test_roster_alias_mapping(spark):
    df = spark.createDataFrame(
        [(" 7 ", " Doe ", "Ann", "BU1", "CDI", "1990-02-03", "03/04/2015", " 1 rue ", "Marche/running")],
        "`ID salarié` string, NOM string, `Prénom` string, BU string, `Type de contrat` string, `Date de naissance` string, "
        "`Date d'embauche` string, `Adresse domicile` string, `Moyen de déplacement` string",
    )
    r = files.read_roster(df).first()
    assert (r["id_salarie_brut"], r["nom"], r["date_naissance"], r["date_embauche"], r["adresse_dom"]) == (
        "7", "Doe", dt.date(1990, 2, 3), dt.date(2015, 4, 3), "1 rue"
    )
    with pytest.raises(ValueError):
        files.read_roster(df.drop("BU"))
    sport = spark.createDataFrame([(" 7 ", " Judo ")], "`id salarié` string, `Pratique d'un sport` string")
    assert tuple(files.read_declared_sport(sport).first()) == ("7", "Judo")


def test_normalised_output_offsets(spark):
    df = spark.createDataFrame(
        [("s", dt.datetime(2024, 1, 5, 11), 1, None, "Judo", "", "csv_gsheet"), ("s", dt.datetime(2024, 7, 5, 10), 1, 2, "Judo", "", "csv_gsheet")],
        "cle_salarie string, date_debut timestamp_ntz, duree_sec int, distance_m int, type_activite string, commentaire string, source_donnee string",
    )
    out = [r[0] for r in files.normalised_output(df).orderBy("date_debut").select("date_debut").collect()]
    assert out == ["2024-01-05T12:00:00+0100", "2024-07-05T12:00:00+0200"]


def test_cells_with_line_breaks_and_columns_in_any_order(spark):
    root = scratch_path(spark, "line-breaks-test")
    os.makedirs(root)
    with open(os.path.join(root, "a.csv"), "w", encoding="utf-8") as f:
        f.write('extra,source_donnee,commentaire,type_activite,distance_m,duree_sec,date_debut,cle_salarie\n')
        f.write('1,csv_gsheet,"two\nlines, ""quoted""",Judo,,600,2024-01-05T12:00:00Z,sal_a\n')
    rows = files.read_activities(spark, root).collect()
    assert [tuple(r) for r in rows] == [
        ("sal_a", dt.datetime(2024, 1, 5, 12), 600, None, "Judo", 'two\nlines, "quoted"', "csv_gsheet", 0)
    ]
    assert files.read_declared(spark, root, ["commentaire"]).count() == 1
    with open(os.path.join(root, "a.csv"), "w", encoding="utf-8") as f:
        f.write('sal_c,2024-01-06T10:00:00Z,12,7,Natation,"a\nb",\n')
    parsed, skipped = files.read_activities_tolerant(spark, root)
    assert [r["commentaire"] for r in parsed.collect()] == ["a\nb"] and skipped.count() == 0
