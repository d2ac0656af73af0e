"""Scalar functions on the hand-built edge rows (FIXTURES part C)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from perkline.functions import dates, display, parse, text
from perkline.operators import labels
from perkline.config import SPORTS, TRAVEL_MODES


def one(spark, expr, value, typ="string"):
    return spark.createDataFrame([(value,)], f"x {typ}").select(expr.alias("y")).first()["y"]


def test_local_day_across_midnight_and_clock_changes(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 23, 30),), (dt.datetime(2024, 3, 31, 0, 30),), (dt.datetime(2024, 10, 27, 0, 30),),
         (dt.datetime(2024, 3, 30, 22, 59),), (dt.datetime(2024, 10, 26, 21, 59),), (dt.datetime(2024, 10, 26, 22, 0),)],
        "ts timestamp_ntz",
    )
    got = [r[0] for r in df.select(dates.local_day("ts")).collect()]
    assert got == [dt.date(2024, 1, 2), dt.date(2024, 3, 31), dt.date(2024, 10, 27), dt.date(2024, 3, 30),
                   dt.date(2024, 10, 26), dt.date(2024, 10, 27)]


def test_age_completed_years(spark):
    df = spark.createDataFrame(
        [(dt.date(1996, 2, 29),), (dt.date(1996, 2, 28),), (None,)], "b date"
    )
    got = [r[0] for r in df.select(dates.age_years("b", F.lit(dt.date(2021, 2, 28)))).collect()]
    assert got == [24, 25, None]
    got = one(spark, dates.age_years("x", F.lit(dt.date(2021, 3, 1))), dt.date(1996, 2, 29), "date")
    assert got == 25


def test_age_band_limits(spark):
    df = spark.createDataFrame([(a,) for a in (None, 0, 25, 26, 35, 36, 45, 46, 55, 56, 90)], "a int")
    got = [r[0] for r in df.select(dates.age_band("a")).collect()]
    assert got == ["INCONNU", "- de 25", "- de 25", "26-35", "26-35", "36-45", "36-45", "46-55", "46-55", "56+", "56+"]


def test_canonical_label_blank_null_nbsp_case_accents_unknown(spark):
    vals = [None, "", "   ", "Tennis de  table", "  RUNING ", "équitation", "ÉQUITATION", "Curling"]
    df = spark.createDataFrame([(v,) for v in vals], "x string")
    lab, unk = labels.canonical_label("x", SPORTS)
    got = [tuple(r) for r in df.select(lab, unk).collect()]
    assert got == [
        ("INCONNU", False),
        ("INCONNU", False),
        ("INCONNU", False),
        ("Tennis de table", False),
        ("Runing", False),
        ("Équitation", False),
        ("Équitation", False),
        ("INCONNU", True),
    ]


def test_mode_label_and_category(spark):
    df = spark.createDataFrame([(" VÉLO/trottinette/autres ",), ("Hoverboard",), (None,)], "x string")
    lab, unk = labels.canonical_label("x", TRAVEL_MODES)
    assert [tuple(r) for r in df.select(lab, unk).collect()] == [
        ("Vélo/Trottinette/Autres", False),
        ("INCONNU", True),
        ("INCONNU", False),
    ]
    cat = spark.createDataFrame([("Randonnée", False), ("Tennis", False), ("INCONNU", True), ("INCONNU", False)], "l string, u boolean")
    c, cu = labels.activity_category("l", "u")
    assert [tuple(r) for r in cat.select(c, cu).collect()] == [
        ("ENDURANCE", False),
        ("NON_ENDURANCE", False),
        ("INCONNU", False),
        ("INCONNU", True),  # blank sport: label INCONNU but flag false -> category unknown (T8)
    ]


def test_duration_parse(spark):
    vals = ["1:2:3", "00:90:00", "25:00:00", "1h30", "", '"00:10:00"', None]
    df = spark.createDataFrame([(v,) for v in vals], "x string")
    got = [r[0] for r in df.select(parse.parse_duration("x")).collect()]
    assert got == [3723, 5400, 90000, None, None, 600, None]


def test_distance_parse(spark):
    vals = ["12,5", "12.5", "0", "-1", "abc", "", "0,0005", "0,0015", None]
    df = spark.createDataFrame([(v,) for v in vals], "x string")
    got = [r[0] for r in df.select(parse.parse_distance("x")).collect()]
    assert got == [12500, 12500, 0, None, None, None, 0, 2, None]


def test_local_noon_dates(spark):
    vals = ["5/3/2024", "05/03/2024", "31/02/2024", "", '"01/07/2024"']
    df = spark.createDataFrame([(v,) for v in vals], "x string")
    got = [r[0] for r in df.select(parse.parse_local_noon("x")).collect()]
    assert got == [dt.datetime(2024, 3, 5, 11), dt.datetime(2024, 3, 5, 11), None, None, dt.datetime(2024, 7, 1, 10)]


def test_normalise_text_and_pseudonym(spark):
    assert one(spark, text.normalise_text("x"), "  Élodie ") == "elodie"
    assert one(spark, text.normalise_text("x"), None) == ""
    import hashlib

    expected = "sal_" + hashlib.sha256(b"salt|42").hexdigest()[:12]
    assert one(spark, text.pseudonym("x", "salt"), "42") == expected
    assert one(spark, text.valid_key("x"), expected) is True
    assert one(spark, text.valid_key("x"), "sal_XYZ") is False


def test_quote_comment(spark):
    assert one(spark, text.quote_comment("x"), '  "bien"  ') == '"bien"'
    assert one(spark, text.quote_comment("x"), "") == ""
    assert one(spark, text.quote_comment("x"), None) == ""


def test_int_like_and_iso(spark):
    df = spark.createDataFrame([("12.0",), ("12,7",), (" 3 ",), ("",), ("x",)], "x string")
    assert [r[0] for r in df.select(parse.parse_int_like("x")).collect()] == [12, 12, 3, None, None]
    df = spark.createDataFrame([("2024-01-05T12:00:00+01:00",), ("2024-01-05T11:00:00Z",), ("2024-01-05T11:00:00",), ("",)], "x string")
    got = [r[0] for r in df.select(parse.parse_iso_instant("x")).collect()]
    assert got == [dt.datetime(2024, 1, 5, 11)] * 3 + [None]


def test_display_rounding_half_even(spark):
    df = spark.createDataFrame([(1250,), (1350,), (None,), (0,)], "d int")
    assert [r[0] for r in df.select(display.display_km("d")).collect()] == ["1.2 km", "1.4 km", "distance inconnue", "0.0 km"]
    df = spark.createDataFrame([(90,), (150,), (0,), (None,)], "s int")
    assert [r[0] for r in df.select(display.display_minutes("s")).collect()] == ["2 min", "2 min", "durée inconnue", "durée inconnue"]


def test_rolling_period_and_months(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 15),)], "d date")
    s, e = dates.rolling_period("d", 12, False)
    assert tuple(df.select(s, e).first()) == (dt.date(2023, 2, 1), dt.date(2024, 1, 31))
    s, e = dates.rolling_period("d", 12, True)
    assert tuple(df.select(s, e).first()) == (dt.date(2023, 3, 1), dt.date(2024, 2, 15))
    months = df.select(dates.last_n_months("d", 3, False)).first()[0]
    assert months == ["2023-11", "2023-12", "2024-01"]


def test_notification_text(spark):
    df = spark.createDataFrame([("Ana", "Roy", "Runing", "5.0 km", "30 min", " top "), ("Ana", "Roy", "Judo", "", "45 min", "")],
                               "p string, n string, s string, d string, m string, c string")
    got = [r[0] for r in df.select(display.notification_text("p", "n", "s", "d", "m", "c")).collect()]
    assert got[0].startswith("Bravo Ana Roy ! Tu viens de courir 5.0 km en 30 min ! Belle énergie ! (top)")
    assert got[1].startswith("Félicitations Ana Roy ! Discipline Judo pratiquée pendant 45 min. Bravo !")


def test_accents_composed_decomposed_and_far(spark):
    df = spark.createDataFrame([("René",), ("René",), (" NGUYỄN ",), ("Łódź ǎ",), (None,)], "x string")
    got = [r[0] for r in df.select(text.normalise_text("x")).collect()]
    assert got == ["rene", "rene", "nguyen", "łodz a", ""]


def test_long_durations_are_invalid_not_fatal(spark):
    df = spark.createDataFrame([("9" * 20 + ":00:00",), ("596523:14:07",), ("596523:14:08",), ("0:0:0",)], "x string")
    assert [r[0] for r in df.select(parse.parse_duration("x")).collect()] == [None, 2147483647, None, 0]


def test_display_rounds_the_binary_quotient(spark):
    metres = [0, 50, 150, 250, 350, 450, 949, 950, 1050, 12345678, 999950]
    df = spark.createDataFrame([(m,) for m in metres], "d int")
    got = [r[0] for r in df.select(display.display_km("d")).collect()]
    assert got == [f"{m / 1000:.1f} km" for m in metres]


def test_normalise_text_on_the_basic_plane(spark):
    """Every assigned code point (and some words) against unicodedata."""
    import unicodedata

    codes = [c for c in range(1, 0x10000) if unicodedata.category(chr(c)) not in ("Cn", "Cs", "Co")]
    values = [f"a{chr(c)}b" for c in codes] + [chr(c) for c in codes]
    values += ["\ufb01n", "\u0132ssel", "\uff21nne", "\u00bc l", "\ud55c\uae00", "\u2003x\u3000", "\u0958\u0301", "\u00e9l\u00e8ve \u0153"]
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string").repartition(4)
    got = dict(map(tuple, df.select("i", text.normalise_text("v")).collect()))
    wrong = []
    for i, v in enumerate(values):
        folded = unicodedata.normalize("NFKD", v.strip().lower())
        want = "".join(c for c in folded if not unicodedata.combining(c))
        if got[i] != want:
            wrong.append((hex(ord(v[len(v) // 2])), v, got[i], want))
    assert wrong == []
