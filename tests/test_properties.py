"""Property and metamorphic tests on the smallest driver tables."""

from __future__ import annotations

import os
import random
import re
import unicodedata
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from perkline.config import DEFAULT_RUN as RUN
from perkline.functions import parse, text
from perkline.operators import mutate
from perkline.plans import bi, ingest, kpi
from perkline.plans.model import BenefitModel
from perkline.sources.tables import Tables

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not available")


def _norm(t: Tables):
    return ingest.normalise_declared(t.declared(), t.name_reference(), t.sport_reference(), RUN)


def test_one_row_per_employee_day_and_every_line_accounted(spark):
    t = Tables(spark, SF, RUN)
    n = _norm(t)
    per_day = n.clean.groupBy("cle_salarie", F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(RUN.zone), "date_debut"))).count()
    assert per_day.filter(F.col("count") > 1).count() == 0
    lines = {r[0] for r in t.declared().select("ligne").collect()}
    seen = {r[0] for r in n.errors.select("ligne").union(n.clean.select("ligne")).union(n.anomalies.select("ligne")).collect()}
    assert lines == seen
    # an error row never reaches the clean output
    assert n.clean.join(n.errors.select("ligne"), "ligne", "left_semi").count() == 0


def test_dedup_idempotent_and_shuffle_invariant(spark):
    t = Tables(spark, SF, RUN)
    a = t.activities()
    once = bi.bi_activity(a)
    shuffled = bi.bi_activity(a.orderBy(F.rand(7)).repartition(5))
    assert sorted(map(repr, once.collect())) == sorted(map(repr, shuffled.collect()))
    n1 = sorted(map(repr, _norm(t).clean.collect()))
    t2 = Tables(spark, SF, RUN)
    d2 = t2.declared().orderBy(F.rand(3)).repartition(3)
    n2 = sorted(map(repr, ingest.normalise_declared(d2, t2.name_reference(), t2.sport_reference(), RUN).clean.collect()))
    assert n1 == n2


def test_upsert_idempotent_on_driver_tables(spark):
    t = Tables(spark, SF, RUN)
    cmp = ["nom", "prenom", "bu", "date_naissance", "adresse_dom", "mod_depl_decl"]
    cols = ["id_salarie_brut", *cmp, "actif"]
    first = mutate.upsert_if_changed(t.roster().select(*cols), t.roster_v2(), "id_salarie_brut", cmp, flag_col="actif")
    second = mutate.upsert_if_changed(first.drop("action"), t.roster_v2(), "id_salarie_brut", cmp, flag_col="actif")
    assert second.filter(F.col("action").isin("insert", "update")).count() == 0


def test_eligibility_reason_and_age_band_sums(spark):
    m = BenefitModel(spark, SF, RUN)
    bonus = m.bonus
    bad = bonus.filter(F.col("est_eligible_prime") != F.col("motif_ineligibilite").isNull())
    assert bad.count() == 0
    age = m.kpi_age().agg(
        F.sum("nb_salaries").alias("n"),
        F.sum("nb_salaries_eligibles_prime").alias("e"),
        F.sum("cout_annuel_total_prime_variable").alias("c"),
        F.sum("jours_bien_etre_attribues_total").alias("j"),
    ).first()
    glob = kpi.kpi_bonus_cost(m.bonus, m.salaries, m.pivot).first()
    days = m.kpi_extra_days().first()
    assert age["n"] == m.bi_employee.count()
    assert age["e"] == glob["nb_salaries_eligibles_prime"]
    # each band is rounded to cents, so the sum may differ by half a cent per band
    n_bands = m.kpi_age().count()
    assert abs(age["c"] - glob["cout_annuel_total_prime"]) <= Decimal("0.005") * n_bands
    assert age["j"] == days["nb_jours_supplementaires"]


# ---------------------------------------------------------------------------
# Scalar functions against plain-Python references on random inputs
# ---------------------------------------------------------------------------
def _py_normalise(v):
    if v is None:
        return ""
    s = v.strip(" \t\n\r\f\v ").lower()
    s = unicodedata.normalize("NFKD", s)
    return "".join(c for c in s if not unicodedata.combining(c))


def _py_duration(v):
    if v is None:
        return None
    s = re.sub(r'^"+|"+$', "", v.strip(" \t\n\r\f\v "))
    m = re.fullmatch(r"(\d+):(\d+):(\d+)", s)
    return int(m[1]) * 3600 + int(m[2]) * 60 + int(m[3]) if m else None


def _py_distance(v):
    if v is None:
        return None
    s = re.sub(r'^"+|"+$', "", v.strip(" \t\n\r\f\v ")).replace(",", ".")
    if not s:
        return None
    try:
        x = float(s)
    except ValueError:
        return None
    if x != x or x < 0 or x * 1000 >= 2147483647.0:
        return None
    return round(x * 1000)  # Python round: half-even, as bround


def test_scalars_match_python_reference(spark):
    rnd = random.Random(42)
    alphabet = "aAéÉèçÇôÖ ñÑ-'  xyz"
    names = [None, "", "  "] + ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 12))) for _ in range(300)]
    durs = [None, "", "1h30", '"01:02:03"'] + [
        f"{rnd.randint(0, 30)}:{rnd.randint(0, 99)}:{rnd.randint(0, 99)}" if rnd.random() < 0.8 else f"{rnd.randint(0, 9)}:{rnd.randint(0, 9)}"
        for _ in range(300)
    ]
    dists = [None, "", "abc", "-1", "0,0005"] + [
        f"{rnd.randint(0, 60)}{rnd.choice([',', '.'])}{rnd.randint(0, 9999)}" for _ in range(300)
    ]
    size = max(len(names), len(durs), len(dists))
    data = [(names[i % len(names)], durs[i % len(durs)], dists[i % len(dists)]) for i in range(size)]
    df = spark.createDataFrame(data, "n string, d string, k string")
    got = df.select(
        "n", "d", "k", text.normalise_text("n").alias("nn"), parse.parse_duration("d").alias("dd"), parse.parse_distance("k").alias("kk")
    ).collect()
    for r in got:
        assert r["nn"] == _py_normalise(r["n"]), r["n"]
        assert r["dd"] == _py_duration(r["d"]), r["d"]
        assert r["kk"] == _py_distance(r["k"]), r["k"]
