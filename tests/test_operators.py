"""Dedup, mutation, parameter and loading operators on hand-built rows."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from perkline.config import RunConfig
from perkline.operators import dedup, mutate
from perkline.plans import ingest, loading, params
from tests.conftest import rows

TS = dt.datetime


def test_keep_one_per_group_and_split(spark):
    df = spark.createDataFrame(
        [(1, "a", 3), (2, "a", 5), (3, "a", 5), (4, "b", 1)], "id long, k string, v int"
    )
    kept = dedup.keep_one_per_group(df, ["k"], [("v", "desc"), ("id", "desc")])
    assert rows(kept, "k", "id") == [("a", 3), ("b", 4)]
    kept, dropped = dedup.split_one_per_group(df, ["k"], [("v", "desc"), ("id", "desc")], "id")
    assert rows(kept, "id") == [(3,), (4,)]
    assert rows(dropped, "id") == [(1,), (2,)]
    with pytest.raises(ValueError):
        dedup.keep_one_per_group(df, ["k"], [("v", "desc"), ("id", "asc")])


def test_group_size_counts_null_keys_together(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "x")], "id int, k string")
    assert rows(dedup.with_group_size(df, ["k"]), "id", "n_group") == [(1, 2), (2, 2), (3, 1)]


def test_dedup_daily_across_utc_midnight_and_ties(spark):
    df = spark.createDataFrame(
        [
            (1, "s1", TS(2024, 1, 1, 23, 30)),  # Paris 2024-01-02 00:30
            (2, "s1", TS(2024, 1, 2, 8, 0)),  # same Paris day
            (3, "s1", TS(2024, 1, 2, 8, 0)),  # tie on the instant -> greatest id
            (4, "s2", TS(2024, 1, 1, 22, 0)),
        ],
        "id_activite long, cle_salarie string, date_debut timestamp_ntz",
    )
    kept, rejected = ingest.dedup_daily(df, keep="latest")
    assert rows(kept, "id_activite") == [(3,), (4,)]
    assert rows(rejected, "raison", "id_activite") == [("plusieurs_activites_jour", 1), ("plusieurs_activites_jour", 2)]
    first, _ = ingest.dedup_daily(df, keep="first")
    assert rows(first, "id_activite") == [(1,), (4,)]
    conflicts = ingest.daily_conflicts(df)
    assert rows(conflicts, "id_activite") == [(1,), (2,), (3,)]


def _target(spark):
    return spark.createDataFrame(
        [
            (1, "k1", "A", True),
            (2, "k2", "B", False),
            (3, "k3", None, True),
            (4, "k4", "D", True),
        ],
        "id long, key string, v string, actif boolean",
    )


def test_upsert_if_changed_actions_and_idempotence(spark):
    target = _target(spark)
    source = spark.createDataFrame(
        [("k1", "A"), ("k2", "B"), ("k3", "C"), ("k4", None), ("k5", "E")], "key string, v string"
    )
    out = mutate.upsert_if_changed(target.drop("id"), source, "key", ["v"], flag_col="actif")
    assert rows(out, "key", "v", "actif", "action") == [
        ("k1", "A", True, "noop"),  # identical row: no change
        ("k2", "B", True, "update"),  # reactivated
        ("k3", "C", True, "update"),  # NULL -> value
        ("k4", None, True, "update"),  # value -> NULL
        ("k5", "E", True, "insert"),
    ]
    again = mutate.upsert_if_changed(out.drop("action"), source, "key", ["v"], flag_col="actif")
    assert again.filter(F.col("action").isin("insert", "update")).count() == 0


def test_upsert_unconditional_with_new_ids(spark):
    target = spark.createDataFrame(
        [(10, "k1", 5, "x", True), (11, "k2", 6, "y", False)], "id long, key string, d int, other string, flag boolean"
    )
    source = spark.createDataFrame([("k2", 60), ("k9", 90), ("k8", 80)], "key string, d int")
    out = mutate.upsert(target, source, ["key"], ["d"], id_col="id", insert_defaults={"flag": F.lit(False), "other": F.lit("new")})
    assert rows(out, "id", "key", "d", "other", "flag", "action") == [
        (10, "k1", 5, "x", True, "unchanged"),
        (11, "k2", 60, "y", False, "update"),
        (12, "k8", 80, "new", False, "insert"),
        (13, "k9", 90, "new", False, "insert"),
    ]


def test_assign_ids_dense_in_order(spark):
    df = spark.range(0, 500).select((F.col("id") * 7 % 500).alias("k")).repartition(7)
    out = mutate.assign_ids(df, ["k"], F.lit(100), "new_id")
    got = rows(out, "k", "new_id")
    assert got == [(k, 101 + k) for k in range(500)]


def test_soft_delete_insert_missing_update_distinct(spark):
    target = _target(spark)
    source = spark.createDataFrame([("k1",), ("k3",)], "key string")
    out = mutate.deactivate_absent(target, source, "key")
    assert rows(out, "key", "actif", "action") == [
        ("k1", True, "unchanged"),
        ("k2", False, "unchanged"),  # already inactive: not counted
        ("k3", True, "unchanged"),
        ("k4", False, "update"),
    ]
    links = spark.createDataFrame([("1", "sal_a")], "id string, cle string")
    new = spark.createDataFrame([("1", "sal_x"), ("2", "sal_b")], "id string, cle string")
    assert rows(mutate.insert_missing(links, new, "id")) == [("1", "sal_a", "unchanged"), ("2", "sal_b", "insert")]
    sport = spark.createDataFrame([("k1", " Judo "), ("k2", "  "), ("k4", "D")], "key string, v string")
    out = mutate.update_if_distinct(target, sport, "key", "v")
    assert rows(out, "key", "v", "action") == [
        ("k1", "Judo", "update"),
        ("k2", None, "update"),  # blank -> NULL
        ("k3", None, "unchanged"),  # absent from the source
        ("k4", "D", "unchanged"),
    ]


def test_reload_sources_empty_replacement_is_noop(spark):
    target = spark.createDataFrame([(1, "csv_gsheet"), (2, "csv_simule")], "id long, source_donnee string")
    empty = spark.createDataFrame([], "id long, source_donnee string")
    assert rows(mutate.reload_sources(target, empty, ["csv_simule"])) == [(1, "csv_gsheet"), (2, "csv_simule")]
    repl = spark.createDataFrame([(3, "csv_simule")], "id long, source_donnee string")
    assert rows(mutate.reload_sources(target, repl, ["csv_simule"])) == [(1, "csv_gsheet"), (3, "csv_simule")]


def test_should_refresh_and_mark_published(spark):
    exp = spark.range(3)
    assert mutate.should_refresh(exp, spark.range(3), False).first()["a_rafraichir"] is False
    assert mutate.should_refresh(exp, spark.range(3), True).first()["a_rafraichir"] is True
    assert mutate.should_refresh(exp, spark.range(2), False).first()["a_rafraichir"] is True
    assert mutate.should_refresh(spark.range(0), spark.range(0), False).first()["a_rafraichir"] is True
    t = spark.createDataFrame([(1, False), (2, True), (3, False)], "id_activite long, flag_slack boolean")
    out = mutate.mark_published(t, spark.createDataFrame([(1,), (2,)], "id_activite long"))
    assert rows(out) == [(1, True, "update"), (2, True, "unchanged"), (3, False, "unchanged")]


def test_guarded_write_all_or_nothing(spark):
    df = spark.range(3)
    errors = spark.createDataFrame([("boom",)], "raison string")
    assert mutate.guarded_write(spark, df, errors, "guarded") is None
    path = mutate.guarded_write(spark, df, errors.limit(0), "guarded")
    assert spark.read.parquet(path).count() == 3


def test_effective_params_cases(spark):
    p = spark.createDataFrame(
        [
            ("taux_prime", "0.04", dt.date(2023, 1, 1)),
            ("taux_prime", "0.05", dt.date(2024, 1, 1)),
            ("taux_prime", "0.06", dt.date(2099, 1, 1)),  # future only
            ("jours_bien_etre", "5", dt.date(2024, 1, 1)),
            ("jours_bien_etre", "6", dt.date(2024, 1, 1)),  # same day: greater text wins
            ("seuil", "15", dt.date(2030, 1, 1)),  # only a future version: absent
        ],
        "code_param string, valeur_param string, date_effet date",
    )
    eff = params.effective_params(p, dt.date(2024, 2, 15))
    assert rows(eff, "code_param", "valeur_param") == [("jours_bien_etre", "6"), ("taux_prime", "0.05")]
    days = spark.createDataFrame([(dt.date(2023, 6, 1),), (dt.date(2024, 6, 1),)], "jour date")
    at = params.effective_params_at(p, days)
    assert rows(at.filter(F.col("code_param") == "taux_prime"), "jour", "valeur_param") == [
        (dt.date(2023, 6, 1), "0.04"),
        (dt.date(2024, 6, 1), "0.05"),
    ]
    assert rows(at.filter(F.col("code_param") == "jours_bien_etre"), "jour", "valeur_param") == [(dt.date(2024, 6, 1), "6")]
    pivot = params.param_pivot(eff).first()
    assert str(pivot["taux_prime"]) == "0.0500" and pivot["jours_bien_etre"] == 6 and pivot["min_activites_bien_etre"] is None


def test_pivot_rejects_non_numeric(spark):
    p = spark.createDataFrame([("taux_prime", "abc", dt.date(2023, 1, 1))], "code_param string, valeur_param string, date_effet date")
    with pytest.raises(Exception):
        params.param_pivot(p).collect()


def test_params_from_mapping_and_diff(spark):
    mapping = {"taux_prime": "0.06", "jours_bien_etre": 5, " ": "x", "liste": [1], "vide": None, "nouveau": "1"}
    new = params.params_from_mapping(spark, mapping, dt.date(2024, 2, 15))
    assert rows(new, "code_param", "valeur_param") == [("jours_bien_etre", "5"), ("nouveau", "1"), ("taux_prime", "0.06")]
    existing = spark.createDataFrame(
        [("taux_prime", "0.05", dt.date(2024, 1, 1)), ("jours_bien_etre", "5", dt.date(2023, 1, 1))],
        "code_param string, valeur_param string, date_effet date",
    )
    diff = mutate.diff_params(existing, new, dt.date(2024, 2, 15))
    assert [tuple(r) for r in diff.select("code_param", "action").collect()] == [
        ("jours_bien_etre", "noop"),
        ("nouveau", "insert"),
        ("taux_prime", "update"),
    ]


def test_merge_priority_and_load_gate(spark):
    run = RunConfig()
    cols = "cle_salarie string, date_debut timestamp_ntz, duree_sec int, distance_m int, type_activite string, commentaire string, source_donnee string"
    forms = spark.createDataFrame([("s1", TS(2024, 1, 5, 11), 600, None, "Judo", "", "csv_gsheet")], cols)
    sim = spark.createDataFrame(
        [("s1", TS(2024, 1, 5, 11), 300, None, "Judo", "", "csv_simule"), ("s1", TS(2024, 1, 6, 9), 300, None, "Judo", "", "csv_simule")], cols
    )
    merged = loading.merge_priority(sim, forms)
    assert rows(merged, "source_donnee", "duree_sec") == [("csv_gsheet", 600), ("csv_simule", 300)]
    target = spark.createDataFrame(
        [(1, "s0", TS(2024, 1, 1, 9), 60, "Judo", None, "", "csv_simule", TS(2024, 1, 2), True)],
        "id_activite long, cle_salarie string, date_debut timestamp_ntz, duree_sec int, type_activite string, distance_m int, "
        "commentaire string, source_donnee string, date_ingestion timestamp_ntz, flag_slack boolean",
    )
    out = loading.load_activities(target, forms, sim.filter(F.col("date_debut") > TS(2024, 1, 6)), run)
    assert rows(out, "id_activite", "cle_salarie", "source_donnee", "action") == [
        (2, "s1", "csv_gsheet", "insert"),
        (3, "s1", "csv_simule", "insert"),
    ]
    clash = spark.createDataFrame([("s1", TS(2024, 1, 5, 17), 300, None, "Judo", "", "csv_simule")], cols)
    with pytest.raises(ValueError):
        loading.load_activities(target, forms, clash, run)


def test_prepare_activities_null_start_fails(spark):
    df = spark.createDataFrame(
        [(" s1 ", None, None, None, None, None, None)],
        "cle_salarie string, date_debut timestamp_ntz, duree_sec int, distance_m int, type_activite string, commentaire string, source_donnee string",
    )
    with pytest.raises(Exception):
        loading.prepare_activities(df).collect()


def _dense(out, n, start, column="new_id"):
    low, high, distinct, rows = out.agg(F.min(column), F.max(column), F.countDistinct(column), F.count("*")).first()
    return (low, high, distinct, rows) == (start + 1, start + n, n, n)


@pytest.mark.parametrize("partitions", [2, 8, 61])
def test_assign_ids_are_dense_at_a_million_rows(spark, partitions):
    n = 1_000_000
    df = spark.range(n).select((F.col("id") * 7919 % n).alias("k"), F.lit("some payload").alias("p"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        out = mutate.assign_ids(df, ["k"], F.lit(5), "new_id")
        assert _dense(out, n, 5)
        assert out.filter(F.col("new_id") != F.col("k") + 6).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_upsert_keeps_every_insert_and_stops_on_duplicate_keys(spark):
    target = spark.range(200_000).select(F.col("id").alias("k"), F.col("id").alias("ident"), F.lit(0).alias("v"))
    source = spark.range(100_000, 500_000).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    out = mutate.upsert(target, source, ["k"], ["v"], id_col="ident")
    counts = {r["action"]: r["count"] for r in out.groupBy("action").count().collect()}
    assert counts == {"unchanged": 100_000, "update": 100_000, "insert": 300_000}
    assert out.select("ident").distinct().count() == 500_000 and out.agg(F.max("ident")).first()[0] == 499_999
    with pytest.raises(Exception, match="duplicate source key"):
        mutate.upsert(target, source.union(source.limit(1)), ["k"], ["v"]).collect()
