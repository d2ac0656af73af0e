"""Digest tree (F5) and publication ledger."""

import pytest
from pyspark.sql import functions as F

from perkline.operators import mutate
from perkline.plans import notify
from perkline.plans.fingerprint import BucketedTable, digest_tree, table_digest, tree_diff

ROSTER = "id string, nom string, bu string, brut int, actif boolean"
COMPARED = ["nom", "bu"]


def people(n, **changed):
    return [(f"e{i}", changed.get(f"e{i}", f"nom {i}"), None if i % 5 == 0 else "x", i, True) for i in range(n)]


def test_one_changed_row_is_one_bucket(spark):
    old = spark.createDataFrame(people(300), ROSTER)
    new = spark.createDataFrame(people(300, e17="autre"), ROSTER).repartition(7)
    trees = [digest_tree(d.select("id", *COMPARED), "id", 64) for d in (old, new)]
    diff = tree_diff(*trees).where("modifie").collect()
    assert len(diff) == 1 and diff[0].nb_avant == diff[0].nb_apres
    assert table_digest(trees[0]).first() != table_digest(trees[1]).first()
    assert table_digest(trees[0]).first() == table_digest(digest_tree(old.repartition(3).select("id", *COMPARED), "id", 64)).first()
    # a value that moves to the next column, and NULL against an empty text
    a = spark.createDataFrame([("k", "ab", "c")], "id string, x string, y string")
    for other in (("k", "a", "bc"), ("k", "ab", None), ("k", "ab", "")):
        b = spark.createDataFrame([other], "id string, x string, y string")
        assert tree_diff(digest_tree(a, "id"), digest_tree(b, "id")).first()["modifie"]


def test_sync_of_changed_buckets_is_the_whole_sync(spark):
    rows = people(200)
    rows[3] = (*rows[3][:4], False)
    target = spark.createDataFrame(rows, ROSTER)
    file_rows = [(i, n, b) for i, n, b, _, _ in people(200, e17="autre") if i != "e50"] + [("n1", "neu", "x")]
    source = spark.createDataFrame(file_rows, "id string, nom string, bu string")
    table = BucketedTable.create(target, "id", COMPARED, "actif", 64)
    # the changed, the inactive, the absent and the new person
    buckets = table.changed_buckets(source)
    assert 1 <= len(buckets) <= 4
    plan = spark._jvm.PythonSQLUtils.explainString(table.rows(buckets)._jdf.queryExecution(), "formatted")
    assert "PartitionFilters: [bucket" in plan
    want = mutate.upsert_if_changed(target, source, "id", COMPARED, flag_col="actif")
    assert sorted(map(str, table.sync(source).collect())) == sorted(map(str, want.select(*table.sync(source).columns).collect()))
    same = spark.createDataFrame([r[:3] for r in people(200)], "id string, nom string, bu string")
    calm = BucketedTable.create(spark.createDataFrame(people(200), ROSTER), "id", COMPARED, "actif", 64)
    assert calm.changed_buckets(same) == []
    assert {r.action for r in calm.sync(same).collect()} == {"noop"}


def test_a_failure_between_both_writes_sends_nothing_twice(spark, monkeypatch):
    activity = spark.createDataFrame([(i, i == 1) for i in range(1, 6)], "id_activite long, flag_slack boolean")
    box = spark.createDataFrame([(i, f"Bravo {i}") for i in range(2, 6)], "id_activite long, message string")
    ledger = notify.Ledger(spark)
    handed = []

    def run(name, messages, force=False, fail=False):
        todo = ledger.unsent(messages, name, force)
        handed.extend(sorted(r.id_activite for r in todo.collect()))
        ledger.hand_over(todo, name)
        if fail:
            raise RuntimeError("between both writes")
        return {r.id_activite: r.flag_slack for r in ledger.flagged(activity).collect()}

    with pytest.raises(RuntimeError):
        run("run-1", box.where("id_activite < 5"), fail=True)
    assert handed == [2, 3, 4]
    # the same run again, with one more message
    flags = run("run-1", box)
    assert handed == [2, 3, 4, 5] and all(flags.values())
    assert run("run-2", box) == flags and handed == [2, 3, 4, 5]
    # a changed message of an activity is a new one; forced runs send again, once
    run("run-3", box.where("id_activite = 2").withColumn("message", F.lit("Encore")))
    assert handed[4:] == [2]
    run("run-4", box, force=True)
    run("run-4", box, force=True)
    assert handed[5:] == [2, 3, 4, 5]
