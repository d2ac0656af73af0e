"""Touched partitions (M1, M8) and the counts kept with them (A2)."""

import datetime as dt
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from perkline.config import DEFAULT_RUN
from perkline.operators import mutate
from perkline.operators.partitions import PartitionedTable
from perkline.plans import counters
from perkline.plans.loading import activity_layout

KEYS = ["cle_salarie", "date_debut", "source_donnee"]
UPDATE = ["duree_sec", "type_activite"]
COLS = "id_activite long, cle_salarie string, date_debut timestamp_ntz, duree_sec int, type_activite string, source_donnee string"
FILE = COLS.split(", ", 1)[1]
TYPES = ["Tennis", " running ", "Runing", "Curling", "Natation", ""]


def instant(rnd, months=(1, 2, 3, 12)):
    return dt.datetime(2023, rnd.choice(months), rnd.randint(1, 28), rnd.randint(0, 23), rnd.randint(0, 59))


def table_rows(rnd, n):
    keys = {(f"sal_{rnd.randrange(9)}", instant(rnd), rnd.choice(["csv_gsheet", "csv_simule"])) for _ in range(n)}
    return [(i, k, t, rnd.randint(1, 99), rnd.choice(TYPES), s) for i, (k, t, s) in enumerate(sorted(keys), 1)]


def files(path):
    return {
        os.path.relpath(os.path.join(d, f), path): os.stat(os.path.join(d, f)).st_mtime_ns
        for d, _, names in os.walk(path)
        for f in names
        if f.endswith(".parquet")
    }


def make(spark, rows):
    return PartitionedTable.create(spark.createDataFrame(rows, COLS), "t", activity_layout())


def pruned(df):
    """The partition filters of the only scan."""
    plan = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return re.search(r"PartitionFilters: (\[.*?\])\n", plan).group(1)


def test_upsert_reads_and_writes_one_month(spark):
    rnd = random.Random(1)
    rows = table_rows(rnd, 200)
    table = make(spark, rows)
    old = next(r for r in rows if r[2].month == 2 and r[5] == "csv_gsheet")
    source = spark.createDataFrame(
        [(old[1], old[2], 7, "Judo", "csv_gsheet"), ("sal_new", dt.datetime(2023, 2, 11), 8, "Tennis", " csv_gsheet ")], FILE
    ).withColumn("source_donnee", F.trim("source_donnee"))
    parts = [("csv_gsheet", "2023-02")]
    assert table.touched(source) == parts
    assert "csv_gsheet" in pruned(table.rows(parts)) and "2023-02" in pruned(table.rows(parts))
    assert {p for p in table.touched(table.rows(parts))} == set(parts)
    before, sizes = files(table.path), files(table.size_path)
    change = table.stage_upsert(source, KEYS, UPDATE, {})
    assert change.parts == parts and files(table.path) == before
    table.publish(change)
    after = files(table.path)
    moved = {f for f in before.keys() | after.keys() if before.get(f) != after.get(f)}
    assert moved and all(f.startswith("source_donnee=csv_gsheet/mois=2023-02/") for f in moved)
    assert all(f.startswith("source_donnee=csv_gsheet/mois=2023-02/") for f, t in files(table.size_path).items() if sizes.get(f) != t)
    want = mutate.upsert(spark.createDataFrame(rows, COLS), source, KEYS, UPDATE, "id_activite").drop("action")
    assert sorted(table.rows().collect()) == sorted(want.collect())
    # publishing again changes nothing
    table.publish(change)
    assert sorted(table.rows().collect()) == sorted(want.collect())
    assert table.largest_id() == max(r[0] for r in rows) + 1


def test_reload_replaces_without_reading(spark):
    rnd = random.Random(2)
    rows = table_rows(rnd, 150)
    table = make(spark, rows)
    kept = [r for r in rows if r[5] == "csv_gsheet"]
    before = files(table.path)
    new = [("sal_1", dt.datetime(2023, 3, 5), 1, "Tennis", "csv_simule"), ("sal_2", dt.datetime(2025, 1, 1), 2, "Tennis", "csv_simule")]
    change = table.stage_reload(spark.createDataFrame(new, FILE), ["csv_simule"], "source_donnee", KEYS, {})
    assert {p[1] for p in change.emptied} == {"2023-01", "2023-02", "2023-12"}
    table.publish(change)
    top = max(r[0] for r in rows)
    assert sorted(table.rows().collect()) == sorted(kept + [(top + 1 + i, *r) for i, r in enumerate(new)])
    assert {f: t for f, t in files(table.path).items() if "csv_gsheet" in f} == {f: t for f, t in before.items() if "csv_gsheet" in f}
    # an empty file leaves the table as it is, a foreign source stops
    assert table.stage_reload(spark.createDataFrame([], FILE), ["csv_simule"], "source_donnee", KEYS, {}) is None
    with pytest.raises(ValueError, match="csv_gsheet"):
        table.stage_reload(spark.createDataFrame([("s", dt.datetime(2023, 1, 1), 1, "x", "csv_gsheet")], FILE), ["csv_simule"], "source_donnee", KEYS, {})


def test_empty_and_null_partition_values(spark):
    rows = [(1, "a", dt.datetime(2023, 1, 1), 1, "Tennis", ""), (2, "b", None, 2, "Tennis", "x"), (3, "c", dt.datetime(2023, 1, 2), 3, "Tennis", "x")]
    table = make(spark, rows)
    assert sorted(map(str, table.rows().collect())) == sorted(str(r) for r in spark.createDataFrame(rows, COLS).collect())
    source = spark.createDataFrame([("a", dt.datetime(2023, 1, 1), 9, "Judo", "")], FILE)
    table.publish(table.stage_upsert(source, KEYS, UPDATE, {}))
    assert table.rows().where("id_activite = 1").first()["duree_sec"] == 9 and table.rows().count() == 3


@pytest.mark.parametrize("seed", range(2))
def test_counts_follow_every_change(spark, seed):
    rnd = random.Random(seed)
    table = make(spark, table_rows(rnd, 120))
    kept = counters.Counts.create(table.rows(), DEFAULT_RUN.zone)

    def recount():
        return sorted(map(tuple, counters.counts(table.rows(), DEFAULT_RUN.zone).collect()))

    assert sorted(map(tuple, kept.rows().collect())) == recount()
    for step in range(3):
        rows = table.rows().drop("id_activite").collect()
        if step == 1:
            # a reload that drops rows, and brings some of years before
            some = [tuple(r) for r in rows if r.source_donnee == "csv_simule" and rnd.random() < 0.5]
            some += [(f"sal_{i}", dt.datetime(2019, 12, 31, 23, 30 + i), 1, "Tennis", "csv_simule") for i in range(3)]
            change = table.stage_reload(spark.createDataFrame(some, FILE), ["csv_simule"], "source_donnee", KEYS, {})
        else:
            # updates of the label both ways, and new rows
            keys = rnd.sample([tuple(r)[:2] + (r.source_donnee,) for r in rows], 20)
            keys += [(f"sal_n{i}", instant(rnd), "csv_gsheet") for i in range(10)]
            source = [(k, t, 5, rnd.choice(TYPES), s) for k, t, s in dict.fromkeys(keys)]
            change = table.stage_upsert(spark.createDataFrame(source, FILE), KEYS, UPDATE, {})
        before = files(kept.path)
        months = kept.apply(counters.change_delta(table, change, DEFAULT_RUN.zone))
        table.publish(change)
        assert sorted(map(tuple, kept.rows().collect())) == recount()
        same = [f for f in before if f.split("/")[0].removeprefix("mois=") not in months]
        assert all(files(kept.path)[f] == before[f] for f in same)
    # instants before midnight UTC on the last day belong to the next local month
    assert ("sal_0", "2020-01", 1) in recount()
    twice = spark.createDataFrame([("sal_0", "2020-01", -5)], "cle_salarie string, mois string, nb long")
    with pytest.raises(Exception, match="negative count"):
        kept.apply(twice)
