"""K9: the run journal, and what readers make of it."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from perkline.config import DEFAULT_RUN
from perkline.plans import history

PARAMS = "code_param string, valeur_param string, date_effet date"


def _kpis(spark, broken=None, error=None):
    def stop(name):
        raise error

    class Stopping(dict):
        def __getitem__(self, name):
            return stop(name) if name == broken else dict.__getitem__(self, name)

    return Stopping({n: spark.range(2).select(F.col("id").alias("valeur")) for n in history.HISTORY_TABLES})


def test_killed_run_leaves_a_failed_run(spark):
    params = spark.createDataFrame([("taux_prime", "0.05", dt.date(2023, 1, 1))], PARAMS)
    journal = history.Journal(spark)
    first = history.snapshot(spark, _kpis(spark), params, 1, DEFAULT_RUN, journal)
    assert first["status"] == "SUCCESS" and first["rows"] == {n: 2 for n in history.HISTORY_TABLES}
    # the driver dies between two snapshots: no end event is written
    with pytest.raises(KeyboardInterrupt):
        history.snapshot(spark, _kpis(spark, "incoherences", KeyboardInterrupt()), params, 2, DEFAULT_RUN, journal)
    # an error in a step is recorded, cut to the column's length
    third = history.snapshot(spark, _kpis(spark, "age", RuntimeError("x" * 9000)), params, 3, DEFAULT_RUN, journal)
    assert third["status"] == "FAILURE" and third["snapshots"] == {}
    events = [(r.id_histo_run, r.evenement) for r in journal.events().collect()]
    assert sorted(events) == [(1, "RUNNING"), (1, "SUCCESS"), (2, "RUNNING"), (3, "FAILURE"), (3, "RUNNING")]
    states = {r.id_histo_run: r for r in history.run_states(journal.events(), DEFAULT_RUN.zone).collect()}
    assert {i: r.status for i, r in states.items()} == {1: "SUCCESS", 2: "FAILURE", 3: "FAILURE"}
    assert states[1].error_message is None and states[2].error_message == history.INTERRUPTED
    assert len(states[3].error_message) == 4000 and states[3].error_message.startswith("RuntimeError: xxx")
    assert states[2].param_effectif == '{"taux_prime":{"valeur_param":"0.05","date_effet":"2023-01-01"}}'
    # readers see the first run's rows only, whatever was written for the others
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id_histo_run long, v string")
    assert [r.v for r in history.successful_snapshots(history.run_states(journal.events(), DEFAULT_RUN.zone), rows).collect()] == ["a"]
    # the run is tried again and ends well
    history.snapshot(spark, _kpis(spark), params, 2, DEFAULT_RUN, journal)
    assert history.run_states(journal.events(), DEFAULT_RUN.zone).where("id_histo_run = 2").first()["status"] == "SUCCESS"


def test_counts_come_from_the_write(spark, tmp_path):
    df = spark.range(1000).repartition(7)
    watched, seen = history.observed(df, "t", even=F.count_if(F.col("id") % 2 == 0))
    watched.write.parquet(str(tmp_path / "t"))
    assert seen() == {"n": 1000, "even": 500}
    none, seen = history.observed(df.where("id < 0"), "t")
    none.write.parquet(str(tmp_path / "none"))
    assert seen() == {"n": 0}
