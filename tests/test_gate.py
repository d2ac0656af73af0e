"""The all-or-nothing gate on all blocking errors."""

from perkline.queries import QUERIES, ingest_q, load_all

SF = "/root/testdata/sf0.001"

load_all()


def test_gate_stops_at_any_blocking_error(spark):
    n = ingest_q._norm(spark, SF)
    stamps = {r["ligne"]: r["horodateur"] for r in n.classified.select("ligne", "horodateur").collect()}
    bad = {(stamps[r["ligne"]] or "")[:16] for r in n.errors.select("ligne").collect()}
    out = {stamps[r["ligne"]][:16] for r in QUERIES["gate_per_minute"](spark, SF).collect()}
    assert out and bad and not out & bad
