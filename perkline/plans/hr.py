"""HR synchronisation (K3): soft delete, roster upsert, links, business
employees, declared sport.

The steps follow one another on successive versions, but each roster row
depends only on its own old row and its row of the file, so one full outer
join gives the next roster and what every step changes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perkline.config import RunConfig
from perkline.functions.text import pseudonym
from perkline.operators import mutate

RH_COMPARE = ["nom", "prenom", "bu", "date_naissance", "adresse_dom", "mod_depl_decl", "type_contrat", "date_embauche"]
EMPLOYEE_COMPARE = ["nom", "prenom", "bu", "mod_depl_decl"]


def missing_links(roster_file: DataFrame, links: DataFrame) -> DataFrame:
    """Rows of the HR file without a link (the business sync must stop)."""
    return roster_file.select("id_salarie_brut").join(links.select("id_salarie_brut"), "id_salarie_brut", "left_anti")


def require_links(roster_file: DataFrame, links: DataFrame) -> None:
    """M3 guard: one cheap action (stops at the first missing link)."""
    missing = missing_links(roster_file, links)
    if not missing.isEmpty():
        first = missing.first()[0]
        raise ValueError(f"missing link for id_salarie_brut={first}")


def sync_employee(employees: DataFrame, roster_file: DataFrame, links: DataFrame) -> DataFrame:
    """M3: business employee table from the HR file through the links
    (change-only upsert on the pseudonymised key)."""
    src = roster_file.join(links.select("id_salarie_brut", "cle_salarie"), "id_salarie_brut", "inner").select(
        "cle_salarie", *EMPLOYEE_COMPARE
    )
    return mutate.upsert_if_changed(employees, src, "cle_salarie", EMPLOYEE_COMPARE)


def new_links(roster_file: DataFrame, salt: str) -> DataFrame:
    return roster_file.select("id_salarie_brut", pseudonym("id_salarie_brut", salt).alias("cle_salarie"))


def roster_with_file(roster: DataFrame, roster_file: DataFrame) -> DataFrame:
    """Old roster rows (``t``) beside the file's (``f``, the sport trimmed and
    blank as NULL), one row per id of either."""
    sport = F.trim("sport_declare")
    old = roster.select("id_salarie_brut", F.struct(*roster.columns).alias("t"))
    new = mutate.one_per_key(roster_file.withColumn("sport_declare", F.when(F.length(sport) > 0, sport)),
                             ["id_salarie_brut"], [*RH_COMPARE, "sport_declare"])
    fields = F.struct(*[F.col(f"_s_{c}").alias(c) for c in [*RH_COMPARE, "sport_declare"]])
    new = new.select("id_salarie_brut", F.when(F.col("_in_s"), fields).alias("f"))
    return old.join(new, "id_salarie_brut", "full_outer")


def _rh_changed() -> Column:
    """M2: a new row, a compared column that differs, or a row not active."""
    t, f = F.col("t"), F.col("f")
    differs = mutate.any_distinct([(t[c], f[c]) for c in RH_COMPARE]) | mutate.is_distinct(t["actif"], F.lit(True))
    return f.isNotNull() & (t.isNull() | differs)


def next_roster(both: DataFrame, columns: list[str]) -> DataFrame:
    """The roster after M5 (absent rows inactive), M2 (file rows inserted or
    updated, and active) and M6 (declared sport)."""
    t, f = F.col("t"), F.col("f")

    def column(c: str) -> Column:
        if c == "id_salarie_brut":
            return F.col(c)
        if c == "actif":
            gone = f.isNull() & F.coalesce(t["actif"], F.lit(False))
            return F.when(_rh_changed(), F.lit(True)).when(gone, F.lit(False)).otherwise(t["actif"]).alias(c)
        if c in RH_COMPARE or c == "sport_declare":
            return F.when(f.isNotNull(), f[c]).otherwise(t[c]).alias(c)
        return t[c].alias(c)

    return both.select(*[column(c) for c in columns])


STEPS = ("desactivation", "upsert_rh", "liens", "upsert_metier", "sport_declare")


def sync_hr_counts(roster: DataFrame, links: DataFrame, employees: DataFrame, roster_file: DataFrame, run: RunConfig) -> DataFrame:
    """K3: changed rows per step (M5 -> M2 -> M4 -> M3 -> M6) and in total,
    as conditional sums over one pass of the joined tables.  The sports are
    updated after the inserts, so a new employee with a sport counts there."""
    t, f = F.col("t"), F.col("f")
    known = links.select("id_salarie_brut", F.col("cle_salarie").alias("_cle"))
    own = employees.select(F.col("cle_salarie").alias("_key"), F.struct(*EMPLOYEE_COMPARE).alias("e"))
    rows = roster_with_file(roster, roster_file).join(known, "id_salarie_brut", "left")
    rows = rows.withColumn("_key", F.coalesce("_cle", pseudonym("id_salarie_brut", run.salt))).join(own, "_key", "left")
    e = F.col("e")
    employee = e.isNull() | mutate.any_distinct([(e[c], f[c]) for c in EMPLOYEE_COMPARE])
    counts = (
        f.isNull() & F.coalesce(t["actif"], F.lit(False)),
        _rh_changed(),
        f.isNotNull() & F.col("_cle").isNull(),
        f.isNotNull() & employee,
        f.isNotNull() & mutate.is_distinct(t["sport_declare"], f["sport_declare"]),
    )
    one = rows.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(step) for step, c in zip(STEPS, counts, strict=True)])
    total = sum((F.col(step) for step in STEPS[1:]), F.col(STEPS[0]))
    named = [F.struct(F.lit(step).alias("etape"), F.col(step).cast("long").alias("nb_lignes")) for step in STEPS]
    named.append(F.struct(F.lit("total").alias("etape"), total.cast("long").alias("nb_lignes")))
    return one.select(F.explode(F.array(*named)).alias("x")).select("x.*")
