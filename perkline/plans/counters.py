"""Maintained activity counts.

The window count of an employee is a sum over months.  A table of counts per
(employee, local month) is kept beside the activity table and corrected by
what a change did, so a run reads twelve small rows an employee instead of
the facts.

Counts are mergeable: those of a change are the counts of its partitions
after it minus the counts of the same partitions before it.  Inserts, updates
(also of the label, which decides whether an activity counts), deleted and
reloaded rows and rows that come late are all covered, as none of them
needs to be known as such.  Only changed months of the count table are
rewritten.

Rows count when their canonical type is known.  Exact duplicates are not
removed here: the activity table holds one row per (employee, instant,
source), with the source trimmed by the load.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perkline.config import SPORTS, RunConfig
from perkline.functions.dates import local_day, year_month
from perkline.operators.labels import canonical_label
from perkline.operators.partitions import Change, PartitionedTable
from perkline.session import materialise, scratch_path

KEYS = ["cle_salarie", "mois"]


def counts(activities: DataFrame, zone: str) -> DataFrame:
    """``cle_salarie, mois, nb``: known activities per employee and local
    month (``yyyy-MM``)."""
    _, unknown = canonical_label("type_activite", SPORTS)
    known = activities.select("cle_salarie", year_month(local_day("date_debut", zone)).alias("mois"), unknown.alias("_u"))
    return known.where(~F.col("_u")).groupBy(*KEYS).agg(F.count(F.lit(1)).alias("nb"))


def delta(before: DataFrame, after: DataFrame, zone: str) -> DataFrame:
    """Signed counts by which ``after`` differs from ``before``; both hold the
    same partitions."""
    old = counts(before, zone).withColumn("nb", -F.col("nb"))
    return counts(after, zone).unionByName(old).groupBy(*KEYS).agg(F.sum("nb").alias("nb")).where("nb <> 0")


def change_delta(table: PartitionedTable, change: Change, zone: str) -> DataFrame:
    """What a staged change will do to the counts; to be taken before it is
    published.  Reads the touched partitions only."""
    parts = sorted({*change.parts, *change.emptied})
    return materialise(delta(table.rows(parts), table.staged_rows(change), zone), "count-delta")


class Counts:
    """The count table under ``path``, partitioned by month."""

    SCHEMA = "cle_salarie string, nb long, mois string"

    def __init__(self, spark, path: str):
        self.spark, self.path = spark, path

    @classmethod
    def create(cls, activities: DataFrame, zone: str) -> "Counts":
        spark = activities.sparkSession
        out = cls(spark, scratch_path(spark, "activity-counts"))
        counts(activities, zone).write.partitionBy("mois").parquet(out.path)
        return out

    def rows(self) -> DataFrame:
        return self.spark.read.schema(self.SCHEMA).parquet(self.path).select(*KEYS, "nb").where("nb <> 0")

    def apply(self, change: DataFrame) -> list[str]:
        """Adds signed counts; returns the months rewritten.  A count below
        zero means that the change was not made to this table: an error."""
        months = sorted(r[0] for r in change.select("mois").distinct().collect())
        if not months:
            return months
        below = F.raise_error(F.concat_ws(" ", F.lit("negative count:"), "cle_salarie", "mois")).cast("long")
        both = self.rows().where(F.col("mois").isin(months)).unionByName(change.select(*KEYS, "nb"))
        # a zero stays as a row, so that every touched month is replaced
        after = both.groupBy(*KEYS).agg(F.sum("nb").alias("nb")).withColumn("nb", F.when(F.col("nb") >= 0, F.col("nb")).otherwise(below))
        staged = materialise(after, "count-months")
        staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("mois").parquet(self.path)
        return months

    def in_window(self, run: RunConfig) -> DataFrame:
        """A2: ``cle_salarie, nb_activites_periode`` of the run's window of
        complete months."""
        if run.include_current_month:
            raise ValueError("monthly counts cannot answer a window that ends inside a month")
        start, end = run.period()
        inside = self.rows().where(F.col("mois").between(f"{start:%Y-%m}", f"{end:%Y-%m}"))
        return inside.groupBy("cle_salarie").agg(F.sum("nb").cast("int").alias("nb_activites_periode"))
