"""Keyed tables laid out by partition, changed only where a job touches them.

``mutate`` computes a table's next version from the whole table.  Here the
table is a Parquet folder partitioned by columns that the key determines
(source and month of an activity), so rows that match share a partition: an
upsert (M1) reads and rewrites the partitions its source names, a reload (M8)
replaces partitions without reading any row of the table.

A change has two steps.  ``stage_*`` writes the new content of the touched
partitions to a fresh folder; ``publish`` then replaces them with Spark's
dynamic partition overwrite.  Publishing reads only staged files, so it can be
repeated after a failure, with the same result; until it ran the table is
unchanged.  One job at a time changes a table.

Beside the table lies its size table: a row per partition with the number of
rows and the largest id, kept by every ``publish``.  The next id and the
partitions of a source come from there, not from the rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from perkline.operators import mutate
from perkline.session import materialise, scratch_path


@dataclass
class Layout:
    """Partition columns (text) with the expression that gives each."""

    by: dict[str, Column]
    id_col: str

    def add(self, rows: DataFrame) -> DataFrame:
        return rows.withColumns({n: F.coalesce(e.cast("string"), F.lit("")) for n, e in self.by.items()})


@dataclass
class Change:
    """A staged change: the new content of ``parts``, with the ``action`` of
    each row; partitions in ``emptied`` lose all their rows."""

    staged: str
    parts: list[tuple[str, ...]]
    emptied: list[tuple[str, ...]] = field(default_factory=list)


class PartitionedTable:
    """A table under ``path``; ``schema`` holds its columns without those of
    the layout that are not among them."""

    def __init__(self, spark: SparkSession, path: str, layout: Layout, schema: StructType):
        self.spark, self.path, self.layout, self.schema = spark, path, layout, schema

    @classmethod
    def create(cls, rows: DataFrame, name: str, layout: Layout) -> "PartitionedTable":
        spark = rows.sparkSession
        table = cls(spark, scratch_path(spark, name), layout, rows.schema)
        layout.add(rows).write.partitionBy(*layout.by).parquet(table.path)
        table._measure(table._scan()).write.partitionBy(*layout.by).parquet(table.size_path)
        return table

    @property
    def size_path(self) -> str:
        return self.path + ".sizes"

    def _full_schema(self, fields: StructType) -> StructType:
        """Data columns first, then those of the layout, as text."""
        out = StructType([f for f in fields if f.name not in self.layout.by])
        for name in self.layout.by:
            out = out.add(name, "string")
        return out

    def _scan(self) -> DataFrame:
        scan = self.spark.read.schema(self._full_schema(self.schema)).parquet(self.path)
        # the folder of an empty text is read as NULL
        return scan.withColumns({n: F.coalesce(n, F.lit("")) for n in self.layout.by})

    def rows(self, parts: Sequence[tuple[str, ...]] | None = None) -> DataFrame:
        """The table's columns; of ``parts`` only, if given (other partitions
        are not read)."""
        df = self.spark.read.schema(self._full_schema(self.schema)).parquet(self.path)
        if parts is not None:
            df = df.where(self._among(parts))
        return df.select(*[F.coalesce(c, F.lit("")).alias(c) if c in self.layout.by else F.col(c) for c in self.schema.names])

    def _among(self, parts: Sequence[tuple[str, ...]]) -> Column:
        """A predicate on partition columns alone: per leading values the list
        of the last one."""
        *lead, last = self.layout.by
        grouped: dict[tuple, list] = {}
        for p in parts:
            grouped.setdefault(tuple(p[:-1]), []).append(p[-1])
        out = F.lit(False)
        for head, tails in grouped.items():
            test = F.coalesce(last, F.lit("")).isin(tails) if "" in tails else F.col(last).isin(tails)
            for name, value in zip(lead, head, strict=True):
                test = test & (F.coalesce(name, F.lit("")) == value if value == "" else F.col(name) == value)
            out = out | test
        return out

    def sizes(self) -> DataFrame:
        """``layout columns, n, max_id``, a row per partition."""
        fields = StructType.fromDDL("n long, max_id long")
        df = self.spark.read.schema(self._full_schema(fields)).parquet(self.size_path)
        return df.withColumns({n: F.coalesce(n, F.lit("")) for n in self.layout.by})

    def _measure(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.layout.by).agg(F.count(F.lit(1)).alias("n"), F.max(self.layout.id_col).cast("long").alias("max_id"))

    def touched(self, rows: DataFrame) -> list[tuple[str, ...]]:
        """The partitions that ``rows`` belong to (as many as partitions)."""
        return sorted(tuple(r) for r in self.layout.add(rows).select(*self.layout.by).distinct().collect())

    def largest_id(self) -> int:
        return self.sizes().agg(F.coalesce(F.max("max_id"), F.lit(0))).first()[0]

    # -- changes ----------------------------------------------------------------
    def stage_upsert(self, source: DataFrame, keys: Sequence[str], update_cols: Sequence[str], defaults: dict[str, Column]) -> Change:
        """M1 in the partitions of ``source`` only; ``keys`` determine the
        layout columns."""
        source = materialise(source, "upsert-source")
        parts = self.touched(source)
        after = mutate.upsert(
            self.rows(parts), source, keys, update_cols, self.layout.id_col, defaults, start=F.lit(self.largest_id())
        )
        return Change(self._staged(after), parts)

    def stage_reload(self, rows: DataFrame, sources: Sequence[str], source_col: str, keys: Sequence[str], defaults: dict[str, Column]) -> Change | None:
        """M8: all partitions of ``sources`` are replaced by ``rows`` (with new
        ids); None, and nothing to publish, where ``rows`` is empty."""
        rows = materialise(rows, "reload-source")
        parts = self.touched(rows)
        if not parts:
            return None
        place = list(self.layout.by).index(source_col)
        if any(p[place] not in sources for p in parts):
            raise ValueError(f"rows of a source that is not reloaded: {sorted({p[place] for p in parts} - set(sources))}")
        held = [tuple(r) for r in self.sizes().where(F.col(source_col).isin(list(sources)) & (F.col("n") > 0)).select(*self.layout.by).collect()]
        new = mutate.assign_ids(rows, keys, F.lit(self.largest_id()), self.layout.id_col)
        fields = {f.name: f.dataType for f in self.schema.fields}
        columns = [defaults.get(c, F.col(c) if c in new.columns else F.lit(None)).cast(fields[c]).alias(c) for c in self.schema.names]
        after = new.select(*columns, F.lit(mutate.INSERT).alias("action"))
        return Change(self._staged(after), parts, sorted(set(held) - set(parts)))

    def _staged(self, after: DataFrame) -> str:
        path = scratch_path(self.spark, "staged-partitions")
        self.layout.add(after).write.partitionBy(*self.layout.by).parquet(path)
        return path

    def staged_rows(self, change: Change) -> DataFrame:
        """The new content of the touched partitions, with ``action``."""
        df = self.spark.read.schema(self._full_schema(StructType([*self.schema.fields]).add("action", "string"))).parquet(change.staged)
        return df.withColumns({n: F.coalesce(n, F.lit("")) for n in self.layout.by})

    def publish(self, change: Change) -> None:
        """Replaces the touched partitions; may be repeated."""
        after = self.staged_rows(change).drop("action")
        for path, rows in ((self.path, after), (self.size_path, self._measure(after))):
            rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*self.layout.by).parquet(path)
            # a partition that lost all rows holds an empty file from now on
            none = rows.drop(*self.layout.by).limit(0)
            for part in change.emptied:
                folder = "/".join(f"{n}={v or '__HIVE_DEFAULT_PARTITION__'}" for n, v in zip(self.layout.by, part, strict=True))
                none.write.mode("overwrite").parquet(f"{path}/{folder}")
