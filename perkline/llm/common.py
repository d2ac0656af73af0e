"""Small helpers shared by the dealt operators."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable

import perkline
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from perkline.session import scratch_path

WHITE = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_counting(df: DataFrame, name: str, **counts: Column) -> tuple[DataFrame, dict]:
    """``stored``, and aggregates of the rows that were taken while they were
    written (no job of their own)."""
    watch = Observation(f"{name}-{uuid.uuid4().hex}")
    out = stored(df.observe(watch, *[c.alias(k) for k, c in counts.items()]), name)
    return out, watch.get


def fresh(name: str, columns: list[str]) -> str:
    """``name``, or a longer one that is not among ``columns`` in any case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


_SHIPPED: dict[str, tempfile.TemporaryDirectory] = {}


def ship(spark: SparkSession) -> None:
    """Gives the tasks' Python this package, wherever the driver found it;
    once an application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(perkline.__file__))
    # kept until the driver ends: executors that start later fetch it too
    folder = tempfile.TemporaryDirectory(prefix="perkline-package-")
    path = os.path.join(folder.name, "perkline_package.zip")
    with zipfile.ZipFile(path, "w") as out:
        for at, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    out.write(os.path.join(at, name), os.path.relpath(os.path.join(at, name), os.path.dirname(root)))
    sc.addPyFile(path)
    _SHIPPED[sc.applicationId] = folder


#: what a task holds at once of its input
BATCH_ROWS, BATCH_BYTES = 2000, 8 << 20


def map_arrow(df: DataFrame, task: Callable, schema) -> DataFrame:
    """``df.mapInArrow`` whose tasks can import this package, and get their
    rows in batches of bounded size."""
    spark = df.sparkSession
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(task, schema)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once a row: a lambda variable
    is bound, while the optimiser may copy a plain column into a loop."""
    return F.transform(F.array(value), body)[0]


def fold(column: Column | int, modulus: int) -> Column:
    """crc32 of the id's text, modulo; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit(""))) % modulus
