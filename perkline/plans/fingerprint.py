"""Dataset fingerprint (F5): detect an unchanged input without comparing
files byte for byte.

The fingerprint of a table is the row count and the sums of both 64-bit
halves of every row's digest.  It is order-insensitive by design and computed
in one aggregate pass (partial aggregation on every partition), so it scales
with the cluster; equal fingerprints mean "no change" with overwhelming
probability.  A cell enters the digest with its length, and NULL as a mark of
its own, so no value can move to another cell unseen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from perkline.operators import mutate
from perkline.session import scratch_path


def row_digest(df: DataFrame):
    cells = []
    for c in df.columns:
        text = F.col(c).cast("string")
        cells.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.md5(F.concat_ws("|", *cells))


def _half(digest, start: int):
    return F.conv(F.substring(digest, start, 16), 16, 10).cast("decimal(38,0)")


def fingerprint(df: DataFrame, name: str) -> DataFrame:
    d = row_digest(df)
    return df.agg(
        F.count(F.lit(1)).alias("nb_lignes"),
        F.sum(_half(d, 1)).alias("somme_haute"),
        F.sum(_half(d, 17)).alias("somme_basse"),
    ).select(F.lit(name).alias("table_name"), "*")


def changed(current: DataFrame, baseline: DataFrame) -> DataFrame:
    """Current fingerprint with ``modifie`` = differs from the baseline."""
    b = baseline.select(
        "table_name", F.col("nb_lignes").alias("_n"), F.col("somme_haute").alias("_h"), F.col("somme_basse").alias("_b")
    )
    j = current.join(b, "table_name", "left")
    diff = ~(F.col("nb_lignes").eqNullSafe(F.col("_n")) & F.col("somme_haute").eqNullSafe(F.col("_h"))
             & F.col("somme_basse").eqNullSafe(F.col("_b")))
    return j.select("table_name", "nb_lignes", "somme_haute", "somme_basse", diff.alias("modifie"))


# ---------------------------------------------------------------------------
# Digest tree: which part of a keyed table changed
# ---------------------------------------------------------------------------
#: buckets of a tree, chosen by the key's hash
BUCKETS = 1024


def bucket_of(key: str, buckets: int = BUCKETS):
    """Bucket of a row: the leading 32 bits of its key's md5."""
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long"), F.lit(buckets)).cast("int")


def digest_tree(df: DataFrame, key: str, buckets: int = BUCKETS) -> DataFrame:
    """The lower level: ``bucket, nb_lignes, empreinte`` of each bucket with
    rows, one aggregate combined in the map tasks."""
    d = row_digest(df)
    sums = df.select(bucket_of(key, buckets).alias("bucket"), _half(d, 1).alias("_h"), _half(d, 17).alias("_l")).groupBy("bucket").agg(
        F.count(F.lit(1)).alias("nb_lignes"), F.sum("_h").alias("_h"), F.sum("_l").alias("_l")
    )
    text = F.concat_ws("|", F.col("nb_lignes").cast("string"), F.col("_h").cast("string"), F.col("_l").cast("string"))
    return sums.select("bucket", "nb_lignes", F.md5(text).alias("empreinte"))


def table_digest(tree: DataFrame) -> DataFrame:
    """The upper level: one digest of the buckets' digests, in order."""
    cells = F.transform(F.array_sort(F.collect_list(F.struct("bucket", "empreinte"))), lambda e: F.concat_ws(":", e["bucket"].cast("string"), e["empreinte"]))
    return tree.agg(F.coalesce(F.sum("nb_lignes"), F.lit(0)).alias("nb_lignes"), F.md5(F.array_join(cells, ",")).alias("empreinte"))


def tree_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Buckets of either tree with ``modifie``: their digests differ, or only
    one side has the bucket."""
    o = old.select("bucket", F.col("nb_lignes").alias("nb_avant"), F.col("empreinte").alias("_o"))
    n = new.select("bucket", F.col("nb_lignes").alias("nb_apres"), F.col("empreinte").alias("_n"))
    return o.join(n, "bucket", "full_outer").select(
        "bucket",
        F.coalesce("nb_avant", F.lit(0)).alias("nb_avant"),
        F.coalesce("nb_apres", F.lit(0)).alias("nb_apres"),
        (~F.col("_o").eqNullSafe(F.col("_n"))).alias("modifie"),
    )


class BucketedTable:
    """A keyed table as a Parquet folder with a directory per bucket, and the
    tree of what it holds beside it.

    ``compared`` are the columns that a sync compares, ``flag`` the one that it
    sets: the tree is taken over these, so a bucket whose digest equals that of
    the incoming file needs no look at its rows.
    """

    def __init__(self, spark, path: str, schema, key: str, compared: list[str], flag: str, buckets: int):
        self.spark, self.path, self.schema = spark, path, schema
        self.key, self.compared, self.flag, self.buckets = key, compared, flag, buckets

    @classmethod
    def create(cls, rows: DataFrame, key: str, compared: list[str], flag: str, buckets: int = BUCKETS) -> "BucketedTable":
        spark = rows.sparkSession
        out = cls(spark, scratch_path(spark, "bucketed"), rows.schema, key, compared, flag, buckets)
        placed = rows.withColumn("bucket", bucket_of(key, buckets))
        # one file a bucket
        placed.repartition("bucket").write.partitionBy("bucket").parquet(out.path)
        out._tree(rows).write.parquet(out.path + ".tree")
        return out

    def _tree(self, rows: DataFrame) -> DataFrame:
        return digest_tree(rows.select(self.key, *self.compared, F.coalesce(self.flag, F.lit(False)).alias("_flag")), self.key, self.buckets)

    def rows(self, buckets: list[int] | None = None) -> DataFrame:
        """All rows, or those of ``buckets`` (other directories are not read)."""
        df = self.spark.read.schema(StructType([*self.schema.fields]).add("bucket", "integer")).parquet(self.path)
        return (df if buckets is None else df.where(F.col("bucket").isin(buckets))).select(*self.schema.names)

    def changed_buckets(self, source: DataFrame) -> list[int]:
        """Buckets in which the file differs from the table; reads the file
        and the table's tree."""
        new = self._tree(source.withColumn(self.flag, F.lit(True)))
        diff = tree_diff(self.spark.read.parquet(self.path + ".tree"), new)
        return sorted(r["bucket"] for r in diff.where("modifie").select("bucket").collect())

    def sync(self, source: DataFrame) -> DataFrame:
        """M2 on the changed buckets only; rows of all others are ``noop`` (each
        is in the file, active and the same).  Returns the next version with
        ``action``."""
        buckets = self.changed_buckets(source)
        place = bucket_of(self.key, self.buckets)
        part = source.where(place.isin(buckets))
        after = mutate.upsert_if_changed(self.rows(buckets), part, self.key, self.compared, flag_col=self.flag)
        others = sorted(set(range(self.buckets)) - set(buckets))
        same = self.rows(others)
        return after.unionByName(same.withColumn("action", F.lit(mutate.NOOP)))
