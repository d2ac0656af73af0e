"""Keyed table mutation as DataFrame jobs.

Plain Parquet tables have no MERGE, so every mutation is expressed as a
join of the current version with the incoming rows that *computes the next
version* (plus an ``action`` column saying what happened to each key).  The
next version is then written to a fresh path and published by pointer swap
(``commit_version``): the job never reads and overwrites the same files, a
failed or retried job leaves the published version untouched, and a lost
executor only means recomputing lineage from immutable inputs.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from perkline.session import materialise, scratch_path

INSERT, UPDATE, NOOP, KEEP = "insert", "update", "noop", "unchanged"


def is_distinct(a: Column, b: Column) -> Column:
    """NULL-safe inequality (``IS DISTINCT FROM``)."""
    return ~a.eqNullSafe(b)


def any_distinct(pairs: Sequence[tuple[Column, Column]]) -> Column:
    out = F.lit(False)
    for a, b in pairs:
        out = out | is_distinct(a, b)
    return out


def assign_ids(df: DataFrame, order: Sequence[str], start: Column, name: str) -> DataFrame:
    """Dense ids ``start + 1, start + 2, ...`` following ``order`` (a total
    order), computed without funnelling the rows through one task.

    Rows are range-partitioned on ``order`` and written once with the number
    of their partition; everything else reads that file, as a second
    evaluation would draw other range bounds.  A partition's rows are numbered
    in it, and its offset is the running sum of the sizes of those before it
    (one row per partition).
    """
    ranged = materialise(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), f"ids-{name}")
    local = Window.partitionBy("_part").orderBy(*order)
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    out = ranged.withColumn("_pos", F.row_number().over(local)).join(offsets, "_part", "inner")
    return out.withColumn(name, (start + F.col("_off") + F.col("_pos")).cast("long")).drop("_part", "_pos", "_off")


def one_per_key(source: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """``source`` as (keys, ``_s_<col>``, ``_in_s``); a key that occurs twice
    stops the job instead of fanning the target out."""
    twice = F.raise_error(F.concat(F.lit("duplicate source key: "), F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])))
    packed = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(*cols)).alias("_v"))
    return packed.select(
        *keys, *[F.col(f"_v.{c}").alias(f"_s_{c}") for c in cols], F.when(F.col("_n") == 1, F.lit(True)).otherwise(twice.cast("boolean")).alias("_in_s")
    )


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str],
    id_col: str | None = None,
    insert_defaults: dict[str, Column] | None = None,
    start: Column | None = None,
) -> DataFrame:
    """M1: unconditional upsert on ``keys`` (equal by ``=``, so a NULL key
    matches nothing).

    Matched keys take ``update_cols`` from the source and keep every other
    target column (id, ingestion date, flags); new keys are inserted with
    ids ``max(id) + 1 ...`` in key order and ``insert_defaults``; keys only
    in the target are kept.  Adds ``action``.  ``start`` is the largest id
    where ``target`` is a part of the table.
    """
    insert_defaults = insert_defaults or {}
    j = target.join(one_per_key(source, keys, update_cols), list(keys), "left")
    in_s = F.col("_in_s").isNotNull()
    old = j.select(
        *[F.when(in_s, F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c) if c in update_cols else F.col(c) for c in target.columns],
        F.when(in_s, F.lit(UPDATE)).otherwise(F.lit(KEEP)).alias("action"),
    )
    fields = {f.name: f.dataType for f in target.schema.fields}

    def inserted(c: str) -> Column:
        if c in keys or c in update_cols:
            return F.col(c).cast(fields[c])
        return insert_defaults.get(c, F.lit(None)).cast(fields[c]).alias(c)

    new = source.join(target.select(*keys), list(keys), "left_anti")
    new = new.select(*[inserted(c) for c in target.columns if c != id_col], F.lit(INSERT).alias("action"))
    if id_col is not None:
        if start is None:
            start = target.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("m")).select("m").scalar()
        new = assign_ids(new, keys, start, id_col)
    else:
        new = new.select(*old.columns)
    return old.unionByName(new.select(*old.columns))


def upsert_if_changed(
    target: DataFrame,
    source: DataFrame,
    key: str,
    compare_cols: Sequence[str],
    flag_col: str | None = None,
) -> DataFrame:
    """M2/M3: insert new keys; update a matched key only when a compared
    column ``IS DISTINCT FROM`` its new value (or the flag is not TRUE); the
    flag is set TRUE on insert/update.  ``action``: insert / update / noop
    (matched, identical) / unchanged (target only)."""
    t = target.withColumn("_in_t", F.lit(True))
    j = t.join(one_per_key(source, [key], compare_cols), key, "full_outer")
    in_t, in_s = F.col("_in_t").isNotNull(), F.col("_in_s").isNotNull()
    changed = any_distinct([(F.col(c), F.col(f"_s_{c}")) for c in compare_cols])
    if flag_col:
        changed = changed | is_distinct(F.col(flag_col), F.lit(True))
    action = (
        F.when(in_t & in_s & changed, F.lit(UPDATE))
        .when(in_t & in_s, F.lit(NOOP))
        .when(in_s, F.lit(INSERT))
        .otherwise(F.lit(KEEP))
    )
    j = j.withColumn("action", action)
    take_new = F.col("action").isin(UPDATE, INSERT)
    cols = []
    for c in target.columns:
        if c == key:
            cols.append(F.col(c))
        elif c in compare_cols:
            cols.append(F.when(take_new, F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c))
        elif flag_col and c == flag_col:
            cols.append(F.when(take_new, F.lit(True)).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return j.select(*cols, "action")


def insert_missing(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """M4: ``ON CONFLICT DO NOTHING`` — add source rows whose key is absent
    (``action`` insert), keep the target as is (``unchanged``)."""
    new = source.select(*target.columns).join(target.select(key), key, "left_anti")
    return target.withColumn("action", F.lit(KEEP)).unionByName(new.withColumn("action", F.lit(INSERT)))


def deactivate_absent(target: DataFrame, source: DataFrame, key: str, flag: str = "actif") -> DataFrame:
    """M5: soft delete — active keys missing from the new file get
    ``flag = FALSE``; only real changes are counted (``action`` update)."""
    present = source.select(key).distinct().withColumn("_present", F.lit(True))
    j = target.join(present, key, "left")
    deactivate = F.col("_present").isNull() & is_distinct(F.col(flag), F.lit(False)) & (F.col(flag) == F.lit(True))
    return j.select(
        *[F.when(deactivate, F.lit(False)).otherwise(F.col(c)).alias(c) if c == flag else F.col(c) for c in target.columns],
        F.when(deactivate, F.lit(UPDATE)).otherwise(F.lit(KEEP)).alias("action"),
    )


def update_if_distinct(target: DataFrame, source: DataFrame, key: str, col: str) -> DataFrame:
    """M6: set ``col`` from the source by key (trimmed, blank -> NULL), only
    where it is distinct; keys absent from the source keep their value."""
    s = source.select(key, F.trim(F.col(col)).alias("_v")).withColumn("_v", F.when(F.length("_v") > 0, F.col("_v")))
    s = s.withColumn("_in_s", F.lit(True))
    j = target.join(s, key, "left")
    change = F.col("_in_s").isNotNull() & is_distinct(F.col(col), F.col("_v"))
    return j.select(
        *[F.when(change, F.col("_v")).otherwise(F.col(c)).alias(c) if c == col else F.col(c) for c in target.columns],
        F.when(change, F.lit(UPDATE)).otherwise(F.lit(KEEP)).alias("action"),
    )


def diff_params(existing: DataFrame, new: DataFrame, day: dt.date) -> DataFrame:
    """M7: parameter diff — insert (absent code), update (value differs as
    text) with the effective date, noop otherwise; sorted by code.

    ``existing`` may be versioned: its current value per code is the
    latest version.
    """
    from perkline.operators.dedup import keep_one_per_group

    cur = keep_one_per_group(
        existing.select("code_param", "valeur_param", "date_effet"), ["code_param"], [("date_effet", "desc"), ("valeur_param", "desc")]
    )
    return param_actions(cur, new.withColumn("date_effet", F.lit(day)), ["code_param"]).orderBy("code_param")


def param_actions(current: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """M7: what a sync does with each row of ``new`` against the ``current``
    values: insert (no such key), update (another text), noop."""
    e = current.select(*keys, F.col("valeur_param").alias("valeur_actuelle"), F.lit(True).alias("_in_e"))
    j = new.select(*keys, "valeur_param", "date_effet").join(e, list(keys), "left")
    action = (
        F.when(F.col("_in_e").isNull(), F.lit(INSERT))
        .when(is_distinct(F.col("valeur_actuelle").cast("string"), F.col("valeur_param").cast("string")), F.lit(UPDATE))
        .otherwise(F.lit(NOOP))
    )
    return j.select(*keys, "valeur_actuelle", "valeur_param", "date_effet", action.alias("action"))


def next_params(existing: DataFrame, actions: DataFrame) -> DataFrame:
    """K4: the next version of the versioned parameter table: inserts and
    updates are appended, nothing is overwritten."""
    fresh = actions.filter(F.col("action") != NOOP).select("code_param", "valeur_param", "date_effet")
    return existing.select("code_param", "valeur_param", "date_effet").unionByName(fresh)


def reload_sources(target: DataFrame, replacement: DataFrame, sources: Sequence[str], col: str = "source_donnee") -> DataFrame:
    """M8: replace the rows of the listed sources by the replacement rows;
    an empty replacement leaves the target unchanged.

    The emptiness test is a scalar subquery (``exists``), evaluated once,
    so no count of the replacement is pulled to the driver.
    """
    has_rows = replacement.select(F.lit(1)).limit(1).exists()
    kept = target.filter(~(has_rows & F.col(col).isin(list(sources))))
    return kept.unionByName(replacement.select(*target.columns))


def should_refresh(expected: DataFrame, existing: DataFrame, force: bool) -> DataFrame:
    """One row — refresh unless ``existing == expected > 0`` and not
    forced; both counts are aggregates joined in one row."""
    e = expected.agg(F.count(F.lit(1)).alias("nb_attendus"))
    n_existing = existing.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    return e.select("nb_attendus", n_existing.alias("nb_existants")).select(
        "nb_attendus",
        "nb_existants",
        F.lit(force).alias("force"),
        (F.lit(force) | ~((F.col("nb_attendus") > 0) & (F.col("nb_existants") == F.col("nb_attendus")))).alias("a_rafraichir"),
    )


def mark_published(target: DataFrame, ids: DataFrame, id_col: str = "id_activite", flag: str = "flag_slack") -> DataFrame:
    """Set the publication flag of the given ids."""
    p = ids.select(id_col).distinct().withColumn("_pub", F.lit(True))
    j = target.join(p, id_col, "left")
    return j.select(
        *[F.when(F.col("_pub").isNotNull(), F.lit(True)).otherwise(F.col(c)).alias(c) if c == flag else F.col(c) for c in target.columns],
        F.when(F.col("_pub").isNotNull() & is_distinct(F.col(flag), F.lit(True)), F.lit(UPDATE)).otherwise(F.lit(KEEP)).alias("action"),
    )


def commit_version(spark: SparkSession, df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> str:
    """Write the next version of a table to a fresh path under the
    shared checkpoint folder and return it (the caller publishes the path).
    Nothing is overwritten in place, so a failure leaves the current version
    intact and readers never see a half-written table."""
    path = scratch_path(spark, name)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def guarded_write(spark: SparkSession, df: DataFrame, errors: DataFrame, name: str) -> str | None:
    """All-or-nothing gate — any blocking error means no output at all.
    ``errors.isEmpty()`` is one cheap action (stops at the first row)."""
    if not errors.isEmpty():
        return None
    return commit_version(spark, df, name)
