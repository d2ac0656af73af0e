"""Declarative data-quality engine (Q1-Q27).

A check is a small spec: the table it applies to, a name, a kind and its
parameters.  Row predicates are SQL text (the declarative form of the checks
— e.g. ``NOT (flag = true AND label = 'INCONNU' OR ...)``), evaluated by
Spark as JVM expressions with SQL three-valued logic.

Evaluation reads each table once.  A table with counting checks only (row
count, missing values, domain, failed rows) is one aggregate.  All others are
shuffled once, together, whatever the number of checks: a row is exploded to
one entry per key check (duplicates, references) and per counting check that it
counts for, tagged with the check and the key's text; the rows of a referenced
table add entries of the same tag from the other side.  One aggregate over
(check, key), combined in the map tasks, and one over the checks give every
metric.
Results are rows ``(table_name, controle, type_controle, metrique, statut)``
with ``statut`` in OK / WARN / FAIL.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


OK, WARN, FAIL = "OK", "WARN", "FAIL"


@dataclass(frozen=True)
class Check:
    table: str
    name: str
    kind: str  # row_count | missing | duplicates | reference | domain | failed_rows | same_count | warn_rows
    cols: tuple[str, ...] = ()
    predicate: str | None = None  # SQL text: the row fails when it is TRUE
    values: tuple[str, ...] = ()
    parent: str | None = None
    parent_col: str | None = None
    fail_le: int | None = None  # row_count: FAIL when count <= fail_le
    warn_lt: int | None = None  # row_count: WARN when count < warn_lt
    op: str | None = None  # row_count comparison: '>' or '=' against ``expected``
    expected: int | None = None
    warn_only: bool = False  # a failed comparison is a WARN (expected row count)
    extra: dict = field(default_factory=dict, compare=False, hash=False)


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _not_in_sql(col: str, values: Sequence[str]) -> str:
    return f"{col} IS NOT NULL AND {col} NOT IN ({', '.join(_q(v) for v in values)})"


def expand(sql: str, engine: str) -> str:
    """Expand the two dialect macros used in predicates:
    ``LOCAL_DAY(col)`` (Europe/Paris day of a UTC instant) and
    ``MATCHES(col, 'regex')``."""
    import re

    if engine == "spark":
        sql = re.sub(r"LOCAL_DAY\(([^)]*)\)", r"to_date(convert_timezone('UTC', 'Europe/Paris', \1))", sql)
        sql = re.sub(r"MATCHES\(([^,]*), ('[^']*')\)", r"(\1 RLIKE \2)", sql)
    else:
        sql = re.sub(r"LOCAL_DAY\(([^)]*)\)", r"CAST((\1 AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Paris' AS DATE)", sql)
        sql = re.sub(r"MATCHES\(([^,]*), ('[^']*')\)", r"regexp_matches(\1, \2)", sql)
    return sql


def failing_predicate(check: Check, engine: str = "spark") -> str:
    """SQL predicate counted by a counting check."""
    return expand(_failing(check), engine)


def _failing(check: Check) -> str:
    if check.kind == "missing":
        return f"{check.cols[0]} IS NULL"
    if check.kind == "domain":
        return _not_in_sql(check.cols[0], check.values)
    if check.kind in ("failed_rows", "warn_rows"):
        return f"coalesce({check.predicate}, false)"
    raise ValueError(check.kind)


def status_sql(check: Check, metric: str) -> str:
    if check.kind == "row_count":
        if check.op == ">":
            return f"CASE WHEN {metric} > {check.expected} THEN 'OK' ELSE 'FAIL' END"
        if check.op == "=":
            bad = "WARN" if check.warn_only else "FAIL"
            return f"CASE WHEN {metric} = {check.expected} THEN 'OK' ELSE '{bad}' END"
        out = "CASE"
        if check.fail_le is not None:
            out += f" WHEN {metric} <= {check.fail_le} THEN 'FAIL'"
        if check.warn_lt is not None:
            out += f" WHEN {metric} < {check.warn_lt} THEN 'WARN'"
        return out + " ELSE 'OK' END"
    if check.kind == "warn_rows":
        return f"CASE WHEN {metric} > 0 THEN 'WARN' ELSE 'OK' END"
    return f"CASE WHEN {metric} > 0 THEN 'FAIL' ELSE 'OK' END"


def columns_metric(columns, check: Check) -> int:
    """Q16: 0 when the column list equals the expected one (names and
    order), else 1 — schema metadata, no data is read."""
    return 0 if list(columns) == list(check.cols) else 1


def _struct_sql(c: Check, metric: str) -> str:
    m = f"CAST({metric} AS BIGINT)"
    return (
        f"named_struct('table_name', {_q(c.table)}, 'controle', {_q(c.name)}, 'type_controle', {_q(c.kind)}, "
        f"'metrique', {m}, 'statut', {status_sql(c, m)})"
    )


COUNTING = ("row_count", "missing", "domain", "failed_rows", "warn_rows", "required")


def _metric_sql(c: Check) -> str:
    if c.kind == "row_count":
        return "count(1)"
    if c.kind == "required":
        # number of required values never seen in the column
        return "(" + " + ".join(f"CASE WHEN count_if({c.cols[0]} = {_q(v)}) = 0 THEN 1 ELSE 0 END" for v in c.values) + ")"
    return f"count_if({failing_predicate(c)})"


def _counted(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Counting checks of a table without key checks."""
    results = ", ".join(_struct_sql(c, _metric_sql(c)) for c in checks)
    return df.agg(F.expr(f"array({results})").alias("r")).select(F.explode("r").alias("r")).select("r.*")


def _key_text(cols: Sequence[str], types: dict[str, str] | None = None) -> str:
    """A key as an array of texts; NULL parts stay NULL."""
    return "array(" + ", ".join(f"CAST({f'CAST({c} AS {types[c]})' if types else c} AS STRING)" for c in cols) + ")"


class _Stack:
    """The entries that each table's rows are exploded to.

    An entry is ``(tag, key, child, parent)``: the check, the key's text (NULL
    for plain counts), and one row on one of the two sides.  A row has an entry
    for a check only where it counts for it."""

    def __init__(self) -> None:
        self.entries: dict[str, list[str]] = {}
        self.results: list[str] = []  # by tag

    def tag(self, result: str) -> int:
        self.results.append(result)
        return len(self.results) - 1

    def add(self, table: str, tag: int, key: str | None = None, parent: bool = False, when: str | None = None) -> None:
        entry = (
            f"named_struct('tag', {tag}, 'key', {key or 'CAST(NULL AS ARRAY<STRING>)'}, "
            f"'child', {int(not parent)}L, 'parent', {int(parent)}L)"
        )
        self.entries.setdefault(table, []).append(f"CASE WHEN {when} THEN {entry} END" if when else entry)


def evaluate(tables: dict[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """Run ``checks`` against ``tables``; one result row per check.

    Expressions are generated as SQL text, so that building the plan costs one
    expression per table."""
    stack, fixed = _Stack(), []
    keyed_checks = [c for c in checks if c.kind in ("duplicates", "reference", "same_count")]
    shuffled = {t for c in keyed_checks for t in (c.table, c.parent)}
    counted: dict[str, list[Check]] = {}
    for c in checks:
        if c.kind in COUNTING and c.table not in shuffled:
            counted.setdefault(c.table, []).append(c)
        elif c.kind == "required":
            # the required values that are seen are keys
            listed = ", ".join(_q(v) for v in c.values)
            tag = stack.tag(_struct_sql(c, f"{len(set(c.values))} - seen"))
            stack.add(c.table, tag, _key_text(c.cols[:1]), when=f"{c.cols[0]} IN ({listed})")
        elif c.kind in COUNTING:
            when = None if c.kind == "row_count" else failing_predicate(c)
            stack.add(c.table, stack.tag(_struct_sql(c, "rows")), when=when)
        elif c.kind == "duplicates":
            stack.add(c.table, stack.tag(_struct_sql(c, "repeated")), _key_text(c.cols))
        elif c.kind == "reference":
            col, up = c.cols[0], c.parent_col
            kind = tables[c.table].schema[col].dataType.simpleString()
            tag = stack.tag(_struct_sql(c, "orphans"))
            stack.add(c.table, tag, _key_text([col]), when=f"{col} IS NOT NULL")
            stack.add(c.parent, tag, _key_text([up], {up: kind}), parent=True, when=f"{up} IS NOT NULL")
        elif c.kind == "same_count":
            tag = stack.tag(_struct_sql(c, "abs(rows - others)"))
            stack.add(c.table, tag)
            stack.add(c.parent, tag, parent=True)
        elif c.kind == "columns":
            fixed.append(_struct_sql(c, str(columns_metric(tables[c.table].columns, c))))
    spark = next(iter(tables.values())).sparkSession
    found = [_counted(tables[t], cs) for t, cs in counted.items()]
    if fixed:
        found.append(spark.range(1).select(F.explode(F.expr(f"array({', '.join(fixed)})")).alias("r")).select("r.*"))
    if stack.results:
        found.append(_stacked(spark, tables, stack))
    return reduce(DataFrame.unionByName, found)


def _stacked(spark, tables: dict[str, DataFrame], stack: _Stack) -> DataFrame:
    # every check has an entry that counts nothing, so that one without any
    # row has its result too
    none = "transform(sequence(0, {}), t -> named_struct('tag', t, 'key', CAST(NULL AS ARRAY<STRING>), 'child', 0L, 'parent', 0L))"
    parts = spark.range(1).select(F.explode(F.expr(none.format(len(stack.results) - 1))).alias("e")).select("e.*")
    for table, entries in stack.entries.items():
        exploded = tables[table].select(F.explode(F.expr(f"array_compact(array({', '.join(entries)}))")).alias("e"))
        parts = parts.unionByName(exploded.select("e.*"))
    keyed = parts.groupBy("tag", "key").agg(F.sum("child").alias("child"), F.sum("parent").alias("parent"))
    per_check = keyed.groupBy("tag").agg(
        F.sum("child").alias("rows"),
        F.sum("parent").alias("others"),
        F.count_if(F.col("child") > 1).alias("repeated"),
        F.count_if(F.col("key").isNotNull() & (F.col("child") > 0)).alias("seen"),
        F.sum(F.when(F.col("parent") == 0, F.col("child")).otherwise(F.lit(0))).alias("orphans"),
    )
    cases = " ".join(f"WHEN {tag} THEN {struct}" for tag, struct in enumerate(stack.results))
    return per_check.select(F.expr(f"CASE tag {cases} END").alias("r")).select("r.*")


def failed_rows(tables: dict[str, DataFrame], checks: Sequence[Check], key_cols: dict[str, str]) -> DataFrame:
    """Rows failing the ``failed_rows`` checks: (table, check, key text)."""
    parts = []
    for c in checks:
        if c.kind not in ("failed_rows", "warn_rows"):
            continue
        df = tables[c.table]
        parts.append(
            df.filter(F.expr(failing_predicate(c))).select(
                F.lit(c.table).alias("table_name"), F.lit(c.name).alias("controle"), F.expr(key_cols[c.table]).cast("string").alias("cle")
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def summarise(results: DataFrame) -> DataFrame:
    """Q25: counters per status and the overall status (FAIL > WARN > OK)."""
    agg = results.agg(
        F.count_if(F.col("statut") == OK).alias("nb_ok"),
        F.count_if(F.col("statut") == WARN).alias("nb_warn"),
        F.count_if(F.col("statut") == FAIL).alias("nb_fail"),
    )
    overall = F.when(F.col("nb_fail") > 0, F.lit(FAIL)).when(F.col("nb_warn") > 0, F.lit(WARN)).otherwise(F.lit(OK))
    return agg.select("nb_ok", "nb_warn", "nb_fail", overall.alias("statut_global"))


# ---------------------------------------------------------------------------
# DuckDB twin generation from the same specs
# ---------------------------------------------------------------------------
def twin_results(checks: Sequence[Check], sources: dict[str, str]) -> str:
    """SQL computing the same result rows as :func:`evaluate`; ``sources``
    maps a table name to a relation (CTE name) of the twin."""
    selects = []
    for c in checks:
        src = sources[c.table]
        head = f"SELECT {_q(c.table)} AS table_name, {_q(c.name)} AS controle, {_q(c.kind)} AS type_controle, "
        if c.kind == "row_count":
            m = "count(*)"
            body = f"FROM {src}"
        elif c.kind in ("missing", "domain", "failed_rows", "warn_rows"):
            m = f"count(*) FILTER (WHERE {failing_predicate(c, 'duck')})"
            body = f"FROM {src}"
        elif c.kind == "required":
            vals = ", ".join(f"({_q(v)})" for v in c.values)
            m = "count(*)"
            body = f"FROM (VALUES {vals}) r(v) WHERE r.v NOT IN (SELECT {c.cols[0]} FROM {src} WHERE {c.cols[0]} IS NOT NULL)"
        elif c.kind == "duplicates":
            cols = ", ".join(c.cols)
            m = "count(*)"
            body = f"FROM (SELECT {cols} FROM {src} GROUP BY {cols} HAVING count(*) > 1)"
        elif c.kind == "reference":
            col = c.cols[0]
            m = "count(*)"
            body = (
                f"FROM {src} x WHERE x.{col} IS NOT NULL AND NOT EXISTS "
                f"(SELECT 1 FROM {sources[c.parent]} p WHERE p.{c.parent_col} = x.{col})"
            )
        elif c.kind == "same_count":
            m = f"abs(count(*) - (SELECT count(*) FROM {sources[c.parent]}))"
            body = f"FROM {src}"
        elif c.kind == "columns":
            # twin: the relation's own column list, in order
            expected = ",".join(c.cols)
            m = f"CASE WHEN (SELECT string_agg(column_name, ',') FROM (DESCRIBE SELECT * FROM {src})) = {_q(expected)} THEN 0 ELSE 1 END"
            body = ""
        else:
            raise ValueError(c.kind)
        inner = f"SELECT CAST({m} AS BIGINT) AS metrique {body}".rstrip()
        selects.append(f"{head}metrique, {status_sql(c, 'metrique')} AS statut FROM ({inner})")
    return " UNION ALL ".join(selects)


def twin_failed_rows(checks: Sequence[Check], sources: dict[str, str], key_cols: dict[str, str]) -> str:
    selects = []
    for c in checks:
        if c.kind not in ("failed_rows", "warn_rows"):
            continue
        selects.append(
            f"SELECT {_q(c.table)} AS table_name, {_q(c.name)} AS controle, CAST({key_cols[c.table]} AS VARCHAR) AS cle "
            f"FROM {sources[c.table]} WHERE {failing_predicate(c, 'duck')}"
        )
    return " UNION ALL ".join(selects)
