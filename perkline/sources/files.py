"""File sources (S1-S7) and file sinks.

Exports are Spark CSV datasets (a folder of part files per export).  The
newest one is chosen from the files' metadata alone, and only it is read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perkline.config import (
    ACTIVITY_COLUMNS,
    ACTIVITY_HEADER_REQUIRED,
    ROSTER_ALIASES,
    ROSTER_DATE_COLUMNS,
    SOURCE_FORM,
    SPORT_ID_ALIASES,
    SPORT_VALUE_ALIASES,
)
from perkline.functions.parse import parse_int_like, parse_iso_instant

# RFC-4180 style CSV (doubled quotes), empty text kept as '' — the format
# spreadsheet tools and pandas produce.
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "encoding": "UTF-8"}
_NO_NULL = "\u0000<null>\u0000"


def write_csv(df: DataFrame, path: str, header: bool = True) -> str:
    opts = dict(
        CSV_OPTIONS,
        header=str(header).lower(),
        nullValue="",
        emptyValue='""',
        ignoreLeadingWhiteSpace="false",
        ignoreTrailingWhiteSpace="false",
    )
    df.write.mode("errorifexists").options(**opts).csv(path)
    return path


def check_columns(columns: Sequence[str], required: Sequence[str]) -> None:
    """Required-column check (order not enforced); the error lists all
    missing columns."""
    missing = [c for c in required if c not in columns]
    if missing:
        raise KeyError(f"missing columns: {missing}")


def read_declared(spark: SparkSession, path: str, required: Sequence[str]) -> DataFrame:
    """S3: all-string CSV scan, no NA conversion (blank stays ''), required
    columns checked.  ``_metadata`` is exposed as ``_fichier`` columns."""
    # a quoted cell may hold line breaks
    raw = spark.read.options(**CSV_OPTIONS, multiLine="true", nullValue=_NO_NULL, inferSchema="false").csv(path)
    check_columns(raw.columns, required)
    # the parser still yields NULL for an empty unquoted field: blank is ''
    return raw.select(
        *[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in raw.columns],
        F.col("_metadata.file_name").alias("_fichier"),
        F.col("_metadata.file_modification_time").alias("_mtime"),
        F.col("_metadata.file_path").alias("_chemin"),
    )


def latest_export(spark: SparkSession, paths: str, by: str = "mtime") -> str:
    """Path of the newest export of a family (``paths`` is a glob of
    export folders).  ``by="mtime"``: the one whose files were modified last;
    ``by="name"``: the greatest name (timestamp prefix).

    Only the files' metadata is read, no content, and one row comes back; the
    caller then reads that export alone.
    """
    if by not in ("mtime", "name"):
        raise ValueError("by must be 'mtime' or 'name'")
    listed = spark.read.format("binaryFile").load(paths).select("path", "modificationTime")
    exports = listed.withColumn("folder", F.regexp_replace("path", "/[^/]*$", "")).groupBy("folder").agg(
        F.max("modificationTime").alias("m")
    )
    name = F.element_at(F.split("folder", "/"), -1)
    order = F.struct("m", name.alias("n")) if by == "mtime" else F.struct(name.alias("n"))
    found = exports.agg(F.max_by("folder", order).alias("folder")).first()["folder"]
    if found is None:
        raise FileNotFoundError(paths)
    return found


ACTIVITY_SCHEMA = T.StructType(
    [
        T.StructField("cle_salarie", T.StringType()),
        T.StructField("date_debut", T.StringType()),
        T.StructField("duree_sec", T.IntegerType()),
        T.StructField("distance_m", T.IntegerType()),
        T.StructField("type_activite", T.StringType()),
        T.StructField("commentaire", T.StringType()),
        T.StructField("source_donnee", T.StringType()),
    ]
)


#: number cells of a row that hold no number
BAD_NUMBERS = "nb_nombres_invalides"


def read_activities(spark: SparkSession, path: str, expected: Sequence[str] = ACTIVITY_COLUMNS) -> DataFrame:
    """Typed activity CSV, required columns checked (order free); the
    ISO offset instant becomes a UTC ``timestamp_ntz``.

    Numbers are read as their text says (``1200``, ``1200.0``); a number cell
    that is neither blank nor a number of the column's range is NULL, and
    counted in ``nb_nombres_invalides``."""
    raw = spark.read.options(**CSV_OPTIONS, multiLine="true", nullValue=_NO_NULL).csv(path)
    check_columns(raw.columns, expected)
    # read by name as text, so that neither order nor further columns matter
    numbers = {f.name for f in ACTIVITY_SCHEMA.fields if f.dataType == T.IntegerType()}
    read = {
        f.name: parse_int_like(F.col(f"`{f.name}`")).try_cast("int") if f.name in numbers else F.col(f"`{f.name}`") for f in ACTIVITY_SCHEMA.fields
    }
    bad = [F.when((F.length(F.trim(F.col(f"`{n}`"))) > 0) & read[n].isNull(), 1).otherwise(0) for n in sorted(numbers)]
    df = raw.select(*[c.alias(n) for n, c in read.items()], sum(bad[1:], bad[0]).alias(BAD_NUMBERS))
    return df.withColumn("date_debut", parse_iso_instant("date_debut")).withColumn(
        "commentaire", F.coalesce("commentaire", F.lit(""))
    )


def read_activities_tolerant(spark: SparkSession, path: str, long_records: str = "skip") -> tuple[DataFrame, DataFrame]:
    """Tolerant scan — header optional (detected per file), positional
    fallback, bad rows skipped; returns (rows, skipped records).

    Records (a quoted cell may hold line breaks) are read as text cells, so a
    malformed one never fails the job; the header (if any) is recognised by its
    content.  A skipped record is returned as it stands in the file.  One with
    more cells than columns most likely holds a comma that nobody quoted: it is
    skipped, or, with ``long_records="keep"``, read by its first cells.
    """
    if long_records not in ("skip", "keep"):
        raise ValueError("long_records must be 'skip' or 'keep'")
    names = [f"c{i}" for i in range(7)]
    options = dict(
        CSV_OPTIONS, header="false", multiLine="true", nullValue=_NO_NULL, mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt"
    )
    fields = ", ".join(f"{n} string" for n in [*names, "_corrupt"])
    records = spark.read.options(**options).schema(fields).csv(path)
    # Spark keeps the text of a record whose cells are not as many as the
    # columns; commas outside quotes tell a long one from a short one
    whole = F.regexp_replace("_corrupt", "[\\r\\n]+$", "")
    bare = F.regexp_replace(whole, '(?s)"(?:[^"\\\\]|\\\\.|"")*"', "")
    long_ = F.coalesce(F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) >= len(names), F.lit(False))
    parts = records.select(
        F.coalesce(whole, F.concat_ws(",", *names)).alias("value"),
        (long_ if long_records == "skip" else F.lit(False)).alias("_long"),
        F.col("_metadata.file_path").alias("_f"),
        F.struct(*names).alias("c"),
    )
    # NULL cells would make array_contains return NULL: compare on ''
    low = [F.coalesce(F.lower(F.trim(F.col(f"c.c{i}"))), F.lit("")) for i in range(7)]
    is_header = F.lit(True)
    for name in ACTIVITY_HEADER_REQUIRED:
        is_header = is_header & F.array_contains(F.array(*low), F.lit(name))
    # column positions come from a header line of the same file when present
    places = F.struct(*[F.array_position(F.array(*low), F.lit(n)).alias(f"_p_{n}") for n in ACTIVITY_COLUMNS])
    # one row per file that has a header, whatever its number of such lines
    headers = parts.filter(is_header).groupBy("_f").agg(F.min(places).alias("_p")).select("_f", "_p.*")
    body = parts.filter(~is_header).join(headers, "_f", "left")
    arr = F.array(*[F.col(f"c.c{i}") for i in range(7)])

    def cell(name: str, pos: int) -> Column:
        # a place in the header, 0 where it lacks the column; else the fixed one
        return F.get(arr, F.coalesce(F.col(f"_p_{name}"), F.lit(pos + 1).cast("long")).cast("int") - 1)

    # a step of its own: every cell is picked and trimmed once
    body = body.select("value", "_long", *[F.trim(F.coalesce(cell(n, i), F.lit(""))).alias(f"_r_{n}") for i, n in enumerate(ACTIVITY_COLUMNS)])
    raw = {n: F.col(f"_r_{n}") for n in ACTIVITY_COLUMNS}
    dist_txt = raw["distance_m"]
    parsed = body.select(
        "value",
        "_long",
        raw["cle_salarie"].alias("cle_salarie"),
        parse_iso_instant(raw["date_debut"]).alias("date_debut"),
        parse_int_like(raw["duree_sec"]).alias("duree_sec"),
        F.when(F.length(dist_txt) > 0, parse_int_like(dist_txt)).alias("distance_m"),
        F.when(F.length(dist_txt) > 0, parse_int_like(dist_txt).isNull()).otherwise(F.lit(False)).alias("_dist_bad"),
        raw["type_activite"].alias("type_activite"),
        raw["commentaire"].alias("commentaire"),
        F.when(F.length(raw["source_donnee"]) > 0, raw["source_donnee"]).otherwise(F.lit(SOURCE_FORM)).alias("source_donnee"),
    )
    ok = (
        (F.length("cle_salarie") > 0)
        & (F.length("type_activite") > 0)
        & F.col("date_debut").isNotNull()
        & F.col("duree_sec").isNotNull()
        & ~F.col("_dist_bad")
        & ~F.col("_long")
    )
    rows = parsed.filter(ok).select(*ACTIVITY_COLUMNS)
    skipped = parsed.filter(~ok).select(F.col("value").alias("ligne_ignoree"))
    return rows, skipped


def _resolve(columns: Sequence[str], candidates: Sequence[str]) -> str | None:
    lower = {c.strip().lower(): c for c in columns}
    for cand in candidates:
        hit = lower.get(cand.strip().lower())
        if hit is not None:
            return hit
    return None


def read_roster(df: DataFrame, aliases: dict = ROSTER_ALIASES) -> DataFrame:
    """Alias header -> canonical column (case-insensitive), trimmed
    strings, lenient dates (invalid -> NULL); error on a missing column."""
    cols = []
    for canonical, cands in aliases.items():
        actual = _resolve(df.columns, cands)
        if actual is None:
            raise ValueError(f"missing HR column: {canonical}")
        c = F.trim(F.col(f"`{actual}`").cast("string"))
        if canonical in ROSTER_DATE_COLUMNS:
            c = F.coalesce(F.try_to_date(c, "yyyy-MM-dd"), F.try_to_date(c, "dd/MM/yyyy"))
        cols.append(c.alias(canonical))
    return df.select(*cols)


def read_declared_sport(df: DataFrame) -> DataFrame:
    """Declared-sport sheet with soft column names, trimmed values."""
    id_col = _resolve(df.columns, SPORT_ID_ALIASES)
    sport_col = _resolve(df.columns, SPORT_VALUE_ALIASES)
    if id_col is None or sport_col is None:
        raise ValueError("missing columns in the declared-sport sheet (id / sport)")
    return df.select(
        F.trim(F.col(f"`{id_col}`").cast("string")).alias("id_salarie_brut"),
        F.trim(F.coalesce(F.col(f"`{sport_col}`").cast("string"), F.lit(""))).alias("sport_declare"),
    )


def iso_offset_text(ts: Column | str, zone: str = "Europe/Paris") -> Column:
    """``yyyy-MM-ddTHH:mm:ss+hhmm`` of a UTC instant in ``zone``."""
    t = F.col(ts) if isinstance(ts, str) else ts
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), t)
    minutes = F.timestamp_diff("MINUTE", t, local)
    sign = F.when(minutes < 0, F.lit("-")).otherwise(F.lit("+"))
    a = F.abs(minutes)
    return F.concat(
        F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss"),
        sign,
        F.lpad((a / 60).cast("int").cast("string"), 2, "0"),
        F.lpad((a % 60).cast("string"), 2, "0"),
    )


def normalised_output(clean: DataFrame, zone: str = "Europe/Paris") -> DataFrame:
    """Normalised activity rows, fixed column order, ISO offset text."""
    return clean.select(
        "cle_salarie",
        iso_offset_text("date_debut", zone).alias("date_debut"),
        "duree_sec",
        "distance_m",
        "type_activite",
        "commentaire",
        "source_donnee",
    )
