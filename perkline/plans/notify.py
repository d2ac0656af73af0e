"""Notification outbox (K11), message texts (F18) and anomaly digest.

The chat post itself is out of scope: the outbox is a table of messages to
send, and publishing flags the sent ids (M12).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perkline.config import NOTIFY_TOP_K, SOURCE_FORM
from perkline.functions.display import display_km, display_minutes, notification_text
from perkline.operators.mutate import mark_published
from perkline.session import scratch_path


def with_names(activity: DataFrame, link: DataFrame, roster: DataFrame) -> DataFrame:
    """Activity rows with the employee's first and last name."""
    names = link.select("id_salarie_brut", "cle_salarie").join(
        roster.select("id_salarie_brut", "nom", "prenom"), "id_salarie_brut", "inner"
    )
    return activity.join(names.drop("id_salarie_brut"), "cle_salarie", "inner")


def lookup_pairs(file_rows: DataFrame, activity: DataFrame, link: DataFrame, roster: DataFrame) -> DataFrame:
    """(employee, start) pairs of the file found among the table's form
    rows — one bulk join instead of per-row lookups."""
    pairs = file_rows.filter(F.col("source_donnee") == SOURCE_FORM).select(
        "cle_salarie",
        "date_debut",
        F.col("type_activite").alias("f_type"),
        F.col("duree_sec").alias("f_duree"),
        F.col("distance_m").alias("f_distance"),
        F.col("commentaire").alias("f_commentaire"),
    )
    table = activity.filter(F.col("source_donnee") == SOURCE_FORM).select("cle_salarie", "date_debut", "id_activite", "flag_slack")
    found = pairs.join(table, ["cle_salarie", "date_debut"], "inner")
    return with_names(found, link, roster).select(
        "cle_salarie",
        "date_debut",
        "id_activite",
        "flag_slack",
        F.trim(F.coalesce("prenom", F.lit(""))).alias("prenom"),
        F.trim(F.coalesce("nom", F.lit(""))).alias("nom"),
        "f_type",
        "f_duree",
        "f_distance",
        "f_commentaire",
    )


def pending(found: DataFrame, force: bool = False) -> DataFrame:
    """Not yet published (flag not TRUE), unless forced."""
    if force:
        return found
    return found.filter(~F.coalesce(F.col("flag_slack"), F.lit(False)))


def messages(rows: DataFrame, type_col: str, duree_col: str, dist_col: str, comment_col: str) -> DataFrame:
    return rows.select(
        "id_activite",
        notification_text(
            "prenom", "nom", type_col, display_km(dist_col), display_minutes(duree_col), F.coalesce(F.col(comment_col), F.lit(""))
        ).alias("message"),
    )


def latest_k(activity: DataFrame, link: DataFrame, roster: DataFrame, k: int = NOTIFY_TOP_K) -> DataFrame:
    """L2: the k most recent form activities (start desc, id desc).
    ``orderBy + limit`` runs as a per-partition top-k and a final merge."""
    forms = activity.filter(F.col("source_donnee") == SOURCE_FORM)
    top = forms.orderBy(F.col("date_debut").desc(), F.col("id_activite").desc()).limit(k)
    return with_names(top, link, roster).select(
        "id_activite",
        "prenom",
        "nom",
        "type_activite",
        "duree_sec",
        "distance_m",
        F.coalesce("commentaire", F.lit("")).alias("commentaire"),
        "date_debut",
    )


def outbox(file_rows: DataFrame, activity: DataFrame, link: DataFrame, roster: DataFrame, force: bool = False,
           k: int = NOTIFY_TOP_K) -> DataFrame:
    """Messages of pending activities; when forced and nothing is
    pending, the k most recent form activities instead (fallback)."""
    found = lookup_pairs(file_rows, activity, link, roster)
    todo = messages(pending(found, force), "f_type", "f_duree", "f_distance", "f_commentaire").withColumn(
        "origine", F.lit("pending")
    )
    if not force:
        return todo
    fallback = messages(
        latest_k(activity, link, roster, k).select(
            "id_activite", F.trim("prenom").alias("prenom"), F.trim("nom").alias("nom"), "type_activite", "duree_sec", "distance_m",
            "commentaire",
        ),
        "type_activite",
        "duree_sec",
        "distance_m",
        "commentaire",
    ).withColumn("origine", F.lit("fallback"))
    none_pending = ~todo.select(F.lit(1)).limit(1).exists()
    return todo.unionByName(fallback.filter(none_pending))


# ---------------------------------------------------------------------------
# Publication that can be run again
# ---------------------------------------------------------------------------
LEDGER = "id_activite long, empreinte string, run string"


class Ledger:
    """Digests of the messages handed over, in a Parquet folder that only grows.

    Handing over a message and setting its flag are two writes.  The ledger is
    the one that decides: a run hands over what is pending and not in it, then
    flags what is in it.  A run that fails between both is run again without a
    second message, and sets the flags that are missing.  A forced run sends
    published activities again, once: there the digests of its own run count.
    """

    def __init__(self, spark, path: str | None = None):
        self.spark = spark
        self.path = path or scratch_path(spark, "publication-ledger")

    def rows(self) -> DataFrame:
        # an empty first file, so that the folder can be read
        if not getattr(self, "_made", False):
            self.spark.createDataFrame([], LEDGER).write.mode("append").parquet(self.path)
            self._made = True
        return self.spark.read.schema(LEDGER).parquet(self.path)

    def unsent(self, box: DataFrame, run: str, force: bool = False) -> DataFrame:
        """Messages of ``box`` that were not handed over yet."""
        mine = F.col("run") == run if force else F.lit(True)
        sent = self.rows().where(mine).select("id_activite", "empreinte").distinct()
        marked = box.withColumn("empreinte", message_digest())
        return marked.join(sent, ["id_activite", "empreinte"], "left_anti").select(*box.columns, "empreinte")

    def hand_over(self, unsent: DataFrame, run: str) -> None:
        """Records the messages of a written outbox as sent (one append; a
        failed one leaves nothing)."""
        unsent.select("id_activite", "empreinte", F.lit(run).alias("run")).write.mode("append").parquet(self.path)

    def flagged(self, activity: DataFrame) -> DataFrame:
        """The activity table with the flags of everything sent."""
        return mark_published(activity, self.rows().select("id_activite"))


def message_digest():
    """Digest of a message and the activity it announces."""
    return F.sha2(F.concat_ws("|", F.col("id_activite").cast("string"), "message"), 256)


# ---------------------------------------------------------------------------
# F19 anomaly digest
# ---------------------------------------------------------------------------
DIGEST_PREFIX = "ALERTE"
ANOMALY_EXAMPLES = 3
ANOMALY_FULL_LIST_BELOW = 10


def _row_line(df: DataFrame, cols) -> DataFrame:
    vals = F.concat_ws(",", *[F.when(F.length(F.trim(F.col(c))) > 0, F.trim(F.col(c))) for c in cols])
    reason = F.trim(F.coalesce(F.col("raison"), F.lit("")))
    prefix = F.when(F.length(reason) > 0, F.concat(F.lit("*"), reason, F.lit("* "))).otherwise(F.lit("*raison manquante*"))
    text = F.when(F.length(vals) > 0, F.concat(F.lit("• "), prefix, F.lit(" : "), vals)).otherwise(F.concat(F.lit("• "), prefix))
    return df.select(text.alias("texte"), "*")


def anomaly_digest(errors: DataFrame, anomalies: DataFrame, cols, flow: str, run_tag: str, source_file: str) -> DataFrame:
    """digest lines ``(section, ordre, texte)``; sorting by
    (section, ordre) gives the message.  Every error is listed; anomalies
    are all listed below 10, otherwise 3 examples (first in file order)."""
    n_err = errors.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    n_ano = anomalies.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    status = F.when(n_err > 0, F.lit("FAILURE")).otherwise(F.lit("ANOMALIES"))
    one = errors.sparkSession.range(1)
    head = one.select(
        F.explode(
            F.array(
                F.struct(F.lit(1).alias("o"), F.concat(F.lit(f"{DIGEST_PREFIX} | {flow} | "), status, F.lit(f" | run={run_tag}")).alias("t")),
                F.struct(
                    F.lit(2).alias("o"),
                    F.concat(F.lit("Erreurs bloquantes: "), n_err.cast("string"), F.lit(" | Anomalies: "), n_ano.cast("string")).alias("t"),
                ),
                F.struct(F.lit(3).alias("o"), F.lit(f"Fichier source: {source_file}").alias("t")),
            )
        ).alias("h")
    ).select(F.lit(0).alias("section"), F.col("h.o").cast("long").alias("ordre"), F.col("h.t").alias("texte"))
    err_title = one.filter(n_err > 0).select(F.lit(1).alias("section"), F.lit(-1).cast("long").alias("ordre"),
                                              F.lit("--- ERREURS BLOQUANTES ---").alias("texte"))
    err_lines = _row_line(errors, cols).select(F.lit(1).alias("section"), F.col("ligne").cast("long").alias("ordre"), "texte")
    ano_title = one.filter(n_ano > 0).select(F.lit(2).alias("section"), F.lit(-2).cast("long").alias("ordre"),
                                              F.lit("--- ANOMALIES ---").alias("texte"))
    ano_note = one.filter(n_ano >= ANOMALY_FULL_LIST_BELOW).select(
        F.lit(2).alias("section"),
        F.lit(-1).cast("long").alias("ordre"),
        F.concat(F.lit("Anomalies: "), n_ano.cast("string"), F.lit(f" (affichage limité à {ANOMALY_EXAMPLES} exemples)")).alias("texte"),
    )
    ano_lines = _row_line(anomalies, cols).select(F.lit(2).alias("section"), F.col("ligne").cast("long").alias("ordre"), "texte")
    # top-k is the feature here (examples); ties on the line number -> text
    examples = ano_lines.orderBy("ordre", "texte").limit(ANOMALY_EXAMPLES).filter(n_ano >= ANOMALY_FULL_LIST_BELOW)
    full = ano_lines.filter(n_ano < ANOMALY_FULL_LIST_BELOW)
    return head.unionByName(err_title).unionByName(err_lines).unionByName(ano_title).unionByName(ano_note).unionByName(
        examples
    ).unionByName(full)
