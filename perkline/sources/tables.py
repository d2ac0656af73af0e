"""Driver-table scans and their binding to the benefits data model.

The engine's domain tables (HR roster, link table, activities, commute
checks, parameters, declared form rows, name reference) are bound to the
driver's Parquet tables by the rules documented in FIXTURES.md part B.  Each
binding is a lazy DataFrame over a pruned Parquet scan, so Catalyst pushes
projections and filters of the consuming job down to the files.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perkline.config import DEFAULT_RUN, RunConfig
from perkline.functions.dates import local_day
from perkline.functions.text import pseudonym


def scan(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan; splits are the file source's own."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _memo(method):
    """Build a binding once per ``Tables`` instance (DataFrames are
    immutable plans, so sharing one object is safe and saves plan analysis)."""
    import functools

    @functools.wraps(method)
    def wrapper(self, *args):
        key = (method.__name__, *args)
        if key not in self._cache:
            given = None if args else self.versions.get(method.__name__)
            self._cache[key] = method(self, *args) if given is None else given
        return self._cache[key]

    return wrapper


class Tables:
    """Lazy domain tables of one data directory; ``versions`` (table name ->
    frame) stand for the bound ones, as a run's own outputs do."""

    def __init__(self, spark: SparkSession, sf_dir: str, run: RunConfig = DEFAULT_RUN, versions: dict[str, DataFrame] | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.run = run
        self.versions = versions or {}
        self._cache: dict = {}

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str, run: RunConfig = DEFAULT_RUN) -> "Tables":
        return cls(spark, sf_dir, run)

    @_memo
    def raw(self, name: str) -> DataFrame:
        return scan(self.spark, self.sf_dir, name)

    # -- HR roster (sec.rh_salarie) + pseudonym --------------------------
    @_memo
    def roster(self) -> DataFrame:
        c = self.raw("customer")
        key = F.col("c_custkey")
        mode = (
            F.when(key % 6 == 0, "Marche/running")
            .when(key % 6 == 1, " VÉLO/trottinette/autres ")
            .when(key % 6 == 2, "Transports en commun")
            .when(key % 6 == 3, "véhicule  thermique/électrique")
            .when(key % 6 == 4, F.lit(None).cast("string"))
            .otherwise("Hoverboard")
        )
        sport = (
            F.when(key % 4 == 0, "Natation")
            .when(key % 4 == 1, "Tennis")
            .when(key % 4 == 2, "")
            .otherwise(F.lit(None).cast("string"))
        )
        return c.select(
            key.cast("string").alias("id_salarie_brut"),
            pseudonym(key.cast("string"), self.run.salt).alias("cle_salarie"),
            F.col("c_name").alias("nom"),
            F.col("c_mktsegment").alias("prenom"),
            F.concat(F.lit("BU"), F.col("c_nationkey").cast("string")).alias("bu"),
            F.when(key % 50 != 0, F.date_add(F.lit("1955-01-01").cast("date"), ((key * 7919) % 18000).cast("int"))).alias(
                "date_naissance"
            ),
            F.when(key % 17 != 0, F.col("c_acctbal").cast("decimal(12,2)")).alias("brut_annuel"),
            mode.alias("mod_depl_decl"),
            sport.alias("sport_declare"),
            (key % 23 != 0).alias("actif"),
            # derived home address (the driver tables carry none): some
            # employees have none or a blank one, as real rosters do
            F.when(key % 13 == 0, F.lit(None).cast("string"))
            .when(key % 13 == 1, F.lit("  "))
            .otherwise(F.concat(key.cast("string"), F.lit(" avenue "), F.col("c_mktsegment")))
            .alias("adresse_dom"),
            F.when(key % 5 == 0, "CDD").otherwise("CDI").alias("type_contrat"),
            F.when(key % 31 != 0, F.date_add(F.lit("1990-01-01").cast("date"), ((key * 31) % 12000).cast("int"))).alias(
                "date_embauche"
            ),
        )

    @_memo
    def link(self) -> DataFrame:
        """sec.lien_salarie: raw id <-> pseudonym."""
        return self.roster().select("id_salarie_brut", "cle_salarie")

    # -- activities (metier.activite) ------------------------------------
    @_memo
    def activities(self) -> DataFrame:
        """Activity rows: every event under twice its id, plus a second copy
        of every 20th event under the odd id after it — exact duplicates for
        the dedup logic, with ids that cannot collide."""
        e = self.raw("events").select("event_id", "ts", "user_id", "event_type", "value", (F.col("event_id") * 2).alias("ident"))
        dup = e.filter(F.col("event_id") % 20 == 0).withColumn("ident", F.col("ident") + 1)
        both = e.unionByName(dup)
        et = F.col("event_type")
        label = (
            F.when(et == "view", "Runing")
            .when(et == "signup", "  natation ")
            .when(et == "click", "Tennis  de   table")
            .when(et == "purchase", "RANDONNÉE")
            .otherwise("Curling")
        )
        ident = F.col("event_id")
        return both.select(
            F.col("ident").alias("id_activite"),
            pseudonym(F.col("user_id").cast("string"), self.run.salt).alias("cle_salarie"),
            F.col("ts").alias("date_debut"),
            local_day("ts", self.run.zone).alias("jour"),
            F.floor(F.col("value") * 60).cast("int").alias("duree_sec"),
            label.alias("type_activite"),
            F.when(et.isin("view", "signup", "purchase") & (ident % 11 != 0), ((ident * 37) % 40000).cast("int")).alias(
                "distance_m"
            ),
            F.when(ident % 3 == 0, F.concat(F.lit("note "), ident.cast("string"))).otherwise(F.lit("")).alias("commentaire"),
            F.when(ident % 4 == 0, "csv_simule").otherwise("csv_gsheet").alias("source_donnee"),
        )

    # -- commute checks (input of metier.ctrl_trajet) --------------------
    @_memo
    def commute_raw(self) -> DataFrame:
        o = self.raw("orders")
        pr = F.col("o_orderpriority")
        mode = (
            F.when(pr == "1-URGENT", "Marche/running")
            .when(pr == "2-HIGH", "Vélo/Trottinette/Autres")
            .when(pr == "3-MEDIUM", "Transports en commun")
            .when(pr == "5-LOW", "Trottinette volante")
            .otherwise("véhicule thermique/électrique")
        )
        # employees whose key is divisible by 9 have no check of their own:
        # those rows belong to people who are not on the roster
        person = F.when(F.col("o_custkey") % 9 == 0, F.concat(F.lit("ex-"), F.col("o_custkey").cast("string")))
        return o.select(
            F.col("o_orderkey").alias("id_ctrl"),
            pseudonym(F.coalesce(person, F.col("o_custkey").cast("string")), self.run.salt).alias("cle_salarie"),
            mode.alias("mode_trajet"),
            F.floor(F.col("o_totalprice") / 10).cast("int").alias("distance_m"),
            F.floor(F.col("o_totalprice") / 100).cast("int").alias("duree_sec"),
            F.col("o_orderdate").alias("date_ctrl"),
        )

    @_memo
    def commute_checks(self) -> DataFrame:
        """metier.ctrl_trajet: raw checks + threshold and incoherence flag."""
        from perkline.plans.commute import flag_incoherent

        return flag_incoherent(self.commute_raw(), self.params(), self.run)

    # -- parameters (metier.param, versioned) ----------------------------
    @_memo
    def params(self) -> DataFrame:
        rows = [
            ("taux_prime", "0.04", "2023-01-01"),
            ("taux_prime", "0.05", "2024-01-01"),
            ("taux_prime", "0.06", "2099-01-01"),
            ("jours_bien_etre", "5", "2023-01-01"),
            ("min_activites_bien_etre", "55", "2023-01-01"),
            ("montant_prime_fixe", "1500", "2023-01-01"),
            ("seuil_km_marche_course", "15", "2023-01-01"),
            ("seuil_km_velo_autres", "25", "2023-01-01"),
            ("adresse_entreprise", "1 rue Exemple", "2023-01-01"),
        ]
        df = self.spark.createDataFrame(rows, "code_param string, valeur_param string, date_effet string")
        return df.withColumn("date_effet", F.col("date_effet").cast("date"))

    # -- declared form rows (all strings) --------------------------------
    @_memo
    def declared(self) -> DataFrame:
        """Form export rows; ``ligne`` is the explicit input order."""
        e = self.raw("events").select("event_id", "ts", "user_id", "event_type")
        c = self.raw("customer").select("c_custkey", "c_name", "c_mktsegment")
        j = e.join(c, e.user_id == c.c_custkey, "inner")
        ident = F.col("event_id")
        et = F.col("event_type")
        name = (
            F.when(ident % 97 == 0, "Inconnu")
            # accents as people type them: composed, combining, beyond Latin Extended-A
            .when(ident % 83 == 0, F.replace("c_name", F.lit("o"), F.lit("\u00f4")))
            .when(ident % 89 == 0, F.replace("c_name", F.lit("o"), F.lit("o\u0302")))
            .when(ident % 101 == 0, F.replace("c_name", F.lit("o"), F.lit("\u1ed9")))
            # full-width letters and a ligature: one character for two
            .when(ident % 103 == 0, F.replace("c_name", F.lit("o"), F.lit("\uff4f")))
            .when(ident % 107 == 0, F.replace("c_name", F.lit("st"), F.lit("\ufb06")))
            .when(ident % 5 == 0, F.concat(F.lit(" "), F.upper("c_name"), F.lit(" ")))
            .otherwise(F.col("c_name"))
        )
        sport = (
            F.when(et == "view", "Runing")
            .when(et == "signup", "Natation")
            .when(et == "click", "Tennis")
            .when(et == "purchase", "Randonnée")
            .otherwise("")
        )
        dist = (
            F.when(ident % 7 == 0, "")
            .when(ident % 59 == 0, "abc")
            .otherwise(F.concat((ident % 30).cast("string"), F.lit(","), (ident % 10).cast("string")))
        )
        duration = F.when(ident % 61 == 0, "1h30").when(ident % 67 == 0, "9" * 20 + ":00:00").otherwise(
            F.concat(F.lit("0"), (ident % 3).cast("string"), F.lit(":"), (10 + ident % 50).cast("string"), F.lit(":00"))
        )
        return j.select(
            ident.alias("ligne"),
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("horodateur"),
            name.alias("nom"),
            F.col("c_mktsegment").alias("prenom"),
            F.when(ident % 53 == 0, "31/02/2024").otherwise(F.date_format("ts", "dd/MM/yyyy")).alias("date_txt"),
            sport.alias("sport"),
            dist.alias("distance_txt"),
            duration.alias("duree_txt"),
            F.when(ident % 33 == 0, F.concat(F.lit('"note '), ident.cast("string"), F.lit('\nsuite"')))
            .when(ident % 3 == 0, F.concat(F.lit('"note '), ident.cast("string"), F.lit('"')))
            .otherwise(F.lit(""))
            .alias("commentaire"),
        )

    # -- HR name reference (id, last name, first name) -------------------
    @_memo
    def name_reference(self) -> DataFrame:
        c = self.raw("customer").select("c_custkey", "c_name", "c_mktsegment")
        base = c.select(
            F.col("c_custkey").cast("string").alias("id_salarie_brut"),
            F.col("c_name").alias("nom"),
            F.col("c_mktsegment").alias("prenom"),
        )
        extra = c.filter(F.col("c_custkey") % 40 == 0).select(
            F.concat(F.lit("dup"), F.col("c_custkey").cast("string")).alias("id_salarie_brut"),
            F.upper("c_name").alias("nom"),
            F.col("c_mktsegment").alias("prenom"),
        )
        return base.unionByName(extra)

    # -- declared sport reference (id, declared sport) -------------------
    @_memo
    def sport_reference(self) -> DataFrame:
        """Declared sport per employee; ids divisible by 7 appear a second
        time later in the file (with another sport) — first row wins."""
        r = self.roster()
        base = r.select("id_salarie_brut", "sport_declare", (F.col("id_salarie_brut").try_cast("long") * 2).alias("ligne"))
        later = r.filter(F.col("id_salarie_brut").try_cast("long") % 7 == 0).select(
            "id_salarie_brut", F.lit("Judo").alias("sport_declare"), (F.col("id_salarie_brut").try_cast("long") * 2 + 1).alias("ligne")
        )
        return base.unionByName(later)

    # -- second versions (for upsert, diff, soft delete, fingerprint) ----
    @_memo
    def roster_v2(self) -> DataFrame:
        """Next HR file: ids ending in 0 are gone, ids divisible by 7 get a
        new business unit, and ids ending in 0 come back as new employees
        under "N" + id.  Sports of ids divisible by 7 change; the contract
        type or hire date alone changes for ids 3 and 4 modulo 11."""
        r = self.roster()
        k = F.col("id_salarie_brut").try_cast("long")
        cols = ["nom", "prenom", "date_naissance", "adresse_dom", "mod_depl_decl"]
        kept = r.filter(k % 10 != 0).select(
            "id_salarie_brut",
            *cols,
            F.when(k % 7 == 0, F.concat("bu", F.lit("_maj"))).otherwise(F.col("bu")).alias("bu"),
            F.when(k % 7 == 0, F.lit("Judo")).otherwise(F.col("sport_declare")).alias("sport_declare"),
            F.when(k % 11 == 3, F.lit("CDD")).otherwise(F.col("type_contrat")).alias("type_contrat"),
            F.when(k % 11 == 4, F.date_add("date_embauche", 1)).otherwise(F.col("date_embauche")).alias("date_embauche"),
        )
        new = r.filter(k % 10 == 0).select(
            F.concat(F.lit("N"), F.col("id_salarie_brut")).alias("id_salarie_brut"), *cols, "bu", "sport_declare", "type_contrat", "date_embauche"
        )
        return kept.unionByName(new)

    @_memo
    def activity_table(self) -> DataFrame:
        """metier.activite as stored: unique on (employee, start, source) —
        the smallest id of each key — with ingestion date and flag."""
        from perkline.operators.dedup import keep_one_per_group

        a = self.activities().drop("jour")
        one = keep_one_per_group(a, ["cle_salarie", "date_debut", "source_donnee"], order=[("id_activite", "asc")])
        return one.select(
            "id_activite",
            "cle_salarie",
            "date_debut",
            "duree_sec",
            "type_activite",
            "distance_m",
            "commentaire",
            "source_donnee",
            F.lit(self.run.as_of).cast("timestamp_ntz").alias("date_ingestion"),
            (F.col("id_activite") % 5 == 0).alias("flag_slack"),
        )

    @_memo
    def activity_source_v2(self) -> DataFrame:
        """Incoming activity file: ids ending in 0 are missing, ids divisible
        by 7 carry a new duration, and ids ending in 0 come back one hour
        later (new keys)."""
        a = self.activity_table()
        i = F.col("id_activite")
        cols = ["cle_salarie", "date_debut", "duree_sec", "distance_m", "type_activite", "commentaire", "source_donnee"]
        kept = a.filter(i % 10 != 0).withColumn(
            "duree_sec", F.when(i % 7 == 0, F.col("duree_sec") + 60).otherwise(F.col("duree_sec"))
        )
        moved = a.filter(i % 10 == 0).withColumn("date_debut", F.col("date_debut") + F.expr("INTERVAL 1 HOUR"))
        return kept.select(*cols).unionByName(moved.select(*cols))
