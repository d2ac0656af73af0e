"""URL filter: a character language-model ratio behind allow and block rules.

Rules decide what they fit.  The URLs they decide, with a short list of seed
words, are the labelled examples from which two variable-order Markov models
over characters are learned, one of accepted and one of rejected URLs: the
estimate after a context of up to three characters is blended with that of
the next shorter one by the number of distinct successors seen (Witten and
Bell), down to the uniform one.  An undecided URL is judged by the difference
of its log-likelihoods per character against a threshold, calibrated on
labelled URLs that the models did not see (smallest mean of both error
rates).

Only DataFrame functions are used.  Characters fall in 32 classes, so a model
up to order three is a table of 32^4 differences at most, of fixed size
whatever the corpus; it is broadcast, and distinct URLs are scored against it
after one shuffle by URL.  Learning counts 4-grams, added up before the
shuffle; shorter contexts are sums of those.

Defined cases: a NULL URL, or one without ``://``, has an empty host and path
and fits no rule; a URL without characters scores 0; when either label has no
calibration example the threshold is 0; repeated rows are each judged; an
empty table gives an empty result; all columns are kept, those that clash
with a computed one are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perkline.llm.common import fresh, let, stored

#: (verdict, host, path)
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: words of hosts that are known to be good or bad before any page is seen
ACCEPTED_WORDS = "news library museum school university science research wiki docs blog journal archive".split()
REJECTED_WORDS = "casino poker bets betting pills pharmacy viagra porn xxx escort loans spam ads tracker lottery replica".split()
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: class 0 is any other character, 1-26 letters, 27 digits, 28-30 as here,
#: 31 what stands before the first character
CLASSES = LOWER + "0" + ".-/"
BEFORE = 31
ORDER = 3
CALIBRATION_FOLDS = 4
BIN = 0.05
BINS = 400


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; empty without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def apply_rules(host: Column, path: Column, rules=RULES) -> Column:
    """``struct(rule, verdict)`` of the longest rule that fits (of equally
    long ones the first in code point order), or NULL."""
    fits = []
    for verdict, rule_host, rule_path in rules:
        on = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        rule = rule_host + rule_path
        fits.append(
            F.when(on, F.struct(F.lit(-len(rule)).alias("n"), F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict")))
        )
    return F.array_min(F.array(*fits)) if fits else F.lit(None).cast("struct<n: int, rule: string, verdict: string>")


def gram_codes(url: Column) -> Column:
    """For each character the classes of it and the three before, as one
    number."""
    plain = F.translate(F.translate(F.coalesce(url, F.lit("")), UPPER, LOWER), "123456789", "0" * 9)
    chars = F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, ""))
    classes = F.transform(chars, lambda c: F.call_function("instr", F.lit(CLASSES), c))

    def codes(k: Column) -> Column:
        def back(i: Column, n: int) -> Column:
            return F.shiftleft(F.coalesce(F.get(k, i - n), F.lit(BEFORE)), 5 * n)

        return F.transform(k, lambda c, i: c + back(i, 1) + back(i, 2) + back(i, 3))

    return let(classes, codes)


def _model(codes: DataFrame, grams: DataFrame, name: str) -> DataFrame:
    """``codes`` with the probability ``name`` of the last of a code's four
    classes after the first three, from ``grams (code, n)``."""
    out = codes.withColumn(name, F.lit(1 / 32))
    for order in range(ORDER + 1):
        span = 32 ** (order + 1)
        seen = grams.groupBy((F.col("code") % span).alias("gram")).agg(F.sum("n").alias("n"))
        contexts = seen.groupBy(F.floor(F.col("gram") / 32).alias("context")).agg(
            F.sum("n").alias("total"), F.count("*").alias("kinds")
        )
        blended = (F.coalesce("n", F.lit(0)) + F.col("kinds") * F.col(name)) / (F.col("total") + F.col("kinds"))
        out = (
            out.withColumn("gram", F.col("code") % span)
            .withColumn("context", F.floor(F.col("gram") / 32))
            .join(seen, "gram", "left")
            .join(contexts, "context", "left")
            .withColumn(name, F.when(F.col("total") > 0, blended).otherwise(F.col(name)))
            .drop("gram", "context", "n", "total", "kinds")
        )
    return out


def learn(labelled: DataFrame, urls: DataFrame) -> DataFrame:
    """``code, ratio``: ln p(accepted) - ln p(rejected) from ``labelled (url,
    accepted)``, for the codes found in ``urls (url)``; 32^4 rows at most."""
    grams = labelled.select("accepted", F.explode(gram_codes(F.col("url"))).alias("code"))
    counts = stored(grams.groupBy("accepted", "code").agg(F.count("*").alias("n")), "url-grams")
    codes = urls.select(F.explode(gram_codes(F.col("url"))).alias("code")).distinct()
    both = _model(codes, counts.where("accepted").select("code", "n"), "p")
    both = _model(both, counts.where("NOT accepted").select("code", "n"), "q")
    return stored(both.select("code", F.log(F.col("p") / F.col("q")).alias("ratio")), "url-model")


def scored(urls: DataFrame, ratio: DataFrame) -> DataFrame:
    """``url, score`` of distinct ``urls (url)``: log-likelihood difference
    per character; positive: as accepted.  The table has a fixed bound (32^4
    rows) and is broadcast, so each URL is scored where it lies."""
    codes = urls.select("url", F.explode(gram_codes(F.col("url"))).alias("code"))
    return codes.join(F.broadcast(ratio), "code").groupBy("url").agg(F.avg("ratio").alias("score"))


def calibrate(examples: DataFrame) -> DataFrame:
    """One row, one column ``threshold``: the bin edge with the smallest mean
    of both error rates on ``examples (score, accepted)``; of equally good
    ones the nearest to 0, then the lower."""
    bins = examples.select(
        F.least(F.greatest(F.floor(F.col("score") / BIN), F.lit(-BINS)), F.lit(BINS)).alias("bin"), "accepted"
    )
    found = bins.groupBy("bin").agg(
        F.count_if("accepted").alias("good"), F.count_if(~F.col("accepted")).alias("bad")
    )
    # every edge stands for choice, also those between two examples
    edges = examples.sparkSession.range(-BINS, BINS + 2).withColumnRenamed("id", "bin")
    counts = edges.join(found, "bin", "left").fillna(0, ["good", "bad"])
    below = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    errors = counts.select(
        (F.col("bin") * BIN).alias("edge"),
        (F.coalesce(F.sum("good").over(below), F.lit(0)) / F.sum("good").over(every)).alias("lost"),
        (1 - F.coalesce(F.sum("bad").over(below), F.lit(0)) / F.sum("bad").over(every)).alias("passed"),
        ((F.sum("good").over(every) > 0) & (F.sum("bad").over(every) > 0)).alias("known"),
    ).where("known")
    best = F.min(F.struct(F.round(F.col("lost") + F.col("passed"), 9).alias("e"), F.abs("edge").alias("d"), "edge"))
    return errors.agg(F.coalesce(best["edge"], F.lit(0.0)).alias("threshold"))


def seeds(spark) -> DataFrame:
    """``url, accepted``: one made-up URL for each seed word."""
    words = [(w, True) for w in ACCEPTED_WORDS] + [(w, False) for w in REJECTED_WORDS]
    rows = [F.struct(F.lit(f"https://www.{w}.com/").alias("url"), F.lit(good).alias("accepted")) for w, good in words]
    return spark.range(1).select(F.explode(F.array(*rows)).alias("s")).select("s.*")


def judge(pages: DataFrame, url: str = "url", rules=RULES) -> DataFrame:
    """``pages`` with ``host, path, rule, verdict`` (allow or block) and
    ``score``."""
    spark = pages.sparkSession
    host, path = host_path(F.col(url))
    base = pages.drop("host", "path", "rule", "verdict", "score")
    r, own = fresh("_r", pages.columns), fresh("_url", pages.columns)
    ruled = base.withColumns({"host": host, "path": path}).withColumn(r, apply_rules(F.col("host"), F.col("path"), rules))
    labelled = (
        ruled.where(F.col(r).isNotNull())
        .select(F.col(url).alias("url"), (F.col(f"{r}.verdict") == "allow").alias("accepted"))
        .distinct()
    )
    aside = F.crc32("url") % CALIBRATION_FOLDS == 0
    urls = base.select(F.col(url).alias("url")).distinct()
    scores = stored(scored(urls, learn(labelled.where(~aside).union(seeds(spark)), urls)), "url-scores")
    threshold = stored(calibrate(labelled.where(aside).join(scores, "url").select("score", "accepted")), "url-threshold")
    by_url = scores.withColumnRenamed("url", own)
    return (
        ruled.join(by_url, ruled[url] == by_url[own], "left")
        .withColumn("score", F.coalesce("score", F.lit(0.0)))
        .withColumn("rule", F.col(f"{r}.rule"))
        .withColumn(
            "verdict",
            F.coalesce(F.col(f"{r}.verdict"), F.when(F.col("score") >= threshold.scalar(), "allow").otherwise("block")),
        )
        .drop(r, own)
    )
