"""Host-level quality rules.

Every document is judged by text rules; failures are aggregated by host, the
host's failure rate is shrunk towards the corpus by an empirical beta prior,
and the verdict on the host is joined back to its documents.  For its host a
document also fails by too many symbols or repeated lines (``host_fault``),
which alone does not remove it.  A host goes if its rate, less two standard
deviations of the posterior, is above ``MAX_HOST_RATE`` and if its odds of
failure are ``MIN_ODDS_RATIO`` times those of the corpus.  Everything is a
built-in expression: the rules are computed inside the row (no explode, no
shuffle of words), and only ``(host, failed)`` crosses the shuffle, partially
aggregated, so a host with a third of the rows costs one row a task.

Defined cases: a NULL text has no words (and fails, having too few); an empty
text likewise; a NULL host has no host verdict; repeated rows are judged one
by one and all count towards the host; an empty table gives an empty result;
extra columns are kept, those that clash with a computed one are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perkline.llm.common import WHITE, fresh, let, stored

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: a document with so many symbols per 100 characters of words, or with more
#: than so many repeated among 100 lines, counts against its host
MAX_SYMBOL_PERCENT = 10
MAX_DUP_LINE_PERCENT = 30
#: a host is rejected when most of its documents surely fail, and by odds so
#: many times those of the corpus
MAX_HOST_RATE = 0.5
MIN_ODDS_RATIO = 4.0
DEVIATIONS = 2.0
#: bounds of the fitted prior's weight in documents
PRIOR_WEIGHT = (2.0, 1000.0)


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+``; NULL has none."""
    parts = F.split(F.trim(F.translate(F.coalesce(text, F.lit("")), WHITE, " " * len(WHITE))), " +")
    return F.filter(parts, lambda w: w != "")


def repeat_words(found: Column) -> Column:
    """Words that lie in a 3-word window found twice or more in the text.

    Each window becomes one long, its hash above its place, so sorting longs
    brings equal windows together; the place takes only the bits it needs.
    """

    def covered(places: Column) -> Column:
        gaps = F.zip_with(
            F.slice(places, 2, F.greatest(F.size(places) - 1, F.lit(0))),
            F.slice(places, 1, F.greatest(F.size(places) - 1, F.lit(0))),
            lambda b, a: F.least(b - a, F.lit(3).cast("long")),
        )
        total = F.aggregate(gaps, F.lit(0).cast("long"), lambda s, g: s + g)
        return F.when(F.size(places) == 0, F.lit(0).cast("long")).otherwise(total + 3)

    def in_words(w: Column) -> Column:
        bits = F.length(F.bin(F.size(w)))
        windows = F.transform(
            F.sequence(F.lit(1), F.size(w) - 2),
            lambda i: F.xxhash64(F.get(w, i - 1), F.get(w, i), F.get(w, i + 1)),
        )

        def placed(b: Column) -> Column:
            coded = F.transform(windows, lambda h, i: _left(_right(h, b), b).bitwiseOR(i.cast("long")))
            return let(F.sort_array(coded), lambda s: doubles(s, b))

        def doubles(s: Column, b: Column) -> Column:
            def equal(x: Column, other: Column) -> Column:
                return F.coalesce(_right(x, b) == _right(other, b), F.lit(False))

            twice = F.filter(s, lambda x, i: equal(x, F.get(s, i + 1)) | equal(x, F.get(s, i - 1)))
            places = F.sort_array(F.transform(twice, lambda x: x - _left(_right(x, b), b)))
            return let(places, covered)

        return F.when(F.size(w) < 4, F.lit(0).cast("long")).otherwise(let(bits, placed))

    return let(found, in_words)


def _left(x: Column, bits: Column) -> Column:
    return F.call_function("shiftleft", x, bits)


def _right(x: Column, bits: Column) -> Column:
    return F.call_function("shiftright", x, bits)


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``word_chars``, ``n_symbols``,
    ``n_dup_lines``, ``n_repeat_words``, ``base_failed`` and ``host_fault``."""
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: F.length(F.translate(x, WHITE, "")) > 0)

    def measured(w: Column) -> Column:
        return F.struct(F.size(w).cast("long").alias("n"), repeat_words(w).alias("r"))

    def in_lines(x: Column) -> Column:
        return F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"))

    m, li = fresh("_m", docs.columns), fresh("_li", docs.columns)
    out = docs.withColumns({m: let(words(F.col(text)), measured), li: let(lines, in_lines)})
    out = out.withColumns(
        {
            "n_words": F.col(f"{m}.n"),
            "word_chars": F.length(F.translate(body, WHITE, "")).cast("long"),
            "n_symbols": (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long"),
            "n_dup_lines": F.col(f"{li}.dup"),
            "n_repeat_words": F.col(f"{m}.r"),
            "base_failed": (F.col(f"{m}.n") < MIN_WORDS)
            | (100 * F.col(f"{m}.r") > MAX_REPEAT_PERCENT * F.col(f"{m}.n")),
        }
    )
    fault = (
        F.col("base_failed")
        | (100 * F.col("n_symbols") > MAX_SYMBOL_PERCENT * F.col("word_chars"))
        | (100 * F.col("n_dup_lines") > MAX_DUP_LINE_PERCENT * F.col(f"{li}.n"))
    )
    return out.withColumn("host_fault", fault).drop(m, li)


def host_verdicts(judged: DataFrame, host: str, failed: str, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """``host, host_docs, host_failed, host_rate, host_rejected``.

    The beta prior is fitted by moments over hosts: its mean is the corpus
    failure rate; its weight makes the spread between hosts the observed one
    less the binomial part.  ``host_rate`` is the posterior mean, and its
    lower bound is compared with ``max_rate``.
    """
    hosts = (
        judged.where(F.col(host).isNotNull())
        .groupBy(F.col(host).alias("host"))
        .agg(F.count("*").alias("host_docs"), F.sum(F.col(failed).cast("long")).alias("host_failed"))
    )
    rate = F.col("host_failed") / F.col("host_docs")
    sums = hosts.agg(
        F.sum("host_docs").alias("n"),
        F.sum("host_failed").alias("f"),
        F.count("*").alias("k"),
        F.sum(F.col("host_docs") * rate * rate).alias("sq"),
    )
    mean = F.col("f") / F.col("n")
    spread = F.col("sq") / F.col("n") - mean * mean
    within = mean * (1 - mean) * F.col("k") / F.col("n")
    between = spread - within
    # between = mean (1 - mean) / (weight + 1)
    weight = F.when(between > 0, mean * (1 - mean) / between - 1).otherwise(PRIOR_WEIGHT[1])
    prior = sums.select(
        F.struct(
            mean.alias("mean"), F.least(F.greatest(weight, F.lit(PRIOR_WEIGHT[0])), F.lit(PRIOR_WEIGHT[1])).alias("weight")
        ).alias("p")
    ).scalar()
    size = F.col("host_docs") + F.col("_p.weight")
    post, p = F.col("host_rate"), F.col("_p.mean")
    sure = post - DEVIATIONS * F.sqrt(post * (1 - post) / (size + 1)) > max_rate
    return (
        hosts.withColumn("_p", prior)
        .withColumn("host_rate", (F.col("host_failed") + p * F.col("_p.weight")) / size)
        .withColumn("host_rejected", sure & (post * (1 - p) > MIN_ODDS_RATIO * p * (1 - post)))
        .drop("_p")
    )


def judge(
    docs: DataFrame, host: str = "source", text: str = "text", max_rate: float = MAX_HOST_RATE, keep_text: bool = True
) -> DataFrame:
    """``docs`` (its text only if ``keep_text``) with the measures,
    ``base_failed``, ``host_fault``, ``host_rate`` (NULL for a NULL host),
    ``host_rejected`` and ``kept``.

    Without the text the measured rows are written once, as both the host
    table and the verdicts read them; texts are measured twice rather than
    copied.  The host table is written, so that the join is planned by its
    size and texts are not shuffled to meet a few hosts."""
    judged = measures(docs.drop("host_rate", "host_rejected", "kept"), text)
    if not keep_text:
        judged = stored(judged.drop(text), "host-measures")
    own = fresh("_host", judged.columns)
    hosts = host_verdicts(judged, host, "host_fault", max_rate).select(
        F.col("host").alias(own), "host_rate", "host_rejected"
    )
    hosts = stored(hosts, "host-verdicts")
    return (
        judged.join(hosts, judged[host] == hosts[own], "left")
        .drop(own)
        .withColumn("host_rejected", F.coalesce("host_rejected", F.lit(False)))
        .withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected"))
    )
