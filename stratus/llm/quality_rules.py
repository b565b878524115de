"""Rules on single documents, and verdicts on whole hosts from the rate at which their documents fail.

Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratus.llm.columns import bind
from stratus.llm.tables import store

#: White space between words, and the characters that count as symbols.
SYMBOL = "[#*$%&|<>]"
SPACE_RUN = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]"

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_HOST_RATE = 0.5
#: Bounds of the prior's weight in documents, and its weight where the hosts tell nothing about it.
PRIOR_BOUNDS = (1.0, 1_000_000.0)
PLAIN_PRIOR = 10.0


def words(text: Column) -> Column:
    """The words of a text in order; white space at either end gives no word."""
    return F.filter(F.split(text, SPACE_RUN), lambda w: w != "")


def repeated_words(ws: Column) -> Column:
    """Number of words inside 3-word windows that occur twice or more among ``ws``.

    The windows are sorted as word triples with their places, so equal ones become neighbours; the places of those
    are put in order again and the words they cover are counted. n log n for any text.
    """
    def windows(w: Column) -> Column:
        return F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0)))

    def hashes(w: Column) -> Column:
        return F.transform(windows(w), lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))

    def triples(w: Column) -> Column:
        # The hash only makes most comparisons short; the words decide.
        def triple(x: Column, i: Column) -> Column:
            b, c = F.get(w, i + 1), F.get(w, i + 2)
            return F.struct(F.xxhash64(x, b, c).alias("h"), x.alias("a"), b.alias("b"), c.alias("c"), i.alias("i"))

        return F.sort_array(F.transform(windows(w), triple))

    def same(x: Column, y: Column) -> Column:
        return (x["h"] == y["h"]) & (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"])

    def places(s: Column) -> Column:
        twice = F.filter(s, lambda x, j: F.coalesce(
            ((j > 0) & same(x, F.get(s, j - 1))) | same(x, F.get(s, j + 1)), F.lit(False)
        ))
        return F.sort_array(F.transform(twice, lambda x: x["i"]))

    def covered(p: Column) -> Column:
        each = F.transform(p, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(p, j + 1) - x, F.lit(3))))
        return F.aggregate(each, F.lit(0), lambda total, x: total + x)

    def counted(w: Column) -> Column:
        # Windows with all hashes different are all different: most texts need no more than that.
        none = F.size(F.array_distinct(hashes(w))) == F.size(windows(w))
        return F.when(none, 0).otherwise(bind(bind(triples(w), places), covered))

    return bind(ws, counted).cast("long")


def document_rules(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source",
    min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT,
) -> DataFrame:
    """Per input row: ``doc_id, host``, the counts of its text, and ``base_failed``.

    A null text counts as empty. ``n_words`` words, ``word_chars`` code points in them, ``n_symbols`` symbol
    characters, ``n_dup_lines`` lines with a word that equal an earlier line, ``n_repeat_words`` words in 3-word windows
    found twice or more. A document fails with fewer than ``min_words`` words or more than ``max_repeat_percent`` of
    its words repeated.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(host).cast("string").alias("host"),
        F.coalesce(F.col(text), F.lit("")).alias("body"),
    )
    lines = F.filter(F.split("body", "\n"), lambda x: x.rlike(WORD))
    counted = rows.select(
        "doc_id", "host", words(F.col("body")).alias("ws"), lines.alias("lines"),
        F.regexp_count("body", F.lit(SYMBOL)).cast("long").alias("n_symbols"),
    ).select(
        "doc_id", "host", F.size("ws").cast("long").alias("n_words"),
        F.length(F.array_join("ws", "")).cast("long").alias("word_chars"), "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("ws")).alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def beta_prior(hosts: float, n: float | None, failed: float, failed2: float, n2: float) -> tuple[float, float]:
    """Mean and weight of the prior, from five sums over all hosts."""
    if not n:
        return 0.0, PLAIN_PRIOR
    mean = failed / n
    if hosts < 2 or failed in (0.0, n) or n <= hosts:
        return mean, PLAIN_PRIOR
    spread = failed2 / 1e6 - failed * mean
    low, high = PRIOR_BOUNDS
    rho = (spread / (mean * (1 - mean)) - (hosts - 1)) / (n - n2 / n - (hosts - 1))
    return mean, high if rho <= 0 else min(max(1 / rho - 1, low), high)


def host_verdicts(rules: DataFrame, max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """Per host: ``n_docs, n_failed, fail_rate, host_kept``; rows without a host are left out.

    The hosts' failure rates are taken as draws from one beta distribution, whose mean is the rate of all documents
    and whose weight comes from how much more the hosts differ than chance alone explains (method of moments).
    A host's rate is the mean of that prior after seeing its own documents, so a host with few documents stays near
    the common rate. With one host only, or if all or none fail, the prior has the weight ``PLAIN_PRIOR``.
    """
    hosts = store(
        rules.filter("host IS NOT NULL").groupBy("host").agg(
            F.count("*").alias("n_docs"), F.count_if("base_failed").alias("n_failed")
        ),
        "quality-hosts",
    )
    n, f = F.col("n_docs").cast("double"), F.col("n_failed").cast("double")
    # Millionths summed as whole numbers: the same sum in any order.
    totals = hosts.agg(
        F.count("*").cast("double").alias("k"), F.sum("n_docs").cast("double").alias("n"),
        F.sum("n_failed").cast("double").alias("f"),
        F.sum(F.floor(1e6 * f * (f / n))).cast("double").alias("ff"),
        F.sum(F.col("n_docs").cast("decimal(38,0)") * F.col("n_docs")).cast("double").alias("nn"),
    )
    mean, weight = beta_prior(*totals.first())
    judged = hosts.withColumn("fail_rate", (f + F.lit(weight * mean)) / (n + F.lit(weight)))
    return judged.select("host", "n_docs", "n_failed", "fail_rate", (F.col("fail_rate") <= max_host_rate).alias("host_kept"))


def quality_rules(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source",
    min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT, max_host_rate: float = MAX_HOST_RATE,
) -> DataFrame:
    """Counts and verdicts per input row, repeated rows included; no rows in, no rows out.

    ``kept`` is false for a failed document, and for any document of a host whose shrunk failure rate is above
    ``max_host_rate``. A document without a host is judged by its own rules alone, with a null ``fail_rate``.
    Columns of ``docs`` other than the three are not looked at.
    """
    # Only the counts travel from here on; the texts are read once.
    rules = store(document_rules(docs, doc_id, text, host, min_words, max_repeat_percent), "quality-rules")
    hosts = store(host_verdicts(rules, max_host_rate), "quality-verdicts").select("host", "fail_rate", "host_kept")
    kept = ~F.col("base_failed") & F.coalesce("host_kept", F.lit(True))
    return rules.join(hosts, "host", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        kept.alias("kept"), "host", "fail_rate",
    )
