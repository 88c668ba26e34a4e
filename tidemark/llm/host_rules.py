"""Quality rules by host: documents are judged by the company they keep.

Every document is measured in whole and tested against the rules.  The failures
of each rule are added up by host, and a host's rate of failures is shrunk
towards the rate of all hosts: the prior is a beta distribution whose mean and
spread come from the hosts themselves, by moments, so a host of a few documents
weighs little and one of many stands by its own rate.  A host fails, and its
documents with it, when a shrunken rate is above the limit by more than its own
standard deviation under the prior.

Columns and functions of Spark SQL throughout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written

# --- fixed values of the contract ---------------------------------------------
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
# -------------------------------------------------------------------------------

# A host fails when a rule's shrunken rate of failures is surely above this.
HOST_LIMIT = 0.3
# Names of failed hosts up to this many bytes are broadcast; beyond that a host's
# documents are dealt over SALTS parts.
BROADCAST_BYTES = 32 << 20
SALTS = 64
# Least share of the hosts' spread that is not chance; 1 / this bounds the prior's weight.
MIN_SPREAD = 1e-6


def _without(text: Column, signs: str) -> Column:
    return F.translate(text, signs, "")


def _windows(words: Column, n: Column) -> Column:
    """Three-word windows with their places, sorted; one of nulls for fewer words."""
    last = F.greatest(n - 2, F.lit(0))
    return F.sort_array(F.arrays_zip(
        F.slice(words, F.lit(1), last).alias("a"), F.slice(words, F.lit(2), last).alias("b"), F.slice(words, F.lit(3), last).alias("c"),
        F.sequence(F.lit(0), F.greatest(n - 3, F.lit(0))).alias("at")))


def _repeated_words(windows: Column) -> Column:
    """Words in windows that occur twice or more: equal neighbours keep their places."""
    others = F.size(windows) - 1
    places = F.zip_with(F.slice(windows, F.lit(1), others), F.slice(windows, F.lit(2), others), lambda x, y: F.when(
        (x["c"] == y["c"]) & (x["b"] == y["b"]) & (x["a"] == y["a"]), F.array(x["at"], y["at"])))
    first = F.array_distinct(F.flatten(F.filter(places, lambda p: p.isNotNull())))
    return F.size(F.array_distinct(F.flatten(F.transform(first, lambda i: F.array(i, i + 1, i + 2)))))


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host: Column | None = None) -> DataFrame:
    """One row per document: ``doc_id, host, n_words, word_chars, n_symbols,
    n_lines, n_dup_lines, n_repeat_words``; lines are those with a word."""
    host = F.lit(None).cast("string") if host is None else host
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), host.cast("string").alias("host"),
                       F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    parts = rows.select("doc_id", "host", "text", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("words"),
                        F.filter(F.split("text", "\n", -1), lambda x: F.length(_without(x, BLANKS)) > 0).alias("lines"))
    # the windows are read twice and must not be sorted twice: they stay a column
    parts = parts.withColumn("windows", _windows(F.col("words"), F.size("words")))
    text, n = F.col("text"), F.size("words")
    return parts.select(
        "doc_id", "host", n.cast("long").alias("n_words"), F.length(_without(text, BLANKS)).cast("long").alias("word_chars"),
        (F.length(text) - F.length(_without(text, SYMBOLS))).cast("long").alias("n_symbols"), F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeated_words(F.col("windows")).cast("long").alias("n_repeat_words"))


def rules() -> dict[str, Column]:
    """Failures of a measured document, by rule."""
    n = F.col("n_words")
    return {
        "few_words": n < MIN_WORDS,
        "repeated_words": 100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * n,
        "symbols": 10 * F.col("n_symbols") > n,
        "repeated_lines": 10 * F.col("n_dup_lines") > 3 * F.col("n_lines"),
        "word_length": (F.col("word_chars") < 3 * n) | (F.col("word_chars") > 10 * n),
    }


def beta_priors(hosts: DataFrame, names: list[str]) -> dict[str, tuple[float, float]]:
    """``(a, b)`` of each rule's prior, from the hosts' ``n`` and failures ``name``:
    the mean is the rate of all documents, and a + b follows from how much more
    the hosts' rates differ than chance alone would have it."""
    sums = [F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n").cast("double")).alias("n2")]
    for name in names:
        sums += [F.sum(name).alias(f"f_{name}"), F.sum(F.col(name) * F.col(name) / F.col("n")).alias(f"s_{name}")]
    row = hosts.agg(*sums).first()
    out = {}
    for name in names:
        n = float(row.n or 0)
        mean = row[f"f_{name}"] / n if n else 0.0
        chance = mean * (1 - mean)
        spread = row[f"s_{name}"] - n * mean * mean if n else 0.0
        room = chance * (n - row.n2 / n - (row.k - 1)) if n else 0.0
        share = (spread - (row.k - 1) * chance) / room if room > 0 else MIN_SPREAD
        share = min(max(share, MIN_SPREAD), 1 - MIN_SPREAD)
        weight = (1 - share) / share
        out[name] = (mean * weight, (1 - mean) * weight)
    return out


def host_verdicts(documents: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """One row per host of measured documents: ``host, n``, the shrunken rate of
    every rule as ``rate_<rule>``, and ``failed``: the first rule whose rate is
    above ``limit`` by more than one standard deviation, or null.  Documents
    without a host have no row."""
    found = rules()
    hosts = written(documents.filter(F.col("host").isNotNull()).groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(test).alias(name) for name, test in found.items()]), "hosts")
    priors = beta_priors(hosts, list(found))
    rates = hosts.select("host", "n", *[
        ((F.col(name) + F.lit(a)) / (F.col("n") + F.lit(a + b))).alias(f"rate_{name}") for name, (a, b) in priors.items()])

    def surely(name: str, weight: float) -> Column:
        rate = F.col(f"rate_{name}")
        return rate - F.sqrt(rate * (1 - rate) / (F.col("n") + F.lit(weight + 1))) > limit

    return rates.withColumn("failed", F.coalesce(*[F.when(surely(name, a + b), F.lit(name)) for name, (a, b) in priors.items()]))


def with_verdicts(documents: DataFrame, verdicts: DataFrame) -> DataFrame:
    """``documents`` with ``host_failed``: the rule that their host fails, or null."""
    failed = written(verdicts.filter(F.col("failed").isNotNull()).select("host", F.col("failed").alias("host_failed")), "failed-hosts")
    size = failed.agg(F.sum(F.octet_length("host") + 32)).first()[0] or 0
    if size <= BROADCAST_BYTES:
        return documents.join(F.broadcast(failed), "host", "left")
    dealt = failed.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = (F.monotonically_increasing_id() % SALTS).cast("int")
    return documents.withColumn("salt", salt).join(dealt, ["host", "salt"], "left").drop("salt")


def judge_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host: Column | None = None,
                    limit: float = HOST_LIMIT) -> DataFrame:
    """One row per document: its measures, ``base_failed``, ``host_failed`` (the
    rule that its host fails, or null) and ``kept``.

    ``base_failed``: fewer than 50 words, or more than half of the words in
    repeated three-word windows.  ``kept`` is false for these and for documents
    of a failed host.  ``host`` is a column of ``docs`` (a source, or
    ``url_host``); documents with a null host are judged by themselves alone
    and count towards no host.  A null text counts as empty, so it is
    ``base_failed``; a null identifier stays null; repeated rows are judged and
    counted each; other columns are not read; empty input gives an empty result.
    """
    found = written(measured(docs, id_col, text_col, host), "measured")
    base = rules()["few_words"] | rules()["repeated_words"]
    judged = with_verdicts(found, host_verdicts(found, limit)).withColumn("base_failed", base)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         (~F.col("base_failed") & F.col("host_failed").isNull()).alias("kept"), "host", "host_failed")


def url_host(url: Column) -> Column:
    """Host of a web address in lower case, without a leading ``www.``; null if none."""
    host = F.lower(F.try_parse_url(url, F.lit("HOST")))
    return F.when(F.length(host) > 0, F.regexp_replace(host, r"^www\.", ""))
