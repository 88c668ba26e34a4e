"""Secret scan with a random forest that removes false positives.

Patterns with high recall find candidates in whole texts: values assigned to a
credential word, and long unbroken strings with a digit, without their name.  Each candidate gets
its length, its character transitions under a model of the neighbouring words,
the share of it that dictionary words cover, signs of a path, and its
neighbouring words.  A forest trained on a bounded sample of labelled findings
scores them all.  Findings are labelled by the shape rules of ``label_rules`` where
these are sure; the forest decides the rest, and sees none of the rules.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import scratch_table, written

# Candidate shapes: a value after a credential word, a long value after any name
# and "=", or a long string of key characters with a digit in it.
KEYWORDS = ("token", "secret", "password", "passwd", "pwd", "api[_ .-]?key", "access[_ .-]?key", "private[_ .-]?key", "auth", "credential")
_WORD = "(?i:" + "|".join(KEYWORDS) + ")"
_KEY = "A-Za-z0-9+/_=.-"
# The word may lie within a name (DB_PASSWORD, AWS_ACCESS_KEY_ID, secretKey,
# tokens), which may be quoted; "author" is none.
_NAME = rf"{_WORD}(?:[sS](?![A-Za-z]))?(?:[_.-][\w.-]{{0,64}}+|[0-9][\w.-]{{0,64}}+|(?<=[a-z])[A-Z][\w.-]{{0,64}}+)?[\"']?\]?"
# A value may stand in the next line, unless that is an assignment itself.
_GAP = r"\h{0,32}+(?:[\r\n]{1,2}+\h{0,32}+(?![\"']?[\w.-]{1,64}+[\"']?\h{0,32}+(?:=|:\s)))?"
_LEAD = rf"(?:(?<![{_KEY}])[{_KEY}]{{0,256}}?)?{_NAME}\s{{0,32}}+[:=]{_GAP}[\"']?"
_VALUE = r"[^\s\"'<>]"
_RUN = rf"(?=[A-Za-z+/_=.-]*+[0-9])[{_KEY}]{{16,}}+"
_NAMED = rf"(?<![{_KEY}])[A-Za-z_][\w.-]{{0,63}}+="
# All but the first form are tried at the first key character of a run only; the
# repetitions that track back are bounded, so a text takes time in proportion to
# its length.
CANDIDATE = rf"{_LEAD}{_VALUE}{{6,}}+|{_NAMED}{_RUN}|(?<![{_KEY}]){_RUN}"
# What of a match stands before the value.
LEAD = rf"^(?:{_LEAD}(?={_VALUE}{{6}})|{_NAMED}(?={_RUN}))"
CONTEXT = 48

# Sure cases (label, rule): formats of published key kinds and digests assigned
# to a credential word are secrets; numbers, plain words, addresses and paths
# are not.
_ASSIGNED = rf"{_NAME}\s*[:=]\s*[\"']?$"


def label_rules() -> Column:
    value, before = F.col("value"), F.col("before")
    secret = (value.rlike(r"^(AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abp]-[A-Za-z0-9-]{10,}|eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+)$")
              | (before.rlike(_ASSIGNED) & value.rlike(r"^([0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{64})$")))
    harmless = (value.rlike(r"^[0-9.,+-]+$") | value.rlike(r"^[A-Za-z.-]+$") | value.rlike(r"^(https?|ftp)[:/]|^www\.|@")
                | value.rlike(r"^/?([A-Za-z0-9_.-]+/){2,}"))
    return F.when(secret, F.lit(1.0)).when(harmless & ~before.rlike(_ASSIGNED), F.lit(0.0))


# Forest and its training sample: at most this many labelled findings a label.
TREES, DEPTH, SAMPLE = 20, 6, 10_000
# A word of the candidates' neighbourhood seen this often is a dictionary word.
DICTIONARY_COUNT = 5


def candidates(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``row, doc_id, pos, start, value, before, after``: every match in every
    text with its place in characters and its context."""
    text = F.col("text")
    rows = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .filter(text.rlike(CANDIDATE))
            .withColumn("row", F.monotonically_increasing_id())
            .withColumn("found", F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)))
            .withColumn("gaps", F.split("text", CANDIDATE, -1)))
    n = F.size("found")
    lead = F.regexp_extract(F.col("col.hit"), LEAD, 0)
    parts = rows.select("row", "doc_id", F.posexplode(F.arrays_zip(
        F.col("found").alias("hit"), F.slice("gaps", F.lit(1), n).alias("left"),
        F.slice("gaps", F.lit(2), n).alias("right")))).select(
        "row", "doc_id", "pos", F.substring("col.hit", F.length(lead) + 1, F.length("col.hit")).alias("value"),
        F.length("col.left").alias("gap"), F.length("col.hit").alias("span"), F.length(lead).alias("led"),
        F.concat(F.expr(f"right(col.left, {CONTEXT})"), lead).alias("before"), F.expr(f"left(col.right, {CONTEXT})").alias("after"))
    upto = Window.partitionBy("row").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    return (parts.withColumn("start", F.sum(F.col("gap") + F.col("span")).over(upto) - F.col("span") + F.col("led"))
            .withColumn("size", F.length("value")).drop("gap", "span", "led"))


def _words(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(r"\p{L}{2,}"), F.lit(0))


def _transition_costs(found: DataFrame) -> dict[str, float]:
    """-log10 probability of each character after another within neighbouring
    words; letters a-z, and one sign for all others (27 * 27 rows at most)."""
    word = found.select(F.explode(F.concat(_words(F.col("before")), _words(F.col("after")))).alias("w"))
    plain = F.regexp_replace("w", "[^a-z]", "#")
    pairs = (word.groupBy("w").agg(F.count(F.lit(1)).alias("n"))
             .select("n", F.explode(F.transform(F.sequence(F.lit(1), F.length("w") - 1),
                                                lambda i: F.substring(plain, i, 2))).alias("p"))
             .groupBy("p").agg(F.sum("n").alias("n")))
    counts = {r.p: r.n for r in pairs.collect()}
    first: dict[str, int] = {}
    for p, n in counts.items():
        first[p[0]] = first.get(p[0], 0) + n
    return {p: -math.log10((n + 0.5) / (first[p[0]] + 14)) for p, n in counts.items()}


def _count(c: Column, pattern: str) -> Column:
    return F.size(F.regexp_extract_all(c, F.lit(pattern), F.lit(0))).cast("double")


FEATURES = ["size", "digits", "uppers", "lowers", "signs", "switches", "distinct", "hexlike", "transition", "covered",
            "slashes", "dots", "path_before", "assigned", "quoted", "keyword", "number_words", "word_before_len",
            "word_hash", "word_after_hash"]


def features(found: DataFrame) -> DataFrame:
    """``found`` with the forest's inputs as columns of doubles."""
    value, before, after = F.col("value"), F.col("before"), F.col("after")
    size = F.col("size").cast("double")
    costs = _transition_costs(found)
    plain = F.regexp_replace(F.lower(value), "[^a-z]", "#")
    if costs:
        table = F.create_map(*[x for p, c in sorted(costs.items()) for x in (F.lit(p), F.lit(float(c)))])
        cost = F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(plain) - 1, F.lit(1))), F.lit(0.0),
                           lambda acc, i: acc + F.coalesce(F.try_element_at(table, F.substring(plain, i, 2)), F.lit(3.0))) / size
    else:
        cost = F.lit(3.0)
    last = F.try_element_at(_words(before), F.lit(-1))
    next_ = F.try_element_at(_words(after), F.lit(1))
    wide = found.select(
        "row", "doc_id", "pos", "start", "value", "before", "after",
        size.alias("size"), (_count(value, "[0-9]") / size).alias("digits"), (_count(value, "[A-Z]") / size).alias("uppers"),
        (_count(value, "[a-z]") / size).alias("lowers"), (_count(value, "[^A-Za-z0-9]") / size).alias("signs"),
        (_count(value, "[0-9](?=[A-Za-z])|[A-Za-z](?=[0-9])|[a-z](?=[A-Z])") / size).alias("switches"),
        (F.size(F.array_distinct(F.split(value, ""))) / size).alias("distinct"),
        (_count(value, "[0-9a-fA-F]") / size).alias("hexlike"), cost.alias("transition"),
        _count(value, "/").alias("slashes"), _count(value, r"\.").alias("dots"),
        before.rlike(r"[/\\]\S*$|https?:\S*$").cast("double").alias("path_before"),
        before.rlike(r"[:=]\s*[\"']?$").cast("double").alias("assigned"),
        (before.rlike("[\"']$") & after.rlike("^[\"']")).cast("double").alias("quoted"),
        F.lower(before).rlike(_WORD).cast("double").alias("keyword"),
        _count(F.concat(before, after), r"\b[0-9]{3,}\b").alias("number_words"),
        F.coalesce(F.length(last), F.lit(0)).cast("double").alias("word_before_len"),
        F.coalesce(F.pmod(F.hash(last), F.lit(16)), F.lit(-1)).cast("double").alias("word_hash"),
        F.coalesce(F.pmod(F.hash(next_), F.lit(16)), F.lit(-1)).cast("double").alias("word_after_hash"))
    # dictionary coverage: letter runs of the candidate among its neighbours' common words
    known = (found.select(F.explode(F.concat(_words(before), _words(after))).alias("w"))
             .groupBy("w").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= DICTIONARY_COUNT).select("w"))
    runs = wide.select("row", "pos", F.explode(_words(value)).alias("w")).filter(F.length("w") >= 3)
    covered = runs.join(known, "w").groupBy("row", "pos").agg(F.sum(F.length("w")).alias("chars"))
    return wide.join(covered, ["row", "pos"], "left").withColumn(
        "covered", F.coalesce(F.col("chars"), F.lit(0)) / F.col("size")).drop("chars")


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5,
                 seed: int = 11) -> DataFrame:
    """One row per candidate: ``doc_id, start, size, value_sha256, label, score,
    is_secret``.

    ``start`` and ``size`` are characters of the text; ``label`` is 1, 0 or null
    where the shape rules are not sure; ``score`` is the forest's probability
    of a secret.  A null or empty text has no candidate; a null identifier
    stays null; repeated rows are scanned each.  Where the labelled findings
    are all of one kind there is nothing to learn, and the score is the label,
    or 1 after a credential word and else 0.
    """
    found = written(candidates(docs, id_col, text_col), "secret-candidates")
    scored = written(features(found).withColumn("label", label_rules()), "secret-features")
    sample = scored.filter(F.col("label").isNotNull()).withColumn(
        "u", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "start", "value"), F.lit(1 << 30)) / float(1 << 30))
    kinds = {r.label: r.n for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(kinds) < 2:
        result = scored.withColumn("score", F.coalesce("label", "keyword"))
    else:
        keep = F.lit(False)
        for label, n in kinds.items():
            keep = keep | ((F.col("label") == label) & (F.col("u") < SAMPLE / n))
        vector = VectorAssembler(inputCols=FEATURES, outputCol="inputs")
        forest = RandomForestClassifier(featuresCol="inputs", labelCol="label", numTrees=TREES, maxDepth=DEPTH,
                                        seed=seed, probabilityCol="chance").fit(vector.transform(sample.filter(keep)))
        # A fitted forest keeps its training summary, and with it the session, whose
        # observations cannot be sent to executors; a stored model has none.
        path = scratch_table(docs.sparkSession, "secret-forest")
        forest.save(path)
        result = RandomForestClassificationModel.load(path).transform(vector.transform(scored)).withColumn("score", vector_to_array("chance")[1])
    return result.select("doc_id", "start", F.col("size").cast("int").alias("size"), F.sha2("value", 256).alias("value_sha256"),
                         F.col("label").cast("int").alias("label"), F.round("score", 6).alias("score"),
                         (F.col("score") >= threshold).alias("is_secret"))
