"""Mixing sources to target weights by Poisson replication.

A source's target repetition rate is its share of the wanted total over what it
holds.  Each document draws a count from the Poisson distribution with that
mean, by inverting its distribution function at a uniform number hashed from
seed and identifier; the row is emitted that often and all copies are shuffled
globally by a second hash.  Nothing but the sources' totals leaves the tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written

# Means above this are drawn as a sum of equal parts: exp(-mean) must not underflow.
PART_MEAN = 400.0
# Sources' rates are broadcast up to this many bytes of names; beyond, the rows
# are joined on (source, salt).
BROADCAST_BYTES = 8 << 20
SALTS = 64


def uniform(seed: int, ident: Column, part: Column) -> Column:
    """A number in 0..1 (52 bits) from seed, part and identifier."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), part.cast("string"),
                               F.coalesce(ident.cast("string"), F.lit("~"))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def poisson_quantile(u: Column, mean: Column) -> Column:
    """Least k with P(X <= k) > u for X of this mean, by summing terms."""
    start = F.struct(F.lit(0).alias("k"), F.exp(-mean).alias("term"), F.exp(-mean).alias("cdf"))

    def step(acc, i):
        more = (acc["k"] == i - 1) & (acc["cdf"] <= u)
        term = acc["term"] * mean / i
        return F.struct(F.when(more, i).otherwise(acc["k"]).alias("k"),
                        F.when(more, term).otherwise(acc["term"]).alias("term"),
                        F.when(more, acc["cdf"] + term).otherwise(acc["cdf"]).alias("cdf"))

    # so far out that no 52-bit number passes it
    steps = F.sequence(F.lit(1), F.ceil(mean + 9 * F.sqrt(mean) + 30).cast("int"))
    return F.aggregate(steps, start, step, lambda acc: acc["k"])


def poisson_count(seed: int, ident: Column, rate: Column) -> Column:
    """The document's count: a Poisson draw of mean ``rate`` fixed by seed and
    identifier; a large mean is drawn as a sum of independent parts."""
    parts = F.greatest(F.lit(1), F.ceil(rate / PART_MEAN).cast("int"))
    return F.aggregate(F.sequence(F.lit(1), parts), F.lit(0), lambda acc, j:
                       acc + poisson_quantile(uniform(seed, ident, j), rate / parts))


def _source_name(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def source_rates(docs: DataFrame, weights: dict[str, float] | None = None, epochs: float = 1.0,
                 power: float = 0.5, source_col: str = "source") -> tuple[DataFrame, int]:
    """``mix_source, rate``, one row a source: the mean repetitions of its rows;
    and the bytes of all names.

    ``weights`` are target shares by source; a source that they leave out gets
    none.  Without them the target is proportional to rows ** ``power``.  The
    wanted total is ``epochs`` times the rows that there are.
    """
    sizes = (docs.groupBy(_source_name(F.col(f"`{source_col}`")).alias("mix_source"))
             .agg(F.count(F.lit(1)).alias("n")))
    if weights is None:
        target = F.pow(F.col("n").cast("double"), F.lit(float(power)))
    else:
        target = F.coalesce(*[F.when(F.col("mix_source") == k, F.lit(float(v))) for k, v in weights.items()],
                            F.lit(0.0))
    sized = written(sizes.withColumn("target", target), "mix-sources")
    rows, targets, names = sized.agg(F.sum("n"), F.sum("target"),
                                     F.sum(F.octet_length("mix_source") + 16)).first()
    per = epochs * rows / targets if targets else 0.0
    return sized.select("mix_source", (F.col("target") * F.lit(per) / F.col("n")).alias("rate")), int(names or 0)


def poisson_mix(docs: DataFrame, weights: dict[str, float] | None = None, epochs: float = 1.0,
                power: float = 0.5, seed: int = 42, id_col: str = "doc_id", source_col: str = "source",
                shuffle: bool = True) -> DataFrame:
    """The rows of ``docs``, each as often as its draw says, in shuffled order.

    Result: ``doc`` (a struct of all input columns, so names cannot clash),
    ``copy`` (0, 1, ...), ``rate``.  The draw depends on seed and identifier
    alone: rows that repeat an identifier repeat its draw.  A null source is a
    source of its own (with the empty name), a null identifier draws like any
    other value.  Empty input gives an empty result.
    """
    rates, names = source_rates(docs, weights, epochs, power, source_col)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    ident = F.col(f"doc.`{id_col}`")
    rows = rows.withColumn("mix_source", _source_name(F.col(f"doc.`{source_col}`")))
    if names <= BROADCAST_BYTES:
        rated = rows.join(F.broadcast(rates), "mix_source")
    else:
        salted = rates.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rated = (rows.withColumn("salt", F.pmod(F.xxhash64(ident), F.lit(SALTS)).cast("int"))
                 .join(salted, ["mix_source", "salt"]))
    drawn = (rated.withColumn("n", poisson_count(seed, ident, F.col("rate")))
             .filter(F.col("n") > 0)
             .select("doc", "rate", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("copy")))
    if not shuffle:
        return drawn
    place = F.md5(F.concat_ws("|", F.lit(f"{seed}.order"), F.coalesce(F.col(f"doc.`{id_col}`").cast("string"), F.lit("~")),
                              F.col("copy").cast("string")))
    mixed = drawn.withColumn("place", place)
    return (mixed.repartition(F.col("place")).sortWithinPartitions("place")
            .select("doc", "copy", "rate"))

