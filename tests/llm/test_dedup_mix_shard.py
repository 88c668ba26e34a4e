"""Exact dedup, mixing and sharding: odd rows, hot groups, brute force."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import pytest
from helpers import key, low, odd_rows
from pyspark.sql import functions as F

from tidemark.llm.exact_dedup import exact_dedup
from tidemark.llm.mixing import poisson_mix, source_rates
from tidemark.llm.sharding import read_shards, stratified_shards, write_shards


def dedup_by_hand(rows, keep=max):
    groups = defaultdict(list)
    for doc, text in rows:
        groups[low(text)].append(doc)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        best = keep(known) if known else None
        for place, i in enumerate(sorted(ids, key=lambda x: x == best)):
            out.append((i, best, len(ids), place == len(ids) - 1, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=key)


@pytest.mark.parametrize("ranges", [1, 3, 16])
def test_exact_dedup_odd_rows(odd, ranges):
    got = sorted((tuple(r) for r in exact_dedup(odd, ranges=ranges).collect()), key=key)
    assert got == dedup_by_hand([(r[0], r[1]) for r in odd_rows()])


def test_exact_dedup_keeps_smallest(spark):
    docs = spark.createDataFrame([(i, "Same" if i % 2 else f"t{i}") for i in range(10)], "doc_id long, text string")
    got = {r.doc_id: (r.keep_id, r.kept) for r in exact_dedup(docs, keep="min").collect()}
    assert got[1] == (1, True) and got[9] == (1, False) and got[4] == (4, True)


def test_hot_text_is_spread_over_ranges(spark):
    """A text that fills two thirds of all rows lies in several ranges and is
    still one group."""
    docs = spark.createDataFrame([(i, "hot" if i % 3 else f"text {i}") for i in range(3000)], "doc_id long, text string")
    rows = exact_dedup(docs, ranges=12).collect()
    hot = [r for r in rows if r.doc_id % 3]
    assert {(r.keep_id, r.group_size) for r in hot} == {(2999, 2000)}
    assert [r.doc_id for r in hot if r.kept] == [2999]
    assert len(rows) == 3000 and sum(r.kept for r in rows) == 1001


def test_exact_dedup_has_no_python_and_one_text_shuffle(odd):
    plan = exact_dedup(odd)._jdf.queryExecution().toString()
    assert "Python" not in plan and "ArrowEval" not in plan


def test_empty_inputs(empty):
    assert exact_dedup(empty).collect() == []
    assert poisson_mix(empty).collect() == []
    assert stratified_shards(empty).collect() == []


def poisson_by_hand(u, rate):
    k, term = 0, math.exp(-rate)
    total = term
    while total <= u:
        k += 1
        term *= rate / k
        total += term
    return k


def test_mix_draws_and_rows(odd):
    rates = {r.mix_source: r.rate for r in source_rates(odd)[0].collect()}
    sizes = Counter(r[3] or "" for r in odd_rows())
    total, roots = sum(sizes.values()), sum(math.sqrt(n) for n in sizes.values())
    assert rates == pytest.approx({s: math.sqrt(n) * total / roots / n for s, n in sizes.items()})
    want = Counter()
    for r in odd_rows():
        digest = hashlib.md5(f"42|1|{'~' if r[0] is None else r[0]}".encode()).hexdigest()
        want[r] += poisson_by_hand(int(digest[:13], 16) / 2**52, rates[r[3] or ""])
    got = Counter(tuple(r.doc) for r in poisson_mix(odd).collect())
    assert got == +want
    assert poisson_mix(odd).select("doc.*").columns == odd.columns


def test_mix_reaches_target_shares(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 18_000, "big").otherwise("small").alias("source"))
    n = Counter(r.source for r in poisson_mix(docs, weights={"big": 0.5, "small": 0.5}).select("doc.source").collect())
    assert n["big"] == pytest.approx(10_000, rel=0.05) and n["small"] == pytest.approx(10_000, rel=0.05)
    assert set(poisson_mix(docs, weights={"small": 1.0}).select("doc.source").distinct().toPandas()["source"]) == {"small"}


def test_mix_large_rate(spark):
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.when(F.col("id") == 0, "tiny").otherwise("rest").alias("source"))
    mixed = poisson_mix(docs, weights={"tiny": 1.0}, epochs=50.0)  # a mean of 2000 copies
    assert mixed.count() == pytest.approx(2000, rel=0.1)
    assert mixed.select("copy").distinct().count() == mixed.count()


def test_shards_follow_the_law(odd):
    rows = stratified_shards(odd, shards=4).collect()
    given = odd_rows()
    assert len(rows) == len(given)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == Counter(
        (g[0], len((g[1] or "").encode()) + 8, zlib.crc32((g[1] or "").encode())) for g in given)
    count = Counter(r.shard for r in rows)
    assert max(count.values()) - min(count.values()) <= 1
    assert sorted((r.shard, r.slot) for r in rows) == [(s, k) for s in sorted(count) for k in range(count[s])]
    assert {(r.law, r.grown_shard) for r in rows} == {("rows", None)}


def test_shards_match_the_mixture(spark):
    docs = spark.range(9_000).select(
        F.col("id").alias("doc_id"), F.lit("x").alias("text"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("source"))
    rows = stratified_shards(docs, shards=24).collect()
    share = Counter((r.shard, r.source) for r in rows)
    total = Counter(r.source for r in rows)
    for (_, s), n in share.items():
        assert abs(n - total[s] / 24) <= 2
    assert rows and stratified_shards(docs, shards=24, seed=1).collect() != rows


def test_more_shards_than_rows(spark):
    docs = spark.createDataFrame([(1, "a", "s"), (2, "b", "s")], "doc_id long, text string, source string")
    rows = stratified_shards(docs, shards=24).collect()
    assert len({r.shard for r in rows}) == 2 and {r.slot for r in rows} == {0}


def test_written_shards_hold_every_row_whole(spark, odd, tmp_path):
    """Null and repeated identifiers, and columns named as the operator's own."""
    docs = odd.withColumns({c: F.lit(c) for c in ("shard", "slot", "doc", "draw", "bin", "place", "part", "at")})
    write_shards(docs, str(tmp_path / "s"), shards=4)
    rows = read_shards(spark, str(tmp_path / "s")).collect()
    assert Counter(tuple(r.doc) for r in rows) == Counter(map(tuple, docs.collect()))
    count = Counter(r.shard for r in rows)
    assert max(count.values()) - min(count.values()) <= 1
    assert sorted((r.shard, r.slot) for r in rows) == [(s, k) for s in sorted(count) for k in range(count[s])]
    assert {p.name for p in (tmp_path / "s").glob("shard=*")} == {f"shard={s}" for s in range(4)}


def test_files_go_on_in_slot_order_and_a_shard_has_several(spark, tmp_path):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"),
                                      (F.col("id") % 7).cast("string").alias("source"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        write_shards(docs, str(tmp_path / "s"), shards=3)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for s in range(3):
        files = sorted((tmp_path / "s" / f"shard={s}").glob("*.parquet"))
        slots = [r.slot for f in files for r in spark.read.parquet(str(f)).select("slot").collect()]
        assert len(files) >= 5 and slots == list(range(len(slots)))


def test_shard_placing_is_that_of_the_whole_order(spark):
    docs = spark.range(30_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"),
                                      F.when(F.col("id") % 4 > 0, "big").otherwise(F.concat(F.lit("s"), F.col("id") % 9)).alias("source"))
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    strata = defaultdict(list)
    for r in docs.collect():
        strata[r.source].append((md5(f"42|{r.doc_id}|{md5('x')}"), r.doc_id))
    line = sorted(((k + 0.5) / len(v), d, i) for v in strata.values() for k, (d, i) in enumerate(sorted(v)))
    want = {i: p * 24 // len(line) for p, (_, _, i) in enumerate(line)}
    assert {r.doc_id: r.shard for r in stratified_shards(docs).collect()} == want


def test_changed_rows_between_reads_are_refused(spark, tmp_path):
    docs = spark.range(50).select((F.rand() * 1e9).cast("long").alias("doc_id"), F.uuid().alias("text"), F.lit("s").alias("source"))
    moving = docs.withColumn("text", F.concat("text", F.expr("cast(reflect('java.lang.System', 'nanoTime') as string)")))
    with pytest.raises(ValueError, match="changed"):
        write_shards(moving, str(tmp_path / "s"))
