"""The registered queries against SQL, and the pipeline against brute force."""

import os
from collections import Counter

import duckdb
import pytest
from helpers import key, odd_rows

import __spark_entry__ as E
import corpus_pipeline as P
from tidemark.llm import queries as Q
from tidemark.llm.common import scratch_tables, written

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_operator_is_registered():
    names = E.queries()
    assert [n for n in range(1, 14) if any(q.startswith(f"op{n}_") for q in names)] == list(range(1, 14))
    assert "pipeline" in names and [n for n, _ in P.STAGES] and len(P.STAGES) == 5


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    df = Q.queries()[name](spark, SF)
    cur = duck.execute(Q.oracle_sql()[name])
    columns = sorted(df.columns)
    assert columns == sorted(d[0] for d in cur.description)
    place = [[d[0] for d in cur.description].index(c) for c in columns]
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=key) == sorted(
        (tuple(r[k] for k in place) for r in cur.fetchall()), key=key)


def test_mix_query_writes_whole_documents(spark):
    given = spark.read.parquet(f"{SF}/documents.parquet")
    old = scratch_tables()
    rows = Q.queries()["op6_poisson_mix"](spark, SF).collect()
    path = next(p for p in scratch_tables() if p not in old and "/mixed-" in p)
    mixed = spark.read.parquet(path).select("doc.*", "copy").collect()
    texts = {r.doc_id: tuple(r) for r in given.collect()}
    assert Counter((r.doc_id, r.copy) for r in mixed) == Counter((r.doc_id, r.copy) for r in rows)
    assert all(tuple(r)[:-1] == texts[r.doc_id] for r in mixed)


def test_language_query_on_held_out_texts(spark):
    given = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    rows = Q.queries()["op1_language_id"](spark, SF).collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(given) and sum(r.lang_pred == given[r.doc_id] for r in held) >= 0.9 * len(held)


def test_pipeline_stages_against_brute_force(spark, odd, tmp_path):
    """Each stage on its own input; the language model is trained on the given
    documents, the odd rows go through it with them."""
    from helpers import jaccard_rows, phrase_hits

    given = spark.read.parquet(f"{SF}/documents.parquet")
    docs = written(given.unionByName(odd.select(given.columns)).coalesce(3), "pipeline-input")
    first = P.language_id(spark, docs, SF)
    stage1 = written(first, "stage1")
    kept, all_rows = Counter(map(tuple, stage1.collect())), Counter(map(tuple, docs.collect()))
    assert stage1.columns == docs.columns and not kept - all_rows
    gone = list((all_rows - kept).elements())
    # ids: null, empty, blank, null with null id, and only numbers
    assert [r for r in gone if not any(c.isalpha() for c in r[1] or "")] and len(gone) <= 8
    assert not [r for r in kept if not any(c.isalpha() for c in r[1] or "")]

    stage2 = written(P.near_duplicates(spark, stage1, SF), "stage2")
    rows = stage1.collect()
    groups = jaccard_rows([(k, r.text) for k, r in enumerate(rows)])
    members: dict = {}
    for k, _, g in groups:
        members.setdefault(g, []).append(tuple(rows[k]))
    got = Counter(map(tuple, stage2.collect()))
    assert sum(got.values()) == len(members)
    for m in members.values():
        stays = [r for r in m if r in got]
        assert len(set(stays)) == 1
        known = [r[0] for r in m if r[0] is not None]
        assert stays[0][0] == (min(known) if known else None)

    stage3 = written(P.decontamination(spark, stage2, SF), "stage3")
    rows = [tuple(r) for r in stage2.collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    hits = phrase_hits([(k, r[1]) for k, r in enumerate(rows)], items)
    assert Counter(map(tuple, stage3.collect())) == Counter(rows[k] for k, _, n, _ in hits if not n)
    assert any(n for _, _, n, _ in hits)

    stage4 = written(P.mixing(spark, stage3, SF), "stage4")
    assert stage4.columns == docs.columns and not set(map(tuple, stage4.collect())) - set(map(tuple, stage3.collect()))
    last = P.token_files(spark, stage4, SF).collect()
    assert sorted((r.doc_id for r in last), key=lambda x: (x is not None, x)) == sorted(
        (r.doc_id for r in stage4.collect()), key=lambda x: (x is not None, x))


def test_rows_of_one_key_are_told_apart(spark):
    """Rows equal in identifier and text, or in all columns: each has its own
    fate, and one of each group of copies stays."""
    text = " ".join(f"plain{i} english words of the text" for i in range(12))
    rows = [(1, text, "en", "a", 1), (1, text, "en", "b", 2), (1, text, "en", "a", 1), (None, text, "en", "c", 3), (2, "1234", "en", "a", 4),
            (2, "1234", "en", "b", 5), (3, " ".join(f"other{i} words altogether" for i in range(20)), "en", "a", 6)]
    docs = written(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, row_number long"), "equal-rows")
    kept = P.near_duplicates(spark, docs, SF).collect()
    assert Counter(r.doc_id for r in kept) == {1: 1, 2: 1, 3: 1} and [r for r in kept if r.doc_id == 1][0].text == text
    assert sorted(r.row_number for r in P.language_id(spark, docs, SF).collect()) != []
    assert P.decontamination(spark, docs, SF).count() == 7 and kept[0].asDict().keys() == set(docs.columns)


def test_runs_side_by_side_keep_their_tables(spark):
    from concurrent.futures import ThreadPoolExecutor
    docs = spark.read.parquet(f"{SF}/documents.parquet")

    def two_stages(_) -> int:
        first = written(P.decontamination(spark, docs, SF), "side-by-side")
        return P.mixing(spark, first, SF).count()

    with ThreadPoolExecutor(2) as pool:
        a, b = pool.map(two_stages, range(2))
    assert a == b > 0


def test_run_is_the_stages_in_order(spark):
    rows = P.run(spark, SF).collect()
    assert rows and set(rows[0].asDict()) == {"doc_id", "start", "n_tokens", "ids_crc32"}
    assert os.path.exists(SF)


def test_empty_documents(spark, empty):
    docs = written(empty.select("doc_id", "text", "lang", "source", "n_chars"), "no-documents")
    for _, stage in P.STAGES[:-1]:
        docs = written(stage(spark, docs, SF), "no-rows")
        assert docs.count() == 0
    assert P.token_files(spark, docs, SF).count() == 0
    assert len(odd_rows()) > 0
