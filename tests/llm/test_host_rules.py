"""Quality rules by host against plain Python, and SQL with failing hosts."""

from collections import Counter

import duckdb
import pytest
from helpers import SPACE_WORD, key

from tidemark.llm import host_rules as H
from tidemark.llm import queries as Q
from tidemark.llm.common import written


def measures(text):
    text = text or ""
    w = SPACE_WORD.findall(text)
    grams = Counter(zip(w, w[1:], w[2:]))
    inside = {i + k for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if SPACE_WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside))


def judged(df):
    return [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in df.collect()]


def good(k):
    return " ".join(f"word{k}x{i}" for i in range(60))


@pytest.fixture(scope="module")
def hosts(spark):
    """Two thirds of ``bad``'s documents are full of symbols, and one of four
    of ``small``; ``short`` fails another rule."""
    rows = [(i, good(i) + (" # # $ % & * < >" if i % 3 else ""), "bad") for i in range(60)]
    rows += [(100 + i, good(i), f"h{i % 8}") for i in range(160)]
    rows += [(400, good(1) + " ####### |||", "small"), (401, good(2) + " ####### |||", None)]
    rows += [(410 + i, good(i), "small") for i in range(3)]
    rows += [(500 + i, "only a few words here", "short") for i in range(40)] + [(600 + i, good(600 + i), "short") for i in range(10)]
    return written(spark.createDataFrame(rows, "doc_id long, text string, source string"), "hosts-given")


def test_measures_odd_rows(odd, empty):
    got = H.judge_documents(odd, host=H.F.col("source"))
    want = [(r.doc_id, *measures(r.text)) for r in odd.collect()]
    assert sorted(judged(got), key=key) == sorted(want, key=key)
    assert H.judge_documents(empty, host=H.F.col("source")).collect() == []
    null = [r for r in got.collect() if r.n_words == 0]
    assert null and all(r.base_failed and not r.kept for r in null)


def test_measures_of_windows_and_lines(spark):
    texts = ["a b c a b c", "a b c", "a a a a", "a b a b", "x\n\nx\n \nx", "é é é é\né é é é", "a\x0bb\x0cc\r\na b c #|", "a b c d a b c",
             "q w e\nq w e\n q w e", "<|$%&*#>", "one\xa0word one\xa0word one\xa0word"]
    docs = written(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "windows-given")
    assert sorted(judged(H.judge_documents(docs))) == [(k, *measures(t)) for k, t in enumerate(texts)]


@pytest.mark.parametrize("broadcast", [H.BROADCAST_BYTES, 0])
def test_failed_hosts_take_their_documents_along(hosts, monkeypatch, broadcast):
    monkeypatch.setattr(H, "BROADCAST_BYTES", broadcast)
    rows = {r.doc_id: r for r in H.judge_documents(hosts, host=H.F.col("source")).collect()}
    assert len(rows) == hosts.count()
    assert {r.host: r.host_failed for r in rows.values() if r.host_failed} == {"bad": "symbols", "short": "few_words"}
    # the symbol-free documents of a failed host go too; one bad document does not fail a host
    assert not any(rows[i].kept for i in range(60)) and not rows[0].base_failed
    assert rows[400].kept and rows[401].kept and rows[401].host is None
    assert all(rows[100 + i].kept for i in range(160)) and not any(rows[600 + i].kept for i in range(10))


def test_rates_are_shrunk_by_the_hosts_spread(hosts):
    found = written(H.measured(hosts, host=H.F.col("source")), "measured")
    verdicts = {r.host: r for r in H.host_verdicts(found).collect()}
    n = {"bad": 60, "small": 4, "short": 50, **{f"h{i}": 20 for i in range(8)}}
    f = {"bad": 40, "small": 1}
    total, k = sum(n.values()), len(n)
    mean = sum(f.values()) / total
    spread = sum(f.get(h, 0) ** 2 / n[h] for h in n) - total * mean ** 2
    chance = mean * (1 - mean)
    share = (spread - (k - 1) * chance) / (chance * (total - sum(x * x for x in n.values()) / total - (k - 1)))
    weight = (1 - share) / share
    for h in n:
        assert verdicts[h].rate_symbols == pytest.approx((f.get(h, 0) + mean * weight) / (n[h] + weight))
    assert 0.02 < verdicts["small"].rate_symbols < 0.3 and verdicts["h0"].rate_symbols > 0


def test_hosts_that_differ_by_chance_alone_share_one_rate(spark):
    rows = [(i, good(i) + (" # # # # # # # #" if (i // 5) % 4 == 0 else ""), f"h{i % 5}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = written(H.measured(docs, host=H.F.col("source")), "measured")
    assert {round(r.rate_symbols, 3) for r in H.host_verdicts(found).collect()} == {0.25}


def test_sql_with_failing_hosts(hosts):
    con = duckdb.connect()
    given = [tuple(r) for r in hosts.select("doc_id", "text", "source").collect()]
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", given)
    cur = con.execute(Q.oracle_sql()["op12_host_rules"])
    names = [d[0] for d in cur.description]
    df = H.judge_documents(hosts, host=H.F.col("source")).select(*names)
    assert sorted(map(tuple, df.collect()), key=key) == sorted(cur.fetchall(), key=key)


def test_web_addresses_name_their_host(spark):
    urls = ["http://www.A.example.com/x?q#y", "https://b.example.org:8080/", "not an address", None, "ftp://c.example.net"]
    df = spark.createDataFrame([(u,) for u in urls], "url string").select(H.url_host(H.F.col("url")).alias("h"))
    assert [r.h for r in df.collect()] == ["a.example.com", "b.example.org", None, None, "c.example.net"]


def test_no_python_in_the_plan(odd):
    plan = H.measured(odd, host=H.F.col("source"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InPandas" not in plan and "InArrow" not in plan
    assert plan.count("sort_array") == 1
