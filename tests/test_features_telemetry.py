"""Feature rules, histogram quantile special cases, encoders, log parsing."""
import math

from conftest import SF_SMALL
from tidemark.functions.histogram import histogram_quantile
from tidemark.operators import features as FE
from tidemark.operators import telemetry as TL
from tidemark.operators import training as TR

INF = float("inf")


def test_histogram_quantile_special_cases(spark):
    cases = [
        ([1., 2., 4., 8., 16.], [1., 5., 8., 10., 14.], 0.9, math.nan),   # last bound not +Inf
        ([1., 2., 4., 8., INF], [1., 5., 8., 10., 14.], 0.9, 8.0),       # top bucket -> 2nd highest
        ([1., 2., 4., 8., INF], [1., 5., 8., 10., 14.], 0.5, 2 + 2 * (2 / 3)),
        ([INF, 8., 4., 2., 1.], [14., 10., 8., 5., 1.], 0.5, 2 + 2 * (2 / 3)),  # unsorted input
        ([1., 2., 2., INF], [1., 2., 3., 10.], 0.3, 1.5),               # duplicated bound merged
        ([1., 2., 4., INF], [5., 3., 8., 10.], 0.4, 0.8),               # non-monotone forced
        ([1., INF], [0., 0.], 0.5, math.nan),                            # zero observations
        ([INF], [3.], 0.5, math.nan),                                    # fewer than 2 buckets
        ([1., INF], [3., 4.], -0.1, -INF), ([1., INF], [3., 4.], 1.1, INF),
        ([1., INF], [3., 4.], math.nan, math.nan),
        ([-1., 1., INF], [3., 4., 6.], 0.2, -1.0),                       # first bound <= 0
    ]
    df = spark.createDataFrame([(b, c, q) for b, c, q, _ in cases], "bounds array<double>, counts array<double>, q double")
    got = [r[0] for r in df.select(histogram_quantile()).collect()]
    for (b, c, q, want), g in zip(cases, got):
        if math.isnan(want):
            assert math.isnan(g), (b, c, q, g)
        elif math.isinf(want):
            assert g == want, (b, c, q, g)
        else:
            assert abs(g - want) < 1e-9, (b, c, q, g, want)


def test_feature_edges(spark):
    rows = [
        (1, "2024-01-07 10:00:00 UTC", "purchase", 5, 2.0, "x", "a.b.c", 3, "s1"),   # level2 = b.c
        (2, "2024-01-07 10:00:00 UTC", "view", 5, 2.0, "x", "single", 3, "s1"),      # dropped: level2 null
        (3, "2024-01-07 10:00:00", "view", 5, 2.0, " ", "a.b", 3, "s1"),             # blank brand dropped
        (4, "bad", "view", 5, 2.0, "x", "a.b", 3, "s1"),                              # bad time dropped
        (5, "2024-01-07 10:00:00 UTC", "view", 5, 2.0, "x", "null.bnull", 0, "s2"),  # user 0 dropped
        (6, "2024-01-07 10:00:00 UTC", "view", 5, None, "x", "ab.cd", 3, "s2"),      # null price -> 0.0
    ]
    df = spark.createDataFrame(rows, "ingest_seq long, event_time string, event_type string, product_id long, "
                                     "price double, brand string, category_code string, user_id long, user_session string")
    out = {r["ingest_seq"]: r for r in FE.preprocess_batch(df, keep=["ingest_seq"]).collect()}
    assert sorted(out) == [1, 6]
    assert out[1]["category_code_level2"] == "b.c" and out[1]["is_purchased"] == 1
    assert out[1]["event_weekday"] == 0            # 2024-01-07 is a Sunday
    assert out[1]["activity_count"] == 3           # counted before the quality filter
    assert out[6]["price"] == 0.0 and out[6]["activity_count"] == 2


def test_encoder_dense_and_unseen(spark):
    train = spark.createDataFrame([("b", 3, "x", "y"), ("a", 1, "x", "z"), ("b", 10, None, "y")],
                                  "brand string, event_weekday int, category_code_level1 string, category_code_level2 string")
    m = {(r["feature"], r["value"]): r["idx"] for r in TR.category_mapping(train).collect()}
    assert m[("brand", "a")] == 0 and m[("brand", "b")] == 1
    assert [m[("event_weekday", v)] for v in ("1", "3", "10")] == [0, 1, 2]   # numeric order
    test = spark.createDataFrame([("c", 3, None, "y")], train.schema)
    r = TR.encode_categories(test, TR.category_mapping(train)).first()
    assert (r["brand"], r["event_weekday"], r["category_code_level1"], r["category_code_level2"]) == (-1, 1, -1, 0)


def test_log_parse(spark):
    lines = ["<14>1 2024-01-01T00:00:01.250Z abc123 shop-view 42 - - hello world",
             "<14>1 2024-01-01T00:00:02.000Z abc123 signoz-frontend 42 - - dropped",
             "not a syslog line"]
    df = spark.createDataFrame([(i, l) for i, l in enumerate(lines)], "id int, line string")
    out = {r["id"]: r for r in TL.log_parse(df).collect()}
    assert sorted(out) == [0, 2]
    assert out[0]["container_name"] == "shop-view" and out[0]["body"] == "hello world"
    assert out[2]["container_name"] is None and out[2]["body"] == "not a syslog line"


def test_latest_and_lookup_ttl(spark):
    import datetime as dt
    rows = [(1, 1, 10, dt.datetime(2024, 1, 30, 12), 5), (2, 1, 10, dt.datetime(2024, 1, 29, 12), 9),
            (3, 2, 10, dt.datetime(2024, 1, 20, 0), 7)]
    f = spark.createDataFrame(rows, "ingest_seq long, user_id long, product_id long, event_timestamp timestamp, activity_count long")
    latest = FE.latest_per_key(f)
    assert {r["user_id"]: r["ingest_seq"] for r in latest.collect()} == {1: 1, 2: 3}
    req = spark.createDataFrame([(1, 10, dt.datetime(2024, 1, 31)), (2, 10, dt.datetime(2024, 1, 31)),
                                 (3, 10, dt.datetime(2024, 1, 31))], "user_id long, product_id long, request_ts timestamp")
    out = {r["user_id"]: r["activity_count"] for r in FE.feature_lookup(req, latest, features=["activity_count"]).collect()}
    assert out == {1: 5, 2: None, 3: None}   # user 2 expired (older than 1 day), user 3 unknown


def test_gap_sessions_hot_key_against_brute_force(spark):
    """One key holding most events, cut into many range chunks, must give the
    same sessions as a plain sequential sessionisation."""
    import datetime as dt
    import random
    rnd = random.Random(7)
    base = dt.datetime(2024, 1, 1)
    rows, t = [], 0
    for _ in range(3000):                       # hot key 1
        t += rnd.choice([1, 5, 20, 59, 60, 61, 300])
        rows.append((1, base + dt.timedelta(minutes=t)))
    for k in range(2, 12):                      # small keys
        tk = 0
        for _ in range(rnd.randint(1, 6)):
            tk += rnd.choice([10, 61, 200])
            rows.append((k, base + dt.timedelta(minutes=tk)))
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "user_id long, event_timestamp timestamp")
    got = sorted((r["user_id"], r["first_event"], r["last_event"], r["event_count"])
                 for r in FE.session_window_activity(df, gap="1 hour", chunks=16).collect())
    want = []
    by_key = {}
    for k, ts in rows:
        by_key.setdefault(k, []).append(ts)
    for k, tss in by_key.items():
        tss.sort()
        start = prev = tss[0]
        n = 1
        for x in tss[1:]:
            if x - prev >= dt.timedelta(hours=1):
                want.append((k, start, prev, n))
                start, n = x, 0
            n += 1
            prev = x
        want.append((k, start, prev, n))
    assert got == sorted(want)


def test_log_times_of_every_accepted_layout(spark):
    from tidemark.operators.telemetry import log_parse
    stamps = ["2024-01-02T03:04:05.123Z", "2024-01-02T03:04:05z", "2024-01-02T05:04:05.123456789+02:00", "2024-01-02T08:34:05+0530", "2024-01-02T03:04:05"]
    rows = [(i, f"<1>1 {t} cid name 1 - - body") for i, t in enumerate(stamps)]
    got = log_parse(spark.createDataFrame(rows, "i int, line string")).collect()
    assert len(got) == 5 and all(r.timestamp.replace(microsecond=0).isoformat() == "2024-01-02T03:04:05" for r in got)


def test_rejected_rows_count_under_their_reason(spark):
    from tidemark.operators import features as FE
    rows = [(1, 1, 1.0, "b", "x", "y", "s", 1, 0), (0, 1, 1.0, "b", "x", "y", "s", 1, 0), (1, 1, -1.0, "b", "x", "y", "s", 1, 0),
            (1, 1, 1.0, "  ", "x", "y", "s", 1, 0), (1, None, 1.0, "b", "x", "y", "s", 1, 9), (1, 1, 1.0, "b", "x", "y", "s", 1, 7)]
    df = spark.createDataFrame(rows, "user_id long, product_id long, price double, brand string, category_code_level1 string, "
                                     "category_code_level2 string, user_session string, activity_count long, event_weekday int")
    assert FE.quality_filter(df).count() == 1
    assert {(r.reason, r.n) for r in FE.rejected_by_reason(df).collect()} == {
        ("user_id: above 0", 1), ("price: at least 0", 1), ("brand: text", 1), ("product_id: present", 1), ("event_weekday: at most 6", 1)}
