"""Property tests: native expressions against plain-Python statements of the rules."""
import json
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.functions.histogram import histogram_quantile
from tidemark.operators import validation as V

INF = float("inf")


def py_quantile(q, bounds, counts):
    """Direct statement of the bucket-quantile rules (for comparison only)."""
    if math.isnan(q):
        return math.nan
    if q < 0:
        return -INF
    if q > 1:
        return INF
    if not bounds:
        return math.nan
    b = sorted(zip(bounds, counts), key=lambda t: t[0])
    if b[-1][0] != INF:
        return math.nan
    merged = []
    for ub, c in b:
        if merged and merged[-1][0] == ub:
            merged[-1][1] += c
        else:
            merged.append([ub, c])
    running = -INF
    for m in merged:
        running = max(running, m[1])
        m[1] = running
    if len(merged) < 2 or merged[-1][1] == 0:
        return math.nan
    rank = q * merged[-1][1]
    k = next((i for i in range(len(merged) - 1) if merged[i][1] >= rank), len(merged) - 1)
    if k == len(merged) - 1:
        return merged[-2][0]
    if k == 0 and merged[0][0] <= 0:
        return merged[0][0]
    start = merged[k - 1][0] if k > 0 else 0.0
    prev = merged[k - 1][1] if k > 0 else 0.0
    cnt = merged[k][1] - prev
    if cnt == 0:
        return math.nan
    return start + (merged[k][0] - start) * ((rank - prev) / cnt)


hist = st.lists(st.tuples(st.sampled_from([-1.0, 0.0, 0.5, 1.0, 2.0, 5.0, 10.0, INF]),
                          st.integers(0, 20).map(float)), min_size=0, max_size=8)
qs = st.one_of(st.floats(-0.5, 1.5), st.just(math.nan), st.just(0.0), st.just(1.0))


@settings(max_examples=1, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(hist, qs), min_size=150, max_size=150))
def test_histogram_quantile_matches_rules(spark, cases):
    rows = [([b for b, _ in h], [c for _, c in h], q) for h, q in cases]
    df = spark.createDataFrame(rows, "bounds array<double>, counts array<double>, q double")
    got = [r[0] for r in df.select(histogram_quantile()).collect()]
    for (b, c, q), g in zip(rows, got):
        want = py_quantile(q, b, c)
        if isinstance(want, float) and math.isnan(want):
            assert g is not None and math.isnan(g), (b, c, q, g)
        elif math.isinf(want):
            assert g == want, (b, c, q, g)
        else:
            assert abs(g - want) < 1e-9, (b, c, q, g, want)


FIELDS = [{"name": "event_type", "type": "string"}, {"name": "product_id", "type": "long"},
          {"name": "brand", "type": ["null", "string"]}, {"name": "price", "type": "double"},
          {"name": "note", "type": "string", "optional": True}]
values = st.one_of(st.none(), st.booleans(), st.integers(-5, 5), st.floats(-5, 5, allow_nan=False),
                   st.sampled_from(["view", "cart", "click", "", "7"]), st.just(KeyError))


@settings(max_examples=1, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.fixed_dictionaries({f["name"]: values for f in FIELDS}), min_size=200, max_size=200))
def test_static_and_dynamic_validation_agree(spark, payloads):
    texts = []
    for p in payloads:
        body = {k: v for k, v in p.items() if v is not KeyError}
        texts.append(json.dumps({"schema": {"fields": FIELDS}, "payload": body}))
    df = spark.createDataFrame(list(enumerate(texts)), "id int, value string")
    dyn = {r["id"]: (r["valid"], r["error_message"]) for r in V.validate_dynamic(df, keep=["id"]).collect()}
    sta = {r["id"]: (r["valid"], r["error_message"])
           for r in V.validate_static(df, FIELDS, keep=["id"]).collect()}
    assert dyn == sta
