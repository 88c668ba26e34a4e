"""Quantile estimate from a cumulative latency histogram, as one native expression.

Semantics (Prometheus-style ``histogram_quantile`` over parallel arrays):
  * q is NaN -> NaN; q < 0 -> -Inf; q > 1 -> +Inf
  * buckets are sorted by upper bound; the highest bound must be +Inf, else NaN
  * buckets with equal bounds are merged (counts summed)
  * counts are forced monotone (running maximum)
  * fewer than 2 buckets or zero observations -> NaN
  * rank = q * total; the first bucket whose count reaches rank is chosen;
    the +Inf bucket answers with the second-highest bound; a first bucket with
    a bound <= 0 answers with its bound; otherwise linear interpolation inside
    the bucket, the lowest bucket starting at 0.
Built from arrays_zip / array_sort / aggregate / transform so it stays inside
whole-stage codegen-friendly JVM expressions, no Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NAN = "double('NaN')"
_PINF = "double('Infinity')"
_NINF = "double('-Infinity')"


def histogram_quantile_sql(bounds: str, counts: str, q: str) -> str:
    """SQL text of the estimator; arguments are SQL expressions."""
    # let-binding idiom: transform(array(value), name -> body)[0]
    zipped = (f"array_sort(transform(arrays_zip(transform({bounds}, x -> cast(x as double)), "
              f"transform({counts}, x -> cast(x as double))), z -> named_struct('b', z['0'], 'c', z['1'])))")
    merged = ("aggregate(s, cast(array() as array<struct<b:double,c:double>>), "
              "(acc, x) -> if(size(acc) > 0 and element_at(acc, -1).b = x.b, "
              "concat(slice(acc, 1, size(acc) - 1), array(named_struct('b', x.b, 'c', element_at(acc, -1).c + x.c))), "
              "concat(acc, array(x))))")
    mono = ("transform(m, (x, i) -> named_struct('b', x.b, 'c', "
            "array_max(transform(slice(m, 1, i + 1), y -> y.c))))")
    # index of the first bucket (excluding the last) whose count >= rank, else n-1
    search = ("coalesce(array_min(transform(sequence(0, size(h) - 2), "
              "i -> if(get(h, i).c >= r, i, cast(null as int)))), size(h) - 1)")
    interp = (
        "transform(array(named_struct("
        "'start', if(k > 0, get(h, k - 1).b, 0d), 'end', get(h, k).b, "
        "'cnt', get(h, k).c - if(k > 0, get(h, k - 1).c, 0d), "
        "'rk', r - if(k > 0, get(h, k - 1).c, 0d))), "
        "t -> if(t.cnt = 0, " + _NAN + ", t.start + (t.end - t.start) * (t.rk / t.cnt)))[0]"
    )
    pick = (
        f"transform(array({search}), k -> "
        f"case when k = size(h) - 1 then get(h, size(h) - 2).b "
        f"when k = 0 and get(h, 0).b <= 0 then get(h, 0).b "
        f"else {interp} end)[0]"
    )
    body = (
        f"transform(array(cast({q} as double)), qq -> case "
        f"when isnan(qq) then {_NAN} when qq < 0 then {_NINF} when qq > 1 then {_PINF} else "
        f"transform(array({zipped}), s -> case "
        f"when size(s) = 0 or element_at(s, -1).b != {_PINF} then {_NAN} else "
        f"transform(array({merged}), m -> "
        f"transform(array({mono}), h -> case "
        f"when size(h) < 2 or element_at(h, -1).c = 0 then {_NAN} else "
        f"transform(array(qq * element_at(h, -1).c), r -> {pick})[0] end)[0])[0] end)[0] end)[0]"
    )
    return body


def histogram_quantile(bounds="bounds", counts="counts", q="q") -> Column:
    """Column form; arguments are column names (or SQL expression text)."""
    return F.expr(histogram_quantile_sql(bounds, counts, q))
