from tidemark.functions.columns import (  # noqa: F401
    category_levels, category_two_levels, day_name, event_weekday, falsy,
    is_purchased, once, parse_event_time, price_tier, record_hash, to_ts_string,
)
from tidemark.functions.histogram import histogram_quantile  # noqa: F401
from tidemark.functions.joins import bounded_broadcast, estimated_bytes  # noqa: F401
