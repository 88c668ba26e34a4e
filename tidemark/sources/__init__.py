from tidemark.sources.testdata import (  # noqa: F401
    behaviour_events, cdc_changes, raw_envelopes, read_table,
)
