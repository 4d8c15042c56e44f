from labelbench.sources.delimited import (
    BAD_LINE,
    FEATURES,
    SAMPLE_SCHEMA,
    drop_header,
    parse_lines,
    read_delimited,
    read_lines,
    split_bad_lines,
)
from labelbench.sources.tables import TEXT_FEATURES, table, text_samples

__all__ = [
    "BAD_LINE",
    "FEATURES",
    "SAMPLE_SCHEMA",
    "TEXT_FEATURES",
    "drop_header",
    "parse_lines",
    "read_delimited",
    "read_lines",
    "split_bad_lines",
    "table",
    "text_samples",
]
