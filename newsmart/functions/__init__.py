"""Column-expression functions: built-in Spark expressions only (no UDFs)."""

from newsmart.functions.columns import (  # noqa: F401
    UNKNOWN_AUTHOR,
    as_col,
    field,
    fill_author,
    page_count,
)
from newsmart.functions.dates import (  # noqa: F401
    day,
    iso_format,
    month,
    parse_timestamp,
    utc_date,
    year,
)
from newsmart.functions.text import (  # noqa: F401
    WHITESPACE_RUN,
    contains_match,
    count_matches,
    date_prefix,
    quote_literal,
    split_on_whitespace,
    url_host,
)
