from eqlake.functions.parsing import (  # noqa: F401
    MISSING_STRINGS,
    clean_exchange,
    date_invalid,
    float_equal,
    is_missing_string,
    number_invalid,
    parse_is_open,
    parse_number,
    parse_yyyymmdd,
    trimmed,
    ts_code_valid,
)
from eqlake.functions.stats import (  # noqa: F401
    average_rank,
    finite_or_null,
    ieee_divide,
    is_finite,
    position_quantile,
    round_doubles,
    safe_corr,
)
