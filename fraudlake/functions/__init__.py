from fraudlake.functions.expr import (  # noqa: F401
    base_name, blank_to_null, day_start, file_date, file_ext, file_kind, fio, format_ts,
    is_current, is_different, minus_seconds, on_day, open_end, parse_amount, parse_ts,
    plus_interval, trunc_seconds, ts_lit,
)
