"""Column expressions: built-in Spark functions only, so they stay in codegen."""

from blotter.functions.categorical import (  # noqa: F401
    INCOME_BANDS, UNKNOWN_TEXTS, Band, band_of, boolean_flag, groups_of, invert_groups, is_known,
    map_values, not_sentinel_number, yes_no_flag)
from blotter.functions.dates import (  # noqa: F401
    as_date, date_with_fallback, month_from_label, month_label, month_name, month_start, null_if_text,
    parse_date)
from blotter.functions.numeric import pct_change, pct_change_zero_guarded, share_pct  # noqa: F401
from blotter.functions.series import (  # noqa: F401
    MA_WINDOW, MODERATE_PCT, PERIOD_END, PERIOD_START, SURGE_PCT, growth_class, in_period,
    lag_rows, pct_growth, series_window, strict_moving_avg)
