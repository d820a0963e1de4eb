"""Column expressions and window helpers."""

from .scalar import (  # noqa: F401
    date_key,
    direction,
    exact_avg,
    flag_points,
    key_to_date,
    pct,
    round_half_up,
    safe_div,
    weather_key,
    weather_type,
    with_month,
)
from .windows import full_rolling, ordered, rolling_corr, running, trailing  # noqa: F401
