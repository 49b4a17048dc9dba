from shelfcast.functions.numeric import (  # noqa: F401
    cents, cents_sum, dec_sum, money, round_half_even, round_half_up, safe_div, to_money,
)
from shelfcast.functions.dates import m5_wday, sunday_week_start, weekday_mon0  # noqa: F401
