from cartwheel.functions.columns import (  # noqa: F401
    flag,
    money,
    MONEY,
    round_half_up,
    safe_div,
    week_diff,
    day_diff,
)
