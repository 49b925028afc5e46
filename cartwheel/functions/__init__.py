"""Column-expression helpers; all JVM-side built-ins, no Python UDFs."""

from cartwheel.functions.calendar import (  # noqa: F401
    calendar_days, day_name, elapsed_days, month_index, month_key, period_diff,
)
from cartwheel.functions.numeric import (  # noqa: F401
    as_double, money_text, pct_of, ratio, round_half_up,
)
