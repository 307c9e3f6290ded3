"""Column expressions (day/hour differences, labels, flags, money, mode)."""

from ledgerline.functions.expressions import (  # noqa: F401
    any_not_null,
    avg_micros_as_days,
    avg_money,
    avg_score,
    day_diff,
    first_by_order,
    guarded_ratio,
    hour_diff,
    late_flag,
    mean_coordinate,
    micros_between,
    month_part,
    round_money,
    sum_money,
    sum_totals,
    year_month_label,
    year_part,
)
