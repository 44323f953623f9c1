from ledgerlens.functions.expr import (
    MINMAX_EPSILON,
    as_double,
    days_between,
    fill0,
    fill0d,
    filled_sum,
    flag,
    fractional_days,
    minmax_log,
    null_sum,
    replace_inf,
    safe_div,
    safe_log,
)

__all__ = ["MINMAX_EPSILON", "as_double", "days_between", "fill0", "fill0d", "filled_sum",
           "flag", "fractional_days", "minmax_log", "null_sum", "replace_inf", "safe_div",
           "safe_log"]
