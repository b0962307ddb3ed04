from fieldtally.functions.columns import (
    complete_share,
    count_where,
    days_between,
    fixed_width,
    half_even_percent,
    is_yes,
    option_tokens,
    resolve_other,
    score_band,
    sum_of_cells,
    sum_where,
    typed,
    whole_number,
)

__all__ = [
    "complete_share", "count_where", "days_between", "fixed_width", "half_even_percent", "is_yes",
    "option_tokens", "resolve_other", "score_band", "sum_of_cells", "sum_where", "typed", "whole_number",
]
