from strata.functions.expr import (  # noqa: F401
    bucket,
    clip,
    floor_zero,
    lookup,
    md5_fraction_below,
    month_key,
    pct,
    round_half_even,
    round_half_up,
    safe_div,
    strip_all,
    title_case,
    year_key,
)
