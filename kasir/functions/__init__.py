from kasir.functions.expr import (  # noqa: F401
    as_of_date,
    channel_group,
    date_lit,
    days_since,
    gap_adjusted,
    map_labels,
    month_of,
    null_greatest,
    product_key,
    sunday_week,
    unicode_trim,
    year_bucket,
)
