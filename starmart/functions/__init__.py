from starmart.functions.columns import (
    covers,
    draw,
    in_year,
    overlaps,
    percent_change,
    percent_of,
    recode,
    scaled_price,
)

__all__ = [
    "covers",
    "draw",
    "in_year",
    "overlaps",
    "percent_change",
    "percent_of",
    "recode",
    "scaled_price",
]
