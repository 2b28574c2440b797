from priceloom.functions.columns import (
    expm1_price,
    is_number,
    log_target,
    product,
    ratio_or_zero,
    square,
    zero_if_null,
)
from priceloom.functions.hashing import hash_bucket, row_key
from priceloom.functions.scores import adjusted_r2, mae, r2, rmse

__all__ = [
    "adjusted_r2",
    "expm1_price",
    "hash_bucket",
    "is_number",
    "log_target",
    "mae",
    "product",
    "r2",
    "ratio_or_zero",
    "rmse",
    "row_key",
    "square",
    "zero_if_null",
]
