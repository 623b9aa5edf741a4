from stratalake.functions.columns import (
    as_column,
    clean_text,
    is_true,
    key_hash,
    mask_tail,
    percent_change,
    safe_ratio,
)

__all__ = [
    "as_column",
    "clean_text",
    "is_true",
    "key_hash",
    "mask_tail",
    "percent_change",
    "safe_ratio",
]
