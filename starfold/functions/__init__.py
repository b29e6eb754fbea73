from starfold.functions.columns import (
    HASH_SEPARATOR,
    MISSING_TOKENS,
    NULL_HASH_TOKEN,
    OPEN_END_DATE,
    add_record_hash,
    any_null,
    any_null_or_blank,
    classify,
    date_lit,
    flag,
    lower_trim,
    normalized_string,
    null_if_missing,
    ratio,
    record_hash_expr,
    surrogate_key,
    title_case,
    typed,
    upper_code,
)

__all__ = [
    "HASH_SEPARATOR",
    "MISSING_TOKENS",
    "NULL_HASH_TOKEN",
    "OPEN_END_DATE",
    "add_record_hash",
    "any_null",
    "any_null_or_blank",
    "classify",
    "date_lit",
    "flag",
    "lower_trim",
    "normalized_string",
    "null_if_missing",
    "ratio",
    "record_hash_expr",
    "surrogate_key",
    "title_case",
    "typed",
    "upper_code",
]
