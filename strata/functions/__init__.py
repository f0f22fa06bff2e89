from strata.functions.cleaning import (
    clean_string,
    clean_upper,
    in_domain,
    only_digits,
    parse_date,
    parse_long,
)
from strata.functions.constants import NULL_TOKENS, VALID_UFS
from strata.functions.hashing import add_hash_key, add_record_hash, hash_key, record_hash
from strata.functions.names import cast_all_to_string, normalize_column_name, normalize_columns

__all__ = [
    "NULL_TOKENS",
    "VALID_UFS",
    "add_hash_key",
    "add_record_hash",
    "cast_all_to_string",
    "clean_string",
    "clean_upper",
    "hash_key",
    "in_domain",
    "normalize_column_name",
    "normalize_columns",
    "only_digits",
    "parse_date",
    "parse_long",
    "record_hash",
]
