"""Fixed values of the beneficiary-movement domain.

These must stay exactly as they are: cleaned data, rejection reasons and the
surrogate keys downstream depend on them.
"""

from __future__ import annotations

# --- fixed values -----------------------------------------------------------
# Values that mean "absent" once trimmed and upper-cased.
NULL_TOKENS = ["", "NULL", "N/A", "NA", "NAN", "-", "NONE"]

# Brazilian state codes accepted in sg_uf, in this order.
VALID_UFS = [
    "AC", "AL", "AP", "AM", "BA", "CE", "DF", "ES", "GO",
    "MA", "MT", "MS", "MG", "PA", "PB", "PR", "PE", "PI",
    "RJ", "RN", "RS", "RO", "RR", "SC", "SP", "SE", "TO",
]

# Separator of the record and key hashes, and the stand-in for NULL inside a key.
HASH_SEPARATOR = "||"
HASH_NULL_TOKEN = "__NULL__"

# Date layouts tried in order by parse_date (Spark datetime patterns).
DATE_FORMATS = ["yyyy-MM-dd", "dd/MM/yyyy", "yyyyMMdd"]

# Suffix of the per-column "missing" rejection reason.
MISSING_SUFFIX = " ausente"
# Separator between several rejection reasons of one row.
REASON_SEPARATOR = "; "
# --- end of fixed values ----------------------------------------------------
