"""Column-expression helpers (JVM-side, codegen friendly)."""

from cohortlens.functions.hashing import portable_hash, hash_unit, hash_hex
from cohortlens.functions.ratios import safe_ratio, confusion_aggs, metric_columns

__all__ = [
    "portable_hash",
    "hash_unit",
    "hash_hex",
    "safe_ratio",
    "confusion_aggs",
    "metric_columns",
]
