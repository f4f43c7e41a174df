from tidepanel.functions.categorize import classify_keyword, dominant_category, quadrant_label, sign_flag
from tidepanel.functions.numeric import np_round, reduction_pct, row_sum_min_count, safe_ratio, to_numeric
from tidepanel.functions.text import alias_lookup, clean_code, clean_name, normalize_column_names

__all__ = [
    "alias_lookup", "classify_keyword", "clean_code", "clean_name", "dominant_category",
    "normalize_column_names", "np_round", "quadrant_label", "reduction_pct",
    "row_sum_min_count", "safe_ratio", "sign_flag", "to_numeric",
]
