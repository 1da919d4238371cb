from salescope.functions.columns import (
    SEQUENCE_LENGTH,
    category_part,
    class_weight,
    clean_category,
    clean_product,
    date_parts,
    clock_parts,
    day_name,
    file_label,
    hash_bucket,
    hours_between,
    parse_timestamp,
    prediction_error,
    probability_of_one,
    repurchase_flag,
    seconds_of,
    strings_of,
    vector_element,
    wall_clock,
)

__all__ = [
    "SEQUENCE_LENGTH", "category_part", "class_weight", "clean_category", "clean_product", "date_parts", "clock_parts",
    "day_name", "file_label", "hash_bucket", "hours_between", "parse_timestamp", "prediction_error",
    "probability_of_one", "repurchase_flag", "seconds_of", "strings_of", "vector_element", "wall_clock",
]
