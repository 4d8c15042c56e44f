from labelbench.functions.hashing import fold_of, is_train
from labelbench.functions.labels import GOOD_FROM, good_label, good_label_udf, register_functions
from labelbench.functions.text import count_char, count_matches

__all__ = [
    "GOOD_FROM",
    "count_char",
    "count_matches",
    "fold_of",
    "good_label",
    "good_label_udf",
    "is_train",
    "register_functions",
]
