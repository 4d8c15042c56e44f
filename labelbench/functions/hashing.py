"""Row placement from the key alone.

``randomSplit`` depends on how rows are laid out even with a seed. These columns depend on the key
only, so a split or a fold is the same after any repartitioning, retry or re-read.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _digest_number(key: str | Column, start: int) -> Column:
    key = F.col(key) if isinstance(key, str) else key
    digits = F.substring(F.md5(key.cast("string")), start, 8)
    return F.conv(digits, 16, 10).cast("bigint")


def is_train(key: str | Column, percent: int = 80) -> Column:
    """True for about ``percent`` of the keys."""
    return _digest_number(key, 1) % 100 < percent


def fold_of(key: str | Column, folds: int = 3) -> Column:
    """Fold number from other digits of the digest than the split, so the two are independent."""
    return (_digest_number(key, 9) % folds).cast("int")
