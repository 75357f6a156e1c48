from .joins import join_null_safe
from .search import with_count_at_or_below
from .timeline import micros
from .values import at_least, is_missing, missing_rate, nan_to_null, observed, reading, under

__all__ = [
    "at_least",
    "is_missing",
    "join_null_safe",
    "micros",
    "missing_rate",
    "nan_to_null",
    "observed",
    "reading",
    "under",
    "with_count_at_or_below",
]
