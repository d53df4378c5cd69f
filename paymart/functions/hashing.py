"""Change-detection hash over tracked attributes."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separator of the hashed text and the NULL sentinel used by the
# null-safe variant.
HASH_SEPARATOR = "|"
NULL_SENTINEL = "\\N"


def record_hash(cols: Sequence[str], null_safe: bool = False) -> Column:
    """md5 over the '|'-joined string forms of ``cols``.

    The default skips NULLs, as ``concat_ws`` does, so ``('a', NULL, 'b')`` and
    ``('a', 'b', NULL)`` hash alike; it is kept for compatibility with stored
    hashes.  ``null_safe=True`` replaces NULL by a sentinel so that every column
    keeps its position.
    """
    parts = [F.col(c).cast("string") for c in cols]
    if null_safe:
        parts = [F.coalesce(p, F.lit(NULL_SENTINEL)) for p in parts]
    return F.md5(F.concat_ws(HASH_SEPARATOR, *parts))
