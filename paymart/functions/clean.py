"""String normalisation used by the silver layer.

``trim`` strips spaces only (tabs survive), as Spark's ``trim`` does.  Case
mapping runs before trimming, so ``initcap`` sees the leading space and word
boundaries of the raw text.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from paymart.functions._col import col


def trim(c: "str | Column") -> Column:
    return F.trim(col(c))


def lower_trim(c: "str | Column") -> Column:
    return F.trim(F.lower(col(c)))


def upper_trim(c: "str | Column") -> Column:
    return F.trim(F.upper(col(c)))


def initcap_trim(c: "str | Column") -> Column:
    return F.trim(F.initcap(col(c)))
