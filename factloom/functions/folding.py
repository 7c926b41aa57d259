"""Unicode compatibility folding (NFKC) in the JVM, and expressions that are computed once.

Spark has no function for it, but ships the ICU library for its collations, and
``java_method`` calls a static method of any class that Spark has: ``compose(text, true)``
is NFKC.  One small node in a plan, no Python, the whole of Unicode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(c: Column, make) -> Column:
    """``make`` of ``c``, which is computed once however often ``make`` uses it (projections may be merged, a variable is not)."""
    return F.transform(F.array(c), make)[0]


def nfkc(c: Column) -> Column:
    """Unicode NFKC; null gives the empty string.  Plain ASCII stays as it is."""
    folded = lambda t: F.java_method(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), t, F.lit(True))
    return once(F.coalesce(c, F.lit("")), lambda t: F.when(F.length(t) == F.octet_length(t), t).otherwise(folded(t)))
