"""Column -> Column functions built only from Spark SQL expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, fn) -> Column:
    """Evaluate ``value`` once and pass it to ``fn`` (a ``Column -> Column`` function).

    Expressions that use their input many times (exact rounding, number parsing)
    would otherwise copy the whole input expression into every use, and Catalyst
    may inline upstream projections into it. Binding through a one-element array
    keeps a single evaluation.
    """
    return F.transform(F.array(value), fn)[0]


_MEMO: dict = {}


def memo_column(key, builder) -> Column:
    """Build a Column once per Spark application and reuse it.

    Large expressions (JSON signals, exact rounding, URL repair) cost hundreds of
    driver round trips to build; they refer to input columns by name, so one
    built expression serves every DataFrame of the same application.
    """
    from pyspark import SparkContext
    sc = SparkContext._active_spark_context
    k = (sc.applicationId if sc is not None else None, key)
    if k not in _MEMO:
        _MEMO[k] = builder()
    return _MEMO[k]
