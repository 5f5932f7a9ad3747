"""Text aggregates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def distinct_list(value: Column, separator: str = ",") -> Column:
    """Sorted distinct non-null values joined into one string; NULL when there are none.

    ``collect_set`` merges partial sets before the shuffle, so one hot group moves only its
    distinct values. A distinct ``listagg`` would need a second shuffle.
    """
    values = F.collect_set(value)
    return F.when(F.size(values) > 0, F.array_join(F.array_sort(values), separator))
