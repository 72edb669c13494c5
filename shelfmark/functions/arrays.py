"""Array functions that work inside one row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times inside ``body``."""
    return F.transform(F.array(value), body)[0]


def runs(sorted_structs: Column, key: str) -> Column:
    """Cut an array sorted by ``key`` into one array per key, in linear time."""

    def cut(found: Column) -> Column:
        starts = F.filter(
            F.when(F.size(found) > 0, F.sequence(F.lit(0), F.size(found) - 1)).otherwise(
                F.array().cast("array<int>")
            ),
            lambda i: (i == 0) | ~F.get(found, i)[key].eqNullSafe(F.get(found, i - 1)[key]),
        )
        return let(
            starts,
            lambda at: F.transform(
                at,
                lambda start, k: F.slice(
                    found, start + 1, F.coalesce(F.get(at, k + 1), F.size(found)) - start
                ),
            ),
        )

    return let(sorted_structs, cut)
