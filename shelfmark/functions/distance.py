"""Edit distance in which a swap of neighbours is one edit and no part is edited twice."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_EDITS = 2
#: Letters of a word that its deletions are made of.
HEAD = 7


def deletions(word: Column) -> Column:
    """The first ``HEAD`` letters of a word with up to two letters left out, each text once.

    Two words within two edits of each other share one of them: what both keep of an alignment is had
    by leaving out at most two letters of each, also when only as many first letters are looked at.
    """

    def one_out(text: Column) -> Column:
        places = F.when(F.length(text) > 0, F.sequence(F.lit(1), F.length(text)))
        out = F.transform(
            places, lambda i: F.concat(F.substring(text, F.lit(1), i - 1), F.substring(text, i + 1, F.lit(HEAD)))
        )
        return F.coalesce(out, F.expr("cast(array() as array<string>)"))

    head = F.substring(word, 1, HEAD)
    one = one_out(head)
    return F.array_distinct(F.concat(F.array(head), one, F.flatten(F.transform(one, one_out))))


def deletions_of(word: str) -> list[str]:
    """The same for one word of a query."""
    found, last = {word[:HEAD]}, {word[:HEAD]}
    for _ in range(MAX_EDITS):
        last = {w[:i] + w[i + 1 :] for w in last for i in range(len(w))}
        found |= last
    return sorted(found)


def _edits():
    # Nested, so that it travels with the plan and executors need no copy of this package.
    def distance(a: str, b: str) -> int:
        before: list[int] = []
        last = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row = [i]
            for j, y in enumerate(b, 1):
                best = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
                if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                    best = min(best, before[j - 2] + 1)
                row.append(best)
            before, last = last, row
        return last[-1]

    def edits(a: pd.Series, b: pd.Series) -> pd.Series:
        found = (distance(x, y) for x, y in zip(a, b))
        return pd.Series(np.fromiter(found, dtype=np.int32, count=len(a)))

    return F.pandas_udf(edits, T.IntegerType())


def maybe_within(a: Column, b: Column, edits: int = MAX_EDITS) -> Column:
    """A JVM-side condition every pair within ``edits`` meets.

    A swap costs two plain edits, so such pairs are at most ``2 * edits`` plain edits apart.
    """
    return (F.abs(F.length(a) - F.length(b)) <= edits) & (
        F.levenshtein(a, b, 2 * edits) >= 0
    )


def edit_distance(a: Column, b: Column) -> Column:
    """The distance itself; lookups call it only for pairs that passed :func:`maybe_within`."""
    return _edits()(a, b)
