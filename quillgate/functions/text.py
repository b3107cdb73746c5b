"""Text distances."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType


def char_errors(reference: Column | str, said: Column | str) -> Column:
    """Edit distance in characters."""
    return F.levenshtein(reference, said).cast("long")


def _words(a: str, b: str) -> int:
    x, y = a.split(), b.split()
    if not y:
        return len(x)
    ids: dict[str, int] = {}
    v = np.array([ids.setdefault(w, len(ids)) for w in y])
    offsets = np.arange(len(y) + 1)
    row = offsets.copy()
    for i, w in enumerate(x, 1):
        best = np.empty_like(row)
        best[0] = i
        np.minimum(row[1:] + 1, row[:-1] + (v != ids.get(w, -1)), out=best[1:])
        row = np.minimum.accumulate(best - offsets) + offsets  # insertions run along the row
    return int(row[-1])


@F.pandas_udf(LongType())
def word_errors(reference: pd.Series, said: pd.Series) -> pd.Series:
    """Edit distance in words, for which Spark has no function."""
    return pd.Series([None if a is None or b is None else _words(a, b) for a, b in zip(reference, said, strict=True)], dtype="Int64")
