"""Word error rate as an Arrow-batched function."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from sonoweave.functions.text import error_rate_tokens


def token_distance(ref: list, hyp: list) -> int:
    """Levenshtein distance of two token sequences, one numpy row at a time."""
    names: dict = {}
    a = [names.setdefault(t, len(names)) for t in ref]
    b = np.array([names.setdefault(t, len(names)) for t in hyp], dtype=np.int64)
    steps = np.arange(len(b) + 1)
    row = steps.copy()
    for i, t in enumerate(a, 1):
        step = np.minimum(row[1:] + 1, row[:-1] + (b != t))
        row = np.minimum.accumulate(np.concatenate(([i], step)) - steps) + steps
    return int(row[-1])


def _rates(ref: pd.Series, hyp: pd.Series) -> pd.Series:
    pairs = zip(ref, hyp, strict=True)
    return pd.Series([token_distance(list(r), list(h)) / max(len(r), 1) for r, h in pairs], dtype="float64")


def word_error_rate(ref: Column, hyp: Column) -> Column:
    """Edit distance of the tokens over the reference's token count (at least 1); null texts have no tokens."""
    return F.pandas_udf(_rates, DoubleType())(error_rate_tokens(ref), error_rate_tokens(hyp))
