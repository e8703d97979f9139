"""What both vector operators share: which vectors take part, and blocks of vectors as matrices."""

import numpy as np
from pyspark.sql import functions as F


def usable(column):
    """Whether an array column is not null, not empty, not zero and holds only finite numbers."""
    return F.coalesce(
        (F.size(column) > 0)
        & F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(column, lambda x: x != 0),
        F.lit(False),
    )


def one_width(vectors):
    """The number of components of all vectors, None if there are none; raises if they differ."""
    row = vectors.agg(F.min(F.size("embedding")).alias("low"), F.max(F.size("embedding")).alias("high")).first()
    if row["low"] != row["high"]:
        raise ValueError(f"vectors have {row['low']} to {row['high']} components")
    return row["low"]


def matrix(column):
    """A pandas or Arrow column of arrays as a float64 matrix."""
    return np.array([np.asarray(v, np.float64) for v in column], np.float64)


def unit(x):
    """Rows scaled to length 1, without overflow."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)
