"""Keep costly expressions from being evaluated more than once per row."""

from pyspark.sql import functions as F


def evaluate_once(df, *cols, keep=()):
    """Select `cols` so that they are computed once, however often they are used.

    The optimiser copies an expression into every filter and projection that
    refers to it. Columns that come out of a generator stay columns, so a
    one-element `inline` marks the point up to which the work is done.
    """
    return df.select(*keep, F.inline(F.array(F.struct(*cols))))
