"""Times as text."""

from pyspark.sql import functions as F


def start_text(epoch_millis, slack_seconds=2):
    """Epoch milliseconds, less a slack for clock skew, as `MM/dd/yyyy HH:mm:ss UTC`.

    Reckoned without a time zone, so the session's does not matter.
    """
    seconds = (epoch_millis / F.lit(1000)).cast("decimal(18,6)") - F.lit(slack_seconds)
    zero = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    at = zero + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
    return F.concat(F.date_format(at, "MM/dd/yyyy HH:mm:ss"), F.lit(" UTC"))
