"""Time helpers that do not depend on the session time zone.

The driver tables store wall-clock timestamps (``TIMESTAMP_NTZ``); turning
them into epoch numbers through ``unix_timestamp`` would shift them by the
session zone.  These helpers read the fields directly.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_micros(ts) -> Column:
    """Microseconds since 1970-01-01 00:00 of the wall-clock value."""
    t = _c(ts).cast("timestamp_ntz")
    days = F.datediff(F.to_date(t), F.lit("1970-01-01").cast("date")).cast("bigint")
    whole = days * 86400 + F.hour(t).cast("bigint") * 3600 + F.minute(t).cast("bigint") * 60
    frac = F.extract(F.lit("SECOND"), t)  # decimal(8,6): seconds with fraction
    return (whole * 1_000_000 + (frac * 1_000_000).cast("bigint")).cast("bigint")


def epoch_seconds(ts) -> Column:
    return F.floor(epoch_micros(ts) / 1_000_000).cast("bigint")
