"""Points in time as literals in the session's time zone, whatever the driver's own zone is."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

Moment = datetime | str


def moment(value: Moment) -> Column:
    text = value if isinstance(value, str) else value.isoformat(sep=" ")
    return F.lit(text).cast("timestamp")
