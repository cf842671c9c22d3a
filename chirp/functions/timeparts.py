"""Fixed-position parts of ``created_at`` (G01-G05, E19).

Input text looks like ``Sat May 07 12:34:56 +0000 2022``. The offset is
replaced by one space first (leaving three spaces before the year, so the
year starts at character 23). Bad text yields NULL parts, never an error:
parsing uses ``try_to_timestamp`` because Spark 4 runs with ANSI on.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chirp.functions.text import ColumnOrName, _c


def strip_offset(created_at: ColumnOrName) -> Column:
    return F.replace(_c(created_at), F.lit("+0000"), F.lit(" "))


def created_at_parts(created_at: ColumnOrName) -> dict[str, Column]:
    """Derived columns, keyed by output name, from a ``created_at`` whose
    offset has already been stripped."""
    ca = _c(created_at)
    month_name = F.substring(ca, 5, 3)
    month = F.date_format(F.try_to_timestamp(month_name, F.lit("MMM")), "MM")
    day = F.substring(ca, 9, 2)
    hour = F.substring(ca, 12, 2)
    minute = F.substring(ca, 15, 2)
    second = F.substring(ca, 18, 2)
    year = F.substring(ca, 23, 4)
    date_s = F.concat(year, F.lit("-"), month, F.lit("-"), day)
    time_s = F.concat(hour, F.lit(":"), minute, F.lit(":"), second)
    ts = F.try_to_timestamp(F.concat(date_s, F.lit(" "), time_s),
                            F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")
    return {
        "day_of_week": F.substring(ca, 1, 3),
        "month_name": month_name,
        "month": month,
        "day": day,
        "hour": hour,
        "minute": minute,
        "second": second,
        "year": year,
        "tweet_date_string": date_s,
        "tweet_time_string": time_s,
        "tweet_date": ts,
    }
