"""Calendar parts of instants, for sessions in UTC.

``to_date`` and ``hour`` make calendar objects of every row; in UTC both are
plain arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_HOUR = 3_600_000_000
_DAY = 24 * _HOUR


def utc_date(instant: Column) -> Column:
    micros = F.unix_micros(instant)
    return F.date_from_unix_date(_quotient(micros - F.pmod(micros, F.lit(_DAY)), _DAY))


def utc_hour(instant: Column) -> Column:
    return _quotient(F.pmod(F.unix_micros(instant), F.lit(_DAY)), _HOUR)


def _quotient(value: Column, divisor: int) -> Column:
    return F.call_function("div", value, F.lit(divisor)).cast("int")
