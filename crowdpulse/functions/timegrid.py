"""Event time and the grid of notification times.

The grid starts at ``origin`` and ticks every ``every`` seconds. Slot ``k`` is the
right-closed interval ``(origin + (k-1)*every, origin + k*every]``, so an event that
falls exactly on a tick still belongs to the notification at that tick.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed input format: UTC, seconds with an optional fraction.
UTC_PATTERN = "yyyy-MM-dd'T'HH:mm:ss[.SSS]X"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_utc(text) -> Column:
    """Whole epoch seconds of a UTC time text, null if it is not one."""
    return F.unix_seconds(F.try_to_timestamp(_col(text), F.lit(UTC_PATTERN)))


def slot_index(ts_s, origin: int, every: int) -> Column:
    """First slot whose closing time is not before the event, in exact whole numbers."""
    return -floor_div(F.lit(origin).cast("bigint") - _col(ts_s), every)


def floor_div(value, by: int) -> Column:
    """Whole-number division that rounds down for negative values too."""
    value = _col(value)
    return F.call_function("div", value - F.pmod(value, F.lit(by)), F.lit(by))


def slot_time(k, origin: int, every: int) -> Column:
    return (F.lit(origin).cast("bigint") + _col(k) * F.lit(every)).cast("bigint")


def last_slot(ts_s: int, origin: int, every: int) -> int:
    """Plain-number twin of ``slot_index`` for grid limits already known to the driver."""
    return -((origin - ts_s) // every)
