"""Time conversions used by sinks and monitoring (Columns, JVM-side)."""

from __future__ import annotations

import datetime as _dt
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

# Display zone and compact stamp format.
PACIFIC = "America/Los_Angeles"
COMPACT_FORMAT = "yyyyMMddHHmmss"
COMPACT_FORMAT_PY = "%Y%m%d%H%M%S"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def millis_to_timestamp(ms) -> Column:
    return F.timestamp_millis(_col(ms))


def pacific_compact(ms) -> Column:
    """Epoch ms -> Pacific wall-clock ``yyyyMMddHHmmss``."""
    return F.date_format(F.from_utc_timestamp(millis_to_timestamp(ms), PACIFIC), COMPACT_FORMAT)


def pacific_compact_py(ms: int) -> str:
    """Driver-side form for a single instant (file names)."""
    t = _dt.datetime.fromtimestamp(ms / 1000.0, tz=_dt.timezone.utc).astimezone(ZoneInfo(PACIFIC))
    return t.strftime(COMPACT_FORMAT_PY)


def csv_filename(ms) -> Column:
    return F.concat(F.lit("rtscore_"), pacific_compact(ms), F.lit(".csv"))


def hours_from_ms(ms) -> Column:
    return _col(ms).cast("double") / F.lit(1000.0 * 60 * 60)


def minutes_from_ms(ms) -> Column:
    return _col(ms).cast("double") / F.lit(1000.0 * 60)
