"""Column functions over timestamps. They read the session time zone as UTC."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import contract as c


def instant(ts: Column) -> Column:
    """A timestamp without zone taken as UTC; a timestamp with zone unchanged."""
    return ts.cast("timestamp")


def try_timestamp(text: Column) -> Column:
    """A client-declared time; NULL when malformed."""
    return text.try_cast("timestamp")


def truncate_time(unit: str, ts: Column) -> Column:
    return F.date_trunc(unit, ts)


def epoch_window(ts: Column, seconds: int = c.WINDOW_SECONDS) -> Column:
    """Epoch second at which the window holding `ts` starts."""
    epoch = F.unix_seconds(instant(ts))
    return epoch - F.pmod(epoch, F.lit(seconds))


def latency_ms(event_time: Column, processed_at: Column) -> Column:
    """Whole milliseconds between the two, each side truncated first."""
    return F.unix_millis(instant(processed_at)) - F.unix_millis(instant(event_time))


def business_day(
    ts: Column, zone: str = c.DAY_TIME_ZONE, close_hour: int = c.DAY_CLOSE_HOUR
) -> Column:
    """The day whose window (previous close, close] in local time holds `ts`."""
    local = F.from_utc_timestamp(instant(ts), zone)
    return F.to_date(local + F.make_dt_interval(hours=F.lit(24 - close_hour)))
