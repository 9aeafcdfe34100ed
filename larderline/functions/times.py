"""Zone-less times. None of these reads the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# First and last second that a four-digit year can show.
FIRST_SECOND = -62135596800
LAST_SECOND = 253402300799


def _unix_origin() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def epoch_to_timestamp(seconds: Column) -> Column:
    """Unix seconds, as a number or as text, to the UTC wall clock; NULL for
    text that is no whole number and for seconds outside the calendar."""
    whole = seconds.try_cast("bigint")
    return F.when(
        whole.between(FIRST_SECOND, LAST_SECOND),
        _unix_origin() + F.make_dt_interval(secs=whole),
    )


def timestamp_to_epoch(moment: Column) -> Column:
    """Whole Unix seconds of a zone-less timestamp."""
    days = F.date_diff(moment.cast("date"), F.lit("1970-01-01").cast("date"))
    return (
        days.cast("bigint") * 86400
        + F.hour(moment) * 3600
        + F.minute(moment) * 60
        + F.second(moment)
    )


def iso_to_timestamp(text: Column) -> Column:
    """ISO text to a timestamp. The letters T and Z only separate; a zone is
    dropped, not converted. NULL where the text is no timestamp."""
    plain = F.replace(F.replace(text, F.lit("T"), F.lit(" ")), F.lit("Z"), F.lit(""))
    return plain.try_cast("timestamp_ntz")


def slot(seconds: Column, within_seconds: int) -> Column:
    """The slot of time, twice the bound long, that a moment falls into; for a
    bound of zero each second is one."""
    if within_seconds < 0:
        raise ValueError("the bound must not be negative")
    return F.floor(seconds / max(1, 2 * within_seconds))


def touched_slots(seconds: Column, within_seconds: int) -> Column:
    """The one or two slots with moments at most the bound away."""
    first = slot(seconds - within_seconds, within_seconds)
    return F.sequence(first, slot(seconds + within_seconds, within_seconds))
