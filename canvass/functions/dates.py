"""Date and time helpers as column expressions. Sessions run with the zone set to UTC."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from canvass.functions.columns import ColumnLike, as_column
from canvass.functions.rules import first_match
from canvass.functions.text import squish

# The time format of submissions, and the words around an appointment.
SUBMISSION_FORMAT = "MMM d, yyyy h:m:s a"
APPOINTMENT_WORDS = "Dia: |Hora:"
APPOINTMENT_FORMAT = "yyyy-M-d H:m"


def submission_time(value: ColumnLike, hours_behind: int = 3) -> Column:
    """Parse a submission time written in UTC and move it to local wall-clock time."""
    parsed = F.try_to_timestamp(as_column(value), F.lit(SUBMISSION_FORMAT))
    return parsed - F.make_dt_interval(hours=F.lit(hours_behind))


def appointment_time(
    value: ColumnLike,
    zone: str,
    words: str = APPOINTMENT_WORDS,
    fmt: str = APPOINTMENT_FORMAT,
) -> Column:
    """Instant of an appointment written as local time; NULL if it does not parse."""
    text = squish(F.regexp_replace(as_column(value), words, ""))
    return F.to_utc_timestamp(F.try_to_timestamp(text, F.lit(fmt)), zone)


def overdue_label(
    instant: ColumnLike,
    as_of: datetime | Column,
    *,
    overdue: str = "⚠️ CITA VENCIDA",
    pending: str = "Pendiente",
    none: str = "Sin Cita Programada",
) -> Column:
    """Label an appointment against a given moment; the clock is never read here."""
    now = as_of if isinstance(as_of, Column) else F.lit(as_of)
    when = as_column(instant)
    return first_match([(when.isNull(), none), (when < now, overdue)], pending)


def on_or_after(value: ColumnLike, floor: str) -> Column:
    """Date floor at midnight."""
    return as_column(value) >= F.lit(floor).cast("date")


def days_between(last: ColumnLike, first: ColumnLike) -> Column:
    return F.datediff(as_column(last), as_column(first))


def active_days(last: ColumnLike, first: ColumnLike) -> Column:
    """Days from the first to the last visit, both included."""
    return days_between(last, first) + 1
