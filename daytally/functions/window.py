"""The report window: a closed interval that ends at a fixed hour of the report day.

Semantics kept from the original job:

* both ends are inclusive, so an event exactly on the cut belongs to two consecutive
  daily reports (``Column.between``, never ``F.window``, which is half-open);
* the report instant is resolved once, on the driver, and every source sees the same one;
* the whole path stays ``TIMESTAMP_NTZ`` (wall-clock, no time zone).  A DATE column is
  compared as midnight of that day, exactly as a database compares DATE with DATETIME.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, time, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the original report: the cut hour and the label formats.
CUT_HOUR = 8
LOOKBACK = timedelta(days=1)
LABEL_PATTERN_SPARK = "dd-MMM-yyyy (hh:mm a)"  # e.g. 05-Jan-2024 (08:00 AM)
LABEL_PATTERN_PY = "%d-%b-%Y (%I:%M %p)"
DAY_LABEL_SPARK = "dd-MMM-yyyy"
DAY_LABEL_PY = "%d-%b-%Y"


def _ntz_sql(ts: datetime) -> str:
    return f"TIMESTAMP_NTZ '{ts.strftime('%Y-%m-%d %H:%M:%S.%f')}'"


def _ntz(ts: datetime) -> Column:
    return F.lit(ts.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


@dataclass(frozen=True)
class ReportWindow:
    """``[end - lookback, end]``, both inclusive, wall-clock time."""

    end: datetime
    lookback: timedelta = LOOKBACK

    @classmethod
    def closing_on(cls, day: date, cut_hour: int = CUT_HOUR, lookback: timedelta = LOOKBACK) -> "ReportWindow":
        return cls(datetime.combine(day, time(cut_hour)), lookback)

    @classmethod
    def for_run(cls, now: datetime | None = None, cut_hour: int = CUT_HOUR, lookback: timedelta = LOOKBACK, *,
                zone: str = "UTC") -> "ReportWindow":
        """The window a run started at ``now`` (default: the clock, read once) reports on, in wall-clock time of
        ``zone``: the zone of the fact times, of the report day and of the cut hour."""
        now = now or datetime.now(ZoneInfo(zone))
        if now.tzinfo is not None:
            now = now.astimezone(ZoneInfo(zone))
        return cls.closing_on(now.date(), cut_hour, lookback)

    def zone_offset(self, zone: str) -> str:
        """The zone's offset at the window's end, as ``+05:30``."""
        text = self.end.replace(tzinfo=ZoneInfo(zone)).strftime("%z")
        return f"{text[:3]}:{text[3:5]}"

    @property
    def start(self) -> datetime:
        return self.end - self.lookback

    @property
    def report_date(self) -> date:
        return self.end.date()

    def bounds(self) -> tuple[Column, Column]:
        return _ntz(self.start), _ntz(self.end)

    def contains(self, column: Column | str) -> Column:
        if isinstance(column, str):
            return F.expr(self.contains_sql(column))
        lo, hi = self.bounds()
        return column.between(lo, hi)

    def contains_sql(self, column: str) -> str:
        return f"{column} BETWEEN {_ntz_sql(self.start)} AND {_ntz_sql(self.end)}"

    def partition_days_sql(self, column: str) -> str:
        """Predicate on a DATE partition column that keeps every day the window touches."""
        return f"{column} BETWEEN DATE '{self.start.date().isoformat()}' AND DATE '{self.end.date().isoformat()}'"

    def widened(self, runs: int) -> "ReportWindow":
        """The span covered by this window and the ``runs - 1`` daily windows before it."""
        return ReportWindow(self.end, self.lookback + timedelta(days=runs - 1))

    def run_range_sql(self, column: str, runs: int) -> tuple[str, str]:
        """(first, last) of the runs ``k`` in ``[0, runs)`` whose window – this one moved ``k``
        days back – holds the value of ``column``; first > last when none does.

        With ``d`` = microseconds from the value to this window's end, run ``k`` holds it iff
        ``k·DAY <= d <= k·DAY + lookback``, i.e. ``ceil((d - lookback)/DAY) <= k <= floor(d/DAY)``.
        """
        day = 86_400_000_000
        lb = int(self.lookback.total_seconds() * 1_000_000)
        d = f"timestampdiff(MICROSECOND, CAST({column} AS TIMESTAMP_NTZ), {_ntz_sql(self.end)})"
        last = f"least(CAST(({d} - pmod({d}, {day})) div {day} AS INT), {runs - 1})"
        first = f"greatest(CAST(-((({lb} - {d}) - pmod({lb} - {d}, {day})) div {day}) AS INT), 0)"
        return first, last

    def run_offsets_sql(self, column: str, runs: int) -> str:
        """``array<int>`` of the runs in :meth:`run_range_sql`: one for most rows of a daily window, two for
        a row exactly on a cut (both ends are inclusive), more where the lookback is longer."""
        first, last = self.run_range_sql(column, runs)
        return f"CASE WHEN {first} <= {last} THEN sequence({first}, {last}) ELSE array() END"

    def labels(self) -> tuple[str, str]:
        return self.start.strftime(LABEL_PATTERN_PY), self.end.strftime(LABEL_PATTERN_PY)

    def generated_on(self) -> str:
        return self.end.strftime(DAY_LABEL_PY)


def zone_slices(start: datetime, end: datetime, zone: str) -> list[tuple[datetime, datetime, str]]:
    """The instants whose wall-clock time in ``zone`` lies in ``[start, end]``, cut where the zone's offset changes.

    Each slice is (first, last, offset) in the wall-clock time of its own fixed offset, half-open but for the last
    one.  Together they hold every such instant once; an hour that the clock repeats is in two slices,
    one per offset, and an hour that it skips is in none.  Next to a change at a bound they hold a little more, which the
    exact window filters.
    """
    tz, utc = ZoneInfo(zone), ZoneInfo("UTC")
    at, stop = (t.replace(tzinfo=tz, fold=f).astimezone(utc) for t, f in ((start, 0), (end, 1)))
    slices = []
    while True:
        offset = at.astimezone(tz).utcoffset()
        change = _offset_change(at, stop, tz)
        upper = stop if change is None else change
        slices.append(((at + offset).replace(tzinfo=None), (upper + offset).replace(tzinfo=None), _offset_text(offset)))
        if change is None:
            return slices
        at = change


def _offset_change(at: datetime, stop: datetime, tz: ZoneInfo) -> datetime | None:
    """The first instant in ``(at, stop]`` at which the zone's offset is not the one at ``at``."""
    offset, step = at.astimezone(tz).utcoffset(), timedelta(hours=1)
    low = at
    while low < stop:
        high = min(low + step, stop)
        if high.astimezone(tz).utcoffset() != offset:
            while high - low > timedelta(seconds=1):
                middle = low + (high - low) // 2
                low, high = (middle, high) if middle.astimezone(tz).utcoffset() == offset else (low, middle)
            return high.replace(microsecond=0)  # zone rules change on whole seconds
        low = high
    return None


def _offset_text(offset: timedelta) -> str:
    minutes = int(offset.total_seconds()) // 60
    return f"{'-' if minutes < 0 else '+'}{abs(minutes) // 60:02d}:{abs(minutes) % 60:02d}"


def label(column: Column) -> Column:
    """Spark-side label of a bound, same text as :meth:`ReportWindow.labels`."""
    return F.date_format(column, LABEL_PATTERN_SPARK)


def day_label(column: Column) -> Column:
    """Spark-side "generated on" label, same text as :meth:`ReportWindow.generated_on`."""
    return F.date_format(column, DAY_LABEL_SPARK)
