"""Does a schedule fire on a given day? Day granularity, plain expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# Preset names and the five-field schedules they stand for.
PRESETS = {
    "@hourly": "0 * * * *",
    "@daily": "0 0 * * *",
    "@midnight": "0 0 * * *",
    "@weekly": "0 0 * * 0",
    "@monthly": "0 0 1 * *",
    "@quarterly": "0 0 1 */3 *",
    "@yearly": "0 0 1 1 *",
    "@annually": "0 0 1 1 *",
}
# Presets that never recur, words for "none", non-calendar marks.
NEVER_PRESETS = ("@once", "@never")
NONE_WORDS = ("none", "null", "nan", "")
NOT_CALENDAR = r"(?i)dataset|_type|timetable|timedelta"
# Month and weekday names with their numbers.
MONTHS = {
    "jan": 1, "feb": 2, "mar": 3, "apr": 4, "may": 5, "jun": 6,
    "jul": 7, "aug": 8, "sep": 9, "oct": 10, "nov": 11, "dec": 12,
}
WEEKDAYS = {"sun": 0, "mon": 1, "tue": 2, "wed": 3, "thu": 4, "fri": 5, "sat": 6}

_TOKEN = r"^(\*|\d{1,2}(-\d{1,2})?)(/[1-9]\d?)?$"


def _numbers(field: Column, names: dict[str, int]) -> Column:
    return reduce(
        lambda acc, kv: F.replace(acc, F.lit(kv[0]), F.lit(str(kv[1]))),
        names.items(),
        F.lower(field),
    )


def _bounds(token: Column, low: int, high: int) -> tuple[Column, Column, Column]:
    base = F.element_at(F.split(token, "/"), 1)
    step = F.coalesce(F.get(F.split(token, "/"), F.lit(1)).try_cast("int"), F.lit(1))
    first = F.when(base == "*", low).otherwise(
        F.element_at(F.split(base, "-"), 1).try_cast("int")
    )
    last = (
        F.when(base == "*", high)
        .when(F.contains(base, F.lit("-")), F.get(F.split(base, "-"), F.lit(1)).try_cast("int"))
        .when(F.contains(token, F.lit("/")), F.lit(high))
        .otherwise(first)
    )
    return first, last, step


def _valid(field: Column, low: int, high: int) -> Column:
    def ok(token: Column) -> Column:
        first, last, _ = _bounds(token, low, high)
        return (
            token.rlike(_TOKEN)
            & (first >= low)
            & (last <= high)
            & (first <= last)
        )

    return F.forall(F.split(field, ","), lambda t: F.coalesce(ok(t), F.lit(False)))


def _hits(field: Column, value: Column, low: int, high: int) -> Column:
    def hit(token: Column) -> Column:
        first, last, step = _bounds(token, low, high)
        return (value >= first) & (value <= last) & ((value - first) % step == 0)

    return F.exists(F.split(field, ","), lambda t: F.coalesce(hit(t), F.lit(False)))


def schedule_due(schedule: Column | str, day: Column) -> Column:
    """True / False, or NULL when the schedule cannot be read as a calendar.

    When both day fields are restricted either of them suffices, as in cron.
    """
    s = F.col(schedule) if isinstance(schedule, str) else schedule
    raw = F.trim(s)
    quoted = raw.rlike(r"""^(".*"|'.*')$""") & (F.length(raw) >= 2)
    bare = F.when(
        quoted, F.trim(F.substring(raw, F.lit(2), F.length(raw) - 2))
    ).otherwise(raw)
    return _let(bare, lambda text: _due(text, day))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often it is named."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _due(raw: Column, day: Column) -> Column:
    word = F.lower(raw)
    preset = F.create_map(*[F.lit(x) for kv in PRESETS.items() for x in kv])
    cron = F.coalesce(F.try_element_at(preset, word), raw)
    nothing = F.lit(None).cast("boolean")
    return (
        F.when(raw.isNull() | word.isin(list(NONE_WORDS)), nothing)
        .when(word.isin(list(NEVER_PRESETS)), F.lit(False))
        .when(raw.rlike(NOT_CALENDAR), nothing)
        .otherwise(
            _let(F.split(F.trim(cron), r"\s+"), lambda fields: _fires(fields, day))
        )
    )


def _fires(fields: Column, day: Column) -> Column:
    def part(i: int) -> Column:
        return F.get(fields, F.lit(i))

    minute, hour = part(0), part(1)
    dom = F.when(part(2) == "?", "*").otherwise(part(2))
    month = _numbers(part(3), MONTHS)
    dow = F.when(part(4) == "?", "*").otherwise(_numbers(part(4), WEEKDAYS))
    readable = (
        (F.size(fields) == 5)
        & _valid(minute, 0, 59)
        & _valid(hour, 0, 23)
        & _valid(dom, 1, 31)
        & _valid(month, 1, 12)
        & _valid(dow, 0, 7)
    )
    # Sunday is 0, also written 7.
    weekday = F.dayofweek(day) - F.lit(1)
    dow_hit = _hits(dow, weekday, 0, 6) | (
        (weekday == 0) & F.contains(dow, F.lit("7")) & _hits(dow, F.lit(7), 0, 7)
    )
    dom_hit = _hits(dom, F.dayofmonth(day), 1, 31)
    any_dom = dom.isin("*", "*/1", "1-31")
    any_dow = dow.isin("*", "*/1", "0-6", "1-7", "0-7")
    day_hit = F.when(any_dom | any_dow, dom_hit & dow_hit).otherwise(dom_hit | dow_hit)
    fires = _hits(month, F.month(day), 1, 12) & day_hit
    return F.when(F.coalesce(readable, F.lit(False)), fires)
