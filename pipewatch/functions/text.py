"""Log-text mining as column expressions."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

# Line categories (a line counts once per category it hits).
ERROR_PATTERNS: dict[str, tuple[str, ...]] = {
    "permission_auth": (
        r"permission denied|403|unauthorized|forbidden",
        r"auth|credential|token",
    ),
    "quota_rate_limit": (r"quota|rate limit|429|too many requests",),
    "not_found": (r"not found|404|no such file",),
    "timeout": (r"timeout|timed out|deadline exceeded",),
    "oom_memory": (r"out of memory|oom|memoryerror|killed process",),
    "network_connection": (r"connection reset|connection refused|broken pipe|dns",),
    "other": (r"error|exception|traceback",),
}

# Line keywords.
KEYWORD_PATTERNS: dict[str, tuple[str, ...]] = {
    "retrying": (r"retrying",),
    "killed": (r"killed",),
    "sigterm": (r"sigterm",),
    "broken_dag": (r"broken dag",),
    "import_error": (r"importerror|import error",),
}

# Stack-trace mark (case-sensitive).
STACKTRACE_PATTERN = r"Traceback \(most recent cal"

# Root-cause categories, the first hit wins.
ERROR_CATEGORIES: tuple[tuple[str, str], ...] = (
    ("ImportError", r"importerror|modulenot|no module named|broken dag"),
    ("PermissionDenied", r"permission denied|403|401|unauthorized|forbidden|iam"),
    ("Timeout", r"timeout|timed out|deadline exceeded|operator timeout"),
    ("OOMMemory", r"out of memory|oom|memoryerror|killed|sigkill"),
    ("QuotaRateLimit", r"quota|rate.?limit|429|too many requests"),
    (
        "NetworkConnection",
        r"connection reset|connection refused|broken pipe|dns|socket",
    ),
    ("NotFound", r"not found|404|no such file|table.*not exist"),
    ("BigQueryError", r"bigquery|bq\s|job.*failed|query.*error"),
    ("CodeError", r"keyerror|attributeerror|typeerror|valueerror|assertionerror"),
    ("TaskFailed", r"task.*failed|upstream.*failed|marked.*failed"),
)

# Severities from worst to mildest.
SEVERITY_RANK = {"CRITICAL": 4, "ERROR": 3, "WARNING": 2, "INFO": 1}

# Start of a line that names an exception.
EXCEPTION_LINE = r"(?U)^[A-Za-z][\w.]*(?:Error|Exception|Warning)"

LINE_BREAKS = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\u0085\u2028\u2029]"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_lines(text: Column | str) -> Column:
    """Lines at every Unicode line break; a break at the end opens no new line."""
    pieces = F.array(F.split(_col(text), LINE_BREAKS))
    # The empty piece after a final break, or of an empty text, is no line.
    trimmed = F.transform(
        pieces,
        lambda ls: F.when(
            F.element_at(ls, -1) == "", F.slice(ls, F.lit(1), F.size(ls) - 1)
        ).otherwise(ls),
    )
    return F.get(trimmed, F.lit(0))


def log_text(full_block: Column | str, message: Column | str) -> Column:
    """The full block unless blank, else the message, else empty."""
    block = _col(full_block)
    return F.coalesce(F.when(~is_blank(block), block), _col(message), F.lit(""))


def is_blank(c: Column | str) -> Column:
    return F.coalesce(~_col(c).rlike(r"(?U)\S"), F.lit(True))


# Characters whose case folding plain lower-casing misses.
_FOLD_FROM, _FOLD_TO = "\u017f\u0131\u0130\u212a", "siik"


def folded(c: Column | str) -> Column:
    """Lower-case form in which a literal occurs iff it occurs case-blind in the text."""
    t = _col(c)
    special = reduce(lambda a, b: a | b, [F.contains(t, F.lit(ch)) for ch in _FOLD_FROM])
    return F.lower(F.when(special, F.translate(t, _FOLD_FROM, _FOLD_TO)).otherwise(t))


_LITERAL = re.compile(r"[a-z0-9 _:'\"/@%=,;<>~`!#&-]+")
_JOINTS = re.compile(r"\.\*|\.\+|\.\?|\\s")


def _alternative(alt: str, text: Column, low: Column) -> Column:
    """Case-blind search of one alternative, by plain substring search where possible.

    Literal pieces around wildcards must all occur, so they are looked for first.
    """
    if _LITERAL.fullmatch(alt):
        return F.contains(low, F.lit(alt))
    found = text.rlike(f"(?iu){alt}")
    if _is_plain(alt):
        pieces = [F.contains(low, F.lit(p)) for p in _JOINTS.split(alt) if p]
        return reduce(lambda a, b: a & b, pieces) & found
    return found


def _alternatives(patterns: Sequence[str]) -> list[str]:
    """Patterns cut at their bars; one with groups, classes or an escaped bar stays whole."""
    out: list[str] = []
    for p in patterns:
        whole = "(" in p or "[" in p or "\\|" in p
        out += [p] if whole else p.split("|")
    return out


def _is_plain(alt: str) -> bool:
    pieces = [p for p in _JOINTS.split(alt) if p]
    return bool(pieces) and all(_LITERAL.fullmatch(p) for p in pieces)


def matches_any(patterns: Sequence[str], text: Column, low: Column) -> Column:
    """Does any pattern occur, ignoring case? ``low`` is the folded ``text``."""
    return reduce(
        lambda a, b: a | b, [_alternative(x, text, low) for x in _alternatives(patterns)]
    )


def count_matching_lines(
    lines: Column | str,
    patterns: Sequence[str],
    text: Column | str | None = None,
    low: Column | str | None = None,
) -> Column:
    """Lines that hit any pattern, each counted once.

    Given the whole ``text`` (and its folded form ``low``), its lines are only looked at when the text has a hit;
    patterns with anchors or groups, which may read differently there, always look.
    """
    hit = F.size(F.filter(_col(lines), lambda line: matches_any(patterns, line, folded(line))))
    if text is None or not all(_is_plain(x) for x in _alternatives(patterns)):
        return hit
    t = _col(text)
    whole = folded(t) if low is None else _col(low)
    return F.when(t.isNotNull() & ~matches_any(patterns, t, whole), 0).otherwise(hit)


def line_count_columns(
    lines: Column | str,
    patterns: Mapping[str, Sequence[str]],
    prefix: str,
    text: Column | str | None = None,
    low: Column | str | None = None,
) -> dict[str, Column]:
    return {
        f"{prefix}{name}": count_matching_lines(lines, pats, text, low)
        for name, pats in patterns.items()
    }


def has_stacktrace(text: Column | str, pattern: str = STACKTRACE_PATTERN) -> Column:
    return F.coalesce(_col(text).rlike(pattern), F.lit(False)).cast("int")


def tail_text(lines: Column | str, n: int = 20) -> Column:
    """The last ``n`` lines."""
    ls = _col(lines)
    return F.array_join(
        F.slice(ls, F.greatest(F.size(ls) - F.lit(n) + 1, F.lit(1)), F.lit(n)), "\n"
    )


def classify_error(
    text: Column | str,
    categories: Sequence[tuple[str, str]] = ERROR_CATEGORIES,
    default: str = "Other",
) -> Column:
    """The first category whose pattern occurs in the whole text."""
    t = F.coalesce(_col(text), F.lit(""))

    def first(pair: Column) -> Column:
        out = None
        for name, pattern in categories:
            hit = matches_any([pattern], pair["t"], pair["low"])
            out = F.when(hit, name) if out is None else out.when(hit, name)
        return F.lit(default) if out is None else out.otherwise(default)

    # Folded once per text, however many categories look at it.
    pair = F.array(F.struct(t.alias("t"), folded(t).alias("low")))
    return F.get(F.transform(pair, first), F.lit(0))


def stack_hint(text: Column | str, max_len: int = 200) -> Column:
    """Last line that starts like an exception, else the last non-blank line."""
    strip = r"(?U)^\s+|\s+$"
    lines = F.filter(
        F.transform(split_lines(text), lambda ln: F.regexp_replace(ln, strip, "")),
        lambda ln: ln != "",
    )
    named = F.filter(lines, lambda ln: ln.rlike(EXCEPTION_LINE))
    return F.coalesce(
        F.substring(
            F.coalesce(F.try_element_at(named, F.lit(-1)), F.try_element_at(lines, F.lit(-1))),
            1,
            max_len,
        ),
        F.lit(""),
    )


def severity_rank(severity: Column | str) -> Column:
    s = F.upper(_col(severity))
    out = None
    for name, rank in SEVERITY_RANK.items():
        out = F.when(s == name, rank) if out is None else out.when(s == name, rank)
    return out.otherwise(0)


def worst_severity(severity: Column | str) -> Column:
    """Aggregate: the worst known severity; INFO when none is known."""
    best = F.max(severity_rank(severity))
    out = F.lit("INFO")
    for name, rank in SEVERITY_RANK.items():
        out = F.when(best == rank, name).otherwise(out)
    return out
