"""Reading timestamps that arrive as text in several layouts."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from plantmetrics.config import TIMESTAMP_FORMATS


_PART = re.compile(r"'[^']*'|([A-Za-z])\1*|[^A-Za-z']")
_DATE_PARTS = ("yyyy", "MM", "dd")
_TIME_PARTS = ("HH", "mm", "ss")
#: What may follow the seconds: a fraction and a zone.
_SUFFIX = r"(\.\d+)?(Z|[+-]\d\d:?\d\d)?"


def _positions(layout: str) -> tuple[str, str, dict[str, int]]:
    """LIKE mask of a fixed-width layout (a pattern letter is one character), the same as a regular expression of
    digits, and where each part starts.
    """
    mask, digits, starts = "", "", {}
    for part in (match.group() for match in _PART.finditer(layout)):
        if part.isalpha():
            starts[part] = len(mask) + 1
            mask += "_" * len(part)
            digits += rf"\d{{{len(part)}}}"
        else:
            mask += part.strip("'")
            digits += re.escape(part.strip("'"))
    return mask, digits, starts


def _fixed(starts: Mapping[str, int]) -> bool:
    """Whether the layout is made of numbers at fixed places, which are cut out and cast."""
    return set(_DATE_PARTS) <= set(starts) <= {*_DATE_PARTS, *_TIME_PARTS, "SSSSSS"}


def _read(value: Column, layout: str) -> Column:
    """Timestamp, to the second, of a text that begins with ``layout``; NULL if it is no valid one."""
    mask, _, starts = _positions(layout)
    if not _fixed(starts):
        return F.date_trunc("second", F.try_to_timestamp(F.substring(value, 1, len(mask)), F.lit(layout)))
    date = [F.substring(value, starts[part], len(part)) for part in _DATE_PARTS]
    time = [F.substring(value, starts[part], 2) if part in starts else F.lit("00") for part in _TIME_PARTS]
    return F.concat(F.concat_ws("-", *date), F.lit(" "), F.concat_ws(":", *time)).try_cast("timestamp")


def _iso_text(value: Column, layout: str) -> tuple[str, Column]:
    """(pattern of a whole text in a fixed layout, such a text in ISO order).

    What follows the seconds, a fraction and a zone, stays as it is.
    """
    mask, digits, starts = _positions(layout)
    pattern = rf"^{digits}{_SUFFIX if layout.endswith('ss') else ''}\z"
    if mask in ("____-__-__T__:__:__", "____-__-__ __:__:__"):
        return pattern, value
    date = [F.substring(value, starts[part], len(part)) for part in _DATE_PARTS]
    time = [F.substring(value, starts[part], 2) if part in starts else F.lit("00") for part in _TIME_PARTS]
    rest = [F.substr(value, F.lit(len(mask) + 1))] if layout.endswith("ss") else []
    joined = [date[0], F.lit("-"), date[1], F.lit("-"), date[2], F.lit(" ")]
    return pattern, F.concat(*joined, time[0], F.lit(":"), time[1], F.lit(":"), time[2], *rest)


def _read_whole(value: Column, layouts: Sequence[str]) -> Column:
    """Timestamp, to the second, of a text that one of the fixed layouts fits whole: one pattern per layout tells
    which, and one cast reads it.
    """
    text = F.lit(None).cast("string")
    for layout in reversed(layouts):
        pattern, iso = _iso_text(value, layout)
        text = F.when(value.rlike(pattern), iso).otherwise(text)
    return F.date_trunc("second", text.try_cast("timestamp"))


def parse_timestamp(
    text: Column | str, formats: Sequence[str] = TIMESTAMP_FORMATS, prefix: bool = False
) -> Column:
    """Timestamp, to the second, from the first layout that the whole text fits; NULL when none does.

    A layout that ends in seconds also takes a fraction of any length, which is cut off, and a zone
    (``Z``, ``+02:00``, ``+0200``), which is heeded; without one the session's zone holds.

    With ``prefix`` (the legacy reading) a layout fits any longer text that begins with it: fractions and
    zones are ignored, and a short layout hides a longer one listed after it.

    Masks and casts rather than pattern parsing: a failed parse throws inside the task, once per
    layout and row of a mixed feed, and a cast to timestamp is several times faster than a
    successful one.
    """
    value = (F.col(text) if isinstance(text, str) else text).cast("string")
    if prefix:
        return F.coalesce(*(F.when(value.like(_positions(x)[0] + "%"), _read(value, x)) for x in formats))
    # a layout with a fraction is the one without, which takes any fraction
    left = list(dict.fromkeys(x.removesuffix(".SSSSSS") for x in formats))
    tries = []
    while left:
        mask, _, starts = _positions(left[0])
        if not _fixed(starts):
            tries.append(F.when(value.like(mask), _read(value, left.pop(0))))
            continue
        # layouts of different shapes are told apart by their patterns; of one shape the later is tried if the earlier fails
        together: dict[str, str] = {}
        while left and _fixed(_positions(left[0])[2]) and _positions(left[0])[1] not in together:
            layout = left.pop(0)
            together[_positions(layout)[1]] = layout
        tries.append(_read_whole(value, list(together.values())))
    return F.coalesce(*tries)


def date_label(day: Column | str) -> Column:
    """Axis label of a day, ``yyyy-MM-dd``."""
    return F.date_format(day, "yyyy-MM-dd")


def label_date(label: Column | str) -> Column:
    return F.to_date(label, "yyyy-MM-dd")
