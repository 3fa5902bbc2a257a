"""Duration texts such as 10, 10s, 500ms or 2m."""

from pyspark.sql import functions as F

from .text import BLANK

_CLASS = "[" + "".join(f"\\x{{{ord(ch):x}}}" for ch in BLANK) + "]*"
_SHAPE = rf"(?i)^{_CLASS}([0-9]+(?:\.[0-9]+)?){_CLASS}(ms|s|m)?{_CLASS}\z"


def duration_seconds(c):
    """Seconds as a double; NULL where the text is no positive duration."""
    number = F.regexp_extract(c, _SHAPE, 1).try_cast("double")
    unit = F.lower(F.regexp_extract(c, _SHAPE, 2))
    seconds = (
        F.when(unit == "ms", number / 1000.0)
        .when(unit == "m", number * 60.0)
        .otherwise(number)
    )
    return F.when(number > 0, seconds)
