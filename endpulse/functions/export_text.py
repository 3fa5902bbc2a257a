"""Column expressions for the annotated text export."""

import string

from pyspark.sql import functions as F

from .text import normalize_link


def base64_text(c):
    """Base64 on one line (the built-in breaks lines at 76 characters)."""
    return F.regexp_replace(F.base64(F.encode(c, "UTF-8")), "[\r\n]", "")


def percent_encode(c):
    """Percent-encoding that keeps letters, digits and _ . - ~ /"""
    out = F.url_encode(c)
    for old, new in (("+", "%20"), ("*", "%2A"), ("%7E", "~"), ("%2F", "/")):
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def whole_number(x):
    """A double without decimals, ties to even."""
    return F.when(x.isNotNull(), F.format_string("%.0f", F.rint(x)))


def two_decimals(x):
    """A double with two decimals, rounded on its exact binary value.

    x * 100 is taken as a sum of two doubles, p + e, without any error: x is
    split into two halves short enough for exact products. So a tie is seen
    only where there is one, and goes to the even neighbour.
    """
    mag = F.abs(x)
    spread = mag * 134217729.0
    top = spread - (spread - mag)
    p = mag * 100.0
    e = (top * 100.0 - p) + (mag - top) * 100.0
    base = F.floor(p)
    rest = p - base.cast("double")
    up = (rest > 0.5) | ((rest == 0.5) & ((e > 0) | ((e == 0) & (base % 2 == 1))))
    cents = base + F.when(up, 1).otherwise(0)
    text = F.concat(
        F.when(x < 0, "-").otherwise(""),
        ((cents - cents % 100) / 100).cast("bigint").cast("string"), F.lit("."),
        F.lpad((cents % 100).cast("string"), 2, "0"),
    )
    # Above this size a double has no decimals left to round.
    return F.when(mag < 1e13, text).when(mag >= 1e13, F.format_string("%.2f", x))


_CAPITALS = string.ascii_uppercase
_FLAG_LETTERS = "".join(chr(0x1F1E6 + i) for i in range(26))


def flag(country):
    """Flag of a two-letter country code; empty for any other text."""
    code = F.upper(country)
    return F.when(code.rlike(r"^[A-Z]{2}\z"), F.translate(code, _CAPITALS, _FLAG_LETTERS)
                  ).otherwise("")


def comment(exit_ip, city, country, latency_ms, mbps):
    """Percent-encoded remark on one endpoint, empty when nothing is known."""
    filled = lambda c: F.nullif(c, F.lit(""))
    geo = F.nullif(F.concat_ws(",", filled(city), filled(country)), F.lit(""))
    parts = F.concat_ws(
        " | ",
        F.concat(F.lit("IP="), filled(exit_ip)),
        F.concat(F.lit("Geo="), geo, F.lit(" "), F.coalesce(flag(country), F.lit(""))),
        F.concat(F.lit("URL="), whole_number(latency_ms), F.lit("ms")),
        F.concat(F.lit("Speed="), two_decimals(mbps), F.lit("MB/s")),
    )
    return percent_encode(parts)


def annotated_link(raw_link, remark):
    clean = normalize_link(raw_link)
    return F.when(remark == "", clean).otherwise(F.concat(clean, F.lit("#"), remark))


def clock(seconds):
    """Seconds as HH:MM:SS."""
    whole = F.floor(seconds).cast("bigint")
    pair = lambda v: F.format_string("%02d", v)
    return F.concat_ws(":", pair(F.floor(whole / 3600)),
                       pair(F.floor(whole % 3600 / 60)), pair(whole % 60))


def _utc(epoch):
    """Date and time of day in UTC by arithmetic, whatever the session's time zone."""
    whole = F.floor(epoch).cast("bigint")
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(whole / 86400).cast("int")), clock(
        F.pmod(whole, F.lit(86400)))


def iso_utc(epoch):
    day, time = _utc(epoch)
    return F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T"), time, F.lit("+00:00"))


def spoken_time(epoch):
    day, time = _utc(epoch)
    return F.concat(time, F.lit(" "), F.date_format(day, "dd.MM.yyyy"))
