"""Column expressions for links and payload text."""

import string

from pyspark.sql import functions as F

from .staged import cases, in_steps

# The characters str.strip() and str.split() treat as blank.
BLANK = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The line ends that str.splitlines() knows.
LINE_END = "\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"

LINK_MARK = "://"


def strip(c):
    return F.btrim(c, F.lit(BLANK))


def normalize_link(c):
    """The link without its #label and surrounding blanks; may be empty."""
    return strip(F.substring_index(c, "#", 1))


def link_hash(c):
    return F.sha2(c, 256)


def split_lines(c):
    return F.split(c, LINE_END)


def is_link_line(c):
    return c.contains(LINK_MARK)


def decode_utf8(binary):
    """Bytes as text, without the bytes that are not UTF-8."""
    text = binary.cast("string")
    return F.when(F.is_valid_utf8(text), text).otherwise(
        F.replace(F.make_valid_utf8(text), F.lit("\ufffd"), F.lit("")))


def _class(characters):
    return "[" + "".join(f"\\x{{{ord(ch):x}}}" for ch in characters) + "]"


_BLANK_CLASS = _class(BLANK)
_ASCII_BLANK_CLASS = _class(ch for ch in BLANK if ch.isascii())




def is_ascii(text):
    """SQL text: as many characters as bytes."""
    return f"length({text}) = octet_length({text})"


# Written out one by one, the class is a table lookup in the regex engine,
# which is some twenty times faster than ranges.
_DATA = string.ascii_letters + string.digits + "+/="

# How many data characters of a base64 text count, NULL if it is bad. The text,
# data characters and '=' only, comes split at '='. Decoding ends at the first
# complete padding; without one, all data must be a whole number of quads. The
# fold carries counts only: data characters so far, '=' in a row, and the data
# characters before the end.
_DATA_LENGTH = """aggregate(
  slice({pieces}, 2, size({pieces})),
  named_struct('data', length(get({pieces}, 0)), 'pads', 0, 'cut', CAST(NULL AS INT)),
  (acc, piece) -> named_struct(
    'data', acc.data + length(piece),
    'pads', CASE WHEN length(piece) > 0 THEN 0 WHEN acc.data % 4 >= 2 THEN acc.pads + 1 ELSE acc.pads END,
    'cut', coalesce(acc.cut, CASE WHEN acc.data % 4 >= 2 AND acc.data % 4 + acc.pads + 1 >= 4 THEN acc.data END)),
  acc -> coalesce(acc.cut, CASE WHEN acc.data % 4 = 0 THEN acc.data END))"""

_BYTES = """try_to_binary(concat(
  substring(replace({kept}, '='), 1, {size}), repeat('=', (4 - {size} % 4) % 4)), 'base64')"""


def with_base64_text(df, column, out):
    """Add the decoded text of a base64 column; NULL when it is none or empty.

    Foreign characters are skipped and missing padding is added. The URL-safe
    alphabet is tried only where the standard one fails.
    """
    data_only = f"regexp_replace({{}}, '[^{_DATA}]+', '')".format
    done = in_steps(
        df,
        {"_compact": cases(
            (is_ascii(f"`{column}`"), f"regexp_replace(`{column}`, r'{_ASCII_BLANK_CLASS}+', '')"),
            otherwise=f"regexp_replace(`{column}`, r'{_BLANK_CLASS}+', '')")},
        {"_padded": cases((is_ascii("_compact"),
                           "concat(_compact, repeat('=', (4 - length(_compact) % 4) % 4))"))},
        {"_kept": data_only("_padded")},
        {"_pieces": "split(_kept, '=')"},
        {"_size": _DATA_LENGTH.format(pieces="_pieces")},
        {"_safe_kept": cases(("_size IS NULL", data_only("translate(_padded, '-_', '+/')")))},
        {"_safe_pieces": "split(_safe_kept, '=')"},
        {"_safe_size": _DATA_LENGTH.format(pieces="_safe_pieces")},
        {"decoded__": cases(("_size IS NOT NULL", _BYTES.format(kept="_kept", size="_size")),
                            otherwise=_BYTES.format(kept="_safe_kept", size="_safe_size"))},
    )
    text = F.nullif(decode_utf8(F.col("decoded__")), F.lit(""))
    return done.withColumn(out, text).drop("decoded__")
