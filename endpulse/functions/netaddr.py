"""IP addresses and networks as columns.

An address is (version, hi, lo): 128 bits in two longs. An IPv4 address sits
in the top 32 bits of ``hi``, so one formula gives the prefix of either kind.
Everything here stays in the JVM.
"""

from pyspark.sql import functions as F

from .staged import cases, in_steps
from .text import strip

_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IPV4 = rf"^{_OCTET}(?:\.{_OCTET}){{3}}\z"
_HEXTET = "[0-9A-Fa-f]{1,4}"
_HEXTETS = rf"^{_HEXTET}(?::{_HEXTET})*\z"
_SCOPED = r"^[^%/]*(?:%[^%/]+)?\z"


def host_key(c):
    return F.lower(F.rtrim(strip(c), F.lit(".")))


def _octets(text):
    return cases((f"{text} RLIKE r'{IPV4}'", rf"split({text}, r'\.')"))


def _number(octets):
    """Octets as one number, e.g. 1.2.3.4 is 0x01020304."""
    return "(" + " + ".join(
        f"try_cast(get({octets}, {i}) AS BIGINT) * {256 ** (3 - i)}" for i in range(4)) + ")"


_TAIL = "substring_index(_bare, ':', -1)"
# IPv6 groups where an IPv4 tail stands for the last two; a one-element
# transform binds the split octets to a name.
_GROUPS = cases(
    ("NOT contains(_bare, '.')", "_bare"),
    otherwise=f"""concat(
      substr(_bare, 1, length(_bare) - length({_TAIL})),
      regexp_replace(lpad(hex(get(transform(array({_octets(_TAIL)}), o -> {_number('o')}), 0)), 8, '0'),
                     '^(....)', '$1:'))""")


def _side(part):
    """One side of '::' as hex digits, NULL where it is malformed."""
    wide = f"array_join(transform(split({part}, ':'), g -> lpad(g, 4, '0')), '')"
    return cases((f"{part} = ''", "''"), (f"{part} RLIKE r'{_HEXTETS}'", wide))


_GAP = "instr(_groups, '::')"
_KNOWN = "(length(_left) + length(_right))"
_HALF = "try_cast(conv(substring(_hex, {}, 16), 16, -10) AS BIGINT)"


def with_address(df, column, version="version", hi="hi", lo="lo"):
    """Add an address text's version, hi and lo; NULL where it is none.

    Leading zeros in IPv4 are refused; IPv6 may be shortened, end in IPv4 and
    carry a %scope, which is ignored.
    """
    text = f"`{column}`"
    return in_steps(
        df,
        {"_octets": _octets(text),
         "_bare": cases((f"contains({text}, ':') AND {text} RLIKE r'{_SCOPED}'",
                         f"substring_index({text}, '%', 1)"))},
        {"_v4": _number("_octets"), "_groups": _GROUPS},
        {"_short": f"{_GAP} > 0",
         "_left_text": cases((f"{_GAP} > 0", f"substr(_groups, 1, {_GAP} - 1)"), otherwise="_groups"),
         "_right_text": cases((f"{_GAP} > 0", f"substr(_groups, {_GAP} + 2)"), otherwise="''")},
        {"_left": _side("_left_text"), "_right": _side("_right_text")},
        # '::' stands for one zero group at least; without it all eight are there.
        {"_hex": cases((f"(_short AND {_KNOWN} <= 28) OR (NOT _short AND {_KNOWN} = 32)",
                        f"concat(_left, repeat('0', 32 - {_KNOWN}), _right)"))},
        {version: cases(("_v4 IS NOT NULL", "4"), ("_hex IS NOT NULL", "6")),
         hi: cases(("_v4 IS NOT NULL", "shiftleft(_v4, 32)"), otherwise=_HALF.format(1)),
         lo: cases(("_v4 IS NOT NULL", "0L"), otherwise=_HALF.format(17))},
    )


# The first prefix_len of 128 bits, as two numbers.
PREFIX_HIGH = cases(
    ("prefix_len = 0", "0L"), ("prefix_len < 64", "shiftrightunsigned({0}, 64 - prefix_len)"),
    otherwise="{0}")
PREFIX_LOW = cases(
    ("prefix_len <= 64", "0L"), ("prefix_len < 128", "shiftrightunsigned({0}, 128 - prefix_len)"),
    otherwise="{0}")


def with_network(df, column):
    """Add version, prefix_len, p_hi, p_lo of a network text, else NULLs.

    Host bits are masked off and a bare address is a network of one. IPv4
    masks may be a length, a netmask or a hostmask.
    """
    # Netmask and hostmask are runs of ones, so adding one leaves no common bit.
    zeros = "(4294967295 - _dotted)"
    length = cases(
        ("_n = 1", "_width"),
        (r"_mask RLIKE r'^[0-9]+\z'", "try_cast(_mask AS INT)"),
        (f"({zeros} & ({zeros} + 1)) = 0", f"32 - bit_count({zeros})"),
        ("(_dotted & (_dotted + 1)) = 0", "32 - bit_count(_dotted)"))
    parts = in_steps(df, {"parts__": f"split(`{column}`, '/')"}, {"address__": "get(parts__, 0)"})
    parsed = with_address(parts, "address__", "ip__", "hi__", "lo__")
    known = in_steps(
        parsed,
        {"_mask": "get(parts__, 1)", "_n": "size(parts__)",
         "_width": "CASE ip__ WHEN 4 THEN 32 WHEN 6 THEN 128 END"},
        {"_mask_octets": cases(("ip__ = 4", _octets("_mask")))},
        {"_dotted": _number("_mask_octets")},
        {"_length": f"CAST({length} AS INT)"},
        {"prefix_len": cases(("_n BETWEEN 1 AND 2 AND _length BETWEEN 0 AND _width", "_length"))},
        {"version": cases(("prefix_len IS NOT NULL", "ip__")),
         "p_hi": cases(("prefix_len IS NOT NULL", PREFIX_HIGH.format("hi__"))),
         "p_lo": cases(("prefix_len IS NOT NULL", PREFIX_LOW.format("lo__")))},
    )
    return known.drop("parts__", "address__", "ip__", "hi__", "lo__")
