import base64
import hashlib
import ipaddress
import json
import random
import urllib.parse

import pytest
from pyspark.sql import functions as F

from endpulse.functions import durations, export_text, netaddr, outbound, text


def column(spark, values, expr, kind="string"):
    """expr(c) for each value, in the order of the values."""
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, c {kind}")
    out = rows.select("i", expr(F.col("c")).alias("out")).orderBy("i").collect()
    return [r.out for r in out]


def frame(spark, values, add, out="out"):
    """The column ``out`` that add(df) adds, in the order of the values."""
    rows = spark.createDataFrame(list(enumerate(values)), "i int, c string")
    found = add(rows)
    cols = [out] if isinstance(out, str) else out
    return [r.v if len(cols) > 1 else r.v[0] for r in
            found.select("i", F.struct(*cols).alias("v")).orderBy("i").collect()]


def test_normalize_link(spark):
    cases = ["  ss://a#b#c ", "#only://x", "\u2003vless://h \x1c#t", "\u00a0", "x://y\x85"]
    want = [c.strip().split("#", 1)[0].strip() for c in cases]
    assert column(spark, cases, text.normalize_link) == want


def test_link_hash(spark):
    assert column(spark, ["vless://é"], text.link_hash) == [
        hashlib.sha256("vless://é".encode()).hexdigest()]


def test_split_lines_knows_every_separator(spark):
    body = "a://1\r\nb://2\x1cc://3\x85d://4\u2028e://5\x0bf://6\rg://7"
    assert column(spark, [body], text.split_lines) == [body.splitlines()]


def test_decode_utf8_drops_bad_bytes(spark):
    rng = random.Random(3)
    cases = [b"ok", b"a\xffb", b"\xe2\x82A", "é\ufffd".encode(), b"\xed\xa0\x80x"]
    cases += [bytes(rng.randrange(256) for _ in range(12)) for _ in range(300)]
    got = column(spark, [bytearray(c) for c in cases], text.decode_utf8, "binary")
    assert got == [c.decode("utf-8", errors="ignore") for c in cases]


# Worked out by hand: blanks go, missing padding is added, other characters are
# skipped, four characters give three bytes, and a padded group ends the text. What
# is left over at the end makes the whole text unreadable.
BASE64_CASES = [
    ("", None), ("  ", None), ("====", None), ("YQ", "a"), ("YQ==", "a"), ("Y W\nJj", "abc"), ("YQ==YWI=", "a"),
    ("Y=Q==", "a"), ("é", None), ("YWJj\nZGVm", "abcdef"), ("A", None), ("-_-_", None), ("YQ=x=", "a\x0c"),
    ("YWI%", None), ("w6k", "é"), ("4pyT", "✓"), ("/+8=", None), ("YWJjZ", None), ("gA", None), (None, None),
]


def test_base64_by_hand(spark):
    got = frame(spark, [c for c, _ in BASE64_CASES], lambda df: text.with_base64_text(df, "c", "out"))
    assert got == [want for _, want in BASE64_CASES]


def test_base64_round_trip(spark):
    """Texts come back from either alphabet, with blanks strewn in and without padding."""
    rng = random.Random(11)
    texts, cases = [], []
    while len(texts) < 1500:
        body = "".join(rng.choice("aZ09 ~/é✓\t") for _ in range(rng.randint(1, 40)))
        code = rng.choice((base64.b64encode, base64.urlsafe_b64encode))(body.encode()).decode()
        if "-" in code or "_" in code:  # read as the first alphabet, which skips them
            continue
        if rng.random() < 0.5:
            code = code.rstrip("=")
        for _ in range(rng.randint(0, 4)):
            at = rng.randint(0, len(code))
            code = code[:at] + rng.choice(" \n\t\x1c") + code[at:]
        texts.append(body)
        cases.append(code)
    assert frame(spark, cases, lambda df: text.with_base64_text(df, "c", "out")) == texts


@pytest.mark.parametrize("value, seconds", [
    ("10", 10.0), (" 10s ", 10.0), ("500ms", 0.5), ("2M", 120.0), ("1.5 s", 1.5), ("0s", None),
    ("-3s", None), ("soon", None), ("", None), ("1h", None), ("1\n", 1.0), (None, None)])
def test_duration_seconds(spark, value, seconds):
    assert column(spark, [value], durations.duration_seconds) == [seconds]


ADDRESSES = [
    "1.2.3.4", "010.1.1.1", "256.1.1.1", "1.2.3", "1.2.3.4.5", "", "::", "::1", "1::", "::ffff:1.2.3.4",
    "2001:db8::1", "2001:DB8:0:0:0:0:0:1", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8",
    "1:2:3:4:5:6:7:8::", "1::2::3", ":::", ":1:2:3:4:5:6:7", "1:2:3:4:5:6:7:", "12345::", "g::",
    "fe80::1%eth0", "fe80::1%", "fe80::1%a%b", "fe80::1%a/b", "1:2:3:4:5:6:1.2.3.4", "::1.2.3.04",
    "1.2.3.4:5", "1.2.3.4\n", " 1.2.3.4", "ffff:ffff:ffff:ffff:ffff:ffff:ffff:ffff", "8000::", "::8000:0:0:0",
    "1:2:3:4:5:6:7:1.2.3.4", "1:2:3:4:5:1.2.3.4", "::1.2.3.4:5", ":", "1.2.3.4::", "host.example",
]


def as_number(ip):
    if ip["version"] is None:
        return None
    hi, lo = ip["hi"] % 2**64, ip["lo"] % 2**64
    return (ip["version"], hi >> 32 if ip["version"] == 4 else (hi << 64) + lo)


def python_ip(value):
    try:
        ip = ipaddress.ip_address(value)
    except ValueError:
        return None
    return (ip.version, int(ip))


def test_parse_ip(spark):
    rng = random.Random(5)
    cases = list(ADDRESSES)
    for _ in range(400):
        cases.append(str(ipaddress.IPv6Address(rng.getrandbits(128) & rng.getrandbits(128) & rng.getrandbits(128))))
        cases.append(str(ipaddress.IPv4Address(rng.getrandbits(32))))
        cases.append("".join(rng.choice(":::1af.") for _ in range(rng.randrange(2, 14))))
    got = [as_number(v) for v in frame(
        spark, cases, lambda df: netaddr.with_address(df, "c"), ["version", "hi", "lo"])]
    want = [python_ip(c) for c in cases]
    assert [(c, g, w) for c, g, w in zip(cases, got, want) if g != w] == []


def test_parse_network(spark):
    rng = random.Random(6)
    cases = ["10.0.0.0/255.0.0.0", "10.0.0.0/0.0.0.255", "2001:db8::/32", "1.2.3.0/24 # x", "1.2.3.4",
             "1.2.3.4/0", "0.0.0.0/0.0.0.0", "1.2.3.4/255.255.255.255", "1.2.3.4/33", "1.2.3.4/",
             "1.2.3.4/08", "1.2.3.4/255.0.255.0", "::/0", "::1", "::1/129", "::1/128", "::1/255.0.0.0",
             "1.2.3.4/8/8", "/8", "", "1.1.2", "1.2.3.4/-1", "1.2.3.4/99999999999"]
    for _ in range(300):
        cases.append(f"{ipaddress.IPv4Address(rng.getrandbits(32))}/{rng.randrange(0, 34)}")
        cases.append(f"{ipaddress.IPv6Address(rng.getrandbits(128))}/{rng.randrange(0, 130)}")
    got = frame(spark, cases, lambda df: netaddr.with_network(df, "c"),
                ["version", "prefix_len", "p_hi", "p_lo"])
    for case, net in zip(cases, got):
        try:
            want = ipaddress.ip_network(case, strict=False)
        except ValueError:
            assert tuple(net) == (None,) * 4, case
            continue
        assert (net["version"], net["prefix_len"]) == (want.version, want.prefixlen), case
        base = int(want.network_address) << (96 if want.version == 4 else 0)
        hi, lo, size = base >> 64, base % 2**64, want.prefixlen
        assert net["p_hi"] % 2**64 == (hi >> (64 - size) if size < 64 else hi), case
        assert net["p_lo"] % 2**64 == (0 if size <= 64 else lo >> (128 - size)), case


def test_host_key(spark):
    assert column(spark, [" Host.Example.. ", "a"], netaddr.host_key) == ["host.example", "a"]


def doc(network="xhttp", **parts):
    return json.dumps({"protocol": "vless", "streamSettings": {"network": network, **parts}},
                      ensure_ascii=False)


@pytest.mark.parametrize("config, verdict", [
    (doc(), "safe"),
    (doc("tcp", xhttpSettings={"host": "a@b"}), "safe"),
    ('{"protocol":"vless"}', "safe"),
    (doc(xhttpSettings={"host": "a@b"}), "unsafe"),
    (doc(xhttpSettings={}, splithttpSettings={"path": "p" * 251}), "unsafe"),
    (doc(xhttpSettings={"path": "p" * 250}), "safe"),
    (doc(xhttpSettings={"mode": "x"}, splithttpSettings={"path": "p" * 251}), "safe"),
    (doc(tlsSettings={"serverName": ""}, realitySettings={"serverName": "é"}), "unsafe"),
    (doc(tlsSettings={"serverName": "t"}, realitySettings={"serverName": "é"}), "safe"),
    (doc(xhttpSettings={"host": None}), "broken"),
    (doc(tlsSettings={"serverName": None}), "safe"),
    (doc(realitySettings={"serverName": None}), "broken"),
    ('{"protocol":"vless", oops', "unreadable"),
    ('{"protocol":"vless","x":{"address": ', "unreadable"),
    ('[{"address":"x"}]', "unreadable"), ('["a"]', "unreadable"), ('"text"', "unreadable"), ("12", "unreadable"),
    ('{"protocol":"vless"} {"x":1}', "unreadable"), ("{'protocol':'vless'}", "unreadable"),
    ('"{\\"protocol\\":1}"', "unreadable"),
    ('{"streamSettings":"{\\"network\\":\\"xhttp\\",\\"xhttpSettings\\":{\\"host\\":\\"a@b\\"}}"}', "safe"),
    ('{"streamSettings":{"network":"tcp","network":"xhttp","xhttpSettings":{"host":"a@b"}}}', "unsafe"),
    ('{"streamSettings":[1]}', "safe"), ("", "missing"), ("null", "missing"), (None, "missing"),
])
def test_config_verdict(spark, config, verdict):
    assert frame(spark, [config], lambda df: outbound.with_verdict(df, "c"), "verdict") == [verdict]


@pytest.mark.parametrize("config, host", [
    (None, None), ("{}", None), ("null", None),
    ('{"settings":{"vnext":[{"address":"a"}]}}', "a"),
    ('{"settings":{"servers":[{"address":"b"}]}}', "b"),
    ('{"address":"top","settings":{"vnext":[{"address":"a"}]}}', "top"),
    ('{"settings":{"vnext":[{"address":"a"}]},"x":{"address":"last"}}', "last"),
    ('{"x":{"address":"first"},"settings":{"vnext":[{"address":"a"}]}}', "a"),
    ('{"settings":{"vnext":[{"address":""}]}}', None),
    ('{"settings":{"vnext":[[{"address":"deep"}]]}}', None),
    ('{"a":{"b":{"address":"nested"}}}', "nested"),
    ('{"settings":{"vnext":[{"address":"a"},{"address":"b"}]}}', "b"),
    ('{"settings":{"vnext":[{"port":1}]}}', None),
    ('{"x":{"\\u0061ddress":"escaped"}}', "escaped"),
    ('{"address":"one","address":"two"}', "two"),
    ('{"x":{"address":"old"},"y":{"address":"b"},"x":{"address":"new"}}', "b"),
    ('{"y":{"address":"b"},"x":{"address":"old"},"x":{"address":"new"}}', "new"),
    ('{"a":[{"b":{"address":"p"}},{"address":"q"},{"c":1}]}', "q"),
    ('{"a":{"b":{"c":{"address":"deep"}}},"z":{"address":null}}', None),
    ('{"a":{"address":"x"},"z":{"b":[{"c":{"d":[{"address":"far"}]}}]}}', "far"),
    ('{"a":{"address":"x","b":{"address":"inner"}}}', "x"),
    ('{"a":"{\\"address\\":\\"text\\"}"}', None), ('{"a": "[{\\"address\\":1}]" }', None),
    ('{"address":"{brace}"}', "{brace}"), ('{"a\'b":{"address":"quote"}}', "quote"),
    ('{"protocol":"vless","x":{"address": ', None), ('[{"address":"x"}]', None), ('["a"]', None),
    (' {"a" : { "address" : "spaces" } } ', "spaces"), ('{"a":{"address":12}}', "12"),
])
def test_outbound_host(spark, config, host):
    assert frame(spark, [config], lambda df: outbound.with_host(df, "c"), "host") == [host]


@pytest.mark.parametrize("config, scheme", [
    ('{"protocol":"vless"}', "vless"), ('{"protocol":"vless","protocol":"ss"}', "ss"), ('{"x":1}', None),
    ('{"protocol":"vless", oops', None), ('["protocol"]', None), (None, None), ('{"protocol":null}', None),
])
def test_scheme_is_read_by_the_same_reader(spark, config, scheme):
    for reader in (outbound.with_scheme, outbound.with_facts):
        assert frame(spark, [config], lambda df: reader(df, "c"), "scheme") == [scheme]


def test_configurations_are_read_in_the_jvm(spark):
    facts = outbound.with_facts(spark.createDataFrame([("{}",)], "c string"), "c")
    plan = facts._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_hosts_of_random_configurations(spark):
    """The last object in document order, read off the text's own nesting."""
    rng = random.Random(21)

    def make(depth):
        kind = rng.random()
        if depth == 0 or kind < 0.25:
            return rng.choice([1, None, True, "t", "", [1, "x"], []])
        if kind < 0.45:
            return [make(depth - 1) for _ in range(rng.randint(0, 3))]
        return {k: (f"h{rng.randint(0, 99)}" if k == "address" else make(depth - 1))
                for k in rng.sample(["a", "b", "c", "d", "address"], rng.randint(0, 4))}

    def places(value, place):
        """(place, host) of the objects that count."""
        if "address" in value:
            return [(place, value["address"])]
        return [hit for i, member in enumerate(value.values())
                for j, child in enumerate(member if isinstance(member, list) else [member])
                if isinstance(child, dict) for hit in places(child, (*place, i, j))]

    cases = [{"root": make(5), "more": make(4)} for _ in range(300)]
    want = [max(places(c, ()), default=(None, None))[1] for c in cases]
    assert frame(spark, [json.dumps(c) for c in cases], lambda df: outbound.with_host(df, "c"), "host") == want
    assert sum(w is not None for w in want) > 100


def test_percent_encode(spark):
    rng = random.Random(8)
    cases = ["".join(rng.choice("aZ09 +*~/_.-|,=%éß🇩🇪#&") for _ in range(12)) for _ in range(500)]
    assert column(spark, cases, export_text.percent_encode) == [urllib.parse.quote(c) for c in cases]


def test_rounded_numbers_match_exactly(spark):
    rng = random.Random(9)
    cases = [0.0, 1.015, 0.125, 0.375, 2.675, 0.005, 1e12 + 0.125, 3.5e13, 999.995, 0.5, 1.5, 2.5]
    cases += [rng.randrange(10**6) / 1000 for _ in range(2000)]
    cases += [rng.randrange(10**6) / 8 for _ in range(1000)]
    cases += [rng.random() * 10 ** rng.randrange(9) for _ in range(2000)]
    assert column(spark, cases, export_text.two_decimals, "double") == [f"{c:.2f}" for c in cases]
    assert column(spark, cases, export_text.whole_number, "double") == [f"{c:.0f}" for c in cases]


def test_comment_and_link(spark):
    rows = spark.createDataFrame(
        [("1.2.3.4", "Paris", "FR", 12.5, 3.005), (None, None, None, None, None),
         (None, "Town", None, None, None), (None, "", "Germany", 0.0, None)],
        "ip string, city string, country string, lat double, mbps double")
    remark = export_text.comment(*[F.col(c) for c in ("ip", "city", "country", "lat", "mbps")])
    got = [r[0] for r in rows.select(export_text.annotated_link(F.lit("ss://x #old"), remark)).collect()]
    quote = urllib.parse.quote
    assert got == [
        "ss://x#" + quote("IP=1.2.3.4 | Geo=Paris,FR 🇫🇷 | URL=12ms | Speed=3.00MB/s"),
        "ss://x", "ss://x#" + quote("Geo=Town "), "ss://x#" + quote("Geo=Germany  | URL=0ms")]


def test_base64_text_and_times(spark):
    long = "profile title " * 20
    assert column(spark, [long], export_text.base64_text) == [base64.b64encode(long.encode()).decode()]
    assert column(spark, [1700000000], export_text.iso_utc, "long") == ["2023-11-14T22:13:20+00:00"]
    assert column(spark, [1700000000], export_text.spoken_time, "long") == ["22:13:20 14.11.2023"]
    assert column(spark, [3725.9, 360000.0], export_text.clock, "double") == ["01:02:05", "100:00:00"]
