"""Addresses against networks: any-match and longest match.

An address lies in a network when their prefixes of the network's length are
equal, so containment is an equi-join on (version, prefix_len, prefix). A
distinct address is probed only for the lengths that its own head (its first
HEAD bits) has networks of, and for the lengths below HEAD that its version has:
one row for each, none where no network can be near. The heads are at most
2 * 2**HEAD rows of at most 128 lengths, whatever the data, so they are always
broadcast. AQE broadcasts the networks too when their measured size allows.

For the other case, a prefix that many addresses share would be a hot join
key, so such prefixes are counted and salted, as in ``skew.lookup_join``: their
networks are repeated, and their addresses are spread over the copies. A network
that is not hot stands there once, so the copies are about as many as the networks.
Not counted are IPv4 prefixes longer than HEAD: they have at most 2**(31 - HEAD)
distinct addresses.

Networks are read several times (heads, counts and join), and so are the addresses and
the rows that are labelled; the counts are taken at once. Pass stored tables.
"""

from pyspark.sql import functions as F

from ..functions.netaddr import (
    IPV4, PREFIX_HIGH, PREFIX_LOW, host_key, with_address, with_network,
)
from ..schemas import check_method
from .skew import GROUPS, hot_keys, lookup_join, parts, repeated, with_groups, with_salt

HEAD = 16
KEY = ["version", "prefix_len", "p_hi", "p_lo"]


def parse_networks(lines):
    """Networks of a list's lines (column ``line``), stripped of blanks."""
    return with_network(lines, "line").where(F.col("prefix_len").isNotNull())


def rejected_networks(lines):
    return with_network(lines, "line").where(F.col("prefix_len").isNull())


def _heads(networks):
    """(version, head, lengths) of the networks of HEAD bits and more."""
    head = F.expr(f"CAST(shiftrightunsigned(p_hi, least(prefix_len, 64) - {HEAD}) AS INT)")
    return networks.where(F.col("prefix_len") >= HEAD).groupBy(
        "version", head.alias("head")).agg(F.collect_set("prefix_len").alias("lengths"))


def _with_prefixes(addresses, networks):
    """Addresses (version, hi, lo, ...) once per prefix length that may match.

    An address without one (unreadable, or no networks around) can match
    nothing; it keeps one row, without prefix_len.
    """
    short_if = lambda version: F.collect_set(
        F.when((F.col("version") == version) & (F.col("prefix_len") < HEAD), F.col("prefix_len")))
    short = networks.agg(short_if(4), short_if(6)).first()
    array = lambda lengths: F.array(*map(F.lit, sorted(lengths))).cast("array<int>")
    below = F.when(F.col("version") == 4, array(short[0])).when(F.col("version") == 6, array(short[1]))
    none = array([])
    lengths = F.concat(F.coalesce(below, none), F.coalesce("lengths", none))
    headed = addresses.withColumn("head", F.expr(f"CAST(shiftrightunsigned(hi, {64 - HEAD}) AS INT)"))
    return (
        headed.join(F.broadcast(_heads(networks)), ["version", "head"], "left")
        .withColumn("prefix_len", F.explode_outer(lengths)).drop("head", "lengths")
        .withColumns({"p_hi": F.expr(PREFIX_HIGH.format("hi")), "p_lo": F.expr(PREFIX_LOW.format("lo"))})
    )


def _hot(probed, tasks):
    """(*KEY, groups) of the prefixes that hold more than one of `tasks` equal shares of the rows that could be many."""
    return hot_keys(probed.where((F.col("prefix_len") <= HEAD) | (F.col("version") == 6)).select(*KEY), KEY, tasks)


def _salted(addresses, networks):
    """Addresses with their prefixes, and networks (one row per KEY), both with a salt."""
    tasks = GROUPS * parts(addresses)
    probed = _with_prefixes(addresses, networks)
    hot = _hot(probed, tasks)
    # Rows without a prefix are spread as well.
    salted = with_salt(with_groups(probed, hot, KEY), "address", tasks, F.col("prefix_len").isNull())
    return salted, repeated(with_groups(networks, hot, KEY))


def _probe(addresses, networks, how):
    """Join the addresses with the networks around them."""
    salted, copies = _salted(addresses, networks)
    return salted.join(copies, [*KEY, "salt"], how)


def address_flags(addresses, networks):
    """Distinct addresses that lie in any network or are unreadable, and which it is.

    The others have no row, so only these are shuffled after the join.
    """
    parsed = with_address(addresses.select("address").distinct(), "address")
    nets = networks.select(*KEY).distinct().withColumn("hit", F.lit(True))
    return (
        _probe(parsed, nets, "left")
        .where(F.col("hit").isNotNull() | F.col("version").isNull())
        .groupBy("address")
        .agg(F.coalesce(F.bool_or("hit"), F.lit(False)).alias("matched"),
             (F.count("version") == 0).alias("unreadable"))
    )


def contained(addresses, networks):
    """The distinct addresses (column ``address``) that lie in any network."""
    return address_flags(addresses, networks).where("matched").select("address")


def host_flags(host_addresses, networks, flags=None):
    """Per host: does any address lie in a network, and is any unreadable.

    ``flags`` are the ``address_flags`` of the same tables, if they are stored already.
    """
    flags = address_flags(host_addresses, networks) if flags is None else flags
    said = lambda name: F.bool_or(F.coalesce(name, F.lit(False))).alias(name)
    return (
        lookup_join(host_addresses, flags, "address", "host")
        .groupBy("host").agg(said("matched"), said("unreadable"))
    )


def host_verdicts(host_addresses, networks, method="exclude", flags=None):
    """(host, passed) for each host that has an address.

    Only a pass counts: a host without an address or with an unreadable one,
    or checked against no networks at all, fails in both modes. ``flags`` as in ``host_flags``.
    """
    check_method(method)
    flags = host_flags(host_addresses, networks, flags)
    if method == "include":
        passed = F.col("matched")
    else:
        any_network = networks.agg(F.count("*") > 0).scalar()
        passed = ~F.col("matched") & ~F.col("unreadable") & any_network
    return flags.select("host", passed.alias("passed"))


def resolve_hosts(hosts, resolutions):
    """(host, address) of the distinct host keys; literal addresses are their own.

    A name holds no colon, so a host with one is left to the address parser.
    """
    literal = F.col("host").rlike(IPV4) | F.col("host").contains(":")
    keys = hosts.select(host_key(F.col("host")).alias("host")).distinct()
    answers = resolutions.select(host_key(F.col("host")).alias("host"), "address")
    # Only answers for wanted hosts are made distinct. A host with very many answers is the big
    # side of a plain join of two shuffled sides, which AQE may split.
    named = answers.join(keys.where(~literal), "host", "left_semi").distinct()
    own = keys.where(literal).select("host", F.col("host").alias("address"))
    return named.unionByName(own)


def resolve_hosts_as_of(hosts, lookups, now, ttl):
    """(host, address) like ``resolve_hosts``, by the lookups that are known and still valid at ``now``.

    ``lookups`` has one row (host, address, resolved_at, ok) for each address that a
    lookup found; ``resolved_at`` is the same in all of them. Of each host the newest
    lookup counts that found an address, is not later than ``now`` and younger than
    ``ttl`` seconds: a failed one (``ok`` not true, or without an address) replaces
    nothing. A host without such a lookup has no row. With a ttl of 0 or
    less nothing is kept. Read from a stored table: it is scanned four times.
    """
    age = F.lit(now) - F.col("resolved_at")
    valid = lookups.where(F.col("ok") & F.col("address").isNotNull() & (age >= 0) & (age < max(0, ttl)))
    # Each address once before anything is joined, however often it was looked up.
    answers = valid.groupBy(host_key(F.col("host")).alias("host"), "address").agg(
        F.max("resolved_at").alias("resolved_at"))
    newest = answers.groupBy("host").agg(F.max("resolved_at").alias("newest"))
    current = lookup_join(answers, newest, "host", "address").where("resolved_at = newest")
    return resolve_hosts(hosts, current.select("host", "address"))


def geo_networks(table):
    """Geo networks with labels, one row per KEY (the least label if repeated)."""
    country = F.coalesce(F.nullif("iso_code", F.lit("")), "country_name")
    labels = F.struct(country.alias("country"), F.col("city").alias("city"))
    return (
        with_network(table, "network").where(F.col("prefix_len").isNotNull())
        .groupBy(*KEY).agg(F.min(labels).alias("labels"))
    )


def geo_labels(addresses, networks):
    """(address, country, city) by the longest network around each distinct address."""
    parsed = with_address(addresses.select("address").distinct(), "address")
    return (
        _probe(parsed, networks, "inner").groupBy("address").agg(F.max_by("labels", "prefix_len").alias("labels"))
        .select("address", "labels.country", "labels.city")
    )


def with_geo(rows, networks, key, column="exit_ip"):
    """Add country and city by the address in ``column``; NULL where unknown.

    ``key`` is unique; rows that share an address are spread by it.
    """
    known = rows.select(F.col(column).alias("address")).where(F.col("address").isNotNull())
    labels = geo_labels(known, networks).withColumnRenamed("address", column)
    return lookup_join(rows, labels, column, key)
