"""IP text as native expressions: canonical form and numeric halves.

Everything is built-in functions, so addresses are normalised inside the scan stage:
no Python worker and no shuffle. IPv6 work sits behind a ``:`` test, so IPv4 rows skip it.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from logspark.functions.binding import let

# Address shapes.
OCTET = r"(25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
IPV4 = rf"^{OCTET}(\.{OCTET}){{3}}\z"
IPV6_CHARS = r"^[0-9A-Fa-f:.]+\z"
IPV6_GROUP = r"^[0-9A-Fa-f]{1,4}\z"
IPV4_TAIL = rf"^(.*:){OCTET}\.{OCTET}\.{OCTET}\.{OCTET}\z"


def _hex_tail(col: Column) -> Column:
    """Rewrite a dotted IPv4 tail as two hexadecimal groups."""
    octets = [F.regexp_extract(col, IPV4_TAIL, i).try_cast("int") for i in (2, 3, 4, 5)]
    words = [F.lower(F.hex(octets[i] * 256 + octets[i + 1])) for i in (0, 2)]
    dotted = F.concat(F.regexp_extract(col, IPV4_TAIL, 1), words[0], F.lit(":"), words[1])
    return F.when(col.rlike(IPV4_TAIL), dotted).otherwise(col)


def _split_groups(part: Column) -> Column:
    return F.when(F.coalesce(part, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.split(part, ":"))


def _filled(halves: Column) -> Column:
    """Eight groups: the gap left by ``::`` is filled with at least one zero."""

    def joined(head: Column, tail: Column) -> Column:
        missing = F.lit(8) - F.size(head) - F.size(tail)
        return (
            F.when(
                (F.size(halves) == 2) & (missing >= 1),
                F.concat(head, F.array_repeat(F.lit("0"), missing), tail),
            ).when((F.size(halves) == 1) & (missing == 0), head)
        )

    return let(
        _split_groups(F.get(halves, F.lit(0))),
        lambda head: let(_split_groups(F.get(halves, F.lit(1))), lambda tail: joined(head, tail)),
    )


def _as_groups(col: Column) -> Column:
    """Eight lower-case groups without leading zeros, or null."""

    def cleaned(full: Column) -> Column:
        valid = F.forall(full, lambda g: g.rlike(IPV6_GROUP))
        return F.when(valid, F.transform(full, lambda g: F.lower(F.regexp_replace(g, r"^0+(?=.)", ""))))

    # at most one "::"; ":::" leaves an empty group, which fails the group test
    groups = let(F.split(_hex_tail(col), "::", 3), lambda halves: let(_filled(halves), cleaned))
    return F.when(col.rlike(IPV6_CHARS), groups)


# Runs of zero groups, longest first.
ZERO_RUNS = [":" + "0:" * n for n in range(8, 1, -1)]


def _compress(groups: Column) -> Column:
    """Join eight groups, replacing the first longest run (two or more) of zeros by ``::``."""

    def packed(text: Column) -> Column:
        longest = F.get(
            F.filter(F.array(*[F.lit(r) for r in ZERO_RUNS]), lambda r: F.instr(text, r) > 0), F.lit(0)
        )
        return let(
            longest,
            lambda run: F.when(run.isNull(), text).otherwise(
                F.concat(F.call_function("substring_index", text, run, F.lit(1)), F.lit("::"), F.substr(text, F.instr(text, run) + F.length(run)))
            ),
        )

    text = F.concat(F.lit(":"), F.array_join(groups, ":"), F.lit(":"))
    # one lone colon may be left at either end
    return F.regexp_replace(let(text, packed), r"^:(?!:)|(?<!:):$", "")


def _hex_word(groups: Column, i: int) -> Column:
    return F.conv(F.get(groups, F.lit(i)), 16, 10).cast("bigint")


def _printed(groups: Column) -> Column:
    mapped = F.array_join(F.slice(groups, 1, 6), ":") == "0:0:0:0:0:ffff"
    octets = [
        part.cast("string")
        for i in (6, 7)
        for part in (F.shiftright(_hex_word(groups, i), 8), _hex_word(groups, i).bitwiseAND(F.lit(255)))
    ]
    return F.when(mapped, F.concat_ws(".", *octets)).otherwise(_compress(groups))


def canon_ip(col: Column) -> Column:
    """Canonical text of an IPv4 or IPv6 address; null when it is not an address.

    IPv6 is printed in short form; an IPv4-mapped address is printed as IPv4.
    """
    v6 = let(col, lambda c: let(_as_groups(c), lambda g: F.when(g.isNotNull(), _printed(g))))
    return F.when(col.rlike(IPV4), col).when(F.contains(col, F.lit(":")), v6)


def cidr_address(col: Column) -> Column:
    """Address part of ``address/prefix``, canonical; null unless both parts are valid."""
    addr = canon_ip(F.substring_index(col, "/", 1))
    prefix = cidr_prefix(col)
    return F.when(prefix.isNotNull(), addr)


def cidr_prefix(col: Column) -> Column:
    """Prefix length of a CIDR text, null when missing or out of range."""
    length = F.regexp_extract(col, r"^[^/]+/(0|[1-9][0-9]{0,2})\z", 1).try_cast("int")
    limit = F.when(F.contains(F.substring_index(col, "/", 1), F.lit(":")), 128).otherwise(32)
    return F.when(length <= limit, length)


def address_halves(col: Column) -> Column:
    """STRUCT<family, hi, lo> of a canonical address; IPv4 lives in ``lo`` with hi = 0."""

    def v4(octets: Column) -> Column:
        parts = [F.shiftleft(F.get(octets, F.lit(i)).cast("bigint"), 24 - 8 * i) for i in range(4)]
        number = parts[0] + parts[1] + parts[2] + parts[3]
        return F.struct(F.lit(4).alias("family"), F.lit(0).cast("bigint").alias("hi"), number.alias("lo"))

    def half(groups: Column, start: int) -> Column:
        out = F.shiftleft(_hex_word(groups, start), 48)
        for i, shift in ((1, 32), (2, 16), (3, 0)):
            out = out.bitwiseOR(F.shiftleft(_hex_word(groups, start + i), shift))
        return out

    def v6(groups: Column) -> Column:
        return F.struct(F.lit(6).alias("family"), half(groups, 0).alias("hi"), half(groups, 4).alias("lo"))

    return F.when(F.contains(col, F.lit(":")), let(_as_groups(col), v6)).when(
        col.isNotNull(), let(F.split(col, r"\."), v4)
    )


def _mask64(value: Column, keep: Column) -> Column:
    """Keep the top ``keep`` (0..64) bits of a 64-bit half."""
    shift = F.lit(64) - keep
    return (
        F.when(keep <= 0, F.lit(0).cast("bigint"))
        .when(keep >= 64, value)
        .otherwise(F.call_function("shiftleft", F.call_function("shiftright", value, shift), shift))
    )


def masked(halves: Column, prefix: Column) -> Column:
    """Network base of an address for a prefix length: STRUCT<family, hi, lo>."""
    v4_keep = prefix + 32
    return F.when(
        halves["family"] == 4,
        F.struct(
            F.lit(4).alias("family"),
            F.lit(0).cast("bigint").alias("hi"),
            _mask64(halves["lo"], v4_keep).alias("lo"),
        ),
    ).otherwise(
        F.struct(
            F.lit(6).alias("family"),
            _mask64(halves["hi"], F.least(prefix, F.lit(64))).alias("hi"),
            _mask64(halves["lo"], prefix - 64).alias("lo"),
        )
    )
