"""IPv4 addresses as canonical text plus a BIGINT form for range work."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_OCTET = "(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IPV4 = rf"\A{_OCTET}([.]{_OCTET}){{3}}\z"
_GROUP = "[0-9A-Fa-f]{1,4}"
#: Eight groups; or fewer around one ``::``, counted by a look-ahead over the colons.
IPV6 = rf"\A({_GROUP}(:{_GROUP}){{7}}|(?=(:?[^:]*:){{2,8}}[^:]*\z)({_GROUP}(:{_GROUP})*)?::({_GROUP}(:{_GROUP})*)?)\z"

# The inclusive client address range.
CLIENT_RANGE = ("10.30.255.0", "10.50.255.0")


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def to_ip(value: Column | str, allow_ipv6: bool = False) -> Column:
    """Canonical address text, or null when the text is not a strict dotted quad."""
    text = _col(value)
    valid = text.rlike(IPV4)
    if allow_ipv6:
        valid = valid | (text.rlike(IPV6))
    return F.when(valid, text)


def ip_to_long(value: Column | str) -> Column:
    """The address as BIGINT; null when invalid."""
    parts = F.split(to_ip(value), "[.]")
    octets = [parts.getItem(i).cast("bigint") for i in range(4)]
    return octets[0] * 16777216 + octets[1] * 65536 + octets[2] * 256 + octets[3]


def long_to_ip(value: Column | str) -> Column:
    number = _col(value).cast("bigint")
    octets = [F.shiftright(number, s).bitwiseAND(F.lit(255)).cast("string") for s in (24, 16, 8, 0)]
    return F.when(number.between(0, 4294967295), F.concat_ws(".", *octets))


def _bound(text: str) -> int:
    a, b, c, d = (int(part) for part in text.split("."))
    return ((a * 256 + b) * 256 + c) * 256 + d


def in_range(value: Column | str, low: str = CLIENT_RANGE[0], high: str = CLIENT_RANGE[1]) -> Column:
    """Whether the address lies in an inclusive range."""
    return ip_to_long(value).between(_bound(low), _bound(high))
