"""Raw messages to typed events in one pass.

A message is classified once. One regex match per message then yields all its parts: the line pattern of the kind is
replaced by its own groups with a separator between them and the text is split. ``SHAPES`` names the parts, which become
a map, and the output columns read that map. The whole job is a chain of projections of built-in functions, without a
shuffle and without reading the input once per kind.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglattice.functions.fence import computed_once
from loglattice.functions.ip import IPV4

_SEP = "\u0001"
_IP = r"(\d{1,3}(?:\.\d{1,3}){3})"
_COMMA_STAMP = r"(\d{4}-\d\d-\d\d \d\d:\d\d:\d\d,\d{3})"
_SYSLOG_STAMP = r"(\w{3} +\d{1,2} \d\d:\d\d:\d\d)"
_REQUEST = r'"(\S+) (.*?) HTTP/[\d.]+"'


@dataclass(frozen=True)
class Shape:
    """One line format.

    ``detect``  pattern that tells the kind, tried in the order of ``SHAPES``
    ``parts``   pattern over the whole message with one group per name in ``names``
    ``stamp``   datetime pattern of the part called ``ts``; None for stamps without a year
    ``pairs``   whether the part called ``body`` holds ``key=value`` pairs
    """

    detect: str
    parts: str
    names: tuple[str, ...]
    stamp: str | None
    pairs: bool = False


# Order matters: the first detected kind wins.
SHAPES: dict[str, Shape] = {
    "cef": Shape(
        r" CEF:0\|",
        rf"^{_SYSLOG_STAMP} (\S+) CEF:0" + r"\|([^|]*)" * 6 + r"\|(.*)$",
        ("ts", "host", "vendor", "product", "version", "signature", "name", "severity", "body"),
        None,
        pairs=True,
    ),
    "waf": Shape(
        r"ModSecurity: ",
        r"^(\d{4}/\d\d/\d\d \d\d:\d\d:\d\d) .*"
        r'\[id "(\d+)"\] \[msg "(.*?)"\] \[severity "(.*?)"\] \[data "(.*?)"\], client: (\S+), server: (\S+), '
        + "request: " + _REQUEST + "$",
        ("ts", "rule_id", "rule_msg", "level", "data", "client_ip", "server", "http_method", "url_path"),
        "yyyy/MM/dd HH:mm:ss",
    ),
    "haproxy": Shape(
        r"^\w{3} [ \d]\d [\d:]{8} \S+ haproxy\[\d+\]: ",
        r"^.{15} (\S+) haproxy\[(\d+)\]: ([^:\s]+):(\d+) \[([^\]]+)\] (\S+) ([^/\s]+)/(\S+) "
        r"(\d+)/(\d+)/(\d+)/(\d+)/(\d+) (\d{3}) (\d+) .*" + _REQUEST + "$",
        ("host", "pid", "client_ip", "port", "ts", "frontend", "backend", "server", "t_request", "t_queue", "t_connect",
         "t_response", "duration_ms", "http_status", "bytes", "http_method", "url_path"),
        "dd/MMM/yyyy:HH:mm:ss.SSS",
    ),
    "envoy": Shape(
        r'^\[[-\d]{10}T[\d:.]{12}Z\] "',
        r"^\[([^\]]+)\] " + _REQUEST + r' (\d{3}) (\S+) (\d+) (\d+) (\d+) (\d+) "([^"]*)" "([^"]*)" "([^"]*)" "([^"]*)" '
        r'"([^"]*)"$',
        ("ts", "http_method", "url_path", "http_status", "flags", "bytes_in", "bytes", "duration_ms", "upstream_ms",
         "client_ip", "agent", "request_id", "service", "upstream"),
        "yyyy-MM-dd'T'HH:mm:ss.SSSX",
    ),
    "gc": Shape(
        r"^\[[-\d]{10}T[\d:.]{12}[+]0000\] GC\(#\d+\) ",
        r"^\[([^\]]+)\] GC\(#(\d+)\) (.*) (\d+)M->(\d+)M\((\d+)M\) ([\d.]+)ms$",
        ("ts", "gc_no", "pause_kind", "before_mb", "after_mb", "heap_mb", "duration_ms"),
        "yyyy-MM-dd'T'HH:mm:ss.SSSXX",
    ),
    "hikari": Shape(
        r" \| HikariPool-\d+ \| pool stats: ",
        r"^(\S+) \| (\S+) \| (\S+) \| pool stats: total=(\d+) active=(\d+) idle=(\d+) waiting=(\d+)$",
        ("ts", "host", "pool", "total", "active", "idle", "waiting"),
        "yyyy-MM-dd'T'HH:mm:ss.SSSX",
    ),
    "redis": Shape(
        r"^\d+:M \d{2} \w{3} \d{4} ",
        r"^(\d+):M (\d{2} \w{3} \d{4} [\d:.]+) \* (.*)$",
        ("pid", "ts", "body"),
        "dd MMM yyyy HH:mm:ss.SSS",
    ),
    "nginx": Shape(
        r"^\d{1,3}(\.\d{1,3}){3} - \S+ \[",
        rf"^{_IP} - (\S+) \[([^\]]+)\] " + _REQUEST + r' (\d{3}) (\d+) "([^"]*)" "([^"]*)" rt=([\d.]+)$',
        ("client_ip", "user_name", "ts", "http_method", "url_path", "http_status", "bytes", "referrer", "agent",
         "seconds"),
        "dd/MMM/yyyy:HH:mm:ss Z",
    ),
    "kafka": Shape(
        r"^[-\d]{10} [\d:]{8},\d{3} \w+ +\[Consumer clientId=",
        rf"^{_COMMA_STAMP} (\w+) +\[Consumer clientId=([^\]]+)\] group=(\S+) topic=(\S+) partition=(\d+) "
        r"offset=(\d+) lag=(\d+)$",
        ("ts", "level", "client_id", "group", "topic", "partition", "offset", "lag"),
        "yyyy-MM-dd HH:mm:ss,SSS",
    ),
    "postgres": Shape(
        r"^[-\d]{10} [\d:.]{12} UTC \[\d+\] \w+@\w+ [A-Z]+:",
        r"^([-\d]{10} [\d:.]{12}) UTC \[(\d+)\] (\w+)@(\w+) ([A-Z]+): +(.*)$",
        ("ts", "pid", "user_name", "database", "level", "body"),
        "yyyy-MM-dd HH:mm:ss.SSS",
    ),
    "stacktrace": Shape(
        r"(?s)^[-\d]{10} [\d:]{8},\d{3} ERROR +\[[^\]]+\] \S+ - Unhandled exception .*\n",
        rf"^{_COMMA_STAMP} (\w+) +\[([^\]]+)\] (\S+) - ([^\n]*)\n([^:\n]+)(?:: ([^\n]*))?(\n.*)?$",
        ("ts", "level", "thread", "logger", "body", "exception", "exception_message", "rest"),
        "yyyy-MM-dd HH:mm:ss,SSS",
        pairs=True,
    ),
    "log4j": Shape(
        r"^[-\d]{10} [\d:]{8},\d{3} \w+ +\[[^\]]+\] \S+ - ",
        rf"^{_COMMA_STAMP} (\w+) +\[([^\]]+)\] (\S+) - (.*)$",
        ("ts", "level", "thread", "logger", "body"),
        "yyyy-MM-dd HH:mm:ss,SSS",
        pairs=True,
    ),
    "iis": Shape(
        r"^[-\d]{10} [\d:]{8} [\d.]+ [A-Z]+ \S+ \S+ \d+ - ",
        r"^([-\d]{10} [\d:]{8}) (\S+) ([A-Z]+) (\S+) (\S+) (\d+) - (\S+) (\S+) \S+ (\d{3}) \d+ \d+ (\d+)$",
        ("ts", "server_ip", "http_method", "url_path", "body", "port", "client_ip", "agent", "http_status",
         "duration_ms"),
        "yyyy-MM-dd HH:mm:ss",
        pairs=True,
    ),
    "syslog": Shape(
        r"^\w{3} [ \d]\d [\d:]{8} \S+ [\w-]+\[\d+\]: ",
        rf"^{_SYSLOG_STAMP} (\S+) ([\w-]+)\[(\d+)\]: (.*)$",
        ("ts", "host", "service", "pid", "body"),
        None,
    ),
}

# The paths of the JSON kinds that feed the common columns; other fields are skipped while parsing.
_ENVELOPE = (
    "order_id STRING, order_date STRING, status STRING, ts STRING, svc STRING, lvl STRING, accountId BIGINT, "
    "clientIp STRING, durationMs BIGINT, `@timestamp` STRING, "
    "resource STRUCT<attributes: STRUCT<`service.name`: STRING>>, "
    "span STRUCT<startTimeUnixNano: BIGINT, endTimeUnixNano: BIGINT, attributes: STRUCT<http: STRUCT<request: "
    "STRUCT<method: STRING>, response: STRUCT<status_code: INT>, route: STRING>, client: STRUCT<address: STRING>, "
    "enduser: STRUCT<id: STRING, accountId: BIGINT>>>, "
    "actor STRUCT<principal: STRUCT<name: STRING>>, source STRUCT<ip: STRING>, target STRUCT<accountId: BIGINT>, "
    "transaction STRUCT<accountId: BIGINT>, device STRUCT<ip: STRING>"
)

JSON_KINDS = ("order", "otel_span", "audit_event", "payment_auth", "jsonish", "json_other")


def _is_json(message: Column) -> Column:
    return message.rlike(r"^\s*\{")


def _json_kind(doc: Column) -> Column:
    return (
        F.when(doc["order_id"].isNotNull(), "order")
        .when(doc["span"].isNotNull(), "otel_span")
        .when(doc["actor"].isNotNull(), "audit_event")
        .when(doc["transaction"].isNotNull(), "payment_auth")
        .when(doc["svc"].isNotNull(), "jsonish")
        .otherwise("json_other")
    )


def _line_kind(message: Column) -> Column:
    out = F
    for kind, shape in SHAPES.items():
        out = out.when(message.rlike(shape.detect), kind)
    return out.otherwise("unknown")


def classify(message: Column | str) -> Column:
    """The kind of a raw message; ``unknown`` and ``json_other`` keep what fits no format."""
    message = F.col(message) if isinstance(message, str) else message
    doc = F.from_json(message, "order_id STRING, span STRING, actor STRING, transaction STRING, svc STRING")
    return F.when(_is_json(message), _json_kind(doc)).otherwise(_line_kind(message))


_PAIR = r'\b[A-Za-z][\w.]*+=(?:"[^"]*+"|\S++)'


def pairs(text: Column) -> Column:
    """The ``key=value`` pieces of a log body."""
    return F.regexp_extract_all(text, F.lit(_PAIR), F.lit(0))


def _pair_keys(found: Column) -> Column:
    return F.transform(found, lambda p: F.substring_index(p, "=", 1))


def _pair_values(found: Column) -> Column:
    return F.transform(found, lambda p: F.btrim(F.substr(p, F.locate("=", p) + 1), F.lit('"')))


def _first_per_key(keys: Column, values: Column) -> Column:
    names = F.array_distinct(keys)
    return F.map_from_arrays(names, F.transform(names, lambda k: F.element_at(values, F.array_position(keys, k).cast("int"))))


def kv_map(text: Column) -> Column:
    """``key=value`` pairs of a text as a map; the first value of a repeated key is kept."""
    found = pairs(text)
    return _first_per_key(_pair_keys(found), _pair_values(found))


def _extract(text: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def yearless_ts(stamp: Column, as_of: Column, year: int | None = None) -> Column:
    """``MMM d HH:mm:ss`` read in the year of ``as_of``, or the year before when that lies in the future."""
    text = F.regexp_replace(stamp, " +", " ")

    def at(y: Column) -> Column:
        return F.try_to_timestamp(F.concat(y.cast("string"), F.lit(" "), text), F.lit("yyyy MMM d HH:mm:ss"))

    if year is not None:
        return at(F.lit(year))
    # The newest year in which the text is a date not after ``as_of``; 29 February may be up to eight years back.
    years = F.array(*[F.year(as_of) - back for back in range(9)])
    valid = F.filter(F.transform(years, at), lambda t: t <= as_of)
    recent = F.transform(F.array(at(F.year(as_of)), at(F.year(as_of) - 1)), lambda t: F.when(t <= as_of, t))
    return F.when(text.startswith("Feb 29 "), F.get(valid, F.lit(0))).otherwise(F.coalesce(recent[0], recent[1]))


def parse_messages(
    df: DataFrame, as_of: datetime, year: int | None = None, message: str = "message", with_doc: bool = False
) -> DataFrame:
    """One typed row per message; the input columns are kept.

    Adds ``kind, ts, level, service, client_ip, account_id, user_name, http_method, url_path, http_status, bytes,
    duration_ms, kv, frames, caused_by`` and, on request, ``doc`` (VARIANT). Nothing is dropped: a message that fits no
    pattern keeps its kind or ``unknown`` with null columns.
    """
    raw = F.col(message)
    staged = df.withColumn("envelope", F.when(_is_json(raw), F.from_json(raw, _ENVELOPE)))
    env = F.col("envelope")
    staged = staged.withColumn("kind", F.when(_is_json(raw), _json_kind(env)).otherwise(_line_kind(raw)))

    kind, names, parts = F.col("kind"), F, F
    for name, shape in SHAPES.items():
        groups = _SEP.join(f"${i}" for i in range(1, len(shape.names) + 1))
        parts = parts.when(kind == name, F.split(F.regexp_replace(raw, f"(?s){shape.parts}", groups), _SEP))
        names = names.when(kind == name, F.array(*map(F.lit, shape.names)))
    staged = staged.withColumns({"parts": parts, "names": names})
    # A line of a known kind that breaks off half-way leaves its parts unread.
    staged = staged.withColumn("parts", F.when(F.size("parts") == F.size("names"), F.col("parts")))
    staged = staged.withColumn("body", F.get("parts", F.array_position("names", "body").cast("int") - 1))
    has_pairs = kind.isin(*[k for k, s in SHAPES.items() if s.pairs]) & F.col("parts").isNotNull()
    staged = staged.withColumn("found", F.when(has_pairs, pairs(F.col("body"))))
    staged = staged.withColumns(
        {
            "keys": F.when(has_pairs, F.concat("names", _pair_keys(F.col("found")))),
            "values": F.when(has_pairs, F.concat("parts", _pair_values(F.col("found")))),
        }
    )
    fields = F.when(has_pairs, _first_per_key(F.col("keys"), F.col("values"))).when(
        F.col("parts").isNotNull(), F.map_from_arrays("names", "parts")
    )
    staged = computed_once(
        staged.select(*[F.col(f"`{c}`") for c in df.columns], "envelope", "kind", fields.alias("kv")),
        {"envelope": F.col("envelope"), "kind": F.col("kind"), "kv": F.col("kv")},
    )
    env, kind, kv = F.col("envelope"), F.col("kind"), F.col("kv")
    body = kv["body"]

    def any_of(*keys: str) -> Column:
        return F.coalesce(*[kv[k] for k in keys])

    as_of_col = F.lit(as_of).cast("timestamp")
    nano = env["span"]["startTimeUnixNano"]
    iso = F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSX")
    json_stamp = F.try_to_timestamp(F.coalesce(env["ts"], env["order_date"], env["@timestamp"]), iso)
    stamp = F.when(kind == "otel_span", _nano_ts(nano)).when(kind.isin(*JSON_KINDS), json_stamp)
    for form in dict.fromkeys(s.stamp for s in SHAPES.values()):
        same = kind.isin(*[k for k, s in SHAPES.items() if s.stamp == form])
        text = kv["ts"]
        value = yearless_ts(text, as_of_col, year) if form is None else F.try_to_timestamp(text, F.lit(form))
        stamp = stamp.when(same, value)

    span = env["span"]["attributes"]
    address = F.coalesce(
        env["clientIp"],
        span["client"]["address"],
        env["source"]["ip"],
        env["device"]["ip"],
        any_of("client_ip", "clientIp", "src"),
        F.when(kind == "redis", _extract(body, rf"\baddr={_IP}:")),
        F.when(kind == "syslog", _extract(body, rf"(?: from | user \S+ ){_IP} port ")),
    )
    account_text = F.coalesce(
        any_of("accountId"),
        F.when(kv["cs1Label"] == "accountId", kv["cs1"]),
        F.when(kind == "nginx", _extract(kv["url_path"], r"accountId=(\d+)")),
        F.when(kind == "waf", _extract(kv["data"], r"accountId=(\d+)")),
        F.when(kind == "log4j", _extract(body, r"key=acct:(\d+):")),
    )
    account = F.coalesce(
        env["accountId"],
        span["enduser"]["accountId"],
        env["target"]["accountId"],
        env["transaction"]["accountId"],
        account_text.try_cast("bigint"),
    )
    user = F.coalesce(
        span["enduser"]["id"],
        env["actor"]["principal"]["name"],
        F.nullif(any_of("user_name", "user", "principal", "sub", "client", "suser"), F.lit("-")),
        F.when(
            kind == "syslog",
            F.coalesce(
                _extract(body, r" for (?:invalid user )?(\S+) from "),
                _extract(body, r"authenticating user (\S+) "),
                _extract(body, r" of user (\w+)"),
                _extract(body, r" by (\w+)\("),
            ),
        ),
    )
    status = F.coalesce(
        span["http"]["response"]["status_code"],
        F.when(kind == "jsonish", env["status"].try_cast("int")),
        any_of("http_status", "status").try_cast("int"),
        F.when((kind == "waf") & kv.isNotNull(), 403),
    )
    size = F.coalesce(any_of("bytes"), F.when(kv["cs1Label"] == "bytes", kv["cs1"])).try_cast("bigint")
    span_ms = (env["span"]["endTimeUnixNano"] - nano) / 1000000
    text_ms = F.coalesce(
        any_of("duration_ms", "durationMs"),
        _extract(any_of("elapsed", "duration"), r"^([\d.]+)ms"),
        F.when(kind == "postgres", _extract(body, r"duration: ([\d.]+) ms")),
    )
    duration = F.coalesce(
        env["durationMs"].cast("double"),
        span_ms,
        text_ms.try_cast("double"),
        F.round(kv["seconds"].try_cast("double") * 1000, 3),
    )
    staged = staged.withColumn("address", address)
    is_trace = kind == "stacktrace"
    return staged.select(
        *[F.col(f"`{c}`") for c in df.columns],
        "kind",
        stamp.alias("ts"),
        F.upper(F.coalesce(env["lvl"], kv["level"])).alias("level"),
        F.coalesce(env["svc"], env["resource"]["attributes"]["service.name"], any_of("service", "logger"))
        .alias("service"),
        F.when(F.col("address").rlike(IPV4), F.col("address")).alias("client_ip"),
        account.alias("account_id"),
        user.alias("user_name"),
        F.coalesce(span["http"]["request"]["method"], kv["http_method"]).alias("http_method"),
        F.coalesce(span["http"]["route"], kv["url_path"]).alias("url_path"),
        status.alias("http_status"),
        size.alias("bytes"),
        duration.alias("duration_ms"),
        "kv",
        F.when(is_trace, F.regexp_extract_all(kv["rest"], F.lit(r"(?m)^\tat (.+)$"), F.lit(1))).alias("frames"),
        F.when(is_trace, _extract(kv["rest"], r"(?m)^Caused by: ([^:\n]+)")).alias("caused_by"),
        *([F.when(_is_json(raw), F.try_parse_json(raw)).alias("doc")] if with_doc else []),
    )


def _nano_ts(nano: Column) -> Column:
    # Whole-number division: the value exceeds what a double holds exactly.
    return F.timestamp_micros(F.call_function("div", nano, F.lit(1000)))
