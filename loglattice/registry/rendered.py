"""Raw messages rendered by Spark from the derived facts, as input for the parsing queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglattice.functions.fence import computed_once

_COMMA = "date_format(ms_ts, 'yyyy-MM-dd HH:mm:ss,SSS')"
_DOT = "date_format(ms_ts, 'yyyy-MM-dd HH:mm:ss.SSS')"
_ISO = "date_format(ms_ts, \"yyyy-MM-dd'T'HH:mm:ss.SSS\")"
_CLF = "date_format(sec_ts, 'dd/MMM/yyyy:HH:mm:ss')"
_MONTH = "concat(date_format(sec_ts, 'MMM '), lpad(day(sec_ts), 2, ' '), date_format(sec_ts, ' HH:mm:ss'))"

#: Spark SQL text per kind over the columns of ``line_facts``.
LINES = {
    "log4j": f"concat({_COMMA}, ' ', rpad(lvl, 5, ' '), ' [exec-', n12, '] c.x.', svc, ' - Repeated failed login user=', "
    "usr, ' clientIp=', ip, ' accountId=', account, ' elapsed=', ms, 'ms')",
    "nginx": f"concat(ip, ' - ', usr, ' [', {_CLF}, ' +0000] \"', method, ' ', path, '?accountId=', account, "
    "' HTTP/1.1\" ', status, ' ', size, ' \"-\" \"curl/8.7.1\" rt=', format_string('%d.%03d', ms div 1000, ms % 1000))",
    "syslog": f"concat({_MONTH}, ' app-0', n3, ' sshd[', 200 + n12, ']: Failed password for invalid user ', usr, ' from ', "
    "ip, ' port ', 30000 + n12, ' ssh2')",
    "haproxy": f"concat({_MONTH}, ' edge-01 haproxy[901]: ', ip, ':', 30000 + n12, ' [', "
    "date_format(ms_ts, 'dd/MMM/yyyy:HH:mm:ss.SSS'), '] fe_https~ be_auth/srv', n3, ' 1/2/3/4/', ms, ' ', status, ' ', "
    "size, ' - - ---- 5/4/0/0/0 0/0 \"', method, ' ', path, ' HTTP/2.0\"')",
    "envoy": f"concat('[', {_ISO}, 'Z] \"', method, ' ', path, ' HTTP/2\" ', status, ' - 17 ', size, ' ', ms, ' ', "
    "ms div 2, ' \"', ip, '\" \"agent one\" \"r', id, '\" \"', svc, '.svc\" \"10.42.1.9:8080\"')",
    "kafka": f"concat({_COMMA}, ' INFO  [Consumer clientId=consumer-', n3, '] group=fraud topic=', event_type, "
    "' partition=', n12, ' offset=', id, ' lag=', ms)",
    "postgres": f"concat({_DOT}, ' UTC [', 1000 + n12, '] ', usr, '@ledger_api LOG:  duration: ', ms, "
    "'.500 ms  statement: SELECT 1')",
    "cef": f"concat({_MONTH}, ' siem CEF:0|Vendor|Core|4.2|101|Failed Login|', n12, '|src=', ip, ' suser=', usr, "
    "' dst=10.42.1.17 dpt=443 cs1Label=', if(n3 = 0, 'bytes', 'accountId'), ' cs1=', if(n3 = 0, size, account), "
    "' outcome=failure')",
    "hikari": f"concat({_ISO}, 'Z | app-0', n3, ' | HikariPool-1 | pool stats: total=50 active=', 38 + n12, ' idle=', "
    "12 - n12, ' waiting=', ms)",
    "gc": f"concat('[', {_ISO}, '+0000] GC(#', id, ') Pause Young (Normal) (G1 Evacuation Pause) ', 4000 + n12, 'M->', "
    "2000 + n12, 'M(8192M) ', ms, '.25ms')",
    "iis": "concat(date_format(sec_ts, 'yyyy-MM-dd HH:mm:ss'), ' 10.42.3.22 ', method, ' ', path, ' accountId=', account, "
    "' 443 - ', ip, ' agent+one - ', status, ' 0 0 ', ms)",
    "redis": "concat(100 + n12, ':M ', date_format(ms_ts, 'dd MMM yyyy HH:mm:ss.SSS'), ' * Client id=', id, ' addr=', ip, "
    "':', 30000 + n12, ' scheduled to be closed')",
    "waf": "concat(date_format(sec_ts, 'yyyy/MM/dd HH:mm:ss'), ' [error] 12#0: *', id, ' ModSecurity: Access denied with "
    "code 403 (phase 2). [id \"', 942100 + n3, '\"] [msg \"SQL Injection Attack\"] [severity \"CRITICAL\"] [data \"', "
    "path, '?accountId=', account, '\"], client: ', ip, ', server: api.bank.example, request: \"', method, ' ', path, "
    "' HTTP/1.1\"')",
    "stacktrace": f"concat({_COMMA}, ' ERROR [exec-', n12, '] c.x.', svc, ' - Unhandled exception accountId=', account, "
    "' clientIp=', ip, '\\njava.net.SocketTimeoutException: Read timed out', if(n3 = 0, "
    "'\\n\\tat a.B.c(B.java:1)\\n\\tat d.E.f(E.java:2)\\nCaused by: x.Reset: connection reset', '\\n\\tat a.B.c(B.java:1)'))",
    "jsonish": f"""concat('{{"ts":"', {_ISO}, 'Z","svc":"', svc, '","lvl":"', lower(lvl),
        '","msg":"request completed","accountId":', account, ',"clientIp":"', ip, '","traceId":"t', id,
        '","durationMs":', ms, ',"status":', status, '}}')""",
}

#: Documents as nested structs, rendered with ``to_json``.
DOCUMENTS = {
    "otel_span": """named_struct(
      'resource', named_struct('attributes', named_struct('service.name', svc, 'service.version', concat('4.', n12, '.0'),
        'cloud', named_struct('region', concat('region-', n3)), 'k8s', named_struct('pod', named_struct('name', concat('pod-', n12))))),
      'scope', named_struct('name', 'webmvc', 'version', '2.4.0'),
      'span', named_struct('traceId', concat('trace', id div 4), 'spanId', concat('span', id),
        'parentSpanId', if(id % 4 = 0, null, concat('span', id - id % 4)), 'name', concat(method, ' ', path), 'kind', 'SERVER',
        'startTimeUnixNano', unix_micros(ms_ts) * 1000, 'endTimeUnixNano', unix_micros(ms_ts) * 1000 + ms * 1000000,
        'status', named_struct('code', if(n3 = 0, 'STATUS_CODE_ERROR', 'STATUS_CODE_OK'),
          'message', if(n3 = 0 and id % 97 <> 0, 'handler threw', '')),
        'attributes', named_struct('http', named_struct('request', named_struct('method', method),
            'response', named_struct('status_code', status), 'route', path),
          'client', named_struct('address', ip, 'port', 30000 + n12), 'enduser', named_struct('id', usr, 'accountId', account)),
        'events', if(n3 = 0,
          array(named_struct('name', 'db.query', 'attributes', named_struct('db.rows_affected', n12, 'exception.type', cast(null as string))),
                named_struct('name', 'exception', 'attributes', named_struct('db.rows_affected', cast(null as bigint), 'exception.type', concat('E', n12)))),
          array()),
        'links', if(n12 = 0, array(named_struct('traceId', concat('trace', id), 'spanId', concat('span', id))), array())))""",
    "audit_event": f"""named_struct('@timestamp', concat({_ISO}, 'Z'),
      'event', named_struct('kind', 'event', 'category', array(if(n3 = 0, 'iam', 'database')), 'action', event_type,
        'outcome', if(n12 < 3, 'denied', 'allowed'), 'severity', n12, 'risk_score', n12 / 20),
      'actor', named_struct('principal', named_struct('id', concat('usr_', user_id), 'name', usr, 'type', 'human'),
        'session', named_struct('id', concat('s', id), 'mfa', named_struct('satisfied', n3 = 0, 'method', 'totp')),
        'roles', if(n3 = 0, array('viewer'), array('operator', 'viewer'))),
      'source', named_struct('ip', ip, 'geo', named_struct('country', if(n3 = 0, 'US', 'RO'), 'city', if(n3 = 0, 'Denver', 'Cluj'),
        'lat', if(n3 = 0, 39.7392D, 46.7712D), 'lon', if(n3 = 0, -104.9903D, 23.6236D)),
        'network', named_struct('asn', 1000 + n12, 'vpn_detected', n12 = 5)),
      'target', named_struct('type', 'account', 'id', concat('acc_', account), 'accountId', account),
      'labels', named_struct('env', 'production', 'compliance', if(n12 % 2 = 0, array('sox', 'glba'), array('sox'))))""",
    "payment_auth": f"""named_struct('@timestamp', concat({_ISO}, 'Z'),
      'event', named_struct('dataset', 'banking.authorization', 'type', array('access'),
        'outcome', if((n12 < 9) = (id % 89 <> 0), 'success', 'failure')),
      'transaction', named_struct('id', concat(CASE WHEN id % 97 = 0 THEN 'X' ELSE 'AUTH-' END, format_string('%012X', id)), 'accountId', account,
        'amount', named_struct('value', value, 'currency', 'USD'), 'channel', event_type, 'entry_mode', 'chip',
        'decision', if(n12 < 9, 'approved', 'declined')),
      'card', named_struct('brand', if(n3 = 0, 'visa', 'amex'), 'last4', '1234', 'bin', named_struct('number', '411111', 'country', 'US')),
      'merchant', named_struct('name', concat('M', n12), 'mcc', '5411'),
      'device', named_struct('ip', ip, 'trusted', n3 = 0),
      'risk', named_struct('score', case n3 when 0 then 0D when 1 then 0.25D else 0.35D end + if(id % 83 = 0, 0.5D, 0D),
        'rules', case n3 when 0 then array() when 1 then array(named_struct('code', 'R101', 'name', 'velocity', 'score', 0.25D, 'action', 'monitor'))
          else array(named_struct('code', 'R101', 'name', 'velocity', 'score', 0.2D, 'action', 'review'),
                     named_struct('code', 'R204', 'name', 'geo', 'score', 0.5D, 'action', 'monitor')) end,
        'reason_codes', case n3 when 0 then array() when 1 then array(if(id % 79 = 0, 'other', 'velocity')) else array('velocity', 'geo') end),
      'ledger', named_struct('posting', named_struct('status', if((n12 < 9) = (id % 73 <> 0), 'pending', 'void'),
        'journalId', concat(CASE WHEN id % 101 = 0 THEN 'J' ELSE 'JRN-' END, format_string('%08d', id)))))""",
}
# Mixed-type ``from`` and ``to`` cannot be one struct field, so the changes are spliced in as text.
_CHANGES = (
    '"changes":[{"field":"daily_limit","from":1000,"to":5000},{"field":"role","from":"viewer","to":"admin"},'
    '{"field":"mfa_required","from":true,"to":false}]'
)

KINDS = [*LINES, *DOCUMENTS]


def message(kind: str, pretty: bool = False) -> Column:
    """The raw text of one kind."""
    if kind in LINES:
        return F.expr(LINES[kind])
    doc = F.to_json(F.expr(DOCUMENTS[kind]), {"pretty": "true"} if pretty else {"ignoreNullFields": "false"})
    if kind == "audit_event":
        changes = F.when(F.col("n3") == 1, F.lit("{" + _CHANGES + ",")).otherwise(F.lit('{"changes":[],'))
        doc = F.concat(changes, F.substr(doc, F.lit(2)))
    return doc


def messages(facts: DataFrame, kind: str, *keep: str) -> DataFrame:
    """Every fact rendered as one kind; some documents are spread over several lines."""
    text = message(kind)
    if kind in DOCUMENTS and kind != "audit_event":
        text = F.when(F.col("n12") == 7, message(kind, pretty=True)).otherwise(text)
    return computed_once(facts, {"message": text}).select(*keep, "message")


def mixed(facts: DataFrame, *keep: str) -> DataFrame:
    """All kinds interleaved, with some lines of no known format."""
    slot = F.pmod(F.col("id"), F.lit(len(KINDS) + 2))
    out = F
    for number, kind in enumerate(KINDS):
        out = out.when(slot == number, message(kind))
    text = out.when(slot == len(KINDS), F.lit("{ broken")).otherwise(F.concat(F.lit("no format "), F.col("id")))
    return computed_once(facts, {"message": text}).select(*keep, "message")


_HOST = "if(has_ip, ip, '-')"
_WARN = f"{_COMMA}, ' WARN  [http-nio-8080-exec-', n12, '] "
#: Lines of the attack phases and ordinary ones, over the columns of ``attack_facts``: (phase, shape) to text; None stands for any phase.
ATTACK_LINES = {
    (None, "nginx"): f"concat(ip, ' - ', if(phase = 'exfil', target, '-'), ' [', {_CLF}, ' +0000] \"', if(phase = 'stuffing', 'POST', 'GET'), ' ', url, "
    "' HTTP/1.1\" ', code, ' ', sent, ' \"-\" \"', agent, '\" rt=0.012')",
    (None, "waf"): f"concat(date_format(sec_ts, 'yyyy/MM/dd HH:mm:ss'), ' [error] 12#0: *', id, ' ModSecurity: Access denied with code 403 (phase 2). "
    "Matched \"Operator `Rx` with parameter\" against variable `ARGS` [id \"942100\"] [msg \"Attack Detected\"] [severity \"CRITICAL\"] [data \"', "
    f"payload, '\"], client: ', {_HOST}, ', server: api.bank.example, request: \"GET /api/v2/cards HTTP/1.1\"')",
    (None, "json"): f"""concat('{{"ts":"', {_ISO}, 'Z","svc":"account-service","lvl":"warn","msg":"forbidden resource","accountId":', account,
        ',"clientIp":"', {_HOST}, '","traceId":"t', id, '","durationMs":', ms, ',"status":403}}')""",
    ("stuffing", "log4j"): f"concat({_WARN}c.b.auth.LoginController - Authentication failed user=', target, ' clientIp=', {_HOST}, ' reason=BAD_CREDENTIALS attempt=', n12)",
    ("stuffing", "cef"): f"concat({_MONTH}, ' siem CEF:0|Bank|CoreAuth|4.2|205|Excessive Authentication Failures|8|src=', {_HOST}, ' suser=', target, "
    "' dst=10.42.1.17 dpt=443 cs1Label=accountId cs1=', account, ' outcome=failure')",
    ("enumeration", "log4j"): f"concat({_WARN}c.b.acct.AccountQueryService - Unauthorized account access attempt accountId=', account, ' clientIp=', {_HOST}, ' principal=', target)",
    ("exfil", "log4j"): f"concat({_WARN}c.b.batch.StatementJob - Bulk export requested rows=', export_rows, ' clientIp=', {_HOST}, ' principal=', target, ' format=csv')",
    ("exfil", "cef"): f"concat({_MONTH}, ' siem CEF:0|Bank|DLP|4.2|402|Anomalous Data Access Volume|7|src=', {_HOST}, ' suser=', target, "
    "' dst=10.42.1.17 cs1Label=bytes cs1=', sent, ' outcome=success')",
    ("benign", "log4j"): f"concat({_WARN}c.b.batch.StatementJob - Bulk export requested rows=', export_rows, ' clientIp=', {_HOST})",
}


def attack_messages(facts: DataFrame, *keep: str) -> DataFrame:
    """One line per fact of ``attack_facts``."""
    text = F
    for (phase, shape), line in ATTACK_LINES.items():
        same = F.col("shape") == shape
        text = text.when(same if phase is None else same & (F.col("phase") == phase), F.expr(line))
    return computed_once(facts, {"message": text}).select(*keep, "message")


ORDER = """named_struct('order_id', concat(if(k % 157 = 0, 'ORD-', 'ORDER-'), format_string('%08d', k)),
  'order_date', date_format(placed, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"), 'status', status, 'channel', channel,
  'currency', if(k % 127 = 0, 'XXX', currency), 'fx_rate_to_usd', fx, 'quantity', quantity,
  'unit_price', subtotal_c / 100 / quantity, 'subtotal', subtotal_c / 100,
  'discount', named_struct('code', if(disc_pct = 0, null, concat('D', disc_pct)), 'percent', disc_pct, 'amount', disc_c / 100),
  'tax', named_struct('rate', tax_pct / 100, 'amount', tax_c / 100),
  'total_amount', (total_c + if(k % 101 = 0, 300, 0)) / 100,
  'amount_usd', round((total_c + if(k % 101 = 0, 300, 0)) / 100 * fx, 2) + if(k % 103 = 0, 900, 0),
  'customer', named_struct('id', concat(if(k % 163 = 0, 'C-', 'CUST-'), cust), 'country', country, 'city', if(k % 151 = 0, 'Nowhere', city), 'tier', tier,
    'address', named_struct('city', city, 'state', if(country = 'Japan', null, 'S1'), 'prefecture', if(country = 'Japan', 'Tokyo', null))),
  'product', named_struct('name', concat('P', k % 50), 'category', category,
    'tags', case n_tags when 0 then array() when 1 then array('new') else array('eco', 'new') end),
  'shipping', named_struct('method', 'standard', 'carrier', if(k % 131 = 0, 'Pigeon', carrier), 'cost', ship_c / 100, 'estimated_days', ship_days,
    'shipped_at', if(status = 'cancelled', null, date_format(placed + interval 1 day, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")),
    'delivered_at', if(status = 'cancelled', null,
       date_format(if(k % 107 = 0, placed, placed + make_dt_interval(1 + ship_days)), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")),
    'events', if(status = 'cancelled', array(),
       array(named_struct('status', 'label_created', 'at', date_format(placed + interval 1 day, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"),
               'location', named_struct('city', wh_country, 'country', wh_country)),
             named_struct('status', 'delivered', 'at', date_format(placed + make_dt_interval(1 + ship_days), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"),
               'location', named_struct('city', city, 'country', country))))),
  'payment', named_struct('method', method, 'status', case when k % 109 = 0 then 'open' when status = 'returned' then 'refunded'
       when status = 'cancelled' then 'voided' else 'captured' end,
    'authorized_at', date_format(placed + if(k % 167 = 0, interval '2' day, interval '1' minute), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"),
    'card', if((method in ('credit_card', 'debit_card')) = (k % 113 <> 0), named_struct('brand', 'visa', 'last4', '1234'), null)),
  'fulfillment', named_struct('warehouse', named_struct('code', 'W1', 'country', wh_country),
    'cross_border', (wh_country <> country) = (k % 137 <> 0)),
  'return', if(status = 'returned' or k % 139 = 0, named_struct('reason', 'defective',
    'refund', named_struct('amount', (total_c + if(k % 149 = 0, 500, 0)) / 100, 'currency', currency,
      'restocking_fee', if(k % 2 = 0, 0D, round(total_c / 1000, 2))), 'rma', concat(if(k % 173 = 0, 'R-', 'RMA-'), format_string('%07d', k))), null))"""


def orders(facts: DataFrame, *keep: str) -> DataFrame:
    """One commerce order document per fact."""
    text = F.to_json(F.expr(ORDER), {"ignoreNullFields": "false"})
    return computed_once(facts, {"message": text}).select(*keep, "message")
