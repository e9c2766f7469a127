"""Checking SQL for DuckDB, written from the operators' definitions and sharing their parameters."""

from __future__ import annotations

from loglattice.llm import credentials, linespread, merkle, mixing, quality, setsketch, urltree
from loglattice.llm.common import SPACES, WORD

_TRIM = rf"^[{SPACES}]+|[{SPACES}]+$"

QUALITY = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, text, regexp_extract_all(text, '{WORD}') AS words,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines FROM d),
m AS (SELECT r, doc_id, len(words) AS n_words, length(regexp_replace(text, '[{SPACES}]', '', 'g')) AS word_chars,
  length(text) - length(regexp_replace(text, '[{quality.SYMBOLS}]', '', 'g')) AS n_symbols,
  len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
  length(text) - length(regexp_replace(text, '\p{{Lu}}', '', 'g')) AS upper_letters,
  length(text) - length(regexp_replace(text, '\p{{L}}', '', 'g')) AS letters, length(text) - length(regexp_replace(text, '{quality.UNSPACED}', '', 'g')) AS unspaced,
  len(list_filter(words, lambda x: regexp_matches(x, '\p{{L}}'))) AS wordy FROM w),
p AS (SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS i, words FROM w),
top AS (SELECT r, max(n) AS n FROM (SELECT r, word, count(*) AS n FROM p GROUP BY r, word) GROUP BY r),
v AS (SELECT r, i, words[i:i + 4] AS five FROM p WHERE i + 4 <= len(words)),
twice AS (SELECT r, five FROM v GROUP BY r, five HAVING count(*) > 1),
covered AS (SELECT r, count(DISTINCT i + j) AS n FROM v JOIN twice USING (r, five), range(5) AS g(j) GROUP BY r),
b AS (SELECT m.*, coalesce(c.n, 0) AS n_repeat_words, coalesce(top.n, 0) AS top_word,
  n_words < {quality.MIN_WORDS} OR 100 * coalesce(c.n, 0) > {quality.REPEAT_PERCENT} * n_words AS base_failed
  FROM m LEFT JOIN covered c USING (r) LEFT JOIN top USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND 100 * n_symbols <= {quality.SYMBOL_PERCENT} * n_words AND 100 * upper_letters <= {quality.UPPER_PERCENT} * letters
  AND 100 * n_dup_lines <= {quality.DUP_LINE_PERCENT} * n_lines AND word_chars >= {quality.WORD_CHARS_RANGE[0]} * n_words
  AND (word_chars <= {quality.WORD_CHARS_RANGE[1]} * n_words OR 2 * unspaced > word_chars)
  AND (100 * top_word <= {quality.TOP_WORD_PERCENT} * n_words OR n_words < {2 * quality.MIN_WORDS})
  AND 100 * wordy >= {quality.WORDY_PERCENT} * n_words AS kept
FROM b
"""

LINES = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, text FROM documents),
l AS (SELECT r, doc_id, source, unnest(lines) AS line, generate_subscripts(lines, 1) AS i
  FROM (SELECT *, string_split(text, chr(10)) AS lines FROM d WHERE text IS NOT NULL)),
t AS (SELECT *, regexp_replace(line, '{_TRIM}', '', 'g') AS bare FROM l),
b AS (SELECT bare, min(doc_id) AS first_id FROM t WHERE bare <> '' GROUP BY bare HAVING count(DISTINCT source) >= {linespread.MIN_SITES}),
k AS (SELECT r, count(*) FILTER (WHERE cut) AS n_removed, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT cut), '') AS text
  FROM (SELECT t.*, b.bare IS NOT NULL AND (first_id IS DISTINCT FROM doc_id OR doc_id IS NULL) AS cut FROM t LEFT JOIN b USING (bare)) GROUP BY r)
SELECT d.doc_id, coalesce(n_removed, 0) AS n_removed, length(k.text) AS chars_left, md5(k.text) AS text_md5 FROM d LEFT JOIN k USING (r)
"""

WARC = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT h, max(page_id) AS first_id FROM p WHERE n >= 1000 GROUP BY h),
j AS (SELECT p.*, CASE WHEN n >= 1000 AND first_id IS DISTINCT FROM page_id THEN first_id END AS refers_to FROM p LEFT JOIN f USING (h))
SELECT page_id, n AS payload_bytes, h AS payload_digest, CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to FROM j
"""


def _weights(name: str, weights: dict[str, int]) -> str:
    return "CASE " + " ".join(f"WHEN {name} = '{k}' THEN {v}" for k, v in weights.items()) + " ELSE 1 END"


def _pour(out: str, children: str, parent: str, name: str) -> str:
    up = f"PARTITION BY {parent} ORDER BY capacity::DOUBLE / weight, {name}"
    return f"""
{out}_a AS (SELECT *, greatest(0, given - coalesce(sum(capacity) OVER ({up} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS spare,
  sum(weight) OVER ({up} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_left, row_number() OVER ({up}) AS place FROM {children}),
{out}_b AS (SELECT *, capacity * weight_left <= weight * spare AS filled FROM {out}_a),
{out}_c AS (SELECT *, min(CASE WHEN NOT filled THEN place END) OVER (PARTITION BY {parent}) AS open_place FROM {out}_b),
{out} AS (SELECT c.*, CASE WHEN c.filled THEN c.capacity ELSE (c.weight * max(CASE WHEN c.place = c.open_place THEN c.spare END) OVER (PARTITION BY {parent}))
  // max(CASE WHEN c.place = c.open_place THEN c.weight_left END) OVER (PARTITION BY {parent}) END AS budget FROM {out}_c c)"""


_DOMAIN = "CASE " + " ".join(f"WHEN regexp_matches(origin, '[{d}]$') THEN '{n}'" for n, d in reversed(mixing.DOMAIN_DIGITS.items())) + " ELSE 'other' END"

MIXING = f"""
WITH t AS (SELECT doc_id, lang, source, coalesce(lang, '') AS language, coalesce(source, '') AS origin,
  len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS n_tokens FROM documents),
d AS (SELECT *, {_DOMAIN} AS domain FROM t WHERE n_tokens > 0),
leaf AS (SELECT domain, language, origin, sum(n_tokens) AS tokens, sum(n_tokens) * {mixing.MAX_EPOCHS} AS capacity, 1 AS weight FROM d GROUP BY ALL),
one AS (SELECT sum(tokens) * {mixing.BUDGET_PERCENT} // 100 AS given FROM leaf),
doms AS (SELECT 1 AS root, domain, sum(capacity) AS capacity, {_weights("domain", mixing.DOMAIN_WEIGHTS)} AS weight, any_value(given) AS given FROM leaf, one GROUP BY domain),
{_pour("top", "doms", "root", "domain")},
langs AS (SELECT l.domain, l.language, sum(l.capacity) AS capacity, {_weights("l.language", mixing.LANGUAGE_WEIGHTS)} AS weight, any_value(top.budget) AS given
  FROM leaf l JOIN top USING (domain) GROUP BY l.domain, l.language),
{_pour("mid", "langs", "domain", "language")},
origins AS (SELECT l.*, mid.budget AS given FROM leaf l JOIN mid USING (domain, language)),
{_pour("low", "origins", "domain, language", "origin")},
plan AS (SELECT domain, language, origin, budget // tokens AS epochs, budget % tokens AS rest FROM low),
placed AS (SELECT d.*, epochs, rest, md5('{mixing.SEED}:' || epochs || ':' || coalesce(doc_id::VARCHAR, '')) AS place FROM d JOIN plan USING (domain, language, origin)),
run AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, language, origin ORDER BY place RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM placed)
SELECT doc_id, domain, lang, source, n_tokens, epochs + (rest > 0 AND upto <= rest)::BIGINT AS copies FROM run WHERE epochs + (rest > 0 AND upto <= rest)::BIGINT > 0
"""


def _spans(kind: int, pattern: str) -> str:
    """Matches of one kind with running piece lengths; the pieces around the matches come from splitting with the same pattern."""
    value = f"regexp_extract(m, '{pattern}', 2)" if kind == 0 else "m"
    good = (f"length({value}) >= {credentials.MIN_ASSIGNED}", "true", "true", "regexp_matches(m, '[0-9]') AND regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[a-z]')")[kind]
    return f"""SELECT r, {kind} AS kind, stop - length(m) AS start, stop, sha256({value}) AS value FROM (
  SELECT r, m, sum(length(m) + length(g)) OVER (PARTITION BY r ORDER BY i) AS stop FROM (
    SELECT r, unnest(ms) AS m, unnest(gs[:len(ms)]) AS g, generate_subscripts(ms, 1) AS i FROM (
      SELECT r, regexp_extract_all(text, '{pattern}') AS ms, string_split_regex(text, '{pattern}') AS gs FROM d WHERE regexp_matches(text, '{pattern}')))) WHERE {good}"""


def _credentials() -> str:
    plain = [p.replace("'", "''").replace("(?<![A-Za-z0-9+/_-])", "") for p in credentials.PATTERNS]
    found = " UNION ALL ".join(_spans(k, p) for k, p in enumerate(plain))
    names = "[" + ", ".join(f"'{k}'" for k in credentials.KINDS) + "]"
    joined = lambda where: f"coalesce(string_agg({names}[kind + 1] || ':' || start || ':' || stop, ',' ORDER BY start, kind) FILTER (WHERE {where}), '')"
    live = f"owners <= {credentials.MAX_LIVE_OWNERS} AND repos <= {credentials.MAX_LIVE_REPOS}"
    copied = f"(owners >= {credentials.MIN_COPIED_OWNERS} OR repos >= {credentials.MIN_COPIED_REPOS})"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS owner, coalesce(source, '') || '/' || coalesce(lang, '') AS repo, coalesce(text, '') AS text FROM documents),
s AS ({found}),
o AS (SELECT value, count(DISTINCT owner) AS owners, count(DISTINCT owner || chr(0) || repo) AS repos FROM s JOIN d USING (r) GROUP BY value),
a AS (SELECT s.*, {live} AS live, {copied} AS copied, EXISTS (SELECT 1 FROM s b WHERE b.r = s.r AND b.kind < 3 AND b.start < s.stop AND s.start < b.stop) AS inside FROM s JOIN o USING (value)),
j AS (SELECT r, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access, count(*) FILTER (WHERE kind = 2) AS n_hex,
  count(*) FILTER (WHERE live) AS n_live, count(*) FILTER (WHERE copied) AS n_copied,
  {joined('kind < 3')} AS base, {joined('kind < 3 OR (live AND NOT inside)')} AS spans FROM a GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_copied, 0) AS n_copied FROM d LEFT JOIN j USING (r)
"""


CREDENTIALS = _credentials()


def _first_rule(value: str) -> str:
    ordered = sorted(urltree.RULES, key=lambda r: -len(r.text))
    fits = lambda r: f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')"
    return "CASE " + " ".join(f"WHEN {fits(r)} THEN '{getattr(r, value)}'" for r in ordered) + " END"


def _urls() -> str:
    """Levels unrolled, for paths that differ within the first eight segments."""
    u, levels, depth = urltree, [], 8
    for k in range(depth):
        levels.append(f"""
o{k} AS (SELECT *, segments[{k + 1}] AS segment FROM t{k} WHERE paths > 1 AND len(segments) >= {k}),
c{k} AS (SELECT host, template, segment, regexp_replace(segment, '\\p{{L}}+', 'a', 'g') AS shape, sum(n) AS n, sum(labelled) AS labelled, sum(blocked) AS blocked
  FROM o{k} WHERE segment IS NOT NULL GROUP BY ALL),
p{k} AS (SELECT host, template, count(*) AS children, sum(n) AS urls, (sum(blocked) + 1)::DOUBLE / (sum(labelled) + 2) AS rate FROM c{k} GROUP BY ALL),
l{k} AS (SELECT host, template, shape, count(*) AS alike, avg(n) AS usual FROM c{k} WHERE labelled < {u.MIN_LABELS} GROUP BY ALL),
n{k} AS (SELECT host, template, segment, CASE WHEN children >= {u.MIN_CHILDREN} AND urls < {u.MAX_MEAN_URLS} * children THEN '*'
  WHEN children > 1 AND labelled >= {u.MIN_LABELS} AND abs((blocked + 1)::DOUBLE / (labelled + 2) - rate) <= {u.MAX_DEVIATIONS} * sqrt(rate * (1 - rate) / (labelled + 2)) THEN '+'
  WHEN labelled < {u.MIN_LABELS} AND alike >= {u.MIN_ALIKE} AND abs(n - usual) <= {u.MAX_DEVIATIONS} * sqrt(usual) THEN '~' || shape
  ELSE segment END AS shown FROM c{k} JOIN p{k} USING (host, template) LEFT JOIN l{k} USING (host, template, shape)),
x{k} AS (SELECT o.host, o.segments, o.n, o.labelled, o.blocked, o.purity AS upper, o.template || coalesce('/' || shown, '') AS template, o.segment IS NULL AS ends FROM o{k} o
  LEFT JOIN n{k} ON o.host = n{k}.host AND o.template = n{k}.template AND o.segment = n{k}.segment),
t{k + 1} AS (SELECT host, segments, n, labelled, blocked, template, count(*) OVER w AS paths,
  (sum(blocked) OVER w + {u.SMOOTHING} * max(upper) OVER w) / (sum(labelled) OVER w + {u.SMOOTHING}) AS purity FROM x{k} WINDOW w AS (PARTITION BY host, template, ends))""")
    done = " UNION ALL ".join(
        f"SELECT host, segments, template || CASE WHEN len(segments) > {k} THEN '/' || array_to_string(segments[{k + 1}:], '/') ELSE '' END AS template, purity "
        f"FROM t{k} WHERE paths = 1 OR len(segments) < {k}" for k in range(depth + 1)
    )
    return rf"""
WITH h AS (SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
s AS (SELECT *, list_transform(string_split(path, '/'), lambda x: regexp_replace(x, '[0-9]+', '{{n}}', 'g'))[2:] AS segments, {_first_rule('text')} AS rule, {_first_rule('verdict')} AS ruled FROM h),
d AS (SELECT host, segments, count(*) AS n, count(ruled) AS labelled, count(*) FILTER (WHERE ruled = 'block') AS blocked FROM s GROUP BY host, segments),
g AS (SELECT sum(blocked) / greatest(sum(labelled), 1) AS rate FROM d),
t0 AS (SELECT d.*, '' AS template, count(*) OVER w AS paths, (sum(blocked) OVER w + {u.SMOOTHING} * rate) / (sum(labelled) OVER w + {u.SMOOTHING}) AS purity
  FROM d, g WINDOW w AS (PARTITION BY host)),
{",".join(levels)},
m AS ({done})
SELECT page_id, s.host, path, rule, coalesce(ruled, CASE WHEN purity >= {u.MIN_PURITY} THEN 'block' ELSE 'allow' END) AS verdict, template, round(purity, 6) AS purity
FROM s JOIN m ON s.host = m.host AND s.segments = m.segments
"""


URLS = _urls()


def _merkle() -> str:
    """Levels unrolled, for groups of at most 16 ** 6 leaves and as many groups."""
    depth, fan = 6, merkle.FANOUT
    fields = " || ".join(f"CASE WHEN {{{f}}} IS NULL THEN '-' ELSE strlen({{{f}}}::VARCHAR) || ':' || {{{f}}} END" for f in merkle.FIELDS)
    plain = fields.format(**{f: f for f in merkle.FIELDS})
    low = f"translate(text, '{merkle.UPPER}', '{merkle.LOWER}')"
    changed = fields.format(**{f: low if f == "text" else f for f in merkle.FIELDS})
    parts = [rf"""
WITH b0 AS (SELECT i, i AS x FROM range(256) AS g(i)),
{', '.join(f"b{k + 1} AS (SELECT i, CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END AS x FROM b{k})" for k in range(8))},
crc AS (SELECT list(x ORDER BY i) AS t FROM b8),
d AS (SELECT doc_id, source, sha256({plain}) AS leaf, sha256({changed}) AS low,
  list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)) AS bytes FROM documents),
e AS (SELECT doc_id, source, leaf, CASE WHEN xor(list_reduce(bytes, lambda c, v: xor(c // 256, t[(xor(c, v) % 256) + 1])), 4294967295) % 5 = 0
  THEN low ELSE leaf END AS changed FROM d, crc),
r AS (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS grp FROM e),
s0 AS (SELECT grp, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS k, leaf AS h, doc_id, leaf, changed FROM r)"""]

    def levels(name: str) -> None:
        for i in range(depth):
            parts.append(f"""{name}c{i} AS (SELECT *, count(*) OVER (PARTITION BY grp) AS c FROM {name}{i}),
{name}{i + 1} AS (SELECT grp, k // {fan} AS k, sha256(string_agg(h, '' ORDER BY k)) AS h FROM {name}c{i} WHERE c > 1 GROUP BY grp, k // {fan}),
{name}w{i} AS (SELECT grp, k,
  coalesce(string_agg(h, '') OVER (PARTITION BY grp, k // {fan} ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
  coalesce(string_agg(h, '') OVER (PARTITION BY grp, k // {fan} ORDER BY k ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {name}c{i} WHERE c > 1)""")
        parts.append(f"{name}top AS (" + " UNION ALL ".join(f"SELECT grp, h FROM {name}c{i} WHERE c = 1" for i in range(depth)) + ")")

    levels("s")
    parts.append("g0 AS (SELECT 0 AS grp, grp AS k, h FROM stop)")
    levels("g")
    joins, proof, folds = "", [], []
    for name, grp, k in (("s", "s0.grp", "s0.k"), ("g", "0", "s0.grp")):
        for i in range(depth):
            a = f"{name}{i}_"
            joins += f" LEFT JOIN {name}w{i} AS {a} ON {a}.grp = {grp} AND {a}.k = {k} // {fan ** i}"
            proof.append(f"coalesce({a}.l || {a}.r, '')")
            folds.append((f"{a}l", f"{a}r", f"{a}.l AS {a}l, {a}.r AS {a}r"))
    parts.append(f"f0 AS (SELECT doc_id, leaf, stop.h AS subroot, gtop.h AS root, changed AS h, sha256({' || '.join(proof)}) AS proof_sha256, "
                 + ", ".join(x for _, _, x in folds) + f" FROM s0 JOIN stop USING (grp) CROSS JOIN gtop{joins})")
    for i, (left, right, _) in enumerate(folds):
        parts.append(f"f{i + 1} AS (SELECT * REPLACE (CASE WHEN {left} IS NULL THEN h ELSE sha256({left} || h || {right}) END AS h) FROM f{i})")
    return ",\n".join(parts) + f"\nSELECT doc_id, leaf, subroot, root, proof_sha256, h AS folded_root, h = root AS verified FROM f{len(folds)}"


MERKLE = _merkle()

NEAR = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{merkle.UPPER}', '{merkle.LOWER}'), '{WORD}') AS w FROM documents),
s AS (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {setsketch.SHINGLE} THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - {setsketch.SHINGLE - 2}), lambda i: array_to_string(w[i:i + {setsketch.SHINGLE - 1}], ' ')) END)) AS x FROM d),
r AS (SELECT doc_id, len(x) AS n, md5(array_to_string(x, chr(10))) AS f, x FROM s),
node AS (SELECT f, any_value(n) AS n, any_value(x) AS x FROM r WHERE n > 0 GROUP BY f),
t AS (SELECT f, n, unnest(x) AS s FROM node),
c AS (SELECT a.f AS a, b.f AS b, a.n + b.n AS n, count(*) AS common FROM t AS a JOIN t AS b ON a.s = b.s AND a.f <> b.f
  AND 100 * least(a.n, b.n) >= {setsketch.PERCENT} * greatest(a.n, b.n) GROUP BY a.f, b.f, a.n + b.n),
link AS (SELECT a, b FROM c WHERE 100 * common >= {setsketch.PERCENT} * (n - common)),
reach AS (SELECT f AS a, f AS b FROM node UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
least AS (SELECT reach.a AS f, min(r.doc_id) AS lowest FROM reach JOIN r ON r.f = reach.b GROUP BY reach.a)
SELECT doc_id, n AS n_shingles, CASE WHEN n = 0 THEN doc_id ELSE lowest END AS component_id,
  doc_id IS NOT DISTINCT FROM (CASE WHEN n = 0 THEN doc_id ELSE lowest END) AS kept FROM r LEFT JOIN least USING (f)
"""
