"""Secret scan with corpus-wide ownership frequency, with DataFrame operations only.

Three base patterns mark spans in every text. A wider pattern adds candidates: long tokens that mix digits, capitals and small letters.
All found values are hashed and counted by distinct owners and distinct repositories over the corpus. A value of one owner in one or two
repositories looks live; one that many owners have, or that one owner has in many repositories, is a copied example. Candidates outside base spans become spans of kind ``live`` if they look live.

A match's place comes from the lengths of the pieces between matches: splitting and extracting with one pattern alternate, and a running
sum over a document's matches gives every start, however many there are.

A null text is empty. A null owner or repository counts as one owner or repository. Repeated rows each get the full answer. Columns with
clashing names and empty tables are fine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loglattice.llm.common import column, materialise, row_key
from loglattice.operators.lookup import lookup_join

#: Fixed patterns and least lengths of the base kinds, in their order.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS, HEX = r"AKIA[A-Z0-9]{14,}", r"[0-9a-f]{16,}"
MIN_ASSIGNED = 12
#: Candidates of the method.
TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}"
KINDS = ("assign", "access", "hex", "live")
PATTERNS = (ASSIGN, ACCESS, HEX, TOKEN)
#: A value of at most so many owners and repositories looks live; one of at least so many of either is a copied example.
MAX_LIVE_OWNERS, MIN_COPIED_OWNERS = 1, 3
MAX_LIVE_REPOS, MIN_COPIED_REPOS = 2, 4


def _found(text: Column, kind: int) -> Column:
    """Kind, match texts and the pieces around them; null where nothing matches, which one pass over the text tells."""
    pattern = F.lit(PATTERNS[kind])
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    gaps = F.transform(F.split(text, PATTERNS[kind], -1), lambda x: F.length(x))
    both = F.struct(F.lit(kind).alias("kind"), F.arrays_zip(matches.alias("match"), F.slice(gaps, 1, F.size(gaps) - 1).alias("gap")).alias("hits"))
    return F.when(text.rlike(PATTERNS[kind]), both)


def spans(rows: DataFrame) -> DataFrame:
    """``rows(key, owner, repo, text)`` to one row per match: ``kind, start, stop, value`` beside ``key, owner, repo``."""
    per_kind = rows.select("key", "owner", "repo", F.explode(F.array(*[_found(F.col("text"), k) for k in range(len(PATTERNS))])).alias("found"))
    hits = per_kind.where("found is not null").select("key", "owner", "repo", "found.kind", F.posexplode("found.hits").alias("at", "hit"))
    hits = hits.select("key", "owner", "repo", "kind", "at", "hit.gap", F.col("hit.match").alias("match"), F.length("hit.match").alias("size"))
    hits = hits.distinct()  # equal rows have equal matches: they are placed once and answered for every row
    before = F.sum(F.col("gap") + F.col("size")).over(Window.partitionBy("key", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0))
    placed = hits.withColumn("stop", before).withColumn("start", F.col("stop") - F.col("size"))
    value = F.when(F.col("kind") == 0, F.regexp_extract("match", ASSIGN, 2)).otherwise(F.col("match"))
    placed = placed.withColumn("value", value)
    mixed = F.col("value").rlike("[0-9]") & F.col("value").rlike("[A-Z]") & F.col("value").rlike("[a-z]")
    good = F.when(F.col("kind") == 0, F.length("value") >= MIN_ASSIGNED).when(F.col("kind") == 3, mixed).otherwise(True)
    return placed.where(good).select("key", "owner", "repo", "kind", "start", "stop", F.sha2("value", 256).alias("value"))


def ownership(found: DataFrame) -> DataFrame:
    """Per value: distinct owners and repositories; counted from distinct pairs, so a widely copied value is reduced in the tasks first."""
    pairs = found.select("value", "owner", "repo").distinct()
    per_owner = pairs.groupBy("value", "owner").agg(F.count("*").alias("repos"))
    return per_owner.groupBy("value").agg(F.count("*").alias("owners"), F.sum("repos").alias("repos"))


def _joined(kinds: Column) -> Column:
    """``kind:start:stop`` of an array of ``(start, kind, stop)``, in order, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["stop"])
    return F.array_join(F.transform(F.array_sort(kinds), one), ",")


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", owner: str = "source", repo_parts: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """Per row: ``doc_id, n_assign, n_access, n_hex, base_spans, spans, n_live, n_copied``; the last two count all candidates."""
    repo = F.concat_ws("/", *[F.coalesce(column(c).cast("string"), F.lit("")) for c in repo_parts])
    rows = docs.select(
        row_key(docs).alias("key"), column(doc_id).alias("doc_id"), F.coalesce(column(owner).cast("string"), F.lit("")).alias("owner"), repo.alias("repo"),
        F.coalesce(column(text).cast("string"), F.lit("")).alias("text"),
    )
    found = materialise(spans(rows), "spans")
    owners = ownership(found)
    live = (F.col("owners") <= MAX_LIVE_OWNERS) & (F.col("repos") <= MAX_LIVE_REPOS)
    copied = (F.col("owners") >= MIN_COPIED_OWNERS) | (F.col("repos") >= MIN_COPIED_REPOS)
    rated = lookup_join(found, materialise(owners, "owners"), ["value"], "inner").withColumn("live", live).withColumn("copied", copied)
    span = F.struct("start", "kind", "stop")
    per_doc = rated.groupBy("key").agg(
        F.collect_list(F.when(F.col("kind") < 3, span)).alias("base"), F.collect_list(F.when((F.col("kind") == 3) & F.col("live"), span)).alias("more"),
        *[F.count_if(F.col("kind") == k).alias(f"n_{KINDS[k]}") for k in range(3)],
        F.count_if("live").alias("n_live"), F.count_if("copied").alias("n_copied"),
    )
    outside = F.filter("more", lambda m: ~F.exists("base", lambda b: (b["start"] < m["stop"]) & (m["start"] < b["stop"])))
    answers = per_doc.select("key", "n_assign", "n_access", "n_hex", _joined(F.col("base")).alias("base_spans"), _joined(F.concat("base", outside)).alias("spans"), "n_live", "n_copied")
    counts = ["n_assign", "n_access", "n_hex", "n_live", "n_copied"]
    out = rows.select("key", "doc_id").join(answers, "key", "left")
    return out.select(
        "doc_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts], *[F.coalesce(c, F.lit("")).alias(c) for c in ("base_spans", "spans")]
    )
