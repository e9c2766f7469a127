"""Attach roster rows to documents by address, and write the result into a struct column."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from loglattice.functions.ip import ip_to_long, to_ip
from loglattice.functions.scalars import full_name, parse_id_list
from loglattice.operators.lookup import lookup_join
from loglattice.session import BROADCAST_BYTES, fits_broadcast

DOC_KEY = ("_index", "_id")
IP_FIELDS = ("client_ip", "source_ip", "host_ip")
TIE_COLUMNS = ("last_name", "first_name", "department", "sub_department", "start_date")
HR_FIELDS = ("department", "sub_department", "start_date", "first_name", "last_name")


def one_person_per_ip(roster: DataFrame, tie_cols: Sequence[str] = TIE_COLUMNS) -> DataFrame:
    """The roster reduced to one row per valid address: lowest tie key wins."""
    candidate = F.struct(*tie_cols, *[c for c in HR_FIELDS if c not in tie_cols])
    best = (
        roster.select(to_ip("ip_address").alias("hr_ip"), candidate.alias("person"))
        .where(F.col("hr_ip").isNotNull())
        .groupBy("hr_ip")
        .agg(F.min("person").alias("person"))
    )
    return best.select("hr_ip", F.struct(*[F.col(f"person.{c}").alias(c) for c in HR_FIELDS]).alias("person"))


def _is_list(docs: DataFrame, column: str) -> bool:
    return isinstance(docs.schema[column].dataType, ArrayType)


def _use_broadcast(docs: DataFrame, ip_cols: Sequence[str], roster: DataFrame, strategy: str, max_bytes: int) -> bool:
    if any(_is_list(docs, c) for c in ip_cols):
        return False  # several addresses per field are legs of their own
    if strategy == "auto":
        return fits_broadcast(roster, max_bytes)
    return strategy == "broadcast"


def _hits(docs: DataFrame, people: DataFrame, ip_cols: Sequence[str]) -> DataFrame:
    """One broadcast look-up per address column; documents keep their place, nothing is shuffled."""
    for position, column in enumerate(ip_cols, 1):
        side = people.select(F.col("hr_ip").alias(f"__ip{position}"), F.col("person").alias(f"__person{position}"))
        docs = docs.join(F.broadcast(side), to_ip(column) == F.col(f"__ip{position}"), "left")
    return docs


def _drop_hits(docs: DataFrame, ip_cols: Sequence[str]) -> DataFrame:
    n = range(1, len(ip_cols) + 1)
    return docs.drop(*[f"__ip{i}" for i in n], *[f"__person{i}" for i in n])


#: The struct of a document's address fields. All that a look-up finds follows from it, so it is the look-up's key: equal or
#: missing document ids make no difference.
_ADDRESSES = "__addresses"


def _legs(docs: DataFrame, ip_cols: Sequence[str]) -> DataFrame:
    """Narrow (addresses, rank, address) rows, one per valid address of each distinct combination; a field may hold a list."""
    docs = docs.select(F.struct(*ip_cols).alias(_ADDRESSES)).distinct().select(_ADDRESSES, f"{_ADDRESSES}.*")

    def leg(rank: int) -> Callable[[Column], Column]:
        return lambda address: F.struct(F.lit(rank).alias("rank"), to_ip(address).alias("hr_ip"))

    lists = []
    for rank, column in enumerate(ip_cols, 1):
        if _is_list(docs, column):
            found = F.coalesce(F.col(column), F.array().cast("array<string>"))
            lists.append(F.transform(found, leg(rank)))
        else:
            lists.append(F.array(leg(rank)(F.col(column))))
    return docs.select(_ADDRESSES, F.inline(F.concat(*lists))).where(F.col("hr_ip").isNotNull())


def _placed(docs: DataFrame, ip_cols: Sequence[str], best: DataFrame) -> DataFrame:
    """The documents with what was found for their addresses; a combination that many of them share, or none at all, is split over tasks."""
    return lookup_join(docs.withColumn(_ADDRESSES, F.struct(*ip_cols)), best, [_ADDRESSES], "left", fits=False)


def ranked_lookup(
    docs: DataFrame,
    roster: DataFrame,
    ip_cols: Sequence[str] = IP_FIELDS,
    tie_cols: Sequence[str] = TIE_COLUMNS,
    doc_key: Sequence[str] = DOC_KEY,
    strategy: str = "auto",
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """All documents plus ``match_rank`` and ``person`` of the first address column that has a roster row.

    A roster whose measured size allows it is broadcast and probed once per column. Beyond that the narrow legs go
    through ``lookup_join`` and are reduced per document, and only then meet the wide documents again.
    """
    people = one_person_per_ip(roster, tie_cols)
    if _use_broadcast(docs, ip_cols, roster, strategy, max_bytes):
        found = _hits(docs, people, ip_cols)
        n = range(1, len(ip_cols) + 1)
        rank = F.coalesce(*[F.when(F.col(f"__ip{i}").isNotNull(), F.lit(i)) for i in n])
        person = F.coalesce(*[F.col(f"__person{i}") for i in n])
        return _drop_hits(found.withColumns({"match_rank": rank, "person": person}), ip_cols)
    best = (
        lookup_join(_legs(docs, ip_cols), people, ["hr_ip"], "inner", fits=False)
        .groupBy(_ADDRESSES)
        .agg(F.min(F.struct("rank", "person")).alias("best"))
        .select(_ADDRESSES, F.col("best.rank").alias("match_rank"), F.col("best.person").alias("person"))
    )
    return _placed(docs, ip_cols, best).select(*docs.columns, "match_rank", "person")


def any_match(
    docs: DataFrame,
    roster: DataFrame,
    start: datetime | None,
    end: datetime | None,
    as_of: datetime,
    ip_cols: Sequence[str] = ("source_ip", "client_ip", "host_ip"),
    tie_cols: Sequence[str] = TIE_COLUMNS,
    doc_key: Sequence[str] = DOC_KEY,
    ts: str = "event_ts",
    strategy: str = "auto",
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """All documents plus ``hr``, set where any address column has a roster row and the time is in range.

    Several employees may match one document; the lowest address wins. The bounds are inclusive and default to the
    24 hours before ``as_of``.
    """
    start, end = start or as_of - timedelta(hours=24), end or as_of
    people = one_person_per_ip(roster, tie_cols).select(
        "hr_ip", F.struct(ip_to_long("hr_ip").alias("ip_num"), "hr_ip", "person").alias("person")
    )
    inside = F.col(ts).between(F.lit(start), F.lit(end))
    if _use_broadcast(docs, ip_cols, roster, strategy, max_bytes):
        found = _hits(docs, people, ip_cols)
        persons = [F.col(f"__person{i}") for i in range(1, len(ip_cols) + 1)]
        best = F.least(*persons) if len(persons) > 1 else persons[0]
        out = _drop_hits(found.withColumn("__best", F.when(inside, best)), ip_cols)
    else:
        best = (
            lookup_join(_legs(docs.where(inside), ip_cols), people, ["hr_ip"], "inner", fits=False)
            .groupBy(_ADDRESSES)
            .agg(F.min("person").alias("__found"))
        )
        out = _placed(docs, ip_cols, best).select(*docs.columns, F.when(inside, F.col("__found")).alias("__best"))
    person = F.col("__best.person")
    hr = F.struct(
        F.col("__best.hr_ip").alias("ip_address"),
        person["first_name"].alias("first_name"),
        person["last_name"].alias("last_name"),
        full_name(person["first_name"], person["last_name"]).alias("full_name"),
        person["department"].alias("department"),
        person["sub_department"].alias("sub_department"),
        person["start_date"].alias("start_date"),
        F.lit(as_of).cast("timestamp").alias("enriched_at"),
    )
    return out.withColumn("hr", F.when(F.col("__best").isNotNull(), hr)).drop("__best")


def enriched_struct(person: Column, null_as_empty: bool = False) -> Column:
    """The five keys written to ``enriched``; null when there is no person."""

    def text(name: str) -> Column:
        return F.coalesce(person[name], F.lit("")) if null_as_empty else person[name]

    names = {
        "department": "department",
        "sub_department": "sub_department",
        "start_date": "start_date",
        "first_name": "first_name",
        "last_name": "last_name",
    }
    return F.when(person.isNotNull(), F.struct(*[text(src).alias(dst) for src, dst in names.items()]))


def merge_struct(docs: DataFrame, field: str, update: Column, keys: Sequence[str] = HR_FIELDS) -> DataFrame:
    """Partial update: set the keys of ``update`` inside ``field`` and leave its other keys alone."""
    if field not in docs.columns:
        return docs.withColumn(field, update)
    old = F.col(field)
    kept = [f.name for f in docs.schema[field].dataType.fields]
    merged = F.struct(
        *[old[name].alias(name) for name in kept if name not in keys], *[update[name].alias(name) for name in keys]
    )
    untouched = F.struct(
        *[old[name].alias(name) for name in kept if name not in keys],
        *[(old[name] if name in kept else F.lit(None).cast("string")).alias(name) for name in keys],
    )
    return docs.withColumn(
        field, F.when(update.isNotNull(), merged).when(old.isNotNull(), untouched)
    )


def replace_struct(docs: DataFrame, field: str, update: Column, keys: Sequence[str] = HR_FIELDS) -> DataFrame:
    """Whole-object update: matched documents keep nothing of the old ``field``."""
    if field not in docs.columns:
        return docs.withColumn(field, update)
    old = F.col(field)
    kept = [f for f in docs.schema[field].dataType.fields]
    names = [f.name for f in kept]
    fresh = F.struct(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in kept if f.name not in keys],
        *[update[name].alias(name) for name in keys],
    )
    untouched = F.struct(
        *[old[f.name].alias(f.name) for f in kept if f.name not in keys],
        *[(old[name] if name in names else F.lit(None).cast("string")).alias(name) for name in keys],
    )
    return docs.withColumn(field, F.when(update.isNotNull(), fresh).when(old.isNotNull(), untouched))


def update_by_id(
    docs: DataFrame, updates: DataFrame, field: str, mode: str = "merge", doc_key: Sequence[str] = DOC_KEY,
    order: str | None = None,
) -> DataFrame:
    """Apply (document key, ``update`` struct) rows; documents without a row stay untouched.

    Of several updates for one key the last by ``order`` counts, or the greatest struct where no order is given.
    """
    names = [f.name for f in updates.schema["update"].dataType.fields]
    last = F.max("update") if order is None else F.max_by("update", F.struct(order, "update"))
    latest = updates.groupBy(*doc_key).agg(last.alias("__update"))
    joined = docs.join(latest, list(doc_key), "left")
    apply = merge_struct if mode == "merge" else replace_struct
    out = apply(joined, field, F.col("__update"), names).drop("__update")
    columns = docs.columns if field in docs.columns else [*docs.columns, field]
    return out.select(*columns)


def id_frame(spark, text: str) -> DataFrame:
    """Ids from comma-separated text."""
    return spark.range(1).select(F.explode(parse_id_list(F.lit(text))).alias("_id"))


def select_docs(
    docs: DataFrame,
    ids: DataFrame | None = None,
    documents: DataFrame | None = None,
    alerts: DataFrame | None = None,
    max_docs: int | None = None,
) -> DataFrame:
    """Documents whose ``_id`` is listed; explicit ids come before documents, documents before alerts.

    ``max_docs`` is a guard, not a cut: more selected documents raise an error.
    """
    chosen = next((c for c in (ids, documents, alerts) if c is not None), None)
    if chosen is None:
        raise ValueError("give ids, documents or alerts")
    picked = docs.join(chosen.select("_id"), "_id", "left_semi").select(*docs.columns)
    if max_docs is not None and picked.select("_id").limit(max_docs + 1).count() > max_docs:
        raise ValueError(f"more than {max_docs} documents selected")
    return picked


def enrich_logs(docs: DataFrame, roster: DataFrame, **options) -> DataFrame:
    """Ranked look-up merged into ``enriched``."""
    found = ranked_lookup(docs, roster, **options)
    return merge_struct(found, "enriched", enriched_struct(F.col("person"))).drop("person")


def enrich_alerts(docs: DataFrame, roster: DataFrame, **options) -> DataFrame:
    """Ranked look-up replacing ``enriched``."""
    found = ranked_lookup(docs, roster, **options)
    return replace_struct(found, "enriched", enriched_struct(F.col("person"))).drop("person")


def untouched_docs(docs: DataFrame, roster: DataFrame, **options) -> DataFrame:
    """Documents no roster row matches."""
    return ranked_lookup(docs, roster, **options).where(F.col("match_rank").isNull()).drop("match_rank", "person")
