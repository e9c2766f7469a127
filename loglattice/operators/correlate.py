"""Union-then-group correlation of several datasets by one key.

Each dataset is aggregated on its own first, with the columns it lacks filled by null, and only the per-key partial
results are united and merged. The row counts are the same as grouping the united rows, yet the wide value sets are
never built over log rows that cannot hold them, and a busy key reaches the shuffle as one row per map task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglattice.functions.ip import to_ip
from loglattice.functions.scalars import case

ROSTER_ATTRIBUTES = ("first_name", "last_name", "department", "sub_department", "start_date")


def correlate(
    datasets: Sequence[DataFrame],
    key: str,
    tags: Sequence[tuple[str, Column]],
    counts: Mapping[str, Sequence[str] | None],
    values: Mapping[str, str],
    having: Column | None = None,
) -> DataFrame:
    """Correlate ``datasets`` by ``key``: one row per kept key.

    ``tags``    ordered (label, predicate); the first true one names the row, else ``Other``.
    ``counts``  output name to the labels it counts; ``None`` counts every row.
    ``values``  output name to the column whose distinct values are listed (attributes with few values per key).
    ``having``  kept groups; by default every count must be above zero.

    Columns with one value per document are not listed; ``documents_of`` gives them as rows.
    """
    schemas = [d.schema for d in datasets]
    types = {f.name: f.dataType for schema in reversed(schemas) for f in schema.fields}
    columns = list(dict.fromkeys([key, *(c for schema in schemas for c in schema.names)]))
    label = case([(predicate, F.lit(name)) for name, predicate in tags], F.lit("Other"))

    partials = []
    for data, schema in zip(datasets, schemas):
        held = set(schema.names)
        filled = data.select(
            *[F.col(c) if c in held else F.lit(None).cast(types[c]).alias(c) for c in columns]
        ).withColumn("data_type", label)
        aggs = [
            F.count_if(F.col("data_type").isin(*labels) if labels is not None else F.col("data_type").isNotNull())
            .alias(name)
            for name, labels in counts.items()
        ]
        aggs += [
            (F.collect_set(column) if column in held else F.lit(None).cast("array<string>")).alias(name)
            for name, column in values.items()
        ]
        partials.append(filled.groupBy(key).agg(*aggs))

    united = reduce(DataFrame.unionByName, partials)
    merged = united.groupBy(key).agg(
        *[F.sum(name).alias(name) for name in counts],
        *[F.array_sort(F.array_distinct(F.flatten(F.collect_list(name)))).alias(name) for name in values],
    )
    if having is None:
        having = reduce(Column.__and__, [F.col(name) > 0 for name in counts])
    return merged.where(having).select(
        key, *counts, *[F.when(F.size(name) > 0, F.col(name)).alias(name) for name in values]
    )


def documents_of(groups: DataFrame, documents: DataFrame, key: str = "client_ip", doc_id: str = "_id") -> DataFrame:
    """``(key, doc_id)`` of the documents of the kept ``groups``, one row per distinct id however many there are."""
    rows = documents.where(F.col(doc_id).isNotNull()).select(key, doc_id)
    return rows.join(groups.select(key), key, "left_semi").distinct()


def roster_by_ip(roster: DataFrame) -> DataFrame:
    """Roster rows keyed by the canonical client address."""
    return roster.where(F.col("ip_address").isNotNull()).select(
        to_ip("ip_address").alias("client_ip"), *ROSTER_ATTRIBUTES
    )


def _keyed(roster: DataFrame) -> DataFrame:
    # A group needs a log row with a non-null address, so invalid roster addresses cannot survive.
    return roster_by_ip(roster).where(F.col("client_ip").isNotNull())


def _with_client(logs: DataFrame, *columns: str) -> DataFrame:
    return logs.where(F.col("client_ip").isNotNull()).select("client_ip", *columns)


def _hr_tag() -> tuple[str, Column]:
    return "HR", F.col("department").isNotNull()


def _module_tags() -> list[tuple[str, Column]]:
    # Event module to dataset label.
    labels = {
        "network_traffic": "Netflow",
        "proxysg": "Proxy",
        "email": "Email",
        "ti_abusech": "Threat-Intel",
        "system": "Windows",
    }
    return [(label, F.col("event_module") == module) for module, label in labels.items()]


def _document_tags() -> list[tuple[str, Column]]:
    return [
        ("Dataset", F.col("event_module").isNotNull()),
        ("Doc_ID", F.col("_id").isNotNull()),
        ("Index", F.col("_index").isNotNull()),
        _hr_tag(),
    ]


def netflow_roster(logs: DataFrame, roster: DataFrame) -> DataFrame:
    """Flow records per address that also belong to an employee; other modules do not count."""
    return correlate(
        [_with_client(logs, "event_module"), _keyed(roster)],
        "client_ip",
        [_module_tags()[0], _hr_tag()],
        {"log_events": ["Netflow"], "hr_matches": ["HR"]},
        {c: c for c in ("first_name", "department", "sub_department", "start_date")},
    )


def five_module_roster(logs: DataFrame, roster: DataFrame, ip: str | None = None) -> DataFrame:
    """Events of the five known modules per employee address, optionally for one address only."""
    tags = _module_tags()
    out = correlate(
        [_with_client(logs, "event_module"), _keyed(roster)],
        "client_ip",
        [*tags, _hr_tag()],
        {"log_events": [label for label, _ in tags], "hr_matches": ["HR"]},
        {c: c for c in ROSTER_ATTRIBUTES},
    )
    return out if ip is None else out.where(F.col("client_ip") == ip)


def document_roster(logs: DataFrame, roster: DataFrame) -> DataFrame:
    """Per employee address: datasets and indices; only rows with a module are counted."""
    return correlate(
        [_with_client(logs, "event_module", "_id", "_index"), _keyed(roster)],
        "client_ip",
        _document_tags(),
        {"log_events": ["Dataset"], "hr_matches": ["HR"]},
        {**{c: c for c in ROSTER_ATTRIBUTES}, "dataset": "event_module", "index": "_index"},
    )


def _roster_text_match(roster: DataFrame, ip: str) -> DataFrame:
    # The roster side compares raw text; only afterwards is the text read as an address.
    return roster_by_ip(roster.where(F.col("ip_address") == ip))


def lookup_exact(logs: DataFrame, roster: DataFrame, ip: str) -> DataFrame:
    """One address: every row counts as an event, roster rows included."""
    return correlate(
        [
            logs.where(F.col("client_ip") == to_ip(F.lit(ip))).select("client_ip", "event_module", "_id", "_index"),
            _roster_text_match(roster, ip),
        ],
        "client_ip",
        [("Datasets", F.col("event_module").isNotNull()), _hr_tag()],
        {"log_events": None, "hr_matches": ["HR"]},
        {**{c: c for c in ROSTER_ATTRIBUTES}, "index": "_index"},
    )


_ADDRESS_FIELDS = ("client_ip", "host_ip", "destination_ip", "source_ip")


def _any_field(logs: DataFrame, ip: str) -> DataFrame:
    return logs.where(to_ip(F.lit(ip)).isin(*[F.col(c) for c in _ADDRESS_FIELDS]))


def lookup_v5_exact(logs: DataFrame, roster: DataFrame, ip: str) -> DataFrame:
    """Logs are matched on any of four address fields but grouped by client address.

    A log matched through another field therefore lands in a group without a roster row and is dropped.
    """
    return correlate(
        [_any_field(logs, ip).select("client_ip", "event_module", "_id", "_index"), _roster_text_match(roster, ip)],
        "client_ip",
        _document_tags(),
        {"log_events": None, "hr_matches": ["HR"]},
        {**{c: c for c in ROSTER_ATTRIBUTES}, "dataset": "event_module", "index": "_index"},
    )


def documents_at(logs: DataFrame, ip: str) -> DataFrame:
    """Documents with the address in any of four fields, keyed by the address itself."""
    return _any_field(logs, ip).select(to_ip(F.lit(ip)).alias("client_ip"), "event_module", "_id", "_index")


def lookup_any_ip(logs: DataFrame, roster: DataFrame, ip: str) -> DataFrame:
    """As ``lookup_v5_exact`` but grouped by the requested address, so all four fields count."""
    return correlate(
        [documents_at(logs, ip), _roster_text_match(roster, ip)],
        "client_ip",
        _document_tags(),
        {"log_events": None, "hr_matches": ["HR"]},
        {**{c: c for c in ROSTER_ATTRIBUTES}, "dataset": "event_module", "index": "_index"},
    )
