"""MinHash near-dedup with SetSketch registers.

A document is the set of its distinct shingles of lower-cased words. Register i of its sketch is the minimum of exponentially distributed hashes
of the shingles, cut down to the whole power of ``BASE`` that it reaches and truncated to one byte: the maximum over the parts of a set is the
register of the whole, and two sets have equal registers little more often than their similarity says. Registers are banded, ``ROWS`` to a key; sets
that share a key are candidates. The numbers of greater, equal and smaller registers of a candidate pair, with the exact sizes of its sets, give
the most likely similarity; pairs ``SIGMAS`` standard errors below the bound are dismissed, all others confirmed on the full sets.

The number of bands follows from the bound: a pair at it shares no key with a chance below ``MISS``. Equal sets are one node, so copies cost one
row, however many. Within a key's cell of at most ``SMALL`` nodes all pairs are candidates. In a larger cell every node first meets one head, the
node whose keys are the most common ones, which is the text that the others were copied from, if there is one. Where a cell then still holds
several components, some nodes outside its largest one become heads, and then all that are outside it still, so that each of them has met every
node of another component. Pairs are left out if their sizes rule a link out, or an exact bound on what they
can have in common: the shingles that both share with the head of most of their cells, and those outside of it that each shares with any node. So no candidate
pair stays unexamined unless its two nodes are connected already.

A text of fewer words than a shingle is one shingle; null, empty and word-free texts have an empty set and are linked with nothing. Component
ids are the smallest non-null ids reachable; null ids take part and are ``kept`` where nothing else is reachable. Repeated rows share a component.
Columns with clashing names and empty tables are fine.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loglattice.llm.common import Words, chunks, column, materialise, row_key, sent_if_small
from loglattice.llm.components import components
from loglattice.session import fits_broadcast

#: Words of a shingle, and the least similarity of a link in percent.
SHINGLE, PERCENT = 5, 85
#: SetSketch: base of the register scale, and rate of the hashes, so that even one shingle is rarely truncated.
BASE, RATE = 1.1, 20.0
ROWS, MISS, SIGMAS = 5, 1e-6, 5
#: Nodes of a cell that are compared pair by pair; more have heads.
SMALL = 16
#: Heads of a large cell in its second round; in the third, all nodes that are still outside its largest component are heads.
HEADS = 32
_BROADCAST = 64 << 20
#: So few pairs, in bytes of text, that what is known of their nodes is sent to every task.
_FEW = 512 << 10

_ODD = np.random.default_rng(23).integers(1, 2**63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def bands_for(percent: int, rows: int = ROWS, miss: float = MISS) -> int:
    """Fewest bands of which a pair at the bound shares none with a chance of at most ``miss``."""
    return max(1, math.ceil(math.log(miss) / math.log1p(-((percent / 100) ** rows)))) if percent < 100 else 1


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Rising hashes of the distinct shingles of each text, text after text, and their number per text."""
    w = Words(texts)
    lowered = pc.ascii_lower(w.vocabulary).to_pylist()
    hashed = np.array([xxhash.xxh64_intdigest(x.encode("utf-8", "surrogatepass")) for x in lowered], np.uint64)
    words = np.concatenate([hashed[w.codes] if len(w.codes) else np.zeros(0, np.uint64), np.zeros(size, np.uint64)])
    counts = np.where(w.sizes >= size, w.sizes - size + 1, np.minimum(w.sizes, 1))
    row = np.repeat(np.arange(len(counts)), counts)
    at = np.arange(counts.sum()) + np.repeat(w.starts[:-1] - (np.cumsum(counts) - counts), counts)
    left = np.repeat(w.starts[1:], counts) - at
    sums = np.minimum(left, size).astype(np.uint64)
    for j in range(size):
        sums += np.where(left > j, words[at + j], np.uint64(0)) * _ODD[j]
    hashes = mix(sums)
    order = np.lexsort((hashes, row))
    hashes, row = hashes[order], row[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
    return hashes[fresh], np.bincount(row[fresh], minlength=len(counts))


def registers(hashes: np.ndarray, counts: np.ndarray, number: int) -> np.ndarray:
    """``number`` registers of each non-empty set."""
    starts = (np.cumsum(counts) - counts)[counts > 0]
    out = np.zeros((len(starts), number), np.uint8)
    for i in range(number if len(starts) else 0):
        least = np.minimum.reduceat(hashes * _ODD[16 + i], starts)
        exponential = -np.log1p(-(least.astype(np.float64) + 0.5) * 2.0**-64).clip(None, 50.0)
        out[:, i] = np.clip(np.floor(1 + np.log(RATE / np.maximum(exponential, 1e-300)) / math.log(BASE)), 0, 255)
    return out


def merged(*sketches: np.ndarray) -> np.ndarray:
    """The registers of the union of sets."""
    return np.maximum.reduce(sketches)


def band_keys(sketch: np.ndarray, bands: int, rows: int = ROWS) -> np.ndarray:
    keys = np.zeros((len(sketch), bands), np.uint64)
    for b in range(bands):
        for r in range(rows):
            keys[:, b] += (sketch[:, b * rows + r].astype(np.uint64) + np.uint64(1)) * _ODD[-1 - r]
        keys[:, b] = mix(keys[:, b] + _ODD[-32 - b])
    return keys


def likely_similarity(greater: np.ndarray, smaller: np.ndarray, number: int, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Maximum-likelihood similarity from how many of a's registers are greater and smaller than b's, and the sets' sizes."""
    u = n_a / (n_a + n_b)
    v = 1 - u
    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)

    def reach(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.maximum(x, 0) * (BASE - 1) / BASE) / math.log(BASE)

    def likelihood(j: np.ndarray) -> np.ndarray:
        up, down = reach(u - v * j), reach(v - u * j)
        logs = [np.log(np.maximum(x, 1e-12)) for x in (up, down, 1 - up - down)]
        return greater * logs[0] + smaller * logs[1] + (number - greater - smaller) * logs[2]

    for _ in range(40):  # the likelihood has one maximum
        third = (high - low) / 3
        right = likelihood(low + third) < likelihood(high - third)
        low, high = np.where(right, low + third, low), np.where(right, high, high - third)
    return (low + high) / 2


def dismissal(percent: int, number: int) -> float:
    bound = percent / 100
    return bound - SIGMAS * math.sqrt(bound * (1 - bound) / number)


def _totals(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


def with_sketches(rows: DataFrame, percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """``rows(key, doc_id, text)`` to ``key, doc_id, n, fp, sketch, bands``; fp names the set, and is null with sketch and bands for an empty one."""
    bands = bands_for(percent)
    schema = T.StructType([
        *rows.schema.fields[:2], T.StructField("n", T.LongType()), T.StructField("fp", T.BinaryType()), T.StructField("sketch", T.BinaryType()),
        T.StructField("bands", T.ArrayType(T.LongType())),
    ])

    def fixed(values: np.ndarray, full: np.ndarray) -> pa.Array:
        width = values.dtype.itemsize * values.shape[1]
        packed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(values), [None, pa.py_buffer(np.ascontiguousarray(values).tobytes())]).cast(pa.binary())
        return packed.take(pa.array(np.cumsum(full) - 1, mask=~full))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).cast(pa.large_string())
            for start, stop in chunks(texts):
                hashes, counts = shingle_sets(texts.slice(start, stop - start), size)
                full = counts > 0
                prints = np.column_stack([_totals(hashes, counts), _totals(mix(hashes + np.uint64(1)), counts)])[full]
                sketch = registers(hashes, counts, bands * ROWS)
                keys = band_keys(sketch, bands)
                offsets = pa.array(np.concatenate([[0], np.cumsum(full * bands)]).astype(np.int32))
                part = batch.slice(start, stop - start)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(counts.astype(np.int64)), fixed(prints, full), fixed(sketch, full),
                     pa.ListArray.from_arrays(offsets, pa.array(keys.ravel().view(np.int64)))],
                    names=schema.names,
                )

    return rows.mapInArrow(run, schema)


def _sets(texts: DataFrame, size: int) -> DataFrame:
    """``texts(fp, text)`` to ``fp, shingles``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column_ = batch.column(1).cast(pa.large_string())
            for start, stop in chunks(column_):
                hashes, counts = shingle_sets(column_.slice(start, stop - start), size)
                offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
                lists = pa.ListArray.from_arrays(offsets, pa.array(hashes.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, stop - start), lists], names=["fp", "shingles"])

    return texts.mapInArrow(run, "fp binary, shingles array<bigint>")


def likely_pairs(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The written ``pairs(a, b)`` whose most likely similarity does not rule them out."""
    number = bands_for(percent) * ROWS
    bound = dismissal(percent, number)
    left = nodes.select(F.col("fp").alias("a"), F.col("sketch").alias("x"), F.col("n").alias("n_a"))
    right = nodes.select(F.col("fp").alias("b"), F.col("sketch").alias("y"), F.col("n").alias("n_b"))
    if fits_broadcast(pairs, _FEW):
        left, right = (F.broadcast(side.join(F.broadcast(pairs.select(end)), end, "left_semi")) for side, end in ((left, "a"), (right, "b")))
    known = pairs.join(left, "a").join(right, "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(name).to_pylist()), np.uint8).reshape(-1, number) for name in ("x", "y"))
            n_a, n_b = (batch.column(name).to_numpy(zero_copy_only=False).astype(np.float64) for name in ("n_a", "n_b"))
            likely = likely_similarity((x > y).sum(axis=1), (x < y).sum(axis=1), number, n_a, n_b) >= bound
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(likely))

    return known.select("a", "b", "x", "y", "n_a", "n_b").mapInArrow(run, "a binary, b binary")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The written ``pairs(a, b)`` that reach the bound on their full sets ``sets(fp, shingles)``."""
    left, right = sets.select(F.col("fp").alias("a"), F.col("shingles").alias("x")), sets.select(F.col("fp").alias("b"), F.col("shingles").alias("y"))
    both = sent_if_small(pairs, _FEW).join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("x", "y")).cast("long")
    either = F.size("x") + F.size("y") - common
    return both.where(100 * common >= percent * either).select("a", "b")


class _Examiner:
    """Candidate pairs to links; full sets are read once per node that some likely pair needs."""

    def __init__(self, nodes: DataFrame, texts: DataFrame, percent: int, size: int):
        self.nodes, self.texts, self.percent, self.size = nodes, texts, percent, size
        self.sets: DataFrame | None = None

    def sets_of(self, ends: DataFrame) -> DataFrame:
        """``(fp, shingles)`` of the nodes among the written ``ends(fp)``, which may repeat, and no others."""
        fresh = ends if self.sets is None else ends.join(sent_if_small(self.sets.select("fp")), "fp", "left_anti")
        wanted = materialise(self.nodes.select("fp", "key").join(sent_if_small(fresh), "fp", "left_semi"), "wanted")
        if not wanted.isEmpty():
            wanted = F.broadcast(wanted) if fits_broadcast(wanted, _BROADCAST) else wanted
            found = _sets(self.texts.join(wanted, "key").select("fp", "text"), self.size).groupBy("fp").agg(F.first("shingles").alias("shingles"))
            found = materialise(found, "shingle-sets")
            self.sets = found if self.sets is None else self.sets.unionByName(found)
        if self.sets is None:
            self.sets = ends.select("fp", F.array().cast("array<bigint>").alias("shingles"))
        return self.sets.join(sent_if_small(ends), "fp", "left_semi")

    def links(self, pairs: DataFrame) -> DataFrame:
        """The confirmed links of the written ``pairs(a, b)``."""
        if pairs.isEmpty():
            return pairs
        likely = materialise(likely_pairs(pairs, self.nodes, self.percent), "likely")
        if likely.isEmpty():
            return likely
        ends = likely.select(F.explode(F.array("a", "b")).alias("fp"))
        return materialise(confirmed(likely, self.sets_of(ends), self.percent), "confirmed")

    def overlap_facts(self, pivots: DataFrame) -> DataFrame:
        """``(fp, pivot, shared, inside, bits)`` of the written ``pivots(fp, pivot)``, from their full sets; every pivot has a row of its own.

        ``shared`` counts the shingles that another of these nodes has as well, ``bits`` marks which shingles of the pivot the node has, 62 to a
        word, and ``inside`` counts them.
        """
        numbered = materialise(self.sets_of(pivots.select("fp")).withColumn("no", F.monotonically_increasing_id()), "numbered-sets")
        tokens = numbered.select("no", F.explode("shingles").alias("token")).groupBy("token").agg(F.count("*").alias("n"), F.min("no").alias("no"))
        alone = tokens.where("n = 1").groupBy("no").agg(F.count("*").alias("alone"))
        of_pivots = numbered.join(sent_if_small(pivots.select(F.col("pivot").alias("fp"))), "fp", "left_semi").select(F.col("fp").alias("pivot"), F.posexplode("shingles").alias("at", "token"))
        placed = numbered.join(sent_if_small(pivots), "fp")
        own = placed.select("no", "pivot", F.explode("shingles").alias("token"))
        word = F.floor(F.col("at") / 62).cast("int").alias("word")
        words = own.join(sent_if_small(of_pivots), ["pivot", "token"]).groupBy("no", word).agg(F.sum(F.expr("shiftleft(1L, at % 62)")).alias("bits"), F.count("*").alias("inside"))
        marked = words.groupBy("no").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("marks"), F.max("word").alias("last"), F.sum("inside").alias("inside"))
        bits = F.transform(F.sequence(F.lit(0), F.col("last")), lambda w: F.coalesce(F.try_element_at("marks", w), F.lit(0).cast("long")))
        facts = placed.select("fp", "pivot", "no", F.size("shingles").alias("size")).join(alone, "no", "left").join(marked, "no", "left")
        return facts.select(
            "fp", "pivot", (F.col("size") - F.coalesce("alone", F.lit(0))).alias("shared"), F.coalesce("inside", F.lit(0)).alias("inside"), bits.alias("bits")
        )


def _sized(percent: int, a: str, b: str) -> Column:
    """Sets of such sizes may reach the bound at all."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _bounded(percent: int) -> Column:
    """Whether two sets can reach the bound with no more in common than is possible.

    That is what each shares with anyone; or, if they have a pivot in common, the part of it that both have, counted exactly, and what each shares
    outside of it.
    """
    both = F.zip_with("bits_a", "bits_b", lambda x, y: F.bit_count(F.coalesce(x, F.lit(0).cast("long")).bitwiseAND(F.coalesce(y, F.lit(0).cast("long")))))
    within = F.coalesce(F.aggregate(both, F.lit(0), lambda x, y: x + y), F.lit(0))
    outside = F.least(F.col("shared_a") - F.col("inside_a"), F.col("shared_b") - F.col("inside_b"))
    most = F.when(F.col("pivot_a") == F.col("pivot_b"), within + outside).otherwise(F.least("shared_a", "shared_b"))
    return 100 * most >= percent * (F.col("n_a") + F.col("n_b") - most)


def _ordered(pairs: DataFrame, *more: str) -> DataFrame:
    out = pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), *more)
    return materialise(out.dropDuplicates(["a", "b"]), "pairs")


def _renamed_roots(rows: DataFrame, merges: DataFrame) -> DataFrame:
    """``rows`` with their ``root`` after ``merges(root, now)``."""
    return materialise(rows.join(merges, "root", "left").withColumn("root", F.coalesce("now", "root")).drop("now"), "roots")


def roots_of(nodes: DataFrame, texts: DataFrame, percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """``(fp, least, root)``: the smallest node of each one's component, for ``nodes(fp, least, key, n, sketch, bands)``; ``texts(key, text)`` has every key's text."""
    examine = _Examiner(nodes, texts, percent, size)
    cells = nodes.select("fp", "n", F.explode("bands").alias("cell"))
    shared = materialise(cells.groupBy("cell").agg(F.count("*").alias("crowd")).where("crowd > 1"), "cells")
    members = materialise(cells.join(sent_if_small(shared), "cell"), "members")
    small = members.where(F.col("crowd") <= SMALL)
    left, right = small.select("cell", F.col("fp").alias("a"), F.col("n").alias("n_a")), small.select("cell", F.col("fp").alias("b"), F.col("n").alias("n_b"))
    pairs = left.join(right, "cell").where("a < b").where(_sized(percent, "n_a", "n_b")).select("a", "b")

    scores = members.groupBy("fp").agg(F.sum("crowd").alias("score"), F.max("crowd").alias("most")).where(F.col("most") > SMALL)
    scores = materialise(scores.select("fp", "score"), "scores")
    crowded = materialise(members.where(F.col("crowd") > SMALL).join(sent_if_small(scores), "fp"), "crowded")
    heads = crowded.groupBy("cell").agg(F.max(F.struct("score", "fp", "n")).alias("h"))
    heads = materialise(heads.select("cell", F.col("h.fp").alias("head"), F.col("h.n").alias("n_head")), "heads")
    heading = sent_if_small(heads)
    met = crowded.join(heading, "cell").where(_sized(percent, "n", "n_head"))
    found = examine.links(_ordered(pairs.unionByName(met.select(F.col("head").alias("a"), F.col("fp").alias("b")))))

    known = sent_if_small(components(found).withColumnRenamed("node", "fp"))
    rooted, crowded = (
        materialise(rows.join(known, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "roots") for rows in (nodes.select("fp", "least"), crowded.select("cell", "fp", "n"))
    )
    crowded = _open_cells(crowded)
    if crowded.isEmpty():
        return rooted
    led = crowded.join(heading.select("cell", "head"), "cell").select("fp", "head")
    sizes = materialise(led.groupBy("head").agg(F.count("*").alias("led")), "led")
    pivots = led.join(sent_if_small(sizes), "head").groupBy("fp").agg(F.max(F.struct("led", "head")).alias("most"))
    facts = materialise(examine.overlap_facts(materialise(pivots.select("fp", F.col("most.head").alias("pivot")), "pivots")), "overlap-facts")
    crowded = materialise(crowded.join(sent_if_small(facts), "fp").where(100 * F.col("shared") >= percent * F.col("n")), "open-members")
    done = heads.select("cell", F.col("head").alias("fp"))
    left = _open_cells(crowded)
    for number in itertools.chain([HEADS], itertools.repeat(None)):
        heads = _next_heads(left, done, number)
        if heads.isEmpty():
            return rooted
        own = ("fp", "n", "root", "pivot", "shared", "inside", "bits")
        first, others = (rows.select("cell", *[F.col(c).alias("ab"[i] if c == "fp" else f"{c}_{'ab'[i]}") for c in own]) for i, rows in enumerate((heads, left)))
        met = others.join(sent_if_small(first), "cell").where("root_a <> root_b").where(_sized(percent, "n_a", "n_b") & _bounded(percent))
        pairs = _ordered(met, "root_a", "root_b")
        found = examine.links(pairs.select("a", "b"))
        if not found.isEmpty():
            merges = components(pairs.join(sent_if_small(found), ["a", "b"]).select(F.col("root_a").alias("a"), F.col("root_b").alias("b")))
            merges = sent_if_small(merges.select(F.col("node").alias("root"), F.col("root").alias("now")))
            rooted, crowded = (_renamed_roots(rows, merges) for rows in (rooted, crowded))
            left = _open_cells(crowded)
        elif number is None:  # all nodes outside the largest components have been heads
            return rooted
        done = done.unionByName(heads.select("cell", "fp"))
    raise AssertionError("unreachable")


def _open_cells(crowded: DataFrame) -> DataFrame:
    """The members of cells with several components, with the largest one's root as ``main`` and the number of nodes ``outside`` it."""
    sizes = crowded.groupBy("cell", "root").agg(F.count("*").alias("n"))
    main = sizes.groupBy("cell").agg(F.max(F.struct("n", "root")).alias("main"), F.sum("n").alias("total"))
    main = main.where(F.col("total") > F.col("main.n")).select("cell", F.col("main.root").alias("main"), (F.col("total") - F.col("main.n")).alias("outside"))
    return materialise(crowded.drop("main", "outside").join(sent_if_small(materialise(main, "open-cells")), "cell"), "open-members")


def _next_heads(left: DataFrame, done: DataFrame, number: int | None) -> DataFrame:
    """About ``number`` more heads of each open cell, or all, among the nodes outside its largest component."""
    fresh = left.where("root <> main").join(sent_if_small(done), ["cell", "fp"], "left_anti")
    if number is not None:
        fresh = fresh.where(F.pmod(F.xxhash64("fp"), F.lit(1 << 30)) / F.lit(float(1 << 30)) * F.col("outside") <= F.lit(number))
    return materialise(fresh, "next-heads")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` per row."""
    slim = docs.select(column(doc_id).alias("doc_id"), column(text).cast("string").alias("text"))
    slim = slim.select(row_key(slim).alias("key"), "doc_id", "text")
    prints = materialise(with_sketches(slim, percent, size), "sketches")
    firsts = [F.min_by(c, "key").alias(c) for c in ("key", "n", "sketch", "bands")]
    nodes = materialise(prints.where("fp is not null").groupBy("fp").agg(F.min("doc_id").alias("least"), *firsts), "nodes")
    rooted = roots_of(nodes, slim.select("key", "text"), percent, size)
    lowest = rooted.groupBy("root").agg(F.min("least").alias("lowest"), F.count("*").alias("nodes")).where("nodes > 1").drop("nodes")
    lowest = sent_if_small(materialise(lowest, "components"))
    classes = rooted.join(lowest, "root", "left").select("fp", F.coalesce("lowest", "least").alias("component_id"))
    with_set = prints.where("fp is not null").join(classes, "fp").select("doc_id", "n", "component_id")
    without = prints.where("fp is null").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return with_set.unionByName(without).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )
