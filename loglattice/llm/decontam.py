"""Benchmark decontamination by templates.

Words are canonicalised: lower case, outer punctuation gone, units glued to numbers split off. Runs of numbers, of a number with its units,
and of names become one typed placeholder each, so a value of other length fills the same slot. Windows of canonical words are hashed and
matched against the benchmark's windows: ``WINDOW`` words, or ``SHORT_WINDOW`` for items of fewer than ``LONG`` words.

Matched windows of one document and item that overlap at one distance between the two form a segment; segments are chained if they rise in
both and their distances differ by at most ``MAX_DRIFT`` words, as inserted, lost or changed words make them. An item leaks into a document
if a chain covers enough of the item's words and its slots are consistent: each value on the item's side always stands for the same value on
the document's side, and the other way round. Equal values make an exact leak, others a re-parameterised one.

The benchmark is the stated query set. It is measured and cut into blocks of bounded size, sent to the tasks as sorted arrays; ``PASS_BLOCKS``
of them are matched in one pass over the documents. Nulls, empty texts and items of fewer than ``SHORT_WINDOW`` words match nothing; items of
fewer than ``WHOLE`` words must be covered whole. Repeated rows get equal answers. Empty tables give empty results. Columns with clashing
names pass through the filter untouched.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import reduce
from itertools import batched
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loglattice.llm.common import Words, chunks, column

#: Words of a window, and the least of them that are not placeholders, for long and for short items.
WINDOW, MIN_LITERALS = 8, 4
SHORT_WINDOW, MIN_SHORT_LITERALS = 4, 2
#: Canonical words from which an item is long; below ``WHOLE`` it must be covered whole.
LONG, WHOLE = 23, 8
#: Share of a long and of a short item's words that a chain must cover, with at least ``MIN_LITERALS`` plain ones.
MIN_COVERAGE, MIN_SHORT_COVERAGE = 0.5, 0.7
#: Most words by which the distances of neighbouring segments differ.
MAX_DRIFT = 8
#: Most bytes of benchmark text in a block on average, and blocks matched in one pass.
BLOCK_BYTES, PASS_BLOCKS = 16_000_000, 8

NUMBER, QUANTITY, NAME = "<number>", "<number> <unit>", "<name>"
#: Units that become a placeholder behind a number.
UNITS = frozenset(
    "mm cm m km in ft mi mg g kg lb oz ml l s sec min h hr hour hours minute minutes second seconds day days week weeks year years "
    "mph kmh percent dollar dollars euro euros cent cents meter meters metre metres mile miles gram grams litre litres liter liters".split()
)
_NUMBER = re.compile(r"[$€£]?[+-]?\d[\d.,:/]*(%|st|nd|rd|th)?")
_NUMBER_UNIT = re.compile(r"([$€£]?[+-]?\d[\d.,]*)([a-z]+)")
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")
_ENDS = re.compile(r"[.!?:;]\W*$")

_PLAIN, _IS_NUMBER, _IS_QUANTITY, _IS_NAME, _IS_UNIT = range(5)
_WEIGHTS = np.random.default_rng(13).integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Leading bits of a window's hash that a block's first test looks at.
_TEST_BITS = 20


def _hash(words: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")) for w in words], np.uint64)


_MARKS = dict(zip((_IS_NUMBER, _IS_QUANTITY, _IS_NAME), _hash([NUMBER, QUANTITY, NAME]), strict=True))


class Template(NamedTuple):
    """Canonical words of some texts: hash, kind and value per position, each one's text, and the first position of every text."""

    hashes: np.ndarray
    kinds: np.ndarray
    values: np.ndarray
    rows: np.ndarray
    starts: np.ndarray


def _pieces(words: list[str]) -> tuple[list[str], np.ndarray]:
    """The distinct pieces of some distinct words, and each word's first and second piece: -1 for none."""
    numbers: dict[str, int] = {}
    at = np.full((len(words), 2), -1, np.int64)
    for i, word in enumerate(words):
        literal = _EDGES.sub("", word).lower()
        glued = _NUMBER_UNIT.fullmatch(literal)
        parts = glued.groups() if glued and glued[2] in UNITS else (literal,) if literal else ()
        for j, part in enumerate(parts):
            at[i, j] = numbers.setdefault(part, len(numbers))
    return list(numbers), at


def template(texts: pa.Array) -> Template:
    """Canonicalise; every rule is decided per distinct word, then per position where the words before it matter."""
    w = Words(texts)
    vocabulary = w.vocabulary.to_pylist()
    pieces, at = _pieces(vocabulary)
    capital = np.array([bool(b) and b[0].isupper() and not b.isupper() for b in (_EDGES.sub("", v) for v in vocabulary)], bool)
    ends = np.array([bool(_ENDS.search(v)) for v in vocabulary], bool)
    numeric = np.array([bool(_NUMBER.fullmatch(x)) for x in pieces], bool)
    unit = np.array([x in UNITS for x in pieces], bool)
    codes, rows = w.codes, w.rows
    if not len(codes) or not len(pieces):
        return Template(np.zeros(0, np.uint64), np.zeros(0, np.int8), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64))
    opening = np.ones(len(codes), bool)  # a sentence may start here
    opening[1:] = ends[codes[:-1]] | (rows[1:] != rows[:-1])
    name = capital[codes] & ~opening
    per_word = (at >= 0).sum(axis=1)[codes]  # bare marks have no piece
    source = np.repeat(np.arange(len(codes)), per_word)
    second = np.zeros(len(source), bool)
    second[1:] = source[1:] == source[:-1]
    codes, rows, name = at[codes[source], second.astype(np.int64)], rows[source], name[source]

    kinds = np.zeros(len(codes), np.int8)
    kinds[numeric[codes]] = _IS_NUMBER
    joined = np.zeros(len(codes), bool)  # with the position before
    joined[1:] = rows[1:] == rows[:-1]
    after_number = joined.copy()
    after_number[1:] &= kinds[:-1] == _IS_NUMBER
    kinds[unit[codes] & after_number & (kinds == _PLAIN)] = _IS_UNIT
    kinds[name & (kinds == _PLAIN)] = _IS_NAME
    joined[1:] &= (kinds[1:] == _IS_UNIT) | ((kinds[1:] == kinds[:-1]) & (kinds[1:] != _PLAIN))

    firsts = np.flatnonzero(~joined)
    hashed = _hash(pieces)[codes]
    place = np.arange(len(codes)) - firsts[np.cumsum(~joined) - 1]
    values = np.add.reduceat(hashed * _WEIGHTS[place % len(_WEIGHTS)], firsts) if len(firsts) else np.zeros(0, np.uint64)
    with_unit = np.logical_or.reduceat(kinds == _IS_UNIT, firsts) if len(firsts) else np.zeros(0, bool)
    hashes, kinds, rows = hashed[firsts], kinds[firsts], rows[firsts]
    kinds[with_unit] = _IS_QUANTITY
    for kind, mark in _MARKS.items():
        hashes[kinds == kind] = mark
    return Template(hashes, kinds, values, rows, np.searchsorted(rows, np.arange(len(texts) + 1)))


def windows(t: Template, size: int, literals: int) -> tuple[np.ndarray, np.ndarray]:
    """Start positions and hashes of the windows inside one text that have enough literal words."""
    n = len(t.hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    plain = np.concatenate([[0], np.cumsum(t.kinds == _PLAIN)])
    at = np.flatnonzero((t.rows[:n] == t.rows[size - 1 :]) & (plain[size:] - plain[:-size] >= literals))
    sums = np.zeros(len(at), np.uint64)
    for j in range(size):
        sums += t.hashes[at + j] * _WEIGHTS[j]
    return at, sums


class Index(NamedTuple):
    """Window hashes of some items in order, with item and position, and a bit table that most other hashes fail."""

    size: int
    literals: int
    table: np.ndarray
    hashes: np.ndarray
    items: np.ndarray
    positions: np.ndarray


class Block(NamedTuple):
    """A bounded part of the benchmark: its items' ids and template, words that a leak must cover, and the windows of long and short items."""

    ids: list[int | None]
    template: Template
    needed: np.ndarray
    indexes: list[Index]


def block_of(ids: list[int | None], texts: list[str | None]) -> Block:
    t = template(pa.array(texts, pa.large_string()))
    sizes = np.diff(t.starts)
    share = np.where(sizes >= LONG, MIN_COVERAGE, np.where(sizes >= WHOLE, MIN_SHORT_COVERAGE, 1.0))
    indexes = []
    for size, literals, own in ((WINDOW, MIN_LITERALS, sizes >= LONG), (SHORT_WINDOW, MIN_SHORT_LITERALS, sizes < LONG)):
        at, sums = windows(t, size, literals)
        mine = own[t.rows[at]]
        at, sums = at[mine], sums[mine]
        order = np.argsort(sums, kind="stable")
        at, sums = at[order], sums[order]
        table = np.zeros(1 << _TEST_BITS, bool)
        table[sums >> np.uint64(64 - _TEST_BITS)] = True
        indexes.append(Index(size, literals, table, sums, t.rows[at], at - t.starts[t.rows[at]]))
    return Block(ids, t, np.ceil(share * sizes).astype(np.int64), indexes)


def consistent(kinds: np.ndarray, item: np.ndarray, doc: np.ndarray) -> tuple[bool, int]:
    """Whether the slots' values map one to one within each kind, and how many of them differ."""
    slots = np.flatnonzero(kinds != _PLAIN)
    triples = set(zip(kinds[slots].tolist(), item[slots].tolist(), doc[slots].tolist(), strict=True))
    one_to_one = len({(k, a) for k, a, _ in triples}) == len(triples) == len({(k, b) for k, _, b in triples})
    return one_to_one, int((item[slots] != doc[slots]).sum())


def segments(shifts: np.ndarray, positions: np.ndarray, size: int) -> list[tuple[int, int, int]]:
    """(start in the document, start in the item, words) of the runs of overlapping windows at one shift, by start in the document."""
    order = np.lexsort((positions, shifts))
    s, q = shifts[order], positions[order]
    breaks = np.flatnonzero((s[1:] != s[:-1]) | (q[1:] > q[:-1] + size)) + 1
    firsts, lasts = np.concatenate([[0], breaks]), np.concatenate([breaks, [len(s)]]) - 1
    return sorted(zip((s + q)[firsts].tolist(), q[firsts].tolist(), (q[lasts] + size - q[firsts]).tolist(), strict=True))


def chains(parts: list[tuple[int, int, int]], drift: int, reach: int) -> Iterator[list[tuple[int, int, int]]]:
    """The longest chain up to each segment that no other one goes on from: parts of it without the words that the one before has.

    ``reach`` is the most words between the starts of two segments of a chain.
    """
    starts = [p for p, _, _ in parts]
    best, before = [n for _, _, n in parts], [-1] * len(parts)
    for i, (p, q, n) in enumerate(parts):
        for j in range(bisect_left(starts, p - reach), i):
            p_j, q_j, n_j = parts[j]
            both = max(q_j + n_j - q, p_j + n_j - p, 0)
            if p_j < p and q_j < q and both < n and abs((p - q) - (p_j - q_j)) <= drift and best[j] + n - both > best[i]:
                best[i], before[i] = best[j] + n - both, j
    inner = set(before)
    for i in range(len(parts)):
        if i not in inner:
            chain, k = [], i
            while k >= 0:
                p, q, n = parts[k]
                j = before[k]
                both = max(parts[j][1] + parts[j][2] - q, parts[j][0] + parts[j][2] - p, 0) if j >= 0 else 0
                chain.append((p + both, q + both, n - both))
                k = j
            yield chain[::-1]


def _best(parts: list[tuple[int, int, int]], item: int, base: int, t: Template, block: Block) -> tuple[int, int] | None:
    """Words covered and, negative, slots changed of the best consistent chain; chains of one shift count where no other is consistent."""
    own = block.template
    first, size = int(own.starts[item]), int(own.starts[item + 1] - own.starts[item])
    for drift in (MAX_DRIFT, 0):
        best = None
        for chain in chains(parts, drift, size + MAX_DRIFT):
            if sum(n for _, _, n in chain) < block.needed[item]:
                continue
            here = np.concatenate([np.arange(q, q + n) for _, q, n in chain]) + first
            there = np.concatenate([np.arange(p, p + n) for p, _, n in chain]) + base
            kinds = own.kinds[here]
            same = kinds == t.kinds[there]
            good, changed = consistent(kinds[same], own.values[here][same], t.values[there][same])
            if good and (kinds == _PLAIN).sum() >= MIN_LITERALS and (best is None or (len(here), -changed) > best):
                best = len(here), -changed
        if best:
            return best
    return None


def _hits(t: Template, index: Index) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, item, shift and position in the item of every pair of equal windows."""
    at, sums = windows(t, index.size, index.literals)
    maybe = index.table[sums >> np.uint64(64 - _TEST_BITS)]
    at, sums = at[maybe], sums[maybe]
    low, high = (np.searchsorted(index.hashes, sums, side) for side in ("left", "right"))
    counts = high - low
    each = np.repeat(np.arange(len(at)), counts)
    entry = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + low[each]
    rows, q = t.rows[at[each]], index.positions[entry]
    return rows, index.items[entry], at[each] - t.starts[rows] - q, q


def leaks(texts: pa.Array, block: Block) -> Iterator[tuple[int, int, int, int, int]]:
    """(text, item, words covered, words of the item, slots changed) of every leak; the best chain of each pair."""
    return template_leaks(template(texts), block)


def template_leaks(t: Template, block: Block) -> Iterator[tuple[int, int, int, int, int]]:
    """``leaks`` of texts already canonicalised."""
    sizes = np.diff(block.template.starts)
    for index in block.indexes:
        rows, items, shifts, q = _hits(t, index)
        if not len(rows):
            continue
        pair = rows * len(sizes) + items
        # No chain covers more than all windows of the pair together.
        width = int(sizes.max()) + 1
        words = np.unique((pair[:, None] * width + q[:, None] + np.arange(index.size)).ravel()) // width
        pairs, covered = np.unique(words, return_counts=True)
        pairs = pairs[covered >= block.needed[pairs % len(sizes)]]
        order = np.argsort(pair, kind="stable")
        bounds = np.stack([np.searchsorted(pair[order], pairs, side) for side in ("left", "right")], axis=1)
        for one, (low, high) in zip(pairs.tolist(), bounds.tolist(), strict=True):
            row, item = divmod(one, len(sizes))
            mine = order[low:high]
            if best := _best(segments(shifts[mine], q[mine], index.size), item, int(t.starts[row]), t, block):
                yield row, item, best[0], int(sizes[item]), -best[1]


def benchmark_blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> Iterator[Block]:
    """The benchmark in blocks whose text is measured to stay within ``BLOCK_BYTES`` on average."""
    items = benchmark.select(column(item_id).cast("long").alias("item_id"), column(text).cast("string").alias("text")).where("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = size // BLOCK_BYTES + 1
    for b in range(n):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b) if n > 1 else items
        rows = sorted(part.collect(), key=lambda r: (r["item_id"] is None, r["item_id"] or 0, r["text"]))
        if rows:
            yield block_of([r["item_id"] for r in rows], [r["text"] for r in rows])


def find_leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per document row and leaked item: ``doc_id, item_id, covered_words, item_words, slots_changed, kind`` (exact or template)."""
    rows = docs.select(column(doc_id).alias("doc_id"), column(text).cast("string").alias("text"))
    counts = ("item_id", "covered_words", "item_words", "slots_changed")
    schema = T.StructType([rows.schema.fields[0], *[T.StructField(c, T.LongType()) for c in counts]])
    found = []
    for blocks in batched(benchmark_blocks(benchmark), PASS_BLOCKS):
        sent = [docs.sparkSession.sparkContext.broadcast(block) for block in blocks]

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = batch.column(1).cast(pa.large_string())
                for start, stop in chunks(texts):
                    t = template(texts.slice(start, stop - start))
                    for one in sent:
                        if hits := list(template_leaks(t, one.value)):
                            at, items, *values = (np.array(x, np.int64) for x in zip(*hits, strict=True))
                            ids = pa.array([one.value.ids[i] for i in items], pa.int64())
                            yield pa.RecordBatch.from_arrays(
                                [pc.take(batch.column(0), pa.array(at + start)), ids, *[pa.array(v) for v in values]], names=schema.names
                            )

        found.append(rows.mapInArrow(run, schema))
    out = reduce(DataFrame.unionByName, found) if found else docs.sparkSession.createDataFrame([], schema)
    return out.withColumn("kind", F.when(F.col("slots_changed") > 0, "template").otherwise("exact"))


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` into which no item leaks, with all their columns, in one pass."""
    at = docs.columns.index(text)
    for blocks in batched(benchmark_blocks(benchmark), PASS_BLOCKS):
        sent = [docs.sparkSession.sparkContext.broadcast(block) for block in blocks]

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = batch.column(at).cast(pa.large_string())
                for start, stop in chunks(texts):
                    t = template(texts.slice(start, stop - start))
                    clean = np.ones(stop - start, bool)
                    for one in sent:
                        clean[[hit[0] for hit in template_leaks(t, one.value)]] = False
                    yield batch.slice(start, stop - start).filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
