"""Quality rules as a short-circuit cascade.

Every rule rejects a text or lets it pass; a text is kept if no rule rejects it. The rules' order changes the cost, never the result. A
bounded sample gives each rule's seconds per text and the rows it rejects; rules then run by rejection per second, each on the texts that
the earlier ones let pass, with what it rejects of those and what it costs beside the measures they took.

Nulls, empty and word-free texts have zero words and fail the base rule. Other columns, whatever their names, pass through untouched.
Equal rows get equal verdicts. An empty table gives an empty result.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loglattice.llm.common import Words, chunks, column, free_name, string_column

#: Fixed values of the base rule.
MIN_WORDS, REPEAT_PERCENT, WINDOW = 10, 20, 5
SYMBOLS = "#*$%&|<>"
#: Limits of the further rules, in percent and in characters per word.
SYMBOL_PERCENT, UPPER_PERCENT, DUP_LINE_PERCENT, TOP_WORD_PERCENT, WORDY_PERCENT = 30, 50, 30, 30, 50
WORD_CHARS_RANGE = (2, 20)
#: Scripts whose texts do not separate words by spaces.
UNSPACED = r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}\p{Tibetan}]"
#: Rows of the cost sample in expectation.
SAMPLE_ROWS = 1000

_SYMBOL_BYTES = np.isin(np.arange(256), np.frombuffer(SYMBOLS.encode(), np.uint8))
_UPPER_BYTES = np.isin(np.arange(256), np.arange(65, 91))
_LETTER_BYTES = _UPPER_BYTES | np.isin(np.arange(256), np.arange(97, 123))
_MIX = np.random.default_rng(5).integers(1, 2**63, WINDOW + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Texts:
    """Some texts and the measures taken of them so far; a measure is computed when first asked for."""

    def __init__(self, texts: pa.Array):
        self.texts, self._done = texts, {}

    def _once(self, name: str, make: Callable):
        if name not in self._done:
            self._done[name] = make()
        return self._done[name]

    def take(self, alive: np.ndarray) -> Texts:
        """The texts at ``alive``, with their measures."""
        left = Texts(self.texts.filter(pa.array(alive)))
        left._done = {k: v[alive] for k, v in self._done.items() if isinstance(v, np.ndarray)}
        return left

    @property
    def words(self) -> Words:
        return self._once("words", lambda: Words(self.texts))

    def _bytes_in(self, table: np.ndarray) -> np.ndarray:
        lengths = pc.fill_null(pc.binary_length(self.texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        plain = pa.concat_arrays([pc.fill_null(self.texts, "")])
        offsets = np.frombuffer(plain.buffers()[1], np.int64, len(plain) + 1, plain.offset * 8) if len(plain) else np.zeros(1, np.int64)
        data = np.frombuffer(plain.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[0] + lengths.sum()]
        total = np.concatenate([[0], np.cumsum(table[data], dtype=np.int64)])
        ends = np.cumsum(lengths)
        return total[ends] - total[ends - lengths]

    @property
    def n_words(self) -> np.ndarray:
        return self._once("n_words", lambda: self.words.sizes)

    @property
    def word_chars(self) -> np.ndarray:
        def make():
            sizes = pc.utf8_length(self.words.vocabulary).to_numpy(zero_copy_only=False).astype(np.int64)
            return self.words.sums(sizes[self.words.codes] if len(sizes) else self.words.codes)

        return self._once("word_chars", make)

    @property
    def n_symbols(self) -> np.ndarray:
        return self._once("n_symbols", lambda: self._bytes_in(_SYMBOL_BYTES))

    @property
    def upper_letters(self) -> np.ndarray:
        return self._once("upper", lambda: self._bytes_in(_UPPER_BYTES))

    @property
    def letters(self) -> np.ndarray:
        return self._once("letters", lambda: self._bytes_in(_LETTER_BYTES))

    def _points(self, pattern: str) -> np.ndarray:
        """Code points that fit ``pattern``, counted once per distinct word."""
        w = self.words
        per_word = pc.count_substring_regex(w.vocabulary, pattern).to_numpy(zero_copy_only=False).astype(np.int64)
        return w.sums(per_word[w.codes] if len(per_word) else w.codes)

    @property
    def capitals(self) -> np.ndarray:
        """Upper-case letters of any script."""
        return self._once("capitals", lambda: self._points(r"\p{Lu}"))

    @property
    def script_letters(self) -> np.ndarray:
        """Letters of any script."""
        return self._once("script_letters", lambda: self._points(r"\p{L}"))

    @property
    def unspaced(self) -> np.ndarray:
        """Characters of scripts that do not separate words by spaces."""
        return self._once("unspaced", lambda: self._points(UNSPACED))

    @property
    def lines(self) -> np.ndarray:
        """Columns: lines with a word, and those equal to an earlier line."""

        def make():
            out = np.zeros((len(self.texts), 2), np.int64)
            for i, text in enumerate(self.texts.to_pylist()):
                worded = [x for x in (text or "").split("\n") if x.strip(" \t\n\v\f\r")]
                out[i] = len(worded), len(worded) - len(set(worded))
            return out

        return self._once("lines", make)

    @property
    def n_dup_lines(self) -> np.ndarray:
        return self.lines[:, 1]

    @property
    def n_repeat_words(self) -> np.ndarray:
        """Words inside five-word windows that occur at least twice in their text."""

        def make():
            w = self.words
            n, rows = len(w.codes), w.rows
            if n < WINDOW:
                return np.zeros(len(self.texts), np.int64)
            whole = rows[: n - WINDOW + 1] == rows[WINDOW - 1 :]
            at = np.flatnonzero(whole)
            sums = rows[at].astype(np.uint64) * _MIX[WINDOW]
            for j in range(WINDOW):
                sums += w.codes[at + j].astype(np.uint64) * _MIX[j]
            order = np.argsort(sums)
            same = sums[order][1:] == sums[order][:-1]
            found = np.zeros(n, bool)
            found[at[order[1:][same]]] = True
            found[at[order[:-1][same]]] = True
            covered = found.copy()
            for j in range(1, WINDOW):
                covered[j:] |= found[:-j]
            return w.sums(covered.astype(np.int64))

        return self._once("n_repeat_words", make)

    @property
    def top_word(self) -> np.ndarray:
        """Occurrences of the commonest word."""

        def make():
            w = self.words
            if not len(w.codes):
                return np.zeros(len(self.texts), np.int64)
            both, counts = np.unique(w.rows * len(w.vocabulary) + w.codes, return_counts=True)
            top = np.zeros(len(self.texts), np.int64)
            np.maximum.at(top, both // len(w.vocabulary), counts)
            return top

        return self._once("top_word", make)

    @property
    def wordy(self) -> np.ndarray:
        """Words with a letter."""

        def make():
            w = self.words
            has = pc.match_substring_regex(w.vocabulary, r"\p{L}").to_numpy(zero_copy_only=False).astype(np.int64)
            return w.sums(has[w.codes] if len(has) else w.codes)

        return self._once("wordy", make)


def too_short(t: Texts) -> np.ndarray:
    return t.n_words < MIN_WORDS


def repetitive(t: Texts) -> np.ndarray:
    return 100 * t.n_repeat_words > REPEAT_PERCENT * t.n_words


def word_length(t: Texts) -> np.ndarray:
    """Words too short, or too long in a text that is not mostly in scripts without spaces."""
    least, most = (n * t.n_words for n in WORD_CHARS_RANGE)
    long = t.word_chars > most
    return (t.word_chars < least) | (long & (2 * t.unspaced <= t.word_chars) if long.any() else long)


#: Rule name to its test; True rejects. The first two are the base rule.
RULES: dict[str, Callable[[Texts], np.ndarray]] = {
    "too_short": too_short,
    "repetitive": repetitive,
    "symbols": lambda t: 100 * t.n_symbols > SYMBOL_PERCENT * t.n_words,
    "shouting": lambda t: 100 * t.capitals > UPPER_PERCENT * t.script_letters,
    "duplicate_lines": lambda t: 100 * t.n_dup_lines > DUP_LINE_PERCENT * t.lines[:, 0],
    "word_length": word_length,
    "one_word": lambda t: (100 * t.top_word > TOP_WORD_PERCENT * t.n_words) & (t.n_words >= 2 * MIN_WORDS),
    "no_letters": lambda t: 100 * t.wordy < WORDY_PERCENT * t.n_words,
}
BASE_RULES = ("too_short", "repetitive")


#: Rules that need no words; every other one takes the word split if no rule before it has.
WORDLESS = {"duplicate_lines"}


def best_order(verdicts: dict[int, float], seconds: dict[str, float], split: float) -> list[str]:
    """Rule names by rejection per second, each among the rows that the ones before it leave.

    ``verdicts`` has, per set of rules that reject a row (bit i for the i-th rule), the number of such rows; ``seconds`` each rule's own cost
    and ``split`` that of splitting into words, for all rows.
    """
    names, left, order, paid = list(RULES), dict(verdicts), [], False
    rows = max(sum(verdicts.values()), 1)

    def gain(name: str) -> float:
        rejected = sum(n for bits, n in left.items() if bits >> names.index(name) & 1)
        cost = seconds.get(name, 0.0) + (0.0 if paid or name in WORDLESS else split)
        return (rejected + 0.5) / (sum(left.values()) + 1) / max(cost / rows, 1e-9)

    while len(order) < len(names):
        best = max((name for name in names if name not in order), key=gain)
        order.append(best)
        paid = paid or best not in WORDLESS
        left = {bits: n for bits, n in left.items() if not bits >> names.index(best) & 1}
    return order


def rule_order(docs: DataFrame, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[str]:
    """The rules' best order by a sample of ``sample_rows`` rows in expectation, spread over all partitions and measured inside the tasks."""
    names = list(RULES)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = string_column(batch, "text")
            for start, stop in chunks(texts):
                part = texts.slice(start, stop - start)
                began = time.thread_time()
                words = Texts(part).words
                spent = [time.thread_time() - began]
                bits = np.zeros(len(part), np.int64)
                for i, name in enumerate(names):
                    t = Texts(part)
                    t._done["words"] = words
                    began = time.thread_time()
                    bits |= RULES[name](t).astype(np.int64) << i
                    spent.append(time.thread_time() - began)
                seen, counts = np.unique(bits, return_counts=True)
                keys = np.concatenate([seen, -1 - np.arange(len(spent))])
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.concatenate([counts, spent]))], names=["key", "value"])

    total = docs.count()
    sample = docs.select(column(text).cast("string").alias("text")).sample(min(1.0, sample_rows / max(total, 1)), seed=11)
    # At most one row per set of rules, and one per cost.
    found = sample.mapInArrow(measure, "key long, value double").groupBy("key").agg(F.sum("value").alias("value")).collect()
    sums = {r["key"]: r["value"] for r in found}
    return best_order({k: n for k, n in sums.items() if k >= 0}, {name: sums.get(-2 - i, 0.0) for i, name in enumerate(names)}, sums.get(-1, 0.0))


def passes(texts: pa.Array, order: list[str]) -> np.ndarray:
    """True where no rule rejects; each rule sees only what the earlier ones left."""
    alive, left = np.arange(len(texts)), Texts(texts)
    for name in order:
        if not len(alive):
            break
        stays = ~RULES[name](left)
        if not stays.all():
            alive, left = alive[stays], left.take(stays)
    kept = np.zeros(len(texts), bool)
    kept[alive] = True
    return kept


def quality_filter(docs: DataFrame, text: str = "text", order: list[str] | None = None) -> DataFrame:
    """The rows of ``docs`` that the cascade keeps, with all their columns."""
    order = order or rule_order(docs, text)
    at = docs.columns.index(text)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).cast(pa.large_string())
            for start, stop in chunks(texts):
                yield batch.slice(start, stop - start).filter(pa.array(passes(texts.slice(start, stop - start), order)))

    return docs.mapInArrow(keep, docs.schema)


def quality_measures(docs: DataFrame, keys: list[str], text: str = "text", order: list[str] | None = None) -> DataFrame:
    """``keys``, the base measures, ``base_failed`` and the cascade's verdict ``kept`` per row."""
    order = [name for name in order or rule_order(docs, text) if name not in BASE_RULES]
    picked = docs.select(*[column(k) for k in keys])
    hidden = free_name(picked, "measured_text")
    rows = docs.select(*[column(k) for k in keys], column(text).cast("string").alias(hidden))
    longs = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    schema = T.StructType([*picked.schema.fields, *[T.StructField(c, T.LongType()) for c in longs]])
    schema = schema.add("base_failed", "boolean").add("kept", "boolean")
    n = len(keys)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(n).cast(pa.large_string())
            for start, stop in chunks(texts):
                t = Texts(texts.slice(start, stop - start))
                values = [t.n_words, t.word_chars, t.n_symbols, t.n_dup_lines, t.n_repeat_words]
                failed = too_short(t) | repetitive(t)
                kept = np.zeros(len(failed), bool)
                kept[~failed] = passes(t.texts.filter(pa.array(~failed)), order)
                part = batch.slice(start, stop - start)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:n], *[pa.array(v, pa.int64()) for v in values], pa.array(failed), pa.array(kept)], names=schema.names
                )

    return rows.mapInArrow(measure, schema)
