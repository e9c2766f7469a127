"""Language identification of mixed-language text.

Training counts hashed byte n-grams of words per language on a bounded, stratified sample of labelled rows. In a text, the script of a word
narrows the languages to those seen in that script; each word gets a log-likelihood per remaining language; and a Viterbi pass over the
words with a penalty per change labels the text in spans. The language with most letters in its spans is the prediction, its share of
the letters the score.

A null text, or one without a letter, is ``und`` with score 0, and so is everything if no labelled row exists. Ties go to the language
first in order. Null ids are never learned from and not held out. Repeated rows get equal answers. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loglattice.llm.common import Words, chunks, column

#: Most documents per language that the model is counted on, in expectation.
TRAIN_PER_LANGUAGE = 4000
ORDERS, BUCKET_BITS, SMOOTHING = (1, 2, 3, 4), 16, 0.5
#: Log-likelihood lost by a change of language between two words.
SWITCH_PENALTY = 12.0
#: A language uses a script if at least this share of its words is in it.
MIN_SCRIPT_SHARE = 0.001
OUT_OF_SCRIPT = -1e4
UNKNOWN = "und"
#: First code points of Unicode script ranges, in order; a word's script is that of its first letter.
SCRIPT_STARTS = np.array([
    0x0, 0x370, 0x400, 0x530, 0x590, 0x600, 0x700, 0x900, 0x980, 0xA00, 0xB80, 0xC00, 0xE00, 0xE80, 0x1000, 0x10A0, 0x1100, 0x1200, 0x1E00,
    0x1F00, 0x2C60, 0x3040, 0x3100, 0x3400, 0xA000, 0xAC00, 0xD7A4,
])
#: Ranges that continue an earlier script: Latin, Greek and Hangul.
_SAME_SCRIPT = {0x1E00: 0x0, 0x2C60: 0x0, 0x1F00: 0x370, 0xAC00: 0x1100}
SCRIPT_IDS = np.array([int(np.searchsorted(SCRIPT_STARTS, _SAME_SCRIPT.get(int(s), int(s)))) for s in SCRIPT_STARTS])
BUCKETS = 1 << BUCKET_BITS
_WEIGHTS = np.random.default_rng(3).integers(1, 2**63, (max(ORDERS) + 1, max(ORDERS)), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Model(NamedTuple):
    """Languages in order, log-likelihood per n-gram bucket and language, and which scripts each language uses."""

    languages: list[str]
    loglik: np.ndarray
    scripts: np.ndarray


def letters_only(vocabulary: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(pc.utf8_lower(vocabulary), r"[^\p{L}]+", "")


def grams(plain: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and word index of every n-gram inside the words, their two ends marked by a space."""
    data = np.frombuffer(b" " + " ".join(plain.to_pylist()).encode("utf-8", "surrogatepass") + b" ", np.uint8)
    space = data == 32
    upto = np.concatenate([[0], np.cumsum(space)])
    buckets, words = [], []
    for n in ORDERS:
        m = len(data) - n + 1
        if m <= 0:
            continue
        spaces = upto[n:] - upto[:-n]
        good = np.flatnonzero((spaces == space[:m].astype(int) + (space[n - 1 :] if n > 1 else 0)) & (spaces < n))
        sums = np.full(len(good), n, np.uint64) * _WEIGHTS[-1, 0]
        for j in range(n):
            sums += data[good + j] * _WEIGHTS[n, j]
        sums ^= sums >> np.uint64(31)
        buckets.append(((sums * _WEIGHTS[0, 0]) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64))
        words.append(upto[good + 1] - 1)
    return np.concatenate(buckets), np.concatenate(words)


def scripts_of(plain: pa.Array) -> np.ndarray:
    """Script id per word, -1 for a word without a letter."""
    first = np.array([ord(w[0]) if w else -1 for w in plain.to_pylist()], np.int64)
    ids = SCRIPT_IDS[np.maximum(np.searchsorted(SCRIPT_STARTS, first, "right") - 1, 0)]
    return np.where(first < 0, -1, ids)


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = TRAIN_PER_LANGUAGE) -> Model:
    """Count a sample of about ``per_language`` labelled, not held out documents of each language, picked by a hash of the id."""
    rows = docs.select(column(doc_id).alias("id"), column(text).cast("string").alias("text"), column(lang).cast("string").alias("lang"))
    rows = rows.where(F.col("id").isNotNull() & F.col("lang").isNotNull() & ~is_held_out(F.col("id")))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros((0, len(SCRIPT_STARTS)), bool))
    limits = F.create_map(*[F.lit(x) for k in languages for x in (k, int(min(1, per_language / sizes[k]) * (1 << 20)))])
    sample = rows.where(F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(1 << 20)) < F.element_at(limits, F.col("lang"))).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            texts, tags = batch.column(1).cast(pa.large_string()), np.array(batch.column(0).to_pylist(), object)
            for name in set(tags):
                own = texts.filter(pa.array(tags == name))
                for start, stop in chunks(own):
                    w = Words(own.slice(start, stop - start))
                    plain, used = letters_only(w.vocabulary), np.bincount(w.codes, minlength=len(w.vocabulary))
                    if not len(w.codes):
                        continue
                    bucket, word = grams(plain)
                    found, scripts = seen.setdefault(name, (np.zeros(BUCKETS), np.zeros(len(SCRIPT_STARTS))))
                    found += np.bincount(bucket, used[word], BUCKETS)
                    of = scripts_of(plain)
                    scripts += np.bincount(of[of >= 0], used[of >= 0], len(SCRIPT_STARTS))
        for name, (found, scripts) in seen.items():
            values = [[name], [found], [scripts]]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, (pa.string(), pa.list_(pa.float64()), pa.list_(pa.float64())), strict=True)], names=["lang", "grams", "scripts"])

    counted = {r["lang"]: r for r in sample.repartition("lang").mapInArrow(count, "lang string, grams array<double>, scripts array<double>").collect()}
    languages = sorted(counted)
    loglik, scripts = np.zeros((BUCKETS, len(languages)), np.float32), np.zeros((len(languages), len(SCRIPT_STARTS)), bool)
    for i, name in enumerate(languages):
        found, used = np.array(counted[name]["grams"]), np.array(counted[name]["scripts"])
        loglik[:, i] = np.log((found + SMOOTHING) / (found.sum() + SMOOTHING * BUCKETS))
        scripts[i] = used >= MIN_SCRIPT_SHARE * max(used.sum(), 1)
    return Model(languages, loglik, scripts)


def word_scores(model: Model, plain: pa.Array) -> np.ndarray:
    """Log-likelihood per word and language beside the word's best, zero for a word without a letter or in a script nobody uses."""
    n, size = len(plain), len(model.languages)
    out = np.zeros((n, size), np.float32)
    bucket, word = grams(plain)
    for i in range(size):
        out[:, i] = np.bincount(word, model.loglik[bucket, i], n)
    script = scripts_of(plain)
    allowed = model.scripts[:, np.maximum(script, 0)].T
    nobody = ~allowed.any(1)
    out[~allowed & ~nobody[:, None]] = OUT_OF_SCRIPT
    out[(script < 0) | nobody] = 0
    return out - out.max(1, keepdims=True) if n else out


def viterbi(scores: np.ndarray, codes: np.ndarray, sizes: np.ndarray, penalty: float = SWITCH_PENALTY) -> np.ndarray:
    """The best language per word position; all texts advance together, longest first, one word a step."""
    labels = np.zeros(len(codes), np.int16)
    if not len(codes):
        return labels
    starts = np.cumsum(sizes) - sizes
    order = np.argsort(-sizes, kind="stable")
    first, long_first = starts[order], sizes[order]
    width = scores.shape[1]
    back = np.zeros((len(codes), width), np.int16)
    own = np.arange(width, dtype=np.int16)
    steps = int(long_first[0])
    active = len(sizes) - np.searchsorted(long_first[::-1], np.arange(steps), "right")  # texts longer than each step
    state = scores[codes[first[: active[0]]]].astype(np.float64)
    ends = np.zeros(len(sizes), np.int16)
    for t in range(1, steps):
        k = active[t]
        if k < len(state):
            ends[k : len(state)] = state[k:].argmax(1)
            state = state[:k]
        at = first[:k] + t
        best = state.argmax(1)
        moved = state[np.arange(k), best][:, None] - penalty
        stays = state >= moved
        back[at] = np.where(stays, own, best[:, None])
        state = np.where(stays, state, moved) + scores[codes[at]]
    ends[: len(state)] = state.argmax(1)
    now = ends.copy()
    for t in range(steps - 1, -1, -1):
        k = active[t]
        at = first[:k] + t
        labels[at] = now[:k]
        now[:k] = back[at, now[:k]]
    return labels


def label_texts(model: Model, texts: pa.Array) -> list[tuple[str, float, list[dict]]]:
    """``lang, score, spans`` per text; a span has its language and its first and last-but-one word positions."""
    w = Words(texts)
    if not model.languages or not len(w.codes):
        return [(UNKNOWN, 0.0, [])] * len(texts)
    plain = letters_only(w.vocabulary)
    labels = viterbi(word_scores(model, plain), w.codes, w.sizes)
    letters = pc.utf8_length(plain).to_numpy(zero_copy_only=False)[w.codes]
    width, rows = len(model.languages), w.rows
    share = np.bincount(rows * width + labels, letters, len(texts) * width).reshape(len(texts), width)
    total, best = share.sum(1), share.argmax(1)
    cut = np.flatnonzero(np.concatenate([[True], (labels[1:] != labels[:-1]) | (rows[1:] != rows[:-1])]))
    stops = np.append(cut[1:], len(labels))
    spans: list[list[dict]] = [[] for _ in range(len(texts))]
    for a, b in zip(cut.tolist(), stops.tolist(), strict=True):
        row = rows[a]
        spans[row].append({"lang": model.languages[labels[a]], "start": int(a - w.starts[row]), "stop": int(b - w.starts[row])})
    return [
        (model.languages[best[i]], float(share[i, best[i]] / total[i]), spans[i]) if total[i] else (UNKNOWN, 0.0, []) for i in range(len(texts))
    ]


def identify(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``doc_id, lang_pred, score, spans``."""
    rows = docs.select(column(doc_id).alias("doc_id"), column(text).cast("string").alias("text"))
    span = T.StructType().add("lang", "string").add("start", "integer").add("stop", "integer")
    schema = T.StructType([rows.schema.fields[0]]).add("lang_pred", "string").add("score", "double").add("spans", T.ArrayType(span))
    kind = pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.large_string())
            for start, stop in chunks(texts):
                found = label_texts(sent.value, texts.slice(start, stop - start))
                names, scores, spans = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, stop - start), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(spans, kind)],
                    names=schema.names,
                )

    return rows.mapInArrow(run, schema)
