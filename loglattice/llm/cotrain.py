"""Quality classifier by co-training on two views.

The text view measures the text: word lengths, symbols, capitals, repetition. The metadata view has language, source and declared length (n_chars), which are all the tables have.
A logistic model per view is fitted on labelled rows; over some rounds each view gives the other its most confident unlabelled rows as
pseudo-labels. On labelled rows kept aside, each view's score is calibrated and the two are combined; the result scores every document.

Only the labelled rows are a bounded sample: ``MAX_LABELLED`` in expectation, picked by a hash of the id. Every unlabelled document takes part: its
measures are written once, each round scores all of them with both views, a histogram of confidences per class and group of sources gives the
thresholds that pass the round's share, and the refit adds up gradients and curvature over all rows that pass. So no row leaves the tasks, and a
rare source gives its share as a large one does. Pseudo-labels weigh ``PSEUDO_WEIGHT`` of the labelled rows in all, whatever their number.

Null and empty texts have zero measures and are scored like any other. Null ids and null labels are never learned from as labelled rows;
contradicting labels of one id cancel out. Without both classes in the sample every score is 0.5. Repeated rows get equal scores. Other columns are
not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loglattice.llm.common import chunks, column, materialise
from loglattice.llm.quality import Texts

MAX_LABELLED = 12_000
ROUNDS, PER_ROUND, MIN_CONFIDENCE, PSEUDO_WEIGHT = 4, 0.05, 0.9, 0.25
#: Steps of each refit from the weights before; width of a confidence bin, in logits; groups of sources by hash.
STEPS, BIN, GROUPS = 4, 0.05, 64
#: One labelled row in so many is kept aside to calibrate and combine the views.
ASIDE = 5
#: Penalty on the views' weights; calibration has one or two weights and few rows, and needs next to none.
RIDGE, CALIBRATION_RIDGE = 1.0, 0.01
META_BUCKETS = 64
THRESHOLD = 0.5


def text_view(t: Texts) -> np.ndarray:
    """Measures of the text alone, one row per text."""
    words, chars = np.maximum(t.n_words, 1), np.maximum(t.word_chars, 1)
    lines = np.maximum(t.lines[:, 0], 1)
    distinct = np.zeros(len(words))
    w = t.words
    if len(w.codes):
        distinct = np.bincount(np.unique(w.rows * len(w.vocabulary) + w.codes) // len(w.vocabulary), minlength=len(words))
    return np.column_stack([
        np.log1p(t.n_words), t.word_chars / words, t.n_symbols / words, t.n_symbols / chars, t.upper_letters / chars, t.letters / chars,
        t.n_dup_lines / lines, np.log1p(words / lines), t.n_repeat_words / words, t.top_word / words, distinct / words, t.wordy / words,
        t.n_words < 10, t.n_words < 50,
    ]).astype(np.float64)


def meta_view(langs: list, sources: list, lengths: list) -> np.ndarray:
    """Hashed language and source, and the declared length by powers of two; nulls have a place of their own."""
    out = np.zeros((len(langs), META_BUCKETS + 24))
    for i, (lang, source, length) in enumerate(zip(langs, sources, lengths, strict=True)):
        for kind, value in (("lang", lang), ("source", source)):
            out[i, zlib.crc32(f"{kind}={value}".encode("utf-8", "surrogatepass")) % META_BUCKETS] = 1
        out[i, META_BUCKETS + (0 if length is None else min(23, 1 + max(int(length), 0).bit_length()))] = 1
    return out


class Logistic(NamedTuple):
    """Weights over standardised features."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights[1:] + self.weights[0]


def fit(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE) -> Logistic:
    """Ridge logistic regression by Newton steps."""
    mean, scale = x.mean(0), x.std(0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    z = np.column_stack([np.ones(len(x)), np.clip((x - mean) / scale, -8, 8)])
    weights, penalty = np.zeros(z.shape[1]), np.full(z.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(30):
        p = chance(z @ weights)
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty + 1e-9), z.T @ (y - p) - penalty * weights)
        weights = weights + np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-6:
            break
    return Logistic(mean, scale, weights)


def chance(logit: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(logit, -35, 35)))


class Model(NamedTuple):
    """The two views' models, their calibrations, and the combination of the calibrated logits."""

    text: Logistic
    meta: Logistic
    calibrate_text: Logistic
    calibrate_meta: Logistic
    combine: Logistic

    def scores(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a = self.calibrate_text.logit(self.text.logit(text)[:, None])
        b = self.calibrate_meta.logit(self.meta.logit(meta)[:, None])
        return chance(a), chance(b), chance(self.combine.logit(np.column_stack([a, b])))


MIN_LOGIT = float(np.log(MIN_CONFIDENCE / (1 - MIN_CONFIDENCE)))


def confidence_bins(logit: np.ndarray) -> np.ndarray:
    """Signed bins of the logits that are confident enough: n for class 1, -n for class 0, 0 for neither."""
    size = np.floor((np.abs(np.clip(logit, -35, 35)) - MIN_LOGIT) / BIN).astype(np.int64) + 1
    return np.where(np.abs(logit) >= MIN_LOGIT, np.sign(logit).astype(np.int64) * size, 0)


def thresholds(histogram: dict[tuple[int, int], int], rows: dict[int, int], allowed: float, share: float) -> dict[tuple[int, int], tuple[int, float]]:
    """Per group of sources and class the lowest bin that passes, and the weight of its rows: bins from the most confident down.

    ``histogram`` has (group, signed bin) to rows, ``rows`` the size of each group, ``share`` the positives among the labels; classes grow in
    proportion. Rows of one bin cannot be told apart, so those of the bin that exceeds the allowed rows share what is left of them.
    """
    out = {}
    for group, size in rows.items():
        for sign, part in ((1, share), (-1, 1 - share)):
            left = allowed * size * part
            for b in sorted((b * sign for g, b in histogram if g == group and b * sign > 0), reverse=True):
                held = histogram[group, b * sign]
                out[group, sign] = (b, min(1.0, left / held))
                left -= held
                if left <= 0:
                    break
    return out


def chosen(bins: np.ndarray, groups: np.ndarray, lowest: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pseudo-label and weight per row, zero if not chosen; ``lowest[group]`` and ``weight[group]`` are for class 1 and class 0."""
    size, which = np.abs(bins), (bins < 0).astype(int)
    edge = lowest[groups, which]
    return 1.0 - which, np.where((bins == 0) | (size < edge), 0.0, np.where(size == edge, weight[groups, which], 1.0))


def _standard(model: Logistic, x: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(x)), np.clip((x - model.mean) / model.scale, -8, 8)])


def sums_of(model: Logistic, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> np.ndarray:
    """Gradient, curvature and weight of the rows, as one array that adds up over rows.

    The curvature is that of the quadratic bound on the loss which touches it at the present weights, so a step never overshoots.
    """
    weight = np.ones(len(x)) if weight is None else weight
    z = _standard(model, x)
    logit = z @ model.weights
    size = np.maximum(np.abs(logit), 1e-6)
    bound = np.tanh(size / 2) / (2 * size)
    return np.concatenate([z.T @ (weight * (y - chance(logit))), ((z * (weight * bound)[:, None]).T @ z).ravel(), [weight.sum()]])


def stepped(model: Logistic, labelled: np.ndarray, pseudo: np.ndarray, weight: float) -> Logistic:
    """One step from the sums of labelled and pseudo-labelled rows; the latter weigh ``weight`` times the former in all."""
    k = len(model.weights)
    scale = weight * labelled[-1] / pseudo[-1] if pseudo[-1] else 0.0
    total = labelled[:-1] + scale * pseudo[:-1]
    penalty = np.full(k, RIDGE)
    penalty[0] = 1e-6
    step = np.linalg.solve(total[k:].reshape(k, k) + np.diag(penalty + 1e-9), total[:k] - penalty * model.weights)
    return model._replace(weights=np.round(model.weights + step, 9))


def finished(models: list[Logistic], views: tuple[np.ndarray, np.ndarray], label: np.ndarray) -> Model:
    """Calibrated and combined on labelled rows kept aside."""
    logits = [m.logit(v) for m, v in zip(models, views, strict=True)]
    calibrated = [fit(z[:, None], label, CALIBRATION_RIDGE) for z in logits]
    both = np.column_stack([c.logit(z[:, None]) for c, z in zip(calibrated, logits, strict=True)])
    return Model(*models, *calibrated, fit(both, label, CALIBRATION_RIDGE))


def _views(batch: pa.RecordBatch, start: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
    """Views of rows whose columns begin with text, lang, source, length."""
    part = batch.slice(start, stop - start)
    texts, lang, source, length = part.columns[:4]
    return text_view(Texts(texts.cast(pa.large_string()))), meta_view(lang.to_pylist(), source.to_pylist(), length.to_pylist())


def _inputs(docs: DataFrame, text: str, lang: str, source: str, length: str) -> list:
    names = ((text, "text", "string"), (lang, "lang", "string"), (source, "source", "string"), (length, "length", "long"))
    return [column(c).cast(kind).alias(name) for c, name, kind in names]


def _added(rows: DataFrame, emit) -> np.ndarray:
    """The sum over all tasks of ``emit(batch)`` arrays of one length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = emit(batch)
                total = part if total is None else total + part
        if total is not None:
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["at", "value"])

    found = rows.mapInArrow(run, "at long, value double").groupBy("at").agg(F.sum("value").alias("value")).collect()  # as many as the array is long
    out = np.zeros(max((r["at"] for r in found), default=0) + 1)
    for r in found:
        out[r["at"]] = r["value"]
    return out


def _columns(batch: pa.RecordBatch) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """Source groups and both views of stored measures ``(grp, a, m)``."""
    n = batch.num_rows
    grp, a, m = (batch.column(c) for c in ("grp", "a", "m"))
    text = a.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)
    places = m.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
    meta = np.zeros((n, META_BUCKETS + 24))
    for k in range(places.shape[1]):
        meta[np.arange(n), places[:, k]] = 1
    return grp.to_numpy(zero_copy_only=False), (text, meta)


def exchange(models: list[Logistic], labelled: list[tuple[np.ndarray, np.ndarray]], pool: DataFrame, weight: float, allowed: float) -> list[Logistic]:
    """One round: thresholds from the histograms of all unlabelled rows, then steps of both views on what the other is confident of."""
    bins = int((35 - MIN_LOGIT) / BIN) + 2
    width = 2 * bins + 1

    def count(batch: pa.RecordBatch) -> np.ndarray:
        groups, views = _columns(batch)
        out = np.zeros(2 * GROUPS * width + GROUPS)
        for k in (0, 1):
            places = (k * GROUPS + groups) * width + confidence_bins(models[k].logit(views[k])) + bins
            out[: 2 * GROUPS * width] += np.bincount(places, minlength=2 * GROUPS * width)
        out[2 * GROUPS * width :] = np.bincount(groups, minlength=GROUPS)
        return out

    counted = np.zeros(2 * GROUPS * width + GROUPS)
    got = _added(pool, count)
    counted[: len(got)] = got
    sizes = {g: int(n) for g, n in enumerate(counted[2 * GROUPS * width :]) if n}
    share = float(labelled[0][1].mean())
    lowest = []
    for k in (0, 1):
        grid = counted[k * GROUPS * width : (k + 1) * GROUPS * width].reshape(GROUPS, width)
        held = {(int(g), int(b) - bins): int(grid[g, b]) for g, b in zip(*np.nonzero(grid), strict=True) if b != bins}
        edge, weights = np.full((GROUPS, 2), np.iinfo(np.int64).max), np.zeros((GROUPS, 2))
        for (g, sign), found in thresholds(held, sizes, allowed, share).items():
            edge[g, 0 if sign > 0 else 1], weights[g, 0 if sign > 0 else 1] = found
        lowest.append((edge, weights))
    teachers = list(models)
    sizes_of = [1 + len(m.weights) + len(m.weights) ** 2 for m in models]
    for _ in range(STEPS):
        now = list(models)

        def gather(batch: pa.RecordBatch, now: list[Logistic] = now) -> np.ndarray:
            groups, views = _columns(batch)
            parts = []
            for learner, teacher in ((0, 1), (1, 0)):
                label, rated = chosen(confidence_bins(teachers[teacher].logit(views[teacher])), groups, *lowest[teacher])
                used = rated > 0
                parts.append(sums_of(now[learner], views[learner][used], label[used], rated[used]))
            return np.concatenate(parts)

        sums = np.zeros(sum(sizes_of))
        got = _added(pool, gather)
        sums[: len(got)] = got
        models = [
            stepped(now[k], sums_of(now[k], *labelled[k]), sums[: sizes_of[0]] if k == 0 else sums[sizes_of[0] :], weight) for k in (0, 1)
        ]
    return models


def train(
    docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
    source: str = "source", length: str = "n_chars", max_labelled: int = MAX_LABELLED,
) -> Model | None:
    """Fit on a sample of the labelled and on all unlabelled rows; ``None`` if the sample lacks a class."""
    known = labels.select(column(doc_id).alias("id"), column(label).cast("int").alias("label")).where("id is not null and label is not null")
    known = known.groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("other")).where("label = other").drop("other")
    place = F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(1 << 30))
    known = known.where(place < int(min(1.0, max_labelled / max(known.count(), 1)) * (1 << 30)))
    rows = docs.select(*_inputs(docs, text, lang, source, length), column(doc_id).alias("id"))
    # The sample of labels is bounded by its parameter, so it may go to every task.
    tagged = rows.join(F.broadcast(known), "id", "left").select("text", "lang", "source", "length", F.col("id").cast("string").alias("id"), "label")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in chunks(batch.column(0)):
                a, b = _views(batch, start, stop)
                places = np.nonzero(b)[1].reshape(-1, 3) if (b.sum(1) == 3).all() else _three(b)
                part = batch.slice(start, stop - start)
                groups = [zlib.crc32((x or "").encode("utf-8", "surrogatepass")) % GROUPS for x in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(4), part.column(5), pa.array(groups, pa.int32()), pa.array(list(a.astype(np.float32)), pa.list_(pa.float32())),
                     pa.array(list(places.astype(np.int16)), pa.list_(pa.int16()))],
                    names=["id", "label", "grp", "a", "m"],
                )

    stored = materialise(tagged.mapInArrow(measure, "id string, label int, grp int, a array<float>, m array<smallint>"), "views")
    got = stored.where("label is not null").toArrow()
    if not got.num_rows:
        return None
    got = got.sort_by([("id", "ascending"), ("label", "ascending")]).combine_chunks()
    _, views = _columns(got.to_batches()[0])
    label_of = got.column("label").to_numpy(zero_copy_only=False).astype(float)
    aside = np.array([zlib.crc32(x.encode()) % ASIDE == 0 for x in got.column("id").to_pylist()])
    if len(np.unique(label_of[~aside])) < 2 or len(np.unique(label_of[aside])) < 2:
        return None
    labelled = [(v[~aside], label_of[~aside]) for v in views]
    models = [fit(*x) for x in labelled]
    pool = stored.where("label is null").select("grp", "a", "m")
    for number in range(1, ROUNDS + 1):
        models = exchange(models, labelled, pool, PSEUDO_WEIGHT * number / ROUNDS, PER_ROUND * number)
    return finished(models, tuple(v[aside] for v in views), label_of[aside])


def _three(meta: np.ndarray) -> np.ndarray:
    """The set places of each row, the first one again where two of a row's values share a bucket."""
    out = np.zeros((len(meta), 3), np.int64)
    for i, row in enumerate(meta):
        at = np.flatnonzero(row)
        out[i] = np.concatenate([np.full(3 - len(at), at[0]), at])
    return out


def score(
    docs: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source", length: str = "n_chars",
) -> DataFrame:
    """Per row: ``doc_id, text_score, meta_score, score, kept``."""
    rows = docs.select(*_inputs(docs, text, lang, source, length), column(doc_id).alias("doc_id"))
    schema = T.StructType([rows.schema["doc_id"], *[T.StructField(c, T.DoubleType()) for c in ("text_score", "meta_score", "score")]]).add("kept", "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in chunks(batch.column(0)):
                n = stop - start
                found = model.scores(*_views(batch, start, stop)) if model else (np.full(n, 0.5),) * 3
                yield pa.RecordBatch.from_arrays(
                    [batch.column(4).slice(start, n), *[pa.array(v) for v in found], pa.array(found[2] >= THRESHOLD)], names=schema.names
                )

    return rows.mapInArrow(run, schema)
