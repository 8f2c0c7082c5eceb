"""A convolutional text classifier for toxicity, trained in numpy on a bounded sample.

A word is the sum of two hashed embeddings, of the word and of its first four bytes. Filters
over one, two and three words are applied at every place of a text, the largest value of
each filter is kept (max pooling), and a linear layer turns these into a score. A word is a run
of letters and digits, A-Z in lower case.

Only the labelled training rows are looked at for learning. Filters and embeddings are fitted on a sample of them: at most ``SAMPLE_DOCS`` documents and
about ``SAMPLE_CHARS`` characters, picked by a hash of the id, whole texts. A task fits them, and only the model comes to the driver. Embeddings start
with the smoothed log-odds of their bucket as first coordinate. A fifth of the sample is
kept back. On all labelled training rows that were not fitted on, scores are calibrated to
probabilities and, per language, the lowest threshold is chosen whose rejections are right in
``PRECISION`` of cases; Spark counts these rows by language, label and range of score.

Scores depend on the text alone. Scoring covers whole texts, long ones in runs of places.

Defined results: null and empty texts have the score of a text without any known word; without
training rows of both kinds the score is the share of toxic ones (0 if there are none);
a repeated label counts once, toxic if any is; a language without enough rows takes the
threshold of all; columns with other names are kept and ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .grouping import beside, quoted
from .hashing import MARKS, slices, text_bytes, word_hashes

if TYPE_CHECKING:
    import pandas as pd

SAMPLE_DOCS = 12_000
SAMPLE_CHARS = 60_000_000
PRECISION = 0.97
LIKELY = 0.7
LEAST_TOXIC = 10  # rows for a threshold of its own
LEAST_ROWS = 50  # not fitted on; with fewer, those fitted on count too
BINS = 32  # ranges of score for each unit of its log-odds
BUCKETS = 1 << 20
STEM = 4
KNOWN = 30_000  # embeddings of each kind
MAX_BROADCAST = 1_000_000  # labels, of about 30 bytes
LEAST_DOCS = 2  # a bucket in fewer sample documents has no embedding
WIDTHS = (1, 2, 3)
FILTERS = 8
DIM = 8
EPOCHS = 4
BATCH = 64
_RUN = 200_000  # words convolved at a time


def _buckets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word buckets, stem buckets, and the number of words before each text."""
    data, bounds = text_bytes(texts)
    whole, firsts = word_hashes(data, bounds, between=MARKS)
    stems, _ = word_hashes(data, bounds, STEM, MARKS)
    fold = np.uint64(BUCKETS - 1)
    return (whole & fold).astype(np.int32), (stems & fold).astype(np.int32), firsts


@dataclass
class Model:
    """What was learnt. ``words`` and ``stems`` are sorted buckets; row 0 stands for all others."""

    share: float
    words: np.ndarray
    stems: np.ndarray
    word_rows: np.ndarray
    stem_rows: np.ndarray
    filters: dict[int, np.ndarray]  # width: (width, DIM, FILTERS)
    bias: dict[int, np.ndarray]
    out: np.ndarray
    out_bias: float
    scale: float = 1.0
    shift: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)
    threshold: float = LIKELY
    fitted: np.ndarray | None = None  # ids of documents

    def look_up(self, words: np.ndarray, stems: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _rows(self.words, words), _rows(self.stems, stems)

    def pooled(self, rows: tuple[np.ndarray, np.ndarray], firsts: np.ndarray) -> np.ndarray:
        """The largest value of every filter in every text; texts stand between empty words."""
        texts = len(firsts) - 1
        best = np.zeros((texts, len(WIDTHS) * FILTERS), np.float32)
        at = 0
        while at < texts:
            stop = int(np.searchsorted(firsts, firsts[at] + _RUN, "right")) - 1
            if stop > at:
                part = slice(firsts[at], firsts[stop])
                x, starts = self._padded(rows[0][part], rows[1][part], firsts[at : stop + 1] - firsts[at])
                best[at:stop] = self._largest(x, starts)
            else:
                stop = at + 1
                best[at] = self._long(rows[0][firsts[at] : firsts[stop]], rows[1][firsts[at] : firsts[stop]])
            at = stop
        return best

    def _long(self, words: np.ndarray, stems: np.ndarray) -> np.ndarray:
        """One long text, by runs of places; each place sees the words that it would in one run."""
        reach = max(WIDTHS) - 1
        best = np.zeros(len(WIDTHS) * FILTERS, np.float32)
        for low in range(0, len(words) + reach, _RUN):
            high = min(low + _RUN, len(words) + reach)
            first, last = max(0, low - reach), min(len(words), high)
            x = np.zeros((high - low + reach, DIM), np.float32)
            x[first + reach - low : last + reach - low] = (
                self.word_rows[words[first:last]] + self.stem_rows[stems[first:last]]
            )
            np.maximum(best, self._largest(x, np.zeros(1, np.int64))[0], out=best)
        return best

    def _padded(
        self, words: np.ndarray, stems: np.ndarray, firsts: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        reach = max(WIDTHS) - 1
        text = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
        x = np.zeros((len(words) + reach * len(firsts), DIM), np.float32)
        x[np.arange(len(words)) + reach * (text + 1)] = self.word_rows[words] + self.stem_rows[stems]
        return x, firsts[:-1] + reach * np.arange(len(firsts) - 1)

    def _largest(self, x: np.ndarray, starts: np.ndarray) -> np.ndarray:
        parts = []
        for width in WIDTHS:
            value = self._convolved(x, width)
            parts.append(np.maximum.reduceat(value, starts, axis=0))
        return np.maximum(np.concatenate(parts, axis=1), 0)

    def _convolved(self, x: np.ndarray, width: int) -> np.ndarray:
        places = len(x) - max(WIDTHS) + 1
        value = np.tile(self.bias[width], (places, 1))
        for step in range(width):
            value += x[step : step + places] @ self.filters[width][step]
        return value

    def logits(self, rows: tuple[np.ndarray, np.ndarray], firsts: np.ndarray) -> np.ndarray:
        return self.pooled(rows, firsts) @ self.out + self.out_bias

    def score(self, texts: pa.Array) -> np.ndarray:
        if self.out is None:
            return np.full(len(texts), self.share)
        words, stems, firsts = _buckets(texts)
        z = self.logits(self.look_up(words, stems), firsts).astype(np.float64)
        return _sigmoid(self.scale * z + self.shift)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _rows(known: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    table = np.zeros(BUCKETS, np.int32)
    table[known] = np.arange(1, len(known) + 1)
    return table[buckets]


class _Trainer:
    """Adam on single documents' max-pooled values; gradients touch only the places that won."""

    def __init__(self, model: Model, rate: float = 0.01):
        self.model, self.rate, self.step = model, rate, 0
        self.moments: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def _adam(self, name: str, value: np.ndarray, gradient: np.ndarray) -> None:
        first, second = self.moments.setdefault(name, (np.zeros_like(value), np.zeros_like(value)))
        first += 0.1 * (gradient - first)
        second += 0.001 * (gradient**2 - second)
        ahead = first / (1 - 0.9**self.step)
        around = np.sqrt(second / (1 - 0.999**self.step)) + 1e-8
        value -= (self.rate * ahead / around).astype(value.dtype)

    def learn(self, docs: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> None:
        model, reach = self.model, max(WIDTHS) - 1
        self.step += 1
        sizes = np.array([len(d[0]) for d in docs])
        firsts = np.concatenate(([0], np.cumsum(sizes)))
        words, stems = (np.concatenate([d[side] for d in docs]) for side in (0, 1))
        x, starts = model._padded(words, stems, firsts)
        ends = np.append(starts[1:], len(x) - reach)
        values = {width: model._convolved(x, width) for width in WIDTHS}
        where = {
            width: np.array([a + v[a:b].argmax(axis=0) for a, b in zip(starts, ends)])
            for width, v in values.items()
        }
        raw = np.concatenate(
            [np.take_along_axis(values[w], where[w], axis=0) for w in WIDTHS], axis=1
        )
        pooled = np.maximum(raw, 0)
        error = (_sigmoid(pooled @ model.out + model.out_bias) - labels) / len(docs)
        back = (error[:, None] * model.out[None, :]) * (raw > 0)
        # Places in x, and the word that stands there (0 between texts).
        word_at, stem_at = np.zeros(len(x), np.int32), np.zeros(len(x), np.int32)
        text = np.repeat(np.arange(len(docs)), sizes)
        spot = np.arange(len(words)) + reach * (text + 1)
        word_at[spot], stem_at[spot] = words, stems
        d_word, d_stem = np.zeros_like(model.word_rows), np.zeros_like(model.stem_rows)
        for number, width in enumerate(WIDTHS):
            g = back[:, number * FILTERS : (number + 1) * FILTERS]
            d_filter = np.zeros_like(model.filters[width])
            for step in range(width):
                place = where[width] + step
                d_filter[step] = np.einsum("tf,tfd->df", g, x[place])
                d_x = g[:, :, None] * model.filters[width][step].T[None, :, :]
                np.add.at(d_word, word_at[place], d_x)
                np.add.at(d_stem, stem_at[place], d_x)
            self._adam(f"filter{width}", model.filters[width], d_filter)
            self._adam(f"bias{width}", model.bias[width], g.sum(axis=0))
        d_word[0] = d_stem[0] = 0
        self._adam("words", model.word_rows, d_word)
        self._adam("stems", model.stem_rows, d_stem)
        self._adam("out", model.out, pooled.T @ error)
        model.out_bias -= self.rate * float(error.sum())


def _start(buckets: list[np.ndarray], labels: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The known buckets, and embeddings that begin with how telling each bucket is."""
    seen = [np.unique(b) for b in buckets]
    flat = np.concatenate(seen)
    toxic = np.repeat(labels, [len(s) for s in seen])
    docs = np.bincount(flat, minlength=BUCKETS)
    bad = np.bincount(flat, weights=toxic, minlength=BUCKETS)
    known = np.flatnonzero(docs >= LEAST_DOCS)
    share, prior = labels.mean(), 5.0
    odds = np.log((bad + prior * share) / (docs - bad + prior * (1 - share)))
    odds = (odds - np.log(share / (1 - share)))[known]
    if len(known) > KNOWN:
        # The most telling ones, by how far they are from saying nothing.
        keep = np.sort(np.argsort(-np.abs(odds), kind="stable")[:KNOWN])
        known, odds = known[keep], odds[keep]
    rows = np.random.default_rng(seed).normal(0, 0.05, (len(known) + 1, DIM)).astype(np.float32)
    rows[1:, 0] = odds / 4
    rows[0] = 0
    return known.astype(np.int32), rows


def train(sample: pd.DataFrame) -> Model:
    """Learn from rows with ``words`` and ``stems`` (int32 bytes), ``toxic`` and ``lang``."""
    given, sample = sample, sample.drop_duplicates(["words", "stems"]).reset_index(drop=True)
    labels = sample["toxic"].to_numpy(np.float32)
    share = float(labels.mean()) if len(labels) else 0.0
    empty = np.zeros(0, np.int32)
    if not 0 < share < 1:
        none = np.zeros((1, DIM), np.float32)
        return Model(share, empty, empty, none, none, {}, {}, None, 0.0)
    words, stems = (
        [np.frombuffer(b, np.int32) for b in sample[name]] for name in ("words", "stems")
    )
    random = np.random.default_rng(11)
    order = random.permutation(len(sample))
    kept_back = order[: len(order) // 5]
    fit = order[len(order) // 5 :]
    if not 0 < labels[fit].mean() < 1:
        fit = order
    texts = {(sample["words"][i], sample["stems"][i]) for i in fit}
    copies = [key in texts for key in zip(given["words"], given["stems"])]
    known_words, word_rows = _start([words[i] for i in fit], labels[fit], 1)
    known_stems, stem_rows = _start([stems[i] for i in fit], labels[fit], 2)
    filters, bias = {}, {}
    for width in WIDTHS:
        filters[width] = random.normal(0, 0.2, (width, DIM, FILTERS)).astype(np.float32)
        filters[width][:, 0, : FILTERS // 2] = np.abs(filters[width][:, 0, : FILTERS // 2]) + 0.5
        bias[width] = np.zeros(FILTERS, np.float32)
    out = np.abs(random.normal(0, 0.1, len(WIDTHS) * FILTERS)).astype(np.float32)
    start = float(np.log(share / (1 - share)))
    model = Model(share, known_words, known_stems, word_rows, stem_rows, filters, bias, out, start)
    docs = [model.look_up(words[i], stems[i]) for i in range(len(sample))]
    trainer = _Trainer(model)
    epochs = max(EPOCHS, min(40, 400 * BATCH // max(1, len(fit))))
    for _ in range(epochs):
        for at in range(0, len(fit), BATCH):
            part = fit[at : at + BATCH]
            trainer.learn([docs[i] for i in part], labels[part])
        fit = random.permutation(fit)
    model.fitted = given["doc_id"].to_numpy(np.int64)[copies]
    return model


def calibrate(model: Model, docs: DataFrame, labels: DataFrame, may_learn: Column) -> Model:
    """Turn scores into probabilities, then choose a threshold for each language."""
    if model.out is None:
        return model
    plain = replace(model, scale=1.0, shift=0.0, fitted=None)
    given = docs.where(may_learn).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text"
    )
    fitted = docs.sparkSession.createDataFrame([(int(i),) for i in set(model.fitted.tolist())], "doc_id bigint")
    known = labelled(labels, may_learn).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    if known.count() <= MAX_BROADCAST:
        known = F.broadcast(known)
    within = F.least(F.greatest(F.col("score"), F.lit(1e-13)), F.lit(1 - 1e-13))
    z = F.log(within / (1 - within))
    counted = (
        score(given.join(known, "doc_id"), plain)
        .select("doc_id", "lang", "toxic", z.alias("z"))
        .join(F.broadcast(fitted.withColumn("fitted", F.lit(True))), "doc_id", "left")
        .groupBy(F.col("fitted").isNotNull().alias("fitted"), "lang", F.floor(F.col("z") * BINS).alias("bin"))
        .agg(
            F.count("*").alias("n"),
            F.sum((F.col("toxic") > 0).cast("int")).alias("toxic"),
            F.min("z").alias("low"),
            F.max("z").alias("high"),
        )
        .toArrow()
        .to_pandas()
        .sort_values(["lang", "bin", "fitted"], kind="stable")
    )
    own = counted[~counted["fitted"]]
    table = own if own["n"].sum() >= LEAST_ROWS else counted
    if not len(table):
        return model
    z = ((table["low"] + table["high"]) / 2).to_numpy(np.float64)
    n, toxic = table["n"].to_numpy(np.float64), table["toxic"].to_numpy(np.float64)
    scale, shift, total = 1.0, 0.0, n.sum()
    for _ in range(500):
        error = n * _sigmoid(scale * z + shift) - toxic
        # Held near the identity, as few rows or perfect separation would let it run away.
        scale -= 0.1 * ((error * z).sum() / total / (1 + (n * z**2).sum() / total) + 0.001 * (scale - 1))
        shift -= 0.1 * (error.sum() / total + 0.001 * shift)
    model.scale, model.shift = max(0.1, scale), shift
    model.threshold = _threshold(model, table)
    for name, part in table.groupby("lang"):
        if part["toxic"].sum() >= LEAST_TOXIC:
            model.thresholds[name] = _threshold(model, part)
    return model


def _threshold(model: Model, table: pd.DataFrame) -> float:
    """The lowest threshold above all ranges where too many rejections would be wrong."""
    bins = table.groupby("bin").agg(
        n=("n", "sum"), toxic=("toxic", "sum"), low=("low", "min"), high=("high", "max")
    ).sort_index(ascending=False)
    low, high = (_sigmoid(model.scale * bins[c].to_numpy() + model.shift) for c in ("low", "high"))
    fine = np.flatnonzero((bins["toxic"].cumsum() / bins["n"].cumsum()).to_numpy() >= PRECISION)
    if not len(fine):
        return LIKELY
    last = fine[-1]
    # Halfway to the next score below, for what lies between.
    below = high[last + 1] if last + 1 < len(bins) else 0.0
    return float(np.clip((low[last] + below) / 2, 0.3, 0.95))


def labelled(labels: DataFrame, may_learn: Column) -> DataFrame:
    """(doc_id, toxic) of the rows that may be learnt from, one per document."""
    return (
        labels.where(may_learn & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )


_SAMPLE_TYPES = "words binary, stems binary, toxic int, lang string, doc_id bigint"


def sample_rows(
    docs: DataFrame,
    labels: DataFrame,
    may_learn: Column,
    sample_docs: int = SAMPLE_DOCS,
    sample_chars: int = SAMPLE_CHARS,
) -> DataFrame:
    """Hashed words of a bounded number of labelled documents, picked by hash of the id."""
    one = labelled(labels, may_learn)
    draw = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1_000_000))
    rows = max(1, one.count())
    share = min(1.0, sample_docs / rows)
    drawn = one.where(draw < int(share * 1_000_000))
    # Rows that repeat under one id say the same; they count once, and texts of one id have a bound too.
    texts = (
        docs.select("doc_id", "text", "lang")
        .join(F.broadcast(drawn), "doc_id")
        .dropDuplicates(["doc_id", "text"])
    )
    found, chars = texts.agg(F.count("*"), F.sum(F.char_length("text"))).first()
    if (chars or 0) > sample_chars:
        texts = texts.where(draw < int(share * sample_chars / chars * 1_000_000))
    if found > 2 * sample_docs:
        by_text = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000))
        texts = texts.where(by_text < int(sample_docs / found * 1_000_000))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own_words, own_stems = [], []
            for part in slices(batch.column("text")):
                words, stems, firsts = _buckets(part)
                for a, b in zip(firsts[:-1], firsts[1:]):
                    own_words.append(words[a:b].tobytes())
                    own_stems.append(stems[a:b].tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(own_words, pa.binary()),
                    pa.array(own_stems, pa.binary()),
                    batch.column("toxic"),
                    batch.column("lang"),
                    batch.column("doc_id"),
                ],
                ["words", "stems", "toxic", "lang", "doc_id"],
            )

    typed = texts.select(
        "text",
        (F.col("toxic") > 0).cast("int").alias("toxic"),
        F.col("lang").cast("string").alias("lang"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
    )
    return typed.mapInArrow(hashed, _SAMPLE_TYPES)


def _ordered(rows: pa.Table) -> pd.DataFrame:
    return rows.to_pandas().sort_values(["doc_id", "words"], kind="stable").reset_index(drop=True)


def training_sample(docs: DataFrame, labels: DataFrame, may_learn: Column, **bounds: int) -> pd.DataFrame:
    """The rows of ``sample_rows`` in the driver, in the order of training."""
    return _ordered(sample_rows(docs, labels, may_learn, **bounds).toArrow())


def fitted_model(rows: DataFrame) -> Model:
    """``train`` on ``sample_rows``, in a task: the sample is bounded, but far larger than the model."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if held:
            sample = _ordered(pa.Table.from_batches(held))
            held.clear()
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(train(sample))], pa.binary())], ["model"])

    found = rows.repartition(1).mapInArrow(run, "model binary").collect()
    if not found:
        return train(_ordered(rows.limit(0).toArrow()))
    return pickle.loads(found[0].model)


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` from the text alone."""
    names = docs.columns
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.select(F.struct(*[F.col(quoted(n)) for n in names]).alias("kept"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("kept").field(text_col)
            scores = [shared.value.score(part) for part in slices(texts)]
            scores = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("kept"), pa.array(scores, pa.float64())], ["kept", "score"]
            )

    scored = kept.mapInArrow(run, beside(kept, "kept", "score double"))
    return scored.select(*[F.col(f"kept.{quoted(n)}") for n in names], "score")


def is_held_out(id_col: str = "doc_id") -> Column:
    """Rows that labels are never learnt from."""
    remainder = F.crc32(F.col(id_col).cast("string").cast("binary")) % 3
    return F.coalesce(remainder == 1, F.lit(False))


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with ``held_out``, ``score``, ``predicted``, ``threshold`` and ``rejected``.

    Columns of these names are replaced.
    """
    docs = docs.drop("held_out", "score", "predicted", "threshold", "rejected")
    model = fitted_model(sample_rows(docs, labels, ~is_held_out()))
    model = replace(calibrate(model, docs, labels, ~is_held_out()), fitted=None)
    threshold = F.lit(model.threshold)
    for name, value in sorted(model.thresholds.items()):
        threshold = F.when(F.col("lang") == name, F.lit(value)).otherwise(threshold)
    return (
        score(docs, model)
        .withColumn("held_out", is_held_out())
        .withColumn("predicted", (F.col("score") >= LIKELY).cast("int"))
        .withColumn("threshold", threshold)
        .withColumn("rejected", F.col("score") >= F.col("threshold"))
    )
