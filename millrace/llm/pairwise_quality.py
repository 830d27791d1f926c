"""Quality scores learned from preferences: a good document is preferred to a bad one (Bradley and Terry's model).

Every text is described by a few statistics, each cut at quantiles into steps. The logistic loss on the differences of pairs
gives a weight for each step; a document's score is the sum of its weights. Scores are shifted so that the quantile of the
training scores that splits off the share of bad documents lies at the threshold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import ids_and_texts, in_batches_of, type_of
from millrace.llm.hashing import chain, word_hashes

#: Labelled documents to learn from at most, and pairs drawn from them.
SAMPLE = 20_000
PAIRS = 60_000
STEPS = 8
ROUNDS = 250
RATE = 0.3
SHRINK = 1e-3
THRESHOLD = 0.7
ROWS = 256
WINDOW = 512

#: Classes of bytes whose shares count.
CLASSES = [b"#*$%&|<>", b"!", b"?,;:", b".", b"0123456789", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"\n", b" \t", bytes(range(128, 256)), b"@/\\=_~^{}[]()\"'+-"]
NAMES = [
    "length", "words", "word_length", "distinct", "most_frequent", "same_as_last", "repeated_runs", "repeated_lines", "line_length", "odd_window", "upper_window",
    *[f"share_{k}" for k in range(len(CLASSES))],
]

_MEMBERS = np.zeros((256, len(CLASSES)))
for _k, _class in enumerate(CLASSES):
    _MEMBERS[list(_class), _k] = 1


def statistics(texts: pa.Array) -> np.ndarray:
    """A row of numbers for each text, in the order of ``NAMES``. Null counts as empty."""
    hashes, counts = word_hashes(texts)
    out = np.zeros((len(texts), len(NAMES)))
    at = 0
    for k, (text, n) in enumerate(zip(texts.to_pylist(), counts.tolist(), strict=True)):
        words, at = hashes[at : at + n], at + n
        if not n:
            continue
        raw = text.encode("utf-8", "surrogatepass")
        data = np.frombuffer(raw, np.uint8)
        share = np.bincount(data, minlength=256) @ _MEMBERS / len(data)
        _, often = np.unique(words, return_counts=True)
        five = chain(words, 5)
        lines = [x for x in raw.split(b"\n") if x.strip()]
        starts = np.arange(0, len(data), WINDOW)
        sizes = np.diff(np.append(starts, len(data)))
        windows = [np.add.reduceat(_MEMBERS[data, c], starts) / np.maximum(sizes, WINDOW // 2) for c in (0, 5)]
        out[k, : len(NAMES) - len(CLASSES)] = (
            np.log1p(len(data)), np.log1p(n), (len(data) - n) / n, len(often) / n, often.max() / n, (words[1:] == words[:-1]).mean() if n > 1 else 0.0,
            1 - len(np.unique(five)) / len(five) if len(five) else 0.0, 1 - len(set(lines)) / len(lines), np.log1p(len(data) / len(lines)), windows[0].max(), windows[1].max(),
        )
        out[k, len(NAMES) - len(CLASSES) :] = share
    return out


@dataclass(frozen=True)
class Model:
    """``cuts``: for each statistic the values at which its steps begin; ``weights``: one for each step, in the same order."""

    cuts: list[np.ndarray]
    weights: np.ndarray
    shift: float

    def steps(self, x: np.ndarray) -> np.ndarray:
        """0 and 1: which steps each row has reached."""
        return np.concatenate([x[:, [k]] >= own[None, :] for k, own in enumerate(self.cuts)], axis=1).astype(np.float32)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Between 0 and 1, ``THRESHOLD`` where good and bad part. Sums are cut where the result would round to 0 or 1."""
        raw = self.steps(x).astype(float) @ self.weights - self.shift
        return 1 / (1 + np.exp(-np.clip(raw + np.log(THRESHOLD / (1 - THRESHOLD)), -30, 30)))


def learn(x: np.ndarray, good: np.ndarray, pairs: int = PAIRS, seed: int = 7) -> Model:
    """Fit statistics ``x`` (a row each) to labels. If all labels agree, every document gets their side; without labels, 0.5."""
    if not good.any() or good.all():
        empty = [np.zeros(0)] * len(NAMES)
        shift = np.log(THRESHOLD / (1 - THRESHOLD)) if not len(good) else -30.0 if good.all() else 30.0
        return Model(empty, np.zeros(0), float(shift))
    levels = np.linspace(0, 1, STEPS + 1)[1:]
    # quantiles of either side, since the smaller one would hardly move those of all
    cuts = [np.unique(np.concatenate([np.quantile(x[good, k], levels[:-1]), np.quantile(x[~good, k], levels[:-1])])) for k in range(x.shape[1])]
    model = Model(cuts, np.zeros(sum(map(len, cuts))), 0.0)
    steps = model.steps(x)
    rng = np.random.default_rng(seed)
    winners, losers = np.flatnonzero(good), np.flatnonzero(~good)
    n = min(pairs, len(winners) * len(losers))
    # every document takes part about as often as others of its side
    a = np.resize(rng.permutation(winners), n)
    b = rng.permutation(np.resize(losers, n))
    difference = steps[a] - steps[b]
    weights = np.zeros(difference.shape[1], np.float32)
    pace = np.zeros_like(weights)
    for _ in range(ROUNDS):
        miss = 1 / (1 + np.exp(np.clip(difference @ weights, -30, 30)))
        slope = difference.T @ miss / n - SHRINK * weights
        pace += slope * slope
        weights += RATE * slope / (np.sqrt(pace) + 1e-8)
    raw = steps @ weights
    # the quantile that splits off as many as are labelled bad
    low = np.sort(raw)
    bad = int((~good).sum())
    shift = (low[bad - 1] + low[bad]) / 2
    return Model(cuts, weights.astype(float), float(shift))


def held_out(id_col: str) -> Column:
    """Documents whose labels nothing is learned from."""
    return F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).cast("binary")) % 4 == 2


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> Model:
    """A model from at most ``sample`` labelled documents that aren't held out (a documented bound: their statistics come to
    the driver). A document labelled twice counts as bad if one label says so; one that repeats gives one row."""
    chosen = (
        labels.filter(F.col(f"`{label_col}`").isNotNull() & F.col(f"`{id_col}`").isNotNull() & ~held_out(id_col))
        .groupBy(F.col(f"`{id_col}`").alias("id"))
        .agg(F.min(f"`{label_col}`").alias("label"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(sample)
    )
    in_batches_of(docs.sparkSession, ROWS)
    kind = type_of(labels, id_col)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = pa.array(statistics(batch.column("text")).tolist(), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), x], ["id", "label", "x"])

    texts = ids_and_texts(docs, id_col, text_col).join(F.broadcast(chosen), "id").select("id", "label", "text")
    found = texts.mapInArrow(describe, f"id {kind}, label {dict(texts.dtypes)['label']}, x array<double>")
    rows = found.groupBy("id").agg(F.min("label").alias("label"), F.min("x").alias("x")).orderBy("id").collect()
    x = np.array([r.x for r in rows], float).reshape(-1, len(NAMES))
    return learn(x, np.array([r.label > 0 for r in rows], bool))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: id, held_out, score, predicted.

    A text without words (null, empty, blank) has score 0. Repeated rows are scored alike; extra columns are ignored.
    """
    in_batches_of(docs.sparkSession, ROWS)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = statistics(batch.column("text"))
            scores = np.where(x[:, 1] > 0, shared.value.scores(x), 0.0)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(scores)], ["id", "score"])

    out = ids_and_texts(docs, id_col, text_col).mapInArrow(run, f"id {type_of(docs, id_col)}, score double")
    return out.select(F.col("id").alias(id_col), held_out("id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
