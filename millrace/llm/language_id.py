"""Language identification by mixtures: each document's language shares, by expectation-maximisation over its n-grams.

Letter trigrams are counted per language in a hashed table of fixed size. A document's shares are fitted over all languages;
then growing sets of its strongest languages are fitted again, and the set with the best penalised likelihood is taken.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import ids_and_texts, in_batches_of, type_of

#: Buckets of the n-gram table. With the number of languages it bounds what goes to the driver and to the workers.
BUCKETS = 1 << 15
LANGUAGES = 512
SMOOTHING = 0.5
STEPS = 12
#: Cost of a further language, in units of log(n) of the document's n-grams.
PENALTY = 3.0
ROWS = 256
ENTRIES = 400_000
UNKNOWN = "und"

_LETTER = np.frombuffer(bytes(chr(c).isalpha() for c in range(0x10000)), np.bool_)


def held_out(id_col: str) -> Column:
    """Documents that nothing is learned from."""
    return F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).cast("binary")) % 4 == 2


def _buckets(text: str) -> np.ndarray | None:
    """Hashed letter trigrams of a text, or None if it has no letter. What is no letter counts as a space."""
    points = np.frombuffer(f"  {text.lower()}  ".encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = np.where(points < 0x10000, _LETTER[np.minimum(points, 0xFFFF)], False)
    for k in np.flatnonzero(points >= 0x10000):
        letter[k] = chr(points[k]).isalpha()
    if not letter.any():
        return None
    clean = np.where(letter, points, 0x20).astype(np.uint64)
    some = letter[:-2] | letter[1:-1] | letter[2:]
    with np.errstate(over="ignore"):
        mixed = ((clean[:-2] << np.uint64(42)) ^ (clean[1:-1] << np.uint64(21)) ^ clean[2:]) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(49)).astype(np.int64)[some]


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages and their n-gram probabilities (bucket by language), from rows with a language that aren't held out."""
    in_batches_of(docs.sparkSession, ROWS)
    rows = docs.filter(F.col(f"`{lang_col}`").isNotNull() & ~held_out(id_col)).select(
        F.col(f"`{lang_col}`").alias("lang"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                own = sums.setdefault(lang, np.zeros(BUCKETS, np.int64))
                found = _buckets(text)
                if found is not None:
                    own += np.bincount(found, minlength=BUCKETS)
        for lang, own in sums.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_pydict({"lang": [lang] * len(at), "bucket": pa.array(at), "n": pa.array(own[at])})

    # as many rows as buckets and languages, whatever the input
    sums = rows.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = sums.toPandas()
    langs = sorted(found["lang"].unique())
    if len(langs) > LANGUAGES:
        raise ValueError(f"{len(langs)} languages: the table is for {LANGUAGES} at most")
    table = np.full((BUCKETS, len(langs)), SMOOTHING)
    table[found["bucket"].to_numpy(), [langs.index(x) for x in found["lang"]]] += found["n"].to_numpy()
    return langs, (table / table.sum(0)).astype(np.float32) if langs else table.astype(np.float32)


def _fit(p: np.ndarray, x: np.ndarray, owner: np.ndarray, starts: np.ndarray, total: np.ndarray, shares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shares after some steps from ``shares`` (zeros stay zero), and the log-likelihood of each document."""
    for _ in range(STEPS):
        mixed = np.einsum("el,el->e", p, shares[owner])
        shares = shares * np.add.reduceat(p * (x / mixed)[:, None], starts, axis=0) / total[:, None]
    mixed = np.einsum("el,el->e", p, shares[owner])
    return shares, np.add.reduceat(x * np.log(mixed), starts)


def mixtures(found: list[np.ndarray], table: np.ndarray) -> np.ndarray:
    """Language shares of each document (row), zero outside the chosen set."""
    langs = table.shape[1]
    at, x, sizes = [], [], []
    for buckets in found:
        counts = np.bincount(buckets, minlength=BUCKETS)
        own = np.flatnonzero(counts)
        at.append(own)
        x.append(counts[own])
        sizes.append(len(own))
    x = np.concatenate(x).astype(np.float32)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    p = table[np.concatenate(at)]
    total = np.add.reduceat(x, starts)
    cost = PENALTY * np.log(np.maximum(total, 2))
    single = np.add.reduceat(x[:, None] * np.log(p), starts, axis=0)
    best = np.eye(langs, dtype=np.float32)[single.argmax(1)]
    worth = single.max(1)
    if langs == 1:
        return best
    full, _ = _fit(p, x, owner, starts, total, np.full((len(sizes), langs), 1 / langs, np.float32))
    # the best single language first, then by share
    rank = np.argsort(np.argsort(-(full + 2 * best), axis=1), axis=1)
    for k in range(2, langs + 1):
        start = np.where(rank < k, full + 0.01, 0).astype(np.float32)
        shares, likelihood = _fit(p, x, owner, starts, total, start / start.sum(1, keepdims=True))
        better = likelihood - (k - 1) * cost > worth
        if not better.any():
            break
        best[better], worth[better] = shares[better], (likelihood - (k - 1) * cost)[better]
    return best


def predict(docs: DataFrame, langs: list[str], table: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, held_out, lang_pred, score, langs, shares.

    ``lang_pred`` has the largest share, which is the score; ``langs`` and ``shares`` list the chosen set, largest first. A null
    text, or one without a letter, is ``und`` with score 0, as is everything if nothing was learned. Extra columns are ignored.
    """
    in_batches_of(docs.sparkSession, ROWS)
    kind = type_of(docs, id_col)
    rows = ids_and_texts(docs, id_col, text_col)
    names = np.array(langs, object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_buckets(t) for t in batch.column("text").to_pylist()]
            results: list[tuple[list[str], list[float]]] = [([], [])] * len(found)
            todo = [k for k, b in enumerate(found) if b is not None and langs]
            while todo:
                some, entries = [], 0
                while todo and (not some or entries < ENTRIES):
                    some.append(todo.pop())
                    entries += min(len(found[some[-1]]), BUCKETS)
                for k, shares in zip(some, mixtures([found[k] for k in some], table), strict=True):
                    order = np.argsort(-shares, kind="stable")[: max(1, int((shares > 0.005).sum()))]
                    results[k] = (names[order].tolist(), shares[order].astype(float).tolist())
            yield pa.RecordBatch.from_pydict(
                {
                    "id": batch.column("id"),
                    "lang_pred": pa.array([r[0][0] if r[0] else UNKNOWN for r in results], pa.string()),
                    "score": pa.array([min(1.0, r[1][0]) if r[1] else 0.0 for r in results], pa.float64()),
                    "langs": pa.array([r[0] for r in results], pa.list_(pa.string())),
                    "shares": pa.array([r[1] for r in results], pa.list_(pa.float64())),
                }
            )

    out = rows.mapInArrow(run, f"id {kind}, lang_pred string, score double, langs array<string>, shares array<double>")
    return out.select(F.col("id").alias(id_col), held_out("id").alias("held_out"), "lang_pred", "score", "langs", "shares")


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Learn from the labelled documents and predict all."""
    return predict(docs, *train(docs, id_col, text_col, lang_col), id_col, text_col)
