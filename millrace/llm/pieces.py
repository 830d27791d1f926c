"""Encoding and decoding with pieces of a unigram model: best path over a double-array trie, byte fallback, marked spaces.

The vocabulary file lists pieces in order of their rank; their log scores follow Zipf's law over that rank. A space becomes
the marker, one is put before the text, and pieces have the marker at their beginning only, so the best path of a text is
those of its segments that start with a marker, one after the other. A worker remembers segments it has met.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.common import ids_and_texts, in_batches_of, type_of

MARK = "▁"
ROWS = 256
#: Added to the lowest score for a character that no piece covers.
UNKNOWN_COST = -10.0
SEGMENT = re.compile(f"\n|{MARK}+[^{MARK}\n]*|[^{MARK}\n]+")


@dataclass(frozen=True)
class Vocabulary:
    pieces: list[str]
    scores: dict[str, float]  # of the pieces a path may use
    ids: dict[str, int]
    byte_ids: list[int]

    @property
    def unknown(self) -> float:
        return min(self.scores.values()) + UNKNOWN_COST


def load(path: str) -> Vocabulary:
    """Pieces of a ``sentencepiece`` file with byte pieces. Control and unused pieces, and those it never forms, are left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    pieces = [model.id_to_piece(i) for i in range(size)]
    usable = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)) and model.get_score(i) > -1e6]
    usable.sort(key=lambda i: (-model.get_score(i), i))
    total = math.log(sum(1 / (r + 1) for r in range(len(usable))))
    scores = {pieces[i]: -math.log(r + 1) - total for r, i in enumerate(usable)}
    byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    return Vocabulary(pieces, scores, {pieces[i]: i for i in usable}, byte_ids)


class DoubleArray:
    """A trie in two arrays: from state s the character with code c leads to ``base[s] + c`` if ``check`` there is s."""

    #: Places looked at together for a free one.
    WINDOW = 512

    def __init__(self, keys: list[str]) -> None:
        self.codes = {c: k for k, c in enumerate(sorted({c for key in keys for c in key}), 1)}
        children: list[dict[int, int]] = [{}]
        ends: list[int] = [-1]
        for value, key in enumerate(keys):
            node = 0
            for c in key:
                code = self.codes[c]
                if code not in children[node]:
                    children[node][code] = len(children)
                    children.append({})
                    ends.append(-1)
                node = children[node][code]
            ends[node] = value
        size = 4 * len(children) + 2 * len(self.codes) + 2 * self.WINDOW
        base, check, value = np.zeros(size, np.int64), np.full(size, -1, np.int64), np.full(size, -1, np.int64)
        check[0] = 0
        taken, free, place = check >= 0, 1, {0: 0}
        for node, own in enumerate(children):  # parents come before their children
            if not own:
                continue
            codes = np.fromiter(own, np.int64)
            while taken[free]:
                free += 1
            low, at = free, -1
            while at < 0:  # the first base, from the first free place on, that has room for all children
                bases = low + np.flatnonzero(~taken[low : low + self.WINDOW]) - codes.min()
                bases = bases[bases >= 0]
                fits = np.flatnonzero(~taken[bases[:, None] + codes].any(1))
                at = int(bases[fits[0]]) if len(fits) else -1
                low += self.WINDOW
            here = place.pop(node)
            base[here] = at
            taken[at + codes] = True
            for code, child in own.items():
                check[at + code], place[child], value[at + code] = here, at + code, ends[child]
        self.base, self.check, self.value = base.tolist(), check.tolist(), value.tolist()


class Encoder:
    """Best paths of segments. ``most`` bounds the segments that are remembered."""

    def __init__(self, vocabulary: Vocabulary, trie: DoubleArray | None = None, most: int = 400_000) -> None:
        self.vocabulary = vocabulary
        self.keys = list(vocabulary.scores)
        self.trie = trie or DoubleArray(self.keys)
        self.scores = [vocabulary.scores[k] for k in self.keys]
        self.ids = [vocabulary.ids[k] for k in self.keys]
        self.lowest = vocabulary.unknown
        self.most = most
        self.known: dict[str, bytes] = {}

    def path(self, segment: str) -> list[int]:
        """Ids of the pieces with the highest sum of scores; of equal ones the path whose last pieces are longest."""
        base, check, value, codes, scores = self.trie.base, self.trie.check, self.trie.value, self.trie.codes, self.scores
        n = len(segment)
        chars = [codes.get(c, 0) for c in segment]
        best, back, piece = [-math.inf] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        best[0] = 0.0
        for i in range(n):
            state, own, single = 0, best[i], False
            for j in range(i, n):
                code = chars[j]
                if not code:
                    break
                step = base[state] + code
                if check[step] != state:
                    break
                state = step
                if (v := value[state]) >= 0:
                    single |= j == i
                    if own + scores[v] > best[j + 1]:
                        best[j + 1], back[j + 1], piece[j + 1] = own + scores[v], i, v
            if not single and own + self.lowest > best[i + 1]:
                best[i + 1], back[i + 1], piece[i + 1] = own + self.lowest, i, -1
        out: list[int] = []
        at = n
        while at:
            if piece[at] >= 0:
                out.append(self.ids[piece[at]])
            else:
                out.extend(self.vocabulary.byte_ids[b] for b in reversed(segment[back[at] : at].encode("utf-8", "surrogatepass")))
            at = back[at]
        return out[::-1]

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text; an empty one has none."""
        if not text:
            return np.zeros(0, np.uint32)
        segments = SEGMENT.findall(MARK + text.replace(" ", MARK))
        known = self.known
        for s in set(segments).difference(known):
            if len(known) >= self.most:
                known.clear()
            known[s] = np.array(self.path(s), "<u4").tobytes()
        try:
            return np.frombuffer(b"".join(map(known.__getitem__, segments)), "<u4")
        except KeyError:  # the memory was cleared on the way
            return np.concatenate([np.array(self.path(s), np.uint32) for s in segments])


class Decoder:
    def __init__(self, vocabulary: Vocabulary) -> None:
        self.bytes = [p.encode() for p in vocabulary.pieces]
        for b, i in enumerate(vocabulary.byte_ids):
            self.bytes[i] = bytes([b])

    def decode(self, ids: np.ndarray) -> str:
        """The text of some ids: bytes are joined, markers become spaces and the first one goes."""
        text = b"".join(map(self.bytes.__getitem__, ids.tolist())).decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if text[:1] == " " else text


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_pieces, n_bytes (byte pieces among them), ids, round_trip.

    ``round_trip`` tells whether decoding the ids gives the text back; that fails only where a text has the marker itself. A
    null text counts as empty and has no ids. Repeated rows are encoded alike; extra columns are ignored.
    """
    in_batches_of(docs.sparkSession, ROWS)
    kind = type_of(docs, id_col)
    vocabulary = load(model)
    trie = DoubleArray(list(vocabulary.scores))
    low, high = min(vocabulary.byte_ids), max(vocabulary.byte_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = Encoder(vocabulary, trie), Decoder(vocabulary)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            ids = [encoder.encode(t) for t in texts]
            yield pa.RecordBatch.from_pydict(
                {
                    "id": batch.column("id"),
                    "n_pieces": pa.array([len(x) for x in ids], pa.int64()),
                    "n_bytes": pa.array([int(((x >= low) & (x <= high)).sum()) for x in ids], pa.int64()),
                    "ids": pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())),
                    "round_trip": pa.array([decoder.decode(x) == t for x, t in zip(ids, texts, strict=True)], pa.bool_()),
                }
            )

    out = ids_and_texts(docs, id_col, text_col).mapInArrow(run, f"id {kind}, n_pieces long, n_bytes long, ids array<int>, round_trip boolean")
    return out.withColumnRenamed("id", id_col)
