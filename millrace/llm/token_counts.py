"""Token counts without encoding: distinct pre-tokens share a trie, and each prefix is scored once.

The best score and piece count of a prefix depend on nothing that follows, so they are computed once for all pre-tokens
that share it; a pre-token's count stands at its last node. A document's count is the sum over its pre-tokens.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.common import ids_and_texts, in_batches_of, type_of
from millrace.llm.pieces import MARK, ROWS, SEGMENT, Vocabulary, load


class PrefixCounts:
    """Counts of pre-tokens. ``most`` bounds the pre-tokens that are remembered."""

    def __init__(self, vocabulary: Vocabulary, most: int = 400_000) -> None:
        self.scores, self.lowest = vocabulary.scores, vocabulary.unknown
        self.longest = max(map(len, vocabulary.scores))
        self.most = most
        self.known: dict[str, int] = {}

    def learn(self, tokens: set[str]) -> None:
        """Walk the trie of new pre-tokens in order. Nodes on the way to the present one are kept on a stack, where its
        forward score and count stand; what two neighbours share isn't computed again."""
        best, count = [0.0], [0]
        before = ""
        scores, longest = self.scores, self.longest
        for token in sorted(tokens):
            shared = 0
            for a, b in zip(before, token, strict=False):
                if a != b:
                    break
                shared += 1
            del best[shared + 1 :], count[shared + 1 :]
            for end in range(shared + 1, len(token) + 1):
                # starts in ascending order, as the encoder tries them: of equal paths the longest last piece stays
                top, n = -math.inf, 0
                for start in range(max(0, end - longest), end):
                    score = scores.get(token[start:end])
                    if score is not None and best[start] + score > top:
                        top, n = best[start] + score, count[start] + 1
                last = token[end - 1]
                if last not in scores and best[end - 1] + self.lowest > top:
                    top, n = best[end - 1] + self.lowest, count[end - 1] + len(last.encode("utf-8", "surrogatepass"))
                best.append(top)
                count.append(n)
            self.known[token] = count[-1]
            before = token

    def count(self, texts: list[str]) -> tuple[list[int], list[int]]:
        """Pre-tokens and tokens of each text."""
        if len(self.known) > self.most:
            self.known.clear()
        split = [SEGMENT.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        self.learn({s for own in split for s in own}.difference(self.known))
        return [len(own) for own in split], [sum(map(self.known.__getitem__, own)) for own in split]


def count(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_pretokens, n_tokens (as many as encoding gives).

    A null or empty text has none. Repeated rows are counted alike; extra columns are ignored.
    """
    in_batches_of(docs.sparkSession, ROWS)
    vocabulary = load(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = PrefixCounts(vocabulary)
        for batch in batches:
            pretokens, tokens = counts.count(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_pydict({"id": batch.column("id"), "n_pretokens": pa.array(pretokens, pa.int64()), "n_tokens": pa.array(tokens, pa.int64())})

    out = ids_and_texts(docs, id_col, text_col).mapInArrow(run, f"id {type_of(docs, id_col)}, n_pretokens long, n_tokens long")
    return out.withColumnRenamed("id", id_col)
