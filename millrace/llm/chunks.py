"""Whole texts to token ids with a ``tokenizers`` file, remembering what each chunk between spaces encodes to.

Words repeat, and encoding them is slow; the tokenizer only sees chunks that a worker hasn't met lately. A batch is cut into
chunks and put together again as arrays. That is exact for tokenizers which never join anything across a single space or line
break, nor letters with a point or comma: those whose pre-tokenizer cuts there. Other tokenizers get whole texts, as do texts
with any other white space or with two blanks in a row.
"""

from __future__ import annotations

import json
import os
import sys
from array import array

import numpy as np
import pyarrow as pa

_BLANK, _LINE = 0x20, 0x0A
_POINT, _LETTER = np.zeros(256, bool), np.zeros(256, bool)
_POINT[list(b".,")] = True
_LETTER[[*range(65, 91), *range(97, 123)]] = True
#: Length of a chunk whose texts are encoded whole.
_WHOLE = -1


def cuts_at_blanks(file: dict) -> bool:
    """Whether a tokenizer's file names a pre-tokenizer that cuts before a blank, at line breaks and between letters and points."""
    found = file.get("pre_tokenizer") or {}
    steps = found.get("pretokenizers", [found])
    if any(x.get("type") == "ByteLevel" and x.get("use_regex", True) and not x.get("add_prefix_space") for x in steps):
        return True
    # white space goes, and runs of letters stand alone
    return any(x.get("type") == "Split" and "\\p{L}]+" in str(x.get("pattern", {}).get("Regex", "")) for x in steps)


class ChunkEncoder:
    """Texts to the bytes of their ids. One is kept per worker process, tokenizer and integer type."""

    _kept: dict[tuple, ChunkEncoder] = {}

    def __init__(self, path: str, dtype: str, most_chunks: int) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            self.in_chunks = cuts_at_blanks(json.load(file))
        self.dtype = np.dtype(dtype)
        self.kind = {2: "H", 4: "I"}[self.dtype.itemsize]
        if sys.byteorder != "little" or array(self.kind).itemsize != self.dtype.itemsize:
            raise RuntimeError("ids are kept as little-endian integers")
        self.most_chunks = most_chunks
        self._forget()

    def _forget(self) -> None:
        # a chunk's number, and where its ids lie in one long array
        self.known: dict[bytes, int] = {}
        self.ids, self.starts, self.lengths = array(self.kind), array("q"), array("q")

    @classmethod
    def get(cls, path: str, dtype: str = "<u4", most_chunks: int = 1_600_000) -> ChunkEncoder:
        key = (path, dtype, most_chunks)
        if key not in cls._kept:
            cls._kept[key] = cls(path, dtype, most_chunks)
        return cls._kept[key]

    def whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array(self.kind, e.ids).tobytes() for e in found]

    def _note(self, chunks: list[bytes], lengths: list[int]) -> None:
        """The last ids are those of ``chunks``, one after the other."""
        at = len(self.starts)
        self.known.update(zip(chunks, range(at, at + len(chunks)), strict=True))
        sizes = np.maximum(np.array(lengths, np.int64), 0)
        first = len(self.ids) - int(sizes.sum())
        self.starts.frombytes((first + np.cumsum(sizes) - sizes).tobytes())
        self.lengths.extend(lengths)

    def _learn(self, chunks: list[bytes]) -> None:
        """Encode new chunks. A word with a point or comma after it is put together from both.

        A chunk with further blanks in it, or nothing else, is noted as one that only whole texts can have.
        """
        known, bare, build, unfit = self.known, {}, [], []
        for raw in chunks:
            chunk = raw.decode()
            plain = chunk[1:] if chunk[0] == " " else chunk
            if plain.split() != [plain] and chunk != "\n":
                unfit.append(raw)
            elif plain[-1] in ".," and plain[:-1].isalpha():
                build.append(raw)
                bare.update((x, y) for x, y in ((chunk[:-1], raw[:-1]), (chunk[-1], raw[-1:])) if y not in known)
            else:
                bare[chunk] = raw
        self._note(unfit, [_WHOLE] * len(unfit))
        lengths = []
        for found in self.tokenizer.encode_batch_fast(list(bare), add_special_tokens=False):
            own = found.ids
            self.ids.extend(own)
            lengths.append(len(own))
        self._note(list(bare.values()), lengths)
        lengths = []
        for raw in build:
            parts = [known[raw[:-1]], known[raw[-1:]]]
            for k in parts:
                self.ids.extend(self.ids[self.starts[k] : self.starts[k] + self.lengths[k]])
            lengths.append(sum(self.lengths[k] for k in parts))
        self._note(build, lengths)

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """The ids of each text as bytes of the chosen type."""
        if isinstance(texts, list):
            texts = pa.array(texts, pa.large_string())
        if not self.in_chunks:
            return self.whole(texts.to_pylist())
        if not len(texts):
            return []
        if len(self.known) > self.most_chunks:
            self._forget()
        texts = texts.cast(pa.large_string())
        offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
        data = texts.buffers()[2]
        data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
        offsets = offsets - offsets[0]

        # a chunk is a line break, or a word with the blank before it; a point or comma that ends it stands alone
        blank, line = data == _BLANK, data == _LINE
        space = blank | line
        last = np.ones(len(data) + 1, bool)
        last[:-1] = space
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        last |= edge
        edge[:-1] |= space
        edge[1:] |= line
        edge[1:-1] |= _POINT[data[1:]] & _LETTER[data[:-1]] & last[2:]
        starts = np.flatnonzero(edge[:-1])
        counts = np.diff(np.searchsorted(starts, offsets))
        ends = np.append(starts[1:], len(data))

        # a lone blank, or a line break without a word after it, makes a text one that is encoded whole
        first, alone = data[starts], ends - starts == 1
        odd_chunk = alone & (first == _BLANK)
        no_word = np.append(space[starts[1:]], True)
        no_word[np.cumsum(counts)[counts > 0] - 1] = True
        odd_chunk |= (first == _LINE) & no_word

        chunks = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(data))), pa.py_buffer(data)])
        found = chunks.dictionary_encode()
        names = found.dictionary.to_numpy(zero_copy_only=False).tolist()
        if missing := [x for x in names if x not in self.known]:
            self._learn(missing)
        codes = np.fromiter(map(self.known.__getitem__, names), np.int64, len(names))[found.indices.to_numpy()]

        lengths = np.frombuffer(self.lengths, np.int64)[codes]
        odd_chunk |= lengths == _WHOLE
        owner_ends = np.concatenate([[0], np.cumsum(counts)])
        unfit = np.concatenate([[0], np.cumsum(odd_chunk)])[owner_ends]
        odd = np.flatnonzero(unfit[1:] != unfit[:-1])
        lengths = np.maximum(lengths, 0)
        ends = np.concatenate([[0], np.cumsum(lengths)])
        places = np.repeat(np.frombuffer(self.starts, np.int64)[codes] - ends[:-1], lengths) + np.arange(ends[-1])
        ids = np.frombuffer(self.ids, self.dtype)[places].tobytes() if len(places) else b""
        edges = (ends[owner_ends] * self.dtype.itemsize).tolist()
        out = [ids[a:b] for a, b in zip(edges, edges[1:], strict=False)]
        for k, own in zip(odd.tolist(), self.whole(texts.take(pa.array(odd)).to_pylist()) if len(odd) else [], strict=True):
            out[k] = own
        return out
