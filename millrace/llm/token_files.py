"""Token ids of all documents in flat binary files, in the order of the documents' ids.

Each part has three files: ``.ids`` (the ids as unsigned integers, two bytes each where the vocabulary allows), ``.offsets``
(64-bit, one more than there are documents) and ``.docs`` (an Arrow file with the documents' ids). Parts are numbered in
order; where a part starts in the whole is the sum of those before it. Files are written under a name of the attempt and
then moved into place, so a repeated task replaces what a lost one left. The folder has to be mounted by all executors.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.chunks import ChunkEncoder
from millrace.llm.common import ids_and_texts, in_batches_of, landed, shared_folder, type_of

END_ID = 1
ROWS = 512


def is_mounted(folder: str) -> bool:
    return urlparse(folder).scheme in ("", "file")


def local_path(folder: str) -> str:
    found = urlparse(folder)
    if not is_mounted(folder):
        raise ValueError(f"memory-mapped files need a folder that executors mount, not {found.scheme}://")
    return found.path


def id_type(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def _stem(folder: str, part: int) -> str:
    return os.path.join(folder, f"part-{part:07d}")


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, dtype: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the files and return the manifest: part, docs, tokens.

    A null text counts as empty: it has the end id alone. A null id comes first; rows that repeat an id follow one another,
    ordered by a hash of their text. No rows give no parts. Extra columns are ignored.
    """
    spark = docs.sparkSession
    in_batches_of(spark, ROWS)
    folder = local_path(folder)
    rows = ids_and_texts(docs, id_col, text_col).withColumn("tie", F.xxhash64("text"))
    rows = rows.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        encoder = ChunkEncoder.get(tokenizer, dtype)
        end = np.array([end_id], encoder.dtype).tobytes()
        stem, own = _stem(folder, part), f".{uuid.uuid4().hex}"
        os.makedirs(folder, exist_ok=True)
        lengths: list[int] = []
        out = None
        with open(f"{stem}.ids{own}", "wb") as ids:
            for batch in batches:
                if out is None:
                    out = pa.OSFile(f"{stem}.docs{own}", "wb")
                    names = pa.ipc.new_file(out, pa.schema([batch.schema.field("id")]))
                names.write_batch(batch.select(["id"]))
                for found in encoder.encode(batch.column("text")):
                    ids.write(found)
                    ids.write(end)
                    lengths.append(len(found) // encoder.dtype.itemsize + 1)
        if out is None or not lengths:
            os.unlink(f"{stem}.ids{own}")
            return
        names.close()
        out.close()
        np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]).astype("<u8").tofile(f"{stem}.offsets{own}")
        for kind in ("ids", "docs", "offsets"):
            os.replace(f"{stem}.{kind}{own}", f"{stem}.{kind}")
        yield pa.RecordBatch.from_pydict({"part": [part], "docs": [len(lengths)], "tokens": [sum(lengths)]})

    return landed(rows.select("id", "text").mapInArrow(write, "part long, docs long, tokens long"))


def part_bases(manifest: DataFrame) -> list[tuple[int, int]]:
    """(part, tokens of all parts before it). One row per file part comes to the driver, none per document."""
    out, total = [], 0
    for row in manifest.orderBy("part").collect():
        out.append((row["part"], total))
        total += row["tokens"]
    return out


def open_part(folder: str, part: int, dtype: str) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Memory-mapped ids and offsets of a part, and its documents' ids."""
    stem = _stem(local_path(folder), part)
    names = pa.ipc.open_file(pa.memory_map(f"{stem}.docs")).read_all().column("id").combine_chunks()
    return np.memmap(f"{stem}.ids", dtype, "r"), np.memmap(f"{stem}.offsets", "<u8", "r"), names


def read_tokens(spark: SparkSession, folder: str, manifest: DataFrame, dtype: str, id_type_name: str, id_col: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """Documents as the files have them: id, start, n_tokens, ids_crc32 and, if asked for, the ids."""
    bases = part_bases(manifest)
    schema = f"`{id_col}` {id_type_name}, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    parts = spark.createDataFrame(bases, "part long, base long")
    if bases:
        parts = parts.repartitionByRange(len(bases), "part")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, base in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids, offsets, names = open_part(folder, part, dtype)
                for at in range(0, len(names), 4096):
                    ends = offsets[at : min(at + 4096, len(names)) + 1].astype(np.int64)
                    cut = [ids[a:b] for a, b in zip(ends, ends[1:], strict=False)]
                    columns = {
                        id_col: names[at : at + 4096],
                        "start": pa.array(base + ends[:-1]),
                        "n_tokens": pa.array(np.diff(ends)),
                        "ids_crc32": pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in cut], pa.int64()),
                    }
                    if with_ids:
                        columns["ids"] = pa.array([x.astype(np.int32) for x in cut], pa.list_(pa.int32()))
                    yield pa.RecordBatch.from_pydict(columns)

    return parts.mapInArrow(read, schema)


def through_files(docs: DataFrame, tokenizer: str, vocabulary: int, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None, with_ids: bool = False) -> DataFrame:
    """Write all documents and return what the files hold."""
    spark = docs.sparkSession
    folder = folder or shared_folder(spark)
    dtype = id_type(vocabulary)
    manifest = write_tokens(docs, folder, tokenizer, dtype, END_ID, id_col, text_col)
    return read_tokens(spark, folder, manifest, dtype, type_of(docs, id_col), id_col, with_ids)
