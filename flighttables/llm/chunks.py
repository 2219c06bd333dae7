"""Documents packed into chunks of bounded size, the unit by which tables are brought back to their documents.

A chunk holds the whole documents (one at least) that a task read one after another.  The table of chunks is written
once under the shared folder, compressed, so that each later pass that needs the texts together with data from
elsewhere shuffles the packed chunk, and never more than one chunk is unpacked at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from flighttables.llm._common import blocks, in_arrow, staged


def pack(docs: DataFrame, id_col: str, text_col: str, chunk_chars: int = 3_000_000) -> DataFrame:
    """``chunk`` (a number of its own), ``ids``, and ``texts``: the texts (null: empty), zstd-compressed with their sizes."""
    id_type = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        part, seq = TaskContext.get().partitionId(), 0
        ids, texts, held = [], [], 0

        def close():
            nonlocal seq, ids, texts, held
            raw = [t.encode() for t in texts]
            sizes = np.array([len(x) for x in raw], "<u8").tobytes()
            blob = zstandard.ZstdCompressor(level=3).compress(b"".join([len(raw).to_bytes(8, "little"), sizes, *raw]))
            row = pa.RecordBatch.from_arrays(
                [pa.array([(part << 24) | seq], pa.int64()), pa.ListArray.from_arrays([0, len(texts)], pa.concat_arrays(ids)),
                 pa.array([blob], pa.binary())], names=["chunk", "ids", "texts"])
            seq, ids, texts, held = seq + 1, [], [], 0
            return row

        for b in blocks(batches, "text", chunk_chars // 4):
            ids.append(b.column("id"))
            new = [t or "" for t in b.column("text").to_pylist()]
            texts += new
            held += sum(map(len, new))
            if held >= chunk_chars * 3 // 4:
                yield close()
        if texts:
            yield close()

    return staged(in_arrow(docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")), run,
                           f"chunk long, ids array<{id_type}>, texts binary"), "chunks")


def pack_arrays(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed blob; bytes of equal weight stand together, which compresses better."""
    import zstandard
    z = zstandard.ZstdCompressor(level=1)
    parts = []
    for a in arrays:
        raw = z.compress(np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.dtype.itemsize).T.tobytes())
        parts += [len(raw).to_bytes(8, "little"), raw]
    return b"".join(parts)


def unpack_arrays(blob: bytes, *types) -> list[np.ndarray]:
    import zstandard
    z, at, out = zstandard.ZstdDecompressor(), 0, []
    for t in types:
        n = int.from_bytes(blob[at:at + 8], "little")
        raw = np.frombuffer(z.decompress(blob[at + 8:at + 8 + n]), np.uint8)
        out.append(np.ascontiguousarray(raw.reshape(np.dtype(t).itemsize, -1).T).reshape(-1).view(t))
        at += 8 + n
    return out


def unpack(blob: bytes) -> list[bytes]:
    """The texts of a chunk as UTF-8."""
    import zstandard
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = int.from_bytes(raw[:8], "little")
    ends = np.cumsum(np.frombuffer(raw, "<u8", n, 8)).tolist()
    at = 8 + 8 * n
    return [raw[at + s:at + e] for s, e in zip([0, *ends], ends)]
