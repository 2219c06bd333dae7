"""Token counts of whole documents; huge documents are encoded in overlapping chunks.

A document of more than ``chunk_bytes`` bytes is encoded chunk by chunk, each chunk overlapping
the next one.  Two neighbouring encodings are spliced at a *stable boundary* inside the overlap: a
space that follows a character other than a space.  When no piece of the vocabulary holds a space
after another character (checked on the loaded vocabulary) no merge can cross such a place, so the
pieces on either side do not depend on what lies beyond it.  A splice is taken only where both
encodings do have a token boundary at the place; otherwise the overlap is doubled, at the worst up to
the end of the document.  With a vocabulary that fails the check every document is encoded whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from flighttables.llm._common import blocks, in_arrow

SPACE = "▁"


@lru_cache(maxsize=4)
def _encoder(path: str):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = (sp.id_to_piece(i) for i in range(sp.get_piece_size()))
    return sp, not any(SPACE in p.lstrip(SPACE) for p in pieces)


def _boundaries(sp, raw: bytes, begin: int, end: int) -> list[int]:
    """Where (byte of the document) each token of ``raw[begin:end]`` starts."""
    return [begin + p.begin for p in sp.encode(raw[begin:end].decode(), return_type="proto").pieces]


def _whole(raw: bytes, at: int) -> int:
    """``at`` moved back to the start of a character."""
    while 0 < at < len(raw) and raw[at] & 0xC0 == 0x80:
        at -= 1
    return min(at, len(raw))


def _stable(raw: bytes, lo: int, hi: int) -> Iterator[int]:
    """Places in (lo, hi) with a space after a character that the model does not take for one, the last first."""
    at = raw.rfind(b" ", lo, hi)
    while at > lo:
        if raw[at - 1] != 0x20 and raw[max(0, at - 3):at] != SPACE.encode():
            yield at
        at = raw.rfind(b" ", lo, at)


def count_one(sp, raw: bytes, chunk: int, overlap: int) -> int:
    """Tokens of the UTF-8 text ``raw``, spliced from chunks of about ``chunk`` bytes."""
    total, begin, have = 0, 0, 0  # the tokens that start before `have` are counted
    end = _whole(raw, chunk)
    left = _boundaries(sp, raw, begin, end)
    while end < len(raw):
        at, width, in_left = None, overlap, set(left)
        while at is None and width < end - have:
            lo = _whole(raw, end - width)
            upto = _whole(raw, lo + chunk + width)
            right = _boundaries(sp, raw, lo, upto)
            in_right = set(right)
            at = next((b for b in _stable(raw, lo, end) if b in in_left and b in in_right), None)
            width *= 2
        if at is None:  # no splice in all that is not yet counted: lengthen the chunk itself
            end = _whole(raw, end + max(chunk, end - begin))
            left = _boundaries(sp, raw, begin, end)
            continue
        total += sum(have <= b < at for b in left)
        begin, have, left, end = lo, at, right, upto
    return total + sum(b >= have for b in left)


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096, chunk_bytes: int = 32_768,
                 overlap_bytes: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit`` (``n_tokens > limit``).

    ``model_path`` is a sentencepiece model that every node has.  Null and empty texts have 0 bytes and
    0 tokens.  Repeated ids give repeated rows; other columns are ignored, whatever their names.
    """
    id_type = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp, safe = _encoder(model_path)
        for b in blocks(batches, "text"):
            n_bytes, n_tokens = [], []
            for t in b.column("text").to_pylist():
                raw = (t or "").encode()
                n_bytes.append(len(raw))
                n_tokens.append(count_one(sp, raw, chunk_bytes, overlap_bytes) if safe and len(raw) > chunk_bytes
                                else len(sp.encode(t or "")))
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()),
                 pa.array([n > limit for n in n_tokens], pa.bool_())],
                names=[id_col, "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    return in_arrow(rows, run, f"`{id_col}` {id_type}, n_bytes long, n_tokens long, over_limit boolean")
