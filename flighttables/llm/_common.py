"""Helpers shared by the corpus operators: tables, words, Arrow batches and written intermediates."""

from __future__ import annotations

import ctypes
import zlib
from collections.abc import Iterable, Iterator
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flighttables.session import new_output_dir, ship_package

#: The six separators of ``[^\x20\x09-\x0D]+``; ``bytes.split()`` separates at exactly these.
SPACES = b"\x09\x0a\x0b\x0c\x0d\x20"
_SPACES_TEXT = SPACES.decode()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_arrow(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` with the library shipped to the executors; a task that ends gives its free memory back to the system."""
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from fn(batches)
        release_memory()

    return df.mapInArrow(run, schema)


def release_memory() -> None:
    """Give memory that a worker has freed back to the system: workers live on between tasks and stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def carried(docs: DataFrame, columns: list[str], text_col: str) -> tuple[list[F.Column], str]:
    """``columns`` of ``docs`` as ``_c0``..., and the name of the text among them: each column goes to Python once."""
    out = [docs[c].alias(f"_c{i}") for i, c in enumerate(columns)]
    return (out, f"_c{columns.index(text_col)}") if text_col in columns else ([*out, docs[text_col].alias("_text")], "_text")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet under the shared folder and read it back (cuts the lineage)."""
    spark = df.sparkSession
    path = new_output_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` as UTF-8 (null: none)."""
    return text.encode().split() if text else []


def n_spaces(text: str) -> int:
    return sum(map(text.count, _SPACES_TEXT))


def lower_ascii(raw: bytes) -> bytes:
    """A-Z to a-z; ``bytes.lower`` leaves every other byte as it is."""
    return raw.lower()


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser over unsigned integers (vectorised)."""
    x = np.asarray(x, dtype=np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Longest word (in bytes) that a cache of words keeps; longer ones are looked up anew.
KEPT_WORD = 64


class WordCodes:
    """Distinct words of what one task has read so far, numbered; bounded by ``limit`` entries and ``most`` bytes of words.

    When the dictionary is full it is emptied, so codes are comparable only between the words of one
    :meth:`encode` call.
    """

    def __init__(self, limit: int = 1_000_000, most: int = 32_000_000):
        self.limit, self.most, self.held = limit, most, 0
        self.ids: dict[bytes, int] = {}

    def encode(self, tokens: Iterable[bytes]) -> np.ndarray:
        ids = self.ids
        if len(ids) > self.limit or self.held > self.most:
            ids.clear()
            self.held = 0
        known = len(ids)
        out = np.fromiter((ids.setdefault(w, len(ids)) for w in tokens), np.int64)
        self.held += sum(map(len, islice(reversed(ids), len(ids) - known)))
        return out


class WordHashes:
    """64-bit hashes of words, cached (at most about ``limit`` words; 0 is taken for a word not yet seen)."""

    def __init__(self, limit: int = 500_000):
        import xxhash
        self.limit, self.cache, self.fn = limit, {}, xxhash.xxh3_64_intdigest

    def encode(self, tokens: list[bytes]) -> np.ndarray:
        cache = self.cache
        if len(cache) > self.limit:
            cache.clear()
        out = np.fromiter(map(cache.get, tokens, repeat(0)), np.uint64, len(tokens))
        missing = np.flatnonzero(out == 0)
        if len(missing):
            new = [tokens[i] for i in missing.tolist()]
            fn = self.fn
            found = {w: fn(w) for w in dict.fromkeys(new)}
            cache.update((w, h) for w, h in found.items() if len(w) <= KEPT_WORD)
            out[missing] = np.fromiter(map(found.__getitem__, new), np.uint64, len(new))
        return out


def starts_of(lengths: np.ndarray) -> np.ndarray:
    """Exclusive running sum: where each run of ``lengths`` begins in the concatenation."""
    return np.concatenate(([0], np.cumsum(lengths)[:-1])).astype(np.int64) if len(lengths) else np.zeros(0, np.int64)


def blocks(batches: Iterator[pa.RecordBatch], text: str, most: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Slices of the incoming batches with at most about ``most`` characters of ``text`` (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        at = 0
        while at < batch.num_rows:
            n = max(1, int(np.searchsorted(np.cumsum(sizes[at:]), most, "right")))
            yield batch.slice(at, n)
            at += n


def crc_remainder(id_col: str, mod: int) -> F.Column:
    """crc32 of the id as text, modulo ``mod`` (null: null)."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(mod))


def crc32_text(value) -> int:
    return zlib.crc32(str(value).encode())
