"""Byte text (T9, T24): fixed-size ``char`` arrays stored as signed bytes -> strings.

Each element is masked to a raw byte (``& 0xFF``), the array is cut at the first NUL and
the bytes are decoded as UTF-8, replacing invalid sequences.  Native expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ._util import as_col


def _to_raw(arr: Column) -> Column:
    return F.transform(arr, lambda b: b.cast("int").bitwiseAND(F.lit(255)))


def char_array_to_text(arr) -> Column:
    """array<signed byte as int> -> string: mask, cut at first NUL, UTF-8 with replacement.

    Bytes become Latin-1 characters (code point = byte value), are joined and encoded back
    as Latin-1, which yields exactly the raw bytes; those are read as UTF-8.  Linear in the
    array length.
    """
    raw = _to_raw(as_col(arr))
    nul = F.array_position(raw, 0)
    cut = F.when(nul == 0, raw).otherwise(F.slice(raw, F.lit(1), (nul - 1).cast("int")))
    latin = F.array_join(F.transform(cut, lambda b: F.chr(b)), "")
    return F.make_valid_utf8(F.encode(latin, "ISO-8859-1").cast("string"))


def char_arrays_to_texts(arrs) -> Column:
    """array<array<byte>> -> array<string>, each element cut at its own NUL."""
    return F.transform(as_col(arrs), char_array_to_text)


def text_to_signed_bytes(text) -> Column:
    """UTF-8 bytes of a string as signed ints (the form raw logs store ``char`` in).

    The UTF-8 bytes are read as Latin-1 so each byte becomes one character whose code point
    is the byte value; splitting into characters is linear in the text length.
    """
    latin = F.decode(F.encode(as_col(text), "UTF-8"), "ISO-8859-1")
    chars = F.when(F.length(latin) > 0, F.split(latin, "")).otherwise(F.array().cast("array<string>"))
    return F.transform(chars, lambda c: F.when(F.ascii(c) > 127, F.ascii(c) - 256).otherwise(F.ascii(c)))
