"""Text keys for matching names across spellings."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column, functions as F


@lru_cache(maxsize=1)
def _letter_table() -> tuple[str, str]:
    """Letters whose canonical decomposition is one ASCII letter plus marks, with that letter.

    ASCII characters that are neither letter nor digit follow without a counterpart: they go.
    """
    accented, plain = ["đ", "Đ"], ["d", "D"]
    for point in range(0x80, 0x3000):
        base, *marks = unicodedata.normalize("NFD", chr(point))
        if base.isascii() and base.isalnum() and marks and all("\u0300" <= m <= "\u036f" for m in marks):
            accented.append(chr(point))
            plain.append(base)
    dropped = [chr(point) for point in range(0x80) if not chr(point).isalnum()]
    return "".join(accented + dropped), "".join(plain)


def name_key(text: Column, drop_prefix: str | None = "tp") -> Column:
    """Lower-case ASCII letters and digits only, marks stripped, a leading city prefix dropped."""
    bare = F.translate(text, *_letter_table())
    # what is left of plain names is ASCII; only other scripts and symbols need the pattern
    is_ascii = F.length(bare) == F.octet_length(bare)
    key = F.lower(F.when(is_ascii, bare).otherwise(F.regexp_replace(bare, "[^a-zA-Z0-9]", "")))
    if drop_prefix is None:
        return key
    return F.regexp_replace(key, f"^{drop_prefix}", "")


def code_key(code: Column) -> Column:
    """Codes compare without case or padding, as under a case-insensitive collation."""
    return F.upper(F.trim(code))
