"""Two-way flag labels, lookups with a default and hierarchy paths."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import constants as k
from .text import name_key


def flag_label(flag: Column, labels) -> Column:
    return F.when(flag, labels[0]).otherwise(F.lit(labels[1]))


def _mapped(value: Column, mapping: dict, default: str) -> Column:
    pairs = [F.lit(item) for pair in mapping.items() for item in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), value), F.lit(default))


def macro_region(region: Column, mapping=k.MACRO_REGIONS, default=k.MACRO_REGION_OTHER) -> Column:
    """Literal comparison: a region spelt with '&' does not match one spelt with 'và'."""
    return _mapped(region, mapping, default)


def macro_region_normalised(region: Column, mapping=k.MACRO_REGIONS, default=k.MACRO_REGION_OTHER) -> Column:
    """Variant that compares letters only and reads '&' as 'và'."""
    import re
    import unicodedata

    def key(text: str) -> str:
        text = unicodedata.normalize("NFD", text.replace("đ", "d").replace("Đ", "D"))
        return re.sub(r"[^a-z0-9]", "", text.lower())

    spelt = F.replace(region, F.lit("&"), F.lit("và"))
    return _mapped(name_key(spelt, drop_prefix=None), {key(n): v for n, v in mapping.items()}, default)


def scope_or_default(scope: Column, default=k.DEFAULT_SCOPE) -> Column:
    return F.coalesce(scope, F.lit(default))


def hierarchy_path(*levels: Column) -> Column:
    """Levels joined by ' > '; NULL when any level is NULL."""
    parts = [levels[0]]
    for level in levels[1:]:
        parts += [F.lit(" > "), level]
    return F.concat(*parts)
