"""Text expressions: slugs, numbers in text, fingerprints, path dates."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

# Letters whose NFD decomposition is a base letter plus marks.
# (`đ` has no decomposition, so it is absent and falls to the separator.)
_MARKED = "".join(chr(c) for c in range(0xC0, 0x1F00) if unicodedata.decomposition(chr(c))) + "".join(
    chr(c) for c in range(0x1EA0, 0x1EFA)
)


def _base_letter(letter: str) -> str:
    plain = [c for c in unicodedata.normalize("NFD", letter) if unicodedata.category(c) != "Mn"]
    return plain[0] if len(plain) == 1 else ""


_FOLD = {c: _base_letter(c) for c in dict.fromkeys(_MARKED) if _base_letter(c).isascii() and _base_letter(c)}
_MARKS = "".join(chr(c) for c in range(0x300, 0x370))


def strip_accents(text: Column) -> Column:
    """Replace accented letters by their base letter, drop loose marks."""
    return F.translate(text, "".join(_FOLD) + _MARKS, "".join(_FOLD.values()))


def slug(text: Column) -> Column:
    """``' Căn hộ/Chung cư '`` -> ``can_ho_chung_cu``; other characters become ``_``."""
    folded = strip_accents(F.lower(F.trim(text)))
    return F.regexp_replace(F.regexp_replace(folded, "[^a-z0-9]+", "_"), "^_+|_+$", "")


def slug_label(value: str) -> str:
    """The same slug for one label, used when a label becomes a column name."""
    plain = "".join(
        c for c in unicodedata.normalize("NFD", str(value).strip().lower()) if unicodedata.category(c) != "Mn"
    )
    return re.sub("[^a-z0-9]+", "_", plain).strip("_")


def slug_name(name: str) -> str:
    """Slug of a column name: encoded spaces become ``_``, other characters vanish."""
    decoded = re.sub("_?x20", "_", name)
    plain = "".join(c for c in unicodedata.normalize("NFD", decoded) if unicodedata.category(c) != "Mn")
    kept = re.sub("[^a-z0-9_]", "", plain.lower())
    return re.sub("_+", "_", kept).strip("_")


def extract_number(text: Column) -> Column:
    """First run of digits, commas and dots as a double; commas read as dots."""
    run = F.regexp_extract(text, r"[0-9,.]+", 0)
    return F.replace(run, F.lit(","), F.lit(".")).try_cast("double")


def strip_pattern(text: Column, pattern: str) -> Column:
    """Remove every match and trim."""
    return F.trim(F.regexp_replace(text, pattern, ""))


def date_from_path(path: Column) -> Column:
    """``.../date=2026-01-31/...`` -> ``2026-01-31`` as text, null without a match."""
    return F.nullif(F.regexp_extract(path, r"date=(\d{4}-\d{2}-\d{2})", 1), F.lit(""))


def fingerprint(columns: Sequence[str], separator: str = "||", null_token: str | None = None) -> Column:
    """SHA-256 of the joined columns. Nulls are skipped unless ``null_token`` is given."""
    parts = [F.col(c).cast("string") for c in columns]
    if null_token is not None:
        parts = [F.coalesce(p, F.lit(null_token)) for p in parts]
    return F.sha2(F.concat_ws(separator, *parts), 256)


def bool_to_int(text: Column) -> Column:
    """Truthy / falsy spellings to 1 / 0, everything else null."""
    word = text.cast("string")
    return F.when(word.isin("TRUE", "true", "True", "1"), 1).when(word.isin("FALSE", "false", "False", "0"), 0)


def first_non_empty(*columns: Column) -> Column:
    """First value that is neither null, '' nor 0, as text."""
    texts = [c.cast("string") for c in columns]
    return F.coalesce(*[F.when(~t.isin("", "0"), t) for t in texts])


def contains_any(text: Column, terms: Sequence[str]) -> Column:
    """True when lower-cased text holds one of the terms; null text counts as ''."""
    return holds_any(F.lower(F.coalesce(text.cast("string"), F.lit(""))), terms)


def holds_any(lowered: Column, terms: Sequence[str]) -> Column:
    """True when text that is in lower case already holds one of the terms."""
    return reduce(lambda a, b: a | b, [lowered.contains(t.lower()) for t in terms])
