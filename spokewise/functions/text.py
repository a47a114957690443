"""Text expressions."""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# How a missing value reads inside composed text.
MISSING_TEXT = "NA"


def detect(text: Column, pattern: str, ignore_case: bool = False) -> Column:
    """True where the regular expression matches anywhere."""
    return text.rlike(f"(?iu){pattern}" if ignore_case else pattern)


def flag(text: Column, word: str) -> Column:
    """1 where the text matches in any case, 0 where not, NULL for NULL."""
    return detect(text, word, ignore_case=True).cast("int")


def title_case(text: Column) -> Column:
    """Upper-case the first letter of each word; a hyphen starts a new word."""
    words = F.split(F.lower(text), r"(?<=[^\p{L}\p{N}'])")
    return F.array_join(F.transform(words, F.initcap), "")


def sentence_case(text: Column) -> Column:
    return F.concat(F.upper(F.substring(text, 1, 1)), F.lower(F.substr(text, F.lit(2))))


def join_text(*parts: Column | str, sep: str = "") -> Column:
    """Concatenate; NULL if a part is NULL. A str part is literal text."""
    columns = [F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]
    woven = [c for pair in ((F.lit(sep), c) for c in columns) for c in pair][1:]
    return F.concat(*woven)


def glue(template: str, **values: Column) -> Column:
    """Fill ``{name}`` fields from columns or keyword expressions; NULL reads ``NA``."""
    parts = []
    for literal, name, _, _ in string.Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if name is not None:
            value = values[name] if name in values else F.col(name)
            parts.append(F.coalesce(value.cast("string"), F.lit(MISSING_TEXT)))
    return F.concat(*parts)


def split_text(text: Column, pattern: str) -> Column:
    """All pieces as an array."""
    return F.split(text, pattern)


def split_fixed(text: Column, pattern: str, pieces: int) -> list[Column]:
    """A fixed number of pieces; a missing piece is empty text, the last holds the rest."""
    parts = F.split(text, pattern, pieces)
    return [F.when(text.isNotNull(), F.coalesce(F.get(parts, F.lit(i)), F.lit(""))) for i in range(pieces)]


def trim(text: Column) -> Column:
    """Strip white space of any kind from both ends."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def replace_first(text: Column, pattern: str | Column, replacement: str = "") -> Column:
    """Replace the first match; the pattern may come from a column.

    In the replacement, group numbers of the pattern start at 2.
    """
    if isinstance(pattern, str):
        pattern = F.lit(pattern)
    whole = F.concat(F.lit(r"(?s)^(.*?)(?:"), pattern, F.lit(")"))
    return F.regexp_replace(text, whole, F.lit("$1" + replacement))


def replace_all(text: Column, pattern: str, replacement: str = "") -> Column:
    return F.regexp_replace(text, pattern, replacement)


def remove_all(text: Column, pattern: str) -> Column:
    return F.regexp_replace(text, pattern, "")


def replace_literal(text: Column, old: str, new: str) -> Column:
    return F.replace(text, F.lit(old), F.lit(new))


def numbered_names(prefix: str, count: int) -> list[str]:
    return [f"{prefix}{i}" for i in range(1, count + 1)]


def separate(
    df: DataFrame, column: str, into: Sequence[str], sep: str = r"[^\p{L}\p{N}]+", remove: bool = True
) -> DataFrame:
    """Split one text column into several at a regular expression.

    Missing pieces on the right are NULL, extra pieces are dropped. The new
    columns stand where the old one stood.
    """
    pieces = F.split(F.col(f"`{column}`").cast("string"), sep)
    new = [F.get(pieces, F.lit(i)).alias(name) for i, name in enumerate(into)]
    chosen: list[Column | str] = []
    for name in df.columns:
        if name != column:
            if name not in into:
                chosen.append(F.col(f"`{name}`"))
            continue
        if not remove:
            chosen.append(F.col(f"`{name}`"))
        chosen.extend(new)
    return df.select(*chosen)


def unite(
    df: DataFrame, name: str, columns: Sequence[str], sep: str = "_", remove: bool = True
) -> DataFrame:
    """Join several columns into one text column; NULL reads ``NA``."""
    parts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(MISSING_TEXT)) for c in columns]
    joined = F.concat_ws(sep, *parts).alias(name)
    first = next(c for c in df.columns if c in columns)
    chosen: list[Column] = []
    for old in df.columns:
        if old == first:
            chosen.append(joined)
        if old != name and not (remove and old in columns):
            chosen.append(F.col(f"`{old}`"))
    return df.select(*chosen)
