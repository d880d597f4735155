"""Header cleaning (P4-P6) with a collision check."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablepipe._util import as_col

_NON_WORD = re.compile(r"[^a-zA-Z0-9_]")
# Fixed value: the portal's system id header, renamed to "id" (P6).
SYSTEM_ID_NAMES = ("sid",)


def snake_name(name: str) -> str:
    """lower, strip, space -> '_', drop '(' and ')' (bike trips header rule)."""
    return name.lower().strip().replace(" ", "_").replace("(", "").replace(")", "")


def strip_name(name: str) -> str:
    """strip, lower, delete everything outside [a-zA-Z0-9_] (portal header rule)."""
    return _NON_WORD.sub("", name.strip().lower())


def system_id_name(name: str, system_ids=SYSTEM_ID_NAMES, legacy_sid: bool = False) -> str:
    """Rename the system id column to ``id``.

    Only the exact name is renamed (D5). ``legacy_sid=True`` replaces the text
    anywhere, as the original did, which turns ``residence`` into ``reidence``."""
    if legacy_sid:
        for s in system_ids:
            name = name.replace(s, "id")
        return name
    return "id" if name in system_ids else name


def check_collisions(old: list[str], new: list[str]) -> None:
    counts = Counter(new)
    dup = {n for n, k in counts.items() if k > 1}
    if dup:
        pairs = {n: [o for o, m in zip(old, new) if m == n] for n in sorted(dup)}
        raise ValueError(f"column names collide after cleaning: {pairs}")


def rename_with(df: DataFrame, fn) -> DataFrame:
    new = [fn(c) for c in df.columns]
    check_collisions(df.columns, new)
    return df.toDF(*new)


def rename_snake(df: DataFrame) -> DataFrame:
    return rename_with(df, snake_name)


def rename_strip(df: DataFrame, system_ids=SYSTEM_ID_NAMES, legacy_sid: bool = False) -> DataFrame:
    return rename_with(df, lambda c: system_id_name(strip_name(c), system_ids, legacy_sid))


def strip_name_col(col) -> Column:
    """The portal header rule for names held as data (metadata columns)."""
    return F.regexp_replace(F.lower(F.trim(as_col(col))), r"[^a-zA-Z0-9_]", "")
