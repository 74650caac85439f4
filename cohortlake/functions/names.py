"""Column names that are safe identifiers, unique and at most 63 characters long."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_LENGTH = 63


def _plain(text: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", text) if c.isascii())


def normalize_identifier(name: object, position: int = 0) -> str:
    words = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", _plain(str(name))).lower()
    joined = "_".join(re.findall(r"[a-z0-9]+", words)) or f"col_{position + 1}"
    return ("c_" + joined if joined[0].isdigit() else joined)[:MAX_LENGTH]


def normalize_columns(names: Iterable[object]) -> list[str]:
    """Repeated names get ``_2``, ``_3`` ... inside the length limit."""
    taken: set[str] = set()
    last: dict[str, int] = {}
    result = []
    for position, raw in enumerate(names):
        base = name = normalize_identifier(raw, position)
        number = last.get(base, 1)
        while name in taken:
            number += 1
            tail = f"_{number}"
            name = base[: MAX_LENGTH - len(tail)] + tail
        last[base] = number
        taken.add(name)
        result.append(name)
    return result


def identifier_column(col: Column, position: Column) -> Column:
    """The same rule for names held as data (marked Latin letters lose their marks)."""
    marked = {c: _plain(c) for c in map(chr, range(0x80, 0x2100)) if len(_plain(c)) == 1}
    text = F.translate(col, "".join(marked), "".join(marked.values()))
    text = F.when(
        col.rlike(r"[^\x00-\x7F]"), F.regexp_replace(text, r"[^\x00-\x7F]+", "")
    ).otherwise(col)
    text = F.lower(F.regexp_replace(text, r"([a-z0-9])(?=[A-Z])", "$1_"))
    text = F.regexp_replace(F.regexp_replace(text, r"[^a-z0-9]+", "_"), r"^_+|_+$", "")
    text = F.when(text == "", F.concat(F.lit("col_"), (position + 1).cast("string"))).otherwise(text)
    text = F.when(text.rlike(r"^\d"), F.concat(F.lit("c_"), text)).otherwise(text)
    return F.left(text, F.lit(MAX_LENGTH))
