"""Column names as they come from file headers."""

from __future__ import annotations

import csv

from pyspark.sql import Column, functions as F

BYTE_ORDER_MARK = "﻿"


def column(name: str) -> Column:
    """The column of exactly this name, whatever characters the name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def header_names(line: str) -> list[str]:
    """The names on a header line. Repeated names get ``.1``, ``.2`` ...; blank ones a number."""
    names: list[str] = []
    for i, raw in enumerate(next(csv.reader([line.lstrip(BYTE_ORDER_MARK)]), [])):
        base = raw or f"Unnamed: {i}"
        name, n = base, 0
        while name in names:
            n += 1
            name = f"{base}.{n}"
        names.append(name)
    folded = {}
    for name in names:
        other = folded.setdefault(name.lower(), name)
        if other != name:
            raise ValueError(f"columns {other!r} and {name!r} differ only in case")
    return names
