"""Bounded, reproducible samples of labelled rows for the small models of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def crc_of(id_col: str = "doc_id") -> Column:
    """crc32 of an id as text; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))


def held_out(modulus: int, remainder: int, id_col: str = "doc_id") -> Column:
    return F.pmod(crc_of(id_col), F.lit(modulus)) == remainder


def place(id_col: str = "doc_id") -> Column:
    """A number from 0 to 1 for each id, spread evenly."""
    return F.shiftrightunsigned(F.xxhash64(F.col(id_col).cast("string")), 1) / F.lit(float(1 << 63))


def fewest(rows: DataFrame, n: int, id_col: str = "doc_id") -> DataFrame:
    """At most n rows, those whose ids have the smallest places: the same ones whatever the partitions.

    A count comes first, so that the tasks only pass on rows whose place can be among them.
    """
    near = rows.where(place(id_col) < F.lit(_reach(rows.count(), n)))
    return near.orderBy(place(id_col), F.col(id_col)).limit(n)


def _reach(total: int, n: int) -> float:
    """A place below which n of `total` rows lie; short of them by chance once in far more than 10 ** 9 samples."""
    return 2.0 if total <= 4 * n else (n + 10 * n**0.5 + 100) / total


def fewest_of_each(rows: DataFrame, key: str, n: int, id_col: str = "doc_id") -> DataFrame:
    """`fewest` for each of a handful of key values, such as labels or languages; nulls are left out."""
    sizes = {r[key]: r["count"] for r in rows.where(F.col(key).isNotNull()).groupBy(key).count().collect()}
    parts = [
        rows.where((F.col(key) == value) & (place(id_col) < F.lit(_reach(size, n)))).orderBy(place(id_col), F.col(id_col)).limit(n)
        for value, size in sorted(sizes.items())
    ]
    if not parts:
        return rows.limit(0)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
