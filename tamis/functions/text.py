"""Column functions on text, all inside the JVM.

White space means every character that Unicode calls white space; Java's ``\\s`` alone is ASCII only.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WS = r"\s\x{85}\p{Z}\x{1c}-\x{1f}"
#: A printed number at the front: digits, perhaps after Q, then "." or ")"; "3.5 kN" is no such number.
NUMBER = rf"^[{WS}]*[Qq]?[{WS}]*\p{{Nd}}+[{WS}]*[.)](?!\p{{Nd}})"


def stem(text: Column) -> Column:
    """The text without a printed number at its front; NULL gives the empty string."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), NUMBER, "")


def collapse(text: Column) -> Column:
    """Runs of ASCII white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def hash128(*columns: Column) -> list[Column]:
    """Two 64-bit hashes with different seeds, as (h1, h2)."""
    return [F.xxhash64(F.lit(1), *columns).alias("h1"), F.xxhash64(F.lit(2), *columns).alias("h2")]
