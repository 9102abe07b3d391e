"""Records that differ only in layout: one canonical form, a 128-bit hash, counts combined before the shuffle.

Ignored: letter case, all white space, all punctuation, the order of the options, a printed number at the front of
the text.  Content: letters, digits, other symbols, a decimal point between digits, and the signs ``+ - * / = < > ^ %``
directly beside a digit.  NULL text counts as empty, NULL options as no options, a NULL option as an empty one.
Collisions: beside the 128 bits goes an independent third hash, of which each group keeps least and greatest; groups
where they differ are counted again by their whole canonical text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamis.functions.text import WS, hash128, stem
from tamis.scratch import Scratch

_SIGNS = r"+*/=<>^%\-"
IGNORED = (
    rf"[{WS}]+"
    rf"|(?<!\p{{Nd}})[{_SIGNS}](?!\p{{Nd}})"
    r"|(?<!\p{Nd})\.|\.(?!\p{Nd})"
    rf"|[\p{{P}}$`|~&&[^.{_SIGNS}]]+"
)


def bare(text: Column) -> Column:
    return F.regexp_replace(F.lower(text), IGNORED, "")


def canonical(text: Column, options: Column) -> Column:
    """Canonical text of a record: bare stem, then the sorted bare options."""
    opts = F.array_sort(F.transform(F.coalesce(options, F.array().cast("array<string>")), lambda o: bare(F.coalesce(o, F.lit("")))))
    return F.concat(bare(stem(text)), F.lit("\x1f"), F.array_join(opts, "\x1e"), F.lit("\x1f"), F.size(opts).cast("string"))


def keyed(df: DataFrame, scope: str, text: str = "question_text", options: str = "options", id_: str = "id") -> DataFrame:
    """(scope, id, canon)."""
    return df.select(F.col(scope).alias("scope"), F.col(id_).alias("id"), canonical(F.col(text), F.col(options)).alias("canon"))


def copies(df: DataFrame, scope: str, scratch: Scratch | None = None, **columns: str) -> DataFrame:
    """(scope, first_id, copies): one row per canonical record of a scope.  The texts are read again only after a clash."""
    scratch = scratch or Scratch(df.sparkSession)
    k = keyed(df, scope, **columns)
    h = k.select("scope", "id", *hash128(F.col("canon")), F.xxhash64(F.lit(3), "canon", F.length("canon")).alias("h3"))
    g = h.groupBy("scope", "h1", "h2").agg(
        F.min("id").alias("first_id"), F.count("*").alias("copies"), F.min("h3").alias("lo"), F.max("h3").alias("hi")
    )
    out = ("scope", "first_id", "copies")
    g = scratch.cut(g, clashes=F.count_if(F.col("lo") != F.col("hi")))
    if not scratch.last["clashes"]:
        return g.select(*out)
    clash = g.where("lo <> hi").select("scope", "h1", "h2")
    again = k.withColumns(dict(zip(("h1", "h2"), hash128(F.col("canon"))))).join(clash, ["scope", "h1", "h2"], "left_semi")
    exact = again.groupBy("scope", "canon").agg(F.min("id").alias("first_id"), F.count("*").alias("copies"))
    return g.where("lo = hi").select(*out).unionByName(exact.select(*out))
