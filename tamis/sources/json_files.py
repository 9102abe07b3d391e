"""Folders of JSON files, read leniently: bad backslashes repaired, lists unwrapped, bad files reported."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def lenient(text: Column) -> Column:
    """The text if it is JSON, else the text with invalid backslashes doubled if that is, else NULL."""
    fixed = F.regexp_replace(text, r'\\(?!["\\/bfnrt]|u[0-9a-fA-F]{4})', r"\\\\")
    ok = lambda t: F.when(F.try_parse_json(t).isNotNull(), t)
    return F.coalesce(ok(text), ok(fixed))


def items(json: Column) -> Column:
    """Array of JSON objects: the text's own list, or that under questions, data or items; one object is one item."""
    v = F.try_parse_json(json)
    listed = lambda path: F.try_variant_get(v, path, "array<variant>")
    kept = lambda a: F.filter(F.transform(a, lambda x: F.to_json(x)), lambda x: x.startswith("{"))
    return kept(F.coalesce(listed("$"), listed("$.questions"), listed("$.data"), listed("$.items"), F.array(v)))


def read_folder(spark: SparkSession, path: str) -> DataFrame:
    """(path, size, modified, item): one row per object of every .json file below ``path``; bad files give a NULL item."""
    raw = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").text(path, wholetext=True)
    m = raw.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_modification_time").alias("modified"), lenient(F.col("value")).alias("json"))
    return m.select("path", "size", "modified", F.explode_outer(items(F.col("json"))).alias("item"))


def number_and_text(raw: Column) -> tuple[Column, Column]:
    """A printed number at the front and the rest of the text."""
    t = F.trim(F.coalesce(raw, F.lit("")))
    n = F.regexp_extract(t, r"^(\d+)\s*[.)]\s*", 1)
    return F.when(n != "", n.try_cast("int")), F.trim(F.regexp_replace(t, r"^\d+\s*[.)]\s*", ""))
