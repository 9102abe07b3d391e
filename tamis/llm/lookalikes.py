"""Text brought to the form a reader sees, with look-alike letters repaired by script.

1. Character forms: full-width and half-width forms, ligatures, the micro sign and singletons such as the Kelvin sign
   become plain; accents compose; invisible characters go; every kind of white space is a space, runs are one space.
   Raised figures, dashes, quotes and case stay, for they look different.
2. Look-alikes: in a token (a run of letters) that mixes scripts, the dominant script is that of its letters which no
   other script shares, else that of the whole text, else Latin.  Letters that only look like it are substituted, if the result is
   of one script and is in the corpus vocabulary.  A token wholly of look-alikes of another script than its text's is
   mixed with its surroundings and is treated so too.  The vocabulary has every token of the corpus after step 1, and
   counts a word as present too when two differently stored tokens give it.

Tokens are repaired in the JVM plan by joins on the token; the Python step sees each text once and does nothing to
plain ASCII.  NULL texts give NULL; blank texts show nothing and equal nothing.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamis.functions.text import collapse, hash128
from tamis.scratch import Scratch, small

#: Letters that look like the Latin letter at the same place.
LATIN_C, CYRILLIC = "aceiopsyxjhABCEHIKMOPSTXYJ", "асеіорѕухјһАВСЕНІКМОРЅТХУЈ"
LATIN_G, GREEK = "oABEZHIKMNOPTYX", "οΑΒΕΖΗΙΚΜΝΟΡΤΥΧ"

TO_LATIN = {**dict(zip(CYRILLIC, LATIN_C)), **dict(zip(GREEK, LATIN_G))}
TO = {"L": TO_LATIN, "C": dict(zip(LATIN_C, CYRILLIC)), "G": dict(zip(LATIN_G, GREEK))}
SHARED = {"L": {*LATIN_C, *LATIN_G}, "C": {*CYRILLIC}, "G": {*GREEK}}
LETTERS = regex.compile(r"[\p{L}\p{M}]+")
FOREIGN = regex.compile(r"[\p{Cyrillic}\p{Greek}]")


def _forms() -> dict[int, str | None]:
    """Single characters and what they look like, by rule from the Unicode database."""
    out: dict[int, str | None] = {}
    for i in range(0x80, 0x10000):
        ch = chr(i)
        kind, _, parts = unicodedata.decomposition(ch).partition(" ")
        cat = unicodedata.category(ch)
        if ch.isspace():
            out[i] = " "
        elif cat == "Cf" or 0xFE00 <= i <= 0xFE0F:
            out[i] = None
        elif kind in ("<wide>", "<narrow>") or kind == "<compat>" and cat[0] == "L":
            plain = "".join(chr(int(x, 16)) for x in parts.split())
            if kind != "<compat>" or all(unicodedata.category(x)[0] == "L" for x in plain):
                out[i] = unicodedata.normalize("NFC", plain)
    return out


FORMS = _forms()


def character_form(text: str) -> str:
    if not text.isascii():
        text = unicodedata.normalize("NFC", text.translate(FORMS))
    return " ".join(text.split())


def _script(ch: str) -> str:
    i = ord(ch)
    if i < 0x250 or 0x1E00 <= i < 0x1F00:
        return "L"
    if 0x400 <= i < 0x530:
        return "C"
    if 0x370 <= i < 0x400 or 0x1F00 <= i < 0x2000:
        return "G"
    return ""


def _dominant(text: str) -> str:
    """The script of most letters that no other script shares; Latin, the corpus's own, if there are none such."""
    own = [s for ch in unicodedata.normalize("NFD", text) if ch.isalpha() and (s := _script(ch)) and ch not in SHARED[s]]
    return max("LCG", key=own.count)


def candidates(text: str) -> list[tuple[str, str]]:
    """(token, repaired token) for every token of the text that look-alikes might spoil."""
    if text.isascii() or not FOREIGN.search(text):
        return []
    whole, out = "", {}
    for token in LETTERS.findall(text):
        letters = [(_script(ch), ch) for ch in unicodedata.normalize("NFD", token)]
        scripts = {s for s, ch in letters if s and ch.isalpha()}
        if not scripts:
            continue
        shared = all(ch in SHARED[s] for s, ch in letters if s and ch.isalpha())
        if len(scripts) == 1 and not shared:
            continue
        if shared:
            whole = whole or _dominant(text)
            main = whole
        else:
            main = _dominant(token)
        fixed = "".join(TO[main].get(ch, ch) if s and s != main else ch for s, ch in letters)
        fixed = unicodedata.normalize("NFC", fixed)
        if fixed != token and len({s for ch in unicodedata.normalize("NFD", fixed) if ch.isalpha() and (s := _script(ch))}) == 1:
            out[token] = fixed
    return [*out.items()]


def _seen(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        form = [None if t is None else character_form(t) for t in pdf["text"]]
        pdf["shown"] = form
        pdf["odd"] = [[] if t is None else [{"token": a, "fixed": b} for a, b in candidates(t)] for t in form]
        yield pdf.drop(columns="text")


def _repair(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        done = []
        for text, fixes in zip(pdf["shown"], pdf["fixes"]):
            known = {f["token"]: f["fixed"] for f in fixes}
            done.append(unicodedata.normalize("NFC", LETTERS.sub(lambda m: known.get(m[0], m[0]), text)))
        yield pdf.assign(shown=done).drop(columns="fixes")


def one_form(texts: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """texts (key, part, text, ...) -> the same rows with ``shown`` in place of ``text``.

    (key, part) names a text; repeated names give repeated rows and must hold the same text.
    """
    scratch = scratch or Scratch(texts.sparkSession)
    rest = [f for f in texts.schema.fields if f.name != "text"]
    odd = T.StructField("odd", T.ArrayType(T.StructType([T.StructField("token", T.StringType()), T.StructField("fixed", T.StringType())])))
    seen = scratch.cut(texts.mapInPandas(_seen, T.StructType([*rest, T.StructField("shown", T.StringType()), odd])))
    names = [f.name for f in rest]
    strange = seen.where(F.size("odd") > 0)
    wanted = scratch.cut(strange.select(F.inline("odd")).groupBy("fixed").agg(F.count_distinct("token").alias("spellings")), n=F.count("*"))
    n = scratch.last["n"]
    words = seen.select(F.explode(F.regexp_extract_all("shown", F.lit(r"([\p{L}\p{M}]+)"), F.lit(1))).alias("fixed"))
    spelt = words.join(small(wanted.select("fixed"), n), "fixed", "left_semi").distinct()
    known = wanted.where("spellings > 1").select("fixed").unionByName(spelt).distinct()
    named = strange.select(*names, "shown", F.posexplode("odd").alias("i", "o")).select(*names, "shown", "o.token", "o.fixed")
    fixes = named.join(small(known, n), "fixed").groupBy("key", "part").agg(F.collect_set(F.struct("token", "fixed")).alias("fixes"))
    todo = strange.select(*names, "shown").join(fixes, ["key", "part"], "left")
    todo = todo.withColumn("fixes", F.coalesce("fixes", F.array().cast(fixes.schema["fixes"].dataType)))
    repaired = todo.mapInPandas(_repair, T.StructType([*rest, T.StructField("shown", T.StringType())]))
    return seen.where(F.size("odd") == 0).select(*names, "shown").unionByName(repaired)


def disguised_pairs(df: DataFrame, scope: str, key: str = "key") -> DataFrame:
    """Pairs (a, b), a < b, of one scope that show the same though stored otherwise.

    df (scope, key, stored, shown).  Texts stored alike form a variant; variants that show the same are paired first,
    and members are joined to pairs of variants, so that every row made is a result.
    """
    h = df.where("shown <> ''").select(scope, F.col(key).alias("id"), F.xxhash64(F.lit(5), collapse(F.col("stored"))).alias("variant"), *hash128(F.col("shown")))
    cls = [scope, "h1", "h2"]
    many = h.groupBy(*cls).agg((F.min("variant") != F.max("variant")).alias("many")).where("many").select(*cls)
    h = h.join(many, cls, "left_semi")
    v = h.select(*cls, "variant").distinct()
    two = v.withColumnRenamed("variant", "va").join(v.withColumnRenamed("variant", "vb"), cls).where("va < vb")
    left = two.join(h.select(*cls, F.col("variant").alias("va"), F.col("id").alias("x")), [*cls, "va"])
    both = left.join(h.select(*cls, F.col("variant").alias("vb"), F.col("id").alias("y")), [*cls, "vb"])
    return both.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def same_stored(a: Column, b: Column) -> Column:
    return collapse(a) == collapse(b)
