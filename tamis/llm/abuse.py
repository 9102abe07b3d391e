"""Scores for abusive, hateful or sexual language: a factorization machine over hashed terms of sentences.

A text is cut into sentences; a sentence is a bag of hashed terms: its words with disguises undone (full-width forms,
look-alike letters, digits or signs for letters, letters set apart or doubled), parts of words for spellings never seen,
and pairs of neighbouring words.  The machine has a weight per term and a vector per word; the products of vectors let
pairs of any words of a sentence count, as an insult with a mention of a group, where neither counts alone.  A text
scores as its worst sentence, so length does not dilute a case, and no text is cut short.  No list of words is given:
all weights are learnt.

A few labels cover a small part of the language, so the whole corpus adds evidence on each term, in two rounds:

1. Labels tell how much likelier a case is in each source.  A term that mostly stands in documents of sources rich in
   cases is suspect; one that recurs in textbooks as elsewhere, such as the name of a tool, is not.
2. The machine trained with that scores every sentence of the corpus; a term's evidence is now the mean belief in the
   sentences that hold it.

Evidence enters the machine as a sentence's greatest, least and mean one over words and over pairs, always without the
sentence's own share, and with learnt weights.  Counts, evidence and threshold are taken over all documents.

Labels are given for whole texts.  In training the worst sentence of an unfit text stands for it, and every sentence of
a fit text counts as fit.  Disagreeing readers give their mean.  Training uses at most MAX_LABELLED texts, chosen by hash
of the key among all labelled ones; the model has 2**BITS terms whatever the table's size, which bounds its broadcast.

The threshold is where the scores of all documents are thinnest, between even odds and the median of the texts labelled
unfit; scores are centred on it, so 0.5 or more is a case.

NULL and empty texts score 0; NULL sources are a source.  Without labels of both kinds all score 0.
"""

from __future__ import annotations

import pickle
import re
import unicodedata
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamis.llm.lookalikes import TO_LATIN
from tamis.scratch import Scratch, spread

#: Terms are 2**BITS numbers: a quarter for words, a quarter for parts of words, half for pairs.
BITS, FACTORS, STEPS, RATE, VECTOR_RATE, DECAY, VECTOR_DECAY, MAX_LABELLED = 20, 2, 60, 0.05, 0.01, 0.2, 0.2, 4_000
SIZE = 1 << BITS
PARTS, PAIRS = SIZE >> 2, SIZE >> 1
#: Documents, or sentences, that a term's evidence is shrunk by.
SHRINK, SHRINK_BELIEF = 3.0, 2.0
#: Words that a worker remembers, and characters that it reads at once.
LEXICON, STRETCH = 400_000, 2_000_000
WORD_VALUE, PART_VALUE, PAIR_VALUE = 1.0, 0.3, 0.7
NUMBERS = "<number>"

SQUASH = re.compile(r"(.)\1+")
LEET = str.maketrans("013457@$!|", "oieastasil")
TOKEN = re.compile(r"(?<=[.!?।;])\s+|[\n\r]+|[^\s.,;:?()\[\]\"“”‘’।—–]+")
APART = re.compile(r"(?<!\S)(?:[^\W\d_][ \t._*-]){3,}[^\W\d_](?!\w)")
BETWEEN = re.compile(r"[ \t._*-]")
MARKS = re.compile(r"(?<=\w)[*#_~^'`´-]+(?=\w)|[*#_~^]+$")
NUMBER = re.compile(r"[-+]?[\d.,]+|\d[^\W\d_]*\d*")
UNSEEN = re.compile("[" + "".join(c for c in map(chr, range(0x110000)) if unicodedata.category(c) == "Cf") + "]+")


def _hash(term: str, start: int, size: int) -> int:
    return start + xxhash.xxh32_intdigest(term) % size


def spellings(word: str) -> list[str]:
    """What a word may stand for: lower case, look-alikes and signs inside undone, doubled letters single."""
    low = word.lower() if word.isascii() else "".join(TO_LATIN.get(c, c) for c in word.lower())
    low = MARKS.sub("", low).strip("-'!*#_~^")
    # a sign or digit in a word stands for a letter, or hides one, or was put between letters
    odd = any(c.isascii() and not c.isalpha() for c in low)
    found = (low.translate(LEET), re.sub(r"[^\w]|[\d_]", "", low)) if odd else (low,)
    return [*dict.fromkeys(SQUASH.sub(r"\1", x) for x in found if x)]


class Lexicon:
    """Words met by a worker, with their terms; forgotten when there are too many."""

    def __init__(self) -> None:
        self.at: dict[str, int] = {}
        self.pair, self.first, self.second = array("Q"), array("i"), array("i")
        self.ends, self.terms, self.values = array("q", [0]), array("i"), array("f")

    def add(self, word: str) -> int:
        """Number of a new word; -1 for the gap between sentences, -2 for what is no word."""
        number = NUMBER.fullmatch(word) is not None
        if number and NUMBERS in self.at:
            k = self.at[NUMBERS]
        elif word.isspace():
            k = -1
        elif not (seen := [NUMBERS] if number else spellings(word)):
            k = -2
        else:
            k = len(self.pair)
            own = {_hash(f"w {s}", 0, PARTS): WORD_VALUE for s in seen}
            ids = [*own]
            for s in () if number else seen:
                s = f"<{s}>"
                own |= {_hash(s[i : i + 4], PARTS, PARTS): PART_VALUE for i in range(len(s) - 3)}
            if "*" in word or "#" in word:
                own |= {_hash(t, PARTS, PARTS): WORD_VALUE for t in ("<masked>", f"m {seen[-1][0]}{seen[-1][-1]}")}
            if number:
                self.at[NUMBERS] = k
            self.pair.append(0 if number else xxhash.xxh64_intdigest(seen[0]) | 1)
            self.first.append(ids[0])
            self.second.append(ids[-1])
            self.terms.extend(own)
            self.values.extend(own.values())
            self.ends.append(len(self.terms))
        self.at[word] = k
        return k

    def read(self, texts: list[str | None]) -> Bags:
        if len(self.pair) > LEXICON:
            self.__init__()
        tokens: list[str] = []
        sizes = []
        for t in texts:
            had = len(tokens)
            if t:
                if not t.isascii():
                    t = UNSEEN.sub("", unicodedata.normalize("NFKC", t))
                tokens += TOKEN.findall(APART.sub(lambda m: BETWEEN.sub("", m[0]), t))
            sizes.append(len(tokens) - had)
        get, add = self.at.get, self.add
        w = np.array([k if (k := get(x)) is not None else add(x) for x in tokens], np.int64)
        owner = np.repeat(np.arange(len(texts)), sizes)
        gap = (w == -1) | np.r_[False, owner[1:] != owner[:-1]][: len(w)]
        part, kept = np.cumsum(gap), w >= 0
        w, owner, part = w[kept], owner[kept], part[kept]
        new = np.r_[True, part[1:] != part[:-1]][: len(w)]
        sentence = np.cumsum(new) - 1
        words, at = np.unique(w, return_inverse=True)
        ends, pair = np.array(self.ends), np.array(self.pair, np.uint64)
        n = ends[words + 1] - ends[words]
        pick = np.repeat(ends[words] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        h = pair[w]
        near = (sentence[1:] == sentence[:-1]) & (h[1:] > 0) & (h[:-1] > 0)
        mixed = (h[:-1] * np.uint64(0x9E3779B97F4A7C15) ^ h[1:]) * np.uint64(0xBF58476D1CE4E5B9)
        return Bags(
            at, sentence, np.flatnonzero(new), owner[new], len(texts), np.array(self.first)[words], np.array(self.second)[words],
            np.repeat(np.arange(len(words)), n), np.array(self.terms)[pick], np.array(self.values)[pick],
            (PAIRS + (mixed >> np.uint64(20)).astype(np.int64) % PAIRS)[near], sentence[1:][near],
        )


@dataclass
class Bags:
    """Sentences of some texts; a word's terms are listed once however often it stands."""

    word: np.ndarray  # per running word: its place in the list of words
    sentence: np.ndarray
    starts: np.ndarray  # first running word of each sentence
    owner: np.ndarray  # text of each sentence
    texts: int
    first: np.ndarray  # per word: the terms of its spellings
    second: np.ndarray
    holder: np.ndarray  # per term of a word: the word
    term: np.ndarray
    value: np.ndarray
    pair: np.ndarray  # pairs of neighbours
    pair_sentence: np.ndarray

    def main(self, count: np.ndarray) -> np.ndarray:
        """The term of each word's likelier spelling."""
        return np.where(count[self.second] > count[self.first], self.second, self.first)

    def spread(self, per_sentence: np.ndarray) -> np.ndarray:
        """Sums over the sentences that hold a term."""
        words = np.bincount(self.word, per_sentence[self.sentence], len(self.first))
        return np.bincount(self.term, words[self.holder], SIZE) + np.bincount(self.pair, per_sentence[self.pair_sentence], SIZE)

    def documents(self, per_text: np.ndarray) -> np.ndarray:
        """Sums over the texts that hold a term; each text once for each of its words and pairs."""
        n = max(1, len(self.first))
        seen = np.unique(self.owner[self.sentence] * n + self.word)
        words = np.bincount(seen % n, per_text[seen // n], n)
        pairs = np.unique(self.owner[self.pair_sentence] * SIZE + self.pair)
        return np.bincount(self.term, words[self.holder], SIZE) + np.bincount(pairs % SIZE, per_text[pairs // SIZE], SIZE)

    def evidence(self, n: np.ndarray, total: np.ndarray, own: np.ndarray, prior: float, shrink: float, odds: bool) -> np.ndarray:
        """Greatest, least and mean evidence over the words and over the pairs of each sentence, without its own share."""
        main = self.main(n)[self.word]
        out = np.zeros((len(self.starts), 6), np.float32)

        def of(term: np.ndarray, sentence: np.ndarray) -> np.ndarray:
            e = (total[term] - own[sentence] + shrink * prior) / np.maximum(n[term] - 1 + shrink, shrink)
            if odds:
                e = np.clip(e, 1e-6, 1 - 1e-6)
                return np.log(e / (1 - e)) - np.log(prior / (1 - prior))
            return e

        for at, term, sentence in ((0, main, self.sentence), (3, self.pair, self.pair_sentence)):
            if len(term):
                e = of(term, sentence)
                begin = np.flatnonzero(np.r_[True, sentence[1:] != sentence[:-1]])
                to = sentence[begin]
                out[to, at], out[to, at + 1] = np.maximum.reduceat(e, begin), np.minimum.reduceat(e, begin)
                out[to, at + 2] = np.add.reduceat(e, begin) / np.diff([*begin, len(e)])
        return out


@dataclass
class Corpus:
    """What is known of the terms over all documents."""

    documents: int
    count: np.ndarray  # documents of each term
    suspect: np.ndarray  # sums of the documents' log ratios by source
    ratio: dict[str, float]  # log ratio of cases to others, per source
    sentences: np.ndarray | None = None  # sentences of each term
    belief: np.ndarray | None = None  # sums of their probabilities
    mean: float = 0.01
    rarity: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.count, self.suspect = self.count.astype(np.float32), self.suspect.astype(np.float32)
        self.rarities()

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "rarity"}

    def __setstate__(self, state: dict) -> None:
        self.__dict__ |= state
        self.rarities()

    def rarities(self) -> None:
        most = np.log(max(2, self.documents))
        self.rarity = np.where(self.count > 1, 1 - np.log(np.maximum(self.count, 1)) / most, 0).clip(0, 1).astype(np.float32)

    def features(self, b: Bags, sources: list) -> np.ndarray:
        own = np.array([self.ratio.get(s or "", 0.0) for s in sources])[b.owner]
        out = b.evidence(self.count, self.suspect, own, 0.0, SHRINK, False)
        return out

    def believed(self, b: Bags, p: np.ndarray) -> np.ndarray:
        return b.evidence(self.sentences, self.belief, p, self.mean, SHRINK_BELIEF, True)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


@dataclass
class Machine:
    """score = bias + sum w x + 1/2 sum_f ((sum v x)^2 - sum (v x)^2) + evidence . lean"""

    bias: float
    w: np.ndarray
    v: np.ndarray
    lean: np.ndarray

    def sentences(self, b: Bags, rarity: np.ndarray, evidence: np.ndarray) -> np.ndarray:
        if not len(b.starts):
            return np.zeros(0)
        linear = np.bincount(b.holder, self.w[b.term] * b.value * rarity[b.term], len(b.first))
        z = self.bias + np.add.reduceat(linear[b.word], b.starts) + evidence @ self.lean
        z += np.bincount(b.pair_sentence, self.w[b.pair] * rarity[b.pair] * PAIR_VALUE, len(z))
        vx = (self.v[b.first] * rarity[b.first, None])[b.word]  # words are the first terms
        s = np.add.reduceat(vx, b.starts)
        return z + 0.5 * ((s * s).sum(1) - np.add.reduceat((vx * vx).sum(1), b.starts))


def fit(b: Bags, labels: np.ndarray, rarity: np.ndarray, evidence: np.ndarray, factors: int = FACTORS, steps: int = STEPS, seed: int = 1) -> Machine:
    """Adam on the log loss of sentences; the worst sentence of an unfit text is chosen anew in every step."""
    bad = labels[b.owner] >= 0.5
    rng = np.random.default_rng(seed)
    terms, at = np.unique(np.r_[b.term, b.pair, b.first], return_inverse=True)
    own, pair, first = np.split(at, [len(b.term), len(b.term) + len(b.pair)])
    n, words, sentences = len(terms), len(b.first), len(b.starts)
    x, px, fx = b.value * rarity[b.term], PAIR_VALUE * rarity[b.pair], rarity[b.first]
    begin = np.flatnonzero(np.r_[True, b.owner[1:] != b.owner[:-1]])
    per_text = np.diff([*begin, sentences])
    par = [np.zeros(n), rng.normal(0, 0.02, (n, factors)), np.zeros(evidence.shape[1]), np.array([-4.0])]
    one, two = [np.zeros_like(p) for p in par], [np.zeros_like(p) for p in par]
    for step in range(1, steps + 1):
        w, v, lean, bias = par
        z = bias[0] + np.add.reduceat(np.bincount(b.holder, w[own] * x, words)[b.word], b.starts) + evidence @ lean
        z += np.bincount(b.pair_sentence, w[pair] * px, sentences)
        word_vx = v[first] * fx[:, None]
        vx = word_vx[b.word]
        s = np.add.reduceat(vx, b.starts)
        z += 0.5 * ((s * s).sum(1) - np.add.reduceat((vx * vx).sum(1), b.starts))
        p = _sigmoid(z)
        worst = z >= np.repeat(np.maximum.reduceat(z, begin), per_text)
        # an unfit text's worst sentence counts more, as there is one; far misses are capped, for readers err
        g = np.where(bad, worst * np.maximum(p - 1, -0.9) * 4.0, np.minimum(p, 0.9))
        by_word = np.bincount(b.word, g[b.sentence], words)
        gw = np.bincount(own, by_word[b.holder] * x, n) + np.bincount(pair, g[b.pair_sentence] * px, n) + DECAY * w
        rest = (s[b.sentence] - vx) * g[b.sentence, None]
        gv = np.stack([np.bincount(first, np.bincount(b.word, rest[:, f], words) * fx, n) for f in range(factors)], 1) if factors else v
        for i, (grad, rate) in enumerate(((gw, RATE), (gv + VECTOR_DECAY * v, VECTOR_RATE), (evidence.T @ g + 0.5 * lean, RATE), (np.array([g.sum()]), RATE))):
            one[i] = 0.9 * one[i] + 0.1 * grad
            two[i] = 0.99 * two[i] + 0.01 * grad**2
            par[i] = par[i] - rate * (one[i] / (1 - 0.9**step)) / (np.sqrt(two[i] / (1 - 0.99**step)) + 1e-3)
    w, v = np.zeros(SIZE, np.float32), np.zeros((PARTS, factors), np.float32)
    word = terms < PARTS
    w[terms], v[terms[word]] = par[0], par[1][word]
    return Machine(float(par[3][0]), w, v, par[2].astype(np.float32))


def log_ratios(sources: list, labels: np.ndarray) -> dict[str, float]:
    """How much likelier a source is among unfit texts than among others, by log; every source counts once in advance."""
    names = sorted({s or "" for s in sources})
    k = np.array([names.index(s or "") for s in sources], np.int64)
    unfit, other = (np.bincount(k, x, len(names)) + 1 for x in (labels, 1 - labels))
    return dict(zip(names, np.log((unfit / unfit.sum()) / (other / other.sum())).tolist()))


def valley(z: np.ndarray, n: np.ndarray, most: float) -> float:
    """The middle of the thinnest stretch of a histogram (centres, counts) between 0 and ``most``."""
    inside = (z >= 0) & (z <= max(most, 0.0))
    if not inside.any():
        return 0.0
    density = np.exp(-0.5 * ((z[inside, None] - z[None, :]) / 0.75) ** 2) @ n
    at = np.flatnonzero(density <= density.min() * 1.02 + 1e-9)
    return float(z[inside][at[len(at) // 2]])


def chunks(pdf: pd.DataFrame, text: str) -> Iterator[pd.DataFrame]:
    """Rows of a batch by about STRETCH characters."""
    size = pdf[text].str.len().fillna(0).to_numpy()
    part = (np.cumsum(size) // STRETCH).astype(np.int64)
    at = [0, *(np.flatnonzero(np.diff(part)) + 1), len(pdf)]
    for a, b in zip(at, at[1:]):
        if b > a:
            yield pdf.iloc[a:b]


def _texts(pdf: pd.DataFrame, text: str) -> list:
    return [t if isinstance(t, str) else None for t in pdf[text]]


def _sources(pdf: pd.DataFrame, source: str) -> list:
    return [s if isinstance(s, str) else None for s in pdf[source]]


def packed(x: object) -> bytes:
    """Compressed, as most terms of a small corpus are unused and every executor keeps a copy on disk."""
    return zstandard.compress(pickle.dumps(x, pickle.HIGHEST_PROTOCOL))


def unpacked(x: bytes) -> object:
    return pickle.loads(zstandard.decompress(x))


def _gather(rows: DataFrame, measures: list[str]) -> dict[str, np.ndarray]:
    """Sums per term over all tasks; each task sends at most 2**BITS + 1 rows, of which -1 holds totals."""
    got = rows.groupBy("term").agg(*[F.sum(m).alias(m) for m in measures]).toArrow()
    at, out = got["term"].to_numpy(), {m: np.zeros(SIZE + 1) for m in measures}
    for m in measures:
        out[m][at] = got[m].to_numpy()
    return out


def _rows(columns: dict[str, np.ndarray], totals: dict[str, float]) -> pd.DataFrame:
    at = np.flatnonzero(np.any([c != 0 for c in columns.values()], axis=0))
    return pd.DataFrame({"term": np.r_[-1, at], **{k: np.r_[totals[k], c[at]] for k, c in columns.items()}})


def corpus_counts(docs: DataFrame, ratio: dict[str, float], text: str = "text", source: str = "source") -> Corpus:
    """Documents and summed log ratios of each term, over all documents."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lexicon, n, s, docs = Lexicon(), np.zeros(SIZE), np.zeros(SIZE), 0
        for pdf in batches:
            docs += len(pdf)
            for part in chunks(pdf, text):
                b = lexicon.read(_texts(part, text))
                n += b.documents(np.ones(len(part)))
                s += b.documents(np.array([ratio.get(x or "", 0.0) for x in _sources(part, source)]))
        yield _rows({"n": n, "s": s}, {"n": docs, "s": 0.0})

    got = _gather(docs.select(text, source).mapInPandas(run, "term int, n double, s double"), ["n", "s"])
    return Corpus(int(got["n"][-1]), got["n"][:-1], got["s"][:-1], ratio)


def add_beliefs(docs: DataFrame, corpus: Corpus, model: Machine, text: str = "text", source: str = "source") -> None:
    """Sentences of each term and the sum of their probabilities, over all documents."""
    sent = docs.sparkSession.sparkContext.broadcast(packed((corpus, model)))  # 2**BITS * 3.5 numbers

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        corpus, model = unpacked(sent.value)
        lexicon, n, s, seen, total = Lexicon(), np.zeros(SIZE), np.zeros(SIZE), 0, 0.0
        for pdf in batches:
            for part in chunks(pdf, text):
                b = lexicon.read(_texts(part, text))
                p = _sigmoid(model.sentences(b, corpus.rarity, corpus.features(b, _sources(part, source))))
                n, s = n + b.spread(np.ones(len(p))), s + b.spread(p)
                seen, total = seen + len(p), total + p.sum()
        yield _rows({"n": n, "s": s}, {"n": seen, "s": total})

    got = _gather(docs.select(text, source).mapInPandas(run, "term int, n double, s double"), ["n", "s"])
    sent.destroy()
    corpus.sentences, corpus.belief = got["n"][:-1].astype(np.float32), got["s"][:-1].astype(np.float32)
    corpus.mean = float(np.clip(got["s"][-1] / max(1.0, got["n"][-1]), 1e-6, 0.5))


def labelled(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "unfit", source: str = "source", most: int = MAX_LABELLED) -> pd.DataFrame:
    """At most ``most`` labelled texts, chosen by hash of the key; label is the readers' mean."""
    mean = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(key).agg(F.avg(F.col(label).cast("double")).alias("label"))
    chosen = mean.orderBy(F.xxhash64(key), key).limit(most)
    found = docs.select(key, text, source).join(F.broadcast(chosen), key).where(F.col(text).isNotNull())
    return found.toPandas().sort_values(key).drop_duplicates(key)


@dataclass
class Judge:
    """Both machines and what they know; ``texts`` gives the log odds of a text's worst sentence."""

    corpus: Corpus
    first: Machine
    second: Machine

    def texts(self, lexicon: Lexicon, texts: list, sources: list) -> np.ndarray:
        b = lexicon.read(texts)
        e = self.corpus.features(b, sources)
        p = _sigmoid(self.first.sentences(b, self.corpus.rarity, e))
        z = self.second.sentences(b, self.corpus.rarity, np.hstack([e, self.corpus.believed(b, p)]))
        out = np.full(len(texts), -np.inf)
        np.maximum.at(out, b.owner, z)
        return out


def train(docs: DataFrame, known: pd.DataFrame, text: str = "text", source: str = "source", factors: int = FACTORS) -> Judge | None:
    """Both rounds; None without labels of both kinds."""
    y = known["label"].to_numpy()
    if not len(y) or not (y >= 0.5).any() or (y >= 0.5).all():
        return None
    texts, sources = _texts(known, text), _sources(known, source)
    corpus = corpus_counts(docs, log_ratios(sources, y), text, source)
    b = Lexicon().read(texts)
    if not len(b.starts):
        return None
    e = corpus.features(b, sources)
    first = fit(b, y, corpus.rarity, e, factors)
    add_beliefs(docs, corpus, first, text, source)
    p = _sigmoid(first.sentences(b, corpus.rarity, e))
    second = fit(b, y, corpus.rarity, np.hstack([e, corpus.believed(b, p)]), factors)
    return Judge(corpus, first, second)


def log_odds(docs: DataFrame, judge: Judge | None, text: str = "text", source: str = "source") -> DataFrame:
    """The table with ``z`` in place of the text; NULL for texts without words."""
    rest = [f for f in docs.schema.fields if f.name != text]
    if judge is None:
        return docs.drop(text).withColumn("z", F.lit(None).cast("double"))
    sent = docs.sparkSession.sparkContext.broadcast(packed(judge))  # 2**BITS * 7 numbers

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        judge, lexicon = unpacked(sent.value), Lexicon()
        for pdf in batches:
            for part in chunks(pdf, text):
                z = judge.texts(lexicon, _texts(part, text), _sources(part, source))
                yield part.drop(columns=text).assign(z=np.where(np.isfinite(z), z, np.nan))

    scored = docs.mapInPandas(run, T.StructType([*rest, T.StructField("z", T.DoubleType())]))
    return scored.withColumn("z", F.nanvl("z", F.lit(None).cast("double")))


def score(docs: DataFrame, labels: DataFrame, scratch: Scratch | None = None, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """docs (key, text, source, ...) -> the table with ``score`` in 0..1 in place of the text; 0.5 or more is a case."""
    scratch = scratch or Scratch(docs.sparkSession)
    known, docs = labelled(docs, labels, key, text, source=source), spread(docs)
    z = scratch.cut(log_odds(docs, train(docs, known, text, source), text, source))
    unfit = {*known.loc[known["label"] >= 0.5, key].tolist()}  # MAX_LABELLED at most
    step = 8.0
    shape = z.where("z IS NOT NULL").groupBy(F.least(F.greatest(F.round(F.col("z") * step), F.lit(-400)), F.lit(400)).cast("int").alias("k"))
    shape = shape.agg(F.count("*").alias("n"), F.count_if(F.col(key).isin(unfit) if unfit else F.lit(False)).alias("u")).orderBy("k").toPandas()  # 801 rows at most
    at, n, u = shape["k"].to_numpy() / step, shape["n"].to_numpy(), shape["u"].to_numpy()
    grid = np.arange(-400, 401) / step
    full = np.zeros(801)
    full[(at * step).astype(int) + 400] = n
    middle = float(at[np.searchsorted(np.cumsum(u), u.sum() / 2)]) if u.sum() else 0.0
    centre = valley(grid, full, middle)
    return z.select(*[c for c in z.columns if c != "z"], F.coalesce(1 / (1 + F.exp(F.lit(centre) - F.col("z"))), F.lit(0.0)).alias("score"))
