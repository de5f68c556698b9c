"""Toxicity: a weighted lexicon matched by Aho-Corasick over folded texts.

Folding undoes disguises: case, accents and compatibility forms (wide, mathematical letters),
Cyrillic and Greek letters that look Latin, digits and signs in the place of letters, characters of no
width. i, l, 1, ! and | fold to one letter. One automaton finds all terms and all exception phrases of
a text in one pass. A term counts as a whole word (an s may follow) unless an exception phrase covers it.
The score is a logistic function of the weights found per thousand characters.

Weights are learned from a bounded sample of labelled rows (``PER_CLASS`` of each class:
of the first ``CANDIDATES`` times as many in the order of a hash of the id, the first
that have a text of up to ``LONGEST`` bytes), never from held-out ids. A word, or the beginning of a family of
words, joins the lexicon if it is far more frequent in toxic texts: counted once with each word before it, so that neither a
text that repeats itself nor copies of one text make a term. Terms of ``SEEDS`` have a weight of their own until the sample
says otherwise. Texts are scored whole, piece by piece.

Defined results: null counts as empty text; an empty text scores like any text without terms. Labels that are
null, or that disagree for one id, are not learned from. Without labels of both classes the seeds and
fixed coefficients score alone. Repeated rows and null ids are scored each. Other columns
of the inputs are ignored, kept ones stay.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm.batches import text_pieces
from skein.llm.quality import held_out

PER_CLASS, CANDIDATES, LONGEST = 600, 3, 16_000
#: Insults that count before any label is seen, and their weight.
SEEDS = "idiot idiotic moron moronic imbecile stupid dumbass worthless pathetic disgusting trash scum scumbag loser clown bastard bitch asshole jackass retard".split()
SEED_WEIGHT = 3.0
#: Harmless phrases that hold a term.
EXCEPTIONS = (
    "trash can", "trash cans", "trash bin", "trash bins", "trash bag", "trash bags", "trash collection", "trash pickup", "take out the trash", "taking out the trash",
    "clown fish", "circus clown", "clown car", "class clown", "pond scum", "soap scum", "sore loser", "loser bracket", "losers bracket", "cheeky bastard sword", "bastard sword", "bastard file",
)
#: Least evidence (log-likelihood ratio, twice), ratio of rates, letters and texts of a learned term; the longest lexicon.
EVIDENCE, RATIO, LEAST, TEXTS, TERMS = 30.0, 10.0, 3, 5, 2_000
#: A beginning that makes up less than this share of the words it begins is an open term.
OPEN = 0.8
#: Characters added to every text's length, and characters that a rate counts by.
SMOOTH, PER = 200, 1_000
#: (offset, slope) where there are no labels.
UNFITTED = (-3.0, 3.0)
RIDGE = 1.0

#: Fixed: letters that look like Latin ones, below their Latin looks.
_LOOKS = (
    ("абвегикмнорстухѕіјԁһԛԝ", "abberukmhopctyxsijdhqw"),
    ("αβεικνορτυχωγη", "abeikvoptuxwyn"),
    ("ıɩɡɑʟƽ", "iigals"),
)
_DIGITS = ("0134578", "oieastb")
_SIGNS = {"@": "a", "$": "s", "!": "i", "|": "i"}
_WIDTHLESS = [0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF, *range(0x300, 0x370)]
_PLAIN = str.maketrans(_DIGITS[0] + "l", _DIGITS[1] + "i")
_WIDE = str.maketrans(dict.fromkeys(_WIDTHLESS)) | {ord(a): b for looks, latin in _LOOKS for a, b in zip(looks, latin, strict=True)}
_SIGN = re.compile(r"[@$!|](?=[^\W_])")
_WORD = re.compile(r"[^\W_]+")


def fold(text: str) -> str:
    """The text with disguises undone; terms and texts are compared in this form."""
    text = text.lower()
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text).lower().translate(_WIDE)
    return _SIGN.sub(lambda m: _SIGNS[m[0]], text).translate(_PLAIN)


@dataclass
class Lexicon:
    weights: dict[str, tuple[float, bool]]  # by folded term; open ones are beginnings of words
    exceptions: tuple[str, ...]  # folded phrases
    offset: float = UNFITTED[0]
    slope: float = UNFITTED[1]
    found: object = field(default=None, repr=False)

    @classmethod
    def of(cls, weights: dict[str, float], exceptions: Iterable[str] = EXCEPTIONS) -> Lexicon:
        return cls({fold(t): (w, False) for t, w in weights.items()}, tuple(fold(p) for p in exceptions))

    def automaton(self) -> ahocorasick.Automaton:
        if self.found is None:
            made = ahocorasick.Automaton()
            for phrase in self.exceptions:
                made.add_word(phrase, (len(phrase), None, False))
            for term, (weight, open_) in self.weights.items():
                made.add_word(term, (len(term), weight, open_))
            made.make_automaton()
            self.found = made
        return self.found

    def __getstate__(self) -> dict:
        return self.__dict__ | {"found": None}

    def total(self, folded: str) -> float:
        """The weights of all terms in a folded text that stand as words and that no exception covers."""
        if not self.weights:
            return 0.0
        size, hits, covered = len(folded), [], []
        for last, (length, weight, open_) in self.automaton().iter(folded):
            first, end = last + 1 - length, last + 1
            if first and folded[first - 1].isalnum():
                continue
            plural = end < size and folded[end] == "s"
            if not open_ and end + plural < size and folded[end + plural].isalnum():
                continue
            if weight is None:
                covered.append((first, end))
            else:
                hits.append((first, end, weight))
        if not covered:
            return sum(w for _, _, w in hits)
        total, at = 0.0, 0
        reach = []  # exceptions by start, with the farthest end so far
        for first, end in sorted(covered):
            reach.append((first, max(end, reach[-1][1] if reach else 0)))
        for first, end, weight in sorted(hits):
            while at < len(reach) and reach[at][0] <= first:
                at += 1
            if not at or reach[at - 1][1] < end:
                total += weight
        return total

    def rate(self, text: str) -> float:
        """Weights for each ``PER`` characters, on a logarithmic scale."""
        folded = fold(text)
        return math.log1p(self.total(folded) * PER / (len(folded) + SMOOTH))

    def score(self, text: str) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.offset + self.slope * self.rate(text)))))


def _pairs(texts: list[str]) -> tuple[set[tuple[str, str]], dict[str, int]]:
    """The distinct pairs of neighbouring words, and of each beginning of a word the number of texts that hold it."""
    pairs, held = set(), defaultdict(int)
    for text in texts:
        words = _WORD.findall(fold(text))
        pairs.update(zip(["", *words], words, strict=False))
        for stem in {w[:k] for w in set(words) for k in range(LEAST, len(w) + 1)}:
            held[stem] += 1
    return pairs, held


def learned(toxic: list[str], clean: list[str]) -> dict[str, tuple[float, bool]]:
    """(weight, open) of terms: whole words and open beginnings of words that are far more frequent in toxic texts, and seeds.

    A beginning is counted by the distinct pairs of a word that begins so and the word before it. Of beginnings of
    one another that with the most evidence stays, the longest of those alike.
    """
    (a, texts_of), (b, _) = _pairs(toxic), _pairs(clean)
    stems = {s for s, n in texts_of.items() if n >= TEXTS}
    seeds = {fold(s) for s in SEEDS}
    x, y, whole = defaultdict(int), defaultdict(int), defaultdict(int)
    for pairs, counts in ((a, x), (b, y)):
        for _, word in pairs:
            for k in range(LEAST, len(word) + 1):
                if word[:k] in stems or word[:k] in seeds:
                    counts[word[:k]] += 1
            if pairs is a and word in stems:
                whole[word] += 1
    found = []
    for stem in stems:
        m, n = x[stem], y[stem]
        ratio = ((m + 0.5) / len(a)) / ((n + 0.5) / len(b))
        share = (m + n) / (len(a) + len(b))
        evidence = 2 * sum(c * math.log(c / (size * share)) for c, size in ((m, len(a)), (n, len(b))) if c)
        if evidence >= EVIDENCE and ratio >= RATIO:
            found.append((evidence, stem, math.log(ratio)))
    out = {s: (SEED_WEIGHT, False) for s in seeds if (x[s] + 0.5) / len(a) >= (y[s] + 0.5) / len(b) or y[s] < TEXTS}
    taken, below = set(), set()
    for _, stem, weight in sorted(found, key=lambda f: (-f[0], -len(f[1]), f[1])):
        if len(taken) == TERMS:
            break
        beginnings = {stem[:k] for k in range(LEAST, len(stem) + 1)}
        if stem in below or beginnings & taken:
            continue
        taken.add(stem)
        below |= beginnings
        out[stem] = (weight, whole[stem] < OPEN * x[stem])
    return out


def fit(toxic: list[str], clean: list[str], exceptions: Iterable[str] = EXCEPTIONS) -> Lexicon:
    """A lexicon with weights from labelled texts, and its logistic coefficients by Newton's method; classes count as they are."""
    lexicon = Lexicon(learned(toxic, clean), tuple(fold(p) for p in exceptions))
    x = np.array([[1.0, lexicon.rate(t)] for t in (*toxic, *clean)])
    y = np.repeat([1.0, 0.0], [len(toxic), len(clean)])
    beta, ridge = np.array(UNFITTED), RIDGE * np.array([0.0, 1.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge + 1e-9), x.T @ (y - p) - ridge * beta)
        beta = beta + np.clip(step, -2, 2)
    lexicon.offset, lexicon.slope = float(beta[0]), float(beta[1])
    return lexicon


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Lexicon:
    """Fit on at most per_class labelled rows of each class; the seeds alone without rows of both."""
    spark = docs.sparkSession
    agreed = (
        labels.where("doc_id is not null and toxic in (0, 1)")
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("toxic").alias("t"), F.max("toxic").alias("most"))
        .where("t = most")
    )
    order = [F.xxhash64("doc_id"), "doc_id"]
    asked = {t: [r["doc_id"] for r in agreed.where(F.col("t") == t).orderBy(*order).limit(per_class * CANDIDATES).collect()] for t in (0, 1)}
    if not all(asked.values()):
        return Lexicon.of(dict.fromkeys(SEEDS, SEED_WEIGHT))
    some = F.broadcast(spark.createDataFrame([(i,) for ids in asked.values() for i in ids], "doc_id long"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.octet_length("text") <= LONGEST).join(some, "doc_id")
    texts = {r["doc_id"]: r["text"] for r in rows.groupBy("doc_id").agg(F.min("text").alias("text")).collect()}
    clean, toxic = ([texts[i] for i in asked[t] if i in texts][:per_class] for t in (0, 1))
    if not clean or not toxic:
        return Lexicon.of(dict.fromkeys(SEEDS, SEED_WEIGHT))
    return fit(toxic, clean)


def score_toxicity(docs: DataFrame, lexicon: Lexicon, keep: list[str], text_col: str = "text", out: str = "score") -> DataFrame:
    """The kept columns of docs and the score, for each row; a kept column of the score's name gives way to it."""
    keep = [c for c in keep if c != out]
    schema = docs.select(*keep, F.lit(0.5).alias(out)).schema
    column = text_col if text_col in keep else "__text"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_pieces(batches, column):
            raw = data.tobytes()
            scores = [lexicon.score(raw[a:b].decode("utf-8", "replace")) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            yield pa.record_batch([*rows.columns[: len(keep)], pa.array(scores, pa.float64())], names=[*keep, out])

    sent = keep if text_col in keep else [*keep, F.col(text_col).alias(column)]
    return docs.select(*sent).mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    scored = score_toxicity(docs, train(docs, labels), ["doc_id"])
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
