"""Toxicity scores: gradient-boosted trees over dense features, calibrated by isotonic regression.

A model is learned from labelled texts: at most ``max_rows`` of them, those with the smallest hashes of their ids. From
these come the lexicon (words and word beginnings that stand in toxic texts nearly always or mostly), the trees and the
calibration; a quarter of the rows, chosen by another hash, is kept from lexicon and trees for the calibration. Features
are densities of the lexicon, how near second-person words stand to it, capitals, punctuation and obfuscation, taken from
the whole text. Ids, sources and languages are no features.

A null text counts as an empty one, which is scored like any other; rows without a label are no training rows, and
repeated ids are rows of their own. Without labels of both kinds there is nothing to learn, and every score is the share
of toxic labels, 0 if there are none. Extra columns are kept, columns called like a result are replaced.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, functions as F

from tillroll.staging import written

MAX_ROWS = 20_000
SUPPORT = 8  # toxic texts a term must stand in
STRONG, WEAK = 0.95, 0.5  # share of its texts that are toxic, in equal numbers of both kinds
REJECT = 0.7
STEMS = (4, 5, 6)
NEAR = 4  # words
# second-person words of English, German, French and Spanish: fixed values
YOU = frozenset(
    "you your yours yourself u ur du dich dir dein deine deiner euch euer ihr sie tu te toi ton ta tes vous votre vos"
    " tú ti tus usted ustedes vosotros vuestro".split()
)
_WORD = re.compile(r"[^\W\d_]+")
_MASKED = re.compile(r"\b[^\W\d_]+(?:[0-9@$*!#|][^\W\d_]+)+\b|\b(?:[^\W\d_][.\-_* ]){3,}[^\W\d_]\b")
_LEET = str.maketrans("01345789@$!|", "oieastbgasii")
_STRETCHED = re.compile(r"([^\W\d_])\1{2,}")
_RUNS = re.compile(r"[!?]{2,}|[^\w\s]{3,}")
FEATURES = (
    "log_words", "strong_density", "strong_count", "strong_kinds", "weak_density", "near_you", "you_density",
    "capitals", "shouted", "exclamations", "questions", "punctuation", "punctuation_runs", "masked", "masked_strong",
    "stretched",
)


@dataclass(frozen=True)
class Lexicon:
    strong: frozenset[str]
    weak: frozenset[str]

    def kind(self, word: str) -> int:
        """2 for a strong, 1 for a weak word, else 0; longer forms come first."""
        for form in (word, *(word[:k] + "*" for k in reversed(STEMS) if len(word) > k)):
            if form in self.strong:
                return 2
            if form in self.weak:
                return 1
        return 0


class _Kinds(dict):
    """The kinds of words met so far in a task."""

    def __init__(self, lexicon: Lexicon):
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, word: str) -> int:
        if len(self) > 300_000:
            self.clear()
        self[word] = found = self.lexicon.kind(word)
        return found


@lru_cache(maxsize=2)
def _kinds(lexicon: Lexicon) -> _Kinds:
    return _Kinds(lexicon)


def terms(text: str) -> set[str]:
    """The words of a text and their beginnings."""
    words = set(_WORD.findall(text.lower()))
    return words | {w[:k] + "*" for w in words for k in STEMS if len(w) > k}


def feature_row(text: str, kinds: dict[str, int]) -> list[float]:
    words = _WORD.findall(text.lower())
    total = max(1, len(words))
    kind = [kinds[w] for w in words]
    strong = [i for i, k in enumerate(kind) if k == 2]
    weak = kind.count(1)
    you = sum(map(YOU.__contains__, words))
    near = sum(not YOU.isdisjoint(words[max(0, i - NEAR) : i + NEAR + 1]) for i in strong)
    chars = max(1, len(text))
    capitals = sum(map(str.isupper, text)) if not text.islower() else 0
    shouted = sum(w.isupper() for w in _WORD.findall(text) if len(w) > 2) if capitals else 0
    masked = [m.lower() for m in _MASKED.findall(text)]
    plain = [re.sub(r"[^\w]|_", "", m.translate(_LEET)) for m in masked]
    return [
        np.log1p(len(words)), len(strong) / total, np.log1p(len(strong)), float(len({words[i] for i in strong})),
        weak / total, near / max(1, len(strong)), you / total, capitals / chars, shouted / total,
        text.count("!") / chars, text.count("?") / chars,
        (text.count(",") + text.count(".") + text.count(";") + text.count(":")) / chars,
        len(_RUNS.findall(text)) / total, len(masked) / total, float(sum(kinds[w] == 2 for w in plain)),
        len(_STRETCHED.findall(text)) / total,
    ]


def features(text: Column, lexicon: Lexicon) -> Column:
    @F.pandas_udf("array<double>")
    def measure(texts: pd.Series) -> pd.Series:
        kinds = _kinds(lexicon)
        return pd.Series([feature_row(t or "", kinds) for t in texts], dtype=object)

    return measure(text)


def _counted(texts: DataFrame, among: frozenset[str] | None) -> DataFrame:
    """(term, n): the number of texts each term stands in."""

    def count(frames):
        held: dict[str, int] = {}
        for frame in frames:
            for text in frame["text"]:
                found = terms(text or "")
                for term in found if among is None else found & among:
                    held[term] = held.get(term, 0) + 1
        yield pd.DataFrame({"term": list(held), "n": list(held.values())}).astype({"term": object, "n": "int64"})

    return texts.select("text").mapInPandas(count, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))


def learn_lexicon(toxic: DataFrame, clean: DataFrame, ratio: float) -> Lexicon:
    """``ratio``: clean texts per toxic one. All terms of the labelled texts are looked at that stand in ``SUPPORT`` toxic ones."""
    often = _counted(toxic, None).where(F.col("n") >= SUPPORT).collect()  # the labelled texts are bounded, and so are their terms
    bad = {r.term: r.n for r in often}
    good = {r.term: r.n for r in _counted(clean, frozenset(bad)).collect()}
    share = {t: n / (n + good.get(t, 0) / max(ratio, 1.0)) for t, n in bad.items()}
    pure = {t for t in bad if bad[t] / (bad[t] + good.get(t, 0)) >= STRONG and share[t] >= STRONG}
    return Lexicon(frozenset(pure), frozenset(t for t in bad if t not in pure and share[t] >= 1 - (1 - WEAK) / 4))


class ToxicityModel:
    def __init__(self, lexicon: Lexicon, trees, calibration, constant: float):
        self.lexicon, self.trees, self.calibration, self.constant = lexicon, trees, calibration, constant

    def score(self, docs: DataFrame, text_col: str = "text") -> DataFrame:
        """``docs`` with ``score``, the calibrated probability of a toxic label."""
        kept = [c for c in docs.columns if c != "score"]
        if self.trees is None:
            return docs.select(*kept, F.lit(self.constant).alias("score"))
        held = docs.select(
            F.struct(*kept).alias("doc"),
            array_to_vector(features(F.col(text_col), self.lexicon)).alias("features"),
        )
        chance = vector_to_array("probability")[1]
        judged = self.trees.transform(held).select("doc", chance.alias("chance"))
        score = F.least(F.greatest(F.col("score"), F.lit(0.0)), F.lit(1.0))
        return self.calibration.transform(judged).select("doc.*", score.alias("score"))


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    max_rows: int = MAX_ROWS, rounds: int = 20, depth: int = 4, seed: int = 3,
) -> ToxicityModel:
    """A model of ``label_col`` (0 or 1) from the rows of ``labels`` and the texts of ``docs``."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("id"), F.col(label_col).alias("label"))
    chosen = known.withColumn("h", F.xxhash64(F.lit(seed), "id")).orderBy("h", "id", "label").limit(max_rows)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # max_rows bounds the broadcast side
    rows = texts.join(F.broadcast(chosen), "id").select("id", "text", F.col("label").cast("double").alias("label"))
    rows = written(rows.withColumn("kept", F.pmod(F.xxhash64(F.lit(seed + 1), "id"), F.lit(4)) == 0), "toxicity-sample")
    held = {(r.kept, r.label): r.n for r in rows.groupBy("kept", "label").agg(F.count("*").alias("n")).collect()}
    toxic = held.get((False, 1.0), 0), held.get((True, 1.0), 0)
    clean = held.get((False, 0.0), 0), held.get((True, 0.0), 0)
    if not all(toxic + clean):
        return ToxicityModel(Lexicon(frozenset(), frozenset()), None, None, sum(toxic) / max(1, sum(toxic + clean)))
    train = rows.where("NOT kept")
    lexicon = learn_lexicon(train.where("label = 1"), train.where("label = 0"), clean[0] / toxic[0])
    measured = rows.select("id", "kept", "label", features(F.col("text"), lexicon).alias("f"))
    measured = written(measured, "toxicity-features").withColumn("features", array_to_vector("f"))
    trees = GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=0.3, seed=seed, featuresCol="features", labelCol="label")
    trees = trees.fit(measured.where("NOT kept"))
    judged = trees.transform(measured.where("kept")).select("label", vector_to_array("probability")[1].alias("chance"))
    calibration = IsotonicRegression(featuresCol="chance", labelCol="label", predictionCol="score").fit(judged)
    return ToxicityModel(lexicon, trees, calibration, 0.0)


def held_out(id_col: str) -> Column:
    """Rows that no model learns from: a third, by the checksum of the id; never null."""
    third = F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(3)) == 1
    return F.coalesce(third, F.lit(False))


def without_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", reject: float = REJECT) -> DataFrame:
    """``docs`` that score below ``reject``, by a model of the labels that are not held out."""
    model = fit(docs, labels.where(~held_out(id_col)), id_col, text_col)
    return model.score(docs.select(F.struct("*").alias("doc"), F.col(text_col).alias("text"))).where(F.col("score") < reject).select("doc.*")
