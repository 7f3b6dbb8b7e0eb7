"""Language ID: sparse multinomial logistic regression on TF-IDF of character n-grams.

Features. Lower-cased characters with one blank for every run of anything but letters; every
n-gram of ``ORDERS`` characters is hashed to one of ``SIZE`` features. A text's weight of a feature is
(1 + log count) * idf, scaled to length one. Document counts are taken over all labelled texts.

Training. Follow-the-regularised-leader with elastic-net penalties: each weight is the closed-form
optimum of the gradients so far, its own learning rate, an absolute and a squared penalty, so most
weights are zero. It sees at most ``QUOTA`` texts of each language, those whose id has the least
hash; the sample's features, not its texts, come to one task and are bounded by quota, languages
and features; the driver gets the weights.

Calibration. A fifth of the sample is kept apart. Whole texts are told apart without an error, so any
temperature below them would look better still; their short pieces, of ``PIECES`` characters, are not, and
labels smoothed by ``SMOOTH`` keep certainty from being free. The temperature that divides the scores is
the one of least log loss on these pieces, 1 at least. There are no intercepts: a text in a script that was not
learned meets few weights and scores little more than chance, whichever languages are frequent.

Scoring reads whole texts, in pieces of bounded size that share one count of features.

Nulls: a null text, or one without a letter, is ``und`` with score 1; rows with a null language are
not learned from; null ids are learned from like others. Repeated rows are scored alike. An empty table,
or one without labels, gives ``und`` with score 0 for every text with letters. Other columns are
ignored. Ties go to the language that sorts first.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimtrace.llm.common import U64, mix, seed, whole_text

SIZE = 1 << 15
ORDERS = (1, 2, 3)
QUOTA = 1500  # texts of a language that the model is fitted on
PIECE = 1 << 20  # characters counted at once
PIECES = (8, 15, 30, 60)  # characters of the pieces that the temperature is fitted on
SMOOTH = 0.02  # share of a label that goes to all languages alike
APART = 5  # one in so many sampled texts is kept apart
UNKNOWN = "und"
_OTHER = regex.compile(r"\P{L}+")


def counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The features of a whole text and how often each occurs; none without a letter."""
    total, found = np.zeros(SIZE, np.int64), False
    last = " "
    for at in range(0, len(text), PIECE):
        plain = _OTHER.sub(" ", text[at : at + PIECE].lower())
        found |= plain != " "
        new = len(last) if at else 0  # characters counted with the piece before
        plain = last + plain[last[-1] == plain[0] == " " :]
        if at + PIECE >= len(text) and plain[-1] != " ":
            plain += " "
        code = np.frombuffer(plain.encode("utf-32-le"), np.uint32).astype(U64)
        gram, hashed = code, []
        for order in range(1, max(ORDERS) + 1):
            if order > 1:
                gram = gram[: len(gram) - 1] * U64(0x110000) + code[order - 1 :] if len(gram) > 1 else gram[:0]
            if order in ORDERS:
                hashed.append(mix(gram[max(0, new - order + 1) :] + seed(order)) & U64(SIZE - 1))
        total += np.bincount(np.concatenate(hashed).view(np.int64), minlength=SIZE)
        last = plain[-(max(ORDERS) - 1) :]
    if not found:
        total[:] = 0
    features = np.flatnonzero(total)
    return features, total[features]


@dataclass
class Model:
    """Languages in order, a weight for each feature and language, idf, and the temperature.

    Of no text is a score below chance, one in so many languages.
    """

    languages: list[str]
    weights: np.ndarray
    idf: np.ndarray
    temperature: float = 1.0

    def scores(self, features: np.ndarray, n: np.ndarray) -> np.ndarray:
        value = (1 + np.log(n)) * self.idf[features]
        value /= np.sqrt((value * value).sum()) or 1.0
        return value @ self.weights[features]

    def predict(self, text: str) -> tuple[str, float]:
        features, n = counts(text)
        if not len(features):
            return UNKNOWN, 1.0
        if not self.languages:
            return UNKNOWN, 0.0
        p = _softmax(self.scores(features, n) / self.temperature)
        best = int(np.argmax(p))
        return self.languages[best], float(p[best])


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max())
    return e / e.sum()


def ftrl(
    rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, epochs: int = 5, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.01, l2: float = 0.01
) -> np.ndarray:
    """Weights for rows of features, values and class."""
    z, n = np.zeros((SIZE, classes)), np.zeros((SIZE, classes))

    def weight(at) -> np.ndarray:
        shrunk = np.sign(z[at]) * np.maximum(np.abs(z[at]) - l1, 0)
        return -shrunk / ((beta + np.sqrt(n[at])) / alpha + l2)

    order = np.random.default_rng(0)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            at, x, label = rows[i]
            w = weight(at)
            error = _softmax(x @ w)
            error[label] -= 1
            g = x[:, None] * error[None, :]
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - step * w
            n[at] += g * g
    return weight(np.arange(SIZE))


def temperature(logits: np.ndarray, labels: np.ndarray, smooth: float = SMOOTH) -> float:
    """What to divide the scores by for the least log loss against smoothed labels, from 1 to 50."""
    tried = np.geomspace(1, 50, 241)
    if not len(labels):
        return 1.0
    losses = []
    for t in tried:
        s = logits / t
        s = s - s.max(axis=1, keepdims=True)
        s = s - np.log(np.exp(s).sum(axis=1, keepdims=True))
        losses.append(-((1 - smooth) * s[np.arange(len(labels)), labels] + smooth * s.mean(axis=1)).mean())
    return float(tried[int(np.argmin(losses))])


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(SIZE, np.int64)
    for batch in batches:
        for text in batch.column(0).to_pylist():
            total[counts(text)[0]] += 1
    at = np.flatnonzero(total)
    if len(at):
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["feature", "docs"])


def pieces(text: str, h: int) -> list[str]:
    """One piece of the text of each length that it has, from places that a hash tells."""
    return [text[(h >> 3) % (len(text) - n + 1) :][:n] for n in PIECES if len(text) >= n]


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features of the sampled texts, or of the pieces of those kept apart."""
    names = ["lang", "h", "apart", "features", "n"]
    for batch in batches:
        rows = []
        for lang, h, text in zip(*[batch.column(c).to_pylist() for c in ("lang", "h", "text")]):
            apart = h % APART == 0
            rows += [(lang, h, apart, *counts(t)) for t in (pieces(text, h) if apart else [text])]
        if rows:
            plain = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.string(), pa.int64(), pa.bool_()))]
            listed = [pa.array([r[i].astype(np.int32) for r in rows], pa.list_(pa.int32())) for i in (3, 4)]
            yield pa.RecordBatch.from_arrays([*plain, *listed], names)


def _trained(languages: list[str], idf: np.ndarray):
    """The sample's features, all in one task, to the one row of weights and temperature."""
    number = {name: i for i, name in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        ready: dict[bool, list] = {False: [], True: []}
        if held:
            # All rows in a few large arrays, which are given back whole when the task ends.
            features, n = (np.concatenate([b.column(c).flatten().to_numpy() for b in held]) for c in ("features", "n"))
            sizes = np.concatenate([b.column("features").value_lengths().to_numpy() for b in held])
            label = np.array([number[x] for b in held for x in b.column("lang").to_pylist()])
            h, apart = (np.concatenate([b.column(c).to_numpy(zero_copy_only=False) for b in held]) for c in ("h", "apart"))
            value = ((1 + np.log(n.astype(np.float32))) * idf.astype(np.float32)[features]).astype(np.float32)
            del n, held
            ends = np.cumsum(sizes)
            for i in np.lexsort((sizes, label, h)).tolist():
                if sizes[i]:
                    row = slice(ends[i] - sizes[i], ends[i])
                    value[row] /= np.sqrt((value[row] ** 2).sum())
                    ready[bool(apart[i])].append((features[row], value[row], int(label[i])))
        weights = ftrl(ready[False], len(languages)).astype(np.float32)
        logits = np.array([v @ weights[f] for f, v, _ in ready[True]]).reshape(-1, len(languages))
        heat = temperature(logits, np.array([label for *_, label in ready[True]], np.int64))
        yield pa.RecordBatch.from_pydict({"weights": [weights.tobytes()], "heat": [heat]})

    return run


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", quota: int = QUOTA) -> Model:
    """The model of the labelled texts; the hash of ``key`` chooses the sample and nothing else."""
    rows = labelled.select(F.col(lang).alias("lang"), F.xxhash64(key).alias("h"), whole_text(text).alias("text"))
    rows = rows.where(F.col("lang").isNotNull())
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return Model([], np.zeros((SIZE, 0)), np.ones(SIZE))
    languages = sorted(sizes)
    found = rows.select("text").mapInArrow(_document_counts, "feature long, docs long")
    seen = np.zeros(SIZE)
    for r in found.groupBy("feature").agg(F.sum("docs").alias("docs")).collect():  # SIZE rows at most
        seen[r.feature] = r.docs
    idf = np.log((1 + sum(sizes.values())) / (1 + seen)) + 1
    # The least hashes of a language: those below the share of hashes that its quota is.
    below = F.lit(None).cast("long")
    for name in languages:
        share = min(1.0, quota / sizes[name])
        below = F.when(F.col("lang") == name, F.lit(int(-(1 << 63) + share * ((1 << 64) - 1)) if share < 1 else (1 << 63) - 1)).otherwise(below)
    chosen = rows.where(F.col("h") <= below).limit(2 * quota * len(languages))  # a bound even if keys repeat
    features = chosen.mapInArrow(_features, "lang string, h long, apart boolean, features array<int>, n array<int>")
    made = features.repartition(1).mapInArrow(_trained(languages, idf), "weights binary, heat double").first()
    weights = np.frombuffer(made.weights, np.float32).reshape(SIZE, len(languages))
    return Model(languages, weights, idf, made.heat)


def predicted(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows with ``lang_pred`` and ``score`` in a struct column ``language``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # SIZE weights a language

    def frame(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([shared.value.predict(t) for t in texts], columns=["lang_pred", "score"])

    return docs.withColumn("language", F.pandas_udf(frame, "lang_pred string, score double")(whole_text(text_col)))


def held_out(key: str) -> Column:
    """Rows kept from training: those whose id's checksum leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def accepted(lang_pred: Column, score: Column, least: float = 0.4) -> Column:
    """Whether a prediction is good enough to keep the text: some language, with that score."""
    return (lang_pred != UNKNOWN) & (score >= least)
