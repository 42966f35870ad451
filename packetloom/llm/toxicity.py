"""Toxicity: logistic regression whose scores do not move when identity terms are swapped.

Features of a text are its distinct words and the distinct character n-grams of
these words (word ends marked), hashed to ``2 ** HASH_BITS`` numbers. The model
is fitted on the driver from at most ``sample_rows`` labelled rows, those with
the smallest hash of their id; tasks extract the features. The features most
related to the label (chi-square) are kept.

Counterfactual regularisation: in every sentence of the sample that holds an
identity term, the term is swapped for each other term of its group, and each
pair of terms of a group is also swapped in the bare term. A swap changes the
score by w . d, d being the features gained less those lost; the loss has
``fairness`` times the mean of (w . d) squared over all swaps. So a term that
merely occurs more often in toxic rows gets no weight of its own.

Scoring reads whole texts; the score depends on the text alone. Null or empty
text has no feature and gets the score of the intercept. Without labelled rows
of both kinds the model is the constant 0. Repeated rows each get a row.
"""

from __future__ import annotations

import re

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetloom.llm.common import map_batches

HASH_BITS = 20
GRAMS = (4, 5)
SAMPLE_ROWS = 8_000
KEPT = 6_000
_WORDS = re.compile(r"[^\W_]+")
_SENTENCES = re.compile(r"[^.!?\n]+")
_REMEMBERED = 200_000

#: Terms of one group may stand for each other. A parameter; the default names common groups in the corpus' languages.
IDENTITY_TERMS = (
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "african", "european", "arab"),
    ("women", "men", "girls", "boys", "transgender"),
    ("gay", "lesbian", "straight", "bisexual", "queer"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("frauen", "männer"), ("muslime", "christen", "juden"), ("ausländer", "einheimische"),
    ("femmes", "hommes"), ("musulmans", "chrétiens", "juifs"), ("étrangers", "immigrés"),
    ("mujeres", "hombres"), ("musulmanes", "cristianos", "judíos"), ("extranjeros", "inmigrantes"),
)


def hashed(feature: str) -> int:
    return xxhash.xxh3_64_intdigest(feature.encode()) & ((1 << HASH_BITS) - 1)


_known: dict[str, tuple[int, ...]] = {}


def of_word(word: str) -> tuple[int, ...]:
    """Hashed features of one word: itself and its n-grams; of very long words only the ends and the word."""
    found = _known.get(word)
    if found is None:
        if len(_known) > _REMEMBERED:
            _known.clear()
        marked = f"^{word}$"
        grams = {marked[i : i + n] for n in GRAMS for i in range(len(marked) - n + 1)}
        found = _known[word] = tuple({hashed(g) for g in grams | {f"={word}"}})
    return found


def features(text: str | None) -> set[int]:
    return {f for w in set(_WORDS.findall((text or "").lower())) for f in of_word(w)}


def swaps(text: str | None, groups: tuple[tuple[str, ...], ...]) -> list[tuple[tuple[int, ...], tuple[int, ...]]]:
    """(gained, lost) features of the sentence for every swap of an identity term in it."""
    other = {t: [u for u in group if u != t] for group in groups for t in group}
    out = []
    for sentence in _SENTENCES.findall((text or "").lower()):
        words = set(_WORDS.findall(sentence))
        for term in sorted(words & other.keys()):
            rest = {f for w in words - {term} for f in of_word(w)}
            before = rest | set(of_word(term))
            for swapped in other[term]:
                after = rest | set(of_word(swapped))
                out.append((tuple(after - before), tuple(before - after)))
    return out


class Model:
    """Kept features (sorted hashes), their weights and the intercept."""

    def __init__(self, kept: np.ndarray, weights: np.ndarray, intercept: float):
        self.kept, self.weights, self.intercept = kept, weights, intercept

    def score(self, found: set[int]) -> float:
        table = self.table()
        z = self.intercept + sum(table[f] for f in found if f in table)
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))

    def table(self) -> dict[int, float]:
        return dict(zip(self.kept.tolist(), self.weights.tolist()))


def sample(docs: DataFrame, labels: DataFrame, rows: int, id_col: str, text_col: str, label_col: str, groups: tuple) -> tuple:
    """Feature sets, labels and swaps of the bounded sample."""
    chosen = (
        labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
        .select(id_col, F.col(label_col).cast("int").alias("label")).dropDuplicates([id_col])
        .orderBy(F.xxhash64(id_col), id_col).limit(rows)
    )
    # at most ``rows`` ids
    joined = docs.select(id_col, text_col).join(F.broadcast(chosen), id_col)

    def extract(batch: dict[str, list]) -> dict[str, object]:
        found = [swaps(t, groups) for t in batch["text"]]
        return {
            "label": batch["label"],
            "features": [np.array(sorted(features(t)), dtype=np.int32).tobytes() for t in batch["text"]],
            "gained": [[list(g) for g, _ in s] for s in found], "lost": [[list(x) for _, x in s] for s in found]}

    taken = map_batches(
        joined.select(F.col(text_col).alias("text"), "label"), extract,
        "label int, features binary, gained array<array<int>>, lost array<array<int>>").collect()
    pairs = [(g, x) for r in taken for g, x in zip(r.gained, r.lost)]
    return [np.frombuffer(r.features, dtype=np.int32) for r in taken], np.array([r.label for r in taken]), pairs


def fit(
    rows: list[np.ndarray], labels: np.ndarray, pairs: list[tuple], groups: tuple[tuple[str, ...], ...], kept: int = KEPT,
    penalty: float = 2e-4, fairness: float = 1.0, steps: int = 300, rate: float = 0.05, positive_weight: float = 3.0,
) -> Model:
    """Adam on the mean logistic loss, toxic rows weighted, plus ``penalty`` * |w|^2, plus ``fairness`` * mean (w . d)^2 over the swaps."""
    if len(rows) == 0 or len(set(labels.tolist())) < 2:
        return Model(np.empty(0, dtype=np.int64), np.empty(0), 0.0)
    y = labels.astype(float)
    flat = np.concatenate(rows).astype(np.int64)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    size = 1 << HASH_BITS
    of_one = np.bincount(flat, weights=y[owner], minlength=size)
    of_all = np.bincount(flat, minlength=size)
    share = y.mean()
    expected = of_all * share
    chi = (of_one - expected) ** 2 / np.maximum(expected * (1 - share) * (1 - of_all / len(rows)), 1e-9)
    chi[of_all < 3] = -1.0
    chi[of_all == len(rows)] = -1.0
    chosen = set(np.argsort(-chi, kind="stable")[:kept][: (chi >= 0).sum()].tolist())
    bare = [(tuple(set(of_word(u)) - set(of_word(t))), tuple(set(of_word(t)) - set(of_word(u))))
            for group in groups for t in group for u in group if t < u]
    names = np.array(sorted(chosen), dtype=np.int64)
    place = np.full(size, -1, dtype=np.int64)
    place[names] = np.arange(len(names))
    use = place[flat] >= 0
    column, row = place[flat[use]], owner[use]
    d_column, d_row, d_sign = [], [], []
    for k, (gained, lost) in enumerate([*pairs, *bare]):
        for side, sign in ((gained, 1.0), (lost, -1.0)):
            for f in side:
                if place[f] >= 0:
                    d_column.append(place[f])
                    d_row.append(k)
                    d_sign.append(sign)
    d_column, d_row, d_sign = np.array(d_column, dtype=np.int64), np.array(d_row, dtype=np.int64), np.array(d_sign)
    swapped = len(pairs) + len(bare)
    of_row = np.where(y > 0, positive_weight, 1.0)
    of_row /= of_row.sum()
    w, b = np.zeros(len(names)), float(np.log(share / (1 - share)))
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for step in range(1, steps + 1):
        z = b + np.bincount(row, weights=w[column], minlength=len(rows))
        error = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y) * of_row
        g = np.bincount(column, weights=error[row], minlength=len(names)) + 2 * penalty * w
        if len(d_row):
            change = np.bincount(d_row, weights=d_sign * w[d_column], minlength=swapped)
            g += 2 * fairness / swapped * np.bincount(d_column, weights=d_sign * change[d_row], minlength=len(names))
        gb = error.sum()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        f1, f2 = 1 - 0.9**step, 1 - 0.999**step
        w -= rate * (m / f1) / (np.sqrt(v / f2) + 1e-8)
        b -= rate * (mb / f1) / (np.sqrt(vb / f2) + 1e-8)
    return Model(names, w, float(b))


def train(
    docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, groups: tuple = IDENTITY_TERMS,
    id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", **fitting,
) -> Model:
    rows, marks, pairs = sample(docs, labels, sample_rows, id_col, text_col, label_col, groups)
    return fit(rows, marks, pairs, groups, **fitting)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc id, score, predicted (1 if score >= 0.5) of every row."""
    spread = docs.sparkSession.sparkContext.broadcast(model)

    def of_batch(batch: dict[str, list]) -> dict[str, object]:
        fitted = spread.value
        weight = fitted.table()
        of: dict[str, tuple[int, ...]] = {}
        scores = []
        for text in batch["text"]:
            found: set[int] = set()
            for word in set(_WORDS.findall((text or "").lower())):
                kept = of.get(word)
                if kept is None:
                    if len(of) > _REMEMBERED:
                        of.clear()
                    kept = of[word] = tuple(f for f in of_word(word) if f in weight)
                found.update(kept)
            z = fitted.intercept + float(np.sort([weight[f] for f in found]).sum()) if found else fitted.intercept
            scores.append(float(1 / (1 + np.exp(-np.clip(z, -500, 500)))))
        return {"id": batch["id"], "score": scores, "predicted": [int(s >= 0.5) for s in scores]}

    id_type = docs.schema[id_col].dataType.simpleString()
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return map_batches(source, of_batch, f"id {id_type}, score double, predicted int").withColumnRenamed("id", id_col)
