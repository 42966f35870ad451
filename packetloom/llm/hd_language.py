"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1 that its code point fixes. The
vector of a letter n-gram binds its letters' vectors, each rotated by its place,
with the elementwise product. A text is the sum (bundle) of the vectors of all
n-grams inside its words, blanks at word ends included; a language prototype is
the bundle of all its training texts. A text goes to the prototype of largest
cosine.

Sums of +-1 are whole numbers, so prototypes do not depend on partitions. A
task adds up its own texts, Spark adds the tasks; the driver sees one vector
per language. Texts are bundled many at once as a matrix product of n-gram
counts and n-gram vectors; very long ones in pieces, which sum exactly.

Null text and text without a letter: ``und`` with score 0, also if nothing was
learned. Ties go to the alphabetically first language. Rows with null language
teach nothing. Empty table: no rows; repeated rows each give one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetloom.llm.common import alone, arrow_schema, batch_of, map_batches, of_texts, small

DIMENSION = 1024
N = 3
SEED = 20_240_501
PIECE_CHARS = 1 << 20
ROWS, CHARS = 64, 1 << 18  # texts and characters bundled in one product
REMEMBERED = 24_000  # n-gram vectors per worker

_BLANK = re.compile(r"[\W\d_]")
_ALPHA = np.array([chr(c).isalpha() for c in range(0x10000)])
_PRIVATE, _PRIVATE_SIZE = 0xE000, 0x1900


def letters_of(text: str) -> np.ndarray:
    """16-bit letter codes with single zeros between words and at both ends."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    codes = np.where(_ALPHA[points & 0xFFFF], points, 0)
    high = np.flatnonzero(points > 0xFFFF)
    if len(high):  # letters beyond 16 bits share the private-use codes
        known = {int(c): _PRIVATE + int(c) % _PRIVATE_SIZE if chr(c).isalpha() else 0 for c in np.unique(points[high])}
        codes[high] = [known[c] for c in points[high].tolist()]
    codes = np.concatenate([[0], codes, [0]]).astype(np.int64)
    keep = np.ones(len(codes), dtype=bool)
    keep[1:] = (codes[1:] != 0) | (codes[:-1] != 0)
    return codes[keep]


def grams_of(text: str) -> np.ndarray:
    """Packed n-grams of three letters within the words of a text."""
    c = letters_of(text)
    if len(c) < N:
        return np.empty(0, dtype=np.int64)
    packed = (c[:-2] << 32) | (c[1:-1] << 16) | c[2:]
    return packed[c[1:-1] != 0]


def pieces_of(text: str) -> Iterator[str]:
    """The text in pieces of about PIECE_CHARS, cut between words."""
    start = 0
    while len(text) - start > PIECE_CHARS:
        blank = _BLANK.search(text, start + PIECE_CHARS)
        if blank is None:
            break
        yield text[start : blank.start()]
        start = blank.start()
    yield text[start:] if start else text


class Space:
    """Vectors of the n-grams met so far."""

    def __init__(self, dimension: int, seed: int):
        self.dimension, self.seed = dimension, seed
        self.letters: dict[int, np.ndarray] = {}
        self.clear()

    def clear(self) -> None:
        self.keys, self.at = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        self.vectors = np.empty((0, self.dimension), dtype=np.int8)

    def letter(self, code: int) -> np.ndarray:
        if code not in self.letters:
            bits = np.random.default_rng([self.seed, code]).integers(0, 2, self.dimension, dtype=np.int8)
            self.letters[code] = 2 * bits - 1
        return self.letters[code]

    def bind(self, grams: np.ndarray) -> np.ndarray:
        out = np.ones((len(grams), self.dimension), dtype=np.int8)
        for place in range(N):
            codes, which = np.unique((grams >> (16 * (N - 1 - place))) & 0xFFFF, return_inverse=True)
            out *= np.array([np.roll(self.letter(int(c)), N - 1 - place) for c in codes])[which]
        return out

    def of(self, grams: np.ndarray) -> np.ndarray:
        """Vectors of the given sorted distinct n-grams."""
        place = np.searchsorted(self.keys, grams)
        known = np.zeros(len(grams), dtype=bool)
        inside = place < len(self.keys)
        known[inside] = self.keys[place[inside]] == grams[inside]
        if not known.all():
            new = grams[~known]
            if len(self.keys) + len(new) > REMEMBERED:
                self.clear()
                new = grams
                if len(new) > REMEMBERED:
                    return self.bind(new)
            at = np.concatenate([self.at, len(self.vectors) + np.arange(len(new))])
            keys = np.concatenate([self.keys, new])
            self.vectors = np.concatenate([self.vectors, self.bind(new)])
            order = np.argsort(keys)
            self.keys, self.at = keys[order], at[order]
            place = np.searchsorted(self.keys, grams)
        return self.vectors[self.at[place]]

    def bundle(self, owners: list[int], texts: list[str], rows: int) -> np.ndarray:
        """Sum of n-gram vectors for each owner 0..rows-1 of the texts."""
        out = np.zeros((rows, self.dimension))
        parts, size = [], 0

        def add() -> None:
            found = np.sort(np.concatenate(parts))
            first = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
            counts = np.diff(np.append(first, len(found)))
            owner, gram = found[first] >> 48, found[first] & ((1 << 48) - 1)
            distinct = np.unique(gram)
            table = np.zeros((rows, len(distinct)), dtype=np.float32)
            table[owner, np.searchsorted(distinct, gram)] = counts
            for lo in range(0, len(distinct), 4096):  # vectors become floats a few at a time
                out[:] += table[:, lo : lo + 4096] @ self.of(distinct[lo : lo + 4096]).astype(np.float32)

        for owner, text in zip(owners, texts):
            for piece in pieces_of(text):
                grams = grams_of(piece)
                if len(grams):
                    parts.append(grams | (np.int64(owner) << 48))
                    size += len(grams)
                if size >= PIECE_CHARS // 2:
                    add()
                    parts, size = [], 0
        if parts:
            add()
        return out


_spaces: dict[tuple[int, int], Space] = {}


def space(dimension: int, seed: int) -> Space:
    return _spaces.setdefault((dimension, seed), Space(dimension, seed))


def few(texts: list[str]) -> Iterator[slice]:
    """Runs of at most ROWS texts and about CHARS characters."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if i > start and (i - start >= ROWS or size + len(text) > CHARS):
            yield slice(start, i)
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield slice(start, len(texts))


def learn(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", dimension: int = DIMENSION, seed: int = SEED,
) -> dict[str, np.ndarray]:
    """Prototype of every language with a training text."""
    types = arrow_schema(docs.sparkSession, "lang string, bundle array<long>")

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in small(batches):
            columns = batch.to_pydict()
            names = sorted(set(columns["lang"]))
            number = {name: i for i, name in enumerate(names)}
            for lo in range(0, len(names), ROWS):  # few languages at once keep the count matrix small
                own = [i for i, name in enumerate(columns["lang"]) if lo <= number[name] < lo + ROWS]
                added = space(dimension, seed).bundle(
                    [number[columns["lang"][i]] - lo for i in own], [columns["text"][i] for i in own], min(ROWS, len(names) - lo))
                for name, vector in zip(names[lo : lo + ROWS], added):
                    sums[name] = sums.get(name, 0) + vector
        space(dimension, seed).clear()
        if sums:
            yield batch_of({"lang": list(sums), "bundle": [v.astype(np.int64) for v in sums.values()]}, types)

    taught = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    parts = taught.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).mapInArrow(
        bundle, "lang string, bundle array<long>")
    summed = parts.select("lang", F.posexplode("bundle")).groupBy("lang", "pos").agg(F.sum("col").alias("value"))
    out: dict[str, np.ndarray] = {}
    for row in summed.collect():  # languages x dimension numbers
        out.setdefault(row.lang, np.zeros(dimension))[row.pos] = row.value
    return {name: out[name] for name in sorted(out) if out[name].any()}


def best_of(texts: list[str], unit: np.ndarray, dimension: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest prototype and its cosine, negative ones as 0; -1 and -1.0 for a text without a letter."""
    alone("n-grams", _spaces.clear)
    bundles = space(dimension, seed).bundle(list(range(len(texts))), texts, len(texts))
    norms = np.linalg.norm(bundles, axis=1)
    cosines = bundles @ unit.T / np.where(norms > 0, norms, 1.0)[:, None]
    found = norms > 0
    return np.where(found, cosines.argmax(axis=1), -1), np.where(found, cosines.max(axis=1).clip(0.0, 1.0), -1.0)


def predict(
    docs: DataFrame, prototypes: dict[str, np.ndarray], id_col: str = "doc_id", text_col: str = "text",
    dimension: int = DIMENSION, seed: int = SEED, keep: tuple[str, ...] = (),
) -> DataFrame:
    """doc id, ``keep`` columns, lang_pred and score (cosine, negative ones as 0) of every row."""
    names = list(prototypes)
    unit = np.array([v / np.linalg.norm(v) for v in prototypes.values()]).reshape(len(names), dimension)

    def score(columns: dict[str, list]) -> dict[str, object]:
        texts = [t or "" for t in columns["text"]]
        langs, scores = ["und"] * len(texts), [0.0] * len(texts)
        for part in few(texts) if names else ():
            best, cosine = best_of(texts[part], unit, dimension, seed)
            for i in np.flatnonzero(best >= 0).tolist():
                langs[part.start + i], scores[part.start + i] = names[best[i]], float(cosine[i])
        return {**{k: columns[k] for k in ("id", *keep)}, "lang_pred": langs, "score": scores}

    kinds = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keep)
    id_type = docs.schema[id_col].dataType.simpleString()
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *keep)
    found = map_batches(source, score, f"id {id_type}, {kinds + ', ' if kinds else ''}lang_pred string, score double")
    return found.withColumnRenamed("id", id_col)


def keep_known(
    docs: DataFrame, prototypes: dict[str, np.ndarray], text_col: str = "text", dimension: int = DIMENSION, seed: int = SEED,
) -> DataFrame:
    """The rows whose text ``predict`` gives a language, however low its score; columns and texts as they are."""
    names = list(prototypes)
    unit = np.array([v / np.linalg.norm(v) for v in prototypes.values()]).reshape(len(names), dimension)

    def known(texts: list[str | None]) -> list[bool]:
        kept = np.zeros(len(texts), dtype=bool)
        texts = [t or "" for t in texts]
        for part in few(texts) if names else ():
            best, _ = best_of(texts[part], unit, dimension, seed)
            kept[part] = best >= 0
        return kept.tolist()

    return docs.where(of_texts(known, "boolean", lambda: space(dimension, seed).clear())(F.col(text_col)))
