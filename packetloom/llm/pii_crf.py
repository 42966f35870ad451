"""Personal data with a skip-chain conditional random field on top of fixed patterns.

The patterns find e-mail addresses, IP addresses, payment cards and phone
numbers; their spans stay. The field labels the other tokens. Nodes are the
tokens that hold a digit, ``@`` or ``+``, and those inside a pattern's span,
whose label is given; every other token can only be "other" and enters as a
constant. Three kinds of potentials score a labelling: token shape and label;
labels of neighbouring tokens; and, along the skip chain, agreement of a
token with the previous and next similar token of the document and with the
first similar one that a pattern found (similar: equal token, equal last ten
digits, or equal part before ``@``; at least five characters, so short numbers
link nothing). A token repeated a thousand times has two thousand links, not
all pairs. Loopy belief propagation passes messages over
all links of a batch of documents at once; what a pattern found in one place
thus reaches the places where the pattern fails. Tokens with a marginal of at
least ``sure`` for one kind become spans, neighbours of one kind joined.

Weights are fitted to the labels that the patterns give (pseudo-likelihood,
with the neighbours' labels known), from counts of
(shape, neighbour labels, agreeing links, label) over all documents, without
the tokens that no pattern found but a link ties to a found one. These
counts have a bound that does not depend on the data, and only they reach the
driver. The fit sees a token's shape, not whether a pattern matched it.

Places are code points, ends exclusive. Null and empty texts have no spans.
Repeated rows each give a row; an empty table none, and with nothing to learn
from only the patterns count.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetloom.llm.common import arrow_schema, batch_of, map_batches, of_texts, slices, small

KINDS = ("email", "ip", "card", "phone")
OTHER = len(KINDS)
LABELS = OTHER + 1
SURE = 0.9
ROUNDS = 12
MOST_LINKS = 2  # agreeing links counted per label in training
AGREE = 8.0  # where the agreement weight starts: tokens that share ten digits or a name are nearly always of one kind

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_MARKED = re.compile(r"[0-9@+]")
_TOKEN = re.compile(r"\S+")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from each @ backwards, so that long runs without one cost nothing."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > free and text[begin - 1] in _LOCAL_CHARS:
            begin -= 1
        domain = _DOMAIN.match(text, at + 1) if begin < at else None
        free = domain.end() if domain else at + 1
        if domain:
            out.append((begin, free))
        at = text.find("@", free)
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all pattern matches, in order."""
    out = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    if _MARKED.search(text):
        for m in _IP.finditer(text):
            if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in m.group().split(".")):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = _NOT_DIGIT.sub("", m.group())
                if 14 <= len(digits) <= 19 and luhn(digits):
                    out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def shape(token: str) -> tuple[int, ...]:
    """A few small numbers: digits, letters, @, dots, hyphens, brackets, plus, length, each with a small bound."""
    digits = len(_NOT_DIGIT.sub("", token))
    return (
        sum(digits >= b for b in (1, 3, 4, 7, 10, 14, 16, 20)), int(any(c.isalpha() for c in token)), min(token.count("@"), 2),
        min(token.count("."), 4), min(token.count("-"), 3), int("(" in token or ")" in token), int("+" in token),
        sum(len(token) >= b for b in (4, 8, 12, 17, 25)),
    )


SIZES = (9, 2, 3, 5, 4, 2, 2, 6)
STARTS = np.concatenate([[0], np.cumsum(SIZES)])
SHAPES = int(STARTS[-1])


class Graph:
    """Nodes and links of a run of documents."""

    def __init__(self) -> None:
        self.shapes: list[tuple[int, ...]] = []
        self.given: list[int] = []  # label, or -1
        self.where: list[tuple[int, int, int, int]] = []  # document, token number, start, end
        self.chain: list[tuple[int, int]] = []
        self.skip: list[tuple[int, int]] = []

    def add(self, doc: int, text: str, spans: list[tuple[int, int, int]]) -> None:
        alike: dict[str, list[int]] = {}
        number_of_last, k = -2, 0
        for number, m in enumerate(_TOKEN.finditer(text)):
            start, end = m.span()
            while k < len(spans) and spans[k][2] <= start:
                k += 1
            inside = next((s for s in spans[k : k + 4] if s[0] < end and s[2] > start), None)
            if inside is None and not _MARKED.search(m.group()):
                continue
            word = m.group().strip("\"'").rstrip(".,;:!?")
            node = len(self.given)
            # spans of different kinds may overlap: the first one names the token
            self.given.append(-1 if inside is None else inside[1])
            self.shapes.append(shape(word))
            begin = start + m.group().find(word)
            self.where.append((doc, number, begin, begin + len(word)))
            if number_of_last == number - 1:
                self.chain.append((node - 1, node))
            number_of_last = number
            for key in keys(word, text[inside[0] : inside[2]] if inside and inside[2] <= end else ""):
                alike.setdefault(key, []).append(node)
        for nodes in alike.values():
            self.skip += zip(nodes, nodes[1:])
            found = next((i for i in nodes if self.given[i] >= 0), None)
            if found is not None:
                self.skip += [(min(i, found), max(i, found)) for i in nodes if self.given[i] < 0]

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        chain = np.array(self.chain, dtype=np.int64).reshape(-1, 2)
        skip = np.unique(np.array(self.skip, dtype=np.int64).reshape(-1, 2), axis=0)
        shapes = np.array(self.shapes, dtype=np.int64).reshape(-1, len(SIZES)) + STARTS[:-1]
        return shapes, np.array(self.given, dtype=np.int64), chain, skip


def keys(word: str, span: str) -> set[str]:
    """What makes two tokens similar; ``span`` is the pattern match that ends in the token."""
    found = {"w" + word.lower()} if len(word) >= 5 else set()
    digits = _NOT_DIGIT.sub("", span) or _NOT_DIGIT.sub("", word)
    if len(digits) >= 10:
        found.add("d" + digits[-10:])
    local = word.partition("@")[0]
    if len(local) >= 5:
        found.add("l" + local.lower())
    return found


class Field:
    """Weights: shape by label, left label by right label, agreement."""

    def __init__(self, unary: np.ndarray, pair: np.ndarray, agree: float):
        self.unary, self.pair, self.agree = unary, pair, agree


def patterns_in(graph: Graph) -> Counter:
    """How often each (shape, left, right, agreeing links per label, label) occurs."""
    shapes, given, chain, skip = graph.arrays()
    n = len(given)
    label = np.where(given < 0, OTHER, given)
    left, right = np.full(n, OTHER), np.full(n, OTHER)
    right[chain[:, 0]], left[chain[:, 1]] = label[chain[:, 1]], label[chain[:, 0]]
    # a token that no pattern found but a link ties to a found one may be what the pattern missed: it teaches nothing
    open_ends = np.concatenate([skip, skip[:, ::-1]])
    unsure = np.zeros(n, dtype=bool)
    unsure[open_ends[(given[open_ends[:, 0]] < 0) & (given[open_ends[:, 1]] >= 0), 0]] = True
    skip = skip[~unsure[skip].any(axis=1)]
    links = np.zeros((n, LABELS), dtype=np.int64)
    np.add.at(links, (skip[:, 0], label[skip[:, 1]]), 1)
    np.add.at(links, (skip[:, 1], label[skip[:, 0]]), 1)
    rows = np.column_stack([shapes, left, right, np.minimum(links, MOST_LINKS), label])[~unsure]
    return Counter(map(tuple, rows.tolist()))


def fit(rows: np.ndarray, counts: np.ndarray, steps: int = 400, rate: float = 0.05, penalty: float = 1e-3) -> Field:
    """Pseudo-likelihood by Adam."""
    width = len(SIZES)
    shapes, left, right, links, label = rows[:, :width], rows[:, width], rows[:, width + 1], rows[:, width + 2 : -1], rows[:, -1]
    weight = counts / counts.sum()
    table = np.zeros((len(rows), SHAPES))
    np.put_along_axis(table, shapes, 1.0, axis=1)
    to_left, to_right, truth = np.eye(LABELS)[left], np.eye(LABELS)[right], np.eye(LABELS)[label]
    theta = np.zeros(SHAPES * LABELS + LABELS * LABELS + 1)
    theta[-1] = AGREE
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    cut = SHAPES * LABELS
    for step in range(1, steps + 1):
        unary, pair, agree = theta[:cut].reshape(SHAPES, LABELS), theta[cut:-1].reshape(LABELS, LABELS), theta[-1]
        z = table @ unary + pair[left] + pair.T[right] + agree * links
        z -= z.max(axis=1, keepdims=True)
        p = np.exp(z)
        p /= p.sum(axis=1, keepdims=True)
        error = (p - truth) * weight[:, None]
        g = np.concatenate([
            (table.T @ error).ravel(), (to_left.T @ error + error.T @ to_right).ravel(), [(error * links).sum()]])
        g[:-1] += 2 * penalty * theta[:-1] / len(theta)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta = theta - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Field(theta[:cut].reshape(SHAPES, LABELS), theta[cut:-1].reshape(LABELS, LABELS), max(0.0, float(theta[-1])))


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def marginals(graph: Graph, field: Field, rounds: int = ROUNDS) -> np.ndarray:
    """Label probabilities of every node after ``rounds`` of loopy sum-product messages."""
    shapes, given, chain, skip = graph.arrays()
    n = len(given)
    own = field.unary[shapes].sum(axis=1)
    has_left, has_right = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
    has_left[chain[:, 1]] = has_right[chain[:, 0]] = True
    own += np.where(has_left[:, None], 0.0, field.pair[OTHER]) + np.where(has_right[:, None], 0.0, field.pair[:, OTHER])
    fixed = np.flatnonzero(given >= 0)
    own[fixed] = -60.0
    own[fixed, given[fixed]] = 0.0
    agree = field.agree * np.eye(LABELS)
    source = np.concatenate([chain[:, 0], chain[:, 1], skip[:, 0], skip[:, 1]])
    target = np.concatenate([chain[:, 1], chain[:, 0], skip[:, 1], skip[:, 0]])
    c, s = len(chain), len(skip)
    back = np.concatenate([np.arange(c) + c, np.arange(c), 2 * c + s + np.arange(s), 2 * c + np.arange(s)])
    potential = np.concatenate([
        np.broadcast_to(p, (k, LABELS, LABELS)) for p, k in ((field.pair, c), (field.pair.T, c), (agree, s), (agree, s))])
    message = np.zeros((len(source), LABELS))
    belief = own.copy()
    for _ in range(rounds if len(source) else 0):
        new = log_sum((belief[source] - message[back])[:, :, None] + potential, axis=1)
        new -= new.max(axis=1, keepdims=True)
        message = 0.5 * message + 0.5 * new
        belief = own.copy()
        np.add.at(belief, target, message)
    belief = np.exp(belief - belief.max(axis=1, keepdims=True))
    return belief / belief.sum(axis=1, keepdims=True)


def added_spans(graph: Graph, field: Field, docs: int, sure: float) -> list[list[tuple[int, int, int]]]:
    """(start, kind, end) of the tokens that no pattern found and the field is sure of."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(docs)]
    open_nodes = [i for i, g in enumerate(graph.given) if g < 0]
    if not open_nodes:
        return out
    chance = marginals(graph, field)
    last = (-1, -2, -1)
    for i in open_nodes:
        kind = int(chance[i, :OTHER].argmax())
        if chance[i, kind] >= sure:
            doc, number, begin, end = graph.where[i]
            if last == (doc, number - 1, kind):
                out[doc][-1] = (out[doc][-1][0], kind, end)
            elif end > begin:
                out[doc].append((begin, kind, end))
            last = (doc, number, kind)
    return out


def graphs(texts: list[str]) -> Iterator[tuple[slice, list[list[tuple[int, int, int]]], Graph]]:
    for part in slices(texts, 1 << 20):
        graph, spans = Graph(), [base_spans(t) for t in texts[part]]
        for doc, (text, found) in enumerate(zip(texts[part], spans)):
            if _MARKED.search(text):
                graph.add(doc, text, found)
        yield part, spans, graph


def learn(docs: DataFrame, text_col: str = "text") -> Field | None:
    """The field fitted to all documents; None if the patterns find nothing."""
    names = [f"f{i}" for i in range(len(SIZES) + 2 + LABELS + 1)]
    schema = ", ".join(f"{x} int" for x in names) + ", n long"
    types = arrow_schema(docs.sparkSession, schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in small(batches):
            for _, _, graph in graphs(batch.to_pydict()["text"]):
                if graph.given:
                    total += patterns_in(graph)
        if total:
            columns = list(zip(*total.keys()))
            yield batch_of({**dict(zip(names, columns)), "n": list(total.values())}, types)

    found = docs.where(F.col(text_col).rlike("[0-9@+]")).select(F.col(text_col).alias("text")).mapInArrow(count, schema)
    summed = found.groupBy(*names).agg(F.sum("n").alias("n")).orderBy(*names).collect()
    rows = np.array([tuple(r) for r in summed], dtype=np.int64).reshape(-1, len(names) + 1)
    if not (rows[:, -2] != OTHER).any():
        return None
    return fit(rows[:, :-1], rows[:, -1].astype(float))


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def find(
    docs: DataFrame, field: Field | None, sure: float = SURE, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """doc id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added of every row."""
    counts = [f"n_{k}" for k in KINDS]

    def of_batch(batch: dict[str, list]) -> dict[str, object]:
        out = {k: [] for k in (*counts, "base_sha256", "spans", "n_added")}
        texts = [t or "" for t in batch["text"]]
        for part, base, graph in graphs(texts):
            added = added_spans(graph, field, len(base), sure) if field else [[]] * len(base)
            for found, more in zip(base, added):
                for k, name in enumerate(counts):
                    out[name].append(sum(s[1] == k for s in found))
                out["base_sha256"].append(hashlib.sha256(joined(found).encode()).hexdigest())
                out["spans"].append(joined(sorted(found + more)))
                out["n_added"].append(len(more))
        return {"id": batch["id"], **out}

    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"id {id_type}, {', '.join(f'{c} long' for c in counts)}, base_sha256 string, spans string, n_added long"
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return map_batches(source, of_batch, schema).withColumnRenamed("id", id_col)


def redacted(field: Field | None, text: F.Column, sure: float = SURE) -> F.Column:
    """The text with every span replaced by its kind in square brackets; overlapping spans become one."""

    def clean(texts: list[str | None]) -> list[str | None]:
        out: list[str | None] = list(texts)
        for part, base, graph in graphs([t or "" for t in texts]):
            added = added_spans(graph, field, len(base), sure) if field else [[]] * len(base)
            for i, (found, more) in enumerate(zip(base, added), start=part.start):
                text, pieces, last = texts[i], [], 0
                for start, kind, end in sorted(found + more):
                    if start >= last:
                        pieces += [text[last:start], f"[{KINDS[kind].upper()}]"]
                    last = max(last, end)
                if pieces:
                    out[i] = "".join([*pieces, text[last:]])
        return out

    return of_texts(clean, "string")(text)


def redact(docs: DataFrame, field: Field | None, sure: float = SURE, text_col: str = "text") -> DataFrame:
    """The same rows with redacted texts."""
    return docs.withColumn(text_col, redacted(field, F.col(text_col), sure))
