"""Benchmark decontamination with an FM-index per training shard.

Words are runs of ASCII letters and digits and all characters beyond ASCII,
A-Z lower-cased. Every task gathers documents into shards of about
``shard_words`` words, concatenates their whole word sequences with a
separator after each document, sorts all suffixes, and keeps the Burrows-
Wheeler transform as a wavelet matrix with rank tables and every 16th suffix
position. All windows of the benchmark are searched backwards at once: a
window's row range shrinks word by word through wavelet ranks. The rows of
windows that occur are located by walking to the next sampled position, and
the word spans they cover are merged per document.

The alphabet is the benchmark's words plus one symbol for every other word,
which no window contains. Copies of a text inside a shard are indexed once. The
benchmark goes to the tasks in blocks of ``block_bytes`` (one item at least),
so what is broadcast has a bound; with several blocks the spans are merged
afterwards by a shuffle of the few documents that were hit.

Null texts and texts without a word: no words, no hits. Items without a word
match nothing; items of fewer than ``window`` words are one window. Repeated
rows each give a row. Empty tables on either side are fine.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import ceil
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetloom.llm.common import alone, arrow_schema, batch_of, of_texts, slices, small, store, without

WINDOW = 13
SHARD_WORDS = 1_000_000
SHARD_ROWS, SHARD_BYTES = 20_000, 32 << 20  # of the rows that wait for their shard, copies and kept columns included
SAMPLE = 16
BLOCK_BYTES = 16 << 20

_WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")
SEPARATOR, OTHER = 0, 1


def words_of(text: str | None) -> list[bytes]:
    return _WORDS.findall(text.encode().lower()) if text else []


class Windows:
    """The distinct windows of a block of benchmark items, as one sorted array."""

    def __init__(self, items: list[tuple[object, str | None]], window: int):
        self.symbols: dict[bytes, int] = {}
        self.names = [str(item) for item, _ in items]
        parts, sizes = [], []
        for _, text in items:
            ids = np.array([self.symbols.setdefault(w, len(self.symbols) + 2) for w in words_of(text)], dtype=np.uint32)
            many = max(1, len(ids) - window + 1) if len(ids) else 0
            part = np.zeros((many, window), dtype=np.uint32)  # right-aligned; 0 is no word
            for j in range(min(window, len(ids))):
                part[:, window - min(window, len(ids)) + j] = ids[j : j + many]
            parts.append(part)
            sizes.append(many)
        every = np.concatenate(parts) if parts else np.zeros((0, window), dtype=np.uint32)
        of = np.repeat(np.arange(len(items)), sizes)
        order = np.lexsort(every.T[::-1])
        every, of = every[order], of[order]
        first = np.ones(len(every), dtype=bool)
        first[1:] = (every[1:] != every[:-1]).any(axis=1)
        self.table = every[first]
        self.lengths = (self.table != 0).sum(axis=1)
        self.starts, self.of = np.append(np.flatnonzero(first), len(every)), of

    def items_of(self, numbers: set[int]) -> list[str]:
        """Names of the items that hold one of the windows, sorted."""
        return sorted({self.names[i] for k in numbers for i in self.of[self.starts[k] : self.starts[k + 1]].tolist()})


_windows: dict[tuple[object, int], Windows] = {}


def windows_of(name: object, items: list[tuple[object, str | None]], window: int) -> Windows:
    """The windows of a block, made once per worker; only the last block's are kept."""
    alone("windows", _windows.clear)
    key = (name, window)
    if key not in _windows:
        _windows.clear()
        _windows[key] = Windows(items, window)
    return _windows[key]


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Start places of all suffixes in order. Separators differ from each other, by place; the last symbol is one."""
    n, seps = len(text), np.flatnonzero(text == SEPARATOR)
    rank = text + (len(seps) - 1)
    rank[seps] = np.arange(len(seps))
    bits = int(rank.max()).bit_length() or 1
    reach = max(1, 63 // bits)
    padded = np.concatenate([rank, np.zeros(reach, dtype=np.int64)])
    key = np.zeros(n, dtype=np.int64)
    for j in range(reach):
        key = (key << bits) | padded[j : j + n]
    order = np.argsort(key)
    place, key = np.arange(n), key[order]  # place: of the rows not yet apart, in ``order``
    some = order
    while True:
        first = np.concatenate([[True], key[1:] != key[:-1]])
        starts = place[np.flatnonzero(first)]
        rank[some] = starts[np.cumsum(first) - 1]
        single = first & np.concatenate([first[1:], [True]])
        place, some = place[~single], some[~single]
        if not len(place):
            return order
        # suffixes tied on ``reach`` symbols hold no separator there, so the symbol after exists
        key = (rank[some] << 31) | rank[some + reach]
        sort = np.argsort(key)
        key, some = key[sort], some[sort]
        order[place] = some
        reach *= 2


class Index:
    """FM-index of one shard."""

    def __init__(self, text: np.ndarray, symbols: int):
        order = suffix_order(text)
        n = len(text)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])
        current = text[order - 1].astype(np.uint32 if symbols > 1 << 16 else np.uint16)
        self.levels = []
        for level in reversed(range(max(1, (symbols - 1).bit_length()))):
            bit = ((current >> level) & 1).astype(bool)
            ones = np.zeros(n + 1, dtype=np.int32)
            np.cumsum(bit, out=ones[1:])
            self.levels.append((level, ones, n - int(ones[n])))
            current = np.concatenate([current[~bit], current[bit]])
        # a sample at every document's first word: no walk crosses a separator
        sampled = (order % SAMPLE == 0) | (text[order - 1] == SEPARATOR)
        self.sampled = sampled
        self.sample_rank = np.cumsum(sampled) - 1
        self.samples = order[sampled]

    def walk(self, symbols: np.ndarray, rows: np.ndarray) -> np.ndarray:
        for level, ones, zeros in self.levels:
            r = ones[rows]
            rows = np.where((symbols >> level) & 1, zeros + r, rows - r)
        return rows

    def search(self, windows: Windows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of the windows that occur, with first and last + 1 row of each."""
        width, n = windows.table.shape[1], len(self.sampled)
        alive = np.arange(len(windows.lengths))
        lo, hi = np.zeros(len(alive), dtype=np.int64), np.full(len(alive), n, dtype=np.int64)
        done = []
        for step in range(width):
            ended = windows.lengths[alive] == step
            if ended.any():
                done.append((alive[ended], lo[ended], hi[ended]))
                alive, lo, hi = alive[~ended], lo[~ended], hi[~ended]
            if not len(alive):
                break
            symbol = windows.table[alive, width - 1 - step].astype(np.int64)
            zero = self.walk(symbol, np.zeros(len(alive), dtype=np.int64))
            start = self.before[symbol] - zero
            lo, hi = start + self.walk(symbol, lo), start + self.walk(symbol, hi)
            found = lo < hi
            alive, lo, hi = alive[found], lo[found], hi[found]
        done.append((alive, lo, hi))
        return tuple(np.concatenate(x) for x in zip(*done))

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text place of every row: steps back to the nearest sample, plus their number."""
        out, todo, steps = np.empty(len(rows), dtype=np.int64), np.arange(len(rows)), 0
        while len(todo):
            at = rows[todo]
            here = self.sampled[at]
            out[todo[here]] = self.samples[self.sample_rank[at[here]]] + steps
            todo, at = todo[~here], at[~here]
            end, begin, symbol = at, np.zeros(len(at), dtype=np.int64), np.zeros(len(at), dtype=np.int64)
            for level, ones, zeros in self.levels:
                r = ones[end]
                bit = ones[end + 1] - r
                end = np.where(bit, zeros + r, end - r)
                r = ones[begin]
                begin = np.where(bit, zeros + r, begin - r)
                symbol |= bit.astype(np.int64) << level
            rows[todo] = self.before[symbol] + end - begin
            steps += 1
        return out


def search_shard(texts: list[np.ndarray], windows: Windows) -> list[tuple[list[tuple[int, int]], list[str]]]:
    """Merged word spans and items of every text of a shard."""
    found = [([], []) for _ in texts]
    full = [i for i, t in enumerate(texts) if len(t)]
    if not full or not len(windows.lengths):
        return found
    starts = np.cumsum([0] + [len(texts[i]) + 1 for i in full])
    text = np.zeros(starts[-1], dtype=np.int64)
    for at, i in zip(starts, full):
        text[at : at + len(texts[i])] = texts[i]
    index = Index(text, len(windows.symbols) + 2)
    which, lo, hi = index.search(windows)
    if not len(which):
        return found
    counts = hi - lo
    rows = np.arange(counts.sum()) + np.repeat(lo - np.cumsum(counts) + counts, counts)
    places, numbers = index.locate(rows), np.repeat(which, counts)
    order = np.argsort(places)
    places, numbers = places[order], numbers[order]
    doc = np.searchsorted(starts, places, side="right") - 1
    ends = places + windows.lengths[numbers]
    for d, begin, end, number in zip(doc.tolist(), (places - starts[doc]).tolist(), (ends - starts[doc]).tolist(), numbers.tolist()):
        spans, items = found[full[d]]
        items.append(number)
        if spans and begin <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(spans[-1][1], end))
        else:
            spans.append((begin, end))
    return [(spans, windows.items_of(set(items))) for spans, items in found]


def hits(
    docs: DataFrame, items: list[tuple[object, str | None]], window: int = WINDOW, shard_words: int = SHARD_WORDS,
    id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (),
) -> DataFrame:
    """id, ``keep`` columns, n_words, spans and items of every row, for one block of the benchmark."""
    kinds = "".join(f", `{k}` {docs.schema[k].dataType.simpleString()}" for k in keep)
    schema = (f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}{kinds}, n_words long, "
              "spans array<struct<begin: long, `end`: long>>, items array<string>")
    types = arrow_schema(docs.sparkSession, schema)
    spread, name = docs.sparkSession.sparkContext.broadcast(items), uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = windows_of(name, spread.value, window)
        get = windows.symbols.get
        rows, texts, number, size, held_bytes = [], [], {}, 0, 0

        def flush() -> pa.RecordBatch:
            found = search_shard(texts, windows)
            columns = {name: [r[i] for r, _ in rows] for i, name in enumerate((id_col, *keep))}
            columns["n_words"] = [len(texts[k]) for _, k in rows]
            columns["spans"] = [[{"begin": a, "end": b} for a, b in found[k][0]] for _, k in rows]
            columns["items"] = [found[k][1] for _, k in rows]
            return batch_of(columns, types)

        for batch in small(batches):
            columns = batch.to_pydict()
            held = [columns[k] for k in (id_col, *keep)]
            for i, text in enumerate(columns[text_col]):
                k = number.get(text)
                if k is None:
                    words = words_of(text)
                    k = number[text] = len(texts)
                    texts.append(np.fromiter([get(w, OTHER) for w in words], dtype=np.int64, count=len(words)))
                    size += len(words)
                rows.append((tuple(h[i] for h in held), k))
                held_bytes += sum(len(v) for v in rows[-1][0] if isinstance(v, (str, bytes)))
                if size >= shard_words or len(rows) >= SHARD_ROWS or held_bytes >= SHARD_BYTES:
                    yield flush()
                    rows, texts, number, size, held_bytes = [], [], {}, 0, 0
        if rows:
            yield flush()

    return docs.select(id_col, text_col, *[k for k in keep if k not in (id_col, text_col)]).mapInArrow(run, schema)


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS,
    block_bytes: int = BLOCK_BYTES, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", keep: tuple[str, ...] = (),
) -> DataFrame:
    """id, ``keep`` columns, n_words, spans (of words, merged), items, n_hit, contaminated."""
    size = benchmark.agg(F.sum(F.octet_length(item_text_col)).alias("n")).first().n or 0
    blocks = max(1, ceil(size / block_bytes))
    block = F.pmod(F.xxhash64(item_col), F.lit(blocks))

    def items_of(b: int) -> list[tuple[object, str | None]]:
        return [(r[0], r[1]) for r in benchmark.where(block == b).select(item_col, item_text_col).collect()]

    if blocks == 1:
        found = hits(docs, items_of(0), window, shard_words, id_col, text_col, keep)
    else:
        docs = store(docs.select(id_col, *{text_col, *keep} - {id_col}).withColumn("_row", F.monotonically_increasing_id()), "numbered")
        found = hits(docs, items_of(0), window, shard_words, id_col, text_col, (*keep, "_row"))
        more = None
        for b in range(1, blocks):
            part = hits(docs, items_of(b), window, shard_words, id_col, text_col, ("_row",)).where(F.size("items") > 0)
            part = part.select("_row", "spans", "items")
            more = part if more is None else more.union(part)
        # spans of a document: at most its number of words for each block
        more = more.groupBy("_row").agg(F.flatten(F.collect_list("spans")).alias("s"), F.flatten(F.collect_list("items")).alias("i"))
        found = found.join(more, "_row", "left").withColumn(
            "spans", merged(F.array_sort(F.concat("spans", F.coalesce("s", F.expr("CAST(array() AS array<struct<begin: long, end: long>>)")))))
        ).withColumn("items", F.array_sort(F.array_distinct(F.concat("items", F.coalesce("i", F.expr("CAST(array() AS array<string>)")))))
        ).drop("_row", "s", "i")
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["begin"])
    return found.withColumn("n_hit", n_hit).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
          shard_words: int = SHARD_WORDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows that are not contaminated, with all their columns, whatever these are called.

    With one block of benchmark only texts go to Python. With several the rows are numbered and stored, as spans of a
    row come from several searches.
    """
    size = benchmark.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    if size > block_bytes:
        numbered = store(docs.select(F.monotonically_increasing_id().alias("n"), F.struct("*").alias("row")), "numbered")
        found = decontaminate(numbered.select(F.col("n").alias(id_col), F.col("row")[text_col].alias(text_col)), benchmark,
                              window, shard_words, block_bytes, id_col, text_col)
        return without(numbered, found.where("contaminated").select(F.col(id_col).alias("n")), "n").select("row.*")
    items = [(r.item_id, r.text) for r in benchmark.select("item_id", "text").collect()]
    spread, name = docs.sparkSession.sparkContext.broadcast(items), uuid4().hex

    def fine(texts: list[str | None]) -> list[bool]:
        windows, out = windows_of(name, spread.value, window), []
        get = windows.symbols.get
        for part in slices([t or "" for t in texts], 6 * shard_words):
            number: dict[str | None, int] = {}
            shard = []
            for text in texts[part]:
                if text not in number:
                    number[text] = len(shard)
                    words = words_of(text)
                    shard.append(np.fromiter([get(w, OTHER) for w in words], dtype=np.int64, count=len(words)))
            hit = [sum(b - a for a, b in spans) for spans, _ in search_shard(shard, windows)]
            out += [not 0 < len(shard[k]) <= 20 * hit[k] for k in (number[text] for text in texts[part])]
        return out

    return docs.where(of_texts(fine, "boolean")(F.col(text_col)))


def merged(spans: F.Column) -> F.Column:
    """Sorted spans with overlapping and adjoining ones joined."""
    kind = "array<struct<begin: long, end: long>>"

    def add(done: F.Column, s: F.Column) -> F.Column:
        last = F.element_at(done, -1)
        joined = F.struct(last["begin"].alias("begin"), F.greatest(last["end"], s["end"]).alias("end"))
        return F.when(F.size(done) == 0, F.array(s)).when(
            s["begin"] <= last["end"], F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined))
        ).otherwise(F.concat(done, F.array(s)))

    return F.aggregate(spans, F.expr(f"CAST(array() AS {kind})"), add)


def digest(items: F.Column) -> F.Column:
    """SHA-256 of the item names, sorted as strings and comma-joined."""
    return F.sha2(F.array_join(F.array_sort(items), ",").cast("binary"), 256)


def remove_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the characters of the given word spans."""
    raw = text.encode()
    places = [m.span() for m in _WORDS.finditer(raw.lower())]
    out, last = [], 0
    for begin, end in spans:
        out.append(raw[last : places[begin][0]])
        last = places[end - 1][1]
    return b"".join([*out, raw[last:]]).decode()
