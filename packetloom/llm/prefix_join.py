"""Grouped prefix join on word shingles: Jaccard similarity of at least a threshold, exactly.

A document is the set of its distinct word n-grams, hashed to 64 bits. Equal
sets form one class; classes of equal size and equal prefix form one group, and
only groups enter the index. The prefix of a set of size n is its first
n - ceil(t n) + 1 elements in a global order; sets that are similar enough
share one. The order is by hash, with elements of frequent hash buckets last,
so lines and passages that many documents share stay out of nearly all
prefixes. Bucket counts cover all documents; their number is a parameter, and
they decide the order only, never the result.

Candidates are taken in rounds, because a large group of near copies has the
square of its size in pairs. First every group in a prefix element's list meets
one random member of that list, and every class the first of its group.
Verified pairs give components. Lists that still hold several of them are put
into ``TURNS`` random orders, in which neighbours meet: that joins what is left
of dense groups at a cost in proportion to the lists. Then all pairs of groups
that share a prefix element and still lie in different components are expanded
to member classes and verified. Pairs inside a component can add nothing, so no
link between components is lost. Lists of frequent elements are dealt into pieces, each with
its own random member; these meet one of their own.

In the last round lists of ``MANY`` rows or more make a pair at its first common
element only, as far as the first ``EARLY`` elements of both prefixes tell; a
later one can add nothing, for the positional filter is weakest at the first.
Long lists are cut into pieces by group, which meet the list in tasks of their own
(``list_pairs``).

Pairs pass a size filter, a positional filter, a bound from 2048-bit
signatures (bits that differ need an element that differs) and, where such a
signature would be full, the like bound from bucket counts, before their sets
are made again from the texts and intersected. Only sets of such classes are
shuffled.

Null texts and texts without a word have an empty set and no link. A text of
fewer than ``words`` words is one element. Rows without id take part and give a
row; a component's name is its smallest id. Repeated rows are copies.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from packetloom.llm.common import alone, arrow_schema, batch_of, few_keys, map_batches, release, small, store
from packetloom.llm.components import components
from packetloom.llm.list_pairs import Columns, bits_between, pairs_in_lists

WORDS, PERCENT = 5, 80
BUCKETS = 1 << 17
BITS = 2048
LARGE, COUNTS = 1_000, 1_024
LIST_PIECES = 64
TURNS = 1
EARLY, MANY = 16, 16
FIRST = 8  # longs of a signature that a pair's bound is tried on before all
PIECE = 1_000
_MIX = [np.uint64(m) for m in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)]

_SPACES = b" \t\n\v\f\r"
_SPACE = bytes(c in _SPACES for c in range(256))
_OF_BYTE = np.random.default_rng(9).integers(0, 1 << 64, 256, dtype=np.uint64)
_OF_BYTE[ord("A") : ord("Z") + 1] = _OF_BYTE[ord("a") : ord("z") + 1]
_STEP = 0xD6E8FEB86659FD93
_POWERS = 1 << 12


def _powers(step: int, count: int) -> np.ndarray:
    """step^0, step^1, ... modulo 2^64."""
    out = np.full(count, step, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


_up, _down = (_powers(step, _POWERS) for step in (_STEP, pow(_STEP, -1, 1 << 64)))


def word_hashes(text: str) -> np.ndarray:
    """A hash of every word, without making the words: a polynomial of its bytes' random numbers modulo 2^64.

    Words lie between ASCII white space; ASCII letters count as small ones. Prefix sums over the whole text give every
    word's sum, times a power for its place.
    """
    global _up, _down
    text = f" {text} ".encode()
    raw = np.frombuffer(text, dtype=np.uint8).astype(np.intp)
    space = np.frombuffer(text.translate(_SPACE), dtype=bool)
    edges = np.flatnonzero(space[1:] != space[:-1])
    if len(raw) > len(_up):
        up, down = (_powers(step, len(raw)) for step in (_STEP, pow(_STEP, -1, 1 << 64)))
        if len(raw) <= 1 << 18:  # kept for other texts: 4 MB at most
            _up, _down = up, down
    else:
        up, down = _up, _down
    sums = _OF_BYTE.take(raw)
    sums *= up[: len(raw)]
    sums = np.cumsum(sums).take(edges)
    found = (sums[1::2] - sums[::2]) * down.take(edges[::2])
    found ^= found >> np.uint64(32)
    return found


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the text's word n-grams; of all its words if they are fewer."""
    alone("words", list)
    one = word_hashes(text) if text else ()
    if not len(one):
        return np.empty(0, dtype=np.uint64)
    size = min(words, len(one))
    many = len(one) - size + 1
    mixed = np.full(many, size, dtype=np.uint64)
    for j in range(size):
        mixed = (mixed ^ one[j : j + many]) * _MIX[j % len(_MIX)]
        mixed ^= mixed >> np.uint64(29)
    mixed.sort()
    return mixed[np.concatenate([[True], mixed[1:] != mixed[:-1]])]


def bucket_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(20)).astype(np.int64) & (BUCKETS - 1)


def counted(found: np.ndarray) -> bytes:
    """Elements in each of COUNTS buckets, one byte each, larger numbers as 255."""
    at = ((found >> np.uint64(40)) & np.uint64(COUNTS - 1)).astype(np.int64)
    return np.minimum(np.bincount(at, minlength=COUNTS), 255).astype(np.uint8).tobytes()


def frequent_buckets(docs: DataFrame, text_col: str, words: int) -> np.ndarray:
    """Flags of the hash buckets with clearly more elements than the mean bucket."""
    schema = "chunk int, counts array<long>"
    types = arrow_schema(docs.sparkSession, schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(BUCKETS, dtype=np.int64)
        for batch in small(batches):
            held = []
            for text in batch.to_pydict()["text"]:
                held.append(bucket_of(shingles(text, words)))
                if len(held) == 200:
                    sums += np.bincount(np.concatenate(held), minlength=BUCKETS)
                    held = []
            if held:
                sums += np.bincount(np.concatenate(held), minlength=BUCKETS)
        if sums.any():
            yield batch_of({"chunk": list(range(BUCKETS // 1024)), "counts": list(sums.reshape(-1, 1024))}, types)

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, counts in zip(batch.column(0).to_pylist(), batch.column(1).flatten().to_numpy().reshape(-1, 1024)):
                sums[chunk] = sums.get(chunk, 0) + counts
        if sums:
            yield batch_of({"chunk": list(sums), "counts": list(sums.values())}, types)

    parts = docs.select(F.col(text_col).alias("text")).mapInArrow(count, schema)
    counts = np.zeros((BUCKETS // 1024, 1024), dtype=np.int64)
    # at most BUCKETS numbers whatever the data; added up as arrays, a row per number and task would be many more
    for row in parts.repartition("chunk").mapInArrow(total, schema).collect():
        counts[row.chunk] = row.counts
    counts = counts.ravel()
    mean = counts.mean()
    return counts > mean + 8 * sqrt(mean) + 16


def make_sets(docs: DataFrame, frequent: np.ndarray, id_col: str, text_col: str, words: int, percent: int) -> DataFrame:
    """row, id, n, class key (s1, s2), prefix key (p1, p2), light, prefix, bits and (of large sets) counts of every row."""
    id_type = docs.schema[id_col].dataType.simpleString()
    columns = (f"row long, id {id_type}, n int, s1 long, s2 long, p1 long, p2 long, light int, prefix array<long>, "
               f"bits array<long>, counts binary")
    spread = docs.sparkSession.sparkContext.broadcast(np.packbits(frequent))

    def two(data: np.ndarray) -> tuple[int, int]:
        return tuple(int(x) for x in np.frombuffer(xxhash.xxh3_128_digest(data.tobytes()), dtype="<i8"))

    def of_batch(batch: dict[str, list]) -> dict[str, object]:
        heavy_bucket = np.unpackbits(spread.value).astype(bool)
        out = {k: [] for k in ("n", "s1", "s2", "p1", "p2", "light", "prefix", "bits", "counts")}
        for text in batch["text"]:
            found = shingles(text, words)
            n = len(found)
            heavy = heavy_bucket[bucket_of(found)]
            light = found[~heavy]
            size = n + (-percent * n // 100) + 1 if n else 0
            prefix = np.concatenate([light, found[heavy]])[:size] if len(light) < size else light[:size]
            marked = np.zeros(BITS, dtype=bool)
            marked[(found & np.uint64(BITS - 1)).astype(np.int64)] = True
            s1, s2 = two(found)
            p1, p2 = two(prefix)
            for k, v in (("n", n), ("s1", s1), ("s2", s2), ("p1", p1), ("p2", p2), ("light", min(len(light), size)),
                         ("prefix", prefix.view(np.int64)), ("bits", np.packbits(marked).view(np.int64)),
                         ("counts", counted(found) if n > LARGE else None)):
                out[k].append(v)
        return {"row": batch["row"], "id": batch["id"], **out}

    source = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return map_batches(source, of_batch, columns)


def near_enough(n1: str, n2: str, p1: str, p2: str, percent: int) -> F.Column:
    """Size filter and positional filter for two sets that share the element at these places."""
    small, large = F.least(n1, n2), F.greatest(n1, n2)
    most = F.least(F.col(n1) - F.col(p1), F.col(n2) - F.col(p2))
    return (100 * small >= percent * large) & ((100 + percent) * most >= percent * (F.col(n1) + F.col(n2)))


class Join:
    """The steps over one table of documents."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, words: int, percent: int):
        self.docs, self.id_col, self.text_col, self.words, self.percent = docs, id_col, text_col, words, percent
        self.spark = docs.sparkSession
        self.sets = store(
            make_sets(docs, frequent_buckets(docs, text_col, words), id_col, text_col, words, percent), "sets")
        same = ["n", "s1", "s2"]
        classes = self.sets.where("n > 0").groupBy(*same, "p1", "p2").agg(
            F.min("row").alias("c"), F.min("id").alias("least"))
        classes = store(classes, "classes")
        groups = classes.groupBy("n", "p1", "p2").agg(F.min("c").alias("g"), F.count("*").alias("members"))
        self.groups = store(groups, "groups")
        grouped = self.groups.where("members > 1").select("n", "p1", "p2", F.col("g").alias("_g"))
        # nearly all groups have one class; only the others need the join
        self.classes = store(
            classes.join(grouped, ["n", "p1", "p2"], "left").select(
                "c", "least", "n", "s1", "s2", F.coalesce("_g", "c").alias("g")), "classes")
        self.shared = self.index()
        release(self.spark)

    def index(self) -> DataFrame:
        """Rows (element, g, n, at, piece, again, partner) of all lists with two groups or more.

        ``again``: the first round does not meet all pairs of the list, as it has more than two groups, is one piece
        of several, or holds a group of several classes.
        """
        chosen = self.groups.select(F.col("g").alias("row"), "members")
        entries = self.sets.select("row", "n", "light", "prefix").join(chosen, "row").select(
            F.col("row").alias("g"), "n", "light", "members", F.posexplode("prefix").alias("at", "element"))
        entries = entries.select(
            "element", "g", "members", (F.shiftleft(F.col("n").cast("long"), 32) + F.col("at")).alias("place"),
            F.when(F.col("at") >= F.col("light"), F.pmod(F.xxhash64("g"), F.lit(LIST_PIECES))).otherwise(-1).cast("int").alias("piece"))
        lists = Window.partitionBy("element", "piece")
        entries = entries.select(
            "*", F.count("*").over(lists).alias("long"), F.max("members").over(lists).alias("most"),
            F.min(F.struct(F.xxhash64("element", "g").alias("order"), "g", "place")).over(lists).alias("partner"))
        entries = entries.where("long > 1 OR piece >= 0")
        return store(entries.select(
            "element", "g", "members", F.shiftright("place", 32).cast("int").alias("n"), F.col("place").bitwiseAND(2**31 - 1).cast("int").alias("at"), "piece",
            F.expr("long > 2 OR piece >= 0 OR most > 1").alias("again"), F.col("partner.g").alias("g2"), F.shiftright("partner.place", 32).cast("int").alias("n2"),
            F.col("partner.place").bitwiseAND(2**31 - 1).cast("int").alias("at2")), "shared")

    def first_pairs(self) -> DataFrame:
        """Each group with its list's random member, pieces of a list with each other, classes with their group's first."""
        near = near_enough("n", "n2", "at", "at2", self.percent)
        heads = self.shared.where("piece >= 0").groupBy("element", "piece").agg(F.min(F.struct("g2", "n2", "at2")).alias("h"))
        head = heads.groupBy("element").agg(F.min(F.struct(F.xxhash64("element", "h.g2").alias("order"), "h")).alias("m"))
        joined = heads.join(head, "element").select(
            F.col("h.g2").alias("g"), F.col("h.n2").alias("n"), F.col("h.at2").alias("at"),
            F.col("m.h.g2").alias("g2"), F.col("m.h.n2").alias("n2"), F.col("m.h.at2").alias("at2"))
        columns = ["g", "n", "at", "g2", "n2", "at2"]
        pairs = self.shared.select(columns).union(joined.select(columns)).where(near & (F.col("g") != F.col("g2")))
        inside = self.classes.where("c <> g").select(F.col("c").alias("a"), F.col("g").alias("b"))
        return ordered(pairs.select(F.col("g").alias("a"), F.col("g2").alias("b")).union(inside))

    def placed(self, roots: DataFrame) -> DataFrame:
        """(c, g, root) of every class."""
        return self.classes.join(roots.withColumnRenamed("node", "c"), "c", "left").select("c", "g", F.coalesce("root", "c").alias("root"))

    def split(self, of_group: DataFrame) -> DataFrame:
        """The rows of lists that hold several components, by group and component, with the list's number of rows and pieces."""
        rows = self.shared.where("again").select("element", "g", "n", "at", "members").join(of_group, "g")
        lists = rows.groupBy("element").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("long")).where("lo < hi")
        return rows.join(lists.select("element", "long"), "element").withColumn("pieces", F.ceil(F.col("long") / PIECE).cast("int"))

    def more_pairs(self, roots: DataFrame, seen: DataFrame, turn: int) -> DataFrame:
        """Neighbours in a random order of the lists, where they are of different components.

        Of a group's classes in one component the first stands for the others. Long lists are ordered in pieces that the order deals.
        """
        rows = self.split(self.placed(roots).groupBy("g", "root").agg(F.min("c").alias("c")))
        order = F.xxhash64("element", "c", F.lit(turn))
        rows = rows.select("element", "c", "n", "at", "root", order.alias("order"), F.pmod(order, F.col("pieces")).alias("piece"))
        following = F.lead(F.struct("c", "n", "at", "root")).over(Window.partitionBy("element", "piece").orderBy("order", "c"))
        pairs = rows.withColumn("next", following).select(
            "n", "at", "root", F.col("c").alias("a"), F.col("next.c").alias("b"), F.col("next.n").alias("n2"),
            F.col("next.at").alias("at2"), F.col("next.root").alias("root2"))
        pairs = pairs.where((F.col("root") != F.col("root2")) & near_enough("n", "n2", "at", "at2", self.percent))
        return ordered(pairs.select("a", "b")).join(seen, ["a", "b"], "left_anti")

    def marked(self, of_group: DataFrame) -> DataFrame:
        """The rows of ``split`` with the group's bits and, in long lists, the elements before the shared one of its first EARLY."""
        marks = self.sets.select(F.col("row").alias("g"), "bits", F.slice("prefix", 1, EARLY).alias("early"))
        # the signature is the first class's: it says nothing of a group's other classes
        bits = F.when(F.col("members") == 1, F.col("bits"))
        early = F.expr(f"slice(early, 1, if(long >= {MANY}, at, 0))")
        return self.split(of_group).join(marks, "g").withColumns({"bits": bits, "early": early})

    def met(self, rows: DataFrame) -> DataFrame:
        """(g, root, g2, root2) of the pairs of ``marked`` rows that the filters allow, once for nearly all pairs."""
        more, less, longs = 100 + self.percent, 100 - self.percent, BITS // 64

        def prepared(rows: Columns) -> Columns:
            lengths = rows["early_lengths"]
            early = np.zeros((len(lengths), max(1, lengths.max())), dtype=np.int64)
            early[np.arange(early.shape[1]) < lengths[:, None]] = rows["early"]
            return rows | {"early": early, "bits": rows["bits"].view(np.uint64).reshape(-1, longs)}

        def passing(rows: Columns, one: np.ndarray, two: np.ndarray) -> np.ndarray:
            known = rows["sure"][one] & rows["sure"][two]
            most = np.where(known, less * (rows["n"][one] + rows["n"][two]) // more, BITS)
            left = np.flatnonzero(bits_between(rows["bits"][:, :FIRST], one, two) <= most)
            left = left[bits_between(rows["bits"], one[left], two[left]) <= most[left]]
            out = np.zeros(len(one), dtype=bool)
            places = np.arange(rows["early"].shape[1])
            for start in range(0, len(left), 4_096):
                some = left[start : start + 4_096]
                a, b = one[some], two[some]
                equal = rows["early"][a][:, :, None] == rows["early"][b][:, None, :]
                equal &= (places < rows["early_lengths"][a, None])[:, :, None] & (places < rows["early_lengths"][b, None])[:, None, :]
                out[some] = ~equal.any((1, 2))
            return out

        nothing = F.array_repeat(F.lit(0).cast("long"), longs)
        return pairs_in_lists(
            rows.select("element", "g", "n", "at", "root", "pieces", "early", F.coalesce("bits", nothing).alias("bits"),
                        (F.col("members") == 1).alias("sure")),
            "element", "g", self.percent, prepared, passing)

    def other_pairs(self, roots: DataFrame, seen: DataFrame) -> DataFrame:
        """Pairs of classes in different components whose groups share a prefix element or are the same."""
        placed = self.placed(roots)
        of_group = placed.select("g", "root").distinct()
        met = self.met(self.marked(of_group)).distinct()
        several = of_group.groupBy("g").agg(F.count("*").alias("k")).where("k > 1").select("g")
        same = of_group.join(several, "g", "left_semi")
        met = met.union(
            same.join(same.select("g", F.col("root").alias("root2")), "g").where("root < root2")
            .select("g", "root", F.col("g").alias("g2"), "root2"))
        ends = placed.select(F.col("g").alias("g2"), F.col("root").alias("root2"), F.col("c").alias("b"))
        pairs = met.join(placed.withColumnRenamed("c", "a"), ["g", "root"]).join(ends, ["g2", "root2"])
        return store(ordered(pairs.select("a", "b")).join(seen, ["a", "b"], "left_anti"), "pairs")

    def bits_allow(self, bits: str, bits2: str, n: str, n2: str) -> F.Column:
        """Not more bits differ than elements may: n + n2 - 2 k of them, where 100 k >= percent (n + n2 - k)."""
        x, y = F.col(bits), F.col(bits2)
        differ = sum((F.bit_count(x[i].bitwiseXOR(y[i])) for i in range(1, BITS // 64)), F.bit_count(x[0].bitwiseXOR(y[0])))
        return (100 + self.percent) * differ <= (100 - self.percent) * (F.col(n) + F.col(n2))

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) of classes whose sets reach the threshold."""
        mark = self.sets.select("row", "n", "bits", "counts", "s1", "s2")
        one, two = ([F.col("row").alias(x)] + [F.col(c).alias(c + x) for c in ("n", "bits", "counts", "s1", "s2")] for x in "ab")
        more, less = 100 + self.percent, 100 - self.percent
        near = pairs.join(mark.select(one), "a").join(mark.select(two), "b").where(self.bits_allow("bitsa", "bitsb", "na", "nb"))

        def close(batch: dict[str, list]) -> dict[str, object]:
            kept = []
            for i, (x, y) in enumerate(zip(batch["countsa"], batch["countsb"])):
                if x and y:
                    x, y = np.frombuffer(x, dtype=np.uint8).astype(np.int64), np.frombuffer(y, dtype=np.uint8).astype(np.int64)
                    if more * int(np.abs(x - y).sum()) > less * (batch["na"][i] + batch["nb"][i]):
                        continue
                kept.append(i)
            return {k: [batch[k][i] for i in kept] for k in names}

        names = ("a", "b", "na", "s1a", "s2a", "nb", "s1b", "s2b")
        kept = store(map_batches(
            near.select(*names, "countsa", "countsb"), close,
            "a long, b long, na int, s1a long, s2a long, nb int, s1b long, s2b long"), "candidates")
        wanted = kept.select(F.col("a").alias("c")).union(kept.select("b")).distinct().join(self.classes, "c").select("least")
        sets = self.remade(wanted)
        once = sets.groupBy("n", "s1", "s2").agg(F.first("set").alias("set"))
        percent = self.percent

        def meet(batch: dict[str, list]) -> dict[str, object]:
            linked = []
            for x, y in zip(batch["sa"], batch["sb"]):
                x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                both = int((y[at] == x).sum())
                linked.append(100 * both >= percent * (len(x) + len(y) - both))
            return {"a": batch["a"], "b": batch["b"], "linked": linked}

        of_a, of_b = (once.select(*[F.col(c).alias(c + x) for c in ("n", "s1", "s2")], F.col("set").alias("s" + x)) for x in "ab")
        with_sets = kept.join(of_a, ["na", "s1a", "s2a"]).join(of_b, ["nb", "s1b", "s2b"])
        met = map_batches(with_sets.select("a", "b", "sa", "sb"), meet, "a long, b long, linked boolean")
        linked = store(met.where("linked").select("a", "b"), "linked")
        release(self.spark, sets, kept)
        return linked

    def remade(self, wanted: DataFrame) -> DataFrame:
        """(n, s1, s2, set) from the texts of the documents with the ids ``least`` of ``wanted``.

        Ids are compared by their hash; sets of other documents of that hash meet no pair. A task gives a set once.
        """
        keys = few_keys(wanted.select(F.xxhash64("least").alias("at")))
        words = self.words
        types = arrow_schema(self.spark, "n int, s1 long, s2 long, `set` binary")

        def remake(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen = set()
            for batch in small(batches):
                out = {k: [] for k in ("n", "s1", "s2", "set")}
                for text in batch.column(0).to_pylist():
                    found = shingles(text, words).tobytes()
                    key = xxhash.xxh3_128_digest(found)
                    if found and key not in seen:
                        seen.add(key)
                        s1, s2 = np.frombuffer(key, dtype="<i8").tolist()
                        for k, v in (("n", len(found) // 8), ("s1", s1), ("s2", s2), ("set", found)):
                            out[k].append(v)
                yield batch_of(out, types)

        source = self.docs.select(F.xxhash64(self.id_col).alias("at"), F.col(self.text_col).alias("text"))
        asked = source.join(keys, "at", "left_semi").select("text")
        made = store(asked.mapInArrow(remake, "n int, s1 long, s2 long, `set` binary"), "remade")
        release(self.spark, keys)
        return made


def ordered(pairs: DataFrame) -> DataFrame:
    return pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def jaccard_join(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT,
) -> DataFrame:
    """doc id, n_shingles, component_id of every row."""
    join = Join(docs, id_col, text_col, words, percent)
    seen = store(join.first_pairs(), "pairs")
    links = join.verified(seen)
    for turn in range(1, TURNS + 1):
        more = store(join.more_pairs(components(links), seen, turn), "pairs")
        links, seen = links.union(join.verified(more)), seen.union(more)
    last = join.verified(join.other_pairs(components(links), seen))
    roots = store(components(links.union(last)), "roots")
    placed = join.classes.join(roots.withColumnRenamed("node", "c"), "c", "left").withColumn("root", F.coalesce("root", "c"))
    names = placed.groupBy("root").agg(F.min("least").alias("name"))
    named = placed.join(names, "root").select("n", "s1", "s2", "name")
    # copies of one text make the left side skewed, the right side has each class once
    out = join.sets.select("id", "n", "s1", "s2").join(named, ["n", "s1", "s2"], "left")
    return out.select(
        F.col("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("name")).otherwise(F.col("id")).alias("component_id"))
