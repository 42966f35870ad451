"""Near duplicates by b-bit MinHash: links of a Jaccard similarity on word shingles, and their components.

A document is the set of its distinct word n-grams, hashed to 64 bits. ``BANDS * ROWS`` hash functions give a minimum
each. Full minima make the band keys, one per run of ROWS; documents that share a key are candidates. Of every minimum
only the low ``BITS`` bits are kept, packed into a few longs. Two sets of similarity J agree in a lane with probability
J + (1 - J) / 2^BITS, as unequal minima agree by chance; so the bit count of equal lanes, corrected for such
collisions, estimates J. Candidates below the threshold by more than ``SLACK`` standard errors go. So do those whose
sets set too many different bits of a 2048-bit table, as every such bit needs an element that the other set lacks: an
exact bound that tells copies just below the threshold from links. The others are verified on full sets, made again
from the texts of the documents in question.

A pair exactly at the threshold (0.85) shares no key with probability (1 - 0.85^5)^32 = 7e-9, and its estimate falls
short with 1e-9; links of greater similarity are lost more seldom still.

Equal sets are one class. Only components are asked for, so not all pairs of a group of near copies are made: every
class meets the smallest of each of its keys' lists and the next one in a random order of the list. What verifies gives
components. Lists that still hold several components are put into other random orders, ``TURNS`` times, which joins what
is left of large groups at a cost in proportion to the lists. Then lists of several components are met in full, but only
between components, and become pairs only where the estimate allows; long lists are cut into pieces by class, each of
which meets the list in a task of its own (``list_pairs``).

Null texts and texts without a word have an empty set, no link and are their own component. A text of fewer than
``words`` words is one element. Rows without id take part, their component is named by others; ``kept`` is false for
them. Repeated rows are copies: all of them carry the component's id, and all rows of the smallest id are kept. Empty
tables give no rows. Extra columns of the input do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import floor, sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from packetloom.llm.common import arrow_schema, batch_of, few_keys, map_batches, release, small, store
from packetloom.llm.components import components
from packetloom.llm.list_pairs import Columns, bits_between, pairs_in_lists
from packetloom.llm.prefix_join import _MIX, shingles

WORDS, PERCENT = 3, 85
BANDS, ROWS, BITS = 32, 5, 2
HASHES = BANDS * ROWS
LANES = 64 // BITS  # of a long
SLACK = 6.0
PIECE = 1_000
TABLE_BITS = 2_048
TURNS = 1

_rng = np.random.default_rng(20)
_FACTORS = (_rng.integers(0, 1 << 32, HASHES, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_OFFSETS = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32)
_BLOCK = 512


def minima(found: np.ndarray) -> np.ndarray:
    """The minimum of every hash function over a set that is not empty.

    A hash's last step, one to one, is taken on the minima only: the order is that of the hashes before it.
    """
    folded = (found ^ (found >> np.uint64(32))).astype(np.uint32)
    least = np.full(HASHES, np.iinfo(np.uint32).max, dtype=np.uint32)
    for start in range(0, len(folded), _BLOCK):
        mixed = (folded[None, start : start + _BLOCK] ^ _OFFSETS[:, None]) * _FACTORS[:, None]
        mixed ^= mixed >> np.uint32(15)
        mixed *= np.uint32(0x2C1B3C6D)
        np.minimum(least, mixed.min(1), out=least)
    return least ^ (least >> np.uint32(13))


def band_keys(least: np.ndarray) -> list[list[int]]:
    """One 64-bit key per band, of its number and its minima; for rows of minima."""
    runs = least.reshape(-1, BANDS, ROWS).astype(np.uint64)
    keys = np.arange(BANDS, dtype=np.uint64)
    for j in range(ROWS):
        keys = (keys ^ runs[:, :, j]) * _MIX[j % len(_MIX)]
        keys ^= keys >> np.uint64(29)
    return keys.view(np.int64).tolist()


def packed(least: np.ndarray) -> list:
    """The low BITS bits of every minimum, LANES to a long; for one set's minima, or for rows of them."""
    bits = (least[..., None] >> np.arange(BITS, dtype=np.uint32)) & 1
    return np.packbits(bits.astype(np.uint8).reshape(*least.shape[:-1], -1), axis=-1, bitorder="little").view("<i8").tolist()


def unequal_lanes(one: F.Column, two: F.Column) -> F.Column:
    """Lanes in which two signatures differ, by bit counts."""
    low = int.from_bytes(sum(1 << (BITS * k) for k in range(LANES)).to_bytes(8, "big"), "big", signed=True)

    def count(i: int) -> F.Column:
        x = one[i].bitwiseXOR(two[i])
        for shift in range(1, BITS):
            x = x.bitwiseOR(F.shiftrightunsigned(one[i].bitwiseXOR(two[i]), shift))
        return F.bit_count(x.bitwiseAND(F.lit(low)))

    return sum((count(i) for i in range(1, HASHES // LANES)), count(0))


def lanes_between(sig: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """``unequal_lanes`` of the rows at these places of a matrix of signatures."""
    differ = sig[one] ^ sig[two]
    either = differ.copy()
    for shift in range(1, BITS):
        either |= differ >> np.uint64(shift)
    either &= np.uint64(sum(1 << (BITS * k) for k in range(LANES)))
    return np.bitwise_count(either).sum(1, dtype=np.int64)


def table(found: np.ndarray) -> list[int]:
    """TABLE_BITS bits of a set, TABLE_BITS / 64 longs: set where an element falls."""
    marked = np.zeros(TABLE_BITS, dtype=np.uint8)
    marked[((found >> np.uint64(17)) % np.uint64(TABLE_BITS)).astype(np.int64)] = 1
    return np.packbits(marked, bitorder="little").view("<i8").tolist()


def differing_bits(one: F.Column, two: F.Column) -> F.Column:
    return sum((F.bit_count(one[i].bitwiseXOR(two[i])) for i in range(1, TABLE_BITS // 64)), F.bit_count(one[0].bitwiseXOR(two[0])))


def estimate(unequal: F.Column) -> F.Column:
    """Similarity from the unequal lanes, corrected for lanes that agree by chance."""
    chance = 2.0**-BITS
    return ((F.lit(1.0) - unequal / F.lit(float(HASHES))) - F.lit(chance)) / F.lit(1.0 - chance)


def most_unequal(percent: int, slack: float = SLACK) -> int:
    """Unequal lanes up to which the estimate is within ``slack`` standard errors of the threshold."""
    equal = percent / 100 + (1 - percent / 100) * 2.0**-BITS
    return floor(HASHES * (1 - equal) + slack * sqrt(HASHES * equal * (1 - equal)))


def signed(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """row, id, place (hash of the id), n, class key (s1, s2), band keys and signature of every row.

    A task gives bands and signature once per set; later rows with the same set have null there.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    columns = f"row long, id {id_type}, place long, n int, s1 long, s2 long, bands array<long>, sig array<long>, bits array<long>"
    types = arrow_schema(docs.sparkSession, columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in small(batches):
            out = {k: [None] * batch.num_rows for k in ("n", "s1", "s2", "bands", "sig", "bits")}
            chosen, least = [], []
            for i, text in enumerate(batch.column(3).to_pylist()):
                found = shingles(text, words)
                key = xxhash.xxh3_128_digest(found.tobytes())
                if len(found) and key not in seen:
                    if len(seen) >= 200_000:
                        seen.clear()
                    seen.add(key)
                    chosen.append(i)
                    least.append(minima(found))
                    out["bits"][i] = table(found)
                out["n"][i] = len(found)
                out["s1"][i], out["s2"][i] = np.frombuffer(key, dtype="<i8").tolist()
            if chosen:
                rows = np.stack(least)
                for i, bands, sig in zip(chosen, band_keys(rows), packed(rows)):
                    out["bands"][i], out["sig"][i] = bands, sig
            yield batch_of({"row": batch.column(0), "id": batch.column(1), "place": batch.column(2), **out}, types)

    source = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.xxhash64(id_col).alias("place"),
        F.col(text_col).alias("text"))
    return source.mapInArrow(run, columns)


class Dedup:
    """The steps over one table of documents."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, words: int, percent: int):
        self.docs, self.id_col, self.text_col, self.words, self.percent = docs, id_col, text_col, words, percent
        self.spark, self.most = docs.sparkSession, most_unequal(percent)
        self.rows = store(signed(docs, id_col, text_col, words), "signed")
        # of a class, the first row that carries its signature
        self.classes = store(
            self.rows.where("n > 0").groupBy("n", "s1", "s2").agg(
                F.min(F.when(F.col("sig").isNotNull(), F.col("row"))).alias("c"), F.min("id").alias("least")), "classes")
        chosen = self.rows.where("sig IS NOT NULL").select("row", "n", "place", "s1", "s2", "bands", "sig", "bits")
        chosen = chosen.join(self.classes.select(F.col("c").alias("row")), "row")
        self.signatures = store(chosen.select(F.col("row").alias("c"), "n", "place", "s1", "s2", "sig", "bits", "bands"), "signatures")
        entries = self.signatures.select("c", "n", F.explode("bands").alias("k"))
        lists = entries.groupBy("k").agg(F.count("*").alias("long"), F.min("c").alias("lo")).where("long > 1")
        self.shared = store(entries.join(lists, "k"), "lists")

    def may_link(self, one: str, two: str) -> F.Column:
        """Whether sizes, signatures and bits of two rows, whose columns end in ``one`` and ``two``, allow a link."""
        n, n2, sig, sig2, bits, bits2 = (F.col(c + end) for c in ("n", "sig", "bits") for end in (one, two))
        sizes = 100 * F.least(n, n2) >= self.percent * F.greatest(n, n2)
        # of n + n2 elements n + n2 - 2 k are in one set only, where 100 k >= percent (n + n2 - k)
        apart = (100 + self.percent) * differing_bits(bits, bits2) <= (100 - self.percent) * (n + n2)
        return sizes & (unequal_lanes(sig, sig2) <= self.most) & apart

    def first_pairs(self) -> DataFrame:
        """Every class with the smallest of its lists and with the next one in a random order."""
        smallest = self.shared.select(F.col("c").alias("x"), F.col("lo").alias("y"))
        return ordered(smallest.union(self.neighbours(self.shared, 0)))

    def neighbours(self, rows: DataFrame, turn: int) -> DataFrame:
        """(x, y): every class with the next one of its list, in an order that ``turn`` and the list decide.

        Long lists are ordered in pieces that the order deals.
        """
        order = F.xxhash64("k", "c", F.lit(turn))
        dealt = rows.select("k", "c", order.alias("o"), F.pmod(order, F.ceil(F.col("long") / PIECE)).alias("piece"))
        by = Window.partitionBy("k", "piece").orderBy("o", "c")
        return dealt.select(F.col("c").alias("x"), F.lead("c").over(by).alias("y")).where("y IS NOT NULL")

    def split(self, roots: DataFrame) -> DataFrame:
        """(k, c, n, long, root) of the lists of three or more that hold several components.

        In shorter lists the first round met all pairs.
        """
        rows = self.shared.where("long > 2").select("k", "c", "n", "long").join(
            roots.withColumnRenamed("node", "c"), "c", "left").withColumn("root", F.coalesce("root", "c"))
        several = rows.groupBy("k").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("k")
        return rows.join(several, "k", "left_semi")

    def more_pairs(self, roots: DataFrame, seen: DataFrame, turn: int) -> DataFrame:
        """Neighbours in another order of the lists, where they are of different components."""
        rows = store(self.split(roots), "split")
        placed = rows.select("c", "root").distinct()
        pairs = ordered(self.neighbours(rows, turn))
        for end in "ab":
            pairs = pairs.join(placed.select(F.col("c").alias(end), F.col("root").alias(f"root_{end}")), end)
        return pairs.where("root_a <> root_b").select("a", "b").join(seen, ["a", "b"], "left_anti")

    def other_pairs(self, roots: DataFrame, seen: DataFrame) -> DataFrame:
        """Pairs of different components in one list, where sizes and signatures allow a link."""
        sig = self.signatures.select("c", "sig", "bits")
        rows = self.split(roots).join(sig, "c").select(
            "k", "c", "n", "root", "sig", "bits", F.lit(0).alias("at"), F.ceil(F.col("long") / PIECE).cast("int").alias("pieces"))
        most, more, less = self.most, 100 + self.percent, 100 - self.percent

        def prepared(rows: Columns) -> Columns:
            return rows | {k: rows[k].view(np.uint64).reshape(len(rows["n"]), -1) for k in ("sig", "bits")}

        def passing(rows: Columns, one: np.ndarray, two: np.ndarray) -> np.ndarray:
            left = np.flatnonzero(lanes_between(rows["sig"], one, two) <= most)
            out = np.zeros(len(one), dtype=bool)
            one, two = one[left], two[left]
            out[left] = more * bits_between(rows["bits"], one, two) <= less * (rows["n"][one] + rows["n"][two])
            return out

        met = pairs_in_lists(rows, "k", "c", self.percent, prepared, passing)
        pairs = store(ordered(met.select(F.col("c").alias("x"), F.col("c2").alias("y"))), "pairs")
        return pairs.join(seen, ["a", "b"], "left_anti")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) of classes whose sets reach the threshold."""
        mark = self.signatures.select("c", "n", "sig", "bits", "s1", "s2", "place")
        one, two = ([F.col("c").alias(x)] + [F.col(c).alias(c + x) for c in mark.columns[1:]] for x in "ab")
        near = pairs.join(mark.select(one), "a").join(mark.select(two), "b").where(self.may_link("a", "b"))
        near = store(near.select("a", "b", *[c + x for x in "ab" for c in ("n", "s1", "s2", "place")]), "candidates")
        sets = self.remade(near.select(F.explode(F.array("placea", "placeb")).alias("place")))
        percent = self.percent

        def meet(batch: dict[str, list]) -> dict[str, object]:
            linked = []
            for x, y in zip(batch["seta"], batch["setb"]):
                x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                both = int((y[at] == x).sum())
                linked.append(100 * both >= percent * (len(x) + len(y) - both))
            return {"a": batch["a"], "b": batch["b"], "linked": linked}

        of_a, of_b = (sets.select(*[F.col(c).alias(c + x) for c in ("n", "s1", "s2", "set")]) for x in "ab")
        both = near.join(of_a, ["na", "s1a", "s2a"]).join(of_b, ["nb", "s1b", "s2b"]).select("a", "b", "seta", "setb")
        links = store(map_batches(both, meet, "a long, b long, linked boolean").where("linked").select("a", "b"), "links")
        release(self.spark, sets, near)
        return links

    def remade(self, wanted: DataFrame) -> DataFrame:
        """(n, s1, s2, set) of the documents whose id has a hash in ``wanted(place)``, each set once.

        Sets of other documents of that hash meet no pair.
        """
        keys = few_keys(wanted)
        words, schema = self.words, "n int, s1 long, s2 long, `set` binary"
        types = arrow_schema(self.spark, schema)

        def remake(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: set[bytes] = set()
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

        texts = self.docs.select(F.xxhash64(self.id_col).alias("place"), F.col(self.text_col).alias("text"))
        made = texts.join(keys, "place", "left_semi").select("text").mapInArrow(remake, schema)
        sets = store(made.groupBy("n", "s1", "s2").agg(F.first("set").alias("set")), "remade")
        release(self.spark, keys)
        return sets


def ordered(pairs: DataFrame) -> DataFrame:
    return pairs.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT,
) -> DataFrame:
    """``id_col``, n_shingles, component_id, kept of every row."""
    steps = Dedup(docs, id_col, text_col, words, percent)
    seen = store(steps.first_pairs(), "pairs")
    links = steps.verified(seen)
    for turn in range(1, TURNS + 1):
        more = store(steps.more_pairs(components(links), seen, turn), "pairs")
        links, seen = links.union(steps.verified(more)), seen.union(more)
    last = steps.verified(store(steps.other_pairs(components(links), seen), "pairs"))
    roots = store(components(links.union(last)), "roots")
    placed = steps.classes.join(roots.withColumnRenamed("node", "c"), "c", "left").withColumn("root", F.coalesce("root", "c"))
    names = placed.groupBy("root").agg(F.min("least").alias("name"))
    named = placed.join(names, "root").select("n", "s1", "s2", "name")
    out = steps.rows.select("id", "n", "s1", "s2").join(named, ["n", "s1", "s2"], "left")
    component = F.when(F.col("n") > 0, F.col("name")).otherwise(F.col("id"))
    return out.select(
        F.col("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
