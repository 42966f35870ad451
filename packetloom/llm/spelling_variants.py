"""Spelling variants by generation over a reduced alphabet.

Words are counted over all texts (repeated occurrences are added up in the tasks first). Letters are hashed to a few
symbols, so a word has a reduced word, and words that differ in one letter have reduced words that are equal or differ
in one symbol. Every reduced word is given its full neighbourhood of one edit over the symbols and itself, the
neighbourhoods are joined with the reduced vocabulary, reduced words are expanded to their words, and every pair of words
is verified on the original letters. The number of symbols follows the size of the vocabulary (a few more letters where
there are millions of words), so that a reduced word stands for few words.

Where a reduced word stands for more than ``crowd`` words none of its pairs are made that way: its words get their
neighbourhood over all letters, in which a neighbour is the word itself. So work grows with words, never with the square
of a group, and no pair is lost.

A word's form is its near word of largest count (of equal counts the first in code-point order), if that is at least
``ratio`` times the word's; forms are followed to the root by doubling, as a chain rises by that ratio with every step.

Null and empty texts have no words. Rows of null id take part as id ''. Repeated rows count as often as they stand there. Words of any
length take part. Empty tables give no rows. Extra columns of the input do not matter.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetloom.llm.common import arrow_schema, batch_of, release, small, store

LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))
SHORTEST, SELDOM, RATIO = 6, 5, 5
DROP = 199
CROWD = 48
_RUN = re.compile("[a-zÀ-ÿ]+")
_HELD = 200_000  # distinct words that a task adds up before it hands them on


def lowered(text: str) -> str:
    """Only A-Z in lower case."""
    return text.encode("utf-8", "replace").lower().decode()


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = SHORTEST, drop: int = DROP) -> DataFrame:
    """(word, n) of all words of ``shortest`` letters or more.

    Of a run whose crc32 with the document's id is divisible by ``drop`` one letter goes: typing errors that are known.
    ``drop`` 0 leaves all runs as they are.
    """
    schema = "word string, n long"
    types = arrow_schema(docs.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}
        for batch in small(batches):
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                start = zlib.crc32(f"{doc or ''}:".encode())
                for word in _RUN.findall(lowered(text)) if text else ():
                    if drop and (h := zlib.crc32(word.encode(), start)) % drop == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                    if len(word) >= shortest:
                        held[word] = held.get(word, 0) + 1
                if len(held) >= _HELD:
                    yield batch_of({"word": list(held), "n": list(held.values())}, types)
                    held = {}
        if held:
            yield batch_of({"word": list(held), "n": list(held.values())}, types)

    texts = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    return texts.mapInArrow(run, schema).groupBy("word").agg(F.sum("n").alias("n"))


def symbols_for(words: int) -> int:
    """Enough symbols for about one word in eight reduced words of the shortest length; 4 to 24."""
    return min(24, max(4, ceil((8 * max(words, 1)) ** (1 / SHORTEST))))


def alphabet(size: int) -> tuple[str, str]:
    """(letters in order of their hash, the symbol of each): every symbol has about as many letters."""
    order = sorted(LETTERS, key=lambda c: zlib.crc32(c.encode()))
    return "".join(order), "".join(chr(ord("A") + k % size) for k in range(len(order)))


def neighbourhood(word: F.Column, symbols: str) -> F.Column:
    """All strings one insertion, deletion or replacement away, and the word, each once."""
    letters = F.array([F.lit(s) for s in symbols])
    size = F.char_length(word)
    before = lambda i: F.substring(word, F.lit(1), i - 1)
    after = lambda i: F.substring(word, i, size)
    each = lambda last, tail: F.flatten(F.transform(
        F.sequence(F.lit(1), last), lambda i: F.transform(letters, lambda s: F.concat(before(i), s, tail(i)))))
    fewer = F.transform(F.sequence(F.lit(1), size), lambda i: F.concat(before(i), after(i + 1)))
    return F.array_distinct(F.concat(
        F.array(word), fewer, each(size, lambda i: after(i + 1)), each(size + 1, after)))


def near_words(words: DataFrame, symbols: int | None = None, crowd: int = CROWD) -> DataFrame:
    """(word, near) both ways for all pairs of ``words(word, n)`` one edit apart; ``words`` must have each word once."""
    size = symbols or symbols_for(words.count())
    reduced = F.translate("word", *alphabet(size))
    placed = store(words.select("word", reduced.alias("r")), "reduced")
    groups = placed.groupBy("r").agg(F.count("*").alias("k"))
    open_groups = groups.where(F.col("k") <= crowd).select("r")
    used = "".join(sorted(set(alphabet(size)[1])))
    hoods = open_groups.select(F.col("r").alias("from"), F.explode(neighbourhood(F.col("r"), used)).alias("r"))
    # each reduced pair once: from is the smaller
    met = hoods.where(F.col("from") <= F.col("r")).join(open_groups, "r")
    one = placed.select(F.col("word").alias("a"), F.col("r").alias("from"))
    two = placed.select(F.col("word").alias("b"), "r")
    pairs = met.join(one, "from").join(two, "r").where(((F.col("from") < F.col("r")) | (F.col("a") < F.col("b"))) & one_edit("a", "b"))
    crowded = placed.join(groups.where(F.col("k") > crowd).select("r"), "r", "left_semi").select(F.col("word").alias("a"))
    fine = crowded.select("a", F.explode(neighbourhood(F.col("a"), LETTERS)).alias("b")).where("a <> b")
    found = fine.join(placed.select(F.col("word").alias("b")), "b", "left_semi").where(one_edit("a", "b"))
    both = pairs.select("a", "b").union(found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))).distinct()
    both = store(both, "near")
    release(words.sparkSession, placed)
    return both.select(F.col("a").alias("word"), F.col("b").alias("near")).union(both.select("b", "a"))


def one_edit(a: str, b: str) -> F.Column:
    return F.levenshtein(a, b, 1) == 1


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form) of the words that have a form; every step doubles the way gone."""
    state = store(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = state.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = store(state.join(onward, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        release(forms.sparkSession, state)
        state = moved
        if state.where("moved").isEmpty():
            return state.select("word", "root")


def variants(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = SHORTEST, seldom: int = SELDOM,
    ratio: int = RATIO, drop: int = DROP, symbols: int | None = None, crowd: int = CROWD,
) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word with ``seldom`` occurrences or more."""
    counted = word_counts(docs, id_col, text_col, shortest, drop)
    words = store(counted.where(F.col("n") >= seldom), "words")
    near = near_words(words, symbols, crowd).join(words.select(F.col("word").alias("near"), F.col("n").alias("m")), "near")
    most = near.groupBy("word").agg(F.count("*").alias("n_near"), F.max("m").alias("m"))
    best = near.join(most, ["word", "m"]).groupBy("word", "n_near", "m").agg(F.min("near").alias("form"))
    known = store(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(F.col("m") >= ratio * F.col("n"), F.col("form")).alias("form"),
        F.when(F.col("m") >= ratio * F.col("n"), F.col("m")).alias("form_n")), "known")
    followed = roots(known.where("form IS NOT NULL"))
    return known.join(followed, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
