"""Pairs of lists against all pairs, hashes of words against the words."""

import itertools
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from packetloom.llm import list_pairs, prefix_join


def rows_of_lists(rng, sizes):
    """(k, c, n, at, root, pieces, mark) of lists of these sizes; some rows share a component."""
    rows = []
    for k, size in enumerate(sizes):
        for _ in range(size):
            n = rng.choice([1, 5, 40, 43, 50, 52, 60, 300])
            rows.append((k, len(rows), n, rng.randrange(min(n, 6)), rng.randrange(12), 1 + size // 20, rng.randrange(4)))
    return rows


def plain_pairs(rows):
    out = set()
    for a, b in itertools.combinations(rows, 2):
        if a[0] == b[0] and a[4] != b[4] and a[6] != b[6]:
            (c, n, at, root), (c2, n2, at2, root2) = a[1:5], b[1:5]
            if 100 * min(n, n2) >= 80 * max(n, n2) and 180 * min(n - at, n2 - at2) >= 80 * (n + n2):
                out.add((c, root, c2, root2) if root < root2 else (c2, root2, c, root))
    return out


def test_pairs_equal_all_pairs(spark):
    rows = rows_of_lists(random.Random(3), [1, 2, 3, 90, 1, 40, 7, 1, 200, 2])
    frame = spark.createDataFrame(rows, "k long, c long, n int, at int, root long, pieces int, mark int")

    def passing(found, one, two):
        return found["mark"][one] != found["mark"][two]

    got = [tuple(r) for r in list_pairs.pairs_in_lists(frame, "k", "c", 80, lambda found: found, passing).collect()]
    assert len(got) == len(set(got)) and set(got) == plain_pairs(rows) and len(got) > 500


def test_pairs_a_few_at_once(monkeypatch):
    """More pairs of a row than are taken at once, rows without any, lists over the edges of batches."""
    monkeypatch.setattr(list_pairs, "AT_ONCE", 3)
    rows = sorted((r[0], 0, r[2], *r[1:2], *r[3:5], r[6]) for r in rows_of_lists(random.Random(4), [30, 1, 1, 9, 25]))
    names = ("k", "piece", "n", "c", "at", "root", "mark")
    batches = [pa.RecordBatch.from_pydict({x: [r[i] for r in rows[s : s + 4]] for i, x in enumerate(names)}) for s in range(0, len(rows), 4)]
    got, seen = [], 0
    for table in list_pairs.whole_lists(iter(batches), "k"):
        found = list_pairs.columns_of(table)
        seen += table.num_rows
        found["mine"] = np.ones(table.num_rows, dtype=bool)
        for one, two in list_pairs.pairs_of(found, "k", 80, lambda f, one, two: f["mark"][one] != f["mark"][two]):
            got += zip(found["c"][one], found["root"][one], found["c"][two], found["root"][two])
    want = plain_pairs([(r[0], r[3], r[2], r[4], r[5], 1, r[6]) for r in rows])
    assert seen == len(rows) and len(got) == len(set(got)) and set(got) == want


def test_pairs_of_a_long_list_are_no_rows_of_a_join(spark):
    rows = [(i, f"the very same first five words and then w{i} x{i} y{i} z{i}") for i in range(60)]
    join = prefix_join.Join(spark.createDataFrame(rows, "doc_id int, text string"), "doc_id", "text", 5, 80)
    met = join.met(join.marked(join.classes.select("g", F.col("c").alias("root"))))
    above = met._jdf.queryExecution().analyzed().toString().split("MapInArrow")[0]
    assert "Join" not in above and met.count() == 0


def test_word_hashes_tell_words_apart():
    rng = random.Random(5)
    texts = ["", " ", "a", "A a\tA", "É é", "\x85x \x1c y", "one\x0btwo\x0cthree\r\nONE", "ab ba aabb abab baba bbaa", "x" * 9_000 + " " + "x" * 8_999,
             "0 " + "y" * (1 << 18)]
    texts += [" ".join("".join(rng.choice("abAB01é") for _ in range(rng.randint(1, 9))) for _ in range(300)) for _ in range(60)]
    known = {}
    for text in texts:
        words = text.encode().lower().split()
        found = prefix_join.word_hashes(text).tolist()
        assert len(found) == len(words)
        for word, value in zip(words, found):
            assert known.setdefault(word, value) == value
    assert len(set(known.values())) == len(known) > 5_000


def test_shingles_of_a_text():
    def distinct(text, words):
        found = text.encode().lower().split()
        size = min(words, len(found))
        return len({tuple(found[i : i + size]) for i in range(len(found) - size + 1)}) if found else 0

    for text in ("", "  ", "a", "a A", "a b a b a b a b", "a b c d e f", "to be or not TO be or not to be"):
        for words in (1, 3, 5, 7):
            found = prefix_join.shingles(text, words)
            assert len(found) == distinct(text, words) and (found[1:] > found[:-1]).all()
    assert len(prefix_join.shingles(None)) == 0
    assert (prefix_join.shingles("a b c", 2) == prefix_join.shingles(" A\nb  C ", 2)).all()
