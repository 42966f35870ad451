"""Spelling variants against all pairs of words, with odd rows."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from packetloom.llm import spelling_variants

SCHEMA = "doc_id long, text string, word string, n int, r string"


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain(rows, shortest, seldom, ratio, drop=199):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % drop == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= shortest and c >= seldom}
    near = {w: [v for v in n if one_apart(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, n[w], len(near[w]), form[w], n.get(form[w]), root))
    return sorted(out)


def texts():
    rng = random.Random(11)
    letters = "abcdeéßÀ÷"
    base = ["".join(rng.choice(letters) for _ in range(rng.choice([3, 4, 5, 8]))) for _ in range(60)]
    words = base + ["aaaaaa", "aaaaab", "aaaaabb", "bbbbbb", "ABCDEF", "abcdeÉ"]
    for w in base[:40]:
        i = rng.randrange(len(w))
        words += [w[:i] + w[i + 1 :], w[:i] + rng.choice(letters) + w[i + 1 :], w[:i] + rng.choice(letters) + w[i:]]
    weights = [rng.choice([1, 1, 2, 9, 60]) for _ in words]
    rows = [(i, " ".join(rng.choices(words, weights, k=rng.choice([1, 30, 200])))) for i in range(80)]
    rows += [(900, None), (901, ""), (902, "1234 ... œ ı K"), (903, "x" * 5000), (None, "aaaaaa AAAAAB"), (3, rows[3][1])]
    return rows + [(904, rows[5][1])] * 5


@pytest.mark.parametrize("symbols,crowd", [(None, 48), (2, 3), (4, 1), (24, 48), (3, 10_000)])
def test_variants_equal_brute_force(spark, symbols, crowd):
    rows = texts()
    docs = spark.createDataFrame([(i, t, "w", 1, "r") for i, t in rows], SCHEMA)
    got = spelling_variants.variants(docs, shortest=4, seldom=2, ratio=3, drop=7, symbols=symbols, crowd=crowd)
    found = [(r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in got.collect()]
    want = plain(rows, 4, 2, 3, 7)
    assert sorted(found) == want
    assert len({w[3] for w in want}) > 5 and any(w[5] != w[3] for w in want if w[3])


def test_without_words(spark):
    none = spark.createDataFrame([(1, None), (2, ""), (3, "a b")], "doc_id long, text string")
    assert spelling_variants.variants(none).count() == 0
    assert spelling_variants.variants(none.limit(0)).columns == ["word", "n", "n_near", "form", "form_n", "root"]


def test_neighbourhood_is_every_single_edit(spark):
    row = spark.range(1).select(spelling_variants.neighbourhood(F.lit("ABBA"), "ABC").alias("h")).first()
    words = {"".join(w) for k in (3, 4, 5) for w in __import__("itertools").product("ABC", repeat=k)}
    assert sorted(row.h) == sorted(w for w in words if w == "ABBA" or one_apart("ABBA", w))


def test_ties_take_the_first_form_and_chains_lead_to_the_root(spark):
    text = " ".join(["kitten"] * 125 + ["sitten"] * 25 + ["sittin"] * 5 + ["zzzzzz"] * 25 + ["zzzzzy"] * 25 + ["zzzzzx"] * 5)
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = {r.word: r for r in spelling_variants.variants(docs, drop=0).collect()}
    assert (got["sittin"].form, got["sittin"].root) == ("sitten", "kitten")
    assert (got["zzzzzx"].form, got["zzzzzx"].n_near, got["zzzzzy"].form) == ("zzzzzy", 2, None)
