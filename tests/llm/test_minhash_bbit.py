"""b-bit MinHash near duplicates against all pairs, with odd rows."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from packetloom.llm import common, minhash_bbit
from packetloom.llm.prefix_join import shingles

SCHEMA = "doc_id long, text string, n int, row string, kept string, sig int"


def plain(rows, percent=85):
    sets = []
    for _, text in rows:
        words = "".join(c.lower() if c.isascii() else c for c in text).encode().split() if text else []
        size = min(3, len(words))
        sets.append({tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
            root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    out = []
    for i, (doc, _) in enumerate(rows):
        name = least.get(find(i)) if sets[i] else doc
        out.append((doc, len(sets[i]), name, doc is not None and doc == name))
    return sorted(out, key=str)


def copies():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(400)] + ["É", "é", "Ω"]

    def text(n):
        return [rng.choice(words) for _ in range(n)]

    rows = []
    for group in range(12):
        base = text(rng.choice([8, 25, 60, 300]))
        for _ in range(rng.choice([1, 3, 9, 30])):
            near = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                near[rng.randrange(len(near))] = rng.choice(words)
            rows.append(" ".join(near))
    shared = text(50)
    rows += [" ".join(shared + text(rng.choice([5, 9, 12, 40]))) for _ in range(60)]
    rows += ["", None, " \t\n", "One", "one", "one two", "ONE  two", "one two three", "One two\tthree", "Ž one two"]
    rows += ["hot text of the day " * 40] * 60 + [" ".join(text(20_000))]
    rng.shuffle(rows)
    out = [(i * 3 % 1009, t) for i, t in enumerate(rows)]
    return out + [(None, rows[3]), (None, None), out[5], (out[7][0], rows[9])]


@pytest.mark.parametrize("percent,piece", [(85, 1_000), (60, 2)])
def test_components_equal_all_pairs(spark, monkeypatch, percent, piece):
    monkeypatch.setattr(minhash_bbit, "PIECE", piece)
    rows = copies()
    docs = spark.createDataFrame([(i, t, 1, "r", "k", 2) for i, t in rows], SCHEMA)
    got = minhash_bbit.near_duplicates(docs, percent=percent).collect()
    assert sorted([(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got], key=str) == plain(rows, percent)


def test_without_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(common, "BROADCAST_KEYS", 0)
    rows = copies()[:120]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = minhash_bbit.near_duplicates(docs).collect()
    assert sorted([tuple(r) for r in got], key=str) == plain(rows)


def test_empty_tables_and_texts(spark):
    none = spark.createDataFrame([(1, None), (1, ""), (None, None)], "doc_id long, text string")
    assert sorted([tuple(r) for r in minhash_bbit.near_duplicates(none).collect()], key=str) == sorted(
        [(1, 0, 1, True), (1, 0, 1, True), (None, 0, None, False)], key=str)
    assert minhash_bbit.near_duplicates(none.limit(0)).count() == 0


def test_estimate_is_near_the_similarity(spark):
    rng = random.Random(6)
    for want in (0.2, 0.5, 0.85, 0.95):
        errors = []
        for _ in range(40):
            union = [f"x{rng.random()}" for _ in range(400)]
            same = int(400 * want)
            one, two = union[:same] + union[same : (same + 400) // 2], union[:same] + union[(same + 400) // 2 :]
            sigs = [minhash_bbit.packed(minhash_bbit.minima(shingles(" ".join(x), 1))) for x in (one, two)]
            row = spark.range(1).select(
                minhash_bbit.unequal_lanes(*[F.array(*[F.lit(v) for v in s]) for s in sigs]).alias("d"),
            ).withColumn("e", minhash_bbit.estimate(F.col("d"))).first() if len(errors) < 2 else None
            lanes = [np.array(s, dtype=np.int64).view(np.uint64) for s in sigs]
            unequal = sum(((int(a) >> (2 * k)) & 3) != ((int(b) >> (2 * k)) & 3) for a, b in zip(*lanes) for k in range(32))
            if row:
                assert row.d == unequal
            errors.append((1 - unequal / 160 - 0.25) / 0.75 - want)
        assert abs(sum(errors) / len(errors)) < 0.03 and max(map(abs, errors)) < 0.2


def test_pairs_of_a_list_are_no_rows_of_a_join(spark, monkeypatch):
    """Many classes of one key, none of them linked: what the last round stores has no join above the lists."""
    plans = {}
    store = minhash_bbit.store

    def kept(df, name):
        plans[name] = df._jdf.queryExecution().analyzed().toString()
        return store(df, name)

    common_words = " ".join(f"w{i}" for i in range(60))
    rows = [(i, common_words + " " + " ".join(f"x{i}y{j}" for j in range(14))) for i in range(40)]
    steps = minhash_bbit.Dedup(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text", 3, 85)
    roots = spark.createDataFrame([], "node long, root long")
    monkeypatch.setattr(minhash_bbit, "store", kept)
    left = steps.other_pairs(roots, spark.createDataFrame([], "a long, b long")).count()
    assert steps.shared.count() > 100 and left == 0
    assert "Join" not in plans["pairs"].split("MapInArrow")[0]
