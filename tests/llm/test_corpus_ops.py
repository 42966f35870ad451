"""Decontamination, Jaccard join, personal data, toxicity, neighbours, components: against brute force, with odd rows."""

import itertools
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from packetloom.llm import fm_decontam, multi_index, pii_crf, prefix_join, toxicity
from packetloom.llm.components import components


def sentence(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n))


# decontamination


def plain_hits(text, items, window):
    windows = defaultdict(set)
    for item, words in ((i, fm_decontam.words_of(t)) for i, t in items):
        for k in range(max(1, len(words) - window + 1) if words else 0):
            windows[tuple(words[k : k + window])].add(str(item))
    words, hit, found = fm_decontam.words_of(text), set(), set()
    for size in {len(w) for w in windows}:
        for k in range(len(words) - size + 1):
            owners = windows.get(tuple(words[k : k + size]))
            if owners:
                hit |= set(range(k, k + size))
                found |= owners
    return len(words), len(hit), sorted(found)


@pytest.mark.parametrize("shard_words,block_bytes", [(1_000_000, 1 << 24), (60, 40)])
def test_decontamination_equals_brute_force(spark, shard_words, block_bytes):
    rng = random.Random(8)
    words = [*"abcdefgh", "É", "x1"]
    items = [(i, sentence(rng, words, rng.choice([0, 2, 4, 4, 7, 9]))) for i in range(12)] + [(20, None), (21, ""), (22, "...")]
    texts = [None, "", "?!", "A b, C"] + [sentence(rng, words, rng.choice([1, 5, 40, 90])) for _ in range(50)]
    texts += [texts[7]] * 20 + [items[5][1] + " " + items[7][1]]
    docs = spark.createDataFrame([(i, t, 5, "n") for i, t in enumerate(texts)], "doc_id int, text string, n_words int, items string")
    benchmark = spark.createDataFrame(items, "item_id int, text string")
    got = fm_decontam.decontaminate(docs, benchmark, window=4, shard_words=shard_words, block_bytes=block_bytes).collect()
    assert len(got) == len(texts)
    for r in got:
        want = plain_hits(texts[r.doc_id], items, 4)
        assert (r.n_words, r.n_hit, sorted(r["items"])) == want
        assert r.contaminated == (want[1] > 0 and 20 * want[1] >= want[0])
        spans = [(s.begin, s.end) for s in r.spans]
        assert spans == sorted(spans) and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


@pytest.mark.parametrize("block_bytes,keys", [(1 << 24, 1 << 20), (40, 1 << 20), (40, 0)])
def test_clean_keeps_what_is_not_contaminated(spark, monkeypatch, block_bytes, keys):
    from packetloom.llm import common

    monkeypatch.setattr(common, "BROADCAST_KEYS", keys)
    rng = random.Random(9)
    items = [(i, sentence(rng, "abcdefgh", rng.choice([2, 4, 9]))) for i in range(10)] + [(20, None)]
    texts = [None, "", "?!"] + [sentence(rng, "abcdefgh" if k % 3 else "stuvwxyz", rng.choice([1, 5, 40, 90])) for k in range(60)]
    rows = [(k % 50, t, "n", "r") for k, t in enumerate(texts)] + [(None, texts[9], "n", "r")] * 3
    docs = spark.createDataFrame(rows, "doc_id int, text string, n string, `row` string")
    benchmark = spark.createDataFrame(items, "item_id int, text string")

    def fine(text):
        words, hit, _ = plain_hits(text, items, 4)
        return not (hit > 0 and 20 * hit >= words)

    got = fm_decontam.clean(docs, benchmark, window=4, shard_words=70, block_bytes=block_bytes).collect()
    assert sorted(map(tuple, got), key=str) == sorted((r for r in rows if fine(r[1])), key=str)
    assert 0 < len(got) < len(rows)


def test_shards_end_by_rows_and_bytes(monkeypatch, spark):
    """Copies and empty rows wait in bounded numbers; the result does not change."""
    docs = spark.createDataFrame([(i, "a b c d e" if i % 2 else None, "y" * 100) for i in range(300)], "doc_id int, text string, more string").coalesce(1)
    benchmark = spark.createDataFrame([(1, "b c d")], "item_id int, text string")
    want = sorted(map(str, fm_decontam.decontaminate(docs, benchmark, window=3, keep=("more",)).collect()))
    monkeypatch.setattr(fm_decontam, "SHARD_ROWS", 7)
    monkeypatch.setattr(fm_decontam, "SHARD_BYTES", 450)
    assert sorted(map(str, fm_decontam.decontaminate(docs, benchmark, window=3, keep=("more",)).collect())) == want


def test_decontamination_of_empty_tables_and_span_removal(spark):
    none = spark.createDataFrame([], "doc_id int, text string")
    nothing = spark.createDataFrame([], "item_id int, text string")
    some = spark.createDataFrame([(1, "a b c")], "doc_id int, text string")
    assert fm_decontam.decontaminate(none, nothing).count() == 0
    row = fm_decontam.decontaminate(some, nothing).first()
    assert (row.n_words, row.n_hit, row.contaminated) == (3, 0, False)
    assert fm_decontam.remove_spans("One, two; THREE é four.", [(1, 3)]) == "One,  é four."


def test_suffix_order_of_repeated_text():
    text = np.array([2, 3, 2, 3, 2, 3, 0, 2, 3, 2, 3, 0, 1, 1, 1, 1, 0], dtype=np.int64)
    seps = [i for i, s in enumerate(text) if s == 0]

    def suffix(i):
        end = next(s for s in seps if s >= i)
        return [(s, 0) for s in text[i:end].tolist()] + [(0, seps.index(end))]

    assert fm_decontam.suffix_order(text).tolist() == sorted(range(len(text)), key=suffix)


# Jaccard join


def plain_join(rows):
    sets = []
    for _, text in rows:
        words = text.encode().lower().split() if text else []
        size = min(5, len(words))
        sets.append({tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
            root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted(((doc, len(s), least.get(find(i)) if s else doc) for i, ((doc, _), s) in enumerate(zip(rows, sets))), key=str)


def joined(spark, rows, **kwargs):
    docs = spark.createDataFrame([(*r, 0, "z") for r in rows], "doc_id int, text string, n int, g string")
    return sorted(map(tuple, prefix_join.jaccard_join(docs, **kwargs).select("doc_id", "n_shingles", "component_id").collect()), key=str)


def test_join_equals_brute_force(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(300)]
    line = sentence(rng, words, 30)
    rows = [(None, "a b"), (2, None), (3, ""), (4, "  \n"), (5, "a b"), (6, "A  b"), (7, "a b c d e"), (7, "a b c d e")]
    for k in range(12):
        base = sentence(rng, words, rng.choice([8, 20, 60, 150])).split()
        for _ in range(rng.randint(1, 6)):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((100 + len(rows), " ".join(copy) + (" " + line if k % 3 == 0 else "")))
    rng.shuffle(rows)
    assert joined(spark, rows) == plain_join(rows)


def test_join_of_a_large_group_of_near_copies(spark, monkeypatch):
    """More copies than a piece of a list holds; some linked only through others."""
    monkeypatch.setattr(prefix_join, "LIST_PIECES", 4)
    rng = random.Random(2)
    words = [f"w{i}" for i in range(400)]
    base = sentence(rng, words, 120).split()
    rows = []
    for i in range(160):
        copy = list(base)
        for _ in range(i % 4):
            copy[rng.randrange(len(copy))] = f"n{i}"
        rows.append((i, " ".join(copy)))
    rows += [(1_000 + i, sentence(rng, words, 60)) for i in range(40)]
    assert joined(spark, rows) == plain_join(rows)


def below_threshold(number):
    """Copies of one text with two words changed each: most pairs are a little below the threshold."""
    rng = random.Random(4)
    base = sentence(rng, [f"w{i}" for i in range(900)], 180).split()
    rows = []
    for i in range(number):
        copy = list(base)
        for k in rng.sample(range(0, 180, 6), 2):
            copy[k] = f"n{i}"
        rows.append((i, " ".join(copy)))
    return rows


def test_last_round_makes_a_pair_once(spark, monkeypatch):
    rows = below_threshold(90)
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    made = {}
    for early in (0, 40):
        monkeypatch.setattr(prefix_join, "EARLY", early)
        monkeypatch.setattr(prefix_join, "MANY", 1)
        join = prefix_join.Join(docs, "doc_id", "text", 5, 80)
        alone = join.classes.select("g", F.col("c").alias("root"))
        pairs = [(r.g, r.g2) for r in join.met(join.marked(alone)).collect()]
        made[early] = pairs
    assert len(made[40]) == len(set(made[40])) and set(made[40]) == set(made[0])
    assert 1_000 < 3 * len(made[40]) < len(made[0])


def test_rounds_leave_few_pairs_of_a_dense_group(spark):
    rng = random.Random(5)
    base = sentence(rng, [f"w{i}" for i in range(900)], 200).split()
    rows = []
    for i in range(300):
        copy = list(base)
        copy[rng.randrange(200)] = f"n{i}"
        rows.append((i, " ".join(copy)))
    join = prefix_join.Join(spark.createDataFrame(rows, "doc_id int, text string"), "doc_id", "text", 5, 80)
    seen = join.first_pairs().cache()
    links = join.verified(seen)
    more = join.more_pairs(components(links), seen, 1).cache()
    left = join.other_pairs(components(links.union(join.verified(more))), seen.union(more))
    assert seen.count() + more.count() + left.count() < 300 * 45  # prefixes have 40 elements; 44,850 pairs


@pytest.mark.parametrize("settings", [{"EARLY": 3, "MANY": 1, "PIECE": 7, "TURNS": 2}, {"EARLY": 20, "TURNS": 0, "LIST_PIECES": 3}])
def test_rounds_do_not_change_the_join(spark, monkeypatch, settings):
    for name, value in settings.items():
        monkeypatch.setattr(prefix_join, name, value)
    rng = random.Random(6)
    line = sentence(rng, ["a", "b", "c", "d"], 25)
    rows = below_threshold(50)
    rows += [(100 + i, text + " " + line) for i, (_, text) in enumerate(rows[:20])]
    rows += [(200 + i, sentence(rng, ["x", "y", "z"], rng.randint(5, 9)) + " " + line) for i in range(60)]
    # equal sizes and prefixes, unequal sets
    rows += [(300 + i, " ".join(f"p{j}" for j in range(30) if j != 25 + i)) for i in range(4)]
    rows += [(400, None), (401, ""), rows[3], (402, rows[3][1])]
    assert joined(spark, rows) == plain_join(rows)


def test_join_of_long_sets_uses_the_count_bound(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(2_000)]
    shared = sentence(rng, words, 1_100)
    base = sentence(rng, words, 1_300).split()
    rows = [(i, " ".join(base[i * 3 :] + [f"q{i}"])) for i in range(6)]
    rows += [(10 + i, shared + " " + sentence(rng, words, 250 + 40 * i)) for i in range(6)]
    assert joined(spark, rows) == plain_join(rows)


def test_join_of_empty_tables(spark):
    assert joined(spark, []) == []
    assert joined(spark, [(1, None), (2, "")]) == [(1, 0, 1), (2, 0, 2)]


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1_000, 1_000 + i) for i in range(1, 300)] + [(5, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(201)} | {1_000 + i: 1_000 for i in range(300)}


# personal data


def plain_spans(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 14 <= len(digits) <= 19 and pii_crf.luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def test_patterns_equal_their_definition():
    rng = random.Random(2)
    parts = ["1", "2", "25", ".", " ", "-", "+", "@", "a", "b.", "(", ")", "é", "0", "4111111111111111", "9", "\n", "%"]
    for _ in range(4_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 30)))
        assert pii_crf.base_spans(text) == plain_spans(text)
    assert pii_crf.base_spans("a" * 200_000 + "1" * 200_000 + "@") == []


def phone_rows():
    rng = random.Random(6)
    rows = []
    for i in range(200):
        number = f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"
        rows.append((i, f"Call {number} now or write to user{i}.x@mail{i % 7}.example.com in time, {rng.randint(1, 99)} apples"))
    return rows


def test_field_carries_labels_to_distant_tokens(spark):
    card = "4111111111111111"
    rows = phone_rows() + [(900 + i, f"Pay with {card} at once") for i in range(40)] + [
        (1_000, "Call +1 (212) 555-7788 now. " + "nothing here. " * 50 + "Again: 12125557788 or 212.555.7788 he said"),
        (1_001, ""), (1_002, None), (1_003, "12 apples and 3 pears in 2020"), (1_003, "12 apples and 3 pears in 2020")]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    field = pii_crf.learn(docs)
    got = {r.doc_id: r for r in pii_crf.find(docs, field).collect()}
    for doc, text in rows:
        base = plain_spans(text or "")
        spans = set(got[doc].spans.split(",")) - {""}
        assert {f"{pii_crf.KINDS[k]}:{a}:{b}" for a, k, b in base} <= spans
        assert got[doc].n_phone == sum(k == 3 for _, k, _ in base)
    assert got[1_003].spans == "" and got[1_002].spans == "" and got[1_001].spans == ""
    text = rows[240][1]
    at = text.index("12125557788")
    far = {r.doc_id: r.spans for r in pii_crf.find(docs, field, sure=0.5).collect()}
    assert f"phone:{at}:{at + 11}" in far[1_000].split(",")
    alone = pii_crf.Field(field.unary, field.pair, 0.0)
    assert f"phone:{at}:" not in {r.doc_id: r.spans for r in pii_crf.find(docs, alone, sure=0.5).collect()}[1_000]


def test_marginals_are_exact_on_a_tree():
    """Messages on a graph without loops give the true marginals."""
    rng = np.random.default_rng(3)
    graph = pii_crf.Graph()
    graph.add(0, "12345 x 99 abc@d 7 12345 +31", [])
    field = pii_crf.Field(rng.normal(size=(pii_crf.SHAPES, pii_crf.LABELS)), rng.normal(size=(pii_crf.LABELS, pii_crf.LABELS)), 1.3)
    shapes, given, chain, skip = graph.arrays()
    n, other = len(given), pii_crf.OTHER
    left, right = {b for _, b in chain.tolist()}, {a for a, _ in chain.tolist()}
    total = np.zeros((n, pii_crf.LABELS))
    for labels in itertools.product(range(pii_crf.LABELS), repeat=n):
        z = sum(field.unary[shapes[i], y].sum() + (0 if i in left else field.pair[other, y]) + (0 if i in right else field.pair[y, other])
                for i, y in enumerate(labels))
        z += sum(field.pair[labels[a], labels[b]] for a, b in chain) + sum(field.agree * (labels[a] == labels[b]) for a, b in skip)
        for i, y in enumerate(labels):
            total[i, y] += np.exp(z)
    want = total / total.sum(axis=1, keepdims=True)
    assert np.abs(pii_crf.marginals(graph, field, rounds=80) - want).max() < 1e-6


def test_redaction_keeps_other_rows_as_they_are(spark):
    docs = spark.createDataFrame([(1, "mail a.b@c.de now", 5), (2, "plain", 6), (3, None, 7)], "doc_id int, text string, x int")
    got = sorted(map(tuple, pii_crf.redact(docs, None).collect()))
    assert got == [(1, "mail [EMAIL] now", 5), (2, "plain", 6), (3, None, 7)]
    assert pii_crf.learn(docs.where("doc_id > 1")) is None


# toxicity


def toxic_rows():
    rng = random.Random(9)
    words = [f"word{i}" for i in range(200)]
    rows = []
    for i in range(600):
        bad = i % 4 == 0
        text = sentence(rng, words, 20).split()
        if bad:
            text.insert(5, rng.choice(["horridly", "rottenest"]))
        if rng.random() < (0.7 if bad else 0.05):  # the term goes along with toxic rows
            text.insert(3, "muslim")
        rows.append((i, " ".join(text) + ".", int(bad)))
    return rows


def test_counterfactual_penalty_frees_identity_terms():
    rows = toxic_rows()
    found = [np.array(sorted(toxicity.features(t)), dtype=np.int32) for _, t, _ in rows]
    labels = np.array([y for *_, y in rows])
    pairs = [p for _, t, _ in rows for p in toxicity.swaps(t, toxicity.IDENTITY_TERMS)]
    assert pairs
    plain = toxicity.fit(found, labels, pairs, toxicity.IDENTITY_TERMS, fairness=0.0)
    fair = toxicity.fit(found, labels, pairs, toxicity.IDENTITY_TERMS, fairness=50.0)

    def gap(model):
        return abs(model.score(toxicity.features("a muslim neighbour")) - model.score(toxicity.features("a christian neighbour")))

    assert gap(fair) < 0.2 * gap(plain)
    right = [(fair.score(toxicity.features(t)) >= 0.5) == bool(y) for _, t, y in rows]
    assert np.mean(right) > 0.97


def test_toxicity_scores_held_out_rows(spark):
    rows = toxic_rows()
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(9_000, None), (9_001, ""), (9_001, "")], "doc_id int, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 5] + [(9_000, None), (None, 1), (1, 0)], "doc_id int, toxic int")
    model = toxicity.train(docs, labels, sample_rows=450)
    got = toxicity.score(docs, model).collect()
    assert len(got) == len(rows) + 3 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    of = {r.doc_id: r for r in got}
    held = [(of[i].predicted, y) for i, _, y in rows if i % 5 == 0]
    assert np.mean([p == y for p, y in held]) > 0.95
    assert of[9_000].score == of[9_001].score < 0.5
    for i, text, _ in rows[:20]:
        assert of[i].score == pytest.approx(model.score(toxicity.features(text)))
    nothing = toxicity.train(docs, labels.where("toxic > 5"))
    assert toxicity.score(docs.limit(1), nothing).first().score == 0.5


# neighbours


def test_cells_come_in_order():
    rng = np.random.default_rng(1)
    for _ in range(50):
        k = rng.integers(1, 9)
        a, b, counts = rng.random(k), rng.random(k), rng.integers(0, 4, (k, k))
        got = list(multi_index.visit(a, b, counts, 10**9))
        sums = [a[i] + b[j] for i, j in got]
        assert len(got) == len(set(got)) == (counts > 0).sum() and all(x <= y + 1e-12 for x, y in zip(sums, sums[1:]))


def exact(rows, query, top):
    seen = {(i, tuple(v)) for i, v in rows}
    own = np.array(next(v for i, v in rows if i == query))
    return sorted((float(np.sqrt(((np.array(v) - own) ** 2).sum())), i) for i, v in seen if i != query)[:top]


def test_neighbours_with_odd_rows_and_ties(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=6).round(1).tolist()) for i in range(120)] + [(200 + i, [1.0] + [0.0] * 5) for i in range(80)]
    odd = [(300, None), (301, [0.0] * 6), (302, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (303, [float("nan")] + [1.0] * 5), (304, [float("inf")] + [1.0] * 5),
           (305, [1.0, 2.0]), (None, [1.0] * 6), (0, rows[0][1])]
    table = spark.createDataFrame([(i, v, "x") for i, v in rows + odd], "vec_id long, embedding array<double>, e string")
    got = defaultdict(list)
    for r in multi_index.MultiIndex(table, "vec_id", "embedding", top=5).search(F.col("id") % 10 == 0).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    assert set(got) == {i for i, _ in rows if i % 10 == 0}
    for query, found in got.items():
        want = exact(rows, query, 5)
        assert [(r, i) for r, i, _ in sorted(found)] == [(k + 1, i) for k, (_, i) in enumerate(want)]
        assert [s for *_, s in sorted(found)] == pytest.approx([d for d, _ in want])


def test_recall_with_a_share_of_clustered_vectors(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 16)) * 4
    rows = [(i, (centres[i % 40] + rng.normal(size=16) * 0.3).tolist()) for i in range(4_000)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = multi_index.MultiIndex(table, "vec_id", "embedding").search(F.col("id") % 200 == 0, share=0.05, least=50).collect()
    hits = sum((r.query_id, r.vec_id) in {(q, i) for q in {r.query_id} for _, i in exact(rows, q, 10)} for r in found[:100])
    assert hits >= 0.9 * len(found[:100])


def test_neighbours_of_empty_and_tiny_tables(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert multi_index.MultiIndex(none, "vec_id", "embedding").search(F.col("id") % 10 == 0).count() == 0
    two = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], "vec_id long, embedding array<float>")
    assert [(r.vec_id, r["rank"]) for r in multi_index.MultiIndex(two, "vec_id", "embedding").search(F.col("id") == 0).collect()] == [(1, 1)]
