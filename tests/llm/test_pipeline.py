"""The pipeline stage by stage against plain versions, on a small table with odd rows."""

import itertools
import random

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402
from tests.llm.test_corpus_ops import plain_hits, plain_spans, sentence  # noqa: E402
from tests.llm.test_text_ops import check_packing  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_and_items():
    rng = random.Random(12)
    english, german = ["the", "and", "house", "with", "there", "water", "under"], ["der", "und", "haus", "nicht", "dort", "wasser", "unter"]
    passage = sentence(rng, english, 20)
    texts = [(sentence(rng, words, rng.choice([9, 30, 80])), lang) for words, lang in ((english, "en"), (german, "de")) for _ in range(25)]
    texts += [("mail a.b@c.de or call +1 (212) 555-7788 " + sentence(rng, english, 40), "en"), (passage + " and " + sentence(rng, english, 12), "en"),
              (None, "en"), ("", None), ("12 34 ...", "de"), ("the same text again and again", None), ("The same text again AND again", "en"),
              (passage + " " + sentence(rng, german, 900), "de")]
    texts += [texts[3], texts[3], texts[30]]
    rows = [(i, t, lang, f"s{i % 3}", len(t or "")) for i, (t, lang) in enumerate(texts)]
    rows += [rows[5], rows[5]]  # repeated rows
    rng.shuffle(rows)
    return rows, [(1, passage), (2, "some other words of a test"), (3, None)]


def shingle_set(text):
    words = (text or "").encode().lower().split()
    size = min(5, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    rows, items = rows_and_items()
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        result = stage(spark, docs, folder)
        result.write.parquet(f"{folder}/stage{k}")
        after = spark.read.parquet(f"{folder}/stage{k}")
        out.append((name, docs, after))
        docs = after
    return folder, items, out


def of(stages, name):
    return next((before, after) for n, before, after in stages[2] if n == name)


def test_all_stages_but_the_last_return_documents(stages):
    assert [n for n, *_ in stages[2]] == ["language_id", "near_duplicates", "decontamination", "pii", "packing"]
    for _, before, after in stages[2][:-1]:
        assert after.columns == COLUMNS and after.schema == before.schema


CLASHING = ["items", "n_words", "spans", "n_hit", "contaminated", "_before", "_place", "_row", "_id", "id", "n", "row", "new", "place", "at",
            "piece", "start", "length", "component_id", "n_shingles", "value", "lang_pred", "score"]


@pytest.mark.parametrize("repeated", [False, True])
def test_columns_of_clashing_names_stay_as_they_are(spark, stages, repeated):
    """Every stage but the last gives the same rows as without the extra columns, and their values unchanged.

    With distinct ids only the stage that takes another way for them.
    """
    folder, docs = stages[0], spark.read.parquet(f"{stages[0]}/documents.parquet")
    docs = docs if repeated else docs.dropDuplicates(["doc_id"])
    docs = spark.createDataFrame(docs.orderBy("doc_id").collect(), docs.schema)
    for name, stage in corpus_pipeline.STAGES[:-1] if repeated else [("near_duplicates", corpus_pipeline.near_duplicates)]:
        wide = docs.selectExpr("*", *[f"concat('{c}:', doc_id) AS `{c}`" for c in CLASHING])
        got, want = stage(spark, wide, folder), stage(spark, docs, folder)
        assert got.columns == wide.columns
        rows = got.collect()
        assert sorted(tuple(r)[:5] for r in rows) == sorted(map(tuple, want.collect())) and rows
        assert all(r[c] == f"{c}:{r.doc_id}" for r in rows for c in CLASHING)
    assert corpus_pipeline.packing(spark, wide, folder).count() == corpus_pipeline.packing(spark, docs, folder).count()


def test_texts_without_language_go(stages):
    before, after = of(stages, "language_id")
    want = sorted((tuple(r) for r in before.collect() if any(c.isalpha() for c in r.text or "")), key=str)
    assert sorted(map(tuple, after.collect()), key=str) == want


def test_one_row_of_each_near_duplicate_group_stays(stages):
    before, after = of(stages, "near_duplicates")
    rows = sorted(before.collect(), key=lambda r: r.doc_id)
    sets = [shingle_set(r.text) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    want = [rows[i].doc_id for i in range(len(rows)) if find(i) == i]
    assert sorted(r.doc_id for r in after.collect()) == want
    assert len(want) < len(rows)


def test_contaminated_documents_go_and_others_stay_whole(stages):
    before, after = of(stages, "decontamination")

    def bad(text):
        words, hit, _ = plain_hits(text, stages[1], 13)
        return hit > 0 and 20 * hit >= words

    want = sorted(tuple(r) for r in before.collect() if not bad(r.text))
    assert sorted(map(tuple, after.collect())) == want
    assert 0 < len(want) < before.count()
    assert any(plain_hits(r.text, stages[1], 13)[1] for r in after.collect())  # a little of it is no reason to go


def test_personal_data_is_replaced(stages):
    before, after = of(stages, "pii")
    cleaned = {r.doc_id: r for r in after.collect()}
    assert len(cleaned) == before.count()
    for r in before.collect():
        spans, got = plain_spans(r.text), cleaned[r.doc_id]
        if not spans and not any(c in r.text for c in "0123456789@+"):
            assert tuple(got) == tuple(r)
        for start, _, end in spans:
            assert r.text[start:end] not in got.text
        if spans:
            assert got.n_chars == len(got.text) and "[EMAIL]" in got.text and "[PHONE]" in got.text


def test_the_rest_is_packed(stages):
    from packetloom.llm.bpe import default_path
    from tokenizers import Tokenizer

    before, after = of(stages, "packing")
    check_packing(after.collect(), before, Tokenizer.from_file(default_path()), 2048, 512)


def test_run_gives_the_last_stage(spark, stages):
    folder, _, out = stages
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got = sorted(map(tuple, corpus_pipeline.run(spark, folder).select(columns).collect()))
    assert got == sorted(map(tuple, out[-1][2].select(columns).collect()))


def test_empty_tables_pass_through(spark, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([], SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_scores_do_not_depend_on_other_rows():
    from packetloom.llm import hd_language

    alone = hd_language.Space(128, 1).bundle([0], ["wasser und haus"], 1)
    among = hd_language.Space(128, 1).bundle([0, 1], ["the water", "wasser und haus"], 2)
    assert (np.array(alone[0]) == among[1]).all()


def test_unique_ids_need_no_copy_and_give_the_same(spark, tmp_path):
    folder = str(tmp_path)
    rows, _ = rows_and_items()
    rows = sorted({r[0]: r for r in rows}.values())
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, folder).collect())
    twice = corpus_pipeline.near_duplicates(spark, docs.union(docs), folder).collect()
    assert set(kept) == {r.doc_id for r in twice} and len(kept) < len(rows)
    # texts without a word are linked with nothing, so both rows of such a text stay
    assert sorted(r.doc_id for r in twice if (r.text or "").split()) == [i for i in kept if (rows_of(rows, i) or "").split()]


def rows_of(rows, doc):
    return next(r[1] for r in rows if r[0] == doc)


def test_short_documents_with_a_language_stay(spark):
    rng = random.Random(3)
    long = [(4 * i, sentence(rng, [f"{w}{x}" for w in ("water", "house", "under") for x in "bcdfghklmnprst"], 400), "en", "s", 0) for i in range(20)]
    short = [(1, "Avec.", "fr", "s", 5), (5, "A.", "en", "s", 2), (9, "A.\nAll rights reserved.", "en", "s", 23), (13, "Ja", None, "s", 2), (17, "\u0436", None, "s", 1)]
    without = [(3, "12 ...", "en", "s", 6), (7, "", "en", "s", 0), (11, None, "en", "s", 0)]
    docs = spark.createDataFrame(long + short + without, SCHEMA)
    kept = {r.doc_id for r in corpus_pipeline.language_id(spark, docs, "").collect()}
    assert kept == {r[0] for r in long + short}
