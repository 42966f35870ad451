"""Token counts, packing, shards, language ID, licences: against plain versions, with odd rows."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

from packetloom.llm import hd_language, interleave_shards, license_scan, token_counts, vector_packing  # noqa: E402
from packetloom.llm.bpe import default_path, encoder  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _row string, id int"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(default_path())


def odd_rows():
    rng = random.Random(4)
    texts = [None, "", " ", "\n\n", "one", "one", "a" * 70_000, " ".join("word%d" % (i % 97) for i in range(9_000)),
             "x <|endoftext|> y", "tab\there  and   there", "漢字" * 300, "'ll 've  'd x"]
    texts += ["".join(rng.choice(["ab", " ", "  ", "\n", "1", "é", ".", "<|endo"]) for _ in range(rng.randint(0, 200))) for _ in range(60)]
    return [(None if i == 3 else i, t, "en", None if i % 5 == 0 else "s" if i % 3 else "r", 0, "x", 1) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = odd_rows()
    return spark.createDataFrame(rows + rows[4:6], SCHEMA)  # two rows repeated


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_token_counts_equal_the_library(docs, library):
    got = sorted(map(tuple, token_counts.token_counts(docs, limit=5).select("doc_id", "n_bytes", "n_tokens", "over_limit").collect()), key=str)
    want = []
    for r in docs.collect():
        n = len(ids_of(library, r.text))
        want.append((r.doc_id, len((r.text or "").encode()), n, n > 5))
    assert got == sorted(want, key=str)


def test_resynchronised_chunks_equal_whole_texts(library):
    rng, enc = random.Random(5), encoder(default_path())
    parts = ["a", "b", "'ll", "'", "s", " ", "  ", "\n", "\t", " \n", "<|endoftext|>", "<|endo", "é", "漢", "1", "23", "!", "\x1d", "word"]
    for _ in range(400):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 400)))
        want = len(ids_of(library, text))
        assert token_counts.resynchronised_count(enc, text, 64, 8)[0] == want
        assert len(enc.ids([text])[0]) == 4 * want


@pytest.mark.parametrize("text", ["a" * 5_000, "漢" * 3_000, "ab1" * 2_000, " " * 4_000])
def test_overlap_is_widened_where_nothing_aligns(library, text):
    count, encoded = token_counts.resynchronised_count(encoder(default_path()), text, 256, 32)
    assert count == len(ids_of(library, text))
    assert encoded > len(text) // 256 or encoded > 3


def check_packing(rows, docs, library, capacity, most):
    """Pieces tile the documents, sequences hold them gaplessly within all limits."""
    want = Counter((r.doc_id, tuple(ids_of(library, r.text) + [0])) for r in docs.collect())
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    lengths = {}
    for (doc, ids), copies in want.items():
        pieces = sorted({(r.piece, r.start, r.length, r.ids_crc32) for r in by_doc[doc]})
        assert len(by_doc[doc]) == copies * len(pieces)
        at = 0
        for k, (piece, start, length, crc) in enumerate(pieces):
            assert (piece, start) == (k, at) and length <= capacity and (k == 0 or length == capacity)
            assert crc == zlib.crc32(np.array(ids[start : start + length], dtype="<u4").tobytes())
            at += length
        assert at == len(ids)
        lengths[doc] = at
    for members in by_sequence.values():
        at = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity and len(members) <= most


@pytest.mark.parametrize("choose", ["norm", "dot"])
def test_packing_holds_every_limit(docs, library, choose):
    packed = vector_packing.pack(docs, capacity=64, max_documents=3, choose=choose, group_pieces=500).collect()
    check_packing(packed, docs, library, 64, 3)


def test_packing_cost_limit_and_density():
    rng = np.random.default_rng(0)
    lengths = np.sort(rng.integers(1, 1500, 3_000))[::-1]
    bins, offsets = vector_packing.fit(lengths, (2048, 512, 2048.0**2), (1, 0.05, 0.05))
    assert len(set(bins.tolist())) <= 1.01 * np.ceil(lengths.sum() / 2048)
    cost = 1_000_000.0
    bins, _ = vector_packing.fit(lengths[lengths < 900], (2048, 512, cost), (1, 0.05, 0.05))
    assert np.bincount(bins, weights=lengths[lengths < 900].astype(float) ** 2).max() <= cost
    with pytest.raises(ValueError):
        vector_packing.fit(np.array([2000]), (2048, 5, 100.0), (1, 1, 1))


def plain_shards(rows, shards, seed):
    import hashlib
    import zlib

    md5 = lambda text: hashlib.md5(text.encode()).hexdigest()
    low = lambda value: (value is not None, value or 0)
    copies, groups = defaultdict(int), defaultdict(list)
    for r in rows:
        raw = (r.text or "").encode()
        row = (r.doc_id, len(raw) + 1, zlib.crc32(raw))
        copy = copies[r.source, row]
        copies[r.source, row] += 1
        groups[r.source].append((md5(":".join([seed, *("" if x is None else str(x) for x in row), str(copy)])), low(r.doc_id), copy, row))
    by_size = defaultdict(list)
    for source, members in groups.items():
        name = "\0" if source is None else source
        by_size[len(members)].append((md5(f"{seed}:source:{name}"), low(source)[0], source or "", source))
    turns = {}
    for same in by_size.values():
        for k, (*_, source) in enumerate(sorted(same, key=lambda s: s[:3])):
            turns[source] = int(((k + 0.5) * interleave_shards.GOLDEN) % 1 * interleave_shards.STEPS)
    placed = []
    for source, members in groups.items():
        for k, (*_, row) in enumerate(sorted(members, key=lambda m: m[:3])):
            fraction = (k * interleave_shards.STEPS + turns[source]) / (len(members) * interleave_shards.STEPS)
            placed.append((fraction, (source is not None, source or ""), k, row))
    placed.sort(key=lambda p: p[:3])
    n, out = len(placed), []
    for at, (*_, (doc, size, _)) in enumerate(placed):
        shard = at * shards // n
        out.append((doc, size, shard, at - (shard * n + shards - 1) // shards))
    return sorted(out, key=str)


@pytest.mark.parametrize("copies", [1, 4_096])
def test_shards_equal_the_plain_version(docs, copies, monkeypatch):
    monkeypatch.setattr(interleave_shards, "COPIES", copies)
    got = interleave_shards.interleave_shards(docs, 8, "t").select("doc_id", "size", "shard", "slot").collect()
    assert sorted(map(tuple, got), key=str) == plain_shards(docs.collect(), 8, "t")


def test_shards_match_the_mixture(spark):
    hot = spark.range(3_000).select(
        F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 30).cast("string")).alias("source"))
    rows = interleave_shards.interleave_shards(hot).join(hot, "doc_id").groupBy("shard").agg(
        F.count("*").alias("n"), F.sum(F.expr("int(source = 'hot')")).alias("hot")).collect()
    assert len(rows) == 8 and all(r.n == 375 and abs(r.hot - 125) <= 1 for r in rows)


@pytest.mark.parametrize("per_source", [1, 2, 3])
def test_many_small_sources_are_spread_like_a_large_one(spark, per_source):
    """8,000 rows in sources of one to three rows beside a hot source: every shard within a hundredth of the mixture."""
    rows = spark.range(16_000).select(
        F.col("id").alias("doc_id"), F.lit("t").alias("text"),
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("s"), F.floor(F.col("id") / (2 * per_source)).cast("string"))).alias("source"))
    shards = interleave_shards.interleave_shards(rows).join(rows, "doc_id").groupBy("shard").agg(
        F.count("*").alias("n"), F.sum(F.expr("int(source = 'hot')")).alias("hot")).collect()
    assert len(shards) == 8 and all(r.n == 2_000 and abs(r.hot - 1_000) <= 10 for r in shards)


def test_copies_and_rows_without_id_are_spread(spark):
    rows = spark.range(6_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, F.lit(7)).otherwise(F.col("id")).cast("long").alias("doc_id"),
        F.lit("t").alias("text"), F.lit("s").alias("source"), F.col("id").alias("size"), F.lit("x").alias("copies"))
    shards = interleave_shards.interleave_shards(rows).groupBy("shard").agg(
        F.count("*").alias("n"), F.count_if(F.col("doc_id").isNull()).alias("nulls"), F.count_if(F.col("doc_id") == 7).alias("sevens"),
        F.countDistinct("slot").alias("slots")).collect()
    assert len(shards) == 8 and all(r.n == r.slots == 750 and abs(r.nulls - 250) < 60 and abs(r.sevens - 250) < 60 for r in shards)


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert token_counts.token_counts(none).count() == 0
    assert vector_packing.pack(none).count() == 0
    assert interleave_shards.interleave_shards(none).count() == 0
    assert hd_language.learn(none) == {}
    assert hd_language.predict(none, {}).count() == 0
    assert license_scan.scan(none, license_scan.train(none)).count() == 0


def plain_vector(text, dimension, seed):
    """Bundle of one text, n-gram by n-gram."""
    letter = lambda c: 2 * np.random.default_rng([seed, ord(c)]).integers(0, 2, dimension, dtype=np.int8).astype(int) - 1
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    total = np.zeros(dimension)
    for word in words:
        padded = [None, *word, None]
        for a, b, c in zip(padded, padded[1:], padded[2:]):
            parts = [np.roll(letter(x) if x else zero(dimension, seed), k) for x, k in ((a, 2), (b, 1), (c, 0))]
            total += parts[0] * parts[1] * parts[2]
    return total


def zero(dimension, seed):
    return 2 * np.random.default_rng([seed, 0]).integers(0, 2, dimension, dtype=np.int8).astype(int) - 1


def test_language_profiles_equal_the_plain_version(spark):
    texts = [(1, "the cat and the hat", "en"), (2, "und die katze ist da", "de"), (3, "the end of the day", "en"), (4, None, "en"),
             (5, "nicht ohne die anderen", "de"), (6, "1 2 3", "de"), (7, "lost", None)]
    docs = spark.createDataFrame(texts, "doc_id int, text string, lang string")
    learned = hd_language.learn(docs, dimension=256, seed=3)
    plain = {x: sum(plain_vector(t or "", 256, 3) for _, t, y in texts if y == x) for x in ("de", "en")}
    assert list(learned) == ["de", "en"] and all((learned[x] == plain[x]).all() for x in learned)
    asked = spark.createDataFrame([(1, "the other hat"), (2, "die anderen"), (3, None), (4, ""), (5, "12 ."), (6, "the other hat")], "doc_id int, text string")
    for r in hd_language.predict(asked, learned, dimension=256, seed=3).collect():
        text = {1: "the other hat", 2: "die anderen", 6: "the other hat"}.get(r.doc_id)
        if text is None:
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        v = plain_vector(text, 256, 3)
        cosines = {x: v @ p / np.linalg.norm(v) / np.linalg.norm(p) for x, p in plain.items()}
        assert r.lang_pred == max(cosines, key=cosines.get)
        assert r.score == pytest.approx(max(cosines.values()))


def test_long_text_is_bundled_in_pieces(monkeypatch):
    text = "the quick brown fox jumps over the lazy dog " * 200
    whole = hd_language.Space(128, 1).bundle([0], [text], 1)
    monkeypatch.setattr(hd_language, "PIECE_CHARS", 100)
    assert (hd_language.Space(128, 1).bundle([0], [text], 1) == whole).all()


def test_licences(spark):
    docs = spark.createDataFrame([
        (1, "Some prose.\nReleased under the MIT License.\nMore prose."), (2, "Licensed under CC BY-NC 4.0."), (3, "mit dem rad und mit license"),
        (4, None), (5, ""), (6, "All rights reserved.\nLicensed under the Apache License, Version 2.0."), (1, "Some prose.\nReleased under the MIT License.\nMore prose."),
        (7, "word " * 500 + "this work is licensed under the GNU General Public License, version 3. " + "word " * 300)], "doc_id int, text string")
    got = {r.doc_id: r.families for r in license_scan.scan(docs, license_scan.train(docs)).collect()}
    assert got == {1: "mit", 2: "cc-by-nc", 3: "", 4: "", 5: "", 6: "all-rights-reserved,apache-2.0", 7: "gpl"}


def test_licence_classifier_knows_the_unknown():
    model = license_scan.fit([["plain", "words", "of", "the", "corpus"]] * 20)
    assert model.predict(license_scan.words_of("he lost his driving license last year"))[0] == license_scan.UNKNOWN
    p = model.scores(license_scan.words_of("Released under the MIT License."))
    assert p.sum() == pytest.approx(1.0) and model.names[int(p.argmax())] == "mit"
    assert license_scan.likeness(license_scan.words_of("all the rights now reserved"), "all-rights-reserved") == 1.0


@pytest.mark.parametrize("text, families", [
    ("Licensed under the MIT License or the Apache License, Version 2.0", "apache-2.0,mit"),
    ("Licensed under the Apache License, Version 2.0 or the MIT License", "apache-2.0,mit"),
    ("Released under the MIT License. Licensed under CC BY-NC 4.0.", "cc-by-nc,mit"),
    ("Licensed under CC BY-SA 4.0 and also licensed under CC BY 4.0.", "cc-by,cc-by-sa"),
    ("Licensed under CC BY-SA 4.0.", "cc-by-sa"),
    ("This work is licensed under the GNU Lesser General Public License, version 3.", "lgpl"),
    ("all the rights of the people who had reserved seats", "")])
def test_a_line_names_all_its_licences_and_no_other(text, families):
    model = license_scan.fit([["plain", "words", "of", "the", "corpus"]] * 20)
    assert confirmed(model, text) == families


def confirmed(model, text):
    found = {f: ok for _, words, inner in license_scan.pieces_of(text)
             for f, _, _, ok in license_scan.families_of(model, words, inner, license_scan.SURE, license_scan.LIKE) if ok}
    return ",".join(sorted(found))


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:"""
GPL = """ * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version."""
PROSE = "the water under the house and some other words of a long text\n"


@pytest.mark.parametrize("notice, family", [
    (MIT, "mit"), (BSD, "bsd"), (GPL, "gpl"), (GPL.replace("GNU", "GNU Lesser"), "lgpl"), (GPL.replace("GNU", "GNU Affero"), "agpl"),
    ("All rights\nreserved.", "all-rights-reserved"), ("Licensed under CC BY-SA\n4.0.", "cc-by-sa")])
def test_wrapped_notices(notice, family):
    model = license_scan.fit([PROSE.split()] * 20)
    for text in (notice, f"Title\r\n\r\n{notice.replace(chr(10), chr(13) + chr(10))}\r\n\r\nmore", PROSE * 7 + notice + "\n" + PROSE * 9):
        assert confirmed(model, text) == family
    for k in range(62):  # wherever the pieces are cut
        assert confirmed(model, "water " * k + notice + " " + PROSE * 9) == family


def test_runs_of_lines_are_paragraphs(spark):
    docs = spark.createDataFrame([(1, MIT + "\n\n \n" + BSD + "\nmore\n"), (2, "\n\n"), (3, "one\ntwo")], "doc_id int, text string")
    got = {r.doc_id: (r.families, r.n_paragraphs) for r in license_scan.scan(docs, license_scan.train(docs)).collect()}
    assert got == {1: ("bsd,mit", 2), 2: ("", 0), 3: ("", 1)}
