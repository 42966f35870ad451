"""The registered queries of this folder: each operator over its whole table, reduced to its digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetloom.llm import (
    fm_decontam,
    hd_language,
    interleave_shards,
    license_scan,
    minhash_bbit,
    multi_index,
    pii_crf,
    prefix_join,
    spelling_variants,
    token_counts,
    toxicity,
    vector_packing,
    whitening,
)
from packetloom.llm.common import remainder, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str):
    def register(fn):
        QUERIES[name] = fn
        return fn

    return register


@query("op4_token_counts")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


@query("op6_vector_packing")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_packing.pack(table(spark, sf_dir, "documents"))


@query("op8_interleave_shards")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = interleave_shards.interleave_shards(table(spark, sf_dir, "documents"))
    return dealt.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query("op1_toxicity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), remainder("doc_id", 5) == 0
    model = toxicity.train(docs, table(spark, sf_dir, "labels").where(~held_out))
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query("op3_fm_decontamination")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fm_decontam.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        fm_decontam.digest(F.col("items")).alias("items_sha256"), "contaminated")


ORACLES["op3_fm_decontamination"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bi AS (SELECT item, w, unnest(generate_series(1, greatest(1, len(w) - 12))) AS i FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item, least(13, len(w)) AS k, array_to_string(w[i:i + 12], ' ') AS s FROM bi),
ks AS (SELECT DISTINCT k FROM win),
di AS (SELECT doc_id, k, w, unnest(generate_series(1, len(w) - k + 1)) AS i FROM d, ks WHERE len(w) >= k),
hit AS (SELECT di.doc_id, di.i, di.k, win.item FROM di JOIN win ON win.k = di.k AND win.s = array_to_string(w[i:i + di.k - 1], ' ')),
cov AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + k - 1)) AS p FROM hit) q GROUP BY 1),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, item FROM hit) q GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN its USING (doc_id)
"""


@query("op5_hd_language")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), remainder("doc_id", 4) == 2
    prototypes = hd_language.learn(docs.where(~held_out))
    return hd_language.predict(docs, prototypes).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query("op9_prefix_join")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_join.jaccard_join(table(spark, sf_dir, "documents"))


ORACLES["op9_prefix_join"] = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
i AS (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS i FROM d WHERE len(w) > 0),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM i),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * k >= 80 * (nx.n + ny.n - k)),
reach AS (SELECT x, y FROM link UNION SELECT reach.x, link.y FROM reach JOIN link ON reach.y = link.x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(r.m, d.doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT x, min(y) AS m FROM reach GROUP BY 1) r ON r.x = d.doc_id
"""


@query("op2_multi_index")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = multi_index.MultiIndex(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return index.search(F.col("id") % 100 == 0)


@query("op7_license_scan")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = license_scan.scan(docs, license_scan.train(docs))
    return found.select("doc_id", "n_paragraphs", F.size("licenses").cast("long").alias("n_licenses"), "families", "n_unsure")


@query("op10_pii_crf")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii_crf.find(docs, pii_crf.learn(docs))


@query("op13_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    rows = whitening.whiten(vectors, whitening.fit(vectors))
    return rows.withColumn("deviation", F.col("deviation").cast("long"))


@query("op12_spelling_variants")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.variants(table(spark, sf_dir, "documents"))


ORACLES["op12_spelling_variants"] = r"""
WITH RECURSIVE tab AS (SELECT i, list_reduce(list_prepend(CAST(i AS BIGINT), range(8)),
    lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END) AS c FROM range(256) g(i)),
r AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc, unnest(regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents),
d AS (SELECT run, hex(encode(doc || ':' || run)) AS code, count(*) AS n FROM r GROUP BY ALL),
crc AS (SELECT code, 0 AS pos, CAST(4294967295 AS BIGINT) AS state FROM d
    UNION ALL SELECT code, pos + 1, xor(state // 256, c) FROM crc
    JOIN tab ON i = xor(state % 256, CAST('0x' || substr(code, 2 * pos + 1, 2) AS BIGINT)) WHERE 2 * pos < length(code)),
h AS (SELECT run, n, xor(state, 4294967295) AS h FROM d JOIN crc USING (code) WHERE 2 * pos = length(code)),
w AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2) ELSE run END AS word, n FROM h),
v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM w WHERE length(word) >= 6 GROUP BY 1 HAVING sum(n) >= 5),
del AS (SELECT word, i, substr(word, 1, CAST(i AS INT) - 1) || substr(word, CAST(i AS INT) + 1) AS rest
    FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v) q),
near AS (SELECT a.word AS x, b.word AS y FROM del a JOIN del b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
    AND length(a.word) = length(b.word)
    UNION SELECT word, rest FROM del WHERE rest IN (SELECT word FROM v)
    UNION SELECT rest, word FROM del WHERE rest IN (SELECT word FROM v)),
k AS (SELECT x, count(*) AS n_near FROM near GROUP BY 1),
best AS (SELECT x, y, v.n AS m, row_number() OVER (PARTITION BY x ORDER BY v.n DESC, encode(y)) AS p FROM near JOIN v ON v.word = y),
f AS (SELECT x, y, m FROM best JOIN v ON v.word = x WHERE p = 1 AND m >= 5 * v.n),
way AS (SELECT x, y, 1 AS depth FROM f UNION ALL SELECT way.x, f.y, depth + 1 FROM way JOIN f ON f.x = way.y),
top AS (SELECT x, arg_max(y, depth) AS root FROM way GROUP BY 1)
SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, f.y AS form, f.m AS form_n, coalesce(root, v.word) AS root
FROM v LEFT JOIN k ON k.x = v.word LEFT JOIN f ON f.x = v.word LEFT JOIN top ON top.x = v.word
"""


@query("op11_bbit_minhash")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_bbit.near_duplicates(table(spark, sf_dir, "documents"))


ORACLES["op11_bbit_minhash"] = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
i AS (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 2))) AS i FROM d WHERE len(w) > 0),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s FROM i),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * k >= 85 * (nx.n + ny.n - k)),
reach AS (SELECT x, y FROM link UNION SELECT reach.x, link.y FROM reach JOIN link ON reach.y = link.x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(r.m, d.doc_id)) AS component_id,
  d.doc_id = least(d.doc_id, coalesce(r.m, d.doc_id)) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT x, min(y) AS m FROM reach GROUP BY 1) r ON r.x = d.doc_id
"""
