"""The registered queries of this package: thin digests of what the operators return."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from landfall.llm import (
    decontamination, lexical_search, near_dedup, packing, pii, quality, quality_rules, sharding, spelling, suffix_dedup, token_counts,
    token_output, toxicity,
)
from landfall.llm.common import documents, held_out
from landfall.workspace import fresh_folder

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def classified(scores: DataFrame, threshold: float) -> DataFrame:
    return scores.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    weights = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return classified(toxicity.score(docs, weights), toxicity.THRESHOLD)


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(documents(spark, sf_dir), 16).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    vectors = quality.word_vectors(docs)
    network = quality.learn(docs, table(spark, sf_dir, "labels"), vectors)
    return classified(quality.score(docs, vectors, network), quality.THRESHOLD)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contaminated(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.col("item").alias("item_id"), "score", "word_start", "word_end")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = pii.find_spans(docs, pii.learn(docs))
    joined = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    base = F.filter("found", lambda s: s["base"])
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [(F.size(base) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}") for kind in pii.BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), TOKENIZER).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def op7_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_folder(spark, "tokens")
    token_output.write_tokens(documents(spark, sf_dir), path, TOKENIZER)
    return token_output.token_digests(token_output.read_tokens(spark, path), ["doc_id", "start", "n_tokens"])


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.without_repeats(documents(spark, sf_dir))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return cut.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"), (F.size("spans") > 0).alias("has_repeats"),
        F.make_valid_utf8(F.col("kept").cast("string")).alias("text"),
    )


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.keep_by_rules(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_components(documents(spark, sf_dir), words=2, percent=80).select("doc_id", "n_shingles", "component_id", "kept")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.best_documents(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"), top=50)


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), PIECES)


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(documents(spark, sf_dir))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_sharding": op2_sharding,
    "op3_quality": op3_quality,
    "op4_decontamination": op4_decontamination,
    "op5_pii": op5_pii,
    "op6_packing": op6_packing,
    "op7_token_output": op7_token_output,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_quality_rules": op9_quality_rules,
    "op10_near_dedup": op10_near_dedup,
    "op11_lexical_search": op11_lexical_search,
    "op12_token_counts": op12_token_counts,
    "op13_spelling": op13_spelling,
}

ORACLE = {
    "op10_near_dedup": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) < 2 THEN w ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s
  FROM words),
grams AS (SELECT doc_id, unnest(s) AS g FROM sets),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT x, y FROM shared JOIN sets p ON p.doc_id = x JOIN sets q ON q.doc_id = y
  WHERE 100 * c >= 80 * (len(p.s) + len(q.s) - c)),
ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM sets
  UNION
  SELECT r.x, w.y FROM reach r JOIN ways w ON r.y = w.x)
SELECT s.doc_id, CAST(any_value(len(s.s)) AS BIGINT) AS n_shingles, min(r.y) AS component_id, s.doc_id = min(r.y) AS kept
FROM sets s JOIN reach r ON r.x = s.doc_id GROUP BY s.doc_id
""",
    "op11_lexical_search": r"""
WITH found AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents),
filled AS (SELECT doc_id, t, CAST(len(t) AS BIGINT) AS n FROM found WHERE len(t) > 0),
corpus AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM filled),
counts AS (
  SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(t) AS term FROM filled) GROUP BY doc_id, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
  FROM counts, corpus GROUP BY term),
norms AS (SELECT doc_id, 100 - 50 + ((50 * n * docs) // total) AS m FROM filled, corpus),
wanted AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
scores AS (
  SELECT item_id, c.doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM wanted q JOIN counts c ON q.term = c.term JOIN weights k ON k.term = c.term JOIN norms d ON d.doc_id = c.doc_id
  GROUP BY item_id, c.doc_id),
ranks AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranks WHERE rank <= 50
""",
    "op13_spelling": r"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) AS run
  FROM documents),
held AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE len(run) >= 6 GROUP BY doc_id, run),
bytes AS (
  SELECT doc_id, run, n, flatten(list_transform(string_split(doc_id || ':' || run, ''),
    lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [192 + (unicode(c)::BIGINT >> 6), 128 + (unicode(c)::BIGINT & 63)] END)) AS b
  FROM held),
sums AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS h
  FROM bytes, crc),
spelt AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % len(run) AS BIGINT)) || substr(run, CAST(h % len(run) AS BIGINT) + 2) ELSE run END AS word, n
  FROM sums),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spelt WHERE len(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cuts AS (SELECT word, n, substr(word, 1, i - 1) AS p, substr(word, i + 1) AS s FROM (SELECT word, n, unnest(range(1, len(word) + 1)) AS i FROM words)),
pairs AS (
  SELECT a.word AS x, b.word AS y FROM cuts a JOIN cuts b ON a.p = b.p AND a.s = b.s AND a.word <> b.word
  UNION SELECT a.word, b.word FROM cuts a JOIN words b ON a.p || a.s = b.word
  UNION SELECT b.word, a.word FROM cuts a JOIN words b ON a.p || a.s = b.word),
near AS (
  SELECT x, y, b.n AS m, count(*) OVER (PARTITION BY x) AS n_near, row_number() OVER (PARTITION BY x ORDER BY b.n DESC, y) AS place
  FROM pairs JOIN words b ON b.word = y),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 5 * w.n THEN y END AS form, CASE WHEN m >= 5 * w.n THEN m END AS form_n
  FROM words w LEFT JOIN near ON x = w.word AND place = 1),
walk AS (
  SELECT word, word AS at FROM forms
  UNION ALL SELECT walk.word, forms.form FROM walk JOIN forms ON forms.word = walk.at WHERE forms.form IS NOT NULL),
roots AS (SELECT walk.word, walk.at AS root FROM walk JOIN forms ON forms.word = walk.at WHERE forms.form IS NULL)
SELECT f.word, f.form, r.root, f.n, CAST(f.n_near AS BIGINT) AS n_near, f.form_n FROM forms f JOIN roots r ON r.word = f.word
""",
}
