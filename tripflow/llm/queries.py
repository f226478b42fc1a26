"""Registered queries of the subpackage: each applies an operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm.alignment import align_tokenizers
from tripflow.llm.decontaminate import find_contamination
from tripflow.llm.exact_dedup import exact_groups
from tripflow.llm.jaccard_join import Similarity, jaccard_components
from tripflow.llm.mixing import EPOCH, Level, about_tokens, mix_documents
from tripflow.llm.packing import pack_documents
from tripflow.llm.pii import KINDS, find_personal_data
from tripflow.llm.quality import SCORE, fit_quality, held_out
from tripflow.llm.secrets import BASE_RULES, scan_secrets
from tripflow.llm.shared import shared_path
from tripflow.llm.sharding import JUMP_MULTIPLIER, shard_documents
from tripflow.llm.spelling import spelling_variants
from tripflow.llm.token_files import read_token_files, write_token_files
from tripflow.llm.topk_search import integer_components, top_k

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Where the installed public vocabulary of this name lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


OP1_MEMO_BYTES = 256_000_000


def op1_pack_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_documents(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), end_id=1, memo_bytes=OP1_MEMO_BYTES)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


QUERIES["op1_pack_differencing"] = op1_pack_differencing


def op2_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"), keep="max")


QUERIES["op2_content_sort"] = op2_content_sort
ORACLE_SQL["op2_content_sort"] = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


def spans_text(spans: Column, name: str = "kind") -> Column:
    """name:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s[name], s["start"], s["end"])), ",")


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = [k.name for k in KINDS]
    found = find_personal_data(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *(F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}") for k in base),
        F.sha2(spans_text(F.filter("spans", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        spans_text(F.col("spans")).alias("spans"),
        F.transform("spans", lambda s: s["score"]).alias("scores"),
    )


QUERIES["op7_personal_data"] = op7_personal_data


SHARDS = 16


def op9_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"), SHARDS)


QUERIES["op9_jump_shards"] = op9_jump_shards
ORACLE_SQL["op9_jump_shards"] = f"""
WITH RECURSIVE
jumps AS (
  SELECT doc_id AS key, n AS shards, 0::BIGINT AS here, 0::BIGINT AS nxt,
         (CASE WHEN doc_id < 0 THEN doc_id::HUGEINT + 18446744073709551616 ELSE doc_id::HUGEINT END) AS state
  FROM (SELECT DISTINCT doc_id FROM documents), (VALUES ({SHARDS}), ({SHARDS + 1})) AS t(n)
  UNION ALL
  SELECT key, shards, nxt,
         floor((nxt + 1) * (2147483648.0::DOUBLE
           / ((((state * {JUMP_MULTIPLIER} + 1) % 18446744073709551616) // 8589934592 + 1)::DOUBLE)))::BIGINT,
         (state * {JUMP_MULTIPLIER} + 1) % 18446744073709551616
  FROM jumps WHERE nxt < shards
),
landed AS (SELECT key, shards, max(here) AS shard FROM jumps GROUP BY key, shards),
placed AS (
  SELECT d.doc_id, d.text, a.shard AS shard, b.shard AS grown
  FROM documents d
  JOIN landed a ON a.key = d.doc_id AND a.shards = {SHARDS}
  JOIN landed b ON b.key = d.doc_id AND b.shards = {SHARDS + 1}
),
crc AS (  -- the table of the reflected polynomial, one entry per byte
  SELECT v, list_reduce([v::BIGINT] || [0::BIGINT FOR i IN range(8)],
                        lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS entry
  FROM range(256) AS t(v)
),
entries AS (SELECT list(entry ORDER BY v) AS e FROM crc)
SELECT doc_id,
       strlen(coalesce(text, '')) + 1 AS size,
       xor(list_reduce([4294967295::BIGINT] || [('0x' || h)::BIGINT FOR h IN regexp_extract_all(hex(encode(coalesce(text, ''))), '..')],
                       lambda c, b: xor(c // 256, e[xor(c % 256, b) + 1])), 4294967295) AS text_crc32,
       'key' AS law,
       shard::INT AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY substr(md5(doc_id::VARCHAR), 1, 3), doc_id) - 1 AS slot,
       grown::INT AS grown_shard
FROM placed, entries
"""


def op5_trigram_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = [r.name for r in BASE_RULES]
    return scan_secrets(table(spark, sf_dir, "documents")).select(
        "doc_id",
        *(F.size(F.filter("spans", lambda s: s["rule"] == k)).cast("long").alias(f"n_{k}") for k in base),
        F.sha2(spans_text(F.filter("spans", lambda s: s["rule"].isin(base)), "rule"), 256).alias("base_sha256"),
        spans_text(F.col("spans"), "rule").alias("spans"),
    )


QUERIES["op5_trigram_secrets"] = op5_trigram_secrets


def op6_dictionary_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path, vocabulary("byte_bpe_50k.json"), end_id=0)
    read = read_token_files(spark, path)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


QUERIES["op6_dictionary_files"] = op6_dictionary_files


KEEP_SCORE = 0.7


def op8_random_indexing_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    return model.score(docs).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col(SCORE).alias("score"),
        (F.col(SCORE) >= KEEP_SCORE).cast("int").alias("predicted"),
    )


QUERIES["op8_random_indexing_quality"] = op8_random_indexing_quality


def op10_orders_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), Similarity(words=3, percent=90))


QUERIES["op10_orders_jaccard"] = op10_orders_jaccard


def op3_segment_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", integer_components(F.col("embedding")).alias("whole"))
    return top_k(vectors, F.col("vec_id") % 50 == 0, 5, vector_col="whole")


QUERIES["op3_segment_top_k"] = op3_segment_top_k
ORACLE_SQL["op3_segment_top_k"] = """
WITH whole AS (
  SELECT vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
),
scored AS (
  SELECT q.vec_id AS query_id, x.vec_id AS vec_id,
         list_sum([a[1] * a[2] FOR a IN list_zip(q.v, x.v)])::BIGINT AS score
  FROM whole q JOIN whole x ON q.vec_id <> x.vec_id AND len(q.v) = len(x.v)
  WHERE q.vec_id % 50 = 0
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


def document_levels() -> list[Level]:
    """A tree of domain, language and source for the table ``documents``, with integer weights."""
    number = F.regexp_extract(F.coalesce("source", F.lit("")), "([0-9]+)$", 1)
    domain = F.when(number == "0", "web").when(F.length(number) == 1, "forum").otherwise("books")
    return [
        Level("domain", domain, F.when(F.col("domain") == "web", 2).otherwise(3)),
        Level("lang", F.col("lang"), F.when(F.col("lang") == "en", 4).when(F.col("lang") == "es", 3).otherwise(2)),
        Level("source", F.col("source"), F.lit(1)),
    ]


MIX_SHARE, MIX_EPOCHS, MIX_SEED = 0.75, 2, 17


def op4_tree_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    mixed = mix_documents(docs, document_levels(), share=MIX_SHARE, max_epochs=MIX_EPOCHS, seed=MIX_SEED)
    return mixed.select("doc_id", "lang", "source", about_tokens(F.col("text")).alias("tokens"), F.col(EPOCH).alias("epoch"))


QUERIES["op4_tree_mixture"] = op4_tree_mixture


def _water(nodes: str, parent: str) -> str:
    siblings = f"PARTITION BY {parent}" if parent else ""
    earlier = f"OVER ({siblings} ORDER BY cap / weight, name ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return f"""
  SELECT * EXCLUDE (budget, water),
         least(cap, floor(weight * max(water) OVER ({siblings}))::BIGINT) AS budget
  FROM (SELECT *, (budget - coalesce(sum(cap) {earlier}, 0))::DOUBLE
                  / (sum(weight) OVER ({siblings}) - coalesce(sum(weight) {earlier}, 0))::DOUBLE AS water
        FROM ({nodes}))"""


ORACLE_SQL["op4_tree_mixture"] = f"""
WITH d AS (
  SELECT doc_id, lang, source, strlen(coalesce(text, '')) // 4 + 1 AS tokens, coalesce(lang, '') AS l, coalesce(source, '') AS s,
         CASE WHEN regexp_extract(coalesce(source, ''), '([0-9]+)$', 1) = '0' THEN 'web'
              WHEN length(regexp_extract(coalesce(source, ''), '([0-9]+)$', 1)) = 1 THEN 'forum' ELSE 'books' END AS m
  FROM documents
),
leaf AS (SELECT m, l, s, sum(tokens)::BIGINT AS supply, (sum(tokens) * {MIX_EPOCHS})::BIGINT AS cap FROM d GROUP BY ALL),
root AS (SELECT floor(sum(supply)::DOUBLE * {MIX_SHARE})::BIGINT AS budget FROM leaf),
one AS ({_water("SELECT m, m AS name, sum(cap)::BIGINT AS cap, CASE WHEN m = 'web' THEN 2 ELSE 3 END AS weight, any_value(budget) AS budget FROM leaf, root GROUP BY m", "")}),
two AS ({_water("SELECT m, l, l AS name, sum(leaf.cap)::BIGINT AS cap, CASE l WHEN 'en' THEN 4 WHEN 'es' THEN 3 ELSE 2 END AS weight, any_value(one.budget) AS budget FROM leaf JOIN one USING (m) GROUP BY m, l", "m")}),
three AS ({_water("SELECT m, l, s, s AS name, leaf.cap AS cap, leaf.supply AS supply, 1 AS weight, two.budget AS budget FROM leaf JOIN two USING (m, l)", "m, l")}),
plan AS (SELECT m, l, s, budget // supply AS whole, budget % supply AS rest FROM three),
placed AS (
  SELECT d.*, whole, rest, sum(tokens) OVER (PARTITION BY m, l, s ORDER BY md5('{MIX_SEED}:' || whole || ':' || doc_id)) AS through
  FROM d JOIN plan USING (m, l, s)
),
lacks AS (  -- what whole documents leave of a leaf's rest, and how long its next one is
  SELECT m, l, s, any_value(rest) - coalesce(max(through) FILTER (through <= rest), 0) AS lack,
         if(any_value(whole) < {MIX_EPOCHS}, min(through) FILTER (through > rest) - coalesce(max(through) FILTER (through <= rest), 0), NULL) AS extra
  FROM placed GROUP BY ALL
),
by_source AS (
  SELECT *, coalesce(sum(extra) OVER (PARTITION BY m, l ORDER BY extra, s) <= sum(lack) OVER (PARTITION BY m, l) AND extra IS NOT NULL, FALSE) AS won FROM lacks
),
langs AS (
  SELECT m, l, sum(lack - if(won, extra, 0)) AS pool, min((extra, s)) FILTER (NOT won AND extra IS NOT NULL) AS offer FROM by_source GROUP BY ALL
),
lang_won AS (
  SELECT m, l, offer[2] AS s FROM langs WHERE offer IS NOT NULL
  QUALIFY sum(offer[1]) OVER (PARTITION BY m ORDER BY offer[1], l) <= (SELECT sum(pool) FROM langs AS all_langs WHERE all_langs.m = langs.m)
),
by_lang AS (SELECT * REPLACE (won OR (m, l, s) IN (SELECT m, l, s FROM lang_won) AS won) FROM by_source),
domains AS (
  SELECT m, sum(lack - if(won, extra, 0)) AS pool, min((extra, l, s)) FILTER (NOT won AND extra IS NOT NULL) AS offer FROM by_lang GROUP BY ALL
),
domain_won AS (
  SELECT m, offer[2] AS l, offer[3] AS s FROM domains WHERE offer IS NOT NULL
  QUALIFY sum(offer[1]) OVER (ORDER BY offer[1], m) <= (SELECT sum(pool) FROM domains)
),
settled AS (SELECT * REPLACE (won OR (m, l, s) IN (SELECT m, l, s FROM domain_won) AS won) FROM by_lang),
ends AS (
  SELECT placed.*, won AND through = min(through) FILTER (through > rest) OVER (PARTITION BY m, l, s) AS next
  FROM placed JOIN settled USING (m, l, s)
)
SELECT doc_id, lang, source, tokens, unnest(range(whole + (through <= rest OR next)::INT))::BIGINT AS epoch
FROM ends
"""


SLIP_EVERY, FORM_RATIO = 31, 10


def op11_trie_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return spelling_variants(docs, ratio=FORM_RATIO, min_letters=7, min_count=2, slip_every=SLIP_EVERY)


QUERIES["op11_trie_spellings"] = op11_trie_spellings
ORACLE_SQL["op11_trie_spellings"] = """
WITH RECURSIVE
crc AS (  -- the table of the reflected polynomial, one entry per byte
  SELECT v, list_reduce([v::BIGINT] || [0::BIGINT FOR i IN range(8)],
                        lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS entry
  FROM range(256) AS t(v)
),
entries AS (SELECT list(entry ORDER BY v) AS e FROM crc),
runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')),
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents
),
summed AS (
  SELECT run, times,
         xor(list_reduce([4294967295::BIGINT] || [('0x' || h)::BIGINT FOR h IN regexp_extract_all(hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)), '..')],
                         lambda c, b: xor(c // 256, e[xor(c % 256, b) + 1])), 4294967295) AS h
  FROM (SELECT doc_id, run, count(*) AS times FROM runs WHERE length(run) >= 7 GROUP BY ALL), entries
),
words AS (
  SELECT CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, sum(times)::BIGINT AS n
  FROM summed GROUP BY 1 HAVING length(word) >= 7 AND sum(times) >= 2
),
cuts AS (SELECT word, n, k, left(word, k) || substr(word, k + 2) AS rest FROM words, unnest(range(length(word))) AS t(k)),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.k = b.k AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.rest = b.word
),
best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, encode(other)) AS other, max(other_n) AS other_n FROM near GROUP BY word
),
formed AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, if(other_n >= 10 * n, other, NULL) AS form, if(other_n >= 10 * n, other_n, NULL) AS form_n
  FROM words LEFT JOIN best USING (word)
),
chain AS (
  SELECT word, word AS here FROM formed
  UNION ALL SELECT chain.word, form FROM chain JOIN formed ON formed.word = here WHERE form IS NOT NULL
)
SELECT f.word, form, here AS root, n, n_near, form_n
FROM formed f JOIN chain USING (word) WHERE here IN (SELECT word FROM formed WHERE form IS NULL)
"""


def op12_fm_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


QUERIES["op12_fm_decontamination"] = op12_fm_decontamination
_WORDS = "regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
ORACLE_SQL["op12_fm_decontamination"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDS.format("text")}, []) AS w FROM documents),
items AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {_WORDS.format("text")} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS size, w[k:k + least(len(w), 10) - 1] AS win
  FROM items, unnest(range(1, greatest(len(w) - 8, 2))) AS t(k) WHERE len(w) > 0
),
sizes AS (SELECT DISTINCT size FROM windows),
placed AS (SELECT r, k, size, w[k:k + size - 1] AS win FROM d, sizes, unnest(range(1, len(w) - size + 2)) AS t(k) WHERE len(w) >= size),
found AS (SELECT r, k, size, item FROM placed JOIN windows USING (size, win)),
hit AS (SELECT r, count(DISTINCT word) AS n_hit FROM (SELECT r, unnest(range(k, k + size)) AS word FROM found) GROUP BY r),
named AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS names FROM found GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
"""


def op13_spill_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokenizers(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


QUERIES["op13_spill_alignment"] = op13_spill_alignment
