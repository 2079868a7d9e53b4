"""The registered queries ``opN_<name>`` over the given tables, and their SQL for DuckDB."""

from __future__ import annotations

import re
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, fingerprints, html, line_dedup, merkle, mixing, neighbours, ngram_join, periodic, suffix_dedup, token_shards, toxicity

#: Weights of the sources in code point order, repeating.
SOURCE_WEIGHTS = [5, 2, 1]
TOKENIZER = "byte_bpe_50k.json"


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    cleaned = line_dedup.remove_lines(_table(spark, sf, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_removed", F.length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("kept_sha256"))


def op2_bpe_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    return bpe.round_trip_digest(_table(spark, sf, "documents"), public_tokenizers.path(TOKENIZER), cache_bytes=96 << 20)


def op3_token_shards(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents")
    folder = token_shards.shard_folder(docs)
    manifest = token_shards.write_shards(docs, folder, vocabulary=public_tokenizers.path(TOKENIZER))
    rows = token_shards.read_shards(manifest, folder)
    return rows.select("slot", "shard", "offset", F.octet_length("ids").cast("long").alias("n_bytes"), F.sha2("ids", 256).alias("ids_sha256"))


def op4_source_mix(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(_table(spark, sf, "documents"), SOURCE_WEIGHTS, share_percent=150, max_epochs=2)


def op5_ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    return ngram_join.components(_table(spark, sf, "documents"), k=4, percent=85)


def op6_order_minhash(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprints.edited_likeness(_table(spark, sf, "documents"))


def op7_main_text(spark: SparkSession, sf: str) -> DataFrame:
    found = html.extract(_table(spark, sf, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op8_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    cleaned = suffix_dedup.remove_repeats(_table(spark, sf, "documents"), length=100)
    return cleaned.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op9_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, toxicity.training_labels(_table(spark, sf, "labels")))
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


def op10_nearest_vectors(spark: SparkSession, sf: str) -> DataFrame:
    vectors = _table(spark, sf, "embeddings")
    return neighbours.search(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5)


def op11_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.digest(decontaminate.find(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"), window=10))


def op12_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    columns = [F.col(c) for c in docs.columns]
    tampered = [F.col("n_chars") + 1 if c == "n_chars" else F.col(c) for c in docs.columns]
    picked = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    shown = {"shown": F.when(picked, merkle.leaf(*tampered)).otherwise(merkle.leaf(*columns))}
    proved = merkle.verify(merkle.manifest(docs, docs.columns, extra=shown), "shown")
    return proved.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``; in about a tenth of the rows the words from a place on repeat with a period, both drawn by crc32 of the id."""
    drawn = F.crc32(F.col("doc_id").cast("string"))
    cut = docs.select("doc_id", "text", F.floor(drawn / 10).alias("_g"), F.when(drawn % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))).alias("_w"))
    cut = cut.withColumn("_n", F.size("_w")).withColumn("_a", F.when(F.col("_n") > 0, F.expr("int(_g % _n)")))
    cut = cut.withColumn("_p", F.expr("int(1 + (_n - _a) div (3 + _g % 8))"))
    period = F.slice("_w", F.col("_a") + 1, F.col("_p"))
    repeated = F.slice(F.flatten(F.array_repeat(period, F.expr("int((_n - _a + _p - 1) div _p)"))), F.lit(1), F.col("_n") - F.col("_a"))
    text = F.array_join(F.concat(F.slice("_w", F.lit(1), F.col("_a")), repeated), " ")
    return cut.select("doc_id", F.when(F.col("_n") > 0, text).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    return periodic.digest(periodic.find_runs(with_planted_runs(_table(spark, sf, "documents"))))


OP1_SQL = r"""
WITH lines AS (
  SELECT doc_id, coalesce(text, '') AS text, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
  FROM documents
), cut AS (
  SELECT doc_id, text, line, place, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS words FROM lines
), sets AS (
  SELECT doc_id, text, line, place,
         CASE WHEN len(words) = 0 THEN []
              WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
              ELSE list_sort(list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')))) END AS tokens
  FROM cut
), firsts AS (
  SELECT tokens, min({'doc': doc_id, 'place': place}) AS first, row_number() OVER () AS class FROM sets WHERE len(tokens) > 0 GROUP BY tokens
), items AS (
  SELECT class, first, len(tokens) AS n, unnest(tokens) AS token FROM firsts
), later AS (
  SELECT x.class FROM items x JOIN items y ON x.token = y.token AND y.first < x.first
  GROUP BY x.class, y.class, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))
), judged AS (
  SELECT s.doc_id, s.text, s.line, s.place,
         f.class IS NOT NULL AND (f.first <> {'doc': s.doc_id, 'place': s.place} OR f.class IN (SELECT class FROM later)) AS gone
  FROM sets s LEFT JOIN firsts f ON s.tokens = f.tokens
), kept AS (
  SELECT doc_id, any_value(text) AS text, count(*) AS parts, count(*) FILTER (gone) AS n_removed,
         coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '') AS rest
  FROM judged GROUP BY doc_id
)
SELECT doc_id, (CASE WHEN text = '' THEN 0 ELSE parts END)::BIGINT AS n_lines, n_removed::BIGINT AS n_removed,
       length(rest)::BIGINT AS n_chars, sha256(rest) AS kept_sha256
FROM kept
"""

OP5_SQL = r"""
WITH RECURSIVE cut AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), sets AS (
  SELECT doc_id,
         CASE WHEN len(words) = 0 THEN []
              WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
              ELSE list_distinct(list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' '))) END AS shingles
  FROM cut
), items AS (
  SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets
), links AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM items x JOIN items y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id
  GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))
), reach AS (
  SELECT doc_id, doc_id AS other FROM sets
  UNION
  SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.other = links.a
)
SELECT sets.doc_id, len(any_value(shingles))::BIGINT AS n_shingles, min(other) AS component_id
FROM sets JOIN reach USING (doc_id) GROUP BY sets.doc_id
"""

OP4_SQL = r"""
WITH docs AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         md5('mix|' || coalesce(doc_id::VARCHAR, '')) AS pick
  FROM documents
), src AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source
), placed AS (
  SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT] AS weight,
         row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS place, 2 * source_size AS cap,
         sum(source_size) OVER () * 150 AS wanted
  FROM src
), levels AS (
  SELECT *, (wanted - 100 * coalesce(sum(cap) OVER (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
            / (100.0::DOUBLE * sum(weight) OVER (ORDER BY cap / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS level
  FROM placed
), stopped AS (
  SELECT level AS stop FROM levels WHERE level * weight <= cap ORDER BY cap / weight, place LIMIT 1
), targets AS (
  SELECT l.source, source_size,
         greatest(0.0::DOUBLE, least(cap::DOUBLE, coalesce((SELECT stop FROM stopped) * weight, cap::DOUBLE))) AS target
  FROM levels l
), split AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM targets
), ordered AS (
  SELECT doc_id, size, source_size, target, whole, floor(target - whole * source_size)::BIGINT AS rest,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY pick, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM docs d JOIN split s ON d.source IS NOT DISTINCT FROM s.source
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (whole * size + greatest(0, least(size, rest - ahead)))::BIGINT AS taken,
       whole::BIGINT AS whole, greatest(0, least(size, rest - ahead))::BIGINT AS partial
FROM ordered
"""

OP11_SQL = r"""
WITH items AS (
  SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark
), windows AS (
  SELECT DISTINCT item, least(len(words), 10) AS n, unnest(list_transform(range(1, greatest(2, len(words) - 8)), lambda i: array_to_string(words[i:i + 9], ' '))) AS win
  FROM items WHERE len(words) > 0
), docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), sizes AS (
  SELECT DISTINCT n FROM windows
), seen AS (
  SELECT doc_id, n, unnest(range(1, len(words) - n + 2)) AS first,
         unnest(list_transform(range(1, len(words) - n + 2), lambda i: array_to_string(words[i:i + n - 1], ' '))) AS win
  FROM docs, sizes WHERE len(words) >= n
), found AS (
  SELECT seen.doc_id, seen.first, seen.n, windows.item FROM seen JOIN windows ON seen.win = windows.win AND seen.n = windows.n
), hit AS (
  SELECT doc_id, count(DISTINCT place)::BIGINT AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(first, first + n)) AS place FROM found) GROUP BY doc_id
), listed AS (
  SELECT doc_id, count(DISTINCT item)::BIGINT AS n_items, array_to_string(list_sort(list(DISTINCT item) FILTER (item IS NOT NULL)), ',') AS ids FROM found GROUP BY doc_id
)
SELECT d.doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit USING (doc_id) LEFT JOIN listed USING (doc_id)
"""

OP12_SQL = r"""
WITH RECURSIVE drawn AS (
  SELECT *, CRC32(doc_id) % 7 = 0 AS tampered FROM documents
), parts AS (
  SELECT doc_id, lang, tampered,
         concat(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR, '-'), coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-')) AS front,
         n_chars, coalesce(strlen(text) || ':' || text, '-') AS back
  FROM drawn
), leaves AS (
  SELECT doc_id, lang, sha256(concat(front, coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars::VARCHAR, '-'), back)) AS leaf,
         sha256(concat(front, coalesce(strlen((n_chars + tampered::INT)::VARCHAR) || ':' || (n_chars + tampered::INT)::VARCHAR, '-'), back)) AS shown
  FROM parts
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM leaves
), nodes AS (
  SELECT lang, 0 AS level, pos, leaf AS h, n FROM placed
  UNION ALL
  SELECT lang, level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 1) // 2 FROM nodes WHERE n > 1 GROUP BY lang, level, pos // 2
), subroots AS (
  SELECT lang, h AS subroot, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1
), upper AS (
  SELECT 0 AS level, pos, subroot AS h, n FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 1) // 2 FROM upper WHERE n > 1 GROUP BY level, pos // 2
), steps AS (
  SELECT lang, level, pos, n > 1 AS climbs, CASE WHEN pos % 2 = 1 THEN lag(h) OVER w ELSE '' END AS l, CASE WHEN pos % 2 = 0 THEN coalesce(lead(h) OVER w, '') ELSE '' END AS r
  FROM nodes WINDOW w AS (PARTITION BY lang, level ORDER BY pos)
), upper_steps AS (
  SELECT level, pos, n > 1 AS climbs, CASE WHEN pos % 2 = 1 THEN lag(h) OVER w ELSE '' END AS l, CASE WHEN pos % 2 = 0 THEN coalesce(lead(h) OVER w, '') ELSE '' END AS r
  FROM upper WINDOW w AS (PARTITION BY level ORDER BY pos)
), climb AS (
  SELECT doc_id, lang, leaf, pos AS id, pos, 0 AS level, shown AS h, '' AS proof FROM placed
  UNION ALL
  SELECT c.doc_id, c.lang, c.leaf, c.id, c.pos // 2, c.level + 1, sha256(concat(s.l, c.h, s.r)), concat(c.proof, s.l, s.r)
  FROM climb c JOIN steps s ON s.lang IS NOT DISTINCT FROM c.lang AND s.level = c.level AND s.pos = c.pos WHERE s.climbs
), at_subroot AS (
  SELECT c.*, b.subroot, b.pos AS place FROM climb c
  JOIN steps s ON s.lang IS NOT DISTINCT FROM c.lang AND s.level = c.level AND s.pos = c.pos AND NOT s.climbs
  JOIN subroots b ON b.lang IS NOT DISTINCT FROM c.lang
), last AS (
  SELECT doc_id, lang, leaf, id, subroot, place AS pos, 0 AS level, h, proof FROM at_subroot
  UNION ALL
  SELECT c.doc_id, c.lang, c.leaf, c.id, c.subroot, c.pos // 2, c.level + 1, sha256(concat(s.l, c.h, s.r)), concat(c.proof, s.l, s.r)
  FROM last c JOIN upper_steps s ON s.level = c.level AND s.pos = c.pos WHERE s.climbs
)
SELECT doc_id, leaf, subroot, u.h AS root, sha256(proof) AS proof_sha256, c.h AS folded_root, c.h = u.h AS verified
FROM last c JOIN upper_steps s ON s.level = c.level AND s.pos = c.pos AND NOT s.climbs JOIN upper u ON u.n = 1
"""

OP13_SQL = r"""
WITH cut AS (
  SELECT doc_id, CRC32(doc_id) AS h, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), drawn AS (
  SELECT doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS planted, (h // 10) % greatest(len(w), 1) AS a, 3 + (h // 10) % 8 AS parts FROM cut
), docs AS (
  SELECT doc_id, n, CASE WHEN planted THEN list_transform(range(0, n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // parts) END]) ELSE w END AS w
  FROM drawn
), places AS (
  SELECT doc_id, n, unnest(w) AS word, unnest(range(0, n)) AS i FROM docs WHERE n > 0
), matches AS (
  SELECT x.doc_id, x.i, y.i - x.i AS q FROM places x JOIN places y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 3 * (y.i - x.i) <= x.n
), islands AS (
  SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM matches
), stretches AS (
  SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM islands GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(24, 3 * q)
), runs AS (
  SELECT doc_id, start, length, min(q) AS period FROM stretches GROUP BY doc_id, start, length
), listed AS (
  SELECT doc_id, count(*)::BIGINT AS n_runs, string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS lines,
         min({'less': -(length / period), 'start': start, 'period': period, 'length': length}) AS best
  FROM runs GROUP BY doc_id
), dropped AS (
  SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs
), kept AS (
  SELECT p.doc_id, string_agg(word, ' ' ORDER BY p.i) AS text FROM places p ANTI JOIN dropped d ON d.doc_id = p.doc_id AND d.i = p.i GROUP BY p.doc_id
)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, best.start::BIGINT AS start, best.length::BIGINT AS length, best.period::BIGINT AS period,
       (1000 * best.length // best.period)::BIGINT AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM docs d LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


def _with_crc32(sql: str) -> str:
    """``sql`` with CRC32(x) written out: unsigned, of the decimal digits of x, bit by bit."""
    steps = "list_reduce(list_prepend(xor(c, b), [0, 1, 2, 3, 4, 5, 6, 7]::BIGINT[]), lambda v, i: xor(v >> 1, 3988292384 * (v & 1)))"
    digits = r"list_transform(string_split(\1::VARCHAR, ''), lambda d: ord(d)::BIGINT)"
    return re.sub(r"CRC32\((\w+)\)", f"xor(list_reduce(list_prepend(4294967295::BIGINT, {digits}), lambda c, b: {steps}), 4294967295)", sql)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_line_dedup": op1_line_dedup,
        "op2_bpe_round_trip": op2_bpe_round_trip,
        "op3_token_shards": op3_token_shards,
        "op4_source_mix": op4_source_mix,
        "op5_ngram_join": op5_ngram_join,
        "op6_order_minhash": op6_order_minhash,
        "op7_main_text": op7_main_text,
        "op8_suffix_dedup": op8_suffix_dedup,
        "op9_toxicity": op9_toxicity,
        "op10_nearest_vectors": op10_nearest_vectors,
        "op11_decontamination": op11_decontamination,
        "op12_merkle_manifest": op12_merkle_manifest,
        "op13_periodic_runs": op13_periodic_runs,
    }


def oracles() -> dict[str, str]:
    return {
        "op1_line_dedup": OP1_SQL,
        "op4_source_mix": OP4_SQL,
        "op5_ngram_join": OP5_SQL,
        "op11_decontamination": OP11_SQL,
        "op12_merkle_manifest": _with_crc32(OP12_SQL),
        "op13_periodic_runs": _with_crc32(OP13_SQL),
    }
