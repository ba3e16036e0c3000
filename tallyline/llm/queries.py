"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm import (
    chunks,
    fragments,
    importance,
    language,
    lexical,
    mixing,
    outliers,
    pieces,
    simhash,
    toolcalls,
    toxicity,
    vectors,
    warc,
)
from tallyline.llm.common import Stash, id_of, is_held_out, table
from tallyline.llm.register import ORACLE, QUERIES, query

__all__ = ["ORACLE", "QUERIES"]


@query("op1_substring_dedup")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    """Documents without the passages that an earlier document has; what was cut beside them."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return chunks.cut_repeats(docs, detail=True)


@query("op9_simhash_near_dedup")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of each document."""
    return simhash.near_duplicates(table(spark, folder, "documents"))


MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS turn
  FROM documents),
per AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight
  FROM sized GROUP BY source),
room AS (
  SELECT *, source_size * 2.0::DOUBLE AS room FROM per),
level AS (
  SELECT *,
    ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE - coalesce(sum(room) OVER (ORDER BY room / weight, source NULLS LAST
       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY room / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM room),
goal AS (
  SELECT source, source_size,
    CASE WHEN level * weight >= room THEN room
         ELSE weight * min(CASE WHEN level * weight < room THEN {'r': room / weight, 'l': level} END) OVER () ['l'] END AS target
  FROM level),
placed AS (
  SELECT s.doc_id, s.size, g.source_size, g.target, round(g.target)::BIGINT AS words,
    coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.turn, s.doc_id, s.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM sized s JOIN goal g ON s.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
  (greatest(0, least(size, words - start)) + greatest(0, least(size, words - start - source_size)))::BIGINT AS taken
FROM placed
"""


@query("op10_curriculum_mix", MIX_SQL)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    """Size, source and words taken of each document, in the order of training."""
    stash = Stash(spark)
    read = stash.put(mixing.plan(table(spark, folder, "documents"), stash), "readings")
    return mixing.by_position(read).select(id_of("id").alias("doc_id"), "size", "source_size", "target", "taken")


@query("op5_sentencepiece")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of each document, and whether they are sentencepiece's and decode to the text."""
    made = pieces.encoded(table(spark, folder, "documents"), pieces.read_model(spark), ["doc_id"])
    return made.select("doc_id", "ids", F.array_size("ids").cast("long").alias("n_ids"), "parity", "round_trip")


@query("op7_toxicity")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    """Score of each document by a network that learned from the rows not held out."""
    docs = table(spark, folder, "documents")
    net = toxicity.fit(docs, table(spark, folder, "labels"))
    made = docs.select("doc_id", is_held_out("doc_id", 3, 1).alias("held_out"), toxicity.scored(net).alias("score"))
    return made.withColumn("predicted", F.when(F.col("score") >= toxicity.THRESHOLD, 1).otherwise(0))


WARC_SQL = """
WITH shaped AS (
  SELECT page_id, coalesce(strlen(html), 0)::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
firsts AS (
  SELECT payload_digest, min(page_id) AS first FROM shaped WHERE payload_bytes >= 100 GROUP BY 1)
SELECT s.page_id, s.payload_bytes, s.payload_digest,
  CASE WHEN f.first IS NOT NULL AND s.page_id IS DISTINCT FROM f.first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN s.page_id IS DISTINCT FROM f.first THEN f.first END AS refers_to
FROM shaped s LEFT JOIN firsts f ON s.payload_digest = f.payload_digest AND s.payload_bytes >= 100
"""


@query("op8_warc", WARC_SQL)
def op8(spark: SparkSession, folder: str) -> DataFrame:
    """Each page as the written archives hold it."""
    manifest = warc.write_archives(table(spark, folder, "pages"))
    return warc.read_archives(manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op3_language_id")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    """Language of each document by a model that learned from the rows not held out."""
    docs = table(spark, folder, "documents")
    model = language.fit(docs)
    made = docs.select("doc_id", is_held_out("doc_id", 4, 2).alias("held_out"), language.predicted(model).alias("p"))
    return made.select("doc_id", "held_out", "p.lang_pred", "p.score", "p.accepted")


@query("op4_embedding_near_dedup")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    """Number of links and component of each vector."""
    return vectors.near_duplicates(table(spark, folder, "embeddings"))


@query("op6_quality_rules")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and verdict of each document."""
    return outliers.judge(table(spark, folder, "documents"))


@query("op2_tool_calls")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations as linked, ordered and checked tool calls, a line of canonical JSON per message."""
    messages = toolcalls.from_turns(table(spark, folder, "conversations"))
    return toolcalls.format_chat(messages, toolcalls.tool_schemas(spark))


# DuckDB has no crc32: a table by the polynomial's rule, then a fold over the bytes of each distinct word.
RESAMPLE_SQL = r"""
WITH table_ AS (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS t
  FROM range(256) r(i)),
docs AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS words
  FROM documents),
of_docs AS (SELECT doc_id, unnest(words) AS word FROM docs),
of_target AS (
  SELECT unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark),
hexes AS (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM of_docs UNION SELECT word FROM of_target)),
bytes AS (
  SELECT word, list_transform(range(1, length(h)::BIGINT, 2),
    lambda i: (instr('0123456789ABCDEF', substr(h, i, 1)) - 1) * 16 + instr('0123456789ABCDEF', substr(h, i + 1, 1)) - 1) AS b
  FROM hexes),
buckets AS (
  SELECT word, xor(list_reduce(b, lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8), 4294967295::BIGINT), 4294967295) % 10000 AS bucket
  FROM bytes, table_),
s AS (SELECT bucket, count(*) AS n FROM of_docs JOIN buckets USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM of_target JOIN buckets USING (word) GROUP BY bucket),
gains AS (
  SELECT s.bucket, floor(1000 * ln(((coalesce(t.n, 0) + 1) * ((SELECT sum(n) FROM s) + 10000))::DOUBLE
    / ((s.n + 1) * (coalesce((SELECT sum(n) FROM t), 0) + 10000))::DOUBLE))::BIGINT AS gain
  FROM s LEFT JOIN t USING (bucket)),
weighed AS (
  SELECT doc_id, count(*)::BIGINT AS n, sum(gain)::BIGINT AS total
  FROM of_docs JOIN buckets USING (word) JOIN gains USING (bucket) GROUP BY doc_id),
scored AS (
  SELECT d.doc_id, coalesce(w.n, 0)::BIGINT AS n_features,
    coalesce((w.total - ((w.total % w.n) + w.n) % w.n) // w.n, 0)::BIGINT AS weight,
    floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS draw
  FROM docs d LEFT JOIN weighed w USING (doc_id)),
ranked AS (
  SELECT doc_id, n_features, weight, weight + draw AS score,
    CASE WHEN n_features >= 20 THEN row_number() OVER (PARTITION BY n_features >= 20 ORDER BY weight + draw DESC, doc_id) END AS place,
    10 * count(*) FILTER (n_features >= 20) OVER () // 100 AS drawn
  FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= drawn THEN place END AS rank FROM ranked
"""


@query("op11_importance_resampling", RESAMPLE_SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    """Weight, score and rank of each document drawn toward the benchmark texts."""
    return importance.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op12_bpe_forced_boundaries")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    """Number and digest of each document's ids, and digest of what they decode to."""
    return fragments.encoded(table(spark, folder, "documents"), fragments.read_model(), ["doc_id"])


SEARCH_SQL = r"""
WITH words AS (
  SELECT rowid AS doc, doc_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM (SELECT row_number() OVER () AS rowid, doc_id, text FROM documents)),
sizes AS (SELECT doc, len(terms)::BIGINT AS n FROM words WHERE len(terms) > 0),
corpus AS (SELECT count(*)::BIGINT AS held, coalesce(sum(n), 0)::BIGINT AS total FROM sizes),
asked AS (
  SELECT item_id, unnest(list_distinct(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term
  FROM benchmark),
postings AS (
  SELECT doc, doc_id, term, count(*)::BIGINT AS tf
  FROM (SELECT doc, doc_id, unnest(terms) AS term FROM words) WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
rare AS (
  SELECT term, floor(1000 * ln((2 * any_value(held) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM postings, corpus GROUP BY term),
impacts AS (
  SELECT p.doc, p.doc_id, p.term, r.w * ((1000000000 * p.tf) // (1000 * p.tf + 8 * (10 + (90 * s.n * c.held) // c.total))) AS impact
  FROM postings p JOIN rare r ON p.term = r.term JOIN sizes s ON p.doc = s.doc CROSS JOIN corpus c),
scored AS (
  SELECT a.item_id, i.doc, i.doc_id, sum(i.impact)::BIGINT AS score FROM asked a JOIN impacts i ON a.term = i.term GROUP BY ALL),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= 10
"""


@query("op13_lexical_search", SEARCH_SQL)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best documents for each benchmark item."""
    return lexical.ranked(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
