"""Queries opN_<name> over the whole given tables, with check SQL where SQL can say it."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacantia.llm import (
    centroids,
    chat,
    decontam,
    forest,
    langid,
    linededup,
    pieces,
    quality,
    repeats,
    resampling,
    secrets,
    shards,
    simhash,
)
from vacantia.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}

#: The public SentencePiece model; only the driver opens it.
PIECES = os.environ.get("PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            CHECKS[name] = sql
        return function

    return register


@query("op2_simhash_groups")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"), width=4, radius=4)
    return found.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


@query("op9_word_first_language")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs.filter(~langid.held_out()))
    return docs.select(
        "doc_id", langid.held_out().alias("held_out"), langid.predicted(model, docs).alias("p")
    ).select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), "p.score")


OP7_SQL = """
WITH numbered AS (
  SELECT doc_id, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos,
         unnest(string_split(coalesce(text, ''), chr(10))) AS line
  FROM documents
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM numbered
), common AS (
  SELECT k, max(doc_id) AS last FROM keyed WHERE length(k) >= 40
  GROUP BY k HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT keyed.*, common.k IS NOT NULL AND doc_id <> last AS gone
  FROM keyed LEFT JOIN common USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query("op7_levelled_line_dedup", OP7_SQL)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return linededup.dedup_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")
    )


@query("op3_merge_dropout_pieces")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.encoded(table(spark, folder, "documents"), PIECES, dropout=0.1, seed=42)


@query("op4_benchmark_windows")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return decontam.matches(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op5_previous_factor_dedup")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    length = F.aggregate("removed", F.lit(0).cast("long"), lambda a, r: a + r["to"] - r["from"])
    return repeats.without_repeats(docs, length=100).select(
        "doc_id",
        (F.octet_length("kept") + length).alias("n_bytes"),
        length.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query("op8_projection_forest_links")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    found = forest.linked(table(spark, folder, "embeddings"), least=0.98)
    return found.select(
        "vec_id",
        "n_links",
        F.col("component").cast("long").alias("component_id"),
        F.col("vec_id").eqNullSafe(F.col("component")).alias("kept"),
    )


@query("op10_label_propagation_shards")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return shards.sharded(table(spark, folder, "documents"), shards=40).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


OP6_SQL = """
WITH t AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), e AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS pos,
         replace(replace(text, '~', '~0'), '<|', '<~1') AS body,
         '<|im_start|>' || replace(replace(replace(role, '~', '~0'), '<|', '<~1'), chr(10), '~2') || chr(10) AS head
  FROM t
), s AS (
  SELECT *, ceil(strlen(head || body) / 4.0)::BIGINT + 4 AS tokens, length(head) + length(body) + 11 AS chars FROM e
), p AS (
  SELECT *, sum(tokens) OVER (PARTITION BY conv_id ORDER BY pos)::BIGINT AS until FROM s
), w AS (
  SELECT *, until - tokens AS start, pos = 0 AND role = 'system' AS lead,
         2 * ((until - tokens) // 512) + ((until - 1) // 512 > (until - tokens) // 512)::INT AS win FROM p
), windows AS (
  SELECT conv_id, win, min(start) AS start, min(pos) AS pos, sum(chars) AS chars FROM w GROUP BY ALL
), repeated AS (
  SELECT x.conv_id, x.win, sum(y.chars) AS chars FROM windows x JOIN w y ON x.conv_id = y.conv_id
   AND (y.lead AND x.pos > 0
        OR NOT y.lead AND y.tokens <= 128 AND y.start < x.start AND y.start >= x.start - 128)
  GROUP BY ALL
), sizes AS (
  SELECT conv_id, sum(x.chars + coalesce(y.chars, 0))::BIGINT AS formatted_chars
  FROM windows x LEFT JOIN repeated y USING (conv_id, win) GROUP BY conv_id
), texts AS (
  SELECT conv_id, count(*) AS n_turns,
         sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
         coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
         sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256
  FROM e GROUP BY conv_id
)
SELECT * FROM texts JOIN sizes USING (conv_id)
"""


@query("op6_budgeted_chat_windows", OP6_SQL)
def op6(spark: SparkSession, folder: str) -> DataFrame:
    given = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    hard = "<|im_end|><|im_start|>assistant ok"
    extra = spark.createDataFrame([(-1, 0, "user", hard), (-1, 1, "assistant", hard)], given.schema)
    read = chat.read_back(chat.windows(given.unionByName(extra)))
    digest = lambda c: F.sha2(F.array_join(c, "").cast("binary"), 256)
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        digest(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))).alias("turns_sha256"),
        F.aggregate("targets", F.lit(0).cast("long"), lambda a, t: a + F.char_length(t)).alias("loss_chars"),
        digest(F.col("targets")).alias("loss_sha256"),
        F.col("chars").alias("formatted_chars"),
    )


@query("op1_bradley_terry_quality")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    model = quality.fit(docs, labels.filter(~langid.held_out()))
    return docs.select(
        "doc_id", langid.held_out().alias("held_out"), quality.scored(model, docs).alias("score")
    ).withColumn("predicted", (F.col("score") >= quality.CUT).cast("int"))


OP11_SQL = r"""
WITH RECURSIVE bits AS (
  SELECT i, 0 AS round, i AS v FROM generate_series(0, 255) t(i)
  UNION ALL
  SELECT i, round + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE round < 8
), step AS (
  SELECT list(v ORDER BY i) AS t FROM bits WHERE round = 8
), words AS (
  SELECT 'd' AS side, doc_id AS id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM documents
  UNION ALL
  SELECT 'b', item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) FROM benchmark
), kinds AS (
  SELECT w, hex(encode(w)) AS h FROM (SELECT DISTINCT w FROM words)
), hashed AS (
  SELECT w, xor(list_reduce(list_transform(range(0, length(h) // 2),
      lambda j: ('0x' || substr(h, 2 * j + 1, 2))::BIGINT),
      lambda a, b: xor(a >> 8, t[xor(a & 255, b) + 1]), 4294967295::BIGINT), 4294967295) % 10000 AS bucket
  FROM kinds, step
), counted AS (
  SELECT bucket, count(*) FILTER (WHERE side = 'd') AS s, count(*) FILTER (WHERE side = 'b') AS t
  FROM words JOIN hashed USING (w) GROUP BY bucket
), totals AS (
  SELECT coalesce(sum(s), 0)::BIGINT AS s_all, coalesce(sum(t), 0)::BIGINT AS t_all FROM counted
), gains AS (
  SELECT bucket, floor(1000 * ln(((t + 1) * (s_all + 10000))::DOUBLE / ((s + 1) * (t_all + 10000))::DOUBLE))::BIGINT AS gain
  FROM counted, totals
), weighed AS (
  SELECT id AS doc_id, count(*) AS n_features, sum(gain)::BIGINT AS weight
  FROM words JOIN hashed USING (w) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY id
), scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM documents LEFT JOIN weighed USING (doc_id)
), ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS number
  FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * number // 100 THEN rank END AS rank
FROM scored LEFT JOIN ranked USING (doc_id)
"""


@query("op11_position_table_resampling", OP11_SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    docs, target = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    return resampling.resampled(docs, target, longest=1, buckets=10_000, percent=10, least_words=20, seed=2024)


@query("op12_randomness_battery_secrets")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scanned(table(spark, folder, "documents"))
    many = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        many(0).alias("n_assign"),
        many(1).alias("n_access"),
        many(2).alias("n_hex"),
        F.sha2(F.col("base_text").cast("binary"), 256).alias("base_sha256"),
        F.col("spans_text").alias("spans"),
    )


def _op13_sql() -> str:
    """Every round as tables of its own: nearest centroid of each vector, then the floor of each mean."""
    square = "list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT"
    near = f"SELECT vec_id, any_value(v.x) AS x, min({square}) AS distance, arg_min(c.c, ({square}, c.c)) AS cluster FROM v, {{}} c GROUP BY vec_id"
    parts = [
        """v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x::DOUBLE))) = 64
), c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS c, x FROM v ORDER BY sha256('2:' || vec_id) LIMIT 40
)"""
    ]
    for i in range(5):
        parts.append(f"a{i} AS ({near.format(f'c{i}')})")
        parts.append(
            f"s{i} AS (SELECT cluster, i, sum(x[i])::BIGINT AS s, count(*) AS n FROM a{i}, generate_series(1, 64) t(i) GROUP BY cluster, i)"
        )
        parts.append(f"m{i} AS (SELECT cluster AS c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS x FROM s{i} GROUP BY cluster)")
        parts.append(f"c{i + 1} AS (SELECT c{i}.c, coalesce(m{i}.x, c{i}.x) AS x FROM c{i} LEFT JOIN m{i} USING (c))")
    parts.append(f"a5 AS ({near.format('c5')})")
    body = ",\n".join(parts)
    return f"""WITH {body}
SELECT vec_id, a5.cluster::INT AS cluster, distance, sum(distance) OVER (PARTITION BY a5.cluster)::BIGINT AS cluster_inertia,
       sum(distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(c5.x, ',')) AS centroid_sha256
FROM a5 JOIN c5 ON c5.c = a5.cluster
"""


@query("op13_rotated_filter_centroids", _op13_sql())
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.clustered(table(spark, folder, "embeddings")).drop("compared")
