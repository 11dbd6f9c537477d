"""One query per operator, over its whole table and with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpus_audit.llm import binary, chosen_path, decontaminate, jaccard, licenses, negatives, packing, quality, repair, token_counts, toolcalls, topk, toxicity
from corpus_audit.llm.common import held_out, keyed_texts, query, table
from corpus_audit.session import scratch_dir


def word_tokenizer() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


@query("op1_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), word_tokenizer(), ids=False).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


@query("op5_token_files")
def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "token-files")
    binary.write_token_files(table(spark, sf_dir, "documents"), folder, word_tokenizer(), end_id=2)
    read = binary.read_token_files(spark, folder)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query(
    "op8_exact_top_k",
    """
    WITH v AS (
      SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
      WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), s AS (
      SELECT q.vec_id AS query_id, c.vec_id,
             CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0
    ), r AS (
      SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
    )
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
    """,
)
def exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), lambda key: key % 20 == 0, k=20)


@query("op4_quality_discriminant")
def quality_discriminant(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = keyed_texts(table(spark, sf_dir, "documents"))
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs, model)
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query("op6_toxicity_instances")
def toxicity_instances(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = keyed_texts(table(spark, sf_dir, "documents"))
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model, offending="offending")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        F.size("offending").alias("n_offending"),
        "offending",
    )


@query("op7_edit_decontamination")
def edit_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.edit_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op10_trie_token_counts")
def trie_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = token_counts.ranked_scores(public_tokenizers.path("piece_bpe_32k.model"))
    return token_counts.token_counts(table(spark, sf_dir, "documents"), scores)


@query("op2_ngram_jaccard")
def ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.components(table(spark, sf_dir, "documents"), words=4, share=85).drop("text_hash")


@query("op3_license_scan", licenses.oracle())
def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents").withColumn("path", F.expr(licenses.document_path())))


#: The tools that the turns of ``conversations`` are read as calls of.
TOOLS = {
    "count": {"after": ("string", False), "text": ("string", True)},
    "find": {"after": ("string", False), "limit": ("integer", True), "text": ("string", True)},
    "rate": {"exact": ("boolean", False), "scale": ("number", True), "text": ("string", True)},
}

#: An assistant's turn as a call, in SQL that both engines read alike: the tool and the fields follow from the turn.
_CALL = """
  SELECT conv_id, concat('c', conv_id, '-', turn) AS call_id, turn,
         CASE (conv_id + turn) % 4 WHEN 0 THEN 'count' WHEN 1 THEN 'find' WHEN 2 THEN 'rate' ELSE 'guess' END AS name,
         CASE WHEN turn > 1 THEN concat('c', conv_id, '-', turn - 2) END AS before,
         regexp_replace(text, '[^A-Za-z0-9]+', ' '{g}) AS said, conv_id % 5 AS k
  FROM conversations WHERE role = 'assistant'
"""
_ARGUMENTS = """
  CASE WHEN k = 4 AND name = 'find' THEN concat('{ "text":"', said, '", "limit": "', turn, '" }')
       WHEN name = 'find' THEN concat('{ "text":"', said, '", "limit": ', turn, coalesce(concat(', "after": "', before, '"'), ''), ' }')
       WHEN name = 'rate' AND k = 3 THEN concat('{"exact": true, "text": "', said, '"}')
       WHEN name = 'rate' THEN concat('{"text" : "', said, '", "scale": ', turn, '.5, "exact": ', CASE WHEN k = 1 THEN 'true' ELSE 'false' END, '}')
       WHEN k = 2 THEN concat('{"text": "', said, '"')
       ELSE concat('{"text": "', said, '", "after" : "', coalesce(before, ''), '"}') END
"""


@query(
    "op9_tool_call_linking",
    f"""
    WITH c AS ({_CALL.format(g=", 'g'")}),
    r AS (SELECT conv_id, concat('c', conv_id, '-', turn - 1) AS call_id, text FROM conversations WHERE role = 'user'),
    a AS (SELECT c.*, r.text AS result, r.call_id IS NOT NULL AS got,
                 (before IS NOT NULL AND EXISTS (SELECT 1 FROM c p WHERE p.conv_id = c.conv_id AND p.call_id = c.before)) AS chained
          FROM c LEFT JOIN r ON c.conv_id = r.conv_id AND c.call_id = r.call_id),
    s AS (SELECT *, sum(CASE WHEN chained THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id ORDER BY turn) AS run FROM a),
    l AS (SELECT *, row_number() OVER (PARTITION BY conv_id, run ORDER BY turn) - 1 AS level FROM s),
    p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY level, turn, call_id) AS position FROM l),
    w AS (SELECT *, CASE
        WHEN name = 'guess' THEN ['unknown tool']
        WHEN k = 2 AND name = 'count' THEN ['arguments are not a JSON object']
        WHEN k = 4 AND name = 'find' THEN ['limit is not integer']
        WHEN name = 'rate' AND k = 3 THEN ['missing scale']
        ELSE [] END AS bad,
      CASE WHEN k = 4 AND name = 'find' THEN '{{"limit":"' || turn || '","text":"' || said || '"}}'
           WHEN name = 'find' THEN '{{' || coalesce('"after":"' || before || '",', '') || '"limit":' || turn || ',"text":"' || said || '"}}'
           WHEN name = 'rate' AND k = 3 THEN '{{"exact":true,"text":"' || said || '"}}'
           WHEN name = 'rate' THEN '{{"exact":' || CASE WHEN k = 1 THEN 'true' ELSE 'false' END || ',"scale":' || turn || '.5,"text":"' || said || '"}}'
           WHEN k = 2 THEN NULL
           ELSE '{{"after":"' || coalesce(before, '') || '","text":"' || said || '"}}' END AS canon FROM p)
    SELECT 'call' AS kind, conv_id, call_id, name, CAST(level AS BIGINT) AS level, CAST(position AS BIGINT) AS position,
           CAST(CASE WHEN got THEN 1 ELSE 0 END AS BIGINT) AS n_results,
           array_to_string(list_concat(list_concat(bad, CASE WHEN before IS NOT NULL AND NOT chained THEN ['no call ' || before] ELSE [] END),
                           CASE WHEN got THEN [] ELSE ['no result'] END), '; ') AS errors,
           '{{' || coalesce('"arguments":' || canon || ',', '') || '"id":"' || call_id || '","name":"' || name || '"'
             || coalesce(',"result":' || CAST(to_json(result) AS VARCHAR), '') || '}}' AS message
    FROM w
    UNION ALL
    SELECT 'orphan', conv_id, call_id, NULL, NULL, NULL, 1, NULL, NULL
    FROM r WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.conv_id = r.conv_id AND c.call_id = r.call_id)
    """,
)
def tool_call_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    said = spark.sql(_CALL.format(g="").replace("FROM conversations", "FROM {turns}"), turns=turns)
    calls = said.withColumn("arguments", F.expr(_ARGUMENTS)).withColumn("depends_on", F.array("before"))
    results = turns.where(F.col("role") == "user").select(
        "conv_id", F.expr("concat('c', conv_id, '-', turn - 1)").alias("call_id"), "turn", F.col("text").alias("content")
    )
    return toolcalls.link(calls, results, TOOLS)


@query(
    "op12_hard_negatives",
    """
    WITH v AS (
      SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
      WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), s AS (
      SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
             CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * c.v[i])) AS BIGINT) AS score
      FROM v a JOIN v c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v) WHERE a.vec_id % 50 = 0
    ), p AS (
      SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
             row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS w FROM s WHERE same
    ), n AS (
      SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor_id, p.w ORDER BY s.score DESC, s.vec_id) AS rank
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
       AND 100 * s.score BETWEEN 50 * p.positive_score AND 95 * p.positive_score
      WHERE p.w <= 5
    )
    SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
    """,
)
def hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", label)
    return negatives.hard_negatives(vectors, lambda key: key % 50 == 0)


@query("op13_chosen_path")
def chosen_path_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.near_duplicates(table(spark, sf_dir, "documents"), words=5, share=85).drop("text_hash")


#: crc32 of an ASCII string, byte by byte and bit by bit
_CRC = """
  xor(CAST(list_reduce(list_concat([4294967295], list_transform(string_split({0}, ''), lambda c: CAST(ord(c) AS BIGINT))),
      lambda acc, b: list_reduce(list_concat([xor(acc, b)], [0, 0, 0, 0, 0, 0, 0, 0]),
                                 lambda v, z: CASE WHEN v & 1 = 1 THEN xor(3988292384, v >> 1) ELSE v >> 1 END)) AS BIGINT), 4294967295)
"""


@query(
    "op11_conversation_repair",
    f"""
    WITH RECURSIVE named AS (
      SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name
      FROM conversations
    ), kinds AS (SELECT *, {_CRC.format("name")} % 20 AS kind FROM named),
    damaged AS (
      SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
             CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
             unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
      FROM kinds WHERE kind <> 0
    ), placed AS (
      SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i FROM damaged
    ), seen AS (
      SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS nth, left(role, 1) AS head,
             right(rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS last
      FROM placed
    ), faulted AS (
      SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank' WHEN nth > 1 THEN 'duplicate'
                     WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
             lag(head) OVER (PARTITION BY conv_id ORDER BY i) || head AS pair
      FROM seen
    ), counts AS (
      SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
             count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
             count(*) FILTER (fault = 'truncated') AS truncated,
             count(*) FILTER (i > 1 AND pair NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
      FROM faulted GROUP BY conv_id
    ), best AS (
      -- x0 .. x3: least (cost, audit) with the output at its start, after s, after u, after a
      SELECT conv_id, CAST(0 AS BIGINT) AS i, {{'c': 0, 'a': ''}} AS x0, {{'c': 1000000000, 'a': ''}} AS x1,
             {{'c': 2, 'a': 'I'}} AS x2, {{'c': 4, 'a': 'II'}} AS x3 FROM counts
      UNION ALL
      SELECT conv_id, i, y0, y1,
             list_min([y2, {{'c': y0.c + 2, 'a': y0.a || 'I'}}, {{'c': y1.c + 2, 'a': y1.a || 'I'}}, {{'c': y3.c + 2, 'a': y3.a || 'I'}}]),
             list_min([y3, {{'c': y2.c + 2, 'a': y2.a || 'I'}}, {{'c': y0.c + 4, 'a': y0.a || 'II'}}, {{'c': y1.c + 4, 'a': y1.a || 'II'}}])
      FROM (
        SELECT b.conv_id, f.i, {{'c': x0.c + 3, 'a': x0.a || 'D'}} AS y0,
               list_min([{{'c': x1.c + 3, 'a': x1.a || 'D'}}, {{'c': x0.c + CASE WHEN head = 's' THEN t ELSE 1000000000 END, 'a': x0.a || 'K'}}]) AS y1,
               list_min([{{'c': x2.c + 3, 'a': x2.a || 'D'}},
                         {{'c': x0.c + k, 'a': x0.a || e}}, {{'c': x1.c + k, 'a': x1.a || e}}, {{'c': x3.c + k, 'a': x3.a || e}}]) AS y2,
               list_min([{{'c': x3.c + 3, 'a': x3.a || 'D'}}, {{'c': x2.c + g, 'a': x2.a || h}}]) AS y3
        FROM best b JOIN (
          SELECT *, CASE WHEN fault IN ('blank', 'duplicate') THEN 1000000000 WHEN fault = 'truncated' THEN 1 ELSE 0 END AS t,
                 t + CASE WHEN head = 'u' THEN 0 ELSE 2 END AS k, CASE WHEN head = 'u' THEN 'K' ELSE 'R' END AS e,
                 t + CASE WHEN head = 'a' THEN 0 ELSE 2 END AS g, CASE WHEN head = 'a' THEN 'K' ELSE 'R' END AS h
          FROM faulted
        ) f ON b.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = b.i + 1
      )
    ), chosen AS (
      SELECT c.*, list_min([x0, x3]) AS x FROM counts c JOIN best b ON c.conv_id IS NOT DISTINCT FROM b.conv_id AND b.i = c.n
    ), letters AS (
      SELECT conv_id, unnest(string_split(x.a, '')) AS letter, generate_subscripts(string_split(x.a, ''), 1) AS j FROM chosen WHERE x.a <> ''
    ), steps AS (
      SELECT *, count(*) FILTER (letter <> 'I') OVER (PARTITION BY conv_id ORDER BY j) AS i,
             count(*) FILTER (letter <> 'D') OVER (PARTITION BY conv_id ORDER BY j) - 1 AS k,
             count(*) FILTER (letter <> 'D') OVER (PARTITION BY conv_id) % 2 AS odd
      FROM letters
    ), repaired AS (
      SELECT s.conv_id, string_agg(CASE WHEN letter = 'K' THEN f.role WHEN k % 2 = odd THEN 'user' ELSE 'assistant' END
                                   || ':' || CASE WHEN letter = 'I' THEN '' ELSE f.text END, chr(10) ORDER BY j) AS body
      FROM steps s LEFT JOIN faulted f ON s.conv_id IS NOT DISTINCT FROM f.conv_id AND s.i = f.i WHERE letter <> 'D' GROUP BY s.conv_id
    )
    SELECT o.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
           coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal, CAST(coalesce(c.x.c, 0) AS BIGINT) AS cost,
           coalesce(c.x.a, '') AS audit, sha256(coalesce(r.body, '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN chosen c ON o.conv_id IS NOT DISTINCT FROM c.conv_id
    LEFT JOIN repaired r ON o.conv_id IS NOT DISTINCT FROM r.conv_id
    """,
)
def conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(repair.damage(table(spark, sf_dir, "conversations")))
