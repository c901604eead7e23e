"""Queries of the training-data operators: ``opN_<name>`` and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from txstream.llm import centroids, chat, chosen_path, conversation_repair, decontaminate, html_text, language_crf, license_scan, mixing, quality, risk_rules, token_files, toxicity
from txstream.session import scratch_path

TOKENIZER, END_ID = "byte_bpe_50k.json", 2


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


# Texts travel to Python workers in batches of about this size: two workers of an
# executor then stay within a few hundred MB beside its heap.
BATCH_BYTES = "4m"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_chat_formatting(spark: SparkSession, sf: str) -> DataFrame:
    """All conversations and conversation -7, whose texts hold control strings."""
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"))
    rows = table(spark, sf, "conversations").select(
        "conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    return chat.digest(chat.prefix_target_examples(rows.unionByName(extra)))


def op2_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    """Scores of all documents from their words and their sites; what is kept."""
    return quality.classify(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op3_language_crf(spark: SparkSession, sf: str) -> DataFrame:
    """Language of all documents by a model of those that are not held out."""
    docs = table(spark, sf, "documents")
    return language_crf.predict(docs, language_crf.train(docs))


def op4_risk_controlled_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of all documents, base rules and rules with risk-controlled cutoffs."""
    return risk_rules.judge(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op5_mixing_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Words the mixture takes of every document, with its source's target."""
    return mixing.mixture(table(spark, sf, "documents")).select(
        "doc_id", "source", "size", "source_size", "target", "taken")


def op6_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Base phrases and license notices in all documents."""
    return license_scan.scan_licenses(table(spark, sf, "documents"))


def op7_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    """Main text of all pages."""
    return html_text.main_text(table(spark, sf, "pages"))


def op8_huffman_token_files(spark: SparkSession, sf: str) -> DataFrame:
    """All documents as Huffman-coded token files; the digest is read back from them."""
    folder = scratch_path(spark, "token-files")
    token_files.write_token_files(table(spark, sf, "documents"), folder, tokenizer_path(), END_ID)
    return token_files.read_token_files(spark, folder)


def op9_winnowing_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    """Words of all documents inside ten-word windows of benchmark items."""
    return decontaminate.report(decontaminate.contamination(
        table(spark, sf, "documents"), table(spark, sf, "benchmark")))


def op10_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    """Five-word shingles, Jaccard 0.8: class and number of links of every document."""
    return chosen_path.jaccard_join(table(spark, sf, "documents")).select(
        "doc_id", "class_id", "n_links", "copies")


def op11_centroid_clustering(spark: SparkSession, sf: str) -> DataFrame:
    """40 clusters of all whole vectors after five rounds, on exact integers."""
    return centroids.clusters(table(spark, sf, "embeddings"))


def op12_toxicity_kneser_ney(spark: SparkSession, sf: str) -> DataFrame:
    """Toxicity of all documents by models of the labelled ones that are not held out."""
    return toxicity.score(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op13_conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    """Faults, cheapest edits and repaired rows of all conversations after repeatable damage."""
    rows = table(spark, sf, "conversations")
    return conversation_repair.report(conversation_repair.damage(rows), rows)


def pipeline(spark: SparkSession, sf: str) -> DataFrame:
    """``corpus_pipeline.run``: its stages build on the helpers above, so it is imported late."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_formatting": op1_chat_formatting,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_language_crf": op3_language_crf,
    "op4_risk_controlled_rules": op4_risk_controlled_rules,
    "op5_mixing_sources": op5_mixing_sources,
    "op6_license_scan": op6_license_scan,
    "op7_html_extraction": op7_html_extraction,
    "op8_huffman_token_files": op8_huffman_token_files,
    "op9_winnowing_decontamination": op9_winnowing_decontamination,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_centroid_clustering": op11_centroid_clustering,
    "op12_toxicity_kneser_ney": op12_toxicity_kneser_ney,
    "op13_conversation_repair": op13_conversation_repair,
    "pipeline": pipeline,
}

ORACLE: dict[str, str] = {}

ORACLE["op1_chat_formatting"] = r"""
WITH c AS (
  SELECT conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, '') AS role,
         coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, length(regexp_replace(text, '([<\[])(\\*)(/?s>|/?SYS\]|/?INST\]|OUT\]|/?ROLE\])',
                                  '\1\\\2\3', 'g')) AS nt,
            length(regexp_replace(role, '([<\[])(\\*)(/?s>|/?SYS\]|/?INST\]|OUT\]|/?ROLE\])',
                                  '\1\\\2\3', 'g')) AS nr FROM c
), n AS (
  SELECT *, CASE role WHEN 'system' THEN 20 + nt WHEN 'user' THEN 22 + nt
                 WHEN 'assistant' THEN 13 + nt ELSE 21 + nr + nt END AS chars,
         row_number() OVER (PARTITION BY conv_id
                            ORDER BY turn NULLS FIRST, role, text) AS i,
         count(*) OVER (PARTITION BY conv_id) AS n_turns FROM e
), x AS (
  SELECT *, sum(CASE WHEN role = 'assistant' OR i = n_turns THEN 1 ELSE 0 END)
              OVER (PARTITION BY conv_id ORDER BY i
                    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS uses FROM n
)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (WHERE role = 'assistant'), ''))
         AS loss_sha256,
       CAST(sum(chars * uses) AS BIGINT) AS formatted_chars,
       CAST(max(uses) AS BIGINT) AS n_examples
FROM x GROUP BY conv_id
"""

_ALNUM_WORDS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

ORACLE["op9_winnowing_decontamination"] = f"""
WITH d AS (SELECT row_number() OVER () AS uid, doc_id, coalesce({_ALNUM_WORDS}, []) AS w
           FROM documents),
b AS (SELECT item_id, {_ALNUM_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
iw AS (
  SELECT DISTINCT item_id, l, array_to_string(w[i:i + l - 1], ' ') AS win FROM (
    SELECT item_id, w, l, unnest(range(1, len(w) - l + 2)) AS i FROM (
      SELECT item_id, w, least(10, len(w)) AS l FROM b WHERE len(w) > 0))
), dw AS (
  SELECT uid, l, i, array_to_string(w[i:i + l - 1], ' ') AS win FROM (
    SELECT uid, w, l, unnest(range(1, len(w) - l + 2)) AS i
    FROM d, (SELECT DISTINCT l FROM iw) WHERE len(w) >= l)
), h AS (SELECT uid, l, i, item_id FROM dw JOIN iw USING (l, win)),
p AS (SELECT uid, count(DISTINCT x) AS n_hit
      FROM (SELECT uid, unnest(range(i, i + l)) AS x FROM (SELECT DISTINCT uid, l, i FROM h))
      GROUP BY uid),
t AS (SELECT uid, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
      FROM (SELECT DISTINCT uid, CAST(item_id AS VARCHAR) AS id FROM h WHERE item_id IS NOT NULL)
      GROUP BY uid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p USING (uid) LEFT JOIN t USING (uid)
"""

ORACLE["op5_mixing_sources"] = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))
                              AS BIGINT) AS size,
    CASE WHEN coalesce(length(text), 0) = 0 THEN 1.0::DOUBLE ELSE greatest(0.05::DOUBLE, 1.0::DOUBLE
      - length(regexp_replace(text, '[\p{L}\x20\x09-\x0D]+', '', 'g'))::DOUBLE / length(text)) END AS q,
    CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR),
         'text ' || md5(coalesce(text, '')))), 1, 13) AS BIGINT) AS bits
  FROM documents
), k AS (SELECT *, -ln((bits::DOUBLE + 0.5) / 4503599627370496::DOUBLE) / q AS key FROM d),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, 2.0::DOUBLE * source_size AS cap,
        CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE
             WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight FROM s),
l AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER (
          ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST
                            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (SELECT source, source_size, coalesce(least(cap, weight * (
          SELECT arg_min(level, cap / weight) FROM l WHERE level <= cap / weight)), cap) AS target FROM l),
b AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 1 END
        AS epochs FROM t),
f AS (
  SELECT k.*, source_size, target, epochs,
    CASE WHEN source_size > 0 THEN target - epochs * source_size ELSE 0 END AS budget,
    sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id NULLS LAST, size
                    RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
    sum(size) OVER (PARTITION BY k.source, key, doc_id, size) AS grp
  FROM k JOIN b ON k.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, source, size, source_size, target,
  CAST(size * (epochs + CASE WHEN budget > 0 AND 2 * upto - grp <= 2 * budget THEN 1 ELSE 0 END)
       AS BIGINT) AS taken
FROM f
"""


def _kmeans_sql(rounds: int = 5) -> str:
    """The rounds written out one after the other."""
    sql = """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS id, CAST(vec_id AS BIGINT) AS vec_id,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(CAST(x AS DOUBLE)))) = 64),
x AS MATERIALIZED (SELECT id, i, v[i] AS x FROM v, range(1, 65) t(i)),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id) NULLS LAST, v) - 1 AS c, v FROM v
  QUALIFY c < 40)"""
    for r in range(rounds + 1):
        sql += f""",
a{r} AS MATERIALIZED (
  SELECT id, CAST(m % 64 AS BIGINT) AS c, CAST(m // 64 AS BIGINT) AS d FROM (
    SELECT id, min(CAST(list_sum(list_transform(range(1, 65),
      lambda i: (v.v[i] - c.v[i]) * (v.v[i] - c.v[i]))) AS HUGEINT) * 64 + c) AS m
    FROM v, c{r} c GROUP BY id))"""
        if r < rounds:
            sql += f""",
c{r + 1} AS MATERIALIZED (
  SELECT c{r}.c, coalesce(n.v, c{r}.v) AS v FROM c{r} LEFT JOIN (
    SELECT c, list(m ORDER BY i) AS v FROM (
      SELECT c, i, CAST(floor(CAST(sum(x) AS DOUBLE) / count(*)) AS BIGINT) AS m
      FROM a{r} JOIN x USING (id) GROUP BY c, i) GROUP BY c) n USING (c))"""
    return sql + f"""
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, d AS distance,
  CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(f.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN v USING (id) JOIN c{rounds} f ON f.c = a.c
"""


ORACLE["op11_centroid_clustering"] = _kmeans_sql()

ORACLE["op13_conversation_repair"] = r"""
WITH RECURSIVE t(i, c, k) AS (
  SELECT i, CAST(i AS BIGINT), 0 FROM range(256) r(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1
  FROM t WHERE k < 8),
tab AS (SELECT list(c ORDER BY i) AS tab FROM t WHERE k = 8),
r AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(
      coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
      lambda x: CAST(ord(x) AS BIGINT))),
      lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), CAST(4294967295 AS BIGINT)) % 20 AS m
  FROM conversations, tab),
d AS (
  SELECT conv_id, turn, CASE m WHEN 4 THEN 'user' ELSE role END AS role,
    CASE m WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE m WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM r WHERE m <> 0),
o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS pos,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS shown,
    CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'o' END AS ini
  FROM d),
f AS (
  SELECT *, CASE WHEN shown = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate'
                 WHEN right(shown, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(ini) OVER (PARTITION BY conv_id ORDER BY pos) AS prev
  FROM o),
s AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (prev IS NOT NULL AND prev || ini NOT IN ('su', 'ua', 'au')) AS illegal,
    list(ini ORDER BY pos) AS ini, list(fault ORDER BY pos) AS fault, count(*) AS n
  FROM f GROUP BY conv_id),
dp(conv_id, i, b) AS (
  SELECT conv_id, n + 1, [{'c': 0, 'a': ''}, {'c': 6, 'a': 'II'}, {'c': 3, 'a': 'I'}, {'c': 0, 'a': ''}] FROM s
  UNION ALL
  SELECT conv_id, i, [list_min([z[1], {'c': 3 + y.c, 'a': 'I' || y.a}]), list_min([z[2], {'c': 3 + y.c, 'a': 'I' || y.a}]),
                      y, list_min([z[4], {'c': 3 + y.c, 'a': 'I' || y.a}])]
  FROM (
    SELECT conv_id, i, z, list_min([z[3], {'c': 3 + z[4].c, 'a': 'I' || z[4].a}]) AS y FROM (
      SELECT conv_id, i, list_transform([1, 2, 3, 4], lambda q: list_min([
        {'c': 4 + b[q].c, 'a': 'D' || b[q].a},
        CASE WHEN stay AND r = 's' AND q = 1 THEN {'c': p + b[2].c, 'a': 'K' || b[2].a}
             WHEN stay AND r = 'u' AND q <> 3 THEN {'c': p + b[3].c, 'a': 'K' || b[3].a}
             WHEN stay AND r = 'a' AND q = 3 THEN {'c': p + b[4].c, 'a': 'K' || b[4].a}
             ELSE {'c': 1000000000, 'a': 'Z'} END,
        CASE WHEN NOT stay THEN {'c': 1000000000, 'a': 'Z'}
             WHEN q = 3 THEN {'c': 3 + p + b[4].c, 'a': 'R' || b[4].a}
             ELSE {'c': 3 + p + b[3].c, 'a': 'R' || b[3].a} END])) AS z
      FROM (SELECT dp.conv_id, dp.i - 1 AS i, b, s.ini[dp.i - 1] AS r,
              s.fault[dp.i - 1] NOT IN ('blank', 'duplicate') AS stay,
              CASE WHEN s.fault[dp.i - 1] = 'truncated' THEN 3 ELSE 0 END AS p
            FROM dp JOIN s ON dp.conv_id IS NOT DISTINCT FROM s.conv_id WHERE dp.i > 1)))),
w AS (SELECT conv_id, b[1].c AS cost, b[1].a AS audit FROM dp WHERE i = 1),
e AS (
  SELECT conv_id, letter, sum(CASE WHEN letter <> 'I' THEN 1 ELSE 0 END) OVER v AS pos,
    sum(CASE WHEN letter <> 'D' THEN 1 ELSE 0 END) OVER v - 1 AS place
  FROM (SELECT conv_id, k, substr(audit, k, 1) AS letter
        FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS k FROM w))
  WINDOW v AS (PARTITION BY conv_id ORDER BY k ROWS UNBOUNDED PRECEDING)),
g AS (
  SELECT e.conv_id, letter, place, f.role, f.text,
    max(CASE WHEN place = 0 AND letter = 'K' AND ini = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY e.conv_id) AS led
  FROM e LEFT JOIN f ON e.conv_id IS NOT DISTINCT FROM f.conv_id AND e.pos = f.pos
  WHERE letter <> 'D'),
h AS (
  SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN (place - led) % 2 = 0 THEN 'user' ELSE 'assistant' END
    || ':' || CASE WHEN letter = 'I' THEN '' ELSE text END, chr(10) ORDER BY place) AS whole
  FROM g GROUP BY conv_id)
SELECT ids.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
  CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
  CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost,
  coalesce(audit, '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) ids
LEFT JOIN s ON ids.conv_id IS NOT DISTINCT FROM s.conv_id
LEFT JOIN w ON ids.conv_id IS NOT DISTINCT FROM w.conv_id
LEFT JOIN h ON ids.conv_id IS NOT DISTINCT FROM h.conv_id
"""
