"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltbed.llm import bitplane, bpe, chat, html_wrappers, iblt, isomedia, mixing, periodic, pii, resampling, simhash, toxicity, warc
from siltbed.llm.common import table


def vocabulary() -> str:
    """Where this machine keeps the public vocabulary; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_html_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_wrappers.extract(table(spark, sf_dir, "pages"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.predictions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), keep=["doc_id"])


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.captures(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary())


def op6_bitplane_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitplane.digests(table(spark, sf_dir, "documents"), vocabulary())


def op7_isomedia(spark: SparkSession, sf_dir: str) -> DataFrame:
    return isomedia.features(table(spark, sf_dir, "documents"))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iblt.compared(table(spark, sf_dir, "documents"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.report(table(spark, sf_dir, "documents"), plant_by="doc_id")


def op12_chat_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.report(table(spark, sf_dir, "conversations"))


def op13_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_html_wrappers": op1_html_wrappers,
    "op2_toxicity": op2_toxicity,
    "op3_source_mixing": op3_source_mixing,
    "op4_warc": op4_warc,
    "op5_bpe_encode_decode": op5_bpe_encode_decode,
    "op6_bitplane_ids": op6_bitplane_ids,
    "op7_isomedia": op7_isomedia,
    "op8_simhash_near_dedup": op8_simhash_near_dedup,
    "op9_document_fingerprints": op9_document_fingerprints,
    "op10_pii": op10_pii,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_chat_events": op12_chat_events,
    "op13_target_resampling": op13_target_resampling,
}

#: The other operators fit models, run automata, or write formats that SQL can't
#: express; tests hold them against brute force, other libraries and round trips.
ORACLE_SQL: dict[str, str] = {
    "op3_source_mixing": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, CASE WHEN source IS NULL THEN 'n' ELSE 'a' || source END AS src FROM documents),
s AS (SELECT *, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS size FROM d),
k AS (SELECT doc_id, src, size,
  -ln((CAST('0x' || substr(sha256('0' || chr(31) || coalesce(CAST(doc_id AS VARCHAR), '') || chr(31) || t), 1, 13) AS BIGINT) + 0.5e0) / 4503599627370496e0)
  / (1e0 + 3e0 * (1e0 - least(1e0, abs(length(t) / CAST(greatest(size, 1) AS DOUBLE) - 6e0) / 6e0))) AS key FROM s),
g AS (SELECT src, CAST(sum(size) AS BIGINT) AS source_size, CAST([5, 2, 1][(row_number() OVER (ORDER BY src) - 1) % 3 + 1] AS DOUBLE) AS weight FROM k GROUP BY src),
c AS (SELECT *, 2e0 * source_size / weight AS ratio FROM g),
l AS (SELECT *, (1.5e0 * sum(source_size) OVER () - coalesce(sum(2e0 * source_size) OVER (ORDER BY ratio, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / sum(weight) OVER (ORDER BY ratio, src ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM c),
m AS (SELECT src, source_size, least(2e0 * source_size, (SELECT arg_min(level, ratio) FROM l WHERE level <= ratio) * weight) AS target FROM l),
e AS (SELECT *, floor(target / greatest(source_size, 1)) AS epochs FROM m),
r AS (SELECT *, CAST(round(target - epochs * source_size) AS BIGINT) AS rest FROM e)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
  CAST(epochs * size + greatest(0, least(size, rest - (sum(size) OVER (PARTITION BY src ORDER BY key, size ROWS UNBOUNDED PRECEDING) - size))) AS BIGINT) AS taken
FROM k JOIN r USING (src)""",
    "op4_warc": r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
h AS (SELECT page_id, strlen(t) AS payload_bytes, sha1(t) AS x FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY x) AS first FROM h)
SELECT page_id, payload_bytes,
  list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((CAST('0x' || substr(x, 5 * (i // 4) + 1, 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS BIGINT) + 1, 1) FOR i IN range(32)], 'string_agg', '') AS payload_digest,
  CASE WHEN page_id IS DISTINCT FROM first AND first IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM f""",
    # a control string or a backslash costs one character more; brackets of the turns by role
    "op12_chat_events": r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS t FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
l AS (SELECT *, 7 + CASE role WHEN 'system' THEN 11 WHEN 'user' THEN 13 WHEN 'assistant' THEN 0 ELSE 13 + length(role) + len(regexp_extract_all(role, '\\|</?s>|\[/?(SYS|INST|ROLE)\]')) END
  + length(t) + len(regexp_extract_all(t, '\\|</?s>|\[/?(SYS|INST|ROLE)\]')) AS n FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || t || chr(10), '' ORDER BY turn, role, t)) AS turns_sha256,
  CAST(coalesce(sum(length(t)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(t, '' ORDER BY turn, role, t) FILTER (role = 'assistant'), '')) AS loss_sha256, CAST(sum(n) AS BIGINT) AS formatted_chars
FROM l GROUP BY conv_id""",
    # the crc32 of each distinct word, byte by byte, from the table that its polynomial gives
    "op13_target_resampling": r"""
WITH tab AS (SELECT list(list_reduce(list_prepend(CAST(i AS BIGINT), CAST(range(8) AS BIGINT[])), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) r(i)),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
f AS (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest(ws) AS w FROM d) GROUP BY ALL),
v AS (SELECT w, xor(list_reduce(list_prepend(4294967295, [CAST('0x' || substr(hex(encode(w)), 2 * i + 1, 2) AS BIGINT) FOR i IN range(strlen(w))]), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket FROM (SELECT w FROM f UNION SELECT w FROM b), tab),
s AS (SELECT bucket, sum(n) AS s FROM f JOIN v USING (w) GROUP BY 1), t AS (SELECT bucket, count(*) AS t FROM b JOIN v USING (w) GROUP BY 1),
g AS (SELECT bucket, CAST(floor(1000 * ln(CAST((coalesce(t, 0) + 1) * ((SELECT sum(s) FROM s) + 10000) AS DOUBLE) / CAST((s + 1) * (coalesce((SELECT sum(t) FROM t), 0) + 10000) AS DOUBLE))) AS BIGINT) AS gain FROM s LEFT JOIN t USING (bucket)),
w AS (SELECT doc_id, CAST(sum(n * gain) AS BIGINT) AS weight FROM f JOIN v USING (w) JOIN g USING (bucket) GROUP BY 1),
k AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
  coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5e0) / 4294967296e0))) AS BIGINT) AS score FROM d LEFT JOIN w USING (doc_id)),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM k WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= n * 10 // 100 THEN rank END AS rank FROM k LEFT JOIN r USING (doc_id)""",
}
