"""The registered queries of the numbered operators, each over its whole table, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from audience_engine.llm import (
    contamination,
    conversations,
    language,
    line_dedup,
    mixing,
    periodic_runs,
    pieces,
    quality_classifier,
    quality_rules,
    repeats,
    simhash,
    token_counts,
    vectors,
)
from audience_engine.plans.views import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def registered(name: str, check: str | None = None):
    def register(build):
        QUERIES[name] = build
        if check:
            CHECKS[name] = check.strip()
        return build

    return register


_RULES = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, coalesce('=' || source, '') AS host FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws FROM d),
raw_lines AS (SELECT rid, host, t, unnest(string_split(t, chr(10))) AS l FROM d),
lines AS (SELECT rid, host, t, l, regexp_extract_all(l, '[^\\x20\\x09-\\x0D]+') AS ws FROM raw_lines WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]')),
dup AS (SELECT rid, count(*) - count(DISTINCT l) AS n FROM lines GROUP BY rid),
win AS (SELECT rid, i, array_to_string(ws[i:i + 7], ' ') AS g FROM (SELECT rid, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8) x),
twice AS (SELECT rid, g FROM win GROUP BY rid, g HAVING count(*) >= 2),
rep AS (SELECT rid, count(DISTINCT i + j) AS n FROM win JOIN twice USING (rid, g), (SELECT unnest(range(0, 8)) AS j) k GROUP BY rid),
norm AS (SELECT rid, host, t, translate(array_to_string(ws, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k, len(ws) AS n FROM lines),
hosts AS (SELECT host, count(DISTINCT t) AS texts FROM d GROUP BY host),
over_limit AS (SELECT host, k FROM norm JOIN hosts USING (host) GROUP BY host, k, texts HAVING count(DISTINCT t) > 10 AND count(DISTINCT t) > 0.1 * texts),
gone AS (SELECT rid, count(*) AS n_lines, sum(n) AS n_words FROM norm JOIN over_limit USING (host, k) GROUP BY rid),
f AS (SELECT doc_id, len(ws) AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
  length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(dup.n, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
  coalesce(gone.n_lines, 0) AS n_removed_lines, coalesce(gone.n_words, 0) AS n_removed_words
  FROM w LEFT JOIN dup USING (rid) LEFT JOIN rep USING (rid) LEFT JOIN gone USING (rid))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, CAST(n_removed_lines AS BIGINT) AS n_removed_lines,
  CAST(n_removed_words AS BIGINT) AS n_removed_words, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND n_removed_words <= 0.5 * n_words AS kept
FROM f
"""


@registered("op1_quality_rules", _RULES)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


@registered("op2_quality_classifier")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = quality_classifier.held_out("doc_id")
    weights = quality_classifier.train(docs.filter(~held), table(spark, sf_dir, "labels"))
    scored = quality_classifier.score(docs, weights)
    predicted = (F.col("score") >= quality_classifier.THRESHOLD).cast("int")
    return scored.select("doc_id", held.alias("held_out"), "score", predicted.alias("predicted"))


_LINES = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT rid, doc_id, i, ls[i] AS line, translate(trim(ls[i], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM (SELECT *, unnest(range(1, len(ls) + 1)) AS i FROM d) x),
often AS (SELECT k FROM l WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT rid) >= 10),
m AS (SELECT l.*, often.k IS NOT NULL AS gone FROM l LEFT JOIN often USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY rid, doc_id
"""


@registered("op4_line_dedup", _LINES)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return out.select("doc_id", "n_lines", "n_dropped", digest.alias("kept_sha256"))


@registered("op8_language")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = quality_classifier.held_out("doc_id", 3, 1)
    found = language.identify(docs, *language.train(docs.filter(~held)))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score", "languages")


@registered("op10_mixing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "copies", "taken")


@registered("op3_token_counts")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    edited = token_counts.counts_after(table(spark, sf_dir, "documents"))
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("edited_sha256")
    return edited.select("doc_id", "n_tokens", "n_pretokens", "n_edits", "n_encoded", "n_tokens_edited", digest)


@registered("op5_simhash")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


@registered("op6_pieces")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = F.sha2(F.col("text").cast("binary"), 256)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", digest.alias("digest"))
    coded = pieces.encode(docs, carry=("doc_id", "digest"), whole=True)
    second = F.element_at(F.col("pieces.alternatives"), 1)["score"]
    plain = coded.select(
        "doc_id", "digest", F.size("pieces.ids").cast("long").alias("n_pieces"), F.col("pieces.score").alias("score"),
        F.when(F.size("pieces.alternatives") > 0, second).alias("second_score"), F.xxhash64("pieces.ids").alias("ids_hash"),
        F.col("pieces.alternatives.score").alias("other_scores"), F.col("pieces.n_best").alias("ids"),
    )
    hashes = F.transform(F.slice("ids", 2, pieces.N_BEST), lambda own: F.xxhash64(own)).alias("other_hashes")
    carried = ("doc_id", "digest", "n_pieces", "score", "second_score", "ids_hash", "other_scores", "other_hashes")
    back = pieces.decode(plain.select("*", hashes), "ids", carry=carried)
    # every one of the N best segmentations has to give the text back
    same = F.when(F.col("digest").isNull(), F.col("decoded").isNull()).otherwise(
        F.forall("decoded", lambda text: F.sha2(text.cast("binary"), 256) == F.col("digest"))
    )
    return back.select(*[c for c in carried if c != "digest"], F.coalesce(same, F.lit(False)).alias("round_trip"))


@registered("op7_embeddings")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vectors.near_groups(table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "n_links", F.col("component").cast("long").alias("component_id"), F.col("vec_id").eqNullSafe(F.col("component")).alias("kept"))


@registered("op9_repeats")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repeats.without_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@registered("op12_periodic_runs")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find(periodic_runs.looped(table(spark, sf_dir, "documents").select("doc_id", "text")), texts=False)
    lines = F.transform("runs", lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]))
    listed = F.array_join(F.transform(lines, lambda line: F.concat(line, F.lit("\n"))), "")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *[F.col(f"strongest.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), "collapsed_sha256",
    )


_LEAKS = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(len(ws), 10) AS n, array_to_string(ws[i:i + least(len(ws), 10) - 1], ' ') AS g
  FROM (SELECT *, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM b WHERE len(ws) > 0) x),
dw AS (SELECT rid, n, i, array_to_string(ws[i:i + n - 1], ' ') AS g
  FROM (SELECT rid, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM iw) k WHERE len(ws) >= n) x),
hit AS (SELECT rid, i, n, item_id FROM dw JOIN iw USING (n, g)),
covered AS (SELECT rid, count(DISTINCT i + j) AS n_hit FROM (SELECT DISTINCT rid, i, n FROM hit) h, (SELECT unnest(range(0, 10)) AS j) k WHERE j < n GROUP BY rid),
listed AS (SELECT rid, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM hit GROUP BY rid)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (rid) LEFT JOIN listed USING (rid)
"""


@registered("op13_contamination", _LEAKS)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    n_items = F.size("items").cast("long")
    return found.select("doc_id", "n_words", "n_hit", n_items.alias("n_items"), digest.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def _more(value: str, price: int, letter: str) -> str:
    """SQL of a cost and audit (the cost in nine digits, then the letters) after one more edit."""
    return f"lpad(CAST(CAST(left({value}, 9) AS BIGINT) + {price} AS VARCHAR), 9, '0') || substr({value}, 10) || '{letter}'"


_TURNS = f"""
WITH RECURSIVE given AS (SELECT dense_rank() OVER (ORDER BY conv_id) AS cid, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
crc AS (SELECT *, xor(4294967295, list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(k, ''), lambda c: CAST(ascii(c) AS BIGINT))),
  lambda c, b: list_reduce(list_concat([xor(c, b)], CAST(range(8) AS BIGINT[])), lambda y, i: xor(y >> 1, 3988292384 * (y & 1))))) % 20 AS x FROM given),
spoilt AS (SELECT cid, conv_id, turn, CASE WHEN x = 4 THEN 'user' ELSE role END AS role,
  CASE WHEN x = 1 THEN '' WHEN x = 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM crc, (SELECT unnest([1, 2]) AS n) times WHERE x <> 0 AND n <= CASE WHEN x = 3 THEN 2 ELSE 1 END),
ordered AS (SELECT *, row_number() OVER (PARTITION BY cid ORDER BY turn NULLS FIRST, role, text) AS i FROM spoilt),
placed AS (SELECT *, row_number() OVER (PARTITION BY cid, role, text ORDER BY i) AS time, left(role, 1) AS f,
  lag(left(role, 1)) OVER (PARTITION BY cid ORDER BY i) AS before,
  right(rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS final FROM ordered),
faulty AS (SELECT *, CASE WHEN final = '' THEN 'b' WHEN time > 1 THEN 'd' WHEN final NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault FROM placed),
counts AS (SELECT cid, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'b') AS blank,
  count(*) FILTER (WHERE fault = 'd') AS duplicate, count(*) FILTER (WHERE fault = 't') AS truncated,
  count(*) FILTER (WHERE before || f NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM faulty GROUP BY cid),
steps(cid, i, n, s, u, a) AS (SELECT DISTINCT cid, CAST(0 AS BIGINT), '000000000', CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR) FROM given
  UNION ALL
  SELECT z.cid, f.i, {_more("n", 4, "D")},
    least({_more("s", 4, "D")}, CASE WHEN stay AND f.f = 's' THEN CASE WHEN f.fault = 't' THEN {_more("n", 3, "K")} ELSE {_more("n", 0, "K")} END END),
    least({_more("ui", 4, "D")}, CASE WHEN stay THEN CASE WHEN f.fault = 't' THEN {_more("ub", 6, "R")} ELSE {_more("ub", 3, "R")} END END,
      CASE WHEN stay AND f.f = 'u' THEN CASE WHEN f.fault = 't' THEN {_more("ub", 3, "K")} ELSE {_more("ub", 0, "K")} END END),
    least({_more("ai", 4, "D")}, CASE WHEN stay THEN CASE WHEN f.fault = 't' THEN {_more("ui", 6, "R")} ELSE {_more("ui", 3, "R")} END END,
      CASE WHEN stay AND f.f = 'a' THEN CASE WHEN f.fault = 't' THEN {_more("ui", 3, "K")} ELSE {_more("ui", 0, "K")} END END)
  FROM (SELECT *, least(n, s, ai) AS ub FROM (SELECT *, least(a, {_more("ui", 3, "I")}) AS ai
    FROM (SELECT *, least(u, {_more("least(n, s, a)", 3, "I")}) AS ui FROM steps) q) r) z
  JOIN (SELECT *, fault NOT IN ('b', 'd') AS stay FROM faulty) f ON f.cid = z.cid AND f.i = z.i + 1),
found AS (SELECT cid, CAST(left(best, 9) AS BIGINT) AS cost, substr(best, 10) AS audit FROM (SELECT cid, least(n, a, {_more("ui", 3, "I")}) AS best
  FROM (SELECT steps.*, least(u, {_more("least(steps.n, s, a)", 3, "I")}) AS ui FROM steps LEFT JOIN counts USING (cid) WHERE i = coalesce(counts.n, 0)) q) r),
letters AS (SELECT cid, j, audit[j] AS e, count(*) FILTER (WHERE audit[j] <> 'I') OVER w AS i, count(*) FILTER (WHERE audit[j] <> 'D') OVER w AS place
  FROM (SELECT cid, audit, unnest(range(1, length(audit) + 1)) AS j FROM found) q WINDOW w AS (PARTITION BY cid ORDER BY j)),
edited AS (SELECT l.*, f.role, f.text, max(CASE WHEN e = 'K' AND place = 1 AND f.f = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY l.cid) AS lead
  FROM letters l LEFT JOIN faulty f ON f.cid = l.cid AND f.i = l.i AND e <> 'I' WHERE e <> 'D'),
hashed AS (SELECT cid, sha256(string_agg(CASE WHEN e = 'K' THEN role WHEN (place - lead) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''),
  chr(10) ORDER BY j)) AS digest FROM edited GROUP BY cid)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
  CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, cost, audit, coalesce(digest, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT cid, conv_id FROM given) g JOIN found USING (cid) LEFT JOIN counts USING (cid) LEFT JOIN hashed USING (cid)
"""


@registered("op11_conversations", _TURNS)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(conversations.damaged(table(spark, sf_dir, "conversations")), "dropped")
