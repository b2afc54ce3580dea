"""Draft, variant and experiment queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from audience_engine.functions import drafts, scoring
from audience_engine.operators import experiments, topics, variants
from audience_engine.plans import expected
from audience_engine.plans.registry import Inputs, any_in, query, stripped
from audience_engine.plans.topic_queries import CENTERS, DISTANCES
from audience_engine.settings import Settings
from audience_engine.session import staging_path
from audience_engine.sources import readers
from audience_engine.sources.versions import VersionedTable
from audience_engine.streaming.jobs import approvals as approval_rows

CFG = Settings()


def comments(t: Inputs):
    return t.comments.withColumnRenamed("text", "comment")


# --- captions and drafts ---------------------------------------------------------------------------------------------

SNIPPET = "CASE WHEN length(text) > 100 THEN concat(" + stripped("substr(text, 1, 100)") + ", '...') ELSE text END"
TEMPLATES = ", ".join("'" + template.replace("'", "''") + "'" for template in expected.CAPTION_TEMPLATES)


@query(
    "variants",
    f"""SELECT concat(CAST(comment_id AS VARCHAR), '_', CAST(i AS VARCHAR)) AS variant_id, md5(text) AS original_comment,
    replace([{TEMPLATES}][i + 1], '{{snippet}}', {SNIPPET}) AS variant_text, source
    FROM comments CROSS JOIN range(0, {len(expected.CAPTION_TEMPLATES)}) r(i)""",
    ["comments"],
)
def make_variants(t: Inputs):
    return variants.make_variants(comments(t)).withColumn("original_comment", F.md5("original_comment"))


def bare(text: str) -> str:
    return f"trim({stripped(text)}, '\"')"


DRAFTED = f"""
drafted AS (SELECT *, CASE WHEN contains(raw_text, '||') THEN {bare("substr(raw_text, 1, strpos(raw_text, '||') - 1)")}
    WHEN len(lines) >= 2 THEN lines[1] ELSE raw_text END AS caption,
  CASE WHEN contains(raw_text, '||') THEN {bare("substr(raw_text, strpos(raw_text, '||') + 2)")}
    WHEN len(lines) >= 2 THEN lines[2] ELSE '' END AS cta FROM (
  SELECT *, list_filter(list_transform(regexp_split_to_array(raw_text, '\\r\\n|\\r|\\n'),
    lambda x: {stripped('x')}), lambda x: x <> '') AS lines FROM llm_drafts))"""


@query("split_caption", "SELECT variant_id, caption, cta FROM drafted", ["llm_drafts"], DRAFTED)
def split_caption(t: Inputs):
    return variants.split_drafts(t.llm_drafts).select("variant_id", "caption", "cta")


def platform_drafts(t: Inputs):
    platform = F.when(F.col("topic") % 2 == 0, F.lit("instagram"))
    return variants.split_drafts(t.llm_drafts).withColumn("platform", platform)


@query(
    "latest_drafts",
    """SELECT variant_id, concat('*', topic_name, '* — _', CASE WHEN topic % 2 = 0 THEN 'instagram' ELSE 'generic' END, '_', chr(10),
    '• Caption: ', CASE WHEN caption <> '' THEN caption ELSE substr(raw_text, 1, 240) END, chr(10), '• CTA: ', cta) AS message
    FROM drafted ORDER BY topic DESC, variant_id DESC LIMIT 10""",
    ["llm_drafts"],
    DRAFTED,
)
def latest_drafts(t: Inputs):
    return variants.latest_drafts(platform_drafts(t), 10, ("topic", "variant_id")).select("variant_id", "message")


@query(
    "draft_messages",
    """SELECT variant_id, concat('*', topic_name, '* — _', CASE WHEN topic % 2 = 0 THEN 'instagram' ELSE 'generic' END, '_', chr(10),
    '• Caption: ', CASE WHEN caption <> '' THEN caption ELSE substr(raw_text, 1, 240) END, chr(10), '• CTA: ', cta) AS message
    FROM drafted""",
    ["llm_drafts"],
    DRAFTED,
)
def draft_messages(t: Inputs):
    message = drafts.draft_message("topic_name", "topic", "platform", "caption", "raw_text", "cta")
    return platform_drafts(t).select("variant_id", message.alias("message"))


@query(
    "draft_candidates",
    """SELECT variant_id, topic_name AS topic, substr(CASE WHEN caption <> '' THEN caption ELSE raw_text END, 1, 800) AS variant_text
    FROM drafted ORDER BY drafted.topic, variant_id LIMIT 10""",
    ["llm_drafts"],
    DRAFTED,
)
def draft_candidates(t: Inputs):
    return variants.candidates(variants.split_drafts(t.llm_drafts), 10, ("topic", "variant_id"))


TOPIC_DOCS = (
    CENTERS
    + DISTANCES
    + """,
nearest AS (SELECT label, doc_id, row_number() OVER (PARTITION BY label ORDER BY distance, doc_id) AS rank FROM distances),
topic_docs AS (SELECT CAST(label AS VARCHAR) AS topic, concat('label ', CAST(label AS VARCHAR)) AS name, list(text ORDER BY rank) AS docs,
  CASE WHEN label % 2 = 0 THEN 'positive' ELSE 'neutral' END AS mood, CASE WHEN label % 3 = 0 THEN 'instagram' ELSE 'generic' END AS platform
  FROM nearest JOIN embedded_docs USING (label, doc_id) WHERE rank <= 3 GROUP BY label)"""
)


def topic_docs(t: Inputs):
    """A summary with each label's representative documents, as the topic run makes it."""
    docs = t.embedded_docs.select("doc_id", "label", "embedding", "text")
    nearest = topics.nearest_docs(docs, topics.centroids(docs, "embedding", "label"), "embedding", "label", "doc_id")
    # three documents per label
    shown = nearest.groupBy("label").agg(F.sort_array(F.collect_list(F.struct("rank", "text"))).alias("d"))
    return shown.select(
        F.col("label").alias("Topic"),
        F.concat(F.lit("label "), F.col("label").cast("string")).alias("Name"),
        F.to_json(F.transform("d", lambda d: d["text"])).alias("Representative_Docs"),
        F.when(F.col("label") % 2 == 0, F.lit("positive")).alias("sentiment_hint"),
        F.when(F.col("label") % 3 == 0, F.lit("instagram")).otherwise(F.lit("")).alias("platform"),
    )


@query(
    "prompts",
    """SELECT topic, md5(concat('You are a marketing copywriter.', chr(10),
    'Goal: Create one short social caption (<=50 words) + a 1-line CTA for platform=', platform, '.', chr(10),
    'Tone should match sentiment: ', mood, '.', chr(10), 'Topic name: ', name, chr(10),
    'Representative audience comments (signal): ', array_to_string(docs[1:3], ' | '), chr(10), chr(10),
    'Return strictly in the format: caption || CTA')) AS prompt FROM topic_docs""",
    views=["embedded_docs"],
    steps=TOPIC_DOCS,
)
def prompts(t: Inputs):
    return variants.topic_prompts(topic_docs(t)).select("topic", F.md5("prompt").alias("prompt"))


@query(
    "heuristic_drafts",
    """SELECT topic, topic_name, sentiment_hint, platform, caption, cta, CAST(length(concat(caption, ' || ', cta)) AS BIGINT) AS raw_length,
    created_utc FROM (
      SELECT topic, name AS topic_name, mood AS sentiment_hint, platform, substr(concat(name, ': ', substr(docs[1], 1, 100)), 1, 240) AS caption,
      CASE WHEN platform = 'generic' THEN 'Learn more' ELSE 'Read more' END AS cta, '2024-03-31T00:00:00Z' AS created_utc FROM topic_docs)""",
    views=["embedded_docs"],
    steps=TOPIC_DOCS,
)
def heuristic_drafts(t: Inputs):
    return variants.generate_drafts(topic_docs(t), CFG.as_of).select(
        "topic", "topic_name", "sentiment_hint", "platform", "caption", "cta", F.col("raw_length").cast("long").alias("raw_length"), "created_utc"
    )


@query(
    "generated_drafts",
    """SELECT topic, caption, cta FROM (SELECT topic, concat('On ', name) AS caption, concat('See ', platform) AS cta, mood FROM topic_docs)
    WHERE mood = 'positive'""",
    views=["embedded_docs"],
    steps=TOPIC_DOCS,
)
def generated_drafts(t: Inputs):
    def answer(prompt: str) -> str:
        if "sentiment: positive" not in prompt:
            return ""
        lines = prompt.split("\n")
        name = next(line for line in lines if line.startswith("Topic name: "))[12:]
        place = prompt.split("platform=", 1)[1].split(".", 1)[0]
        return f' "On {name}" || See {place}'

    return variants.generate_drafts(topic_docs(t), CFG.as_of, answer).select("topic", "caption", "cta")


@query(
    "model_ranking",
    """SELECT conv_id, turn, concat('v', CAST(i AS VARCHAR)) AS variant_id, CAST(conv_id % 7 + i AS DOUBLE) / 10 AS score, 'tone' AS reason
    FROM conversations CROSS JOIN range(1, 4) r(i) WHERE role = 'assistant' AND conv_id % 4 <> 3""",
)
def model_ranking(t: Inputs):
    entry = lambda i: F.concat(
        F.lit(f'{{"variant_id": "v{i}",\n "score": '), (F.col("conv_id") % 7 + i).cast("string"), F.lit('e-1, "reason": "tone"}')
    )
    listed = F.concat(F.lit("[" ), entry(1), F.lit(", "), entry(2), F.lit(","), entry(3), F.lit("]"))
    spoken = F.translate("text", "[]", "()")
    answers = t.conversations.filter("role = 'assistant'").select(
        "conv_id",
        "turn",
        F.when(F.col("conv_id") % 4 == 0, listed)
        .when(F.col("conv_id") % 4 == 3, spoken)
        .otherwise(F.concat(spoken, F.lit("\n"), listed, F.lit("\nDone.")))
        .alias("answer"),
    )
    return variants.model_ranking(answers, "answer").withColumn("score", F.round("score", 6))


@query(
    "approvals",
    """SELECT event_id, concat('u', CAST(user_id AS VARCHAR)) AS "user", concat('t', CAST(user_id % 7 AS VARCHAR)) AS topic,
    concat('v', CAST(user_id % 20 AS VARCHAR)) AS variant FROM events WHERE event_type = 'click'""",
)
def approvals(t: Inputs):
    raw = t.approvals_raw
    return raw.select("event_id", drafts.parse_approval("payload").alias("a")).select("event_id", "a.*")


# --- A/B log ---------------------------------------------------------------------------------------------------------

UPDATES = """
log AS (SELECT * FROM ab_log UNION ALL SELECT post_id, topic, concat(variant_id, 'b') AS variant_id, ts, replies, likes, ctr FROM ab_log),
updates AS (SELECT post_id, ts, replies + 1 AS replies, likes + 2 AS likes, CAST(0.5 AS DOUBLE) AS ctr FROM ab_log WHERE replies % 3 = 0
  UNION ALL SELECT post_id, ts + INTERVAL 1 DAY, replies + 5, NULL, NULL FROM ab_log WHERE replies % 6 = 0),
last_updates AS (SELECT post_id, arg_max(struct_pack(replies := replies, likes := likes), ts) AS last,
  arg_max(ctr, ts) FILTER (WHERE ctr IS NOT NULL) AS ctr FROM updates GROUP BY post_id)"""


RECORDED = """SELECT l.post_id, l.variant_id, CASE WHEN u.post_id IS NULL THEN l.replies ELSE coalesce(u.last.replies, 0) END AS replies,
    CASE WHEN u.post_id IS NULL THEN l.likes ELSE coalesce(u.last.likes, 0) END AS likes, coalesce(u.ctr, l.ctr) AS ctr
    FROM log l LEFT JOIN last_updates u ON u.post_id = l.post_id"""


def log_and_updates(t: Inputs):
    log = t.ab_log.unionByName(t.ab_log.withColumn("variant_id", F.concat("variant_id", F.lit("b"))))
    one = t.ab_log.filter("replies % 3 = 0").select(
        "post_id", "ts", (F.col("replies") + 1).alias("replies"), (F.col("likes") + 2).alias("likes"), F.lit(0.5).alias("ctr")
    )
    two = t.ab_log.filter("replies % 6 = 0").select(
        "post_id", (F.col("ts") + F.expr("INTERVAL 1 DAY")).alias("ts"), (F.col("replies") + 5).alias("replies"),
        F.lit(None).cast("long").alias("likes"), F.lit(None).cast("double").alias("ctr"),
    )
    return log, one, two


@query("record_metrics", RECORDED, ["ab_log"], UPDATES)
def record_metrics(t: Inputs):
    log, one, two = log_and_updates(t)
    return experiments.record_metrics(log, one.unionByName(two)).select("post_id", "variant_id", "replies", "likes", "ctr")


@query("updated_log", RECORDED, ["ab_log"], UPDATES)
def updated_log(t: Inputs):
    """A stored log, appended once by a run that is repeated, and twice updated from its own rows."""
    log, *updates = log_and_updates(t)
    table = VersionedTable(t.spark, staging_path(t.spark, "log"))
    for _ in range(2):
        table.append(log, run="enrolment")
    for new in updates:
        table.update(lambda rows, new=new: experiments.record_metrics(rows, new))
    return table.read().select("post_id", "variant_id", "replies", "likes", "ctr")


@query(
    "typed_ab_log",
    "SELECT post_id, replies, CASE WHEN replies % 4 = 0 THEN NULL ELSE likes END AS likes, ctr FROM ab_log",
    ["ab_log"],
)
def typed_ab_log(t: Inputs):
    as_text = t.ab_log.withColumns(
        {
            "ts": F.col("ts").cast("string"),
            "replies": F.col("replies").cast("string"),
            "likes": F.when(F.col("replies") % 4 == 0, F.lit("n/a")).otherwise(F.col("likes").cast("string")),
            "ctr": F.coalesce(F.col("ctr").cast("string"), F.lit("")),
        }
    )
    return readers.type_ab_log(as_text).select("post_id", "replies", "likes", "ctr")


@query(
    "unscored_posts",
    "SELECT post_id, variant_id FROM ab_log WHERE ctr IS NULL",
    ["ab_log"],
)
def unscored_posts(t: Inputs):
    return experiments.unscored(t.ab_log).select("post_id", "variant_id")


@query(
    "ab_winner",
    "SELECT post_id, variant_id, coalesce(ctr, 0) AS score FROM ab_log ORDER BY score DESC, ts, post_id LIMIT 1",
    ["ab_log"],
)
def ab_winner(t: Inputs):
    return experiments.pick_winner(t.ab_log).select("post_id", "variant_id", "score")


@query(
    "ab_winner_by_topic",
    """SELECT topic, post_id, coalesce(ctr, 0) AS score FROM ab_log
    QUALIFY row_number() OVER (PARTITION BY topic ORDER BY coalesce(ctr, 0) DESC, ts, post_id) = 1""",
    ["ab_log"],
)
def ab_winner_by_topic(t: Inputs):
    return experiments.pick_winner(t.ab_log, "topic").select("topic", "post_id", "score")


@query(
    "ab_averages",
    "SELECT round(avg(ctr), 4) AS avg_ctr, CAST(floor(avg(likes)) AS BIGINT) AS avg_likes FROM ab_log",
    ["ab_log"],
)
def ab_averages(t: Inputs):
    return experiments.variant_averages(t.ab_log)


@query(
    "latest_history",
    "SELECT post_id, variant_id FROM ab_log ORDER BY ts DESC, post_id DESC LIMIT 8",
    ["ab_log"],
)
def latest_history(t: Inputs):
    return variants.latest(t.ab_log, 8, ("ts", "post_id")).select("post_id", "variant_id")


# --- ranking ---------------------------------------------------------------------------------------------------------

LOW = "lower({0})"


def rank_sql(text: str) -> str:
    low = f"lower({text})"
    return (
        f"round(CAST(CASE WHEN {any_in(low, expected.RANK_CTA_WORDS)} THEN 0.03 ELSE 0 END AS DOUBLE)"
        f" + least(CAST(0.05 AS DOUBLE), length({low}) / CAST(2000 AS DOUBLE))"
        f" + CAST(CASE WHEN {any_in(low, expected.AI_WORDS)} THEN 0.02 ELSE 0 END AS DOUBLE), 4)"
    )


def prior_sql(text: str) -> str:
    low = f"lower({text})"
    return (
        f"round(least(CAST(0.2 AS DOUBLE), greatest(CAST(0.001 AS DOUBLE), CAST(0.01 AS DOUBLE)"
        f" + CAST(CASE WHEN {any_in(low, expected.PRIOR_CTA_WORDS)} THEN 0.02 ELSE 0 END AS DOUBLE)"
        f" + CAST(CASE WHEN length({low}) < 80 THEN 0.01 ELSE 0 END AS DOUBLE)"
        f" + CAST(CASE WHEN {any_in(low, expected.AI_WORDS)} THEN 0.015 ELSE 0 END AS DOUBLE))), 4)"
    )


@query("rank_scores", f"SELECT doc_id, {rank_sql('text')} AS score FROM documents")
def rank_scores(t: Inputs):
    return t.documents.select("doc_id", scoring.rank_score("text").alias("score"))


@query("ctr_prior", f"SELECT variant_id, {prior_sql('raw_text')} AS prior FROM llm_drafts", ["llm_drafts"])
def ctr_prior(t: Inputs):
    return t.llm_drafts.select("variant_id", scoring.ctr_prior("raw_text").alias("prior"))


ALL_RANKED = (
    DRAFTED
    + f""",
all_texts AS (SELECT variant_id, topic_name AS topic, substr(CASE WHEN caption <> '' THEN caption ELSE raw_text END, 1, 600) AS variant_text
  FROM drafted),
ranked AS (SELECT *, {rank_sql('variant_text')} AS score FROM all_texts ORDER BY score DESC, variant_id LIMIT 5)"""
)


def all_candidates(t: Inputs):
    return variants.candidates(variants.split_drafts(t.llm_drafts), None, limit_text=600)


@query("heuristic_rank", "SELECT variant_id, score, 'heuristic' AS reason FROM ranked", ["llm_drafts"], ALL_RANKED)
def heuristic_rank(t: Inputs):
    return experiments.rank_candidates(all_candidates(t), 5).select("variant_id", "score", "reason")


@query(
    "log_prediction",
    """SELECT concat('pred_', substr(md5(concat(variant_id, '|2024-03-31T00:00:00')), 1, 8)) AS post_id, topic, variant_id, variant_text
    FROM ranked ORDER BY score DESC, variant_id LIMIT 1""",
    ["llm_drafts"],
    ALL_RANKED,
)
def log_prediction(t: Inputs):
    return experiments.log_prediction(all_candidates(t), CFG.as_of).select("post_id", "topic", "variant_id", "variant_text")


@query(
    "enrol_variants",
    """SELECT concat('local_', substr(md5(concat_ws('|', variant_id, topic_name, variant_text, '2024-03-31T00:00:00')), 1, 8)) AS post_id,
    topic_name AS topic, variant_id, variant_text, CAST(NULL AS BIGINT) AS likes FROM (
      SELECT variant_id, topic_name, substr(CASE WHEN caption <> '' THEN caption ELSE raw_text END, 1, 800) AS variant_text FROM drafted
      ORDER BY topic, variant_id LIMIT 5)""",
    ["llm_drafts"],
    DRAFTED,
)
def enrol_variants(t: Inputs):
    drafted = variants.split_drafts(t.llm_drafts)
    first = readers.first_nonempty([drafted.filter("false"), drafted])
    chosen = variants.candidates(first, 5, ("topic", "variant_id"))
    return experiments.enrol_variants(chosen, CFG.as_of).select("post_id", "topic", "variant_id", "variant_text", "likes")


VARIANTS = """
variants AS (SELECT DISTINCT variant_id, concat('text of ', variant_id) AS variant_text FROM ab_log),
scores AS (SELECT variant_id, round(avg(ctr), 4) AS score FROM ab_log GROUP BY 1),
odd_scores AS (SELECT variant_id, CASE WHEN variant_id = 'v3' THEN CAST('NaN' AS DOUBLE) WHEN variant_id <> 'v4' THEN score END AS score FROM scores)"""


def offered(t: Inputs):
    ids = t.ab_log.select("variant_id").distinct()
    return ids.withColumn("variant_text", F.concat(F.lit("text of "), "variant_id"))


def variant_scores(t: Inputs):
    return t.ab_log.groupBy("variant_id").agg(F.round(F.avg("ctr"), 4).alias("score"))


@query(
    "lookup_variant",
    """SELECT variant_id, variant_text FROM variants WHERE variant_id IN (SELECT variant_id FROM scores ORDER BY score DESC NULLS LAST, variant_id LIMIT 3)""",
    ["ab_log"],
    VARIANTS,
)
def lookup_variant(t: Inputs):
    best = variant_scores(t).orderBy(F.col("score").desc_nulls_last(), "variant_id").limit(3)
    return experiments.lookup_variant(offered(t), best)


def unit(tag: str) -> str:
    return f"CAST(CAST(('0x' || substr(md5(concat(CAST(event_id AS VARCHAR), '|42|{tag}')), 1, 8)) AS UBIGINT) AS DOUBLE) / CAST(4294967296 AS DOUBLE)"


@query(
    "bandit_assign",
    f"""SELECT event_id, explored, CASE WHEN explored THEN i.variant_id ELSE best.variant_id END AS variant_id,
      CASE WHEN explored THEN i.variant_text ELSE best.variant_text END AS variant_text
    FROM (SELECT event_id, {unit('explore')} < CAST(0.1 AS DOUBLE) AS explored,
      CAST(floor({unit('pick')} * (SELECT count(*) FROM variants)) AS BIGINT) AS place FROM events) e
    JOIN (SELECT *, row_number() OVER (ORDER BY CAST(('0x' || substr(md5(variant_id), 1, 8)) AS UBIGINT) % 4096, variant_id) - 1 AS place
      FROM variants) i ON i.place = e.place
    CROSS JOIN (SELECT variant_id, variant_text FROM variants JOIN odd_scores USING (variant_id)
      ORDER BY CASE WHEN isnan(score) OR score IS NULL THEN 0 ELSE score END DESC, variant_id LIMIT 1) best""",
    ["ab_log"],
    VARIANTS,
)
def bandit_assign(t: Inputs):
    odd = F.when(F.col("variant_id") == "v3", F.lit(float("nan"))).when(F.col("variant_id") != "v4", F.col("score"))
    scores = variant_scores(t).withColumn("score", odd)
    return experiments.assign_variants(t.events.select("event_id"), offered(t), scores, CFG.explore_share)
