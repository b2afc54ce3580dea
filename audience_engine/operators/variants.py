"""Caption variants, drafts and their lists."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from audience_engine import vocabulary as voc
from audience_engine.functions import drafts as fn
from audience_engine.functions.clock import instant, iso_z
from audience_engine.functions.text import coalesce_text, evaluate_once, fill_template, parse_json_list, snippet, to_text
from audience_engine.schemas import DRAFTS


def make_variants(
    comments: DataFrame, templates: Sequence[str] = voc.CAPTION_TEMPLATES, n: int = 100, text: str = "comment"
) -> DataFrame:
    """One caption per comment and template, with the template's index in the id."""
    listed = F.array(*[F.lit(template) for template in templates])
    filled = evaluate_once(snippet(text, n), lambda sn: F.transform(listed, lambda t: fill_template(t, sn)))
    return comments.select("comment_id", F.col(text), "source", F.posexplode(filled).alias("_i", "variant_text")).select(
        fn.variant_id("comment_id", "_i").alias("variant_id"),
        to_text(text).alias("original_comment"),
        "variant_text",
        F.coalesce("source", F.lit("")).alias("source"),
    )


def topic_prompts(summary: DataFrame) -> DataFrame:
    """The prompt of each topic of a summary; representative documents may be an array or JSON text."""
    docs = F.col("Representative_Docs")
    if dict(summary.dtypes)["Representative_Docs"] == "string":
        docs = parse_json_list(docs)

    def optional(*names: str, default: str) -> Column:
        present = [c for c in names if c in summary.columns]
        return F.coalesce(F.nullif(coalesce_text(*present), F.lit("")), F.lit(default)) if present else F.lit(default)

    return (
        summary.select(
            F.col("Topic").cast("string").alias("topic"),
            to_text("Name").alias("topic_name"),
            docs.alias("docs"),
            optional("sentiment_hint", "sentiment", default="neutral").alias("sentiment_hint"),
            optional("platform", default="generic").alias("platform"),
            (to_text("source") if "source" in summary.columns else F.lit("")).alias("source"),
        )
        .withColumn("prompt", fn.build_prompt("topic_name", "docs", "sentiment_hint", "platform"))
    )


def _answered(prompts: DataFrame, generator: Callable[[str], str]) -> DataFrame:
    """``prompts`` plus the generator's ``raw_text`` and, where it raised or had nothing to say, the ``error``."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def one(prompt: str) -> tuple[str, str | None]:
            try:
                answer = generator(prompt) or ""
            except Exception as error:  # the caller's function may raise anything; it is reported, not hidden
                return "", f"{type(error).__name__}: {error}"
            return answer, None if answer else "no answer"

        for batch in batches:
            answers = [one(p) for p in batch["prompt"]]
            yield batch.assign(raw_text=[a for a, _ in answers], error=[e for _, e in answers])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in prompts.schema) + ", raw_text string, error string"
    return prompts.mapInPandas(write, schema)


def failed_drafts(summary: DataFrame, generator: Callable[[str], str]) -> DataFrame:
    """(topic, topic_name, source, error) of the topics for which the generator raised or returned nothing."""
    answered = _answered(topic_prompts(summary), generator)
    return answered.filter(F.col("error").isNotNull()).select("topic", "topic_name", "source", "error")


def generate_drafts(
    summary: DataFrame, as_of: dt.datetime, generator: Callable[[str], str] | None = None
) -> DataFrame:
    """A draft per topic, from the caller's ``prompt -> text`` function or, without one, from the topic itself.

    A topic for which the function raises or returns nothing is left out; ``failed_drafts`` lists those with the reason.
    Topics of several sources are told apart by the summary's ``source``, which becomes the ``topic_group``.
    """
    prompts = topic_prompts(summary)
    named = ["source"] if "source" in summary.columns else []
    if generator is None:
        own = fn.heuristic_draft("topic_name", "docs", "platform")
        drafted = prompts.withColumn("_d", own).withColumn(
            "raw_text", F.concat(F.col("_d.caption"), F.lit(" || "), F.col("_d.cta"))
        )
    else:
        answered = _answered(prompts, generator).filter(F.col("raw_text") != "")
        drafted = answered.withColumn("_d", fn.split_caption_cta("raw_text"))
    return drafted.select(
        "topic",
        "topic_name",
        F.when(F.col("source") != "", F.col("source")).otherwise(F.col("topic")).alias("topic_group"),
        F.concat("topic", F.lit("_"), fn.short_id("topic", "raw_text", *named, length=6)).alias("variant_id"),
        F.lit(0).alias("variant_index"),
        F.coalesce(F.try_element_at("docs", F.lit(1)), F.lit("")).alias("representative_doc"),
        "sentiment_hint",
        "platform",
        F.col("_d.caption").alias("caption"),
        F.col("_d.cta").alias("cta"),
        "raw_text",
        F.length("raw_text").alias("raw_length"),
        iso_z(instant(as_of)).alias("created_utc"),
    ).to(DRAFTS)


def split_drafts(df: DataFrame, raw: str = "raw_text") -> DataFrame:
    """Add caption and call to action from the raw text."""
    return df.withColumn("_d", fn.split_caption_cta(raw)).withColumns(
        {"caption": F.col("_d.caption"), "cta": F.col("_d.cta")}
    ).drop("_d")


def candidates(
    df: DataFrame,
    n: int | None,
    order: Sequence[str] = ("created_utc", "variant_id"),
    limit_text: int = 800,
    texts: Sequence[str] = ("caption", "variant_text", "raw_text"),
) -> DataFrame:
    """The first ``n`` drafts or variants (None: all) as (variant_id, topic, variant_text), the text being the first one given."""
    texts = [c for c in texts if c in df.columns]
    names = [c for c in ("topic_name", "topic") if c in df.columns]
    by = [c for c in order if c in df.columns]
    ids = F.when(F.col("variant_id").cast("string") != "", F.col("variant_id").cast("string"))
    first = df if n is None else df.orderBy(*by).limit(n)
    return first.select(
        F.coalesce(ids, F.concat(F.lit("draft_"), fn.short_id(*texts, *names, length=6))).alias("variant_id"),
        (coalesce_text(*names) if names else F.lit("")).alias("topic"),
        F.substring(coalesce_text(*texts), 1, limit_text).alias("variant_text"),
    )


def latest(df: DataFrame, n: int, order: Sequence[str] = ("created_utc", "variant_id")) -> DataFrame:
    """The last ``n`` rows by the order columns, oldest first."""
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(n).orderBy(*order)


def latest_drafts(df: DataFrame, n: int = 10, order: Sequence[str] = ("created_utc", "variant_id")) -> DataFrame:
    """The last ``n`` drafts with their notice text."""
    message = fn.draft_message("topic_name", "topic", "platform", "caption", "raw_text", "cta")
    return latest(df, n, order).withColumn("message", message)


def model_ranking(df: DataFrame, answer: str) -> DataFrame:
    """One row per entry of the JSON arrays in generated answers."""
    kept = [c for c in df.columns if c != answer]
    return df.select(*kept, F.inline(fn.parse_ranking(answer)))


def ranking_prompt(cands: DataFrame, history: DataFrame, n: int = 10, n_history: int = 8) -> DataFrame:
    """The prompt that asks a generator to rank the first ``n`` candidates, with the latest ``n_history`` results as history."""
    history = history.orderBy(F.col("ts").desc_nulls_last(), F.col("post_id").desc(), "variant_id").limit(n_history)
    cands = cands.orderBy("variant_id", "variant_text").limit(n)
    shown = F.concat_ws(
        " ",
        F.col("variant_id"),
        F.concat(F.lit("replies="), to_text("replies")),
        F.concat(F.lit("likes="), to_text("likes")),
        F.concat(F.lit("ctr="), to_text("ctr")),
    )
    past = history.agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("ts", "post_id", shown.alias("s")))), lambda r: r["s"]), "\n").alias("history"))
    line = F.concat("variant_id", F.lit(": "), F.translate(F.substring("variant_text", 1, 200), "\n", " "))
    listed = cands.agg(F.array_join(F.sort_array(F.collect_list(line)), "\n").alias("candidates"))
    return past.select(
        F.concat(
            F.lit(voc.RANK_PROMPT_HEAD), F.col("history"), F.lit("\n\nCandidates:\n"), listed.scalar(),
            F.lit("\n\nReturn JSON only."),
        ).alias("prompt")
    )
