"""The whole runs: clean and KPIs, merge, weekly report, topics to drafts, and the variant loop.

Every run reads and writes Spark tables; the clock and all thresholds come from ``Settings``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from audience_engine import vocabulary as voc
from audience_engine.functions import clock, drafts
from audience_engine.functions.text import is_english
from audience_engine.operators import conform, experiments, kpis, quality, selection, sentiment, topics, variants
from audience_engine.schemas import DQ_LOG, KPI, RAW_SCHEMAS
from audience_engine.session import cut_lineage
from audience_engine.settings import Settings
from audience_engine.sources import readers, sinks


LISTED = ("position", "comment_id")


def _order(df: DataFrame, order: Sequence[str]) -> list[Column]:
    """The listing place where the rows have one, then what is unique."""
    return [F.col(c) for c in order if c in df.columns]


def collect_videos(
    popular: DataFrame, marketing: DataFrame, settings: Settings, order: Sequence[str] = ("position", "video_id")
) -> DataFrame:
    """Selected videos of both streams: first seen per id, capped per listing, united, capped per channel, the top ones.

    ``popular`` has (region, category, ...) and ``marketing`` a ``keyword`` column; both come from flattened pages.
    """
    by = [F.col(c) for c in order]
    firsts = conform.first_seen(popular, "video_id", by)
    listed = selection.cap_per_group(firsts, ["region", "category"], settings.videos_per_category, by, spread_by=["video_id"])
    found = conform.first_seen(marketing, "video_id", by)
    searched = selection.cap_per_group(found, "keyword", settings.videos_per_keyword, by, spread_by=["video_id"])
    both = conform.keyed_union([listed, searched.drop("keyword")], "video_id")
    return selection.select_videos(both, settings.videos_per_channel, settings.max_videos)


def collect_video_comments(
    comments: DataFrame, selected: DataFrame, settings: Settings, order: Sequence[str] = LISTED
) -> DataFrame:
    """Comments of the selected videos in listing order, capped by the video's stream, with the video's details.

    With ``settings.english_only`` other comments are passed over and don't count towards the cap.
    ``selected`` is bounded by ``settings.max_videos``; it is computed once and joined once.
    """
    if settings.english_only:
        comments = comments.filter(is_english("text"))
    marketing = settings.comments_per_marketing_video
    cap = F.when(F.col("stream") == "marketing", marketing).otherwise(settings.comments_per_popular_video)
    detailed = selection.attach_video_meta(comments, selected, how="inner", keep=("stream",))
    capped = selection.cap_per_group(
        detailed, "video_id", cap, _order(comments, order),
        max_n=max(marketing, settings.comments_per_popular_video), spread_by=["comment_id"],
    )
    return capped.drop("stream")


def collect_posts(posts: DataFrame, comments: DataFrame, settings: Settings, order: Sequence[str] = LISTED) -> DataFrame:
    """Recent comments of the picked recent posts, the first in ``order`` of each post."""
    as_of, days = settings.as_of, settings.window_days
    recent = posts.filter(clock.recent_days("created_utc", as_of, days))
    picked = selection.pick_posts(recent, n=settings.posts_per_community, p=settings.score_percentile)
    fresh = comments.filter(clock.recent_days("created_utc", as_of, days))
    chosen = selection.only_selected(fresh, picked, "post_id")
    return selection.cap_per_group(chosen, "post_id", settings.comments_per_post, _order(comments, order), spread_by=["comment_id"])


def clean_and_report(
    raw: DataFrame, platforms: Sequence[str], settings: Settings, prefix: str, notes: str = "", manifest: str | None = None
) -> None:
    """Clean raw comments into ``<prefix>clean``, append KPIs and the quality log of the day, and write the manifest.

    The texts are searched once: the log is counted while the cleaned table is written, and the KPIs are read from it.
    ``manifest`` is a folder; by default ``<prefix>manifest`` beside the tables.
    """
    date = settings.as_of.date().isoformat()
    spark = raw.sparkSession
    cleaned, observed = quality.observe_dq(raw, settings, platforms)
    sinks.replace_table(cleaned, f"{prefix}clean")
    rows = kpis.compute_kpis(spark.table(f"{prefix}clean"), platforms, date, notes=notes, positive_above=settings.positive_above)
    sinks.append_table(rows.to(KPI), f"{prefix}kpis", KPI)
    counts = observed.get
    log = [(p, reason, counts[f"{p}|{reason}"]) for p in platforms for reason in voc.DQ_REASONS]
    sinks.append_table(spark.createDataFrame(log, DQ_LOG), f"{prefix}dq_log", DQ_LOG)
    where = manifest or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{prefix}manifest"
    sinks.write_manifest(spark, settings, where, notes=notes)


def merge_comments(raw: dict[str, DataFrame], settings: Settings, order: Sequence[str] = ("created_utc",)) -> DataFrame:
    """All platforms in one table: conformed, united, deduplicated, the last days only.

    Of equal comments the first by ``order`` stays; re-pulls that are equal there too are told apart by all their columns.
    """
    parts = [conform.conform_comments(df, source) for source, df in raw.items()]
    united = conform.union_sources(*parts)
    whole = F.to_json(F.struct(*united.columns))
    first = conform.dedupe_comments(united, [*[F.col(c) for c in order], F.xxhash64(whole), whole])
    return selection.keep_last_n_days(first, settings.as_of, settings.window_days)


def merge_sources(
    spark: SparkSession, paths: dict[str, str], tables: dict[str, str], settings: Settings, schemas: dict[str, T.StructType] | None = None
) -> DataFrame:
    """``merge_comments`` on local snapshots where there are any, else on the stored raw tables.

    ``schemas`` gives the raw schema of sources other than the known ones.
    """
    known = {**RAW_SCHEMAS, **(schemas or {})}
    if unknown := sorted(set(tables) - set(known)):
        raise ValueError(f"no raw schema for {unknown}")
    raw = {s: readers.resolve_source(spark, paths.get(s, ""), tables[s], s, known[s]) for s in tables}
    return merge_comments({s: df.drop("source") for s, df in raw.items()}, settings)


def weekly_report(comments: DataFrame, lexicon: DataFrame, summary: DataFrame, settings: Settings) -> DataFrame:
    """One row with the week's totals, its top topics and the message text."""
    start, end = kpis.date_window(settings.report_days, settings.as_of)
    week = kpis.report_window(comments, start, end)
    row = kpis.weekly_rollup(sentiment.with_sentiment(week, lexicon), summary, start, end)
    message = drafts.weekly_message(clock.instant(start), clock.instant(end), "total", "pos", "neu", "neg", "names")
    return row.withColumn("folder", clock.week_label(clock.instant(end))).withColumn("message", message).drop("names")


def topics_to_drafts(
    sources: dict[str, DataFrame], key: str, text: str, settings: Settings, generator: Callable[[str], str] | None = None
) -> tuple[topics.Topics, DataFrame, DataFrame]:
    """Topics of each source, a draft per topic, and the messages of the latest drafts."""
    built = topics.build_topics(sources, key, text, settings)
    drafted = cut_lineage(variants.generate_drafts(built.summary, settings.as_of, generator))
    return built, drafted, variants.latest_drafts(drafted)


def enrol_and_rank(candidates: DataFrame, settings: Settings, limit: int = 5) -> tuple[DataFrame, DataFrame]:
    """Log rows for the first candidates, and a log row with the predicted winner among them.

    The prediction reads shorter texts, and the raw text where there is no caption.
    """
    posted = variants.candidates(candidates, limit)
    ranked = variants.candidates(candidates, limit, limit_text=600, texts=("caption", "raw_text", "variant_text"))
    return experiments.enrol_variants(posted, settings.as_of), experiments.log_prediction(ranked, settings.as_of)
