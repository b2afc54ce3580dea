"""Labels, prompts, drafts and messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from audience_engine import vocabulary as voc
from audience_engine.functions.text import coalesce_text, strip, to_text, truncate
from audience_engine.schemas import APPROVAL, RANKING


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _lookup(table: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(item) for pair in table.items() for item in pair])


def topic_label(terms: Column | str, topic: Column | str | None = None) -> Column:
    """Name a topic from its top terms.

    The first term with a brand or vertical hint gives the seed, followed by up to two terms without a hint.
    Without a hint the first three terms are used in title case; without terms ``topic_n``, or ``Unknown``.
    """
    terms = F.transform(_col(terms), F.lower)
    hints = _lookup({**voc.VERTICAL_HINTS, **voc.BRAND_HINTS})
    hinted = [*voc.BRAND_HINTS, *voc.VERTICAL_HINTS]
    seed = F.try_element_at(hints, F.try_element_at(F.filter(terms, lambda t: t.isin(*hinted)), F.lit(1)))
    extras = F.slice(F.filter(terms, lambda t: ~t.isin(*hinted)), 1, 2)
    missing = F.lit("Unknown") if topic is None else F.concat(F.lit("topic_"), _col(topic).cast("string"))
    return (
        F.when(F.coalesce(F.size(terms), F.lit(0)) <= 0, missing)
        .when(seed.isNotNull(), F.array_join(F.concat(F.array(seed), extras), " / "))
        .otherwise(F.initcap(F.array_join(F.slice(terms, 1, 3), " ")))
    )


def sentiment_label(compound: Column | str) -> Column:
    """positive from 0.05, negative from -0.05 down, else neutral."""
    compound = _col(compound)
    return (
        F.when(compound >= 0.05, F.lit("positive"))
        .when(compound <= -0.05, F.lit("negative"))
        .otherwise(F.lit("neutral"))
    )


def build_prompt(
    name: Column | str, docs: Column | str, sentiment: Column | str, platform: Column | str
) -> Column:
    """The copywriter prompt of a topic, with its first three documents as the sample."""
    sample = F.coalesce(F.array_join(F.slice(_col(docs), 1, 3), " | "), F.lit(""))
    values = {"platform": to_text(platform), "sentiment": to_text(sentiment), "topic": to_text(name), "sample": sample}
    pieces: list[Column] = []
    rest = voc.PROMPT_TEMPLATE
    for mark, value in values.items():
        before, rest = rest.split("{" + mark + "}", 1)
        pieces += [F.lit(before), value]
    return F.concat(*pieces, F.lit(rest))


def _bare(text: Column) -> Column:
    """Outer blanks, then outer double quotes removed."""
    return F.btrim(strip(text), F.lit('"'))


def split_caption_cta(text: Column | str) -> Column:
    """A draft as ``struct(caption, cta)``: split at the first ``||``, else its first two lines, else all of it."""
    text = to_text(text)
    parts = F.split(text, r"\|\|", 2)
    lines = F.filter(
        F.transform(F.split(text, r"\r\n|\r|\n"), strip),
        lambda line: line != "",
    )
    marked = F.contains(text, F.lit("||"))
    two_lines = F.size(lines) >= 2
    caption = (
        F.when(marked, _bare(F.try_element_at(parts, F.lit(1))))
        .when(two_lines, F.try_element_at(lines, F.lit(1)))
        .otherwise(text)
    )
    cta = (
        F.when(marked, _bare(F.try_element_at(parts, F.lit(2))))
        .when(two_lines, F.try_element_at(lines, F.lit(2)))
        .otherwise(F.lit(""))
    )
    return F.struct(caption.alias("caption"), cta.alias("cta"))


def heuristic_draft(name: Column | str, docs: Column | str, platform: Column | str) -> Column:
    """A draft without a text generator, as ``struct(caption, cta)``."""
    first = F.try_element_at(_col(docs), F.lit(1))
    sample = F.coalesce(truncate(first, 100), to_text(name))
    caption = truncate(F.concat(to_text(name), F.lit(": "), sample), 240)
    cta = F.when(F.contains(to_text(platform), F.lit("generic")), F.lit("Learn more")).otherwise(F.lit("Read more"))
    return F.struct(caption.alias("caption"), cta.alias("cta"))


def draft_message(
    topic_name: Column | str, topic: Column | str, platform: Column | str, caption: Column | str,
    raw_text: Column | str, cta: Column | str,
) -> Column:
    """The notice text of one draft."""
    return F.concat(
        F.lit("*"), F.coalesce(F.nullif(coalesce_text(topic_name, topic), F.lit("")), F.lit("Topic")),
        F.lit("* — _"), F.coalesce(_col(platform), F.lit("generic")),
        F.lit("_\n• Caption: "), coalesce_text(caption, truncate(to_text(raw_text), 240)),
        F.lit("\n• CTA: "), to_text(cta),
    )


def weekly_message(
    start: Column | str, end: Column | str, total: Column | str, pos: Column | str, neu: Column | str,
    neg: Column | str, names: Column | str,
) -> Column:
    """The weekly summary text; ``names`` is the array of top topic names."""
    names = _col(names)
    listed = F.when(F.coalesce(F.size(names), F.lit(0)) > 0, F.array_join(names, ", ")).otherwise(F.lit("N/A"))
    return F.concat(
        F.lit("*Weekly snapshot* ("), F.date_format(_col(start), "yyyy-MM-dd"), F.lit(" → "),
        F.date_format(_col(end), "yyyy-MM-dd"), F.lit(")\nTotal comments: "), _col(total).cast("string"),
        F.lit(" | Pos "), _col(pos).cast("string"), F.lit(" | Neu "), _col(neu).cast("string"),
        F.lit(" | Neg "), _col(neg).cast("string"), F.lit("\nTop topics: "), listed,
    )


def parse_ranking(answer: Column | str) -> Column:
    """The ranked rows in a generator's answer: its JSON array from the first ``[`` to the last ``]``."""
    answer = _col(answer)
    found = F.regexp_extract(answer, r"(?s)(\[.*\])", 1)
    parsed = F.from_json(F.coalesce(F.nullif(found, F.lit("")), answer), RANKING)
    return F.coalesce(parsed, F.array().cast(RANKING))


def parse_approval(payload: Column | str) -> Column:
    """An approval payload as ``struct(user, topic, variant)``; the value is split at its first ``||``."""
    body = F.from_json(_col(payload), APPROVAL)
    value = F.coalesce(F.try_element_at(body["actions"], F.lit(1))["value"], F.lit(""))
    parts = F.split(value, r"\|\|", 2)
    return F.struct(
        F.coalesce(F.nullif(body["user"]["username"], F.lit("")), body["user"]["id"]).alias("user"),
        F.try_element_at(parts, F.lit(1)).alias("topic"),
        F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit("")).alias("variant"),
    )


def variant_id(key: Column | str, index: Column | str) -> Column:
    """The id of one variant of a comment."""
    return F.concat(to_text(key), F.lit("_"), to_text(index))


def short_id(*parts: Column | str, length: int = 8) -> Column:
    """A short id that a re-run repeats."""
    return F.substring(F.md5(F.concat_ws("|", *[to_text(part) for part in parts])), 1, length)
