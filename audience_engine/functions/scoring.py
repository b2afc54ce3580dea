"""Numeric scores."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from audience_engine import vocabulary as voc
from audience_engine.functions.clock import hours_since
from audience_engine.functions.text import contains_any, lowered


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def engagement_density(
    likes: Column | str, replies: Column | str, awards: Column | str, ts: Column | str, as_of: dt.datetime | Column
) -> Column:
    """Likes, replies and five-fold awards per hour of age."""
    return (_col(likes) + _col(replies) + F.lit(5) * _col(awards)) / hours_since(ts, as_of)


def _ai_hit(text: Column, whole_word: bool) -> Column:
    return text.rlike(r"\b(?:" + "|".join(voc.AI_WORDS) + r")\b") if whole_word else contains_any(text, voc.AI_WORDS)


def rank_score(text: Column | str, whole_word: bool = False) -> Column:
    """Offline rank of a variant: call to action, length and AI words, to 4 places."""
    text = lowered(text)
    return F.round(
        F.when(contains_any(text, voc.RANK_CTA_WORDS), F.lit(0.03)).otherwise(F.lit(0.0))
        + F.least(F.lit(0.05), F.length(text) / F.lit(2000.0))
        + F.when(_ai_hit(text, whole_word), F.lit(0.02)).otherwise(F.lit(0.0)),
        4,
    )


def ctr_prior(text: Column | str, whole_word: bool = False) -> Column:
    """Expected click rate of a variant from its words and length, within [0.001, 0.2]."""
    text = lowered(text)
    raw = (
        F.lit(0.01)
        + F.when(contains_any(text, voc.PRIOR_CTA_WORDS), F.lit(0.02)).otherwise(F.lit(0.0))
        + F.when(F.length(text) < 80, F.lit(0.01)).otherwise(F.lit(0.0))
        + F.when(_ai_hit(text, whole_word), F.lit(0.015)).otherwise(F.lit(0.0))
    )
    return F.round(F.least(F.lit(0.2), F.greatest(F.lit(0.001), raw)), 4)


def ctr_value(ctr: Column | str) -> Column:
    """A click rate for comparison: blank, bad and NaN count as 0."""
    value = _col(ctr).try_cast("double")
    return F.coalesce(F.when(~F.isnan(value), value), F.lit(0.0))


def cosine_distance(a: Column | str, b: Column | str) -> Column:
    """1 minus the cosine of two arrays; a zero vector is at distance 1."""
    a, b = _col(a), _col(b)

    def dot(x: Column, y: Column) -> Column:
        products = F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double"))
        return F.aggregate(products, F.lit(0.0), lambda total, value: total + value)

    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.lit(1.0) - F.coalesce(F.try_divide(dot(a, b), norm), F.lit(0.0))


def unit_hash(*parts: Column) -> Column:
    """A repeatable number in [0, 1) from the md5 of the parts, in place of a random draw."""
    head = F.substring(F.md5(F.concat_ws("|", *parts)), 1, 8)
    return F.conv(head, 16, 10).cast("double") / F.lit(4294967296.0)


def magnitude_bin(value: Column) -> Column:
    """A whole number's bin: exact up to 1023, then 1024 bins per power of two. Bins keep the order of the values.

    There are at most about 110,000 bins over all 64-bit numbers; null goes to bin 0.
    """

    def bin_of(v: Column) -> Column:
        power = F.length(F.bin(v)) - 1
        shift = F.greatest(power - 10, F.lit(0))
        leading = F.call_function("shiftright", v, shift)
        return F.when(power < 10, v).otherwise((power - 9).cast("long") * 1024 + leading - 1024)

    value = value.cast("long")
    signed = F.when(value >= 0, bin_of(value)).otherwise(F.lit(-1).cast("long") - bin_of(F.bitwise_not(value)))
    # never null, so that a join on the bin adds no filter and both sides can share one shuffle
    return F.coalesce(signed, F.lit(0).cast("long"))
