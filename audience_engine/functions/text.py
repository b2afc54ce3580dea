"""Text predicates, extraction and clean-up."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from audience_engine import vocabulary as voc

URL = r"https?://\S+|www\.\S+"
EMAIL = r"[A-Za-z0-9_.+-]+@[A-Za-z0-9-]+\.[A-Za-z0-9.-]+"
PHONE = r"\+?[0-9][0-9 ().-]{7,}[0-9]"
NON_WORD = r"[^\p{L}\p{N}_]+"
NUMERIC = r"^\p{N}+$"
HASHTAG = r"#[\p{L}\p{N}_]+"
WORD_BREAK = r"[^\p{L}\p{N}_']+"
# every character that counts as white space, not only the blank
SPACES = "".join(map(chr, (*range(9, 14), *range(28, 33), 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288)))


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def contains_any(text: Column | str, words: Sequence[str]) -> Column:
    """True when any of ``words`` occurs in ``text`` as a substring."""
    text = _col(text)
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(word)) for word in words])


def lowered(text: Column | str) -> Column:
    """Lower-case text, null as empty."""
    return F.lower(F.coalesce(_col(text), F.lit("")))


def longer_than(text: Column | str, n: int = 6) -> Column:
    """Text of more than ``n`` characters; null is false."""
    return F.coalesce(F.length(_col(text)) > n, F.lit(False))


def is_english(text: Column | str, thresh: float = 0.95) -> Column:
    """Share of ASCII characters above ``thresh``; empty or null text is false.

    A non-ASCII character takes two to four bytes, so the byte length bounds their number: most texts are decided
    by two lengths, and only the rest pay for the regular expression.
    """
    text = _col(text)
    chars = F.length(text)
    extra = F.octet_length(text) - chars
    exact = F.try_divide(F.length(F.regexp_replace(text, r"[^\x00-\x7F]", "")), chars)
    return F.coalesce(
        F.when(chars == 0, F.lit(False))
        .when(extra == 0, F.lit(1.0) > F.lit(thresh))
        # from extra / 3 to extra characters are not ASCII; the margin keeps rounding out of the shortcuts
        .when(F.try_divide(extra, chars * 3) > F.lit(1.0 - thresh + 1e-6), F.lit(False))
        .when(F.try_divide(extra, chars) < F.lit(1.0 - thresh - 1e-6), F.lit(True))
        .otherwise(exact > F.lit(thresh)),
        F.lit(False),
    )


def evaluate_once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once per row.

    Spark inlines a projected column into every predicate that is pushed below it; a lambda variable is not inlined.
    """
    return F.element_at(F.transform(F.array(value), use), 1)


def toxicity(text: Column | str, words: Sequence[str] = voc.TOXIC_WORDS) -> Column:
    """0.6 when a toxic word occurs in the text, else 0.05."""
    toxic = evaluate_once(lowered(text), lambda low: contains_any(low, words))
    return F.when(toxic, F.lit(0.6)).otherwise(F.lit(0.05))


def rule_sentiment(
    text: Column | str, pos: Sequence[str] = voc.POSITIVE_WORDS, neg: Sequence[str] = voc.NEGATIVE_WORDS
) -> Column:
    """0.7 on a positive word, else -0.6 on a negative one, else 0.1."""
    return evaluate_once(
        lowered(text),
        lambda low: F.when(contains_any(low, pos), F.lit(0.7))
        .when(contains_any(low, neg), F.lit(-0.6))
        .otherwise(F.lit(0.1)),
    )


def hashtags(text: Column | str) -> Column:
    """Sorted distinct lower-case hashtags."""
    found = F.regexp_extract_all(F.coalesce(_col(text), F.lit("")), F.lit(HASHTAG), F.lit(0))
    return F.sort_array(F.array_distinct(F.transform(found, F.lower)))


def marketing_signals(text: Column | str, phrases: Sequence[str] = voc.SIGNAL_PHRASES) -> Column:
    """The phrases that occur in the text as substrings, in list order."""
    listed = F.array(*[F.lit(phrase) for phrase in phrases])
    return evaluate_once(lowered(text), lambda low: F.filter(listed, lambda phrase: F.contains(low, phrase)))


def has_signal(text: Column | str, phrases: Sequence[str] = voc.SIGNAL_PHRASES) -> Column:
    """True when any phrase occurs; stops at the first one found."""
    return evaluate_once(lowered(text), lambda low: contains_any(low, phrases))


def has_hashtag(text: Column | str) -> Column:
    """True when the text holds a hashtag."""
    return F.coalesce(_col(text).rlike(HASHTAG), F.lit(False))


def strip(text: Column | str) -> Column:
    """Text without outer white space of any kind."""
    return F.btrim(_col(text), F.lit(SPACES))


def not_removed(text: Column | str) -> Column:
    """False for null, blank and ``[removed]`` text."""
    return F.coalesce(~F.lower(strip(text)).isin("", "[removed]"), F.lit(False))


def coalesce_text(*cols: Column | str) -> Column:
    """The first column that is neither null nor empty, else an empty string."""
    texts = [_col(c).cast("string") for c in cols]
    return F.coalesce(*[F.when(t != "", t) for t in texts], F.lit(""))


def to_text(value: Column | str) -> Column:
    """The value as text, null as empty."""
    return F.coalesce(_col(value).cast("string"), F.lit(""))


def truncate(text: Column | str, n: int) -> Column:
    """The first ``n`` characters."""
    return F.substring(_col(text), 1, n)


def normalise_text(text: Column | str) -> Column:
    """Lower-case words and digits only: URLs, e-mails, phone numbers and punctuation become single spaces."""

    def gated(pattern: str, *marks: str):
        return lambda t: F.when(contains_any(t, marks), F.regexp_replace(t, pattern, " ")).otherwise(t)

    # most texts hold neither a URL nor an address: a substring test spares them the regular expression
    out = evaluate_once(lowered(text), gated(URL, "http", "www."))
    out = evaluate_once(out, gated(EMAIL, "@"))
    out = F.regexp_replace(out, PHONE, " ")
    return F.trim(F.regexp_replace(out, NON_WORD, " "))


def tokens(normalised: Column | str, stop: Sequence[str], min_len: int = 3) -> Column:
    """Words of a normalised text without stop words, short words and numbers."""
    # one set lookup per word: the list is folded into an IN set, not scanned
    return F.filter(
        F.split(_col(normalised), " "),
        lambda word: (F.length(word) >= min_len) & ~word.isin(*stop) & ~word.rlike(NUMERIC),
    )


def with_bigrams(words: Column | str) -> Column:
    """The words followed by their space-joined neighbours."""
    words = _col(words)
    follow = F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0)))
    pairs = F.zip_with(
        F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), follow, lambda a, b: F.concat(a, F.lit(" "), b)
    )
    return F.concat(words, pairs)


def snippet(text: Column | str, n: int = 120) -> Column:
    """The first ``n`` characters, trimmed, with an ellipsis; shorter text as it is."""
    text = to_text(text)
    return F.when(F.length(text) > n, F.concat(strip(F.substring(text, 1, n)), F.lit("..."))).otherwise(text)


def fill_template(template: Column | str, value: Column | str) -> Column:
    """``{snippet}`` in the template replaced by the value; any other mark stays."""
    template = F.lit(template) if isinstance(template, str) else template
    return F.replace(template, F.lit("{snippet}"), _col(value))


def json_arr(values: Column | str) -> Column:
    """An array as JSON text."""
    return F.to_json(_col(values))


def parse_json_list(text: Column | str) -> Column:
    """JSON text to an array of strings; anything else gives an empty array."""
    text = _col(text)
    parsed = F.when(F.startswith(strip(text), F.lit("[")), F.from_json(text, "array<string>"))
    return F.coalesce(parsed, F.array().cast("array<string>"))
