"""Lexicon sentiment of comments."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from audience_engine import vocabulary as voc
from audience_engine.functions.drafts import sentiment_label
from audience_engine.functions.text import WORD_BREAK, evaluate_once, lowered
from audience_engine.operators.joining import lookup_join

NEGATION = -0.74
ALPHA = 15.0
MAX_LEXICON = 50_000
SCORES = ("neg", "neu", "pos", "compound", "sentiment_label")


def words(text: Column | str) -> Column:
    """Lower-case words of a text."""
    return F.filter(F.split(lowered(text), WORD_BREAK), lambda w: w != "")


def negated(tokens: Column | str, span: int = 3, negators: Sequence[str] = voc.NEGATORS) -> Column:
    """Per word ``struct(word, negated)``: whether one of the ``span`` words before it is a negator.

    The look-back stays inside the row's array, so no word is shuffled to find its neighbours.
    """
    tokens = F.col(tokens) if isinstance(tokens, str) else tokens

    def marked(flags: Column):
        def one(w: Column, i: Column) -> Column:
            before = [F.coalesce(F.get(flags, i - back), F.lit(False)) for back in range(1, span + 1)]
            return F.struct(w.alias("word"), reduce(or_, before).alias("negated"))

        return one

    return evaluate_once(
        tokens,
        lambda t: evaluate_once(
            F.transform(t, lambda w: w.isin(*negators)), lambda flags: F.transform(t, marked(flags))
        ),
    )


def one_valence(lexicon: DataFrame) -> DataFrame:
    """(word, valence) with one row per word: the largest of its values; rows without either are left out."""
    return lexicon.dropna(subset=["word", "valence"]).groupBy("word").agg(F.max(F.col("valence").cast("double")).alias("valence"))


def lexicon_values(lexicon: DataFrame | Mapping[str, float], most: int = MAX_LEXICON) -> Mapping[str, float] | None:
    """The lexicon as a mapping, or None if it has more than ``most`` words, too many to go into a plan."""
    if isinstance(lexicon, Mapping):
        return lexicon
    rows = one_valence(lexicon).limit(most + 1).collect()
    return {r["word"]: r["valence"] for r in rows} if len(rows) <= most else None


def _shares(total: Column, p: Column, n: Column, hits: Column, size: Column) -> Column:
    """The scores from the sums over a text's words."""
    neutral = size - hits
    mass = p + n + neutral
    compound = F.round(total / F.sqrt(total * total + F.lit(ALPHA)), 4) + F.lit(0.0)
    return F.struct(
        F.coalesce(F.round(F.try_divide(n, mass), 3), F.lit(0.0)).alias("neg"),
        F.coalesce(F.round(F.try_divide(neutral, mass), 3), F.lit(0.0)).alias("neu"),
        F.coalesce(F.round(F.try_divide(p, mass), 3), F.lit(0.0)).alias("pos"),
        compound.alias("compound"),
        sentiment_label(compound).alias("sentiment_label"),
    )


def text_scores(text: Column | str, values: Mapping[str, float]) -> Column:
    """Shares of negative, neutral and positive words, compound score and label of a text, inside its row.

    Words are looked up in hashed sets, one per valence; a word outside the lexicon costs one look.
    """
    by_valence: dict[float, list[str]] = {}
    for word, valence in values.items():
        by_valence.setdefault(float(valence), []).append(word)
    nothing = F.lit(None).cast("double")

    def value(item: Column) -> Column:
        if not values:
            return nothing
        found = F.coalesce(*[F.when(item["word"].isin(*words), F.lit(v)) for v, words in sorted(by_valence.items())], nothing)
        return F.when(item["word"].isin(*values), found * F.when(item["negated"], F.lit(NEGATION)).otherwise(F.lit(1.0)))

    def add(sums: Column, v: Column) -> Column:
        return F.struct(
            (sums["total"] + v).alias("total"),
            (sums["p"] + F.when(v > 0, v + 1).otherwise(0.0)).alias("p"),
            (sums["n"] + F.when(v < 0, 1 - v).otherwise(0.0)).alias("n"),
            (sums["hits"] + F.lit(1.0)).alias("hits"),
        )

    zero = F.struct(*[F.lit(0.0).alias(c) for c in ("total", "p", "n", "hits")])

    def scored(marked: Column) -> Column:
        hits = F.filter(F.transform(marked, value), lambda v: v != 0)
        return evaluate_once(F.aggregate(hits, zero, add), lambda s: _shares(s["total"], s["p"], s["n"], s["hits"], F.size(marked)))

    return evaluate_once(negated(words(text)), scored)


def score_by_words(df: DataFrame, lexicon: DataFrame, text: str, keys: Sequence[str]) -> DataFrame:
    """One row of scores per distinct (keys, ``_text``, a hash of the text), for a lexicon too large for a plan.

    All words of a text are exploded and summed inside one map task, so only one narrow row per text is shuffled; the
    text itself is not.
    """
    text_words = df.select(
        *keys,
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("_text"),
        words(text).alias("_words"),
    ).withColumn("_size", F.size("_words"))
    # the empty word counts the copies of a text and keeps texts without any word
    start = F.array(F.struct(F.lit("").alias("word"), F.lit(False).alias("negated")))
    exploded = text_words.select(*keys, "_text", "_size", F.explode(F.concat(start, negated("_words"))).alias("_w"))
    flat = exploded.select(*keys, "_text", "_size", F.col("_w.word").alias("word"), F.col("_w.negated").alias("neg"))
    joined = lookup_join(flat, one_valence(lexicon), "word")
    value = F.col("valence") * F.when(F.col("neg"), F.lit(NEGATION)).otherwise(F.lit(1.0))
    sums = (
        joined.select(*keys, "_text", "_size", "word", value.alias("v"))
        .groupBy(*keys, "_text", "_size")
        .agg(
            F.count_if(F.col("word") == "").alias("copies"),
            F.coalesce(F.sum("v"), F.lit(0.0)).alias("total"),
            F.coalesce(F.sum(F.when(F.col("v") > 0, F.col("v") + 1)), F.lit(0.0)).alias("p"),
            F.coalesce(F.sum(F.when(F.col("v") < 0, 1 - F.col("v"))), F.lit(0.0)).alias("n"),
            F.count_if(F.col("v") != 0).alias("hits"),
        )
    )
    each = {c: F.col(c) / F.col("copies") for c in ("total", "p", "n", "hits")}
    return sums.select(*keys, "_text", _shares(**each, size=F.col("_size")).alias("_scores"))


def with_sentiment(
    comments: DataFrame,
    lexicon: DataFrame | Mapping[str, float],
    text: str = "comment",
    keys: Sequence[str] = ("source", "comment_id"),
    most: int = MAX_LEXICON,
) -> DataFrame:
    """The comments with their sentiment columns.

    ``lexicon`` has (word, valence). Up to ``most`` words, each comment is scored where it is: one scan, no shuffle.
    """
    own = [c for c in comments.columns if c not in SCORES]
    values = lexicon_values(lexicon, most)
    if values is not None:
        scored = comments.select(*own, text_scores(text, values).alias("_scores"))
        return scored.select(*own, "_scores.*")
    by_text = score_by_words(comments, lexicon, text, keys)
    keyed = comments.withColumn("_text", F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    same = [keyed[k].eqNullSafe(by_text[k]) for k in (*keys, "_text")]
    return keyed.join(by_text, same, "left").select(*[keyed[c] for c in own], by_text["_scores"]).select(*own, "_scores.*")


def text_hash(text: str = "comment") -> Column:
    """What tells the texts of one comment id apart in a stored table."""
    return F.md5(F.coalesce(F.col(text), F.lit("")))


def lexicon_sentiment(
    df: DataFrame, lexicon: DataFrame | Mapping[str, float], text: str = "comment", keys: Sequence[str] = ("source", "comment_id")
) -> DataFrame:
    """Keys, hash of the text, scores and label of each comment, without the text: a table to store."""
    return with_sentiment(df, lexicon, text, keys).select(*keys, text_hash(text).alias("text_hash"), *SCORES)


def join_labels(
    comments: DataFrame,
    sentiment: DataFrame,
    keys: Sequence[str] = ("source", "comment_id"),
    label: str = "sentiment_label",
    text: str | None = "comment",
) -> DataFrame:
    """The comments with the label of a stored sentiment table; unknown comments get null.

    Rows meet by their keys, null ones too, and by ``text_hash`` where the table has it and the comments their text. Each
    comment stays one row: a table with several labels for one of them gives the first by name.
    """
    hashed = "text_hash" in sentiment.columns and text in comments.columns
    names = [*keys, "text_hash"] if hashed else list(keys)
    stored = sentiment.groupBy(*names).agg(F.min(label).alias("_label"))
    stored = stored.withColumnsRenamed({c: f"_{c}" for c in names})
    mine = comments.withColumn("_hash", text_hash(text)) if hashed else comments
    same = [mine["_hash" if c == "text_hash" else c].eqNullSafe(stored[f"_{c}"]) for c in names]
    return mine.join(stored, same, "left").select(*[mine[c] for c in comments.columns if c != label], F.col("_label").alias(label))
