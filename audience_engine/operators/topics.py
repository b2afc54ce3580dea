"""Topics of comments: term weights, latent space, clusters, labels."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml import PipelineModel
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from audience_engine.functions.drafts import topic_label
from audience_engine.functions.scoring import cosine_distance, magnitude_bin
from audience_engine.functions.text import evaluate_once, normalise_text, not_removed, tokens, with_bigrams
from audience_engine.operators.density import density_clusters
from audience_engine.operators.joining import lookup_join, top_per_group
from audience_engine.session import cut_alone, cut_lineage, drop_staged, laid_out, shuffles_dropped, staged_by
from audience_engine.settings import Settings

# --- terms -----------------------------------------------------------------------------------------------------------

#: Vocabularies up to this size are so few rows of each task that one task can order them.
TAKEN_AT_ONCE = 10_000

#: All pairs of documents and terms take several times the room of the texts when they are shuffled, so they are by slices of the
#: terms: one more for each so many documents, up to the most.
ROWS_PER_SLICE, MOST_SLICES = 1_000, 16


def document_terms(df: DataFrame, text: str, stop: Sequence[str], bigrams: bool = True, staged: Sequence[str] | None = None) -> DataFrame:
    """Add ``terms``: the words of each text, with neighbouring pairs.

    ``staged`` names the only columns to keep and has the words written once, for work that reads the terms several times.
    """
    words = df.withColumn("_words", tokens(normalise_text(text), stop))
    if staged is not None:
        words = cut_lineage(words.select(*staged, "_words"))
    return words.withColumn("terms", with_bigrams("_words") if bigrams else F.col("_words")).drop("_words")


def term_counts(df: DataFrame, terms: str = "terms", tf: bool = True) -> DataFrame:
    """Occurrences (``tf``, if wished) and documents (``df``) of each term, in one shuffle.

    The terms of a document are sorted inside its row, so that a repeated term is seen next to itself; if only documents
    are counted, each row's distinct terms do, or the rows of ``term_pairs``.
    """
    if not tf:
        distinct = F.explode(F.array_distinct(terms)) if dict(df.dtypes)[terms].startswith("array") else F.col(terms)
        return df.select(distinct.alias("term")).groupBy("term").agg(F.count("*").alias("df"))

    def marked(t: Column) -> Column:
        def one(word: Column, i: Column) -> Column:
            return F.struct(word.alias("term"), ((i == 0) | (F.get(t, i - 1) != word)).alias("new"))

        return F.transform(t, one)

    rows = df.select(F.inline(evaluate_once(F.sort_array(terms), marked)))
    return rows.groupBy("term").agg(F.count("*").alias("tf"), F.count_if("new").alias("df"))


def term_idf(
    df: DataFrame, terms: str = "terms", min_df: int = 1, max_share: float = 0.98, vocabulary: int | None = None, tf: bool = True,
    rows: int | None = None,
) -> DataFrame:
    """The terms with their smoothed inverse document frequency, ``ln((1 + n) / (1 + df)) + 1``.

    Kept are the terms in at least ``min_df`` documents and at most ``max_share`` of them; with ``vocabulary``, so many
    of the most frequent ones (equal ones by the md5 of the term). Without ``tf`` the occurrences are not counted, so
    there is no vocabulary to choose. ``rows`` is the number of documents, if ``df`` has more or fewer rows than that.
    """
    if vocabulary is not None and not tf:
        raise ValueError("a vocabulary is chosen by tf")
    # a scalar that is never null adds no filter
    if rows is None:
        documents = F.coalesce(df.select(F.lit(1)).agg(F.count("*")).scalar(), F.lit(0).cast("long"))
    else:
        documents = F.lit(rows).cast("long")
    counted = term_counts(df, terms, tf).withColumn("_n", documents)
    kept = counted.filter((F.col("df") >= min_df) & (F.col("df") <= F.lit(max_share) * F.col("_n")))
    if vocabulary is not None and vocabulary <= TAKEN_AT_ONCE:
        # each task keeps its first rows, and only those meet: nothing is staged and the terms are counted in one go
        kept = kept.orderBy(F.col("tf").desc(), F.md5("term"), "term").limit(vocabulary)
    elif vocabulary is not None:
        kept = most_frequent(cut_lineage(kept), vocabulary)
    counts = ["tf", "df"] if tf else ["df"]
    return kept.select("term", *counts, (F.log((F.col("_n") + 1.0) / (F.col("df") + 1.0)) + 1.0).alias("idf"))


def term_dictionary(weights: DataFrame) -> DataFrame:
    """``weights`` (of ``term_idf``) with each term's number ``index``, 0 and up without gaps.

    The terms are written once, each with its task and its place there; only the tasks' counts are summed up in order, so
    there may be any number of terms, and none is shuffled or sorted to be numbered.
    """
    staged = cut_lineage(weights.withColumn("_at", F.monotonically_increasing_id()))
    rows = staged.withColumn("_task", F.shiftright("_at", 33)).withColumn("_place", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
    counts = rows.groupBy("_task").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    numbered = rows.join(F.broadcast(starts), "_task")  # one row per task that wrote
    return numbered.select(*weights.columns, (F.col("_start") + F.col("_place")).alias("index"))


def counted_in_row(terms: str = "terms") -> Column:
    """The distinct terms of a row's array with their number of occurrences, as structs ``term``, ``tf``."""

    def counted(t: Column) -> Column:
        heads = F.array_compact(F.transform(t, lambda w, i: F.when((i == 0) | (F.get(t, i - 1) != w), i)))

        def runs(h: Column) -> Column:
            return F.transform(
                h, lambda at, j: F.struct(F.get(t, at).alias("term"), (F.coalesce(F.get(h, j + 1), F.size(t)) - at).cast("double").alias("tf"))
            )

        return evaluate_once(heads, runs)

    return evaluate_once(F.sort_array(terms), counted)


def term_pairs(df: DataFrame, key: str, terms: str = "terms", carry: Sequence[str] = ()) -> DataFrame:
    """``key``, the columns ``carry``, ``term`` and ``times`` for each row and each of its terms, staged by slices of the terms."""
    slices = min(MOST_SLICES, 1 + df.count() // ROWS_PER_SLICE)
    pairs = df.select(key, *carry, F.inline(counted_in_row(terms)).alias("term", "times"))
    return staged_by(pairs.withColumn("_slice", F.pmod(F.xxhash64("term"), F.lit(slices)).cast("int")), "_slice")


def by_slices(pairs: DataFrame, use: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The united results of ``use`` on each slice of ``term_pairs``: written, and its shuffles gone, before the next begins."""
    with shuffles_dropped(pairs.sparkSession):
        slices = sorted(r["_slice"] for r in pairs.select("_slice").distinct().collect()) or [0]
        done = [cut_alone(pairs.sparkSession, lambda at=at: use(pairs.filter(F.col("_slice") == at))) for at in slices]
    return reduce(DataFrame.unionByName, done)


def _weighed(df: DataFrame, weights: DataFrame, terms: str, *columns: str) -> DataFrame:
    """``columns`` of ``df``, all columns of ``weights``, and ``w``: a term's number in the row times its ``idf``."""
    if dict(df.dtypes)[terms].startswith("array"):
        df = df.select(*columns, F.inline(counted_in_row(terms)).alias("term", "times"))
    else:
        df, weights = df.select(*columns, F.col(terms).alias("term"), "times"), weights.hint("shuffle_hash")
    return df.join(weights, "term").select(*columns, *weights.columns, (F.col("times") * F.col("idf")).alias("w"))


def weight_norms(pairs: DataFrame, weigh: Callable[[DataFrame], DataFrame], key: str) -> DataFrame:
    """``key`` and ``norm``: the length of each document's vector of term weights, from ``term_pairs`` by their slices.

    ``weigh`` gives the weights (``term``, ``idf``) of a slice.
    """

    def squares(part: DataFrame) -> DataFrame:
        return _weighed(part, weigh(part), "term", key).groupBy(key).agg(F.sum(F.col("w") * F.col("w")).alias("_square"))

    parts = by_slices(pairs, squares)
    with shuffles_dropped(pairs.sparkSession):
        norms = cut_lineage(parts.groupBy(key).agg(F.sqrt(F.sum("_square")).alias("norm")))
    drop_staged(parts)
    return norms


def unit_weights(
    df: DataFrame, weights: DataFrame, key: str, terms: str = "terms", carry: Sequence[str] = (), norms: DataFrame | None = None
) -> DataFrame:
    """``key``, the columns ``carry``, all columns of ``weights``, and ``w``: the term weights of each document, as a unit vector.

    The terms are counted inside the row and joined to their weights, where adaptive execution splits the terms that
    very many documents hold; the norm is summed per document. No vocabulary passes the driver, and none is cut.
    With the ``norms`` of ``weight_norms``, ``df`` may be a slice of ``term_pairs`` (``terms`` is its ``term`` then).
    """
    if norms is None:
        pairs = _weighed(df, weights, terms, key, *carry)
        norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(key)))  # the terms of one document
    else:
        lengths = norms.select(F.col(key).alias("_key"), F.col("norm").alias("_norm")).hint("shuffle_hash")
        normed = df.join(lengths, F.col(key).eqNullSafe(F.col("_key")))  # rows without a norm have no weight
        pairs = _weighed(normed, weights, terms, key, *carry, "_norm")
        norm = F.col("_norm")
    return pairs.select(key, *carry, *weights.columns, (F.col("w") / norm).alias("w"))


def sparse_rows(weighed: DataFrame, key: str) -> DataFrame:
    """``key``, ``indices`` and ``values`` of each document's weights by the numbers of a ``term_dictionary``."""
    row = F.sort_array(F.collect_list(F.struct("index", "w")))  # the terms of one document
    return weighed.groupBy(key).agg(row.alias("_row")).select(key, F.col("_row.index").alias("indices"), F.col("_row.w").alias("values"))


def most_frequent(counted: DataFrame, n: int) -> DataFrame:
    """The ``n`` rows with the largest (``tf``, then smallest md5 of ``term``) without sorting them all.

    The place of the last kept row is narrowed down by counts: its magnitude, its frequency, the first digits of its md5;
    only the terms that agree in all three, a few even among millions of ties, are sorted.
    """
    rows = counted.withColumns({"_bin": -magnitude_bin(F.col("tf")), "_down": -F.col("tf"), "_head": F.substring(F.md5("term"), 1, 4)})
    inside, left = F.lit(True), n
    for level in ("_bin", "_down", "_head"):
        upto = Window.orderBy(level).rowsBetween(Window.unboundedPreceding, 0)
        steps = rows.filter(inside).groupBy(level).agg(F.count("*").alias("_k")).withColumn("_upto", F.sum("_k").over(upto))
        last = steps.filter(F.col("_upto") >= left).orderBy(level).limit(1).first()
        if last is None:
            return counted
        rows = rows.withColumn(f"{level}_in", ~inside | (F.col(level) <= F.lit(last[level])))
        rows = rows.filter(F.col(f"{level}_in")).drop(f"{level}_in")
        inside, left = inside & (F.col(level) == F.lit(last[level])), left - (last["_upto"] - last["_k"])
    ties = rows.filter(inside).orderBy(F.md5("term"), "term").limit(left)
    return rows.filter(~inside).unionByName(ties).select(*counted.columns)


def class_tfidf(df: DataFrame, label: str, terms: str = "terms", n: int | None = 7) -> DataFrame:
    """Terms that set a class apart: ``tf * ln(1 + a / f)``, where ``f`` counts the term over all classes and ``a``
    is the mean number of words per class."""
    counted = (
        # sorted, so that equal terms of a document meet at once in the map-side count
        df.select(label, F.explode(F.sort_array(terms)).alias("term"))
        .groupBy(label, "term")
        .agg(F.count("*").alias("tf"))
    )
    mean_words = counted.agg(F.sum("tf") / F.count_distinct(label)).scalar()
    weighed = counted.withColumn("f", F.sum("tf").over(Window.partitionBy("term"))).select(
        label, "term", "tf", (F.col("tf") * F.log(F.lit(1.0) + mean_words / F.col("f"))).alias("weight")
    )
    if n is None:
        return weighed
    order = [F.round("weight", 9).desc(), F.col("term")]
    return top_per_group(weighed, [label], order, n, rank="rank")


# --- vectors ---------------------------------------------------------------------------------------------------------


def centroids(df: DataFrame, vec: str, label: str, name: str = "centroid") -> DataFrame:
    """The mean vector of each cluster."""
    vector = F.col(vec) if dict(df.dtypes)[vec] == "vector" else array_to_vector(F.col(vec).cast("array<double>"))
    mean = df.groupBy(label).agg(Summarizer.mean(vector).alias("_mean"), F.count("*").alias("size"))
    return mean.select(label, "size", vector_to_array("_mean").alias(name))


def nearest_docs(df: DataFrame, centers: DataFrame, vec: str, label: str, key: str, n: int = 3) -> DataFrame:
    """The ``n`` documents of each cluster nearest to its centroid by cosine distance, with their rank."""
    joined = lookup_join(df, centers.select(label, "centroid"), label, "inner")
    ranked = joined.withColumn("distance", F.round(cosine_distance(vec, "centroid"), 6)).drop("centroid")
    return top_per_group(ranked, [label], [F.col("distance"), F.col(key)], n, rank="rank")


def cluster_sizes(df: DataFrame, label: str = "topic") -> DataFrame:
    """Members per cluster."""
    return df.groupBy(label).agg(F.count("*").alias("size"))


def keep_clusters(sizes: DataFrame, min_size: int = 5, fallback: int = 10, label: str = "topic") -> DataFrame:
    """Clusters of at least ``min_size`` members; if there is none, the ``fallback`` largest."""
    largest = F.coalesce(sizes.agg(F.max("size")).scalar(), F.lit(0).cast("long"))
    biggest = sizes.orderBy(F.col("size").desc(), label).limit(fallback)
    return sizes.filter(F.col("size") >= min_size).unionByName(biggest.filter(largest < min_size))


# --- models ----------------------------------------------------------------------------------------------------------


@dataclass
class TfidfModel:
    """Fitted term weights: ``transform`` adds the unit vector of each document's terms."""

    vocabulary: list[str]
    stages: PipelineModel

    def transform(self, df: DataFrame) -> DataFrame:
        return self.stages.transform(df).drop("_counts", "_weighed")


def _counter(spark: SparkSession, vocabulary: list[str]) -> CountVectorizerModel:
    """A counter of the given terms, which cross to the JVM in one call instead of one by one (no term holds a line end)."""
    words = spark.sparkContext._jvm.java.util.regex.Pattern.compile("\n").split("\n".join(vocabulary))
    model = CountVectorizerModel._create_from_java_class("org.apache.spark.ml.feature.CountVectorizerModel", words)
    return model._set(vocabSize=max(1, len(vocabulary)))


def fit_tfidf(df: DataFrame, settings: Settings, terms: str = "terms", out: str = "tfidf") -> TfidfModel:
    """Fit vocabulary and inverse document frequencies on a table with a ``terms`` array.

    Both come from one count of the terms; only the vocabulary, at most ``settings.topic_vocabulary`` terms, is
    collected.
    """
    weights = term_idf(df, terms, 1, settings.max_document_share, settings.topic_vocabulary)
    rows = weights.select("term", "idf").toPandas()
    drop_staged(weights)  # the counts of all terms
    vocabulary = rows["term"].tolist()
    counter = _counter(df.sparkSession, vocabulary).setInputCol(terms).setOutputCol("_counts")
    weigh = ElementwiseProduct(
        scalingVec=Vectors.dense(rows["idf"].to_numpy()), inputCol="_counts", outputCol="_weighed"
    )
    unit = Normalizer(p=2.0, inputCol="_weighed", outputCol=out)
    return TfidfModel(vocabulary, PipelineModel(stages=[counter, weigh, unit]))


def _flat(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row offsets, term indices, values) of a batch of sparse rows."""
    indices, values = rows.column("indices"), rows.column("values")
    offsets = np.asarray(indices.offsets)
    terms, weights = np.asarray(indices.values)[offsets[0] : offsets[-1]], np.asarray(values.values)
    ends = np.asarray(values.offsets)
    return offsets - offsets[0], terms, weights[ends[0] : ends[-1]]


def _run_sums(starts: np.ndarray, weights: np.ndarray, rows: np.ndarray, matrix: np.ndarray, most: int = 512) -> np.ndarray:
    """For each run of values, begun at ``starts``, the sum of ``weights`` times the rows of ``matrix`` numbered ``rows``.

    Whole runs of about ``most`` values are worked through at a time, so that the products stay in the processor's cache. A run is
    added up in its own order, so the digits don't depend on that.
    """
    out = np.zeros((len(starts), matrix.shape[1]))
    ends = np.append(starts[1:], len(weights))
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + most, "right")))
        low, high = starts[first], ends[last - 1]
        out[first:last] = np.add.reduceat(weights[low:high, None] * matrix[rows[low:high]], starts[first:last] - low, axis=0)
        first = last
    return out


def _products(offsets: np.ndarray, terms: np.ndarray, values: np.ndarray, right: np.ndarray, most: int = 1 << 15):
    """(slice of rows, their terms and values, rows x ``right``) for slices with about ``most`` values."""
    first = 0
    while first < len(offsets) - 1:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        low, high = offsets[first], offsets[last]
        sizes = np.diff(offsets[first : last + 1])
        out = np.zeros((last - first, right.shape[1]))
        some = np.flatnonzero(sizes)
        out[some] = _run_sums((offsets[first:last] - low)[some], values[low:high], terms[low:high], right)
        yield slice(first, last), terms[low:high], values[low:high], sizes, out
        first = last


def _gram_times(rows: DataFrame, basis: np.ndarray, block: int = 512) -> np.ndarray:
    """``X' X B`` for the sparse rows X (indices, values) and a terms x width matrix B.

    Each task multiplies whole slices of rows and adds up, by block of terms, only the terms that it meets; the blocks are
    shuffled (in single precision) and added as they arrive. Only the terms x width result reaches the driver.
    """
    shared = rows.sparkSession.sparkContext.broadcast(basis.astype("float32"))
    width = basis.shape[1]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        right = shared.value
        place = np.full(len(right), -1)  # of a term in the sums
        met: list[np.ndarray] = []
        sums, used = np.zeros((1024, width)), 0
        for batch in batches:
            for _, terms, values, sizes, product in _products(*_flat(batch), right):
                order = np.argsort(terms, kind="stable")
                heads = np.flatnonzero(np.diff(terms[order], prepend=-1))
                unique = terms[order[heads]]
                new = unique[place[unique] < 0]
                place[new] = np.arange(used, used + len(new))
                met.append(new)
                used += len(new)
                if used > len(sums):
                    sums = np.concatenate([sums, np.zeros((max(used - len(sums), len(sums)), width))])
                sums[place[unique]] += _run_sums(heads, values[order], np.repeat(np.arange(len(sizes)), sizes)[order], product)
        terms = np.sort(np.concatenate(met)) if met else np.empty(0, np.int64)
        for b in np.unique(terms // block).tolist():
            own = terms[(terms // block) == b]
            data = [[own.astype("int32").tobytes()], [sums[place[own]].astype("float32").tobytes()]]
            numbers = [pa.array([b], pa.int32()), pa.array([TaskContext.get().partitionId()], pa.int32())]
            yield pa.RecordBatch.from_arrays([*numbers, *map(pa.array, data)], names=["block", "part", "terms", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for row in batch.to_pylist():
                places = np.frombuffer(row["terms"], "int32") - row["block"] * block
                own = totals.setdefault(row["block"], np.zeros((block, width)))
                own[places] += np.frombuffer(row["sums"], "float32").reshape(-1, width)
        for b, own in totals.items():
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([own.astype("float32").tobytes()])], names=["block", "sums"])

    partials = rows.mapInArrow(partial, "block int, part int, terms binary, sums binary")
    # added in the order of the parts, so that a rerun adds up to the same digits
    blocks = partials.repartition("block").sortWithinPartitions("block", "part").mapInArrow(add, "block int, sums binary")
    out = np.zeros_like(basis)
    for row in blocks.toArrow().to_pylist():  # terms x width numbers in all
        first = row["block"] * block
        part = np.frombuffer(row["sums"], "float32").reshape(-1, width)
        out[first : first + block] = part[: len(out) - first]
    shared.destroy()  # the driver's file too, or each pass leaves one
    return out


def _orthonormal(columns: np.ndarray) -> np.ndarray:
    """An orthonormal basis of a tall matrix's columns, by its small Gram matrix, twice for accuracy."""
    for _ in range(2):
        values, vectors = np.linalg.eigh(columns.T @ columns)
        kept = values > 1e-12 * max(values[-1], 1e-300)
        columns = columns @ (vectors[:, kept] / np.sqrt(values[kept]))
    return columns


def right_singular_vectors(
    rows: DataFrame, size: int, dims: int, tolerance: float = 0.01, most: int = 20, seed: int = 42
) -> np.ndarray:
    """The leading right singular vectors (terms x dims) by randomised block iteration (Halko, Martinsson, Tropp 2011).

    Passes over the rows go on until the sum of the leading squared singular values grows by less than ``tolerance``
    of itself; each pass can only raise it. ``most`` passes without that are an error.
    """
    width = min(size, dims + 10)
    basis = _orthonormal(np.random.default_rng(seed).standard_normal((size, width)))
    before = 0.0
    for _ in range(most):
        product = _gram_times(rows, basis)
        values, vectors = np.linalg.eigh(basis.T @ product)
        caught = float(values[::-1][:dims].sum())
        if caught - before <= tolerance * caught:
            return basis @ vectors[:, ::-1][:, :dims]
        before = caught
        basis = _orthonormal(product)
    raise ValueError(f"the singular vectors did not settle in {most} passes: raise the tolerance or the passes")


def fit_lsa(
    df: DataFrame, vec: str = "tfidf", dims: int = 100, out: str = "lsa", seed: int = 42, tolerance: float = 0.01, parts: int | None = None
) -> DataFrame:
    """Add the latent-space vector of each document: its product with the leading right singular vectors.

    The terms x ``dims`` matrix is the only part on the driver (at most 100,000 x 110 doubles, 88 MB). Each task of a pass over
    the rows writes up to that much in single precision; ``parts`` is the most tasks to read them with.
    """
    sparse = F.unwrap_udt(vec)
    size = df.select(sparse["size"].alias("n")).first()["n"]
    rows = df.select(sparse["indices"].alias("indices"), sparse["values"].alias("values"))
    if parts is not None:
        rows = rows.coalesce(parts)
    basis = right_singular_vectors(rows, size, min(dims, max(2, size - 1)), tolerance, seed=seed)
    shared = df.sparkSession.sparkContext.broadcast(basis.astype("float32"))

    def project(indices: pa.Array, values: pa.Array) -> pa.Array:
        right = shared.value
        batch = pa.RecordBatch.from_arrays([indices, values], names=["indices", "values"])
        parts = [product for *_, product in _products(*_flat(batch), right)]
        flat = np.concatenate(parts) if parts else np.empty((0, right.shape[1]))
        ends = np.arange(len(flat) + 1, dtype=np.int32) * right.shape[1]
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.ravel()))

    return df.withColumn(out, F.arrow_udf(project, "array<double>")(sparse["indices"], sparse["values"]))


def _matrix(vectors: pa.Array) -> np.ndarray:
    """Arrays of one length as the rows of a matrix."""
    return np.asarray(vectors.flatten()).astype("float64").reshape(len(vectors), -1)


def _first_centers(rows: DataFrame, vec: str, k: int, seeds: Sequence[int], per_cluster: int = 50) -> np.ndarray:
    """Centres (starts x k x dims) to begin with: k-means++ on ``per_cluster * k`` rows (at least 2,000), those with the least hashes.

    The sample only says where the steps begin; these go over all rows.
    """
    chosen = rows.orderBy(F.xxhash64(vec), vec).limit(max(2000, per_cluster * k)).select(vec).toArrow()
    sample = _matrix(chosen.column(0).combine_chunks())
    norms = (sample**2).sum(axis=1)

    def spread(seed: int) -> np.ndarray:
        draw = np.random.default_rng(seed)
        taken = [int(draw.integers(len(sample)))]
        least = np.full(len(sample), np.inf)
        while len(taken) < k:
            own = sample[taken[-1]]
            least = np.minimum(least, np.maximum(norms - 2 * sample @ own + own @ own, 0.0))
            total = least.sum()
            taken.append(int(draw.choice(len(sample), p=least / total)) if total > 0 else int(draw.integers(len(sample))))
        return sample[taken]

    return np.stack([spread(seed) for seed in seeds])


def _step(rows: DataFrame, vec: str, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sums, sizes, costs) by start and cluster when each row goes to its nearest centre: one pass for all starts.

    Rows are added up by their ``_block`` and cluster; one small row per block and cluster is shuffled by cluster and added in
    the order of the blocks, so the sums don't depend on the tasks. Only starts x k of them reach the driver.
    """
    starts, k, dims = centers.shape
    shared = rows.sparkSession.sparkContext.broadcast(centers.reshape(starts * k, dims))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        norms = (own**2).sum(axis=1)
        totals, last = np.zeros((starts * k, dims + 2)), None

        def summed(block: int) -> pa.RecordBatch:
            some = np.flatnonzero(totals[:, dims]).tolist()
            columns = [pa.array(some, pa.int32()), pa.array([block] * len(some), pa.int32()), pa.array([totals[c].tobytes() for c in some], pa.binary())]
            totals[:] = 0.0
            return pa.RecordBatch.from_arrays(columns, names=["center", "block", "sums"])

        for batch in batches:
            blocks = np.asarray(batch.column("_block"))
            edges = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(blocks)]
            for low, high in zip(edges, edges[1:], strict=False):
                if last is not None and high > low and blocks[low] != last:
                    yield summed(last)
                for at in range(low, high, 4096):
                    last = int(blocks[at])
                    x = _matrix(batch.column(vec).slice(at, min(4096, high - at)))
                    near = norms - 2.0 * x @ own.T
                    size = (x**2).sum(axis=1)
                    for s in range(starts):
                        part = near[:, s * k : (s + 1) * k]
                        cluster = part.argmin(axis=1)
                        chosen = np.zeros((k, len(x)))
                        chosen[cluster, np.arange(len(x))] = 1.0
                        cost = np.maximum(part[np.arange(len(x)), cluster] + size, 0.0)
                        totals[s * k : (s + 1) * k] += np.column_stack([chosen @ x, chosen.sum(axis=1), chosen @ cost])
        if last is not None:
            yield summed(last)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for center, data in zip(batch.column("center").to_pylist(), batch.column("sums").to_pylist(), strict=True):
                totals[center] = totals.get(center, 0.0) + np.frombuffer(data)
        columns = [pa.array(list(totals), pa.int32()), pa.array([t.tobytes() for t in totals.values()], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["center", "sums"])

    partials = rows.select(vec, "_block").mapInArrow(partial, "center int, block int, sums binary")
    added = partials.repartition("center").sortWithinPartitions("center", "block").mapInArrow(add, "center int, sums binary")
    out = np.zeros((starts * k, dims + 2))
    for center, sums in added.collect():  # starts x k rows
        out[center] = np.frombuffer(sums)
    shared.destroy()
    out = out.reshape(starts, k, dims + 2)
    return out[:, :, :dims], out[:, :, dims], out[:, :, dims + 1]


def fit_clusters(
    df: DataFrame,
    k: int,
    vec: str = "lsa",
    seed: int = 42,
    out: str = "topic",
    starts: int = 3,
    tolerance: float = 1e-4,
    most: int = 100,
) -> tuple[DataFrame, np.ndarray]:
    """Assign each row to one of ``k`` k-means clusters; also the cluster centres.

    All ``starts`` are moved in the same passes over the rows, each until no centre moves by more than ``tolerance`` (at
    most ``most`` steps); the one with the least cost is kept. A cluster without rows keeps its centre. Every row gets the
    nearest centre, the first of equals, a zero vector too.
    """
    array = dict(df.dtypes)[vec].startswith("array")
    ready = df.withColumn("_features", F.col(vec) if array else vector_to_array(vec))
    rows = cut_lineage(ready.select("_features", F.spark_partition_id().alias("_block")))
    centers = _first_centers(rows, "_features", k, [seed + i for i in range(starts)])
    cost, moving = np.full(starts, np.inf), np.arange(starts)
    for _ in range(most):
        sums, sizes, costs = _step(rows, "_features", centers[moving])
        cost[moving] = costs.sum(axis=1)
        new = np.where(sizes[:, :, None] > 0, sums / np.maximum(sizes, 1.0)[:, :, None], centers[moving])
        far = np.sqrt(((new - centers[moving]) ** 2).sum(axis=2)).max(axis=1)
        centers[moving] = new
        moving = moving[far > tolerance]
        if not len(moving):
            break
    drop_staged(rows)
    # costs that differ in their last digits only are equal: the first of those fits, so that reruns number clusters alike
    best = centers[min(range(starts), key=lambda s: float(f"{cost[s]:.9g}"))]
    return ready.withColumn(out, nearest_center(df.sparkSession, best, "_features")).drop("_features"), best


def nearest_center(spark: SparkSession, centers: np.ndarray, vec: str) -> Column:
    """The number of the centre (one of the rows of ``centers``) nearest to an array of doubles, the first of equals."""
    shared = spark.sparkContext.broadcast(centers)

    def nearest(vectors: pa.Array) -> pa.Array:
        own = shared.value
        norms = (own**2).sum(axis=1)
        parts = [(norms - 2.0 * _matrix(vectors.slice(at, 4096)) @ own.T).argmin(axis=1) for at in range(0, len(vectors), 4096)]
        return pa.array(np.concatenate(parts) if parts else np.empty(0), pa.int32())

    return F.arrow_udf(nearest, "int")(vec)


def top_terms(assigned: DataFrame, vocabulary: DataFrame, label: str = "topic", vec: str = "tfidf", k: int = 6) -> DataFrame:
    """The ``k`` terms with the largest mean weight in each cluster, best first.

    ``vocabulary`` has (index, term) and at most the fitted vocabulary size.
    """
    sparse = F.unwrap_udt(vec)
    weights = (
        assigned.select(label, F.explode(F.arrays_zip(sparse["indices"].alias("i"), sparse["values"].alias("v"))).alias("_t"))
        .groupBy(label, F.col("_t.i").alias("index"))
        .agg(F.sum("_t.v").alias("weight"))
    )
    named = lookup_join(weights, vocabulary, "index", "inner")
    ranked = top_per_group(named, [label], [F.round("weight", 9).desc(), F.col("term")], k, rank="rank")
    # k rows per cluster
    listed = ranked.groupBy(label).agg(F.sort_array(F.collect_list(F.struct("rank", "term"))).alias("_terms"))
    return listed.select(label, F.transform("_terms", lambda t: t["term"]).alias("terms"))


#: Texts with their terms and vectors are heavy rows: a few hundred thousand are work for more than eight tasks. Each task of a
#: pass over the rows sends up to terms x width sums, so it is not less either.
TEXTS_PER_PART = 20_000


@dataclass
class Topics:
    """Members (topic, topic_prob, topic_name, document, source, ids) and the summary per topic."""

    members: DataFrame
    summary: DataFrame


def _fitted_terms(df: DataFrame, key: str, text: str, settings: Settings) -> tuple[DataFrame, int, TfidfModel]:
    """The documents that are not blank or removed, laid out, with their terms; their number; and their fitted term weights."""
    dated = ["created_utc"] if "created_utc" in df.columns else []
    kept = df.filter(not_removed(text)).select(F.col(key).alias("id"), F.col(text).alias("document"), *dated)
    count = kept.count()
    # the texts alone are shuffled: their terms take three times the room and are found again where they are read
    ordered = kept.withColumn("_order", F.xxhash64("id", "document"))
    termed = document_terms(laid_out(ordered, "_order", "id", "document", rows=count, per_part=TEXTS_PER_PART), "document", settings.stop_words)
    return termed, count, fit_tfidf(termed, settings)


def build_source_topics(df: DataFrame, source: str, key: str, text: str, settings: Settings) -> Topics:
    """Topics of one source: term weights, latent vectors, clusters, then their names and nearest documents.

    Every document that is not blank or removed gets a cluster and stays one row, whatever its id: rows carry a number of
    their own and their text from the first staged table to the last, so nothing is joined back by id.
    """
    with shuffles_dropped(df.sparkSession):
        return _source_topics(*_fitted_terms(df, key, text, settings), source, key, settings)


def _source_topics(termed: DataFrame, count: int, model: TfidfModel, source: str, key: str, settings: Settings) -> Topics:
    """On disk are a source's texts twice at the most, with their term weights and with their latent vectors; the latter stay."""
    spark = termed.sparkSession
    dated = ["created_utc"] if "created_utc" in termed.columns else []
    carried = ["id", "document", *dated, "tfidf"]
    weighed = cut_lineage(model.transform(termed).select(F.monotonically_increasing_id().alias("doc_key"), *carried))
    projected = fit_lsa(weighed, dims=settings.topic_dims, parts=max(8, -(-count // TEXTS_PER_PART)))
    latent = cut_lineage(projected.drop("tfidf"))
    k = min(settings.topic_count, max(2, count // max(1, settings.topic_min_size)))
    vectors = latent.select("doc_key", "lsa")
    _, centers = fit_clusters(laid_out(vectors, "doc_key", rows=count, per_part=TEXTS_PER_PART), k, "lsa", starts=settings.topic_starts)
    cluster = nearest_center(spark, centers, "lsa")  # follows from a row's own vector, so no texts move to get it
    assigned = latent.withColumn("topic", cluster)

    # at most k rows
    sizes = keep_clusters(cut_lineage(cluster_sizes(assigned)), settings.topic_min_size, min(k, 10))
    words = pd.DataFrame({"index": range(len(model.vocabulary)), "term": model.vocabulary})
    vocabulary = spark.createDataFrame(words, "index int, term string")
    terms = top_terms(projected.withColumn("topic", cluster).select("topic", "tfidf"), vocabulary, k=settings.topic_label_words)
    # at most k rows from here on
    names = sizes.join(terms, "topic", "left").withColumn("topic_name", topic_label("terms", "topic"))
    labels = cut_lineage(names.select("topic", "size", "topic_name"))
    drop_staged(weighed)
    nearest = nearest_docs(assigned.select("doc_key", "topic", "lsa"), centroids(assigned, "lsa", "topic"), "lsa", "topic", "doc_key")
    # three rows per topic
    found = lookup_join(latent.select("doc_key", "document"), cut_lineage(nearest.select("doc_key", "topic", "rank")), "doc_key", "inner")
    shown = cut_lineage(
        found.groupBy("topic")
        .agg(F.sort_array(F.collect_list(F.struct("rank", "document"))).alias("_docs"))
        .select("topic", F.transform("_docs", lambda d: d["document"]).alias("Representative_Docs"))
    )
    members = lookup_join(assigned, labels.drop("size"), "topic", "inner").select(
        F.col("topic").cast("string").alias("topic"),
        F.lit(1.0).alias("topic_prob"),
        "topic_name",
        "document",
        F.lit(source).alias("source"),
        F.col("id").alias(key),
        *dated,
    )
    summary = labels.join(shown, "topic", "left").select(
        F.col("topic").cast("string").alias("Topic"),
        F.col("size").alias("Count"),
        F.col("topic_name").alias("Name"),
        "Representative_Docs",
        F.lit(source).alias("source"),
    )
    return Topics(members, summary)


def _united(built: list[Topics]) -> Topics:
    if not built:
        raise ValueError("no source has any row")
    members, summary = (reduce(DataFrame.unionByName, [getattr(t, part) for t in built]) for part in ("members", "summary"))
    return Topics(members, summary.orderBy(F.col("Count").desc(), "source", "Topic"))


def build_topics(sources: dict[str, DataFrame], key: str, text: str, settings: Settings) -> Topics:
    """Topics of each source on its own, united; the summary is ordered by size."""
    given = {name: df for name, df in sources.items() if not df.isEmpty()}
    if not given:
        return _united([])
    with shuffles_dropped(next(iter(given.values())).sparkSession):
        # the terms of all sources first: counting them takes the most room while it lasts, and leaves nothing
        fitted = {name: _fitted_terms(df, key, text, settings) for name, df in given.items()}
        return _united([_source_topics(*found, name, key, settings) for name, found in fitted.items()])


def _center_distances(centers: np.ndarray) -> Column:
    norms = (centers**2).sum(axis=1)

    def measure(vectors: pd.Series) -> pd.Series:
        x = np.vstack(vectors.to_numpy()).astype("float64")
        squared = (x**2).sum(axis=1)[:, None] - 2.0 * x @ centers.T + norms
        return pd.Series(list(np.sqrt(np.maximum(squared, 0.0))))

    return F.pandas_udf(measure, "array<double>")


def _named_topics(assigned: DataFrame, source: str, text: str, key: str, settings: Settings) -> Topics:
    """Members and summary of rows with ``topic`` (-1: outlier) and ``topic_prob``; a name is the seven most distinctive words."""
    termed = document_terms(assigned.filter("topic >= 0").select("topic", text), text, settings.stop_words, bigrams=False)
    words = class_tfidf(termed, "topic").groupBy("topic").agg(F.sort_array(F.collect_list(F.struct("rank", "term"))).alias("_w"))
    names = cut_lineage(words.select("topic", F.array_join(F.transform("_w", lambda w: w["term"]), ", ").alias("_name")))
    name = F.when(F.col("topic") < 0, F.lit("outlier")).otherwise(F.coalesce("_name", F.col("topic").cast("string")))
    members = lookup_join(assigned, names, "topic").select(
        key, "topic", F.round(F.when(F.col("topic") < 0, F.lit(0.0)).otherwise(F.col("topic_prob")), 6).alias("topic_prob"),
        name.alias("topic_name"), F.col(text).alias("document"), F.lit(source).alias("source"),
    )
    summary = members.groupBy("topic", "topic_name", "source").agg(F.count("*").alias("Count")).select(
        F.col("topic").alias("Topic"), "Count", F.col("topic_name").alias("Name"), "source"
    )
    return Topics(members, summary)


def embedding_topics(
    df: DataFrame,
    source: str,
    vec: str,
    text: str,
    key: str,
    k: int,
    settings: Settings,
    min_size: int = 50,
    outlier_quantile: float = 0.95,
    seed: int = 42,
) -> Topics:
    """Topics of one source from given embeddings.

    Rows far from their centre, and clusters under ``min_size``, become the outlier topic -1. A topic is named by its
    seven most distinctive words; a row's probability is the softmax of its negative centre distances. How far is too far
    comes from a quantile sketch that is off by a ten-thousandth of the cluster's rows at most.
    """
    if k < 2:
        raise ValueError("k is at least 2")
    staged = cut_lineage(df.withColumn("_order", F.xxhash64(key, text)))
    placed, centers = fit_clusters(
        laid_out(staged, "_order", key, text), k, vec, seed, out="_cluster", starts=settings.topic_starts
    )
    measured = placed.withColumn("_distances", _center_distances(centers)(F.col(vec).cast("array<double>"))).withColumn(
        "_own", F.element_at("_distances", F.col("_cluster") + 1)
    )
    nearest = F.array_min("_distances")
    total = F.aggregate("_distances", F.lit(0.0), lambda s, d: s + F.exp(nearest - d))
    measured = cut_lineage(measured.withColumn("topic_prob", F.exp(nearest - F.col("_own")) / total).drop("_distances", "_order"))
    limits = measured.groupBy("_cluster").agg(
        F.percentile_approx("_own", outlier_quantile, 10_000).alias("_limit"), F.count("*").alias("_size")
    )
    outlier = (F.col("_own") > F.col("_limit")) | (F.col("_size") < min_size)
    assigned = lookup_join(measured, cut_lineage(limits), "_cluster", "inner").withColumn(
        "topic", F.when(outlier, F.lit(-1)).otherwise(F.col("_cluster"))
    )
    return _named_topics(assigned, source, text, key, settings)


def density_topics(
    df: DataFrame, source: str, vec: str, text: str, key: str, settings: Settings, min_size: int = 50, **options
) -> Topics:
    """Topics of one source from the places where its embeddings lie densely; all other rows are the outlier topic -1.

    The number of topics follows from the data (``density_clusters``, which takes ``options``); they are named as in
    ``embedding_topics``. A row's probability is its strength in its cluster.
    """
    assigned = density_clusters(df.select(key, text, vec), vec, min_size=min_size, **options)
    return _named_topics(cut_lineage(assigned), source, text, key, settings)


def build_density_topics(sources: dict[str, DataFrame], vec: str, text: str, key: str, settings: Settings, **options) -> Topics:
    """Density topics of each source on its own, united."""
    return _united([density_topics(df, name, vec, text, key, settings, **options) for name, df in sources.items() if not df.isEmpty()])


def build_embedding_topics(sources: dict[str, DataFrame], vec: str, text: str, key: str, k: int, settings: Settings, **options) -> Topics:
    """Embedding topics of each source on its own, united."""
    built = [embedding_topics(df, name, vec, text, key, k, settings, **options) for name, df in sources.items() if not df.isEmpty()]
    return _united(built)
