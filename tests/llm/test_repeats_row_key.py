import zlib
from hashlib import md5

from audience_engine.llm import repeats


def test_texts_of_one_id_with_equal_crc(spark):
    passage = " ".join(f"p{i}" for i in range(40))
    other = " ".join(f"q{i}" for i in range(60))
    tail = lambda mark, i: f" {mark}{md5(str(i).encode()).hexdigest()}"  # the end of a text, unlike any other's
    start, ends = zlib.crc32(passage.encode()), {}
    for i in range(200_000):
        ends[zlib.crc32(tail("x", i).encode(), start)] = i
    start = zlib.crc32(other.encode())
    found = ((i, ends.get(zlib.crc32(tail("y", i).encode(), start))) for i in range(3_000_000))
    j, i = next(pair for pair in found if pair[1] is not None)
    first, second = passage + tail("x", i), other + tail("y", j)
    assert zlib.crc32(first.encode()) == zlib.crc32(second.encode())
    for doc_id in (1, None):
        docs = spark.createDataFrame([(doc_id, first), (doc_id, second), (2, passage)], "doc_id long, text string")
        got = sorted((r.n_words, r.n_removed, r.text) for r in repeats.without_repeats(docs).collect())
        assert got == [(40, 40, ""), (41, 40, first.split()[-1]), (61, 0, second)]
