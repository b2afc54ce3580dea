import numpy as np

import corpus_pipeline
from audience_engine.llm import pieces


def test_stage_gives_alternatives_and_decodes(spark):
    rows = [(1, "the cat sat on the mat", "s", "en"), (2, None, "s", None), (3, "", None, "en"), (3, "", None, "en"), (None, "été 😀\n x▁y", "t", "fr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    got = corpus_pipeline.encode(spark, docs, "").collect()
    assert len(got) == len(rows) and all(r.round_trip for r in got)
    own = pieces.lattice(pieces.model_bytes())
    for r in got:
        text = next(t for d, t, s, _ in rows if (d, s) == (r.doc_id, r.source))
        if text:
            ((ids, score, ways),) = own.encode([text])
            assert r.ids == ids.tolist() and np.isclose(r.score, score) and r.other_scores and own.decode(r.ids).decode() == text
            assert np.allclose(r.other_scores, [s for s, _ in ways]) and r.other_scores[0] <= r.score
