import pytest

import __spark_entry__ as contract
from tools.check import compare

SF = "/root/testdata/sf0.001"
ROWS_ONLY = {"topics", "topics_summary", "embedding_topics", "virality_scores", "density_members"}
#: This library's own queries; those of the optional folder have their own tests.
OWN = {n for n, f in contract.queries().items() if not f.__module__.startswith(("audience_engine.llm", "corpus_pipeline"))}
CHECKED = sorted(OWN & set(contract.oracle_sql()))
#: Nothing is this rare in so small a table.
MAY_BE_EMPTY = set()


def plan(spark, name):
    return contract.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def test_contract():
    assert OWN - set(contract.oracle_sql()) == ROWS_ONLY
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() == 3


@pytest.mark.parametrize("name", CHECKED)
def test_query_agrees_with_sql(spark, name):
    agrees, note = compare(spark, SF, name)
    assert agrees or (name in MAY_BE_EMPTY and note.startswith("0 rows")), note


CAPS = ["videos_capped", "posts_capped", "comments_capped", "category_cap", "first_seen", "deduped_comments", "ab_winner_by_topic"]


@pytest.mark.parametrize("name", CAPS)
def test_caps_cut_before_the_shuffle(spark, name):
    assert "WindowGroupLimit" in plan(spark, name)


#: Their plans are those of the tables that they have written.
WRITERS = {"density_topics", "topic_members", "embedding_members", "virality_fit"}


@pytest.mark.parametrize("name", [n for n in CHECKED if n not in WRITERS])
def test_no_row_python_and_no_products(spark, name):
    text = plan(spark, name)
    assert "BatchEvalPython" not in text and "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    if name != "generated_drafts":
        assert "Python" not in text and "MapInPandas" not in text


@pytest.mark.parametrize("name", ["comment_metrics", "weekly_rollup", "edited_weekly_rollup", "lexicon_sentiment"])
def test_sentiment_is_scored_in_one_scan(spark, name):
    text = plan(spark, name).split("Subquery")[0]
    assert "Join" not in text
    assert "hashpartitioning" not in text


@pytest.mark.parametrize("name", ["clean_comments", "hashtags", "rule_scores", "english_documents", "variants", "split_caption"])
def test_row_functions_do_not_shuffle_by_key(spark, name):
    assert "Exchange hash" not in plan(spark, name)


def test_only_needed_columns_are_read(spark):
    text = plan(spark, "order_weeks")
    assert "ReadSchema: struct<o_orderdate:timestamp_ntz>" in text
    assert "ReadSchema: struct<doc_id:bigint>" in plan(spark, "rolling_window")
