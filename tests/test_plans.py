"""Physical plans: what moves, what is read, what is broadcast."""

import re

import pytest
from conftest import SMALL

from docloom.functions.text import normalize_heading
from docloom.operators import chunking, collection, documents, outline
from docloom.plans import queries, views
from docloom.shared import write_buckets, write_stage


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return re.findall(r"Exchange (hashpartitioning\([^)]*\)|\w+)", re.sub(r"#\d+L?", "", plan(df)))


@pytest.fixture(scope="module")
def md_table(spark):
    return write_stage(views.md_docs(spark, SMALL), "md")


@pytest.fixture
def no_auto_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# knn_single asks for its query vector first, the rest builds its plan lazily
LAZY = sorted(set(queries.queries()))


@pytest.mark.parametrize("name", LAZY)
def test_no_query_multiplies_rows(spark, no_auto_broadcast, name):
    text = plan(queries.queries()[name](spark, SMALL))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in text


def test_parsing_and_flagging_move_nothing(md_table):
    assert exchanges(outline.flag_boilerplate(outline.parse_headings(md_table))) == []


def test_one_exchange_from_markdown_to_entries_with_background(md_table):
    sections = outline.markdown_to_sections(md_table)
    rows = chunking.with_budget(chunking.entries_with_background(sections, 600), 600)
    assert exchanges(chunking.split_pieces(rows)) == ["hashpartitioning(source_file, 4)"]


def test_skip_and_hierarchy_reuse_the_documents_partitioning(spark):
    """Without the Python scorer in between there is no exchange behind the assembly."""
    docs = views.md_docs(spark, SMALL)
    flagged = outline.parse_headings(docs).withColumn("is_toc", normalize_heading("title") == "index")
    rows = outline.hierarchy(outline.sections(outline.skip_subtrees(flagged)))
    assert len(exchanges(rows)) == 1


def test_packing_moves_nothing(spark):
    docs = views.table(spark, SMALL, "documents").selectExpr("source as source_file", "text")
    assert exchanges(documents.pack_segments(docs)) == []


def test_numbering_sums_one_row_per_partition_in_one_task(spark, md_table):
    rows = outline.markdown_to_entries(md_table).selectExpr("*", "array(content) as pieces")
    numbered = chunking.number_entries(write_stage(rows, "pieces"))
    text = plan(numbered)
    single = [line for line in text.splitlines() if "SinglePartition" in line]
    assert len(single) == 1
    after = text[text.index("SinglePartition") :].splitlines()[1]
    assert "HashAggregate(keys=[part" in after


def test_numbering_moves_one_row_per_file(spark, no_auto_broadcast, md_table):
    rows = outline.markdown_to_entries(md_table).selectExpr("*", "array(content) as pieces")
    staged = write_buckets(rows, "pieces", "source_file", "entry_pos")
    numbered = chunking.number_entries(staged)
    # the side with the starts; the pieces are read in their buckets
    assert exchanges(numbered).count("hashpartitioning(source_file, 4)") == 1
    assert "Bucketed: true" in plan(numbered)
    pieces_side = plan(numbered).split("SortMergeJoin")[1].split("Bucketed: true")[0]
    assert "Exchange" not in pieces_side


def test_columns_are_pruned(spark):
    text = plan(queries.existing_ids(spark, SMALL))
    assert re.findall(r"ReadSchema: struct<([^>]*)>", text) == ["doc_id:bigint"]
    text = plan(queries.collection_info(spark, SMALL))
    assert "text" not in " ".join(re.findall(r"ReadSchema: struct<([^>]*)>", text))


def test_anti_join_comes_before_the_embedding(spark):
    embed = collection.embedder(lambda texts: [[0.0]] * len(texts), 1)
    rows = views.incoming(spark, SMALL)
    text = plan(collection.insert_missing(rows, views.stored(spark, SMALL), embed))
    assert text.index("ArrowEvalPython") < text.index("LeftAnti")


def test_totals_are_partial_first(spark):
    text = plan(queries.token_rollup(spark, SMALL))
    assert "partial_sum" in text
