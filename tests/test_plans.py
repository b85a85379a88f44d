"""What the plans must not contain, and what must reach the scan."""

import io
import re
from contextlib import redirect_stdout

import pytest

from roamdex.operators import search as se
from roamdex.operators.postings import FieldSpec, Index
from roamdex.plans import jobs
from roamdex.plans.queries import QUERIES, crumbed_pages
from roamdex.sources import readers

SF_DIR = "/root/testdata/sf0.001"
# Each looks at one table and needs no join against a table of unknown size.
NARROW = ["page_documents", "page_sections", "page_remainder", "link_graph", "infobox_pairs", "infobox_map", "url_keys"]


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_the_next_urls_are_not_ordered_in_one_task(spark):
    text = plan(QUERIES["frontier_next"](spark, SF_DIR))
    assert "TakeOrderedAndProject" not in text
    # The one window over all rows is over the counts of ranges.
    before_single = text[text.index("Exchange\nInput") if "Exchange\nInput" in text else 0 :]
    assert before_single.count("SinglePartition") <= 1


@pytest.mark.parametrize("name", QUERIES)
def test_no_python_workers_and_no_products(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|PythonUDF|ArrowEval|BatchEval|MapInPandas", text)


@pytest.mark.parametrize("name", NARROW)
def test_page_work_does_not_shuffle(spark, name):
    assert "Exchange" not in plan(QUERIES[name](spark, SF_DIR))


def test_postings_are_counted_without_a_shuffle(spark):
    assert "Exchange" not in plan(QUERIES["postings"](spark, SF_DIR))


def test_stored_index_search_reaches_the_reader(spark, tmp_path):
    docs = spark.createDataFrame([("1", "old bay"), ("2", "new bay")], "doc_id string, title string")
    index = Index.build(docs, (FieldSpec("title", positions=True),)).stored(str(tmp_path))
    text = plan(se.top_hits(se.search(index, [se.Clause("bay")]), 3))
    pushed = re.findall(r"PushedFilters: (.*)", text)
    assert any("EqualTo(term,bay)" in p and "EqualTo(field,title)" in p for p in pushed)
    assert text.count("TakeOrderedAndProject") >= 1
    read = re.findall(r"ReadSchema: (.*)", text)
    assert all("positions" not in r for r in read)


def test_title_queries_read_two_columns(spark):
    scans = re.findall(r"ReadSchema: (.*)", plan(QUERIES["delete_by_id"](spark, SF_DIR)))
    assert "struct<doc_id:bigint,n_chars:bigint>" in scans


def test_jobs_end_to_end(spark, tmp_path):
    """Pages to collection, dump to infoboxes, enrichment, link table and a search over the result."""
    pages = crumbed_pages(spark, SF_DIR).selectExpr("md5(link) || '.txt' as url_key", "link", "raw")
    base = str(tmp_path / "base")
    jobs.build_collection(pages, base)
    names = [r.value for r in readers.read_lines(spark, f"{base}/gazetteer").collect()]
    assert "en" in names
    (tmp_path / "dump.xml").write_text(
        '<mediawiki><page><title>en</title><revision><text bytes="1">\n|capital = Heer\n</text></revision></page>'
        '<page><title>zz-not</title><revision><text bytes="1">\n|capital = X\n</text></revision></page></mediawiki>'
    )
    jobs.extract_infoboxes(spark, str(tmp_path / "dump.xml"), f"{base}/gazetteer", str(tmp_path / "boxes"))
    boxes = readers.read_infoboxes(spark, str(tmp_path / "boxes")).collect()
    assert [(b.title, b.mod_key, b.mod_val) for b in boxes] == [("en", ["capital"], ["Heer"])]
    jobs.enrich_collection(spark, base, str(tmp_path / "boxes"), str(tmp_path / "rich"))
    before = spark.read.parquet(f"{base}/documents")
    after = spark.read.parquet(str(tmp_path / "rich" / "documents"))
    matched = [r.doc_id for r in before.collect() if "en" in re.split(r"\W+", r.title.lower())]
    assert after.count() == before.count()
    assert sorted(r.doc_id for r in after.filter("doc_id like '\\\\_%'").collect()) == sorted("_" + d for d in matched)
    index = Index.read(spark, str(tmp_path / "rich" / "index"))
    assert se.search(index, [se.Clause("heer", "capital")]).count() == len(matched)
    jobs.link_table(pages, str(tmp_path / "links"))
    assert spark.read.parquet(str(tmp_path / "links")).count() > 0
    jobs.count_headings(pages, str(tmp_path / "headings"))
