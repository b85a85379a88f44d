"""Crawl states read in splits, the packed page store, and rounds that read only what is left."""

import json
import random

import pytest
from pyspark.sql import functions as F

from roamdex.functions import urls
from roamdex.operators import enrich, phrase_join
from roamdex.sources import readers, writers
from roamdex.streaming.rounds import CrawlState, crawl

HOST = "p.org"


def plain(state):
    queue = [(rank, u) for rank, key in enumerate(("priority", "other")) for u in state.get(key, [])]
    return queue, sorted(state.get("visited", {}))


def read(spark, path):
    queue, visited = readers.read_state_json(spark, path)
    rows = sorted(queue.collect(), key=lambda r: (r["queue_rank"], r["seq"]))
    return [(r["queue_rank"], r["url"]) for r in rows], sorted(r["url"] for r in visited.collect())


STATES = [
    {"priority": ["https://a/1", "https://a/2"], "other": ["https://b/1"], "visited": {"https://c/1": True, "https://c/2": False}},
    {"priority": [], "other": [], "visited": {}},
    {"priority": ["x"], "priority_hash": {"x": True, "y": True}, "other": [], "other_hash": {}, "visited": {"é": True}},
    {"visited": {"v": True}, "other": ["o1", "o2"], "priority": ["p"]},
    {"priority": ['q"uote', "back\\slash", "comma, blank", "tab\t", "日本"], "other": ['": [', '", "', "a]", "{b}"], "visited": {'v": {': True}},
    {"priority": ["ends with, ", ', "'], "other": [""], "visited": {"": True}},
]


LAYOUTS = [{"indent": 1}, {"separators": (",", ":")}, {"ensure_ascii": False}]


@pytest.mark.parametrize("k, layout", [*((k, {}) for k in range(len(STATES))), *((4, x) for x in LAYOUTS)])
def test_states_of_any_layout(spark, tmp_path, k, layout):
    (tmp_path / "state.json").write_text(json.dumps(STATES[k], **layout))
    assert read(spark, str(tmp_path / "state.json")) == plain(STATES[k])


def test_a_state_is_read_in_splits(spark, tmp_path):
    rng = random.Random(1)
    links = [f"https://{rng.choice('ab')}.org/{i}/" + "x," * rng.randrange(30) for i in range(5000)]
    state = {"priority": links[:2000] + links[:5], "other": links[2000:3500], "visited": {u: True for u in links[3500:]}}
    (tmp_path / "state.json").write_text(json.dumps(state))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        queue, visited = readers.read_state_json(spark, str(tmp_path / "state.json"))
        assert queue.rdd.getNumPartitions() > 5
        assert read(spark, str(tmp_path / "state.json")) == plain(state)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_a_written_state_is_one_object(spark, tmp_path):
    queue = spark.createDataFrame([(0, "b", 1), (0, "a", 0), (1, 'q"', 5)], "queue_rank int, url string, seq bigint")
    visited = spark.createDataFrame([("v1",), ("v, 2",)], "url string")
    writers.write_state_json(queue, visited, str(tmp_path / "state"))
    (file,) = (tmp_path / "state").glob("part-*")
    assert json.loads(file.read_text()) == {"priority": ["a", "b"], "other": ['q"'], "visited": {"v1": True, "v, 2": True}}
    assert read(spark, str(tmp_path / "state")) == ([(0, "a"), (0, "b"), (1, 'q"')], ["v, 2", "v1"])


def test_packed_pages_are_found_by_key(spark, tmp_path):
    pages = spark.range(50).select(F.format_string("https://h/%d\nbody %d\nend", "id", "id").alias("raw"))
    writers.write_page_files(pages, str(tmp_path / "files"))
    assert len(list((tmp_path / "files").glob("part-*"))) == 50
    writers.pack_pages(spark, str(tmp_path / "files"), str(tmp_path / "store"))
    key = spark.range(1).select(urls.url_key(F.lit("https://h/7"))).first()[0]
    found = readers.find_pages(spark, str(tmp_path / "store"), [key, "no such key"])
    assert [(r["link"], r["raw"].strip()) for r in found.collect()] == [("https://h/7", "https://h/7\nbody 7\nend")]
    assert "PushedFilters: [In(url_key" in found._jdf.queryExecution().executedPlan().toString()
    keys = [r["url_key"] for r in readers.read_pages(spark, str(tmp_path / "store")).collect()]
    assert len(set(keys)) == 50


def test_rounds_read_what_is_left(spark, tmp_path):
    """A chain of pages: by the sixth round only the last rounds' folders are read, and known URLs are not shuffled."""
    names = [f"https://{HOST}/{i}" for i in range(40)]
    edges = [(a, b, 1, k) for i, a in enumerate(names) for k, b in enumerate(names[i : i + 4])]
    edges = spark.createDataFrame(edges, "src string, dst string, kind int, pos int")
    seeds = spark.createDataFrame([(u, i) for i, u in enumerate(names[:3])], "url string, seq bigint")
    state = crawl(spark, str(tmp_path / "c"), seeds, edges, 3, HOST, max_rounds=6)
    last = state.last_round()
    assert last == 6
    first = min(c["at_round"] for c in state.cursors(last))
    files = state.waiting(last).inputFiles()
    assert first >= 4 and all(int(f.split("round=")[1].split("/")[0]) >= first for f in files)
    taken = {r["url"] for r in state.visited(last).collect()}
    queued = {r["url"] for r in state.queued_ever(last).collect()}
    assert {r["url"] for r in state.waiting(last).collect()} == queued - taken
    known = state._known(last)
    assert {r["url"] for r in known.collect()} == queued
    new = spark.createDataFrame([("x",), (names[0],)], "url string").groupBy("url").count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = new.join(known, "url", "left_anti")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # One for the new links; the bucketed table has none.
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan


def test_a_round_left_out_of_the_known_urls_is_added(spark, tmp_path):
    names = [f"https://{HOST}/{i}" for i in range(12)]
    edges = spark.createDataFrame([(a, b, 1, 0) for a, b in zip(names, names[1:])], "src string, dst string, kind int, pos int")
    seeds = spark.createDataFrame([(names[0], 0)], "url string, seq bigint")
    path = str(tmp_path / "c")
    crawl(spark, path, seeds, edges, 2, HOST, max_rounds=3)
    # Another session knows nothing of the table but its folder.
    spark.sql(f"drop table if exists {CrawlState(spark, path).known_name()}")
    state = crawl(spark, path, seeds, edges, 2, HOST)
    assert sorted(r["url"] for r in state.visited(state.last_round()).collect()) == sorted(names)


def test_phrases_meet_on_their_rarest_token(spark):
    titles = [("d1", "the old town of the bay"), ("d2", "the bay"), ("d3", "old bay the the"), ("d4", ""), ("d5", "bay the")]
    docs = spark.createDataFrame(titles, "doc_id string, title string")
    boxes = spark.createDataFrame([(t,) for t in ("the bay", "The", "old town of", "the the", "no such", "bay town", "!!", "the BAY")], "title string")
    got = sorted(map(tuple, phrase_join.title_phrase_join(boxes, docs).select("title", "doc_id").collect()))
    expected = [(t, d) for t in ("the bay", "The", "old town of", "the the", "the BAY") for d, text in titles if f" {t.lower()} " in f" {text} "]
    assert got == sorted(expected)
    assert enrich.matches_of(docs.limit(0), boxes).count() == 0
