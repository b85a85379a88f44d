import json
import random
from collections import deque
from urllib.parse import quote

from pyspark.sql import functions as F

from roamdex.functions import urls
from roamdex.operators import frontier as fr
from roamdex.operators import links as li
from roamdex.plans import jobs
from roamdex.sources import readers
from roamdex.streaming.rounds import CrawlState, crawl

HOST = "guide.org"


def web(seed=3, n=40):
    """A random web: URL to the list of links on its page; some pages cannot be fetched."""
    rng = random.Random(seed)
    names = [f"https://{HOST if i % 3 else 'x.net'}/p {i}" for i in range(n)]
    return {u: [rng.choice(names) for _ in range(rng.randrange(6))] for u in names if rng.random() < 0.8}, names


def crawl_in_rounds(seeds, pages, n, rounds):
    """The queue rules one URL at a time, in rounds of n."""
    first, second, visited, queued = deque(), deque(), [], set()

    def add(u):
        if u not in queued:
            queued.add(u)
            (first if HOST in u else second).append(u)

    for u in seeds:
        add(u)
    for _ in range(rounds):
        taken = [(first or second).popleft() for _ in range(min(n, len(first) + len(second)))]
        visited += taken
        for u in taken:
            for v in pages.get(u, []):
                add(v)
    return list(first), list(second), visited


def edge_table(spark, pages):
    rows = [(quote(u, "<>=/:!"), v, 0, i) for u, vs in pages.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, "src string, dst string, kind int, pos int")


def in_order(frontier):
    rows = frontier.orderBy(*fr.ORDER).collect()
    return [r.url for r in rows if r.queue_rank == 0], [r.url for r in rows if r.queue_rank == 1]


def test_steps_follow_the_queue_rules(spark):
    pages, names = web()
    edges = edge_table(spark, pages)
    seeds = spark.createDataFrame([(u, i) for i, u in enumerate(names[:4])], "url string, seq bigint")
    frontier, visited = fr.init_frontier(seeds, HOST), spark.createDataFrame([], "url string")
    for k in (1, 2):
        frontier, visited = fr.frontier_step(frontier, visited, fr.take(frontier, 3), edges, HOST, k)
    first, second, seen = crawl_in_rounds(names[:4], pages, 3, 2)
    assert in_order(frontier) == (first, second)
    assert sorted(r.url for r in visited.collect()) == sorted(seen)


def test_rounds_are_durable(spark, tmp_path):
    pages, names = web(seed=5)
    edges = edge_table(spark, pages)
    seeds = spark.createDataFrame([(u, i) for i, u in enumerate(names[:4])], "url string, seq bigint")
    path = str(tmp_path / "state")
    crawl(spark, path, seeds, edges, 5, HOST, max_rounds=2)
    # A round that died after its first table is done again.
    half = CrawlState(spark, path)
    fr.numbered(fr.next_urls(half.waiting(2), 1)).write.parquet(f"{path}/visited/round=3")
    assert half.last_round() == 2
    state = crawl(spark, path, seeds, edges, 5, HOST, max_rounds=1)
    first, second, seen = crawl_in_rounds(names[:4], pages, 5, 3)
    last = state.last_round()
    assert in_order(state.waiting(last)) == (first, second)
    assert sorted(r.url for r in state.visited(last).collect()) == sorted(seen)
    state = crawl(spark, path, seeds, edges, 50, HOST)
    assert state.waiting(state.last_round()).isEmpty()
    _, _, seen = crawl_in_rounds(names[:4], pages, 50, 20)
    assert sorted(r.url for r in state.visited(state.last_round()).collect()) == sorted(seen)


def test_turns_over_many_rows(spark):
    """More turns than any range holds, with equal places, two queues and several rounds."""
    rng = random.Random(2)
    rows = [(f"u{i}", rng.randrange(2), rng.randrange(3), rng.randrange(400)) for i in range(3000)]
    frontier = spark.createDataFrame(rows, "url string, queue_rank int, round int, seq bigint")
    order = [r[0] for r in sorted(rows, key=lambda r: (r[1], r[2], r[3], r[0]))]
    for n in (1, 1700, 5000):
        got = {r.turn: r.url for r in fr.numbered(fr.next_urls(frontier, n)).collect()}
        assert got == {k + 1: u for k, u in enumerate(order[:n])}


def test_a_saved_state_goes_on(spark, tmp_path):
    pages, names = web(seed=7)
    saved = {"priority": [u for u in names[:6] if HOST in u] * 2, "other": [u for u in names[:6] if HOST not in u], "visited": {names[0]: True, names[9]: True}}
    (tmp_path / "state.json").write_text(json.dumps(saved))
    frontier, seen = readers.state_or_seeds(spark, str(tmp_path / "state.json"), "none", "", HOST)
    assert sorted(r.url for r in frontier.collect()) == sorted(set(names[1:6]))
    state = CrawlState(spark, str(tmp_path / "crawl"))
    state.resume(frontier, seen)
    while state.run_round(edge_table(spark, pages), 7, HOST):
        pass
    last = state.last_round()
    visited = [r.url for r in state.visited(last).collect()]
    reach, todo = {names[0], names[9]}, list(names[1:6])
    while todo:
        u = todo.pop()
        if u not in reach:
            reach.add(u)
            todo += pages.get(u, [])
    assert sorted(visited) == sorted(reach)
    jobs.dedup_state(spark, str(tmp_path / "state.json"), str(tmp_path / "clean"))
    assert readers.read_state(spark, str(tmp_path / "clean"))[0].count() == 5
    (tmp_path / "files").mkdir()
    key = spark.range(1).select(urls.url_key(urls.quote(F.lit(names[2])))).first()[0]
    (tmp_path / "files" / key).write_text("x")
    jobs.reconcile_state(spark, str(tmp_path / "state.json"), str(tmp_path / "files"), str(tmp_path / "known"))
    stay, known = readers.read_state(spark, str(tmp_path / "known"))
    assert quote(names[2], "<>=/:!") in {r.url for r in known.collect()} and stay.where("url like '%p%202'").count() == 0


def test_page_links(spark):
    rows = [
        ("https://a.b/x", 'https://a.b/x\n<a href="/r1"> https://c.d/e <a href="/i.png"> https://c.d/f.pdf'),
        ("http://a.b/x", 'http://a.b/x\n<a href="/r1"> https://c.d/e'),
        ("https://a.b/y", "https://a.b/y"),
    ]
    pages = spark.createDataFrame(rows, "link string, raw string")
    got = sorted(map(tuple, li.page_links(pages).collect()))
    assert got == [
        ("http://a.b/x", "https://c.d/e", 1, 0),
        ("https://a.b/x", "https://a.b/r1", 0, 0),
        ("https://a.b/x", "https://c.d/e", 1, 0),
    ]


def test_dedup_keeps_the_first_place(spark):
    rows = [(0, "a", 0), (0, "b", 1), (0, "a", 2), (1, "a", 0)]
    queue = spark.createDataFrame(rows, "queue_rank int, url string, seq bigint")
    assert sorted(map(tuple, fr.dedup_frontier(queue).collect())) == [(0, "a", 0), (0, "b", 1), (1, "a", 0)]


def test_reconcile(spark):
    rows = [(0, "https://a/x y", 0), (0, "https://a/z", 1), (1, "https://b/é", 0), (0, "https://a/z", 2)]
    queue = spark.createDataFrame(rows, "queue_rank int, url string, seq bigint")
    visited = spark.createDataFrame([("https://v/1",)], "url string")
    keys = spark.createDataFrame([("https://a/x y",), ("https://a/x y",)], "u string").select(
        urls.url_key(urls.quote(F.col("u"))).alias("url_key")
    )
    stay, seen = fr.reconcile(queue, visited, keys)
    assert sorted(map(tuple, stay.select("queue_rank", "url", "seq").collect())) == [
        (0, "https://a/z", 1), (1, "https://b/%C3%A9", 0),
    ]
    assert sorted(r.url for r in seen.collect()) == ["https://a/x%20y", "https://v/1"]
