import json

import pytest
from pyspark.sql import functions as F

from roamdex.operators import infobox as ib
from roamdex.sources import readers, writers

DUMP = """<mediawiki><siteinfo/>
<page><title>Côte</title><ns>0</ns><revision><id>1</id><text bytes="9" xml:space="preserve">
|lead = x
{{Infobox country
|capital = [[Bratislava]]
|area km2=49,035 &lt;ref&gt;a=b&lt;/ref&gt;
|empty=
|x|y = z
}}</text></revision></page>
<page><title>Other</title><revision><text bytes="1">no box</text></revision></page>
<page><title>Unnamed</title><revision><text bytes="1">
|a=b</text></revision></page>
</mediawiki>"""


def test_dump_to_infobox_files(spark, tmp_path):
    (tmp_path / "dump.xml").write_text(DUMP, encoding="utf-8")
    (tmp_path / "gaz.txt").write_text("Côte\n Other \n\n", encoding="utf-8")
    dump = readers.read_dump(spark, str(tmp_path / "dump.xml"))
    names = readers.read_lines(spark, str(tmp_path / "gaz.txt"))
    writers.write_infoboxes(ib.gazetteer_infoboxes(dump, names), str(tmp_path / "out"))
    (tmp_path / "out" / "notes.txt").write_text("not json")
    rows = readers.read_infoboxes(spark, str(tmp_path / "out")).collect()
    assert [r.title for r in rows] == ["Côte"]
    assert rows[0].mod_key == ["lead", "capital", "area km2", "empty", "x y"]
    assert rows[0].mod_val == ["x", "Bratislava", "49,035 ab", "", "z"]


def test_map_keeps_the_last_of_equal_keys(spark):
    rows = [("t", ["a", "b", "a", "c"], ["1", "2", "3", "4", "5"]), ("e", [], [])]
    kinds = "title string, mod_key array<string>, mod_val array<string>"
    df = spark.createDataFrame(rows, kinds)
    assert {r.title: r.kv for r in ib.with_map(df).collect()} == {"t": {"a": "3", "b": "2", "c": "4"}, "e": {}}
    with pytest.raises(Exception, match="fewer values than keys in the infobox of t"):
        ib.with_map(spark.createDataFrame([("t", ["a", "b"], ["1"])], kinds)).collect()


def test_missing_folder_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.read_infoboxes(spark, str(tmp_path / "none")).count()


def test_name_list(spark, tmp_path):
    path = tmp_path / "names.txt"
    path.write_text("'Object1'\n'Object2'\n('Get in', 1024)\n")
    assert readers.read_names(spark, str(path)) == ["Object1", "Object2", "Get in"]
    path.write_text("")
    assert readers.read_names(spark, str(path)) == []


def test_heading_lines_there_and_back(spark, tmp_path):
    names = ["plain", "a\nb", "it's", 'say "x"', """both ' and \"""", "back\\slash", "tab\there"]
    counts = spark.createDataFrame([(n, i + 1) for i, n in enumerate(names)], "heading string, n bigint")
    lines = [r.value for r in writers.heading_lines(counts).collect()]
    assert lines == [repr((n, i + 1)) for i, n in reversed(list(enumerate(names)))]
    (tmp_path / "names.txt").write_text("\n".join(lines))
    assert readers.read_names(spark, str(tmp_path / "names.txt")) == names[::-1]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.read_names(spark, str(tmp_path / "none.txt"))


def test_page_files(spark, tmp_path):
    folder = tmp_path / "data"
    folder.mkdir()
    (folder / "k1.txt").write_bytes("https://a.b/c\r\n<title>é</title>\rx".encode())
    (folder / "k2.txt").write_bytes(b"https://a.b/d\n")
    pages = readers.read_page_files(spark, str(folder)).orderBy("url_key")
    assert [tuple(r) for r in pages.collect()] == [
        ("k1.txt", "https://a.b/c", "https://a.b/c\n<title>é</title>\nx"),
        ("k2.txt", "https://a.b/d", "https://a.b/d\n"),
    ]
    assert sorted(r.url_key for r in readers.listed_keys(spark, str(folder)).collect()) == ["k1.txt", "k2.txt"]
    writers.write_pages(pages, str(tmp_path / "pages"))
    assert readers.fetched_keys(readers.read_pages(spark, str(tmp_path / "pages"))).count() == 2


def test_page_files_are_one_file_a_page(spark, tmp_path):
    """A local folder gets the pages and Spark's mark that all are there: no checksum file beside each."""
    raw = [f"https://a.b/{i}\n<p>é</p>\n" for i in range(5)]
    writers.write_page_files(spark.createDataFrame([(r,) for r in raw], "raw string").coalesce(1), str(tmp_path / "files"))
    names = [f.name for f in (tmp_path / "files").iterdir() if f.name != "_SUCCESS"]
    assert len(names) == 5 and not [n for n in names if n.endswith(".crc")]
    assert sorted(r.raw for r in readers.read_page_files(spark, str(tmp_path / "files")).collect()) == [r + "\n" for r in raw]


def test_pack_pages_opens_files_once(spark, tmp_path, monkeypatch):
    """The pass that ranges are drawn from does not open the files again, and nothing stays behind."""
    folder = tmp_path / "files"
    folder.mkdir()
    for i in range(40):
        (folder / f"k{i}.txt").write_text(f"https://a.b/{i}\nx")
    opened, read = spark.sparkContext.accumulator(0), readers.read_page_files

    def counted(*args):
        pages = read(*args)

        def run(batches):
            for batch in batches:
                opened.add(batch.num_rows)
                yield batch

        return pages.mapInArrow(run, pages.schema)

    monkeypatch.setattr(readers, "read_page_files", counted)
    writers.pack_pages(spark, str(folder), str(tmp_path / "store"))
    assert sorted(r.link for r in readers.read_pages(spark, str(tmp_path / "store")).collect()) == sorted(f"https://a.b/{i}" for i in range(40))
    assert opened.value == 40
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


def test_keywords_and_seeds(spark, tmp_path):
    path = tmp_path / "k.txt"
    path.write_text("Tea\n Togo \nTea\n", encoding="utf-8")
    assert sorted(r.keyword for r in readers.read_keywords(spark, str(path)).collect()) == ["Tea", "Togo"]
    seeds = readers.seed_urls(spark, str(path), "https://x.org/wiki/").orderBy("seq").collect()
    assert [(r.url, r.seq) for r in seeds] == [
        ("https://x.org/wiki/Tea", 0), ("https://x.org/wiki/Togo", 1), ("https://x.org/wiki/Tea", 2),
    ]


def test_text_sinks(spark, tmp_path):
    gaz = spark.createDataFrame([("key1",), ("key2",)], "value string")
    writers.write_gazetteer(gaz, str(tmp_path / "g"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "g")).collect()) == ["key1", "key2"]
    writers.write_gazetteer(gaz.limit(0), str(tmp_path / "g0"))
    assert spark.read.text(str(tmp_path / "g0")).count() == 0
    counts = spark.createDataFrame([("Do", 2), ("See", 5)], "heading string, n bigint")
    writers.write_headings(counts, str(tmp_path / "h"))
    assert [r.value for r in spark.read.text(str(tmp_path / "h")).coalesce(1).collect()] == ["('See', 5)", "('Do', 2)"]


def test_crawl_state(spark, tmp_path):
    state = {
        "mine": ["https://m/1", "https://m/2", "https://m/1"], "mine_hash": {}, "other": ["https://o/1"],
        "other_hash": {}, "visited": {"https://v/1": True},
    }
    (tmp_path / "s.json").write_text(json.dumps(state), encoding="utf-8")
    queue, visited = readers.read_state_json(spark, str(tmp_path / "s.json"), "mine")
    assert sorted(map(tuple, queue.select("queue_rank", "seq", "url").collect())) == [
        (0, 0, "https://m/1"), (0, 1, "https://m/2"), (0, 2, "https://m/1"), (1, 0, "https://o/1"),
    ]
    assert [r.url for r in visited.collect()] == ["https://v/1"]
    (tmp_path / "seeds.txt").write_text("A\n")
    args = (spark, str(tmp_path / "state"), str(tmp_path / "seeds.txt"), "https://m/", "m/")
    frontier, seen = readers.state_or_seeds(*args)
    assert [r.url for r in frontier.collect()] == ["https://m/A"] and seen.count() == 0
    writers.write_state(frontier.withColumn("url", F.lit("https://m/kept")), visited, str(tmp_path / "state"))
    frontier, seen = readers.state_or_seeds(*args)
    assert [r.url for r in frontier.collect()] == ["https://m/kept"] and seen.count() == 1
