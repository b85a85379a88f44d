"""Fingerprints, components, lines and vectors against brute force, and the defined cases."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from roamdex.llm import ann, components, near_vectors, simhash, substring


def groups(n, links):
    parent = list(range(n))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(60 + i, 61 + i) for i in range(20)]
    links += [(100, 100 + i) for i in range(30)]
    df = spark.createDataFrame([*links, *links[:5], (None, 3), (4, None), (7, 7)], "u bigint, v bigint")
    expected = groups(130, links)
    got = {r["node"]: r["component"] for r in components.components(df).collect()}
    assert got == {i: expected[i] for a, b in links if a != b for i in (a, b)}


def test_components_of_nothing(spark):
    assert components.components(spark.createDataFrame([], "u bigint, v bigint")).collect() == []


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_is_brute_force(spark, documents):
    rng = random.Random(5)
    base = [" ".join(rng.choice("abcdefghij") * rng.randrange(1, 4) for _ in range(rng.randrange(1, 60))) for _ in range(60)]
    texts = [None, "", " \t\n", "One", "ONE", "ÀB one", "a b", "x " * 70000]
    for t in base:
        texts += [t, t.upper(), t.replace(" ", "\n  ", 1), t + " tail"]
    rows = [(1000 - i, t, "s") for i, t in enumerate(texts)] + [(1000, None, "s"), (None, "One", "s"), (None, "lone null", "s")]
    docs = documents(rows).withColumn("fingerprint", F.lit(0)).withColumn("component_id", F.lit(0))
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    ids = [r[0] for r in rows if r[0] is not None]
    of = {i: plain_fingerprint(t) for i, t, _ in rows if i is not None}
    order = sorted(of)
    links = [(a, b) for a in range(len(order)) for b in range(a) if (of[order[a]] ^ of[order[b]]).bit_count() <= 3]
    root = groups(len(order), links)
    for r in got:
        if r["doc_id"] is not None:
            assert r["fingerprint"] == f"{of[r['doc_id']]:016x}"
            assert r["component_id"] == order[root[order.index(r["doc_id"])]]
    assert sorted(ids) == sorted(r["doc_id"] for r in got if r["doc_id"] is not None)
    assert None in {r["component_id"] for r in got if r["doc_id"] is None}


def test_anchor_search_is_exact(spark):
    """Random fingerprints with planted ones at 0 to 5 bits: every pair within 3 is found, and no other."""
    rng = random.Random(11)
    fps = set()
    for _ in range(150):
        x = rng.getrandbits(64)
        fps.add(x)
        for bits in range(1, 6):
            y = x
            for b in rng.sample(range(64), bits):
                y ^= 1 << b
            fps.add(y)
    fps = sorted(fps)
    signed = [x - 2**64 if x >= 2**63 else x for x in fps]
    df = spark.createDataFrame([([x], i) for i, x in enumerate(signed)], "fp array<bigint>, rep bigint")
    expected = {(b, a) for a in range(len(fps)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 3}
    assert {(r["u"], r["v"]) for r in simhash.class_links(df).collect()} == expected


def test_simhash_of_nothing(documents):
    assert simhash.near_duplicates(documents([])).collect() == []


def test_keep_one(documents):
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=6))
    texts = [" ".join(word() for _ in range(300)) for _ in range(30)]
    near = [t.upper() for t in texts[:5]] + [t.replace(" ", " \n") for t in texts[5:10]]
    rows = [(i, t, "s") for i, t in enumerate(texts)] + [(100 + i, t, "s") for i, t in enumerate(near)]
    rows += [(200, texts[0], "s"), (29, texts[29], "s"), (None, "null id", "s"), (300, None, "s"), (301, " ", "s")]
    docs = documents(rows).withColumn("n", F.lit(1)).withColumn("component_id", F.lit("clash"))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == [*range(30), 300]
    assert kept.where("doc_id is null").count() == 1
    assert simhash.keep_one(documents([])).collect() == []


def test_keep_one_of_bits(documents):
    """Which documents stay follows from plain fingerprints alone."""
    docs = documents([]).sparkSession.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    ids, fps = [r[0] for r in rows], np.array([plain_fingerprint(r[1]) for r in rows], np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3
    order = np.argsort(ids)
    root = groups(len(ids), [(int(a), int(b)) for a, b in zip(*np.nonzero(near[np.ix_(order, order)])) if a > b])
    expected = {ids[order[k]] for k in set(root)}
    assert {r["doc_id"] for r in simhash.keep_one(docs).collect()} == expected


def plain_units(text):
    """Units by a scan over the characters, without the patterns."""
    out, at = [], 0
    space = " \t\x0b\x0c\r"
    for i, ch in enumerate(text):
        ended = ch in space and text[at:i].rstrip(space)[-1:] in (".", "!", "?") and text[at:i].rstrip(space)
        if ch == "\n" or (ended and (i + 1 == len(text) or text[i + 1] not in space)):
            out.append(text[at : i + 1])
            at = i + 1
    out += [text[at:]] if text[at:] else []
    fine = []
    for part in out:
        words = [m for m in re.finditer(r"[^\x20\x09-\x0D]+", part)]
        cuts = [0]
        if len(words) > 25:
            cuts += [b.start() for a, b in zip(words, words[1:]) if hashlib.md5(a[0].encode().lower()).hexdigest()[0] in "08"]
        fine += [part[a:b] for a, b in zip(cuts, [*cuts[1:], len(part)])]
    return fine


def plain_dedup(rows, least=10):
    seen, out = set(), {}
    for i, text, _ in sorted(rows, key=lambda r: r[0]):
        parts = plain_units(text or "")
        keys = [tuple(p.encode().lower().split()) for p in parts]
        again = []
        for key in keys:
            again.append(not key or key in seen)
            seen.add(key)
        lines = np.cumsum([0] + [p.endswith("\n") for p in parts])[:-1] if parts else []
        gone = [False] * len(parts)
        k = 0
        while k < len(parts):
            end = k
            while end < len(parts) and again[end]:
                end += 1
            if sum(len(x) for x in keys[k:end]) >= least:
                gone[k:end] = [True] * (end - k)
            k = max(end, k + 1)
        for line in set(lines):
            own = [k for k in range(len(parts)) if lines[k] == line]
            if all(again[k] for k in own) and any(keys[k] for k in own):
                for k in own:
                    gone[k] = True
        marks = "".join(("x" if g else " ") * len(p) for p, g in zip(parts, gone))
        spans = []
        for m in re.finditer("x+", marks):
            a, b = m.span()
            b -= a > 0 and text[a - 1] != "\n" and text[b - 1] == "\n"
            if a < b:
                spans.append((a, b))
        kept = [text[a:b] for a, b in zip([0, *(b for _, b in spans)], [*(a for a, _ in spans), len(text or "")])] if text else [text or ""]
        out[i] = ("".join(kept), spans)
    return out


def test_units_are_brute_force(documents):
    rng = random.Random(8)
    pool = [" ".join(rng.choice(["é", "Ab", "c", "dd."]) for _ in range(n)) for n in (2, 3, 4, 5, 12, 40)]
    long = " ".join(f"word{rng.randrange(10**6)}" for _ in range(80))
    rows = []
    for i in range(80):
        parts = [rng.choice(pool) if rng.random() < 0.6 else f"own line {i} {j} x" for j in range(rng.randrange(0, 8))]
        text = "".join(p + rng.choice(["\n", "\n", ". ", "!  ", " ", ".\r\n", "\n\n"]) for p in parts)
        if rng.random() < 0.2:
            text += " ".join(f"own{rng.randrange(10**6)}" for _ in range(7)) + " " + long + " and more"
        rows.append((i, text + rng.choice(["", "\n", "  "]), "s"))
    rows += [(170, None, "s"), (171, "", "s"), (172, pool[4].upper().replace(" ", " \t "), "s"), (173, "w " * 50000, "s"), (174, " \n \n", "s")]
    docs = documents(rows).withColumn("removed", F.lit("clash")).withColumn("units", F.lit("clash"))
    got = {r["doc_id"]: r for r in substring.dedup_units(docs).collect()}
    whole = {r[0]: r[1] for r in rows}
    for i, (text, spans) in plain_dedup(rows).items():
        assert b"".join(substring.units((whole[i] or "").encode())).decode() == (whole[i] or "")
        assert (got[i]["kept_text"] or "") == text
        assert [tuple(s) for s in got[i]["removed"]] == spans
        assert got[i]["text"] == whole[i] and got[i]["units"] == "clash"
    assert got[170]["kept_text"] is None
    assert sum(bool(r["removed"]) for r in got.values()) > 40


def test_passages_without_sentence_ends(documents):
    """A passage of 60 words in other words of two documents: all but its edges is cut from the second."""
    rng = random.Random(6)
    passage = " ".join(f"p{rng.randrange(10**6)}" for _ in range(60))
    before, after = (" ".join(f"{c}{rng.randrange(10**6)}" for _ in range(40)) for c in "ab")
    rows = [(1, f"{before} {passage} {after}", "s"), (2, f"{after} {passage} {before}", "s")]
    got = {r["doc_id"]: r["kept_text"] for r in substring.dedup_units(documents(rows)).collect()}
    assert got[1] == rows[0][1]
    left = [w for w in got[2].split() if w.startswith("p")]
    assert len(left) < 25


def test_lines_of_repeated_rows_and_nothing(documents):
    line = "one line that is long enough to count as a unit here"
    rows = [(5, line, "s"), (5, line, "s"), (6, line + "\nmore", "s"), (None, line, "s")]
    got = substring.keep_first_lines(documents(rows))
    assert sorted((r["doc_id"] or 0, r["text"], r["n_chars"]) for r in got.collect()) == [
        (0, "", 0), (5, line, len(line)), (5, line, len(line)), (6, "more", 4),
    ]
    assert substring.keep_first_lines(documents([])).collect() == []


def test_passages_within_lines(documents):
    passage = "The long passage has a first sentence. And it has é second one!"
    rows = [(1, f"Before it. {passage} After it\nmore", "s"), (2, f"{passage} Other words\nAll new? {passage}\nlast", "s")]
    rows += [(3, "Short one. Own words. And it has é second one!", "s")]
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in substring.keep_first_lines(documents(rows)).collect()}
    kept = {1: rows[0][1], 2: "Other words\nAll new? \nlast", 3: rows[2][1]}
    assert got == {i: (t, len(t)) for i, t in kept.items()}


def test_short_repeated_lines(documents):
    rows = [(1, "menu\nhome page\nfirst text", "s"), (2, "Menu\n\nhome  page\nsecond text\nmenu", "s")]
    got = {r["doc_id"]: r["text"] for r in substring.keep_first_lines(documents(rows)).collect()}
    assert got[1] == rows[0][1]
    assert [line for line in got[2].split("\n") if line] == ["second text"]


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id bigint, embedding array<float>, label int")


def planted(seed, n=400, d=16):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, d))
    for k in range(1, n, 2):
        x[k] = x[k - 1] + rng.uniform(0.01, 0.5) * rng.standard_normal(d)
    blob = rng.standard_normal(d) + 0.04 * rng.standard_normal((120, d))
    loose = rng.standard_normal(d) + 0.2 * rng.standard_normal((60, d))
    x = np.concatenate([x, blob, loose, x[:9], 3 * x[:4]]).astype(np.float32)
    return x[rng.permutation(len(x))]


ODD = [(90001, None), (90002, [0.0] * 16), (90003, [float("nan")] * 16), (90004, [None] * 16), (90005, [1.0, 2.0]), (90006, []), (90007, [float("inf")] + [1.0] * 15)]


@pytest.mark.parametrize("seed", [1, 2])
def test_near_vectors_are_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(near_vectors, "LEAF_ROWS", 64)
    x = planted(seed)
    df = vectors(spark, [(i * 3, v.tolist()) for i, v in enumerate(x)] + ODD).withColumn("kept", F.lit("clash"))
    got = {r["vec_id"]: r for r in near_vectors.near_duplicates(df).collect()}
    u = x.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    s = u @ u.T
    np.fill_diagonal(s, 0)
    # Pairs whose cosine is within rounding of the bound may fall either way.
    assert not (np.abs(s - 0.95) < 1e-12).any()
    links = s >= 0.95
    root = groups(len(x), zip(*np.nonzero(links)))
    wrong = sum(got[i * 3]["n_links"] != links[i].sum() for i in range(len(x)))
    assert wrong <= 0.01 * len(x)
    assert sum(r["n_links"] for r in got.values()) >= 0.99 * links.sum()
    assert all(got[i * 3]["n_links"] <= links[i].sum() for i in range(len(x)))
    assert sum(got[i * 3]["component_id"] != 3 * root[i] for i in range(len(x))) <= 0.02 * len(x)
    for i, _ in ODD:
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)


def test_near_vectors_of_copies_and_nothing(spark):
    v = [1.0, 2.0, 3.0]
    df = vectors(spark, [(4, v), (4, v), (7, v), (8, [2.0, 4.0, 6.0]), (9, [-1.0, 0.0, 0.0])])
    got = sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in near_vectors.near_duplicates(df).collect())
    assert got == [(4, 3, 4, True), (4, 3, 4, True), (7, 3, 4, False), (8, 3, 4, False), (9, 0, 9, True)]
    assert near_vectors.near_duplicates(vectors(spark, [])).collect() == []
    assert len(near_vectors.near_duplicates(vectors(spark, ODD)).collect()) == len(ODD)


def test_nearest_recall_and_scores(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = df.collect()
    ids = np.array([r["vec_id"] for r in rows])
    x = np.array([r["embedding"] for r in rows], np.float64)
    got = {}
    for r in ann.nearest(df, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    at = {i: k for k, i in enumerate(ids)}
    hits = 0
    assert set(got) == {i for i in ids if i % 20 == 0}
    for q, found in got.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, 21))
        assert [(-s, v) for _, v, s in found] == sorted((-s, v) for _, v, s in found)
        scores = x @ x[at[q]]
        assert all(s == pytest.approx(scores[at[v]], abs=1e-12) and v != q for _, v, s in found)
        scores[at[q]] = -np.inf
        hits += len({f[1] for f in found} & set(ids[np.lexsort((ids, -scores))[:20]]))
    assert hits >= 0.9 * 20 * len(got)


def test_nearest_of_unequal_norms_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(4)
    x = (rng.standard_normal((90, 16)) * rng.uniform(0.1, 9, (90, 1))).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(200, x[3].tolist()), (201, x[3].tolist()), (201, x[3].tolist())]
    df = vectors(spark, rows + [(1000 * i, v) for i, v in ODD]).withColumn("rank", F.lit("clash"))
    got = {}
    for r in ann.nearest(df, F.col("vec_id") % 20 == 0, k=7).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    unique = dict(rows)
    for q in got:
        a = np.array(unique[q], np.float64)
        best = sorted((-float(np.dot(np.array(v, np.float64), a)), i) for i, v in unique.items() if i != q)[:7]
        assert [v for _, v, _ in sorted(got[q])] == [i for _, i in best]
    assert set(got) == {i for i in unique if i % 20 == 0}
    few = vectors(spark, [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [-1.0, 0.0])])
    assert [(r["rank"], r["vec_id"]) for r in ann.nearest(few, F.col("vec_id") == 0).collect()] == [(1, 1), (2, 2)]
    assert ann.nearest(vectors(spark, []), F.lit(True)).collect() == []
    assert ann.nearest(vectors(spark, ODD[:4]), F.lit(True)).collect() == []
