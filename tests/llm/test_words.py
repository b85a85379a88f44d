"""Phrases, fill-in-middle and language-model scores against brute force, and what they are built on."""

import math
import random
import re
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from roamdex.llm import bloom, infill, lm, ngrams, phrases


@pytest.mark.parametrize("chunk", [7, 64, 1 << 20])
def test_words(monkeypatch, chunk):
    rng = random.Random(chunk)
    monkeypatch.setattr(ngrams, "CHUNK", chunk)
    ngrams._powers.cache_clear()
    texts = [None, "", " ", "x" * 300, "É a b"] + ["".join(rng.choice("ab AB\t\n,é") for _ in range(rng.randrange(80))) for _ in range(50)]
    buffer, at = ngrams.joined(pa.array(texts))
    assert [buffer[a : b - 1] for a, b in zip(at, at[1:])] == [(t or "").encode().lower() for t in texts]
    starts, ends, hashes = ngrams.words(buffer, ngrams.byte_class(b" \t\n"))
    expected = [(m.start(), m.end(), m[0]) for m in re.finditer(rb"[^ \t\n]+", buffer)]
    assert list(zip(starts, ends)) == [e[:2] for e in expected]
    by_word = {w: h for (_, _, w), h in zip(expected, hashes)}
    assert all(by_word[w] == h for (_, _, w), h in zip(expected, hashes)) and len(set(by_word.values())) == len(by_word)
    ngrams._powers.cache_clear()


def test_filter(spark):
    rng = np.random.default_rng(1)
    keys = ngrams.mix(np.arange(1, 60_001, dtype=np.uint64))
    counts = rng.zipf(1.6, 30_000).astype(np.int64)
    table = spark.createDataFrame(list(zip(keys[:30_000].view(np.int64).tolist(), counts.tolist())), "key bigint, n bigint")
    items = table.select("key", bloom.level_of(F.col("n")).alias("level"))
    total = items.agg(F.sum("level")).first()[0]
    grams = bloom.build(items, bloom.blocks_for(total, 1 << 30))
    read = grams.levels(keys)
    as_count = bloom.count_of()[read]
    low = counts < bloom.EXACT
    assert (as_count[:30_000][low] >= counts[low]).all() and (as_count[:30_000][low] == counts[low]).mean() > 0.9
    big = (counts >= bloom.EXACT) & (counts < 10**9)
    assert (as_count[:30_000][big] > counts[big] * 0.88).all()
    assert (read[30_000:] > 0).mean() < 1.5 * 2**-bloom.PROBES


UNITS = re.compile(r"[A-Za-z]+|[^A-Za-z]")


def plain_infill(doc_id, text):
    units, draws = UNITS.findall(text), infill.draws(doc_id)
    n = len(units)
    if not text or re.search("<[PSM]>", text) or draws[2] % 100 >= 90:
        return n, "plain", None, None, text
    low, high = sorted((draws[0] % (n + 1), draws[1] % (n + 1)))
    p, m, s = ("".join(u) for u in (units[:low], units[low:high], units[high:]))
    if draws[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_middle_is_plain(spark, documents):
    rng = random.Random(3)
    texts = [None, "", "a", "é", "<P>", "a<M>b", "<", "<P", "x" * 200_000, "ab cd, " * 60_000, "日本語 text 🙂" * 9000, "\x00\r\n"]
    texts += ["".join(rng.choice("abC dé🙂<>PSM\n ") for _ in range(rng.randrange(200))) for _ in range(150)]
    rows = [(i, t, "s") for i, t in enumerate(texts)]
    rows += [(8, texts[8], "s")] * 3 + [(9, "other text", "s"), (None, "no id", "s"), (None, "no id", "s"), (None, None, "s")]
    docs = documents(rows).repartition(5).withColumn("form", F.lit(1)).withColumn("copy", F.lit("clash"))
    got = [tuple(r) for r in infill.fill_in_middle(docs).collect()]

    def digest(t):
        return sha256(t.encode()).hexdigest()

    expected = []
    for i, t, _ in rows:
        n, form, p, m, out = plain_infill(i, t or "")
        expected.append((i, n, form, p, m, digest(out), digest(t or "")))
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert {"plain", "psm", "spm"} == {r[2] for r in got}
    assert infill.fill_in_middle(docs.where("false")).collect() == []


def test_fill_in_middle_shuffles_once(spark, documents):
    plan = infill.fill_in_middle(documents([(1, "a", "s")]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and plan.count("Sort [") == 2


def plain_collocations(rows, least=10, top=2000):
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    key = (lang, *words[i : i + k])
                    counts[key] = counts.get(key, 0) + 1
    longest = Counter()
    for key, a in counts.items():
        if len(key) == 4 and a >= least:
            for part in (key[:3], (key[0], *key[2:])):
                longest[part] = max(longest[part], a)
    out = {}
    for key, a in counts.items():
        if len(key) < 3 or a < least or 100 * longest[key] >= 50 * a:
            continue
        lang, words = key[0], key[1:]
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[(lang, *words[:k])], counts[(lang, *words[k:])]
            cuts.append((1000000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    return sorted(
        (lang, rank, p.decode(), -a, left, right, totals[lang], -s)
        for lang, found in out.items()
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1)
    )


def phrase_rows():
    rng = random.Random(11)
    vocabulary = ["the", "new", "York", "city", "of", "é", "日本", "it's", "a-b", "x\x0bx", "\x1c"]
    rows = []
    for k in range(160):
        words = [rng.choice(vocabulary) if rng.random() < 0.7 else f"w{rng.randrange(60)}" for _ in range(rng.randrange(60))]
        text = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n"]) for w in words)
        rows.append((rng.choice(["en", "fr", None, "und", ""]), rng.choice([text, text.upper(), text + " New York City!"])))
    return [*rows, (None, None), ("en", ""), ("de", "only here " * 30_000), ("en", "a b c. " * 12), ("it", "too few words")]


@pytest.mark.parametrize("share", [1, 8, 10**9])
def test_collocations_are_plain(spark, share):
    rows = phrase_rows()
    docs = spark.createDataFrame([(*r, 1) for r in rows], "lang string, text string, w1 int").repartition(4)
    got = [tuple(r) for r in phrases.collocations(docs, sample_share=share).collect()]
    assert sorted(got) == plain_collocations(rows)
    found, passes = phrases.frequent_phrases(docs, sample_share=share)
    # A sample of everything misses nothing; one of nothing takes a pass for every length.
    assert passes == {1: 1, 10**9: 3}.get(share, passes)
    keys = found.groupBy("w1", "w2", "w3", "lang").count()
    assert keys.where("count > 1").count() == 0


def test_collocations_few(spark):
    rows = phrase_rows()
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert sorted(map(tuple, phrases.collocations(docs, top=3).collect())) == plain_collocations(rows, top=3)
    assert phrases.collocations(docs.where("false")).collect() == []
    assert phrases.collocations(docs.where("lang = 'it'")).collect() == []


def test_collocation_scores_are_exact(spark):
    big = [(10**15 + 7, 10**15 + 9, 10**15 + 21), (10**15, 10**15, 10**15), (3, 9, 1), (10, 10, 11)]
    rows = spark.createDataFrame(big, "a bigint, l bigint, r bigint").select("a", "l", "r", phrases._cut("l", "r").alias("s"))
    assert all(r["s"] == 1000000 * r["a"] ** 2 // (r["l"] * r["r"]) for r in rows.collect())


SPACE = r"[^\x20\x09-\x0D]+"


def lm_tokens(text):
    return [*re.findall(SPACE, re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), "\n"]


def held_out(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 10 == 0


def lm_rows():
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["a", "B", "é", "the", "of", f"w{rng.randrange(200)}"]) for _ in range(rng.randrange(90))), "s") for i in range(300)]
    return rows + [(1000, None, "s"), (1001, "", "s"), (None, "new words here", "s"), (1002, "long " * 50_000, "s"), (5, rows[5][1], "s"), (5, rows[5][1], "s")]


@pytest.mark.parametrize("common", [1 << 18, 12, 0])
def test_lm_is_plain(spark, documents, common):
    rows = lm_rows()
    docs = documents(rows).repartition(4).withColumn("score", F.lit("clash")).withColumn("row", F.lit(0))
    got = lm.score(docs, common_words=common).collect()
    counts, pairs, starts = Counter(), Counter(), 0
    for i, t, _ in rows:
        if not held_out(i):
            tokens = lm_tokens(t)
            counts.update(tokens)
            pairs.update(zip(["\r", *tokens], tokens))
            starts += 1
    total, share = sum(counts.values()), 0.1 * (len(counts) + 1)
    assert len(got) == len(rows)
    by_row = {}
    for r in got:
        by_row.setdefault((r["doc_id"], r["n_tokens"]), []).append(r)
    exact = 0
    for i, t, _ in rows:
        tokens = lm_tokens(t)
        base = sum(math.log10((counts[w] + 0.1) / (total + share)) for w in tokens)
        known = sum(counts[w] > 0 for w in tokens)
        history = Counter(counts)
        history["\r"] = starts

        def read(n):
            return n if n < 8 else float(bloom.count_of()[8 + math.floor(math.log(n / 8) / math.log(bloom.STEP))])

        score = sum(
            math.log10(
                (min(read(pairs[h, w]), read(counts[w]), read(history[h])) + lm.PRIOR * (read(counts[w]) + 0.1) / (total + share))
                / (read(history[h]) + lm.PRIOR)
            )
            for h, w in zip(["\r", *tokens], tokens)
        )
        for r in by_row[i, len(tokens)]:
            assert (r["held_out"], r["n_known"], r["train_tokens"]) == (held_out(i), known, total)
            assert math.isclose(r["base_score"], base, rel_tol=1e-9)
            # Only false positives part the two: they raise counts of pairs, and of words that are rare.
            assert math.isclose(r["score"], score, rel_tol=0.1)
            exact += math.isclose(r["score"], score, rel_tol=1e-9)
    assert exact > 0.2 * len(got)
    assert lm.score(docs.where("false")).collect() == []


def test_lm_without_training(spark, documents):
    only = documents([(None, "a b", "s"), (None, None, "s")])
    got = sorted((r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in lm.score(only).collect())
    assert got == [(1, 0, 0, 0.0), (3, 0, 0, 0.0)]


def test_lm_adds_up_and_beats_its_base(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    training = docs.where(~lm.is_held_out(F.col("doc_id")))
    model, counts = lm.train(training)
    words = np.append(counts.select("word").toPandas()["word"].to_numpy().view(np.uint64), ngrams.mix(np.array([99], np.uint64)))
    for h in words[:: len(words) // 20]:
        share = 10 ** model.log_shares(words, np.full(len(words), h))
        count = model.probed(np.array([h]))[0]
        # Quantised counts, and as many false positives as the filter may have, each read as one occurrence.
        assert 0.8 < share.sum() < 1.25 + 1.5 * len(words) * 2**-bloom.PROBES / (count + lm.PRIOR)
    held = lm.score(docs).where("held_out").agg(F.sum("base_score"), F.sum("score")).first()
    assert held[1] > held[0]


def test_lm_bounds(spark, documents):
    """A filter with too little room leaves out the least counts, and nothing else changes."""
    docs = documents(lm_rows())
    small, whole = (lm.score(docs, most_bytes=b).orderBy("doc_id", "n_tokens").collect() for b in (bloom.BLOCK_BYTES, 1 << 27))
    levels = [{"level": i, "k": k, "word": w} for i, k, w in ((1, 10**6, False), (9, 1000, False), (2, 10, True))]
    assert lm._least_levels(levels, bloom.BLOCK_BYTES) == (1, 2) and lm._least_levels(levels, 1 << 27) == (1, 1)
    assert lm._least_levels(levels, 1) == (3, 128)
    assert [r["base_score"] for r in small] == [r["base_score"] for r in whole]


@pytest.mark.parametrize("most, common", [(4000, 12), (1, 1 << 18)])
def test_lm_left_out_of_the_filter(spark, documents, most, common):
    """What the filter had no room for is looked up: scores are those of a filter with room, but for its false positives."""
    rows = lm_rows()
    docs = documents(rows).repartition(4)
    model, _, left = lm._trained(docs.where(~lm.is_held_out(F.col("doc_id"))), most, common)
    assert left.where("not word").count() > 0 and (left.where("word").count() > 0) == (most == 1)
    counts, pairs, starts = Counter(), Counter(), 0
    for i, t, _ in rows:
        if not held_out(i):
            tokens = lm_tokens(t)
            counts.update(tokens)
            pairs.update(zip(["\r", *tokens], tokens))
            starts += 1
    total, share = sum(counts.values()), 0.1 * (len(counts) + 1)
    history = Counter(counts)
    history["\r"] = starts

    def read(n):
        return n if n < 8 else float(bloom.count_of()[8 + math.floor(math.log(n / 8) / math.log(bloom.STEP))])

    expected = {}
    for i, t, _ in rows:
        tokens = lm_tokens(t)
        expected[i, len(tokens)] = sum(
            math.log10(
                (min(read(pairs[h, w]), read(counts[w]), read(history[h])) + lm.PRIOR * (read(counts[w]) + 0.1) / (total + share))
                / (read(history[h]) + lm.PRIOR)
            )
            for h, w in zip(["\r", *tokens], tokens)
        )
    got = lm.score(docs, most_bytes=most, common_words=common).collect()
    assert len(got) == len(rows)
    close = [math.isclose(r["score"], expected[r["doc_id"], r["n_tokens"]], rel_tol=1e-9) for r in got]
    assert all(math.isclose(r["score"], expected[r["doc_id"], r["n_tokens"]], rel_tol=0.02) for r in got)
    assert sum(close) > 0.95 * len(got)


def test_lm_reads_common_words_once(monkeypatch):
    """Levels of the commonest words are read when the model is made: scoring texts asks the filter for the others."""
    rng = np.random.default_rng(5)
    words = np.unique(rng.integers(0, 1 << 63, 2000, dtype=np.uint64))
    levels = rng.integers(1, 40, len(words))
    grams = bloom.Filter(bloom.blocks_for(int(levels.sum()), 1 << 27))
    grams.add_levels(words, levels)
    model = lm.Model(grams, (1, 1), 10**6, len(words), words[::2], 2 ** np.arange(len(words[::2])) % 1000 + 1)
    expected, asked, levels_of = grams.levels(words), [], bloom.Filter.levels
    monkeypatch.setattr(bloom.Filter, "levels", lambda self, keys: asked.append(keys) or levels_of(self, keys))
    assert model.word_levels(words).tolist() == expected.tolist()
    assert np.concatenate(asked).tolist() == words[1::2].tolist()


def test_filter_bits_are_plain():
    """Bits and answers of a filter, keys put in many at a time, against one key at a time; some share bytes, some repeat."""
    rng = np.random.default_rng(6)
    keys = np.concatenate([rng.integers(0, 1 << 64, 300, dtype=np.uint64), np.arange(300, dtype=np.uint64)])
    keys = np.concatenate([keys, keys[:50]])
    levels = rng.integers(1, 12, len(keys))
    many, one = bloom.Filter(2), bloom.Filter(2)
    many.add_levels(keys, levels)
    for key, level in zip(keys.tolist(), levels.tolist()):
        for n in range(1, level + 1):
            m = int(ngrams.mix(np.array([(key + n * 0xD1342543DE82EF95) % (1 << 64)], np.uint64))[0])
            first = ((key >> 32) * 2 >> 32) * bloom.BLOCK_BITS
            for i in range(bloom.PROBES):
                place = first + (m % bloom.BLOCK_BITS + i * (m >> 20 & bloom.BLOCK_BITS - 1 | 1)) % bloom.BLOCK_BITS
                one.bits[place >> 3] |= 1 << (place & 7)
    assert (many.bits == one.bits).all()
    assert (many.levels(keys) >= levels).all() and not many.has(np.zeros(0, np.uint64)).size


def test_filter_rows_are_put_in_together():
    """Arrow batches of a few rows are put in many at a time, as a loop over levels has a price for each call."""
    batches = [pa.record_batch({"key": pa.array([i, -i], pa.int64()), "level": pa.array([1, 2], pa.int8())}) for i in range(1000)]
    parts = list(bloom._gathered(iter(batches), 1500))
    assert [len(keys) for keys, _ in parts] == [1500, 500]
    assert np.concatenate([k for k, _ in parts]).view(np.int64).tolist() == [s * i for i in range(1000) for s in (1, -1)]
    assert list(bloom._gathered(iter([]), 10)) == []
