"""Token counts against the library, language by held-out accuracy, quality by labels, and the defined cases."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from roamdex.llm import language, quality, token_counts

SF = "/root/testdata/sf0.01"
FILE = public_tokenizers.path("byte_bpe_50k.json")

TEXTS = [
    None, "", " ", "\n\n \t x", "It's we'll I'D don't 'sup", "a  b   c    ", "x²³¹ ½ ¼", "naïve ÀÉ ǅ ªº", "12 345 6789٣",
    "emoji 😀😀 and 漢字かな", "a<|endoftext|>b", "<|endoftext", "tabs\t\tand\x1cseps\x1d\x85x\xa0y", "under_score __x__ ‿ ⁀",
    "“quotes” — dash… ‘s ’s", " line para　wide", "é combining ҉", "x" * 5000, "ab " * 3000,
    "trailing space ", "\r\n\r\nmix\r", "!!??..;;'' ''", "'s", "'S 'T", "\x00\x7f\x80\x9f", "́", "a​b ﻿c", "ﬁ ſ K",
]


@pytest.mark.parametrize("entries", [token_counts.CACHE_ENTRIES, 3])
def test_token_counts_are_the_librarys(spark, documents, entries):
    docs = documents([(i, t, "s") for i, t in enumerate(TEXTS)] + [(7, TEXTS[7], "s")])
    docs = docs.withColumn("n_tokens", F.lit("clash"))
    got = token_counts.count_tokens(docs, FILE, entries).collect()
    tokenizer = Tokenizer.from_file(FILE)
    assert len(got) == len(TEXTS) + 1
    for r in got:
        text = TEXTS[r["doc_id"]] or ""
        assert r["n_bytes"] == len(text.encode())
        assert r["n_tokens"] == len(tokenizer.encode(text, add_special_tokens=False).ids), repr(text)
        assert r["over_limit"] == (r["n_tokens"] > 1024)


def test_token_counts_of_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(docs, FILE).collect()}
    rows = docs.select("doc_id", "text").collect()
    tokenizer = Tokenizer.from_file(FILE)
    counts = tokenizer.encode_batch([r["text"] for r in rows], add_special_tokens=False)
    assert got == {r["doc_id"]: len(e.ids) for r, e in zip(rows, counts)}


def test_every_piece_is_the_tokenizers_own():
    tokenizer = Tokenizer.from_file(FILE)
    cut = token_counts._Cutter(tokenizer)
    for text in TEXTS[1:]:
        pieces, special = cut(text)
        assert special == text.count("<|endoftext|>")
        assert "".join(pieces) == text.replace("<|endoftext|>", "")
        if not special:
            assert pieces == [text[a:b] for _, (a, b) in tokenizer.pre_tokenizer.pre_tokenize_str(text)], repr(text)


def test_no_text_is_encoded_whole(spark, documents, monkeypatch):
    """Pieces of odd texts are found in the two tiers: what is encoded is a miss of both, never a text."""
    tokenizer = Tokenizer.from_file(FILE)
    frequent = token_counts.frequent_lengths(tokenizer, [" 漢字", " Ελλάδα", "not one", ""])
    assert " 漢字" in frequent and " Ελλάδα" in frequent and "not one" not in frequent and "" not in frequent
    lengths = token_counts._Lengths(tokenizer, frequent, 10)
    pieces, _ = token_counts._Cutter(tokenizer)("the 漢字 and 漢字 in Ελλάδα zqxj zqxj")
    assert [p for p in pieces if p not in frequent] == [" zqxj", " zqxj"]
    assert sum(map(lengths.__getitem__, pieces)) == len(tokenizer.encode("the 漢字 and 漢字 in Ελλάδα zqxj zqxj").ids)
    assert set(lengths) - set(frequent) == {" zqxj"}


def test_sampled_words_are_the_commonest(spark, documents):
    docs = documents([(i, "漢字 漢字 漢字 " + "y" * 99 + f" rare{i}", "s") for i in range(300)] + [(None, None, None)])
    words = token_counts.sampled_words(docs, Tokenizer.from_file(FILE).to_str())
    assert words[0] == " 漢字" and "y" * 99 not in words and " " + "y" * 99 not in words
    assert len(words) <= token_counts.SAMPLE_WORDS


def test_tokenizers_that_change_texts_are_refused():
    tokenizer = Tokenizer.from_file(FILE)
    from tokenizers import normalizers

    tokenizer.normalizer = normalizers.Lowercase()
    with pytest.raises(ValueError):
        token_counts._Cutter(tokenizer)


def test_token_counts_of_nothing(documents):
    assert token_counts.count_tokens(documents([]), FILE).collect() == []


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id")
    right = got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right >= 0.98
    assert got.where("score < 0 or score > 1").count() == 0
    held = spark.sql("select crc32(cast('17' as binary)) % 4 = 2").first()[0]
    assert got.where("doc_id = 17").first()["held_out"] == held


def test_language_never_sees_the_held_out_or_the_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    wrong = docs.withColumn("lang", F.when(language.held_out(), F.lit("zz")).otherwise(F.col("lang")))
    a = {r["doc_id"]: r["lang_pred"] for r in language.identify(docs).collect()}
    b = {r["doc_id"]: r["lang_pred"] for r in language.identify(wrong).collect()}
    assert a == b


def test_language_mixtures_and_odd_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.fit(docs)
    by_lang = {r["lang"]: r["text"] for r in docs.where("n_chars between 2000 and 4000").select("lang", "text").collect()}
    half = by_lang["de"][:2000] + " " + by_lang["fr"][:1000]
    (one,) = language.predict(model, [half])
    assert one[0] == "de" and 0.5 < one[1] < 0.85
    odd = [None, "", "123 !?", "Und", "THE AND OF THE WAS " * 20, "漢字", by_lang["es"] * 300]
    found = language.predict(model, odd)
    assert [f[0] for f in found[:3]] == ["und"] * 3 and found[4][0] == "en" and found[6][0] == "es"
    assert found[5][0] in model.languages
    assert language.predict(model, odd) == found


def test_language_without_labels(documents):
    docs = documents([(1, "some text", "s"), (2, None, "s")], lang=None)
    assert [r["lang_pred"] for r in language.identify(docs).collect()] == ["und", "und"]
    assert language.identify(documents([])).collect() == []


def test_quality_against_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.classify(docs).join(labels, "doc_id")
    counts = {(r["quality"], r["kept"]): r["count"] for r in got.groupBy("quality", "kept").count().collect()}
    assert counts.get((1, False), 0) <= 0.01 * counts[1, True]
    assert counts.get((0, True), 0) <= 0.05 * counts[0, False]


def test_vote_weights():
    def pattern(*said):
        return sum(v * 3**k for k, v in enumerate(said))

    n = len(quality.LABELLERS)
    good, quiet = pattern(*[quality.GOOD] * n), pattern(*[quality.NOTHING] * n)
    bad = [pattern(*[quality.BAD if k in (j, j + 1) else quality.GOOD for k in range(n)]) for j in range(0, n, 2)]
    found = quality.weigh_votes({good: 900, quiet: 20, **{b: 25 for b in bad}})
    assert found[good] > 0.95 and found[quiet] > 0.5 and all(found[b] < 0.05 for b in bad)
    assert quality.weigh_votes({}) == {}


def test_quality_of_odd_texts(documents):
    rows = [(i, t, "s") for i, t in enumerate([None, "", "One.", "  ", "word " * 30000, "fine text here, it is. " * 5])]
    docs = documents(rows + [(2, "One.", "s")]).withColumn("score", F.lit("clash")).withColumn("kept", F.lit("clash"))
    got = quality.classify(docs).collect()
    assert len(got) == 7 and all(0 <= r["score"] <= 1 for r in got)
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} >= {0, 1, 2, 3, 5}
    assert quality.classify(documents([])).collect() == []


def test_the_whole_word_is_read():
    """Texts without spaces that differ behind their 64th character only have different features; short words are as they were."""
    head = "Ab9-" * 40
    found = [quality.features(*quality.read_text(head + tail)) for tail in ("", "{x}[y]" * 30, "Ab9-" * 40)]
    assert found[0] != found[1]
    # As many buckets' worth as the shape has pieces: nothing behind the first is passed over.
    assert sum(found[2].values()) > 1.9 * sum(found[0].values()) - 1
    assert len(quality._shapes("Word's")) == 1 and quality._shapes("a" * 10**6) == quality._shapes("b")


def _slow_em(patterns, rounds=200):
    """The labellers' model, one pattern, labeller and class at a time."""
    from math import exp, log

    votes = {c: [c // 3**k % 3 for k in range(len(quality.LABELLERS))] for c in patterns}
    p = {c: 0.1 if quality.BAD in v else 0.9 for c, v in votes.items()}
    for _ in range(rounds):
        total = sum(patterns.values())
        good = (sum(n * p[c] for c, n in patterns.items()) + 1) / (total + 2)
        wrong = {}
        for k in range(len(quality.LABELLERS)):
            for cls in (0, 1):
                seen = [1.0, 1.0] if cls == 0 else [0.1 * 20, 0.9 * 20]
                for c, n in patterns.items():
                    if votes[c][k] != quality.NOTHING:
                        seen[votes[c][k]] += n * (p[c] if cls else 1 - p[c])
                wrong[cls, k] = [x / sum(seen) for x in seen]
        for c, v in votes.items():
            odds = log(good) - log(1 - good)
            odds += sum(log(wrong[1, k][x]) - log(wrong[0, k][x]) for k, x in enumerate(v) if x != quality.NOTHING)
            p[c] = 1 / (1 + exp(-odds))
    return p


def _simulated(n, share_good, wrong_on_good, right_on_bad, silent, seed):
    import numpy as np

    rng = np.random.default_rng(seed)
    good = rng.random(n) < share_good
    k = len(quality.LABELLERS)
    bad_vote = np.where(good[:, None], rng.random((n, k)) < wrong_on_good, rng.random((n, k)) < right_on_bad)
    vote = np.where(rng.random((n, k)) < silent, quality.NOTHING, np.where(bad_vote, quality.BAD, quality.GOOD))
    return good, (vote * 3 ** np.arange(k)).sum(1)


def test_estimates_equal_slow_em():
    from collections import Counter

    _, codes = _simulated(400, 0.8, 0.05, 0.6, 0.3, 1)
    patterns = {int(c): n for c, n in Counter(codes.tolist()).items()}
    slow, fast = _slow_em(patterns), quality.weigh_votes(patterns)
    assert slow.keys() == fast.keys()
    assert max(abs(slow[c] - fast[c]) for c in slow) < 1e-5


@pytest.mark.parametrize("share_good", [0.9, 0.5])
def test_accuracies_are_recovered(share_good):
    """Labellers that differ in accuracy, some often wrong on good documents: EM finds how often, against the prior."""
    from collections import Counter

    import numpy as np

    k = len(quality.LABELLERS)
    wrong_on_good, right_on_bad = np.linspace(0.01, 0.3, k), np.linspace(0.4, 0.9, k)
    good, codes = _simulated(20_000, share_good, wrong_on_good, right_on_bad, 0.2, 2)
    found = quality.estimate({int(c): n for c, n in Counter(codes.tolist()).items()})
    assert abs(found.good - share_good) < 0.02
    assert np.abs(found.accuracy[quality.GOOD, :, quality.BAD] - wrong_on_good).max() < 0.02
    assert np.abs(found.accuracy[quality.BAD, :, quality.BAD] - right_on_bad).max() < 0.04
    # Calls are as good as those of one who knows the accuracies.
    digit = codes[:, None] // 3 ** np.arange(k) % 3
    odds = np.where(digit == quality.BAD, np.log(wrong_on_good / right_on_bad), np.log((1 - wrong_on_good) / (1 - right_on_bad)))
    known = np.log(share_good / (1 - share_good)) + np.where(digit == quality.NOTHING, 0, odds).sum(1) >= 0
    called = np.array([found.posterior[int(c)] >= 0.5 for c in codes])
    assert (called == good).mean() > (known == good).mean() - 0.005


def _slow_language(model, text):
    """The mixture of one text, a window and a language at a time."""
    from math import exp, log

    rows = [[float(x) for x in w] for w in language.windows(model, text)]
    if not rows:
        return language.UNKNOWN, 0.0
    k = len(model.languages)

    def em(share):
        for _ in range(language.EM_ROUNDS):
            sums = [0.0] * k
            for w in rows:
                parts = [exp(x - max(w)) * s for x, s in zip(w, share)]
                total = max(sum(parts), 1e-300)
                sums = [a + b / total for a, b in zip(sums, parts)]
            share = [a / len(rows) for a in sums]
        fit = 0.0
        for w in rows:
            fit += log(max(sum(exp(x - max(w)) * s for x, s in zip(w, share)), 1e-300)) + max(w)
        return share, fit

    cost = language.PENALTY * log(len(rows) + 1)
    share, fit = em([1 / k] * k)
    best, best_share = fit - cost * sum(s > 0 for s in share), share
    for left in range(k - 1, 0, -1):
        alive = [j for j in range(k) if share[j] > 0]
        if len(alive) > left:
            least = min(alive, key=lambda j: (share[j], j))
            share = [0.0 if j == least else s for j, s in enumerate(share)]
        share, fit = em([s / sum(share) for s in share])
        value = fit - cost * sum(s > 0 for s in share)
        if value > best:
            best, best_share = value, share
    top = max(range(k), key=lambda j: (best_share[j], -j))
    return model.languages[top], best_share[top]


def test_language_equals_slow_mixture(spark):
    """Whole texts and texts put together of two languages, against the plain model."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.fit(docs.where(~language.held_out()))
    texts = [r["text"][:4000] for r in docs.where(language.held_out()).orderBy("doc_id").limit(24).collect()]
    texts += [a[:1500] + " " + b[:1500] for a, b in zip(texts, texts[7:])] + [None, "", "12 34", "a", "été"]
    for (lang, score), text in zip(language.predict(model, texts), texts):
        slow, share = _slow_language(model, text)
        assert lang == slow, text
        assert abs(score - min(1.0, share)) < 1e-4
