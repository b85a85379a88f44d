"""Mixing and packing: budgets, brute-force models, and the defined cases of their docstrings."""

import hashlib
import re
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from roamdex.llm import mixing, packing


def words(n, word="w"):
    return " ".join([word] * n)


def model(rows, weights=(5, 2, 1), epochs=3):
    """Targets by resharing the excess until none is above, then a walk through each source in key order."""
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    target, left, free = {}, Fraction(sum(sizes.values())), list(order)
    while free:
        level = left / sum(weight[s] for s in free)
        above = [s for s in free if level * weight[s] > epochs * sizes[s]]
        for s in above or free:
            target[s] = Fraction(epochs * sizes[s]) if above else level * weight[s]
            left -= target[s]
            free = [f for f in free if f != s]
    taken = {}
    for s in order:
        rest = int(target[s])
        own = sorted(
            (hashlib.md5(":".join(["mix"] + ([] if i is None else [str(i)])).encode()).hexdigest(), i, t)
            for i, t, src in rows
            if src == s
        )
        whole = rest // sizes[s] if sizes[s] else 0
        rest -= whole * sizes[s]
        for _, i, t in own:
            size = len((t or "").split())
            part = min(size, rest)
            rest -= part
            taken[i] = whole * size + part
    return target, taken


@pytest.mark.parametrize("range_rows", [2048, 2])
def test_mix_is_the_model(spark, documents, monkeypatch, range_rows):
    monkeypatch.setattr(mixing, "RANGE_ROWS", range_rows)
    rows = [(i, words(1 + i * 7 % 23), "hot" if i % 3 else f"s{i % 5}") for i in range(90)]
    rows += [(100, None, "hot"), (101, "", None), (102, words(4), None), (103, " \t\x0b ", "empty")]
    got = mixing.mix(mixing.document_sizes(documents(rows))).collect()
    target, taken = model(rows)
    assert {r["doc_id"]: r["taken"] for r in got} == taken
    assert len(got) == len(rows)
    for r in got:
        assert r["target"] == pytest.approx(float(target[r["source"]]))
        assert r["taken"] <= 3 * r["size"]


def test_mix_reruns_agree_and_repeated_rows_count(documents):
    rows = [(1, words(5), "a"), (1, words(5), "a"), (2, words(3), "b")]
    first, second = (
        sorted(map(tuple, mixing.mix(mixing.document_sizes(documents(rows))).collect())) for _ in range(2)
    )
    assert first == second and len(first) == 3
    assert sum(r[5] for r in first) == 13 - (1 if sum(r[4] % 1 > 0 for r in first) else 0)


def test_mix_of_nothing(documents):
    assert mixing.mix(mixing.document_sizes(documents([]))).collect() == []


def test_mixed_documents_keep_their_columns(documents):
    from pyspark.sql import functions as F

    docs = documents([(i, words(10), "abc"[i % 3]) for i in range(60)]).withColumn("times", F.lit("clash"))
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns
    counts = {r["source"]: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert counts == pytest.approx({"a": 37.5, "b": 15, "c": 7.5}, abs=1)
    assert mixed.where("times <> 'clash'").count() == 0


def plain_best_fit(sizes, capacities, open_cost):
    """The same rule, by looking at every bin and every waiting item."""
    waiting = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    rooms, used, bins, offsets = [], [], {}, {}
    for n, i in enumerate(waiting):
        size = sizes[i]
        fits = [(room, -b) for b, room in enumerate(rooms) if room >= size]
        if fits:
            room = min(r for r, _ in fits)
            b = max((b for b, r in enumerate(rooms) if r == room), key=lambda b: stamps[b])
        else:
            costs = []
            for c in capacities:
                if c >= size:
                    room, filled = c - size, size
                    for j in waiting[n + 1 :]:
                        if sizes[j] <= room:
                            room, filled = room - sizes[j], filled + sizes[j]
                    costs.append(((c + open_cost) / filled, c))
            b = len(rooms)
            rooms.append(min(costs)[1])
            used.append(0)
            stamps[b] = 0
        bins[i], offsets[i] = b, used[b]
        rooms[b] -= size
        used[b] += size
        stamps[b] = clock[0] = clock[0] + 1
    return [bins[i] for i in range(len(sizes))], [offsets[i] for i in range(len(sizes))], used


stamps: dict = {}
clock = [0]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=40))
def test_best_fit_is_the_plain_rule(sizes):
    capacities = (10, 20, 40)
    stamps.clear()
    bins, offsets, kept = packing.best_fit(sizes, capacities, 2.0)
    plain, plain_offsets, used = plain_best_fit(sizes, capacities, 2.0)
    assert (bins, offsets) == (plain, plain_offsets)
    assert kept == [min(c for c in capacities if c >= u) for u in used]


def test_packing_is_whole(documents):
    rows = [(i, words(i * 37 % 900), "s") for i in range(200)] + [(500, words(9000), "s"), (501, None, "s")]
    rows += [(502, words(4096), "s"), (502, words(4096), "s"), (503, words(7), "s"), (503, words(7), "s"), (None, words(3), "s")]
    sizes = mixing.document_sizes(documents(rows)).select("doc_id", "size")
    got = packing.pack(sizes, shard_rows=50).collect()
    bins, of = {}, {}
    for r in got:
        of.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["size"]))
        if r["size"]:
            bins.setdefault(r["bin_id"], []).append(r)
        else:
            assert r["bin_id"] is None
    assert sorted(of[500]) == [(0, 0, 4096), (1, 4096, 4096), (2, 8192, 808)]
    assert of[501] == [(0, 0, 0)] and len(of[502]) == 2 and len(of[503]) == 2 and of[None] == [(0, 0, 3)]
    assert sum(r["size"] for r in got) == sum(len((t or "").split()) for _, t, _ in rows)
    for own in bins.values():
        own.sort(key=lambda r: r["bin_offset"])
        filled = 0
        for r in own:
            assert r["bin_offset"] == filled
            filled += r["size"]
        assert own[0]["capacity"] == min(c for c in packing.CAPACITIES if c >= filled)
    waste = sum(own[0]["capacity"] for own in bins.values()) / sum(r["size"] for r in got)
    assert waste < 1.1


def test_packing_nothing(documents):
    sizes = mixing.document_sizes(documents([])).select("doc_id", "size")
    assert packing.pack(sizes).collect() == []
