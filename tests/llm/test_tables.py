"""Exact dedup, mixing and sharding against plain Python."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from reachmap.llm import dedup, mixing, sharding

from .helpers import documents, odd_rows, rows_of, words

WHITE = re.compile(r"[\x20\x09-\x0D]+")


def copies():
    base = [" ".join(words(20, i)) for i in range(30)]
    rows = [(i, base[i % 30] if i % 3 else base[0].replace(" ", " \n\t", i % 5)) for i in range(200)]
    return rows + [(3, base[0]), (None, base[1]), (500, base[0] + " "), *odd_rows()]


def brute_dedup(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[WHITE.sub(" ", t or "")].append(i)
    out = []
    for t, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        left = True
        for i in sorted(ids, key=lambda i: (i is None, i)):
            out.append((i, keep, len(ids), left and i == keep, hashlib.sha256(t.encode()).hexdigest()))
            left = left and i != keep
    return sorted(out, key=repr)


@pytest.mark.parametrize("digest", [dedup.sha256, lambda t: F.length(t)])
def test_dedup_equals_brute_force_even_with_a_weak_digest(spark, digest):
    rows = copies()
    got = dedup.exact_duplicates(documents(spark, rows, extra=True), digest=digest, salts=4)
    assert rows_of(got) == brute_dedup(rows)


def test_dedup_of_nothing(spark):
    got = dedup.exact_duplicates(documents(spark, []))
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"] and got.count() == 0


def mix_rows():
    rows = [(i, " ".join(words(1 + i % 40, i)), "en", f"s{i % 7}", 0) for i in range(400)]
    rows += [(1000 + i, "a b c", None, None, 0) for i in range(5)]
    return rows + [(2000, None, None, "empty", 0), (2001, "", None, "empty", 0), (2002, "x", None, "tiny", 0)]


def brute_targets(rows, cap=3):
    size = Counter()
    for _, t, _, s, _ in rows:
        size[s] += len((t or "").split())
    order = sorted(size, key=lambda s: (s is None, s))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, full = sum(size.values()), set()
    while True:
        rest = total - sum(cap * size[s] for s in full)
        w = sum(weight[s] for s in order if s not in full)
        target = {s: cap * size[s] if s in full else rest * weight[s] / w for s in order}
        over = {s for s in order if s not in full and target[s] > cap * size[s]}
        if not over:
            return size, target
        full |= over


def test_mixing_targets_and_copies(spark):
    rows = mix_rows()
    size, target = brute_targets(rows)
    docs = documents(spark, rows, extra=True).repartition(5)
    got = mixing.mix_report(docs).collect()
    of = {r[0]: r for r in rows}
    assert len(got) == len(rows)
    for r in got:
        s, n = of[r.doc_id][3], len((of[r.doc_id][1] or "").split())
        rate = target[s] / size[s] if size[s] else 0
        assert (r["size"], r.source_size) == (n, size[s])
        assert r.target == pytest.approx(target[s])
        assert r.taken == n * r.copies and int(rate + 1e-9) <= r.copies <= int(rate) + 1 and r.copies <= 3
    again = mixing.mix_report(docs.repartition(3))
    assert rows_of(again) == sorted((tuple(r) for r in got), key=repr)
    emitted = Counter(r.doc_id for r in mixing.mixed(docs).collect())
    assert emitted == Counter({r.doc_id: r.copies for r in got if r.copies})
    assert mixing.mixed(docs).columns == docs.columns


def test_mixing_comes_near_its_targets(spark):
    rows = [(i, "w " * (5 + i % 9), None, "big" if i % 10 else "small", 0) for i in range(20_000)]
    got = mixing.mix_report(documents(spark, rows))
    got = got.groupBy("target").agg(F.sum("taken").alias("taken")).collect()
    assert all(abs(r.taken - r.target) < 0.03 * r.target for r in got) and len(got) == 2


def test_mixing_odd_and_empty_tables(spark):
    assert mixing.mix_report(documents(spark, [])).count() == 0
    assert mixing.mixed(documents(spark, [])).count() == 0
    got = mixing.mix_report(documents(spark, odd_rows()))
    assert got.count() == len(odd_rows()) and got.filter("taken > 3 * size").isEmpty()


def brute_capacity(groups, shards):
    low, high = 1, sum(groups) or 1
    while low < high:
        c = (low + high) // 2
        used, load, fits = 1, 0, True
        for g in groups:
            if g > c:
                fits = False
            elif load + g > c:
                used, load = used + 1, g
            else:
                load += g
        if fits and used <= shards:
            high = c
        else:
            low = c + 1
    return low


def shard_rows():
    rows = [(i, " ".join(words(1 + i * 7 % 50, i % 90))) for i in range(300)]
    return rows + odd_rows() + [(900 + i, "the same text again " * 40) for i in range(60)]


@pytest.mark.parametrize("shards", [1, 5, 16])
def test_sharding_is_a_minimax_partition(spark, shards, monkeypatch):
    monkeypatch.setattr(sharding, "FINER", 4)
    rows = shard_rows()
    got = sharding.assign(documents(spark, rows, extra=True), shards).collect()
    size = lambda t: len((t or "").encode()) + 1
    assert sorted((repr(r.doc_id), r["size"], r.text_crc32) for r in got) == sorted(
        (repr(i), size(t), zlib.crc32((t or "").encode())) for i, t in rows
    )
    loads, slots, of_text = Counter(), defaultdict(list), {}
    for r in got:
        loads[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
        assert of_text.setdefault((r.text_crc32, r["size"]), r.shard) == r.shard
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    groups = Counter()
    for _, t in rows:
        groups[hashlib.md5((t or "").encode()).hexdigest()[:15]] += size(t)
    best = brute_capacity([groups[k] for k in sorted(groups)], shards)
    assert max(loads.values()) == best and max(loads) < shards


def test_sharding_small_blocks_and_nothing(spark, monkeypatch):
    assert sharding.assign(documents(spark, [])).count() == 0
    monkeypatch.setattr(sharding, "ROWS_PER_BLOCK", 3)  # many slices for the slots of one text
    got = sharding.assign(documents(spark, [(i, "same") for i in range(50)])).collect()
    assert sorted(r.slot for r in got) == list(range(50)) and {r.law for r in got} == {"bytes"}
