"""Circulant MinHash: its estimates, its buckets, and components against brute force."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pytest
from brute import words_of

from sparktrips.llm import minhash_dedup, queries

SF = "/root/testdata/sf0.001"


def shingles(text):
    words = words_of(text)
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """Sorted rows (id, size, component, kept) of ``rows`` (id, text)."""
    sets = [frozenset(shingles(t)) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    by_set = {}
    for i, s in enumerate(sets):
        if s:
            parent[root(i)] = root(by_set.setdefault(s, i))
    for (a, i), (b, j) in combinations(by_set.items(), 2):
        if min(len(a), len(b)) * 100 >= 85 * max(len(a), len(b)) and 100 * len(a & b) >= 85 * len(a | b):
            parent[root(i)] = root(j)
    least = {}
    for i, (name, _) in enumerate(rows):
        if name is not None:
            least[root(i)] = min(name, least.get(root(i), name))
    out = []
    for i, (name, _) in enumerate(rows):
        component = least.get(root(i)) if sets[i] else name
        out.append((name, len(sets[i]), component, name == component))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=str)


def table(spark, rows, parts=4):
    return spark.createDataFrame(rows, "doc_id bigint, text string").repartition(parts)


def edited(draw, words, edits):
    words = list(words)
    for at in draw.choice(len(words), edits, replace=False):
        words[at] = f"new{draw.integers(1 << 30)}"
    return words


def test_query_equals_brute_force(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert result(queries.op11_minhash_dedup(spark, SF)) == brute(rows)


def test_awkward_rows(spark, awkward, nothing):
    assert result(minhash_dedup.near_duplicates(awkward)) == brute([(r.doc_id, r.text) for r in awkward.collect()])
    assert result(minhash_dedup.near_duplicates(nothing)) == []


def test_similarities_around_the_threshold(spark):
    """Few edits to texts of 6 to 400 words: links just above and just below 85 %."""
    draw = np.random.default_rng(5)
    rows = []
    for group in range(120):
        n = int(draw.integers(6, 400))
        base = [f"g{group}w{draw.integers(60)}" for _ in range(n)]
        for _ in range(4):
            rows.append((len(rows), " ".join(edited(draw, base, min(n, int(draw.integers(0, max(2, n // 25))))))))
    assert result(minhash_dedup.near_duplicates(table(spark, rows))) == brute(rows)


@pytest.mark.parametrize("copies, edits", [(150, 1), (120, 3), (100, 5)])
def test_one_large_group(spark, copies, edits):
    """Copies that are linked with their source, but (with most edits) not with each other."""
    draw = np.random.default_rng(edits)
    base = [f"w{draw.integers(900)}" for _ in range(160)]
    rows = [(1000 - i, " ".join(edited(draw, base, edits if i else 0))) for i in range(copies)]
    assert result(minhash_dedup.near_duplicates(table(spark, rows))) == brute(rows)


def test_a_chain_is_one_component(spark):
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[3 * i:3 * i + 100])) for i in range(90)]
    got = result(minhash_dedup.near_duplicates(table(spark, rows)))
    assert got == brute(rows) and {r[2] for r in got} == {0}


def test_pairs_stay_few_under_a_shared_passage(spark):
    """A passage of half of every text: pairs that reach the sets grow in proportion."""
    draw = np.random.default_rng(2)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, passage + " " + " ".join(f"x{draw.integers(1 << 40)}" for _ in range(60))) for i in range(3000)]
    signed = minhash_dedup.signed_rows(table(spark, rows).withColumnRenamed("doc_id", "id"))
    classes = signed.select("class", "size", "bands").cache()
    keyed = classes.selectExpr("class", "posexplode(bands)").selectExpr("xxhash64(pos, col) as key", "class")
    buckets = minhash_dedup.buckets_of(keyed).cache()
    crowded = keyed.join(buckets.where("crowded").selectExpr("key", "element_at(members, 1) as hub"), "key")
    pairs = minhash_dedup.member_pairs(buckets).unionAll(minhash_dedup.star(crowded, "hub")).distinct()
    assert pairs.count() < 40 * len(rows)
    assert minhash_dedup.plausible(pairs, classes).count() == 0
    assert {r[2] for r in result(minhash_dedup.near_duplicates(table(spark, rows)))} == set(range(3000))


def test_buckets_keep_every_member_or_say_so(spark):
    rows = [(k, c) for k, n in enumerate((1, 2, 3, 5, 9, 40)) for c in range(n)]
    for r in minhash_dedup.buckets_of(spark.createDataFrame(rows, "key bigint, class bigint")).collect():
        assert r.n == (1, 2, 3, 5, 9, 40)[r.key] and r.members[0] == 0 and len(r.members) <= 2 * minhash_dedup.SLICES
        assert r.crowded == (len(r.members) < r.n) and (r.n > 5 or not r.crowded or r.n > 2 * minhash_dedup.SLICES)


def test_signatures_estimate_similarity():
    """The share of agreeing coordinates: unbiased but for the bits that are dropped, and
    no wider than that of independent permutations."""
    draw = np.random.default_rng(0)
    error = []
    for _ in range(150):
        both, own = int(draw.integers(20, 300)), int(draw.integers(1, 60))
        pool = draw.integers(0, 1 << 48, both + 2 * own).astype(np.uint64)
        a, b = np.sort(pool[:both + own]), np.sort(np.concatenate([pool[:both], pool[both + own:]]))
        signs = minhash_dedup.signatures_of(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
        s = both / (both + 2 * own)
        expected = s + (1 - s) / 256
        error.append(((signs[0] == signs[1]).mean() - expected) / (expected * (1 - expected) / minhash_dedup.COORDINATES) ** .5)
    assert abs(np.mean(error)) < 0.3 and 0.8 < np.std(error) < 1.2


def test_orders_are_permutations():
    places = np.arange(1 << 20, dtype=np.uint32) * np.uint32(4096) + np.uint32(7)
    assert len(np.unique(minhash_dedup.order(places.copy(), np.empty_like(places)))) == 1 << 20


def test_members_without_a_link_are_closed_one_by_one(spark):
    """Copies that agree in bands but differ by too much: each has elements of its own, so
    no pairs of them are left to compare; a pair that shares its edits is found."""
    draw = np.random.default_rng(9)
    base = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(edited(draw, base, 7))) for i in range(400)]
    twin = edited(draw, base, 7)
    rows += [(1000, " ".join(twin)), (1001, " ".join(edited(draw, twin, 2)))]
    assert result(minhash_dedup.near_duplicates(table(spark, rows))) == brute(rows)
    sets = {i: shingles(t) for i, t in rows}
    keyed = [(hash(e) & 0xFFFFFFFFFFFF, i) for i, s in sets.items() for e in s]
    rare = minhash_dedup.members_of(spark.createDataFrame(keyed, "key bigint, class bigint")).where("not crowded")
    opened = spark.createDataFrame([(5, i, i, 0) for i in sets], "key bigint, class bigint, component bigint, main bigint")
    classes = spark.createDataFrame([(i, len(s)) for i, s in sets.items()], "class bigint, size bigint")
    left = minhash_dedup.with_common(opened, classes, rare, minhash_dedup.LINKED)
    assert left.count() < 20 and minhash_dedup.others_of_key(left, minhash_dedup.LINKED).count() < 20


def test_a_class_meets_few_hubs_however_many_buckets_it_is_in(spark):
    """Members of a group of copies share most of their 48 buckets; the rows joined are two a class."""
    crowded = spark.createDataFrame([(key, c) for key in range(48) for c in range(key % 3, 300)], "key bigint, class bigint")
    few = minhash_dedup.few_keys(crowded).collect()
    assert len(few) <= 2 * 300 and {r["class"] for r in few} == set(range(300))
    hubs = {r.key: r.hub for r in minhash_dedup.central(crowded).collect()}
    assert set(hubs) == set(range(48)) and all(h >= 2 for h in hubs.values())  # classes 0 and 1 are in fewer
    draw = np.random.default_rng(4)
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(edited(draw, base, 2 + i % 4))) for i in range(150)]
    assert result(minhash_dedup.near_duplicates(table(spark, rows))) == brute(rows)
