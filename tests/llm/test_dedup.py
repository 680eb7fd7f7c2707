"""Exact dedup and the n-gram Jaccard join against brute force."""

import collections
import hashlib
import random

import numpy as np
import pytest

from tessera.llm import exact_dedup, jaccard_join

DOCS = "doc_id long, text string, digest string, winner int, _text_hash int"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], DOCS)


def test_hash_is_minimal_and_perfect():
    digests = [hashlib.sha256(str(i).encode()).digest() for i in range(3000)]
    keys = exact_dedup._words(digests)
    sizes, bits = exact_dedup.build_hash(keys)
    assert sorted(exact_dedup.slots_of(keys, sizes, bits)) == list(range(3000))
    assert exact_dedup.build_hash(keys[:0])[0] == []


def test_lookup_checks_all_bytes(spark):
    held = docs(spark, [(i, f"t{i}") for i in range(500)])
    index = exact_dedup.build_index(exact_dedup.per_digest(exact_dedup.digests(held)), 3)
    batch = exact_dedup.per_digest(exact_dedup.digests(docs(spark, [(1000 + i, f"t{i}") for i in range(400, 900)])))
    found = exact_dedup.lookup(batch, index, 3).collect()
    assert len(found) == 500
    for r in found:
        i = r["winner"] - 1000
        assert (r["old_winner"], r["old_copies"]) == ((i, 1) if i < 500 else (None, 0))


@pytest.mark.parametrize("seed", [1, 2])
def test_exact_dedup_is_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.randrange(300) if rng.random() > 0.05 else None, rng.choice([None, "", "a", "A", "é", "b" * 50_000, str(rng.random())]))
            for _ in range(400)]
    got = exact_dedup.exact_dedup(docs(spark, rows)).collect()
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    assert len(got) == len(rows)
    assert (collections.Counter((r["doc_id"], r["text_sha256"]) for r in got)
            == collections.Counter((i, hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows))
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for r in got:
        ids = by_sha[r["text_sha256"]]
        assert r["group_size"] == len(ids)
        assert r["keep_id"] == max((i for i in ids if i is not None), default=None)
    assert sum(r["kept"] for r in got) == len(groups)
    assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])


def test_exact_dedup_of_nothing_and_of_one_side(spark):
    assert exact_dedup.exact_dedup(docs(spark, [])).count() == 0
    assert exact_dedup.exact_dedup(docs(spark, [(None, "a"), (None, "a")])).filter("kept").count() == 1


@pytest.mark.parametrize("ids", ["skewed", "null"])
def test_shards_of_the_batch_are_bounded(spark, monkeypatch, ids):
    rows = [(0 if i == 0 else 10**12 + i, f"t{i % 900}") for i in range(1000)]
    rows = [(None if ids == "null" else i, t) for i, t in rows]
    seen, lookup = [], exact_dedup.lookup

    def spy(batch, index, shards):
        seen.append((shards, max(r["count"] for r in exact_dedup._sharded(batch, shards).groupBy("shard").count().collect())))
        return lookup(batch, index, shards)
    monkeypatch.setattr(exact_dedup, "SHARD_KEYS", 50)
    monkeypatch.setattr(exact_dedup, "lookup", spy)
    got = exact_dedup.exact_dedup(docs(spark, rows)).collect()
    assert [s for s, _ in seen] == [18] and seen[0][1] <= 100
    assert len(got) == 1000 and sum(r["kept"] for r in got) == 900
    assert collections.Counter(r["group_size"] for r in got) == {1: 800, 2: 200}


def test_one_of_each_keeps_columns(spark):
    d = docs(spark, [(1, "a"), (2, "a"), (2, "a"), (3, None), (4, "")])
    out = exact_dedup.one_of_each(d)
    assert out.columns == d.columns
    assert sorted(r["doc_id"] for r in out.collect()) == [2, 4]


def shingle_set(text):
    w = (text or "").split()
    return frozenset(tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows):
    """doc_id -> (class_id, links, class_size, set_id)"""
    ids, named = collections.defaultdict(list), collections.defaultdict(set)
    for i, t in rows:
        ids[shingle_set(t)].append(i)
        named[shingle_set(t)].add(t or "")
    sets, parent = list(ids), list(range(len(ids)))

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a
    # Links are between different texts: those of the own set, too.
    texts = [len(named[x]) for x in sets]
    links = collections.Counter({a: n - 1 for a, n in enumerate(texts)})
    for a, x in enumerate(sets):
        for b in range(a):
            common = len(x & sets[b])
            union = len(x) + len(sets[b]) - common
            if union and common >= 0.8 * union - 1e-9:
                links[a] += texts[b]
                links[b] += texts[a]
                parent[root(a)] = root(b)
    members = collections.defaultdict(list)
    for a, x in enumerate(sets):
        members[root(a)] += ids[x]
    return {i: (max(members[root(a)]), links[a], len(members[root(a)]), max(ids[x]))
            for a, x in enumerate(sets) for i in ids[x]}


def near_copies(rng, words, n, changes):
    out = []
    for _ in range(n):
        w = list(words)
        for _ in range(rng.randint(0, changes)):
            w[rng.randrange(len(w))] = f"z{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def check(spark, rows):
    want = brute(rows)
    got = jaccard_join.jaccard_join(docs(spark, rows)).collect()
    assert {r["doc_id"]: (r["class_id"], r["links"], r["class_size"], r["set_id"]) for r in got} == want
    return got


def test_jaccard_join_is_brute_force(spark):
    rng = random.Random(5)
    texts = [None, "", "one two", "one two", "a b c d e", "  a b\tc d\ne "]
    for _ in range(25):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.randint(20, 300))]
        texts += near_copies(rng, words, rng.randint(1, 6), rng.choice([0, 2, 6]))
    passage = " ".join(f"p{i}" for i in range(60))       # a passage that many texts share is no link
    texts += [passage + " " + " ".join(f"q{rng.randrange(10**6)}" for _ in range(60)) for _ in range(60)]
    got = check(spark, list(enumerate(texts)))
    assert sum(r["stays"] for r in got) == len({r["class_id"] for r in got})


def test_large_groups_are_split(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "LEAF", 64)
    rng = random.Random(6)
    words = [f"w{i}" for i in range(150)]
    texts = near_copies(rng, words, 300, 3)               # a dense node, cut into blocks
    passage = [f"p{i}" for i in range(60)]                # a node that the tree splits on
    texts += [" ".join(passage + [f"q{rng.randrange(10**6)}" for _ in range(60)]) for _ in range(200)]
    texts += near_copies(rng, passage + [f"r{i}" for i in range(60)], 5, 2)
    check(spark, list(enumerate(texts)))


def test_similar_of_wide_sets(monkeypatch):
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 60, rng.integers(0, 50)).astype(np.uint64)) for _ in range(60)]
    sets += [s[1:] for s in sets[:20]]
    narrow = [h.tolist() for _, h in jaccard_join.similar(sets)]
    monkeypatch.setattr(jaccard_join, "CELLS", 0)
    assert [h.tolist() for _, h in jaccard_join.similar(sets)] == narrow and any(narrow)
    assert narrow[0] == [j for j, s in enumerate(sets) if j and len(set(s) | set(sets[0]))
                         and len(set(s) & set(sets[0])) >= 0.8 * len(set(s) | set(sets[0]))]


def test_jaccard_join_empty_and_columns(spark):
    assert jaccard_join.jaccard_join(docs(spark, [])).count() == 0
    d = docs(spark, [(1, "a b c d e f"), (1, "a b c d e f"), (None, "g h"), (7, "a b c d e f")])
    out = jaccard_join.one_of_each(d)
    assert out.columns == d.columns
    assert sorted((r["doc_id"] or -1) for r in out.collect()) == [-1, 7]


def test_runs_reach_recall():
    n = jaccard_join.runs_for(0.9999, 0.8)
    assert 3 <= n <= 12 and jaccard_join.runs_for(0.9, 0.8) < n


def test_embedding_estimates_similarity():
    a = np.unique(np.random.default_rng(1).integers(0, 2**63, 2000).astype(np.uint64))
    flat, offsets = np.concatenate([a[:1800], a[200:]]), np.array([0, 1800, 1800 + len(a) - 200])
    x, y = jaccard_join.embed(flat, offsets)
    assert abs((x == y).mean() - 0.8) < 0.2
