import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from kotonoha.llm import simhash
from tests.llm.helpers import empty_documents, odd_documents, prose


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, bits=2):
    n = len(prints)
    label = list(range(n))
    changed = True
    while changed:
        changed = False
        for a in range(n):
            for b in range(n):
                if (prints[a] ^ prints[b]).bit_count() <= bits and label[b] < label[a]:
                    label[a] = label[b]
                    changed = True
    return label


def test_fingerprints(spark):
    texts = [None, "", "One", "one TWO", "One two three", "a b a b a b a b", prose(1, 300), "É é x y z"]
    assert [simhash.fingerprint(t) for t in texts] == [plain_fingerprint(t) for t in texts]
    docs = spark.createDataFrame([(0, "one two three")], "doc_id long, text string")
    native = docs.selectExpr("xxhash64(text) AS h").first()["h"]
    assert simhash.fingerprint("one two three") == native & (1 << 64) - 1


def near_points(rng, n):
    centres = rng.integers(0, 1 << 63, max(1, n // 6), np.uint64)
    points = centres[rng.integers(0, len(centres), n)]
    for _ in range(2):
        points = points ^ (np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64))
    return np.unique(points)


def joined(members, roots, points):
    parent = {int(p): int(p) for p in points}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in zip(members.tolist(), roots.tolist(), strict=True):
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return [top(int(p)) for p in points]


def brute(points, bits):
    label = {int(p): int(p) for p in points}
    near = np.bitwise_count(points[:, None] ^ points[None, :]) <= bits
    a, b = np.nonzero(near)
    return joined(points[a], points[b], points), label


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 10**6), st.sampled_from([0, 1, 2, 3]))
def test_local_trees_lose_no_link(seed, bits):
    points = near_points(np.random.default_rng(seed), 200)
    old, simhash.BLOCK = simhash.BLOCK, 16
    try:
        members, roots = simhash.shard_links(points, bits)
    finally:
        simhash.BLOCK = old
    assert joined(members, roots, points) == brute(points, bits)[0]


def test_shard_tree_loses_no_link():
    points = near_points(np.random.default_rng(5), 3000)
    nodes = simhash.fit_tree(points[::3], 40, 2)
    assert len(nodes) > 5
    rows, shards = simhash.route(nodes, points, 2)
    member, root = [], []
    for s in np.unique(shards):
        m, r = simhash.shard_links(points[rows[shards == s]], 2)
        member.append(m)
        root.append(r)
    assert joined(np.concatenate(member), np.concatenate(root), points) == brute(points, 2)[0]


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(40)] + [(100, 99)], "_a long, _b long")
    found = {r["_node"]: r["_root"] for r in simhash.components(edges).collect()}
    assert found == {**{i: 0 for i in range(41)}, 99: 99, 100: 99}


def test_near_duplicates_equal_brute_force(spark):
    texts = [prose(i // 4, 150) for i in range(60)]
    texts = [t if i % 4 == 0 else t.replace("w1", "w2", i % 4) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([(100 - i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    found = {r["doc_id"]: r for r in simhash.near_duplicates(docs).collect()}
    prints = [plain_fingerprint(t) for t in texts[::-1]]
    labels = plain_components(prints)
    for k, (p, label) in enumerate(zip(prints, labels, strict=True)):
        row = found[41 + k]
        assert row["fingerprint"] == f"{p:016x}"
        assert row["component_id"] == 41 + label
    kept = {r["doc_id"] for r in simhash.keep_first(docs).collect()}
    assert kept == {41 + label for label in labels}


def test_odd_rows(spark):
    docs = odd_documents(spark, [(9, "a text without an id, and a few more words in it", "en", "a", 1), (None, "lone", "x", "y", 4), (None, "lone", "x", "y", 4)])
    found = simhash.near_duplicates(docs).collect()
    assert len(found) == docs.count()
    by_id = {r["doc_id"]: r for r in found if r["doc_id"]}
    assert {by_id[k]["component_id"] for k in (2, 3, 4)} == {2}
    assert by_id[2]["fingerprint"] == "0" * 16
    assert sorted((r["component_id"] or 0) for r in found if r["doc_id"] is None) == [0, 0, 9]
    kept = simhash.keep_first(docs)
    assert kept.schema == docs.schema
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 2, 5, 6, 7, 8, 9]
    assert simhash.near_duplicates(empty_documents(spark)).count() == 0
    assert simhash.keep_first(empty_documents(spark)).count() == 0
