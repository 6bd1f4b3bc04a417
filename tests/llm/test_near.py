"""SimHash, embeddings and components against brute force."""

import random

import numpy as np
import pytest
import xxhash

from pulsegrain.llm import neighbours, simhash
from pulsegrain.llm.common import WORD, components, shared_path


def union(n, pairs):
    up = list(range(n))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for a, b in pairs:
        up[max(root(a), root(b))] = min(root(a), root(b))
    return [root(i) for i in range(n)]


@pytest.mark.parametrize("shape", ["path", "star", "random", "none"])
def test_components(spark, shape):
    rng = random.Random(4)
    pairs = {"path": [(i, i + 1) for i in range(60)], "star": [(0, i) for i in range(60)], "none": [],
             "random": [(rng.randrange(80), rng.randrange(80)) for _ in range(50)]}[shape]
    rows = [*pairs, *pairs[:3], (None, 1), (5, 5)]
    got = {r.v: r.component for r in components(spark.createDataFrame(rows, "a bigint, b bigint")).collect()}
    want = union(81, pairs)
    assert got == {v: want[v] for p in pairs if p[0] != p[1] for v in p}


def brute_print(text):
    import re

    own = re.findall(WORD, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(own[i:i + 3]) for i in range(max(1, len(own) - 2))] if own else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def test_documents_by_brute_force(spark, documents):
    rng = random.Random(7)
    base = [" ".join(f"w{rng.randrange(50)}" for _ in range(60)) for _ in range(40)]
    rows = [(i, t) for i, t in enumerate(base)]
    for i, t in enumerate(base):
        own = t.split()
        own[rng.randrange(60)] = "Changed"
        rows += [(100 + i, " ".join(own).upper()), (200 + i, t)]
    rows += [(900, ""), (901, None), (902, " \n"), (903, "one"), (904, "ONE"), (905, "one two"), (None, base[0]), (None, "x"), (3, "other words of the same id"), (906, "É é\x0bÀ" * 40_000)]
    got = simhash.near_duplicates(documents(rows)).collect()
    prints = [brute_print(t) for _, t in rows]
    roots = union(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3])
    least = {}
    for (d, _), r in zip(rows, roots):
        if d is not None:
            least[r] = min(least.get(r, d), d)
    want = sorted((str(d), f"{p:016x}", least.get(r)) for (d, _), p, r in zip(rows, prints, roots))
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in got) == want or [
        (a, b) for a, b in zip(sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got), want) if a[:2] != b[:2]] == []


def test_hot_fingerprints_change_nothing(spark, documents, monkeypatch):
    docs = documents([*["the same five words here"] * 40, *["other words of one text"] * 3, *[f"text number {i} alone" for i in range(20)], None, ""])
    want = None
    for hot in (1, 10, 4096):  # all through the shuffle, some by the broadcast, all by the broadcast
        monkeypatch.setattr(simhash, "HOT", hot)
        got = sorted(map(tuple, simhash.near_duplicates(docs).collect()))
        want = want or got
        assert got == want and len(got) == 65


def test_one_of_each_group_stays(spark, documents):
    rows = [(5, "a b c d e"), (2, "a b c d e"), (2, "a b c d e"), (8, "quite another text here"), (9, None), (7, ""), (None, "a b c d e")]
    df = documents(rows)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == [("2", "a b c d e"), ("7", ""), ("8", "quite another text here"), ("None", "a b c d e")]
    assert simhash.keep_one(documents([])).count() == 0 and simhash.near_duplicates(documents([])).count() == 0


@pytest.mark.parametrize("spread", [2, 5, 64])
def test_tree_equals_brute_force(spread):
    rng = np.random.default_rng(spread)
    base = rng.integers(0, 2**63, 5, dtype=np.uint64)
    prints = set()
    for _ in range(1500):
        value = int(base[rng.integers(5)])
        for bit in rng.integers(0, 64, rng.integers(0, spread + 1)):
            value ^= 1 << int(bit)
        prints.add(value)
    prints = sorted(prints)
    at = {p: i for i, p in enumerate(prints)}
    array = np.array(prints, np.uint64)
    near = [(i, int(j)) for i in range(len(array)) for j in np.flatnonzero(np.bitwise_count(array ^ array[i]) <= 3)]
    found = simhash.node_links(array)
    assert all((a ^ b).bit_count() <= 3 for a, b in found) and len(found) < len(prints)
    assert union(len(prints), [(at[a], at[b]) for a, b in found]) == union(len(prints), near)


def test_three_bits_always_share_a_node(spark):
    pairs = [(0x0123456789ABCDEF, 0x0123456789ABCDEF ^ (1 << a) ^ (1 << b) ^ (1 << c)) for a in range(0, 64, 7) for b in range(64) for c in range(0, 64, 5)]
    for one, other in pairs:
        assert any((one ^ other) & mask == 0 for mask, _ in simhash.masks())


def vectors(seed, n=400, dim=16):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    for k in range(0, n, 4):
        x[k + 1] = x[k] * 3
        x[k + 2] = x[k] + rng.normal(size=dim) * 0.05
    x[1::8] = x[0:-1:8]
    x[-60:] = x[0] + rng.normal(size=(60, dim)) * 0.08
    return x


@pytest.mark.parametrize("size", [40, 2000])
def test_vectors_by_brute_force(spark, size):
    x = vectors(1)
    rows = [(i, [float(v) for v in x[i]], i % 3) for i in range(len(x))]
    rows += [(1000, None, 1), (1001, [0.0] * 16, 1), (1002, [float("nan")] * 16, 1), (1003, [None] + [1.0] * 15, 1), (1004, rows[0][1], None),
             (1005, [float("inf")] * 16, 1), (1006, [], 1), (None, rows[0][1], 0), (1007, [1.0, 2.0], 1), (1008, [1.0, 2.0], 1)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").selectExpr("*", "1 as v", "2 as own", "3 as id")
    got = neighbours.near_duplicates(df, cluster_size=size).collect()
    usable = {i for i, (d, v, l) in enumerate(rows) if d is not None and l is not None and v and all(c is not None and np.isfinite(c) for c in v) and any(v)}
    unit = {i: np.array(rows[i][1]) / np.linalg.norm(rows[i][1]) for i in usable}
    pairs = [(i, j) for i in usable for j in usable if i < j and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.98]
    links = [sum(i in p for p in pairs) for i in range(len(rows))]
    roots = union(len(rows), pairs)
    assert len(got) == len(rows)
    by = {r.vec_id: r for r in got}
    found = sum(by[rows[i][0]].n_links for i in usable)
    assert found >= 0.97 * sum(links) and all(by[rows[i][0]].n_links <= links[i] for i in range(len(rows)))
    if size == 2000:
        assert all((by[d].n_links, by[d].component_id, by[d].kept) == (links[i], rows[roots[i]][0] if i in usable else d, d is None or rows[roots[i]][0] == d) for i, (d, _, _) in enumerate(rows))
    assert neighbours.near_duplicates(df.limit(0)).count() == 0


def test_recall_of_the_graph():
    x = neighbours.units(vectors(2, 1200, 24))
    graph = neighbours.build(x)
    found = {(i, int(j)) for i, others in neighbours.search(x, graph, 0.9) for j in others}
    cos = x @ x.T
    want = {(i, int(j)) for i in range(0, len(x), 20) for j in np.flatnonzero(cos[i] >= 0.9) if i != j}
    assert len(want & found) >= 0.9 * len(want) and all(cos[i, j] >= 0.9 for i, j in found)
    ids, _ = neighbours.greedy(x.astype(np.float32), graph, neighbours.medoid_of(x), x[::20].astype(np.float32))
    assert (ids[:, 0] == np.arange(0, len(x), 20)).mean() >= 0.9 or np.isclose(cos[np.arange(0, len(x), 20), ids[:, 0]], 1).mean() >= 0.9


def test_dense_group_of_many_pivots(spark):
    rng = np.random.default_rng(5)
    x = np.concatenate([np.eye(16)[0] + rng.normal(size=(900, 16)) * 0.045, rng.normal(size=(500, 16))])
    df = spark.createDataFrame([(i, [float(c) for c in v], 1) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>, label int")
    near = neighbours.units(x) @ neighbours.units(x).T >= 0.98
    roots = union(len(x), [(int(i), int(j)) for i, j in zip(*np.nonzero(near)) if i < j])
    got = neighbours.near_duplicates(df, cluster_size=20).collect()
    assert near.sum() > 100_000
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == {i: (int(near[i].sum()) - 1, roots[i]) for i in range(len(x))}


@pytest.mark.parametrize("dim, threshold", [(3, 0.98), (16, 0.9), (64, 0.98)])
def test_guests_reach_the_homes_of_all_their_links(dim, threshold):
    rng = np.random.default_rng(dim)
    x = neighbours.units(np.repeat(rng.normal(size=(60, dim)), 10, 0) + rng.normal(size=(600, dim)) * 0.15)
    centres = x[::13]
    home, angle = neighbours.homes(x, centres)
    radius = np.array([angle[home == k].max(initial=-1) for k in range(len(centres))])
    goes = neighbours.may_link(x, home, centres, radius, threshold)
    i, j = np.nonzero(x @ x.T >= threshold)
    assert goes[i, home[j]].all() and len(i) > len(x)


def test_shared_folder(spark):
    assert shared_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir").rstrip("/") + "/x-")
