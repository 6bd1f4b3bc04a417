"""Near-duplicate embeddings by robust-pruned flat graphs.

Equal vectors of a label are one vertex with a count. The home of a vertex is the cluster of its best pivot (of a bounded
sample of its label); it is a guest of every other cluster whose pivot is not much farther than that of its home. How much is
audited: a bounded sample of vertices is compared with all of their label, in blocks, and the smallest margin that leads the
sample to the homes of its links is taken, up to the one that no link can break. So there is no cap on the clusters of a
vertex, and what the graphs find is audited by the same sample; if it is too little, all clusters are counted in blocks. Each cluster
builds a graph by itself: every vertex is searched for in the graph so far, and of what the search meets the robust prune
keeps neighbours in different directions. A vertex's lists from all its clusters are united and the graphs searched again:
greedy from the medoid, then outwards over the whole range of near vectors. Links are verified in double precision; inside
what links connect, a cluster counts all pairs of its own vertices exactly. A cluster of too many vertices has no graph:
it is cut into pairs of blocks, a task for each, and all cosines are computed. Pairs are never emitted: a task returns each
vertex's count and one edge of a spanning forest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrain.llm.common import components, stored

THRESHOLD = 0.98
#: Vertices of a cluster, on the mean, and pivots in all, at most: the sample that the clusters are fitted on.
CLUSTER, MOST_PIVOTS = 2_000, 4_096
#: In cluster sizes: vertices with guests from which on a cluster is cut into blocks, and vertices of a block, on the mean.
MOST_GRAPH, BLOCK = 4, 2
DEGREE, BEAM, ALPHA = 20, 40, 1.2
#: Vertices that are audited, about; margins that are tried, and the one that is taken if no vertex of the sample has a link; parts of
#: the sample's links whose home a margin must reach, and that must be found in the end.
AUDITED, MARGINS, PLAIN_MARGIN, LEAST_REACH, LEAST_RECALL = 512, (0.05, 0.075, 0.1, 0.125, 0.15), 0.1, 1.0, 0.95
#: Range in which the search goes on from what it has found.
SLACK = 0.05
_BATCH = 256


def units(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


# ---- one cluster's graph --------------------------------------------------------------------------------------------

def greedy(x: np.ndarray, adjacent: np.ndarray, medoid: int, queries: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
    """The ``beam`` best vertices met on the way from the medoid to each query: (ids, cosines), best first, -1 for none."""
    q = len(queries)
    ids = np.full((q, beam), -1, np.int32)
    sims = np.full((q, beam), -np.inf, np.float32)
    done = np.ones((q, beam), bool)
    ids[:, 0], sims[:, 0], done[:, 0] = medoid, queries @ x[medoid], False
    live = np.arange(q)
    while len(live):
        open_sims = np.where(done[live], -np.inf, sims[live])
        at = open_sims.argmax(1)
        going = open_sims[np.arange(len(live)), at] > -np.inf
        live, at = live[going], at[going]
        if not len(live):
            break
        done[live, at] = True
        near = adjacent[ids[live, at]]
        cosines = np.matmul(x[near], queries[live][:, :, None])[:, :, 0]
        known = (near[:, :, None] == ids[live][:, None, :]).any(2) | (near < 0)
        cosines[known] = -np.inf
        all_ids, all_sims = np.concatenate([ids[live], near], 1), np.concatenate([sims[live], cosines], 1)
        all_done = np.concatenate([done[live], np.zeros(near.shape, bool)], 1)
        best = np.argpartition(-all_sims, beam - 1, axis=1)[:, :beam]
        ids[live] = np.take_along_axis(all_ids, best, 1)
        sims[live] = np.take_along_axis(all_sims, best, 1)
        done[live] = np.take_along_axis(all_done, best, 1) | (sims[live] == -np.inf)
    order = np.argsort(-sims, axis=1, kind="stable")
    ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
    ids[sims == -np.inf] = -1
    return ids, sims


def robust_prune(x: np.ndarray, points: np.ndarray, candidates: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA) -> np.ndarray:
    """For each point up to ``degree`` of its candidates (-1 for none), none much nearer to a chosen one than to the point."""
    own = points[:, None]
    cand = candidates.copy()
    cand[cand == own] = -1
    away = np.where(cand < 0, np.inf, 1 - np.matmul(x[cand], x[points][:, :, None])[:, :, 0])
    order = np.argsort(away, axis=1, kind="stable")
    cand, away = np.take_along_axis(cand, order, 1), np.take_along_axis(away, order, 1)
    repeated = np.zeros(cand.shape, bool)
    by_id = np.argsort(cand, axis=1, kind="stable")
    sorted_ids = np.take_along_axis(cand, by_id, 1)
    np.put_along_axis(repeated, by_id[:, 1:], sorted_ids[:, 1:] == sorted_ids[:, :-1], 1)
    away[repeated] = np.inf
    out = np.full((len(points), degree), -1, np.int32)
    rows = np.arange(len(points))
    vectors = x[cand]
    for k in range(degree):
        at = away.argmin(1)
        some = away[rows, at] < np.inf
        if not some.any():
            break
        chosen = np.where(some, cand[rows, at], -1)
        out[:, k] = chosen
        between = 1 - np.matmul(vectors, x[chosen][:, :, None])[:, :, 0]
        # Half of a squared distance is one minus a cosine, hence the square of alpha.
        away[(alpha * alpha * between <= away) & some[:, None]] = np.inf
        away[rows[some], at[some]] = np.inf
    return out


def medoid_of(x: np.ndarray) -> int:
    return int((x @ x.mean(0)).argmax())


def build(x: np.ndarray, seed: int = 0, degree: int = DEGREE, beam: int = BEAM) -> np.ndarray:
    """Adjacency lists (rows, -1 for none) over unit vectors: vertices are inserted in batches, in a random order."""
    n, rng = len(x), np.random.default_rng(seed)
    if n == 1:
        return np.full((1, degree), -1, np.int32)
    x = x.astype(np.float32)
    adjacent = np.full((n, degree), -1, np.int32)
    filled = np.zeros(n, np.int64)
    medoid, order = medoid_of(x), rng.permutation(n)
    order = np.r_[medoid, order[order != medoid]]
    for at in range(0, n, _BATCH):
        batch = order[at:at + _BATCH]
        found, _ = greedy(x, adjacent, medoid, x[batch], beam)
        # Vertices of one batch cannot meet each other in the graph yet; they are candidates by themselves.
        close = np.argsort(-(x[batch] @ x[batch].T), axis=1)[:, :beam // 2]
        mine = robust_prune(x, batch, np.concatenate([found, batch[close].astype(np.int32), adjacent[batch]], 1), degree)
        adjacent[batch] = mine
        filled[batch] = (mine >= 0).sum(1)
        # Edges back, as many as there is room for; full vertices choose anew among all.
        heads, tails = mine[mine >= 0], np.repeat(batch, (mine >= 0).sum(1))
        by_head = np.argsort(heads, kind="stable")
        heads, tails = heads[by_head], tails[by_head]
        targets, first, counts = np.unique(heads, return_index=True, return_counts=True)
        width = int(counts.max()) if len(counts) else 0
        if width:
            back = np.full((len(targets), width), -1, np.int32)
            back[np.repeat(np.arange(len(targets)), counts), np.arange(len(heads)) - np.repeat(first, counts)] = tails
            for part in range(0, len(targets), _BATCH):
                t = targets[part:part + _BATCH]
                chosen = robust_prune(x, t, np.concatenate([adjacent[t], back[part:part + _BATCH]], 1), degree)
                adjacent[t] = chosen
                filled[t] = (chosen >= 0).sum(1)
    return adjacent


def in_range(x: np.ndarray, adjacent: np.ndarray, seeds: np.ndarray, query: np.ndarray, least: float) -> np.ndarray:
    """Vertices with a cosine of ``least`` or more that the graph leads to from ``seeds`` over such vertices."""
    seen = np.zeros(len(x), bool)
    seen[seeds] = True
    out, front = [seeds], seeds
    while len(front):
        near = np.unique(adjacent[front])
        near = near[(near >= 0) & ~seen[near]]
        seen[near] = True
        front = near[x[near] @ query >= least]
        out.append(front)
    return np.concatenate(out)


def search(x: np.ndarray, adjacent: np.ndarray, threshold: float, beam: int = BEAM, slack: float = SLACK) -> Iterator[tuple[int, np.ndarray]]:
    """Each vertex with the vertices that the graph leads to and that are within the threshold, itself excluded."""
    small = x.astype(np.float32)
    medoid = medoid_of(small)
    for at in range(0, len(x), _BATCH):
        ids, sims = greedy(small, adjacent, medoid, small[at:at + _BATCH], beam)
        for k in range(len(ids)):
            near = ids[k][(ids[k] >= 0) & (sims[k] >= threshold - slack)]
            if len(near) > 1:
                near = in_range(small, adjacent, near, small[at + k], threshold - slack)
            elif not len(near):
                near = in_range(small, adjacent, np.array([at + k]), small[at + k], threshold - slack)
            near = near[near != at + k]
            if len(near):
                yield at + k, near[x[near] @ x[at + k] >= threshold]


def forest(n: int, pairs: Iterator[tuple[int, np.ndarray]]) -> np.ndarray:
    """The smallest vertex of each vertex's component."""
    up = np.arange(n)

    def root(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return int(i)

    for i, others in pairs:
        for r in {root(int(j)) for j in others}:
            a, b = root(i), r
            up[max(a, b)] = min(a, b)
    return np.array([root(i) for i in range(n)], np.int64)


def own_degrees(x: np.ndarray, roots: np.ndarray, own: np.ndarray, counts: np.ndarray, threshold: float) -> np.ndarray:
    """Vectors that each vertex of ``own`` links with in its component; 0 for guests, which are counted at home."""
    out = np.zeros(len(x), np.int64)
    order = np.argsort(roots, kind="stable")
    cuts = np.flatnonzero(np.r_[True, roots[order][1:] != roots[order][:-1]])
    for a, b in zip(cuts.tolist(), np.r_[cuts[1:], len(order)].tolist()):
        part = order[a:b]
        mine = part[own[part]]
        for at in range(0, len(mine) if b - a > 1 else 0, _BATCH):
            rows = mine[at:at + _BATCH]
            near = (x[rows] @ x[part].T >= threshold) & (rows[:, None] != part[None, :])
            out[rows] = near @ counts[part]
    return out


def block_links(x: np.ndarray, ids: np.ndarray, own: np.ndarray, counts: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vertices (ids, rising), how many vectors of the others each of ``own`` links with, and the smallest id of their components.

    All cosines of rows that are ``own`` with those that are not are computed; a vertex may be there as both.
    """
    nodes, place = np.unique(ids, return_inverse=True)
    mine, others = np.flatnonzero(own), np.flatnonzero(~own)
    links, label, to = np.zeros(len(nodes), np.int64), np.arange(len(nodes)), place[others]
    for at in range(0, len(mine), _BATCH):
        rows = mine[at:at + _BATCH]
        near = (x[rows] @ x[others].T >= threshold) & (place[rows][:, None] != to[None, :])
        links[place[rows]] += near @ counts[others]
        # Most rows of a dense block are in one component with all they link with already.
        apart = (near & (label[to][None, :] != label[place[rows]][:, None])).any(1)
        for k in np.flatnonzero(apart):
            met = np.unique(np.r_[label[place[rows[k]]], label[to[near[k]]]])
            if len(met) > 1:
                label[np.isin(label, met)] = met[0]
    return nodes, links, nodes[label]


def thinned(names: np.ndarray, centres: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pivots without those that link with an earlier one: many in one dense group would only hold the same vectors."""
    kept: list[int] = []
    for k in range(len(names)):
        if not kept or (centres[kept] @ centres[k]).max() < threshold:
            kept.append(k)
    return names[kept], centres[kept]


def homes(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The best pivot of each vertex and the angle to it."""
    cos = x @ centres.T
    best = cos.argmax(1)
    return best, np.arccos(np.clip(cos[np.arange(len(x)), best], -1, 1))


def bound(threshold: float) -> float:
    """The margin that no link can break: the chord of the threshold's angle."""
    return float(np.sqrt(max(0.0, 2 - 2 * threshold)))


def may_link(x: np.ndarray, home: np.ndarray, centres: np.ndarray, radius: np.ndarray, threshold: float, margin: float | None = None) -> np.ndarray:
    """Which pivots (columns) may be home to a vector that a vertex (rows) links with; without a margin it never leaves one out that is.

    ``radius`` is the greatest angle of a pivot's own vertices, below 0 if it has none. Whoever is linked lies within the
    threshold's angle, so a pivot is not farther than that beyond its radius. And who is at home there is on that pivot's
    side of the plane between it and the vertex's own pivot, so the vertex is within the threshold's chord of the plane, and in many
    dimensions nearly always within a part of it, the margin.
    """
    cos, slack = x @ centres.T, 1e-9
    angle, chord = np.arccos(np.clip(threshold, -1, 1)), bound(threshold) if margin is None else margin
    least = np.cos(np.minimum(np.pi, radius + angle))
    apart = np.sqrt(np.maximum(0, 2 - 2 * (centres[home] @ centres.T)))
    rows = np.arange(len(x))
    out = (cos >= least - slack) & (cos[rows, home][:, None] - cos <= chord * apart + slack) & (radius >= 0)
    out[rows, home] = True
    return out


# ---- Spark ----------------------------------------------------------------------------------------------------------

def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, cluster_size: int = CLUSTER, most_pivots: int = MOST_PIVOTS) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of vectors (vec_id, embedding, label).

    Rows whose label, vec_id or vector is null, and vectors that are empty, zero or hold a null or non-finite component,
    link with nothing and are kept. Vectors of different lengths never link. A repeated row is another vector with the
    same vec_id and counts as a link. Other columns are ignored; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    values = F.transform(F.col("embedding").cast("array<double>"), lambda v: v)
    finite = F.forall("v", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("bigint"), values.alias("v"), F.col("label").cast("string").alias("label"))
    usable = F.coalesce(F.col("label").isNotNull() & F.col("vec_id").isNotNull() & F.exists("v", lambda v: v != 0) & finite, F.lit(False))
    classes = stored(rows.where(usable).groupBy("label", "v").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies")).withColumn(
        "label", F.concat_ws(":", F.size("v").cast("string"), "label")), "near-classes")

    # Pivots: a sample by hash for every label of more vertices than a cluster should have, and one vertex of each such
    # label in any case. Both numbers are bounded by ``most_pivots``; a smaller label is a cluster by itself.
    sizes = stored(classes.groupBy("label").agg(F.count("*").alias("n"), F.min_by(F.struct("id", "v"), F.xxhash64("id")).alias("one")), "near-sizes")
    total = int(sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    limit = max(cluster_size, -(-total // most_pivots))
    large = sizes.where(F.col("n") > limit)
    sample = classes.where(F.pmod(F.xxhash64("id", F.lit(3)), F.lit(10_000_000)) < 10_000_000 // limit).join(large.select("label"), "label")
    pivots = sample.select("label", "id", "v").union(large.select("label", "one.id", "one.v")).distinct().orderBy("id").collect()
    known: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for label in {r.label for r in pivots}:
        own = [r for r in pivots if r.label == label]
        known[label] = thinned(np.array([r.id for r in own], np.int64), units(np.array([r.v for r in own], float)), threshold)
    sent = spark.sparkContext.broadcast(known)

    def at_home(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            home, angle = pdf["home"].to_numpy(np.int64, copy=True), np.full(len(pdf), np.nan)
            for label, places in pdf.groupby("label").indices.items():
                if label in sent.value:
                    names, centres = sent.value[label]
                    for part in np.array_split(places, -(-len(places) // _BATCH)):
                        best, angle[part] = homes(units(np.stack(pdf["v"].to_numpy()[part])), centres)
                        home[part] = names[best]
            yield pdf.assign(home=home, angle=angle)

    schema = "label string, v array<double>, id bigint, copies bigint, home bigint"
    settled = stored(classes.join(sizes.select("label", F.col("one.id").alias("home")), "label").select("label", "v", "id", "copies", "home").mapInPandas(
        at_home, schema + ", angle double").withColumn("angle", F.nanvl("angle", F.lit(None).cast("double"))), "near-homes")
    # As many rows as there are pivots.
    widths = {(r.label, r.home): r.radius for r in settled.where("angle is not null").groupBy("label", "home").agg(F.max("angle").alias("radius")).collect()}
    reach = spark.sparkContext.broadcast({label: np.array([widths.get((label, int(n)), -1.0) for n in names]) for label, (names, _) in known.items()})

    # The audit: a sample by hash of the vertices of labels with pivots against all vertices of their label.
    in_parts = settled.where("angle is not null")
    n_parts = max(1, in_parts.count())
    sample = in_parts.where(F.pmod(F.xxhash64("id", F.lit(7)), F.lit(1_000_000)) < F.lit(-(-1_000_000 * AUDITED // n_parts))).select("label", "id", "v", "home").collect()
    asked: dict[str, tuple] = {}
    margins = (*(m for m in MARGINS if m < bound(threshold)), bound(threshold))
    for label in {r.label for r in sample}:
        own = [r for r in sample if r.label == label]
        x, (names, centres) = units(np.array([r.v for r in own], float)), known[label]
        home = np.searchsorted(names, [r.home for r in own])
        goes = np.stack([may_link(x, home, centres, reach.value[label], threshold, m) for m in margins])
        asked[label] = (np.array([r.id for r in own]), x, names, goes)
    questions = spark.sparkContext.broadcast(asked)

    def answer(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for label, places in pdf.groupby("label").indices.items():
                if label not in questions.value:
                    continue
                ids, x, names, goes = questions.value[label]
                links, reached = np.zeros(len(ids), np.int64), np.zeros((len(margins), len(ids)), np.int64)
                for part in np.array_split(places, -(-len(places) // _BATCH)):
                    theirs, copies = pdf["id"].to_numpy()[part], pdf["copies"].to_numpy()[part]
                    near = (x @ units(np.stack(pdf["v"].to_numpy()[part])).T >= threshold) & (ids[:, None] != theirs[None, :])
                    links += near @ copies
                    at = np.searchsorted(names, pdf["home"].to_numpy(np.int64)[part])
                    reached += np.einsum("mqn,qn,n->mq", goes[:, :, at], near, copies)
                yield pd.DataFrame({"id": ids, "links": links, "reached": list(reached.T)})

    told = in_parts.select("label", "v", "id", "copies", "home").mapInPandas(answer, "id bigint, links bigint, reached array<bigint>").groupBy("id").agg(
        F.sum("links").alias("links"), *[F.sum(F.get("reached", F.lit(k))).alias(f"m{k}") for k in range(len(margins))])
    truth = stored(told, "near-audit")
    sums = truth.agg(F.coalesce(F.sum("links"), F.lit(0)), *[F.coalesce(F.sum(f"m{k}"), F.lit(0)) for k in range(len(margins))]).first()
    margin = next((m for m, n in zip(margins, sums[1:]) if n >= LEAST_REACH * sums[0]), bound(threshold)) if sums[0] else min(PLAIN_MARGIN, bound(threshold))

    def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out: list[list[int]] = [[home] for home in pdf["home"].tolist()]
            for label, places in pdf.groupby("label").indices.items():
                if label in sent.value:
                    names, centres = sent.value[label]
                    place_of = {n: k for k, n in enumerate(names.tolist())}
                    for part in np.array_split(places, -(-len(places) // _BATCH)):
                        home = np.array([place_of[n] for n in pdf["home"].to_numpy()[part].tolist()])
                        for place, some in zip(part, may_link(units(np.stack(pdf["v"].to_numpy()[part])), home, centres, reach.value[label], threshold, margin)):
                            out[place] = names[some].tolist()
            yield pdf.assign(clusters=out)

    assigned = stored(settled.drop("angle").mapInPandas(assign, schema + ", clusters array<bigint>").select(
        "label", "v", "id", "copies", "home", F.explode("clusters").alias("cluster")), "near-assigned")

    def graph(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        ids = pdf["id"].to_numpy()
        lists = build(units(np.stack(pdf["v"].to_numpy()).astype(float)))
        return pd.DataFrame({"id": ids, "near": [ids[row[row >= 0]] for row in lists]})

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        ids = pdf["id"].to_numpy()
        x = units(np.stack(pdf["v"].to_numpy()).astype(float))
        near = [np.zeros(0, np.int64) if n is None else np.asarray(n) for n in pdf["near"]]
        places = [p[(p < len(ids)) & (ids[np.minimum(p, len(ids) - 1)] == n)] for n, p in ((n, np.searchsorted(ids, n)) for n in near)]
        adjacent = np.full((len(ids), max(1, max(map(len, places)))), -1, np.int32)
        for k, p in enumerate(places):
            adjacent[k, :len(p)] = p
        roots = forest(len(ids), search(x, adjacent, threshold))
        degrees = own_degrees(x, roots, (pdf["home"] == pdf["cluster"]).to_numpy(), pdf["copies"].to_numpy(), threshold)
        return pd.DataFrame({"id": ids, "links": degrees, "root": ids[roots]})

    def pair(pdf: pd.DataFrame) -> pd.DataFrame:
        x = units(np.stack(pdf["v"].to_numpy()).astype(float))
        ids, links, roots = block_links(x, pdf["id"].to_numpy(), pdf["own"].to_numpy(bool), pdf["copies"].to_numpy(), threshold)
        return pd.DataFrame({"id": ids, "links": links, "root": roots})

    number = lambda n, seed: F.pmod(F.xxhash64("id", F.lit(seed)), F.col(n)).cast("int")
    columns = F.transform(F.sequence(F.lit(0), F.col("alls") - 1), lambda k: F.struct(number("owns", 5).alias("a"), k.alias("b"), F.lit(True).alias("own")))
    lines = F.transform(F.sequence(F.lit(0), F.col("owns") - 1), lambda k: F.struct(k.alias("a"), number("alls", 6).alias("b"), F.lit(False).alias("own")))

    result, tasks = "id bigint, links bigint, root bigint", max(1, -(-total // cluster_size))

    def search_all(most: int) -> DataFrame:
        """Links and roots of all clusters; those of more than ``most`` vertices are cut, no more than pivots and labels of that size."""
        block = BLOCK * cluster_size
        cut = stored(assigned.groupBy("label", "cluster").agg(F.count("*").alias("n"), F.count_if(F.col("home") == F.col("cluster")).alias("n_own")).where(
            F.col("n") > most).select("label", "cluster", F.ceil(F.col("n_own") / block).cast("int").alias("owns"), F.ceil(F.col("n") / block).cast("int").alias("alls")), "near-cut")
        whole = assigned.join(cut, ["label", "cluster"], "left_anti")
        lists = stored(whole.repartition(tasks, "label", "cluster").groupBy("label", "cluster").applyInPandas(graph, "id bigint, near array<bigint>"), "near-graphs")
        united = lists.select("id", F.explode("near").alias("n")).groupBy("id").agg(F.collect_set("n").alias("near"))
        # Every block of a cluster's own vertices meets every block of all it holds, in a task for each pair of blocks.
        blocks = assigned.join(cut.where("owns > 0"), ["label", "cluster"]).withColumn("at", F.explode(F.when(
            F.col("home") == F.col("cluster"), F.concat(columns, lines)).otherwise(lines))).select("label", "cluster", "id", "v", "copies", "at.*")
        return stored(whole.join(united, "id", "left").repartition(tasks, "label", "cluster").groupBy("label", "cluster").applyInPandas(walk, result).union(
            blocks.groupBy("label", "cluster", "a", "b").applyInPandas(pair, result)), "near-links")

    found = search_all(MOST_GRAPH * cluster_size)
    audited = found.join(truth.select("id"), "id", "left_semi").agg(F.coalesce(F.sum("links"), F.lit(0))).first()[0]
    if audited < LEAST_RECALL * sums[0]:
        found = search_all(0)
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    parts_of = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")), "near-components").withColumnRenamed("v", "id")
    named = classes.select(F.col("label").alias("own_label"), F.col("v").alias("own_v"), "id", "copies").join(links, "id").join(
        parts_of, "id", "left").select("own_label", "own_v", (F.col("links") + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    own_label = F.when(usable, F.concat_ws(":", F.size("v").cast("string"), "label"))
    return rows.withColumn("own", own_label).join(stored(named, "near-named"), (F.col("own") == F.col("own_label")) & (F.col("v") == F.col("own_v")), "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))

