"""Near-duplicate vectors by range search on a robust-pruned flat graph.

Equal vectors are one class; a class is one node. Cluster centres are fitted on a bounded sample; every node joins the
shards of its two nearest centres, so shards overlap. Every node is searched in the shards of all centres within a margin of
its second centre; the margin is measured on pairs at the threshold around held-out nodes, so that MEET of them meet
whatever the number of centres. A shard that is larger than ``SHARD`` is cut into blocks. In each
block a flat graph is built: the nearest candidates of a node and some at growing ranks, robust-pruned so that no kept neighbour hides another
direction, with reverse edges and a path over all nodes that keeps the graph in one piece. The adjacency lists of a node
are united over its shards. Then every node is searched in its probed shards (in each block of them): a
greedy beam walks from the medoid, and from the nodes it ends at, the search expands over the graph as long as it meets nodes in range. Every
reported pair is verified by its cosine in double precision. ``audit_recall`` compares with brute force.

A neighbour that is met in both of its shards counts only in the lower one, so links are summed and no pair leaves a task: a task
returns for each of its nodes the number of links and one edge to a local root. Blocks of a large shard meet pairwise in
tasks of bounded size.

Defined cases: vectors that are null, empty or zero, or hold null or non-finite components, and rows without id, link with
nothing; vectors of different length link with nothing; repeated rows of one id and vector are one vector; an empty table
gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import connected_components, materialise

LEAST_COSINE = 0.9
SLACK = 0.1  # nodes down to LEAST_COSINE - SLACK are expanded
SAMPLE = 20_000
SHARD = 12_000
FLOOR = 8  # nearest neighbours that are kept whatever hides them
PROBES, MARGIN = 4, 0.15  # the least: a node is searched in its best shards, as far as they are nearly as near as its second
MEET, HELD, PAIRS = 0.99, 10, 4000  # share of pairs at LEAST_COSINE that meet; every 10th sampled node takes no part in the fit
DEGREE, CANDIDATES, ALPHA, BEAM = 16, 24, 1.2, 24
QUERY_BLOCK = 256


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows of length 1 in double precision; scaled by the largest component first, so nothing overflows."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def prepare(vectors: DataFrame) -> DataFrame:
    """(vec_id, key, unit): a 128-bit key of the vector and the unit vector, both null where it cannot link."""

    def run(batches):
        for batch in batches:
            keys, units = [], []
            for x in batch.column("embedding").to_pylist():
                v = np.array(x, np.float64) if x and None not in x else np.zeros(0)
                good = len(v) > 0 and bool(np.isfinite(v).all()) and bool(v.any())
                keys.append(hashlib.blake2b((v + 0.0).tobytes(), digest_size=16).digest() if good else None)
                units.append(unit_rows(v[None])[0] if good else None)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(keys, pa.binary()), pa.array(units, pa.list_(pa.float64()))], names=["vec_id", "key", "unit"])

    return vectors.select("vec_id", "embedding").mapInArrow(run, "vec_id bigint, key binary, unit array<double>")


def probe_margin(centre: np.ndarray, held: np.ndarray, least: float = LEAST_COSINE, meet: float = MEET) -> float:
    """How far below a node's second-best centre the better home of a vector at cosine ``least`` lies, at the quantile ``meet``.

    Pairs are made around ``held``, half of them in any direction and half towards other vectors; the larger margin counts.
    """
    if len(centre) < 3 or not len(held):
        return 0.0
    pick = np.random.RandomState(0)
    margins = []
    for ahead in (lambda n: pick.normal(size=(n, held.shape[1])), lambda n: held[pick.randint(0, len(held), n)]):
        lacks = []
        for low in range(0, PAIRS, 500):
            u = held[np.arange(low, low + 500) % len(held)]
            w = ahead(len(u))
            w = w - (w * u).sum(axis=1, keepdims=True) * u
            w = w / np.maximum(np.linalg.norm(w, axis=1, keepdims=True), 1e-9)
            of_u, of_v = u @ centre.T, (least * u + np.sqrt(1 - least**2) * w) @ centre.T
            homes = np.argsort(-of_v, axis=1, kind="stable")[:, :2]
            lacks.append(np.sort(of_u, axis=1)[:, -2] - np.take_along_axis(of_u, homes, 1).max(axis=1))
        margins.append(np.quantile(np.concatenate(lacks), meet, method="higher"))
    return float(max(0.0, *margins))


def places(unit: np.ndarray, centre: np.ndarray, margin: float) -> tuple[list[int], list[int]]:
    """(homes, probes) of a unit vector: its two best centres, and all that are within ``margin`` of the second."""
    s = centre @ unit
    best = np.argsort(-s, kind="stable")
    second = s[best[:2][-1]]
    few = best[:PROBES]
    near = best[: max(int((s >= second - margin).sum()), int((s[few] >= second - MARGIN).sum()))]
    return sorted(best[:2].tolist()), near.tolist()


def centres(nodes: DataFrame, per_shard: int) -> tuple[np.ndarray, float]:
    """(cluster centres, probe margin) of the most common vector length, from at most SAMPLE nodes in hash order."""
    rows = nodes.orderBy(F.xxhash64("id"), "id").select("unit").limit(SAMPLE).collect()
    if not rows:
        return np.zeros((0, 0)), 0.0
    lengths = pd.Series([len(r[0]) for r in rows])
    x = np.array([r[0] for r in rows if len(r[0]) == lengths.mode()[0]])
    aside = np.arange(len(x)) % HELD == HELD - 1
    held, x = x[aside], x[~aside]
    k = int(max(1, min(len(x) // 8, np.ceil(nodes.count() / per_shard))))
    centre = x[:: max(1, len(x) // k)][:k]
    for _ in range(8):
        near = (x @ centre.T).argmax(axis=1)
        sums = np.zeros_like(centre)
        np.add.at(sums, near, x)
        full = np.linalg.norm(sums, axis=1) > 1e-9
        centre = np.where(full[:, None], sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9), centre)
    return centre, probe_margin(centre, held)


def robust_prune(x: np.ndarray, near: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA) -> list[np.ndarray]:
    """For each row of candidates (nearest first): keep one, drop those it is alpha times nearer to, and go on.

    The nearest FLOOR are kept in any case.
    """
    out = []
    for low in range(0, len(x), 512):
        cand = near[low : low + 512]
        away = 1 - np.einsum("nd,ncd->nc", x[low : low + 512], x[cand])
        between = 1 - np.einsum("ncd,ned->nce", x[cand], x[cand])
        open_ = cand != np.arange(low, low + len(cand))[:, None]
        kept = open_ & (open_.cumsum(axis=1) <= FLOOR)  # in a star of copies around one vector, that one hides all others
        for _ in range(degree - FLOOR):
            k = open_.argmax(axis=1)
            some = open_[np.arange(len(cand)), k]
            if not some.any():
                break
            kept[some, k[some]] = True
            hidden = alpha * between[np.arange(len(cand)), k] <= away
            open_ &= ~(hidden & some[:, None])
            open_[np.arange(len(cand)), k] = False
        out += [c[m] for c, m in zip(cand, kept)]
    return out


def candidate_ranks(n: int) -> np.ndarray:
    """The nearest candidates, then ever fewer of the farther ones, so that tight groups get edges out of them."""
    far = CANDIDATES * 1.3 ** np.arange(60)
    return np.unique(np.concatenate((np.arange(min(CANDIDATES, n)), far[far < n].astype(np.int64))))


def build(x: np.ndarray) -> list[np.ndarray]:
    """Adjacency lists of the flat graph over unit rows."""
    n = len(x)
    ranks = candidate_ranks(n)
    near = np.empty((n, len(ranks)), np.int64)
    for low in range(0, n, 512):
        near[low : low + 512] = np.argsort(-(x[low : low + 512] @ x.T), axis=1, kind="stable")[:, ranks]
    lists = [set(p.tolist()) for p in robust_prune(x, near)]
    for k, p in enumerate([sorted(s) for s in lists]):
        for j in p:
            if len(lists[j]) < 2 * DEGREE:
                lists[j].add(k)
    for k in range(n - 1):
        lists[k].add(k + 1)
        lists[k + 1].add(k)
    return [np.array(sorted(s), np.int64) for s in lists]


def greedy(x: np.ndarray, links: np.ndarray, queries: np.ndarray, start: int, beam: int = BEAM) -> np.ndarray:
    """The ``beam`` best nodes that a greedy walk from ``start`` finds for each query. ``links`` is padded with -1."""
    q = len(queries)
    rows = np.arange(q)
    ids = np.full((q, beam), -1)
    ids[:, 0] = start
    score = np.full((q, beam), -2.0)
    score[:, 0] = queries @ x[start]
    done = np.zeros((q, beam), bool)
    seen = np.zeros((q, len(x)), bool)
    seen[:, start] = True
    while True:
        waiting = np.where(done | (ids < 0), -3.0, score)
        k = waiting.argmax(axis=1)
        live = np.flatnonzero(waiting[rows, k] > -3)
        if not len(live):
            return ids
        done[live, k[live]] = True
        nodes = links[ids[live, k[live]]]
        fresh = (nodes >= 0) & ~seen[live[:, None], nodes]
        r, c = np.nonzero(fresh)
        who, what = live[r], nodes[r, c]
        seen[who, what] = True
        new = np.full(nodes.shape, -2.0)
        new[r, c] = np.einsum("nd,nd->n", queries[who], x[what])
        all_ids = np.concatenate((ids[live], np.where(fresh, nodes, -1)), axis=1)
        all_score = np.concatenate((score[live], new), axis=1)
        all_done = np.concatenate((done[live], np.zeros(nodes.shape, bool)), axis=1)
        top = np.argsort(-all_score, axis=1, kind="stable")[:, :beam]
        ids[live], score[live], done[live] = (np.take_along_axis(a, top, 1) for a in (all_ids, all_score, all_done))


def in_range(x: np.ndarray, links: np.ndarray, queries: np.ndarray, start: int, least: float = LEAST_COSINE):
    """(query, node) pairs with cosine >= least: from the nodes the greedy walk ends at, expand while nodes are in range."""
    found = greedy(x, links, queries, start)
    who, k = np.nonzero(found >= 0)
    what = found[who, k]
    seen = np.zeros((len(queries), len(x)), bool)
    seen[who, what] = True
    pairs = []
    while len(who):
        cosine = np.einsum("nd,nd->n", queries[who], x[what])
        pairs.append((who[cosine >= least], what[cosine >= least]))
        near = cosine >= least - SLACK
        who, what = who[near], what[near]
        new_who, new_what = [], []
        for low in range(0, len(who), 100_000):
            nodes = links[what[low : low + 100_000]]
            w = np.repeat(who[low : low + 100_000], nodes.shape[1])
            t = nodes.ravel()
            ok = (t >= 0) & ~seen[w, t]
            keys = np.unique(w[ok] * len(x) + t[ok])
            new_who.append(keys // len(x))
            new_what.append(keys % len(x))
            seen[new_who[-1], new_what[-1]] = True
        who = np.concatenate(new_who) if new_who else np.zeros(0, np.int64)
        what = np.concatenate(new_what) if new_what else np.zeros(0, np.int64)
    return np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])


def medoid(x: np.ndarray) -> int:
    return int((x @ x.mean(axis=0)).argmax())


def _search(index: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
    """Links and a local root of each query of one block against the graph of another (or the same)."""
    if not len(index) or not len(queries):
        return pd.DataFrame({"id": pd.Series(dtype="int64"), "root": pd.Series(dtype="int64"), "links": pd.Series(dtype="int64")})
    index = index.sort_values("id", ignore_index=True)
    queries = queries.sort_values("id", ignore_index=True)
    x, q = np.array(index["unit"].tolist()), np.array(queries["unit"].tolist())
    ids, q_ids, weight = index["id"].to_numpy(), queries["id"].to_numpy(), index["weight"].to_numpy()
    at = {v: k for k, v in enumerate(ids.tolist())}
    lists = [[at[j] for j in near if j in at] for near in index["near"]]
    links = np.full((len(x), max(1, max(map(len, lists)))), -1)
    for k, near in enumerate(lists):
        links[k, : len(near)] = near
    shard = int(index["shard"][0])
    # a neighbour counts in its lower shard if that is searched, too
    low_x = index["low"].to_numpy()
    probed = np.frombuffer(b"".join(queries["mask"]), np.uint8).reshape(len(q), -1)  # one bit a centre
    start, total, root = medoid(x), np.zeros(len(q), np.int64), {}

    def find(v):
        while root.get(v, v) != v:
            root[v] = root.get(root[v], root[v])
            v = root[v]
        return v

    label = {int(v): int(v) for v in np.concatenate((ids, q_ids))}
    names = np.array(sorted(label), np.int64)
    now = names.copy()
    for low in range(0, len(q), QUERY_BLOCK):
        who, what = in_range(x, links, q[low : low + QUERY_BLOCK], start)
        who = who + low
        other = q_ids[who] != ids[what]
        who, what = who[other], what[other]
        counted = low_x[what] == shard
        if probed.shape[1]:
            counted |= (probed[who, low_x[what] >> 3] >> (7 - (low_x[what] & 7)).astype(np.uint8) & 1) == 0
        np.add.at(total, who[counted], weight[what[counted]])
        a, b = now[np.searchsorted(names, q_ids[who])], now[np.searchsorted(names, ids[what])]
        for u, v in np.unique(np.stack((a, b), 1)[a != b], axis=0).tolist():
            u, v = find(u), find(v)
            root[max(u, v)] = min(u, v)
        now = np.array([find(v) for v in now.tolist()], np.int64) if root else now
    nodes = pd.DataFrame({"id": names, "root": now, "links": 0})
    nodes.loc[np.searchsorted(names, q_ids), "links"] = total
    return nodes[(nodes["links"] > 0) | (nodes["id"] != nodes["root"])]


def near_vectors(vectors: DataFrame, shard: int = SHARD) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id (smallest id reachable, itself included) and kept."""
    spark = vectors.sparkSession
    ready = materialise(prepare(vectors), "vectors")
    usable = ready.where("vec_id IS NOT NULL AND key IS NOT NULL")
    classes = usable.groupBy("key").agg(F.min("vec_id").alias("id"), F.countDistinct("vec_id").alias("weight"))
    classes = materialise(classes, "vector-classes")
    named = classes.select("id", "weight", F.col("key").alias("k"))
    nodes = usable.join(named, (F.col("key") == F.col("k")) & (F.col("vec_id") == F.col("id"))).select("id", "weight", "unit")
    nodes = materialise(nodes.dropDuplicates(["id", "unit"]), "vector-nodes")
    fitted = spark.sparkContext.broadcast(centres(nodes, max(1, shard // 3)))

    def place(batches):
        c, margin = fitted.value
        for batch in batches:
            homes, probes, masks = [], [], []
            for u in batch.column("unit").to_pylist():
                if len(u) != c.shape[1] or not len(c):  # vectors of another length keep to themselves
                    home, near, mask = [-len(u)], [-len(u)], b""
                else:
                    home, near = places(np.array(u), c, margin)
                    bits = np.zeros(len(c), np.uint8)
                    bits[near] = 1
                    mask = np.packbits(bits).tobytes()
                homes.append(home)
                probes.append(near)
                masks.append(mask)
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(homes, longs), pa.array(probes, longs), pa.array(masks, pa.binary())], names=["id", "weight", "unit", "homes", "probes", "mask"])

    placed = nodes.mapInArrow(place, "id bigint, weight bigint, unit array<double>, homes array<bigint>, probes array<bigint>, mask binary")
    placed = materialise(placed, "vector-places")
    member = placed.withColumn("shard", F.explode("homes")).withColumn("low", F.array_min("homes"))
    sizes = materialise(member.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / F.lit(shard)).cast("int").alias("blocks")), "vector-shards")
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    member = materialise(member.join(sizes, "shard").withColumn("block", block), "vector-members")

    def graph(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("id", ignore_index=True)
        ids = part["id"].to_numpy()
        return pd.DataFrame({"id": ids, "near": [ids[n] for n in build(np.array(part["unit"].tolist()))]})

    lists = member.select("shard", "block", "id", "unit").groupBy("shard", "block").applyInPandas(graph, "id bigint, near array<bigint>")
    united = lists.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))  # two shards at most
    united = materialise(united, "vector-graph")
    # more probes mean more queries a shard; they are cut into blocks of their own
    asking = placed.select(F.explode("probes").alias("shard")).groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / F.lit(2 * shard)).cast("int").alias("turns"))
    both = materialise(sizes.join(asking, "shard"), "vector-turns")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    turns = both.select("shard", "turns")
    index = member.join(turns, "shard").join(united, "id").select("shard", "block", every("turns").alias("against"), "id", "unit", "weight", "near", "low")
    asked = placed.select("id", "unit", "mask", F.explode("probes").alias("shard")).join(both, "shard")
    turn = F.pmod(F.xxhash64("id"), F.col("turns")).cast("int")
    asked = asked.select("shard", every("blocks").alias("block"), turn.alias("against"), "id", "unit", "mask")
    keys = ["shard", "block", "against"]
    found = index.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(_search, "id bigint, root bigint, links bigint")
    found = materialise(found, "vector-links")
    linked = found.groupBy("id").agg(F.sum("links").alias("links"))
    parts = connected_components(found.select(F.col("id").alias("a"), F.col("root").alias("b")), "vector-components")
    of_class = named.join(linked, "id", "left").join(parts.withColumnRenamed("node", "id"), "id", "left")
    of_class = materialise(of_class.select("k", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n"), F.coalesce("component", "id").alias("c")), "vector-result")
    out = ready.join(of_class, (F.col("key") == F.col("k")) & F.col("vec_id").isNotNull(), "left")
    component = F.coalesce("c", "vec_id")
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))


def audit_recall(vectors: DataFrame, result: DataFrame, queries: int = 200) -> float:
    """Found links / true links of a bounded sample of vectors, by brute force in blocks over all vectors."""
    ready = prepare(vectors).where("vec_id IS NOT NULL AND key IS NOT NULL")
    rows = ready.orderBy(F.xxhash64("vec_id"), "vec_id").limit(queries).collect()
    asked = vectors.sparkSession.sparkContext.broadcast([(r["vec_id"], np.array(r["unit"])) for r in rows])

    def run(batches):
        for batch in batches:
            ids, units = np.array(batch.column("vec_id").to_pylist()), batch.column("unit").to_pylist()
            for v, u in asked.value:
                same = [k for k, x in enumerate(units) if len(x) == len(u)]
                hits = int(((np.array([units[k] for k in same]) @ u >= LEAST_COSINE) & (ids[same] != v)).sum()) if same else 0
                if hits:
                    yield pa.RecordBatch.from_arrays([pa.array([v], pa.int64()), pa.array([hits], pa.int64())], names=["vec_id", "links"])

    truth = ready.select("vec_id", "unit").mapInArrow(run, "vec_id bigint, links bigint").groupBy("vec_id").agg(F.sum("links").alias("links"))
    both = truth.join(result, "vec_id").agg(F.sum(F.least("n_links", "links")), F.sum("links")).first()
    return 1.0 if not both[1] else both[0] / both[1]
