"""Vectors into clusters: projection, DBSCAN, hierarchical density clustering, centroids and distances."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA, BucketedRandomProjectionLSH
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agorascope.functions import vectors
from agorascope.operators import manifold, tiles
from agorascope.operators.filters import has_embedding
from agorascope.sources import store


def usable(rows: DataFrame, key: str = "post_id", vector: str = "embedding") -> DataFrame:
    """Rows with a vector of the dimension that the row with the smallest key has; null and empty ones are left out."""
    held = rows.where(has_embedding(vector))
    dim = held.agg(F.min_by(F.size(vector), key).alias("d_"))
    return held.join(F.broadcast(dim), F.size(vector) == F.col("d_")).drop("d_")


def centroids(rows: DataFrame, label: str = "label", vector: str = "embedding") -> DataFrame:
    """Element-wise means per label, noise included."""
    each = rows.select(label, F.posexplode(vector).alias("pos", "x")).groupBy(label, "pos").agg(F.avg("x").alias("m"))
    return each.groupBy(label).agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "m"))), lambda s: s["m"]).alias("centroid"))


def center_distances(rows: DataFrame, metric: str = "euclidean", label: str = "label", vector: str = "embedding") -> DataFrame:
    """Rows with the distance to their own centroid; labels are few against rows, so Spark may broadcast centroids."""
    return rows.join(centroids(rows, label, vector), label).withColumn("center_distance", vectors.distance(F.col(vector), F.col("centroid"), metric)).drop("centroid")


def topic_names(labels: DataFrame, prefix: str = "topic", after: int = 0) -> DataFrame:
    """Dense names of labels but -1, in their order: prefix_1, prefix_2, ...; `after` continues existing numbers."""
    distinct = labels.where("label <> -1").select("label").distinct()
    return distinct.withColumn("topic_id", F.concat(F.lit(f"{prefix}_"), (F.row_number().over(Window.orderBy("label")) + after).cast("string")))


def project(rows: DataFrame, k: int, vector: str = "embedding", out: str = "projected") -> DataFrame:
    """Principal components. One row has nothing to project and gives zeros."""
    if len(rows.limit(2).collect()) < 2:
        return rows.withColumn(out, F.array_repeat(F.lit(0.0), k))
    held = rows.withColumn("v_", array_to_vector(F.transform(vector, lambda x: x.cast("double"))))
    fitted = PCA(k=k, inputCol="v_", outputCol="p_").fit(held)
    return fitted.transform(held).withColumn(out, vector_to_array("p_")).drop("v_", "p_")


def _near(a: dict, b: dict, eps: float) -> Iterator[tuple[int, np.ndarray]]:
    """(place in a, rows from there against all of b): which lie within eps and have different keys, where any do."""
    codes, distinct = pd.factorize(np.concatenate([a["keys"], b["keys"]]))
    own, other = np.split(codes, [len(a["keys"])])
    for at in range(0, len(own), tiles.BLOCK):
        near = tiles.within(a["x"][at : at + tiles.BLOCK], b["x"], eps)
        if near.any():
            if len(distinct) < len(codes):
                near &= own[at : at + len(near), None] != other
            yield at, near


def _paired(eps: float):
    """For tiles.compare: all pairs of rows within eps, both ways."""

    def work(a: dict, b: dict) -> Iterator[tuple]:
        for at, near in _near(a, b, eps):
            i, j = np.nonzero(near)
            yield a["keys"][at + i], b["keys"][j]
            if a["tile"] != b["tile"]:
                yield b["keys"][j], a["keys"][at + i]

    return work


def neighbour_pairs(rows: DataFrame, eps: float, key: str, vector: str) -> DataFrame:
    """(a, b) of different rows within eps, both ways. dbscan() does without these pairs."""
    held, spark = tiles.Tiles(rows, key, vector), rows.sparkSession
    pairs = held.near(eps)
    kind = rows.schema[key].dataType
    return held.compare(spark.createDataFrame(pairs, "a long, b long"), len(pairs), _paired(eps), "a string, b string").select(F.col("a").cast(kind), F.col("b").cast(kind))


def _linked(eps: float, enough: int):
    """For tiles.compare: links of rows within eps. A row with `enough` of them in these two tiles alone is core whatever other
    tiles hold, so of links between two such rows only as many are given (with sure) as hold them together. All others are given,
    fewer than `enough` for each row that is not sure, so they count what such a row has near."""

    def work(a: dict, b: dict) -> Iterator[tuple]:
        same, shift = a["tile"] == b["tile"], len(a["keys"])
        ahead, back, held = np.zeros(shift, int), np.zeros(len(b["keys"]), int), []
        for at, near in _near(a, b, eps):
            i, j = np.divmod(np.flatnonzero(near), near.shape[1])
            ahead[at : at + len(near)] = np.bincount(i, minlength=len(near))
            back += np.bincount(j, minlength=len(back))
            # Bits, as a dense pair of tiles may be all links.
            held.append((at, np.packbits(near, axis=1)))
        sure_a, sure_b = ahead >= enough, back >= enough
        keys = np.concatenate([a["keys"], b["keys"]])
        group = np.arange(len(keys))
        if same:
            group[shift:] = group[:shift]
        for at, bits in held:
            near = np.unpackbits(bits, axis=1, count=len(back)).view(bool)
            own = sure_a[at : at + len(near)]
            i, j = np.divmod(np.flatnonzero(near & ~(own[:, None] & sure_b)), near.shape[1])
            if same:
                i, j = i[at + i < j], j[at + i < j]
            yield a["keys"][at + i], b["keys"][j], np.zeros(len(i), bool)
            links: list[tuple] = []
            for k in np.flatnonzero(own):
                found = np.flatnonzero(near[k] & sure_b) + shift
                if len(found) and ((joined := group[found]) != group[at + k]).any():
                    groups, some = np.unique(joined, return_index=True)
                    links += [(keys[at + k], keys[found[x]]) for x in some[groups != group[at + k]].tolist()]
                    group[np.isin(group, groups)] = group[at + k]
            if links:
                yield (*zip(*links, strict=True), np.ones(len(links), bool))

    return work


def dbscan(rows: DataFrame, eps: float = 0.5, min_samples: int = 5, key: str = "post_id", vector: str = "embedding") -> DataFrame:
    """key, label: density clusters numbered by their smallest key, as strings; border rows join the smallest core near them; noise -1.

    Rows are compared once, tile by tile (operators.tiles). Two tiles give fewer links than min_samples for each of their rows,
    so a dense group costs its rows and not its pairs."""
    held = tiles.Tiles(rows, key, vector)
    pairs = held.near(eps)
    links = held.compare(rows.sparkSession.createDataFrame(pairs, "a long, b long"), len(pairs), _linked(eps, max(1, min_samples - 1)), "a string, b string, sure boolean")
    links = store.kept(links, "links")
    ends = links.select(F.explode(F.array("a", "b")).alias("a"), "sure").groupBy("a").agg(F.count("*").alias("n"), F.max("sure").alias("sure"))
    core = ends.where(F.col("sure") | (F.col("n") + 1 >= min_samples)).select("a")
    if min_samples <= 1:
        core = rows.select(F.col(key).cast("string").alias("a")).distinct()
    core = store.kept(core, "core")
    ended = links.join(core.select("a", F.lit(True).alias("core_a")), "a", "left").join(core.select(F.col("a").alias("b"), F.lit(True).alias("core_b")), "b", "left")
    near = ended.where("core_a and core_b").select("a", "b")
    comps = _components(core, near.union(near.select("b", "a")))
    ends = ended.where("core_a and core_b is null").select("a", "b").union(ended.where("core_b and core_a is null").select("b", "a"))
    border = ends.join(comps, "a").groupBy("b").agg(F.min("comp").alias("comp")).withColumnRenamed("b", "a")
    found = comps.unionByName(border)
    names = comps.select("comp").distinct().withColumn("label", F.row_number().over(Window.orderBy("comp")) - 1)
    labeled = found.join(names, "comp").select(F.col("a").alias("key_"), "label")
    return rows.select(key).join(labeled, F.col(key).cast("string") == F.col("key_"), "left").select(key, F.coalesce("label", F.lit(-1)).alias("label"))


def _components(nodes: DataFrame, arcs: DataFrame) -> DataFrame:
    """Smallest key reachable from each node, by rounds of min-labels with pointer jumps."""
    arcs = store.kept(arcs, "cluster")
    labels = nodes.join(arcs.groupBy("a").agg(F.min("b").alias("b")), "a", "left").select("a", F.least("a", "b").alias("comp"))
    while True:
        heard = arcs.join(labels.toDF("b", "c"), "b").groupBy("a").agg(F.min("c").alias("h"))
        hop = labels.toDF("comp", "further")
        moved = labels.join(heard, "a", "left").join(hop, "comp", "left").select("a", F.least("comp", "h", "further").alias("next"), "comp")
        moved = store.kept(moved, "cluster")
        done = moved.where("next <> comp").isEmpty()
        labels = moved.select("a", F.col("next").alias("comp"))
        if done:
            return labels


def hdbscan_labels(points: np.ndarray, min_cluster_size: int = 8, min_samples: int | None = None) -> np.ndarray:
    """Hierarchical density clustering: mutual reachability, minimum spanning tree, condensed tree, excess of mass."""
    n, k = len(points), min_samples or min_cluster_size
    if n < max(2, min_cluster_size):
        return np.full(n, -1)
    sq = (points**2).sum(1)

    def distances(i: int, j: int) -> np.ndarray:
        return np.sqrt(np.maximum(sq[i:j, None] + sq - 2 * points[i:j] @ points.T, 0))

    # Distances are made block by block and row by row, so memory grows with the points and not with their pairs.
    core = np.concatenate([np.partition(distances(i, i + 256), min(k, n) - 1, axis=1)[:, min(k, n) - 1] for i in range(0, n, 256)])
    # Prim's tree.
    seen, best, link = np.zeros(n, bool), np.full(n, np.inf), np.zeros(n, int)
    edges, at = [], 0
    for _ in range(n - 1):
        seen[at] = True
        reach = np.maximum(np.maximum(distances(at, at + 1)[0], core), core[at])
        closer = ~seen & (reach < best)
        best[closer], link[closer] = reach[closer], at
        at = int(np.argmin(np.where(seen, np.inf, best)))
        edges.append((best[at], link[at], at))
    return tree_labels(n, edges, min_cluster_size)


def tree_labels(n: int, edges: list[tuple], min_cluster_size: int) -> np.ndarray:
    """Labels of n points from the edges (height, a, b) of their spanning tree."""
    edges = sorted(edges)
    # Dendrogram: node n + i joins two nodes at a height.
    parent, size, kids, height = list(range(2 * n - 1)), [1] * n, [], []

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, (h, a, b) in enumerate(edges):
        a, b = top(a), top(b)
        parent[a] = parent[b] = n + i
        kids.append((a, b))
        height.append(h)
        size.append(size[a] + size[b])
    # Condensed tree: a split counts if both sides are large enough; else points fall out of the cluster.
    lam = lambda node: 1 / height[node - n] if height[node - n] > 0 else np.inf
    birth, stability, children, members = {0: 0.0}, {0: 0.0}, {0: []}, {0: []}
    stack, fresh = [(2 * n - 2, 0)], 1
    while stack:
        node, cluster = stack.pop()
        if node < n:
            members[cluster].append(node)
            continue
        a, b = kids[node - n]
        level = min(lam(node), 1e12)
        if size[a] >= min_cluster_size and size[b] >= min_cluster_size:
            stability[cluster] += (level - birth[cluster]) * (size[a] + size[b])
            for kid in (a, b):
                birth[fresh], stability[fresh], children[fresh], members[fresh] = level, 0.0, [], []
                children[cluster].append(fresh)
                stack.append((kid, fresh))
                fresh += 1
            continue
        for kid in (a, b):
            if size[kid] < min_cluster_size:
                stability[cluster] += (level - birth[cluster]) * size[kid]
                leaves = [kid]
                while leaves:
                    x = leaves.pop()
                    if x < n:
                        members[cluster].append(x)
                    else:
                        leaves += kids[x - n]
            else:
                stack.append((kid, cluster))
        if size[a] < min_cluster_size and size[b] < min_cluster_size:
            continue
    chosen, total = {}, {}
    for c in range(fresh - 1, -1, -1):
        below = sum(total[x] for x in children[c])
        chosen[c] = c != 0 and (not children[c] or stability[c] >= below)
        total[c] = stability[c] if chosen[c] else below
    out, number = np.full(n, -1), 0
    stack = [0]
    while stack:
        c = stack.pop()
        if chosen[c]:
            inside, own = [c], []
            while inside:
                x = inside.pop()
                own += members[x]
                inside += children[x]
            out[own] = number
            number += 1
        else:
            stack += children[c]
    order = {label: i for i, label in enumerate(dict.fromkeys(out[out >= 0].tolist()))}
    return np.array([order.get(x, -1) for x in out.tolist()])


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of rows side by side; one value for a pair, whichever way round."""
    return np.sqrt(((a - b) ** 2).sum(1))


def _nearest(k: int):
    """For tiles.compare: of each row of a the k nearest of b."""

    def work(a: dict, b: dict) -> Iterator[tuple]:
        x, y = a["x"].astype(float), b["x"].astype(float)
        for at in range(0, len(x), tiles.BLOCK):
            own = x[at : at + tiles.BLOCK]
            far = tiles.squared(own, y)
            if a["tile"] == b["tile"]:
                far[np.arange(len(own)), at + np.arange(len(own))] = np.inf
            # One more than asked for: what rounding swaps at the cut is as far but for rounding.
            some = np.argpartition(far, k, axis=1)[:, : k + 1] if len(y) > k + 1 else np.tile(np.arange(len(y)), (len(own), 1))
            row = np.repeat(np.arange(len(own)), some.shape[1])
            exact = _distances(own[row], y[some.ravel()]).reshape(some.shape)
            if a["tile"] == b["tile"]:
                exact[some == at + np.arange(len(own))[:, None]] = np.inf
            yield a["keys"][at : at + len(own)], list(exact), [b["keys"][p] for p in some]

    return work


def _outgoing(a: dict, b: dict) -> Iterator[tuple]:
    """For tiles.compare: of each component asked for the lightest edge from a to rows of other components in b, ties by keys."""
    asked = np.flatnonzero(a["asked"])
    x, y = a["x"][asked].astype(float), b["x"].astype(float)
    keys, comps, core = a["keys"][asked], a["comps"][asked], a["core"][asked]
    slack = 1e-6 * (1 + np.sqrt(max((x**2).sum(1).max(), (y**2).sum(1).max()))) if len(x) else 0
    best: dict[str, tuple] = {}
    _, codes = np.unique(np.concatenate([comps, b["comps"]]).astype(str), return_inverse=True)
    code, other = codes[: len(x)].astype("int32"), codes[len(x) :].astype("int32")
    for at in range(0, len(x), tiles.BLOCK):
        own = slice(at, at + tiles.BLOCK)
        # Squares, as roots of all of them would take most of the time.
        reach = tiles.squared(x[own], y)
        np.maximum(reach, core[own, None] ** 2, out=reach)
        np.maximum(reach, b["core"] ** 2, out=reach)
        reach[code[own, None] == other] = np.inf
        least = reach.min(1)
        of = pd.Series(least).groupby(code[own]).transform("min").to_numpy()
        bar = (np.sqrt(of) + slack) ** 2
        some = np.flatnonzero((least <= bar) & np.isfinite(least))
        i, j = np.nonzero(reach[some] <= bar[some, None])
        i = some[i]
        for c in range(0, len(i), 1 << 16):
            p, q = i[c : c + (1 << 16)] + at, j[c : c + (1 << 16)]
            w = np.maximum(np.maximum(_distances(x[p], y[q]), core[p]), b["core"][q])
            lo, hi = np.minimum(keys[p], b["keys"][q]), np.maximum(keys[p], b["keys"][q])
            found = pd.DataFrame({"c": comps[p], "w": w, "lo": lo, "hi": hi, "o": b["comps"][q]}).sort_values(["c", "w", "lo", "hi"]).drop_duplicates("c")
            for comp, *edge in found.itertuples(index=False):
                best[comp] = min(best.get(comp, tuple(edge)), tuple(edge))
    yield tuple(zip(*[(c, *e) for c, e in best.items()], strict=True)) or ((),) * 5


def spanning_tree(rows: DataFrame, k: int, key: str = "post_id", vector: str = "embedding", listed: int = 15) -> DataFrame:
    """a, b, w: the minimum spanning tree of mutual reachability, w being the greatest of the distance and the two distances to the
    k-th nearest row, itself included; ties by keys. Keys are unique.

    Boruvka's rounds over the `listed` nearest rows of each: a component's lightest listed edge is its lightest at all where
    it is shorter than any list of the component reaches. Where no component is that sure, all but the largest are compared with all rows."""
    held = tiles.Tiles(rows, key, vector)
    spark, at, listed = rows.sparkSession, sorted(held.bounds), max(listed, k - 1)
    pairs = lambda some: (spark.createDataFrame([(a, b) for a in some for b in at], "a long, b long"), len(some) * len(at))
    near = held.compare(*pairs(at), _nearest(listed), "key string, d array<double>, b array<string>")
    near = near.groupBy("key").agg(F.slice(F.sort_array(F.flatten(F.collect_list(F.arrays_zip("d", "b")))), 1, min(listed, held.count - 1)).alias("near"))
    reach = F.col("near")[F.size("near") - 1]["d"] if held.count - 1 > listed else F.lit(float("inf"))
    near = store.kept(near.withColumns({"core": F.col("near")[min(k, held.count) - 2]["d"] if k > 1 else F.lit(0.0), "reach": reach}), "near")
    arcs = near.select(F.col("key").alias("a"), "core", F.explode("near").alias("n")).select("a", "core", F.col("n.b").alias("b"), F.col("n.d").alias("d"))
    arcs = arcs.join(near.select(F.col("key").alias("b"), F.col("core").alias("core_b")), "b")
    edge = F.struct(F.greatest("d", "core", "core_b").alias("w"), F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))
    arcs = store.kept(arcs.select("a", "b", edge.alias("e")), "arcs")
    labels = near.select(F.col("key").alias("a"), F.col("key").alias("comp"), "core", "reach")
    tree = None
    while True:
        sizes = store.kept(labels.groupBy("comp").agg(F.count("*").alias("n"), F.min("reach").alias("reach")), "sizes")
        largest = sizes.orderBy(F.desc("n"), "comp").limit(2).collect()
        if len(largest) < 2:
            return tree if tree is not None else spark.createDataFrame([], "a string, b string, w double")
        arcs = arcs.join(labels.select("a", F.col("comp").alias("from")), "a").join(labels.select(F.col("a").alias("b"), F.col("comp").alias("to")), "b").where("`from` <> `to`")
        arcs = store.kept(arcs, "arcs")
        best = arcs.groupBy(F.col("from").alias("comp")).agg(F.min(F.struct("e.w", "e.lo", "e.hi", "to")).alias("e")).join(sizes, "comp").where(F.col("e.w") < F.col("reach"))
        best = store.kept(best.select("comp", "e"), "best")
        if best.isEmpty():
            asked = F.col("comp") != largest[0]["comp"]
            by_tile = held.rows.select("tile", F.col("key").alias("a")).join(labels, "a").groupBy("tile").agg(F.sort_array(F.collect_list(F.struct("a", "comp", "core", asked.alias("asked")))).alias("all"))
            by_tile = store.kept(by_tile.select("tile", *[F.col("all")[c].alias(name) for c, name in (("comp", "comps"), ("core", "core"), ("asked", "asked"))]), "by-tile")
            some = [r["tile"] for r in by_tile.where(F.exists("asked", lambda x: x)).select("tile").collect()]
            found = held.compare(*pairs(some), _outgoing, "comp string, w double, lo string, hi string, to string", by_tile)
            best = store.kept(found.groupBy("comp").agg(F.min(F.struct("w", "lo", "hi", "to")).alias("e")), "best")
        more = best.select(F.col("e.lo").alias("a"), F.col("e.hi").alias("b"), F.col("e.w").alias("w")).distinct()
        tree = store.kept(more if tree is None else tree.unionByName(more), "tree")
        moves = best.select(F.col("comp").alias("a"), F.col("e.to").alias("b"))
        moves = moves.union(moves.select("b", "a"))
        joined = _components(moves.select("a").distinct(), moves).toDF("comp", "next")
        labels = store.kept(labels.join(joined, "comp", "left").select("a", F.coalesce("next", "comp").alias("comp"), "core", "reach"), "labels")
        arcs = arcs.select("a", "b", "e")


def hdbscan(rows: DataFrame, min_cluster_size: int = 8, min_samples: int | None = None, key: str = "post_id", vector: str = "embedding", most: int = 20_000) -> DataFrame:
    """key, label. Up to `most` rows go through hdbscan_labels in one task; of more, the spanning tree is made by tiles of rows
    (spanning_tree) and one task condenses its edges, two numbers and a height for each row. Keys are unique."""
    held = rows.select(F.col(key).cast("string").alias("key"), F.transform(vector, lambda x: x.cast("double")).alias("v"))
    if held.count() > most:
        tree = spanning_tree(rows, min_samples or min_cluster_size, key, vector)

        def condense(part: pd.DataFrame) -> pd.DataFrame:
            keys = np.unique(np.concatenate([part["a"], part["b"]]).astype(str))
            a, b = (np.searchsorted(keys, part[c].to_numpy().astype(str)) for c in "ab")
            labels = tree_labels(len(keys), list(zip(part["w"].tolist(), a.tolist(), b.tolist(), strict=True)), min_cluster_size)
            return pd.DataFrame({"key": keys.astype(object), "label": labels.astype("int32")})

        found = tree.groupBy(F.lit("all")).applyInPandas(condense, "key string, label int")
        return held.select("key").join(found, "key", "left").select(F.col("key").alias(key), F.coalesce("label", F.lit(-1)).alias("label"))

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("key", kind="stable")
        labels = hdbscan_labels(np.stack(part["v"].to_numpy()).astype(float), min_cluster_size, min_samples)
        return pd.DataFrame({"key": part["key"].to_numpy(), "label": labels.astype("int32")})

    return held.groupBy(F.lit("all")).applyInPandas(run, "key string, label int").withColumnRenamed("key", key)


def cluster_posts(posts: DataFrame, method: str = "hdbscan", components: int = 50, prefix: str = "topic", after: int = 0, reduce: str = "pca", **options) -> DataFrame:
    """post_id, label, topic_id, center_distance of posts with vectors: projected (reduce: pca or umap), clustered, named, measured."""
    rows = usable(posts.select("post_id", "embedding"))
    dim = rows.select(F.max(F.size("embedding"))).first()[0] or 1
    flat = manifold.umap(rows, components) if reduce == "umap" else project(rows, min(components, dim))
    flat = flat.select("post_id", F.col("projected").alias("embedding"))
    found = (hdbscan if method == "hdbscan" else dbscan)(flat, **options)
    named = found.join(topic_names(found, prefix, after), "label", "left")
    return center_distances(flat.join(named, "post_id")).select("post_id", "label", F.coalesce("topic_id", F.lit("noise")).alias("topic_id"), "center_distance")


def batches_of(sizes: list[int], most: int, tokens: int) -> list[list[int]]:
    """Places of windows in batches, by length: at most `most` windows, and `tokens` with each as long as the longest, or one."""
    out: list[list[int]] = []
    for i in sorted(range(len(sizes)), key=lambda i: (sizes[i], i)):
        if not out or len(out[-1]) >= most or (len(out[-1]) + 1) * sizes[i] > tokens:
            out.append([])
        out[-1].append(i)
    return out


def embed_texts(rows: DataFrame, encode, text: str = "text", max_tokens: int = 512, overlap: int = 50, batch: int = 32, batch_tokens: int = 16_384, held: int = 1024) -> DataFrame:
    """Adds embedding: texts within max_tokens - 2 whole, longer ones as the length-weighted mean of their windows; unit length.

    encode: a function from a list of texts to an array of a row for each, on the workers. It is called for `batch` windows of
    about one length at a time, of whichever rows: windows are sorted by length among `held` of them, a batch holds at most
    batch_tokens words with the shorter ones filled up, and what comes back is added up row by row. So a long text costs as many
    calls as its windows ask for and short texts share theirs; memory is bounded by the windows held."""
    from agorascope.functions.sequences import chunk_tokens

    words = F.split(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)^\s+|\s+$", ""), r"(?U)\s+")
    windows = F.when(F.size(words) <= max_tokens - 2, F.array(words)).otherwise(chunk_tokens(words, max_tokens - 2, overlap))

    @F.pandas_udf("array<double>")
    def encoded(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, lengths in parts:
            sums: list = [0.0] * len(texts)
            weights = np.zeros(len(texts))
            waiting: list[tuple[int, str, int]] = []

            def flush(sums=sums, weights=weights, waiting=waiting) -> None:
                for own in batches_of([n for _, _, n in waiting], batch, batch_tokens):
                    found = np.asarray(encode([waiting[i][1] for i in own]), float)
                    for i, v in zip(own, found, strict=True):
                        row, _, n = waiting[i]
                        sums[row] = sums[row] + v * max(1, n)
                        weights[row] += max(1, n)
                waiting.clear()

            for row, (chunks, counts) in enumerate(zip(texts, lengths, strict=True)):
                for chunk, n in zip(chunks, counts, strict=True):
                    waiting.append((row, chunk, int(n)))
                    if len(waiting) >= held:
                        flush()
            flush()
            mean = np.array(sums).reshape(len(texts), -1) / weights[:, None]
            length = np.linalg.norm(mean, axis=1, keepdims=True)
            yield pd.Series(list(np.where(length > 0, mean / np.where(length > 0, length, 1), mean)), index=texts.index)

    said = rows.where(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+", "") != "").withColumn("w_", windows)
    return said.withColumn("embedding", encoded(F.transform("w_", lambda w: F.array_join(w, " ")), F.transform("w_", F.size))).drop("w_")


def hashing_encoder(size: int = 64):
    """A stand-in encoder that needs no model: signed hashes of words."""
    def encode(texts: list[str]) -> np.ndarray:
        import zlib

        out = np.zeros((len(texts), size))
        for i, t in enumerate(texts):
            for w in t.lower().split():
                h = zlib.crc32(w.encode())
                out[i, h % size] += 1 if h & 0x80000000 else -1
        return out

    return encode


def similar_pairs(rows: DataFrame, eps: float, key: str = "post_id", vector: str = "embedding") -> DataFrame:
    """Approximate pairs within eps by random projections, for corpora where the exact cells get too full."""
    held = rows.select(key, array_to_vector(F.transform(vector, lambda x: x.cast("double"))).alias("v"))
    fitted = BucketedRandomProjectionLSH(inputCol="v", outputCol="h", bucketLength=2 * eps, numHashTables=4, seed=3).fit(held)
    pairs = fitted.approxSimilarityJoin(held, held, eps, "distance")
    a: Column = F.col(f"datasetA.{key}")
    return pairs.select(a.alias("a"), F.col(f"datasetB.{key}").alias("b"), "distance").where("a < b")
