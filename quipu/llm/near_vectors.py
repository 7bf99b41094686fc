"""Embedding near-duplicates: exact threshold pairs by dual traversal of cover trees.

A cover tree has nested levels with halving radii: each node has a centre, the children of
a node lie within its level's radius, and its covering radius is the greatest distance to a
point below it.  Two trees are walked together from the top: a pair of nodes whose centres
are further apart than the threshold plus both covering radii is pruned, a pair that is
within the threshold even at its furthest is taken whole (counted and joined without listing
its pairs), and all others go on to their children, down to points, whose cosine is verified.

How it scales.  Equal vectors are one class with a weight.  The top of the tree is a set of
``pivots`` chosen by farthest-first order from a bounded sample; every vector is at home with
its nearest pivot and visits another pivot's cell only if a vector at home there can be
within the threshold (its distance to the plane between both pivots, and the cell's covering
radius, tell).  A cell beyond ``BLOCK`` vectors is dealt over block pairs, so no task gets an
unbounded group.  Tasks return counts and a spanning set of links, not all pairs; components
come from distributed rounds.

Defined results: vectors that are null, zero or hold null or non-finite values, and rows
without id, link with nothing: n_links 0, a component of their own, kept.  Shorter vectors
count as filled up with zeros.  Repeated rows are other vectors.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quipu.llm.common import connected, matrix_of, table_of, vectors_of
from quipu.operators.corpus import pin_table

BLOCK, SAMPLE, MAX_PIVOTS = 4096, 1024, 256
LEVELS = (0.5, 0.25, 0.125, 0.0625)   # the top is about the reach of a high cosine: wider nodes would hardly prune
EPS = 1e-7
_ROWS = pa.schema([("vec_id", pa.int64()), ("v", pa.binary())])


def _valid(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, v): v is null if the vector takes no part."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = vectors_of(batch.column("v"))
            yield table_of({"vec_id": batch.column("vec_id"),
                            "v": [x.astype("<f8").tobytes() if x is not None and x.any() else None for x in rows]}, _ROWS)

    return (vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("v"))
            .mapInArrow(run, "vec_id long, v binary"))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True, initial=1e-300)  # against overflow of the squares
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _distance(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * cosine))


class CoverTree:
    """Points in an order in which every node of every level is a run.  levels[i] holds the
    runs' starts (with the end), the centres and the covering radii; the last level is points."""

    def __init__(self, x: np.ndarray) -> None:
        n = len(x)
        node, depth = np.zeros(n, np.int64), []
        for radius in LEVELS:
            made = np.full(n, -1)
            order = np.argsort(node, kind="stable")
            starts = np.flatnonzero(np.append(True, np.diff(node[order]) != 0))
            sizes = np.diff(np.append(starts, n))
            alone = order[starts[sizes == 1]]
            made[alone], centres, count = np.arange(len(alone)), alone.tolist(), len(alone)
            for part in [order[a:a + m] for a, m in zip(starts.tolist(), sizes.tolist(), strict=True) if m > 1]:
                # the first point of a node is its centre on this level and stays one below: nested
                while len(part):
                    first = part[:128]
                    near = x[part] @ x[first].T >= 1 - radius * radius / 2
                    near[np.arange(len(first)), np.arange(len(first))] = True
                    chosen: list[int] = []  # those of the first that no centre before them is near to
                    for i in range(len(first)):
                        if not near[i, chosen].any():
                            chosen.append(i)
                    near = near[:, chosen]
                    got = near.any(1)
                    made[part[got]] = count + near[got].argmax(1)
                    centres += first[chosen].tolist()
                    count += len(chosen)
                    part = part[~got]
            node = made
            depth.append((made, np.array(centres)))
        self.order = np.lexsort([d[0] for d in reversed(depth)]) if n else np.zeros(0, np.int64)
        place = np.empty(n, np.int64)
        place[self.order] = np.arange(n)
        self.x = x[self.order]
        self.levels = []
        for made, centres in depth:
            run = made[self.order]
            starts = np.flatnonzero(np.append(True, run[1:] != run[:-1]))
            centre = place[centres[run[starts]]]
            away = _distance((self.x * self.x[np.repeat(centre, np.diff(np.append(starts, n)))]).sum(1))
            self.levels.append((np.append(starts, n), centre, np.maximum.reduceat(away, starts)))
        self.levels.append((np.arange(n + 1), np.arange(n), np.zeros(n)))


def _expand(pairs: tuple[np.ndarray, np.ndarray], a: CoverTree, b: CoverTree, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of nodes of a level to all pairs of their children."""
    def children(tree: CoverTree, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        upper, lower = tree.levels[level][0], tree.levels[level + 1][0]
        first = np.searchsorted(lower, upper[nodes])
        return first, np.searchsorted(lower, upper[nodes + 1]) - first

    (fa, na), (fb, nb) = children(a, pairs[0]), children(b, pairs[1])
    each = na * nb
    k = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
    wide = np.repeat(nb, each)
    return np.repeat(fa, each) + k // wide, np.repeat(fb, each) + k % wide


def dual_links(a: CoverTree, b: CoverTree, same: bool, cosine: float):
    """Yields (level, nodes of a, nodes of b) whose points all link; ``same`` tells that both
    are one tree, whose pairs are then met once (a node with itself: all pairs inside)."""
    reach = float(_distance(np.float64(cosine)))
    if not len(a.x) or not len(b.x):
        return
    starts_a, starts_b = len(a.levels[0][1]), len(b.levels[0][1])
    todo = [(0, i, min(i + 256, starts_a)) for i in range(0, starts_a, 256)]
    for _, lo, hi in todo:
        # the top level as one product of centres
        ca, cb = a.levels[0][1][lo:hi], b.levels[0][1]
        radius_a, radius_b = a.levels[0][2][lo:hi], b.levels[0][2]
        furthest = np.minimum(2.0, reach + radius_a + radius_b.max() + EPS)
        cos = a.x[ca] @ b.x[cb].T
        at, pb = np.nonzero(cos >= (1 - furthest * furthest / 2 - EPS)[:, None])
        near = _distance(cos[at, pb]) <= reach + radius_a[at] + radius_b[pb] + EPS
        pairs = (at[near] + lo, pb[near])
        if same:
            keep = pairs[0] <= pairs[1]
            pairs = pairs[0][keep], pairs[1][keep]
        stack = [(0, pairs)]
        while stack:
            level, pairs = stack.pop()
            if len(pairs[0]) > 100_000:
                half = len(pairs[0]) // 2
                stack += [(level, tuple(p[:half] for p in pairs)), (level, tuple(p[half:] for p in pairs))]
                continue
            ia, ib = pairs
            la, lb = a.levels[level], b.levels[level]
            cos = np.einsum("ij,ij->i", a.x[la[1][ia]], b.x[lb[1][ib]])
            if level == len(LEVELS):
                ok = (cos >= cosine) & ((ia != ib) if same else True)
                if ok.any():
                    yield level, ia[ok], ib[ok]
                continue
            away, radii = _distance(cos), la[2][ia] + lb[2][ib]
            whole = away + radii <= reach - EPS
            if whole.any():
                yield level, ia[whole], ib[whole]
            rest = ~whole & (away <= reach + radii + EPS)
            if not rest.any():
                continue
            ia, ib = ia[rest], ib[rest]
            step = max(1, 50_000)
            for k in range(0, len(ia), step):
                pairs = _expand((ia[k:k + step], ib[k:k + step]), a, b, level)
                if same:
                    keep = pairs[0] <= pairs[1]
                    pairs = pairs[0][keep], pairs[1][keep]
                if len(pairs[0]):
                    stack.append((level + 1, pairs))


def block_links(ids_a: np.ndarray, xa: np.ndarray, wa: np.ndarray, ids_b: np.ndarray, xb: np.ndarray, wb: np.ndarray,
                same: bool, cosine: float) -> tuple[dict[int, int], list[tuple[int, int]]]:
    """Weighted number of links of each id, and links that span what is connected."""
    a = CoverTree(xa)
    b = a if same else CoverTree(xb)
    ids_a, wa = ids_a[a.order], wa[a.order]
    ids_b, wb = (ids_a, wa) if same else (ids_b[b.order], wb[b.order])
    sum_a, sum_b = np.append(0, np.cumsum(wa)), np.append(0, np.cumsum(wb))
    add_a, add_b = np.zeros(len(wa) + 1, np.int64), np.zeros(len(wb) + 1, np.int64)
    own = np.zeros(len(wa), np.int64)
    root: dict[int, int] = {}
    links: list[tuple[int, int]] = []

    def find(i: int) -> int:
        while root.setdefault(i, i) != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def join(i: int, j: int) -> None:
        ri, rj = find(i), find(j)
        if ri != rj:
            root[max(ri, rj)] = min(ri, rj)
            links.append((i, j))

    for level, ia, ib in dual_links(a, b, same, cosine):
        sa, ca, _ = a.levels[level]
        sb, cb, _ = b.levels[level]
        inside = (ia == ib) if same else np.zeros(len(ia), bool)
        for i in ia[inside].tolist():  # all pairs inside one node
            lo, hi = sa[i], sa[i + 1]
            own[lo:hi] += sum_a[hi] - sum_a[lo] - wa[lo:hi]
            for p in range(lo, hi):
                join(int(ids_a[p]), int(ids_a[ca[i]]))
        ia, ib = ia[~inside], ib[~inside]
        for add, s, i, total, t, j in ((add_a, sa, ia, sum_b, sb, ib), (add_a if same else add_b, sb, ib, sum_a, sa, ia)):
            much = total[t[j + 1]] - total[t[j]]
            np.add.at(add, s[i], much)
            np.subtract.at(add, s[i + 1], much)
        for i, j in zip(ia.tolist(), ib.tolist(), strict=True):
            for p in range(sa[i], sa[i + 1]):
                join(int(ids_a[p]), int(ids_b[cb[j]]))
            for p in range(sb[j], sb[j + 1]):
                join(int(ids_b[p]), int(ids_a[ca[i]]))
    counts: dict[int, int] = {}
    for ids, n in ((ids_a, np.cumsum(add_a)[:-1] + own), *(() if same else ((ids_b, np.cumsum(add_b)[:-1]),))):
        for i, c in zip(ids[n > 0].tolist(), n[n > 0].tolist(), strict=True):
            counts[i] = counts.get(i, 0) + c
    return counts, links


def farthest_first(x: np.ndarray, n: int) -> np.ndarray:
    """Places of n points, each the farthest from those before it."""
    chosen, away = [0], _distance(x @ x[0])
    while len(chosen) < min(n, len(x)) and away.max() > EPS:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, _distance(x @ x[chosen[-1]]))
    return np.array(chosen)


def near_duplicates(vectors: DataFrame, cosine: float = 0.95, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row."""
    rows = pin_table(_valid(vectors, id_col, vec_col), "vectors")
    named = rows.filter(F.col("v").isNotNull() & F.col("vec_id").isNotNull())
    classes = pin_table(named.groupBy("v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight")), "classes")
    total = classes.count()
    sample = classes.orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE).select("v").collect()
    raw = matrix_of([bytes(r["v"]) for r in sample])
    points = _unit(raw) if len(raw) else raw
    pivots = points[farthest_first(points, max(1, min(MAX_PIVOTS, total // BLOCK)))] if len(points) else points
    reach = float(_distance(np.float64(cosine))) + EPS
    dims = pivots.shape[1] if len(pivots) else 0

    def assign(batches: Iterable[pa.RecordBatch], radii: np.ndarray | None) -> Iterator[pa.RecordBatch]:
        """Home cell and distance to it; with the cells' radii also all cells to visit."""
        gaps = _distance(pivots @ pivots.T)
        for batch in batches:
            x = _unit(matrix_of(batch.column("v").to_pylist()))
            d = max(x.shape[1], dims)
            x, p = (np.pad(m, ((0, 0), (0, d - m.shape[1]))) for m in (x, pivots))
            away = _distance(x @ p.T)
            home = away.argmin(1)
            if radii is None:
                cols = {"cell": pa.array(home, pa.int32()), "away": pa.array(away[np.arange(len(x)), home])}
                yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))
                continue
            at_home = away[np.arange(len(x)), home][:, None]
            plane = (away ** 2 - at_home ** 2) / np.maximum(2 * gaps[home], 1e-300)
            visit = (plane <= reach) & (away <= radii + reach) & (np.arange(len(p)) > home[:, None])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(home, pa.int32()), pa.array([np.flatnonzero(v).tolist() for v in visit], pa.list_(pa.int32()))],
                names=[*batch.schema.names, "home", "visits"])

    found = pin_table(_pairs(classes, assign, len(pivots), cosine), "found") if total else None
    none = rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    if found is None:
        return none
    counts = found.filter("n > 0").groupBy("a").agg(F.sum("n").alias("links")).withColumnRenamed("a", "rep")
    parts = connected(found.filter("b is not null").select("a", "b")).withColumnRenamed("node", "rep")
    members = classes.join(counts, "rep", "left").join(parts, "rep", "left")
    out = rows.filter(F.col("vec_id").isNotNull()).join(members, "v", "left").select(
        "vec_id", F.coalesce(F.col("weight") - 1 + F.coalesce("links", F.lit(0)), F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "rep", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id")).unionByName(none.filter("vec_id is null"))


def _pairs(classes: DataFrame, assign, n_pivots: int, cosine: float) -> DataFrame:
    """(a, b, n): rows with n > 0 add to a's links, rows with b are links."""
    cells = (classes.select("v").mapInArrow(lambda x: assign(x, None), "cell int, away double")
             .groupBy("cell").agg(F.count("*").alias("n"), F.max("away").alias("radius")).collect())
    radii, blocks = np.zeros(n_pivots), [1] * n_pivots
    for c in cells:
        radii[c["cell"]], blocks[c["cell"]] = c["radius"], -(-c["n"] // BLOCK)
    placed = classes.mapInArrow(lambda x: assign(x, radii), "v binary, rep long, weight long, home int, visits array<int>")
    placed = pin_table(placed, "placed")
    guests = {r["cell"]: -(-r["n"] // BLOCK) for r in placed.select(F.explode("visits").alias("cell")).groupBy("cell")
              .agg(F.count("*").alias("n")).collect()}
    n_home = F.element_at(F.array(*map(F.lit, blocks)), F.col("cell") + 1)
    n_guest = F.element_at(F.array(*[F.lit(guests.get(i, 0)) for i in range(n_pivots)]), F.col("cell") + 1)
    mark = F.xxhash64("rep", F.lit(3))
    at_home = placed.select("v", "rep", "weight", F.col("home").alias("cell")).withColumn("block", F.pmod(mark, n_home).cast("int"))
    upto = F.sequence(F.lit(0), n_home - 1)
    inner = at_home.select("*", F.explode(upto).alias("other")).select(
        "v", "rep", "weight", "cell", F.lit(0).alias("kind"), F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"), (F.col("block") > F.col("other")).alias("right"))
    hosts = at_home.filter(n_guest > 0).select("*", F.explode(F.sequence(F.lit(0), n_guest - 1)).alias("other")).select(
        "v", "rep", "weight", "cell", F.lit(1).alias("kind"), F.col("block").alias("i"), F.col("other").alias("j"), F.lit(False).alias("right"))
    visiting = (placed.select("v", "rep", "weight", F.explode("visits").alias("cell"))
                .withColumn("block", F.pmod(mark, n_guest).cast("int"))
                .select("*", F.explode(upto).alias("other"))
                .select("v", "rep", "weight", "cell", F.lit(1).alias("kind"), F.col("other").alias("i"),
                        F.col("block").alias("j"), F.lit(True).alias("right")))

    def link(rows: pd.DataFrame) -> pd.DataFrame:
        same = bool((rows["kind"].iat[0] == 0) and (rows["i"].iat[0] == rows["j"].iat[0]))
        x = _unit(matrix_of(rows["v"].tolist()))
        ids, w, right = rows["rep"].to_numpy(), rows["weight"].to_numpy(), rows["right"].to_numpy()
        counts, links = block_links(ids[~right], x[~right], w[~right], ids[right], x[right], w[right], same, cosine)
        out = pd.DataFrame({"a": [*counts, *(a for a, _ in links)], "b": pd.array([None] * len(counts) + [b for _, b in links], "Int64"),
                            "n": [*counts.values(), *[0] * len(links)]})
        return out.astype({"a": "int64", "n": "int64"})

    return inner.unionByName(hosts).unionByName(visiting).groupBy("cell", "kind", "i", "j").applyInPandas(link, "a long, b long, n long")
