"""Near-duplicate embeddings by dual traversal of cover trees (operator 1).

Equal vectors of a label are one from the start. The distinct vectors of a label (and length)
are dealt into blocks of bounded size, and each block gets a cover tree under the angle between
vectors: a node's centre is a vector, its children cover its vectors by balls of half its level's
radius, the first child keeps the centre, and each node knows its covering radius, the largest angle from its
centre to a vector below it. For each pair of blocks of a label (also a block and itself)
two trees are descended together. A pair of nodes whose centres are further apart than the
threshold plus both covering radii holds no link and is dropped; one that is closer than the
threshold minus both holds nothing but links and is counted at once; the others are replaced by the pairs of
their children, and pairs of single vectors are compared by cosine. The pairs are exact.

From a pair of blocks come numbers of links and a spanning forest of them, never the links
themselves, so a group of n near copies gives rows in proportion to n.
"""

from __future__ import annotations

from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acct_health.llm.common import map_arrow, read_table, ship, written
from acct_health.llm.components import components

BLOCK = 2048  # vectors of a block, on average
DEEPEST = 24  # levels; what is still together then is compared one by one
SLACK = 1e-7  # radians that bounds allow for rounding


class CoverTree:
    """Nodes in arrays: centre (a position in ``order``), covering radius, the run of ``order`` below it, and the run of ``children``."""

    def __init__(self, vectors: np.ndarray):
        n = len(vectors)
        cosines = np.clip(vectors @ vectors.T, -1, 1)
        nodes: list[list] = []  # centre, radius, members, children

        def node(centre: int, members: np.ndarray, level: int) -> int:
            radius = float(np.arccos(cosines[centre, members].min())) if len(members) > 1 else 0.0
            nodes.append([centre, radius, members, []])
            return len(nodes) - 1

        todo = [(node(0, np.arange(n), 0), 1)]
        while todo:
            at, level = todo.pop()
            centre, radius, members, _ = nodes[at]
            if len(members) == 1 or level > DEEPEST:
                continue
            ball = np.pi / 2 ** level
            while ball >= radius and level < DEEPEST:  # levels at which nothing would part
                level, ball = level + 1, ball / 2
            reach = np.cos(ball)
            nearest = cosines[centre, members].copy()
            owner = np.zeros(len(members), np.int64)
            centres = [centre]
            while (far := int(nearest.argmin())) >= 0 and nearest[far] < reach:
                c = int(members[far])
                to = cosines[c, members]
                closer = to > nearest
                owner[closer], nearest[closer] = len(centres), to[closer]
                nearest[far], owner[far] = 2.0, len(centres)  # a centre stays its own
                centres.append(c)
            own = np.searchsorted(members, centre)
            owner[own] = 0
            for k, c in enumerate(centres):
                child = node(c, members[owner == k], level)
                nodes[at][3].append(child)
                todo.append((child, level + 1))
        # members of a node in a run: lay out by descent
        order, begin, end = [], [0] * len(nodes), [0] * len(nodes)
        stack = [(0, False)]
        while stack:
            at, done = stack.pop()
            if done:
                end[at] = len(order)
                continue
            begin[at] = len(order)
            stack.append((at, True))
            if nodes[at][3]:
                stack += [(c, False) for c in reversed(nodes[at][3])]
            else:
                order += nodes[at][2].tolist()
        self.order = np.array(order, np.int64)
        self.centre = np.array([x[0] for x in nodes], np.int64)
        self.radius = np.array([x[1] for x in nodes])
        self.begin, self.end = np.array(begin, np.int64), np.array(end, np.int64)
        self.kids = [np.array(x[3] or [i], np.int64) for i, x in enumerate(nodes)]


class Links:
    """Numbers of links of the points of two blocks, and a spanning forest of them."""

    def __init__(self, weight: np.ndarray):
        self.weight = weight  # vectors that a point stands for
        self.count = np.zeros(len(weight), np.int64)
        self.label = np.arange(len(weight))
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        np.add.at(self.count, i, self.weight[j])
        np.add.at(self.count, j, self.weight[i])
        self._join(i, j)

    def add_all(self, a: np.ndarray, b: np.ndarray, same: bool) -> None:
        """Every point of ``a`` is linked with every one of ``b``; ``same``: with the others of ``a``."""
        if same:
            self.count[a] += self.weight[a].sum() - self.weight[a]
        else:
            self.count[a] += self.weight[b].sum()
            self.count[b] += self.weight[a].sum()
        self._join(np.concatenate([np.full(len(b), a[0]), a]), np.concatenate([b, np.full(len(a), b[0])]))

    def _join(self, i, j):
        self.held.append((i, j))
        self.size += len(i)
        if self.size > 1 << 20:
            self.flush()

    def flush(self) -> None:
        if not self.held:
            return
        i, j = (np.concatenate(x) for x in zip(*self.held))
        i, j = np.concatenate([i, np.arange(len(self.label))]), np.concatenate([j, self.label])
        while True:
            low = self.label.copy()
            np.minimum.at(low, i, self.label[j])
            np.minimum.at(low, j, self.label[i])
            low = low[low]
            if (low == self.label).all():
                break
            self.label = low
        self.held, self.size = [], 0


def traverse(x: np.ndarray, s: CoverTree, y: np.ndarray, t: CoverTree, cosine: float, links: Links, same: bool) -> None:
    """Add to ``links`` the pairs of vectors of ``x`` and ``y`` (points numbered on from those of ``x``; ``same``: ``x`` again)."""
    angle, shift = float(np.arccos(cosine)), 0 if same else len(x)
    stack = [(0, 0)]
    while stack:
        a, b = stack.pop()
        twin = same and a == b
        if len(s.kids[a]) == 1 and s.kids[a][0] == a and len(t.kids[b]) == 1 and t.kids[b][0] == b:
            # two leaves of several vectors
            p, q = s.order[s.begin[a]:s.end[a]], t.order[t.begin[b]:t.end[b]]
            near = x[p] @ y[q].T >= cosine
            if twin:
                near = np.triu(near, 1)
            i, j = np.nonzero(near)
            links.add(p[i], q[j] + shift)
            continue
        ka, kb = s.kids[a], t.kids[b]
        apart = x[s.centre[ka]] @ y[t.centre[kb]].T
        if twin:
            upper = np.triu(np.ones(apart.shape, bool))
        single = (s.end[ka] - s.begin[ka] == 1)[:, None] & (t.end[kb] - t.begin[kb] == 1)[None, :]
        linked = single & (apart >= cosine)
        if twin:
            linked &= np.triu(np.ones(apart.shape, bool), 1)
        i, j = np.nonzero(linked)
        if len(i):
            links.add(s.centre[ka[i]], t.centre[kb[j]] + shift)
        angles = np.arccos(np.clip(apart, -1, 1))
        reach = s.radius[ka][:, None] + t.radius[kb][None, :]
        open_ = ~single & (angles - reach <= angle + SLACK)
        if twin:
            open_ &= upper
        sure = open_ & (angles + reach <= angle - SLACK)
        for i, j in zip(*np.nonzero(sure)):
            p, q = s.order[s.begin[ka[i]]:s.end[ka[i]]], t.order[t.begin[kb[j]]:t.end[kb[j]]]
            links.add_all(p, q + shift, twin and i == j)
        stack += [(int(ka[i]), int(kb[j])) for i, j in zip(*np.nonzero(open_ & ~sure))]


def unit(a: np.ndarray) -> np.ndarray:
    """Rows of length 1. Scaled by a power of two first, which is exact, so that no square overflows or vanishes."""
    a = np.ldexp(a, -np.frexp(np.abs(a).max(axis=1))[1][:, None])
    return a / np.linalg.norm(a, axis=1)[:, None]


def pair_links(ids_a, weights_a, a, ids_b, weights_b, b, cosine: float, same: bool) -> list[tuple[int, int | None, int]]:
    """(id, null, links) and (id, id, 0) rows: the numbers of links that two blocks give, and a forest of them."""
    x = unit(a)
    s = CoverTree(x)
    if same:
        y, t, ids, links = x, s, ids_a, Links(weights_a)
    else:
        y = unit(b)
        t, ids, links = CoverTree(y), np.concatenate([ids_a, ids_b]), Links(np.concatenate([weights_a, weights_b]))
    traverse(x, s, y, t, cosine, links, same)
    links.flush()
    rows = [(int(ids[i]), None, int(links.count[i])) for i in np.flatnonzero(links.count)]
    return rows + [(int(ids[i]), int(ids[j]), 0) for i, j in enumerate(links.label.tolist()) if i != j]


@contextmanager
def small_batches(spark, rows: int):
    """Arrow batches of few rows while wide rows go to Python."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def near_duplicates(vectors: DataFrame, cosine: float = 0.98, block: int = BLOCK, key: str = "vec_id", vector: str = "embedding",
                    label: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors``.

    Rows are linked if their labels are equal and not null, their vectors have one length and a cosine of ``cosine``
    or more in double precision. Null, empty and zero vectors and those that hold null or non-finite
    components link with nothing, nor do rows with a null vec_id: 0 links, a component of their own.
    Equal vectors of a label link with each other like any near ones; rows that share a vec_id are
    one node of components, each counted as a vector. An empty table gives no rows. Further columns
    are not looked at.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(label).alias("label"),
                          F.col(vector).cast("array<double>").alias("embedding"))
    sound = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("embedding") > 0)
             & F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
             & F.exists("embedding", lambda v: v != 0))
    sound = F.coalesce(sound, F.lit(False))
    distinct = rows.where(sound).groupBy("label", "embedding").agg(F.min("vec_id").alias("low"), F.count(F.lit(1)).alias("n"))
    distinct = written(distinct.withColumn("dim", F.size("embedding")), "distinct-vectors")

    sizes = distinct.groupBy("label", "dim").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    dealt = distinct.join(sizes, ["label", "dim"]).withColumn("block", F.pmod(F.xxhash64("low", "embedding"), F.col("blocks")).cast("int"))

    def packed(table: pa.Table) -> pa.Table:
        first = table.slice(0, 1)
        matrix = table.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        return pa.table({"label": first.column("label"), "dim": first.column("dim"), "block": first.column("block"),
                         "ids": pa.array([table.column("low").to_numpy().astype("<i8").tobytes()], pa.binary()),
                         "weights": pa.array([table.column("n").to_numpy().astype("<i8").tobytes()], pa.binary()),
                         "vectors": pa.array([matrix.astype("<f8").tobytes()], pa.binary())})

    kind = vectors.schema[label].dataType.simpleString()
    blocks = written(dealt.select("label", "dim", "block", "low", "n", "embedding").groupBy("label", "dim", "block").applyInArrow(
        packed, f"label {kind}, dim int, block int, ids binary, weights binary, vectors binary"), "vector-blocks")
    left = blocks.select("label", "dim", *[F.col(c).alias(f"{c}_a") for c in ("block", "ids", "weights", "vectors")])
    right = blocks.select("label", "dim", *[F.col(c).alias(f"{c}_b") for c in ("block", "ids", "weights", "vectors")])
    index = blocks.select("label", "dim", "block")
    pairs = index.withColumnRenamed("block", "block_a").join(index.withColumnRenamed("block", "block_b"), ["label", "dim"])
    pairs = pairs.where("block_a <= block_b").join(left, ["label", "dim", "block_a"]).join(right, ["label", "dim", "block_b"])

    def work(batches):
        for batch in batches:
            for r in batch.to_pylist():
                def side(s, r=r):
                    ids = np.frombuffer(r[f"ids_{s}"], "<i8")
                    return ids, np.frombuffer(r[f"weights_{s}"], "<i8"), np.frombuffer(r[f"vectors_{s}"], "<f8").reshape(len(ids), -1)

                found = pair_links(*side("a"), *side("b"), cosine, r["block_a"] == r["block_b"])
                yield pa.record_batch([pa.array([f[k] for f in found], pa.int64()) for k in range(3)], names=["a", "b", "n"])

    with small_batches(spark, 4):
        # dealt by a hash of the pair, not by a block, so that the pairs of a large label spread
        spread = pairs.repartition(F.xxhash64("label", "dim", "block_a", "block_b"))
        found = written(map_arrow(spread, work, "a long, b long, n long"), "vector-links")
    counts = found.where("b IS NULL").groupBy(F.col("a").alias("low")).agg(F.sum("n").alias("links"))
    groups = components(found.where("b IS NOT NULL").select("a", "b").unionByName(
        rows.where(sound).join(distinct.where("n > 1").select("label", "embedding", "low"), ["label", "embedding"])
        .where("vec_id <> low").select(F.col("vec_id").alias("a"), F.col("low").alias("b"))))
    told = written(distinct.join(counts, "low", "left").select("label", "embedding", (
        F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "vector-counts")
    out = rows.join(told.withColumn("__sound", F.lit(True)), ["label", "embedding"], "left")
    out = out.join(groups.withColumnRenamed("node", "vec_id"), "vec_id", "left")
    component = F.when(F.col("__sound"), F.coalesce("component", "vec_id")).otherwise(F.col("vec_id"))
    links = F.when(F.col("vec_id").isNotNull(), F.coalesce("n_links", F.lit(0))).otherwise(0).cast("long")
    return out.select("vec_id", links.alias("n_links"), component.alias("component_id"),
                      F.col("vec_id").eqNullSafe(component).alias("kept"))


def op1_embeddings(spark, sf_dir: str) -> DataFrame:
    """All embeddings, cosine 0.98 or more within a label."""
    return near_duplicates(read_table(spark, sf_dir, "embeddings"))


OP1_SQL = """
WITH RECURSIVE v AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS given,
        pow(2, floor(log2(list_max([abs(x::DOUBLE) FOR x IN embedding])))) AS scale, -- exact, so that no square overflows
        [x / scale FOR x IN given] AS e FROM embeddings
    WHERE label IS NOT NULL AND len(embedding) > 0
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([x FOR x IN embedding IF x <> 0]) > 0
), l AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
    WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.98
), reach AS (
    SELECT a, b FROM l
    UNION
    SELECT r.a, l.b FROM reach r JOIN l ON r.b = l.a
), c AS (
    SELECT a, least(a, min(b)) AS low FROM reach GROUP BY a
), n AS (
    SELECT a, count(*) AS links FROM l GROUP BY a
)
SELECT vec_id, coalesce(links, 0)::BIGINT AS n_links, coalesce(low, vec_id) AS component_id, coalesce(low, vec_id) = vec_id AS kept
FROM embeddings e LEFT JOIN c ON e.vec_id = c.a LEFT JOIN n ON e.vec_id = n.a
"""
