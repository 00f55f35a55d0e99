"""Near duplicates of embeddings by NN-descent."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from holdfast.llm.collision_search import rows_a_batch, usable
from holdfast.llm.common import connected_components
from holdfast.session import stage_table

THRESHOLD = 0.9
NEIGHBOURS, TREES, LEAF_ROWS = 8, 3, 256
ROUNDS, MIN_ROUNDS, ENLARGEMENTS = 8, 2, 3
AUDIT_ROWS, AUDIT_RECALL = 256, 0.99
CHUNK_ROWS = 512
_EDGE = "node long, other long, sim double"


def _unit(flat, dim: int):
    import numpy as np

    x = np.asarray(flat, np.float64).reshape(-1, dim)
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def _best(node, other, sim, k: int):
    """The ``k`` best proposals of every node of a batch, each pair once."""
    import numpy as np

    order = np.lexsort((other, -sim, node))
    node, other, sim = node[order], other[order], sim[order]
    same = np.zeros(len(node), bool)
    same[1:] = (node[1:] == node[:-1]) & (other[1:] == other[:-1])
    node, other, sim = node[~same], other[~same], sim[~same]
    if not len(node):
        return node, other, sim
    starts = np.nonzero(np.concatenate(([True], node[1:] != node[:-1])))[0]
    place = np.arange(len(node)) - np.repeat(starts, np.diff(np.append(starts, len(node))))
    keep = place < k
    return node[keep], other[keep], sim[keep]


def _edge_batch(parts, k: int):
    import numpy as np
    import pyarrow as pa

    node, other, sim = _best(*(np.concatenate(side) for side in zip(*parts)), k)
    return pa.RecordBatch.from_arrays([pa.array(node), pa.array(other), pa.array(sim)],
                                      names=["node", "other", "sim"])


def _lists(edges: DataFrame, k: int) -> DataFrame:
    """(node, near: the k nearest as (sim, other), nearest first)."""
    ranked = Window.partitionBy("node").orderBy(F.desc("sim"), "other")
    top = (
        edges.groupBy("node", "other").agg(F.max("sim").alias("sim"))
        .withColumn("_n", F.row_number().over(ranked)).filter(F.col("_n") <= k)
    )
    return top.groupBy("node").agg(
        F.sort_array(F.collect_list(F.struct("sim", "other")), asc=False).alias("near")
    )


def _first_lists(nodes: DataFrame, k: int, trees: int, seed: int) -> DataFrame:
    """Neighbours of other groups within the leaves of random hyperplane trees, for open nodes; large leaves are split by hash."""
    import numpy as np
    import pyarrow as pa

    sizes = {r["dim"]: r["count"] for r in nodes.groupBy("dim").count().collect()}  # a row a length
    bits = {d: max(0, math.ceil(math.log2(n / LEAF_ROWS))) if n else 0 for d, n in sizes.items()}

    def coded(batches):
        for batch in batches:
            dims = batch.column(1).to_numpy()
            codes = np.zeros((trees, len(dims)), np.int64)
            for d in np.unique(dims):
                at = np.nonzero(dims == d)[0]
                x = _unit(batch.column(2).take(pa.array(at)).flatten().to_numpy(), int(d))
                for t in range(trees):
                    planes = np.random.default_rng([seed, t, int(d)]).standard_normal((int(d), bits[d]))
                    codes[t, at] = ((x @ planes > 0) @ (1 << np.arange(bits[d]))).astype(np.int64)
            for t in range(trees):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(dims), t, np.int32)), pa.array(codes[t]), *batch.columns],
                    names=["tree", "code", "node", "dim", "embedding", "grp", "open"],
                )

    leaves = nodes.select("node", "dim", "embedding", "grp", "open").mapInArrow(
        coded, "tree int, code long, node long, dim int, embedding array<float>, grp long, open boolean"
    )
    leaves = stage_table(leaves, "leaves")
    counts = leaves.groupBy("tree", "dim", "code").count()
    grouped = (
        leaves.join(counts, ["tree", "dim", "code"])
        .withColumn("part", F.pmod(F.xxhash64("node", "tree"), F.ceil(F.col("count") / (2 * LEAF_ROWS))))
        .groupBy("tree", "dim", "code", "part").agg(
            F.collect_list("node").alias("ids"), F.flatten(F.collect_list("embedding")).alias("flat"),
            F.collect_list("grp").alias("grps"), F.collect_list("open").alias("opens"))
        .filter(F.exists("opens", lambda x: x)).select("dim", "ids", "flat", "grps", "opens")
    )

    def compared(batches):
        for batch in batches:
            parts = []
            for i in range(batch.num_rows):
                ids = batch.column(1)[i].values.to_numpy()
                if len(ids) < 2:
                    continue
                x = _unit(batch.column(2)[i].values.to_numpy(), batch.column(0)[i].as_py())
                grps = batch.column(3)[i].values.to_numpy()
                owners = np.nonzero(batch.column(4)[i].values.to_numpy(zero_copy_only=False))[0]
                near = x[owners] @ x.T
                near[grps[owners, None] == grps[None, :]] = -2
                few = min(k, len(ids) - 1)
                top = np.argpartition(-near, few - 1, axis=1)[:, :few]
                found = np.take_along_axis(near, top, axis=1).ravel()
                real = found > -2
                parts.append((np.repeat(ids[owners], few)[real], ids[top].ravel()[real], found[real]))
            if parts:
                yield _edge_batch(parts, k)

    with rows_a_batch(nodes.sparkSession, 16):
        return stage_table(_lists(grouped.mapInArrow(compared, _EDGE), k), "neighbours")


def _edges(lists: DataFrame) -> DataFrame:
    return lists.select("node", F.explode("near").alias("n")).select("node", "n.other", "n.sim")


def _round(nodes: DataFrame, lists: DataFrame, k: int, seed: int, guides: DataFrame | None = None) -> DataFrame:
    """Lists after every node introduced its neighbours, and those whose neighbour it is, to each other.

    Neighbours in ``guides`` are introduced too, but lists hold neighbours of other groups, and only open nodes have one.
    """
    import numpy as np

    edges = _edges(lists)
    own = edges
    if guides is not None:
        edges = edges.union(_edges(guides))
    back = edges.select(F.col("other").alias("centre"), F.col("node").alias("member"))
    order = Window.partitionBy("centre").orderBy(F.xxhash64("member", F.lit(seed)))
    sampled = back.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= k).drop("_n")
    met = edges.select(F.col("node").alias("centre"), F.col("other").alias("member")).union(sampled)
    met = met.union(edges.select(F.col("node").alias("centre"), F.col("node").alias("member"))).distinct()
    worst = F.when(F.size("near") >= k, F.element_at("near", -1)["sim"]).otherwise(F.lit(-2.0))
    people = nodes.join(lists.select("node", worst.alias("worst")), "node", "left").select(
        F.col("node").alias("member"), "dim", "embedding", "grp",
        F.when(F.col("open"), F.coalesce("worst", F.lit(-2.0))).otherwise(F.lit(2.0)).alias("worst")
    )
    tables = met.join(people, "member").groupBy("centre", "dim").agg(
        F.collect_list("member").alias("ids"), F.collect_list("worst").alias("worst"),
        F.flatten(F.collect_list("embedding")).alias("flat"), F.collect_list("grp").alias("grps"),
    ).select("dim", "ids", "worst", "flat", "grps")

    def introduced(batches):
        for batch in batches:
            parts = []
            for i in range(batch.num_rows):
                ids = batch.column(1)[i].values.to_numpy()
                if len(ids) < 2:
                    continue
                worst = batch.column(2)[i].values.to_numpy()
                x = _unit(batch.column(3)[i].values.to_numpy(), batch.column(0)[i].as_py())
                grps = batch.column(4)[i].values.to_numpy()
                near = x @ x.T
                near[grps[:, None] == grps[None, :]] = -3
                a, b = np.nonzero(near > worst[:, None])
                parts.append((ids[a], ids[b], near[a, b]))
            if parts:
                yield _edge_batch(parts, k)

    with rows_a_batch(nodes.sparkSession, 1000):
        return stage_table(_lists(tables.mapInArrow(introduced, _EDGE).union(own), k), "neighbours")


def _found(lists: DataFrame, threshold: float) -> DataFrame:
    return lists.select("node", F.explode("near").alias("n")).filter(F.col("n.sim") >= threshold).select(
        F.col("node").alias("src"), F.col("n.other").alias("dst")
    )


def audit(nodes: DataFrame, groups: DataFrame, threshold: float, least: int = AUDIT_ROWS) -> float:
    """Of a fixed sample of nodes with links, the mean share of a node's links that lie inside its group.

    All nodes are compared with the sample, of ``least`` nodes or as many as the root of their number.
    """
    import numpy as np
    import pyarrow as pa

    rows = max(least, math.isqrt(nodes.count()))
    sample = nodes.orderBy(F.xxhash64("node", F.lit(99)), "node").limit(rows).collect()
    if not sample:
        return 1.0
    by_dim: dict[int, tuple] = {}
    for d in {r["dim"] for r in sample}:
        own = [r for r in sample if r["dim"] == d]
        by_dim[d] = (np.array([r["node"] for r in own]), _unit([r["embedding"] for r in own], d))

    def linked(batches):
        for batch in batches:
            dims = batch.column(1).to_numpy()
            for d in np.unique(dims):
                if d not in by_dim:
                    continue
                at = np.nonzero(dims == d)[0]
                ids = batch.column(0).to_numpy()[at]
                x = _unit(batch.column(2).take(pa.array(at)).flatten().to_numpy(), int(d))
                a, b = np.nonzero(by_dim[d][1] @ x.T >= threshold)
                src, dst = by_dim[d][0][a], ids[b]
                keep = src != dst
                yield pa.RecordBatch.from_arrays([pa.array(src[keep]), pa.array(dst[keep])],
                                                 names=["src", "dst"])

    links = nodes.select("node", "dim", "embedding").mapInArrow(linked, "src long, dst long")
    a, b = groups.toDF("src", "group_a"), groups.toDF("dst", "group_b")
    inside = F.coalesce((F.col("group_a") == F.col("group_b")).cast("int"), F.lit(0))
    shares = links.join(a, "src", "left").join(b, "dst", "left").groupBy("src").agg(F.avg(inside).alias("share"))
    found = shares.agg(F.avg("share")).first()[0]
    return 1.0 if found is None else found


def _descend(nodes: DataFrame, k: int, threshold: float, seed: int, guides: DataFrame | None = None) -> DataFrame:
    """Lists of the ``k`` nearest nodes of other groups, refined until a round finds no new link."""
    lists = _first_lists(nodes, k, TREES, seed)
    links = _found(lists, threshold).distinct().count()
    for i in range(ROUNDS):
        lists = _round(nodes, lists, k, seed + i, guides)
        before, links = links, _found(lists, threshold).distinct().count()
        if links == before and i + 1 >= MIN_ROUNDS:
            break
    return lists


def _joined_groups(nodes: DataFrame, lists: DataFrame, groups: DataFrame, k: int, threshold: float, seed: int) -> DataFrame:
    """Groups after the saturated lists are enlarged by links that leave the group, until no group has one.

    A list is saturated if even its last neighbour is a link: there may be more, and they may lead to another
    group while the list holds its own group alone. So each such node gets a second list, for nodes of other groups.
    """
    full = lists.filter((F.size("near") >= k) & (F.element_at("near", -1)["sim"] >= threshold)).select(
        "node", F.lit(True).alias("full"))
    full = stage_table(full, "saturated")
    if full.isEmpty():
        return groups
    while True:
        grouped = stage_table(
            nodes.drop("grp", "open").join(groups.withColumnRenamed("component", "grp"), "node", "left")
            .withColumn("grp", F.coalesce("grp", "node")).join(full, "node", "left")
            .withColumn("open", F.coalesce("full", F.lit(False))).drop("full"), "grouped",
        )
        leaving = _found(_descend(grouped, k, threshold, seed, lists), threshold)
        if leaving.isEmpty():
            return groups
        links = groups.select(F.col("node").alias("src"), F.col("component").alias("dst")).union(leaving)
        groups = stage_table(connected_components(links), "groups")


def _link_counts(nodes: DataFrame, groups: DataFrame, threshold: float) -> DataFrame:
    """(node, links): how many vectors of its group each node links with.

    Lists of a dense group are saturated at any fixed length. So every node's list is enlarged to its
    whole group, chunk against chunk, and only the number of links leaves the task.
    """
    import numpy as np
    import pyarrow as pa

    sizes = groups.groupBy("component").agg(F.ceil(F.count("*") / CHUNK_ROWS).alias("chunks"))
    members = (
        nodes.join(groups, "node").join(sizes, "component")
        .withColumn("chunk", F.pmod(F.xxhash64("node", F.lit(3)), F.col("chunks")))
    )
    chunks = stage_table(
        members.groupBy("component", "dim", "chunks", "chunk").agg(
            F.collect_list("node").alias("ids"), F.collect_list("n").alias("ns"),
            F.flatten(F.collect_list("embedding")).alias("flat")), "chunks",
    )
    left = chunks.withColumn("other", F.explode(F.sequence("chunk", F.col("chunks") - 1))).select(
        "component", "dim", F.col("other").alias("chunk"), F.col("ids").alias("left_ids"),
        F.col("ns").alias("left_ns"), F.col("flat").alias("left_flat"),
        (F.col("other") == F.col("chunk")).alias("own"),
    )
    pairs = left.join(chunks.drop("chunks"), ["component", "dim", "chunk"]).select(
        "dim", "own", "left_ids", "left_ns", "left_flat", "ids", "ns", "flat"
    )

    def counted(batches):
        for batch in batches:
            parts = []
            for i in range(batch.num_rows):
                dim, own = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                a, na, x, b, nb, y = (batch.column(c)[i].values.to_numpy() for c in range(2, 8))
                near = _unit(x, dim) @ _unit(y, dim).T >= threshold
                if own:
                    np.fill_diagonal(near, False)
                parts.append((a, near @ nb))
                if not own:
                    parts.append((b, na @ near))
            if parts:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(side).astype(np.int64)) for side in zip(*parts)],
                    names=["node", "links"],
                )

    with rows_a_batch(nodes.sparkSession, 16):
        return stage_table(
            pairs.mapInArrow(counted, "node long, links long").groupBy("node").agg(F.sum("links").alias("links")),
            "link_counts",
        )


def near_duplicates(
    embeddings: DataFrame, threshold: float = THRESHOLD, neighbours: int = NEIGHBOURS, seed: int = 23
) -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row for every row of ``embeddings`` (vec_id, embedding).

    Equal vectors are one node of a neighbour graph. It starts from the leaves of random trees and is
    refined by introducing neighbours of neighbours, until a round finds no new link. Saturated lists are
    enlarged, node by node, by neighbours outside the node's group, until none of these is a link. A fixed sample is
    then compared with all nodes; while its links are not nearly all inside groups, all starts again with lists of
    twice the length, and an error ends it if that does not help. ``n_links`` counts the other rows linked directly.

    Vectors that are null, zero or not finite link with nothing: their component is their own id. So do
    rows without an id; theirs is null and they are not kept. Vectors of different lengths do not link. ``vec_id``
    is taken to name one vector; of rows that repeat each is a link of the others. Other columns, labels too, take no part.
    """
    rows = stage_table(
        embeddings.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<float>"))
        .withColumn("ok", F.col("vec_id").isNotNull() & usable("embedding")), "vectors",
    )
    nodes = stage_table(
        rows.filter("ok").groupBy("embedding").agg(F.min("vec_id").alias("node"), F.count("*").alias("n"))
        .withColumn("dim", F.size("embedding")).withColumn("grp", F.col("node")).withColumn("open", F.lit(True)), "nodes",
    )
    k = neighbours
    for enlargement in range(ENLARGEMENTS + 1):
        lists = _descend(nodes, k, threshold, seed + 100 * enlargement)
        groups = stage_table(connected_components(_found(lists, threshold)), "groups")
        groups = _joined_groups(nodes, lists, groups, k, threshold, seed + 100 * enlargement + 50)
        recall = audit(nodes, groups, threshold)
        if recall >= AUDIT_RECALL:
            break
        k *= 2
    else:
        raise RuntimeError(f"only {recall:.3f} of the sampled links were found with lists of {k // 2}")
    counts = _link_counts(nodes, groups, threshold)
    named = nodes.join(groups, "node", "left").join(counts, "node", "left").select(
        "embedding", F.coalesce("component", "node").alias("component"),
        (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"),
    )
    joined = rows.filter("ok").join(named, "embedding").select("vec_id", "links", "component")
    rest = rows.filter("not ok").select("vec_id", F.lit(0).cast("long"), F.col("vec_id"))
    return joined.union(rest).select(
        "vec_id", F.col("links").alias("n_links"), F.col("component").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.col("component"), F.lit(False)).alias("kept"),
    )
