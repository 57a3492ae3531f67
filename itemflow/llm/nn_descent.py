"""Near-duplicate vectors by NN-descent.

Vectors of a label keep a list of their nearest neighbours. The first lists come from
sorted random signatures; then neighbours of neighbours are compared, round after
round, until hardly a list changes. Lists that hold nothing but links are too short:
they are enlarged while they are short. Then vectors whose list is still full of
links look for the nearest outside their component, by the same descent, and
components merge until none of them finds a link; inside a component links are
counted without being listed. An audit against brute force, on a sample of bounded
size, has to find the sample's links in the lists, else tables and rounds are added.

Equal vectors are one node. Hot neighbours are met in chunks of bounded size.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from itemflow.llm.common import saved
from itemflow.llm.components import connected_components

TABLES = 6
SIGNS = 30
CHUNK = 64
NEIGHBOURS = 8
LONGEST_LIST = 32
# Share of list entries that a round may change in lists that have settled.
SETTLED = 0.01
# Vectors of the audit, the first by a hash of the node: 512 of any number, and eight
# times as many where fewer than 32 of them have links.
AUDITED = 512
LEAST_LINKED = 32
RECALL = 0.98
# Times that tables are added where the audit finds too little.
ADDED = 3
SEED = 7
BLOCK = 1024


def _unit(column: pa.Array) -> np.ndarray:
    """Rows of length one, in double precision. All vectors of a call have one dimension."""
    raw = column.to_pylist()
    x = np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _nodes(vectors: DataFrame, vec_id: str, embedding: str, label: str) -> DataFrame:
    """(node, part, vec, least, n, e, l): distinct usable vectors; part is label and dimension."""
    finite = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.col("l").isNotNull() & F.col("e").isNotNull() & (F.size("e") > 0) & F.coalesce(finite, F.lit(False)) & F.exists("e", lambda x: x != 0)
    rows = vectors.select(F.col(vec_id).alias("v"), F.col(embedding).cast("array<double>").alias("e"), F.col(label).alias("l")).where(usable)
    # 0.0 and -0.0 are one
    rows = rows.withColumn("e", F.transform("e", lambda x: x + F.lit(0.0)))
    distinct = rows.groupBy("l", "e").agg(F.min("v").alias("least"), F.count("*").alias("n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [np.array(x, np.float64) for x in batch.column(1).to_pylist()]
            scaled = [(x / np.abs(x).max()).tobytes() for x in packed]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scaled, pa.binary()), pa.array([len(x) for x in packed], pa.int32())], [*batch.schema.names, "vec", "dim"])

    schema = distinct.withColumns({"vec": F.lit(b""), "dim": F.lit(0)}).schema
    return saved(distinct.mapInArrow(run, schema).withColumn("node", F.monotonically_increasing_id()), "nodes")


def _best(pairs: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """(node, near, size): the nearest of each node, similarity first; lists are bounded."""
    # a pair may have been compared twice, with another last digit
    once = pairs.groupBy("node", "other").agg(F.max("sim").alias("sim"))
    near = F.sort_array(F.collect_list(F.struct("sim", "other")), asc=False)
    lists = once.groupBy("node").agg(near.alias("near"))
    if sizes is None:
        return lists.select("node", F.slice("near", 1, NEIGHBOURS).alias("near"), F.lit(NEIGHBOURS).alias("size"))
    joined = lists.join(sizes.select("node", "size"), "node")
    return joined.select("node", F.slice("near", F.lit(1), F.col("size")).alias("near"), "size")


def _tables(rows: int, least: float) -> int:
    """Tables in which a pair at the threshold, among so many rows of a part, is in one chunk with probability RECALL."""
    same = 1 - math.acos(max(-1.0, min(1.0, least))) / math.pi
    meets = same ** max(0.0, math.log2(max(1, rows) / CHUNK))
    return TABLES if meets >= 1 else max(TABLES, math.ceil(math.log(1 - RECALL) / math.log1p(-meets)))


def _first_lists(nodes: DataFrame, tables: range) -> DataFrame:
    """Neighbours in the order of random signatures, in several tables."""
    return _best(_met(nodes.select("node", "l", "vec", "dim", F.lit(None).cast("bigint").alias("root")), tables))


def _met(rows: DataFrame, tables: range) -> DataFrame:
    """(node, other, sim): the nearest in chunks of each table; those of one root do not meet."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(3).to_numpy()
            for dim in np.unique(dims):
                some = batch.filter(pa.array(dims == dim))
                x = _unit(some.column(2))
                for t in tables:
                    planes = np.random.default_rng([SEED, t, int(dim)]).standard_normal((int(dim), SIGNS))
                    signs = (x @ planes > 0) @ (1 << np.arange(SIGNS - 1, -1, -1, dtype=np.int64))
                    yield pa.RecordBatch.from_arrays([*some.columns, pa.array([t] * len(x), pa.int32()), pa.array(signs)], [*some.schema.names, "t", "sign"])

    schema = rows.withColumns({"t": F.lit(0), "sign": F.lit(0).cast("bigint")}).schema
    order = ["t", "l", "dim", "sign", "node"]
    ordered = rows.mapInArrow(sign, schema).repartitionByRange(*order).sortWithinPartitions(*order)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch] if held is None else [held, batch])
            table = table.combine_chunks().to_batches()[0] if table.num_rows else None
            if table is None:
                continue
            whole = table.num_rows // CHUNK * CHUNK
            for first in range(0, whole, CHUNK):
                yield from _chunk(table.slice(first, CHUNK))
            held = table.slice(whole)
        if held is not None and held.num_rows:
            yield from _chunk(held)

    def _chunk(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        keys = list(zip(*[batch.column(c).to_pylist() for c in (5, 1, 3)]))
        first = 0
        while first < len(keys):
            last = first
            while last < len(keys) and keys[last] == keys[first]:
                last += 1
            part = batch.slice(first, last - first)
            first = last
            if part.num_rows < 2:
                continue
            x = _unit(part.column(2))
            yield _nearest(part.column(0).to_numpy(), part.column(0).to_numpy(), _similar(x, part.column(4)), NEIGHBOURS, None)

    return ordered.mapInArrow(meet, "node long, other long, sim double")


def _similar(x: np.ndarray, roots: pa.Array) -> np.ndarray:
    """Cosines; -2 for a vector with itself and with those of its root, where it has one."""
    sims = x @ x.T
    np.fill_diagonal(sims, -2)
    if roots.null_count < len(roots):
        root = roots.fill_null(-1).to_numpy()
        sims[(root[:, None] == root[None, :]) & (root >= 0)] = -2
    return sims


def _nearest(rows: np.ndarray, columns: np.ndarray, sims: np.ndarray, most: int, low: np.ndarray | None) -> pa.RecordBatch:
    """The best columns of each row, those above the row's bound."""
    k = min(most, sims.shape[1])
    top = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    best = np.take_along_axis(sims, top, 1)
    good = best > (-1.5 if low is None else low[:, None])
    i, j = np.nonzero(good)
    return pa.RecordBatch.from_arrays([pa.array(rows[i]), pa.array(columns[top[i, j]]), pa.array(best[i, j])], ["node", "other", "sim"])


def _low() -> Column:
    """What a neighbour has to exceed to enter a list."""
    return F.when(F.size("near") < F.col("size"), F.lit(-1.5)).otherwise(F.element_at("near", -1)["sim"])


def _round(edges: DataFrame, known: DataFrame) -> DataFrame:
    """Pairs better than what their first node has, found among neighbours of a common node.

    ``edges``: (node, hub), the neighbours; ``known``: (member, vec, low, root), where a null
    low takes all and vectors of one root are not compared.

    Every node calls its neighbours and those that list it. The latter come in chunks
    of bounded size, each with the neighbours, so that a node that very many list is
    many groups, and each of them is small.
    """
    crowd = edges.groupBy("hub").agg(F.ceil(F.count("*") / CHUNK).alias("chunks"))
    callers = edges.join(crowd, "hub").select("hub", F.pmod(F.xxhash64("node"), F.col("chunks")).alias("chunk"), F.col("node").alias("member"), F.lit(True).alias("calls"))
    called = edges.join(crowd.withColumnRenamed("hub", "h"), F.col("node") == F.col("h")).select(
        F.col("node").alias("hub"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1)).alias("chunk"), F.col("hub").alias("member"), F.lit(False).alias("calls")
    )
    members = callers.unionByName(called).groupBy("hub", "chunk", "member").agg(F.max("calls").alias("calls"))
    rows = members.join(known, "member").select("hub", "chunk", "member", "vec", "low", "root")
    grouped = rows.repartition("hub", "chunk").sortWithinPartitions("hub", "chunk", "member")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            hub, chunk = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = np.flatnonzero((np.diff(hub) != 0) | (np.diff(chunk) != 0)) + 1
            starts = [0, *cuts.tolist()]
            yield from _groups(batch, list(zip(starts, starts[1:])))
            held = batch.slice(starts[-1])
        if held is not None:
            yield from _groups(held, [(0, held.num_rows)])

    def _groups(batch: pa.RecordBatch, spans: list[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
        out = []
        for a, b in spans:
            if b - a < 2:
                continue
            part = batch.slice(a, b - a)
            ids = part.column(2).to_numpy()
            x = _unit(part.column(3))
            bound = part.column(4).fill_null(-1.5).to_numpy()
            out.append(_nearest(ids, ids, _similar(x, part.column(5)), LONGEST_LIST, bound))
            if len(out) >= 256:
                yield from pa.Table.from_batches(out).combine_chunks().to_batches()
                out = []
        if out:
            yield from pa.Table.from_batches(out).combine_chunks().to_batches()

    return grouped.mapInArrow(run, "node long, other long, sim double")


def _listed(lists: DataFrame, least: float) -> DataFrame:
    pairs = lists.select(F.col("node").alias("a"), F.explode("near").alias("e")).where(F.col("e.sim") >= least)
    return pairs.select("a", F.col("e.other").alias("b"))


def _roots(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, root) of the nodes with links."""
    linked = connected_components(edges).withColumnsRenamed({"a": "node", "b": "root"})
    own = linked.select(F.col("root").alias("node"), "root").distinct()
    return saved(linked.unionByName(own), "roots")


def audit(nodes: DataFrame, lists: DataFrame, roots: DataFrame, least: float) -> tuple[float, DataFrame]:
    """(recall, the sample's links that do not join one component).

    The sample is compared with every vector: a fixed number of queries against all
    rows, in blocks. Recall is the mean over the sampled vectors that have links: the
    share of a vector's links that a list of either end names, of as many as the
    longest list can, or the share that joins one component if that is less.
    """
    listed = _listed(lists, least)
    listed = listed.unionByName(listed.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct().withColumn("listed", F.lit(True))
    root = roots.select("node", "root")
    for size in (AUDITED, 8 * AUDITED):
        links, asked = _links_of_sample(nodes, size, least)
        seen = links.join(root.withColumnsRenamed({"node": "a", "root": "ra"}), "a", "left").join(root.withColumnsRenamed({"node": "b", "root": "rb"}), "b", "left")
        same = F.coalesce(F.col("ra") == F.col("rb"), F.lit(False))
        checked = saved(seen.join(listed, ["a", "b"], "left").select("a", "b", same.alias("found"), F.coalesce("listed", F.lit(False)).alias("listed")), "audit")
        each = checked.groupBy("b").agg(F.count("*").alias("n"), F.sum(F.col("found").cast("int")).alias("found"), F.sum(F.col("listed").cast("int")).alias("listed"))
        share = F.least(F.col("found") / F.col("n"), F.col("listed") / F.least(F.col("n"), F.lit(LONGEST_LIST)))
        total = each.agg(F.count("*").alias("n"), F.avg(share).alias("recall")).first()
        if total.n >= LEAST_LINKED or asked < size:
            break
    return (total.recall if total.n else 1.0), checked.where("not found").select("a", "b")


def _links_of_sample(nodes: DataFrame, size: int, least: float) -> tuple[DataFrame, int]:
    """(a, b): all links of the sampled vectors, which are b; how many were sampled."""
    sample = nodes.select("node", "l", "dim", "vec").orderBy(F.xxhash64("node"), "node").limit(size).collect()
    parts: dict[tuple, tuple[np.ndarray, np.ndarray]] = {}
    for key in {(r.l, r.dim) for r in sample}:
        some = [r for r in sample if (r.l, r.dim) == key]
        x = np.frombuffer(b"".join(bytes(r.vec) for r in some), np.float64).reshape(len(some), -1)
        parts[key] = (np.array([r.node for r in some]), x / np.linalg.norm(x, axis=1, keepdims=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = list(zip(batch.column(1).to_pylist(), batch.column(3).to_pylist()))
            for key in set(keys):
                if key not in parts:
                    continue
                ids, queries = parts[key]
                some = batch.filter(pa.array([k == key for k in keys]))
                i, j = np.nonzero(_unit(some.column(2)) @ queries.T >= least)
                a, b = some.column(0).to_numpy()[i], ids[j]
                yield pa.RecordBatch.from_arrays([pa.array(a[a != b]), pa.array(b[a != b])], ["a", "b"])

    return nodes.select("node", "l", "vec", "dim").mapInArrow(run, "a long, b long"), len(sample)


def _entries(lists: DataFrame) -> DataFrame:
    return lists.select("node", F.explode("near").alias("e")).select("node", "e.other", "e.sim")


def _full(least: float) -> Column:
    """The list holds nothing but links."""
    return (F.size("near") >= F.col("size")) & (F.element_at("near", -1)["sim"] >= least)


def _settled(lists: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """Lists after rounds until hardly an entry changes and no list has to grow."""
    while True:
        edges = _entries(lists).select("node", F.col("other").alias("hub"))
        bounds = lists.select(F.col("node").alias("member"), _low().alias("low"))
        known = nodes.select(F.col("node").alias("member"), "vec", F.lit(None).cast("bigint").alias("root")).join(bounds, "member", "left")
        pairs = _round(edges, known)
        size = F.when(_full(least), LONGEST_LIST).otherwise(F.col("size"))
        before = lists.select("node", size.alias("size"), F.col("near.other").alias("was"))
        after = _best(pairs.unionByName(_entries(lists)), before).join(before.select("node", "was"), "node")
        fresh = F.size(F.array_except("near.other", "was"))
        marked = saved(after.select("node", "near", "size", fresh.alias("fresh")), "lists")
        lists = marked.drop("fresh")
        grows = _full(least) & (F.col("size") < LONGEST_LIST)
        seen = marked.agg(F.sum("fresh").alias("fresh"), F.sum(F.size("near")).alias("n"), F.max(grows).alias("grows")).first()
        if not seen.n or (seen.fresh < SETTLED * seen.n and not seen.grows):
            return lists


def _bridged(lists: DataFrame, nodes: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """(links of the lists and of those between components whose lists are full, their roots).

    Vectors whose list is full of links look for neighbours outside their component.
    First those of a chunk meet, of all such vectors and of about NEIGHBOURS of each
    component, so that a large one does not hide the others; then neighbours of neighbours,
    inside and outside. Every round's links merge components at once, all of them in one
    step: where each component finds another, their number halves at least. It ends when
    no round finds a link and hardly a vector's nearest outside changes.
    """
    edges = _listed(lists, least)
    roots = _roots(nodes, edges)
    full = saved(lists.where(_full(least)).select("node").join(nodes.select("node", "l", "dim", "vec"), "node"), "full")
    inside = saved(lists.join(full.select("node"), "node").select("node", F.explode(F.slice("near", 1, NEIGHBOURS)).alias("e")).select("node", F.col("e.other").alias("hub")), "inside")
    outside = None
    merged = True
    first = 0
    while True:
        if merged:
            own = full.join(roots, "node")
            several = own.groupBy("l", "dim").agg(F.count("*").alias("rows"), F.countDistinct("root").alias("roots")).where("roots > 1").withColumnsRenamed({"l": "s_l", "dim": "s_dim"})
            own = saved(own.join(several, (F.col("l") == F.col("s_l")) & (F.col("dim") == F.col("s_dim"))).select("node", "l", "vec", "dim", "root", "rows"), "apart")
            most = own.agg(F.max("rows")).first()[0]
            if most is None:
                return edges, roots
            own = own.drop("rows")
            root = own.select("node", "root")
            tables = range(first, first + _tables(most, least))
            first = tables.stop
            few = own.groupBy("root").agg(F.ceil(F.count("*") / NEIGHBOURS).alias("m"))
            some = own.join(few, "root").where(F.pmod(F.xxhash64(F.lit(first), "node"), "m") == 0).select(*own.columns)
            seeds = _met(own, tables).unionByName(_met(some, tables))
            if outside is not None:
                # components that have merged are no longer outside each other
                kept = _entries(outside).join(root, "node").join(root.withColumnsRenamed({"node": "other", "root": "r"}), "other").where("root <> r")
                seeds = seeds.unionByName(kept.select("node", "other", "sim"))
            outside = saved(_best(seeds), "outside")
        hubs = _entries(outside).select("node", F.col("other").alias("hub")).unionByName(inside.join(own.select("node"), "node")).distinct()
        bounds = outside.select(F.col("node").alias("member"), _low().alias("low"))
        known = own.select(F.col("node").alias("member"), "vec", "root").join(bounds, "member", "left")
        was = outside.select("node", F.col("near.other")[0].alias("was"))
        after = _best(_round(hubs, known).unionByName(_entries(outside))).join(was, "node", "left")
        fresh = (~F.col("near.other")[0].eqNullSafe(F.col("was"))).cast("int")
        marked = saved(after.select("node", "near", "size", fresh.alias("fresh")), "outside")
        outside = marked.drop("fresh")
        links = F.exists("near", lambda x: x["sim"] >= least)
        seen = marked.agg(F.sum("fresh").alias("fresh"), F.count("*").alias("n"), F.max(links).alias("links")).first()
        merged = bool(seen.links)
        if merged:
            edges = edges.unionByName(_listed(outside, least))
            roots = _roots(nodes, edges)
        elif not seen.n or seen.fresh < SETTLED * seen.n:
            return edges, roots


def neighbour_graph(nodes: DataFrame, least: float) -> tuple[DataFrame, float]:
    """(node, root) of the nodes with links, and the recall of the audit."""
    most = nodes.groupBy("l", "dim").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    tables = _tables(most, least)
    lists = saved(_first_lists(nodes, range(tables)), "lists")
    for turn in range(ADDED + 1):
        lists = _settled(lists, nodes, least)
        edges, roots = _bridged(lists, nodes, least)
        recall, missed = audit(nodes, lists, roots, least)
        if recall >= RECALL or turn == ADDED:
            break
        more = _first_lists(nodes, range((turn + 1) * tables, (turn + 2) * tables))
        sizes = lists.select("node", "size").unionByName(more.select("node", "size")).groupBy("node").agg(F.max("size").alias("size"))
        lists = saved(_best(_entries(lists).unionByName(_entries(more)), sizes), "lists")
    if recall < RECALL:
        warnings.warn(f"near vectors: the audit finds {recall:.4f} of its links, less than {RECALL}", RuntimeWarning, stacklevel=2)
    if not missed.isEmpty():
        roots = _roots(nodes, edges.unionByName(missed))
    return roots, recall


def count_links(members: DataFrame, least: float) -> DataFrame:
    """(node, links) of members (root, node, vec, n): the vectors of its component that each links with.

    Members within half the angle of the threshold from the centre of their component
    link with each other, all of them, without being compared. The rest, the rim, is
    compared with all members, in blocks of bounded size.
    """

    def scale(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(_lists(batch.column(1))), pa.list_(pa.float64()))], ["root", "x"])

    def _lists(column: pa.Array) -> Iterator[np.ndarray]:
        for raw in column.to_pylist():
            x = np.frombuffer(raw, np.float64)
            yield x / np.linalg.norm(x)

    units = members.select("root", "vec").mapInArrow(scale, "root long, x array<double>")
    sums = units.select("root", F.posexplode("x").alias("d", "x")).groupBy("root", "d").agg(F.sum("x").alias("x"))
    centre = sums.groupBy("root").agg(F.sort_array(F.collect_list(F.struct("d", "x"))).alias("c")).select("root", F.col("c.x").alias("c"))
    near = math.cos(math.acos(least) / 2) + 1e-9
    dot = F.aggregate(F.zip_with("x", "c", lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    length = lambda c: F.sqrt(F.aggregate(c, F.lit(0.0), lambda a, b: a + b * b))

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(_lists(batch.column(2))), pa.list_(pa.float64()))], [*batch.schema.names, "x"])

    rows = members.select("root", "node", "vec", "n").mapInArrow(unpack, "root long, node long, vec binary, n long, x array<double>")
    placed = rows.join(centre, "root").select("root", "node", "vec", "n", (dot >= near * length("c")).alias("core"))
    placed = saved(placed, "members")
    sizes = placed.groupBy("root").agg(
        F.sum(F.when(F.col("core"), F.col("n")).otherwise(0)).alias("core_n"), F.sum(F.when(F.col("core"), 0).otherwise(1)).alias("rim"), F.count("*").alias("size")
    )
    sizes = saved(sizes, "sizes")
    inside = placed.where("core").join(sizes, "root").select("node", (F.col("core_n") - 1).alias("links"))
    blocks = sizes.where("rim > 0").select("root", F.ceil(F.col("rim") / BLOCK).alias("rims"), F.ceil(F.col("size") / BLOCK).alias("alls"))
    named = placed.join(blocks, "root").withColumn("h", F.xxhash64("node"))
    every = lambda c: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(c) - 1))
    as_rim = named.where("not core").select("root", F.pmod("h", "rims").alias("rb"), every("alls").alias("mb"), "node", "vec", "n", "core", F.lit(True).alias("asks"))
    as_all = named.select("root", every("rims").alias("rb"), F.pmod("h", "alls").alias("mb"), "node", "vec", "n", "core", F.lit(False).alias("asks"))

    def compare(key: tuple, group: pa.Table) -> pa.Table:
        asks = np.array(group.column("asks"))
        rim, others = group.filter(pa.array(asks)), group.filter(pa.array(~asks))
        if not rim.num_rows or not others.num_rows:
            return pa.table({"node": pa.array([], pa.int64()), "links": pa.array([], pa.int64())})
        a, b = rim.column("node").to_numpy(), others.column("node").to_numpy()
        n_a, n_b = rim.column("n").to_numpy(), others.column("n").to_numpy()
        linked = (_unit(rim.column("vec")) @ _unit(others.column("vec")).T >= least) | (a[:, None] == b[None, :])
        own = (a[:, None] == b[None, :]) @ np.ones(len(b), np.int64)
        core = np.array(others.column("core"))
        to_core = (linked[:, core].T @ n_a).astype(np.int64)
        return pa.table({"node": pa.array(np.concatenate([a, b[core]])), "links": pa.array(np.concatenate([linked @ n_b - own, to_core]).astype(np.int64))})

    outside = as_rim.unionByName(as_all).groupBy("root", "rb", "mb").applyInArrow(compare, "node long, links long")
    return inside.unionByName(outside).groupBy("node").agg(F.sum("links").alias("links"))


def near_vectors(vectors: DataFrame, least: float = 0.93, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    Vectors of one label, and one dimension, link if their cosine in double precision
    is at least ``least``. n_links: other rows linked directly; component_id: the least
    vec_id reached; kept: this row has it.

    Rows with a null label, and vectors that are null, empty, zero or hold nulls or
    numbers that are not finite, link with nothing and are their own component. Equal
    vectors link with each other. Null vec_ids never name a component, unless alone:
    then it is null and the row is kept. An empty table gives an empty result. Other
    columns are not looked at.
    """
    nodes = _nodes(vectors, vec_id, embedding, label)
    roots, _ = neighbour_graph(nodes, least)
    members = nodes.join(roots, "node").select("root", "node", "vec", "n")
    counted = count_links(members, least)
    least_of = nodes.join(roots, "node").groupBy("root").agg(F.min("least").alias("of_all"))
    answers = nodes.join(roots.join(least_of, "root"), "node", "left").join(counted, "node", "left").select(
        F.col("l").alias("a_l"), F.col("e").alias("a_e"),
        (F.coalesce("links", F.col("n") - 1)).alias("n_links"), F.coalesce("of_all", "least").alias("of_all"),
    )
    # equal vectors meet again by the vector itself
    value = F.transform(F.col(embedding).cast("array<double>"), lambda x: x + F.lit(0.0))
    rows = vectors.select(F.col(vec_id).alias("vec_id"), value.alias("e"), F.col(label).alias("l"))
    joined = rows.join(answers, (F.col("l") == F.col("a_l")) & (F.col("e") == F.col("a_e")), "left")
    component = F.when(F.col("a_l").isNull(), F.col("vec_id")).otherwise(F.col("of_all"))
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id")).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id"))
    )
