"""SimHash near-duplicates by a binary trie self-join.

A-Z become a-z; words are runs of ``[^\\x20\\x09-\\x0D]+``; shingles are three words
joined by a space, repeats included (fewer words: the whole sequence; none:
fingerprint zero, linked like any other).  A fingerprint bit is 1 if it is set
in over half of the shingles' XXH64 values (seed 42).  Fingerprints link when
at most three bits differ; a component is what links reach.

Distinct fingerprints form a binary trie.  Its upper part is cut into nodes of
a bounded number of fingerprints, deeper where there are more of them.  First
each node is joined with itself, which gives every fingerprint the smallest one
that links reach inside its node.  Then every two nodes whose prefixes differ in
no more bits than the budget are joined: the pair descends together, adds up
differing bits, and ends where the budget is exceeded or where both sides are
already one component.  So a dense group costs no square, and a task gives at
most one link per two components.  These links, between groups only, become
components by alternating star contraction in Spark.

Null and empty texts have no words.  A null doc_id gets a row like any other,
but names no component; a component without any doc_id has a null id.  Repeated
rows give a row each.  An empty table gives none.  Further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.arrow import LOWER, buffers, byte_table, send_code, slices, strings
from starloom.session import stage_table

SHINGLE = 3
BUDGET = 3
SEED = 42

#: Fingerprints of one trie node, at most and at least aimed at.
NODE_ROWS = (2_048, 65_536)

#: About how many nodes there are at most; beyond it, nodes grow.
MOST_NODES = 4_096

#: Fingerprints for which there is a task of a join; tasks are counted by rows, as joins take time and not space.
TASK_ROWS = 100_000

_SPACE = byte_table((0x20, 0x20), (0x09, 0x0D))
_LANES = np.uint64(0x0101010101010101)


def fingerprints(texts: pa.Array) -> np.ndarray:
    """The fingerprint of each text, as unsigned 64-bit values."""
    data, at = buffers(texts)
    n = len(texts)
    space = _SPACE[data]
    # one space for every run of white space, so a shingle is one range of bytes
    keep = ~space
    if len(data):
        first = np.zeros(len(data), bool)
        first[at[:-1][at[:-1] < len(data)]] = True
        keep[1:] |= ~space[:-1] & ~first[1:]
    moved = np.concatenate(([0], np.cumsum(keep)))
    at = moved[at]
    space = space[keep]
    joined = np.where(space, np.uint8(0x20), LOWER[data[keep]])
    inside = ~space
    before, after = np.zeros(len(inside), bool), np.zeros(len(inside), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    cut = at[(at > 0) & (at < len(inside))]
    before[cut], after[cut - 1] = False, False
    begin = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    bounds = np.searchsorted(begin, at)
    count = np.diff(bounds)
    rows = np.flatnonzero(count)
    out = np.zeros(n, np.uint64)
    if not len(rows):
        return out
    shingles = np.maximum(count[rows] - SHINGLE + 1, 1)
    heads = np.concatenate(([0], np.cumsum(shingles)))
    index = np.arange(heads[-1]) - np.repeat(heads[:-1], shingles) + np.repeat(bounds[:-1][rows], shingles)
    last = np.minimum(index + SHINGLE, np.repeat(bounds[1:][rows], shingles)) - 1
    text, digest = joined.tobytes(), xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(text[a:b], SEED) for a, b in zip(begin[index].tolist(), end[last].tolist())),
        np.uint64, len(index),
    )
    # eight sums of bytes in one word hold the counts of up to 255 values
    runs = -(-shingles // 255)
    run_at = np.concatenate(([0], np.cumsum(runs)))
    cuts = np.repeat(heads[:-1], runs) + 255 * (np.arange(run_at[-1]) - np.repeat(run_at[:-1], runs))
    found = np.zeros(len(rows), np.uint64)
    for shift in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(shift)) & _LANES, cuts)
        sums = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), run_at[:-1], axis=0)
        bits = 2 * sums > shingles[:, None]
        for byte in range(8):
            found |= bits[:, byte].astype(np.uint64) << np.uint64(8 * byte + shift)
    out[rows] = found
    return out


def with_fingerprint(docs: DataFrame, name: str = "_llm_fp") -> DataFrame:
    """All columns of ``docs`` and the fingerprint of its text, as a signed long."""
    send_code(docs.sparkSession)
    column = docs.columns.index("text")
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())])

    def task(batches):
        for batch in batches:
            texts = strings(batch.column(column))
            for a, b in slices(texts):
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(a, b - a).columns, pa.array(fingerprints(texts[a:b]).view(np.int64))],
                    [*batch.schema.names, name],
                )

    return docs.mapInArrow(task, schema)


# --- the trie ---------------------------------------------------------------------------------------------------


class _Groups:
    """Which entries are known to be connected; ``label`` is each entry's root."""

    def __init__(self, label: np.ndarray):
        self.label = label

    def join(self, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
        """Connect entries; returns the pairs of roots that were joined."""
        x, y = self.label[a], self.label[b]
        new = x != y
        if not new.any():
            return []
        pairs = np.unique(np.stack([np.minimum(x[new], y[new]), np.maximum(x[new], y[new])], 1), axis=0)
        parent: dict[int, int] = {}

        def root(v: int) -> int:
            while (p := parent.get(v, v)) != v:
                parent[v] = parent.get(p, p)
                v = p
            return v

        joined = []
        for p, q in pairs.tolist():
            rp, rq = root(p), root(q)
            if rp != rq:
                parent[max(rp, rq)] = min(rp, rq)
                joined.append((p, q))
        to = np.arange(len(self.label))
        for v in parent:
            to[v] = root(v)
        self.label = to[self.label]
        return joined


def _trie_join(values: np.ndarray, groups: _Groups, left: tuple[int, int], right: tuple[int, int], depth: int,
               budget: int = BUDGET, chunk: int = 100_000) -> list[tuple[int, int]]:
    """Connect the entries of two nodes that differ in at most ``budget`` bits.

    ``values`` are sorted inside each of the two ranges, which are equal for a
    self-join.  The first ``depth`` bits are the ranges' common prefixes.
    """
    joined: list[tuple[int, int]] = []

    def row(x):
        return np.array([x], np.int64)

    apart = 0
    if left != right:
        apart = int(np.bitwise_count((values[left[0]] ^ values[right[0]]) >> np.uint64(64 - depth))) if depth else 0
    stack = [(depth, row(left[0]), row(left[1]), row(right[0]), row(right[1]), row(apart))]
    while stack:
        depth, a, b, c, d, far = stack.pop()
        label = groups.label
        change = np.concatenate(([0], np.cumsum(label[1:] != label[:-1])))
        one = (change[b - 1] == change[a]) & (change[d - 1] == change[c]) & (label[a] == label[c])
        open_ = (far <= budget) & ~one
        a, b, c, d, far = a[open_], b[open_], c[open_], d[open_], far[open_]
        if not len(a):
            continue
        if len(a) > chunk:
            for k in range(0, len(a), chunk):
                s = slice(k, k + chunk)
                stack.append((depth, a[s], b[s], c[s], d[s], far[s]))
            continue
        size = (b - a) * (d - c)
        leaf = (size <= 32) | (depth == 64)
        if leaf.any():
            la, lc, width, total = a[leaf], c[leaf], (d - c)[leaf], size[leaf]
            k = np.arange(total.sum()) - np.repeat(np.cumsum(total) - total, total)
            i = np.repeat(la, total) + k // np.repeat(width, total)
            j = np.repeat(lc, total) + k % np.repeat(width, total)
            near = np.bitwise_count(values[i] ^ values[j]) <= budget
            joined += groups.join(i[near], j[near])
            a, b, c, d, far = a[~leaf], b[~leaf], c[~leaf], d[~leaf], far[~leaf]
            if not len(a):
                continue
        m, o = _middle(values, a, b, depth, left), _middle(values, c, d, depth, right)
        own = (a == c) & (b == d)
        parts = [
            (a, m, c, o, far, None), (m, b, o, d, far, None),
            (a, m, o, d, far + 1, None), (m, b, c, o, far + 1, ~own),
        ]
        columns = []
        for pa_, pb, pc, pd, pf, only in parts:
            full = (pa_ < pb) & (pc < pd) & (pf <= budget)
            if only is not None:
                full &= only
            columns.append([x[full] for x in (pa_, pb, pc, pd, pf)])
        # near pairs are taken first: they connect groups and so spare others
        apart_ = [np.concatenate(x) for x in zip(columns[2], columns[3])]
        same = [np.concatenate(x) for x in zip(columns[0], columns[1])]
        for found in (apart_, same):
            if len(found[0]):
                stack.append((depth + 1, *found))
    return joined


def _middle(values: np.ndarray, begin: np.ndarray, end: np.ndarray, depth: int, within: tuple[int, int]) -> np.ndarray:
    """Where, in each range, the bit at ``depth`` becomes 1."""
    low = np.uint64(63 - depth)
    pivot = ((values[begin] >> low) | np.uint64(1)) << low
    at = within[0] + np.searchsorted(values[within[0] : within[1]], pivot)
    return np.clip(at, begin, end)


def _node_table(prints: DataFrame, rows: int) -> list[tuple[int, int]]:
    """(first value, depth) of the trie's nodes, cut until none holds over ``rows`` fingerprints.

    Reads counts by prefix, eight bits deeper at a time and only inside nodes
    that are too large, so what comes to the driver is bounded by
    256 * fingerprints / rows.
    """
    unsigned = F.col("fp")
    done, open_, depth = [], None, 0
    while True:
        depth += 8
        prefix = F.shiftrightunsigned(unsigned, 64 - depth) if depth < 64 else unsigned
        source = prints
        if open_ is not None:
            above = F.shiftrightunsigned(unsigned, 64 - depth + 8)
            source = prints.join(F.broadcast(prints.sparkSession.createDataFrame([(x,) for x in open_], "above long")),
                                 above == F.col("above"), "left_semi")
        counts = {int(r[0]) & ((1 << depth) - 1): r[1] for r in source.groupBy(prefix.alias("p")).count().collect()}
        open_ = []

        def cut(low: int, high: int, keys: list[int], at: int) -> None:
            """Prefixes low..high of ``depth`` bits share their first ``at`` bits."""
            inside = [k for k in keys if low <= k < high]
            if not inside:
                return
            if sum(counts[k] for k in inside) <= rows:
                done.append((low << (64 - depth), at))
            elif at == depth:
                if depth == 64:
                    done.append((low, 64))
                else:
                    open_.append(low)
            else:
                half = (low + high) // 2
                cut(low, half, inside, at + 1)
                cut(half, high, inside, at + 1)

        keys = sorted(counts)
        for top in sorted({k >> 8 for k in keys}) if depth > 8 else [0]:
            cut(top << 8, (top + 1) << 8, [k for k in keys if k >> 8 == top], depth - 8)
        if not open_:
            return sorted(done)


def _near_nodes(nodes: list[tuple[int, int]], budget: int = BUDGET) -> np.ndarray:
    """Pairs (i < j) of nodes whose prefixes differ in at most ``budget`` bits."""
    first = np.array([x for x, _ in nodes], np.uint64)
    depth = np.array([x for _, x in nodes], np.uint64)
    found = [np.zeros((0, 2), np.int64)]
    for i in range(len(nodes)):
        common = np.minimum(depth[i], depth[i + 1 :])
        differ = first[i] ^ first[i + 1 :]
        shift = np.uint64(64) - common
        differ = np.where(common == 0, np.uint64(0), differ >> np.minimum(shift, np.uint64(63)))
        j = np.flatnonzero(np.bitwise_count(differ) <= budget) + i + 1
        found.append(np.stack([np.full(len(j), i), j], 1))
    return np.concatenate(found)


def _self_join(table: pa.Table) -> pa.Table:
    """One node: each fingerprint with the smallest it is connected with."""
    values = np.sort(table.column("fp").to_numpy().view(np.uint64))
    groups = _Groups(np.arange(len(values)))
    _trie_join(values, groups, (0, len(values)), (0, len(values)), 0)
    return pa.table({"fp": values.view(np.int64), "label": values[groups.label].view(np.int64)})


def _pair_join(depth: int, a: np.ndarray, la: np.ndarray, b: np.ndarray, lb: np.ndarray) -> list[tuple[int, int]]:
    """Links between the labels of two nodes, no more than it takes to connect them."""
    x, y = np.argsort(a), np.argsort(b)
    values = np.concatenate([a[x], b[y]])
    names = np.concatenate([la[x], lb[y]])
    known, inverse = np.unique(names, return_inverse=True)
    first = np.full(len(known), len(values))
    np.minimum.at(first, inverse, np.arange(len(values)))
    groups = _Groups(first[inverse])
    links = _trie_join(values, groups, (0, len(a)), (len(a), len(values)), depth)
    return [(int(names[p]), int(names[q])) for p, q in links]


def components(prints: DataFrame, node_rows: int | None = None) -> DataFrame:
    """(fp, root): the component of each distinct fingerprint, by the fingerprint that names it.

    ``prints`` has distinct ``fp`` and is read several times: pass a stored table.
    """
    spark = prints.sparkSession
    n = prints.count()
    rows = node_rows or max(min(max(n // 64, NODE_ROWS[0]), NODE_ROWS[1]), n // MOST_NODES)
    nodes = _node_table(prints, rows)
    if not nodes:
        return prints.select("fp", F.col("fp").alias("root"))
    pairs = _near_nodes(nodes)
    first = np.array([x for x, _ in nodes], np.uint64)
    depth = np.array([x for _, x in nodes], np.int64)
    shared = spark.sparkContext.broadcast((first, depth, pairs))

    def place(batches):
        first, _, _ = shared.value
        for batch in batches:
            fp = batch.column(0)
            at = np.searchsorted(first, fp.to_numpy(zero_copy_only=False).view(np.uint64), "right") - 1
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), fp], ["node", "fp"])

    def alone(key, table):
        out = _self_join(table)
        return out.append_column("node", pa.array([key[0].as_py()] * out.num_rows, pa.int64())).select(
            ["node", "fp", "label"])

    def tasks(copies: int) -> int:
        return min(max(-(-n * copies // TASK_ROWS), 8), 20_000)

    labelled = stage_table(
        prints.select("fp").mapInArrow(place, "node long, fp long").repartition(min(tasks(1), len(nodes)), "node")
        .groupBy("node").applyInArrow(alone, "node long, fp long, label long"),
        "simhash_labels",
    )

    def copies(batches):
        _, _, pairs = shared.value
        both = np.concatenate([pairs[:, 0], pairs[:, 1]])
        number = np.tile(np.arange(len(pairs)), 2)
        order = np.argsort(both, kind="stable")
        both, number = both[order], number[order]
        for batch in batches:
            node = batch.column(0).to_numpy()
            low, high = np.searchsorted(both, node), np.searchsorted(both, node, "right")
            for begin in range(0, len(node), 2_000):
                s = slice(begin, begin + 2_000)
                count = high[s] - low[s]
                row = np.repeat(np.arange(len(count)), count)
                k = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low[s], count)
                part = batch.slice(begin, 2_000).take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(number[k]), *part.columns], ["pair", "node", "fp", "label"])

    def cross(key, table):
        _, depth, pairs = shared.value
        i, j = pairs[key[0].as_py()]
        node = table.column("node").to_numpy()
        fp = table.column("fp").to_numpy().view(np.uint64)
        label = table.column("label").to_numpy().view(np.uint64)
        x, y = node == i, node == j
        links = _pair_join(int(min(depth[i], depth[j])), fp[x], label[x], fp[y], label[y]) if x.any() and y.any() else []
        links = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
        return pa.table({"a": links[:, 0], "b": links[:, 1]})

    links = (
        labelled.select("node", "fp", "label").mapInArrow(copies, "pair long, node long, fp long, label long")
        # a node is in so many pairs on the average
        .repartition(tasks(-(-2 * len(pairs) // len(nodes))), "pair")
        .groupBy("pair").applyInArrow(cross, "a long, b long")
    )
    roots = connect(stage_table(links, "simhash_links"))
    return (
        labelled.join(roots, labelled["label"] == roots["node"], "left")
        .select("fp", F.coalesce("root", "label").alias("root"))
    )


def connect(links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links`` (a, b) but the roots themselves.

    Large-star and small-star rounds; each joins links with one minimum per
    node, so no neighbourhood is gathered, and writes the links it leaves.
    """
    links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = stage_table(links, "links")
    state = None
    while True:
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now[0] == 0 or now == state:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = now
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # every larger neighbour to the smallest one
        large = (
            links.select(F.col("b").alias("a"), F.col("a").alias("v")).join(least, "a")
            .select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        )
        large = stage_table(large, "large")
        # every node and its smaller neighbours to the smallest one
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
            .unionByName(down.select("a", F.col("m").alias("b")))
            .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        )
        links = stage_table(small, "links")


def _with_component(ids: DataFrame, node_rows: int | None) -> DataFrame:
    """(fp, root, component_id) of stored rows (doc_id, fp)."""
    prints = stage_table(ids.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash_prints")
    found = components(prints.select("fp"), node_rows).join(prints, "fp")
    found = stage_table(found, "simhash_components")
    least = found.groupBy("root").agg(F.min("first").alias("component_id"))
    return stage_table(found.join(least, "root").select("fp", "root", "component_id"), "simhash_ids")


def simhash_components(docs: DataFrame, node_rows: int | None = None) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (the smallest doc_id that links reach)."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ids = stage_table(with_fingerprint(plain, "fp").select("doc_id", "fp"), "simhash")
    of = _with_component(ids, node_rows)
    return ids.join(of, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, node_rows: int | None = None) -> DataFrame:
    """One document of each component, with all its columns: that with the smallest doc_id.

    Of repeated rows of one id one stays.  Documents without an id stay only
    where no document of the component has one, and then once for each
    fingerprint that is its component's smallest.
    """
    fp, name, n = _free(docs, "fp"), _free(docs, "key"), _free(docs, "n")
    stored = stage_table(with_fingerprint(docs.withColumn("text", F.col("text").cast("string")), fp), "simhash_docs")
    ids = stored.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(fp).alias("fp"))

    def key(doc_id: str, print_: str):
        return F.concat_ws(":", F.coalesce(F.col(doc_id).cast("long").cast("string"), F.lit("-")), F.col(print_)).alias(name)

    chosen = (
        ids.join(_with_component(ids, node_rows), "fp").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("root", "component_id").agg(F.min("fp").alias("first")).select(key("component_id", "first"))
    )
    order = Window.partitionBy(name).orderBy(F.xxhash64("text"))
    return (
        stored.select("*", key("doc_id", fp)).join(chosen, name)
        .withColumn(n, F.row_number().over(order)).where(F.col(n) == 1).select(*[f"`{c}`" for c in docs.columns])
    )


def _free(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    taken = {c.lower() for c in docs.columns}
    name = f"_llm_{name}"
    while name in taken:
        name += "_"
    return name
