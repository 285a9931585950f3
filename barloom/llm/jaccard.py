"""Exact Jaccard join of five-word shingle sets: a prefix join over groups of equal prefix and size."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import work_path
from .common import bounded, column, fresh, save, shingle_sets
from .graph import components

#: Two sets are linked when 100 * shared >= PERCENT * united.
PERCENT = 75
#: Shingles whose hash is below this share of all hashes are counted over the corpus and come first
#: in the order of a prefix, rarest first; the others follow by hash.
COUNTED = 0.4
CUT = np.uint64(int(COUNTED * 2**64))
#: A shingle of more sets than this within one flush of a task is known to be frequent there and
#: then: only that is said of it, not whose it is.
FREQUENT = 64
FLUSH = 750_000
#: Postings of a shingle and members of a group up to this number are paired at once; longer ones
#: go by way of clusters.
SHORT = 16
#: Sets of a cluster that are compared with those of another block in one go.
BLOCK = 64
#: Sizes of linked sets differ by less than this factor (4 / 3, with room for rounding).
CLASS = 1.34
#: Bytes of text behind one shuffle partition of shingles, and buckets, each held by a worker, in it.
PART_BYTES = 32_000_000
BUCKETS = 16

LAST, OUTSIDE = np.int64(2**40), np.int64(2**41)
_ARRAYS = ("token", "node", "frequent", "x_token", "x_node", "own_token", "own_node", "doc", "doc_null", "doc_node", "doc_n", "doc_in")
_BLOCKS = pa.schema([("bucket", pa.int32()), *[(a, pa.binary()) for a in _ARRAYS], ("df", pa.binary())])
_BLOCK_DDL = "bucket int, " + ", ".join(f"{a} binary" for a in (*_ARRAYS, "df"))


def prefix_size(n):
    """Shingles of a set of n that contain one shared with every linked set, in a common order."""
    return n - (PERCENT * n + 99) // 100 + 1


def node_of(shingles: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


def _dealt(buckets, keys, arrays, into):
    """Rows of each bucket's share of equally long arrays, added to `into` by bucket."""
    order = np.argsort(keys, kind="stable")
    bounds = np.searchsorted(keys[order], np.arange(buckets + 1))
    sorted_arrays = {k: v[order] for k, v in arrays.items()}
    for b in np.flatnonzero(np.diff(bounds)).tolist():
        for k, v in sorted_arrays.items():
            into.setdefault(b, {})[k] = v[bounds[b] : bounds[b + 1]].tobytes()


def _blocks(into):
    rows = [(b, *[x.get(a) for a in _ARRAYS], x.get("df")) for b, x in sorted(into.items())]
    columns = zip(*rows) if rows else [()] * len(_BLOCKS)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _BLOCKS.types)], schema=_BLOCKS)


def _joined(table, name, dtype):
    return np.frombuffer(b"".join(x for x in table.column(name).to_pylist() if x), dtype)


def _postings(buckets):
    """Map side: the counted shingles of the sets, packed by bucket, and the documents' sets."""

    def flush(sets, docs):
        into = {}
        names = np.fromiter(sets, np.int64, len(sets))
        inside = [int(np.searchsorted(s, CUT)) for s in sets.values()]
        token = np.concatenate([s[:k] for s, k in zip(sets.values(), inside)] or [np.zeros(0, np.uint64)])
        node = np.repeat(names, inside)
        distinct, inverse, counts = np.unique(token, return_inverse=True, return_counts=True)
        often = counts > FREQUENT
        mine = often[inverse] if len(token) else np.zeros(0, bool)
        of = lambda x: (x % np.uint64(buckets)).astype(np.int64)
        by_node = lambda x: of(x.view(np.uint64))
        _dealt(buckets, of(token[~mine]), {"token": token[~mine], "node": node[~mine]}, into)
        _dealt(buckets, of(distinct[often]), {"frequent": distinct[often]}, into)
        _dealt(buckets, by_node(node[mine]), {"own_token": token[mine], "own_node": node[mine]}, into)
        more = [s[k : max(k, prefix_size(len(s)))] for s, k in zip(sets.values(), inside)]
        x_token = np.concatenate(more or [np.zeros(0, np.uint64)])
        x_node = np.repeat(names, [len(m) for m in more])
        _dealt(buckets, of(x_token), {"x_token": x_token, "x_node": x_node}, into)
        inside_of = dict(zip(sets, inside))
        ids = np.array([d if d is not None else 0 for d, _ in docs], np.int64)
        null = np.array([d is None for d, _ in docs], np.uint8)
        nodes = np.array([x for _, x in docs], np.int64)
        sizes = np.array([len(sets[x]) for _, x in docs], np.int64)
        count = np.array([inside_of[x] for _, x in docs], np.int64)
        _dealt(
            buckets,
            by_node(nodes),
            {"doc": ids, "doc_null": null, "doc_node": nodes, "doc_n": sizes, "doc_in": count},
            into,
        )
        return _blocks(into)

    def run(batches):
        sets, docs, held = {}, [], 0
        for batch in bounded(batches):
            for doc_id, s in zip(column(batch, "doc_id").to_pylist(), shingle_sets(column(batch, "text"))):
                node = node_of(s)
                docs.append((doc_id, node))
                if node not in sets:
                    sets[node] = s
                    held += len(s)
            if held > FLUSH:
                yield flush(sets, docs)
                sets, docs, held = {}, [], 0
        if docs:
            yield flush(sets, docs)

    return run


def _counted(buckets):
    """One bucket of shingles: those of two sets or more, with their counts, dealt out by set."""

    def run(table):
        into = {}
        token, node = _joined(table, "token", np.uint64), _joined(table, "node", np.int64)
        pairs = np.unique(np.rec.fromarrays([token, node], names="t,n"))
        frequent = np.unique(_joined(table, "frequent", np.uint64))
        distinct, inverse, counts = np.unique(pairs.t, return_inverse=True, return_counts=True)
        df = counts.astype(np.int64)
        df[np.isin(distinct, frequent)] = LAST
        df = df[inverse] if len(pairs) else np.zeros(0, np.int64)
        kept = df > 1
        x = np.unique(np.rec.fromarrays([_joined(table, "x_token", np.uint64), _joined(table, "x_node", np.int64)], names="t,n"))
        _, inverse, counts = np.unique(x.t, return_inverse=True, return_counts=True)
        x = x[counts[inverse] > 1] if len(x) else x
        token = np.concatenate([pairs.t[kept], x.t])
        node = np.concatenate([pairs.n[kept], x.n])
        df = np.concatenate([df[kept], np.full(len(x), OUTSIDE)])
        key = (node.view(np.uint64) % np.uint64(buckets)).astype(np.int64)
        _dealt(buckets, key, {"token": token, "node": node, "df": df}, into)
        own = int(table.column("bucket")[0].as_py())
        for name in ("own_token", "own_node", "doc", "doc_null", "doc_node", "doc_n", "doc_in"):
            data = b"".join(v for v in table.column(name).to_pylist() if v)
            if data:
                into.setdefault(own, {})[name] = data
        return pa.Table.from_batches([_blocks(into)])

    return run


_FOUND = pa.schema(
    [("kind", pa.string()), ("doc_id", pa.int64()), ("node", pa.int64()), ("n", pa.int64()), ("token", pa.int64()), ("g", pa.int64())]
)


def _prefixes(table):
    """One bucket of sets: the shared shingles in each prefix, the group, and the documents."""
    nodes = _joined(table, "doc_node", np.int64)
    sizes, inside = _joined(table, "doc_n", np.int64), _joined(table, "doc_in", np.int64)
    ids, null = _joined(table, "doc", np.int64), _joined(table, "doc_null", np.uint8).astype(bool)
    docs = pa.table(
        {
            "kind": pa.array(["doc"] * len(nodes)),
            "doc_id": pa.array(ids, mask=null),
            "node": nodes,
            "n": sizes,
            "token": pa.nulls(len(nodes), pa.int64()),
            "g": pa.nulls(len(nodes), pa.int64()),
        },
        schema=_FOUND,
    )
    known, at = np.unique(nodes, return_index=True)
    n, inside = sizes[at], inside[at]
    token = np.concatenate([_joined(table, "token", np.uint64), _joined(table, "own_token", np.uint64)])
    node = np.concatenate([_joined(table, "node", np.int64), _joined(table, "own_node", np.int64)])
    own = np.full(len(_joined(table, "own_node", np.int64)), LAST)
    df = np.concatenate([_joined(table, "df", np.int64), own])
    if not len(node):
        return docs
    # A frequent shingle may be told twice of a set, by its own task and by the shingle's bucket.
    order = np.lexsort((token, df, node))
    token, node, df = token[order], node[order], df[order]
    first = np.ones(len(node), bool)
    first[1:] = (node[1:] != node[:-1]) | (token[1:] != token[:-1]) | (df[1:] != df[:-1])
    token, node, df = token[first], node[first], df[first]
    k = np.searchsorted(known, node)
    counted = df < OUTSIDE
    shared = np.bincount(k[counted], minlength=len(known))
    p = prefix_size(n)
    alone = inside - shared
    begin = np.searchsorted(node, known)
    rank = np.arange(len(node)) - begin[k]
    # Rank among the counted shingles holds, as those outside come last; of these all are in the prefix.
    kept = np.where(counted, rank < (p - alone)[k], True)
    token, node, k, counted = token[kept], node[kept], k[kept], counted[kept]
    group = known.copy()
    full = np.bincount(k[counted], minlength=len(known)) == p
    begin, end = np.searchsorted(node, known), np.searchsorted(node, known, side="right")
    for i in np.flatnonzero(full & (alone <= 0)).tolist():
        whole = np.sort(token[begin[i] : end[i]]).tobytes() + int(n[i]).to_bytes(8, "little")
        group[i] = xxhash.xxh3_64_intdigest(whole, seed=1) - (1 << 63)
    found = pa.table(
        {
            "kind": pa.array(["posting"] * len(node)),
            "doc_id": pa.nulls(len(node), pa.int64()),
            "node": node,
            "n": n[k],
            "token": token.view(np.int64),
            "g": group[k],
        },
        schema=_FOUND,
    )
    return pa.concat_tables([docs, found])


def _linked(shared, n, m):
    return 100 * shared >= PERCENT * (n + m - shared)


def _set_pairs(batches):
    """Verify (a, b, text of a, text of b): the pairs that are linked."""
    for batch in bounded(batches, "text_a", most=1_000_000):
        one, two = shingle_sets(column(batch, "text_a")), shingle_sets(column(batch, "text_b"))
        good = [_linked(len(np.intersect1d(s, t, assume_unique=True)), len(s), len(t)) for s, t in zip(one, two)]
        yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))


def _block_pairs(table):
    """Verify all pairs across two blocks of sets, or within one: links that join them into trees."""
    sides = np.array(table.column("side").to_pylist())
    nodes = table.column("node").to_pylist()
    sets = shingle_sets(table.column("text").combine_chunks())
    single = len(set(sides.tolist())) == 1
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    owner, sorted_tokens = rows[order], flat[order]
    size = np.array([len(s) for s in sets])
    parent = list(range(len(sets)))

    def top(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    out = []
    for i, s in enumerate(sets):
        if not single and sides[i] == 1:
            continue
        low, high = np.searchsorted(sorted_tokens, s), np.searchsorted(sorted_tokens, s, side="right")
        lengths = high - low
        places = np.repeat(low - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
        shared = np.bincount(owner[places], minlength=len(sets))
        other = (np.arange(len(sets)) > i) if single else sides == 1
        for j in np.flatnonzero(other & _linked(shared, size[i], size)).tolist():
            a, b = top(i), top(j)
            if a != b:
                parent[a] = b
                out.append((nodes[i], nodes[j]))
    return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([x for _, x in out], pa.int64())})


def _cluster_tokens(batches):
    for batch in bounded(batches):
        sets = shingle_sets(column(batch, "text"))
        at = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        yield pa.RecordBatch.from_arrays(
            [
                column(batch, "cluster").take(pa.array(at)),
                column(batch, "node").take(pa.array(at)),
                pa.array(np.concatenate(sets).view(np.int64)),
            ],
            names=["cluster", "node", "token"],
        )


def _own_set(batches):
    """Rows whose text is the set that is wanted under its id."""
    for batch in bounded(batches):
        good = [node_of(s) == x for s, x in zip(shingle_sets(column(batch, "text")), column(batch, "node").to_pylist())]
        yield batch.select(["node", "text"]).filter(pa.array(good, pa.bool_()))


def find_links(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, node, n) of every row, and links (a, b) between nodes that connect all linked ones.

    A node is a distinct shingle set. The links are a subset of all linked pairs that leaves no
    two linked sets unconnected; pairs of one short list are all there.
    """
    spark = docs.sparkSession
    root = work_path(spark, "jaccard")
    docs = docs.select("doc_id", "text")
    # As many parts as the texts need, so that a bucket is as large at any size of the input.
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, math.ceil(total / PART_BYTES))
    buckets = BUCKETS * parts
    found = (
        docs.mapInArrow(_postings(buckets), _BLOCK_DDL)
        .repartition(parts, "bucket")
        .groupBy("bucket")
        .applyInArrow(_counted(buckets), _BLOCK_DDL)
        .repartition(parts, "bucket")
        .groupBy("bucket")
        .applyInArrow(_prefixes, "kind string, doc_id long, node long, n long, token long, g long")
    )
    found.write.mode("overwrite").partitionBy("kind").parquet(f"{root}/found")
    found = spark.read.schema(found.schema).parquet(f"{root}/found")
    rows = found.where("kind = 'doc'").select("doc_id", "node", "n")
    postings = found.where("kind = 'posting'").select("token", "node", "g", "n")

    # Groups of equal prefix and size stand for their members in the lists.
    nodes = save(postings.select("node", "g", "n").distinct(), f"{root}/nodes")
    sizes = save(nodes.groupBy("g").agg(F.count("*").alias("members")).where("members > 1"), f"{root}/sizes")
    lists = save(postings.groupBy("token", "g").agg(F.min("n").alias("n")), f"{root}/lists")
    lengths = lists.groupBy("token").agg(F.count("*").alias("length"), F.min("g").alias("hub")).where("length > 1")
    lengths = save(lengths, f"{root}/lengths")
    short = save(
        lists.join(lengths.where(F.col("length") <= SHORT), "token").select("token", "g", "n"), f"{root}/short"
    )
    one = short.select("token", F.col("g").alias("g1"), F.col("n").alias("n1"))
    two = short.select("token", F.col("g").alias("g2"), F.col("n").alias("n2"))
    pairs = (
        one.join(two, "token")
        .where((F.col("g1") < F.col("g2")) & (100 * F.least("n1", "n2") >= PERCENT * F.greatest("n1", "n2")))
        .select("g1", "g2")
        .distinct()
    )
    crowds = sizes.where(F.col("members") > SHORT).select("g")
    pairs = save(pairs, f"{root}/group-pairs")
    in_crowd = save(
        pairs.join(crowds.withColumnRenamed("g", "g1"), "g1", "left_semi")
        .unionByName(pairs.join(crowds.withColumnRenamed("g", "g2"), "g2", "left_semi"))
        .distinct(),
        f"{root}/crowd-pairs",
    )
    a = nodes.select(F.col("node").alias("a"), F.col("g").alias("g1"))
    b = nodes.select(F.col("node").alias("b"), F.col("g").alias("g2"))
    members = pairs.join(in_crowd, ["g1", "g2"], "left_anti").join(a, "g1").join(b, "g2").select("a", "b")
    members = save(members, f"{root}/member-pairs")

    # Long lists, and groups of several, are joined into clusters whose sets are compared whole.
    edges = (
        lists.join(lengths.where(F.col("length") > SHORT), "token")
        .where("g <> hub")
        .select(F.col("hub").alias("a"), F.col("g").alias("b"))
        .distinct()
        .unionByName(in_crowd.select(F.col("g1").alias("a"), F.col("g2").alias("b")))
    )
    of_group = save(components(edges), f"{root}/clusters")
    alone = sizes.join(of_group.withColumnRenamed("node", "g"), "g", "left_anti").select(
        F.col("g").alias("node"), F.col("g").alias("root")
    )
    of_group = save(of_group.unionByName(alone), f"{root}/all-clusters").select(
        F.col("node").alias("g"), F.col("root").alias("cluster")
    )
    clustered = save(nodes.join(of_group, "g").select("cluster", "node", "n"), f"{root}/clustered")

    # Texts of the sets that are compared: one document of each.
    wanted = (
        members.select(F.col("a").alias("node"))
        .unionByName(members.select(F.col("b").alias("node")))
        .unionByName(clustered.select("node"))
        .distinct()
    )
    first = rows.groupBy("node").agg(F.min("doc_id").alias("wanted_id"))
    wanted = save(first.join(wanted, "node"), f"{root}/wanted")
    texts = (
        docs.join(wanted.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("wanted_id")))
        .select("node", "text")
        .mapInArrow(_own_set, "node long, text string")
        .groupBy("node")
        .agg(F.min("text").alias("text"))
    )
    texts = save(texts, f"{root}/texts")

    def verified(pairs, label):
        left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
        right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
        return save(
            pairs.join(left, "a").join(right, "b").mapInArrow(_set_pairs, "a long, b long"), f"{root}/{label}"
        )

    links = verified(members, "short-links")
    links = links.unionByName(_cluster_links(clustered, texts, verified, root))
    return rows, links


def _cluster_links(clustered, texts, verified, root):
    """Links within clusters: first with the most central set, then what that leaves, in blocks.

    A set shares no more with any other of its cluster than its shingles that are not its alone
    there. Sets that by this bound cannot be linked to any size the cluster has drop out; those
    with few of their own stand in the middle. What is not linked to the middle is compared with
    all others whose size allows a link, block by block, so no task holds a cluster.
    """
    tokens = clustered.join(texts, "node").mapInArrow(_cluster_tokens, "cluster long, node long, token long")
    alone = (
        tokens.groupBy("cluster", "token")
        .agg(F.count("*").alias("c"), F.min("node").alias("node"))
        .where("c = 1")
        .groupBy("cluster", "node")
        .agg(F.count("*").alias("own"))
    )
    bound = clustered.join(alone, ["cluster", "node"], "left").select(
        "cluster", "node", "n", (F.col("n") - F.coalesce("own", F.lit(0))).alias("most")
    )
    bound = save(bound, f"{root}/bounds")
    least = save(bound.groupBy("cluster").agg(F.min("n").alias("least")), f"{root}/least")
    united = F.col("n") + F.greatest("least", "most") - F.col("most")
    possible = bound.join(least, "cluster").where(100 * F.col("most") >= PERCENT * united)
    possible = save(possible.select("cluster", "node", "n", "most"), f"{root}/possible")
    middle = save(
        possible.groupBy("cluster").agg(F.min_by("node", F.struct(F.col("n") - F.col("most"), "node")).alias("hub")),
        f"{root}/middle",
    )
    spokes = possible.join(middle, "cluster").where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b"))
    spokes = verified(spokes, "hub-links")
    near = spokes.select(F.col("b").alias("node")).unionByName(middle.select(F.col("hub").alias("node")))
    far = possible.join(near, "node", "left_anti").select("cluster", "node")
    far = save(far, f"{root}/far")

    # Sets are parted by size: those of linked sets lie in one class or in two neighbouring ones.
    size_class = F.floor(F.log("n") / F.lit(math.log(CLASS))).cast("int")
    sized = possible.select("cluster", "node", size_class.alias("c"))
    far = sized.join(far.select("node"), "node", "left_semi")
    rest = sized.join(near, "node", "left_semi")
    counted = (
        far.select("cluster", "c", F.lit(1).alias("open"))
        .unionByName(rest.select("cluster", "c", F.lit(0).alias("open")))
        .groupBy("cluster", "c")
        .agg(F.sum("open").alias("open"), F.sum(1 - F.col("open")).alias("rest"))
    )
    blocks = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
    entries = lambda n: F.map_from_entries(F.collect_list(F.struct("c", blocks(n)))).alias(n)
    counted = save(counted.groupBy("cluster").agg(entries("open"), entries("rest")), f"{root}/open")
    of = lambda n, d: F.coalesce(F.try_element_at(F.col(n), F.col("c") + F.lit(d)), F.lit(0))
    number = lambda n: F.pmod(F.xxhash64("node"), F.greatest(of(n, 0), F.lit(1))).cast("int").alias("i")
    far = far.join(counted, "cluster").select("*", number("open"))
    rest = rest.join(counted, "cluster").select("*", number("rest"))

    def places(count, kind, c, side, mine_first):
        """A place in the pair of one's own block with each of `count` others."""
        one = lambda other: F.struct(
            F.lit(kind).alias("kind"),
            c.alias("c"),
            (F.col("i") if mine_first else other).cast("int").alias("x"),
            (other if mine_first else F.col("i")).cast("int").alias("y"),
            F.lit(side).alias("side"),
        )
        none = F.array(one(F.lit(0)))
        return F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), one)).otherwise(F.slice(none, 1, 0))

    c, i = F.col("c"), F.col("i")
    # Kind 0: open blocks of one class, each pair once; 1: with the next class; 3 + d: with the rest, d classes on.
    own = F.filter(places(of("open", 0), 0, c, 0, True), lambda p: p["y"] >= i)
    lower = places(i, 0, c, 1, False)
    of_far = [own, lower, places(of("open", 1), 1, c, 0, True), places(of("open", -1), 1, c - 1, 1, False)]
    of_far += [places(of("rest", d), 3 + d, c, 0, True) for d in (-1, 0, 1)]
    of_rest = [places(of("open", -d), 3 + d, c - d, 1, False) for d in (-1, 0, 1)]
    placed = far.select("cluster", "node", F.explode(F.concat(*of_far)).alias("p")).unionByName(
        rest.select("cluster", "node", F.explode(F.concat(*of_rest)).alias("p"))
    )
    placed = placed.select("cluster", "node", "p.*")
    blocks_of = placed.join(texts, "node").select("cluster", "kind", "c", "x", "y", "side", "node", "text")
    blocked = blocks_of.groupBy("cluster", "kind", "c", "x", "y").applyInArrow(_block_pairs, "a long, b long")
    return spokes.unionByName(save(blocked, f"{root}/block-links"))


def jaccard_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id reachable by links) of every row.

    Sets are distinct five-word shingles with A-Z lower-cased; a text of fewer words is one
    shingle, its whole sequence. A null, empty or blank text has no shingles and is its own
    component. Rows with equal sets, under one doc_id or several, are linked. A null doc_id is
    never the smallest; where all are null, component_id is null. Extra columns are ignored; an
    empty table gives no rows.
    """
    placed, empty = _placed(docs)
    least = placed.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    least = save(least, work_path(docs.sparkSession, "jaccard-least"))
    return (
        placed.join(least, "root")
        .select("doc_id", F.col("n").alias("n_shingles"), "component_id")
        .unionByName(
            empty.select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
        )
    )


def _placed(docs):
    """(doc_id, node, n, root) of the rows with shingles, and (doc_id, node, n) of those without."""
    root = work_path(docs.sparkSession, "jaccard-components")
    rows, links = find_links(docs)
    top = save(components(links), f"{root}/components")
    placed = rows.where("n > 0").join(top, "node", "left")
    placed = placed.select("doc_id", "node", "n", F.coalesce("root", "node").alias("root"))
    return save(placed, f"{root}/placed"), rows.where("n = 0")


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of `docs`, all columns, of one document per component: that of the smallest doc_id.

    A null doc_id comes last. Of rows that repeat the doc_id that stays, one is kept (the smallest
    set hash, then text). Documents without shingles are kept, one row per doc_id. Extra columns
    stay, whatever their names; an empty table stays empty.
    """
    placed, empty = _placed(docs)
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"), "node")
    winners = placed.groupBy("root").agg(F.min(order).alias("w")).select("w.*")
    winners = winners.unionByName(empty.select(order.alias("w")).select("w.*").distinct())
    winners = save(winners, work_path(docs.sparkSession, "jaccard-winners"))
    names = [fresh(n, docs.columns) for n in ("set_node", "set_none", "set_id")]
    row = fresh("set_row", docs.columns)

    def with_keys(batches):
        for batch in bounded(batches):
            nodes = [node_of(s) for s in shingle_sets(column(batch, "text"))]
            ids = column(batch, "doc_id")
            keys = [pa.array(nodes, pa.int64()), ids.is_null(), ids.fill_null(0)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *keys], names=[*batch.schema.names, *names])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    keyed = docs.mapInArrow(with_keys, f"{fields}, {names[0]} long, {names[1]} boolean, {names[2]} long")
    winners = winners.select("node", "none", "id").toDF(*names)
    first = Window.partitionBy(*names).orderBy("text")
    return (
        keyed.join(winners, names)
        .withColumn(row, F.row_number().over(first))
        .where(F.col(row) == 1)
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )
