"""N-gram Jaccard join by a MinHash LSH forest with exact verification.

A text's word shingles give a signature of several labels, one per tree. Texts
with equal shingle sets are one class from the start. Candidates share a label
prefix: matching starts at whole labels in sorted order and shortens the prefix
until the design recall at the threshold reaches its target. Inside a prefix
group texts are absorbed by leaders instead of being paired: every member is
compared with the group's leaders only, and the triangle inequality of the
Jaccard distance keeps all pairs at the threshold in one candidate component.
Map tasks do so before the shuffle, so only leaders of large groups travel.
Leaders stand for texts by estimates, and a forest may miss a pair: what it
misses is found by prefixes of the shingles, rarest first (``_rest``), which
miss none. Components are then verified exactly in tiles of bounded size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import freed_shuffles, mix64, shingles, stored, words


@dataclass(frozen=True)
class Params:
    """``shingle`` words, least Jaccard ``similarity``. ``trees`` labels of
    ``depth`` hashes; ``recall``: target at the threshold itself. ``absorb``:
    estimated similarity from which a leader stands for a text; ``chunk``: texts
    that a map task compares at once; ``tile``: texts per side of a verification;
    ``counted``: shingles whose rarity a map task asks for at once."""

    shingle: int = 5
    similarity: float = 0.8
    trees: int = 16
    depth: int = 8
    recall: float = 0.995
    absorb: float = 0.85
    slack: float = 0.1
    chunk: int = 16_384
    tile: int = 256
    counted: int = 1 << 21
    seed: int = 3

    @property
    def stop(self) -> int:
        """The longest prefix whose recall at the threshold reaches the target."""
        for d in range(self.depth, 1, -1):
            if 1 - (1 - self.similarity ** d) ** self.trees >= self.recall:
                return d
        return 1

    @property
    def link_local(self) -> float:
        """Two texts at the threshold, one of them absorbed: so similar is the
        other to the leader, less the estimate's slack."""
        return self.absorb - (1 - self.similarity) - self.slack

    @property
    def link_across(self) -> float:
        """The same with both absorbed by leaders of their tasks, one of which
        is absorbed once more after the shuffle."""
        return 1 - ((1 - self.similarity) + 3 * (1 - self.absorb)) - self.slack


def _coefficients(params: Params) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(params.seed)
    n = params.trees * params.depth
    draw = rng.integers(0, 1 << 63, size=(2, n), dtype=np.uint64)
    return draw[0] * np.uint64(2) + np.uint64(1), draw[1]


def signature(grams: np.ndarray, coefficients: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Least value of each hash function over a text's shingles (upper 32 bits)."""
    a, b = coefficients
    least = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(grams), 2048):
        np.minimum(least, (a[:, None] * grams[at:at + 2048] + b[:, None]).min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def node_id(grams: np.ndarray) -> bytes:
    """128-bit address of a shingle set."""
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest()


def _prefix_hashes(labels: np.ndarray, tree: int) -> np.ndarray:
    """Hash of every prefix of the labels: column d - 1 has depth d."""
    h = np.full(len(labels), tree + 1, np.uint64)
    out = np.empty(labels.shape, np.uint64)
    for d in range(labels.shape[1]):
        h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + labels[:, d])
        out[:, d] = h
    return out


def _absorb(run: np.ndarray, sketches: np.ndarray, link: float, absorb: float, chance: float,
            labels: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Leaders of a group. Members as similar as ``link`` belong together with
    the leader; ``labels`` says what does already, and only (member, leader)
    edges that join two parts are appended, fewer than there are members."""
    leaders = []
    while len(run):
        leader, run = run[0], run[1:]
        leaders.append(leader)
        if len(run):
            alike = ((sketches[run] == sketches[leader]).mean(axis=1) - chance) / (1 - chance)
            near = run[alike >= link]
            near = near[labels[near] != labels[leader]]
            if len(near):
                parts, first = np.unique(labels[near], return_index=True)
                edges.append(np.stack([near[first], np.full(len(first), leader)], axis=1))
                labels[np.isin(labels, parts)] = labels[leader]
            run = run[alike < absorb]
    return np.array(leaders)


def forest(signatures: np.ndarray, params: Params) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """(edges between rows, per tree (leaders, their prefix hashes at the stop
    depth)) of one task's texts. Within a tree the sorted labels are matched
    from whole labels to the shortest prefix; absorbed rows don't go on."""
    labels = signatures.reshape(len(signatures), params.trees, params.depth)
    edges: list[np.ndarray] = [np.empty((0, 2), np.int64)]
    parts = np.arange(len(signatures))
    out = []
    for tree in range(params.trees):
        prefixes = _prefix_hashes(labels[:, tree], tree)
        alive = np.arange(len(signatures))
        for depth in range(params.depth, params.stop - 1, -1):
            h = prefixes[alive, depth - 1]
            order = np.argsort(h, kind="stable")
            h, alive = h[order], alive[order]
            starts = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
            sizes = np.diff(np.append(starts, len(h)))
            if not (sizes > 1).any():
                continue
            kept = [alive[starts[sizes == 1]]]
            for s, n in zip(starts[sizes > 1], sizes[sizes > 1]):
                kept.append(_absorb(np.sort(alive[s:s + n]), signatures, params.link_local,
                                    params.absorb, 0.0, parts, edges))
            alive = np.concatenate(kept)
        out.append((alive, prefixes[alive, params.stop - 1]))
    return np.concatenate(edges), out


def sketch(signatures: np.ndarray, params: Params) -> np.ndarray:
    """Four bits of half of the hashes: 32 bytes with the usual parameters."""
    half = signatures[:, ::2] & 15
    return (half[:, ::2] << 4 | half[:, 1::2]).astype(np.uint8)


def _nibbles(sketches: np.ndarray) -> np.ndarray:
    return np.concatenate([sketches >> 4, sketches & 15], axis=1)


def _first_pass(docs: DataFrame, key: str, text: str, params: Params) -> DataFrame:
    """Rows of three kinds: documents (key, node), edges between nodes found in
    a task (node, other) and leaders (bucket, node, sketch)."""
    kind = docs.schema[key].dataType
    schema = T.StructType([T.StructField("kind", T.IntegerType()), T.StructField("key", kind),
                           T.StructField("node", T.BinaryType()), T.StructField("other", T.BinaryType()),
                           T.StructField("bucket", T.LongType()), T.StructField("sketch", T.BinaryType())])
    coefficients = _coefficients(params)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes: dict[bytes, int] = {}
        held: list[np.ndarray] = []

        def rows(n: int, what: int, arrow: pa.DataType, **cols) -> pa.RecordBatch:
            types = {"key": arrow, "node": pa.binary(), "other": pa.binary(), "bucket": pa.int64(), "sketch": pa.binary()}
            return pa.record_batch([pa.array(np.full(n, what, np.int32)),
                                    *[pa.array(cols[c], t) if c in cols else pa.nulls(n, t) for c, t in types.items()]],
                                   schema.names)

        def flush(arrow: pa.DataType) -> Iterator[pa.RecordBatch]:
            if not held:
                return
            signatures, names = np.stack(held), np.array(list(nodes), object)
            edges, trees = forest(signatures, params)
            if len(edges):
                yield rows(len(edges), 1, arrow, node=names[edges[:, 0]], other=names[edges[:, 1]])
            small = np.array([s.tobytes() for s in sketch(signatures, params)], object)
            for leaders, buckets in trees:
                yield rows(len(leaders), 2, arrow, node=names[leaders], bucket=buckets.view(np.int64), sketch=small[leaders])
            nodes.clear()
            held.clear()

        arrow = None
        for got in batches:
            arrow = got.schema.field(0).type
            own = []
            for t in got.column(1):
                grams = shingles(words(t.as_py())[0], params.shingle)
                if not len(grams):
                    own.append(None)
                    continue
                node = node_id(grams)
                own.append(node)
                if node not in nodes:
                    nodes[node] = len(nodes)
                    held.append(signature(grams, coefficients))
            yield rows(len(own), 0, arrow, key=got.column(0), node=own)
            if len(held) >= params.chunk:
                yield from flush(arrow)
        yield from flush(arrow)

    return docs.select(key, text).mapInArrow(run, schema)


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Groups of a sorted stream, whatever batches they span; yields tables of
    whole groups, the last group of a batch waiting for the next."""
    waiting: list[pa.Table] = []
    for got in batches:
        if not got.num_rows:
            continue
        table = pa.Table.from_batches([got])
        cols = [table[k].combine_chunks() for k in keys]
        last = [c[-1] for c in cols]
        same = np.ones(len(table), bool)
        for c, v in zip(cols, last):
            same &= np.array(pc.equal(c, v))
        cut = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
        if cut:
            waiting.append(table.slice(0, cut))
            yield pa.concat_tables(waiting)
            waiting = []
        if waiting and not cut and any(w[k][-1].as_py() != v.as_py() for w in waiting[-1:] for k, v in zip(keys, last)):
            yield pa.concat_tables(waiting)
            waiting = []
        waiting.append(table.slice(cut))
    if waiting:
        yield pa.concat_tables(waiting)


def _starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    change = np.zeros(len(table), bool)
    change[:1] = True
    for k in keys:
        v = table[k].to_numpy()
        change[1:] |= v[1:] != v[:-1]
    return np.append(np.flatnonzero(change), len(table))


def _across_tasks(leaders: DataFrame, params: Params) -> DataFrame:
    """(node, other) edges among the leaders of all tasks that share a bucket. Of
    a group one small row per task and leader is held, not its documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches, ["bucket"]):
            starts = _starts(table, ["bucket"])
            sizes = np.diff(starts)
            if not (sizes > 1).any():
                continue
            nodes = np.array(table["node"].to_pylist(), object)
            raw = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint8).reshape(len(nodes), -1)
            edges: list[np.ndarray] = []
            for s, n in zip(starts[:-1][sizes > 1], sizes[sizes > 1]):
                _, first = np.unique(nodes[s:s + n].astype("S16"), return_index=True)
                if len(first) > 1:
                    _absorb(np.arange(len(first)), _nibbles(raw[s + first]), params.link_across, params.absorb,
                            1 / 16, np.arange(len(first)), own := [])
                    edges += [s + first[e] for e in own]
            if edges and len(e := np.concatenate(edges)):
                yield pa.record_batch([pa.array(nodes[e[:, 0]], pa.binary()), pa.array(nodes[e[:, 1]], pa.binary())],
                                      ["node", "other"])

    dealt = leaders.select("bucket", "node", "sketch").repartition("bucket").sortWithinPartitions("bucket", "node")
    return dealt.mapInArrow(run, "node binary, other binary")


#: Buckets of shingles by their leading bits.
_BUCKETS = 1 << 12


def _slices(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """``values`` cut at ``ends`` (from 0), as a column of bytes."""
    offsets = (ends * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def _joined(column: pa.ChunkedArray, dtype: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.drop_null().to_pylist()), dtype)


def _asked(docs: DataFrame, text: str, params: Params) -> DataFrame:
    """The shingles of a chunk of a task's texts: a row per bucket (bucket, chunk,
    tokens, owners: numbers of texts), and one with the nodes and sizes of the chunk."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes: dict[bytes, int] = {}
        held: list[np.ndarray] = []
        chunk, n = TaskContext.get().partitionId() << 32, 0

        def flush() -> Iterator[pa.RecordBatch]:
            sizes = np.array([len(g) for g in held], np.int64)
            owners, tokens = np.repeat(np.arange(len(held), dtype=np.uint16), sizes), np.concatenate(held)
            order = np.argsort(tokens)
            owners, tokens = owners[order], tokens[order]
            ends = np.searchsorted(tokens >> np.uint64(52), np.arange(_BUCKETS + 1, dtype=np.uint64))
            some = np.flatnonzero(np.diff(ends))
            ends = np.append(ends[some], len(tokens))
            yield pa.record_batch([pa.array(some.astype(np.int32)), pa.array(np.full(len(some), chunk)), _slices(tokens, ends),
                                   _slices(owners, ends), pa.nulls(len(some), pa.binary()), pa.nulls(len(some), pa.binary())], names)
            yield pa.record_batch([pa.array([hash(chunk) % _BUCKETS], pa.int32()), pa.array([chunk]), pa.nulls(1, pa.binary()),
                                   pa.nulls(1, pa.binary()), pa.array([b"".join(nodes)]), pa.array([sizes.tobytes()])], names)
            nodes.clear()
            held.clear()

        for got in batches:
            for t in got.column(0):
                grams = shingles(words(t.as_py())[0], params.shingle)
                if not len(grams) or (node := node_id(grams)) in nodes:
                    continue
                nodes[node] = len(nodes)
                held.append(grams)
                n += len(grams)
                if n >= params.counted or len(held) > np.iinfo(np.uint16).max:
                    yield from flush()
                    chunk, n = chunk + 1, 0
        if held:
            yield from flush()

    names = ["bucket", "chunk", "tokens", "owners", "nodes", "sizes"]
    return docs.select(text).mapInArrow(run, "bucket int, chunk long, tokens binary, owners binary, nodes binary, sizes binary")


def _told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``_asked`` by bucket -> the shingles of more than one text, with
    the number of their texts (copies in other chunks count as texts)."""
    for table in _runs(batches, ["bucket"]):
        starts = _starts(table, ["bucket"])
        for s, e in zip(starts[:-1], starts[1:]):
            rows = table.slice(s, e - s)
            whole = rows.filter(pc.is_valid(rows["nodes"]))
            if len(whole):
                yield pa.record_batch([whole["chunk"].combine_chunks(), *[pa.nulls(len(whole), pa.binary())] * 3,
                                       whole["nodes"].combine_chunks(), whole["sizes"].combine_chunks()], _TOLD)
            rows = rows.filter(pc.is_valid(rows["tokens"]))
            tokens, owners = _joined(rows["tokens"], np.uint64), _joined(rows["owners"], np.uint16)
            _, place, count = np.unique(tokens, return_inverse=True, return_counts=True)
            count = count[place].astype(np.uint32)
            shared = count > 1
            if shared.any():
                ends = np.concatenate([[0], np.cumsum(shared)])[np.concatenate([[0], np.cumsum(
                    pc.binary_length(rows["tokens"]).to_numpy() // 8)])]
                yield pa.record_batch([rows["chunk"].combine_chunks(), _slices(tokens[shared], ends), _slices(owners[shared], ends),
                                       _slices(count[shared], ends), *[pa.nulls(len(rows), pa.binary())] * 2], _TOLD)


_TOLD = ["chunk", "tokens", "owners", "counts", "nodes", "sizes"]


def _rest(docs: DataFrame, text: str, params: Params) -> DataFrame:
    """(node, other) edges that put every pair at the threshold in one component,
    whatever the forest finds.

    Two sets at the threshold share all but a few of their shingles, so in any one
    order of all shingles they share one of the first ``size - ceil(similarity *
    size) + 1`` of each. The order is by rarity: a text with so many shingles of
    its own is like no other and goes at once, and frequent shingles are looked
    at only in texts that hold hardly anything else. Texts that share such a
    shingle are strung by size, as far as their sizes allow."""
    def firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches, ["chunk"]):
            starts = _starts(table, ["chunk"])
            for s, e in zip(starts[:-1], starts[1:]):
                rows = table.slice(s, e - s)
                nodes, sizes = _joined(rows["nodes"], "V16"), _joined(rows["sizes"], np.int64)
                tokens, owners, counts = (_joined(rows[c], t) for c, t in (("tokens", np.uint64), ("owners", np.uint16), ("counts", np.uint32)))
                shared = np.bincount(owners, minlength=len(sizes))
                first = sizes - np.ceil(params.similarity * sizes - 1e-6).astype(np.int64) + 1
                order = np.lexsort((tokens, counts, owners))
                tokens, owners = tokens[order], owners[order]
                rank = np.arange(len(owners)) - (np.cumsum(shared) - shared)[owners]
                kept = rank < (first - (sizes - shared))[owners]  # those of its own come before
                yield pa.record_batch([pa.array(tokens[kept].view(np.int64)), _slices(nodes[owners[kept]], np.arange(kept.sum() + 1)),
                                       pa.array(sizes[owners[kept]])], ["token", "node", "size"])

    told = (_asked(docs, text, params).repartition("bucket").sortWithinPartitions("bucket")
            .mapInArrow(_told, "chunk long, tokens binary, owners binary, counts binary, nodes binary, sizes binary"))
    prefixes = (told.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(firsts, "token long, node binary, size long"))
    by = Window.partitionBy("token").orderBy("size", "node")
    strung = prefixes.select("node", "size", F.lag("node").over(by).alias("other"), F.lag("size").over(by).alias("less"))
    return strung.where(F.col("less") >= params.similarity * F.col("size") - 1e-6).where("node != other").select("node", "other").distinct()


def connected_components(edges: DataFrame, a: str = "node", b: str = "other") -> DataFrame:
    """(node, component) of all nodes in ``edges``; the component is its least
    node. Alternating large and small stars, until nothing changes; the rounds
    grow with the logarithm of the size. Each round is a written table."""
    def star(e: DataFrame, small: bool) -> DataFrame:
        if small:  # every node meets its smaller neighbours
            around = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        else:
            around = e.select("u", "v").union(e.select("v", "u"))
        least = around.groupBy("u").agg(F.min("v").alias("w")).withColumn("m", F.least("u", "w"))
        joined = around.join(least.select("u", "m"), "u")
        if small:
            new = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
                least.select("u", F.col("m").alias("v")))
        else:
            new = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        return new.where(F.col("u") != F.col("v")).distinct()

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head())

    e = stored(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u != v").distinct(), "edges")
    seen = mark(e)
    while seen[0]:
        e = stored(star(star(e, False), True), "edges")
        now = mark(e)
        if now == seen:
            break
        seen = now
    return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(e.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct())


def _similar(grams: list[np.ndarray], least: float) -> np.ndarray:
    """Which pairs of shingle sets have a Jaccard similarity of ``least`` or more."""
    sizes = np.array([len(g) for g in grams], float)
    owner = np.repeat(np.arange(len(grams)), sizes.astype(int))
    _, place, count = np.unique(np.concatenate(grams), return_inverse=True, return_counts=True)
    shared = count > 1
    owner, place = owner[shared[place]], (np.cumsum(shared) - 1)[place[shared[place]]]
    both = np.zeros((len(grams), len(grams)))
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    for at in range(0, int(shared.sum()), 8192):  # columns in blocks
        lo, hi = np.searchsorted(place, (at, at + 8192))
        m = np.zeros((len(grams), 8192), np.float32)
        m[owner[lo:hi], place[lo:hi] - at] = 1
        both += m @ m.T
    union = sizes[:, None] + sizes[None, :] - both
    return both >= least * union - 1e-9


def _verified(members: DataFrame, docs: DataFrame, key: str, text: str, params: Params) -> DataFrame:
    """(node, links, label): documents linked to a node by other nodes, and the
    least node it is linked to, per tile of its component."""
    sized = members.join(members.groupBy("component").agg(F.count("*").alias("size")), "component")
    blocks = F.ceil(F.col("size") / params.tile).cast("int")
    wanted = sized.where(F.col("size") > 1).select(
        F.col("rep").alias("_rep"), F.col("node").alias("_node"), "copies", "component", blocks.alias("blocks"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in batches:
            sets = [shingles(words(t.as_py())[0], params.shingle) for t in got.column(0)]
            keep = pa.array([node_id(g) == n.as_py() for g, n in zip(sets, got.column(1))], pa.bool_())
            out = pa.record_batch([got.column(1), got.column(2), got.column(3), got.column(4),
                                   pa.array([g.tobytes() for g in sets], pa.binary())],
                                  ["node", "copies", "component", "blocks", "grams"])
            yield out.filter(keep)

    sets = "node binary, copies long, component binary, blocks int, grams binary"
    texts = (docs.select(F.col(key).alias("_rep"), F.col(text).alias("_text"))
             .join(wanted.hint("shuffle_hash"), "_rep").select("_text", "_node", "copies", "component", "blocks")
             .mapInArrow(read, sets))

    def address(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in batches:
            own = [shingles(words(t.as_py())[0], params.shingle) for t in got.column(0)]
            yield pa.record_batch([got.column(0), pa.array([node_id(g) if len(g) else None for g in own], pa.binary())], ["_text", "_node"])

    # Texts that no key leads to are found by their address.
    unnamed = (docs.where(F.col(key).isNull()).select(F.col(text).alias("_text")).mapInArrow(address, "_text string, _node binary")
               .join(wanted.where("_rep IS NULL").drop("_rep").hint("shuffle_hash"), "_node")
               .select("_text", "_node", "copies", "component", "blocks").mapInArrow(read, sets))
    texts = texts.union(unnamed)
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    tiles = (texts.withColumn("block", block)
             .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("component", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"),
                     "block", "node", "copies", "grams"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = ["component", "i", "j"]
        for table in _runs(batches, keys):
            starts = _starts(table, keys)
            nodes = table["node"].to_pylist()
            copies = table["copies"].to_numpy()
            block, i, j = (table[c].to_numpy() for c in ("block", "i", "j"))
            grams = [np.frombuffer(g, np.uint64) for g in table["grams"].to_pylist()]
            out: list[tuple[bytes, int, bytes]] = []
            for s, e in zip(starts[:-1], starts[1:]):
                own = list({nodes[k]: k for k in range(s, e)}.values())  # a repeated document counts once
                if len(own) < 2:
                    continue
                near = _similar([grams[k] for k in own], params.similarity)
                np.fill_diagonal(near, False)
                if i[s] != j[s]:
                    near &= block[own][:, None] != block[own][None, :]
                links = near @ copies[own]
                for k, row in enumerate(near):
                    if links[k]:
                        out.append((nodes[own[k]], int(links[k]),
                                    min(nodes[own[p]] for p in np.flatnonzero(row))))
            if out:
                cols = list(zip(*out))
                yield pa.record_batch([pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.int64()),
                                       pa.array(cols[2], pa.binary())], ["node", "links", "label"])

    return (tiles.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j")
            .mapInArrow(verify, "node binary, links long, label binary"))


#: Prefixes of two hashes: the forest misses a pair at the threshold itself with
#: 8e-8, not counting the estimates of its leaders; ``_rest`` finds what it misses.
WHOLE = Params(recall=0.9999999)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text",
                    params: Params = WHOLE) -> DataFrame:
    """One row per document: key, class_id, n_links.

    Two documents are linked when the sets of their word shingles have a Jaccard
    similarity of at least the threshold; ``n_links`` counts a document's links,
    copies included, and ``class_id`` is the least key of its connected group.
    Texts of fewer words than a shingle are one shingle. Null, empty and
    wordless texts have no shingle: their class is their own key, without
    links. Repeated rows are copies of each other. Null keys are members, but
    give no class its name. An empty table gives no row.
    """
    first = stored(_first_pass(docs, key, text, params), "forest")
    rows = first.where("kind = 0").select("key", "node")
    nodes = (rows.where("node IS NOT NULL").groupBy("node")
             .agg(F.min("key").alias("rep"), F.count("*").alias("copies")))
    with freed_shuffles(docs.sparkSession):
        rest = stored(_rest(docs, text, params), "rest")
    candidates = (first.where("kind = 1").select("node", "other")
                  .union(_across_tasks(first.where("kind = 2"), params)).union(rest))
    members = connected_components(candidates).join(nodes, "node")
    checked = stored(_verified(members, docs, key, text, params), "verified")
    groups = connected_components(checked, "node", "label")
    links = checked.groupBy("node").agg(F.sum("links").alias("links"))
    named = nodes.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    ids = named.groupBy("component").agg(F.min("rep").alias("class_id"))
    full = (named.join(ids, "component").join(links, "node", "left")
            .select("node", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    return (rows.join(full, "node", "left")
            .select(F.col("key").alias(key),
                    F.when(F.col("node").isNull(), F.col("key")).otherwise(F.col("class_id")).alias("class_id"),
                    F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")))
