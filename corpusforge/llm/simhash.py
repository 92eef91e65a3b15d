"""SimHash near-duplicates by tiled exact comparison.

Equal fingerprints are one node. Nodes are laid into cells by population counts of the halves
of the fingerprint, and cells into tiles of bounded size. Only tiles whose population counts
lie within the radius meet; two that meet are compared exactly with numpy exclusive-or and bit
counts, block by block, skipping blocks by the counts of finer parts. A pair of tiles yields a
spanning forest of its links, never all pairs, so a group of copies costs what its size is.

Documents of a given similarity take long fingerprints as a search for candidates only: what lies
within a wide radius is compared again by the sets of shingles themselves.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusforge.operators.components import connected_components

from .common import Batches, checkpoint, lean, narrow, strings, tune

SEED, RADIUS = 42, 3
TILE, BLOCK = 4096, 512
#: Odd multipliers from the golden ratio, one for each further 64-bit word of a long fingerprint.
GOLDEN = 0x9E3779B97F4A7C15
#: Sets of shingles are compared in chunks of about so many documents and bytes; a large group has at most MOST chunks until they
#: are eight times as large. Bits of the sieve that keeps texts without any candidate from being shingled again.
SETS, SET_BYTES, MOST, SIEVE = 512, 2 << 20, 64, 1 << 24


def shingles(text: str | None, size: int) -> list[bytes]:
    """Space-joined runs of words, A-Z lowered, repeats included; fewer words than size: all of them; no word: none."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if len(words) <= size:
        return [b" ".join(words)] if words else []
    return list(map(b" ".join, zip(*(words[i:] for i in range(size)))))


def spread(h: np.ndarray, words: int) -> np.ndarray:
    """hashes -> (hashes, words): the hash itself and then independent mixtures of it."""
    out = np.empty((len(h), words), np.uint64)
    out[:, 0] = h
    for k in range(1, words):
        x = h + np.uint64(k * GOLDEN & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        out[:, k] = x ^ (x >> np.uint64(31))
    return out


def hashes(text: str | None, size: int) -> np.ndarray:
    found = shingles(text, size)
    return np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in found), np.uint64, len(found))


def vote(h: np.ndarray, words: int) -> bytes:
    """A bit is 1 if over half the hashes have it; no hash: all 0."""
    counts = np.zeros(64 * words, np.int64)
    for i in range(0, len(h), 4096):
        bits = np.unpackbits(spread(h[i : i + 4096], words).astype(">u8").view(np.uint8).reshape(-1, 8 * words), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return np.packbits(counts * 2 > len(h)).tobytes()


def fingerprint(text: str | None, size: int = 3, words: int = 1) -> tuple[bytes, int]:
    """The fingerprint, big-endian, and the number of hashes that voted. A bit is 1 if over half the hashes have it; no shingle: all 0.
    One word counts repeated shingles; with more each different shingle votes once, as the similarity of sets wants."""
    h = hashes(text, size)
    h = np.unique(h) if words > 1 else h
    return vote(h, words), len(h)


def fingerprints(documents: DataFrame, id: str, text: str, size: int = 3) -> DataFrame:
    """(id, fp binary, c1, c2): c1 and c2, the population counts of the halves of the fingerprint, place it in a cell."""
    tune(documents.sparkSession)
    df = narrow(documents, id=id, text=text)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            made = [fingerprint(t, size)[0] for t in strings(batch, "text")]
            cells = [(int.from_bytes(f[:4], "big").bit_count(), int.from_bytes(f[4:], "big").bit_count()) for f in made]
            columns = [pa.array(made, pa.binary()), pa.array([a for a, _ in cells], pa.int32()), pa.array([b for _, b in cells], pa.int32())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["id", "fp", "c1", "c2"])

    return df.mapInArrow(lean(run), f"id {df.schema['id'].dataType.simpleString()}, fp binary, c1 int, c2 int")


def sketches(documents: DataFrame, id: str, text: str, size: int, words: int) -> DataFrame:
    """(id, fp binary, c1, c2, digest): the digest names the set of shingles, c1 is the class of its size (factors of 1.25) and c2 is 0."""
    tune(documents.sparkSession)
    df = narrow(documents, id=id, text=text)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            sets = [np.unique(hashes(t, size)) for t in strings(batch, "text")]
            columns = [
                pa.array([vote(x, words) for x in sets], pa.binary()),
                pa.array([int(np.log(max(len(x), 1)) / np.log(1.25)) for x in sets], pa.int32()), pa.array([0] * len(sets), pa.int32()),
                pa.array([xxhash.xxh3_128_digest(x.tobytes()) for x in sets], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["id", "fp", "c1", "c2", "digest"])

    return df.mapInArrow(lean(run), f"id {df.schema['id'].dataType.simpleString()}, fp binary, c1 int, c2 int, digest binary")


class Forest:
    """Union-find over the indices of one pair of tiles."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def union(self, x: int, y: int) -> None:
        x, y = self.find(x), self.find(y)
        if x != y:
            self.parent[max(x, y)] = min(x, y)

    def roots(self, lo: int, hi: int) -> np.ndarray:
        return np.array([self.find(x) for x in range(lo, hi)])


def parts(fp: np.ndarray) -> np.ndarray:
    """Population counts of the 16-bit quarters of the first words."""
    return np.stack([np.bitwise_count(fp[:, 0] >> np.uint64(16 * k) & np.uint64(0xFFFF)) for k in range(4)], axis=1).astype(np.int16)


def link(a: np.ndarray, b: np.ndarray, radius: int, first: int, forest: Forest, base: int, lead: int = 1) -> None:
    """Joins in the forest all indices i of a and base + j of b whose fingerprints differ in at most `radius` bits
    (and in at most `first` bits of their first `lead` words). Rows are sorted by their parts beforehand."""
    pa_, pb_ = parts(a), parts(b)
    for i in range(0, len(a), BLOCK):
        x, px = a[i : i + BLOCK], pa_[i : i + BLOCK]
        low, high = px.min(axis=0), px.max(axis=0)
        for j in range(0, len(b), BLOCK):
            y, py = b[j : j + BLOCK], pb_[j : j + BLOCK]
            gap = np.maximum(np.maximum(py.min(axis=0) - high, low - py.max(axis=0)), 0).sum()
            if gap > first:
                continue
            far = np.bitwise_count(x[:, 0][:, None] ^ y[:, 0][None, :])
            for k in range(1, lead):
                far += np.bitwise_count(x[:, k][:, None] ^ y[:, k][None, :])
            near = far <= first
            if not near.any():
                continue
            if a.shape[1] > 1:
                rows, cols = np.nonzero(near)
                for k in range(0, len(rows), 1 << 16):
                    r, c = rows[k : k + (1 << 16)], cols[k : k + (1 << 16)]
                    near[r, c] = np.bitwise_count(x[r] ^ y[c]).sum(axis=1, dtype=np.int32) <= radius
            while True:  # joins each row with one of its links, then forgets links within a set
                near &= forest.roots(i, i + len(x))[:, None] != forest.roots(base + j, base + j + len(y))[None, :]
                rows = np.nonzero(near.any(axis=1))[0]
                if not len(rows):
                    break
                for r, c in zip(rows.tolist(), near[rows].argmax(axis=1).tolist()):
                    forest.union(i + r, base + j + c)


def _tile(tile: list, words: int) -> tuple[np.ndarray, np.ndarray]:
    fp = np.frombuffer(b"".join(x["fp"] for x in tile), ">u8").astype(np.uint64).reshape(-1, words)
    node = np.array([x["node"] for x in tile], np.int64)
    order = np.lexsort(parts(fp).T)
    return fp[order], node[order]


def links(nodes: DataFrame, words: int, radius: int, first: int, lead: int = 1) -> DataFrame:
    """Spanning links (src, dst) of nodes (fp, c1, c2, node)."""
    # At most 33 x 33 cells, or one per class of sizes (under 200).
    sizes = {(r.c1, r.c2): r.n for r in nodes.groupBy("c1", "c2").agg(F.count("*").alias("n")).collect()}
    tile = min(max(TILE, sum(sizes.values()) // 500), 1 << 16)
    chunks = {cell: -(-n // tile) for cell, n in sizes.items() if n > tile}
    n_chunks = F.lit(1)
    if chunks:
        n_chunks = F.coalesce(F.create_map(*[F.lit(x) for (p, q), n in chunks.items() for x in (p * 100 + q, n)])[F.col("c1") * 100 + F.col("c2")], F.lit(1))
    tiles = nodes.withColumn("chunk", F.pmod(F.xxhash64("fp"), n_chunks).cast("int")).groupBy("c1", "c2", "chunk").agg(F.collect_list(F.struct("fp", "node")).alias("tile"))
    tiles = checkpoint(tiles.withColumn("tile_id", F.xxhash64("c1", "c2", "chunk")))
    reach = [(p, q) for p in range(-first, first + 1) for q in range(-first, first + 1) if abs(p) + abs(q) <= first and (p, q) >= (0, 0)] if words == 1 else [(0, 0), (1, 0)]
    # Pairs of tiles are named first; the tiles themselves are fetched after, so that a cell of many tiles is the work of many tasks.
    names = tiles.select("c1", "c2", "chunk", "tile_id")
    moved = names.select("c1", "c2", F.col("chunk").alias("left_chunk"), F.col("tile_id").alias("left_id"), F.explode(F.array(*(F.struct(F.lit(p).alias("p"), F.lit(q).alias("q")) for p, q in reach))).alias("d"))
    moved = moved.select((F.col("c1") + F.col("d.p")).alias("c1"), (F.col("c2") + F.col("d.q")).alias("c2"), "left_chunk", "left_id", ((F.col("d.p") == 0) & (F.col("d.q") == 0)).alias("own"))
    pairs = moved.join(names, ["c1", "c2"]).filter("not own or left_chunk <= chunk").select("left_id", F.col("tile_id").alias("right_id"))
    fetch = lambda side: tiles.select(F.col("tile_id").alias(f"{side}_id"), F.col("tile").alias(side))
    pairs = pairs.join(fetch("left"), "left_id").withColumn("deal", F.xxhash64("left_id", "right_id"))
    pairs = pairs.join(fetch("right"), "right_id").repartition("deal").select("left", "right", (F.col("left_id") == F.col("right_id")).alias("same"))

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {name: batch.column(i)[k].as_py() for i, name in enumerate(batch.schema.names)}
                a, na = _tile(row["left"], words)
                b, nb = (a, na) if row["same"] else _tile(row["right"], words)
                node = np.concatenate([na, nb])
                forest = Forest(len(node))
                if row["same"]:
                    for i in range(len(na)):
                        forest.parent[len(na) + i] = i
                link(a, b, radius, first, forest, len(na), lead)
                roots = forest.roots(0, len(node))
                least = np.full(len(node), np.iinfo(np.int64).max)
                np.minimum.at(least, roots, node)
                src, dst = node, least[roots]
                keep = src != dst
                edges = np.unique(np.stack([src[keep], dst[keep]], axis=1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(edges[:, 0]), pa.array(edges[:, 1])], names=["src", "dst"])

    return pairs.mapInArrow(lean(run), "src long, dst long")


def verify(left: list[np.ndarray], right: list[np.ndarray] | None, num: int, den: int) -> list[tuple[int, int]]:
    """Spanning links (i, j) of all pairs of sets whose common share of all their elements is at least num / den: pairs within left,
    or of left with right (j counts on from left). Pairs that are joined already are not compared."""
    sets = left + (right or [])
    size = np.array([len(x) for x in sets], np.int64)
    end = np.cumsum(size)
    start = end - size
    vocabulary, ids = np.unique(np.concatenate(sets), return_inverse=True)
    label, mark, out = np.arange(len(sets)), np.zeros(len(vocabulary), bool), []
    other = np.arange(len(sets)) >= (len(left) if right is not None else 0)
    fits = lambda i: (np.minimum(size, size[i]) * den >= np.maximum(size, size[i]) * num) & (size > 0)
    for i in range(len(left)):
        if right is None:
            other[i] = False
        rows = np.nonzero(other & (label != label[i]) & fits(i))[0]
        if not len(rows):
            continue
        own = ids[start[i] : end[i]]
        mark[own] = True
        hit = mark[ids] if 4 * size[rows].sum() > len(ids) else None
        if hit is None:
            hit, at = mark[np.concatenate([ids[start[j] : end[j]] for j in rows])], np.cumsum(size[rows]) - size[rows]
            common = np.add.reduceat(hit, at, dtype=np.int64)
        else:
            total = np.concatenate([[0], np.cumsum(hit)])
            common = total[end[rows]] - total[start[rows]]
        mark[own] = False
        for j in rows[common * den >= (size[rows] + size[i] - common) * num].tolist():
            if label[j] != label[i]:
                label[label == label[j]] = label[i]
                out.append((i, j))
    return out


def shingle_sets(documents: DataFrame, wanted: DataFrame, id: str, text: str, size: int) -> DataFrame:
    """(node, component, set, digest): the shingles, as sorted 64-bit hashes, of the documents that `wanted` (node, component) names."""
    at = lambda c: F.pmod(F.xxhash64(c.cast("long")), F.lit(SIEVE)).cast("int")
    sieve = np.zeros(SIEVE // 64, np.uint64)
    bit = F.expr("bit_or(shiftleft(1L, at & 63))")
    for r in wanted.select(at(F.col("node")).alias("at")).groupBy(F.expr("at div 64").alias("k")).agg(bit.alias("bits")).collect():
        sieve[r.k] = r.bits & 0xFFFFFFFFFFFFFFFF
    shared = documents.sparkSession.sparkContext.broadcast(sieve)  # 2 MB
    df = narrow(documents, id=id, text=text).filter("id is not null").select(F.col("id").cast("long").alias("node"), at(F.col("id")).alias("at"), "text")

    def run(batches: Batches) -> Batches:
        for batch in batches:
            at = batch.column(1).to_numpy()
            batch = batch.take(pa.array(np.nonzero(shared.value[at // 64] >> (at % 64).astype(np.uint64) & np.uint64(1))[0]))
            sets = [np.unique(hashes(t, size)).tobytes() for t in strings(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary()), pa.array(map(xxhash.xxh3_128_digest, sets), pa.binary())], names=["node", "set", "digest"])

    return df.mapInArrow(lean(run), "node long, set binary, digest binary").join(wanted, "node")


def verified_links(members: DataFrame, num: int, den: int) -> DataFrame:
    """Spanning links (src, dst) of members (node, component, set, digest) of equal component whose sets have a similarity of num / den at least.

    A component is dealt into chunks of bounded size and all pairs of its chunks meet, so a large one is the work of many tasks.
    """
    counts = members.groupBy("component").agg(F.count("*").alias("n"), F.sum(F.length("set")).alias("bytes"))
    chunks = F.least(F.greatest(F.ceil(F.col("n") / SETS), F.ceil(F.col("bytes") / SET_BYTES), F.lit(1)), F.greatest(F.lit(MOST), F.ceil(F.col("bytes") / (8 * SET_BYTES))))
    dealt = members.join(counts.select("component", chunks.cast("int").alias("chunks")), "component").withColumn("chunk", F.pmod(F.xxhash64("digest"), F.col("chunks")).cast("int"))
    tiles = checkpoint(dealt.groupBy("component", "chunks", "chunk").agg(F.collect_list(F.struct("node", "set")).alias("tile")).filter("chunks > 1 or size(tile) > 1"))
    own = tiles.select("tile", F.lit(None).cast(tiles.schema["tile"].dataType).alias("other"), F.xxhash64("component", "chunk").alias("deal"))
    later = tiles.filter("chunk < chunks - 1").select("component", F.col("chunk").alias("from"), F.col("tile").alias("first"), F.explode(F.sequence(F.col("chunk") + 1, F.col("chunks") - 1)).alias("chunk"))
    met = later.join(tiles, ["component", "chunk"]).select(F.col("first").alias("tile"), F.col("tile").alias("other"), F.xxhash64("component", "chunk", "from").alias("deal"))
    pairs = own.unionAll(met).repartition("deal").select("tile", "other")

    def run(batches: Batches) -> Batches:
        for batch in batches:
            edges = []
            for tile, other in zip(*(batch.column(k).to_pylist() for k in (0, 1))):
                left, right = ([np.frombuffer(x["set"], np.uint64) for x in rows] if rows is not None else None for rows in (tile, other))
                nodes = [x["node"] for x in tile + (other or [])]
                edges += [(nodes[i], nodes[j]) for i, j in verify(left, right, num, den)]
            yield pa.RecordBatch.from_arrays([pa.array([e[k] for e in edges], pa.int64()) for k in (0, 1)], names=["src", "dst"])

    return pairs.mapInArrow(lean(run), "src long, dst long")


def near_duplicates(documents: DataFrame, id: str = "doc_id", text: str = "text", size: int = 3, radius: int = RADIUS) -> DataFrame:
    """Links documents whose fingerprints of 64 bits differ in at most `radius` bits, and finds their components.

    Returns id, fingerprint (lowercase hex), component_id (the smallest id reachable, the own one included). ids are
    integers.
    Null and empty texts have the fingerprint zero and are linked like any other. Equal texts share a fingerprint; very long ones are
    read whole. A row without id takes the component of its fingerprint. Repeated rows stay. An empty table gives an empty result;
    other columns are ignored.
    """
    made = checkpoint(fingerprints(documents, id, text, size))
    nodes = checkpoint(made.groupBy("fp", "c1", "c2").agg(F.min("id").cast("long").alias("node")))
    found = connected_components(links(nodes.filter("node is not null"), 1, radius, radius))
    named = nodes.join(found, nodes.node == found.node, "left").select("fp", "c1", "c2", F.coalesce("component", nodes.node).alias("component_id"))
    return made.join(named, ["fp", "c1", "c2"]).select(F.col("id").alias(id), F.lower(F.hex("fp")).alias("fingerprint"), "component_id")


def similar_documents(documents: DataFrame, id: str, text: str, size: int, words: int, radius: int, first: int, lead: int, num: int, den: int) -> DataFrame:
    """Links documents whose sets of shingles have a similarity (common ones of all) of at least num / den, and finds their components.

    Returns id and component_id (the smallest id reachable, the own one included). ids are integers. Only candidates are compared:
    documents joined by pairs whose fingerprints of 64 * words bits differ in at most `radius` bits, and in at most `first`
    bits of their first `lead` words. num / den must be 0.8 at least, since candidates are of neighbouring classes of size. Null
    and empty texts have equal sets. A row without id takes the component of its set. Repeated rows stay.
    """
    made = checkpoint(sketches(documents, id, text, size, words))
    nodes = checkpoint(made.groupBy("fp", "c1", "c2", "digest").agg(F.min("id").cast("long").alias("node")))
    candidates = checkpoint(connected_components(links(nodes.filter("node is not null"), words, radius, first, lead)))
    members = checkpoint(shingle_sets(documents, candidates, id, text, size))
    same = nodes.groupBy("digest").agg(F.min("node").alias("dst")).join(nodes, "digest").select(F.col("node").alias("src"), "dst")
    found = connected_components(verified_links(members, num, den).unionAll(same.filter("src <> dst")))
    named = nodes.join(found, nodes.node == found.node, "left").select("fp", "digest", F.coalesce("component", nodes.node).alias("component_id"))
    return made.join(named, ["fp", "digest"]).select(F.col("id").alias(id), "component_id")
