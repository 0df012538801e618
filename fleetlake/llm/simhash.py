"""SimHash near-duplicates with Hamming BK-trees.

``fingerprints`` makes one 64-bit SimHash per document.  ``near_components``
links fingerprints that differ in at most ``radius`` bits and returns the
connected classes:

1. copies collapse to one row per distinct fingerprint (smallest doc_id);
2. the 64 bits are cut into ``radius + 2`` blocks.  Two fingerprints within
   the radius agree on at least two whole blocks, so every pair to be linked
   meets in a shard keyed by some pair of blocks.  A shard is about
   2^-(128 / (radius + 2)) of the corpus;
3. a shard of more than ``tree_size`` members is dealt over several trees; each
   of its fingerprints is sent to all of them, so no link is lost and no tree
   outgrows its bound.  The tree travels with its shard's key rather than as
   one broadcast, which would grow with the corpus;
4. a tree keys each child by its integer Hamming distance to the parent.  A
   search follows only child edges within ``radius`` of the distance to the
   node.  Each tree returns a spanning forest of its links, not all pairs;
5. large-star/small-star rounds join the forests.

Null and empty texts have fingerprint zero and are linked like any other.
Rows with a null doc_id are left out.  Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blobs, in_batches, written
from .components import components

SEED = 42


def simhash(blob: bytes | None, words: int) -> int:
    """SimHash of one text: XXH64 votes of its word shingles, repeats included."""
    import numpy as np
    from xxhash import xxh64_intdigest

    tokens = (blob or b"").lower().split()
    if not tokens:
        return 0
    if len(tokens) < words:
        shingles = iter((b" ".join(tokens),))
    else:
        shingles = map(b" ".join, zip(*(tokens[k:] for k in range(words)), strict=False))
    votes = np.zeros(64, dtype=np.int64)
    hashes = np.fromiter((xxh64_intdigest(s, SEED) for s in shingles), dtype=np.uint64)
    for at in range(0, len(hashes), 16384):
        part = hashes[at:at + 16384]
        bits = np.unpackbits(part.view(np.uint8), bitorder="little").reshape(len(part), 64)
        votes += bits.sum(axis=0, dtype=np.int64)
    set_bits = (votes * 2 > len(hashes)).astype(np.uint8)
    return int(np.packbits(set_bits, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """``docs(doc_id, text)`` -> ``(doc_id, fp)``, fp a signed long holding the 64 bits."""

    def run(batches) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            fps = [simhash(b, words) for b in blobs(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], ["doc_id", "fp"])

    return (docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
            .transform(in_batches, run, "doc_id long, fp long"))


class BKTree:
    """Burkhard-Keller tree over 64-bit integers; a child hangs at its distance from the parent."""

    def __init__(self, root: int):
        self.value = [root]
        self.edges: list[dict[int, int]] = [{}]

    def add(self, x: int) -> None:
        at = 0
        while d := (self.value[at] ^ x).bit_count():
            below = self.edges[at].get(d)
            if below is None:
                self.edges[at][d] = len(self.value)
                self.value.append(x)
                self.edges.append({})
                return
            at = below

    def near(self, x: int, radius: int) -> Iterator[int]:
        """Values within ``radius`` of ``x``."""
        stack = [0]
        while stack:
            at = stack.pop()
            d = (self.value[at] ^ x).bit_count()
            if d <= radius:
                yield self.value[at]
            stack += [node for edge, node in self.edges[at].items() if d - radius <= edge <= d + radius]


class ShardTree:
    """The tree of one shard (value -> doc_id) and the links found so far; holds its members only."""

    def __init__(self, members: dict[int, int], radius: int):
        self.members, self.radius, self.parent = members, radius, {}
        values = iter(members)
        self.tree = BKTree(next(values))
        for v in values:
            self.tree.add(v)

    def _root(self, x: int) -> int:
        while (up := self.parent.get(x, x)) != x:
            self.parent[x] = x = self.parent.get(up, up)
        return x

    def links(self, x: int, doc: int) -> list[tuple[int, int]]:
        """Links (doc_id, doc_id) from ``x`` that join what is not yet joined: a spanning forest in all."""
        out, known = [], {self._root(x)} if x in self.members else set()
        for y in self.tree.near(x, self.radius):
            root = self._root(y)
            if root not in known:
                if known:
                    self.parent[root] = next(iter(known))
                else:
                    known = {root}
                out.append((doc, self.members[y]))
        return out

    def own_links(self) -> list[tuple[int, int]]:
        return [pair for x, doc in self.members.items() for pair in self.links(x, doc)]


def _blocks(n: int) -> list[tuple[int, int]]:
    """(shift, bits) of ``n`` blocks that cover 64 bits."""
    cuts = [64 * k // n for k in range(n + 1)]
    return [(lo, hi - lo) for lo, hi in zip(cuts, cuts[1:], strict=False)]


def near_links(distinct: DataFrame, radius: int = 3, tree_size: int = 2048) -> DataFrame:
    """``distinct(fp, rep)`` -> ``(a, b)`` links between reps whose fingerprints are within the radius."""
    part = [F.shiftrightunsigned("fp", lo).bitwiseAND(F.lit((1 << bits) - 1)) for lo, bits in _blocks(radius + 2)]
    keys = F.array(*[F.struct(F.lit(n).cast("byte").alias("pair"),
                              part[i].bitwiseOR(F.shiftleft(part[j], 32)).alias("key"))
                     for n, (i, j) in enumerate(combinations(range(radius + 2), 2))])
    shards = distinct.select("fp", "rep", F.explode(keys).alias("k")).select("k.pair", "k.key", "fp", "rep")
    # counted by aggregate and join, so that no shard, however hot, has to pass through one task whole
    sizes = shards.groupBy("pair", "key").agg(F.count("*").alias("n")).where("n > 1")
    shared = (shards.join(sizes, ["pair", "key"])
              .withColumn("trees", F.ceil(F.col("n") / tree_size).cast("int"))
              .withColumn("tree", F.explode(F.sequence(F.lit(0), F.col("trees") - 1)))
              .select("pair", "key", "tree", "fp", "rep",
                      (F.pmod(F.xxhash64("fp"), "trees") == F.col("tree")).alias("member")))

    def run(batches) -> Iterator:
        """A tree's members come before the other fingerprints of its shard, which pass one by one."""
        import pyarrow as pa

        key, members, shard = None, {}, None
        for batch in batches:
            links = []
            for pair, k, tree, fp, rep, member in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (pair, k, tree) != key:
                    if members and shard is None:
                        links += ShardTree(members, radius).own_links()
                    key, members, shard = (pair, k, tree), {}, None
                fp &= (1 << 64) - 1
                if member:
                    members[fp] = rep
                elif members:
                    if shard is None:
                        shard = ShardTree(members, radius)
                        links += shard.own_links()
                    links += shard.links(fp, rep)
            if links:
                a, b = zip(*links, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
        if members and shard is None and (links := ShardTree(members, radius).own_links()):
            a, b = zip(*links, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return (shared.repartition("pair", "key", "tree")
            .sortWithinPartitions("pair", "key", "tree", F.desc("member"))
            .transform(in_batches, run, "a long, b long"))


def near_components(docs: DataFrame, words: int = 3, radius: int = 3, tree_size: int = 2048) -> DataFrame:
    """``docs(doc_id, text)`` -> ``(doc_id, fp, component_id)``: the smallest doc_id reachable over
    links of at most ``radius`` bits, the document itself included.  An empty table gives no rows."""
    prints = written(fingerprints(docs, words), "fingerprints")
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("rep"))
    roots = components(near_links(distinct, radius, tree_size))
    classes = distinct.join(roots.withColumnRenamed("node", "rep"), "rep", "left").select(
        "fp", F.coalesce("component_id", "rep").alias("component_id"))
    return prints.join(classes, "fp").select("doc_id", "fp", "component_id")
