"""Near copies by SimHash, found with vantage-point trees over Hamming distance.

A sketch has a bit for each bit of its shingles' hashes, by majority. Distinct
sketches are partitioned by a vantage-point tree, fitted on a bounded sample: each
inner node sends what is within its radius of the vantage point one way and the
rest the other. A sketch is stored in one shard and asks all shards which the
triangle inequality does not rule out, so pairs across a boundary are met too.
Inside a shard a second tree prunes in the same way down to short lists.

Long sketches are searched band by band: near copies agree, but for a bit, in at
least one band. Inside a shard a band is looked up by value, without a second tree. The whole sketch names the candidates, with a bound well above the
expected distance, and the exact Jaccard similarity of the shingles decides. Texts that
have candidates in other components meet again by the rarest of their shingles, which
tells apart the many pairs of a family that are just below the similarity.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkspan.llm.common import by_slice, sent, texts, written
from inkspan.llm.graph import components

SEED = 42
#: Distinct sketches of one shard, and of the sample that the shards' tree is fitted on.
SHARD_ROWS = 1 << 15
SAMPLE_ROWS = 1 << 14
#: Sketches that are compared one by one at the end of a branch.
LEAF = 64
_BLOCK = 1 << 21
#: Pairs of sketches that are compared at a time where bands are looked up: few enough for a core's cache.
PAIRS = 1 << 15
#: Pairs of a band's value from which they are compared as a block.
DENSE = 1 << 12
#: Rows of a shard that a task works on at a time.
ROWS_AT_ONCE = 1 << 17
#: Share of its text that a document has lost if its earlier text counts too.
LOST = 0.1


@dataclass(frozen=True)
class Plan:
    """How sketches are made and linked."""

    shingle: int  # words
    words: int  # 64-bit words of a sketch
    most: int  # differing bits of a link
    bands: int = 1
    band_bits: int = 64
    band_most: int = 2  # differing bits of a band in which a link is found
    shard_rows: int = SHARD_ROWS
    similarity: float | None = None  # if given, links are pairs of this Jaccard similarity

    def band(self, sketches: np.ndarray, number: int) -> np.ndarray:
        """The bits of one band of each sketch, as one number."""
        start = number * self.band_bits
        word, shift = divmod(start, 64)
        value = sketches[:, word] << np.uint64(shift)
        if shift and shift + self.band_bits > 64:
            value |= sketches[:, word + 1] >> np.uint64(64 - shift)
        return value >> np.uint64(64 - self.band_bits)


def bits_for(similarity: float, bits: int) -> int:
    """Expected differing bits of two sets of equal size with this Jaccard similarity."""
    return math.floor(bits * math.acos(2 * similarity / (1 + similarity)) / math.pi)


#: Two differing bits of 64, three-word shingles.
SHORT = Plan(shingle=3, words=1, most=2)
#: Similarity 0.8 on five-word shingles: 512 bits, searched in 32 bands of 16 bits. At
#: 0.8 a distance of 77 is expected (deviation 8), of 96 for 4 shingles of 5.
LONG = Plan(
    shingle=5, words=8, most=120, bands=32, band_bits=16, band_most=1,
    shard_rows=1 << 18, similarity=0.8,
)


def shingle_hashes(text: str, k: int) -> np.ndarray:
    """XXH64 of each run of k words (all words, if fewer), A-Z in lower case."""
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) < k:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = [at - 1 for at in accumulate(len(w) + 1 for w in words)]
    starts = [0, *(end + 1 for end in ends[: len(words) - k])]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[k - 1 :], strict=True)], np.uint64)


def shingles_of(text: str, plan: Plan) -> np.ndarray:
    """The hashes that a sketch counts: each once, where links go by Jaccard similarity."""
    hashes = shingle_hashes(text, plan.shingle)
    return np.unique(hashes) if plan.similarity else hashes


def sketch(text: str, plan: Plan) -> bytes:
    """Big-endian bits: 1 where more than half of the hashes have a 1; 0 without words."""
    return _sketch(shingles_of(text, plan), plan)


def _sketch(hashes: np.ndarray, plan: Plan) -> bytes:
    counts = np.zeros(64 * plan.words, np.int64)
    for at in range(0, len(hashes), 4096):
        some = hashes[at : at + 4096, None]
        if plan.words > 1:  # further words are mixed from the hash
            some = some ^ (some >> np.uint64(29)) * (np.arange(plan.words, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            some = (some ^ (some >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            some ^= some >> np.uint64(32)
        bits = np.unpackbits(some.astype(">u8").view(np.uint8).reshape(len(some), -1), axis=1)
        counts += bits.sum(0, dtype=np.uint16)
    return np.packbits(2 * counts > len(hashes)).tobytes()


def as_words(sketches: list[bytes], plan: Plan) -> np.ndarray:
    return np.frombuffer(b"".join(sketches), ">u8").astype(np.uint64).reshape(-1, plan.words)


def sketched(docs: DataFrame, plan: Plan, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, mark (a hash of the text), sketch and node, a number for the sketch.

    Where links go by Jaccard similarity, node is a number for the set of shingles.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("mark"), F.col(text_col).alias("text")
    )

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found, nodes = [], []
        for text in texts(batch):
            hashes = shingles_of(text, plan)
            found.append(_sketch(hashes, plan))
            nodes.append(_node(hashes.tobytes() if plan.similarity else found[-1], plan))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("mark"), pa.array(found, pa.binary()),
             pa.array(nodes, pa.int64())],
            ["doc_id", "mark", "sketch", "node"],
        )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(by_slice(work), f"doc_id {kind}, mark long, sketch binary, node long")


def _node(found: bytes, plan: Plan) -> int:
    """A sketch of one word itself, else a hash; as a signed number."""
    number = xxhash.xxh64_intdigest(found, 1) if plan.similarity or len(found) != 8 else int.from_bytes(found)
    return number - (number >> 63 << 64)


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int16)


class Tree:
    """A vantage-point tree over numbers; ``rows`` of a leaf index into them."""

    def __init__(self, values: np.ndarray, rows: np.ndarray, leaf: int, depth: int = 64):
        self.rows, self.point = rows, None
        if len(rows) <= leaf or not depth:
            return
        point = values[rows[len(rows) // 2]]
        far = distance(values[rows], point)
        radius = int(np.median(far))
        if radius >= far.max():
            radius = int(far[far < far.max()].max(initial=-1))
        if radius < 0:
            return  # all are equal
        self.point, self.radius = point, radius
        self.inner = Tree(values, rows[far <= radius], leaf, depth - 1)
        self.outer = Tree(values, rows[far > radius], leaf, depth - 1)
        self.rows = rows[:0]

    def leaves(self) -> list[Tree]:
        return [self] if self.point is None else self.inner.leaves() + self.outer.leaves()

    def search(self, asked: np.ndarray, which: np.ndarray, most: int) -> Iterator[tuple[Tree, np.ndarray]]:
        """Each leaf with those of ``which`` that may have a value within ``most`` in it."""
        stack = [(self, which)]
        while stack:
            node, some = stack.pop()
            if not len(some):
                continue
            if node.point is None:
                yield node, some
                continue
            far = distance(asked[some], node.point)
            stack.append((node.inner, some[far <= node.radius + most]))
            stack.append((node.outer, some[far > node.radius - most]))


def shard_trees(sketches: DataFrame, plan: Plan, rows: int) -> list[Tree]:
    """For each band the tree whose leaves are its shards, numbered through all bands."""
    order = F.xxhash64("node")
    sample = sketches.select("sketch").orderBy(order, "node").limit(SAMPLE_ROWS).collect()
    known = as_words([bytes(r.sketch) for r in sample], plan)
    depth = max(0, math.ceil(math.log2(max(1, rows / plan.shard_rows))))
    trees, number = [], 0
    for band in range(plan.bands):
        tree = Tree(plan.band(known, band), np.arange(len(known)), 1, depth)
        for leaf in tree.leaves():
            leaf.rows, leaf.number = known[:0, 0], number
            number += 1
        trees.append(tree)
    return trees


def dealt(sketches: DataFrame, plan: Plan, trees: list[Tree], homes_only: bool = False) -> DataFrame:
    """shard, asks, node, root, sketch: each sketch at home once per band, and where else it asks.

    What is at home in a shard asks it as well, so that this needs no row of its own.

    The root is the component that is known so far, at first the node itself.
    """
    root = "root" if "root" in sketches.columns else "node"
    get = sent(sketches.sparkSession, trees)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_band = get()
        for batch in batches:
            known = as_words(batch.column("sketch").to_pylist(), plan)
            every = np.arange(len(known))
            for band, tree in enumerate(by_band):
                values, home = plan.band(known, band), np.full(len(known), -1)
                for asks, most in ((False, 0), (True, plan.band_most))[: 1 if homes_only else 2]:
                    for leaf, some in tree.search(values, every, most):
                        if asks:
                            some = some[home[some] != leaf.number]
                        else:
                            home[some] = leaf.number
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(some), leaf.number)), pa.array([asks] * len(some), pa.bool_()),
                             *(batch.column(c).take(pa.array(some, pa.int64())) for c in ("node", "root", "sketch"))],
                            ["shard", "asks", "node", "root", "sketch"],
                        )

    return sketches.select("node", F.col(root).alias("root"), "sketch").mapInArrow(
        work, "shard long, asks boolean, node long, root long, sketch binary"
    )


def links(sketches: DataFrame, plan: Plan) -> DataFrame:
    """Edges (a, b) between nodes that connect all distinct sketches that are linked.

    No more than one edge per sketch and shard is written, however many pairs a
    group has: those that connect the same sketches as the pairs do.
    """
    return _searched(sketches, plan, lambda key, band: Shard(key, plan, band))


def candidates(sketches: DataFrame, plan: Plan) -> DataFrame:
    """a < b: pairs of nodes of different roots that are within ``most`` bits.

    For each sketch and shard the nearest one and the one of lowest number that is
    likely to be similar; so each node that has such a pair is in one.
    """
    found = _searched(sketches, plan, lambda key, band: Candidates(key, plan, band))
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _searched(sketches: DataFrame, plan: Plan, shard_of: Callable) -> DataFrame:
    """What the shards give. One that holds many more than its share is cut into
    pieces that all its askers meet."""
    rows = sketches.count()
    trees = shard_trees(sketches, plan, rows)
    spread, cuts = dealt(sketches, plan, trees), {}
    if rows > plan.shard_rows:
        # Only the homes are dealt out for this count; nothing is shuffled but counts.
        homes = dealt(sketches, plan, trees, homes_only=True).groupBy("shard").count().where(
            f"count > {2 * plan.shard_rows}"
        )
        cuts = {r.shard: math.ceil(r["count"] / plan.shard_rows) for r in homes.collect()}
    n = F.lit(1)
    if cuts:
        table = F.create_map(*(F.lit(x) for pair in cuts.items() for x in pair))
        n = F.coalesce(table[F.col("shard")], F.lit(1))
    # A home of a shard that is cut is at home in one piece, and asks the others.
    own = F.pmod(F.xxhash64("node"), n).cast("int")
    pieces = F.transform(F.sequence(F.lit(0), n - 1), lambda p: F.struct(
        p.cast("int").alias("piece"), (F.col("asks") | (p != own)).alias("asks")
    ))
    if cuts:
        spread = spread.withColumn("at", F.explode(pieces)).select(
            "shard", "node", "root", "sketch", "at.piece", "at.asks"
        )
    else:
        spread = spread.withColumn("piece", F.lit(0))
    band_of = np.array([band for band, tree in enumerate(trees) for _ in tree.leaves()])
    bands = sketches.sparkSession.sparkContext.broadcast(band_of)
    tasks = max(int(sketches.sparkSession.conf.get("spark.sql.shuffle.partitions")), len(band_of) + sum(cuts.values()))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = None
        for key, part in _by_shard(batches):
            if shard is None or shard.key != key:
                if shard is not None:
                    yield from map(_edges, shard.ended())
                shard = shard_of(key, int(bands.value[key[0]]))
            yield from map(_edges, shard.found(
                np.array(part.column("asks").to_numpy(), bool), part.column("node").to_numpy(),
                as_words(part.column("sketch").to_pylist(), plan), part.column("root").to_numpy(),
            ))
        if shard is not None:
            yield from map(_edges, shard.ended())

    # Places are numbers, not hashes of them: a shard or a piece shares its task with no other.
    further = dict(zip(cuts, np.cumsum([len(band_of), *(n - 1 for n in cuts.values())]).tolist(), strict=False))
    place = F.col("shard")
    if cuts:
        table = F.create_map(*(F.lit(x) for pair in further.items() for x in pair))
        place = F.when(F.col("piece") == 0, place).otherwise(table[F.col("shard")] + F.col("piece") - 1)
    met = spread.withColumn("place", place).repartitionById(tasks, F.col("place").cast("int"))
    met = met.drop("place").sortWithinPartitions("shard", "piece", "asks")
    return met.mapInArrow(search, "a long, b long")


def _by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], pa.Table]]:
    """The rows of each shard and piece, one after the other, many at a time.

    A tree is walked once for all that ask it together, so few rows at a time would
    walk it again and again.
    """
    key, held, rows = None, [], 0
    for batch in batches:
        numbers = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("shard", "piece")], axis=1)
        cuts = [0, *(np.flatnonzero((numbers[1:] != numbers[:-1]).any(axis=1)) + 1).tolist(), len(numbers)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if a == b:
                continue
            now = (int(numbers[a, 0]), int(numbers[a, 1]))
            if held and (now != key or rows >= ROWS_AT_ONCE):
                yield key, pa.Table.from_batches(held)
                held, rows = [], 0
            key = now
            held.append(batch.slice(a, b - a))
            rows += b - a
    if held:
        yield key, pa.Table.from_batches(held)


def _edges(found: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in found], ["a", "b"])


class Shard:
    """The sketches at home in one shard, and what those that ask it are linked to."""

    def __init__(self, key: tuple[int, int], plan: Plan, band: int):
        self.key, self.plan, self.band = key, plan, band
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.tree = None

    def take(self, asks: np.ndarray, nodes: np.ndarray, sketches: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Homes come first; then each asking sketch gives an edge to one that it meets."""
        if not asks.all():
            self.parts.append((nodes[~asks], sketches[~asks]))
        if not asks.any() or not self.parts:
            return np.zeros(0), np.zeros(0)
        if self.tree is None:
            self.nodes = np.concatenate([p[0] for p in self.parts])
            self.sketches = np.concatenate([p[1] for p in self.parts])
            self.group = np.arange(len(self.nodes))
            values = self.plan.band(self.sketches, self.band)
            self.values, self.tree = values, Tree(values, np.arange(len(values)), LEAF)
        nodes, sketches = nodes[asks], sketches[asks]
        values = self.plan.band(sketches, self.band)
        first = np.full(len(nodes), len(self.nodes))
        pairs = []
        for leaf, some in self.tree.search(values, np.arange(len(nodes)), self.plan.band_most):
            pairs += self._match(some, leaf.rows, sketches, values)
        if pairs:
            q, x = (np.concatenate(side) for side in zip(*pairs, strict=True))
            other = nodes[q] != self.nodes[x]
            q, x = q[other], x[other]
            np.minimum.at(first, q, x)
            self._join(first[q], x)
        some = np.flatnonzero(first < len(self.nodes))
        a, b = nodes[some], self.nodes[first[some]]
        return a[a != b], b[a != b]

    def found(self, asks: np.ndarray, nodes: np.ndarray, sketches: np.ndarray, _) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        yield self.take(asks, nodes, sketches)

    def ended(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """What the homes give that ask their own shard, some at a time, and at last the stars."""
        for part in list(self.parts):
            for at in range(0, len(part[0]), ROWS_AT_ONCE):
                nodes, sketches, *roots = (column[at : at + ROWS_AT_ONCE] for column in part)
                yield from self.found(np.ones(len(nodes), bool), nodes, sketches, roots[0] if roots else nodes)
        yield self.stars()

    def _near(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which sketches of a and b are linked, with broadcasting over all but the last axis."""
        return np.bitwise_count(a ^ b).sum(-1, dtype=np.int16) <= self.plan.most

    def _match(
        self, asked: np.ndarray, rows: np.ndarray, sketches: np.ndarray, values: np.ndarray
    ) -> list[tuple[np.ndarray, np.ndarray]]:
        """Linked pairs of a leaf: close in the band, and then in the whole sketch.

        A long list gives enough of them to connect the same.

        What is near one sketch of the list is connected through it, so of the pairs
        among those only the ones with that sketch count; all others are compared.
        """
        if len(asked) * len(rows) <= _BLOCK // self.plan.words:
            close = np.bitwise_count(values[asked][:, None] ^ self.values[rows]) <= self.plan.band_most
            q, x = np.nonzero(close)
            near = self._near(sketches[asked[q]], self.sketches[rows[x]])
            return [(asked[q[near]], rows[x[near]])] if near.any() else []
        if len(rows) <= LEAF:
            half = len(asked) // 2
            return self._match(asked[:half], rows, sketches, values) + self._match(
                asked[half:], rows, sketches, values
            )
        middle = self.sketches[rows[0]]
        near_q = self._near(sketches[asked], middle)
        near_x = self._near(self.sketches[rows], middle)
        self._join(np.full(near_x.sum(), rows[0]), rows[near_x])
        found = [(asked[near_q], np.full(near_q.sum(), rows[0]))]
        for q, x in ((near_q, ~near_x), (~near_q, near_x), (~near_q, ~near_x)):
            if q.any() and x.any():
                found += self._match(asked[q], rows[x], sketches, values)
        return found

    def _join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Put each pair of homes in one group, named by its smallest row."""
        while len(a):
            a, b = self.group[a], self.group[b]
            low, high = np.minimum(a, b), np.maximum(a, b)
            differ = low != high
            a, b, low, high = a[differ], b[differ], low[differ], high[differ]
            np.minimum.at(self.group, high, low)
            while (up := self.group[self.group] != self.group).any():
                self.group[up] = self.group[self.group[up]]

    def stars(self) -> tuple[np.ndarray, np.ndarray]:
        """At the end: each home with the first of its group."""
        if self.tree is None:
            return np.zeros(0), np.zeros(0)
        some = np.flatnonzero(self.group != np.arange(len(self.group)))
        return self.nodes[some], self.nodes[self.group[some]]


def flips(bits: int, most: int) -> np.ndarray:
    """All numbers of so many bits with at most ``most`` of them set."""
    some = [sum(1 << i for i in at) for n in range(most + 1) for at in combinations(range(bits), n)]
    return np.array(some, np.uint64)


def _differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """By how many bits sketches differ, with broadcasting; their words are the first axis."""
    far = np.bitwise_count(a[0] ^ b[0]).astype(np.int16)
    for one, other in zip(a[1:], b[1:], strict=True):
        far += np.bitwise_count(one ^ other)
    return far


class Candidates(Shard):
    """The sketches at home in one shard, and some pairs with each of those that ask it.

    A band is a short number, so what is near one is looked up by each number that is
    near: this meets the pairs that are close in the band and no others.
    """

    def __init__(self, key: tuple[int, int], plan: Plan, band: int):
        super().__init__(key, plan, band)
        self.likely = bits_for(plan.similarity, 64 * plan.words)
        self.values = None
        # Words after which two unrelated sketches differ by more than is allowed, but for three deviations.
        self.sure = next((n for n in range(1, plan.words) if 32 * n - 12 * n**0.5 > plan.most), plan.words)

    def found(
        self, asks: np.ndarray, nodes: np.ndarray, sketches: np.ndarray, roots: np.ndarray
    ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Homes come first; then each asking sketch gives two pairs at most."""
        if not asks.all():
            self.parts.append((nodes[~asks], sketches[~asks], roots[~asks]))
        if not asks.any() or not self.parts:
            return
        if self.values is None:
            self.nodes, self.sketches, self.roots = (np.concatenate(p) for p in zip(*self.parts, strict=True))
            values = self.plan.band(self.sketches, self.band)
            order = np.argsort(values, kind="stable")
            self.values, self.nodes, self.sketches, self.roots = (
                x[order] for x in (values, self.nodes, self.sketches, self.roots)
            )
            self.parts = [(self.nodes, self.sketches, self.roots)]  # not held twice
            self.columns = np.ascontiguousarray(self.sketches.T)
        nodes, sketches, roots = nodes[asks], sketches[asks], roots[asks]
        columns = np.ascontiguousarray(sketches.T)
        none = np.iinfo(np.int64).max
        best, nearest, lowest = np.full(len(nodes), none), np.full(len(nodes), none), np.full(len(nodes), none)
        for q, x in self._close(columns, self.plan.band(sketches, self.band)):
            keep = roots[q] != self.roots[x]
            q, x, far = self._within(columns, q[keep], x[keep])
            if not len(q):
                continue
            order = np.lexsort((self.nodes[x], far, q))
            first = order[np.flatnonzero(np.diff(q[order], prepend=-1))]
            to, node, bits = q[first], self.nodes[x[first]], far[first]
            better = (bits < best[to]) | ((bits == best[to]) & (node < nearest[to]))
            best[to[better]], nearest[to[better]] = bits[better], node[better]
            likely = far <= self.likely
            np.minimum.at(lowest, q[likely], self.nodes[x[likely]])
        for other in (nearest, lowest):
            some = np.flatnonzero(other != none)
            yield nodes[some], other[some]

    def _close(self, columns: np.ndarray, asked: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Asked sketches and homes that are close in the band, some pairs at a time.

        Where many ask with one value, all of them meet all that is near it as a block,
        which leaves out what differs too much already in its first words.
        """
        known, which, count = np.unique(asked, return_inverse=True, return_counts=True)
        by_value, first = np.argsort(which, kind="stable"), np.cumsum(count) - count
        near = known ^ flips(self.plan.band_bits, self.plan.band_most)[:, None]
        starts = np.searchsorted(self.values, near)
        sizes = np.searchsorted(self.values, near, "right") - starts
        many = count * sizes.sum(0) >= DENSE
        for value in np.flatnonzero(many):
            asking = by_value[first[value] : first[value] + count[value]]
            rows = np.concatenate([np.arange(at, at + n) for at, n in zip(starts[:, value], sizes[:, value], strict=True)])
            homes, step = self.columns[: self.sure, rows], max(1, PAIRS // len(rows))
            for at in range(0, len(asking), step):
                some = asking[at : at + step]
                far = _differing(columns[: self.sure, some, None], homes[:, None])
                if (close := np.flatnonzero(far <= self.plan.most)).size:
                    yield some[close // len(rows)], rows[close % len(rows)]
        sizes[:, many] = 0
        for start, size in zip(starts, sizes, strict=True):
            asking = by_value[size[which[by_value]] > 0]
            start, n = start[which[asking]], size[which[asking]]
            ends, at = np.cumsum(n), 0
            while at < len(asking):
                to = max(at + 1, int(np.searchsorted(ends, ends[at] - n[at] + PAIRS, "right")))
                some = n[at:to]
                rows = np.arange(some.sum()) + np.repeat(start[at:to] - (np.cumsum(some) - some), some)
                yield np.repeat(asking[at:to], some), rows
                at = to

    def _within(self, columns: np.ndarray, q: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The pairs that are within ``most`` bits, and by how many they differ.

        They are counted word by word. Half of the bits of two unrelated sketches differ,
        so most pairs are given up before their last word.
        """
        far = np.zeros(len(q), np.int64)
        for word in range(self.plan.words):
            far += np.bitwise_count(columns[word][q] ^ self.columns[word][x])
            if 32 * (word + 1) > self.plan.most or word + 1 == self.plan.words:
                keep = far <= self.plan.most
                q, x, far = q[keep], x[keep], far[keep]
        return q, x, far

    def stars(self) -> tuple[np.ndarray, np.ndarray]:
        return np.zeros(0), np.zeros(0)


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sets, each without repeats."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / max(1, len(a) + len(b) - both)


def shingle_sets(pairs: DataFrame, nodes: DataFrame, rows: DataFrame, plan: Plan) -> DataFrame:
    """node and shingles, their hashes, for each node that is in some pair.

    Sets are made of the text of one document per node.
    """
    asked = nodes.join(_ends(pairs), "node").select("node", F.col("one.doc_id").alias("_id"), F.col("one.mark").alias("_mark"))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingles_of(text, plan).view(np.int64) for text in texts(batch)]
        ends = np.cumsum([0, *map(len, sets)])
        hashes = np.concatenate([np.zeros(0, np.int64), *sets])
        shingles = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(hashes))
        return pa.RecordBatch.from_arrays([batch.column("node"), shingles], ["node", "shingles"])

    met = rows.join(asked, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark")))
    sets = met.select("node", "text").mapInArrow(by_slice(work), "node long, shingles array<long>")
    return sets.groupBy("node").agg(F.first("shingles").alias("shingles"))


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()


def verified(pairs: DataFrame, sets: DataFrame, plan: Plan) -> DataFrame:
    """The pairs whose sets of shingles have the similarity of the plan."""
    sets = sets.select("node", "shingles")
    both = pairs.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b")

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = ((x.values.to_numpy() for x in batch.column(c)) for c in ("set_a", "set_b"))
            alike = [jaccard(x, y) >= plan.similarity for x, y in zip(a, b, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(alike, pa.bool_()))

    return both.select("a", "b", "set_a", "set_b").mapInArrow(decide, "a long, b long")


def may_be_similar(sets: DataFrame, plan: Plan) -> DataFrame:
    """a < b: pairs of different roots, among them all that have the similarity of the plan.

    ``sets`` has node, root and shingles. All shingles stand in one order: first those of
    a single root, then the others by how many pairs of different roots have them. Two
    sets share no more than each has left from the first shingle in both on, so similar
    ones meet by a shingle with enough left. Pairs just below the similarity seldom do:
    they differ in more shingles than may stand before it, and those come first.
    """
    each = sets.select("node", "root", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
    of_root = each.groupBy("shingle", "root").agg(F.count("*").alias("n"))
    shared = of_root.groupBy("shingle").agg(
        F.max_by("root", F.struct("n", "root")).alias("main"),
        (F.pow(F.sum("n"), F.lit(2.0)) - F.sum(F.col("n").cast("double") * F.col("n"))).alias("pairs"),
        F.count("*").alias("roots"),
    ).where("roots > 1").drop("roots")
    from_last = Window.partitionBy("node").orderBy(F.desc("pairs"), F.desc("shingle"))
    rare = each.join(shared, "shingle").withColumn("left", F.row_number().over(from_last)).where(
        F.col("left") >= plan.similarity * F.col("n") - 1e-6
    ).select("shingle", "node", "root", "n", "left", (F.col("root") == F.col("main")).alias("is_main"))
    rare = written(rare, "rare-shingles")
    # Nodes of the main root of a shingle do not meet each other, however many they are.
    a, b = rare.where("NOT is_main").alias("a"), rare.alias("b")
    enough = plan.similarity / (1 + plan.similarity) * (F.col("a.n") + F.col("b.n")) - 1e-6
    met = a.join(b, (F.col("a.shingle") == F.col("b.shingle")) & (F.col("a.root") != F.col("b.root"))
                 & (F.least("a.left", "b.left") >= enough) & (F.col("b.is_main") | (F.col("a.node") < F.col("b.node"))))
    return met.select(F.least("a.node", "b.node").alias("a"), F.greatest("a.node", "b.node").alias("b")).distinct()


def similar(nodes: DataFrame, rows: DataFrame, plan: Plan, known: DataFrame | None = None) -> DataFrame:
    """Edges (a, b) that connect all nodes that pairs of the plan's similarity connect.

    A few candidates of each node are decided first. Nodes that still have candidates in
    other components then meet by their rarest shingles, so neither a group of near
    copies nor a family of texts just below the similarity costs all its pairs.
    ``known`` are edges that hold without being looked for.
    """
    pairs = written(candidates(nodes, plan), "candidates")
    sets = written(shingle_sets(pairs, nodes, rows, plan), "shingles")
    first = verified(pairs, sets, plan)
    first = written(first if known is None else first.unionByName(known), "similar")
    rooted = nodes.join(components(first), "node", "left").withColumn("root", F.coalesce("root", "node"))
    rooted = written(rooted, "rooted")
    # Who has a candidate of another root now had one before, so its set is known.
    sets = sets.join(rooted.select("node", "root"), "node").join(_ends(candidates(rooted, plan)), "node", "left_semi")
    sets = written(sets, "open-sets")
    pairs = written(may_be_similar(sets, plan), "candidates")
    return first.unionByName(written(verified(pairs, sets, plan), "similar"))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("mark"), F.col(text_col).alias("text")
    )


def changed(docs: DataFrame, earlier: DataFrame) -> DataFrame:
    """doc_id, mark and text of the earlier texts of documents that have lost ``LOST`` of theirs since.

    What lost less still resembles its earlier text. Only of ids that one row has on
    each side. Ids and lengths are compared first, so that other texts are not fetched.
    """
    now, then = (
        t.groupBy("doc_id").agg(F.count("*").alias("n"), F.min(F.length("text")).alias("length")).where("n = 1")
        for t in (docs, earlier)
    )
    ids = now.join(then.toDF("doc_id", "n_then", "length_then"), "doc_id")
    ids = ids.where(F.col("length") <= (1 - LOST) * F.col("length_then")).select("doc_id")
    return earlier.join(ids, "doc_id", "left_semi")


def near_groups(
    docs: DataFrame, plan: Plan, id_col: str = "doc_id", text_col: str = "text", earlier: DataFrame | None = None
) -> DataFrame:
    """One row per document: doc_id, mark, sketch, root, component_id, the smallest id it reaches.

    Null and empty texts have no words and the sketch of zeros, linked like any
    other. A null id is no candidate for the smallest unless a component has no
    other. Repeated rows are rows of one component; other columns are not read.

    ``earlier`` is a table of the same columns with the texts before some editing, as
    lines were taken out. Documents then are linked by their earlier texts as well,
    as far as their ids are of one row each (``changed``).
    """
    rows = written(sketched(docs, plan, id_col, text_col), "sketches")
    whole, every, same = _texts(docs, id_col, text_col), rows, None
    if earlier is not None:
        before = written(changed(whole, _texts(earlier, id_col, text_col)), "earlier-texts")
        of_before = written(sketched(before, plan), "earlier-sketches")
        whole, every = whole.unionByName(before), rows.unionByName(of_before)
        same = of_before.select("doc_id", F.col("node").alias("a")).join(
            rows.select("doc_id", F.col("node").alias("b")), "doc_id"
        ).select("a", "b")
    nodes = written(
        every.groupBy("node").agg(
            F.first("sketch").alias("sketch"), F.min("doc_id").alias("least"),
            F.min(F.struct("doc_id", "mark")).alias("one"),
        ), "nodes"
    )
    if plan.similarity:
        edges = similar(nodes, whole, plan, same)
    else:
        edges = links(nodes, plan) if same is None else links(nodes, plan).unionByName(same)
    roots = components(edges)
    named = nodes.select("node", "least").join(roots, "node", "left").withColumn(
        "root", F.coalesce("root", "node")
    )
    named = written(named, "roots")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of_node = named.join(least, "root").select("node", "root", "component_id")
    return rows.join(of_node, "node").select("doc_id", "mark", "sketch", "root", "component_id")


def one_of_each(
    docs: DataFrame, plan: Plan = LONG, id_col: str = "doc_id", text_col: str = "text", earlier: DataFrame | None = None
) -> DataFrame:
    """The documents without near copies: of each component the one of smallest id stays.

    ``earlier`` holds texts before some editing, by which documents are linked as well.

    Of equal ids, or where all are null, the text of the smallest hash stays, once.
    All columns stay as they are.
    """
    groups = near_groups(docs, plan, id_col, text_col, earlier)
    kept = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root", "doc_id").agg(
        F.min("mark").alias("mark")
    ).select(F.col("doc_id").alias("_kept_id"), F.col("mark").alias("_kept_mark")).distinct()
    rows = docs.select(F.struct(*docs.columns).alias("_row"))
    rows = rows.select("_row", F.col("_row")[id_col].alias("_id"), F.xxhash64(F.col("_row")[text_col]).alias("_mark"))
    met = rows.join(kept, F.col("_id").eqNullSafe(F.col("_kept_id")) & (F.col("_mark") == F.col("_kept_mark")))
    once = F.row_number().over(Window.partitionBy("_kept_id", "_kept_mark").orderBy(F.lit(0)))
    return met.withColumn("_n", once).where("_n = 1").select(*(F.col("_row")[c].alias(c) for c in docs.columns))
