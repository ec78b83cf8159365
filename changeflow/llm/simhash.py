"""SimHash near-dedup of whole texts over a Gray-order hierarchical index.

1. A document's fingerprint has the bits that over half of its shingles' hashes have. Equal fingerprints are one.
2. Fingerprints with at most 4 different bits agree on one of 5 blocks of bits. So each fingerprint is entered five times,
   turned so that one of its blocks leads; the entries of a block's value are sorted by Gray rank and cut into parts
   of bounded size. A part is the root of a tree over its entries: a node takes 8 neighbours and holds the bits that
   they share beyond those of the nodes above it.
3. A fingerprint walks down the tree of its part and adds up, node by node, in how many of the shared bits it differs;
   a node is left out with all below it where the sum is over 4, and where all below it are in its component already.
4. The entries of a block's value with several parts are sorted by component and cut into parts anew. A part meets itself
   and, if their shared bits allow it, each other part of the value; what lies in one component is not compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.llm.components import components
from changeflow.operators.skew import hot_from_counts, salted_left_join
from changeflow.session import materialise

WORDS = 4
SEED = 42
BITS = 64

#: Entries of a part, children of a node, fingerprints that walk at once, entries of a forest.
PART = 2048
FAN_OUT = 8
WALKING = 256
FOREST = 1 << 14

#: Hashes whose bits are counted at once.
HASHES = 1 << 17


def shingle_hashes(text: str | None) -> list[int]:
    """XXH64 of each run of :data:`WORDS` words, with repeats; fewer words are one run, no words none."""
    words = (text or "").encode().lower().split()  # of bytes: ASCII letters, ASCII white space
    if not words:
        return []
    line = b" ".join(words)
    if len(words) <= WORDS:
        return [xxhash.xxh64_intdigest(line, SEED)]
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-WORDS] + 1])
    digest = xxhash.xxh64_intdigest
    return [digest(line[a:b], SEED) for a, b in zip(starts.tolist(), ends[WORDS - 1 :].tolist(), strict=True)]


def fingerprint(hashes: list[int]) -> int:
    """The bits that over half of the hashes have; zero without hashes."""
    total = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), HASHES):
        some = np.array(hashes[at : at + HASHES], "<u8")
        total += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, print``: the fingerprint of every row as a signed 64-bit number."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(shingle_hashes(t)) for t in batch[1].to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch[0], pa.array(prints.view(np.int64))], names=["doc_id", "print"])

    return materialise(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(digest, "doc_id long, print long"), "prints")


def edges_of(most: int) -> list[int]:
    """Where the ``most + 1`` blocks of a fingerprint begin, and the end: two that differ in ``most`` bits agree on one."""
    return [BITS * i // (most + 1) for i in range(most + 2)]


def turned(prints: np.ndarray, first: int) -> np.ndarray:
    """Fingerprints with bit ``first``, counted from the highest, in front."""
    if not first:
        return prints
    return (prints << np.uint64(first)) | (prints >> np.uint64(BITS - first))


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The place of each code in the order in which neighbours differ by one bit."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class Forest:
    """Trees over parts of entries that stand in Gray order; the entries of part ``i`` are ``edges[i]:edges[i + 1]``."""

    def __init__(self, codes: np.ndarray, edges: np.ndarray) -> None:
        self.codes = codes
        sizes = np.diff(edges)
        within = np.arange(len(codes)) - np.repeat(edges[:-1], sizes)
        part = np.repeat(np.arange(len(sizes)), sizes)
        # from the leaves up: the first entry of each node
        self.begins = [np.arange(len(codes))]
        reach = FAN_OUT
        while reach < int(sizes.max(initial=0)):
            self.begins.append(np.flatnonzero(within % reach == 0))
            reach *= FAN_OUT
        self.begins.append(edges[:-1][sizes > 0])
        self.root_of = np.cumsum(sizes > 0)[part] - 1
        self.shared, self.pattern = [], []
        for begins in self.begins:
            both, some = np.bitwise_and.reduceat(codes, begins), np.bitwise_or.reduceat(codes, begins)
            self.shared.append(~(both ^ some))
            self.pattern.append(both)
        self.children = []
        for above, below in zip(self.begins[1:], self.begins, strict=False):
            self.children.append(np.searchsorted(below, np.append(above, len(codes))))
        # a node keeps what its parent does not share
        self.own = []
        for level, begins in enumerate(self.begins[:-1]):
            parent = np.searchsorted(self.begins[level + 1], begins, "right") - 1
            self.own.append(self.shared[level] & ~self.shared[level + 1][parent])
        self.own.append(self.shared[-1])
        self.last = [np.append(begins[1:], len(codes)) - 1 for begins in self.begins]

    def ranges(self, label: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """The least and the greatest component below each node."""
        return [(np.minimum.reduceat(label, b), np.maximum.reduceat(label, b)) for b in self.begins]

    def near(self, codes: np.ndarray, roots: np.ndarray, label: np.ndarray, ranges: list, most: int, after: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of a code and an entry under its root that differ in ``most`` bits at most and lie in different
        components. Only entries after ``after`` count, if given."""
        who, node, differs = np.arange(len(codes)), roots, np.zeros(len(codes), np.int64)
        for level in range(len(self.begins) - 1, -1, -1):
            if level < len(self.begins) - 1:
                lo, hi = self.children[level][node], self.children[level][node + 1]
                n = hi - lo
                who, differs = np.repeat(who, n), np.repeat(differs, n)
                node = np.arange(len(who)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
            lo, hi = ranges[level]
            open_ = ~((lo[node] == label[who]) & (hi[node] == label[who]))
            if after is not None:
                open_ &= self.last[level][node] > after[who]
            who, node, differs = who[open_], node[open_], differs[open_]
            differs = differs + np.bitwise_count((codes[who] ^ self.pattern[level][node]) & self.own[level][node])
            close = differs <= most
            who, node, differs = who[close], node[close], differs[close]
        return who, node


class Union:
    """Components of numbered things; keeps the links that joined two of them."""

    def __init__(self, label: np.ndarray) -> None:
        names, self.label = np.unique(label, return_inverse=True)
        self.parent = np.arange(len(names))

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = x = self.parent[self.parent[x]]
        return x

    def join(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which of the links ``a, b``, places in ``label``, joined two components."""
        pairs = np.stack([self.label[a], self.label[b]], 1)
        _, one = np.unique(pairs, axis=0, return_index=True)
        used = []
        for i in one.tolist():
            x, y = self.root(int(pairs[i, 0])), self.root(int(pairs[i, 1]))
            if x != y:
                self.parent[max(x, y)] = min(x, y)
                used.append(i)
        if used:
            while (self.parent[self.parent] != self.parent).any():
                self.parent = self.parent[self.parent]
            self.label = self.parent[self.label]
        return np.array(used, np.int64)


def linked_within(codes: np.ndarray, edges: np.ndarray, most: int, label: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Links, by place, that join all entries of a part which chains of links join; each joins two components. ``label``:
    the components that are known, if any."""
    forest = Forest(codes, edges)
    union = Union(np.arange(len(codes)) if label is None else label)
    next_to = np.flatnonzero((forest.root_of[1:] == forest.root_of[:-1]) & (np.bitwise_count(codes[1:] ^ codes[:-1]) <= most))
    union.join(next_to, next_to + 1)
    found = [(next_to, next_to + 1)]
    ranges = forest.ranges(union.label)
    for at in range(0, len(codes), WALKING):
        some = np.arange(at, min(at + WALKING, len(codes)))
        who, entry = forest.near(codes[some], forest.root_of[some], union.label[some], ranges, most, some)
        used = union.join(some[who], entry) if len(who) else who
        if len(used):
            found.append((some[who][used], entry[used]))
            ranges = forest.ranges(union.label)
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def linked_across(codes: np.ndarray, label: np.ndarray, others: np.ndarray, other_label: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The same between two parts whose entries lie in known components: places in ``codes`` and in ``others``."""
    order = np.argsort(gray_rank(others), kind="stable")
    forest = Forest(others[order], np.array([0, len(others)]))
    union = Union(np.concatenate([label, other_label[order]]))
    found = []
    ranges = forest.ranges(union.label[len(codes) :])
    for at in range(0, len(codes), WALKING):
        some = np.arange(at, min(at + WALKING, len(codes)))
        # labels are compared with those of the entries, so both come from one numbering
        who, entry = forest.near(codes[some], np.zeros(len(some), np.int64), union.label[some], ranges, most)
        used = union.join(some[who], entry + len(codes)) if len(who) else who
        if len(used):
            found.append((some[who][used], order[entry[used]]))
            ranges = forest.ranges(union.label[len(codes) :])
    none = np.zeros(0, np.int64)
    return tuple(np.concatenate(c) for c in zip(*found, strict=True)) if found else (none, none)


def entries(prints: DataFrame, most: int) -> DataFrame:
    """``turn, block, code`` and all other columns of ``prints`` (``print`` and others) under every leading block."""
    edges = edges_of(most)

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch["print"].to_numpy().view(np.uint64)
            for i, (first, end) in enumerate(zip(edges, edges[1:], strict=False)):
                codes = turned(prints, first)
                blocks = (codes >> np.uint64(BITS - end + first)).astype(np.int32)
                # a signed number sorts like the rank
                rank = (gray_rank(codes) ^ np.uint64(1 << 63)).view(np.int64)
                turns = pa.array(np.full(len(prints), i, np.int32))
                columns = [turns, pa.array(blocks), pa.array(rank), pa.array(codes.view(np.int64)), *batch.columns[1:]]
                yield pa.RecordBatch.from_arrays(columns, names=["turn", "block", "rank", "code", *batch.schema.names[1:]])

    kept = [f"{c} long" for c in prints.columns if c != "print"]
    return prints.select("print", *[c for c in prints.columns if c != "print"]).mapInArrow(turn, ", ".join(["turn int, block int, rank long, code long", *kept]))


PARTS = "turn int, block int, part long, shared long, pattern long, lo long, hi long, codes binary, labels binary"


def parts(sorted_entries: DataFrame, labels: bool) -> DataFrame:
    """Cut sorted entries (``turn, block, code`` and, if ``labels``, ``component``) into parts: at most :data:`PART`
    neighbours of one block's value, with the bits that they share and the range of their components."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 40
        names = [c.split()[0] for c in PARTS.split(", ")]
        types = [pa.int32(), pa.int32(), *[pa.int64()] * 5, pa.binary(), pa.binary()]
        held: tuple[np.ndarray, ...] | None = None

        def rows(turn, block, code, label, whole: bool):
            """The parts of some entries, but the last of them if it may go on."""
            nonlocal number
            new = np.concatenate([[True], (turn[1:] != turn[:-1]) | (block[1:] != block[:-1])])
            first = np.maximum.accumulate(np.where(new, np.arange(len(turn)), 0))
            begins = np.flatnonzero((np.arange(len(turn)) - first) % PART == 0)
            ends = np.append(begins[1:], len(turn))
            if not whole and ends[-1] - begins[-1] < PART:
                begins, ends = begins[:-1], ends[:-1]
            made = []
            for a, b in zip(begins.tolist(), ends.tolist(), strict=True):
                codes = code[a:b]
                both, some = np.bitwise_and.reduce(codes), np.bitwise_or.reduce(codes)
                kept = label[a:b]
                lo, hi = (int(kept.min()), int(kept.max())) if labels else (None, None)
                made.append((int(turn[a]), int(block[a]), number, int(~(both ^ some)), int(both), lo, hi, codes.tobytes(), kept.tobytes() if labels else None))
                number += 1
            columns = [pa.array(c, t) for c, t in zip(zip(*made, strict=True), types, strict=True)] if made else [pa.array([], t) for t in types]
            return (ends[-1] if len(ends) else 0), pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            columns = [batch[c].to_numpy() for c in ("turn", "block", "code", *(["component"] if labels else []))]
            columns = columns if labels else [*columns, columns[2]]
            held = tuple(columns) if held is None else tuple(np.concatenate(c) for c in zip(held, columns, strict=True))
            if len(held[0]) >= FOREST:
                done, out = rows(*held, False)
                yield out
                held = tuple(c[done:] for c in held)
        if held is not None and len(held[0]):
            yield rows(*held, True)[1]

    read = ["turn", "block", "code", *(["component"] if labels else [])]
    return sorted_entries.select(*read).mapInArrow(cut, PARTS)


LINKS = "a long, b long"


def unturned(codes: np.ndarray, turns: np.ndarray, edges: list[int]) -> pa.Array:
    out = np.empty(len(codes), np.uint64)
    for i, first in enumerate(edges[:-1]):
        out[turns == i] = turned(codes[turns == i], (BITS - first) % BITS)
    return pa.array(out.view(np.int64))


def links_within(made: DataFrame, most: int) -> DataFrame:
    """``a, b``: links between fingerprints of one part, as few as join them; parts with labels join known components."""
    edges = edges_of(most)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            turn, codes = batch[0].to_numpy(), [np.frombuffer(c, np.uint64) for c in batch[1].to_pylist()]
            labels = batch[2].to_pylist()
            sizes = np.array([len(c) for c in codes], np.int64)
            groups = np.cumsum(sizes) // FOREST
            for group in np.unique(groups):
                some = np.flatnonzero(groups == group)
                all_codes = np.concatenate([codes[i] for i in some])
                known = [labels[i] for i in some if labels[i] is not None]
                label = np.concatenate([np.frombuffer(x, np.int64) for x in known]) if known else None
                a, b = linked_within(all_codes, np.concatenate([[0], np.cumsum(sizes[some])]), most, label)
                turns = np.repeat(turn[some], sizes[some])
                yield pa.RecordBatch.from_arrays([unturned(all_codes[x], turns[x], edges) for x in (a, b)], names=["a", "b"])

    return made.select("turn", "codes", "labels").mapInArrow(search, LINKS)


def links_across(made: DataFrame, most: int) -> DataFrame:
    """``a, b``: links between parts of one block's value that are not in one component."""
    edges = edges_of(most)
    facts = ("part", "shared", "pattern", "lo", "hi")
    sides = [made.select("turn", "block", *[F.col(c).alias(f"{c}_{s}") for c in facts]) for s in "xy"]
    met = sides[0].join(sides[1], ["turn", "block"]).where(
        (F.col("part_x") < F.col("part_y"))
        & ~((F.col("lo_x") == F.col("hi_x")) & (F.col("lo_y") == F.col("hi_y")) & (F.col("lo_x") == F.col("lo_y")))
        & (F.expr("bit_count((pattern_x ^ pattern_y) & shared_x & shared_y)") <= most)
    )
    met = materialise(met.select("turn", "part_x", "part_y"), "meetings")
    for s in "xy":
        met = met.join(made.select(F.col("part").alias(f"part_{s}"), F.col("codes").alias(f"codes_{s}"), F.col("labels").alias(f"labels_{s}")), f"part_{s}")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for turn, *binaries in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                x, y = (np.frombuffer(binaries[i], np.uint64) for i in (0, 2))
                of_x, of_y = (np.frombuffer(binaries[i], np.int64) for i in (1, 3))
                a, b = linked_across(x, of_x, y, of_y, most)
                if len(a):
                    turns = np.full(len(a), turn)
                    yield pa.RecordBatch.from_arrays([unturned(c, turns, edges) for c in (x[a], y[b])], names=["a", "b"])

    return met.select("turn", "codes_x", "labels_x", "codes_y", "labels_y").mapInArrow(search, LINKS)


def print_components(prints: DataFrame, most: int = 4) -> DataFrame:
    """``print, component`` for the distinct fingerprints ``prints`` (``print``): a component's name is its least
    fingerprint as a signed number. Fingerprints link if they differ in ``most`` bits at most."""
    in_order = entries(prints.select("print"), most).repartitionByRange("turn", "block", "rank").sortWithinPartitions("turn", "block", "rank")
    first = materialise(parts(in_order, False), "parts")
    links = materialise(links_within(first, most), "links")
    known = components(links)
    cut = materialise(first.groupBy("turn", "block").agg(F.count("*").alias("n")).where("n > 1").select("turn", "block"), "cut")
    named = prints.select("print").join(known.withColumnRenamed("node", "print"), "print", "left").withColumn("component", F.coalesce("component", "print"))
    if not cut.isEmpty():
        # at most as many rows as there are values of a block: 5 x 8192 for 4 bits of 64
        named = materialise(named, "named")
        again = entries(named, most).join(F.broadcast(cut), ["turn", "block"], "left_semi")
        again = again.repartitionByRange("turn", "block", "component", "rank").sortWithinPartitions("turn", "block", "component", "rank")
        second = materialise(parts(again, True), "parts")
        # the new order puts entries of different first parts together
        joined = links_within(second.where("lo < hi"), most).unionByName(links_across(second, most))
        known = components(links.unionByName(materialise(joined, "links")))
        named = prints.select("print").join(known.withColumnRenamed("node", "print"), "print", "left").withColumn("component", F.coalesce("component", "print"))
    return named


def near_groups(docs: DataFrame, most: int = 4) -> DataFrame:
    """``doc_id, print, component_id`` for every row of ``docs`` (``doc_id, text``); other columns are not read.

    Null, empty and blank texts have the fingerprint zero and link like any other. ``component_id`` is the smallest
    ``doc_id`` in reach, null if all there are null. Repeated rows come back as often as they come. An empty table
    gives no rows.
    """
    printed = fingerprints(docs)
    prints = materialise(printed.groupBy("print").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("docs")), "distinct")
    placed = materialise(prints.join(print_components(prints, most), "print"), "placed")
    firsts = placed.groupBy("component").agg(F.min("first_id").alias("component_id"), F.count("*").alias("prints"))
    firsts = materialise(firsts, "firsts")
    placed = salted_left_join(placed.select("print", "component", "docs"), firsts.drop("prints"), "component", "print", hot_from_counts(firsts, "component", "prints"))
    placed = materialise(placed.select("print", "component_id", "docs"), "placed")
    return salted_left_join(printed, placed.drop("docs"), "print", "doc_id", hot_from_counts(placed, "print", "docs"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
