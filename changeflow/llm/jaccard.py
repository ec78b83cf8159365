"""N-gram Jaccard join of whole texts with set-relation skipping.

Two sets link if ``100 * |intersection| >= 75 * |union|``, that is ``7 * |intersection| >= 3 * (|s| + |t|)``.

1. Every document's set of shingles is profiled: size, digests, smallest hashes under three permutations. Equal
   sets are one node from here on. Shingles that many sets hold are counted; the order of shingles puts them last.
2. Nodes that share a smallest hash are compared to the least node among them: a star, not all pairs. A node so
   linked joins its leader's family and keeps what it has more and less than the leader.
3. An inverted index over prefixes: linked sets share a shingle among the first quarter of both. Lists whose sets
   are all in one component already are skipped whole. Each list's components are compared to one of its sets.
4. What is left is indexed by family: of each list a family has a row per size, and within a list blocks are skipped by
   size and position. A pair of families is one candidate, however many members meet.
5. The leaders of two families are compared exactly. That bounds the overlap of all their members, whose sets are the
   leader's but for a few shingles; only members that could still link are compared, their overlaps derived from the leader's.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changeflow.llm.components import components
from changeflow.llm.exact_dedup import one_of_each
from changeflow.llm.shingles import BASE, in_chunks, mixed
from changeflow.operators.skew import hot_from_counts, salted_left_join
from changeflow.session import drop_staged, materialise

#: A shingle that more sets than these hold is frequent; at most so many are, the most frequent ones.
OFTEN = 16
FREQUENT = 1 << 20
#: Shingles that a task counts at once, and counts that it keeps.
COUNTED = 1 << 21
#: Bits of the filter on texts: for each that is wanted, and at most.
BITS_PER_TEXT = 16
FILTER_BITS = 1 << 27
PERMUTATIONS = 3

#: Times that the components of each list are compared to one of its sets before all that is left is.
STAR_TURNS = 1
#: A set is compared to a leader that it shares lists with for one in so many of its shingles.
LIKELY = 64

#: Entries of a list that is paired at once with others like it.
SHORT = 24

#: Entries of a list that are handled together, and of the blocks that are skipped within.
LIST = 2048
BLOCK = 128

#: Pairs that a task holds, that are made at once, and that are sent at once.
PAIRS = 1 << 20
STEP = 1 << 16

#: Sets that meet one set in a task.
MEETINGS = 256

PROFILE = "doc_id long, text_hash long, n long, node long, check long, k0 long, k1 long, k2 long, counts binary"


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def digests(flat: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of each set, the first its node, whatever the order of its members; no set may be empty."""
    with np.errstate(over="ignore"):
        one = np.add.reduceat(mixed(flat * BASE), edges[:-1]) + np.diff(edges).astype(np.uint64)
        two = np.add.reduceat(mixed(flat ^ np.uint64(0xD6E8FEB86659FD93)), edges[:-1])
        return signed(mixed(one)), signed(mixed(two))


def nonempty(edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which sets have members, and the edges of those alone."""
    full = np.flatnonzero(np.diff(edges))
    return full, np.concatenate([edges[full], edges[-1:]])


class Counter:
    """Counts of the shingles that recur among some million of a task, over distinct sets; they only choose an order."""

    def __init__(self) -> None:
        self.keys, self.n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.empty()

    def empty(self) -> None:
        self.held, self.seen, self.size = [], set(), 0

    def add(self, flat: np.ndarray, own: np.ndarray, node: np.ndarray) -> None:
        for i, x in enumerate(node.tolist()):
            if x not in self.seen:
                self.seen.add(x)
                self.held.append(flat[own[i] : own[i + 1]])
                self.size += int(own[i + 1] - own[i])
        if self.size >= COUNTED:
            self.settle()

    def settle(self) -> None:
        if self.held:
            keys, n = np.unique(np.concatenate(self.held), return_counts=True)
            often = n > 1
            keys, n = np.concatenate([self.keys, keys[often]]), np.concatenate([self.n, n[often]])
            order = np.argsort(keys, kind="stable")
            keys, n = keys[order], n[order]
            begins = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
            self.keys, self.n = keys[begins], np.add.reduceat(n, begins) if len(begins) else n
            if len(self.keys) > COUNTED:
                most = np.sort(np.argpartition(-self.n, COUNTED // 2)[: COUNTED // 2])
                self.keys, self.n = self.keys[most], self.n[most]
        self.empty()


def profiles(docs: DataFrame) -> DataFrame:
    """A row per document, and some per task (``n`` = -1) with its counts of shingles."""

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter()
        turns = mixed(np.arange(1, PERMUTATIONS + 1, dtype=np.uint64))
        names = [c.split()[0] for c in PROFILE.split(", ")]

        def made(rows: list[tuple]) -> pa.RecordBatch:
            types = [pa.int64()] * 8 + [pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

        for batch in batches:
            ids, text_hashes, texts = (c.to_pylist() for c in batch.columns)
            for at, flat, edges in in_chunks(texts):
                full, own = nonempty(edges)
                rows = [(d, h, 0, *[None] * 6) for d, h in zip(ids[at : at + len(edges) - 1], text_hashes[at:], strict=False)]
                if len(full):
                    least = [signed(np.minimum.reduceat(mixed(flat ^ t), own[:-1])) for t in turns]
                    columns = (np.diff(own), *digests(flat, own), *least)
                    counter.add(flat, own, columns[1])
                    for i, *values in zip(full.tolist(), *(c.tolist() for c in columns), strict=True):
                        rows[i] = (*rows[i][:2], *values, None)
                yield made(rows)
        counter.settle()
        for at in range(0, len(counter.keys), 1 << 16):
            some = slice(at, at + (1 << 16))
            yield made([(None, None, -1, *[None] * 5, counter.keys[some].tobytes() + counter.n[some].tobytes())])

    read = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text"), "text")
    return materialise(read.mapInArrow(profile, PROFILE), "profiles")


def frequent(profiled: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The frequent shingles, sorted, and the rank of each by how many sets hold it; fewer than :data:`FREQUENT`, since
    each holds more than that part of all counts."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for counts in batch[0].to_pylist():
                both = np.frombuffer(counts, np.int64).reshape(2, -1)
                yield pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], names=["shingle", "n"])

    counted = profiled.where("n = -1").select("counts").mapInArrow(unpack, "shingle long, n long")
    counted = materialise(counted.groupBy("shingle").agg(F.sum("n").alias("n")), "counted")
    total = counted.agg(F.sum("n").alias("n")).first().n or 0
    rows = counted.where(F.col("n") > max(OFTEN, total / FREQUENT)).toArrow()
    shingles, n = rows["shingle"].to_numpy().view(np.uint64), rows["n"].to_numpy()
    rank = np.empty(len(n), np.uint64)
    rank[np.lexsort((shingles, n))] = np.arange(len(n), dtype=np.uint64)
    order = np.argsort(shingles)
    return shingles[order], rank[order]


def in_order(hashes: np.ndarray, often: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Hashes as keys: frequent shingles last, by rank, the others by 63 bits of their hash."""
    known, rank = often
    tokens = hashes >> np.uint64(1)
    if len(known):
        at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        hit = known[at] == hashes
        tokens[hit] = rank[at[hit]] | np.uint64(1 << 63)
    return tokens


def text_filter(wanted: DataFrame) -> np.ndarray:
    """A bit per ``text_hash`` of ``wanted``: it lets through all of them, and few others. Above some
    :data:`FILTER_BITS` / 16 texts more pass, which costs time only."""
    n_bits = 1 << 16
    while n_bits < min(FILTER_BITS, BITS_PER_TEXT * wanted.count()):
        n_bits *= 2
    bit = F.col("text_hash").bitwiseAND(n_bits - 1)
    rows = wanted.groupBy(F.shiftright(bit, 15).alias("part")).agg(F.bitmap_construct_agg(bit.bitwiseAND(32767)).alias("bits")).collect()
    bits = np.zeros(n_bits // 8, np.uint8)
    for r in rows:
        bits[r.part * 4096 : (r.part + 1) * 4096] = np.frombuffer(r.bits, np.uint8)
    return bits


def sets_of(docs: DataFrame, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """``node, members``: the sets of ``wanted`` (``node``) as sorted 64-bit numbers, made anew from their texts, of
    which ``nodes`` (``node, text_hash``) has one each."""
    wanted = materialise(nodes.select("node", "text_hash").join(wanted.select("node").distinct(), "node", "left_semi"), "wanted")
    bits = text_filter(wanted)

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {}
            text_hash = batch[0].to_numpy()
            at = text_hash & (8 * len(bits) - 1)
            hit = np.flatnonzero(bits[at >> 3] >> (at & 7) & 1)
            hit = hit[np.sort(np.unique(text_hash[hit], return_index=True)[1])]
            for _, flat, edges in in_chunks(batch[1].take(pa.array(hit)).to_pylist()):
                _, own = nonempty(edges)
                if len(own) >= 2:
                    for i, node in enumerate(digests(flat, own)[0].tolist()):
                        found[node] = flat[own[i] : own[i + 1]].tobytes()
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.binary())], names=["node", "members"])

    made = docs.select(F.xxhash64("text"), "text").mapInArrow(fetch, "node long, members binary")
    made = made.join(wanted.select("node"), "node", "left_semi")
    return materialise(made.groupBy("node").agg(F.first("members").alias("members")), "sets")


MET = "s long, t long, linked boolean, shared long, more binary, less binary"


def meet(pairs: DataFrame, sets: DataFrame, families: DataFrame | None) -> DataFrame:
    """Check ``pairs`` (``s, t, lead``): whether ``s`` links with ``t``, as ``s, t, linked, shared, more, less``.

    ``s`` is ``lead`` itself, or the set of ``lead`` without ``less`` and with ``more`` of ``families`` (``s, lead, more, less``),
    binaries as in :func:`sets_of`; they join the pairs last, so that they are dealt out once. The overlap of ``lead``
    with ``t`` is computed once, those of its family are derived. Where ``s`` is ``lead`` itself, what ``s`` has
    more and less than ``t`` comes back too. A task holds the sets of one ``t`` and one ``lead``; a ``t`` that
    meets many sets is repeated over as many salts as they need.
    """
    load = pairs.groupBy("t").agg(F.ceil(F.count("*") / MEETINGS).cast("int").alias("salts"))
    salted = pairs.join(load, "t").withColumn("salt", F.pmod(F.xxhash64("lead"), F.col("salts")).cast("int"))
    empty = F.lit(None).cast("binary")
    first, last = F.lit(None).cast("long"), ("t", "salt", "lead", "kind", "s", "members", "more", "less")
    of_t = load.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).join(sets.withColumnRenamed("node", "t"), "t")
    of_t = of_t.select("t", "salt", first.alias("lead"), F.lit(0).alias("kind"), first.alias("s"), "members", empty.alias("more"), empty.alias("less"))
    leads = salted.select("t", "salt", "lead").distinct().join(sets.withColumnRenamed("node", "lead"), "lead")
    leads = leads.select("t", "salt", "lead", F.lit(1).alias("kind"), first.alias("s"), "members", empty.alias("more"), empty.alias("less"))
    differ = salted.withColumns({"more": empty, "less": empty}) if families is None else salted.join(families, ["s", "lead"], "left")
    family = differ.select("t", "salt", "lead", F.lit(2).alias("kind"), "s", empty.alias("members"), "more", "less")
    rows = of_t.unionByName(leads).unionByName(family)
    rows = rows.repartition("t", "salt").sortWithinPartitions("t", "salt", F.col("lead").asc_nulls_first(), "kind", "s")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, lead = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        shared = 0
        names = [c.split()[0] for c in MET.split(", ")]
        types = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.binary(), pa.binary()]
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [], [])
            for t, lead_id, kind, s, members, more, less in zip(*(batch[c].to_pylist() for c in last if c != "salt"), strict=True):
                if kind == 0:
                    of = np.frombuffer(members, np.uint64)
                elif kind == 1:
                    lead = np.frombuffer(members, np.uint64)
                    shared = len(np.intersect1d(of, lead, True))
                else:
                    plus, minus = (np.frombuffer(x or b"", np.uint64) for x in (more, less))
                    common = shared + len(np.intersect1d(of, plus, True)) - len(np.intersect1d(of, minus, True))
                    size = len(lead) + len(plus) - len(minus)
                    linked = 7 * common >= 3 * (size + len(of))
                    own = linked and s == lead_id
                    values = (
                        s, t, linked, common,
                        np.setdiff1d(lead, of, True).tobytes() if own else None,
                        np.setdiff1d(of, lead, True).tobytes() if own else None,
                    )
                    for column, value in zip(out, values, strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=names)

    return materialise(rows.select(*[c for c in last if c != "salt"]).mapInArrow(check, MET), "met")


ENTRY = "token long, node long, n int, place int"


def beyond_prefix(n):
    """Members of a set of ``n`` outside its prefix: any set that it links with shares more than these."""
    return (3 * n + 3) // 4 - 1


def entries(docs: DataFrame, often: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """The prefixes of all sets: with ``n`` shingles, the first ``n - ceil(3n/4) + 1`` in order. Equal sets of a batch count once."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = set()
            for _, flat, edges in in_chunks(batch[0].to_pylist()):
                _, own = nonempty(edges)
                if len(own) < 2:
                    continue
                node, n = digests(flat, own)[0], np.diff(own)
                tokens = in_order(flat, often)
                fresh = np.array([x not in seen and not seen.add(x) for x in node.tolist()])
                for a, b in zip(own[:-1][fresh].tolist(), own[1:][fresh].tolist(), strict=True):
                    tokens[a:b].sort()
                at = np.arange(len(tokens)) - np.repeat(own[:-1], n)
                on = np.flatnonzero(at < np.repeat(np.where(fresh, n - beyond_prefix(n), 0), n))
                columns = (signed(tokens[on]), np.repeat(node, n)[on], np.repeat(n, n)[on].astype(np.int32), at[on].astype(np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["token", "node", "n", "place"])

    return docs.select("text").mapInArrow(index, ENTRY)


def shared_entries(index: DataFrame) -> DataFrame:
    """The entries whose token occurs in several sets; a row looks only at its neighbours, so a list is never held."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            batch = pa.RecordBatch.from_arrays(batch.columns, names=batch.schema.names)
            if held is not None:
                batch = pa.Table.from_batches([held[0], batch]).combine_chunks().to_batches()[0]
            if not batch.num_rows:
                continue
            token, node = batch["token"].to_numpy(), batch["node"].to_numpy()
            same = token[1:] == token[:-1]
            twin = np.concatenate([[False], same & (node[1:] == node[:-1])])
            # a set that comes again is no neighbour: look for a change of node within the token
            other = same & ~twin[1:]
            alone = np.ones(len(token), bool)
            alone[1:][other] = False
            alone[:-1][other] = False
            if held is not None and held[1]:
                alone[0] = False
            # the node of a run of twins is shared if any of the run is
            runs = np.cumsum(~twin) - 1
            shared = np.zeros(runs[-1] + 1, bool)
            np.logical_or.at(shared, runs, ~alone)
            start = np.flatnonzero(~twin)
            out = start[:-1][shared[:-1]]
            yield batch.take(pa.array(out))
            held = (batch.slice(int(start[-1]), 1), bool(shared[-1]))
        if held is not None and held[1]:
            yield held[0]

    ordered = index.repartition("token").sortWithinPartitions("token", "n", "node")
    return materialise(ordered.mapInArrow(keep, ENTRY), "lists")


def enough_open(n: np.ndarray, before: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of pairs of sets that share a shingle, one to a row: whether it may be the first that they share, and whether they
    may link at all, by the lists that each shares with anyone ``before`` it and from it on (``after``).

    What both prefixes hold is in such lists; the set whose prefix ends first has no more left than is beyond the larger's.
    """
    need, after = 3 * n.sum(axis=1), 7 * (after.min(axis=1) + beyond_prefix(n.max(axis=1)))
    return after >= need, after + 7 * before.min(axis=1) >= need


def only_open(pairs: np.ndarray, firsts: np.ndarray, n: np.ndarray, *open_lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of index pairs those that :func:`enough_open` leaves."""
    if not open_lists:
        return pairs, firsts
    begins, could = enough_open(n[pairs], *(v[pairs] for v in open_lists))
    return pairs[could], (firsts & begins)[could]


def pair_steps(
    n: np.ndarray, first: np.ndarray, last: np.ndarray, component: np.ndarray, begins: np.ndarray, *open_lists: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """:func:`pairs_in` of lists that follow one another, and the number of the list of each pair; short lists all at once, then of
    the others, one after the other, some :data:`STEP` pairs at a time."""
    ends = np.append(begins[1:], len(n))
    sizes = ends - begins
    short = sizes <= SHORT
    x = np.flatnonzero(np.repeat(short, sizes))
    of = np.repeat(np.arange(len(sizes)), sizes)
    times = ends[of[x]] - x - 1
    i = np.repeat(x, times)
    j = np.arange(len(i)) - np.repeat(np.cumsum(times) - times, times) + i + 1
    need, after = 3 * (n[i] + n[j]), 7 * np.minimum(n[i] - first[i], n[j] - first[j])
    on = (component[i] != component[j]) & (4 * n[i] >= 3 * n[j]) & (after + 7 * np.minimum(last[i], last[j]) >= need)
    found, begin = only_open(np.stack([i[on], j[on]], 1), (after >= need)[on], n, *open_lists)
    held, size = [(found, begin, of[found[:, 0]])], len(found)
    for k in np.flatnonzero(~short).tolist():
        some = slice(begins[k], ends[k])
        for found, begin in pairs_in(n[some], first[some], last[some], component[some], *[v[some] for v in open_lists]):
            held.append((found + begins[k], begin, np.full(len(found), k)))
            size += len(found)
            if size >= STEP:
                yield tuple(np.concatenate(v) for v in zip(*held, strict=True))
                held, size = [], 0
    if held:
        yield tuple(np.concatenate(v) for v in zip(*held, strict=True))


def pairs_of_lists(*lists: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All :func:`pair_steps` at once."""
    return tuple(np.concatenate(v) for v in zip(*pair_steps(*lists), strict=True))


def pairs_in(
    n: np.ndarray, first: np.ndarray, last: np.ndarray, component: np.ndarray, *open_lists: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of one list, sorted by size, that may link by size and position and lie in different components;
    and for each whether the shared shingle may be the first that they share. Two blocks at a time.

    From ``first`` to ``last`` shingles of a set stand before the shared one. At most the smaller ``n - first`` are shared
    from here on and the smaller ``last`` before. Blocks that lie in one component or whose sizes or sums cannot suffice
    are passed over. ``open_lists``, if given, are those before and after for :func:`enough_open`.
    """
    rest = n - first
    edges = list(range(0, len(n), BLOCK)) + [len(n)]
    spans = [slice(a, b) for a, b in zip(edges, edges[1:], strict=False)]
    most = [(int(rest[s].max()), int(last[s].max())) for s in spans]
    within = [(int(component[s].min()), int(component[s].max())) for s in spans]
    for i, a in enumerate(spans):
        for j in range(i, len(spans)):
            b = spans[j]
            if 3 * int(n[b.start]) > 4 * int(n[a.stop - 1]):
                break
            if within[i][0] == within[i][1] == within[j][0] == within[j][1]:
                continue
            if 7 * (min(most[i][0], most[j][0]) + min(most[i][1], most[j][1])) < 3 * (int(n[a.start]) + int(n[b.start])):
                continue
            need = 3 * (n[a][:, None] + n[b][None])
            after = 7 * np.minimum(rest[a][:, None], rest[b][None])
            bound = after + 7 * np.minimum(last[a][:, None], last[b][None]) >= need
            bound &= (component[a][:, None] != component[b][None]) & (4 * n[a][:, None] >= 3 * n[b][None])
            x, y = np.nonzero(np.triu(bound, 1) if i == j else bound)
            pairs, begin = only_open(np.stack([x + a.start, y + b.start], 1), (after >= need)[x, y], n, *open_lists)
            if len(pairs):
                yield pairs, begin


def list_stars(lists: DataFrame, tags: DataFrame, turn: int) -> DataFrame:
    """``s, t``: of the sets that share a list with another component's, each component's likeliest pair with a list's
    leader. Every ``turn`` has other leaders; a row per entry, so linear in the lists.

    What is edited in a copy gives shingles of its own, which come before the frequent ones: at first the leader of a
    frequent shingle is the set that has least before it, the least edited one, with which most copies link.
    """
    lists = tagged(lists, tags)
    edited = F.when(F.col("token") < 0, F.col("place") / F.col("n")).otherwise(0.0) if turn == 0 else F.lit(0.0)
    by = F.struct(edited.alias("edited"), F.xxhash64("node", F.lit(turn)).alias("hash"))
    lead = F.min(F.struct(by.alias("by"), F.col("node").alias("t"), F.col("n").alias("n_t"), F.col("component").alias("of_t")))
    open_lists = lists.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), lead.alias("lead"))
    open_lists = open_lists.where("lo < hi").select("token", "lead.t", "lead.n_t", "lead.of_t")
    close = (3 * F.col("n") <= 4 * F.col("n_t")) & (3 * F.col("n_t") <= 4 * F.col("n"))
    met = lists.join(open_lists, "token").where((F.col("component") != F.col("of_t")) & close)
    counted = met.groupBy(F.col("node").alias("s"), "t", F.col("component").alias("of_s"), "of_t", "n", "n_t").agg(F.count("*").alias("shared"))
    # near copies have most lists in common, and with them the leaders; what is passed over here is a candidate later
    counted = counted.where(LIKELY * F.col("shared") >= F.least("n", "n_t"))
    likely = (F.col("shared") / (F.col("n") + F.col("n_t"))).alias("likely")
    return likeliest(materialise(counted.select("s", "t", "of_s", "of_t", likely), "starred"))


def tagged(lists: DataFrame, tags: DataFrame) -> DataFrame:
    """Entries with the ``component`` and the ``family`` of their node; a node without either is its own."""
    own = lambda c: F.coalesce(c, "node").alias(c)
    return lists.join(tags, "node", "left").select(*lists.columns, own("component"), own("family"))


SHARED = "f long, g long, shared int, f_lo int, f_hi int, g_lo int, g_hi int, of_f long, of_g long, begins boolean"


def candidates(lists: DataFrame, tags: DataFrame) -> DataFrame:
    """Pairs ``f, g`` of families in different components (``tags``: ``node, component, family``), each once.

    Lists within one component are dropped before they meet. Of each list a family has one row per size. A list longer than
    :data:`LIST` is dealt into parts by hash, and every two parts meet in a task of their own. The shingles that prefixes
    of the two families share are counted: let the prefix of ``x`` end first in order, then what two sets share beyond it is at
    most the rest of ``x``. So a pair whose count and larger rest together are too few cannot link. Nor can one whose open
    lists, which bound that count on either side of a shared shingle, are too few: it is not made at all.
    """
    lists = tagged(lists, tags).groupBy("token", "family", "component", "n").agg(F.min("place").alias("first"), F.max("place").alias("last"))
    lists = materialise(lists, "family_lists")
    open_lists = (
        lists.groupBy("token")
        .agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("length"))
        .where("lo < hi")
        .select("token", F.ceil(F.col("length") / LIST).cast("int").alias("parts"))
    )
    met = lists.join(open_lists, "token").withColumn("part", F.pmod(F.xxhash64("family", "n"), F.col("parts")).cast("int"))
    own = Window.partitionBy("family", "n")
    # the open lists of sets of one size of a family before a list, and from it on
    met = met.withColumn("before", F.row_number().over(own.orderBy(F.col("token") < 0, "token")) - 1)
    met = met.withColumn("after", (F.count("*").over(own) - F.col("before")).cast("int"))
    others = F.sequence(F.lit(0), F.col("parts") - 1)
    columns = ("token", "one", "two", "part", "family", "n", "first", "last", "component", "before", "after")
    met = met.withColumn("other", F.explode(others)).withColumns({"one": F.least("part", "other"), "two": F.greatest("part", "other")}).select(*columns)

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists_seen = 0

        def found(table: pa.Table) -> Iterator[list[np.ndarray]]:
            nonlocal lists_seen
            c = {name: table[name].to_numpy() for name in table.column_names}
            key = np.flatnonzero(
                np.concatenate([[True], (c["token"][1:] != c["token"][:-1]) | (c["one"][1:] != c["one"][:-1]) | (c["two"][1:] != c["two"][:-1])])
            )
            sizes, first, last, before, after = (c[k].astype(np.int64) for k in ("n", "first", "last", "before", "after"))
            for x, begins, of_list in pair_steps(sizes, first, last, c["component"], key, before, after):
                met_here = (c["one"][x[:, 0]] == c["two"][x[:, 0]]) | (c["part"][x[:, 0]] != c["part"][x[:, 1]])
                x, begins, of_list = x[met_here], begins[met_here], of_list[met_here] + lists_seen
                flip = c["family"][x[:, 0]] > c["family"][x[:, 1]]
                x[flip] = x[flip][:, ::-1]
                (f, g), (n_f, n_g), of = ([c[name][x[:, i]] for i in (0, 1)] for name in ("family", "n", "component"))
                yield [f, g, of_list, np.ones(len(f), np.int32), n_f, n_f, n_g, n_g, *of, begins]
            lists_seen += len(key)

        def combined(parts: list[list[np.ndarray]]) -> list[np.ndarray]:
            """One row for each pair, which counts once for each list: of pairs in the order in which they were made, those of a
            list follow one another. A column at a time, which is taken from the parts."""
            column = lambda: np.concatenate([p.pop(0) for p in parts])
            if not any(len(p[0]) for p in parts):
                return parts[0]
            f, g = column(), column()
            order = np.lexsort((g, f))
            f, g, of_list, shared = f[order], g[order], column()[order], column()[order]
            same = (f[1:] == f[:-1]) & (g[1:] == g[:-1])
            shared[1:][same & (of_list[1:] == of_list[:-1])] = 0
            at = np.flatnonzero(np.concatenate([[True], ~same]))
            ends = np.append(at[1:], len(f)) - 1
            columns = [f[at], g[at], of_list[ends], np.add.reduceat(shared, at, dtype=np.int32)]
            del f, g, of_list, shared, same
            columns += [how.reduceat(column()[order], at) for how in (np.minimum, np.maximum, np.minimum, np.maximum)]
            return columns + [column()[order[at]], column()[order[at]], np.logical_or.reduceat(column()[order], at)]

        def sent(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            names = [v.split()[0] for v in SHARED.split(", ")]
            f, g, _, *others = columns
            for at in range(0, len(f), STEP):
                yield pa.RecordBatch.from_arrays([pa.array(v[at : at + STEP]) for v in (f, g, *others)], names=names)

        made: list[list[np.ndarray]] = []

        def gathered(table: pa.Table) -> Iterator[pa.RecordBatch]:
            """Pairs of a task are held together as long as they are not too many."""
            nonlocal made
            for some in found(table):
                made.append(some)
                if sum(len(m[0]) for m in made[1:]) > max(PAIRS // 8, len(made[0][0])):
                    made = [combined(made)]
                    if len(made[0][0]) > PAIRS // 2:
                        yield from sent(made[0])
                        made = []

        held = None
        for batch in batches:
            batch = pa.RecordBatch.from_arrays(batch.columns, names=batch.schema.names)
            table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            if not table.num_rows:
                continue
            token, one, two = (table[c].to_numpy() for c in ("token", "one", "two"))
            open_at = int(np.flatnonzero((token != token[-1]) | (one != one[-1]) | (two != two[-1]))[-1:].sum() + 1)
            if (token[0], one[0], two[0]) == (token[-1], one[-1], two[-1]):
                open_at = 0
            if open_at:
                yield from gathered(table.slice(0, open_at))
            held = table.slice(open_at)
        if held is not None and held.num_rows:
            yield from gathered(held)
        if made:
            yield from sent(combined(made))

    # frequent shingles of neighbouring ranks mostly stem from one passage: their lists hold the same pairs
    near = F.when(F.col("token") < 0, F.shiftright("token", 8)).otherwise(F.col("token"))
    sorted_lists = met.repartition(near, "one", "two").sortWithinPartitions("token", "one", "two", "n", "family")
    shared = sorted_lists.select(*columns).mapInArrow(pair, SHARED)
    ends = [how(c).cast("long").alias(c) for how, c in ((F.min, "f_lo"), (F.max, "f_hi"), (F.min, "g_lo"), (F.max, "g_hi"))]
    counted = shared.groupBy("f", "g", "of_f", "of_g").agg(*ends, F.sum("shared").alias("shared"), F.max("begins").alias("begins"))
    small, large = F.least("f_lo", "g_lo"), F.greatest("f_hi", "g_hi")
    enough = 7 * (F.col("shared") + F.ceil(3 * large / 4) - 1) >= 3 * (small + large)
    kept = counted.where(F.col("begins") & enough)
    return materialise(kept.select(F.col("f").alias("s"), F.col("g").alias("t"), F.col("of_f").alias("of_s"), F.col("of_g").alias("of_t")), "candidates")


def likeliest(pairs: DataFrame) -> DataFrame:
    """The pair of each component that shares most, as ``s, t``."""
    best = F.struct((-F.col("likely")).alias("by"), "s", "t")
    sides = [pairs.select(F.col(c).alias("component"), best.alias("best")) for c in ("of_s", "of_t")]
    chosen = sides[0].unionByName(sides[1]).groupBy("component").agg(F.min("best").alias("best"))
    return materialise(chosen.select("best.s", "best.t").distinct(), "likeliest")


def still_open(pairs: DataFrame, links: DataFrame) -> DataFrame:
    """The pairs whose components ``links`` (``a, b``, components) do not join; first decided for pairs of components."""
    roots = materialise(components(links), "roots")
    between = pairs.select("of_s", "of_t").distinct()
    for side in ("of_s", "of_t"):
        root = roots.select(F.col("node").alias(side), F.col("component").alias(f"root_{side}"))
        between = between.join(root, side, "left").withColumn(f"root_{side}", F.coalesce(f"root_{side}", side))
    between = between.where("root_of_s <> root_of_t").select("of_s", "of_t")
    return materialise(pairs.join(between, ["of_s", "of_t"], "left_semi"), "open")


def stars(nodes: DataFrame) -> DataFrame:
    """``s, t``: every node with the least node among those that share one of its smallest hashes, sizes permitting."""
    keys = nodes.select("node", "n", F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"k{i}").alias("k")) for i in range(PERMUTATIONS)])).alias("key"))
    keys = keys.select("node", "n", F.xxhash64("key").alias("key"))
    leaders = keys.groupBy("key").agg(F.min(F.struct("node", "n")).alias("lead"), F.count("*").alias("members")).where("members > 1")
    leaders = materialise(leaders, "leaders")
    joined = salted_left_join(keys, leaders.select("key", "lead"), "key", "node", hot_from_counts(leaders, "key", "members"))
    close = (3 * F.col("n") <= 4 * F.col("lead.n")) & (3 * F.col("lead.n") <= 4 * F.col("n"))
    pairs = joined.where((F.col("node") != F.col("lead.node")) & close).select(F.col("node").alias("s"), F.col("lead.node").alias("t")).distinct()
    return materialise(pairs, "stars")


def members_to_try(pairs: DataFrame, families: DataFrame, nodes: DataFrame) -> DataFrame:
    """``s, t``: members of two families whose leaders share ``shared`` shingles, but do not link, that could link themselves.

    Two members share at most what the leaders share and what each has more than its leader. Families that cannot reach
    the threshold with their smallest set and their largest addition are dropped before any member is listed.
    """
    has = lambda c: (F.octet_length(c) / 8).cast("long")
    sizes = nodes.select(F.col("node").alias("member"), "n")
    members = families.select(F.col("s").alias("member"), "lead", has("more").alias("more")).join(sizes, "member")
    asked = pairs.select(F.col("s").alias("lead")).union(pairs.select(F.col("t").alias("lead"))).distinct()
    # a leader is a member too, and often the only one
    leads = asked.select(F.col("lead").alias("member"), "lead", F.lit(0).cast("long").alias("more")).join(sizes, "member")
    every = members.join(asked, "lead", "left_semi").unionByName(leads)
    every = materialise(every, "members")
    spans = every.groupBy("lead").agg(F.min("n").alias("n"), F.max("more").alias("more"))

    def joined(pairs: DataFrame, rows: DataFrame, side: str) -> DataFrame:
        named = rows.select(F.col("lead").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in rows.columns if c != "lead"])
        return pairs.join(named, side)

    could = 7 * (F.col("shared") + F.col("more_s") + F.col("more_t")) >= 3 * (F.col("n_s") + F.col("n_t"))
    reach = joined(joined(pairs, spans, "s"), spans, "t").where(could).select("s", "t", "shared")
    found = joined(joined(reach, every, "s"), every, "t").where(could & ~((F.col("member_s") == F.col("s")) & (F.col("member_t") == F.col("t"))))
    close = (3 * F.col("n_s") <= 4 * F.col("n_t")) & (3 * F.col("n_t") <= 4 * F.col("n_s"))
    return materialise(found.where(close).select(F.col("member_s").alias("s"), F.col("member_t").alias("t")).distinct(), "tried")


def near_groups(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, n_shingles, node, component, component_id`` for every row of ``docs`` (``doc_id, text``).

    Documents with equal sets share a ``node`` (null for an empty set), linked nodes a ``component``; ``component_id`` is the smallest ``doc_id`` in
    reach. Null, empty and blank texts have no shingles and link with nothing: they are their own component, as
    is the null ``doc_id`` among them. Repeated rows are linked like any equal texts. Sets and shingles are told
    apart by 64-bit hashes. An empty table gives no rows.
    """
    profiled = profiles(docs)
    nodes = profiled.where("node IS NOT NULL").groupBy("node").agg(
        F.min("n").alias("n"),
        F.min("doc_id").alias("first_id"),
        F.min("text_hash").alias("text_hash"),
        F.count("*").alias("docs"),
        *[F.min(f"k{i}").alias(f"k{i}") for i in range(PERMUTATIONS)],
    )
    nodes = materialise(nodes, "nodes")
    often = frequent(profiled)

    def compared(asked: DataFrame, families: DataFrame | None = None) -> DataFrame:
        involved = asked.select(F.col("lead").alias("node")).union(asked.select(F.col("t").alias("node")))
        sets = sets_of(docs, nodes, involved)
        found = meet(asked, sets, families)
        drop_staged(sets)  # the largest of what is staged, and read to its end
        return found

    tried = stars(nodes)
    star = compared(tried.select("s", "t", F.col("s").alias("lead"))).where("linked")
    links = materialise(star.select("s", "t"), "links")
    # a set's family is that of the leader it differs from least
    small = F.struct((F.octet_length("more") + F.octet_length("less")).alias("by"), "t", "more", "less")
    families = star.groupBy("s").agg(F.min(small).alias("of")).select("s", F.col("of.t").alias("lead"), "of.more", "of.less")
    families = materialise(families, "families")
    drop_staged(star)

    def of_family(pairs: DataFrame) -> DataFrame:
        asked = pairs.select("s", "t").join(families.select("s", "lead"), "s", "left").select("s", "t", F.coalesce("lead", "s").alias("lead"))
        return materialise(asked, "asked")

    def tags() -> DataFrame:
        known = components(links.select(F.col("s").alias("a"), F.col("t").alias("b")))
        tagged_nodes = known.join(families.select(F.col("s").alias("node"), F.col("lead").alias("family")), "node", "left")
        return materialise(tagged_nodes, "tags")

    lists = shared_entries(entries(docs, often))
    for turn in range(STAR_TURNS):
        found = compared(of_family(list_stars(lists, tags(), turn)), families).where("linked")
        links = links.union(found.select("s", "t"))
    pairs = candidates(lists, tags())
    # leaders first: they bound what their members can share
    led = compared(pairs.select("s", "t", F.col("s").alias("lead")))
    links = links.union(led.where("linked").select("s", "t"))
    left = pairs.join(led.where("NOT linked").select("s", "t", "shared"), ["s", "t"])
    joined = pairs.join(led.where("linked").select("s", "t"), ["s", "t"], "left_semi").select(F.col("of_s").alias("a"), F.col("of_t").alias("b"))
    links = links.union(compared(of_family(members_to_try(still_open(left, joined), families, nodes)), families).where("linked").select("s", "t"))
    whole = components(links.select(F.col("s").alias("a"), F.col("t").alias("b")))

    placed = nodes.join(whole, "node", "left").withColumn("component", F.coalesce("component", "node"))
    firsts = placed.groupBy("component").agg(F.min("first_id").alias("component_id"))
    # nodes of a large component are spread: only the few first identifiers are looked up by component
    hot = hot_from_counts(placed.groupBy("component").agg(F.count("*").alias("n_nodes")), "component", "n_nodes")
    placed = salted_left_join(placed.select("node", "component", "docs"), firsts, "component", "node", hot).select("node", "component", "component_id", "docs")
    placed = materialise(placed, "placed")
    docs_of = profiled.where("n >= 0").select("doc_id", "text_hash", F.col("n").alias("n_shingles"), "node")
    joined = salted_left_join(docs_of, placed.drop("docs"), "node", "doc_id", hot_from_counts(placed, "node", "docs"))
    return joined.select("doc_id", "text_hash", "n_shingles", "node", "component", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def without_near_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are the first of their component: one of each, and all without shingles.

    Of rows alike in ``doc_id`` and text one stays. Where the smallest ``doc_id`` of a component is repeated, or all
    are null, the row with the smallest text hash stays.
    """
    groups = near_groups(docs)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("first")
    kept = groups.where("node IS NOT NULL").groupBy("component").agg(first).select("first.doc_id", "first.text_hash")
    empty = groups.where("node IS NULL").select("doc_id", "text_hash")
    return one_of_each(docs, kept.unionByName(empty))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "n_shingles", "component_id")
