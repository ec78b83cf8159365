"""Alignment of two tokenizers over whole texts, and how often their ids go together, by interval coalescing.

1. Tokens are byte ranges. The ranges of both tokenizers are sorted by start; the running maximum of their ends says
   where a start reaches all that came before: there a group begins. Many texts are sorted at once, end to end.
2. Within a group every token of one side is linked with every token of the other. A document's distinct id pairs and
   their number are kept as packed binaries; a group that repeats its ids is expanded over distinct ids only.
3. An id pair's count is the number of documents that link it. Pairs with more than a fixed share of all counts, so a
   bounded number of them, are looked up in the tasks; the others are joined by pair.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from changeflow.llm.packing import SETTLED, byte_of_char, merging
from changeflow.session import materialise

#: Bytes of text that are aligned at once, and links expanded at once.
BYTES = 1 << 19
LINKS = 1 << 21

#: A group with more links is expanded over its distinct ids.
PLAIN = 16

#: Pairs are looked up in the tasks if they hold more than this part of all counts, so there are fewer of them.
FREQUENT = 1 << 18

#: Distinct pairs that a task counts before it passes them on.
COUNTED = 1 << 22


class Tokenizers:
    """Both tokenizers, the bytes of their entries, and the ids of a text in which special tokens are plain text."""

    def __init__(self, byte_level: str, pieces: str) -> None:
        self.slow = Tokenizer.from_file(byte_level)
        self.slow.encode_special_tokens = True
        self.fast = merging(byte_level)
        byte, vocab = byte_of_char(), self.slow.get_vocab()
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            if all(c in byte for c in token):
                self.a_bytes[i] = bytes(map(byte.__getitem__, token))
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.b_bytes = [self.piece_bytes(i) for i in range(self.pieces.vocab_size())]
        self.a_length, self.b_length = (np.array([len(x) for x in xs], np.int64) for xs in (self.a_bytes, self.b_bytes))
        self.key = np.dtype("<u4" if len(self.a_bytes) * len(self.b_bytes) <= 2**32 else "<u8")
        self.first_a, self.next_a, self.new_a = ([f"{sign}{i}" for i in range(len(self.a_bytes))] for sign in ("", ",", ";"))
        self.first_b, self.next_b = ([f"{sign}{i}" for i in range(len(self.b_bytes))] for sign in ("|", ","))
        self.written = [*self.first_a, *self.next_a, *self.new_a, *self.first_b, *self.next_b]

    def piece_bytes(self, i: int) -> bytes:
        piece = self.pieces.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.pieces.is_byte(i) else piece.replace("▁", " ").encode()

    def of(self, text: str | None) -> tuple[list[int], list[int]]:
        """The ids of both sides, none where one of them does not spell out a space and the text."""
        if not text:
            return [], []
        spaced = " " + text
        a = self.fast.encode_ordinary(spaced) if self.fast and SETTLED.fullmatch(text) else self.slow.encode(spaced, add_special_tokens=False).ids
        b = self.pieces.encode(text, num_threads=1)
        whole = spaced.encode()
        same = all(b"".join(map(table.__getitem__, ids)) == whole for ids, table in ((a, self.a_bytes), (b, self.b_bytes)))
        return (a, b) if same else ([], [])


@cache
def tokenizers_of(files: tuple[str, str]) -> Tokenizers:
    """Loaded once in each worker process."""
    return Tokenizers(*files)


class Aligned:
    """The groups of some texts, end to end: ids and group of every token, and the texts that the groups lie in."""

    def __init__(self, tokenizers: Tokenizers, texts: list[str | None]) -> None:
        ids = [tokenizers.of(t) for t in texts]
        self.n_texts = len(texts)
        self.n_a, self.n_b = (np.array([len(x[i]) for x in ids], np.int64) for i in (0, 1))
        self.a, self.b = (np.array([i for x in ids for i in x[side]], np.int64) for side in (0, 1))
        lengths = np.concatenate([tokenizers.a_length[self.a], tokenizers.b_length[self.b]])
        edge = len(self.a)
        ends = np.concatenate([np.cumsum(lengths[:edge]), np.cumsum(lengths[edge:])])
        starts = ends - lengths
        order = np.lexsort((ends, starts))
        reached = np.maximum.accumulate(ends[order])
        begins = np.ones(len(order), bool)
        begins[1:] = starts[order][1:] >= reached[:-1]
        group = np.empty(len(order), np.int64)
        group[order] = np.cumsum(begins) - 1
        self.a_group, self.b_group = group[:edge], group[edge:]
        self.starts, self.ends = starts[order][begins], reached[np.append(begins[1:], True)] if len(order) else reached
        self.n_groups = int(begins.sum()) if len(order) else 0
        self.a_first, self.b_first = (np.searchsorted(g, np.arange(self.n_groups)) for g in (self.a_group, self.b_group))
        self.a_in, self.b_in = (np.bincount(g, minlength=self.n_groups) for g in (self.a_group, self.b_group))
        self.text_of = np.repeat(np.arange(self.n_texts), self.n_a)[self.a_first] if self.n_groups else np.zeros(0, np.int64)
        self.key, self.width = tokenizers.key, len(tokenizers.b_bytes)
        self.space = len(tokenizers.a_bytes) * self.width
        self.written, self.sizes = tokenizers.written, (len(tokenizers.a_bytes), len(tokenizers.b_bytes))

    def groups_per_text(self) -> np.ndarray:
        return np.bincount(self.text_of, minlength=self.n_texts)

    def links_per_text(self) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(self.a_in * self.b_in)])
        edges = np.searchsorted(self.text_of, np.arange(self.n_texts + 1))
        return sums[edges[1:]] - sums[edges[:-1]]

    def spelled(self) -> list[str]:
        """Per text its groups as ``a1,a2|b1;a3|b2``, the empty string without tokens."""
        n_a, n_b = self.sizes
        edge = len(self.a)
        place = np.argsort(np.concatenate([2 * self.a_group, 2 * self.b_group + 1]), kind="stable")
        sign = np.concatenate([np.full(edge, n_a), np.full(len(self.b), 3 * n_a + n_b)])
        sign[self.a_first] = 2 * n_a
        sign[edge + self.b_first] = 3 * n_a
        begins = np.searchsorted(self.text_of, np.arange(self.n_texts))
        begins = begins[(self.n_a > 0)]
        sign[self.a_first[begins]] = 0
        codes = (np.concatenate([self.a, self.b]) + sign)[place].tolist()
        out, at = [], 0
        for n in (self.n_a + self.n_b).tolist():
            out.append("".join(map(self.written.__getitem__, codes[at : at + n])))
            at += n
        return out

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The distinct id pairs of every text: text, pair ``a * width + b``, and how many links have it; sorted."""
        wide = self.a_in * self.b_in > PLAIN
        found = []
        plain = [(g[~wide[g]], x[~wide[g]], None) for g, x in ((self.a_group, self.a), (self.b_group, self.b))]
        for block in crossed(*plain, self.n_groups):
            found.append(self.distinct(*block))
        if wide.any():
            sides = []
            for g, x in ((self.a_group, self.a), (self.b_group, self.b)):
                both, n = np.unique(g[wide[g]] * self.space + x[wide[g]], return_counts=True)
                sides.append((both // self.space, both % self.space, n))
            for block in crossed(*sides, self.n_groups):
                found.append(self.distinct(*block))
        if not found:
            return (np.zeros(0, np.int64),) * 3
        keys, n = found[0]
        if len(found) > 1:
            keys, n = summed(*(np.concatenate(c) for c in zip(*found, strict=True)))
        return keys // self.space, keys % self.space, n

    def distinct(self, group: np.ndarray, a: np.ndarray, b: np.ndarray, n: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        keys = self.text_of[group] * self.space + a * self.width + b
        return np.unique(keys, return_counts=True) if n is None else summed(keys, n)


def summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the sums of their numbers."""
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    begins = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[begins], np.add.reduceat(n, begins) if len(begins) else n


def crossed(left: tuple, right: tuple, n_groups: int) -> Iterator[tuple]:
    """Each element ``(group, id, number)`` of the left with each of the right in its group, some :data:`LINKS` at a time."""
    group, a, n_a = left
    other, b, n_b = right
    first = np.searchsorted(other, np.arange(n_groups))
    repeats = np.bincount(other, minlength=n_groups)[group]
    made = np.cumsum(repeats)
    at = 0
    while at < len(group):
        before = made[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(made, before + LINKS, "right")))
        times = repeats[at:stop]
        i = np.repeat(np.arange(at, stop), times)
        j = np.arange(len(i)) - np.repeat(np.cumsum(times) - times, times) + first[group[i]]
        yield group[i], a[i], b[j], None if n_a is None else n_a[i] * n_b[j]
        at = stop


def in_blocks(texts: list[str | None]) -> Iterator[tuple[int, list[str | None]]]:
    """Some texts at a time, with the number of the first."""
    at = size = 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= BYTES or i + 1 == len(texts):
            yield at, texts[at : i + 1]
            at, size = i + 1, 0


def paths(byte_level: str | None, pieces: str | None) -> tuple[str, str]:
    if byte_level and pieces:
        return byte_level, pieces
    import public_tokenizers

    return byte_level or public_tokenizers.path("byte_bpe_50k.json"), pieces or public_tokenizers.path("piece_bpe_32k.model")


def alignment_groups(docs: DataFrame, byte_level: str | None = None, pieces: str | None = None) -> DataFrame:
    """``doc_id, group, start, end, a_ids, b_ids``: the groups of every text, numbered from 0, with their bytes of
    space and text and the ids of both sides. Texts without tokens, as :func:`aligned` defines them, have no rows."""
    files = paths(byte_level, pieces)
    names = ["doc_id", "group", "start", "end", "a_ids", "b_ids"]

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = tokenizers_of(files)
        for batch in batches:
            ids, texts = (c.to_pylist() for c in batch.columns)
            for at, some in in_blocks(texts):
                x = Aligned(tokenizers, some)
                first = np.searchsorted(x.text_of, np.arange(len(some)))[x.text_of] if x.n_groups else np.zeros(0, np.int64)
                lists = [
                    pa.ListArray.from_arrays(pa.array(np.append(f, len(v)), pa.int32()), pa.array(v.astype(np.int32)))
                    for f, v in ((x.a_first, x.a), (x.b_first, x.b))
                ]
                columns = [
                    pa.array([ids[at + i] for i in x.text_of.tolist()], pa.int64()),
                    pa.array(np.arange(x.n_groups) - first),
                    pa.array(x.starts - x.starts[first]),
                    pa.array(x.ends - x.starts[first]),
                    *lists,
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id long, group long, start long, end long, a_ids array<int>, b_ids array<int>"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(align, schema)


DIGESTS = "doc_id long, row long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary"


def digested(docs: DataFrame, files: tuple[str, str]) -> DataFrame:
    """A row per document with the digest of its groups, its distinct id pairs and how many links have each."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = tokenizers_of(files)
        names = [c.split()[0] for c in DIGESTS.split(", ")]
        for batch in batches:
            ids, rows, texts = batch[0], batch[1], batch[2].to_pylist()
            for at, some in in_blocks(texts):
                x = Aligned(tokenizers, some)
                shas = [hashlib.sha256(s.encode()).hexdigest() if s else "" for s in x.spelled()]
                text, pair, n = x.links()
                edges = np.searchsorted(text, np.arange(len(some) + 1)).tolist()
                pair, n = pair.astype(x.key), n.astype("<u4")
                packed = [pa.array([v[a:b].tobytes() for a, b in zip(edges, edges[1:], strict=False)], pa.binary()) for v in (pair, n)]
                numbers = [pa.array(v, pa.int64()) for v in (x.n_a, x.n_b, x.groups_per_text(), x.links_per_text())]
                columns = [ids.slice(at, len(some)), rows.slice(at, len(some)), *numbers, pa.array(shas), *packed]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    read = docs.select(F.col("doc_id").cast("long"), F.monotonically_increasing_id(), "text")
    return materialise(read.mapInArrow(digest, DIGESTS), "alignment")


def pair_counts(digests: DataFrame, width: int, key: np.dtype) -> DataFrame:
    """``pair, n, best``: how many documents link the id pair, and whether no pair of its A id has more."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n, held = np.zeros(0, np.int64), np.zeros(0, np.int64), []
        for batch in batches:
            held.append(np.frombuffer(b"".join(batch[0].to_pylist()), key).astype(np.int64))
            if sum(map(len, held)) >= COUNTED:
                fresh = np.unique(np.concatenate(held), return_counts=True)
                keys, n = summed(np.concatenate([keys, fresh[0]]), np.concatenate([n, fresh[1]]))
                held = []
                if len(keys) >= COUNTED:
                    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], names=["pair", "n"])
                    keys, n = keys[:0], n[:0]
        if held:
            fresh = np.unique(np.concatenate(held), return_counts=True)
            keys, n = summed(np.concatenate([keys, fresh[0]]), np.concatenate([n, fresh[1]]))
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], names=["pair", "n"])

    counted = digests.select("pairs").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counted = materialise(counted, "pair_counts").withColumn("a", F.floor(F.col("pair") / width))
    # a row per A id: the vocabulary bounds it
    most = counted.groupBy("a").agg(F.max("n").alias("most"))
    return counted.join(F.broadcast(most), "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


LOOKED = "row long, n_best long, count_sum long, rare array<struct<pair: long, times: long>>"


def aligned(docs: DataFrame, byte_level: str | None = None, pieces: str | None = None) -> DataFrame:
    """A row per row of ``docs`` (``doc_id, text``): ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    A is the byte-level tokenizer file over a space and the text, B the piece model over the text; both are paths that
    executors have, by default the public ones. Special tokens in a text are plain text. Texts that are null or empty,
    or whose tokens of either side do not spell out a space and the text, have no tokens: all numbers are 0 and the digest is the empty string.
    ``n_best`` counts the links whose pair is linked in as many documents as any pair of its A id, ``count_sum`` adds up
    the documents that link the pair of each link. Repeated rows are documents of their own, rows with a null ``doc_id`` too;
    other columns are not read. An empty table gives no rows.
    """
    files = paths(byte_level, pieces)
    width, key = len(tokenizers_of(files).b_bytes), tokenizers_of(files).key
    digests = digested(docs, files)
    counts = materialise(pair_counts(digests, width, key), "counts")
    limit = (counts.agg(F.sum("n").alias("n")).first().n or 0) / FREQUENT
    frequent = counts.where(F.col("n") > limit).toArrow().sort_by("pair")
    known, n_of, best_of = (frequent[c].to_numpy() for c in ("pair", "n", "best"))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("pair", pa.int64()), ("times", pa.int64())])
        for batch in batches:
            found: tuple[list, ...] = ([], [], [], [])
            for row, pairs, times in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                pair, n = np.frombuffer(pairs, key).astype(np.int64), np.frombuffer(times, "<u4").astype(np.int64)
                at = np.minimum(np.searchsorted(known, pair), max(0, len(known) - 1))
                hit = known[at] == pair if len(known) else np.zeros(len(pair), bool)
                at, times_hit = at[hit], n[hit]
                rare = [{"pair": p, "times": t} for p, t in zip(pair[~hit].tolist(), n[~hit].tolist(), strict=True)]
                for column, value in zip(found, (row, int(times_hit[best_of[at]].sum()), int((times_hit * n_of[at]).sum()), rare), strict=True):
                    column.append(value)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.list_(kind))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(found, types, strict=True)], names=[c.split()[0] for c in LOOKED.split(", ", 3)])

    looked = materialise(digests.select("row", "pairs", "times").mapInArrow(look, LOOKED), "looked")
    rare = looked.select("row", F.inline("rare")).join(counts.where(F.col("n") <= limit), "pair")
    rare = rare.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("rare_best"), F.sum(F.col("times") * F.col("n")).alias("rare_sum")
    )
    sums = looked.select("row", "n_best", "count_sum").join(rare, "row", "left").select(
        "row", *[(F.col(c) + F.coalesce(r, F.lit(0))).alias(c) for c, r in (("n_best", "rare_best"), ("count_sum", "rare_sum"))]
    )
    return digests.drop("pairs", "times").join(sums, "row").select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aligned(spark.read.parquet(f"{sf_dir}/documents.parquet"))
