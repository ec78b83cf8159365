"""Best-fit packing of tokenised documents, planned on the histogram of lengths."""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W
from tokenizers import Tokenizer

from changeflow.session import materialise

#: Texts that a task turns into one batch of pieces.
TEXTS = 512

# Fixed value: how a byte-level tokenizer cuts a text before it merges.
CUTS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_of_char() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 for itself,
    the other bytes, in order, for the characters from U+0100 on."""
    shown = {b for b in range(256) if chr(b).isprintable() and not chr(b).isspace()}
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


def merging(path: str):
    """The file's byte-level merges as ranks for ``tiktoken``, which runs them several times faster, or None
    where its rules are others. Ids are the same if the merges stand in the order of their ids."""
    with open(path, encoding="utf-8") as f:
        rules = json.load(f)
    cut, model = rules["pre_tokenizer"] or {}, rules["model"]
    plain = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
    if not plain or model.get("type", "BPE") != "BPE" or rules["normalizer"] or model.get("ignore_merges"):
        return None
    vocab = model["vocab"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    order = [vocab["".join(p)] for p in pairs]
    if order != sorted(set(order)):
        return None
    special = {t["content"] for t in rules["added_tokens"]}
    byte = byte_of_char()
    ranks = {bytes(map(byte.__getitem__, t)): i for t, i in vocab.items() if t not in special}
    return tiktoken.Encoding("from_file", pat_str=CUTS, mergeable_ranks=ranks, special_tokens={})


#: Characters that Unicode tables of any age class alike: older alphabets, common punctuation, kana, hanzi.
SETTLED = re.compile("[\x00-\u1fff\u2010-\u2027\u20ac\u3000-\u30ff\u4e00-\u9fa5]*")


class Tokens:
    """Ids of texts as little-endian unsigned 32-bit numbers, as ``tokenizers`` gives them for the file.

    Texts with special tokens or with characters that are not settled always go through ``tokenizers``.
    """

    def __init__(self, path: str) -> None:
        self.slow = Tokenizer.from_file(path)
        self.fast = merging(path)

    def of(self, text: str) -> bytes:
        if self.fast and "<|" not in text and SETTLED.fullmatch(text):
            return np.array(self.fast.encode_ordinary(text), "<u4").tobytes()
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def tokenised(docs: DataFrame, tokenizer: str, end_id: int, most: int) -> DataFrame:
    """The pieces of every text of ``docs`` (``doc_id, text``): ``doc_id, piece, start, ids``.

    ``ids`` are little-endian unsigned 32-bit numbers. Each text ends in ``end_id``. What is longer than
    ``most`` ids is cut so that only the first piece may be shorter. A null text is the empty text.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, end = Tokens(tokenizer), end_id.to_bytes(4, "little")
        schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("ids", pa.binary())])
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                rows: tuple[list, list, list, list] = ([], [], [], [])
                for doc_id, text in zip(part[0].to_pylist(), part[1].to_pylist(), strict=True):
                    ids = tokens.of(text or "") + end
                    n = len(ids) // 4
                    cuts = [0, *range(n % most or most, n, most), n]
                    for i, (start, stop) in enumerate(zip(cuts, cuts[1:], strict=False)):
                        for column, value in zip(rows, (doc_id, i, start, ids[4 * start : 4 * stop]), strict=True):
                            column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(rows, schema.types, strict=True)], schema=schema
                )

    return docs.select("doc_id", "text").mapInArrow(pieces, "doc_id long, piece int, start long, ids binary")


def best_fit(counts: dict[int, int], most: int) -> list[tuple[int, int, int, int, int, int]]:
    """Place ``counts[length]`` pieces, longest first, each into the fullest sequence that still takes it.

    Sequences that are filled alike are one group, so a step places many pieces at once: as many in each sequence
    as fit, since it only gets fuller. Returns the steps ``(length, first rank, end rank, first sequence, offset, per)``:
    the piece of that length and rank ``r`` is piece ``r - first rank`` of the step, which puts ``per`` into each sequence.
    A length uses up groups, opens two at most and splits one, so the plan is bounded by ``most``, not by the number
    of pieces.
    """
    free: dict[int, list[tuple[int, int]]] = {}  # room left: groups (first sequence, how many)
    rooms: list[int] = []  # sorted
    steps, opened = [], 0

    def give(room: int, first: int, n: int) -> None:
        if n and room:
            if room not in free:
                free[room] = []
                rooms.insert(bisect_left(rooms, room), room)
            free[room].append((first, n))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                room, first = most, opened
                n = -(-left // (most // length))
                opened += n
            else:
                room = rooms[at]
                first, n = free[room].pop()
                if not free[room]:
                    del free[room]
                    rooms.pop(at)
            per = room // length
            full = min(n, left // per)
            if full:
                steps.append((length, rank, rank + full * per, first, most - room, per))
                give(room - per * length, first, full)
                rank, left = rank + full * per, left - full * per
            if left and full < n:
                steps.append((length, rank, rank + left, first + full, most - room, left))
                give(room - left * length, first + full, 1)
                full, rank, left = full + 1, rank + left, 0
            give(room, first + full, n - full)
    return steps


def pack(pieces: DataFrame, most: int) -> DataFrame:
    """``pieces`` (with ``doc_id, piece, length``) with a place each: ``sequence_id`` and ``offset``.

    Only the histogram of lengths, ``most`` counts, comes to the driver, and only the plan goes out again.
    A piece takes the slot of its rank within its length. Ranks are counted in parts by hash, as many as a
    length's share of all pieces asks for, so a length that a third of all pieces have is spread.
    """
    spark = pieces.sparkSession
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    steps = best_fit(counts, most)
    total, parts = max(1, sum(counts.values())), 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    split = spark.createDataFrame([(k, -(-n * parts // total)) for k, n in counts.items()], "length int, n_parts long")
    mixed = F.pmod(F.xxhash64("doc_id", "piece"), F.col("n_parts"))
    parted = pieces.join(F.broadcast(split), "length").withColumn("part", mixed).drop("n_parts")
    before = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    bases = (
        parted.groupBy("length", "part")
        .agg(F.count("*").alias("n"))
        .select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    )
    within = W.partitionBy("length", "part").orderBy(*[c for c in ("doc_id", "piece", "start", "ids_crc32") if c in pieces.columns])
    ranked = parted.join(bases, ["length", "part"]).withColumn("rank", F.col("base") + F.row_number().over(within) - 1)
    plan = spark.createDataFrame(steps, "of int, lo long, hi long, first long, at long, per long")
    slot = (F.col("length") == F.col("of")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi"))
    return (
        ranked.join(F.broadcast(plan), slot)
        .withColumn("sequence_id", F.col("first") + F.floor((F.col("rank") - F.col("lo")) / F.col("per")))
        .withColumn("offset", F.col("at") + F.pmod(F.col("rank") - F.col("lo"), F.col("per")) * F.col("length"))
        .select(*pieces.columns, "sequence_id", "offset")
    )


def sequences(pieces: DataFrame, places: DataFrame) -> DataFrame:
    """The packed sequences themselves: ``sequence_id, ids``, at most the planned length each.

    ``pieces`` holds the ids, ``places`` where each (``doc_id``, ``piece``) goes; these must be unique here.
    """
    joined = pieces.join(places.select("doc_id", "piece", "sequence_id", "offset"), ["doc_id", "piece"])
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = joined.groupBy("sequence_id").agg(parts.alias("parts"))
    return joined.select("sequence_id", F.expr("aggregate(parts.ids, X'', (a, x) -> a || x)").alias("ids"))


def packed(docs: DataFrame, tokenizer: str | None = None, most: int = 1024, end_id: int = 2) -> DataFrame:
    """Pack all documents: a row per piece with ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    ``tokenizer`` is the path of a tokenizer file that executors have, by default the public byte-level one.
    Null and empty texts are one piece of ``end_id`` alone. Repeated rows are packed as often as they come;
    rows with a null ``doc_id`` are packed too. An empty table gives no rows.
    """
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    pieces = tokenised(docs, tokenizer, end_id, most).select(
        "doc_id",
        "piece",
        "start",
        F.floor(F.octet_length("ids") / 4).cast("int").alias("length"),
        F.crc32("ids").alias("ids_crc32"),
    )
    return pack(materialise(pieces, "pieces"), most)


def crc32_of(ids: list[int]) -> int:
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = packed(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return places.withColumn("length", F.col("length").cast("long"))
