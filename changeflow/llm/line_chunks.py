"""Line dedup: content-defined chunks of lines, and the runs of lines at their edges, removed where they repeat anywhere.

A rolling hash over line hashes says where chunks end, so a passage is cut alike wherever it stands, but for the
chunks at its two ends. Chunks that an earlier place has too settle all lines in them. What they leave open, runs of
two lines that lie across a boundary or in a chunk that does not repeat as a whole, is looked up by itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.llm.exact_dedup import row_keys, whole_rows
from changeflow.operators.skew import hot_from_counts, salted_left_join
from changeflow.session import materialise

#: Lines that the rolling hash sees, and mean lines of a chunk: where only whole chunks go, and where runs at their edges do too.
WINDOW = 3
MEAN = 4
RUN_WINDOW = 1
RUN_MEAN = 3

ODD = np.uint64(0x9E3779B97F4A7C15)


def boundaries(lines: list[bytes], window: int = WINDOW, mean: int = MEAN) -> list[int]:
    """Where the chunks of a document end, as line numbers, the last line included.

    A chunk ends behind a line if the rolling hash of the ``window`` lines up to it is divisible by ``mean``.
    Only those lines decide, so lines put in or taken out before them shift nothing; there is no longest chunk.
    """
    n = len(lines)
    hashes = np.array([xxhash.xxh3_64_intdigest(x) for x in lines], np.uint64)
    rolled = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for back in range(min(window, n)):
            rolled[back:] += hashes[: n - back] * ODD ** np.uint64(back)
        rolled = (rolled ^ (rolled >> np.uint64(29))) * ODD
    ends = (np.flatnonzero((rolled >> np.uint64(32)) % np.uint64(mean) == 0) + 1).tolist()
    return ends if ends and ends[-1] == n else [*ends, n]


def lines_of(text: str | None) -> list[bytes]:
    """The lines of a text with their line ends; joined, they are the text."""
    lines = (text or "").encode("utf-8", "surrogatepass").split(b"\n")
    return [x + b"\n" for x in lines[:-1]] + ([lines[-1]] if lines[-1] else [])


def windows_of(text: str | None, lines: int) -> list[bytes]:
    """All runs of that many lines, without the line ends behind them."""
    held = lines_of(text)
    return [b"".join(held[i : i + lines]).rstrip(b"\n") for i in range(len(held) - lines + 1)]


def chunks_of(text: str | None, window: int = WINDOW, mean: int = MEAN) -> list[tuple[int, bytes]]:
    """``(lines, bytes)`` of each chunk; joined, the bytes are the text, with its line ends. No text, no chunk."""
    lines = lines_of(text)
    if not lines:
        return []
    found, start = [], 0
    for end in boundaries([x.rstrip(b"\n") for x in lines], window, mean):
        found.append((end - start, b"".join(lines[start:end])))
        start = end
    return found


def digest_of(chunk: bytes) -> bytes:
    """The last line of a document may lack its line end; the chunk is the same."""
    return hashlib.blake2b(chunk.rstrip(b"\n"), digest_size=16).digest()


CHUNK = "_id string, _hash long, doc_id long, place int, lines int, digest binary, chunk binary"


def chunked(docs: DataFrame, least_lines: int, with_bytes: bool) -> DataFrame:
    """The chunks of ``docs`` with at least ``least_lines`` lines; their bytes only on demand."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("_id", pa.string()), ("_hash", pa.int64()), ("doc_id", pa.int64()), ("place", pa.int32()), ("lines", pa.int32()), ("digest", pa.binary()), ("chunk", pa.binary())]
        )
        for batch in batches:
            rows: list[tuple] = []
            for key, text_hash, doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for place, (lines, chunk) in enumerate(chunks_of(text)):
                    if lines >= least_lines:
                        rows.append((key, text_hash, doc_id, place, lines, digest_of(chunk), chunk if with_bytes else None))
            columns = zip(*rows, strict=True) if rows else [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)

    keyed = docs.select("doc_id", "text").withColumns(row_keys("doc_id", F.xxhash64("text")))
    return keyed.select("_id", "_hash", F.col("doc_id").cast("long"), "text").mapInArrow(cut, CHUNK)


def repeated_chunks(docs: DataFrame, least_lines: int = 2) -> DataFrame:
    """Chunks of at least ``least_lines`` lines that an earlier place of the corpus has too: ``_id, _hash, place, lines``.

    The first place is that of the smallest ``doc_id`` (null last), then text hash, then place. Digests only nominate:
    every nominated chunk meets the first one and is removed if their bytes are equal. The first chunk is
    repeated per salt where a digest is frequent, so no task holds all copies of a chunk.
    """
    thin = materialise(chunked(docs, least_lines, False).drop("chunk"), "chunks")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_id", "_hash", "place")
    groups = thin.groupBy("digest").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    groups = materialise(groups, "repeated")
    hot = hot_from_counts(groups, "digest", "n")
    marked = salted_left_join(thin, groups.select("digest", "first"), "digest", "_hash", hot).where("first IS NOT NULL")
    marked = materialise(marked.withColumn("leads", place == F.col("first")).drop("doc_id", "first"), "marked")
    # only the documents with nominated chunks give their bytes
    keyed = docs.select("doc_id", "text").withColumns(row_keys("doc_id", F.xxhash64("text")))
    involved = keyed.join(marked.select("_id", "_hash").distinct(), ["_id", "_hash"], "left_semi")
    held = chunked(involved.select("doc_id", "text").dropDuplicates(["doc_id", "text"]), least_lines, True)
    full = held.join(marked.select("_id", "_hash", "place", "leads"), ["_id", "_hash", "place"])
    full = full.select("_id", "_hash", "place", "lines", "digest", "leads", F.rtrim(F.col("chunk").cast("string"), F.lit("\n")).alias("bytes"))
    full = materialise(full, "bytes")
    leaders = full.where("leads").groupBy("digest").agg(F.min("bytes").alias("leader"))
    compared = salted_left_join(full, leaders, "digest", "_hash", hot)
    return compared.where((F.col("bytes") == F.col("leader")) & ~F.col("leads")).select("_id", "_hash", "place", "lines")


RUNS = "_id string, _hash long, doc_id long, place int, lines int, digest binary, runs array<binary>"
HELD = "_id string, _hash long, place int, lines int, digest binary, leads boolean, bytes binary"


def arrow_rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)


def first_places(found: DataFrame, least_lines: int) -> DataFrame:
    """Rows of ``found`` (``_id, _hash, doc_id, place, lines, digest``, more) whose digest another place has too, with ``leads``
    for those at its first place. What overlaps the first place in the same text is no repeat of it."""
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_id", "_hash", "place")
    groups = found.groupBy("digest").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    groups = materialise(groups, "repeated")
    hot = hot_from_counts(groups, "digest", "n")
    # spread by document, as the texts of copies have one hash
    marked = salted_left_join(found, groups.select("digest", "first"), "digest", "_id", hot).where("first IS NOT NULL")
    overlaps = (F.col("_id") == F.col("first._id")) & (F.col("_hash") == F.col("first._hash")) & (F.col("place") - F.col("first.place") < least_lines)
    return marked.withColumn("leads", place == F.col("first")).where(F.col("leads") | ~overlaps).drop("first")


def repeated_runs(docs: DataFrame, least_lines: int = 2) -> DataFrame:
    """Chunks, and runs of ``least_lines`` lines that no repeated chunk holds, that an earlier place of the corpus has too,
    whatever stands around them: ``_id, _hash, place, lines``, the number of their first line and how many they are.

    Places are ordered as for :func:`repeated_chunks`. Every longer run of lines that repeats consists of such runs, so none
    is missed: those within a repeated chunk are also within the first one, which stands earlier and is looked at.
    Digests only nominate; only nominated chunks and runs give their bytes, which must equal those of the first place.
    """

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("_id", pa.string()), ("_hash", pa.int64()), ("doc_id", pa.int64()), ("place", pa.int32()), ("lines", pa.int32()), ("digest", pa.binary()), ("runs", pa.list_(pa.binary()))]
        )
        for batch in batches:
            rows: list[tuple] = []
            for key, text_hash, doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                runs = [digest_of(w) for w in windows_of(text, least_lines)]
                at = 0
                for lines, chunk in chunks_of(text, RUN_WINDOW, RUN_MEAN):
                    rows.append((key, text_hash, doc_id, at, lines, digest_of(chunk), runs[at : at + lines]))
                    at += lines
            yield arrow_rows(rows, schema)

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("_id", pa.string()), ("_hash", pa.int64()), ("place", pa.int32()), ("lines", pa.int32()), ("digest", pa.binary()), ("leads", pa.bool_()), ("bytes", pa.binary())]
        )
        for batch in batches:
            rows: list[tuple] = []
            for key, text_hash, wanted, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                lines = lines_of(text)
                for w in wanted:
                    bare = b"".join(lines[w["place"] : w["place"] + w["lines"]]).rstrip(b"\n")
                    rows.append((key, text_hash, w["place"], w["lines"], w["digest"], w["leads"], bare))
            yield arrow_rows(rows, schema)

    keyed = docs.select("doc_id", "text").withColumns(row_keys("doc_id", F.xxhash64("text")))
    thin = keyed.select("_id", "_hash", F.col("doc_id").cast("long"), "text").mapInArrow(digests, RUNS)
    thin = materialise(thin, "chunks")
    place = ["_id", "_hash", "place"]
    long_chunks = thin.where(F.col("lines") >= least_lines).drop("runs")
    chunks = materialise(first_places(long_chunks, least_lines), "repeated_chunks")
    # runs within a later copy of a chunk are settled; the last of a chunk reach into the next one
    settled = chunks.where("NOT leads").select(*place, F.lit(True).alias("settled"))
    runs = thin.drop("digest").join(settled, place, "left").select("*", F.posexplode("runs").alias("at", "digest"))
    runs = runs.where(F.col("settled").isNull() | (F.col("at") > F.col("lines") - least_lines))
    runs = runs.select("_id", "_hash", "doc_id", (F.col("place") + F.col("at")).alias("place"), F.lit(least_lines).alias("lines"), "digest")
    marked = chunks.unionByName(first_places(runs, least_lines))
    wanted = marked.groupBy("_id", "_hash").agg(F.collect_set(F.struct("place", "lines", "digest", "leads")).alias("wanted"))
    full = keyed.join(wanted, ["_id", "_hash"]).select("_id", "_hash", "wanted", "text").mapInArrow(held, HELD)
    full = materialise(full, "bytes")
    leaders = full.where("leads").groupBy("digest").agg(F.min("bytes").alias("leader"))
    hot = hot_from_counts(full.groupBy("digest").agg(F.count("*").alias("n")), "digest", "n")
    compared = salted_left_join(full.where("NOT leads"), leaders, "digest", "_id", hot)
    return compared.where(F.col("bytes") == F.col("leader")).select("_id", "_hash", "place", "lines")


ADDED = "n_lines long, n_chunks long, n_removed_chunks long, n_removed_lines long"


def cut(docs: DataFrame, removed: DataFrame, chunks: tuple[int, int] | None = None) -> DataFrame:
    """``docs`` without what stands at the places ``removed`` (``_id, _hash, place, lines``), and what that was.

    Places are numbers of chunks, or where ``chunks`` gives their window and mean, numbers of first lines.
    """
    removed = removed.groupBy("_id", "_hash").agg(F.collect_set(F.struct("place", "lines")).alias("_places"))
    docs = docs.drop(*(a.split()[0] for a in ADDED.split(", ")))
    joined = whole_rows(docs).join(removed, ["_id", "_hash"], "left")
    columns = docs.columns

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts = [], []
            doc = dict(zip(columns, batch["doc"].flatten(), strict=True))
            for text, places in zip(doc["text"].to_pylist(), batch["_places"].to_pylist(), strict=True):
                found = chunks_of(text, *(chunks or ()))
                starts = np.cumsum([0, *(n for n, _ in found)]).tolist()
                begins = [(p["place"] if chunks else starts[p["place"]], p["lines"]) for p in places or ()]
                gone = {line for i, n in begins for line in range(i, i + n)}
                whole = sum(gone.issuperset(range(a, b)) for a, b in zip(starts, starts[1:], strict=False))
                kept = b"".join(x for i, x in enumerate(lines_of(text)) if i not in gone) if gone else b""
                texts.append(kept.decode("utf-8", "surrogatepass") if gone else text)
                counts.append((starts[-1], len(found), whole, len(gone)))
            arrays = [pa.array(texts, pa.string()) if c == "text" else doc[c] for c in columns]
            more = [pa.array([c[i] for c in counts], pa.int64()) for i in range(4)]
            yield pa.RecordBatch.from_arrays(arrays + more, names=[*columns, *(a.split()[0] for a in ADDED.split(", "))])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + ", " + ADDED
    return joined.select("doc", "_places").mapInArrow(write, schema)


def without_repeats(docs: DataFrame, least_lines: int = 2) -> DataFrame:
    """``docs`` with the bytes of repeated chunks removed: all columns, and ``n_lines, n_chunks, n_removed_chunks, n_removed_lines``,
    which take the place of columns of these names.

    Null and empty texts stay as they are and have no lines. Rows alike in ``doc_id`` and text are judged once
    and cut alike, so a whole repeated row loses nothing to its twin. What is left of a text keeps its order.
    Only repeats that fill whole chunks are found; :func:`without_repeated_runs` finds all.
    """
    return cut(docs, repeated_chunks(docs, least_lines))


def without_repeated_runs(docs: DataFrame, least_lines: int = 2) -> DataFrame:
    """``docs`` without the lines of every run of at least ``least_lines`` lines that an earlier place has too.

    Columns and rows as for :func:`without_repeats`; a chunk counts as removed if all of its lines are. A blank line is a
    line like any other. An empty table gives no rows.
    """
    return cut(docs, repeated_runs(docs, least_lines), (RUN_WINDOW, RUN_MEAN))


def summed(kept: DataFrame) -> DataFrame:
    return kept.select(
        "doc_id", "n_lines", "n_chunks", "n_removed_chunks", "n_removed_lines",
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole chunks only."""
    return summed(without_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")))


def runs_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered query: all repeated runs."""
    return summed(without_repeated_runs(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")))
