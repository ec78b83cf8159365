"""WARC, quality, tool calls, packing, mixing and search: round trips, brute force, held-out rows, odd rows."""

import hashlib
import json
import math
import random
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import zstandard as zstd
from tokenizers import Tokenizer

from changeflow.llm import mixing, packing, quality, queries, tool_calls, topk, warc

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_queries_equal_their_sql(spark, duck, name):
    columns, want = duck(queries.ORACLE[name], SMALL)
    got = queries.QUERIES[name](spark, SMALL)
    assert sorted(got.columns) == sorted(columns)
    assert Counter(tuple(r[c] for c in columns) for r in got.collect()) == Counter(want)


# ---- WARC ----------------------------------------------------------------------------------------------

PAGES = "page_id long, url string, html string"


def test_pages_come_back(spark):
    long = "<p>ä</p>" * 200
    rows = [
        (1, "http://a", long), (2, "http://b c\r\nX: y", long), (3, None, long), (3, None, long), (None, "http://n", long),
        (4, "http://d", "short"), (5, "http://d", "short"), (6, "http://e", None), (7, "http://f", ""), (None, None, None),
        (8, "http://g", "z" * 2_000_000),
    ]
    pages = spark.createDataFrame(rows, PAGES).repartition(3)
    got = warc.round_trip(pages).collect()
    assert len(got) == len(rows)
    payloads = Counter((i, hashlib.sha1((h or "").encode()).hexdigest(), len((h or "").encode())) for i, _, h in rows)
    assert Counter((r.page_id, r.payload_digest, r.payload_bytes) for r in got) == payloads
    kinds = Counter((r.page_id, r.record_type, r.refers_to) for r in got if r.payload_bytes == len(long.encode()))
    assert kinds == {(1, "revisit", 3): 1, (2, "revisit", 3): 1, (None, "revisit", 3): 1, (3, "response", None): 2}
    assert all(r.record_type == "response" for r in got if r.payload_bytes < 1000)
    assert {bytes(r.payload) for r in got if r.page_id == 3} == {long.encode()}
    assert {r.url for r in got if r.page_id == 2} == {"http://b%20c%0D%0AX:%20y"}
    assert warc.round_trip(spark.createDataFrame([], PAGES)).count() == 0


def small_archive(n=5):
    payloads = [b"payload %d " % i * (i + 1) for i in range(n)]
    records = [warc.record_bytes(i, "http://x", p, hashlib.sha1(p).hexdigest(), None, False) for i, p in enumerate(payloads)]
    return payloads, records, warc.archive_bytes(records)


def test_archives_follow_the_format():
    payloads, records, archive = small_archive()
    magic, size = struct.unpack_from("<II", archive)
    assert magic == 0x184D2A5D
    dictionary = zstd.ZstdCompressionDict(zstd.ZstdDecompressor().decompress(archive[8 : 8 + size]))
    # any reader that knows the dictionary reads the whole as one stream of frames
    stream = zstd.ZstdDecompressor(dict_data=dictionary).stream_reader(archive[8 + size :], read_across_frames=True)
    assert stream.read() == b"".join(records)
    assert [r.payload for r in warc.records_of(archive)] == payloads
    skipped = archive[: 8 + size] + struct.pack("<II", 0x184D2A50, 3) + b"abc" + archive[8 + size :]
    assert [r.payload for r in warc.records_of(skipped)] == payloads
    plain = b"".join(zstd.ZstdCompressor().compress(r) for r in records)
    assert [r.payload for r in warc.records_of(plain)] == payloads


def test_broken_archives_are_refused():
    _, records, archive = small_archive()
    one = records[0]
    broken = [
        one.replace(b"Content-Length: 97", b"Content-Length: 96", 1).replace(b"Content-Length: ", b"Content-Length: 9", 1),
        one[:-4],
        one.replace(b"payload 0 ", b"payload 1 "),
        one.replace(b"WARC/1.1", b"WARC/9.9"),
        one.replace(b"WARC-Date", b"WARC-When"),
        one.replace(b"WARC-Date: ", b"WARC-Date "),
    ]
    for content in broken:
        assert content != one
        with pytest.raises(warc.BadArchive):
            list(warc.records_of(warc.archive_bytes([content, *records[1:]])))
    for cut in (4, 20, len(archive) - 3):
        with pytest.raises(warc.BadArchive):
            list(warc.records_of(archive[:cut]))
    flipped = bytearray(archive)
    flipped[-6] ^= 0xFF
    with pytest.raises(warc.BadArchive):
        list(warc.records_of(bytes(flipped)))


# ---- quality -------------------------------------------------------------------------------------------


def test_scores_held_out_rows_well(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in quality.query(spark, sf).collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got.values())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    held = [(got[r.doc_id].score, r.quality) for r in labels if got[r.doc_id].held_out]
    good, bad = ([s for s, q in held if q == x] for x in (1, 0))
    assert len(bad) > 5
    auc = sum((a > b) + 0.5 * (a == b) for a in good for b in bad) / (len(good) * len(bad))
    assert auc > 0.97


def test_flat_trees_equal_a_walk():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 5)).round(1)
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    trees = quality.fit(x, y, rounds=15, depth=3)

    def walk(row, node):
        while trees.feature[node] >= 0:
            node = trees.left[node] + int(row[trees.feature[node]] > trees.cut[node])
        return trees.value[node]

    want = [trees.base + sum(walk(row, r) for r in trees.roots) for row in x]
    assert np.allclose(trees.margins(x), want)
    assert ((trees.scores(x) > 0.5) == (y > 0.5)).mean() > 0.97


def test_odd_rows_are_scored(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 0, 0), (4, 1, 0), (4, 0, None), (8, None, 0), (None, 1, 0), (99, 1, 1), (6, 1, 0)], "doc_id long, quality int, toxic int")
    assert quality.quality_scores(odd_docs, labels).count() == odd_docs.count()
    assert {r.score for r in quality.quality_scores(odd_docs, labels.where("false")).collect()} == {0.5}
    assert quality.quality_scores(no_docs, labels).count() == 0
    assert quality.accepted(odd_docs, labels.where("false")).count() == odd_docs.count()
    assert quality.accepted(odd_docs, labels).columns == odd_docs.columns


# ---- tool calls ----------------------------------------------------------------------------------------

MESSAGES = f"conv_id long, turn long, role string, text string, calls array<{tool_calls.CALL}>, result_of string"
TOOLS = {"add": {"type": "object", "properties": {"a": {"type": "integer", "minimum": 0}, "b": {"type": ["number", "null"]}}, "required": ["a"], "additionalProperties": False}}


def call(name, arguments, after=(), tool="add"):
    return (name, tool, arguments, list(after))


def test_calls_are_linked_ordered_and_checked(spark):
    rows = [
        (1, 0, "user", "go", None, None),
        (1, 1, "assistant", None, [call("c", '{"a": 1.0}', ["b"]), call("b", '{"b": 2.50, "a": 3}', ["a"]), call("a", '{"a": 0}')], None),
        (1, 2, "tool", "A", None, "a"), (1, 3, "tool", "B", None, "b"), (1, 4, "tool", "C", None, "c"), (1, 5, "tool", "again", None, "c"),
        (1, 6, "tool", "lost", None, "zzz"), (1, 7, "tool", None, None, None),
        (2, 0, "assistant", "", [call("x", "{", ["y"]), call("y", '{"a": -1}', ["x"]), call("z", '{"a": 1, "q": 1}'), call("u", "{}", (), "other"), call("v", '{"a":1}')], None),
        (2, 1, "tool", "X", None, "x"), (2, 2, "tool", "Y", None, "y"), (2, 3, "tool", "Z", None, "z"), (2, 4, "tool", "U", None, "u"),
        (3, 0, "tool", "early", None, "e"), (3, 1, "assistant", "", [call("e", '{"a": 1}'), call(None, '{"a": 1}'), call("e", '{"a": 2}')], None),
        (4, 0, "user", "nothing", [], None), (None, 0, "user", "no conversation", None, None), (5, None, None, None, None, None),
        (6, 0, "user", "twice", None, None), (6, 0, "user", "twice", None, None),
    ]
    random.shuffle(rows)
    messages = spark.createDataFrame(rows, MESSAGES).repartition(4)
    got = {r.conv_id: r for r in tool_calls.formatted(messages, TOOLS).collect()}
    assert sorted(got) == [1, 2, 3, 4, 5, 6]
    one, two = json.loads(got[1].document), json.loads(got[2].document)
    assert [c["id"] for c in one["tool_calls"]] == ["a", "b", "c"]
    assert [c["valid"] for c in one["tool_calls"]] == [True] * 3 and got[1].n_unlinked == 3 and got[1].n_calls == 3
    assert '"arguments":{"a":3,"b":2.5}' in got[1].document and '"arguments":{"a":1}' in got[1].document
    assert [c["id"] for c in two["tool_calls"]] == ["z", "u", "x", "y"] and got[2].n_cyclic == 2 and got[2].n_unlinked == 1
    assert [c["errors"] for c in two["tool_calls"]] == [["$.q: unknown"], ["$: unknown tool"], ["$: not JSON"], ["$.a: below minimum"]]
    assert (got[3].n_ok, got[3].n_invalid, got[3].n_unlinked) == (0, 1, 2)
    assert json.loads(got[5].document) == {"messages": [{"content": "", "role": None}], "tool_calls": []}
    assert len(json.loads(got[6].document)["messages"]) == 2
    assert tool_calls.formatted(messages.where("false"), TOOLS).count() == 0


def test_canonical_json():
    assert tool_calls.canonical({"b": [1.0, 2.5, None], "a": {"é": True}}) == '{"a":{"é":true},"b":[1,2.5,null]}'
    with pytest.raises(ValueError):
        tool_calls.canonical(math.nan)


def test_calls_of_conversations_equal_brute_force(spark):
    rows = spark.read.parquet(f"{SMALL}/conversations.parquet").collect()
    got = {r.conv_id: r for r in tool_calls.query(spark, SMALL).collect()}
    turns = defaultdict(dict)
    for r in rows:
        turns[r.conv_id][r.turn] = r
    assert set(got) == set(turns)
    for conv, by_turn in turns.items():
        asked = [r for r in by_turn.values() if r.role == "user"]
        answered = [r for r in asked if r.turn + 1 in by_turn and by_turn[r.turn + 1].role == "assistant"]
        valid = [r for r in answered if len(r.text) >= 20 and 1 <= r.turn <= 6]
        assert (got[conv].n_calls, got[conv].n_ok, got[conv].n_invalid) == (len(asked), len(valid), len(answered) - len(valid))
        document = json.loads(got[conv].document)
        assert [m["content"] for m in document["messages"]] == [by_turn[t].text for t in sorted(by_turn)]
        assert [c["result"] for c in document["tool_calls"]] == [by_turn[r.turn + 1].text for r in sorted(answered, key=lambda r: r.turn)]


# ---- packing -------------------------------------------------------------------------------------------


def plain_ids(text):
    found = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode(text or "", add_special_tokens=False).ids
    return [*found, 2]


def check_packing(rows, pieces, most):
    sequences, whole = defaultdict(list), defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length))
        whole[p.doc_id].append(p)
    for placed in sequences.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= most
    for doc_id, text in rows:
        ids = plain_ids(text)
        own = sorted(whole[doc_id], key=lambda p: p.piece)
        assert [p.piece for p in own] == list(range(-(-len(ids) // most)))
        assert all(p.length == most for p in own[1:]) and sum(p.length for p in own) == len(ids)
        for p in own:
            assert p.ids_crc32 == packing.crc32_of(ids[p.start : p.start + p.length])
    total = sum(p.length for p in pieces)
    return len(sequences), -(-total // most)


def test_documents_are_packed(spark, documents):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    used, least = check_packing(rows, packing.packed(documents).collect(), 1024)
    assert used <= least * 1.02 + 1


def test_odd_documents_are_packed(spark, odd_docs, no_docs):
    single = odd_docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    rows = [tuple(r) for r in single.select("doc_id", "text").collect()]
    check_packing(rows, packing.packed(single).collect(), 1024)
    all_rows = packing.packed(odd_docs)
    assert all_rows.groupBy("sequence_id").agg({"length": "sum"}).where("`sum(length)` > 1024").isEmpty()
    assert packing.packed(no_docs).count() == 0


def test_sequences_hold_the_ids(spark):
    docs = spark.createDataFrame([(i, "a few words " * i) for i in range(40)], "doc_id long, text string")
    path = public_tokenizers.path("byte_bpe_50k.json")
    pieces = packing.tokenised(docs, path, 2, 32)
    found = packing.sequences(pieces, packing.packed(docs, path, 32)).collect()
    ids = Counter(x for r in found for x in np.frombuffer(r.ids, "<u4").tolist())
    assert ids == Counter(x for i in range(40) for x in plain_ids("a few words " * i))
    assert max(len(r.ids) for r in found) <= 4 * 32


def test_best_fit_plans_by_counts():
    random.seed(2)
    for _ in range(50):
        most = random.choice([5, 10, 64])
        counts = {k: random.randint(1, 30) for k in random.sample(range(1, most + 1), random.randint(1, min(most, 12)))}
        steps = packing.best_fit(counts, most)
        filled, sizes = defaultdict(int), defaultdict(list)
        for length, lo, hi, first, offset, per in steps:
            for r in range(lo, hi):
                sequence, nth = divmod(r - lo, per)
                assert filled[first + sequence] == offset + nth * length
                filled[first + sequence] += length
            sizes[length] += range(lo, hi)
        assert max(filled.values()) <= most and {k: sorted(v) for k, v in sizes.items()} == {k: list(range(n)) for k, n in counts.items()}
        # best fit, one by one
        rooms = []
        for length in sorted((k for k, n in counts.items() for _ in range(n)), reverse=True):
            fits = [i for i, r in enumerate(rooms) if r >= length]
            if fits:
                rooms[min(fits, key=lambda i: rooms[i])] -= length
            else:
                rooms.append(most - length)
        assert len(filled) == len(rooms)


def test_fast_merges_equal_tokenizers(documents):
    tokens = packing.Tokens(public_tokenizers.path("byte_bpe_50k.json"))
    assert tokens.fast is not None
    texts = [r.text for r in documents.collect()] + ["", "  a  b\n\n c\t", "don't I'll 12,5€ “x” … 漢字 \U0001f600", "<|endoftext|> a", "a" * 5000]
    for text in texts:
        assert np.frombuffer(tokens.of(text), "<u4").tolist() == plain_ids(text)[:-1]


# ---- mixing --------------------------------------------------------------------------------------------


def level_targets(sizes, weights, share, cap):
    """Excess over the caps is shared again and again by weight."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    whole, full = share * sum(sizes.values()), set()
    while True:
        rest = whole - sum(cap * sizes[s] for s in full)
        open_weight = sum(weight[s] for s in names if s not in full)
        target = {s: cap * sizes[s] if s in full else rest * weight[s] / open_weight for s in names}
        above = {s for s in names if s not in full and target[s] > cap * sizes[s]}
        if not above or len(full | above) == len(names):
            return {s: min(t, cap * sizes[s]) for s, t in target.items()}
        full |= above


def test_mix_meets_its_targets(spark, documents):
    docs = documents.selectExpr("doc_id", "text", "CASE WHEN doc_id % 3 = 0 THEN 'hot' WHEN doc_id % 7 = 0 THEN NULL ELSE source END AS source")
    got = mixing.mix(docs).collect()
    sizes = {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
    want = level_targets(sizes, (5, 2, 1), 1.5, 2.0)
    for source, target in want.items():
        own = [r for r in got if r.source == source]
        assert own[0].source_size == sizes[source] and own[0].target == pytest.approx(target)
        assert sum(r.taken for r in own) == pytest.approx(target, abs=0.51)
        assert all(0 <= r.taken <= 2 * r.size for r in own)
    assert sorted(got) == sorted(mixing.mix(docs.repartition(3)).collect())
    copies = mixing.mixed_documents(docs)
    assert copies.columns == docs.columns
    n = Counter(r.doc_id for r in copies.collect())
    assert all(n[r.doc_id] == (math.floor(r.taken / r.size + 0.5) if r.size else 0) for r in got)


def test_odd_documents_are_mixed(odd_docs, no_docs):
    got = mixing.mix(odd_docs).collect()
    assert len(got) == odd_docs.count()
    assert all(r.taken == 0 for r in got if not r.size) and sum(r.taken for r in got) > 0
    assert mixing.mix(no_docs).count() == 0
    assert mixing.mixed_documents(odd_docs.selectExpr("*", "1 AS _id", "2 AS size", "3 AS doc")).columns[-3:] == ["_id", "size", "doc"]
    assert mixing.mixed_documents(no_docs).count() == 0


# ---- search --------------------------------------------------------------------------------------------


def brute_top(rows, k):
    usable = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    found = []
    for place, (i, q) in enumerate(usable):
        if i % 100 == 0:
            scored = [(-sum(a * b for a, b in zip(q, c, strict=True)), j) for at, (j, c) in enumerate(usable) if at != place and len(c) == len(q)]
            found += [(i, n + 1, j, -s) for n, (s, j) in enumerate(sorted(scored)[:k])]
    return Counter(found)


@pytest.mark.parametrize("sizes", [(1024, 1024), (2, 7)])
def test_top_k_equals_brute_force(spark, sizes):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=40).round(2).tolist()) for i in range(350)]
    rows += [(i, [0.5] * 40) for i in range(350, 380)] + [(400, None), (500, [math.nan] * 40), (600, [None] * 40), (700, [math.inf] + [0.0] * 39), (None, [1.0] * 40)]
    rows += [(800, [1.0, 2.0]), (801, [2.0, 1.0]), (900, []), (0, rows[0][1]), (1000, [2.0**33] * 3), (1001, [2.0**20] * 3)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = topk.top_k(vectors, "vec_id % 100 = 0", 10, *sizes).where("query_id <> 1000").collect()
    want = brute_top([r for r in rows if r[0] not in (1000, 1001)], 10)
    assert Counter(tuple(r) for r in got) == want
    assert topk.top_k(vectors.where("false"), "vec_id % 100 = 0").count() == 0


def test_bounds_cut_the_work():
    rng = np.random.default_rng(1)
    scale = np.exp(-np.arange(64) / 8)
    block = np.floor(rng.normal(size=(64, 2000)) * scale[:, None] * 1024).astype(np.int64)
    asked = block[:, :5].copy()
    best = topk.Best(5, 10)
    done = topk.search_block(asked, np.arange(5), block, np.arange(2000), np.arange(2000), best)
    scores = asked.T @ block
    scores[np.arange(5), np.arange(5)] = -(2**62)
    assert (best.score == -np.sort(-scores, 1)[:, :10]).all()
    assert done < 0.7 * 5 * 2000 * 64


def test_bounds_cut_the_work_on_clusters():
    """Later blocks of a part meet the scores of the first; single pairs are carried on where few are left."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(64, 40))
    vectors = centres[:, rng.integers(0, 40, 4096)] + 0.3 * rng.normal(size=(64, 4096))
    vectors = np.floor(vectors / np.linalg.norm(vectors, axis=0) * 1024).astype(np.int64)
    asked, best, done, rows = vectors[:, :32].copy(), topk.Best(32, 10), 0, np.arange(4096)
    for at in range(0, 4096, 512):
        some = slice(at, at + 512)
        done += topk.search_block(asked, np.arange(32), vectors[:, some].copy(), rows[some], rows[some], best)
    scores = asked.T @ vectors
    scores[np.arange(32), np.arange(32)] = -(2**62)
    assert (best.score == -np.sort(-scores, 1)[:, :10]).all()
    assert done < 0.7 * 32 * 4096 * 64
