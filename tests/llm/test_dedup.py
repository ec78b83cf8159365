"""Exact, near, line and substring dedup against brute force."""

import hashlib
import random
import re
from collections import Counter

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from changeflow.llm import components, exact_dedup, jaccard, line_chunks, shingles, suffix_dedup


def test_exact_groups_of_odd_rows(odd_docs, no_docs):
    rows = exact_dedup.exact_groups(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    kept = {r.text_sha256: r for r in rows if r.kept}
    assert len(kept) == sum(r.kept for r in rows)
    for r in rows:
        same = [x for x in rows if x.text_sha256 == r.text_sha256]
        assert r.group_size == len(same)
        assert r.keep_id == min((x.doc_id for x in same if x.doc_id is not None), default=None)
    blank = hashlib.sha256(b" ").hexdigest()
    assert {r.doc_id for r in rows if r.text_sha256 == blank} == {3}
    assert {r.doc_id for r in rows if r.text_sha256 == hashlib.sha256(b"").hexdigest()} == {1, 2, None}
    assert exact_dedup.exact_groups(no_docs).count() == 0
    left = exact_dedup.without_copies(odd_docs)
    assert left.columns == odd_docs.columns
    assert left.count() == len(kept)
    assert exact_dedup.without_copies(left).count() == len(kept)


@pytest.mark.parametrize("fan_in", [2, 3, 32])
def test_runs_merge_over_any_tree(spark, fan_in):
    leaves = spark.range(0, 4000, 1, 9).select(
        F.col("id").alias("doc_id"),
        F.unhex(F.sha2((F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 700)).cast("string"), 384)).alias("print"),
        F.col("id").alias("row"),
        F.spark_partition_id().alias("run"),
    )
    got = {(bytes(r.print), r.keep_id, r.n) for r in exact_dedup.merged_runs(leaves, 5, fan_in).collect()}
    want = leaves.groupBy("print").agg(F.min("doc_id").alias("k"), F.count("*").alias("n")).collect()
    assert got == {(bytes(r.print), r.k, r.n) for r in want}


def test_shingle_sets_have_the_right_sizes():
    random.seed(1)
    for _ in range(300):
        text = "".join(random.choice(["a", "B", "b", "é", " ", "\n", "\x0b", " ", "."]) for _ in range(random.randint(0, 80)))
        assert len(shingles.shingle_set(text)) == len(brute.shingles(text)), text
    assert (shingles.shingle_set("A b c D e f") == shingles.shingle_set(" a  B C d\te F\n")).all()


def near_rows():
    """Copies with few and many changes, a chain, a passage that many share, a large group of near copies."""
    random.seed(7)
    words = [f"w{i}" for i in range(4000)]
    rows, n = [], 0
    passage = random.choices(words, k=60)
    for base in range(25):
        text = random.choices(words, k=random.randint(1, 200))
        for copy in range(random.choice([1, 2, 6])):
            changed = list(text)
            for _ in range(copy * len(text) // 60):
                changed[random.randrange(len(changed))] = random.choice(words)
            rows.append((n, " ".join(changed)))
            n += 1
    chain = random.choices(words, k=120)
    for _ in range(12):
        rows.append((n, " ".join(chain)))
        chain = chain[6:] + random.choices(words, k=6)
        n += 1
    for _ in range(60):
        rows.append((n, " ".join(random.choices(words, k=random.randint(5, 40)) + passage)))
        n += 1
    big = random.choices(words, k=150)
    for _ in range(150):
        one = list(big)
        one[random.randrange(150)] = random.choice(words)
        rows.append((n, " ".join(one)))
        n += 1
    rows += [(n, None), (n + 1, ""), (n + 2, " \n"), (n + 3, "a b"), (n + 4, "A\tb"), (n + 5, "b a")]
    random.shuffle(rows)
    return rows


@pytest.mark.parametrize("limits", [{}, {"LIST": 16, "BLOCK": 4, "MEETINGS": 5, "STAR_TURNS": 0, "COUNTED": 64}, {"STAR_TURNS": 0, "OFTEN": 2, "PAIRS": 50}])
def test_near_groups_equal_brute_force(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(jaccard, name, value)
    rows = near_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_groups(docs).collect()}
    assert got == brute.near_components(rows)


def test_near_groups_without_stars_are_found_by_the_index(spark, monkeypatch):
    """The index alone must find every link."""
    monkeypatch.setattr(jaccard, "stars", lambda nodes: nodes.select(F.col("node").alias("s"), F.col("node").alias("t")).where("false"))
    rows = [r for r in near_rows() if r[1] is None or len(r[1]) < 3000][:250]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_groups(docs).collect()}
    assert got == brute.near_components(rows)


def split_families():
    """Two families of sets of numbered words whose leaders do not link, though some of their members do."""
    random.seed(11)
    words = [f"w{i}" for i in range(400)]
    base = words[:160]
    far = base[:128] + [f"x{i}" for i in range(32)]
    rows, n = [], 0
    for start in (base, far):
        for step in range(40):
            text = list(start)
            for _ in range(step % 9):
                text[random.randrange(len(text))] = f"y{random.randrange(10_000)}"
            if start is base:
                text = text[: 160 - step % 30]
            rows.append((n, " ".join(text)))
            n += 1
    return rows


@pytest.mark.parametrize("turns", [0, 1])
def test_members_link_where_leaders_do_not(spark, monkeypatch, turns):
    monkeypatch.setattr(jaccard, "STAR_TURNS", turns)
    rows = split_families()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_groups(docs).collect()}
    assert got == brute.near_components(rows)


def test_many_near_copies_make_few_candidates(spark, monkeypatch):
    """Of 2000 near copies no pair of families is left when the index is searched, or hardly any."""
    random.seed(5)
    base = [f"w{random.randrange(5000)}" for _ in range(200)]
    rows = []
    for i in range(2000):
        text = list(base)
        for _ in range(1 + i % 2):
            text[random.randrange(200)] = f"z{random.randrange(10**6)}"
        rows.append((i, " ".join(text)))
    seen = []
    whole = jaccard.candidates
    monkeypatch.setattr(jaccard, "candidates", lambda lists, tags: seen.append(whole(lists, tags)) or seen[-1])
    got = jaccard.near_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(8)).collect()
    assert {r.component_id for r in got} == {0}
    assert seen[0].count() <= 2000


@pytest.mark.parametrize("short", [0, 3, 1000])
def test_lists_are_paired_alike_at_once_or_by_blocks(monkeypatch, short):
    rng = np.random.default_rng(3)
    monkeypatch.setattr(jaccard, "SHORT", short)
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    sizes = rng.integers(1, 30, 40)
    begins = np.cumsum(sizes) - sizes
    n = np.concatenate([np.sort(rng.integers(4, 40, k)) for k in sizes])
    first = (n * rng.random(len(n)) / 4).astype(np.int64)
    last, component = first + rng.integers(0, 3, len(n)), rng.integers(0, 4, len(n))
    x, begin, of = jaccard.pairs_of_lists(n, first, last, component, begins)
    want = set()
    for k, (a, size) in enumerate(zip(begins.tolist(), sizes.tolist())):
        for i in range(a, a + size):
            for j in range(i + 1, a + size):
                after, need = 7 * min(n[i] - first[i], n[j] - first[j]), 3 * (n[i] + n[j])
                if component[i] != component[j] and 4 * n[i] >= 3 * n[j] and after + 7 * min(last[i], last[j]) >= need:
                    want.add((i, j, bool(after >= need), k))
    assert {(int(i), int(j), bool(b), int(k)) for (i, j), b, k in zip(x, begin, of)} == want and len(x) == len(want)


def test_frequent_shingles_come_last():
    often = np.array([5, 2**63 + 8], np.uint64), np.array([1, 0], np.uint64)
    tokens = jaccard.in_order(np.array([5, 2**63 + 8, 2**64 - 1, 0], np.uint64), often)
    assert tokens.tolist() == [2**63 + 1, 2**63, 2**63 - 1, 0]


def test_counts_of_shingles_are_over_distinct_sets():
    counter = jaccard.Counter()
    flat, own, node = np.array([1, 2, 3, 2, 3, 1, 2, 3], np.uint64), np.array([0, 3, 5, 8]), np.array([7, 8, 7])
    counter.add(flat, own, node)
    counter.settle()
    assert dict(zip(counter.keys.tolist(), counter.n.tolist())) == {2: 2, 3: 2}


def test_near_groups_of_odd_rows(odd_docs, no_docs):
    got = jaccard.near_groups(odd_docs).collect()
    assert len(got) == odd_docs.count()
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by_id[1].component_id == 1 and by_id[2].component_id == 2 and by_id[3].n_shingles == 0
    assert by_id[5].component_id == 4 and by_id[7].component_id == 6 and by_id[8].n_shingles == 1
    assert jaccard.near_groups(no_docs).count() == 0


def test_components_of_paths_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200, 201), (201, 202), (202, 200), (7, 7)]
    random.seed(3)
    names = list(range(1000))
    random.shuffle(names)
    edges = [(names[a], names[b]) for a, b in edges]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    for members in (range(41), range(100, 140), range(200, 203)):
        ids = [names[m] for m in members]
        assert {got[i] for i in ids} == {min(ids)}


# ---- lines ---------------------------------------------------------------------------------------------


def line_rows():
    random.seed(11)
    lines = [f"line {i} of some length" for i in range(400)]
    passage = lines[:25]
    rows = []
    for d in range(40):
        own = [random.choice(lines[25:]) for _ in range(random.randint(0, 20))]
        at = random.randint(0, len(own))
        rows.append((d, "\n".join(own[:at] + (passage if d % 3 else []) + own[at:]) + ("\n" if d % 2 else "")))
    return [*rows, (40, None), (41, ""), (42, "\n\n\n"), (43, rows[5][1])]


def test_line_chunks_equal_brute_force(spark):
    rows = line_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in line_chunks.without_repeats(docs).collect()}
    want = brute.chunk_repeats(rows, line_chunks.chunks_of)
    assert {d: (r.text or "").encode() for d, r in got.items()} == want
    assert sum(r.n_removed_lines for r in got.values()) > 200
    assert got[40].text is None and got[41].text == ""
    assert got[43].n_removed_lines == sum(n for n, _ in line_chunks.chunks_of(rows[43][1]) if n > 1)  # a copied text


def test_boundaries_resist_shifts():
    lines = [b"%d" % (i * i) for i in range(300)]
    ends = set(line_chunks.boundaries(lines))
    shifted = {e - 2 for e in line_chunks.boundaries([b"x", b"y", *lines])}
    assert len(ends ^ shifted) <= 2 * line_chunks.WINDOW
    assert b"".join(c for _, c in line_chunks.chunks_of("a\nb\n\nc")) == b"a\nb\n\nc"


def test_line_chunks_of_odd_rows(odd_docs, no_docs):
    got = line_chunks.without_repeats(odd_docs)
    assert got.columns[:5] == odd_docs.columns and got.count() == odd_docs.count()
    assert line_chunks.without_repeats(no_docs).count() == 0


# ---- substrings ----------------------------------------------------------------------------------------


def test_deep_shallow_sorts(monkeypatch):
    random.seed(5)
    for shallow in (0, 3, 8, 100):
        for letters in ("ab", "abcdefgh"):
            strings = ["".join(random.choices(letters, k=12)) for _ in range(200)]
            strings = [s[:6] * 2 if i % 3 else s for i, s in enumerate(strings)]
            pairs = [(s.encode(), i) for i, s in enumerate(strings)]
            got = list(suffix_dedup.deep_shallow(pairs, shallow))
            assert [s for s, _ in got] == sorted(set(s for s, _ in pairs))
            assert {s: sorted(i) for s, i in got} == {s: [i for t, i in pairs if t == s] for s, _ in got}


def test_anchors_cover_all_strings_and_agree(monkeypatch):
    rng = np.random.default_rng(2)
    texts = [rng.integers(97, 99, n, dtype=np.uint8).tobytes() for n in (10, 49, 50, 51, 0, 200, 80)]
    for chunk in (1, 100, 1 << 18):
        monkeypatch.setattr(suffix_dedup, "CHUNK", chunk)
        found = suffix_dedup.anchors(texts, 50)
        for d, text in enumerate(texts):
            own = np.flatnonzero(found.doc == d)
            covered = [i for k in own for i in range(found.first[k], found.end[k] - 49)]
            assert covered == list(range(max(0, len(text) - 49)))
            for k in own:
                for i in range(found.first[k], found.end[k] - 49):
                    one = suffix_dedup.anchors([text[i : i + 50]], 50)
                    assert one.anchor[0] == found.anchor[k] and one.shift[0] + i == found.first[k] + found.shift[k]
                again = suffix_dedup.anchors([b"zz" + text], 50)
                same = np.flatnonzero((again.first == found.first[k] + 2) & (again.end == found.end[k] + 2))
                assert all(again.context[same] == found.context[k])


def substring_rows():
    random.seed(13)
    words = ["".join(random.choices("abcdeé", k=random.randint(1, 8))) for _ in range(500)]
    passage = " ".join(random.choices(words, k=70))
    rows = []
    for d in range(60):
        text = " ".join(random.choices(words, k=random.randint(0, 60)))
        if d % 2:
            cut = random.randint(0, len(text))
            a, b = sorted(random.choices(range(len(passage)), k=2))
            text = text[:cut] + passage[a:b] + text[cut:]
        rows.append((d, text))
    rows += [(60, None), (61, ""), (62, "x" * 49), (63, "x" * 60), (64, "x" * 200), (65, rows[7][1]), (66, "la " * 300), (67, "la " * 200), (68, "la la " * 20)]
    random.shuffle(rows)
    return rows


@pytest.mark.parametrize("hot", [8192, 3])
def test_substrings_equal_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    rows = substring_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in suffix_dedup.without_repeats(docs).collect()}
    want = brute.without_repeats(rows)
    assert got == want
    assert sum(r[1] for r in want.values()) > 3000


def test_substrings_of_odd_rows(odd_docs, no_docs):
    got = suffix_dedup.without_repeats(odd_docs).collect()
    assert len(got) == odd_docs.count()
    repeated = [r for r in got if r.doc_id == 6]
    assert [r.n_removed for r in repeated] == [0, 0]
    assert [r.n_removed == r.n_bytes for r in got if r.doc_id == 7] == [True]
    assert Counter(r.n_removed > 0 for r in got if r.doc_id is None) == {True: 1, False: 1}
    assert suffix_dedup.without_repeats(no_docs).count() == 0


def test_queries_on_documents_equal_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    near = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.query(spark, sf).collect()}
    assert near == brute.near_components(rows)
    cut = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.query(spark, sf).collect()}
    assert cut == brute.without_repeats(rows)
    left = brute.chunk_repeats(rows, line_chunks.chunks_of)
    assert {r.doc_id: r.kept_sha256 for r in line_chunks.query(spark, sf).collect()} == {d: hashlib.sha256(b).hexdigest() for d, b in left.items()}
    words = re.compile(r"[\x20\x09-\x0D]+")
    exact = {r.doc_id: r.text_sha256 for r in exact_dedup.query(spark, sf).collect()}
    assert exact == {d: hashlib.sha256(words.sub(" ", t or "").encode()).hexdigest() for d, t in rows}


def test_sets_that_share_too_few_lists_are_no_pair(spark):
    """Two sets of 280 share four of the shingles at the start of their prefixes, but nothing else with anyone."""
    entries = [(t, node, 280, t - 1) for node in (1, 2) for t in (1, 2, 3, 4)]
    entries += [(100 + t, node, 280, 10 + t) for node in (3, 4) for t in range(60)]
    lists = spark.createDataFrame(entries, jaccard.ENTRY)
    tags = spark.createDataFrame([], "node long, component long, family long")
    assert {(r.s, r.t) for r in jaccard.candidates(lists, tags).collect()} == {(3, 4)}
    begins, could = jaccard.enough_open(np.full((2, 2), 280), np.zeros((2, 2), int), np.array([[4, 60], [60, 60]]))
    assert begins.tolist() == could.tolist() == [False, True]


def test_least_edited_set_leads_frequent_lists(spark):
    """Frequent shingles (negative) have the set with least before it as leader, whatever its hash."""
    entries = [(t - 2**63, node, 400, t + 5 * (node != 7)) for node in range(1, 40) for t in range(60)]
    tags = spark.createDataFrame([], "node long, component long, family long")
    got = {(r.s, r.t) for r in jaccard.list_stars(spark.createDataFrame(entries, jaccard.ENTRY), tags, 0).collect()}
    assert got == {(node, 7) for node in range(1, 40) if node != 7}


@pytest.mark.parametrize("short", [0, 1000])
def test_pairs_of_too_few_open_lists_are_dropped_within_blocks(monkeypatch, short):
    monkeypatch.setattr(jaccard, "SHORT", short)
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    rng = np.random.default_rng(4)
    n, begins = np.repeat(np.arange(280, 290), 5), np.array([0, 20])
    first, component = rng.integers(0, 30, 50), np.arange(50)
    before, after = rng.integers(0, 30, 50), rng.integers(0, 70, 50)
    every, may, of = jaccard.pairs_of_lists(n, first, first, component, begins)
    starts, could = jaccard.enough_open(n[every], before[every], after[every])
    x, begin, _ = jaccard.pairs_of_lists(n, first, first, component, begins, before, after)
    want = {(*p, b) for p, b in zip(map(tuple, every[could].tolist()), (may & starts)[could].tolist())}
    assert {(*p, b) for p, b in zip(map(tuple, x.tolist()), begin.tolist())} == want and 0 < len(x) < len(every)
