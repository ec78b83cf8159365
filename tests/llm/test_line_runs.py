"""Repeated runs of lines against brute force that knows no chunks."""

import hashlib
import random

from changeflow.llm import line_chunks
from changeflow.llm.queries import QUERIES


def left_of(rows: list[tuple[int, str | None]], least: int = 2) -> dict[int, bytes]:
    """doc_id: the bytes left; of texts by doc_id, a line goes if it is in a run that began before, apart from it."""
    first, found = {}, {}
    for d, text in sorted(rows):
        lines = (text or "").encode().splitlines(keepends=True)
        bare = [x.rstrip(b"\n") for x in lines]
        gone = set()
        for i in range(len(lines) - least + 1):
            where, at = first.setdefault(tuple(bare[i : i + least]), (d, i))
            if where != d or at + least <= i:
                gone.update(range(i, i + least))
        found[d] = b"".join(x for i, x in enumerate(lines) if i not in gone)
    return found


def test_planted_passages_all_go(spark):
    random.seed(17)
    rows, passages = [], []
    for d in range(60):
        own = [f"own {d} {i} " + "w " * 30 for i in range(random.randint(0, 5))]
        at = random.randint(0, len(own))
        passage = passages[d - 30] if d >= 30 else [f"shared {d} {i} " + "v " * 30 for i in range(2 + d % 7)]
        passages.append(passage)
        rows.append((d, "\n".join(own[:at] + passage + own[at:]) + ("\n" if d % 2 else "")))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in line_chunks.without_repeated_runs(docs).collect()}
    for d in range(60):
        assert got[d].n_removed_lines == (len(passages[d]) if d >= 30 else 0)
        assert "shared" not in got[d].text or d < 30
    assert {d: r.text.encode() for d, r in got.items()} == left_of(rows)


def test_runs_of_odd_rows(spark, odd_docs, no_docs):
    rows = [(1, "a\na\na\na\na"), (2, "\n\n\n"), (3, "x\na\na"), (4, "y\nz"), (5, "q\ny\nz\n"), (6, None), (7, ""), (8, "z")]
    got = {r.doc_id: r for r in line_chunks.without_repeated_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {d: (r.text or "").encode() for d, r in got.items()} == left_of(rows)
    assert got[1].n_removed_lines == 3 and got[5].text == "q\n" and got[6].text is None and got[7].text == ""
    odd = line_chunks.without_repeated_runs(odd_docs)
    assert odd.columns[:5] == odd_docs.columns and odd.count() == odd_docs.count()
    assert line_chunks.without_repeated_runs(no_docs).count() == 0


def test_registered_query_finds_all_runs(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = {d: hashlib.sha256(b).hexdigest() for d, b in left_of(rows).items()}
    assert {r.doc_id: r.kept_sha256 for r in QUERIES["op5_line_chunks"](spark, sf).collect()} == want
