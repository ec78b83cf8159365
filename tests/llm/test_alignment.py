"""Token alignment against plain Python: cuts where both tokenizers end, counts over all documents."""

import hashlib
from bisect import bisect_right
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from changeflow.llm import alignment as al

NAMES = "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()


@pytest.fixture(scope="module")
def tokenizers():
    return al.Tokenizers(*al.paths(None, None))


def ids_of(tokenizers, text):
    """Both sides' ids by the plain libraries, none where they do not spell the text."""
    if not text:
        return [], []
    a = tokenizers.slow.encode(" " + text, add_special_tokens=False).ids
    b = tokenizers.pieces.encode(text, num_threads=1)
    whole = (" " + text).encode()
    if b"".join(tokenizers.a_bytes[i] for i in a) != whole or b"".join(tokenizers.b_bytes[i] for i in b) != whole:
        return [], []
    return a, b


def plain_groups(tokenizers, text):
    a, b = ids_of(tokenizers, text)
    ends = [np.cumsum([0] + [len(t[i]) for i in x]).tolist() for x, t in ((a, tokenizers.a_bytes), (b, tokenizers.b_bytes))]
    cuts = sorted(set(ends[0]) & set(ends[1]))
    groups = [([], []) for _ in cuts[1:]]
    for side, (x, e) in enumerate(((a, ends[0]), (b, ends[1]))):
        for i, start in zip(x, e):
            groups[bisect_right(cuts, start) - 1][side].append(i)
    return a, b, groups


def plain(tokenizers, docs):
    seen, found = Counter(), []
    for doc_id, text in docs:
        a, b, groups = plain_groups(tokenizers, text)
        links = Counter()
        for x, y in groups:
            for i, n in Counter(x).items():
                for j, m in Counter(y).items():
                    links[i, j] += n * m
        seen.update(links.keys())
        spelled = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        found.append((doc_id, len(a), len(b), len(groups), links, hashlib.sha256(spelled.encode()).hexdigest() if spelled else ""))
    most = defaultdict(int)
    for (i, _), n in seen.items():
        most[i] = max(most[i], n)
    return sorted(
        (str(d), na, nb, g, sum(l.values()), sum(n for p, n in l.items() if seen[p] == most[p[0]]), sum(n * seen[p] for p, n in l.items()), s)
        for d, na, nb, g, l, s in found
    )


def rows_of(df):
    return sorted((str(r[0]), *r[1:]) for r in df.select(*NAMES).collect())


EXTRA = [
    (20, "<|endoftext|> and </s> <unk> <s> <0x41> are plain text", None, None, 0),
    (21, "  two  spaces\t\ttabs\r\n\n\nand no-break 　", None, None, 0),
    (22, "▁ marks a word in the other ▁file", None, None, 0),
    (23, "\x00\x01 control ﻿​ é \U0001f469‍\U0001f469 ﬁ Ⅷ ½", None, None, 0),
    (24, "ab" * 300 + "äöü漢字" * 200, None, None, 0),
    (25, "supercalifragilistic " * 50, None, None, 0),
]


@pytest.mark.parametrize("frequent", [4, 1 << 18])
def test_odd_rows(spark, odd_docs, no_docs, tokenizers, monkeypatch, frequent):
    """With few pairs looked up and most joined, and the other way round."""
    monkeypatch.setattr(al, "FREQUENT", frequent)
    docs = odd_docs.unionByName(spark.createDataFrame(EXTRA, odd_docs.schema))
    clash = docs.withColumn("row", F.lit("x")).withColumn("pairs", F.lit(1)).withColumn("n_a", F.lit(None).cast("string"))
    assert rows_of(al.aligned(clash)) == plain(tokenizers, [(r.doc_id, r.text) for r in docs.collect()])
    if frequent == 4:
        assert al.aligned(no_docs).count() == 0
        assert al.alignment_groups(no_docs).count() == 0


def test_documents(spark, documents, tokenizers):
    assert rows_of(al.query(spark, "/root/testdata/sf0.001")) == plain(tokenizers, [(r.doc_id, r.text) for r in documents.collect()])


def test_groups(spark, odd_docs, tokenizers):
    got = defaultdict(list)
    docs = odd_docs.where("doc_id <> 6 AND doc_id IS NOT NULL").unionByName(spark.createDataFrame(EXTRA, odd_docs.schema))
    for r in al.alignment_groups(docs).orderBy("doc_id", "group").collect():
        got[r.doc_id].append(r)
    for doc_id, text in [(r.doc_id, r.text) for r in docs.collect()]:
        groups = plain_groups(tokenizers, text)[2]
        rows = got.get(doc_id, [])
        assert [(r.a_ids, r.b_ids) for r in rows] == groups
        assert [r.group for r in rows] == list(range(len(rows)))
        for r in rows:
            raw = b"".join(tokenizers.a_bytes[i] for i in r.a_ids)
            assert (" " + text).encode()[r.start : r.end] == raw


def test_links_in_blocks(tokenizers, monkeypatch):
    """A wide group that repeats its ids, expanded over a few links at a time."""
    texts = ["ab" * 400 + "äöü漢字" * 300, None, "x" * 5000, "plain words"]
    whole = [x.tolist() for x in al.Aligned(tokenizers, texts).links()]
    monkeypatch.setattr(al, "LINKS", 7)
    monkeypatch.setattr(al, "PLAIN", 1)
    x = al.Aligned(tokenizers, texts)
    assert [v.tolist() for v in x.links()] == whole
    assert sum(whole[2]) == x.links_per_text().sum() == (x.a_in * x.b_in).sum()


def test_fast_and_plain_ids_agree(tokenizers, documents, odd_docs):
    texts = [r.text for r in documents.union(odd_docs).collect()] + [e[1] for e in EXTRA]
    for text in texts:
        assert tokenizers.of(text) == ids_of(tokenizers, text)
