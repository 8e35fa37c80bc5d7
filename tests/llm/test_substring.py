"""Substring dedup against a brute-force statement of its contract."""

import hashlib
import random
import re

import numpy as np
import pytest

from paperflow.llm import substring_dedup as sd

RNG = random.Random(13)
WORDS = [f"w{k}" for k in range(40)]
SCHEMA = "doc_id long, text string, n_chars int, doc long, `key` long, `row` string, `at` int, _N_WORDS long, `a.b` int"


def prose(n):
    return " ".join(RNG.choice(WORDS) for _ in range(n))


def rows():
    passage, base = prose(55), prose(80)
    texts = [None, "", " \n\t", base, base, base.upper(), f"{prose(30)}\n{passage}\n{prose(10)}", passage, f"{passage} {passage}",
             base.replace(" ", " \n\x0b"), "x " * 200, prose(19), prose(20), "a" * 30_000, passage[3:], "é😀 \x00 " * 40,
             " ".join(base.split()[:30] + ["other"] + base.split()[30:]), f" {base}　", prose(4_000)]
    texts += [f"{prose(RNG.randint(0, 40))} {passage} {prose(RNG.randint(0, 40))}" for _ in range(30)]
    out = [(k, t) for k, t in enumerate(texts)]
    out += [(3, base), (3, base), (-5, passage), (None, base), (None, passage), (None, base), ((1 << 63) - 1, base), (7, base)]
    return [(k, t, 1, 1, 2, "r", 3, 4, 5) for k, t in out]


ROWS = rows()


def brute(size, data=ROWS):
    """(doc_id, text) -> (words, words removed, words kept); the place of a row is (doc_id, text)."""
    words = {(r[0], r[1] or ""): re.findall(r"[^\x20\x09-\x0D]+", r[1] or "") for r in data}
    first = {}
    order = sorted(words, key=lambda d: (d[0] is None, d[0] or 0))
    for d in order:
        for i in range(len(words[d]) - size + 1):
            first.setdefault(tuple(words[d][i:i + size]), (d, i))
    out = {}
    for d, w in words.items():
        gone = set()
        for i in range(len(w) - size + 1):
            if first[tuple(w[i:i + size])] != (d, i):
                gone.update(range(i, i + size))
        out[d] = (len(w), len(gone), [x for i, x in enumerate(w) if i not in gone])
    return out


def sha(words):
    return hashlib.sha256(" ".join(words).encode()).hexdigest()


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sub") / "d")
    spark.createDataFrame(ROWS, SCHEMA).repartition(4).write.parquet(path)
    return spark.read.parquet(path)


def few(words, size):
    return sd.rabin_karp(words, size) % np.uint64(3)


@pytest.mark.parametrize("size,rolling,chunk,bucket", [
    (20, sd.rabin_karp, 1 << 20, 1 << 21), (20, sd.rabin_karp, 50, 100), (5, sd.rabin_karp, 300, 100), (20, few, 1 << 20, 1 << 21)])
def test_same_as_brute_force(docs, monkeypatch, size, rolling, chunk, bucket):
    monkeypatch.setattr(sd, "CHUNK", chunk)
    monkeypatch.setattr(sd, "BUCKET", bucket)
    # Of rows with equal doc_id and different texts (doc_id 7, and null) either may come first.
    data = [r for r in ROWS if r[0] not in (7, None)]
    want = brute(size, data)
    got = sd.substring_dedup(docs.filter("doc_id is not null and doc_id != 7"), size, rolling)
    found = {(r.doc_id, r.text_in): r for r in got.join(
        docs.selectExpr("doc_id", "text text_in"), "doc_id").distinct().collect()}
    for (doc_id, text), (n, removed, kept) in want.items():
        r = found[doc_id, text or None] if (doc_id, text or None) in found else found[doc_id, text]
        assert (r._n_words, r._n_removed) == (n, removed), (doc_id, r)
        assert re.findall(r"[^\x20\x09-\x0D]+", r.text or "") == kept
        assert sum(x.end - x.start for x in r._removed) == removed
        assert all(a.end < b.start for a, b in zip(r._removed, r._removed[1:]))
    assert got.count() == len(data)


def test_rows_columns_and_nulls(docs):
    out = sd.substring_dedup(docs)
    assert out.columns == ["doc_id", "text", "n_chars", "doc", "key", "row", "at", "a.b", "_n_words", "_n_removed", "_removed"]
    got = out.collect()
    assert len(got) == len(ROWS)
    for r in got:
        assert (r.doc, r.key, r.row, r.at, r["a.b"]) == (1, 2, "r", 3, 5)
        assert r.n_chars == (len(r.text) if r._n_removed else 1)
    assert [r.text for r in got if r.doc_id == 0] == [None] and [r.text for r in got if r.doc_id == 1] == [""]
    # Repeated rows are one document, so the copy with the smallest doc_id stays whole, in all its rows.
    assert [r._n_removed for r in got if r.doc_id == 3] == [0, 0, 0]
    # A null doc_id comes last: of texts found elsewhere nothing is left.
    assert {r._n_removed for r in got if r.doc_id is None} == {55, 80}


def test_report_and_empty(spark, docs):
    want = brute(20)
    got = sd.report(sd.substring_dedup(docs.filter("doc_id between 8 and 40"))).collect()
    own = brute(20, [r for r in ROWS if r[0] is not None and 8 <= r[0] <= 40])
    assert {(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got} == {
        (d[0], n, gone, sha(kept)) for d, (n, gone, kept) in own.items()}
    assert want and sd.report(sd.substring_dedup(spark.createDataFrame([], SCHEMA))).count() == 0


def test_intervals_and_packing():
    assert sd.intervals([0, 1, 5, 25, 50], 20) == [(0, 45), (50, 70)]
    doc, key, at = np.array([1, 1, 2]), np.array([-7, -7, 9]), np.array([5, 9, 0])
    assert [x.tolist() for x in sd.unpack(*sd.pack(doc, key, at))] == [doc.tolist(), key.tolist(), at.tolist()]
    words = [b"a", b"b", b"a", b"b", b"a"]
    h = sd.rabin_karp(words, 2)[:, 0]
    assert h[0] == h[2] and h[1] == h[3] and h[0] != h[1] and len(sd.rabin_karp(words, 6)) == 0
