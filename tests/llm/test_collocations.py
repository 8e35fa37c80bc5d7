"""Phrase collocations against a brute-force statement of their contract."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperflow.llm import collocations as co

RNG = random.Random(11)
VOCAB = ["alpha", "Beta", "gamma", "de", "la", "é", "x\x85y", "o'neil", "\x1c", "a\xa0b", "tail"]
SCHEMA = "doc_id long, text string, lang string, w1 string, c long, k int, n long"


def rows():
    def said(n):
        return "".join(RNG.choice(VOCAB) + RNG.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\r\n", ";!"]) for _ in range(n))

    texts = [None, "", " .,;", "one", "new york city hall tower " * 40, "NEW YORK, new york city. " * 30, "a a a a a a a " * 20,
             "z" * 20_000, "tail", said(5_000)] + [said(RNG.randint(1, 300)) for _ in range(50)]
    out = [(k, t, [None, "en", "und", "fr"][k % 4]) for k, t in enumerate(texts)]
    out += [(4, texts[4], "en")] * 2 + [(None, texts[5], "de")]
    return [(*r, "w", 3, 4, 5) for r in out]


ROWS = rows()


def counts(data, order):
    n, f = Counter(), Counter()
    for _, text, lang, *_ in data:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\x0a-\x0d]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i:i + k])) for k in range(1, order + 1) for i in range(len(w) - k + 1))
    return n, f


def brute(data, order=5, least=100, top=2000, share=100):
    n, f = counts(data, order)
    candidates = {p: a for p, a in f.items() if len(p[1]) >= 2 and a >= least}
    out = {}
    for (lang, w), a in candidates.items():
        if any(lang == la and len(w) < len(x) and 100 * b >= share * a and any(x[i:i + len(w)] == w for i in range(len(x)))
               for (la, x), b in candidates.items()):
            continue
        score, _, left, right = min((1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]])
                                    for k in range(1, len(w)))
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), left, right))
    return {(lang, k + 1, p.decode(), -a, left, right, n[lang], -s) for lang, own in out.items()
            for k, (s, a, p, left, right) in enumerate(sorted(own)[:top])}


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("co") / "d")
    spark.createDataFrame(ROWS, SCHEMA).repartition(5).write.parquet(path)
    return spark.read.parquet(path)


def sequence(lang, words):
    own = co.Sequence(lang)
    own.add(words)
    return own.close()


def found(df):
    return [tuple(r) for r in df.drop("k").collect()]


@pytest.mark.parametrize("order,least,top,share,chunk", [(5, 100, 2000, 100, 1 << 20), (5, 20, 7, 100, 64), (3, 5, 50, 60, 1000)])
def test_same_as_brute_force(docs, monkeypatch, order, least, top, share, chunk):
    monkeypatch.setattr(co, "CHUNK", chunk)
    monkeypatch.setattr(co, "BUCKET", chunk)
    got, want = found(co.collocations(docs, order, least, top, share)), brute(ROWS, order, least, top, share)
    assert len(got) == len(want) and set(got) == want and len(want) > 4


def test_wrong_hits_in_the_table_change_nothing(spark, docs, monkeypatch):
    full = np.full(1 << (co.TABLE_BITS - 3), 255, np.uint8)
    monkeypatch.setattr(co, "bit_table", lambda docs, least, buckets: spark.sparkContext.broadcast(full))
    assert set(found(co.collocations(docs, 5, 20, 30))) == brute(ROWS, 5, 20, 30)


def test_the_table_holds_what_is_frequent(docs):
    table = co.bit_table(docs, 30, 3).value
    _, f = counts(ROWS, 3)
    for lang in ("en", "und", "fr", "de"):
        said = [w for (la, w), _ in f.items() if la == lang]
        for order in (1, 2, 3):
            grams = [w for w in said if len(w) == order]
            own = sequence(lang, [x for w in grams for x in (*(y.encode() for y in w), b"\xff")])
            at = np.arange(0, len(grams) * (order + 1), order + 1)
            inside = set(own.frequent(at, order, table).tolist())
            assert {a for a, w in zip(at.tolist(), grams) if f[lang, w] >= 30} <= inside
            assert len(inside) < 1.1 * sum(f[lang, w] >= 30 for w in grams) + 1


def test_rollup_gives_every_order(docs):
    n, f = counts(ROWS, 4)
    got = {(r.lang, tuple(r.words), r.f) for r in co.marginals(co.counted_windows(docs, 4, buckets=3), 4, 1).collect()}
    assert got == {(la, w, c) for (la, w), c in f.items()} | {(la, (), c) for la, c in n.items() if c}


def test_windows_end_before_what_is_rare():
    words = co.words_and_ends(b"A b c d. a b\tc x; y")
    assert words == [b"a", b"b", b"c", b"d", b"\xff", b"a", b"b", b"c", b"x", b"\xff", b"y", b"\xff"]
    own, table = sequence("en", words), np.zeros(1 << (co.TABLE_BITS - 3), np.uint8)
    for order, starts in ((1, [0, 1, 2, 3]), (2, [0, 1, 2]), (3, [0])):
        for at in co.table_bits(co.gram_hashes(own.hashes, np.array(starts), order)).ravel():
            table[int(at) >> 3] |= 1 << (int(at) & 7)
    lead, c = co.lead_windows(own, 4, table)
    got = {tuple(own.vocabulary[x].decode() if x else None for x in col): n for col, n in zip(lead.T, c)}
    assert got == {("a", "b", "c", None): 2, ("b", "c", None, None): 2, ("c", "d", None, None): 1, ("c", None, None, None): 1,
                   ("d", None, None, None): 1, (None,) * 4: 2}


def test_exact_beyond_64_bits(spark):
    cases = [(10**13, 3 * 10**13, 10**13 + 1, 10**13 + 7), (100, 10**12, 100, 101), (99_999, 7, 123_457, 1), (1, 1, 1000, 1)]
    df = spark.createDataFrame(cases, "a long, n long, l long, r long")
    got = [r[0] for r in df.select(co.association(F.col("a"), F.col("n"), F.col("l"), F.col("r"))).collect()]
    assert got == [1000 * a * n // (left * right) for a, n, left, right in cases]


def test_empty(spark, docs):
    assert co.collocations(spark.createDataFrame([], SCHEMA)).count() == 0
    assert co.collocations(docs.filter("doc_id < 3")).count() == 0
