"""The corpus pipeline end to end, against what was planted: toxic texts go, later copies of a passage are cut,
one of each group of near copies stays, sources are mixed, texts are tokenized; and on empty or odd tables."""

import hashlib
import random
from collections import Counter

import corpus_pipeline
import public_tokenizers
import pytest
import sentencepiece

RNG = random.Random(29)
VOCAB = [a + b for a in "ba de ki lo mu ne po ra su ti vo we xi".split() for b in "nd rt ss x lm ck st".split()]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, _score double, taken long"
LABELS = "doc_id long, quality int, toxic int"
BAD = ["vexlotan", "grimtokus"]


def prose(n):
    return " ".join(RNG.choice(VOCAB) for _ in range(n))


def corpus():
    toxic = {k for k in range(400) if k % 5 == 1}
    texts = {k: f"{prose(30)} {RNG.choice(BAD) if k in toxic else RNG.choice(VOCAB)} {prose(30)}" for k in range(400)}
    passage = "\n".join(prose(14) for _ in range(5))
    for k in (402, 403, 404):
        texts[k] = f"{prose(40)}\n{passage}\n{prose(40)}"
    base = prose(300).split()
    for k in (410, 411, 412):
        texts[k] = " ".join([*base[:10 * (k - 409)], "other", *base[10 * (k - 409):]])
    texts |= {420: None, 421: "", 422: " \n\t", 423: "é中文😀 ▁ z", 424: prose(9_000)}
    return toxic, texts, passage


TOXIC, TEXTS, PASSAGE = corpus()


def write(spark, folder, docs, labels):
    rows = [(k, t, "en", [None, "a", "b"][(k or 0) % 3], len(t or ""), "r", 0.5, 1) for k, t in docs]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(str(folder / "documents.parquet"))
    spark.createDataFrame(labels, LABELS).write.parquet(str(folder / "labels.parquet"))
    return str(folder)


def test_stages_take_effect(spark, tmp_path):
    sf = write(spark, tmp_path, [*TEXTS.items(), (5, TEXTS[5])], [(k, 1, int(k in TOXIC)) for k in range(400)])
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:3]:
        after = stage(spark, docs, sf)
        assert after.columns == docs.columns, name
        docs = corpus_pipeline.staged(after, f"t-{name}")
    left = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert len(TOXIC & left.keys()) <= 0.05 * len(TOXIC)
    assert len({k for k in range(400) if k not in TOXIC} - left.keys()) <= 6
    assert PASSAGE in left[402] and left[403] == TEXTS[403].replace(PASSAGE + "\n", "") and left[404] == TEXTS[404].replace(PASSAGE + "\n", "")
    assert 410 in left and 411 not in left and 412 not in left and {420, 421, 422, 423, 424} <= left.keys()
    out = corpus_pipeline.run(spark, sf).collect()
    codec = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    copies = Counter(r["doc_id"] for r in out)
    assert copies.keys() <= left.keys() and max(copies.values()) <= 3 * 2  # document 5 is there twice
    for r in out:
        ids = codec.encode(left[r["doc_id"]] or "")
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(codec.decode(ids).encode()).hexdigest()
    again = corpus_pipeline.run(spark, sf).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))


@pytest.mark.parametrize("docs,labels,rows", [
    ([], [(1, 1, 1)], 0), ([], [], 0), ([(1, None), (2, ""), (None, None)], [], None), ([(1, prose(30)), (1, prose(30)), (2, None)], [(1, None, None)], None)])
def test_empty_and_odd_tables(spark, tmp_path, docs, labels, rows):
    out = corpus_pipeline.run(spark, write(spark, tmp_path, docs, labels))
    assert {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"} <= set(out.columns)
    assert rows is None or out.count() == rows
    assert out.collect() is not None
