"""Secret scans: fixed patterns, and character Markov models for strings without a pattern.

Two first-order models, of random strings and of ordinary words, are counted over a bounded
sample (what the patterns find and what they leave alone are the labels). A string whose
log-likelihood ratio is high per character and in total is reported beside the patterns' spans.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
RUN = re.compile(r"[A-Za-z0-9+/_=-]+")
#: Every assignment holds one of these, in lower case.
CUES = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "markov")
#: Shortest string that the models judge, and the ratios that report it.
SHORTEST, PER_CHAR, IN_TOTAL = 16, 0.3, 8.0
#: Bound of the sample that the models are counted on.
MAX_TRAIN_ROWS = 20_000
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
INDEX = {c: k for k, c in enumerate(ALPHABET)}


def long_words(text: str) -> list[tuple[int, str]]:
    """(start, word) of the words with SHORTEST or more characters."""
    out, at = [], 0
    for w in text.split():
        if len(w) >= SHORTEST:
            at = text.index(w, at)
            out.append((at, w))
            at += len(w)
    return out


def base_spans(text: str, words: list[tuple[int, str]]) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, leftmost and non-overlapping within each kind.

    Access keys and hex runs hold no white space and are as long as a long word, so only the
    long words are searched for them; assignments are searched where a cue word occurs.
    """
    out = []
    low = text.lower()
    if any(c in low for c in CUES):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    for at, w in words:
        if "AKIA" in w:
            out += [(at + m.start(), 1, at + m.end()) for m in ACCESS.finditer(w) if len(m[0]) >= 18]
        out += [(at + m.start(), 2, at + m.end()) for m in HEX.finditer(w) if len(m[0]) >= 16]
    return sorted(out)


class Model:
    """Log-likelihood ratio of random strings against ordinary words, by character transitions."""

    def __init__(self, counts: dict[tuple[int, int, int], int]):
        n = len(ALPHABET)
        self.ratio = [[0.0] * n for _ in range(n)]
        rows = Counter()
        for (label, a, _), c in counts.items():
            rows[label, a] += c
        for a in range(n):
            for b in range(n):
                p, q = ((counts.get((label, a, b), 0) + 0.5) / (rows[label, a] + 0.5 * n) for label in (1, 0))
                self.ratio[a][b] = math.log(p / q)

    def score(self, s: str) -> float:
        at = [INDEX[c] for c in s]
        return sum(self.ratio[a][b] for a, b in zip(at, at[1:]))


def candidate(s: str) -> bool:
    """Strings that the models judge; without a label they train neither."""
    return len(s) >= SHORTEST and any(map(str.isdigit, s)) and any(map(str.isalpha, s))


def extra_spans(words: list[tuple[int, str]], base: list[tuple[int, int, int]], model: Model) -> list[tuple[int, int, int]]:
    """Strings with a digit and a letter that the model takes for random, outside the base spans."""
    out = []
    for at, w in words:
        for m in RUN.finditer(w):
            s, start, end = m[0], at + m.start(), at + m.end()
            if not candidate(s):
                continue
            if any(a < end and start < b for a, _, b in base):
                continue
            score = model.score(s)
            if score >= IN_TOTAL and score >= PER_CHAR * (len(s) - 1):
                out.append((start, 3, end))
    return out


def train(docs: DataFrame, max_rows: int = MAX_TRAIN_ROWS) -> dict[tuple[int, int, int], int]:
    """Transition counts (label, from, to): label 1 in the patterns' values, 0 in other words of 4 or more letters."""
    spread = 1 << 20
    total = docs.select("doc_id").count()
    # one part in 2**20 at least: counts of more rows merge alike, an empty sample would find nothing
    share = spread if total <= max_rows else max(1, int(spread * max_rows / total))
    sample = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(spread)) < share).select("text")

    def count(batches):
        seen: Counter = Counter()
        for batch in batches:
            for value in batch.column(0):
                text = value.as_py() or ""
                base = base_spans(text, long_words(text))
                for a, kind, b in base:
                    values = [text[a:b]] if kind else [ASSIGN.match(text, a)[2]]
                    seen.update((1, INDEX[x], INDEX[y]) for s in values for x, y in zip(s, s[1:]) if x in INDEX and y in INDEX)
                if not base:
                    for s in re.findall(r"[A-Za-z0-9+/_=-]{4,}", text):
                        if not candidate(s):
                            seen.update((0, INDEX[x], INDEX[y]) for x, y in zip(s, s[1:]))
        rows = [(*k, n) for k, n in seen.items()]
        cols = list(zip(*rows)) or [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["label", "a", "b", "n"])

    counted = sample.mapInArrow(count, "label long, a long, b long, n long").groupBy("label", "a", "b").agg(F.sum("n").alias("n"))
    return {(r["label"], r["a"], r["b"]): r["n"] for r in counted.collect()}  # at most 2 x 67 x 67 rows


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_markov for every whole text.

    Positions are code points, ends exclusive; an assignment's span is its whole match. Null
    counts as empty: no spans. Repeated rows are scanned each; an empty table gives no rows;
    other columns are not read.
    """
    counts = train(docs)

    def run(batches):
        model = Model(counts)
        for batch in batches:
            cols: list[list] = [[] for _ in range(6)]
            for value in batch.column(1):
                text = value.as_py() or ""
                words = long_words(text)
                base = base_spans(text, words)
                more = extra_spans(words, base, model)
                n = Counter(k for _, k, _ in base)
                row = (n[0], n[1], n[2], hashlib.sha256(joined(base).encode()).hexdigest(), joined(base + more), len(more))
                for c, v in zip(cols, row):
                    c.append(v)
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(cols, kinds)]],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_markov"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_markov long")
