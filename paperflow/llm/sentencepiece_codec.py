"""SentencePiece (BPE) encoding by a table of prefix ends, and decoding.

For every prefix of a segment the encoding's last token is unique. It is found among the
vocabulary matches that end there (Aho-Corasick automaton): the one that is compatible with
the last token of the prefix before it, i.e. the two stay apart when their joined characters
are merged. Token ids are then recovered backwards. The work is linear in the text whatever
its length, and compatibility answers and short segments are remembered in bounded tables.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame

SPACE = "▁"  # stands for a space inside pieces
#: Bounds of the remembered pairs and words, and the longest word remembered.
PAIRS, SEGMENTS, LONGEST = 300_000, 100_000, 48


class Automaton:
    """Aho-Corasick automaton: for a state, the words that end there, longest first."""

    def __init__(self, words: dict[str, int]):
        self.goto: list[dict[str, int]] = [{}]
        ends: list[int | None] = [None]
        sizes = [0]
        for word, value in words.items():
            state = 0
            for c in word:
                if c not in self.goto[state]:
                    self.goto[state][c] = len(self.goto)
                    sizes.append(sizes[state] + 1)
                    self.goto.append({})
                    ends.append(None)
                state = self.goto[state][c]
            ends[state] = value
        self.fail = [0] * len(self.goto)
        self.out: list[tuple[tuple[int, int], ...]] = [()] * len(self.goto)
        level = [0]
        while level:
            below = []
            for state in level:
                own = () if ends[state] is None else ((ends[state], sizes[state]),)
                self.out[state] = own + (self.out[self.fail[state]] if state else ())
                for c, child in self.goto[state].items():
                    if state:
                        at = self.fail[state]
                        while at and c not in self.goto[at]:
                            at = self.fail[at]
                        self.fail[child] = self.goto[at].get(c, 0)
                    below.append(child)
            level = below


class PrefixTableCodec:
    """Same ids as the sentencepiece library for BPE models with byte fallback and identity normalization."""

    def __init__(self, model_path: str):
        import sentencepiece

        self.sp = sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.pieces = [sp.id_to_piece(i) for i in range(sp.vocab_size())]
        special = lambda i: sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)
        self.ids = {p: i for i, p in enumerate(self.pieces) if not special(i)}
        self.score = {p: sp.get_score(i) for p, i in self.ids.items()}
        self.bytes = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        letters = set().union(*self.ids)
        if not letters <= set(self.ids) or any(SPACE in p.lstrip(SPACE) for p in self.ids) \
                or sp.unk_id() in self.bytes or sp.normalize(" a  ﬁ") != f"{SPACE * 2}a{SPACE * 2}ﬁ":
            raise ValueError("needs a BPE model with byte fallback, identity normalization and pieces that start at spaces")
        # A piece that merging never forms is no token of any text.
        self.matches = Automaton({p: i for p, i in self.ids.items() if self.merge(p) == [p]})
        # No piece holds a wall, and none an ender after a letter, so merges never reach across.
        self.walls = "".join(c for c in "\n\t\r" if c not in letters)
        self.enders = {c for c in ".,;:!?" if not any(x.isalpha() for p in self.ids for x, y in zip(p, p[1:]) if y == c)}
        self.segments = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+").findall
        self.at_walls = re.compile(f"([{self.walls}])").split if self.walls else lambda w: [w]
        self.has_wall = re.compile(f"[{self.walls}]").search if self.walls else lambda w: None
        self.pairs: dict[int, bool] = {}
        self.young: dict[str, tuple[int, ...]] = {}
        self.old: dict[str, tuple[int, ...]] = {}

    def merge(self, text: str) -> list[str]:
        """Byte-pair merging by definition: the best-scored adjacent pair, leftmost first."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            found = [(-score[p], k) for k in range(len(parts) - 1) if (p := parts[k] + parts[k + 1]) in score]
            if not found:
                break
            k = min(found)[1]
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
        return parts

    def apart(self, left: int, right: int) -> bool:
        """Whether two tokens stay two when their characters are merged."""
        a, b = self.pieces[left], self.pieces[right]
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        self.pairs[left << 20 | right] = answer = self.merge(a + b) == [a, b]
        return answer

    def encode_segment(self, text: str) -> list[int]:
        """Ids of a segment that merges do not leave. Characters without a piece become bytes."""
        last: list[int | None] = [None] * (len(text) + 1)
        known, goto, fail, out = self.pairs.get, self.matches.goto, self.matches.fail, self.matches.out
        state = end = 0
        for c in text:
            end += 1
            below = goto[state].get(c)
            while below is None and state:
                state = fail[state]
                below = goto[state].get(c)
            state = below or 0
            for token, size in out[state]:
                if size < end:
                    left = last[end - size]
                    if left is not None:  # None: a character without a piece, nothing merges with it
                        ok = known(left << 20 | token)
                        if not (self.apart(left, token) if ok is None else ok):
                            continue
                last[end] = token
                break
        ids: list[int] = []
        at = len(text)
        while at:
            token = last[at]
            if token is None:
                ids += [self.bytes[b] for b in reversed(text[at - 1].encode())]
                at -= 1
            else:
                ids.append(token)
                at -= len(self.pieces[token])
        ids.reverse()
        return ids

    def word(self, word: str) -> tuple[int, ...]:
        """Ids of a word behind one space; with a space before it, of the same word behind a wall."""
        ids = self.young.get(word) or self.old.get(word)
        if ids is None:
            if word[:1] == " ":
                ids = tuple(self.encode_segment(word[1:]))
            elif self.has_wall(word):
                first, *rest = self.at_walls(word)
                ids = self.word(first)
                for wall, part in zip(rest[::2], rest[1::2]):
                    ids += (self.bytes[ord(wall)],) + (self.word(" " + part) if part else ())
                return ids
            elif word[-1:] in self.enders and word[-2:-1].isalpha():
                ids = self.word(word[:-1]) + (self.ids[word[-1]],)
            else:
                ids = tuple(self.encode_segment(SPACE + word))
        if len(word) <= LONGEST:
            if len(self.young) >= SEGMENTS:
                self.old, self.young = self.young, {}
            self.young[word] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        if "  " in text or text[0] == " " or SPACE in text:
            # Runs of spaces may merge with each other: cut before them only.
            parts = []
            for s in self.segments(SPACE + text.replace(" ", SPACE)):
                plain = len(s) > 1 and s[0] == SPACE != s[1]
                parts.append(self.word(s[1:]) if plain else self.encode_segment(s))
        else:
            words = text.split(" ")
            parts = list(map(self.young.get, words))
            if None in parts:
                parts = [p if p is not None else self.word(w) for p, w in zip(parts, words)]
        return list(chain.from_iterable(parts))

    def decode(self, ids: list[int]) -> str:
        return self.sp.decode(ids)


@lru_cache(maxsize=1)
def codec(model_path: str) -> PrefixTableCodec:
    """One codec per Python worker."""
    return PrefixTableCodec(model_path)


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, ids (array of int) and decoded text of every whole text. Null counts as empty: no ids.

    Repeated rows are encoded each; an empty table gives no rows; other columns are not read.
    """
    def run(batches):
        own = codec(model_path)
        for batch in batches:
            for k in range(batch.num_rows):  # row by row: no more than a text's ids at once
                ids = own.encode(batch.column(1)[k].as_py() or "")
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(k, 1), pa.array([ids], pa.list_(pa.int32())), pa.array([own.decode(ids)])],
                    ["doc_id", "ids", "decoded"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded string")


def encode_digests(docs: DataFrame, model_path: str) -> DataFrame:
    """As ``encode``, but the digests of its outputs: doc_id, n_tokens, ids_sha256 (decimal ids joined
    by commas), decoded_sha256. The ids themselves do not leave the Python worker."""
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()

    def run(batches):
        own = codec(model_path)
        written = list(map(str, range(len(own.pieces))))
        for batch in batches:
            counts, ids_sha, text_sha = [], [], []
            for value in batch.column(1):
                ids = own.encode(value.as_py() or "")
                counts.append(len(ids))
                ids_sha.append(sha(",".join([written[i] for i in ids])))
                text_sha.append(sha(own.decode(ids)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
