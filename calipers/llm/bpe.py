"""Byte-level BPE over a trie of distinct words.

The text is cut into words by the tokenizer's pattern. New distinct words are sorted: together with
the lengths of their common beginnings that is their trie in depth-first order. The traversal keeps
one branch on a stack, and for every node (a beginning of words) the last token of that beginning's
encoding. A node's last token t is the one that ends there and may stand behind the last token of
the node where t starts; so a shared beginning is worked out once for all words below it, and a
word's tokens are read back along its branch. Which tokens may end at a node is looked up by its last
ENDING bytes. No word reaches over a single space between two other characters, so texts are cut there
first, and only pieces that were not met before are cut into words; both come from a bounded memory, as
packed ids.

Null texts are empty: no tokens. Special tokens written out in a text become their id, as the
library does it. Repeated rows are encoded each; other columns are not read; empty tables give
empty results; a text of any length is one row and is worked through whole.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from calipers.llm.common import give_back, table

#: Fixed value: the word pattern of byte-level BPE, with the white space of the Unicode standard spelled out.
SPACE = r"\t-\r \x85\xa0" + "".join(map(chr, (0x1680, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))) + chr(0x2000) + "-" + chr(0x200A)
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
#: Characters of text whose words are gathered before the next traversal.
CHUNK_CHARS = 1_000_000
#: Pieces, words, token pairs and endings remembered by one Python worker; beyond it the memory starts anew.
PIECES_KEPT, WORDS_KEPT, PAIRS_KEPT, ENDINGS_KEPT = 200_000, 300_000, 500_000, 100_000
#: Bytes before a place that say which tokens may end there.
ENDING = 4
#: A space with other white space beside it. isspace() also takes some control characters, which only keeps a piece longer.
SPACED = re.compile(r" \s|\s ")
NEVER = 1 << 60


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary, to the byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in shown}
    hidden = [b for b in range(256) if b not in set(shown)]
    return letters | {chr(256 + k): b for k, b in enumerate(hidden)}


class Bpe:
    """Encoder and decoder of one vocabulary; lives in a Python worker."""

    def __init__(self, spec: str, pattern: str = PATTERN):
        model = json.loads(spec)
        letters = byte_letters()
        plain = lambda token: bytes(letters[c] for c in token)
        vocab = model["model"]["vocab"]
        self.ids = {plain(t): i for t, i in vocab.items()}
        self.tokens = {i: b for b, i in self.ids.items()}
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        self.tokens |= {i: t.encode() for t, i in self.special.items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.words = regex.compile(pattern)
        self.merge_rank: dict[tuple[int, int], int] = {}
        self.made_at: dict[int, int] = {}
        left, right = {}, {}
        for rank, pair in enumerate(model["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            made = vocab[a + b]
            self.merge_rank[vocab[a], vocab[b]] = rank
            if made not in self.made_at:
                self.made_at[made], left[made], right[made] = rank, vocab[a], vocab[b]
        self.left_edge = {t: self._edge(t, left) for t in self.tokens}
        self.right_edge = {t: self._edge(t, right) for t in self.tokens}
        longer: dict[bytes, set[int]] = {}
        for b in self.ids:
            if len(b) > ENDING:
                longer.setdefault(b[-ENDING:], set()).add(len(b))
        self.longer = {k: sorted(v, reverse=True) for k, v in longer.items()}
        self.packed = {i: i.to_bytes(4, "little") for i in self.tokens}
        self.forget()

    @staticmethod
    def _edge(token: int, inner: dict[int, int]) -> list[int]:
        """What stood at one edge of a token while it was merged, from a single byte to the token."""
        edge = [token]
        while edge[-1] in inner:
            edge.append(inner[edge[-1]])
        return edge[::-1]

    def _adjacent(self, a: int, b: int) -> bool:
        """May b follow a? Not if a merge across their border came before those that make a and b.

        Both edges grow in the order of their merges; equal ranks go to the left one first.
        """
        xs, ys, i, j = self.right_edge[a], self.left_edge[b], 0, 0
        while True:
            across = self.merge_rank.get((xs[i], ys[j]), NEVER)
            grow_a = self.made_at[xs[i + 1]] if i + 1 < len(xs) else NEVER
            grow_b = self.made_at[ys[j + 1]] if j + 1 < len(ys) else NEVER
            if across < grow_a and across <= grow_b:
                return False
            if grow_a == grow_b == NEVER:
                return True
            if grow_a <= grow_b:
                i += 1
            else:
                j += 1

    def _ending(self, tail: bytes) -> list[tuple[int, int]]:
        """(length, token) of what may end behind tail, the longest first; -1 for tokens longer than it, which are looked up."""
        found = [(n, -1) for n in self.longer.get(tail, ())] if len(tail) == ENDING else []
        found += [(n, self.ids[tail[-n:]]) for n in range(len(tail), 0, -1) if tail[-n:] in self.ids]
        self.endings[tail] = found
        return found

    def traverse(self, words: Iterable[str]) -> None:
        """Depth-first over the trie of `words`; puts the packed encoding of each into `known`."""
        ids, pairs, endings, adjacent, tokens, packed = self.ids, self.pairs, self.endings, self._adjacent, self.tokens, self.packed
        last = [-1]  # last[d]: last token of the branch's first d bytes
        before = b""
        for raw, word in sorted((w.encode(), w) for w in words):
            if before and raw.startswith(before):
                shared = len(before)
            else:
                shared, most = 0, min(len(before), len(raw))
                while shared < most and before[shared] == raw[shared]:
                    shared += 1
            del last[shared + 1 :]
            for end in range(shared + 1, len(raw) + 1):
                tail = raw[end - ENDING : end] if end > ENDING else raw[:end]
                for n, token in endings.get(tail) or self._ending(tail):
                    if token < 0 and (n > end or (token := ids.get(raw[end - n : end], -1)) < 0):
                        continue
                    if end == n:
                        break
                    pair = last[end - n] << 32 | token
                    if (ok := pairs.get(pair)) is None:
                        ok = pairs[pair] = adjacent(last[end - n], token)
                    if ok:
                        break
                else:  # a byte alone always ends an encoding
                    token = ids[raw[end - 1 : end]]
                last.append(token)
            out, end = [], len(raw)
            while end:
                token = last[end]
                out.append(packed[token])
                end -= len(tokens[token])
            out.reverse()
            self.known[word] = b"".join(out)
            before = raw
        if len(pairs) > PAIRS_KEPT:
            pairs.clear()
        if len(endings) > ENDINGS_KEPT:
            endings.clear()

    def pieces(self, text: str) -> list[str]:
        """The text cut before every space; a piece is a run of whole words but where spaces meet white space."""
        first, *others = text.split(" ")
        own = [first, *[" " + x for x in others]]
        if "  " in text or SPACED.search(text):
            joined, at = [], 0
            while at < len(own):  # a space beside other white space is of one run with it
                end = at + 1
                while end < len(own) and (own[end] == " " or own[end][1].isspace() or own[end - 1][-1:].isspace()):
                    end += 1
                joined.append("".join(own[at:end]) if end - at > 1 else own[at])
                at = end
            return joined
        return own

    def encode_packed(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        special, packed = self.special, self.packed
        parts = [self.cut.split(t) if self.cut and any(s in t for s in special) else [t] for t in texts]
        cut = [[[p] if k % 2 else self.pieces(p) for k, p in enumerate(own)] for own in parts]
        if len(self.met) > PIECES_KEPT:
            self.met.clear()
        if len(self.known) > WORDS_KEPT:
            self.known.clear()
        find = self.words.findall
        new = {p: find(p) for p in {p for own in cut for pieces in own[::2] for p in pieces}.difference(self.met)}
        self.traverse({w for words in new.values() for w in words}.difference(self.known))
        known, met = self.known.__getitem__, self.met
        for p, words in new.items():
            met[p] = known(words[0]) if len(words) == 1 else b"".join(map(known, words))
        get = met.__getitem__
        for own in cut:
            yield b"".join(chain.from_iterable((packed[special[pieces[0]]],) if k % 2 else map(get, pieces) for k, pieces in enumerate(own)))

    def encode(self, texts: list[str]) -> Iterator[list[int]]:
        for ids in self.encode_packed(texts):
            yield np.frombuffer(ids, dtype="<u4").tolist()

    def forget(self) -> None:
        """Drops what was met so far."""
        self.met: dict[str, bytes] = {}
        self.known: dict[str, bytes] = {}
        self.pairs: dict[int, bool] = {}
        self.endings: dict[bytes, list[tuple[int, int]]] = {}

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.tokens.__getitem__, ids)).decode("utf-8", "replace")


def _chunks(batches: Iterator[pa.RecordBatch], text_at: int = 1) -> Iterator[tuple[pa.Array, list[str]]]:
    """(ids, texts) in slices of about CHUNK_CHARS."""
    for batch in batches:
        texts, start, chars = batch.column(text_at).to_pylist(), 0, 0
        for k, t in enumerate(texts):
            chars += len(t or "")
            if chars >= CHUNK_CHARS or k + 1 == len(texts):
                yield batch.column(0).slice(start, k + 1 - start), [x or "" for x in texts[start : k + 1]]
                start, chars = k + 1, 0


def vocabulary(path: str | None = None) -> str:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as f:
        return f.read()


def _apply(documents: DataFrame, columns: list[str], kind: str, schema: str, path: str | None, work) -> DataFrame:
    shared = documents.sparkSession.sparkContext.broadcast(vocabulary(path))  # the vocabulary file: its size doesn't depend on the data
    rows = documents.select(columns[0], documents[columns[1]].cast(kind))

    def task(batches):
        yield from work(Bpe(shared.value), batches)  # made anew by each task: a worker that waits holds nothing
        give_back()

    return rows.mapInArrow(task, f"`{columns[0]}` {documents.schema[columns[0]].dataType.simpleString()}, {schema}")


def encode(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """(id, ids array<int>) of every whole text."""

    def work(bpe, batches):
        for key, texts in _chunks(batches):
            ids = pa.array([np.frombuffer(x, dtype="<i4") for x in bpe.encode_packed(texts)], type=pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([key, ids], [id_col, "ids"])

    return _apply(documents, [id_col, text_col], "string", "ids array<int>", path, work)


def decode(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """(id, text) of every list of ids; null lists are empty."""

    def work(bpe, batches):
        for batch in batches:
            texts = pa.array([bpe.decode(x or ()) for x in batch.column(1).to_pylist()], type=pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), texts], [id_col, "text"])

    return _apply(encoded, [id_col, ids_col], "array<int>", "text string", path, work)


def round_trip(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """Encode and decode in one pass: (id, n_tokens, ids_sha256, decoded_sha256), no list leaves the worker."""

    def work(bpe, batches):
        for key, texts in _chunks(batches):
            n, packed, decoded = [], [], []
            for ids in bpe.encode_packed(texts):
                n.append(len(ids) // 4)
                packed.append(hashlib.sha256(ids).hexdigest())
                decoded.append(hashlib.sha256(bpe.decode(np.frombuffer(ids, dtype="<u4").tolist()).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([key, pa.array(n, pa.int64()), pa.array(packed, pa.string()), pa.array(decoded, pa.string())], [id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    return _apply(documents, [id_col, text_col], "string", "n_tokens long, ids_sha256 string, decoded_sha256 string", path, work)


def op1_bpe(spark, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))
