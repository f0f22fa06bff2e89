"""Byte-pair encoding by a depth-first walk over the trie of distinct words, and decoding.

A batch's texts are cut into words, and the distinct ones enter a trie in
sorted order, which is its depth-first order.  The walk keeps the path to the current word
as a stack; a new node settles its state, the last token of the
encoding of the prefix that ends there and that whole encoding, from the
states on the path.  Words that share a prefix share its nodes, so that a
prefix is encoded once, whatever the number of words that go on from it.  A
Python worker keeps its trie for later batches, up to a number of nodes.

The state rests on one property of byte-pair encoding: tokens that stand side
by side are the encoding of their joined text just if each two neighbours
are.  A prefix's last token is thus the token ``t`` that ends there and fits
behind the last token of what is left before it.  Whether two tokens fit is
settled from the merges that built the sides which touch, and kept.

It holds for vocabularies whose merges come after those of their parts and
make each token in one way; others are refused, as are options of the model
that change the merging.  Normalisation and the cut into words are the
tokenizer's own.  As in ``token_files``, texts are first cut at blanks and line feeds,
and ASCII letters from the punctuation behind them, which is exact for tokenizers that
lower their input, drop white space and merge within runs of letters only.

Defined results: a null or empty text has no ids and decodes to the empty
text; strings of special tokens are their ids; null and repeated ids stay
rows of their own; other columns are ignored; an empty table gives no rows.
Long texts go through in pieces, the result of a row is as long as its text.
"""

from __future__ import annotations

import functools
import gc
import json
import os
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from strata.llm.words import cut_words, distinct_words

#: Bytes of text that are cut into words at once; a longer text goes in pieces that end at blanks.
CUT_AT_ONCE = 1 << 20

#: Distinct words in each of the two generations that a Python worker keeps encoded.
KEPT_WORDS = 150_000

#: Nodes in a worker's trie; beyond them it is planted anew before the next words.
KEPT_NODES = 200_000

#: Pairs of tokens that a worker keeps settled.
KEPT_PAIRS = 1_000_000

#: Bytes of results in one Arrow batch, beyond one row.
OUT_BYTES = 4 << 20

ENCODED = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])
DECODED = pa.schema([*ENCODED, ("decoded", pa.string())])
ENCODED_DDL = "doc_id long, n_tokens long, ids binary"
DECODED_DDL = f"{ENCODED_DDL}, decoded string"

NEVER = 1 << 62

#: The end of Unicode's Latin letters.
LATIN = 0x250


class Merges:
    """A vocabulary's tokens by text, the merges that build them, and which tokens fit side by side."""

    def __init__(self, spec: dict):
        model = spec["model"]
        refused = ("dropout", "continuing_subword_prefix", "byte_fallback", "ignore_merges")
        if model["type"] != "BPE" or any(model.get(k) for k in refused):
            raise ValueError("not a plain byte-pair vocabulary")
        vocabulary: dict[str, int] = model["vocab"]
        suffix: str = model.get("end_of_word_suffix") or ""
        added = {token["id"] for token in spec["added_tokens"]}
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        for rank, (a, b) in enumerate(pairs):
            left, right, whole = vocabulary[a], vocabulary[b], vocabulary[a + b]
            if whole in self.parts:
                raise ValueError(f"merge {rank} makes a token that another one makes")
            self.parts[whole], self.rank[left, right] = (left, right), rank
        for pair, rank in self.rank.items():
            if max(map(self.born, pair)) >= rank:
                raise ValueError(f"merge {rank} does not come after its parts")
        #: Tokens inside a word and tokens that end one, by their text.
        self.inner: dict[str, int] = {}
        self.final: dict[str, int] = {}
        ends: dict[int, bool] = {}
        for text, token in sorted(vocabulary.items(), key=lambda x: self.born(x[1])):
            if token in added:
                continue
            if token in self.parts:
                ends[token] = ends[self.parts[token][1]]
                if not self._meet(*self.parts[token]):
                    continue  # no text is ever encoded with it
            else:
                ends[token] = bool(suffix) and len(text) > len(suffix) and text.endswith(suffix)
            if ends[token]:
                self.final[text.removesuffix(suffix)] = token
            else:
                self.inner[text] = token
        if not suffix:
            self.final = self.inner
        self.settled: dict[int, dict[int, bool]] = {}
        self.pairs = 0

    def born(self, token: int) -> int:
        """The rank of the merge that makes the token; single symbols are there from the start."""
        return self.rank[self.parts[token]] if token in self.parts else -1

    @functools.lru_cache(maxsize=1 << 17)
    def _side(self, token: int, right: bool) -> tuple[list[int], list[int]]:
        """The tokens that hold the last (first) symbol while ``token`` is built, and when the next one is made."""
        found = [token]
        while found[-1] in self.parts:
            found.append(self.parts[found[-1]][right])
        found.reverse()
        return found, [*(self.born(x) for x in found[1:]), NEVER]

    def _meet(self, a: int, b: int) -> bool:
        """Whether ``a`` and ``b`` are complete before a merge joins the parts that touch.

        For tokens that a merge joins, this merge is then the first across
        their border; the others then fit side by side, as none ever comes.
        """
        left, next_left = self._side(a, True)
        right, next_right = self._side(b, False)
        whole = (a, b)
        i = j = 0
        while True:
            across = self.rank.get((left[i], right[j]), NEVER)
            # of equal merges the one further left comes first
            if next_left[i] <= across and next_left[i] <= next_right[j] and next_left[i] < NEVER:
                i += 1
            elif next_right[j] < across:
                j += 1
            else:
                return across == NEVER or (left[i], right[j]) == whole

    def row(self, a: int) -> dict[int, bool]:
        """By token: whether it fits behind ``a``, as far as settled; ``a`` itself is kept under -1."""
        found = self.settled.get(a)
        if found is None:
            found = self.settled[a] = {-1: a}
        return found

    def settle(self, row: dict[int, bool], b: int) -> bool:
        """Whether the encoding of the joined text of the row's token and ``b`` is the two of them."""
        a = row[-1]
        found = row[b] = (a, b) not in self.rank and self._meet(a, b)
        self.pairs += 1
        return found

    def tidy(self) -> None:
        """Forget the settled pairs when they are many."""
        if self.pairs > KEPT_PAIRS:
            self.settled, self.pairs = {}, 0


#: A prefix in the trie: its children by symbol, its state, the row of the last token of its encoding, the packed encoding.
Node = tuple[dict, "State", dict, bytes]


class State(NamedTuple):
    """What follows from the longest end of a prefix that begins a token; filled as the walk meets it."""

    text: str
    tokens: list[tuple[int, int]]  # length and id of those that the prefix ends in, longest first
    steps: dict[str, State]
    closings: dict[str, list[tuple[int, int]]]  # by a word's last symbol: the tokens that may end it


def _tokens_at(tokens: dict[str, int], text: str) -> list[tuple[int, int]]:
    ends = (text[i:] for i in range(len(text)))
    return [(len(x), tokens[x]) for x in ends if x in tokens]


class TrieEncoder:
    """Encodes and decodes texts as the tokenizer of the file at ``tokenizer_path`` does."""

    def __init__(self, tokenizer_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark deals out the cores
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(tokenizer_path)
        spec = json.loads(tokenizer.to_str())
        if spec["decoder"] is not None or any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("decoders and added tokens that change their surroundings are not known here")
        self.normalizer, self.pre_tokenizer = tokenizer.normalizer, tokenizer.pre_tokenizer
        self.merges = Merges(spec)
        tokens = {**self.merges.inner, **self.merges.final}
        #: What tokens begin with.
        self.begins = {token[:i] for token in tokens for i in range(len(token) + 1)}
        self.states: dict[str, State] = {}
        self._plant()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_pattern = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        size = tokenizer.get_vocab_size()
        self.packed = [i.to_bytes(4, "little") for i in range(size)]
        self.strings = [(tokenizer.id_to_token(i) or "").encode() for i in range(size)]
        #: Latin letters, which have no combining forms, as the tokenizer writes them.
        alone = {chr(i): self._cut(chr(i)) for i in range(LATIN) if chr(i).isalpha()}
        self.letters = {letter: words[0] for letter, words in alone.items() if len(words) == 1}
        self.known: dict[bytes, bytes] = {}
        self.last: dict[bytes, bytes] = {}

    def _state(self, text: str) -> State:
        """The state of a prefix that ends in ``text``."""
        while text not in self.begins:
            text = text[1:]
        found = self.states.get(text)
        if found is None:
            found = self.states[text] = State(text, _tokens_at(self.merges.inner, text), {}, {})
        return found

    def walk(self, words: list[str]) -> list[bytes]:
        """The packed ids of each of the sorted distinct ``words``, none of them empty.

        Sorted words enter the trie depth first: ``path`` holds the nodes of
        the word before, down to the prefix that it shares with the next.
        """
        if self.nodes > KEPT_NODES:
            self._plant()
        packed, settle, row_of = self.packed, self.merges.settle, self.merges.row
        path: list[Node] = [self.root]
        found = []
        before = ""
        for word in words:
            last = len(word) - 1
            depth = 0
            for x, y in zip(before, word):
                if x != y:
                    break
                depth += 1
            depth = min(depth, last)  # the last symbol of a word is one of its own
            del path[depth + 1 :]
            node = path[depth]
            while depth < last and (child := node[0].get(word[depth])):
                path.append(child)
                node = child
                depth += 1
            children, state, _, _ = node
            for symbol in word[depth:]:
                if depth < last:
                    following = state[2].get(symbol)
                    if following is None:
                        following = state.steps[symbol] = self._state(state.text + symbol)
                    candidates = following[1]
                else:
                    candidates = state[3].get(symbol)
                    if candidates is None:
                        candidates = state.closings[symbol] = _tokens_at(self.merges.final, state.text + symbol)
                depth += 1
                for length, token in candidates:
                    if length == depth:
                        code = packed[token]
                        break
                    _, _, row, code = path[depth - length]
                    fit = row.get(token)
                    if fit is None:
                        fit = settle(row, token)
                    if fit:
                        code += packed[token]
                        break
                else:
                    raise ValueError(f"the vocabulary has no symbol {symbol!r}")
                if depth <= last:
                    state = following
                    node = ({}, state, row_of(token), code)
                    children[symbol] = node
                    path.append(node)
                    children = node[0]
                    self.nodes += 1
            found.append(code)
            before = word[:-1]
        return found

    def _plant(self) -> None:
        """An empty trie, and no settled pairs if they are many."""
        self.merges.tidy()
        self.root = ({}, self._state(""), {}, b"")
        self.nodes = 0

    def _cut(self, text: str) -> list[str]:
        return [word for word, _ in self.pre_tokenizer.pre_tokenize_str(self.normalizer.normalize_str(text))]

    def _words(self, chunk: bytes) -> list[str]:
        """A chunk's words in the byte-level alphabet."""
        text = chunk.decode()
        try:
            return ["".join([self.letters[x] for x in text])]
        except KeyError:
            return self._cut(text)

    def _learn(self, chunks: set[bytes]) -> None:
        """Encode chunks of text that the worker doesn't know."""
        letters = [chunk for chunk in chunks if chunk.isalpha()]  # ASCII in lower case: words as they are
        others = {chunk: self._words(chunk) for chunk in chunks.difference(letters)}
        words = sorted({word for pieces in others.values() for word in pieces}.union(map(bytes.decode, letters)))
        collects = gc.isenabled()
        gc.disable()  # a trie has no cycles, and looking for some takes a sixth of the time
        try:
            codes = dict(zip(words, self.walk(words)))
        finally:
            if collects:
                gc.enable()
        self.known.update(zip(letters, map(codes.__getitem__, map(bytes.decode, letters))))
        self.known.update((chunk, b"".join([codes[word] for word in pieces])) for chunk, pieces in others.items())

    def _together(self, texts: list[bytes]) -> Iterator[bytes]:
        """The packed ids of each text; what is new in them is learned at once."""
        if not texts:
            return
        data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        starts, lengths = cut_words(data)
        if not len(starts):
            yield from (b"" for _ in texts)
            return
        one, same = distinct_words(data, starts, lengths)
        raw = data.tobytes()
        chunks = [raw[i:j] for i, j in zip(starts[one].tolist(), (starts + lengths)[one].tolist())]
        if len(self.known) > KEPT_WORDS:
            self.known, self.last = {}, self.known
        new = set(chunks).difference(self.known)
        again = new.intersection(self.last)
        self.known.update((chunk, self.last[chunk]) for chunk in again)
        self._learn(new - again)
        codes = list(map(self.known.__getitem__, chunks))
        first = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
        borders = np.searchsorted(starts, first).tolist()
        for i, j in zip(borders, borders[1:]):
            yield b"".join(map(codes.__getitem__, same[i:j].tolist()))

    def _plain(self, text: str) -> bytes:
        """A text without special tokens, of any length."""
        raw = text.encode().lower()
        found, start = [], 0
        while start < len(raw):
            stop = raw.find(b" ", start + CUT_AT_ONCE)
            stop = len(raw) if stop < 0 else stop
            found += self._together([raw[start:stop]])
            start = stop
        return b"".join(found)

    def _special(self, text: str) -> bytes:
        found, start = [], 0
        for match in self.special_pattern.finditer(text):
            found += [self._plain(text[start : match.start()]), self.packed[self.special[match.group()]]]
            start = match.end()
        return b"".join([*found, self._plain(text[start:])])

    def encode(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of each text, in order, as little-endian unsigned 32-bit integers."""
        held: list[bytes] = []
        size = 0
        for text in texts:
            special = self.special_pattern is not None and self.special_pattern.search(text)
            if special or size + len(text) > CUT_AT_ONCE:
                yield from self._together(held)
                held, size = [], 0
            if special:
                yield self._special(text)
            elif len(text) > CUT_AT_ONCE:
                yield self._plain(text)
            else:
                held.append(text.encode().lower())  # A-Z only
                size += len(held[-1]) + 1
        yield from self._together(held)

    def decode(self, ids: bytes) -> bytes:
        """The text of packed ids in UTF-8: without a decoder of its own a tokenizer joins its tokens by blanks."""
        return b" ".join(map(self.strings.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@functools.cache
def encoder(tokenizer_path: str) -> TrieEncoder:
    """One per Python worker: Spark uses a worker for many tasks, and its words come again."""
    return TrieEncoder(tokenizer_path)


def _batches(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows whose last value has a length, in batches of about ``OUT_BYTES``."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[-1])
        if size >= OUT_BYTES:
            yield pa.record_batch([pa.array(x, f.type) for x, f in zip(zip(*held), schema)], schema)
            held, size = [], 0
    if held:
        yield pa.record_batch([pa.array(x, f.type) for x, f in zip(zip(*held), schema)], schema)


def encode_documents(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` of ``docs(doc_id, text)``; ids are packed little-endian unsigned 32-bit integers."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(tokenizer_path)

        def rows() -> Iterator[tuple]:
            for batch in batches:
                codes = words.encode(text.as_py() for text in batch.column("text"))
                for doc_id, ids in zip(batch.column("doc_id"), codes):
                    yield doc_id.as_py(), len(ids) // 4, ids

        yield from _batches(rows(), ENCODED)

    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text).mapInArrow(encode, ENCODED_DDL)


def decode_documents(encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """``encoded(doc_id, n_tokens, ids)`` with the text that the ids stand for as ``decoded``."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(tokenizer_path)

        def rows() -> Iterator[tuple]:
            for batch in batches:
                for doc_id, n, ids in zip(*(batch.column(k) for k in ENCODED.names)):
                    yield doc_id.as_py(), n.as_py(), ids.as_py(), words.decode(ids.as_py()).decode()

        yield from _batches(rows(), DECODED)

    return encoded.select(*ENCODED.names).mapInArrow(decode, DECODED_DDL)
