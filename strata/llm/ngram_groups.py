"""Exact near-duplicate components by word n-gram Jaccard similarity and a token-group matrix.

A document's set is its distinct ``width``-word shingles, as 64-bit hashes; two
documents link when the Jaccard similarity of their sets reaches the
threshold.  The steps, each a Spark job over all documents:

1. Sets that are equal become one node.  Nodes that agree on enough bins of a
   one-permutation sketch with the node among them whose bins are shared most
   are compared with it exactly.  What links is already one component, without pairs inside it.
2. Components are cut into groups of about ``GROUP`` similar nodes; a node that
   linked with nothing is a group alone.  The token-group matrix has one cell
   for each token of a group's union that lies in the prefix of a member.  By
   prefix filtering, nodes that link share such a token, and it lies in the
   shorter index prefix of the smaller set.  Tokens are ordered with those of
   many documents last, so that passages shared by many documents rarely are
   in a prefix.
3. Columns of the matrix meet per token.  First they only tell which cells meet another
   component's at all.  All sets have their tokens below a common cut in the matrix, so that
   two groups share no more of them than either has met cells there: with the tokens above the cut and the
   sizes that bounds their links, and groups that cannot link make no pair.
   Two groups of one node each are also held apart by the parities of their sets: each set has ``PARITIES`` bits, flipped
   by its tokens, and sets differ in at least as many tokens as bits.  Copies of one text that are edited too much to
   link share most of its tokens, and only this tells them apart before they are paired.
   So texts that share some passages or chance phrases cost no pairs, however many there are.
   Then groups are paired, but for those of one component; in a long column, cells outside the index prefixes are not paired
   with each other, only counted.  For two groups, the number of shared
   tokens, the counted ones and the tokens that lie beyond the prefixes bound
   the overlap of any two members; groups that cannot reach the threshold are
   never opened.
4. Opened groups: each member of the smaller is compared with the other
   group's token union, and only if that bound allows with its members.
5. Components of the links, and each document's smallest reachable id.

Step 2's matrix travels as packed arrays, one per batch and range of hashes.

Defined results: a null or empty text, or one of blanks, has an empty set and
is its own component (of its own id); under ``width`` words the whole sequence
is the one shingle; rows that repeat an id each get their row, a component's id
is the smallest non-null id in it; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from strata.llm.components import connected_components
from strata.llm.words import cut_words, mix, word_hashes
from strata.operators.staging import stage

# Fixed value: the white space of the contract.
BLANKS = b" \t\n\x0b\x0c\r"

#: Bytes of text that are shingled at once; a longer text goes in pieces.
AT_ONCE = 1 << 20

#: Documents of a batch whose texts, as strings, and sets a Python worker holds at once.
SLICE = 1000

#: Bins of the sketch that proposes first comparisons, and how many must agree.
BINS, AGREED = 8, 3

#: Members of a token group.
GROUP = 64

#: A token in the emitted part of so many documents goes to the end of the order; so many tokens at most.
FREQUENT_FROM, MOST_FREQUENT = 16, 500_000

#: Nodes that are asked for by broadcast; more are fetched by a shuffled join.
BROADCAST_NODES = 200_000

#: Queries of a group that meet in one task.
QUERIES = 512

#: Cells of a long column.
LONG_COLUMN = 64

#: Pairs that a task holds before it sums them up.
HELD_PAIRS = 4_000_000

#: Bits of a set's parities, a multiple of 64.
PARITIES = 192

CHUNK_BITS = 24  # of a group's number: its place in the component


# --- sets ---------------------------------------------------------------------------------------


def shingle_sets(texts: Iterable[str], width: int = 5) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its shingles."""
    held: list[bytes] = []
    size = 0
    for text in texts:
        raw = text.encode().lower()  # A-Z only
        if held and size + len(raw) > AT_ONCE:
            yield from _sets(held, width)
            held, size = [], 0
        if len(raw) > AT_ONCE:
            hashes = np.concatenate([_hashed([piece])[0] for piece in _pieces(raw)])
            yield _set(hashes, _shingles(hashes, width), width)
            continue
        held.append(raw)
        size += len(raw) + 1
    if held:
        yield from _sets(held, width)


def _pieces(raw: bytes) -> Iterator[bytes]:
    start = 0
    while start < len(raw):
        stop = min(len(raw), start + AT_ONCE)
        while stop < len(raw) and raw[stop] not in BLANKS:
            stop += 1
        yield raw[start:stop]
        start = stop


def _hashed(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and where each text's begin."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    starts, lengths = cut_words(data, BLANKS, b"")
    first = np.cumsum([0, *(len(t) + 1 for t in texts)])
    hashes = word_hashes(data, starts, lengths) if len(starts) else np.zeros(0, np.uint64)
    return hashes, np.searchsorted(starts, first)


def _factors(n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def _shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    n = max(0, len(hashes) - width + 1)
    total = np.zeros(n, np.uint64)
    for i, factor in enumerate(_factors(width)):
        total += hashes[i : i + n] * factor
    return mix(total)


def _set(hashes: np.ndarray, shingles: np.ndarray, width: int) -> np.ndarray:
    if len(hashes) >= width:
        return np.unique(shingles)
    if not len(hashes):
        return np.zeros(0, np.uint64)
    whole = (hashes * _factors(len(hashes))).sum(dtype=np.uint64) + np.uint64(len(hashes))
    return mix(np.array([whole]))


def _sets(texts: list[bytes], width: int) -> Iterator[np.ndarray]:
    hashes, edge = _hashed(texts)
    shingles = _shingles(hashes, width)
    for low, high in zip(edge[:-1].tolist(), edge[1:].tolist()):
        yield _set(hashes[low:high], shingles[low : max(low, high - width + 1)], width)


def _sliced(batch: pa.RecordBatch) -> Iterator[list[list]]:
    """The columns of ``SLICE`` rows after ``SLICE``."""
    for k in range(0, batch.num_rows, SLICE):
        yield [column.to_pylist() for column in batch.slice(k, SLICE).columns]


def _record_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, field.type) for c, field in zip(columns, schema)], schema=schema)


def _binary_schema(names: Iterable[str]) -> pa.Schema:
    return pa.schema([("bucket", pa.int32()), *((name, pa.binary()) for name in names)])


def set_key(tokens: np.ndarray) -> str | None:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).hexdigest() if len(tokens) else None


class Similarity:
    """The threshold in per cent: 100 * intersection >= percent * union, in whole numbers."""

    def __init__(self, percent: int):
        self.percent = percent

    def links(self, shared: int, a: int, b: int) -> bool:
        return (100 + self.percent) * shared >= self.percent * (a + b)

    def too_different(self, least: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Where two sets that differ in at least so many tokens cannot link; ``sizes`` is the sum of theirs."""
        return (100 + self.percent) * least > (100 - self.percent) * sizes

    def needed(self, size: int) -> int:
        """The least overlap of a set of this size with any set it links with."""
        return -(-self.percent * size // 100)

    def prefix(self, size: int) -> int:
        return size - self.needed(size) + 1 if size else 0

    def index_prefix(self, size: int) -> int:
        """Where the smaller set of a link has a token that the larger has in its prefix."""
        return size - -(-2 * self.percent * size // (100 + self.percent)) + 1 if size else 0

    @property
    def cut(self) -> np.uint64:
        """All tokens below are in the matrix, but for frequent ones: about as many as a prefix has."""
        return np.uint64((100 - self.percent) * (1 << 64) // 100)

    def counted(self, size: int) -> int:
        """How many tokens are counted at first: the prefix, and some into which it moves."""
        return min(size, self.prefix(size) + size // 16 + 4)


def parities(tokens: np.ndarray) -> np.ndarray:
    """``PARITIES`` bits, each telling whether an odd number of the set's tokens falls on it."""
    odd = np.bincount((tokens >> np.uint64(32)) % np.uint64(PARITIES), minlength=PARITIES) & 1
    return np.packbits(odd.astype(bool)).view(np.uint64)


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Shared values of two sorted arrays without repeats."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = len(b) - 1
    return int(np.count_nonzero(b[at] == a))


# --- packed columns -----------------------------------------------------------------------------


def _buckets(tokens: np.ndarray, buckets: int) -> np.ndarray:
    """By the low half of a token: the high half orders it."""
    return ((tokens & np.uint64(0xFFFFFFFF)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _packed(buckets: int, tokens: np.ndarray, *others: np.ndarray) -> Iterator[tuple[int, list[bytes]]]:
    """The arrays cut by bucket."""
    bucket = _buckets(tokens, buckets)
    order = np.argsort(bucket, kind="stable")
    arrays = [x[order] for x in (tokens, *others)]
    found, at = np.unique(bucket[order], return_index=True)
    for number, low, high in zip(found.tolist(), at.tolist(), [*at[1:].tolist(), len(order)]):
        yield number, [x[low:high].tobytes() for x in arrays]


def _unpacked(column: pd.Series, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype)


# --- steps --------------------------------------------------------------------------------------

SKETCH = pa.schema(
    {
        "doc_id": pa.string(),
        "text_hash": pa.int64(),
        "n": pa.int64(),
        "set_key": pa.string(),
        "bins": pa.list_(pa.int64()),
        "bucket": pa.int32(),
        "tokens": pa.binary(),
        "counts": pa.binary(),
    }
)
SKETCH_DDL = "doc_id string, text_hash long, n long, set_key string, bins array<long>, bucket int, tokens binary, counts binary"


def sketch_documents(docs: DataFrame, similarity: Similarity, width: int, buckets: int) -> DataFrame:
    """One row per document, and packed rows that count the tokens of emitted parts.

    A token is counted where it is among the first of a document by hash: the
    prefix and some more, into which the prefix moves when frequent tokens
    leave it.
    """

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counted = []
            for doc_ids, text_hashes, texts in _sliced(batch):
                rows, first = [], []
                for doc_id, text_hash, tokens in zip(doc_ids, text_hashes, shingle_sets(texts, width)):
                    n = len(tokens)
                    bins: list = [None] * BINS
                    found, at = np.unique(tokens & np.uint64(BINS - 1), return_index=True)
                    for b, i in zip(found.tolist(), at.tolist()):
                        bins[b] = int(tokens[i].view(np.int64))
                    rows.append((doc_id, text_hash, n, set_key(tokens), bins, None, None, None))
                    first.append(tokens[: similarity.counted(n)])
                yield _record_batch(rows, SKETCH)
                counted.append(np.concatenate(first))
            if counted and len(joined := np.concatenate(counted)):
                tokens, counts = np.unique(joined, return_counts=True)
                packed = [
                    (None, 0, 0, None, None, number, *parts)
                    for number, parts in _packed(buckets, tokens, counts.astype(np.uint32))
                ]
                yield _record_batch(packed, SKETCH)

    texts = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return texts.mapInArrow(sketch, SKETCH_DDL)


def frequent_tokens(counted: DataFrame) -> np.ndarray:
    """The sorted tokens of ``FREQUENT_FROM`` documents or more, the ``MOST_FREQUENT`` first ones by count.

    They only order the tokens: any choice gives the same links.
    """

    def summed(group: pd.DataFrame) -> pd.DataFrame:
        tokens, same = np.unique(_unpacked(group["tokens"], np.uint64), return_inverse=True)
        counts = np.bincount(same, _unpacked(group["counts"], np.uint32).astype(np.float64))
        often = counts >= FREQUENT_FROM
        return pd.DataFrame({"token": tokens[often].view(np.int64), "n": counts[often].astype(np.int64)})

    often = counted.groupBy("bucket").applyInPandas(summed, "token long, n long")
    top = often.orderBy(F.desc("n"), "token").limit(MOST_FREQUENT).select("token").toArrow()
    return np.sort(top["token"].to_numpy().astype(np.int64).view(np.uint64))


def _is_in(tokens: np.ndarray, some: np.ndarray) -> np.ndarray:
    """Which tokens are in a sorted array."""
    if not len(some):
        return np.zeros(len(tokens), bool)
    at = np.searchsorted(some, tokens)
    at[at == len(some)] = 0
    return some[at] == tokens


def count_further(docs: DataFrame, frequent, similarity: Similarity, width: int, buckets: int) -> DataFrame:
    """Packed counts of the tokens beyond the counted part, of documents whose prefix reaches there.

    Such documents consist of frequent tokens for the most part: copies that
    differ in some words, or boilerplate.  What they share beyond the counted
    part would else pass for rare.
    """

    schema = _binary_schema(["tokens", "counts"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            further = []
            for tokens in (tokens for (texts,) in _sliced(batch) for tokens in shingle_sets(texts, width)):
                part = tokens[: similarity.counted(len(tokens))]
                if np.count_nonzero(~_is_in(part, frequent.value)) < similarity.prefix(len(tokens)):
                    further.append(tokens[len(part) :].copy())
            if further and len(joined := np.concatenate(further)):
                tokens, counts = np.unique(joined, return_counts=True)
                rows = [(number, *parts) for number, parts in _packed(buckets, tokens, counts.astype(np.uint32))]
                yield _record_batch(rows, schema)

    return docs.select("text").mapInArrow(count, "bucket int, tokens binary, counts binary")


def prefixes(sets: list[np.ndarray], frequent: np.ndarray, similarity: Similarity) -> list[np.ndarray]:
    return emitted_tokens(sets, frequent, similarity)[0]


def emitted_tokens(sets: list[np.ndarray], frequent: np.ndarray, similarity: Similarity) -> tuple[list[np.ndarray], list[int]]:
    """The first tokens of each set, frequent ones last, else by hash: its prefix, and all below the cut but frequent ones.

    And how many tokens of the set are neither below the cut nor rare.
    """
    below = [int(np.searchsorted(s, similarity.cut)) for s in sets]
    looked = [s[: max(n, similarity.prefix(len(s)) * 3 // 2 + 8)] for s, n in zip(sets, below)]
    rare = ~_is_in(np.concatenate(looked) if looked else np.zeros(0, np.uint64), frequent)
    found, beyond, low = [], [], 0
    for tokens, part, n in zip(sets, looked, below):
        mask = rare[low : low + len(part)]
        low += len(part)
        under = int(np.count_nonzero(mask[:n]))
        length = max(similarity.prefix(len(tokens)), under)
        chosen = part[mask][:length]
        if len(chosen) < length:
            often = _is_in(tokens, frequent)
            chosen = np.concatenate([tokens[~often], tokens[often]])[:length]
        found.append(chosen)
        beyond.append(len(tokens) - under)
    return found, beyond


def matrix_columns(texts: DataFrame, frequent, similarity: Similarity, width: int, buckets: int) -> DataFrame:
    """Packed cells of the token-group matrix from ``texts(set_key, grp, alone, text)``.

    Beside them are the parities of sets that are a group ``alone``, dealt to as many owners.
    """

    schema = _binary_schema([*CELLS, *PARITY])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, numbers, lone, some in (part for batch in batches for part in _sliced(batch)):
            sets, groups, single, odd = [], [], [], []
            for key, group, alone, tokens in zip(keys, numbers, lone, shingle_sets(some, width)):
                if set_key(tokens) == key:  # rows may repeat an id with another text
                    sets.append(tokens)
                    groups.append(group << 2)
                    if alone:
                        single.append(group)
                        odd.append(parities(tokens))
            chosen, beyond = emitted_tokens(sets, frequent.value, similarity)
            if chosen:
                # a cell's lowest bit tells whether it lies in the index prefix, the next whether its token is a rare one below the cut
                lengths = [len(c) for c in chosen]
                inside = [np.arange(len(c)) < similarity.index_prefix(len(s)) for c, s in zip(chosen, sets)]
                under = [np.arange(len(c)) < len(s) - n for c, s, n in zip(chosen, sets, beyond)]
                cells = np.repeat(np.array(groups, np.int64), lengths) | np.concatenate(inside) | np.concatenate(under).astype(np.int64) << 1
                sizes, rest = (np.repeat(np.array(x, np.uint32), lengths) for x in ([len(s) for s in sets], beyond))
                rows = dict(_packed(buckets, np.concatenate(chosen), cells, sizes, rest))
                known = {}
                if single:
                    owned = np.array(single, np.int64)
                    known = {k: parts[1:] for k, parts in _packed(buckets, mix(owned.view(np.uint64)), owned, np.array(odd))}
                yield _record_batch(_rows(rows, CELLS, known), schema)

    return texts.select("set_key", "grp", "alone", "text").mapInArrow(emit, "bucket int, " + _binaries([*CELLS, *PARITY]))


def _rows(rows: dict[int, list[bytes]], names: Iterable[str], known: dict[int, list[bytes]]) -> list[tuple]:
    """Packed rows with the parities that go the same way."""
    names = list(names)
    return [(k, *rows.get(k, [b""] * len(names)), *known.get(k, [b""] * len(PARITY))) for k in sorted(rows.keys() | known.keys())]


#: A token's cell of a group, the size of the set that has it, and how many tokens of the set are not rare ones below the cut.
CELLS = {"tokens": np.uint64, "cells": np.int64, "sizes": np.uint32, "beyond": np.uint32}

#: The same for all members of the group that have the token.
COLUMNS = {"tokens": np.uint64, "cells": np.int64, "low": np.uint32, "high": np.uint32, "beyond": np.uint32}

#: Groups of one set, and the parities of each.
PARITY = {"single": np.int64, "odd": np.uint64}


def _binaries(names: Iterable[str]) -> str:
    return ", ".join(f"{name} binary" for name in names)


def met_cells(columns: DataFrame, buckets: int) -> DataFrame:
    """The cells whose columns have a cell of another component, packed by the group they belong to.

    One cell a token and group, with the smallest and the largest set of the members that have it.
    Owners are as many as buckets, and the parities in a bucket are those of its owner.
    """

    def met(group: pd.DataFrame) -> pd.DataFrame:
        tokens, cells, sizes, beyond = (_unpacked(group[k], t) for k, t in CELLS.items())
        order = np.lexsort((cells ^ 1, tokens))  # inside cells first
        tokens, cells, sizes, beyond = tokens[order], cells[order], sizes[order], beyond[order]
        at = _run_starts(tokens, cells >> 2)
        low, high, beyond = (f.reduceat(x, at) if len(at) else x for f, x in ((np.minimum, sizes), (np.maximum, sizes), (np.maximum, beyond)))
        tokens, cells = tokens[at], cells[at]
        component = cells >> 2 + CHUNK_BITS
        ends = _run_ends(tokens)
        starts = len(tokens) - _run_ends(tokens[::-1])[::-1]
        kept = component[starts] != component[ends - 1]
        # dealt out by a hash of the group
        keys = mix((cells[kept] >> 2).view(np.uint64))
        packed = _packed(buckets, keys, *(x[kept] for x in (tokens, cells, low, high, beyond)))
        known = {int(group["bucket"].iloc[0]): [b"".join(group[name]) for name in PARITY]}
        found = _rows({owner: parts[1:] for owner, parts in packed}, COLUMNS, known)
        return pd.DataFrame(found, columns=["owner", *COLUMNS, *PARITY])

    return columns.groupBy("bucket").applyInPandas(met, "owner int, " + _binaries([*COLUMNS, *PARITY]))


def bound_groups(cells: DataFrame, buckets: int) -> DataFrame:
    """The cells of each group with what bounds its links, packed by token again.

    ``low, high`` are the sizes of the members that have met cells; a member
    without any shares no token of its prefix, and so links with nothing outside.
    Below the cut every set has all its rare tokens in the matrix: ``under`` is how many of them
    met another component's, and no member shares more of them; ``beyond`` is how many other tokens a member has at most.
    The cell's second bit now tells whether ``odd`` has the parities of the group's only set.
    """

    def bound(group: pd.DataFrame) -> pd.DataFrame:
        single, odd = (_unpacked(group[k], t) for k, t in PARITY.items())
        tokens, cells, low, high, beyond = (_unpacked(group[k], t) for k, t in COLUMNS.items())
        order = np.argsort(cells >> 2, kind="stable")
        tokens, cells = tokens[order], cells[order]
        at = _run_starts(cells >> 2)
        met = np.diff(np.append(at, len(cells)))
        bounds = [f.reduceat(x[order], at) if len(at) else x for f, x in ((np.minimum, low), (np.maximum, high), (np.maximum, beyond))]
        bounds.append(np.add.reduceat(cells >> 1 & 1, at).astype(np.uint32) if len(at) else beyond)
        alone, bits = _looked_up(cells[at] >> 2, single, odd.reshape(-1, PARITIES // 64))
        cells = cells & ~2 | np.repeat(alone.astype(np.int64) << 1, met)
        packed = _packed(buckets, tokens, cells, *(np.repeat(x, met) for x in bounds), np.repeat(bits, met, axis=0))
        return pd.DataFrame([(number, *parts) for number, parts in packed], columns=["bucket", "tokens", "cells", *BOUNDS, "odd"])

    return cells.groupBy("owner").applyInPandas(bound, "bucket int, " + _binaries(["tokens", "cells", *BOUNDS, "odd"]))


def _looked_up(keys: np.ndarray, known: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys are known, and each one's row of ``values``; zeros for others."""
    found = np.zeros((len(keys), values.shape[1]), values.dtype)
    if not len(known):
        return np.zeros(len(keys), bool), found
    order = np.argsort(known)
    at = order[np.minimum(np.searchsorted(known, keys, sorter=order), len(known) - 1)]
    same = known[at] == keys
    found[same] = values[at[same]]
    return same, found


#: What bounds the links of a group.
BOUNDS = ["low", "high", "beyond", "under"]


def _run_starts(*values: np.ndarray) -> np.ndarray:
    """Where runs of equal values of sorted arrays begin."""
    new = np.zeros(len(values[0]), bool)
    new[:1] = True
    for x in values:
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


def shared_tokens(columns: DataFrame, similarity: Similarity) -> DataFrame:
    """``a, b, shared`` for groups of different components that share cells and may link by their bounds, per range of tokens.

    Rows with a null ``b`` count the cells of ``a`` in long columns that were
    not paired with others of their kind.
    """

    def meet(group: pd.DataFrame) -> pd.DataFrame:
        cells = _unpacked(group["cells"], np.int64)
        bounds = [_unpacked(group[k], np.uint32).astype(np.int64) for k in BOUNDS]
        odd = _unpacked(group["odd"], np.uint64).reshape(-1, PARITIES // 64)
        pairs, unpaired = group_pairs(
            _unpacked(group["tokens"], np.uint64), cells >> 2, cells & 1 == 1, similarity, bounds, cells & 2 == 2, odd
        )
        found = pd.DataFrame(dict(zip(("a", "b", "shared"), pairs))).astype({"b": "Int64"})
        alone, n = np.unique(unpaired, return_counts=True)
        return pd.concat([found, pd.DataFrame({"a": alone, "b": pd.array([None] * len(alone), "Int64"), "shared": n})])

    met = columns.groupBy("bucket").applyInPandas(meet, "a long, b long, shared long")
    return met.groupBy("a", "b").agg(F.sum("shared").alias("shared"))


def group_pairs(
    tokens: np.ndarray,
    groups: np.ndarray,
    index: np.ndarray,
    similarity: Similarity | None = None,
    bounds: list[np.ndarray] | None = None,
    alone: np.ndarray | None = None,
    odd: np.ndarray | None = None,
) -> tuple[tuple, np.ndarray]:
    """Pairs of groups of different components with the tokens they share, and groups of unpaired cells.

    In columns of more than ``LONG_COLUMN`` cells, those outside the index
    prefixes are paired with those inside only.  With ``bounds`` of each cell's group (``bound_groups``), groups
    whose sizes are too far apart, or that cannot share as many tokens as a link takes, make no pair, and with the parities
    ``odd`` of groups that are ``alone`` those whose sets differ in too many.  As a group has
    the same bounds in all its cells, a pair is made in all its columns or in none.
    """
    order = np.lexsort((~index, groups, tokens))
    tokens, groups = tokens[order], groups[order]
    new = np.ones(len(tokens), bool)
    new[1:] = (tokens[1:] != tokens[:-1]) | (groups[1:] != groups[:-1])
    tokens, groups, index = tokens[new], groups[new], index[order][new]
    small, large, beyond, under = (x[order][new] for x in bounds) if bounds else [None] * 4
    alone, odd = (None, None) if odd is None else (alone[order][new], odd[order][new])
    column_ends = _run_ends(tokens)
    column_starts = len(tokens) - _run_ends(tokens[::-1])[::-1]
    long = column_ends - column_starts > LONG_COLUMN
    component = groups >> CHUNK_BITS
    edges = np.ones(len(tokens), bool)
    edges[1:] = (tokens[1:] != tokens[:-1]) | (component[1:] != component[:-1])
    own_ends = _run_ends(np.cumsum(edges))
    # short columns: with the cells after the component's own; long ones: inside cells with the whole column
    starts = np.where(long, column_starts, own_ends)
    counts = np.where(long & ~index, 0, column_ends - starts)
    kept: list[tuple] = []
    held, rows = 0, np.flatnonzero(counts)
    sums = np.cumsum(counts[rows])
    low = 0
    while low < len(rows):
        high = max(low + 1, int(np.searchsorted(sums, (sums[low - 1] if low else 0) + HELD_PAIRS)))
        part = rows[low:high]
        left = np.repeat(part, counts[part])
        begin = np.cumsum(counts[part]) - counts[part]
        right = np.arange(len(left)) - np.repeat(begin, counts[part]) + starts[left]
        # in long columns two inside cells meet twice, and a component meets itself
        once = ~long[left] | (component[left] != component[right]) & (~index[right] | (left < right))
        if bounds:
            p = similarity.percent
            once &= (p * small[left] <= 100 * large[right]) & (p * small[right] <= 100 * large[left])
            most = np.minimum(under[left], under[right]) + np.minimum(beyond[left], beyond[right])
            once &= (100 + p) * most >= p * (small[left] + small[right])
            if odd is not None:
                left, right = left[once], right[once]
                differ = np.bitwise_count(odd[left] ^ odd[right]).sum(axis=1, dtype=np.int64)
                once = ~(alone[left] & alone[right] & similarity.too_different(differ, small[left] + small[right]))
        left, right = groups[left[once]], groups[right[once]]
        kept.append(_summed(np.minimum(left, right), np.maximum(left, right), np.ones(len(left), np.int64)))
        held += len(kept[-1][0])
        if held > HELD_PAIRS:
            kept = [_summed(*map(np.concatenate, zip(*kept)))]
            held = len(kept[0][0])
        low = high
    empty = np.zeros(0, np.int64)
    pairs = _summed(*map(np.concatenate, zip(*kept))) if kept else (empty, empty, empty)
    return pairs, groups[long & ~index]


def _run_ends(values: np.ndarray) -> np.ndarray:
    """Per value of a sorted array where its run ends."""
    if not len(values):
        return np.zeros(0, np.int64)
    edges = np.append(True, values[1:] != values[:-1])
    return np.append(np.flatnonzero(edges)[1:], len(values))[np.cumsum(edges) - 1]


def _summed(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((b, a))
    a, b, n = a[order], b[order], n[order]
    at = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))[: len(a)])
    return a[at], b[at], np.add.reduceat(n, at) if len(at) else n


class Corpus:
    """Documents and their nodes, and exact comparison of nodes with groups."""

    def __init__(self, docs: DataFrame, nodes: DataFrame, similarity: Similarity, width: int):
        self.docs, self.nodes, self.similarity, self.width = docs, nodes, similarity, width

    def texts(self, wanted: DataFrame) -> DataFrame:
        """``node, set_key, text`` of the ``wanted(node)``; a text that repeats an id may be another's."""
        asked = stage(self.nodes.join(wanted.distinct(), "node").select("node", "rep", "set_key"), "wanted")
        side = F.broadcast(asked) if asked.count() <= BROADCAST_NODES else asked.hint("shuffle_hash")
        return self.docs.alias("d").join(side.alias("w"), F.col("d.doc_id").eqNullSafe(F.col("w.rep"))).select(
            "w.node", "w.set_key", "d.text"
        )

    def open(self, pairs: DataFrame, members: DataFrame) -> DataFrame:
        """Links ``u, v`` of ``pairs(query, grp)``: a query and the first member of the group it links with.

        One link to a group is enough, as its ``members(grp, node)`` are of one
        component.  The queries of a group are dealt to tasks of ``QUERIES``
        each, which read the group once and then compare a stream of queries.
        """
        similarity, width = self.similarity, self.width
        asked = pairs.groupBy("grp").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("copies"))
        queries = pairs.join(asked, "grp").select(
            "grp", F.pmod(F.xxhash64("query"), F.col("copies")).cast("int").alias("copy"), F.lit(1).alias("kind"), F.col("query").alias("node")
        )
        held = members.join(asked, "grp").select(
            "grp", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"), F.lit(0).alias("kind"), "node"
        )
        roles = stage(queries.unionByName(held), "roles")
        dealt = roles.join(self.texts(roles.select("node")), "node").repartition("grp", "copy")

        found = pa.schema([("u", pa.int64()), ("v", pa.int64())])

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            at, group, union = None, {}, None
            for *known, texts in (part for batch in batches for part in _sliced(batch)):
                links = []
                for grp, copy, kind, node, key, tokens in zip(*known, shingle_sets(texts, width)):
                    if set_key(tokens) != key:
                        continue
                    if (grp, copy) != at:
                        at, group, union = (grp, copy), {}, None
                    if kind == 0:
                        group[node] = tokens
                    else:
                        if union is None:
                            union = np.unique(np.concatenate(list(group.values()))) if len(group) > 1 else None
                            least = min(map(len, group.values()), default=0)
                        bound = len(tokens) if union is None else overlap(tokens, union)
                        if similarity.links(bound, len(tokens), least):
                            for other, its in group.items():
                                if other != node and similarity.links(overlap(tokens, its), len(tokens), len(its)):
                                    links.append((node, other))
                                    break
                yield _record_batch(links, found)

        ordered = dealt.sortWithinPartitions("grp", "copy", "kind", "node")
        return ordered.select("grp", "copy", "kind", "node", "set_key", "text").mapInArrow(compare, "u long, v long")


def distinct_sets(sketched: DataFrame) -> DataFrame:
    """``node, rep, set_key, n, bins``: one node per distinct set, numbered from 0, with its smallest document."""
    rows = sketched.where("set_key is not null")
    grouped = rows.groupBy("set_key").agg(
        F.min(F.col("doc_id").cast("long")).alias("rep"), F.first("n").alias("n"), F.first("bins").alias("bins")
    )
    numbered = stage(grouped.withColumn("row", F.monotonically_increasing_id()), "sets")
    task = F.shiftright("row", 33)
    counts = numbered.groupBy(task.alias("task")).count()  # one row per task
    earlier = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("task", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("first"))
    inside = F.col("row").bitwiseAND((1 << 33) - 1)
    return numbered.join(F.broadcast(firsts), task == F.col("task")).select(
        (F.col("first") + inside).alias("node"), "rep", "set_key", "n", "bins"
    )


def proposed_pairs(nodes: DataFrame, similarity: Similarity) -> DataFrame:
    """``query, grp``: nodes and, of those that share bins with them, the one whose bins are shared most.

    Of copies that differ in some words, that is the one nearest to all others.
    """
    bins = nodes.select("node", "n", F.posexplode("bins").alias("bin", "least")).where("least is not null")
    shared = bins.groupBy("bin", "least").agg(F.count("*").alias("copies")).where("copies > 1")
    met = bins.join(shared, ["bin", "least"]).groupBy("node", "n")  # a node has BINS rows at most
    held = met.agg(F.sum("copies").alias("weight"), F.collect_list(F.struct("bin", "least")).alias("bins"))
    weighed = held.select("node", "n", "weight", F.inline("bins"))
    order = F.struct("weight", (-F.col("node")).alias("place"))
    first = weighed.groupBy("bin", "least").agg(F.max_by(F.struct("node", "n"), order).alias("first"))
    asked = weighed.join(first, ["bin", "least"]).where("node <> first.node")
    sizes = F.least("n", "first.n") * 100 >= F.greatest("n", "first.n") * similarity.percent
    counted = asked.where(sizes).groupBy("node", F.col("first.node").alias("grp"), "n").agg(F.count("*").alias("bins"))
    return counted.where((F.col("bins") >= AGREED) | (F.col("n") < 4 * BINS)).select(F.col("node").alias("query"), "grp")


def near_duplicates(docs: DataFrame, percent: int = 75, width: int = 5) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs(doc_id, text)``.

    ``text_hash`` tells rows of one id apart, ``component`` components whose
    smallest ids are equal; it is null for empty sets.
    """
    spark = docs.sparkSession
    similarity = Similarity(percent)
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    sketched = stage(sketch_documents(rows, similarity, width, buckets), "sketches")
    described = sketched.where("bucket is null")
    nodes = stage(distinct_sets(described), "nodes")
    corpus = Corpus(rows, nodes, similarity, width)

    proposed = stage(proposed_pairs(nodes, similarity), "proposed")
    leaders = proposed.select("grp", F.col("grp").alias("node")).distinct()
    first = connected_components(corpus.open(proposed, leaders))
    groups = stage(token_groups(nodes, first), "groups")

    often = frequent_tokens(sketched.where("bucket is not null"))
    if len(often):
        more = frequent_tokens(count_further(rows, spark.sparkContext.broadcast(often), similarity, width, buckets))
        often = np.union1d(often, more)
    frequent = spark.sparkContext.broadcast(often)
    known = groups.select("rep", "set_key", "grp", "alone").hint("shuffle_hash")
    texts = rows.alias("d").join(known.alias("g"), F.col("d.doc_id").eqNullSafe(F.col("g.rep"))).select("g.set_key", "g.grp", "g.alone", "d.text")
    met = met_cells(matrix_columns(texts, frequent, similarity, width, buckets), buckets)
    shared = stage(shared_tokens(bound_groups(met, buckets), similarity), "shared-tokens")
    opened = stage(qualifying_groups(shared, groups, similarity), "opened")
    members = groups.select("grp", "node")
    queries = opened.join(members.select(F.col("grp").alias("a"), F.col("node").alias("query")), "a")
    found = corpus.open(queries.select("query", F.col("b").alias("grp")).distinct(), members)

    of = groups.select("node", "component")
    links = stage(found, "found")
    between = (
        links.join(of.select(F.col("node").alias("u"), F.col("component").alias("cu")), "u")
        .join(of.select(F.col("node").alias("v"), F.col("component").alias("cv")), "v")
        .select(F.col("cu").alias("u"), F.col("cv").alias("v"))
    )
    merged = connected_components(between).select(F.col("node").alias("component"), F.col("component").alias("final"))
    final = groups.join(merged, "component", "left").select("set_key", "rep", F.coalesce("final", "component").alias("final"))
    names = final.groupBy("final").agg(F.min("rep").alias("component_id"))
    named = final.join(names, "final").select("set_key", "component_id", F.col("final").alias("component"))
    listed = described.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("n").alias("n_shingles"), "set_key", "text_hash")
    return listed.join(named, "set_key", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        "text_hash",
        "component",
    )


def token_groups(nodes: DataFrame, components: DataFrame) -> DataFrame:
    """``node, rep, set_key, n, component, grp, alone``: components cut into groups of about ``GROUP`` nodes."""
    sizes = components.groupBy("component").agg(F.count("*").alias("size"))
    placed = nodes.join(components.join(sizes, "component"), "node", "left")
    parts = F.ceil(F.coalesce("size", F.lit(1)) / GROUP)
    component = F.coalesce("component", "node")
    return placed.select(
        "node",
        "rep",
        "set_key",
        "n",
        component.alias("component"),
        F.shiftleft(component, CHUNK_BITS).bitwiseOR(F.pmod(F.xxhash64("node"), parts).cast("long")).alias("grp"),
        F.col("size").isNull().alias("alone"),
    )


def qualifying_groups(shared: DataFrame, groups: DataFrame, similarity: Similarity) -> DataFrame:
    """``a, b`` of the pairs whose overlap bound allows a link; ``a`` has fewer members.

    Two members share at most the tokens that their groups' prefixes share,
    those of unpaired cells of both, and the tokens of one of them beyond its
    prefix.
    """
    sizes = groups.groupBy("grp").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.count("*").alias("nodes"))
    unpaired = shared.where("b is null").select(F.col("a").alias("grp"), F.col("shared").alias("unpaired"))
    sizes = sizes.join(unpaired, "grp", "left").fillna(0, ["unpaired"])
    side = lambda name: sizes.select(
        F.col("grp").alias(name), F.struct("low", "high", "nodes", "unpaired").alias(f"{name}_size")
    )
    p = similarity.percent
    beyond = F.ceil(F.greatest("a_size.high", "b_size.high") * p / 100) - 1
    least = F.col("a_size.low") + F.col("b_size.low")
    fits = (F.col("a_size.low") * p <= F.col("b_size.high") * 100) & (F.col("b_size.low") * p <= F.col("a_size.high") * 100)
    most = F.col("shared") + F.least("a_size.unpaired", "b_size.unpaired") + beyond
    may = most * (100 + p) >= least * p
    met = shared.where("b is not null").join(side("a"), "a").join(side("b"), "b").where(fits & may)
    swap = F.col("a_size.nodes") > F.col("b_size.nodes")
    return met.select(F.when(swap, F.col("b")).otherwise(F.col("a")).alias("a"), F.when(swap, F.col("a")).otherwise(F.col("b")).alias("b"))
