"""Token ids as Arrow files of equal-length sequences with masks.

Documents are encoded in ascending ``doc_id`` order, each followed by an end
id, and packed one after another into sequences of ``length`` ids.  A file is
an Arrow IPC file whose batches hold

- ``tokens``  fixed-size list of ids (16 bits if the vocabulary allows, else 32),
- ``valid``   fixed-size list of booleans, false on the padding of the last sequence,
- ``ends``    fixed-size list of booleans, true on the last id of a document,
- ``doc_ids`` the ids of the documents that end in the sequence.

All batches but the last have the same number of sequences, so sequence ``i``
is row ``i % rows`` of batch ``i // rows``: a reader maps the file and slices
it without copying.  A file holds whole documents; its schema carries its
place in the order.

Defined results: a null or empty text is the end id alone; null ids sort
first; rows with the same id are ordered by their text's hash and text, and
each is encoded; an empty table gives no files.  Other columns are ignored.
"""

from __future__ import annotations

import functools
import itertools
import os
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from strata.llm.blobs import read_blobs, write_blobs
from strata.llm.words import cut_words, distinct_words
from strata.operators.staging import stage

# Fixed value of the format: the magic that ends an Arrow IPC file.
ENDING = "ARROW1"

#: Distinct words in each of the two generations that a Python worker keeps encoded.
KEPT_WORDS = 100_000

#: Bytes of text that are cut into words at once; a longer text goes in pieces that end at blanks.
CUT_AT_ONCE = 1 << 20

#: Words encoded in one call.
CALL_WORDS = 2_000

SPAN_SCHEMA = "file_no long, file_tokens long, place long, doc_id long, in_file long, n_tokens long, ids_crc32 long"


class WordEncoder:
    """Encodes texts with a tokenizer, each distinct word of many texts once.

    Texts are cut at blanks and line feeds, and ASCII letters are cut from the
    punctuation behind them.  That is exact for tokenizers that lower their
    input, drop white space and merge within runs of letters only, such as the
    one this module is used with; a test holds it against whole texts.
    """

    def __init__(self, tokenizer_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark deals out the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        size = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.closes = np.zeros(size, bool)  # ids that end a run of letters
        for token, i in self.tokenizer.get_vocab().items():
            self.closes[i] = bool(suffix) and token.endswith(suffix)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [token.content.encode().lower() for token in added]
        self.known: dict[bytes, bytes] = {}
        self.last: dict[bytes, bytes] = {}

    def encode_all(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """The ids of each text, in order."""
        held: list[bytes] = []
        size = 0
        for text in texts:
            raw = text.encode().lower()  # A-Z only
            whole = any(token in raw for token in self.added)
            if whole or len(raw) > CUT_AT_ONCE:
                yield from self._encoded(held)
                held, size = [], 0
            if whole:  # strings that the tokenizer looks for before it cuts
                yield np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype)
                continue
            if len(raw) > CUT_AT_ONCE:
                yield np.concatenate([ids for piece in _pieces(raw) for ids in self._encoded([piece])])
                continue
            if held and size + len(raw) > CUT_AT_ONCE:
                yield from self._encoded(held)
                held, size = [], 0
            held.append(raw)
            size += len(raw) + 1
        yield from self._encoded(held)

    def _encoded(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        if not texts:
            return
        data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        first = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
        starts, lengths = cut_words(data)
        if not len(starts):
            yield from (np.zeros(0, self.dtype) for _ in texts)
            return
        one, same = distinct_words(data, starts, lengths)
        raw = data.tobytes()
        words = [raw[i:j] for i, j in zip(starts[one].tolist(), (starts + lengths)[one].tolist())]
        found = self._ids(words)
        counts = np.array([len(x) for x in found]) // self.dtype.itemsize
        bank = np.frombuffer(b"".join(found), self.dtype)
        ids, before = _gather(bank, np.cumsum(counts) - counts, counts, same)
        for i, j in itertools.pairwise(before[np.searchsorted(starts, first)].tolist()):
            yield ids[i:j]

    def _ids(self, words: list[bytes]) -> list[bytes]:
        if len(self.known) > KEPT_WORDS:
            self.known, self.last = {}, self.known
        known = self.known
        found = list(map(known.get, words))
        unknown = [i for i, ids in enumerate(found) if ids is None]
        new = []
        for i in unknown:
            if words[i] in self.last:
                known[words[i]] = self.last[words[i]]
            else:
                new.append(words[i])
        text = {word: word.decode() for word in new}
        letters = [w for w in new if text[w].isalpha()]
        for i in range(0, len(letters), CALL_WORDS):
            self._runs(letters[i : i + CALL_WORDS], text)
        self._each([w for w in new if w not in known], text)
        for i in unknown:
            found[i] = known[words[i]]
        return found

    def _runs(self, words: list[bytes], text: dict[bytes, str]) -> None:
        """Runs of letters in one call, if each ends in just one closing id."""
        joined = " ".join(text[w] for w in words)
        ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, self.dtype)
        stops = (np.flatnonzero(self.closes[ids]) + 1) * self.dtype.itemsize
        if len(stops) == len(words) and stops[-1] == ids.nbytes:
            raw, stops = ids.tobytes(), stops.tolist()
            self.known.update(zip(words, map(raw.__getitem__, map(slice, [0, *stops], stops))))

    def _each(self, words: list[bytes], text: dict[bytes, str]) -> None:
        for i in range(0, len(words), CALL_WORDS):
            part = words[i : i + CALL_WORDS]
            found = self.tokenizer.encode_batch_fast([text[w] for w in part], add_special_tokens=False)
            self.known.update((w, np.array(x.ids, self.dtype).tobytes()) for w, x in zip(part, found))


def _pieces(raw: bytes) -> Iterator[bytes]:
    start = 0
    while start < len(raw):
        stop = raw.find(b" ", start + CUT_AT_ONCE)
        stop = len(raw) if stop < 0 else stop
        yield raw[start:stop]
        start = stop


def _gather(bank: np.ndarray, first: np.ndarray, counts: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bank's runs named by ``which`` one after another, and where each starts (and the end)."""
    sizes = counts[which]
    before = np.concatenate([[0], np.cumsum(sizes)])
    at = np.arange(before[-1]) + np.repeat(first[which] - before[:-1], sizes)
    return bank[at], before


@functools.cache
def encoder(tokenizer_path: str) -> WordEncoder:
    """One per Python worker: Spark uses a worker for many tasks, and its words come again."""
    return WordEncoder(tokenizer_path)


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    end_id: int = 1,
    length: int = 2048,
    batch_rows: int = 256,
    file_tokens: int = 2 << 20,
    order: list[str] | None = None,
) -> None:
    """Write ``docs(doc_id, text)`` as files of about ``file_tokens`` ids each.

    ``order`` names columns to order by instead of the id.  The range shuffle that sorts the
    documents splits any range of ids; a task holds one file at a time, and a
    document of more ids than a file makes a longer file.
    """
    keys = order or ["doc_id"]
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        *(F.col(name).alias(f"key{i}") for i, name in enumerate(keys)),
    )
    by = [F.col(f"key{i}").asc_nulls_first() for i in range(len(keys))] + [F.xxhash64("text")]
    ordered = rows.repartitionByRange(*by).sortWithinPartitions(*by, "text")

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = encoder(tokenizer_path)
        end = np.array([end_id], words.dtype)
        task, number = TaskContext.get().partitionId(), 0
        parts, ids, sizes, held = [], [], [], 0
        for batch in batches:
            for doc_id, tokens in zip(batch["doc_id"], words.encode_all(batch["text"])):
                parts += [tokens, end]
                ids.append(doc_id)
                sizes.append(len(tokens) + 1)
                held += sizes[-1]
                if held >= file_tokens:
                    yield pd.DataFrame({"content": [_file(parts, ids, sizes, length, batch_rows, task << 32 | number)]})
                    parts, ids, sizes, held, number = [], [], [], 0, number + 1
        if ids:
            yield pd.DataFrame({"content": [_file(parts, ids, sizes, length, batch_rows, task << 32 | number)]})

    # ids as text: pandas would turn nullable longs into doubles
    packed = ordered.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInPandas(pack, "content binary")
    write_blobs(packed, path, ENDING)


def _file(parts: list, ids: list, sizes: list, length: int, batch_rows: int, file_no: int) -> bytes:
    """The bytes of one Arrow IPC file, without its closing magic."""
    tokens = np.concatenate(parts)
    n = len(tokens)
    rows = -(-n // length)
    flat = np.zeros(rows * length, tokens.dtype)
    flat[:n] = tokens
    last = np.cumsum(sizes) - 1
    ends = np.zeros(rows * length, bool)
    ends[last] = True
    valid = np.arange(rows * length) < n
    counts = np.searchsorted(last, np.arange(rows + 1) * length)
    doc_ids = pa.array([None if x is None else int(x) for x in ids], pa.int64())
    columns = [
        pa.FixedSizeListArray.from_arrays(pa.array(flat), length),
        pa.FixedSizeListArray.from_arrays(pa.array(valid), length),
        pa.FixedSizeListArray.from_arrays(pa.array(ends), length),
        pa.ListArray.from_arrays(pa.array(counts, pa.int32()), doc_ids),
    ]
    names = ["tokens", "valid", "ends", "doc_ids"]
    schema = pa.schema([(k, c.type) for k, c in zip(names, columns)]).with_metadata(
        {"file_no": str(file_no), "n_tokens": str(n), "batch_rows": str(batch_rows)}
    )
    sink = pa.BufferOutputStream()
    with pa.ipc.new_file(sink, schema) as writer:
        writer.write_table(pa.Table.from_arrays(columns, schema=schema), max_chunksize=batch_rows)
    return sink.getvalue().to_pybytes()[: -len(ENDING)]


class TokenFile:
    """Random access to the sequences of one file, by memory map or from bytes."""

    def __init__(self, source: str | bytes):
        buffer = pa.memory_map(source) if isinstance(source, str) else pa.BufferReader(source)
        self.reader = pa.ipc.open_file(buffer)
        head = {k.decode(): int(v) for k, v in self.reader.schema.metadata.items()}
        self.file_no, self.n_tokens, self.batch_rows = head["file_no"], head["n_tokens"], head["batch_rows"]
        self.length = self.reader.schema.field("tokens").type.list_size

    def __len__(self) -> int:
        return -(-self.n_tokens // self.length)

    def sequence(self, i: int) -> tuple[np.ndarray, pa.Array, pa.Array]:
        """Ids (a view of the file), ``valid`` and ``ends`` of sequence ``i``."""
        if not 0 <= i < len(self):
            raise IndexError(i)
        batch, row = self.reader.get_batch(i // self.batch_rows), i % self.batch_rows
        cut = [batch.column(k).flatten().slice(row * self.length, self.length) for k in range(3)]
        return cut[0].to_numpy(zero_copy_only=True), cut[1], cut[2]

    def spans(self) -> Iterator[tuple]:
        """Per document: place in the file, id, first id's place, ids, crc32."""
        table = self.reader.read_all()
        flat = [np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in table.column(k).chunks]) for k in ("tokens", "ends")]
        doc_ids = [x for c in table.column("doc_ids").chunks for x in c.flatten().to_pylist()]
        stops = np.flatnonzero(flat[1]) + 1
        wide = flat[0].astype("<u4")
        start = 0
        for place, (doc_id, stop) in enumerate(zip(doc_ids, stops.tolist(), strict=True)):
            yield place, doc_id, start, stop - start, zlib.crc32(wide[start:stop])
            start = stop


def read_token_spans(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files: ``doc_id, start, n_tokens, ids_crc32``.

    ``start`` counts the ids of all documents before it.  The files' totals
    are summed in a window over one row per file.
    """

    def spans(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [field.split()[0] for field in SPAN_SCHEMA.split(", ")]
        for batch in batches:
            for content in batch["content"]:
                file = TokenFile(content)
                rows = [(file.file_no, file.n_tokens, *span) for span in file.spans()]
                yield pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})

    read = read_blobs(spark, path).select("content").mapInPandas(spans, SPAN_SCHEMA)
    rows = stage(read, "token-spans")
    files = rows.where("place = 0").select("file_no", "file_tokens")
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("file_no", F.coalesce(F.sum("file_tokens").over(before), F.lit(0)).alias("before"))
    return rows.join(starts, "file_no").select(
        "doc_id", (F.col("before") + F.col("in_file")).alias("start"), "n_tokens", "ids_crc32"
    )
