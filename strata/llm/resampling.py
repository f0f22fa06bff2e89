"""Importance resampling of documents towards the n-gram distribution of a target corpus.

Features are the runs of one to three consecutive words, hashed into buckets.
A bucket's gain is the log ratio of its smoothed shares among the target's
features and all documents'; a document's weight is the sum of its features'
gains, and documents are drawn without replacement by the largest weight plus
Gumbel noise.

A Python task takes its texts by the batch: they are joined with a sentinel
between them, one pass of a regular expression finds all words and sentinels,
and each distinct word is hashed once.  Hashes of longer features come from
those of their words, as a CRC of joined strings follows from the parts' CRCs.
The sentinels' places are the documents' offsets; n-grams that reach over one
are masked out by looking their first word's document up in the offsets with
``searchsorted``, and the buckets of the rest are counted with ``bincount``.

Texts are read twice: once for the corpus counts, of which a task gives one
row per bucket, added up by Spark, and once for the documents' sums.  Gains
are a vector of a fixed number of buckets.  The drawn documents' ranks come
from a range shuffle of (score, id), so that no task sees all documents.

Defined results: a null or empty text has no words, no features and weight 0;
null ids enter the noise as an empty id and come last among equal scores; rows
that share an id and score are ranked by their text's hash, and rows equal in both in any
order; other columns are ignored; an empty target has gains all the same (every t is 0); an empty
table gives no rows.  A text is cut in windows of bounded size, whatever its
length.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from strata.llm.ranks import row_numbers
from strata.operators.staging import stage

#: Words, and the sentinel between texts; texts have their A-Z lowered and their own NULs, which part words as blanks do, replaced.
TOKEN = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+|\x00")

#: What parts words.
GAP = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]")

#: Bytes of text in one pass of the expression.
BATCH_BYTES = 2 << 20

#: Distinct words that a task keeps hashed.
KEPT_WORDS = 200_000

LONGEST_RUN = 3

SCORED = "doc_id long, text_hash long, n_words long, n_features long, weight long"


class Crc:
    """CRC-32 of joined byte strings from those of their parts, for arrays."""

    def __init__(self) -> None:
        self.shifts: dict[int, np.ndarray] = {}

    def tables(self, power: int) -> np.ndarray:
        """What appending ``2 ** power`` zero bytes does to each byte of a CRC: four tables of 256."""
        if power not in self.shifts:
            if power:
                half = self.tables(power - 1)
                self.shifts[power] = np.stack([self.through(half, t) for t in half])
            else:  # the library inverts the register before and after
                one = [[zlib.crc32(b"\0", v << 8 * k ^ 0xFFFFFFFF) ^ 0xFFFFFFFF for v in range(256)] for k in range(4)]
                self.shifts[0] = np.array(one, np.uint32)
        return self.shifts[power]

    @staticmethod
    def through(tables: np.ndarray, crcs: np.ndarray) -> np.ndarray:
        a, b, c, d = (tables[k][(crcs >> np.uint32(8 * k)) & np.uint32(255)] for k in range(4))
        return a ^ b ^ c ^ d

    def joined(self, left: np.ndarray, right: np.ndarray, right_bytes: np.ndarray) -> np.ndarray:
        """CRCs of the left strings followed by the right ones, of ``right_bytes`` bytes."""
        left = left.copy()
        power, rest = 0, right_bytes
        while rest.any():
            odd = np.flatnonzero(rest & 1)
            left[odd] = self.through(self.tables(power), left[odd])
            power, rest = power + 1, rest >> 1
        return left ^ right


class Features:
    """Buckets of the features of many texts."""

    def __init__(self, n_buckets: int):
        self.n_buckets = np.uint32(n_buckets)
        self.crc = Crc()
        self.forget()

    def forget(self) -> None:
        self.index: dict[bytes, int] = {b"\0": 0}
        #: By word: CRC, CRC with a blank before it, bytes with that blank.
        self.alone, self.behind, self.width = [np.zeros(1, t) for t in (np.uint32, np.uint32, np.int64)]

    def _learn(self, words: list[bytes]) -> None:
        for word in words:
            self.index[word] = len(self.index)
        self.alone = np.concatenate([self.alone, np.array([zlib.crc32(w) for w in words], np.uint32)])
        self.behind = np.concatenate([self.behind, np.array([zlib.crc32(b" " + w) for w in words], np.uint32)])
        self.width = np.concatenate([self.width, np.array([len(w) + 1 for w in words], np.int64)])

    def of_batch(self, texts: list[bytes], counted: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each length of run: the buckets of its features, and the place of the text of each.

        The first ``counted`` words have been in a batch before; features of them alone are left out.
        """
        found = TOKEN.findall(b"\0".join(texts))
        if len(self.index) > KEPT_WORDS:
            self.forget()
        if new := set(found).difference(self.index):
            self._learn(list(new))
        self.tail = found[1 - LONGEST_RUN :]
        at = np.fromiter(map(self.index.__getitem__, found), np.int64, len(found))
        offsets = np.flatnonzero(at == 0)  # the sentinels; words have other numbers
        place = np.arange(len(at))
        text_of = np.searchsorted(offsets, place)
        ends = np.append(offsets, len(at))[text_of]  # where the token's text ends
        hashes = self.alone[at]
        for run in range(1, LONGEST_RUN + 1):
            first = place[place + run <= ends]  # no sentinel in the run
            if run > 1:
                last = at[first + run - 1]
                hashes[first] = self.crc.joined(hashes[first], self.behind[last], self.width[last])
            first = first[first + run > counted]
            yield (hashes[first] % self.n_buckets).astype(np.int64), text_of[first]

    def of_texts(self, texts: Iterable[bytes | None]) -> Iterator[tuple[int, list[tuple[np.ndarray, np.ndarray]]]]:
        """Batches of texts: the number of the first text, and ``of_batch``.

        A text that is longer than a batch comes in windows that end where a
        word does; the next window begins with the last words of the one before.
        """
        start, held, size = 0, [], 0
        for number, text in enumerate(texts):
            raw = (text or b"").lower().replace(b"\0", b" ")  # A-Z only
            if held and size + len(raw) > BATCH_BYTES:
                yield start, list(self.of_batch(held))
                start, held, size = number, [], 0
            if len(raw) <= BATCH_BYTES:
                held.append(raw)
                size += len(raw) + 1
                continue
            begin, known = 0, []
            while begin < len(raw):
                gap = GAP.search(raw, begin + BATCH_BYTES)
                stop = gap.start() if gap else len(raw)
                yield number, list(self.of_batch([b" ".join([*known, raw[begin:stop]])], len(known)))
                begin, known = stop, self.tail
            start = number + 1
        if held:
            yield start, list(self.of_batch(held))


def bucket_counts(texts: DataFrame, n_buckets: int) -> DataFrame:
    """``bucket, n`` of the features of ``texts(text)``; buckets without features have no row."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(n_buckets)
        total = np.zeros(n_buckets, np.int64)
        for batch in batches:
            for _, runs in features.of_texts(text.as_py() for text in batch.column("text")):
                for buckets, _ in runs:
                    total += np.bincount(buckets, minlength=n_buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": some, "n": total[some]})

    counted = texts.select(F.col("text").cast("string").cast("binary").alias("text")).mapInArrow(count, "bucket long, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(target: DataFrame, corpus: DataFrame, n_buckets: int) -> np.ndarray:
    """Per bucket, 1000 times the log of its smoothed share in ``target`` by that in ``corpus``, rounded down."""

    def counts(texts: DataFrame) -> np.ndarray:
        found = np.zeros(n_buckets)
        for bucket, n in bucket_counts(texts, n_buckets).collect():  # one row per bucket
            found[bucket] = n
        return found

    t, s = counts(target), counts(corpus)
    ratio = (t + 1) * (s.sum() + n_buckets) / ((s + 1) * (t.sum() + n_buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """``doc_id, text_hash, n_words, n_features, weight`` of ``docs(doc_id, text)``."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(len(gain))
        for batch in batches:
            n = batch.num_rows
            words, many, weight = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
            for start, runs in features.of_texts(text.as_py() for text in batch.column("text")):
                for run, (buckets, text_of) in enumerate(runs):
                    each = np.bincount(text_of)
                    rows = slice(start, start + len(each))
                    many[rows] += each
                    weight[rows] += np.bincount(text_of, gain[buckets]).astype(np.int64)
                    if not run:
                        words[rows] += each
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), *map(pa.array, (words, many, weight))],
                names=["doc_id", "text_hash", "n_words", "n_features", "weight"],
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.col("text").cast("string")).alias("text_hash"),
        F.col("text").cast("string").cast("binary").alias("text"),
    )
    return rows.mapInArrow(sums, SCORED)


def resample(
    docs: DataFrame, target: DataFrame, percent: int, min_words: int, seed: str, n_buckets: int = 10_000
) -> DataFrame:
    """Draw ``percent`` of the documents of at least ``min_words`` words towards ``target(text)``.

    Every document comes back: ``doc_id, text_hash, n_words, n_features, weight, score, rank``, the
    rank (from 1) null where it is not drawn.
    """
    weighed = stage(weigh(docs, gains(target, docs, n_buckets)), "weighed")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    share = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    noise = F.floor(-1000 * F.log(-F.log(share)))
    enough = F.col("n_words") >= min_words
    scored = weighed.withColumn("score", F.col("weight") + noise)
    drawn = percent * weighed.where(enough).count() // 100
    order = [(~enough).asc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("text_hash").asc()]
    numbered = row_numbers(scored, order, "drawn", "number")
    rank = F.when(enough & (F.col("number") < drawn), F.col("number") + 1)
    return numbered.withColumn("rank", rank).drop("number")
