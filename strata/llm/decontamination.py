"""Finding benchmark items in training passages by BM25 and block-max WAND.

The test items are the indexed side: few, short and of bounded size.  Every
passage of every document is a query.  Scores are relative: an item's BM25
weights are divided by their sum, so that a passage with all of its words
scores 1, and one threshold serves all items.

Words of items and documents alike are runs of letters and digits in lower
case; every other character separates them.

Passages are two adjacent halves of ``half`` words, so they overlap by half;
items longer than a half are indexed in parts of a half each, and any part
that stands in a document lies inside one passage.  Passages are first bound
all at once by the largest weights of their words, over the whole index and
then by blocks of items; those that may reach the threshold are searched by
WAND with block maxima.  A retrieved item is reported if enough of the word
triples of its question (the first two thirds of its words) and of its answer
(the rest) stand around the passage.

Defined results: null and empty texts have no passages; items without words
are never found; a null document or item id is returned as null; repeated rows
each get their rows; equal items are all found; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from strata.llm.words import cut_words, distinct_words
from strata.operators.staging import stage

# BM25's usual constants.
K1, B = 1.2, 0.75

#: Bytes of text that are looked through at once; a longer text goes alone.
AT_ONCE = 1 << 20

#: Blocks of an index at most, and parts of items in a block at least.
MOST_BLOCKS = 64
BLOCK_ITEMS = 4

#: What separates words: all but letters and digits; the same for ASCII bytes, which are lower-cased as well.
SEPARATORS = re.compile(r"[\W_]+")
ASCII_WORDS = bytes(ord(chr(c).lower()) if chr(c).isalnum() else 32 for c in range(128)) + bytes(range(128, 256))

RESULT = "doc_id long, text_hash long, item_id long, score double, question_overlap double, answer_overlap double"


def words_only(text: str) -> bytes:
    """The text's words in lower case with blanks between them."""
    if text.isascii():
        return text.encode().translate(ASCII_WORDS)
    return SEPARATORS.sub(" ", text).lower().encode()


def core_of(word: str) -> str:
    """The word in lower case without marks at its ends."""
    low = word.lower()
    return low.strip("".join({c for c in low if not c.isalnum()})) if not low.isalnum() else low


def overlap(part: list[int], around: set[tuple], words: set[int]) -> float:
    """Share of the part's word triples (its words, if it has under three) that stand around."""
    if len(part) < 3:
        return sum(w in words for w in part) / len(part) if part else 1.0
    triples = set(zip(part, part[1:], part[2:]))
    return len(triples & around) / len(triples)


class BlockMaxIndex:
    """Postings of normalised BM25 weights with the maximum of every block of items."""

    def __init__(self, parts: list[tuple[int | None, list[str] | None, dict[str, float]]], texts: dict):
        """``parts``: key into ``texts``, words (not needed) and weights; ``texts``: (item id, all its words)."""
        self.vocabulary: dict[str, int] = {}
        for _, words in texts.values():
            for word in words:
                self.vocabulary.setdefault(word, len(self.vocabulary))
        self.items = {k: (i, [self.vocabulary[w] for w in words]) for k, (i, words) in texts.items()}
        self.owners = [key for key, _, _ in parts]
        self.block_items = max(BLOCK_ITEMS, -(-len(parts) // MOST_BLOCKS))
        self.blocks = -(-len(parts) // self.block_items)
        n = len(self.vocabulary)
        self.postings: list[tuple[list[int], list[float]]] = [([], []) for _ in range(n)]
        self.block_max = np.zeros((n, self.blocks), np.float32)
        for number, (_, _, weights) in enumerate(parts):
            for word, weight in weights.items():
                term = self.vocabulary[word]
                self.postings[term][0].append(number)
                self.postings[term][1].append(weight)
                block = number // self.block_items
                self.block_max[term, block] = max(self.block_max[term, block], np.float32(weight * (1 + 1e-6)))
        self.list_max = self.block_max.max(axis=1, initial=0)

    def search(self, terms: set[int], threshold: float) -> list[tuple[int, float]]:
        """All indexed parts whose score reaches the threshold.

        Blocks whose maxima cannot reach it are skipped; the others are walked
        part by part, each time to the first part at which the maxima of the
        lists that have come so far can reach it.
        """
        found = []
        held = [t for t in terms if self.postings[t][0]]
        least = threshold - 1e-6
        sums = self.block_max[held].sum(axis=0) if held else np.zeros(0)
        for block in np.flatnonzero(sums >= least).tolist():
            stop = (block + 1) * self.block_items
            cursors = []  # part, list, place in it
            for term in held:
                places = self.postings[term][0]
                at = bisect_left(places, block * self.block_items)
                if at < len(places) and places[at] < stop:
                    cursors.append((places[at], term, at))
            maxima = self.block_max[:, block]
            while cursors:
                cursors.sort()
                bound, pivot = 0.0, None
                for part, term, _ in cursors:
                    bound += maxima[term]
                    if bound >= least:
                        pivot = part
                        break
                if pivot is None:
                    break
                if cursors[0][0] == pivot:
                    score = sum(self.postings[term][1][at] for part, term, at in cursors if part == pivot)
                    if score >= threshold:
                        found.append((pivot, score))
                    cursors = self._advanced(cursors, pivot + 1, stop)
                else:
                    cursors = self._advanced(cursors, pivot, stop)
        return found

    def _advanced(self, cursors: list, target: int, stop: int) -> list:
        """The cursors moved to ``target`` or beyond; those that leave the block are gone."""
        kept = []
        for part, term, at in cursors:
            if part < target:
                places = self.postings[term][0]
                at = bisect_left(places, target, at)
                if at == len(places) or places[at] >= stop:
                    continue
                part = places[at]
            kept.append((part, term, at))
        return kept


class Finder:
    """Searches texts for the items of an index."""

    def __init__(self, index: BlockMaxIndex, half: int, threshold: float, min_question: float, min_answer: float):
        self.index, self.half, self.threshold = index, half, threshold
        self.min_question, self.min_answer = min_question, min_answer
        self.numbers = {word.encode(): number for word, number in index.vocabulary.items()}

    def find(self, texts: list[str]) -> Iterator[list[tuple]]:
        """Per text its items: id, score and overlaps."""
        held, size = [], 0
        for text in texts:
            raw = words_only(text)
            if held and size + len(raw) > AT_ONCE:
                yield from self._find(held)
                held, size = [], 0
            held.append(raw)
            size += len(raw) + 1
        if held:
            yield from self._find(held)

    def _find(self, texts: list[bytes]) -> Iterator[list[tuple]]:
        raw = b"\n".join(texts) + b"\n"
        starts, lengths = cut_words(np.frombuffer(raw, np.uint8), tail=b"")
        found: dict[int, dict] = {}
        if len(starts):
            one, same = distinct_words(np.frombuffer(raw, np.uint8), starts, lengths)
            words = [raw[i : i + n] for i, n in zip(starts[one].tolist(), lengths[one].tolist())]
            # -1: unknown to the index
            terms = np.array([self.numbers.get(w, -1) for w in words], np.int64)[same]
            edge = np.searchsorted(starts, np.cumsum([0, *(len(t) + 1 for t in texts)]))
            for doc, low, high in self._passages(terms, edge):
                first, last = int(edge[doc]), int(edge[doc + 1])
                for part, score in self.index.search({t for t in terms[low:high].tolist() if t >= 0}, self.threshold):
                    self._verify(found.setdefault(doc, {}), part, score, terms, low, high, first, last)
        for doc in range(len(texts)):
            yield sorted(found.get(doc, {}).values(), key=str)

    def _passages(self, terms: np.ndarray, edge: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Text, first and last word of the passages that the bounds leave."""
        sizes = np.diff(edge)
        halves = -(-sizes // self.half)
        first = np.cumsum(halves) - halves
        if not halves.sum():
            return
        doc = np.repeat(np.arange(len(sizes)), sizes)
        half = first[doc] + (np.arange(len(terms)) - edge[:-1][doc]) // self.half
        known = terms >= 0
        n = len(self.index.vocabulary)
        pairs = np.sort(half[known] * n + terms[known])
        pairs = pairs[np.diff(pairs, prepend=-1) != 0]
        half_of, term_of = pairs // n, pairs % n
        total = int(halves.sum())
        owner = np.repeat(np.arange(len(sizes)), halves)
        paired = np.append(owner[1:] == owner[:-1], False)  # the next half is of the same text
        # a half alone is a passage only where its text has no other
        whole = paired | (halves[owner] == 1)
        least = self.threshold - 1e-5
        bound = np.bincount(half_of, self.index.list_max[term_of], total)
        may = whole & (bound + np.where(paired, np.roll(bound, -1), 0) >= least)
        need = may | np.roll(may & paired, 1)
        keep = need[half_of]
        blocks = np.zeros((total, self.index.blocks), np.float32)
        half_of, term_of = half_of[keep], term_of[keep]
        if len(half_of):
            rows, at = np.unique(half_of, return_index=True)
            blocks[rows] = np.add.reduceat(self.index.block_max[term_of], at, axis=0)
        for h in np.flatnonzero(may).tolist():
            best = (blocks[h] + blocks[h + 1] if paired[h] else blocks[h]).max()
            if best >= least:
                start = int(edge[owner[h]]) + (h - int(first[owner[h]])) * self.half
                yield int(owner[h]), start, min(start + 2 * self.half, int(edge[owner[h] + 1]))

    def _verify(self, found: dict, part: int, score: float, terms, low: int, high: int, first: int, last: int) -> None:
        key = self.index.owners[part]
        item_id, words = self.index.items[key]
        around = terms[max(first, low - len(words)) : min(last, high + len(words))].tolist()
        triples = set(zip(around, around[1:], around[2:]))
        cut = -(-2 * len(words) // 3)
        question, answer = (overlap(p, triples, set(around)) for p in (words[:cut], words[cut:]))
        if question >= self.min_question and answer >= self.min_answer:
            _, s, q, a = found.get(key, (item_id, 0.0, 0.0, 0.0))
            found[key] = (item_id, max(s, score), max(q, question), max(a, answer))


def index_parts(items: DataFrame, half: int) -> DataFrame:
    """``item_id, item, part, words, weights`` of ``items(item_id, text)``; weights sum to 1.

    An item's words come with its first part alone, so that the index is as large as the items are.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = [words_only(t).decode().split() for t in batch["text"]]
            yield batch[["item_id", "item"]].assign(words=words)

    rows = items.select(
        F.col("item_id").cast("string").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    ).withColumn("item", F.xxhash64("item_id", "text"))
    cut_items = rows.mapInPandas(cut, "item_id string, item long, words array<string>").where(F.size("words") > 0)
    pieces = F.transform(
        F.expr(f"sequence(0, (size(words) - 1) div {half})"),
        lambda p: F.struct(
            p.alias("part"), F.slice("words", p * half + 1, half).alias("part_words"), F.when(p == 0, F.col("words")).alias("words")
        ),
    )
    parts = stage(cut_items.select("item_id", "item", F.explode(pieces).alias("p")).select("item_id", "item", "p.*"), "benchmark-parts")
    totals = parts.agg(F.count("*").alias("n"), F.avg(F.size("part_words")).alias("mean")).first()
    n, mean = totals["n"], totals["mean"] or 1.0
    counted = parts.select("item", "part", F.size("part_words").alias("size"), F.explode("part_words").alias("word"))
    counted = counted.groupBy("item", "part", "size", "word").agg(F.count("*").alias("tf"))
    df = counted.groupBy("word").agg(F.count("*").alias("df"))
    weight = F.log(1 + (n - F.col("df") + 0.5) / (F.col("df") + 0.5)) * (
        F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("size") / mean))
    )
    weights = (
        counted.join(df, "word")
        .withColumn("weight", weight)
        .groupBy("item", "part")
        .agg(F.map_from_entries(F.collect_list(F.struct("word", "weight"))).alias("weights"), F.sum("weight").alias("sum"))
    )
    return parts.join(weights, ["item", "part"]).select(
        "item_id", "item", "part", "words", F.transform_values("weights", lambda _, w: w / F.col("sum")).alias("weights")
    )


def find_items(
    docs: DataFrame,
    items: DataFrame,
    threshold: float = 0.6,
    min_question: float = 0.6,
    min_answer: float = 0.6,
    half: int = 64,
    index_items: int = 10_000,
) -> DataFrame:
    """``doc_id, item_id, score, question_overlap, answer_overlap`` per document row and item found.

    ``text_hash`` tells rows of one id apart.

    The index goes to the tasks in sets of about ``index_items`` parts; more
    items make more passes over the documents, not a larger index.
    """
    spark = docs.sparkSession
    parts = stage(index_parts(items, half), "benchmark-index")
    sets = max(1, -(-parts.count() // index_items))
    rows = docs.select(
        F.col("doc_id").cast("string").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    ).withColumn("text_hash", F.xxhash64("text"))
    found = spark.createDataFrame([], RESULT)
    for number in range(sets):
        mine = parts.where(F.pmod("item", F.lit(sets)) == number).orderBy("item", "part").collect()
        if mine:
            index = BlockMaxIndex(
                [((r["item"], r["item_id"]), None, r["weights"]) for r in mine],
                {(r["item"], r["item_id"]): (None if r["item_id"] is None else int(r["item_id"]), r["words"]) for r in mine if not r["part"]},
            )
            shared = spark.sparkContext.broadcast(index)
            found = found.unionByName(rows.mapInPandas(_searcher(shared, half, threshold, min_question, min_answer), RESULT))
    return found


def _searcher(shared, half: int, threshold: float, min_question: float, min_answer: float):
    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        finder = Finder(shared.value, half, threshold, min_question, min_answer)
        names = [field.split()[0] for field in RESULT.split(", ")]
        for batch in batches:
            found = zip(batch["doc_id"], batch["text_hash"], finder.find(list(batch["text"])))
            rows = [(doc, text_hash, *hit) for doc, text_hash, hits in found for hit in hits]
            frame = pd.DataFrame(rows, columns=names)
            ids = {c: pd.array([None if x is None else int(x) for x in frame[c]], "Int64") for c in ("doc_id", "item_id")}
            yield frame.assign(**ids)

    return search
