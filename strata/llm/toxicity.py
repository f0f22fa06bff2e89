"""Toxicity by a learned lexicon, fuzzy matching and context windows.

1. The lexicon is learned from labelled documents: the words whose share of
   toxic documents is far above that of the others, by a smoothed odds ratio.
   Words are runs of letters and digits, here and in the texts that are scored.
2. A Levenshtein automaton (words within ``MAX_EDITS`` edits) is intersected
   with the trie of the lexicon.  Its states are sets of trie places with the
   edits spent so far; they are made as texts ask for them and kept, so that
   a word costs one step per letter, and most words end in the dead state
   after a few letters.
3. Every hit is weighed by the window of words around it: inside quotation
   marks (an apostrophe between two letters is none) or beside a reporting word it counts as quoted, not as abuse, and a
   word of address beside it makes it weigh more.
4. A logistic regression over the sums of a document's hits, fitted on the
   same labelled documents, gives the score.

A score depends on the text alone.  Defined results: null and empty texts have
no hits and get the model's score for none; a null id counts as not held out
and has no label; a document with several labels is toxic if one says so;
repeated rows each get their row; without labels of both kinds every score is
0; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from strata.llm.words import cut_words, distinct_words
from strata.operators.staging import stage

#: Edits between a word and the term it is matched with; short terms must match exactly.
MAX_EDITS = 1
FUZZY_FROM = 5

#: Words on either side of a hit that are its context.
WINDOW = 6

#: Bytes of text that are looked through at once; a longer text goes alone.
AT_ONCE = 2 << 20

#: States of the automaton that a task keeps; beyond them it starts anew.
KEPT_STATES = 100_000

# Marks of quotation, and words that report or address.
QUOTES = "\"'“”„‟«»‹›‘’"
REPORTING = frozenset(
    "said says wrote writes quote quoted called calls word term sagte schrieb zitat wort dit écrit mot dijo escribió palabra".split()
)
ADDRESS = frozenset("you your youre u du dich dir ihr euch tu te toi vous usted ustedes".split())

# What separates words: quotation marks, apostrophes, blanks and others, as bytes; letters and digits are kept.
QUOTE, APOSTROPHE, BLANK, OTHER = b"\"\x02 \x01"
SEPARATORS = bytes((QUOTE, APOSTROPHE, BLANK, OTHER, 10))
FAR_SEPARATOR = re.compile(r"[^\w\x00-\x7f]")
ASCII_KINDS = bytes(
    c if c > 127 or chr(c).isalnum() else QUOTE if c == 34 else APOSTROPHE if c == 39 else BLANK if chr(c).isspace() else OTHER
    for c in range(256)
)

FEATURES = ("abuse", "n_exact", "n_fuzzy", "n_quoted", "strongest")


def near_separator(found: re.Match) -> str:
    """An ASCII character of the same kind."""
    mark = found[0]
    return "'" if mark in "‘’" else '"' if mark in QUOTES else " " if mark.isspace() else "-"


def kinds_of(text: str) -> bytes:
    """The text in lower case with one byte of its kind for every separator."""
    low = text.lower()
    return (low if low.isascii() else FAR_SEPARATOR.sub(near_separator, low)).encode().translate(ASCII_KINDS)


def quotation_marks(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per word whether quotation marks open before it and close after it, in its own text; texts end at ``stops``.

    Marks that touch a word across no blank are its own; those that stand alone count for both neighbours.
    """
    ends = starts + lengths
    following = np.append(starts[1:], len(data))
    before = np.concatenate([[0], ends[:-1]])
    marks = (data == QUOTE) | (data == APOSTROPHE)
    marks[ends[(following - ends == 1) & (data[ends] == APOSTROPHE)]] = False  # as in don't
    summed = np.concatenate([[0], np.cumsum(marks)])
    blanks = np.flatnonzero((data == BLANK) | (data == 10))
    text = np.searchsorted(stops, starts, "right")
    # of the gap behind a word all but what touches the next word; of the gap before it all but what touches the last one
    last = blanks[np.maximum(np.searchsorted(blanks, following) - 1, 0)]
    close = np.minimum(np.where(last >= ends, last, following), stops[text])
    first = blanks[np.searchsorted(blanks, before)]
    open_ = np.maximum(np.where(first < starts, first, before), np.concatenate([[0], stops])[text])
    return summed[starts] > summed[open_], summed[close] > summed[ends]


class FuzzyTrie:
    """The product of a lexicon trie and the Levenshtein automaton, made lazily."""

    def __init__(self, terms: dict[str, float]):
        self.next: list[dict[str, int]] = [{}]
        self.ends: dict[int, str] = {}
        self.terms = terms
        for term in sorted(terms):
            at = 0
            for letter in term:
                at = self.next[at].setdefault(letter, len(self.next))
                if at == len(self.next):
                    self.next.append({})
            self.ends[at] = term
        self._reset()

    def _reset(self) -> None:
        self.states: list[dict[int, int]] = []  # place in the trie -> edits spent
        self.numbers: dict[frozenset, int] = {}
        self.steps: list[dict[str, int]] = []
        self.best: list[tuple[str, int] | None] = []
        self._number({})  # the dead state
        self.start = self._number(self._skips({0: 0}))

    def _skips(self, places: dict[int, int]) -> dict[int, int]:
        """With the places reached by letters that the word leaves out."""
        reached = dict(places)
        wave = places
        while wave:
            after: dict[int, int] = {}
            for place, edits in wave.items():
                if edits < MAX_EDITS:
                    for child in self.next[place].values():
                        if edits + 1 < reached.get(child, MAX_EDITS + 1):
                            reached[child] = after[child] = edits + 1
            wave = after
        return reached

    def _number(self, places: dict[int, int]) -> int:
        key = frozenset(places.items())
        if key not in self.numbers:
            self.numbers[key] = len(self.states)
            self.states.append(places)
            self.steps.append({})
            found = [
                (edits, -len(term), term)
                for place, edits in places.items()
                if (term := self.ends.get(place)) is not None and (edits == 0 or len(term) >= FUZZY_FROM)
            ]
            self.best.append((min(found)[2], min(found)[0]) if found else None)
        return self.numbers[key]

    def _step(self, state: int, letter: str) -> int:
        after: dict[int, int] = {}
        for place, edits in self.states[state].items():
            for other, child in self.next[place].items():
                spent = edits + (other != letter)
                if spent <= MAX_EDITS and spent < after.get(child, MAX_EDITS + 1):
                    after[child] = spent
            if edits < MAX_EDITS and edits + 1 < after.get(place, MAX_EDITS + 1):
                after[place] = edits + 1
        self.steps[state][letter] = to = self._number(self._skips(after))
        return to

    def match(self, word: str) -> tuple[str, int] | None:
        """The nearest term and its edits; of equally near ones the longest, then the first by name."""
        if len(self.states) > KEPT_STATES:
            self._reset()
        state = self.start
        for letter in word:
            to = self.steps[state].get(letter)
            state = self._step(state, letter) if to is None else to
            if not state:
                return None
        return self.best[state]


class Scorer:
    """The features of texts, by a lexicon of terms and their weights."""

    def __init__(self, terms: dict[str, float]):
        self.trie = FuzzyTrie(terms)
        self.known: dict[bytes, tuple] = {}

    def features(self, texts: list[str]) -> Iterator[tuple]:
        held, size = [], 0
        for text in texts:
            raw = kinds_of(text)
            if held and size + len(raw) > AT_ONCE:
                yield from self._features(held)
                held, size = [], 0
            held.append(raw)
            size += len(raw) + 1
        if held:
            yield from self._features(held)

    def _features(self, texts: list[bytes]) -> Iterator[tuple]:
        raw = b"\n".join(texts) + b"\n"
        data = np.frombuffer(raw, np.uint8)
        stops = np.cumsum([len(t) + 1 for t in texts])
        starts, lengths = cut_words(data, SEPARATORS, b"")
        hits: dict[int, list[tuple]] = {}
        if len(starts):
            one, same = distinct_words(data, starts, lengths)
            seen = [self._seen(raw[i : i + n]) for i, n in zip(starts[one].tolist(), lengths[one].tolist())]
            edge = np.searchsorted(starts, np.concatenate([[0], stops]))
            opens, closes = quotation_marks(data, starts, lengths, stops)
            hit = np.array([s[0] is not None for s in seen])[same]
            for i in np.flatnonzero(hit).tolist():
                doc = int(np.searchsorted(edge, i, "right")) - 1
                low, high = max(edge[doc], i - WINDOW), min(edge[doc + 1], i + WINDOW + 1)
                around = [seen[k] for k in same[low:high].tolist()]
                quoted = bool(opens[low : i + 1].any() and closes[i:high].any()) or any(s[2] for s in around)
                addressed = any(s[3] for s in around)
                hits.setdefault(doc, []).append((*seen[same[i]][0:2], quoted, addressed))
        for doc in range(len(texts)):
            yield self._summed(hits.get(doc, ()))

    def _seen(self, word: bytes) -> tuple:
        """Weight, edits, reports, addresses."""
        found = self.known.get(word)
        if found is None:
            if len(self.known) > KEPT_STATES:
                self.known = {}
            text = word.decode()
            match = self.trie.match(text)
            found = self.known[word] = (
                None if match is None else self.trie.terms[match[0]],
                0 if match is None else match[1],
                text in REPORTING,
                text in ADDRESS,
            )
        return found

    @staticmethod
    def _summed(hits) -> tuple:
        abuse = sum(w * (0.5 if edits else 1.0) * (1.5 if near else 1.0) for w, edits, quoted, near in hits if not quoted)
        return (
            math.log1p(abuse),
            math.log1p(sum(not edits and not quoted for _, edits, quoted, _ in hits)),
            math.log1p(sum(bool(edits) and not quoted for _, edits, quoted, _ in hits)),
            math.log1p(sum(quoted for _, _, quoted, _ in hits)),
            max((w * (0.5 if edits else 1.0) for w, edits, quoted, _ in hits if not quoted), default=0.0),
        )


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def learn_lexicon(labelled: DataFrame, min_documents: int = 3, min_odds: float = 20.0, max_terms: int = 5000) -> dict[str, float]:
    """Terms and their log odds from ``labelled(text, toxic)``, the ``max_terms`` strongest.

    Odds compare the shares of toxic and other documents that have the word.
    """
    words = F.array_distinct(F.split(F.lower("text"), r"[^\p{L}\p{N}]+"))
    counted = (
        labelled.select("toxic", F.explode(words).alias("word"))
        .where("length(word) >= 3")
        .groupBy("word")
        .agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
        .where(F.col("bad") >= min_documents)
    )
    total = labelled.agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good")).first()
    if not total["bad"] or not total["good"]:
        return {}
    # two imagined clean documents for every word keep rare ones out
    odds = ((F.col("bad") + 0.5) / (total["bad"] + 1)) / ((F.col("good") + 2) / (total["good"] + 2))
    strong = counted.withColumn("weight", F.log(odds)).where(F.col("weight") >= math.log(min_odds))
    top = strong.orderBy(F.desc("weight"), F.desc("bad"), "word").limit(max_terms)
    return {row["word"]: row["weight"] for row in top.collect()}


def score_documents(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = 0.7,
    max_terms: int = 5000,
    max_labelled: int = 200_000,
    regularisation: float = 1e-4,
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs(doc_id, text)``.

    Labels (``doc_id, toxic``) are used only of documents that are not held
    out, and of more than ``max_labelled`` those with the smallest hashes: a
    sample of that bound, which is broadcast so that no text is shuffled.  The
    lexicon, ``max_terms`` words at most, travels with the tasks.
    """
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    ).withColumn("held_out", held_out(F.col("doc_id")))
    marked = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    marked = marked.agg((F.max("toxic") > 0).cast("int").alias("toxic")).where(~held_out(F.col("doc_id")))
    sample = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    marked = F.broadcast(stage(sample, "toxicity-labels"))
    terms = learn_lexicon(rows.where("not held_out").join(marked, "doc_id"), max_terms=max_terms)
    if not terms:
        return rows.select("doc_id", "held_out", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(terms)
        for batch in batches:
            out = pd.DataFrame(list(scorer.features(list(batch["text"]))), columns=FEATURES, index=batch.index)
            yield pd.concat([batch[["doc_id", "held_out"]], out], axis=1)

    # ids as text: pandas would turn nullable longs into doubles
    texts = rows.select(F.col("doc_id").cast("string").alias("doc_id"), "held_out", "text")
    schema = "doc_id string, held_out boolean, " + ", ".join(f"{name} double" for name in FEATURES)
    measured = stage(
        texts.mapInPandas(measure, schema).withColumn("doc_id", F.col("doc_id").cast("long")), "toxicity-features"
    )
    assembled = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(measured)
    train = assembled.where("not held_out").join(marked, "doc_id").select("features", F.col("toxic").cast("double").alias("label"))
    model = LogisticRegression(regParam=regularisation, maxIter=50).fit(train)
    scored = model.transform(assembled).withColumn("score", vector_to_array("probability")[1])
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
