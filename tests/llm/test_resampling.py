import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from strata.llm import resampling
from strata.llm.resampling import Crc, Features, resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_features(text):
    words = WORD.findall((text or "").translate(UPPER))
    runs = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), Counter(zlib.crc32(f.encode()) for f in runs)


def plain(rows, target, percent, min_words, n_buckets=10_000):
    """The contract, row by row."""

    def total(counters):
        found = Counter()
        for counter in counters:
            for crc, n in counter.items():
                found[crc % n_buckets] += n
        return found

    docs = [(i, text, *plain_features(text)) for i, text in rows]
    s, t = total(f for *_, f in docs), total(plain_features(x)[1] for x in target)
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + n_buckets) / ((s[b] + 1) * (big_t + n_buckets)))) for b in range(n_buckets)]
    scored = []
    for i, text, n_words, features in docs:
        weight = sum(gain[crc % n_buckets] * n for crc, n in features.items())
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        scored.append((i, n_words, sum(features.values()), weight, score))
    fit = sorted((r for r in scored if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0]))
    rank = {r[0]: k + 1 for k, r in enumerate(fit[: percent * len(fit) // 100])}
    return sorted((str(r[0]), *r[2:], rank.get(r[0])) for r in scored)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(max_size=40), min_size=1, max_size=5), st.binary(max_size=300))
def test_crc_of_joined_strings(lefts, right):
    found = Crc().joined(
        np.array([zlib.crc32(x) for x in lefts], np.uint32),
        np.array([zlib.crc32(right)] * len(lefts), np.uint32),
        np.array([len(right)] * len(lefts)),
    )
    assert found.tolist() == [zlib.crc32(x + right) for x in lefts]


@pytest.mark.parametrize("batch_bytes", [1, 7, 30, 1 << 20])
@settings(max_examples=100, deadline=None)
@given(texts=st.lists(st.text(st.sampled_from(list("aB1é漢 .\n\x00-")), max_size=40) | st.none(), max_size=6))
def test_buckets_of_batches_and_windows(texts, batch_bytes):
    """Documents of any length in batches of any size: no feature is lost, counted twice or reaches over a text."""
    before, resampling.BATCH_BYTES = resampling.BATCH_BYTES, batch_bytes
    try:
        found = [Counter() for _ in texts]
        for start, runs in Features(997).of_texts(None if t is None else t.encode() for t in texts):
            for buckets, text_of in runs:
                for bucket, k in zip(buckets.tolist(), text_of.tolist()):
                    found[start + k][bucket] += 1
    finally:
        resampling.BATCH_BYTES = before
    wanted = []
    for text in texts:
        wanted.append(Counter())
        for crc, n in plain_features(text)[1].items():
            wanted[-1][crc % 997] += n
    assert found == wanted


def test_words_forgotten(monkeypatch):
    monkeypatch.setattr(resampling, "KEPT_WORDS", 2)
    monkeypatch.setattr(resampling, "BATCH_BYTES", 10)
    texts = [f"w{i} common" for i in range(20)]
    found = Counter()
    for _, runs in Features(997).of_texts(t.encode() for t in texts):
        found.update(b for buckets, _ in runs for b in buckets.tolist())
    assert found == Counter(crc % 997 for t in texts for crc in plain_features(t)[1].elements())


ROWS = [(i, f"Word{i % 7} and the {'good answer ' * (i % 5)} of number {i}. " * 3, "x") for i in range(200)]
ROWS += [(1000, None, "x"), (1001, "", "x"), (None, "no id but many words " * 9, "x"), (1002, "few words", "x")]
ROWS += [(1003, "a very long text with an answer " * 3000, "x"), (1004, "?!" * 200, "x"), (1005, "\0nul\0 " * 30, "x")]
TARGET = [(1, "the good answer of number 5"), (2, None), (3, "answer answer")]


def got(frame):
    return sorted((str(r.doc_id), r.n_features, r.weight, r.score, r["rank"]) for r in frame.collect())


@pytest.mark.parametrize("percent", [0, 5, 100])
def test_equals_the_contract(spark, percent):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, rank string").repartition(5)
    target = spark.createDataFrame(TARGET, "item_id long, text string")
    found = got(resample(docs, target, percent, 20, "42"))
    assert found == plain([r[:2] for r in ROWS], [t for _, t in TARGET], percent, 20)


def test_repeated_rows_and_empty_tables(spark):
    schema = "doc_id long, text string"
    rows = [(1, "some words are here " * 10)] * 50
    target = spark.createDataFrame(TARGET, "item_id long, text string")
    found = resample(spark.createDataFrame(rows, schema), target, 10, 20, "42").collect()
    assert sorted(r["rank"] for r in found if r["rank"]) == [1, 2, 3, 4, 5] and len({r.score for r in found}) == 1
    none = spark.createDataFrame([], schema)
    assert resample(none, target, 10, 20, "42").count() == 0
    assert resample(spark.createDataFrame(rows, schema), none, 10, 20, "42").count() == 50
