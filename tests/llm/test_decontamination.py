import math
import random
from collections import Counter

import pytest
from hypothesis import given, settings, strategies as st

from strata.llm.decontamination import BlockMaxIndex, core_of, find_items, index_parts


def small_index(items):
    parts = [(k, words, weights) for k, (words, weights) in enumerate(items)]
    return BlockMaxIndex(parts, {k: (k, words) for k, (words, _) in enumerate(items)})


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.dictionaries(st.sampled_from("abcdefgh"), st.floats(0.01, 1), min_size=1), min_size=1, max_size=40),
    st.sets(st.sampled_from("abcdefghz")),
    st.floats(0.05, 2),
)
def test_search_equals_scoring_everything(items, words, threshold):
    index = small_index([(list(w), w) for w in items])
    terms = {index.vocabulary[w] for w in words if w in index.vocabulary}
    got = dict(index.search(terms, threshold))
    scores = {k: sum(v for w, v in weights.items() if w in words) for k, weights in enumerate(items)}
    want = {k: s for k, s in scores.items() if s >= threshold}
    close = {k for k, s in scores.items() if abs(s - threshold) < 1e-9}
    assert set(got) ^ set(want) <= close
    assert all(math.isclose(got[k], scores[k]) for k in got)


def words(rng, n, size=400):
    return [f"w{int(size * rng.random() ** 2)}" for _ in range(n)]


def brute(docs, items, half=64, threshold=0.6, least=0.6):
    """Every passage scored against every part of every item."""
    cut = lambda t: [c for w in (t or "").split() if (c := core_of(w))]
    parts = []
    for number, (item_id, text) in enumerate(items):
        w = cut(text)
        parts += [(number, item_id, w, w[i : i + half]) for i in range(0, len(w), half)]
    df = Counter(t for *_, p in parts for t in set(p))
    mean = sum(len(p) for *_, p in parts) / max(1, len(parts))
    found = set()
    for doc_id, text in docs:
        w = cut(text)
        for start in range(0, max(1, len(w) - half) if len(w) > half else 1, half):
            passage = set(w[start : start + 2 * half])
            for number, item_id, whole, part in parts:
                weight = {
                    t: math.log(1 + (len(parts) - df[t] + 0.5) / (df[t] + 0.5)) * c * 2.2 / (c + 1.2 * (0.25 + 0.75 * len(part) / mean))
                    for t, c in Counter(part).items()
                }
                if sum(weight[t] for t in weight if t in passage) < threshold * sum(weight.values()):
                    continue
                around = w[max(0, start - len(whole)) : start + 2 * half + len(whole)]
                triples = set(zip(around, around[1:], around[2:]))
                at = -(-2 * len(whole) // 3)
                ok = True
                for side in (whole[:at], whole[at:]):
                    if len(side) < 3:
                        share = sum(t in around for t in side) / len(side) if side else 1.0
                    else:
                        own = set(zip(side, side[1:], side[2:]))
                        share = len(own & triples) / len(own)
                    ok &= share >= least
                if ok:
                    found.add((doc_id, item_id, number))
    return sorted((d, i) for d, i, _ in found)


@pytest.mark.parametrize("index_items", [10_000, 7])
def test_finds_what_brute_force_finds(spark, index_items):
    rng = random.Random(5)
    items = [(i, " ".join(words(rng, rng.randrange(1, 50)))) for i in range(30)]
    items += [(30, " ".join(words(rng, 200))), (31, items[3][1]), (32, ""), (33, None)]
    docs = []
    for d in range(60):
        body = words(rng, rng.randrange(0, 500))
        if d % 3 == 0:
            item = (items[d % 31][1] or "").split()
            if d % 2:  # half of it only
                item = item[: len(item) // 2]
            at = rng.randrange(len(body) + 1)
            body[at:at] = [w.upper() + "," for w in item]
        docs.append((d, " ".join(body)))
    docs += [(60, None), (61, ""), (62, "!!! ..."), (63, (items[30][1] + " x ") * 3)]
    table = spark.createDataFrame([(*d, 0.5) for d in docs], "doc_id long, text string, score double")
    benchmark = spark.createDataFrame([(*i, "z") for i in items], "item_id long, text string, weights string")
    got = find_items(table, benchmark, index_items=index_items).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == brute(docs, items)
    assert {(0, 0), (63, 30)} <= {(r.doc_id, r.item_id) for r in got}


def test_repeated_and_null_ids_and_empty_tables(spark):
    text = "the quick brown fox jumps over one very lazy dog today"
    docs = spark.createDataFrame([(1, text), (1, text), (None, text), (2, "nothing like it")], "doc_id long, text string")
    items = spark.createDataFrame([(None, text), (4, "unseen words entirely")], "item_id long, text string")
    got = [(r.doc_id, r.item_id, r.question_overlap, r.answer_overlap) for r in find_items(docs, items).collect()]
    assert sorted(got, key=str) == [(1, None, 1.0, 1.0), (1, None, 1.0, 1.0), (None, None, 1.0, 1.0)]
    assert find_items(docs, items.where("item_id > 9")).count() == 0
    assert find_items(docs.where("doc_id > 9"), items).count() == 0


BLANKS = [" ", "\t", "\n", "\r\n", "\x0b", "\x0c", "\x1f", "\x85", "\xa0", "\u2003", "\u2028", "\u3000"]


def test_exact_copies_are_found_whatever_separates_their_words(spark):
    texts = [
        "Which treaty ended the long war between both northern kingdoms in the year of 1721",
        "import numpy as np; x = np.array([1, 2, 3]); print(x.sum(axis=0), x.mean(), os.path.join(a_b, 'c.txt'))",
        "The U.S. court (e.g. at www.example.org/a?b=c) wrote: state-of-the-art, Müller's naïve «façade» 3.14%",
        "ΟΔΟΣ.α ist İzmir—Straße/Ärger und noch mehr Wörter",
    ]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    docs = [(10 * k + i, f"words before it{b}{b.join(t.split(' '))}{b}and after") for i, t in enumerate(texts) for k, b in enumerate(BLANKS)]
    docs += [(900 + i, f'x = "({t})"') for i, t in enumerate(texts)]
    got = find_items(spark.createDataFrame(docs, "doc_id long, text string"), items).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == sorted((d, d % 10) for d, _ in docs)
    assert all(r.question_overlap == r.answer_overlap == 1 and r.score > 0.999 for r in got)


def test_a_very_long_item_is_stored_once(spark):
    """Its words come with its first part; parts grow with its length, not with its square."""
    n = 20_000
    text = " ".join(f"w{i}" for i in range(n))
    items = spark.createDataFrame([(1, text), (2, "a short one")], "item_id long, text string")
    parts = index_parts(items, 64).selectExpr("item_id", "part", "coalesce(size(words), 0) as held", "size(weights) as own").collect()
    assert sum(r.held for r in parts if r.item_id == "1") == n and {r.held for r in parts if r.part} == {0}
    assert sum(r.own for r in parts if r.item_id == "1") == n
    docs = spark.createDataFrame([(1, f"before {text} after"), (2, "nothing here")], "doc_id long, text string")
    assert [(r.doc_id, r.item_id) for r in find_items(docs, items).collect()] == [(1, 1)]
