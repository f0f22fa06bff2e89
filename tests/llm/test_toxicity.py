import random
import zlib

import pytest
from hypothesis import given, settings, strategies as st

from strata.llm.toxicity import FUZZY_FROM, FuzzyTrie, Scorer, learn_lexicon, score_documents


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("abc", min_size=1, max_size=8), min_size=1, max_size=8, unique=True), st.lists(st.text("abcd", max_size=9), max_size=8))
def test_automaton_finds_the_nearest_term(terms, words):
    trie = FuzzyTrie(dict.fromkeys(terms, 1.0))
    for word in words + terms:
        near = [(d, -len(t), t) for t in terms if (d := edits(word, t)) <= (1 if len(t) >= FUZZY_FROM else 0)]
        want = (min(near)[2], min(near)[0]) if near else None
        assert trie.match(word) == want


def test_quotation_and_address():
    scorer = Scorer({"worthless": 4.0, "scum": 3.0})
    plain, quoted, reported, addressed, fuzzy, empty = scorer.features(
        ["so a worthless thing here", 'a "worthless" thing', "he said worthless", "you worthless", "a worthles thing scun", ""]
    )
    assert plain[1] > 0 and plain[3] == 0
    assert quoted[1] == 0 and quoted[3] > 0 and reported[3] > 0
    assert addressed[0] > plain[0]
    assert fuzzy[1] == 0 and fuzzy[2] > 0 and 0 < fuzzy[0] < plain[0]
    assert empty == (0, 0, 0, 0, 0)


def test_context_stays_inside_a_text():
    scorer = Scorer({"worthless": 4.0})
    assert [f[3] for f in scorer.features(['he said "', "worthless", '" quote'])] == [0, 0, 0]


def corpus(n=900, seed=3):
    rng = random.Random(seed)
    clean = [f"w{i}ord" for i in range(60)] + ["the", "of"]
    bad = ["idiotic", "moronic", "trashy"]
    docs, labels = [], []
    for i in range(n):
        words = rng.choices(clean, k=40)
        toxic = i % 5 == 0
        if toxic:
            for _ in range(3):
                word = rng.choice(bad)
                if rng.random() < 0.3:
                    at = rng.randrange(1, len(word) - 1)
                    word = word[:at] + "x" + word[at + 1 :]
                words.insert(rng.randrange(len(words)), word)
        docs.append((i, " ".join(words), 1.0))
        labels.append((i, int(toxic), "clash"))
    return docs, labels


def test_held_out_documents(spark):
    docs, labels = corpus()
    docs += [(None, "idiotic trashy moronic", 1.0), (5, None, 1.0), (6, "", 1.0), (7, docs[7][1], 1.0)]
    table = spark.createDataFrame(docs, "doc_id long, text string, score double")
    truth = spark.createDataFrame(labels, "doc_id long, toxic int, text string")
    got = score_documents(table, truth).collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id if r.doc_id is not None else "").encode()) % 3 == 1) for r in got)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id not in (5, 6, 7)]
    hits = [r.predicted == (r.doc_id % 5 == 0) for r in held]
    assert sum(hits) / len(hits) > 0.97
    assert next(r for r in got if r.doc_id is None).predicted == 1


def test_labels_of_held_out_documents_do_not_matter(spark):
    docs, labels = corpus(300)
    table = spark.createDataFrame(docs, "doc_id long, text string, score double")
    other = [(i, (1 - t) if zlib.crc32(str(i).encode()) % 3 == 1 else t, c) for i, t, c in labels]
    runs = [
        {r.doc_id: r.score for r in score_documents(table, spark.createDataFrame(rows, "doc_id long, toxic int, text string")).collect()}
        for rows in (labels, other)
    ]
    assert runs[0] == pytest.approx(runs[1])


def test_without_labels_or_rows(spark):
    docs, labels = corpus(30)
    table = spark.createDataFrame(docs, "doc_id long, text string, score double")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in score_documents(table, none).collect()} == {0.0}
    assert score_documents(table.where("doc_id > 99"), none).count() == 0


def test_lexicon_prefers_words_of_toxic_documents(spark):
    rows = [("bad thing", 1)] * 20 + [("good thing", 0)] * 200
    found = learn_lexicon(spark.createDataFrame(rows, "text string, toxic int"))
    assert set(found) == {"bad"}


def test_every_separator_that_is_learned_is_scored():
    scorer = Scorer({"moron": 4.0, "idiot": 3.0})
    marks = [chr(c) for c in [*range(1, 0x250), *range(0x2000, 0x2070), 0x3000, 0x3001, 0xFEFF, 0x1F600] if not chr(c).isalnum()]
    found = list(scorer.features([f"a{m}moron{m}b idiot" for m in marks]))
    plain = next(scorer.features(["a moron b idiot"]))
    for mark, got in zip(marks, found):
        assert got == plain or mark in "\"“”„‟«»‹›" and got[3] > 0, repr(mark)
    assert len({f for f in scorer.features(["so-idiot", "idiot/moron", "(idiot)", "idiot_moron", "idiot's"])}) == 2


def test_marks_of_quotation_beside_other_marks():
    scorer = Scorer({"idiot": 3.0})
    quoted = ['a "idiot" b', "a 'idiot' b", 'a " idiot " b', 'a ("idiot") b', "a «idiot», b", 'a "an idiot." b', 'a,"idiot",b', "“idiot”"]
    plain = ["a idiot b", "don't idiot can't", 'idiot "b" c', 'a "b" idiot', "a' idiot", "", '"', 'idiot "', "it’s idiot isn’t"]
    assert [f[3] > 0 for f in scorer.features(quoted + plain)] == [True] * len(quoted) + [False] * len(plain)
