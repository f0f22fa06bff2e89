import math
import re
from collections import Counter

from strata.llm.divergence import COMMON_WORDS, judge_documents, language_references, measure_documents

SCHEMA = "doc_id long, text string, lang string, words string, kept string"
PROSE = "The cat and the dog of the house were in a garden, and it is for you. "
ROWS = [
    (1, None, "en"), (2, "", "en"), (3, " \t\n", "en"), (4, "one", "en"), (5, "a b a b a b", "en"),
    (6, PROSE * 30, "en"), (7, "\n".join(f"{PROSE}{i}" for i in range(40)), "en"), (8, "#*$%&|<> " * 300, "en"),
    (9, " ".join(f"word{i}" for i in range(300)), "en"), (10, "WORD!! " * 20 + " ".join(f"W{i}" for i in range(200)), None),
    (11, "x\ny\nx\n \nx\n\n", "de"), (12, "é😀 ÄÖ ß " * 30, "de"), (13, "a a a a", "de"), (None, PROSE, "en"),
    (6, PROSE * 30, "en"), (14, "same same same " + " ".join(f"q{i}" for i in range(60)) + " same same same", "fr"),
    (15, " ".join("abcdefgh"[(i * i) % 8] for i in range(3000)), "fr"),
]
TABLE = [(*r, "x", "y") for r in ROWS]


def base(text):
    text = text or ""
    words = [w for w in re.split(r"[ \x09-\x0D]+", text) if w]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^ \x09-\x0D]", line)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)
    )


def test_base_counts(spark):
    got = [tuple(r) for r in judge_documents(spark.createDataFrame(TABLE, SCHEMA)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()]
    want = []
    for doc_id, text, _ in ROWS:
        n, chars, symbols, lines, repeats = base(text)
        want.append((doc_id, n, chars, symbols, lines, repeats, n < 50 or 100 * repeats > 50 * n))
    assert sorted(got, key=str) == sorted(want, key=str)


def distance(p, q):
    total = 0.0
    for a, b in zip(p, q):
        m = (a + b) / 2
        total += (a * math.log2(a / m) if a else 0) / 2 + (b * math.log2(b / m) if b else 0) / 2
    return math.sqrt(max(0, total))


def histograms(text):
    kept = re.sub(r"[ \x09-\x0D]", "", text or "")
    kinds = Counter()
    for c in kept:
        if c.islower() and c.isalpha():
            kinds[0] += 1
        elif c.isupper():
            kinds[1] += 1
        elif c.isnumeric():
            kinds[2] += 1
        elif c in ".,;:!?'\"()-":
            kinds[3] += 1
        else:
            kinds[4] += 1
    runs = Counter(COMMON_WORDS.index(w) if w in COMMON_WORDS else len(COMMON_WORDS) for w in re.findall(r"[^\W\d_]+", (text or "").lower()))
    return [kinds[i] for i in range(5)], [runs[i] for i in range(len(COMMON_WORDS) + 1)]


def test_distances(spark):
    got = judge_documents(spark.createDataFrame(TABLE, SCHEMA)).collect()
    sums = {}
    for _, text, lang in ROWS:
        held = sums.setdefault(lang, ([0] * 5, [0] * (len(COMMON_WORDS) + 1)))
        for a, b in zip(held, histograms(text)):
            a[:] = [x + y for x, y in zip(a, b)]
    share = lambda h: [x / sum(h) if sum(h) else 0.0 for x in h]
    by_id = {r.doc_id: r for r in got}
    for doc_id, text, lang in ROWS:
        for own, reference, found in zip(histograms(text), sums[lang], (by_id[doc_id].class_distance, by_id[doc_id].word_distance)):
            if sum(own):
                assert math.isclose(found, distance(share(own), share(reference)), abs_tol=1e-7), doc_id
            else:
                assert found is None


def test_verdicts_follow_the_references_given(spark):
    clean = spark.createDataFrame([(i, PROSE * 20, "en") for i in range(5)], "doc_id long, text string, lang string")
    references = language_references(measure_documents(clean))
    words = "cat dog house garden tree river stone bread wine sun moon star the of and to in a is".split()
    prose = " ".join(f"{words[(i * i + 3 * i) % 19]} {words[(7 * i + i // 19) % 19]}{i % 23 if i % 40 == 0 else ''}" for i in range(150))
    listed = " ".join(f"{a}{b}{c}" for a in "qwrt" for b in "aeiou" for c in "bcdfghjklm")
    shouted = " ".join(f"{w.upper()}{i}$$$" for i, w in enumerate(prose.split()))
    docs = spark.createDataFrame([(1, PROSE + prose, "en"), (2, listed, "en"), (3, shouted, "en"), (4, prose, "xx")], "doc_id long, text string, lang string")
    kept = {r.doc_id: r.kept for r in judge_documents(docs, references, max_word_distance=0.7).collect()}
    assert not kept[3]
    kept = {r.doc_id: r.kept for r in judge_documents(docs, references, max_class_distance=1.0).collect()}
    assert not kept[2]
    assert kept[4] == (not base_failed(prose))  # a language without a reference is not judged by distance


def base_failed(text):
    n, _, _, _, repeats = base(text)
    return n < 50 or 100 * repeats > 50 * n


def test_empty_table(spark):
    assert judge_documents(spark.createDataFrame([], SCHEMA)).count() == 0
