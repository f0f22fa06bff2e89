import random

from strata.llm.secret_forest import FEATURES, describe_candidates, remove_false_findings, review_by_rule

SCHEMA = "doc_id long, text string, path string, length string, score string"


def rows():
    rng = random.Random(4)
    found = []
    for i in range(120):
        token = "".join(rng.choice("0123456789abcdef") for _ in range(40))
        number = "".join(rng.choice("0123456789") for _ in range(16))
        found.append((i, f'the words of a page token = "{token}" and the words go on', "src", "x", "y"))
        found.append((1000 + i, f"the words of a page {number} and the words go on", "src", "x", "y"))
    return found


def test_features(spark):
    table = spark.createDataFrame(
        [(5001, 'my api_key: "AbC123xyz-Example99" then', "tests/example.py", "x", "y"), (5002, None, None, "x", "y"), (5003, "", "a", "x", "y"),
         (5004, "12345678901234", None, "x", "y"), (None, "nodigitsinthislongword plainwd4", "a", "x", "y")] + rows(), SCHEMA)
    got = {r.doc_id: r for r in describe_candidates(table, min_count=100).collect()}
    one = got[5001]
    assert (one.candidate, one.place, one.before1, one.after1) == ("AbC123xyz-Example99", 2, "api_key:", "then")
    assert (one.length, one.announced, one.assigned, one.quoted, one.example_path) == (19, 1, 1, 1, 1)
    assert one.changes == 8 / 19 and one.digit_share == 5 / 19 and one.upper_share == 3 / 19
    assert (got[5004].is_number, got[5004].is_hex, got[5004].changes, got[5004].example_path) == (1, 1, 0, 0)
    assert 5002 not in got and 5003 not in got and None not in got
    assert all(getattr(r, f) is not None for r in got.values() for f in FEATURES)


def test_dictionary_share(spark):
    text = "the secretword appears " * 30
    table = spark.createDataFrame([(1, text, "p", "x", "y"), (2, "a secretword1234 b", "p", "x", "y")], SCHEMA)
    got = describe_candidates(table, min_count=20).first()
    assert got.dictionary_share == 10 / 14


def test_forest_learns_labels_and_is_held_to_them(spark):
    candidates = review_by_rule(describe_candidates(spark.createDataFrame(rows(), SCHEMA))).cache()
    assert candidates.where("label is null").count() == 0
    learned = candidates.where("doc_id % 2 = 0")
    judged = remove_false_findings(candidates, learned).where("doc_id % 2 = 1").collect()
    assert len(judged) == 120
    assert all(r.is_secret == (r.doc_id < 1000) for r in judged)
    bounded = remove_false_findings(candidates, learned, max_findings=10).where("doc_id % 2 = 1").collect()
    assert sum(r.is_secret == (r.doc_id < 1000) for r in bounded) >= 114


def test_without_labels_nothing_is_removed_and_empty(spark):
    candidates = review_by_rule(describe_candidates(spark.createDataFrame(rows()[:6], SCHEMA)))
    judged = remove_false_findings(candidates, candidates.where("label = 1")).collect()
    assert {(r.score, r.is_secret) for r in judged} == {(1.0, True)}
    assert describe_candidates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_every_run_of_a_word_is_a_candidate(spark):
    key, other = "wJalrXUtnFEMI7K7MDENGbPxRfiCY", "0123456789abcdef0123"
    texts = [
        f'{{"aws_secret_access_key":"{key}","page":"{other}"}}',
        f"id,some_long_column_name,{key},{other}",
        f"https://example.com/some/long/path/here?page=1&api_key={key}",
        f'var configuration_of_it={{pwd:["{key}"]}};f("{other}")',
        f'go "{{\\"a_long_token_name\\":\\"{key}\\"}}" on',
    ]
    table = spark.createDataFrame([(i, t, "p", "x", "y") for i, t in enumerate(texts)], SCHEMA)
    got = {}
    for r in describe_candidates(table).collect():
        got.setdefault(r.doc_id, {})[r.run] = r
    assert {i: [runs[k].candidate for k in sorted(runs)] for i, runs in got.items()} == {
        0: [key, other], 1: [key, other], 2: [f"api_key={key}"], 3: [key, other], 4: [key],
    }
    assert got[0][0].before1 == 'aws_secret_access_key":' and got[0][0].after1 == "page"
    assert [(got[i][0].announced, got[i][0].assigned) for i in (0, 2, 3, 4)] == [(1, 1)] * 4
    assert (got[0][1].announced, got[0][1].assigned) == (0, 1)
    assert review_by_rule(describe_candidates(table)).where("label = 1").count() == 4


def test_copies_and_secrets_make_no_words(spark):
    secret = "qzWvutsrPonm4kjhgfdsXcvb"
    texts = [f"page {i} of words and Authorization: Bearer {secret} here" for i in range(30)]
    texts += ["one text with wvutsrponm and kjhgfdsxcvb alone"] * 30  # copies
    texts += [f"the publisher {i} told it" for i in range(3)] + ["it was publisher1234567"]
    tables = [
        spark.createDataFrame([(i, t, "p", "x", "y") for i, t in enumerate(some)], SCHEMA) for some in (texts, texts * 20)
    ]
    for table in tables:
        got = {r.candidate: r for r in review_by_rule(describe_candidates(table)).collect()}
        assert got[secret].dictionary_share == 0 and got[secret].label is None
        assert got["publisher1234567"].dictionary_share == 9 / 16


def test_minimum_grows_with_the_texts(spark):
    rows = [(i, f"text number{i} has chance" if i < 3 else f"text {i} has", "p", "x", "y") for i in range(400)]
    rows += [(500, "a chance123456789", "p", "x", "y")]
    table = spark.createDataFrame(rows, SCHEMA)
    shares = {m: describe_candidates(table, min_share=m).where("doc_id = 500").first().dictionary_share for m in (0.005, 0.01)}
    assert shares == {0.005: 6 / 15, 0.01: 0}
