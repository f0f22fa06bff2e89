import collections

import public_tokenizers
import pytest

import corpus_pipeline
from strata.llm.divergence import judge_documents
from strata.llm.token_files import encoder

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("pipeline")
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(150)
    docs = docs.union(spark.createDataFrame([(None, None, None, None, None), (7, "", "en", None, 0)], docs.schema))
    docs = docs.union(docs.where("doc_id = 3"))  # a row that repeats
    docs.coalesce(1).write.parquet(f"file://{folder}/in")
    found = [spark.read.parquet(f"file://{folder}/in")]
    for k, (_, function) in enumerate(corpus_pipeline.STAGES):
        function(spark, found[-1], SF).write.parquet(f"file://{folder}/{k}")
        found.append(spark.read.parquet(f"file://{folder}/{k}"))
    return found


def rows(frame):
    return collections.Counter(tuple(r) for r in frame.collect())


def test_columns_and_that_stages_only_remove(stages):
    for before, after in zip(stages[:4], stages[1:5]):
        assert after.columns == before.columns
        assert not rows(after) - rows(before)


def test_quality_rules_take_effect(stages):
    kept = {r.doc_id for r in judge_documents(stages[0]).where("kept").collect()}
    assert {r.doc_id for r in stages[1].collect()} == kept


def test_one_of_each_component_stays(stages):
    from tests.llm.test_ngram_groups import brute

    before = [(r.doc_id, r.text) for r in stages[1].collect()]
    labels = {d: c for d, _, c in brute(before)}
    after = [r.doc_id for r in stages[2].collect()]
    assert sorted(after) == sorted(set(labels.values()))


def test_no_benchmark_item_is_left(spark, stages):
    items = [r.text.split() for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for r in stages[3].collect():
        text = " ".join(r.text.split())
        assert not any(" ".join(item) in text for item in items)
    gone = rows(stages[2]) - rows(stages[3])
    assert all(any(" ".join(i) in " ".join(r[1].split()) for i in items) for r in gone)


def test_mixture_keeps_all_rows(stages):
    assert rows(stages[4]) == rows(stages[3])


def test_token_files_follow_the_stored_order(stages):
    stored = stages[4].select("doc_id", "text", "_metadata.file_name", "_metadata.row_index").collect()
    ordered = sorted(stored, key=lambda r: (r.file_name, r.row_index))
    spans = sorted(stages[5].collect(), key=lambda r: r.start)
    assert [r.doc_id for r in spans] == [r.doc_id for r in ordered]
    vocabulary = encoder(public_tokenizers.path("word_bpe_49k.json")).tokenizer
    start = 0
    for span, doc in zip(spans, ordered):
        n = len(vocabulary.encode(doc.text or "", add_special_tokens=False).ids) + 1
        assert (span.start, span.n_tokens) == (start, n)
        start += n


def test_empty_input(spark, tmp_path, stages):
    stages[0].where("doc_id = -5").write.parquet(f"file://{tmp_path}/in")
    docs = spark.read.parquet(f"file://{tmp_path}/in")
    for k, (_, function) in enumerate(corpus_pipeline.STAGES):
        function(spark, docs, SF).write.parquet(f"file://{tmp_path}/{k}")
        docs = spark.read.parquet(f"file://{tmp_path}/{k}")
    assert docs.count() == 0


CLASHING = ["block", "slot", "release_slot", "deadline_slot", "place", "mix_hash", "mix_bucket", "mix_number", "_hash", "text_hash", "row", "a.b"]


def test_columns_of_any_name_come_out_unchanged(spark, tmp_path, stages):
    names = stages[0].columns
    rows_in = [(*r, *(f"{c}{i}" for c in CLASHING)) for i, r in enumerate(map(tuple, stages[0].collect()))]
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in stages[0].schema), *(f"`{c}` string" for c in CLASHING)])
    # rows that repeat an id and text, told apart by their other columns
    spark.createDataFrame(rows_in, schema).coalesce(1).write.parquet(f"file://{tmp_path}/in")
    docs = spark.read.parquet(f"file://{tmp_path}/in")
    for k, (_, function) in enumerate(corpus_pipeline.STAGES[:4]):
        function(spark, docs, SF).write.parquet(f"file://{tmp_path}/{k}")
        docs = spark.read.parquet(f"file://{tmp_path}/{k}")
        assert docs.columns == [*names, *CLASHING]
        found = rows(docs)
        assert max(found.values()) == 1 and set(found) <= set(rows_in)
        assert rows(docs.select(names)) == rows(stages[k + 1])


def test_files_are_read_in_the_order_of_their_numbers(spark, tmp_path):
    """Beyond 99,999 partitions names have six digits, and do not sort as text."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for number, doc_id in (("99999", 1), ("100000", 2), ("100001", 3)):
        frame = spark.createDataFrame([(doc_id, "word", "en", "s", 4)], schema).coalesce(1)
        frame.write.parquet(f"file://{tmp_path}/{number}")
        (part,) = (tmp_path / number).glob("part-*.parquet")
        (tmp_path / "all").mkdir(exist_ok=True)
        (tmp_path / "all" / f"part-{number}-x.c000.parquet").write_bytes(part.read_bytes())
    spans = corpus_pipeline.token_files(spark, spark.read.parquet(f"file://{tmp_path}/all"), SF).collect()
    assert [r.doc_id for r in sorted(spans, key=lambda r: r.start)] == [1, 2, 3]
