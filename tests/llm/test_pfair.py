import math
from fractions import Fraction

import pytest
from hypothesis import given, settings, strategies as st

from strata.llm.pfair import mix_sources, scheduled_blocks


ROWS = [(i, "a" if i % 3 else ("b" if i % 2 else None), f"text {i}", "clash") for i in range(600)]
ROWS += [(5, "a", "text 5", "clash"), (5, "a", "text 5", "clash"), (None, "c", None, "clash")]


def test_all_rows_in_a_fair_order(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, source string, text string, slot string")
    weights = {"a": 2.0, "b": 1.0, None: 1.0, "c": 0.5}
    mixed = mix_sources(docs, weights, block_rows=4, period=40, bucket_rows=50).collect()
    assert sorted(((r.doc_id, r.source, r.text) for r in mixed), key=str) == sorted((r[:3] for r in ROWS), key=str)
    places = [r.place for r in mixed]
    assert len(set(places)) == len(places)
    by_source = {}
    for r in sorted(mixed, key=lambda r: r.place):
        assert r.release_slot <= r.slot < r.deadline_slot
        by_source.setdefault(r.source, []).append(r)
    for rows in by_source.values():
        assert [r.block for r in rows] == [i // 4 for i in range(len(rows))]
        hashes = [r.block for r in rows]
        assert hashes == sorted(hashes)


def test_refusals_and_empty(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, source string, text string, slot string")
    with pytest.raises(ValueError):
        mix_sources(docs, {"a": 1.0})
    assert mix_sources(docs.where("doc_id > 10000")).count() == 0
    assert mix_sources(docs).count() == len(ROWS)


def fluid(blocks, weights, slot):
    """Blocks that each source has had by ``slot`` when all run at once by their exact weights."""
    left, had, at = dict(blocks), dict.fromkeys(blocks, Fraction(0)), Fraction(0)
    while left:
        total = sum(Fraction(weights[s]) for s in left)
        step = min((n - had[s]) / Fraction(weights[s]) for s, n in left.items()) * total
        run = min(step, slot - at)
        for s in left:
            had[s] += Fraction(weights[s]) / total * run
        at += run
        if run < step:
            break
        left = {s: n for s, n in left.items() if had[s] < n}
    return had


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(0, 30), st.tuples(st.integers(1, 25), st.floats(1e-3, 1e3)), min_size=1, max_size=7))
def test_every_slot_is_within_one_block_of_the_given_weights(sources):
    blocks, weights = {s: n for s, (n, _) in sources.items()}, {s: w for s, (_, w) in sources.items()}
    done = dict.fromkeys(blocks, 0)
    for at, (s, k, slot, release, due) in enumerate(scheduled_blocks(blocks, weights)):
        assert slot == at and k == done[s] and release <= slot < due
        done[s] += 1
        assert all(abs(x - done[s]) < 1 for s, x in fluid(blocks, weights, slot + 1).items())
    assert done == blocks


def test_a_hot_source_among_many_keeps_its_weight():
    counts = {0: 1_000_000} | dict.fromkeys(range(1, 1201), 1_500)
    blocks, weights = {s: -(-n // 64) for s, n in counts.items()}, {s: n**0.5 for s, n in counts.items()}
    share, done = Fraction(weights[0]) / sum(map(Fraction, weights.values())), 0
    for s, _, slot, *_ in scheduled_blocks(blocks, weights):
        done += s == 0
        if slot < 20_000:  # before any source ends
            assert abs(share * (slot + 1) - done) < 1
    assert done == blocks[0]


def test_more_sources_than_a_period(spark):
    docs = spark.range(2400).selectExpr("id as doc_id", "concat('host', id % 1200) as source")
    mixed = mix_sources(docs, block_rows=1).collect()
    assert sorted(r.slot for r in mixed) == list(range(2400))
    assert all(r.release_slot <= r.slot < r.deadline_slot for r in mixed)


def test_query_equals_a_plain_schedule_of_the_given_table(spark):
    """Documents sorted by hash and cut by source; each slot runs the released block that is due first."""
    from pyspark.sql import functions as F

    from strata.llm.queries import queries

    sf_dir = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", F.xxhash64(F.lit(7), "doc_id").alias("h")).collect()
    by_source = {}
    for r in sorted(rows, key=lambda r: (r.h, r.doc_id)):
        by_source.setdefault(r.source, []).append(r.doc_id)
    weights = {s: Fraction(len(own) ** 0.5) for s, own in by_source.items()}
    blocks = {s: -(-len(own) // 64) for s, own in by_source.items()}
    names = sorted(blocks)

    def at(s, k):
        """Slot time at which the fluid has given ``s`` its first ``k`` blocks."""
        inner = Fraction(k) / weights[s]
        return sum(min(weights[t] * inner, blocks[t]) for t in names)

    waiting = {(s, k): (math.floor(at(s, k)), math.ceil(at(s, k + 1))) for s in names for k in range(blocks[s])}
    place = {}
    for slot in range(sum(blocks.values())):
        due, _, _, s, k = min((due, names.index(s), k, s, k) for (s, k), (release, due) in waiting.items() if release <= slot)
        assert due > slot
        del waiting[s, k]
        for i, doc_id in enumerate(by_source[s][64 * k : 64 * k + 64]):
            place[doc_id] = 64 * slot + i
    found = queries()["op8_pfair_mixture"](spark, sf_dir).collect()
    assert {r.doc_id: r.place for r in found} == place and len(found) == len(rows)
