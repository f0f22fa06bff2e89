import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from strata.llm import ngram_groups
from strata.llm.components import connected_components
from strata.llm.ngram_groups import Similarity, emitted_tokens, group_pairs, near_duplicates, parities, prefixes, shingle_sets


def plain_set(text, width=5):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    if len(words) < width:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def brute(rows, percent=75):
    sets = [plain_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, s in enumerate(sets):
        for b in range(a):
            if s and sets[b] and 100 * len(s & sets[b]) >= percent * len(s | sets[b]):
                parent[root(a)] = root(b)
    least = {}
    for k, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(k)] = min(least.get(root(k), doc_id), doc_id)
    return sorted(((d, len(s), d if not s else least.get(root(k))) for k, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def mutated(rng, words, share):
    out = list(words)
    for _ in range(int(len(words) * share)):
        out[rng.randrange(len(out))] = f"m{rng.randrange(10**6)}"
    return out


def corpus(seed, n=160):
    """Copies, near copies around the threshold, chains, shared passages and boilerplate."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(3000)}"
    passage = [word() for _ in range(60)]
    lines = [[word() for _ in range(12)] for _ in range(6)]
    bases = [[word() for _ in range(rng.randrange(6, 150))] for _ in range(8)]
    rows = []
    for i in range(n):
        kind = rng.randrange(6)
        if kind == 0:
            words = mutated(rng, rng.choice(bases), rng.choice([0, 0.005, 0.02, 0.03, 0.05, 0.06]))
        elif kind == 1:
            words = [word() for _ in range(rng.randrange(0, 60))]
            at = rng.randrange(len(words) + 1)
            words[at:at] = passage
        elif kind == 2:
            words = [w for line in rng.sample(lines, rng.randrange(2, 6)) for w in line]
        elif kind == 3:
            words = [word() for _ in range(rng.randrange(0, 9))]
        elif kind == 4 and rows:
            words = mutated(rng, (rng.choice(rows)[1] or "").split(" "), 0.04)
        else:
            base = rng.choice(bases)
            words = base[: rng.randrange(len(base) * 3 // 4, len(base) + 1)]
        rows.append((i, " ".join(words)))
    ids = list(range(n))
    rng.shuffle(ids)
    return [(ids[i], t) for i, (_, t) in enumerate(rows)]


SPECIAL = [
    (900, None), (901, ""), (902, " \t\n\x0b\x0c\r "), (903, "ONE two"), (904, "one\nTWO"), (905, "one two three"), (None, "null id words here now"),
    (None, "null id words here now"), (906, "É é ü ß x"), (907, "é é ü ß x"), (905, "one two three"), (908, "a b c d e " * 50), (909, "a b c d e " * 60),
    (905, "other text of the same id and more"), (910, "x y z w v u"),
]


@pytest.mark.parametrize("seed", range(4))
def test_components_equal_brute_force(spark, seed, monkeypatch):
    if seed % 2:
        monkeypatch.setattr(ngram_groups, "GROUP", 3)
        monkeypatch.setattr(ngram_groups, "QUERIES", 2)
        monkeypatch.setattr(ngram_groups, "FREQUENT_FROM", 3)
        monkeypatch.setattr(ngram_groups, "BROADCAST_NODES", 0)
        monkeypatch.setattr(ngram_groups, "HELD_PAIRS", 10)
        monkeypatch.setattr(ngram_groups, "LONG_COLUMN", 2)
    rows = corpus(seed) + SPECIAL
    docs = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, node int")
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in near_duplicates(docs).collect()]
    assert sorted(got, key=str) == brute(rows)


def test_links_that_the_first_comparison_misses(spark, monkeypatch):
    monkeypatch.setattr(ngram_groups, "AGREED", 99)
    rows = corpus(11, 80)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in near_duplicates(docs).collect()]
    assert sorted(got, key=str) == brute(rows)


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_long_texts_in_pieces(monkeypatch):
    texts = ["word another THIRD " * 50 + str(i) for i in range(3)] + ["x" * 500 + " y" * 40, ""]
    whole = list(shingle_sets(texts))
    monkeypatch.setattr(ngram_groups, "AT_ONCE", 64)
    assert all(np.array_equal(a, b) for a, b in zip(whole, shingle_sets(texts), strict=True))
    assert [len(s) for s in whole] == [len(plain_set(t)) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 60), min_size=1), st.sets(st.integers(0, 60), min_size=1), st.sets(st.integers(0, 60)), st.integers(30, 100))
def test_prefixes_of_links_meet_and_bound_the_overlap(a, b, frequent, percent):
    similarity = Similarity(percent)
    a, b, f = (np.array(sorted(x), np.uint64) for x in (a, b, frequent))
    shared = len(np.intersect1d(a, b))
    pa, pb = prefixes([a, b], f, similarity)
    met = len(np.intersect1d(pa, pb))
    if similarity.links(shared, len(a), len(b)):
        assert met >= 1
        small, large = sorted((pa, pb), key=lambda x: len(a) if x is pa else len(b))
        size = min(len(a), len(b))
        assert len(np.intersect1d(small[: similarity.index_prefix(size)], large)) >= 1
    beyond = max(len(a) - len(pa), len(b) - len(pb))
    assert shared <= met + beyond


TOKENS = st.sets(st.integers(0, (1 << 64) - 1).map(lambda x: x % 97 * ((1 << 64) // 97)), min_size=1)


@settings(max_examples=300, deadline=None)
@given(TOKENS, TOKENS, st.lists(TOKENS, max_size=3), st.sets(st.integers(0, 96)), st.integers(30, 100))
def test_met_cells_below_the_cut_bound_the_overlap(a, b, others, frequent, percent):
    """What two sets share is at most the fewer of their met rare tokens below the cut, and the fewer of their other tokens."""
    similarity = Similarity(percent)
    sets = [np.array(sorted(x), np.uint64) for x in (a, b, *others)]
    f = np.array(sorted(x * ((1 << 64) // 97) for x in frequent), np.uint64)
    chosen, beyond = emitted_tokens(sets, f, similarity)
    for tokens, part, rest in zip(sets, chosen, beyond):
        rare = tokens[(tokens < similarity.cut) & ~np.isin(tokens, f)]
        assert len(tokens) - rest == len(rare) and np.array_equal(part[: len(rare)], rare)
        assert len(part) >= similarity.prefix(len(tokens))
    cells, seen = [], {}
    for k, part in enumerate(chosen):
        cells.append(set(part[: len(sets[k]) - beyond[k]].tolist()))
        for token in part.tolist():
            seen.setdefault(token, set()).add(k)
    met = [sum(len(seen[t]) > 1 for t in own) for own in cells]
    shared = len(np.intersect1d(sets[0], sets[1]))
    assert shared <= min(met[0], met[1]) + min(beyond[0], beyond[1])


@given(
    st.lists(st.tuples(st.integers(0, 5), st.integers(0, 3), st.integers(0, 2), st.booleans()), max_size=40),
    st.sampled_from([0, 2, 4, 99]),
    st.sampled_from([1, 5, 1000]),
)
def test_pairs_of_groups(cells, longest, held_pairs):
    tokens = np.array([c[0] for c in cells], np.uint64)
    groups = np.array([c << ngram_groups.CHUNK_BITS | k for _, c, k, _ in cells], np.int64)
    columns = {}
    for (t, _, _, inside), g in zip(cells, groups.tolist()):
        column = columns.setdefault(t, {})
        column[g] = column.get(g, False) or inside
    want, unpaired = {}, []
    for column in columns.values():
        long = len(column) > longest
        unpaired += [g for g, inside in column.items() if long and not inside]
        for g in column:
            for h in column:
                if g < h and g >> ngram_groups.CHUNK_BITS != h >> ngram_groups.CHUNK_BITS:
                    if not long or column[g] or column[h]:
                        want[g, h] = want.get((g, h), 0) + 1
    with pytest.MonkeyPatch.context() as patched:
        patched.setattr(ngram_groups, "LONG_COLUMN", longest)
        patched.setattr(ngram_groups, "HELD_PAIRS", held_pairs)
        (a, b, n), alone = group_pairs(tokens, groups, np.array([c[3] for c in cells], bool))
    assert dict(zip(zip(a.tolist(), b.tolist()), n.tolist())) == want
    assert sorted(alone.tolist()) == sorted(unpaired)


@pytest.mark.parametrize("seed", range(3))
def test_connected_components(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(100 + i, 101 + i) for i in range(30)] + [(5, 5)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {x: root(x) for x in parent}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


@given(st.sets(st.integers(0, 2**64 - 1)), st.sets(st.integers(0, 2**64 - 1)), st.sets(st.integers(0, 2**64 - 1)), st.sampled_from([50, 75, 90]))
def test_parities_never_hold_linked_sets_apart(both, a, b, percent):
    a, b = both | a, both | b
    odd = [parities(np.array(sorted(s), np.uint64)) for s in (a, b)]
    differ = int(np.bitwise_count(odd[0] ^ odd[1]).sum())
    assert differ <= len(a ^ b)
    similarity = Similarity(percent)
    if similarity.links(len(a & b), len(a), len(b)):
        assert not similarity.too_different(np.array([differ]), np.array([len(a) + len(b)]))[0]


def test_copies_that_are_edited_too_much_to_link_are_not_paired(spark, monkeypatch):
    rng = random.Random(5)
    base = [f"w{k}" for k in range(150)]
    rows = [(k, " ".join(mutated(rng, base, 0.08))) for k in range(150)]
    made = []
    real = ngram_groups.qualifying_groups

    def counted(shared, *args):
        made.append(shared.where("b is not null").count())
        return real(shared, *args)

    monkeypatch.setattr(ngram_groups, "qualifying_groups", counted)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((tuple(r) for r in near_duplicates(df).select("doc_id", "n_shingles", "component_id").collect()), key=str)
    assert found == brute(rows)
    assert len({c for _, _, c in found}) > 100  # most link with nothing
    assert made[0] < 150 * 149 / 2 / 20, made


def test_slices_of_a_batch_give_the_same_groups(spark, monkeypatch):
    rows = corpus(11)
    monkeypatch.setattr(ngram_groups, "SLICE", 7)
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = near_duplicates(df).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted((tuple(r) for r in found), key=str) == brute(rows)


def test_a_batch_of_texts_is_never_held_as_strings(spark):
    batch = pa.RecordBatch.from_arrays([pa.array(["word " * 200] * 20_000)], names=["text"])
    tracemalloc.start()
    assert sum(len(texts) for (texts,) in ngram_groups._sliced(batch)) == 20_000
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 5_000_000  # of 20 MB
    df = spark.createDataFrame(corpus(3, 5), "doc_id long, text string")
    plan = ngram_groups.sketch_documents(df, Similarity(75), 5, 8)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "MapInPandas" not in plan
