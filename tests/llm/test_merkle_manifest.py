import hashlib
import random

import pytest
from pyspark.sql import functions as F

from strata.llm.merkle_manifest import audit, build, copied_nodes, levels_above, path_copy

COLUMNS = ["doc_id", "source", "text"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels(nodes):
    found = [nodes]
    while len(found[-1]) > 1:
        found.append([h(*found[-1][i : i + 16]) for i in range(0, len(found[-1]), 16)])
    return found


def plain(rows, tampered, change):
    """Trees, proofs and folded roots, one row after another."""
    by_source = {}
    for row in rows:
        by_source.setdefault(row[1], []).append(row)
    order = sorted(by_source, key=lambda s: (s is not None, "" if s is None else s.encode()))
    trees = {s: levels([leaf(r) for r in sorted(by_source[s], key=lambda r: (r[0] is not None, r[0], leaf(r)))]) for s in order}
    top = levels([trees[s][-1][0] for s in order])
    found = []
    for s in order:
        for place, row in enumerate(sorted(by_source[s], key=lambda r: (r[0] is not None, r[0], leaf(r)))):
            digest = leaf(change(row)) if tampered(row) else leaf(row)
            beside = ""
            for tree, at in ((trees[s], place), (top, order.index(s))):
                for level in tree[:-1]:
                    start = at // 16 * 16
                    left, right = "".join(level[start:at]), "".join(level[at + 1 : start + 16])
                    beside += left + right
                    digest, at = h(left, digest, right), at // 16
            found.append((str(row[0]), leaf(row), trees[s][-1][0], top[-1][0], h(beside), digest, digest == top[-1][0]))
    return sorted(found)


def got(frame):
    return sorted((str(r.doc_id), r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in frame.collect())


def run(spark, rows):
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, source string, text string, idx string").repartition(4)
    return audit(docs, COLUMNS, {"text": F.lower("text")}, F.col("doc_id") % 3 == 0)


def expected(rows):
    lowered = lambda r: (r[0], r[1], None if r[2] is None else r[2].lower())
    return plain(rows, lambda r: r[0] is not None and r[0] % 3 == 0, lowered)


@pytest.mark.parametrize("sizes", [[1], [16], [17], [1, 2, 300], [4096], [4097, 1], [9000]])
def test_trees_of_many_sizes(spark, sizes):
    rows = [(1000 * k + i if len(sizes) > 1 else i, f"s{k}", f"Text {i}") for k, size in enumerate(sizes) for i in range(size)]
    assert got(run(spark, rows)) == expected(rows)


def test_many_groups_nulls_and_repeated_rows(spark):
    some = random.Random(3)
    rows = [(i, some.choice(["ä", "B", "a", "", None, *map(str, range(40))]), some.choice(["", None, "Upper", "low"])) for i in range(500)]
    rows += [(None, "a", "Null id"), (7, "B", "same"), (7, "B", "same"), (9, None, "x" * 100_000)]
    assert got(run(spark, rows)) == expected(rows)


def test_thousands_of_groups(spark):
    rows = [(i, f"host{i % 5000}", "T") for i in range(6000)]
    assert got(run(spark, rows)) == expected(rows)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, source string, text string")
    assert audit(docs, COLUMNS, {"text": F.lower("text")}, F.lit(True)).count() == 0


def test_versions_share_all_nodes_but_the_ancestors():
    tree = build([h(str(i)) for i in range(600)], 3)
    version = path_copy(tree, 3, 500, h("other"))
    assert version[0] != tree[0] and build([h("other") if i == 500 else h(str(i)) for i in range(600)], 3) == version

    def shared(a, b):
        same = [x is y for x, y in zip(a[1], b[1], strict=True)]
        changed = [(x, y) for x, y in zip(a[1], b[1]) if x is not y]
        return same.count(False), changed

    node = (tree, version)
    for _ in range(3):
        n, changed = shared(*node)
        assert n == 1
        node = changed[0]
    assert len(copied_nodes(version, 3, 500)) == 3 and copied_nodes(version, 3, 500)[-1] == version[0]


def test_copied_nodes_lead_to_the_root(spark):
    rows = [(i, "s", f"T{i}") for i in range(5000)] + [(9000, "t", "T")]
    for r in run(spark, rows).collect():
        if r.doc_id % 3:
            assert r.copied is None and r.verified
        else:
            assert len(r.copied) == levels_above(5000 if r.doc_id < 9000 else 1) + 1
            assert r.copied[-1] == r.folded_root != r.root
