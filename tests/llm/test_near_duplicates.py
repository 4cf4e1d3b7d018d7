import random
import re

import numpy as np
import pytest
from compare import SF

from loomspan.llm import near_duplicates as nd
from loomspan.llm import common
from loomspan.llm.components import components


def shingles(t):
    """As the contract says, with sets of tuples of words."""
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    return {tuple(words)} if 0 < len(words) < 5 else {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    sets = {}
    for i, t in rows:
        sets.setdefault(i, []).append(shingles(t))
    parent = {i: i for i in sets}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and any(x and y and 100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b]):
                p, q = top(a), top(b)
                parent[max(p, q)] = min(p, q)
    return {i: top(i) for i in ids}


def text(draw, n):
    return " ".join(draw.choice("abcdefghijklmnopqrstuvwxyz") * draw.randint(1, 3) + str(draw.randint(0, 99)) for _ in range(n))


def changed(draw, t, k):
    words = t.split(" ")
    for _ in range(k):
        words[draw.randrange(len(words))] = str(draw.randint(1000, 9999))
    return " ".join(words)


def test_components_against_brute_force(spark, docs):
    draw = random.Random(5)
    rows = []
    for _ in range(12):
        base = text(draw, draw.choice([3, 8, 40, 160]))
        rows += [(len(rows) + j, changed(draw, base, draw.choice([0, 0, 1, 2, 4, 6]))) for j in range(draw.randint(1, 12))]
    draw.shuffle(rows)
    got = {r.doc_id: (r.component_id, r.kept, r.n_shingles) for r in nd.near_duplicates(docs(rows)).collect()}
    want = brute(rows)
    assert {i: g[0] for i, g in got.items()} == want
    assert all(g[1] == (i == want[i]) for i, g in got.items())


def test_group_that_hangs_together_by_chains(spark, docs, monkeypatch):
    """Neighbours in a chain reach the threshold, most pairs do not; blocks of four force comparisons across blocks."""
    monkeypatch.setattr(nd, "BLOCK", 4)
    draw = random.Random(9)
    chain = [text(draw, 200)]
    for _ in range(25):
        chain.append(changed(draw, chain[-1], 3))
    order = list(range(len(chain)))
    draw.shuffle(order)
    rows = [(i, chain[k]) for i, k in enumerate(order)]
    got = {r.doc_id: r.component_id for r in nd.near_duplicates(docs(rows)).collect()}
    assert got == brute(rows)


def test_large_groups_go_by_buckets(spark, docs, monkeypatch):
    draw = random.Random(2)
    base = text(draw, 150)
    rows = [(i, changed(draw, base, draw.choice([2, 4, 8, 14]))) for i in range(40)]
    want = brute(rows)
    for limit in (3, 100_000):
        monkeypatch.setattr(nd, "GROUP", limit)
        assert {r.doc_id: r.component_id for r in nd.near_duplicates(docs(rows)).collect()} == want


def test_long_texts_in_one_group_and_hot_keys(spark, docs, monkeypatch):
    """Blocks are cut by shingles too, and frequent classes, pivots and roots are dealt to several tasks."""
    monkeypatch.setattr(nd, "BLOCK_SHINGLES", 5000)
    monkeypatch.setattr(common, "HOT_ROWS", 3)
    draw = random.Random(4)
    base, other = text(draw, 3000), text(draw, 30)
    rows = [(i, changed(draw, base, 95)) for i in range(14)] + [(100 + i, other) for i in range(20)] + [(200 + i, "") for i in range(9)]
    rows += [(300, other), (300, "a b c d e f"), (301, "a b c d e f"), (301, base), (400, "g h i"), (300, "g h i")]
    assert {r.doc_id: r.component_id for r in nd.near_duplicates(docs(rows)).collect()} == brute(rows)


def test_recall_of_pairs_at_the_threshold():
    """Pairs with 75 to 77 of 100 shingles in common: nearly all share a bucket and pass the floor of the signature."""
    draw = np.random.default_rng(3)
    found = 0
    for _ in range(400):
        n = int(draw.integers(60, 600))
        both = draw.integers(0, 1 << 63, n).astype(np.uint64)
        k = int(n / draw.uniform(0.75, 0.77) - n)
        a = np.sort(np.concatenate([both, draw.integers(0, 1 << 63, k // 2).astype(np.uint64)]))
        b = np.sort(np.concatenate([both, draw.integers(0, 1 << 63, k - k // 2).astype(np.uint64)]))
        sig = nd.signatures([a, b])
        bands, low = nd._bands(sig), (sig >> np.uint32(8)).astype(np.uint8)
        found += bool((bands[0] == bands[1]).any() and (low[0] == low[1]).mean() >= nd.SKETCH_FLOOR)
    assert found >= 398


def test_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got, want = nd.query(spark, SF).collect(), brute(rows)
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == sorted((i, len(shingles(t)), want[i], want[i] == i) for i, t in rows)


def test_nulls_empties_repeats_and_case(spark, docs):
    long = "One two three four five six seven " * 300
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "Hello"), (5, "hELLO"), (6, "hello there"), (7, long), (7, long), (7, "quite another text with seven words"), (9, "Quite ANOTHER text with seven words"), (None, "hello"), (None, None), (11, "É é"), (12, "é É")]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in nd.near_duplicates(docs(rows)).collect()), key=repr)
    by = {}
    for g in got:
        by.setdefault(g[0], []).append(g[1:])
    assert by[1] == [(0, 1, True)] and by[2] == [(0, 2, True)]
    assert by[3] == [(0, 3, True)]
    assert by[4] == [(1, 4, True)] and by[5] == [(1, 4, False)] and by[6] == [(1, 6, True)]
    assert len(by[7]) == 3 and all(x[1] == 7 and x[2] for x in by[7])
    assert by[9] == [(2, 7, False)]
    assert sorted(x[0] for x in by[None]) == [0, 1] and all(x[1] is None for x in by[None])
    assert by[11][0][1] == 11 and by[12][0][1] == 12


def test_empty_table_and_clashing_columns(spark, docs):
    assert nd.near_duplicates(docs([])).count() == 0
    rows = [(1, "a b c d e f", "s", "en", 1, "x"), (2, "a b c d e f", "s", "en", 2, "y")]
    df = docs(rows, ", id int, bucket string")
    assert sorted((r.doc_id, r.component_id) for r in nd.near_duplicates(df).collect()) == [(1, 1), (2, 1)]


def test_signatures_estimate_likeness():
    draw = np.random.default_rng(1)
    a = np.unique(draw.integers(0, 1 << 63, 4000).astype(np.uint64))
    b = np.concatenate([a[: int(len(a) * 0.857)], draw.integers(0, 1 << 63, int(len(a) * 0.143)).astype(np.uint64)])
    sig = nd.signatures([a, np.sort(b)])
    assert (sig[0] == sig[1]).mean() == pytest.approx(0.75, abs=0.12)


def test_components_of_links(spark):
    links = spark.createDataFrame([(1, 2), (2, 1), (3, 3), (9, 8), (8, 7), (7, 6), (6, 2), (20, 30)], "a bigint, b bigint")
    assert {r.node: r.component for r in components(links).collect()} == {1: 1, 2: 1, 6: 1, 7: 1, 8: 1, 9: 1, 20: 20, 30: 20}
    assert components(links.where("a = 3")).count() == 0
