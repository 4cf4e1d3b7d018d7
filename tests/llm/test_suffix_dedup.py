import hashlib
import random

import numpy as np
import pytest
from compare import SF

from loomspan.llm import suffix_dedup as sd
from loomspan.llm.anchors import SPAN, stretches, window_hashes


def brute(rows):
    """Per row: bytes, removed, runs, digest of what is kept."""
    first = {}
    for i, t in rows:
        key = np.iinfo(np.int64).max if i is None else i
        b = (t or "").encode()
        for s in range(len(b) - SPAN + 1):
            first[b[s : s + SPAN]] = min(first.get(b[s : s + SPAN], key), key)
    out = []
    for i, t in rows:
        key = np.iinfo(np.int64).max if i is None else i
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for s in range(len(b) - SPAN + 1):
            if first[b[s : s + SPAN]] < key:
                gone[s : s + SPAN] = True
        gone = gone[: len(b)]
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((i, len(b), int(gone.sum()), runs, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
    return sorted(out, key=repr)


def run(df):
    got = sd.remove_repeats(df, ["doc_id"]).collect()
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept_bytes)).hexdigest()) for r in got), key=repr)


@pytest.mark.parametrize(("batch", "entries"), [(300, 250_000), (300, 20), (5000, 250_000), (1 << 20, 250_000)])
def test_against_brute_force(spark, docs, monkeypatch, batch, entries):
    monkeypatch.setattr(sd, "BATCH", batch)
    monkeypatch.setattr(sd, "SHARD_ENTRIES", entries)
    monkeypatch.setattr(sd, "FILE_BATCHES", 3)
    draw = random.Random(batch)
    passages = ["".join(draw.choice("abé ") for _ in range(draw.randint(30, 140))) for _ in range(8)] + ["z" * 130, "xy" * 60]
    rows = []
    for i in range(60):
        parts = [draw.choice(passages) if draw.random() < 0.5 else "".join(draw.choice("abcdefgh ") for _ in range(draw.randint(0, 80))) for _ in range(draw.randint(0, 6))]
        rows.append((i * 3 - 40, "".join(parts)))
    draw.shuffle(rows)
    assert run(docs(rows).repartition(3)) == brute(rows)


def test_nulls_ties_and_edges(spark, docs):
    p = "".join(chr(97 + k % 26) for k in range(49))
    rows = [(1, p + "!"), (2, p + "!"), (2, p + "!"), (2, "q" + p + "!q"), (3, p), (4, None), (5, ""), (None, p + "!"), (None, "tail " + p + "!"), (0, p + "?"), (7, (p + "!") * 40), (6, "é" * 25), (8, "aé" + "é" * 25)]
    assert run(docs(rows)) == brute(rows)


def test_text_output_drops_cut_characters(spark, docs):
    rows = [(1, "é" * 30), (2, "xé" + "é" * 30 + "y")]
    got = {r.doc_id: r.kept_text for r in sd.remove_repeats(docs(rows), ["doc_id"], as_text=True).collect()}
    assert got == {1: "é" * 30, 2: "xy"}


def test_spans_and_carried_columns(spark, docs):
    s = "0123456789" * 5
    df = docs([(1, s, "src", "en", 1), (2, "ab" + s + "cd" + s, None, "de", 2)], ", kept_text int")
    got = {r.doc_id: r for r in sd.remove_repeats(df, ["kept_text", "source", "doc_id"]).collect()}
    assert [(x.start, x.end) for x in got[2].spans] == [(2, 52), (54, 104)]
    assert got[2].kept_text == 2 and got[1].source == "src" and bytes(got[2].kept_bytes) == b"abcd"


def test_empty_table(spark, docs):
    assert run(docs([])) == []


def test_every_window_owns_one_anchor():
    draw = np.random.default_rng(3)
    data = draw.integers(97, 101, 5000).astype(np.uint8)
    offsets = np.array([0, 10, 10, 60, 2000, 5000])
    s = stretches(data, offsets)
    owned = np.concatenate([np.arange(a, b + 1) for a, b in zip(s.first, s.last, strict=True)])
    want = np.concatenate([np.arange(a, b - SPAN + 1) for a, b in zip(offsets[:-1], offsets[1:], strict=True) if b - a >= SPAN])
    assert (np.sort(owned) == want).all()
    h = window_hashes(data, want)
    assert len(np.unique(h)) == len({data[i : i + SPAN].tobytes() for i in want})


def test_family_keeps_few_levels_and_finds_smaller_documents():
    draw, family, batches = np.random.default_rng(1), sd.Family(), []
    for _ in range(40):
        n = int(draw.integers(1, 60))
        key = draw.integers(0, 200, n).astype(">u4").view("S4")
        whole, doc = draw.integers(0, 3, n).astype(np.uint64), draw.integers(0, 50, n)
        batches += zip(key.tolist(), whole.tolist(), doc.tolist(), strict=True)
        family.add(key, whole, doc)
        sizes = [len(level[0]) for level in family.levels]
        assert all(a >= 2 * b for a, b in zip(sizes, sizes[1:], strict=False)) and len(sizes) <= 10
    least, around = {}, {}
    for k, w, d in batches:
        least[k, w] = min(least.get((k, w), d), d)
    for (k, w), d in least.items():
        around.setdefault(k, set()).add(d)
    want = [sd._SETTLED if least[k, w] < d else sd._OPEN if len(around[k]) > 1 else 0 for k, w, d in batches]
    assert family.close().tolist() == want


def test_levels_are_in_the_order_of_their_bytes():
    family = sd.Family()
    words = [w.encode() for w in "the cat sat on a mat and the dog sat by".split()]
    for at in range(0, len(words), 3):
        key = np.array(words[at : at + 3], "S8")
        family.add(key, np.zeros(len(key), np.uint64), np.arange(len(key)))
    for key, *_ in family.levels:
        assert key.tolist() == sorted(key.tolist())


def test_clashing_names(spark, docs):
    s = "0123456789" * 5
    df = docs([(1, s, "a", "en", 7, 8), (2, "x" + s, "b", "de", 9, 10)], ", n_bytes int, grp int")
    got = {r.doc_id: r for r in sd.remove_repeats(df, df.columns, as_text=True).collect()}
    assert (got[2].n_bytes, got[2].grp, got[2].kept_text) == (51, 10, "x")
    got = {r.doc_id: r for r in sd.remove_repeats(df, df.columns, prefix="__").collect()}
    assert (got[2].n_bytes, got[2]["__n_bytes"], got[2]["__n_removed"]) == (9, 51, 50)


def test_query_against_brute_force(spark):
    got = [tuple(r) for r in sd.query(spark, SF).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()]
    assert sorted(got, key=repr) == brute([(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()])
