import random

import pytest
from compare import SF, connect, same_rows

import corpus_pipeline
from loomspan.llm import quality_classifier as qc
from loomspan.llm import registry
from loomspan.llm.common import stage


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, name):
    same_rows(registry.queries()[name](spark, SF), connect(), registry.oracle_sql()[name])


def test_stages_on_a_fixture(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before, texts = {r.doc_id for r in docs.collect()}, None
    for name, step in corpus_pipeline.STAGES:
        out = stage(step(spark, docs, SF), f"test-{name}")
        ids = [r.doc_id for r in out.collect()]
        assert set(ids) <= before and ids
        if name != "tokens":
            assert out.columns == docs.columns
        if name == "mixing":
            assert set(ids) == texts
        texts, docs = set(ids), out


def test_near_copies_keep_one_row(spark, docs):
    draw = random.Random(4)
    base = " ".join(str(draw.randint(0, 9999)) for _ in range(80))
    other = " ".join(str(draw.randint(0, 9999)) for _ in range(80))
    rows = [(5, base), (3, base + " more"), (3, base + " more"), (8, other), (9, other), (None, base), (11, None), (12, "")]
    got = sorted(((r.doc_id, r.text) for r in corpus_pipeline.near_copies(spark, docs(rows), SF).collect()), key=repr)
    assert got == sorted([(3, base + " more"), (8, other), (None, base), (11, None), (12, "")], key=repr)


#: Names that the operators use inside.
CLASHES = ["kept", "n_bytes", "n_removed", "spans", "kept_text", "epochs", "blocks", "of", "epoch", "block", "place", "n_tokens", "id", "n", "bucket", "quality", "quality_score", "word", "bits", "set_hash", "h", "grp", "batch"]


def test_stages_carry_columns_of_any_name(spark, docs):
    draw = random.Random(8)
    base = [" ".join(str(draw.randint(0, 9999)) for _ in range(60)) for _ in range(4)]
    rows = [(i, base[i % 4] + (" and more" if i > 5 else ""), f"s{i % 3}", "en") for i in range(9)] + [(20, None, None, None), (21, "", "s1", "de"), (None, base[1] + " tail", "s2", "fr"), (22, "w " * 40_000, "s0", "en")]
    df = docs([(*r, *(f"{c}{r[0]}" for c in CLASHES)) for r in rows], "".join(f", {c} string" for c in CLASHES))
    for name, step in corpus_pipeline.STAGES[1:4]:
        out = stage(step(spark, df, SF), f"clash-{name}")
        assert out.columns == df.columns and out.count()
        assert all(r[c] == f"{c}{r.doc_id}" for r in out.collect() for c in CLASHES)
    assert stage(corpus_pipeline.quality(spark, df, SF), "clash-quality").columns == df.columns
    assert corpus_pipeline.tokens(spark, df, SF).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_stages_of_empty_tables(spark, docs):
    for name, step in corpus_pipeline.STAGES:
        out = stage(step(spark, docs([]), SF), f"empty-{name}")
        assert out.count() == 0 and (name == "tokens" or out.columns == docs([]).columns)


def test_quality_stage_drops_what_is_scored_low(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    scored = {r.doc_id: r.predicted for r in qc.query(spark, SF).collect()}
    assert {r.doc_id for r in corpus_pipeline.quality(spark, docs, SF).collect()} == {i for i, p in scored.items() if p}


def test_passages_stage_against_brute_force(spark, docs):
    p = "0123456789" * 6
    rows = [(3, f"before {p} after"), (1, p), (2, p), (4, "é" + p[:50] + "é"), (None, p + "x"), (5, "none of it"), (6, ""), (7, None)]
    got = sorted(((r.doc_id, r.text) for r in corpus_pipeline.passages(spark, docs(rows), SF).collect()), key=repr)
    assert got == sorted([(1, p), (3, "before  after"), (4, "éé"), (None, "x"), (5, "none of it"), (6, ""), (7, "")], key=repr)
