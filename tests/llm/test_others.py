import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from compare import SF
from pyspark.sql import functions as F

from loomspan.llm import fingerprints as fp
from loomspan.llm import language_id as li
from loomspan.llm import nearest_neighbours as nn
from loomspan.llm import quality_classifier as qc
from loomspan.llm import source_mixing as sm
from loomspan.llm import url_filter as uf

# op1


def judged(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url is not None and "://" in url else ""
    host = ""
    for c in rest:
        if c in "/?#":
            break
        host += c.lower() if c.isascii() else c
    path = rest[len(host) :]
    for c in "?#":
        path = path.split(c)[0]
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p) and host]
    best = max(fits, default=None)
    return host, path, best[2] if best else None, best[3] if best else default


def test_url_filter_against_a_loop(spark, monkeypatch):
    rules = [*uf.RULES, ("a.b", "", "block"), ("b", "/x?y", "block"), ("é.org", "/É", "block"), ("b", "/x", "allow")]
    urls = [None, "", "no scheme", "://", "http://", "HTTP://EXAMPLE.com/en/7?x#y", "https://a.com/en/", "https://a.com/en", "ftp://x.a.b", "http://xa.b/x", "http://b/x/y", "http://com/en/1", "http://é.org/Éa", "http://É.org/É", "http://u@example.net:80/de/8", "http://example.net/de/8", "http://m.example.net/de/80#a", "a://b://c/d", "http://e.net?de/", "http://\n.net/de/"] * 2
    want = sorted(((i, *judged(u, rules)) for i, u in enumerate(urls)), key=repr)
    pages = spark.createDataFrame([(i, u, "clash", 1) for i, u in enumerate(urls)], "page_id bigint, url string, host string, key int")
    listed = spark.createDataFrame(rules, "host string, path string, verdict string")
    for limit in (uf.BROADCAST_RULES, 0):
        monkeypatch.setattr(uf, "BROADCAST_RULES", limit)
        got = sorted((tuple(r) for r in uf.filter_urls(pages, listed).collect()), key=repr)
        assert got == want


def test_url_filter_repeats_and_empty(spark):
    listed = spark.createDataFrame(uf.RULES, "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://a.com/en/")] * 5 + [(None, None)] * 3, "page_id bigint, url string")
    got = [tuple(r) for r in uf.filter_urls(pages, listed).collect()]
    assert sorted(got, key=repr) == sorted([(1, "a.com", "/en/", "com/en/", "block")] * 5 + [(None, "", "", None, "allow")] * 3, key=repr)
    assert uf.filter_urls(pages.limit(0), listed).count() == 0
    assert {r.verdict for r in uf.filter_urls(pages, listed.limit(0)).collect()} == {"allow"}


def test_url_filter_of_very_long_hosts(spark):
    listed = spark.createDataFrame([*uf.RULES, ("", "/z", "block")], "host string, path string, verdict string")
    urls = ["http://" + "a." * 60_000 + "com/en/" + "x/" * 60_000, "http://" + "b" * 100_000, "http://a./z", "http://a/z"]
    got = {r.page_id: r for r in uf.filter_urls(spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string"), listed).collect()}
    assert (got[0].rule, got[0].verdict, len(got[0].host)) == ("com/en/", "block", 120_003)
    assert got[1].rule is None and got[2].rule == "/z" and got[3].rule is None


def test_bloom_filter_has_no_false_negatives(spark):
    keys = spark.range(3000).select(F.col("id").cast("string").alias("key"))
    bloom, blocks = uf.bloom_filter(keys, 3000)
    tried = spark.range(6000).select("id", F.xxhash64(F.col("id").cast("string")).alias("h")).withColumn("block", F.pmod("h", F.lit(blocks)))
    hit = F.lit(True)
    for i, s in enumerate(uf.WORD_SALTS):
        hit = hit & (F.call_function("shiftright", F.col(f"w{i}"), uf._bit(F.col("h"), s)).bitwiseAND(F.lit(1)) == 1)
    rows = {r.id for r in tried.join(bloom, "block").where(hit).collect()}
    assert set(range(3000)) <= rows and len(rows) < 3100


# op2


def test_differences_are_recovered_at_any_size():
    draw = np.random.default_rng(2)
    left, right = [], []
    for n in (0, 1, 5, 40, 700, 3000):
        common = draw.integers(0, 1 << 63, n).astype(np.uint64)
        a, b = (draw.integers(0, 1 << 63, int(draw.integers(0, 2 * n + 2))).astype(np.uint64) for _ in range(2))
        left.append(np.unique(np.concatenate([common, a])))
        right.append(np.unique(np.concatenate([common, b])))
    for (x, y), (a, b) in zip(zip(left, right, strict=True), fp.differences(left, right), strict=True):
        assert set(a.tolist()) == set(x.tolist()) - set(y.tolist())
        assert set(b.tolist()) == set(y.tolist()) - set(x.tolist())


def test_compare_with_next(spark, docs):
    draw = random.Random(8)
    texts = [" ".join("".join(draw.choice("abcdeé") for _ in range(4)) + draw.choice(["", ".", "\n"]) for _ in range(draw.randint(0, 90))) for _ in range(30)] + [None, "", "a", "ab", "abc"]
    rows = [(i * 7 % 101, t) for i, t in enumerate(texts)] + [(None, "no id at all here")]
    ids = sorted((r[0] for r in rows if r[0] is not None), reverse=True) + [None]
    text = {i: t or "" for i, t in rows}
    got = {r.doc_id: r for r in fp.compare_with_next(docs(rows).repartition(3)).collect()}
    assert len(got) == len(rows)
    for k, i in enumerate(ids):
        following = text[ids[(k + 1) % len(ids)]]
        t = text[i]
        changed = t[: len(t) - len(t) // 3] + following[: len(t) // 3]
        like = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
        a, b, c = (set(fp.pieces(x).tolist()) for x in (t, changed, following))
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(changed.encode()).hexdigest())
        assert (r.near_edited, r.near_next) == (pytest.approx(like(a, b)), pytest.approx(like(a, c)))
        assert (r.fingerprint == r.edited_fingerprint) == (a == b)


def test_ids_of_many_rows_are_dealt_out(spark, docs):
    """Half of the rows have no id and a third have one id: they are ordered by hash and text, and tasks share them."""
    draw = random.Random(6)
    rows = [(draw.choice([None, None, None, 7, 7, i]), " ".join(draw.choice(["ab", "cd.", "ef"]) for _ in range(draw.randint(0, 40)))) for i in range(300)]
    df = docs([(*r, "s", "en", "clash", 1) for r in rows], ", fingerprint string, part int").repartition(3)
    out = fp.compare_with_next(df)
    parts = out.groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) == 4 and max(r["count"] for r in parts) < 160
    got = out.collect()
    assert len(got) == 300
    h = {t: x for t, x in df.select("text", F.shiftrightunsigned(F.xxhash64("text"), 1)).collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), -h[r[1]], r[1]))
    want = [(i, len(t), hashlib.sha256(fp.edit(t, order[(k + 1) % 300][1]).encode()).hexdigest()) for k, (i, t) in enumerate(order)]
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=repr) == sorted(want, key=repr)


def test_fingerprint_query_against_a_loop(spark):
    rows = sorted(((r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect()), reverse=True)

    def cut(t):
        """Six words of a sentence each, by hand."""
        out = set()
        for line in re.findall(r"[^\n.!?]+[.!?]*|[.!?]+", t):
            words = line.split()
            out |= {tuple(words[i : i + 6]) for i in range(0, len(words), 6)}
        return out

    like = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    got = {r.doc_id: r for r in fp.query(spark, SF).collect()}
    assert len(got) == len(rows)
    for k, (i, t) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        n = len(t) // 3
        changed = t[: len(t) - n] + following[:n]
        assert (got[i].n_chars, got[i].edited_sha256) == (len(t), hashlib.sha256(changed.encode()).hexdigest())
        assert (got[i].near_edited, got[i].near_next) == (pytest.approx(like(cut(t), cut(changed))), pytest.approx(like(cut(t), cut(following))))


def test_next_of_a_single_and_of_none(spark, docs):
    (r,) = fp.compare_with_next(docs([(5, "abcdef")])).collect()
    assert r.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and r.near_next == 1.0
    assert fp.compare_with_next(docs([])).count() == 0


# op5


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, rank int")


def test_neighbours_of_small_tables_are_exact(spark):
    draw = np.random.default_rng(4)
    x = draw.normal(size=(60, 8)).astype(np.float32)
    x[10:25] = x[10]
    rows = [(i * 10, x[i].tolist(), 1) for i in range(60)] + [(7, None, 1), (17, [0.0] * 8, 1), (27, [1.0, None] * 4, 1), (37, [float("nan")] * 8, 1), (47, [1.0, 2.0], 1), (57, [float("inf")] * 8, 1), (None, x[0].tolist(), 1), (50, x[5].tolist(), 1)]
    usable, dim = nn.usable(vectors(spark, rows).repartition(3))
    index, quantizer = nn.build_index(usable, dim)
    got = {}
    for r in nn.search(index, quantizer, index.where("vec_id % 100 = 0"), top=10).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert sorted(got) == [0, 100, 200, 300, 400, 500]
    for q, found in got.items():
        far = sorted((math.dist(x[i].astype(float), x[q // 10].astype(float)), i * 10) for i in range(60) if i * 10 != q)[:10]
        assert [f[0] for f in sorted(found)] == list(range(1, 11))
        assert [f[1] for f in sorted(found)] == [w[1] for w in far]
        assert [f[2] for f in sorted(found)] == pytest.approx([w[0] for w in far], abs=1e-12)


def test_recall_in_query_blocks(spark, monkeypatch):
    monkeypatch.setattr(nn, "QUERY_BLOCK", 7)
    monkeypatch.setattr(nn, "PASS", 16)
    draw = np.random.default_rng(6)
    x = draw.normal(size=(3000, 32)).astype(np.float32)
    usable, dim = nn.usable(vectors(spark, [(i, v.tolist(), 0) for i, v in enumerate(x)]))
    index, quantizer = nn.build_index(usable, dim)
    got = {}
    for r in nn.search(index, quantizer, index.where("vec_id % 100 = 0"), rerank=60).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q in range(0, 3000, 100):
        far = ((x - x[q]).astype(float) ** 2).sum(1)
        far[q] = np.inf
        hits += len(got[q] & set(np.argsort(far)[:10].tolist()))
    assert len(got) == 30 and hits / 300 >= 0.9


def test_neighbours_among_near_copies_in_one_batch(spark):
    draw = np.random.default_rng(8)
    x = draw.normal(size=(6000, 32))
    x[:4000] = x[0] * (1 + draw.normal(size=(4000, 1)) * 1e-2) + draw.normal(size=(4000, 32)) * 1e-3
    x = x[draw.permutation(len(x))]
    usable, dim = nn.usable(vectors(spark, [(i, v.tolist(), 0) for i, v in enumerate(x)]).coalesce(1))
    x = np.array([r.embedding for r in usable.orderBy("vec_id").collect()])
    index, quantizer = nn.build_index(usable, dim)
    got = {}
    for r in nn.search(index, quantizer, index.where("vec_id % 100 = 0")).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert len(got) == 60
    for q, found in got.items():
        far = ((x - x[q]) ** 2).sum(1)
        far[q] = np.inf
        assert found == np.lexsort((np.arange(len(x)), far))[:10].tolist()


def test_repeated_ids_do_not_hide_equal_vectors(spark):
    rows = [(100, [1.0, 2.0], 0)] * 15 + [(5, [1.0, 2.0], 0)] * 15 + [(i, [1.0, 2.0], 0) for i in range(201, 206)] + [(i, [float(i), 1.0], 0) for i in range(301, 321)]
    usable, dim = nn.usable(vectors(spark, rows).coalesce(1))
    index, quantizer = nn.build_index(usable, dim)
    got = nn.search(index, quantizer, index.where("vec_id = 100")).orderBy("rank").collect()
    assert [(r.vec_id, r.score == 0) for r in got] == [(5, True), *((i, True) for i in range(201, 206)), *((i, False) for i in range(301, 305))]


def test_neighbour_query_against_brute_force(spark):
    rows = [(r.vec_id, np.array(r.embedding, float)) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in nn.query(spark, SF).collect()}
    for q, v in rows:
        if q % 100 == 0:
            far = sorted((float(np.sqrt(((x - v) ** 2).sum())), i) for i, x in rows if i != q)[:10]
            for k, (d, i) in enumerate(far):
                assert got.pop((q, k + 1)) == (i, pytest.approx(d, abs=1e-12))
    assert not got


def test_estimates_alone_find_most_neighbours(spark):
    """Recall when a hundredth of the vectors is measured: of 100 best estimates among 10,000, the ten nearest."""
    draw = np.random.default_rng(5)
    centres = draw.normal(size=(400, 64))
    x = (centres[draw.integers(0, 400, 10_000)] + 0.4 * draw.normal(size=(10_000, 64))).astype(np.float32)
    q = nn.Quantizer(64).train(x[:5000])
    codes, hits = q.encode(x), 0
    norms = (x.astype(float) ** 2).sum(1)
    for k in range(0, 10_000, 200):
        t = q.tables(x[k : k + 1])[0]
        estimate = norms - 2 * sum(t[b][codes[:, b]] for b in range(codes.shape[1]))
        far = ((x - x[k]).astype(float) ** 2).sum(1)
        hits += len(set(np.argsort(estimate)[:101].tolist()) & set(np.argsort(far)[1:11].tolist()))
    assert hits / 500 >= 0.9


def test_long_and_clashing_vector_tables(spark):
    wide = spark.createDataFrame([(i * 50, [float(i + j % 7) for j in range(5000)], 1, "x") for i in range(6)], "vec_id bigint, embedding array<double>, codes int, h string")
    usable, dim = nn.usable(wide)
    index, quantizer = nn.build_index(usable, dim)
    got = nn.search(index, quantizer, index.where("vec_id = 0")).orderBy("rank").collect()
    assert [r.vec_id for r in got] == [50, 100, 150, 200, 250]


def test_no_vectors(spark):
    usable, dim = nn.usable(vectors(spark, [(1, None, 0)]))
    assert nn.build_index(usable, dim) is None


# op6, op8


def test_language_net_learns_and_handles_odd_texts(spark, docs):
    draw = random.Random(3)
    make = {"xx": "abcde", "yy": "vwxyz"}
    rows = [(i, " ".join("".join(draw.choice(make[k]) for _ in range(5)) for _ in range(40)), "s", k) for i, k in enumerate(["xx", "yy"] * 60)]
    odd = [(900, None, None, "xx"), (901, "", None, None), (902, "123 !?", None, "yy"), (903, "é" * 5000, None, None), (None, rows[0][1], None, None)]
    net = li.fit(docs(rows + odd))
    got = {r.doc_id: r for r in li.identify(docs(rows + odd), net, ["doc_id"]).collect()}
    assert np.mean([got[i].lang_pred == k for i, _, _, k in rows]) > 0.98
    assert all(got[i].lang_pred == "und" and got[i].lang_score == 0 for i in (900, 901, 902))
    assert got[903].lang_pred in make and 0 <= got[903].lang_score <= 1 and got[None].lang_pred == "xx"
    assert li.fit(docs([(1, None), (2, "text")])) is None
    assert li.identify(docs([(1, "text")]), None, ["doc_id"]).first().lang_pred == "und"


def plain_probabilities(net, windows):
    """The network as loops over windows, filters, places and bytes."""
    out = []
    for w in windows:
        kept = []
        for f in range(li.FILTERS * len(li.WIDTHS)):
            width, best = li.WIDTHS[f // li.FILTERS], -np.inf
            for at in range(li.WINDOW):
                total = 0.0
                for k in range(width):
                    if at + k < li.WINDOW:
                        total += float(net.p["embed"][w[at + k]].astype(float) @ net.p["filters"][k * li.EMBED : (k + 1) * li.EMBED, f].astype(float))
                best = max(best, total)
            kept.append(max(best + float(net.p["bias"][f]), 0.0))
        z = [sum(kept[f] * float(net.p["dense"][f, c]) for f in range(len(kept))) + float(net.p["out"][c]) for c in range(len(net.languages))]
        high = max(z)
        out.append([v - high - math.log(sum(math.exp(u - high) for u in z)) for v in z])
    return np.array(out)


def test_network_against_plain_loops():
    draw = np.random.default_rng(2)
    net = li.ByteNet(["a", "b", "c"])
    for p in net.p.values():
        p += draw.normal(0, 0.05, p.shape).astype(np.float32)
    net.p["filters"] *= net.seen
    windows = draw.integers(0, 256, (3, li.WINDOW)).astype(np.uint8)
    assert net.log_probabilities(windows) == pytest.approx(plain_probabilities(net, windows), abs=1e-4)


def test_gradients_against_differences():
    draw = np.random.default_rng(9)
    net = li.ByteNet(["a", "b"])
    windows, labels = draw.integers(0, 256, (4, li.WINDOW)).astype(np.uint8), np.array([0, 1, 1, 0])
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    grads = net._gradients(windows, labels)
    # in the double precision that the differences need
    loss = lambda: -li.ByteNet.log_probabilities(net, windows).astype(float)[np.arange(4), labels].mean()
    for name, at in (("dense", (0, 1)), ("out", (0,)), ("bias", (3,)), ("filters", (2, 5)), ("embed", (int(windows[0, 9]), 1))):
        before = net.p[name][at]
        net.p[name][at] = before + 1e-2
        up = loss()
        net.p[name][at] = before - 1e-2
        down = loss()
        net.p[name][at] = before
        assert grads[name][at] == pytest.approx((up - down) / 2e-2, abs=2e-3)


def test_language_query_against_plain_folds(spark, docs):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r.doc_id: r for r in li.query(spark, SF).collect()}
    assert len(got) == len(rows)
    right = []
    for r in rows:
        assert got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        if any(c.isalpha() for c in r.text or "") and r.lang:
            right.append(got[r.doc_id].lang_pred == r.lang)
        assert 0 <= got[r.doc_id].score <= 1
    assert np.mean(right) > 0.95
    # a document's score is the softmax of its windows' mean log-probabilities
    net = li.fit(spark.read.parquet(f"{SF}/documents.parquet").where("crc32(cast(doc_id as string)) % 5 <> 0"))
    short = min((r for r in rows if len((r.text or "").encode()) > li.WINDOW), key=lambda r: len(r.text.encode()))
    raw = short.text.encode()
    parts = [raw[i : i + li.WINDOW] for i in range(0, len(raw), li.WINDOW)]
    logs = plain_probabilities(net, [np.frombuffer(p.ljust(li.WINDOW, b"\0"), np.uint8) for p in parts])
    mean = sum(len(p) * v for p, v in zip(parts, logs, strict=True)) / len(raw)
    p = np.exp(mean) / np.exp(mean).sum()
    assert (got[short.doc_id].lang_pred, got[short.doc_id].score) == (net.languages[p.argmax()], pytest.approx(p.max(), abs=1e-3))


def test_languages_edges(spark, docs):
    names = [f"l{i:03}" for i in range(40)]
    net = li.fit(docs([(i, "abc " * 20, None, n) for i, n in enumerate(names)] + [(7, "abc", None, "l001")] * 50))
    assert net.languages == names
    df = docs([(1, "abc", "s", "x", 5)] * 3, ", lang_pred int")
    got = li.identify(df, net, df.columns).collect()
    assert len(got) == 3 and got[0].lang_pred in names and got[0].source == "s"
    assert li.identify(docs([]), net, ["doc_id"]).count() == 0


def test_windows_cover_whole_texts():
    data = np.frombuffer(b"a" * 600 + b"b" * 256 + b"c", np.uint8)
    windows, owner, length = li.cut(data, np.array([0, 600, 600, 856, 857]))
    assert owner.tolist() == [0, 0, 0, 2, 3] and length.tolist() == [256, 256, 88, 256, 1]
    assert windows[2][:88].tobytes() == b"a" * 88 and not windows[2][88:].any()


def plain_features(text):
    """Hashed features by hand: words, shapes, pairs of words, pairs of shapes that tell repeats."""
    words = re.findall(r"\w+|[^\w\s]+", text)
    top = (1 << 64) - 1
    mult = 0x9E3779B97F4A7C15
    word, shape = [xxhash.xxh64_intdigest(w) for w in words], [xxhash.xxh64_intdigest(qc._shape(w), 7) for w in words]
    mixed = [*word, *shape]
    for i in range(len(words) - 1):
        mixed.append((word[i] * mult & top) ^ word[i + 1])
        mixed.append(((shape[i] * mult & top) ^ shape[i + 1]) + (word[i] == word[i + 1]) & top)
    return [(x * mult & top) >> (64 - qc.BITS) for x in mixed]


def plain_weights(rows, labels, weights):
    """Follow the regularised leader, one coordinate at a time."""
    z, n = {}, {}
    order = np.random.default_rng(1)

    def weight(i):
        if abs(z.get(i, 0.0)) <= qc.L1:
            return 0.0
        return -(z[i] - math.copysign(qc.L1, z[i])) / ((qc.BETA + math.sqrt(n[i])) / qc.ALPHA + qc.L2)

    for _ in range(qc.EPOCHS):
        for r in order.permutation(len(rows)):
            counts = Counter(plain_features(rows[r]))
            x = {i: 20 * c / sum(counts.values()) for i, c in counts.items()} | {1 << qc.BITS: 1.0}
            w = {i: weight(i) for i in x}
            p = 1 / (1 + math.exp(-max(-30, min(30, sum(w[i] * x[i] for i in x)))))
            for i in x:
                g = weights[r] * (p - labels[r]) * x[i]
                sigma = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / qc.ALPHA
                z[i] = z.get(i, 0.0) + g - sigma * w[i]
                n[i] = n.get(i, 0.0) + g * g
    return {i: weight(i) for i in z}


def test_training_and_scores_against_plain_loops():
    draw = random.Random(3)
    texts = [" ".join(draw.choice(["the", "The", "a1", "77", "!!", "end.", "é", "BUY", "BUY"]) for _ in range(draw.randint(0, 30))) for _ in range(25)]
    labels, weights = [draw.randint(0, 1) for _ in texts], [draw.choice([0.5, 1.5]) for _ in texts]
    make = qc.Featurizer()
    assert all(sorted(make(t).tolist()) == sorted(plain_features(t)) for t in texts)
    for t in texts:
        index, count = qc.unpack(qc.pack(make(t)))
        assert dict(zip(index.tolist(), count.tolist(), strict=True)) == Counter(plain_features(t))
    got = qc.train([qc.pack(make(t)) for t in texts], np.array(labels), np.array(weights))
    want = plain_weights(texts, labels, weights)
    assert {i: got[i] for i in want} == pytest.approx(want, abs=1e-5) and np.count_nonzero(got) <= len(want)
    for t, s in zip(texts, qc.score_texts(texts, got, make), strict=True):
        found = plain_features(t)
        raw = float(got[-1]) + sum(20 * float(got[i]) for i in found) / max(len(found), 1)
        assert s == pytest.approx(1 / (1 + math.exp(-raw)), abs=1e-6)


def test_quality_query_against_plain_folds(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = {r.doc_id: r for r in qc.query(spark, SF).collect()}
    assert len(got) == len(rows)
    weights = qc.fit(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet").where("crc32(cast(doc_id as string)) % 3 <> 1"))
    scores = qc.score_texts([r.text for r in rows], weights, qc.Featurizer())
    for r, s in zip(rows, scores, strict=True):
        assert got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert got[r.doc_id].score == pytest.approx(s) and got[r.doc_id].predicted == int(s >= 0.5)
    held = [(got[i].predicted == q) for i, q in label.items() if i in got and got[i].held_out]
    assert np.mean(held) > 0.85


def test_quality_sample_is_bounded(spark, docs):
    rows = [(i % 7, f"word{i} and more", "s", "en", 1) for i in range(400)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(7)], "doc_id bigint, quality int")
    df = docs(rows, ", quality_score int")
    assert qc.fit(df, labels, rows_per_class=5).any()
    assert qc.fit(df, labels, features=40).any() and not qc.fit(df, labels, features=2).any()
    got = qc.score(df, qc.fit(df, labels), df.columns).collect()
    assert len(got) == 400 and 0 <= got[0].quality_score <= 1 and got[0].source == "s"


def test_quality_classifier_learns(spark, docs):
    draw = random.Random(7)
    good = lambda: " ".join(draw.choice(["the", "green", "house", "stood", "near", "water"]) for _ in range(50)) + "."
    bad = lambda: " ".join(draw.choice(["BUY", "NOW!!", "###", "click", "$$$"]) for _ in range(50))
    rows = [(i, good() if i % 2 else bad()) for i in range(200)] + [(None, good()), (501, None), (502, ""), (503, "the " * 50_000)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(0, 200)] + [(3, None, 0), (77777, 1, 0), (None, 1, 0)], "doc_id bigint, quality int, toxic int")
    weights = qc.fit(docs(rows), qc.learned_fold(docs(rows), labels))
    got = {r.doc_id: r.quality_score for r in qc.score(docs(rows), weights, ["doc_id"]).collect()}
    assert all((got[i] >= 0.5) == bool(i % 2) for i in range(200)) and got[None] >= 0.5
    assert got[501] == got[502] and all(0 <= v <= 1 for v in got.values())
    none = qc.fit(docs(rows), labels.limit(0))
    assert {r.quality_score for r in qc.score(docs(rows), none, ["doc_id"]).collect()} == {0.5}
    assert qc.score(docs([]), weights, ["doc_id"]).count() == 0


# op9


def test_mixing_meets_budgets(spark, docs, monkeypatch):
    monkeypatch.setattr(sm, "BLOCK_ROWS", 8)
    draw = random.Random(1)
    rows = [(i, "w " * draw.randint(1, 30), "hot" if i % 10 else f"s{i % 40}") for i in range(600)] + [(9000, None, None), (9001, "", "void"), (9002, "a b c", None)]
    total = sum(len((t or "").split()) for _, t, _ in rows)
    got = sm.mix_sources(docs(rows), ["doc_id", "source"], max_epochs=3.0).collect()
    used, own = {}, {}
    for r in got:
        used[r.source] = used.get(r.source, 0) + r.n_tokens
    for _, t, s in rows:
        own[s] = own.get(s, 0) + len((t or "").split())
    assert sum(used.values()) <= total and sum(used.values()) > 0.93 * total
    assert all(used[s] <= 3.0 * own[s] + 1 for s in own if own[s])
    assert used["hot"] < own["hot"] and [r.doc_id for r in got if r.source == "void"] == [9001]
    by = {}
    for r in got:
        by.setdefault((r.source, r.epoch), []).append(r.doc_id)
    assert all(len(v) == len(set(v)) for v in by.values())
    full = sm.mix_sources(docs(rows), ["doc_id", "source"], max_epochs=2.0, whole=True).collect()
    times = {}
    for r in full:
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    assert set(times) == {r[0] for r in rows} and max(times.values()) <= 2


def test_mixing_clashing_names(spark, docs):
    names = ["epochs", "blocks", "of", "epoch", "place", "n_tokens", "cut_block", "rest"]
    df = docs([(i, "a b c", f"s{i % 2}", "en", *range(8)) for i in range(6)], "".join(f", {n} int" for n in names))
    got = sm.mix_sources(df, df.columns, prefix="__").collect()
    assert {tuple(r[n] for n in names) for r in got} == {tuple(range(8))} and {r["__n_tokens"] for r in got} == {3}
    assert {(r.n_tokens, r.of) for r in sm.mix_sources(df, df.columns).collect()} == {(3, 2)}


def test_mixing_nothing(spark, docs):
    assert sm.mix_sources(docs([]), ["doc_id"]).count() == 0
    assert sm.mix_sources(docs([(1, None, None), (1, None, None)]), ["doc_id"]).count() == 2
