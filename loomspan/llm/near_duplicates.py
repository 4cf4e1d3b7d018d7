"""MinHash near-dedup with circulant permutations.

A document's set holds its distinct runs of five words. One permutation (sigma) scatters the set over 32 bits,
a second (pi) is applied after a circular shift by k = 0..127, and the smallest value for each k is coordinate k
of the signature. Bands of four coordinates give candidates, which are confirmed on the full sets.

Texts with equal sets are one class, held by its smallest document. The smallest class of a band bucket is its
pivot; each class is first held against the pivots of its buckets, and the likeliest by signature is confirmed. That
joins most of what belongs together with one pair for each class. Where the classes of a bucket are not all in one
component by then, they are open, and open buckets that overlap make a group. In a group those outside its largest
component are compared with all others, block by block: of pairs that share a bucket, signatures leave out what cannot
reach the threshold, full sets decide, and a task reports no more links than join the components it has seen. So every
pair of classes that shares a bucket is confirmed, refuted, or inside one component. Groups of more than GROUP classes
are laid out bucket by bucket instead, which compares the same pairs. Blocks are bounded in rows and in bytes.

Defined results: a null or empty text, or one of white space only, has an empty set and is linked with nothing;
fewer than five words are one shingle; rows with equal doc_id and different texts are linked by having one id;
a null doc_id takes no part in links and is kept; texts of any length are taken whole; an empty table gives an empty
result. Only doc_id and text are read, so other columns, whatever their names, do no harm. Shingles are compared as 64-bit
hashes.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspan.llm.common import bound_batches, drop_path, read_documents, spread, stage, trimmed
from loomspan.llm.components import components, follow

WORDS, THRESHOLD_PERCENT = 5, 75
HASHES, BAND = 128, 4
#: Classes and shingles in one block of a group, about, and classes in a group that is laid out as a whole.
BLOCK, BLOCK_SHINGLES, GROUP = 256, 1 << 20, 100_000
#: Rows of a table of groups (a few numbers each) up to which it is broadcast.
BROADCAST_GROUPS = 100_000
#: Share of equal signature bytes below which a pair is not confirmed: five standard deviations under 0.75.
SKETCH_FLOOR = 0.55
#: 64-bit words of the filter that goes before the join of texts with candidates, and words in one row of it: 16 MB at
#: most in 16384 rows.
FILTER_WORDS, FILTER_ROW = 1 << 20, 64
_SPLIT = re.compile(rb"[^\x20\x09-\x0D]+")
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_CACHE_MAX = 30_000
_U32 = np.uint32
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xD6E8FEB86659FD93)


class Shingler:
    """Texts (UTF-8) to sorted arrays of distinct shingle hashes."""

    def __init__(self, words: int = WORDS) -> None:
        self.words, self.known = words, {}

    def _hash(self, word: bytes) -> int:
        if len(self.known) >= _CACHE_MAX:
            self.known.clear()
        h = self.known[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def __call__(self, text: str | None) -> np.ndarray:
        parts = _SPLIT.findall(text.encode().translate(_LOWER)) if text else []
        if not parts:
            return np.zeros(0, np.uint64)
        get, make = self.known.get, self._hash
        h = np.array([get(w) or make(w) for w in parts], dtype=np.uint64)
        n = max(len(h) - self.words + 1, 1)
        acc = np.full(n, min(len(h), self.words), np.uint64)
        for k in range(min(self.words, len(h))):
            acc = (acc ^ h[k : k + n]) * _MIX
            acc ^= acc >> np.uint64(29)
        acc *= _MIX2
        acc ^= acc >> np.uint64(32)
        acc.sort()
        return acc[np.append(True, acc[1:] != acc[:-1])]


def _permute(x: np.ndarray, c1: int, c2: int) -> np.ndarray:
    """A bijection of 32 bits."""
    x = x ^ (x >> _U32(16))
    x *= _U32(c1)
    x ^= x >> _U32(15)
    x *= _U32(c2)
    return x


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of HASHES coordinates for each set; no set may be empty."""
    out = np.empty((len(sets), HASHES), np.uint32)
    at = 0
    while at < len(sets):
        end, size = at, 0
        while end < len(sets) and (end == at or size + len(sets[end]) <= 65536):
            size += len(sets[end])
            end += 1
        flat = np.concatenate(sets[at:end])
        starts = np.cumsum([0, *(len(s) for s in sets[at : end - 1])])
        spread = _permute((flat ^ (flat >> np.uint64(32))).astype(np.uint32), 0x7FEB352D, 0x846CA68B)
        for k in range(HASHES):
            out[at:end, k] = np.minimum.reduceat(_permute(spread + _U32(k * 0x01000193 & 0xFFFFFFFF), 0x21F0AAAD, 0xD35A2D97), starts)
        at = end
    return out


def _bands(sig: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band, with the band's number mixed in."""
    keys = np.zeros((len(sig), HASHES // BAND), np.uint64)
    keys += np.arange(HASHES // BAND, dtype=np.uint64) + np.uint64(1)
    for r in range(BAND):
        keys = (keys ^ sig[:, r::BAND].astype(np.uint64)) * _MIX
        keys ^= keys >> np.uint64(31)
    return keys.view(np.int64)


_SKETCH_SCHEMA = "doc_id bigint, n_shingles bigint, set_hash string, bands array<bigint>, sketch binary"


def _sketched(batches):
    make = Shingler()
    for batch in batches:
        sets = [make(t) for t in batch.column("text").to_pylist()]
        size = np.array([len(s) for s in sets], np.int64)
        filled = np.flatnonzero(size)
        sig = signatures([sets[i] for i in filled]) if len(filled) else np.zeros((0, HASHES), np.uint32)
        bands, low = _bands(sig), (sig >> _U32(8)).astype(np.uint8)
        hashes, lists, bits = [None] * len(sets), [None] * len(sets), [None] * len(sets)
        for k, i in enumerate(filled):
            hashes[i] = xxhash.xxh3_128_hexdigest(sets[i].tobytes())
            lists[i], bits[i] = bands[k], low[k].tobytes()
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").cast(pa.int64()), pa.array(size), pa.array(hashes, pa.string()), pa.array(lists, pa.list_(pa.int64())), pa.array(bits, pa.binary())],
            names=["doc_id", "n_shingles", "set_hash", "bands", "sketch"],
        )


def sketch(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, set_hash, bands and sketch of every row; the last three null for empty sets."""
    bound_batches(documents.sparkSession)
    return documents.select("doc_id", "text").mapInArrow(trimmed(_sketched), _SKETCH_SCHEMA)


def _marked(ids: DataFrame) -> DataFrame:
    """A one-hash filter of column id: rows of 64-bit words by number. As large as FILTER_WORDS allows at most."""
    h = F.pmod(F.xxhash64("id"), F.lit(FILTER_WORDS * 64))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("h").bitwiseAND(F.lit(63)).cast("int"))
    words = ids.select(h.alias("h")).groupBy(F.shiftright("h", 6).alias("word")).agg(F.bit_or(bit).alias("bits"))
    row = F.map_from_entries(F.collect_list(F.struct(F.pmod("word", F.lit(FILTER_ROW)).cast("int"), "bits")))
    return words.groupBy(F.expr(f"word div {FILTER_ROW}").alias("row")).agg(row.alias("words"))


def maybe_in(rows: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """rows with __maybe: false only where the column is not in ids (column id). Nothing is shuffled."""
    h = F.pmod(F.xxhash64(column), F.lit(FILTER_WORDS * 64))
    word = F.try_element_at(F.col("__words"), F.pmod(F.shiftright(h, 6), F.lit(FILTER_ROW)).cast("int"))
    hit = F.call_function("shiftright", word, h.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1
    marked = _marked(ids).withColumnsRenamed({"row": "__row", "words": "__words"})
    tried = rows.join(F.broadcast(marked), F.shiftright(h, 6 + FILTER_ROW.bit_length() - 1) == F.col("__row"), "left")
    return tried.withColumn("__maybe", F.coalesce(hit, F.lit(False))).drop("__row", "__words")


def _sets(ids: DataFrame, documents: DataFrame) -> DataFrame:
    """doc_id and its set s (array<bigint>) of the documents in column id."""
    ids = stage(ids.distinct(), "ids")
    # The filter keeps most other texts from being shuffled; the join that follows is exact.
    texts = maybe_in(documents.select("doc_id", "text"), "doc_id", ids).where("__maybe")
    texts = texts.select("doc_id", "text").join(ids, F.col("doc_id") == F.col("id"), "left_semi")

    def shingled(batches):
        make = Shingler()
        for batch in batches:
            rows = [make(t).view(np.int64) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(rows, pa.list_(pa.int64()))], names=["doc_id", "s"])

    return stage(texts.mapInArrow(trimmed(shingled), "doc_id bigint, s array<bigint>"), "sets", codec="lz4")


def _confirm(pairs: DataFrame, documents: DataFrame) -> DataFrame:
    """Of the pairs a, b (documents), those whose full sets reach the threshold."""
    sets = _sets(pairs.selectExpr("a id").union(pairs.selectExpr("b id")), documents)
    # A document in many pairs is copied once for 64 of them, so that no key gathers them all.
    degree = pairs.groupBy("a").agg(F.ceil(F.count("*") / 64).cast("int").alias("parts"))
    dealt = spread(pairs, "a", degree).withColumn("part", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int"))
    left = sets.join(degree, sets.doc_id == degree.a).select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("s").alias("sa"))
    both = dealt.select("a", "b", "part").join(sets.select(F.col("doc_id").alias("b"), F.col("s").alias("sb")), "b").join(left, ["a", "part"])
    inter = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - inter
    out = stage(both.where(100 * inter >= THRESHOLD_PERCENT * union).select("a", "b").distinct(), "confirmed")
    drop_path(pairs.sparkSession, sets.staged_path)
    return out


def _alike(batches):
    """Pairs with both sizes and sketches: those that may reach the threshold, and how alike they look."""
    for batch in batches:
        na, nb = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("na", "nb"))
        ka, kb = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, HASHES) for c in ("ka", "kb"))
        alike = (ka == kb).mean(axis=1)
        ok = pa.array((100 * np.minimum(na, nb) >= THRESHOLD_PERCENT * np.maximum(na, nb)) & (alike >= SKETCH_FLOOR))
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(ok), batch.column("b").filter(ok), pa.array(alike).filter(ok)], names=["a", "b", "alike"])


def _compare(batches):
    """Rows of two blocks x and y of members (id, component, bands, sketch, set): links between different components of
    members of x and members of y that share a bucket, as many as it takes to join what is linked."""
    for batch in batches:
        found_a, found_b = [], []
        for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
            (ia, ca, ba, ka, sa), (ib, cb, bb, kb, sb) = _members(x), _members(y)
            size = np.array([len(v) for v in sb], np.int64)
            joined: dict[int, int] = {}

            def top(c: int, joined: dict[int, int] = joined) -> int:
                while c in joined:
                    c = joined[c]
                return c

            for i in range(len(ia)):
                n = len(sa[i])
                near = np.flatnonzero((cb != ca[i]) & (100 * np.minimum(size, n) >= THRESHOLD_PERCENT * np.maximum(size, n)))
                alike = (kb[near] == ka[i]).mean(axis=1)
                near = near[np.argsort(-alike, kind="stable")[: int((alike >= SKETCH_FLOOR).sum())]]
                near = near[(bb[near] == ba[i]).any(axis=1)]
                for at in range(0, len(near), 64):
                    some = [j for j in near[at : at + 64].tolist() if top(int(cb[j])) != top(int(ca[i]))]
                    if not some:
                        continue
                    flat = np.concatenate([sb[j] for j in some])
                    place = np.minimum(np.searchsorted(sa[i], flat), n - 1)
                    common = np.add.reduceat(sa[i][place] == flat, np.cumsum([0, *(size[j] for j in some[:-1])]), dtype=np.int64)
                    for j, inter in zip(some, common.tolist(), strict=True):
                        p, q = top(int(cb[j])), top(int(ca[i]))
                        if p != q and 100 * inter >= THRESHOLD_PERCENT * (n + int(size[j]) - inter):
                            joined[max(p, q)] = min(p, q)
                            found_a.append(int(ia[i]))
                            found_b.append(int(ib[j]))
        yield pa.RecordBatch.from_arrays([pa.array(found_a, pa.int64()), pa.array(found_b, pa.int64())], names=["a", "b"])


def _members(block: pa.Scalar):
    """Ids, components, bands, sketches and sets of a block."""
    v = block.values
    sets, offsets = v.field("s").flatten().to_numpy(), v.field("s").offsets.to_numpy()
    offsets = offsets - offsets[0]
    look = np.frombuffer(b"".join(v.field("sketch").to_pylist()), np.uint8).reshape(len(v), HASHES)
    bands = v.field("bands").flatten().to_numpy().reshape(len(v), HASHES // BAND)
    return v.field("id").to_numpy(), v.field("component").to_numpy(), bands, look, [np.sort(sets[p:q].view(np.uint64)) for p, q in zip(offsets[:-1], offsets[1:], strict=True)]


def _hinted(table: DataFrame) -> DataFrame:
    """A staged table, to be broadcast if it has BROADCAST_GROUPS rows or fewer."""
    return F.broadcast(table) if table.count() <= BROADCAST_GROUPS else table


def _rest(members: DataFrame, held: DataFrame, labels: DataFrame, documents: DataFrame) -> DataFrame:
    """Links between classes that share a bucket and are in different components."""
    spark = members.sparkSession
    placed = members.join(labels, F.col("id") == F.col("node"), "left").select("bucket", "pivot", "id", F.coalesce("component", "id").alias("component"))
    mixed = placed.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("bucket")
    open_ = stage(placed.join(mixed, "bucket"), "open")
    if open_.isEmpty():
        return spark.createDataFrame([], "a bigint, b bigint")
    groups = components(open_.selectExpr("pivot a", "id b")).selectExpr("node id", "component grp")
    named = stage(open_.select("id", "component").distinct().join(groups, "id"), "named")
    large = _hinted(stage(named.groupBy("grp").agg(F.count("*").alias("n")).where(F.col("n") > GROUP).select("grp"), "large"))
    # the key of a group: its own number, or each bucket's if it is large
    whole = named.join(large, "grp", "left_anti").select(F.struct(F.lit(0).alias("kind"), F.col("grp").alias("of")).alias("key"), "id", "component")
    parts = open_.join(named.join(large, "grp").select("id"), "id").select(F.struct(F.lit(1).alias("kind"), F.col("bucket").alias("of")).alias("key"), "id", "component")
    keyed = stage(whole.union(parts).join(held.select("id", "size"), "id"), "keyed")
    sizes = keyed.groupBy("key", "component").agg(F.count("*").alias("n"), F.sum("size").alias("m"))
    # the largest component is the main one; blocks are as many as rows or shingles make necessary
    sizes = sizes.groupBy("key").agg(F.max_by(F.struct("component", "n", "m"), F.struct("n", "component")).alias("main"), F.sum("n").alias("n"), F.sum("m").alias("m"))
    count = lambda n, m: F.ceil(F.greatest(n / F.lit(float(BLOCK)), m / F.lit(float(BLOCK_SHINGLES)))).cast("int")
    sizes = sizes.where("n > main.n").select("key", "main.component", count(F.col("n"), F.col("m")).alias("blocks"), count(F.col("n") - F.col("main.n"), F.col("m") - F.col("main.m")).alias("outer"))
    sizes = stage(sizes.withColumnRenamed("component", "main"), "sizes")
    sets = _sets(keyed.select("id"), documents)
    full = keyed.join(_hinted(sizes), "key").join(held.select("id", "bands", "sketch"), "id").join(sets, F.col("id") == F.col("doc_id"))
    full = stage(full.select("key", "main", "blocks", "outer", F.struct("id", "component", "bands", "sketch", "s").alias("m")), "full", codec="lz4")
    place = F.xxhash64("m.id")
    every = full.groupBy("key", F.pmod(place, "blocks").alias("j")).agg(F.first("outer").alias("outer"), F.collect_list("m").alias("y"))
    outside = full.where("m.component <> main").groupBy("key", F.pmod(place, "outer").cast("int").alias("i")).agg(F.collect_list("m").alias("x"))
    pairs = every.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("outer") - 1))).join(outside, ["key", "i"]).select("x", "y")
    return stage(pairs.mapInArrow(trimmed(_compare), "a bigint, b bigint"), "rest")


def near_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of documents."""
    known = stage(sketch(documents.where("doc_id is not null")), "sketch")
    classes = stage(known.where("set_hash is not null").groupBy("set_hash").agg(F.min("doc_id").alias("id")), "classes")
    # A class is looked up by its smallest document; if that id has several rows, by any of them. Joined by both, so that
    # copies of one text are dealt to many tasks.
    same = (F.col("doc_id") == F.col("id")) & (known["set_hash"] == F.col("class"))
    held = known.join(classes.withColumnRenamed("set_hash", "class"), same).dropDuplicates(["doc_id", "set_hash"])
    held = stage(held.select("id", F.col("n_shingles").alias("size"), "bands", "sketch"), "held")
    looks = held.select("id", "size", "sketch")
    rows = held.select("id", F.explode("bands").alias("bucket"))
    full = rows.groupBy("bucket").agg(F.min("id").alias("pivot"), F.max("id").alias("top")).where("pivot < top")
    members = stage(rows.join(full.select("bucket", "pivot"), "bucket").select("bucket", "pivot", "id").distinct(), "members")
    star = members.where("id <> pivot").selectExpr("pivot a", "id b").distinct()
    star = star.join(looks.selectExpr("id b", "size nb", "sketch kb"), "b")
    star = spread(star, "a", looks.selectExpr("id a", "size na", "sketch ka"), rows_of=members.selectExpr("pivot a"))
    star = star.select("a", "b", "na", "nb", "ka", "kb").mapInArrow(_alike, "a bigint, b bigint, alike double")
    tried = stage(star.groupBy("b").agg(F.max_by("a", F.struct("alike", -F.col("a"))).alias("a")).select("a", "b"), "star")
    # pivots are smaller than what points to them, so the links are a forest
    labels = follow(stage(_confirm(tried, documents).selectExpr("b node", "a component"), "parents"))
    more = _rest(members, held, labels, documents)
    # Rows that share a doc_id are one document.
    each = known.where("set_hash is not null").select("doc_id", "set_hash")
    twice = each.groupBy("doc_id").agg(F.min("set_hash").alias("low"), F.max("set_hash").alias("high")).where("low < high").select("doc_id")
    several = each.join(twice, "doc_id").join(classes, "set_hash").select("doc_id", "id").distinct()
    several = several.join(several.groupBy("doc_id").agg(F.min("id").alias("a")), "doc_id").selectExpr("a", "id b")
    found = more.union(several)
    root = lambda c: labels.selectExpr(f"node {c}", f"component root_{c}")
    drawn = found.join(root("a"), "a", "left").join(root("b"), "b", "left").selectExpr("coalesce(root_a, a) a", "coalesce(root_b, b) b")
    joined = components(drawn)
    top = classes.join(labels, F.col("id") == F.col("node"), "left").select("set_hash", F.coalesce("component", "id").alias("root"))
    top = top.join(joined, F.col("root") == F.col("node"), "left").select("set_hash", F.coalesce("component", "root").alias("component_id"))
    top = stage(top, "tops")
    out = spread(known.select("doc_id", "n_shingles", "set_hash"), "set_hash", top, "left")
    out = out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    nulls = sketch(documents.where("doc_id is null")).select("doc_id", "n_shingles", F.lit(None).cast("bigint").alias("component_id"))
    return out.union(nulls).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10: near-duplicate components of all documents."""
    return near_duplicates(read_documents(spark, sf_dir))
