"""Document fingerprints: invertible Bloom lookup sketches of hashed paragraphs.

A text's pieces are its paragraphs (lines), cut at sentence ends, and sentences at every WORDS words, so that an edit
changes the pieces around it only. The set of piece digests goes into cells: each digest adds to a count, a sum of
digests and a sum of check hashes in one cell of each of three tables. The cells of two versions subtract; peeling
cells that hold one digest recovers the digests in which they differ, and if it gets stuck both versions are
sketched again with twice the cells and other hashes. The likeness is the share of common digests in all.

Defined results: a null text is empty; an empty text has no pieces, and two such texts are alike (1.0); repeated
pieces count once. In the order of documents a null doc_id comes after all others, and rows with equal or no doc_id are
ordered by a hash of their texts and then the texts, so that an id of many rows is dealt to many tasks; the last
document's next one is the first, which may be itself. Texts of any length are taken whole; an empty table gives an
empty result; only doc_id and text are read, so other columns, whatever their names, do no harm.
"""

from __future__ import annotations

import base64
import hashlib
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspan.llm.common import bound_batches, read_documents

WORDS = 6
#: Cells of a fingerprint, and of the first attempt to compare two; a multiple of three.
CELLS = 24
_SENTENCE = re.compile(r"[^\n.!?]+[.!?]*|[.!?]+")
_NO_ID = np.iinfo(np.int64).min
_MULT = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]


def pieces(text: str) -> np.ndarray:
    """Sorted distinct 64-bit digests of a text's pieces."""
    found, digest = [], xxhash.xxh3_64_intdigest
    for sentence in _SENTENCE.findall(text):
        words = sentence.split()
        if len(words) <= WORDS:
            if words:
                found.append(digest(" ".join(words)))
        else:
            found += [digest(" ".join(words[i : i + WORDS])) for i in range(0, len(words), WORDS)]
    return np.unique(np.array(found, dtype=np.uint64))


def _hash(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    x = (x + np.uint64(seed * 0x51ED270B & 0xFFFFFFFFFFFFFFFF)) * _MULT[k]
    x ^= x >> np.uint64(32)
    x *= _MULT[3 - k]
    return x ^ (x >> np.uint64(29))


class Sketches:
    """Sketches of several sets side by side, m cells each."""

    def __init__(self, n: int, m: int, seed: int) -> None:
        self.m, self.seed = m, seed
        self.count = np.zeros(n * m, np.int64)
        self.keys = np.zeros(n * m, np.uint64)
        self.checks = np.zeros(n * m, np.uint64)

    def add(self, owner: np.ndarray, digests: np.ndarray, sign: np.ndarray | int) -> None:
        """Add (sign 1) or take away (-1) digests to the sketches of their owners."""
        third = self.m // 3
        signs = np.broadcast_to(np.asarray(sign, np.int64), digests.shape)
        check = _hash(digests, 3, self.seed)
        keys, checks = digests * signs.astype(np.uint64), check * signs.astype(np.uint64)
        for j in range(3):
            cell = owner * self.m + j * third + ((_hash(digests, j, self.seed) >> np.uint64(32)) * np.uint64(third) >> np.uint64(32)).astype(np.int64)
            np.add.at(self.count, cell, signs)
            np.add.at(self.keys, cell, keys)
            np.add.at(self.checks, cell, checks)

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Take out digests until no cell holds a single one: owners, digests and signs of what came out."""
        out = []
        while True:
            single = np.flatnonzero(np.abs(self.count) == 1)
            sign = self.count[single]
            key = self.keys[single] * sign.astype(np.uint64)
            true = self.checks[single] * sign.astype(np.uint64) == _hash(key, 3, self.seed)
            single, sign, key = single[true], sign[true], key[true]
            if not len(single):
                break
            owner = single // self.m
            order = np.lexsort((key, owner))
            owner, key, sign = owner[order], key[order], sign[order]
            fresh = np.append(True, (owner[1:] != owner[:-1]) | (key[1:] != key[:-1]))
            owner, key, sign = owner[fresh], key[fresh], sign[fresh]
            self.add(owner, key, -sign)
            out.append((owner, key, sign))
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def empty(self) -> np.ndarray:
        """Which sketches hold nothing."""
        left = (self.count != 0) | (self.keys != 0) | (self.checks != 0)
        return ~left.reshape(-1, self.m).any(axis=1)


def _flat(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    sizes = [len(s) for s in sets]
    return np.repeat(np.arange(len(sets)), sizes), np.concatenate([np.zeros(0, np.uint64), *sets])


def differences(left: list[np.ndarray], right: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each pair of sets: the digests only on the left, and only on the right, recovered from sketches."""
    found: list = [None] * len(left)
    todo, m, seed = list(range(len(left))), CELLS, 0
    while todo:
        s = Sketches(len(todo), m, seed)
        s.add(*_flat([left[i] for i in todo]), 1)
        s.add(*_flat([right[i] for i in todo]), -1)
        owner, key, sign = s.peel()
        done = s.empty()
        for side in (0, 1):
            mine = np.flatnonzero(sign == (1, -1)[side])
            mine = mine[np.argsort(owner[mine], kind="stable")]
            bounds = np.searchsorted(owner[mine], np.arange(len(todo) + 1))
            for k in np.flatnonzero(done):
                got = key[mine[bounds[k] : bounds[k + 1]]]
                found[todo[k]] = (got,) if side == 0 else (*found[todo[k]], got)
        todo = [i for k, i in enumerate(todo) if not done[k]]
        m, seed = m * 2, seed + 1
    return found


def likeness(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Common digests over all digests of each pair."""
    out = np.ones(len(left))
    for i, (a, b) in enumerate(differences(left, right)):
        common = len(left[i]) - len(a)
        every = common + len(a) + len(b)
        if every:
            out[i] = common / every
    return out


def fingerprints(sets: list[np.ndarray]) -> list[str]:
    """Number of pieces, and the cells (count, sum of digests, sum of checks) in base64."""
    s = Sketches(len(sets), CELLS, 0)
    s.add(*_flat(sets), 1)
    cells = np.empty((len(sets), CELLS), dtype=[("n", "<u2"), ("k", "<u8"), ("c", "<u4")])
    cells["n"], cells["k"] = s.count.reshape(-1, CELLS).astype(np.uint16), s.keys.reshape(-1, CELLS)
    cells["c"] = s.checks.reshape(-1, CELLS).astype(np.uint32)
    return [f"{len(x)}:" + base64.b64encode(c.tobytes()).decode() for x, c in zip(sets, cells, strict=True)]


def edit(text: str, following: str) -> str:
    """The last third of a text replaced by the beginning of the next."""
    k = len(text) // 3
    return text[: len(text) - k] + following[:k]


_DEALT = "part int, ghost boolean, doc_id bigint, h bigint, text string"
_OUT = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _keys(column: pa.Array) -> np.ndarray:
    return column.cast(pa.int64()).fill_null(_NO_ID).to_numpy(zero_copy_only=False)


class Bounds:
    """Where parts end, by id and hash. An id that quantiles name several times is cut by hash."""

    def __init__(self, quantiles: list[int]) -> None:
        ids, times = np.unique(np.array(quantiles, np.int64), return_counts=True)
        most = np.iinfo(np.int64).max
        # an id's last part goes up to its largest hash
        cuts = [(i, most // n * k if k < n else most) for i, n in zip(ids.tolist(), times.tolist(), strict=True) for k in range(1, n + 1)]
        self.ids, self.hashes = (np.array(x, np.int64) for x in (zip(*cuts, strict=True) if cuts else ((), ())))

    def parts(self, ids: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """How many bounds lie before each row."""
        low, high = np.searchsorted(self.ids, ids), np.searchsorted(self.ids, ids, "right")
        out = low.astype(np.int32)
        for k in np.unique(low[high > low]):
            mine = (low == k) & (high > low)
            out[mine] += np.searchsorted(self.hashes[k : high[mine][0]], hashes[mine]).astype(np.int32)
        return out

    def __len__(self) -> int:
        return len(self.ids)


def _dealt(bounds: Bounds, ghosts: dict[int, tuple[int, int, int]]):
    """Rows with their part; the first row of a part goes to the part before it too, as a ghost."""

    def run(batches):
        for batch in batches:
            key, h = _keys(batch.column("doc_id")), batch.column("h").to_numpy()
            part = bounds.parts(key, h)
            rows = pa.RecordBatch.from_arrays([pa.array(part), pa.array(np.zeros(len(part), bool)), batch.column("doc_id").cast(pa.int64()), batch.column("h"), batch.column("text")], names=["part", "ghost", "doc_id", "h", "text"])
            yield rows
            for p, (head, top, to) in ghosts.items():
                # rows of one id and hash have one text, so one of them will do
                mine = np.flatnonzero((part == p) & (key == head) & (h == top))[:1]
                if len(mine):
                    r = rows.take(pa.array(mine))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(1, to, np.int32)), pa.array(np.ones(1, bool)), r.column("doc_id"), r.column("h"), r.column("text")], names=rows.schema.names)

    return run


def _compared(batches):
    """Rows of a part in order, ghosts last."""
    held_id, held = None, None

    def result(ids, texts):
        """Rows of all but the last text, which is only the next of the one before."""
        sets = [pieces(t) for t in texts]
        edited = [edit(a, b) for a, b in zip(texts, texts[1:], strict=False)]
        changed = [pieces(t) for t in edited]
        n = len(edited)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids[:n], pa.int64()), pa.array([len(t) for t in texts[:n]], pa.int64()), pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
                pa.array(fingerprints(sets[:n])), pa.array(fingerprints(changed)), pa.array(likeness(sets[:n], changed)), pa.array(likeness(sets[:n], sets[1:])),
            ],
            names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )

    for batch in batches:
        if held is None and held_id == "end":
            continue
        ids, texts, ghost = batch.column("doc_id").to_pylist(), [t or "" for t in batch.column("text").to_pylist()], batch.column("ghost").to_pylist()
        stop = ghost.index(True) + 1 if True in ghost else len(ids)
        ids, texts = ids[:stop], texts[:stop]
        if held is not None:
            ids, texts = [held_id, *ids], [held, *texts]
        for at in range(0, len(ids) - 1, 256):
            yield result(ids[at : at + 257], texts[at : at + 257])
        held_id, held = (ids[-1], texts[-1]) if True not in ghost else ("end", None)


def compare_with_next(documents: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text, and the likeness to that and to the next document."""
    spark = documents.sparkSession
    bound_batches(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # 63 bits of a hash of the text
    h = F.shiftrightunsigned(F.xxhash64(F.coalesce("text", F.lit(""))), 1)
    given = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", h.alias("h"))
    cuts = given.agg(F.percentile_approx(F.coalesce("doc_id", F.lit(_NO_ID)), [i / parts for i in range(1, parts)], 100 * parts).alias("c")).first()["c"] if parts > 1 else []
    bounds = Bounds(cuts or [])

    def placed(batches):
        for batch in batches:
            key, top = _keys(batch.column("doc_id")), batch.column("h").to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(bounds.parts(key, top)), pa.array(key), pa.array(top)], names=["part", "key", "h"])

    heads = given.select("doc_id", "h").mapInArrow(placed, "part int, key bigint, h bigint").groupBy("part").agg(F.max(F.struct("key", "h")).alias("head")).collect()
    order = sorted(((r["part"], r["head"]["key"], r["head"]["h"]) for r in heads), reverse=True)
    ghosts = {part: (head, top, order[k - 1][0]) for k, (part, head, top) in enumerate(order)}
    dealt = given.mapInArrow(_dealt(bounds, ghosts), _DEALT).repartitionById(len(bounds) + 1, F.col("part"))
    return dealt.sortWithinPartitions("ghost", F.desc_nulls_last("doc_id"), F.desc("h"), F.coalesce("text", F.lit(""))).mapInArrow(_compared, _OUT)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: every document against its edited text and the next document."""
    return compare_with_next(read_documents(spark, sf_dir))
