"""Suffix-array dedup of repeated passages by a logarithmic family of indexes.

Every byte covered by a SPAN-byte string that also starts in a document with a smaller doc_id is removed.

Documents are laid end to end in batches of about BATCH bytes, and FILE_BATCHES of them make a group. A group's suffix
array is sparse: it holds the suffixes at anchors (see anchors.py), of which each window of SPAN bytes owns exactly one.
Suffixes are dealt to shards by a hash of their first GRAM bytes, so that those with a common beginning meet. A shard
takes its part of each group in turn, puts it in the order of its bytes and scans it against the levels there are: a
suffix whose stretch of windows a smaller document has as a whole is settled, and so is what an earlier group has of a
document that is larger. What is new then enters as the smallest level, and levels of equal size are merged, so a suffix
is merged a logarithmic number of times. In the end the levels become one array, and neighbours in it that begin alike
but differ around are opened: all suffixes at their windows' starts, SPAN bytes deep, go through a second family.

The arrays hold bytes, not hashes of them. Only what lies around a suffix's first GRAM bytes in its stretch is compared
as a 64-bit hash, and so are equal windows within one batch.

Defined results: a null text is empty; a null doc_id counts as larger than all others (rows with equal ids, null
or not, never remove each other's bytes); within one document repeats stay, and of repeated rows each is treated alike;
texts shorter than SPAN stay whole; texts of any length are worked on whole; an empty table gives an empty result.
Columns to carry along are named by the caller; others are not read. A carried column named like an output gives way to
it, and a prefix for the outputs avoids that.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspan.llm.anchors import GRAM, SPAN, stretches, window_hashes
from loomspan.llm.common import beside, bound_batches, read_documents, release, stage, text_bytes, trimmed

#: Bytes of text in a batch; a longer document is a batch of its own.
BATCH = 1 << 20
#: A batch is stored as so many rows, so that rows stay small, and so many batches make a group: one file, which no two
#: tasks share. A group meets a shard in one row, so where shards are very many, groups should be larger.
ROWS, FILE_BATCHES = 2, 4
#: Suffixes of a shard, about, as far as a task has no more than MOST_SHARDS of them, one after the other.
SHARD_ENTRIES, MOST_SHARDS = 250_000, 8
_NO_ID = np.iinfo(np.int64).max
_SENT = "part int, shard int, grp bigint, n bigint, bytes binary, whole binary, doc binary"
_TOLD = "grp bigint, step int, shard int, flags binary"
_SETTLED, _OPEN = 1, 2


def _pack(values: np.ndarray) -> bytes:
    """64-bit values by byte planes, compressed."""
    grid = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), 8)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(grid.T).tobytes())


def _unpack(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data, max_output_size=max(n * 8, 1)), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, n).T).reshape(-1).view(np.uint64)


def _beginnings(data: np.ndarray, places: np.ndarray, width: int) -> np.ndarray:
    """The bytes from each place, as rows."""
    return np.lib.stride_tricks.sliding_window_view(data, width)[places] if len(places) else np.zeros((0, width), np.uint8)


class Batch:
    """The documents of one batch row."""

    def __init__(self, rows: list[dict]) -> None:
        rows = sorted(rows, key=lambda r: r["row"])
        lengths = [np.frombuffer(r["lengths"], np.int64) for r in rows]
        self.ids = np.concatenate([np.frombuffer(r["ids"], np.int64) for r in rows])
        self.offsets = np.append(0, np.cumsum(np.concatenate(lengths)))
        texts = [zstandard.ZstdDecompressor().decompress(r["text"], max_output_size=max(int(n.sum()), 1)) for r, n in zip(rows, lengths, strict=True)]
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        self.rest = [r["rest"] for r in rows]

    def carried(self) -> pa.Table:
        """The columns that came along."""
        tables = []
        for rest in self.rest:
            with pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(rest)) as stream:
                tables.append(stream.read_all())
        return pa.concat_tables(tables)

    def suffixes(self):
        """Stretches with equal ones together, which of them are the first (the smallest document's), and where the
        stretch starts and ends and its anchor."""
        s = stretches(self.data, self.offsets)
        doc = self.ids[s.doc]
        order = _ordered(s.gram, s.whole, doc)
        gram, whole = s.gram[order], s.whole[order]
        fresh = np.append(True, (gram[1:] != gram[:-1]) | (whole[1:] != whole[:-1]))[: len(gram)]
        return gram, whole, doc[order], s.first[order], s.last[order], s.anchor[order], fresh

    def windows(self, entries: np.ndarray, first: np.ndarray, last: np.ndarray, doc: np.ndarray, shard: np.ndarray):
        """Of the windows of some stretches: starts, documents' ids and shards, order by hash, which are the first of a
        hash in that order (the smallest document's), the order of these by shard and start, and these in it."""
        # stretches do not share windows, so in their order the windows are in order too
        entries = entries[np.argsort(first[entries])]
        size = last[entries] - first[entries] + 1
        starts = np.repeat((first[entries] - np.cumsum(size) + size).astype(np.int32), size)
        starts += np.arange(len(starts), dtype=np.int32)
        owner, to = np.repeat(doc[entries], size), np.repeat(shard[entries], size)
        hashes = window_hashes(self.data, starts)
        order = _ordered(hashes, owner)
        hashes = hashes[order]
        fresh = np.append(True, hashes[1:] != hashes[:-1])[: len(hashes)]
        heads = order[fresh]
        rank = np.lexsort((heads, to[heads]))
        return starts, owner, to, order, fresh, rank, heads[rank]


def _runs(values: np.ndarray):
    """Start and end of each run of equal values."""
    edges = np.flatnonzero(values[1:] != values[:-1]) + 1
    return zip([0, *edges.tolist()], [*edges.tolist(), len(values)], strict=True) if len(values) else ()


class Outbox:
    """Suffixes of a group's batches by shard, in the order in which they are put in."""

    def __init__(self, shards: int, per_task: int) -> None:
        self.shards, self.per_task = shards, per_task
        self.held: dict[int, list[tuple]] = {}

    def put(self, shard: np.ndarray, beginnings: np.ndarray, whole: np.ndarray, doc: np.ndarray) -> None:
        """shard is sorted."""
        for a, b in _runs(shard):
            self.held.setdefault(int(shard[a]), []).append((beginnings[a:b], whole[a:b], doc[a:b]))

    def rows(self, grp: int) -> pa.Table:
        out = []
        for shard in sorted(self.held):
            beginnings, whole, doc = (np.concatenate(x) for x in zip(*self.held.pop(shard), strict=True))
            packed = zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(beginnings).tobytes())
            out.append({"part": shard // self.per_task, "shard": shard, "grp": grp, "n": len(doc), "bytes": packed, "whole": _pack(whole), "doc": _pack(doc)})
        return pa.Table.from_pylist(out, schema=_SENT_ARROW)


def _shard_of(gram: np.ndarray, shards: int) -> np.ndarray:
    """In the order of gram."""
    return ((gram >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int32)


def _ordered(first: np.ndarray, *ties: np.ndarray, kind: str | None = None) -> np.ndarray:
    """Order by first, then by ties (the first of them leads). Only what is equal is sorted by more than one key; kind
    "stable" is quick where first is made of sorted runs."""
    order = np.argsort(first, kind=kind)
    f = first[order]
    same = f[1:] == f[:-1]
    tied = np.flatnonzero(np.append(same, False) | np.append(False, same)) if len(f) else np.zeros(0, np.int64)
    if len(tied):
        part, run = order[tied], np.append(0, np.cumsum(~same))[tied]
        order[tied] = part[np.lexsort((*(t[part] for t in reversed(ties)), run))]
    return order


class Family:
    """Levels of suffixes, each in the order of their bytes (and then of whole), no suffix in two of them; sizes fall at
    least by half from level to level. Of a suffix a level holds the smallest document so far and the number of the
    entry that brought it."""

    def __init__(self) -> None:
        self.levels: list[tuple[np.ndarray, ...]] = []
        #: Of every entry: its flag, and the one before it with the same suffix and document id.
        self.count, self.flags, self.before = 0, np.zeros(1024, np.uint8), np.zeros(1024, np.int64)

    def add(self, key: np.ndarray, whole: np.ndarray, doc: np.ndarray) -> None:
        """Put a new array in order and scan it against the levels; then let what they lack enter."""
        who = np.arange(self.count, self.count + len(key))
        self.count += len(key)
        while self.count > len(self.flags):
            self.flags, self.before = (np.concatenate([x, np.zeros_like(x)]) for x in (self.flags, self.before))
        self.before[who] = -1
        order = _ordered(key, whole, doc)
        key, whole, doc, who = key[order], whole[order], doc[order], who[order]
        new = np.append(True, (key[1:] != key[:-1]) | (whole[1:] != whole[:-1]))[: len(key)]
        head = np.flatnonzero(new)
        own = doc == doc[head][np.cumsum(new) - 1]
        self._tell(who[~own], _SETTLED)
        # entries of one id are chained, and the last of them stands for all
        chained = np.flatnonzero(own & ~new)
        self.before[who[chained]] = who[chained - 1]
        tail = head + (np.add.reduceat(own & ~new, head, dtype=np.int64) if len(head) else 0)
        key, whole, doc, low, who = key[head], whole[head], doc[head], who[head], who[tail]
        absent = np.ones(len(key), bool)
        for level in self.levels:
            hit, at = self._find(level, key, whole)
            absent[hit] = False
            theirs, mine = level[2][at], doc[hit]
            self._tell(who[hit[mine > theirs]], _SETTLED)
            self._tell(level[3][at[mine < theirs]], _SETTLED)
            same = mine == theirs
            self.before[low[hit[same]]] = level[3][at[same]]
            wins = mine <= theirs
            level[2][at[wins]], level[3][at[wins]] = mine[wins], who[hit[wins]]
        if absent.any():
            self.levels.append((key[absent], whole[absent], doc[absent], who[absent]))
        while len(self.levels) > 1 and len(self.levels[-2][0]) < 2 * len(self.levels[-1][0]):
            self._merge()

    def close(self) -> np.ndarray:
        """Flags of all entries in the order they came. _SETTLED: a smaller document has the suffix. _OPEN: it is the
        suffix's first document, and a neighbour from another document begins alike."""
        while len(self.levels) > 1:
            self._merge()
        for key, _, doc, who in self.levels:
            start = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            low, high = (np.repeat(f.reduceat(doc, start), np.diff(start, append=len(key))) for f in (np.minimum, np.maximum))
            self._tell(who[low != high], _OPEN)
        self.levels = []
        return self.flags[: self.count]

    def _tell(self, who: np.ndarray, flag: int) -> None:
        while len(who):
            self.flags[who] = flag
            who = self.before[who]
            who = who[who >= 0]

    @staticmethod
    def _find(level: tuple[np.ndarray, ...], key: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which are in the level, and where."""
        keys, wholes = level[:2]
        at = np.searchsorted(keys, key)
        hit = np.flatnonzero(keys[np.minimum(at, len(keys) - 1)] == key)
        low = at[hit]
        # most beginnings stand alone; in the others the hash is searched for
        more = np.flatnonzero(wholes[low] < whole[hit])
        high = np.searchsorted(keys, key[hit[more]], "right")
        a, b, want = low[more], high, whole[hit[more]]
        while len(a) and (a < b).any():
            middle = (a + b) // 2
            less = (a < b) & (wholes[np.minimum(middle, len(keys) - 1)] < want)
            a, b = np.where(less, middle + 1, a), np.where(less, b, np.minimum(b, middle))
        low[more] = a
        found = low < len(keys)
        low = np.minimum(low, len(keys) - 1)
        found &= (wholes[low] == whole[hit]) & (keys[low] == key[hit])
        return hit[found], low[found]

    def _merge(self) -> None:
        """Make the last two levels one."""
        small = self.levels.pop()
        key, whole, doc, who = (np.concatenate(x) for x in zip(self.levels.pop(), small, strict=True))
        order = _ordered(key, whole, kind="stable")
        self.levels.append((key[order], whole[order], doc[order], who[order]))


def _batched(keep: list[str]):
    def run(batches):
        task = TaskContext.get().partitionId()
        seq, held, size = 0, [], 0

        def rows():
            nonlocal seq, held, size
            table = pa.Table.from_batches(held)
            ends = np.cumsum(np.diff(text_bytes(table.column("text").combine_chunks())[1]))
            cuts = [0, *(int(np.searchsorted(ends, ends[-1] * k / ROWS, "right")) for k in range(1, ROWS)), len(table)]
            for k in range(ROWS):
                part = table.slice(cuts[k], cuts[k + 1] - cuts[k]).combine_chunks()
                text, offsets = text_bytes(part.column("text").combine_chunks() if len(part) else pa.array([], pa.string()))
                ids = part.column("doc_id").cast(pa.int64()).fill_null(_NO_ID).to_numpy()
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, part.select(keep).schema) as writer:
                    writer.write_table(part.select(keep))
                shrink = zstandard.ZstdCompressor(level=3).compress
                yield pa.RecordBatch.from_pylist([{"grp": task << 24 | seq // FILE_BATCHES, "batch": seq, "row": k, "ids": ids.tobytes(), "lengths": np.diff(offsets).tobytes(), "text": shrink(text.tobytes()), "rest": shrink(sink.getvalue().to_pybytes())}], schema=_BATCH_ARROW)
            seq, held, size = seq + 1, [], 0

        for batch in batches:
            lengths = np.diff(text_bytes(batch.column("text"))[1])
            at = 0
            while at < batch.num_rows:
                ends = np.cumsum(lengths[at:])
                n = max(int(np.searchsorted(ends, BATCH - size, "right")), 0 if held else 1)
                if n:
                    held.append(batch.slice(at, n))
                    size += int(ends[n - 1]) if n <= len(ends) else int(ends[-1])
                    at += n
                if at < batch.num_rows:
                    yield from rows()
        if held:
            yield from rows()

    return run


_BATCH_ARROW = pa.schema([("grp", pa.int64()), ("batch", pa.int64()), ("row", pa.int32()), ("ids", pa.binary()), ("lengths", pa.binary()), ("text", pa.binary()), ("rest", pa.binary())])
_BATCH = "grp bigint, batch bigint, row int, ids binary, lengths binary, text binary, rest binary"
_SENT_ARROW = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("grp", pa.int64()), ("n", pa.int64()), ("bytes", pa.binary()), ("whole", pa.binary()), ("doc", pa.binary())])


def _batches(rows: list[dict]):
    """The batches of a group, in order."""
    rows = sorted(rows, key=lambda r: (r["batch"], r["row"]))
    if len(rows) % ROWS:
        raise ValueError("a batch was split between tasks")
    for at in range(0, len(rows), ROWS):
        yield Batch(rows[at : at + ROWS])


def _suffix_rows(shards: int, per_task: int):
    """The sparse suffix arrays of groups, by shard."""

    def sent(rows: list[dict]) -> pa.Table:
        out = Outbox(shards, per_task)
        for batch in _batches(rows):
            gram, whole, doc, _, _, anchor, fresh = batch.suffixes()
            out.put(_shard_of(gram[fresh], shards), _beginnings(batch.data, anchor[fresh], GRAM), whole[fresh], doc[fresh])
        return out.rows(rows[0]["grp"])

    def run(batches):
        held: list[dict] = []
        for chunk in batches:
            for r in chunk.to_pylist():
                if held and held[0]["grp"] != r["grp"]:
                    yield from sent(held).to_batches()
                    held = []
                    release()
                held.append(r)
        if held:
            yield from sent(held).to_batches()

    return run


def _matched(step: int, width: int):
    """Rows by shard and group: a family for each shard, and what it says of each group's suffixes."""

    def told(shard: int, groups: list[tuple[int, int]], family: Family) -> pa.RecordBatch:
        flags, at, rows = family.close(), 0, []
        for grp, n in groups:
            rows.append({"grp": grp, "step": step, "shard": shard, "flags": zstandard.ZstdCompressor(level=3).compress(flags[at : at + n].tobytes())})
            at += n
        return pa.RecordBatch.from_pylist(rows, schema=_TOLD_ARROW)

    def run(batches):
        shard, groups, family = None, [], Family()
        for chunk in batches:
            for r in chunk.to_pylist():
                if r["shard"] != shard:
                    if groups:
                        yield told(shard, groups, family)
                        release()
                    shard, groups, family = r["shard"], [], Family()
                n = r["n"]
                raw = zstandard.ZstdDecompressor().decompress(r["bytes"], max_output_size=n * width)
                family.add(np.frombuffer(raw, f"S{width}"), _unpack(r["whole"], n), _unpack(r["doc"], n).view(np.int64))
                groups.append((r["grp"], n))
        if groups:
            yield told(shard, groups, family)

    return run


_TOLD_ARROW = pa.schema([("grp", pa.int64()), ("step", pa.int32()), ("shard", pa.int32()), ("flags", pa.binary())])


class Inbox:
    """What shards said of a group's suffixes, taken in the order in which they were put in the outbox."""

    def __init__(self, told: list[dict], step: int) -> None:
        self.flags = {t["shard"]: np.frombuffer(zstandard.ZstdDecompressor().decompress(t["flags"]), np.uint8) for t in told if t["step"] == step}
        self.at = dict.fromkeys(self.flags, 0)

    def take(self, shard: np.ndarray) -> np.ndarray:
        out = np.zeros(len(shard), np.uint8)
        for a, b in _runs(shard):
            at = self.at[int(shard[a])]
            out[a:b] = self.flags[int(shard[a])][at : at + b - a]
            self.at[int(shard[a])] = at + b - a
        return out


def _opened(batch: Batch, said: Inbox, shards: int):
    """Starts and ends of the stretches that are settled, and the windows of those that are open, in the first document
    that has them."""
    gram, _, doc, first, last, _, fresh = batch.suffixes()
    shard = _shard_of(gram, shards)
    flags, mine = said.take(shard[fresh]), np.cumsum(fresh) - 1
    settled = (flags[mine] == _SETTLED) | (doc > doc[fresh][mine]) if len(doc) else np.zeros(0, bool)
    open_ = np.flatnonzero((flags[mine] == _OPEN) & ~settled) if len(doc) else np.zeros(0, np.int64)
    return first[settled], last[settled], batch.windows(open_, first, last, doc, shard)


def _window_rows(shards: int, per_task: int):
    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        said, out, rows = Inbox(right.to_pylist(), 1), Outbox(shards, per_task), left.to_pylist()
        for batch in _batches(rows):
            _, _, (starts, owner, to, _, _, _, heads) = _opened(batch, said, shards)
            out.put(to[heads], _beginnings(batch.data, starts[heads], SPAN), np.zeros(len(heads), np.uint64), owner[heads])
        table = out.rows(rows[0]["grp"]) if rows else pa.Table.from_pylist([], schema=_SENT_ARROW)
        release()
        return table

    return run


def _cut(schema: pa.Schema, as_text: bool, shards: int):
    def cut(batch: Batch, one: Inbox, two: Inbox) -> pa.Table:
        first, last, (starts, owner, to, order, fresh, rank, heads) = _opened(batch, one, shards)
        n = len(batch.data)
        marks = np.zeros(n + 1, np.int32)
        np.add.at(marks, first, 1)
        np.add.at(marks, last + SPAN, -1)
        if len(heads):
            said = np.empty(len(heads), np.uint8)
            said[rank] = two.take(to[heads])
            of = np.cumsum(fresh) - 1
            gone = (said[of] == _SETTLED) | (owner[order] > owner[order][fresh][of])
            np.add.at(marks, starts[order][gone], 1)
            np.add.at(marks, starts[order][gone] + SPAN, -1)
        removed = np.cumsum(marks[:-1]) > 0
        edge = removed.copy()
        edge[1:] &= ~removed[:-1]
        docs = batch.offsets[:-1][np.diff(batch.offsets) > 0]
        edge[docs] = removed[docs]
        ends = np.zeros(n, bool)
        ends[:-1] = removed[:-1] & (~removed[1:] | edge[1:])
        ends[-1:] = removed[-1:]
        a, b = np.flatnonzero(edge), np.flatnonzero(ends) + 1
        total = np.append(0, np.cumsum(removed))[batch.offsets]
        runs = np.searchsorted(a, batch.offsets)
        spans = pa.ListArray.from_arrays(pa.array(runs, pa.int32()), pa.StructArray.from_arrays([pa.array(a - np.repeat(batch.offsets[:-1], np.diff(runs))), pa.array(b - np.repeat(batch.offsets[:-1], np.diff(runs)))], names=["start", "end"]))
        kept = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(batch.ids), [None, pa.py_buffer((batch.offsets - total).astype(np.int64)), pa.py_buffer(batch.data[~removed])]).cast(pa.binary())
        if as_text:
            kept = pa.array([k.decode("utf-8", "ignore") for k in kept.to_pylist()], pa.string())
        columns = [*batch.carried().columns, pa.array(np.diff(batch.offsets)), pa.array(np.diff(total)), pa.array(np.diff(runs).astype(np.int64)), spans, kept]
        return pa.table([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        told = right.to_pylist()
        one, two = Inbox(told, 1), Inbox(told, 2)
        tables = [cut(batch, one, two) for batch in _batches(left.to_pylist())]
        release()
        table = pa.concat_tables(tables) if tables else schema.empty_table()
        return pa.concat_tables([table.slice(i, 256) for i in range(0, max(len(table), 1), 256)])

    return run


def remove_repeats(documents: DataFrame, keep: list[str], as_text: bool = False, prefix: str = "") -> DataFrame:
    """The columns in keep, and n_bytes, n_removed, n_spans, spans (start and end byte in the text), kept_bytes (their
    names with a prefix, if given); as_text: kept_text in place of the bytes, without characters of which a part was
    removed."""
    spark = documents.sparkSession
    bound_batches(spark)
    outputs = {"n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "spans": "array<struct<start: bigint, `end`: bigint>>"} | ({"kept_text": "string"} if as_text else {"kept_bytes": "binary"})
    keep = beside(keep, [f"{prefix}{c}" for c in outputs])
    given = documents.select(*dict.fromkeys(["doc_id", "text", *keep]))
    batches = stage(given.mapInArrow(trimmed(_batched(keep)), _BATCH), "batches", codec="uncompressed", file_rows=ROWS * FILE_BATCHES)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # seven in a hundred positions are anchors
    entries = batches.count() // ROWS * BATCH * 7 // 100
    per_task = min(max(-(-entries // (tasks * SHARD_ENTRIES)), 1), MOST_SHARDS)
    shards = tasks * per_task
    # what shards tell is little, and need not be a file of each
    files = -(-tasks // 16)

    def told(sent: DataFrame, step: int, width: int) -> DataFrame:
        dealt = sent.repartitionById(tasks, F.col("part")).sortWithinPartitions("shard", "grp")
        return stage(dealt.mapInArrow(_matched(step, width), _TOLD).repartition(files), "flags")

    first = told(batches.mapInArrow(_suffix_rows(shards, per_task), _SENT), 1, GRAM)
    blobs = batches.groupBy("grp")
    more = told(blobs.cogroup(first.groupBy("grp")).applyInArrow(_window_rows(shards, per_task), _SENT), 2, SPAN)
    schema = "".join(f"`{given.schema[c].name}` {given.schema[c].dataType.simpleString()}, " for c in keep)
    schema += ", ".join(f"`{prefix}{c}` {kind}" for c, kind in outputs.items())
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))
    return blobs.cogroup(first.union(more).groupBy("grp")).applyInArrow(_cut(arrow, as_text, shards), schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: what is left of every document."""
    left = remove_repeats(read_documents(spark, sf_dir), ["doc_id"])
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256"))
