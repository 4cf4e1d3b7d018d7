"""SentencePiece encoding and decoding for BPE models by a table over prefixes.

Of every prefix of a text the encoding ends in one certain token. The table holds that token: an automaton
lists the vocabulary entries that end at a position, and an entry is the last token if it may follow the last
token of what is left of it. Two tokens may stand side by side if merging the text of both from single
characters gives just these two. The ids are then read from the table backwards. Characters outside the
vocabulary become their UTF-8 bytes (byte fallback).

No entry of the vocabulary crosses from another character to a space mark, so a text is cut there into units,
and units are kept in a bounded cache; if a model has such an entry, the whole text is one unit.

Defined results: null and empty texts have no tokens and decode to the empty text; repeated rows, null ids and
extra columns pass through, but for kept ones named like an output, which give way; texts of any length are encoded whole; a model with a normalizer is refused.
"""

from __future__ import annotations

import gc
import hashlib
import re
from functools import cache

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession

from loomspan.llm.common import KEPT, beside, bound_batches, read_documents, trimmed

MARK = "▁"
_CACHE_MAX, _CACHED_LEN = 400_000, 48


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class PieceTokenizer:
    """Encodes and decodes as the model file says. Build one in each Python worker."""

    def __init__(self, model_file: str, cache: int | None = None) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        if model.normalize("ﬁ  x") != f"{MARK}ﬁ {MARK}x":
            raise ValueError("only models that leave texts as they are and add a space in front can be used")
        self.pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        special = {i for i in range(len(self.pieces)) if model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)}
        self.byte_of = {i: int(self.pieces[i][3:5], 16) for i in special if model.is_byte(i)}
        self.id_of_byte = {b: i for i, b in self.byte_of.items()}
        self.control = {i for i in special if model.is_control(i)}
        self.unknown = model.unk_id()
        self.ids = {p: i for i, p in enumerate(self.pieces) if i not in special}
        self.score = {p: model.get_score(i) for p, i in self.ids.items()}
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            self.automaton.add_word(piece, (i, len(piece) - 1))
        self.automaton.make_automaton()
        crossing = any(MARK in p.lstrip(MARK) for p in self.ids)
        newline = any("\n" in p for p in self.ids)
        body = "[^%s]" if newline else "[^%s\n]"
        self.units = None if crossing else re.compile(f"{MARK}*{body % MARK}+|{MARK}+|\n")
        self.pairs: dict[int, bool] = {}
        self.alone: dict[int, bool] = {}
        self.traces: dict[int, tuple[list[float], list[str], list[str]]] = {}
        self.names = [str(i) for i in range(len(self.pieces))]
        self.known = _Units(self._learn, cache)

    def merged(self, text: str) -> list[str]:
        """Plain merging: the best pair first, the leftmost of equals."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _stands(self, piece: int) -> bool:
        ok = self.alone[piece] = self.merged(self.pieces[piece]) == [self.pieces[piece]]
        return ok

    def _merges(self, piece: int) -> tuple[list[float], list[str], list[str]]:
        """The scores of a piece's merges in their order, and before each (and at the end) its first and its
        last part."""
        parts, scores, firsts, lasts = list(self.pieces[piece]), [], [], []
        while True:
            firsts.append(parts[0])
            lasts.append(parts[-1])
            if len(parts) == 1:
                found = self.traces[piece] = scores, firsts, lasts
                return found
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            scores.append(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _fits(self, left: int, right: int) -> bool:
        """Whether right can follow left: no merge crosses while both are put together from characters, each
        merge in its turn, the better score first and of equals the one further left. left is -1 at the start
        and after a character outside the vocabulary, across which nothing merges."""
        ok = self._alone(right) and (left < 0 or self._alone(left))
        if ok and left >= 0:
            (sa, _, last), (sb, first, _) = self.traces.get(left) or self._merges(left), self.traces.get(right) or self._merges(right)
            i, j, score, low = 0, 0, self.score, float("-inf")
            while True:
                a, b = sa[i] if i < len(sa) else low, sb[j] if j < len(sb) else low
                across = score.get(last[i] + first[j])
                if across is not None and across > a and across >= b:
                    ok = False
                    break
                if a == b == low:
                    break
                if a >= b:
                    i += 1
                else:
                    j += 1
        if len(self.pairs) > 500_000:
            self.pairs.clear()
        self.pairs[left * len(self.pieces) + right] = ok
        return ok

    def _alone(self, piece: int) -> bool:
        ok = self.alone.get(piece)
        return self._stands(piece) if ok is None else ok

    def last_tokens(self, unit: str) -> list[int]:
        """For each prefix (by its length) the id of its last token; -1 where a character is not in the
        vocabulary."""
        last, pairs, many = [-1] * (len(unit) + 1), self.pairs, len(self.pieces)
        for end, (piece, before) in self.automaton.iter(unit):
            if last[end + 1] < 0:
                left = last[end - before]
                ok = pairs.get(left * many + piece)
                if ok is None:
                    ok = self._fits(left, piece)
                if ok:
                    last[end + 1] = piece
        return last

    def encode_unit(self, unit: str) -> list[int]:
        last, end, out = self.last_tokens(unit), len(unit), []
        while end:
            piece = last[end]
            if piece < 0:
                data = unit[end - 1].encode()
                out.extend(self.id_of_byte.get(b, self.unknown) for b in reversed(data)) if self.id_of_byte else out.append(self.unknown)
                end -= 1
            else:
                out.append(piece)
                end -= len(self.pieces[piece])
        return out[::-1]

    def split(self, text: str) -> list[str]:
        if not text:
            return []
        marked = MARK + text.replace(" ", MARK)
        return self.units.findall(marked) if self.units else [marked]

    def encode(self, text: str | None) -> list[int]:
        return [i for unit in self.split(text or "") for i in self.encode_unit(unit)]

    def spell(self, ids: list[int]) -> str:
        """The text of ids inside a text: marks are spaces, runs of bytes are UTF-8."""
        out, data = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                data.append(self.byte_of[i])
                continue
            if data:
                out.append(_utf8(bytes(data)))
                data = bytearray()
            if i not in self.control:
                out.append(" ⁇ " if i == self.unknown else self.pieces[i].replace(MARK, " "))
        if data:
            out.append(_utf8(bytes(data)))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        """The text of a whole sequence: the space put in front is taken away."""
        skip = next((k for k, i in enumerate(ids) if i not in self.control), len(ids))
        text = self.spell(ids)
        first = ids[skip] if skip < len(ids) else None
        return text[1:] if first is not None and self.pieces[first].startswith(MARK) else text

    def _learn(self, unit: str) -> tuple[str, int, str]:
        last, pieces, names, end, out = self.last_tokens(unit), self.pieces, self.names, len(unit), []
        if last.count(-1) > 1:  # characters that become bytes
            ids = self.encode_unit(unit)
            return ",".join(map(str, ids)), len(ids), self.spell(ids)
        spelt = []
        while end:
            piece = last[end]
            text = pieces[piece]
            out.append(names[piece])
            spelt.append(text)
            end -= len(text)
        out.reverse()
        spelt.reverse()
        return ",".join(out), len(out), "".join(spelt).replace(MARK, " ")

    def round_trip(self, text: str | None) -> tuple[int, str, str]:
        """Number of ids, the ids as decimals joined by commas, and the text decoded from them."""
        units = self.split(text or "")
        if not units:
            return 0, "", ""
        ids, sizes, texts = zip(*map(self.known.__getitem__, units), strict=True)
        return sum(sizes), ",".join(ids), "".join(texts)[1:]


class _Units(dict):
    """Units already worked out. When full, what was used since the last time it was full stays within reach.
    Long units are not kept."""

    def __init__(self, learn, most: int | None) -> None:
        self.learn, self.older, self.most = learn, {}, most

    def __missing__(self, unit: str) -> tuple[str, int, str]:
        found = self.older.get(unit) or self.learn(unit)
        if len(unit) <= _CACHED_LEN:
            if len(self) >= (self.most or _CACHE_MAX):
                self.older = dict(self)
                self.clear()
            self[unit] = found
        return found


def _utf8(data: bytes) -> str:
    """Each byte that is no part of a valid character is one replacement character."""
    out, at = [], 0
    while at < len(data):
        for n in (4, 3, 2, 1):
            try:
                out.append(data[at : at + n].decode())
                at += min(n, len(data) - at)
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


@cache
def tokenizer(model_file: str, units: int | None = None) -> PieceTokenizer:
    """One for each Python process, so that reused workers keep their caches, until another operator runs in them."""
    KEPT["tokenizer"] = tokenizer.cache_clear
    return PieceTokenizer(model_file, units)


def encode(documents: DataFrame, keep: list[str], model_file: str | None = None) -> DataFrame:
    """The columns in keep, the token ids of text (array<int>), and the text decoded from them."""
    bound_batches(documents.sparkSession)
    keep = beside(keep, ["ids", "decoded"])
    given = documents.select(*dict.fromkeys([*keep, "text"]))
    schema = "".join(f"`{given.schema[c].name}` {given.schema[c].dataType.simpleString()}, " for c in keep)
    path = model_file or default_model()

    def run(batches):
        tok = tokenizer(path)
        for batch in batches:
            rows = [tok.encode(x) for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(rows, pa.list_(pa.int32())), pa.array([tok.decode(r) for r in rows], pa.string())], names=[*keep, "ids", "decoded"])

    return given.mapInArrow(trimmed(run, "tokenizer"), f"{schema}ids array<int>, decoded string")


def digest(documents: DataFrame, keep: list[str], model_file: str | None = None, units: int | None = None) -> DataFrame:
    """As encode, but only the number of ids and the SHA-256 of the ids and of the decoded text. units: how many
    units a worker keeps at hand (twice), about 350 bytes each."""
    bound_batches(documents.sparkSession)
    keep = beside(keep, ["n_tokens", "ids_sha256", "decoded_sha256"])
    given = documents.select(*dict.fromkeys([*keep, "text"]))
    schema = "".join(f"`{given.schema[c].name}` {given.schema[c].dataType.simpleString()}, " for c in keep)
    path = model_file or default_model()

    def run(batches):
        tok, sha = tokenizer(path, units), hashlib.sha256
        for batch in batches:
            n, ids, texts = [], [], []
            gc.disable()  # many small objects live on, and none of them in cycles
            try:
                for text in batch.column("text").to_pylist():
                    count, joined, decoded = tok.round_trip(text)
                    n.append(count)
                    ids.append(sha(joined.encode()).hexdigest())
                    texts.append(sha(decoded.encode()).hexdigest())
            finally:
                gc.enable()
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string())], names=[*keep, "n_tokens", "ids_sha256", "decoded_sha256"])

    return given.mapInArrow(trimmed(run, "tokenizer"), f"{schema}n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: every document's tokens under the public 32k BPE model."""
    return digest(read_documents(spark, sf_dir), ["doc_id"])
