"""Approximate nearest neighbours by score-aware anisotropic quantisation.

The nearest vector x to a query q has the largest 2 q.x - |x|^2. Products q.x are estimated from codes: a vector is
cut into pairs of components, each coded in four bits, and codes and codebooks are chosen to make small the squared
residual with its part parallel to x weighed more, as that part moves the products that matter. A query becomes
tables of partial products; two codes share a byte and so one look-up. The best by estimate are ranked again by the
exact distance in double precision.

Codebooks are learned from TRAIN_ROWS vectors, about, and never more than twice as many, those with the smallest hashes
of vec_id; every vector is coded. PASS queries (32 MB for 64 dimensions) are broadcast and go over the table of codes
together, so that it is read once for so many; a task works on QUERY_BLOCK of them at a time. Of each
batch of vectors the RERANK best by estimate are measured exactly; then every other vector whose code and residual
norm do not prove it farther than the nearest measured so far. So ranks are exact; RERANK only decides how soon
distances are small enough to prove much. Where a group is denser than its codes resolve, all of it is measured.

Defined results: vectors that are null, zero, of another length than most, or that hold null or non-finite components
take no part, as query or candidate; nor do rows with null vec_id. Rows with equal vec_id are one candidate, at their
smallest distance, and a query's own id is none of its candidates; ties go to the smaller vec_id. Equal vectors are
looked up once and then listed by id. An empty table, or one with a single vector, gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspan.llm.common import bound_batches, new_path, stage

TRAIN_ROWS = 10_000
PASS, QUERY_BLOCK, RERANK, TOP = 1 << 16, 2048, 400, 10
CODEWORDS, ROUNDS = 16, 5
#: Products of queries within this cosine of a vector set the weight of its parallel residual.
THRESHOLD = 0.2
#: Vectors scanned at once.
SCAN_ROWS = 8192


def usable(vectors: DataFrame) -> tuple[DataFrame, int]:
    """vec_id and embedding (array<double>) of the vectors that take part, and their length."""
    given = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).where("vec_id is not null and embedding is not null")
    ok = given.where(F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0))
    most = ok.groupBy(F.size("embedding").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    dim = most["dim"] if most else 0
    return ok.where(F.size("embedding") == dim), dim


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


class Quantizer:
    """Codebooks for pairs of components."""

    def __init__(self, dim: int) -> None:
        self.dim, self.pairs = dim, (dim + 3) // 4 * 2
        # more weight on the parallel residual, less one
        self.extra = max((dim - 1) * THRESHOLD**2 / (1 - THRESHOLD**2) - 1, 0.0)

    def _split(self, x: np.ndarray) -> np.ndarray:
        wide = np.zeros((len(x), self.pairs * 2), np.float32)
        wide[:, : self.dim] = x
        return wide.reshape(len(x), self.pairs, 2)

    def train(self, x: np.ndarray) -> Quantizer:
        parts, draw = self._split(x), np.random.default_rng(5)
        start = parts[draw.choice(len(parts), CODEWORDS, replace=len(parts) < CODEWORDS)]
        self.books = start.transpose(1, 0, 2).copy()
        for step in range(ROUNDS * 2):
            # plain clustering first, then with the parallel part weighed
            extra = self.extra if step >= ROUNDS else 0.0
            codes, along = self._assign(parts, extra)
            unit = parts / np.linalg.norm(parts.reshape(len(parts), -1), axis=1)[:, None, None]
            for s in range(self.pairs):
                p, u, c = parts[:, s], unit[:, s], codes[:, s]
                rest = along - ((p - self.books[s, c]) * u).sum(1)
                left = np.zeros((CODEWORDS, 2, 2))
                right = np.zeros((CODEWORDS, 2))
                np.add.at(left, c, np.eye(2) + extra * u[:, :, None] * u[:, None, :])
                np.add.at(right, c, p + extra * u * (rest + (p * u).sum(1))[:, None])
                used = np.bincount(c, minlength=CODEWORDS) > 0
                self.books[s, used] = np.linalg.solve(left[used], right[used][:, :, None])[:, :, 0]
                along = rest + ((p - self.books[s, c]) * u).sum(1)
        return self

    def _assign(self, parts: np.ndarray, extra: float, sweeps: int = 2) -> tuple[np.ndarray, np.ndarray]:
        """Codes by coordinate descent, and the residuals' components along the vectors."""
        unit = parts / np.linalg.norm(parts.reshape(len(parts), -1), axis=1)[:, None, None]
        rows = np.arange(len(parts))
        errors, shifts, codes = [], [], np.empty((len(parts), self.pairs), np.uint8)
        for s in range(self.pairs):
            off = parts[:, s, None, :] - self.books[s][None]
            errors.append((off * off).sum(2))
            shifts.append((off * unit[:, s, None, :]).sum(2))
            codes[:, s] = errors[s].argmin(1)
        along = sum(shifts[s][rows, codes[:, s]] for s in range(self.pairs))
        for _ in range(sweeps if extra else 0):
            for s in range(self.pairs):
                rest = along - shifts[s][rows, codes[:, s]]
                loss = errors[s] + extra * (rest[:, None] + shifts[s]) ** 2
                codes[:, s] = loss.argmin(1)
                along = rest + shifts[s][rows, codes[:, s]]
        return codes, along

    def encode(self, x: np.ndarray) -> np.ndarray:
        """Codes of each vector, two in a byte."""
        out = np.empty((len(x), self.pairs // 2), np.uint8)
        for at in range(0, len(x), 4096):
            codes, _ = self._assign(self._split(x[at : at + 4096]), self.extra)
            out[at : at + 4096] = codes[:, 0::2] | codes[:, 1::2] << 4
        return out

    def tables(self, queries: np.ndarray) -> np.ndarray:
        """For each query and byte of a code the partial product for its 256 values."""
        part = np.einsum("qsd,scd->qsc", self._split(queries), self.books).astype(np.float32)
        low, high = part[:, 0::2], part[:, 1::2]
        return (high[:, :, :, None] + low[:, :, None, :]).reshape(len(queries), self.pairs // 2, 256)

    def decode(self, codes: np.ndarray) -> np.ndarray:
        """The vectors that codes stand for."""
        each = np.stack([codes & 15, codes >> 4], axis=2).reshape(len(codes), self.pairs)
        return self.books[np.arange(self.pairs), each].reshape(len(codes), -1).astype(np.float64)[:, : self.dim]


def build_index(vectors: DataFrame, dim: int, train_rows: int = TRAIN_ROWS) -> tuple[DataFrame, Quantizer] | None:
    """A staged table of vec_id, embedding, codes, and the quantizer; None if there is no vector."""
    n = vectors.count()
    if not n:
        return None
    share = min(1.0, train_rows / n)
    placed = vectors.withColumn("h", F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)))
    # a few more than wanted, so that small shares do not end with none
    some = placed.where(F.col("h") <= int(share * (1 << 20)) + (1 << 20) // max(n // 100, 1))
    sample = some.orderBy("h", "vec_id", "embedding").limit(2 * train_rows).select("embedding").toArrow()
    if not len(sample):
        sample = placed.orderBy("h", "vec_id", "embedding").limit(train_rows).select("embedding").toArrow()
    # one of equal vectors is enough to learn from
    quantizer = Quantizer(dim).train(np.unique(_matrix(sample.column("embedding").combine_chunks(), dim).astype(np.float32), axis=0))

    def coded(batches):
        for batch in batches:
            codes = quantizer.encode(_matrix(batch.column("embedding"), dim).astype(np.float32))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("embedding"), pa.array([c.tobytes() for c in codes], pa.binary())], names=["vec_id", "embedding", "codes"])

    bound_batches(vectors.sparkSession)
    return stage(vectors.mapInArrow(coded, "vec_id bigint, embedding array<double>, codes binary"), "vectors"), quantizer


def _at_least(dots: np.ndarray, q: float, x: np.ndarray, coded: np.ndarray, residual: np.ndarray, terms: int) -> np.ndarray:
    """Lower bounds of distances from products with the decoded vectors and the norms of query, vectors, decoded
    vectors and residuals: a vector is its residual away from the decoded one. Allows for single precision."""
    slack = (terms + 8) * (2.0**-22 * q * coded + 2.0**-125)
    square = q * q + coded * coded - 2.0 * dots
    near, far = np.sqrt(np.maximum(square - slack, 0.0)), np.sqrt(np.maximum(square + slack, 0.0))
    return np.maximum(near - residual, residual - far) - 1e-12 * (q + x + coded)


def _scan(quantizer: Quantizer, ids: np.ndarray, queries: np.ndarray, top: int, rerank: int):
    def run(batches):
        lengths = np.linalg.norm(queries, axis=1)
        # distances that top ids are known to be within, from the batches so far
        within = np.full(len(ids), np.inf)
        for batch in batches:
            for at in range(0, batch.num_rows, SCAN_ROWS):
                part = batch.slice(at, SCAN_ROWS)
                vec_ids = part.column("vec_id").to_numpy()
                x = _matrix(part.column("embedding"), quantizer.dim)
                codes = np.frombuffer(b"".join(part.column("codes").to_pylist()), np.uint8).reshape(len(x), -1)
                # equal vectors are scanned once
                order = np.lexsort((vec_ids, *x.T[::-1]))
                vec_ids, x, codes = vec_ids[order], x[order], codes[order]
                # and once for each id, so that repeated ids cannot crowd out others
                new = np.append(True, (x[1:] != x[:-1]).any(axis=1) | (vec_ids[1:] != vec_ids[:-1]))
                vec_ids, x, codes = vec_ids[new], x[new], codes[new]
                first = np.flatnonzero(np.append(True, (x[1:] != x[:-1]).any(axis=1)))
                size = np.diff(first, append=len(x))
                once, short = x[first], np.ascontiguousarray(codes[first].T)
                decoded = quantizer.decode(short.T)
                norms, coded, residual = (np.linalg.norm(v, axis=1) for v in (once, decoded, once - decoded))
                found: list[list[np.ndarray]] = [[], [], []]
                n = min(rerank, len(first))

                def nearest(q, some):
                    exact = np.sqrt(((once[some] - queries[q]) ** 2).sum(1))
                    # every vector stands for its rows, of which the top + 1 smallest ids are enough
                    many = np.minimum(size[some], top + 1)
                    rows = np.repeat(first[some], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                    far, who = np.repeat(exact, many), vec_ids[rows]
                    keep = who != ids[q]
                    return best_of(far[keep], who[keep])

                def best_of(far, who):
                    # repeated ids must not crowd out others: keep the nearest of each
                    sort = np.lexsort((who, far))
                    _, each = np.unique(who[sort], return_index=True)
                    sort = sort[np.sort(each)][:top]
                    return far[sort], who[sort]

                for q in range(len(ids)):
                    if q % QUERY_BLOCK == 0:
                        tables = quantizer.tables(queries[q : q + QUERY_BLOCK])
                    dots = np.zeros(len(first), np.float32)
                    for b, code in enumerate(short):
                        dots += tables[q % QUERY_BLOCK, b][code]
                    best = np.argpartition(norms**2 - 2.0 * dots, n - 1)[:n]
                    far, who = nearest(q, best)
                    if len(far) == top:
                        within[q] = min(within[q], far[-1])
                    # what is not proved farther is measured, also where a bound overflows
                    may = ~(_at_least(dots, lengths[q], norms, coded, residual, codes.shape[1]) > within[q])
                    may[best] = False
                    rest = np.flatnonzero(may)
                    # by their products first, which are quick but lose digits
                    square = lengths[q] ** 2 + norms[rest] ** 2 - 2.0 * (once[rest] @ queries[q])
                    rest = rest[~(square - 1e-12 * (lengths[q] + norms[rest]) ** 2 > within[q] ** 2)]
                    if len(rest):
                        more, others = nearest(q, rest)
                        far, who = best_of(np.append(far, more), np.append(who, others))
                        if len(far) == top:
                            within[q] = min(within[q], far[-1])
                    for out, v in zip(found, (np.full(len(who), ids[q]), who, far), strict=True):
                        out.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(v)) for v in found], names=["query_id", "vec_id", "score"])

    return run


def search(index: DataFrame, quantizer: Quantizer, queries: DataFrame, top: int = TOP, rerank: int = RERANK) -> DataFrame:
    """query_id, rank, vec_id, score: the top nearest found for each of queries (vec_id, embedding)."""
    spark = index.sparkSession
    bound_batches(spark)
    asked = queries.groupBy(F.col("vec_id").alias("query_id")).agg(F.min("embedding").alias("embedding"))
    n = asked.count()
    blocks = -(-n // PASS) if n else 1
    path = new_path(spark, "neighbours") if blocks > 1 else None
    for block in range(blocks):
        mine = asked if blocks == 1 else asked.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == block)
        got = mine.orderBy("query_id").toArrow()
        ids = got.column("query_id").to_numpy()
        vectors = _matrix(got.column("embedding").combine_chunks(), quantizer.dim) if len(got) else np.zeros((0, quantizer.dim))
        near = index.mapInArrow(_scan(quantizer, ids, vectors, top, rerank), "query_id bigint, vec_id bigint, score double") if len(got) else spark.createDataFrame([], "query_id bigint, vec_id bigint, score double")
        if path:
            near.write.mode("append").parquet(path)
    if path:
        near = spark.read.parquet(path)
    near = near.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    ranked = near.selectExpr("query_id", "row_number() over (partition by query_id order by score, vec_id) rank", "vec_id", "score")
    return ranked.where(F.col("rank") <= top)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5: the 10 nearest found of every vector whose vec_id is divisible by 100."""
    vectors, dim = usable(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    built = build_index(vectors, dim)
    if built is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    index, quantizer = built
    return search(index, quantizer, index.where("vec_id % 100 = 0").select("vec_id", "embedding"))
