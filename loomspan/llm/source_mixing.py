"""Mixing sources to target weights by temperature.

A source's weight is its share of tokens to the power alpha, normalised. alpha = k / STEPS is the largest for which
the weights' entropy reaches a target, but no smaller than keeps every source within a limit of repetitions; k is
found by sections, each a grouped aggregate of the table of sources. A source's budget is its weight times the
budget of all; it is met by epochs over all its documents and one partial epoch. Each epoch is a permutation in
blocks: a document's block and its place in the block are hashes of its id and the epoch, and the partial epoch
ends at the last document, in order of block and place, that fits the budget. Where it ends is worked out on block
sums, so the documents themselves are read once more and never shuffled.

Defined results: a token is a run of characters other than space, tab, CR and LF; a null text has none; a null
source is a source; sources without tokens take no part in the weights and give their documents once; documents with
equal doc_id (null counts as 'null') have one place and are in or out together, repeated rows each; texts of any length
are counted whole; an empty table gives an empty result. Columns to carry along are named by the caller; one named like
an output gives way to it, and a prefix for the outputs avoids that. Names that begin with __mix_ are the operator's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspan.llm.common import beside, read_documents, stage

STEPS, SECTIONS = 1 << 20, 16
#: Documents in a block, about.
BLOCK_ROWS = 1024
#: Sources up to which their table of budgets is broadcast (about 100 bytes each).
BROADCAST_SOURCES = 100_000
ENTROPY_SHARE, MAX_EPOCHS = 0.95, 4.0


def count_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t\r\n]+")), F.lit(0)).cast("long")


def _place(doc_id: Column, epoch: Column) -> Column:
    """48 bits of a hash of the document and the epoch, the same in any SQL engine that has MD5."""
    name = F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(":"), epoch.cast("string"))
    return F.conv(F.substring(F.md5(name), 1, 12), 16, 10).cast("long")


def exponent(shares: DataFrame, target_entropy: float, max_epochs: float, whole: bool) -> int:
    """k of alpha = k / STEPS. shares: column share. Epochs are counted for a budget of as many tokens as there
    are or, if whole, of as many as read the largest source once."""

    def measure(ks: list[int]) -> dict[int, tuple[float, float]]:
        a, s = F.col("k") / STEPS, F.col("share")
        power = F.pow(s, a)
        grid = shares.select("share", F.explode(F.array(*map(F.lit, ks))).alias("k"))
        got = grid.groupBy("k").agg(F.sum(power).alias("z"), F.sum(power * F.log(s)).alias("y"), F.max(power / s).alias("m"), F.min(power / s).alias("l"))
        once = F.col("l") if whole else F.col("z")
        return {r["k"]: (r["h"], r["e"]) for r in got.select("k", (F.log("z") - F.col("k") / STEPS * F.col("y") / F.col("z")).alias("h"), (F.col("m") / once).alias("e")).collect()}

    def search(low: int, high: int, below) -> int:
        """The last k in [low, high) of which below holds, low if none; below(high) counts as false."""
        while high - low > 1:
            ks = sorted({low + max(1, (high - low) * i // SECTIONS) for i in range(1, SECTIONS)} - {high})
            for k, got in sorted(measure(ks).items()):
                if below(*got):
                    low = max(low, k)
                else:
                    high = min(high, k)
        return low

    by_entropy = search(0, STEPS + 1, lambda h, _: h >= target_entropy)
    by_epochs = search(-1, STEPS, lambda _, e: e > max_epochs) + 1
    return max(by_entropy, by_epochs)


def budgets(sized: DataFrame, entropy_share: float, max_epochs: float, whole: bool) -> tuple[DataFrame, bool]:
    """Of each source: epochs (whole ones), blocks, and where the partial epoch ends (cut_block, cut_place);
    and whether the table is small. sized: doc_id, source, n_tokens."""
    totals = stage(sized.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("docs")), "sources")
    facts = totals.where("tokens > 0").agg(F.sum("tokens").alias("all"), F.max("tokens").alias("most")).first()
    small = totals.count() <= BROADCAST_SOURCES
    every = facts["all"] or 0
    shares = totals.where("tokens > 0").select((F.col("tokens") / F.lit(every)).alias("share")) if every else None
    goal = entropy_share * shares.select(F.log(F.count("*"))).first()[0] if every else 0.0
    k = exponent(shares, goal, max_epochs, whole) if every else STEPS
    alpha = k / STEPS
    power = F.pow(F.col("tokens") / F.lit(every), F.lit(alpha)) if every else F.lit(0.0)
    z = shares.agg(F.sum(F.pow("share", F.lit(alpha)))).first()[0] if every else 1.0
    # With `whole` the budget is raised until every source, the largest too, is read at least once.
    total = every / (((facts["most"] / every) ** alpha / z) / (facts["most"] / every)) if whole and every else float(every)
    # the last digits of sums depend on their order and must not decide about a whole token
    budget = F.floor(power / F.lit(z) * F.lit(float(total)) * F.lit(1 + 1e-11))
    budget = F.greatest(budget, F.col("tokens")) if whole else budget
    plan = totals.withColumn("budget", F.when(F.col("tokens") > 0, budget).otherwise(0).cast("long"))
    plan = plan.withColumn("epochs", F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(1))
    plan = plan.withColumn("rest", F.when(F.col("tokens") > 0, F.col("budget") - F.col("epochs") * F.col("tokens")).otherwise(0))
    plan = plan.withColumn("blocks", F.expr(f"(docs + {BLOCK_ROWS - 1}) div {BLOCK_ROWS}")).select(F.col("source").alias("of"), "epochs", "rest", "blocks")
    held = F.broadcast(plan) if small else plan
    placed = sized.join(held, F.col("source").eqNullSafe(F.col("of"))).withColumn("place", _place(F.col("doc_id"), F.col("epochs")))
    placed = placed.select("source", "rest", "n_tokens", "place", F.pmod("place", "blocks").alias("block"))
    sums = placed.groupBy("source", "rest", "block").agg(F.sum("n_tokens").alias("tokens"))
    upto = sums.selectExpr("source", "rest", "block", "tokens", "sum(tokens) over (partition by source order by block) upto")
    cut = upto.where("upto > rest").groupBy(F.col("source").alias("s")).agg(F.min_by(F.struct("block", (F.col("rest") - F.col("upto") + F.col("tokens")).alias("left")), "block").alias("cut"))
    cut = stage(cut.selectExpr("s", "cut.block cut_block", "cut.left left"), "cuts")
    edge = placed.join(F.broadcast(cut) if small else cut, F.col("source").eqNullSafe(F.col("s"))).where("block = cut_block")
    edge = edge.selectExpr("source", "left", "place", "sum(n_tokens) over (partition by source order by place) upto")
    last = edge.where("upto <= left").groupBy(F.col("source").alias("s2")).agg(F.max("place").alias("cut_place"))
    out = plan.join(cut.select("s", "cut_block"), F.col("of").eqNullSafe(F.col("s")), "left").join(last, F.col("of").eqNullSafe(F.col("s2")), "left")
    # without a cut the partial epoch has nothing to leave out: only where it is empty and all is zero
    return stage(out.select("of", "epochs", "blocks", F.coalesce("cut_block", F.lit(-1)).alias("cut_block"), F.coalesce("cut_place", F.lit(-1)).alias("cut_place")), "budgets"), small


def mix_sources(documents: DataFrame, keep: list[str], entropy_share: float = ENTROPY_SHARE, max_epochs: float = MAX_EPOCHS, whole: bool = False, prefix: str = "") -> DataFrame:
    """The columns in keep, and epoch, block, place and n_tokens (their names with a prefix, if given), once for every
    time a document is to be read; in order of epoch, block, place each source is a permutation of its documents.
    entropy_share: target entropy as a share of that of equal weights. whole: raise the budget from the number of
    tokens there are until no document is left out."""
    outputs = [f"{prefix}{c}" for c in ("epoch", "block", "place", "n_tokens")]
    keep = beside(keep, outputs)
    given = documents.select(*dict.fromkeys([*keep, "doc_id", "source", "text"]))
    sized = stage(given.select("doc_id", "source", count_tokens(F.col("text")).alias("n_tokens")), "sized")
    plan, small = budgets(sized, entropy_share, max_epochs, whole)
    plan = plan.select(*(F.col(c).alias(f"__mix_{c}") for c in plan.columns))
    rows = given.join(F.broadcast(plan) if small else plan, F.col("source").eqNullSafe(F.col("__mix_of")))
    rows = rows.withColumn("__mix_epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__mix_epochs"))))
    rows = rows.withColumn("__mix_place", _place(F.col("doc_id"), F.col("__mix_epoch"))).withColumn("__mix_block", F.pmod("__mix_place", "__mix_blocks"))
    rows = rows.where("__mix_epoch < __mix_epochs or __mix_block < __mix_cut_block or (__mix_block = __mix_cut_block and __mix_place <= __mix_cut_place)")
    made = [F.col("__mix_epoch").cast("int"), F.col("__mix_block"), F.col("__mix_place"), count_tokens(F.col("text"))]
    return rows.select(*keep, *(c.alias(name) for c, name in zip(made, outputs, strict=True)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9: all documents mixed to 95 % of the entropy of equal weights, each source read 4 times at most."""
    return mix_sources(read_documents(spark, sf_dir), ["doc_id", "source"])


ORACLE_SQL = r"""
WITH RECURSIVE sized AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^ \t\r\n]+')), 0)::BIGINT AS n_tokens FROM documents),
totals AS (SELECT source, sum(n_tokens)::BIGINT AS tokens, count(*) AS docs FROM sized GROUP BY source),
shares AS (SELECT tokens / (SELECT sum(tokens) FROM totals)::DOUBLE AS s FROM totals WHERE tokens > 0),
goal AS (SELECT 0.95 * ln(count(*)) AS h FROM shares),
bent(step, lo, hi) AS (SELECT 0, 0, 1048577 UNION ALL
  SELECT step + 1, CASE WHEN ok THEN mid ELSE lo END, CASE WHEN ok THEN hi ELSE mid END FROM (SELECT step, lo, hi, mid,
    (SELECT ln(sum(pow(s, mid / 1048576.0))) - mid / 1048576.0 * sum(pow(s, mid / 1048576.0) * ln(s)) / sum(pow(s, mid / 1048576.0)) FROM shares) >= (SELECT h FROM goal) AS ok
    FROM (SELECT step, lo, hi, (lo + hi) // 2 AS mid FROM bent WHERE step < 21 AND hi - lo > 1) x) y),
brep(step, lo, hi) AS (SELECT 0, -1, 1048576 UNION ALL
  SELECT step + 1, CASE WHEN ok THEN mid ELSE lo END, CASE WHEN ok THEN hi ELSE mid END FROM (SELECT step, lo, hi, mid,
    (SELECT max(pow(s, mid / 1048576.0) / s) / sum(pow(s, mid / 1048576.0)) FROM shares) > 4.0 AS ok
    FROM (SELECT step, lo, hi, (lo + hi) // 2 AS mid FROM brep WHERE step < 21 AND hi - lo > 1) x) y),
alpha AS (SELECT greatest((SELECT max(lo) FROM bent), (SELECT max(lo) FROM brep) + 1) / 1048576.0 AS a),
plan AS (SELECT source, tokens, docs, CASE WHEN tokens > 0 THEN floor(pow(tokens / (SELECT sum(tokens) FROM totals)::DOUBLE, a) / (SELECT sum(pow(s, a)) FROM shares)
    * (SELECT sum(tokens) FROM totals)::DOUBLE * (1 + 1e-11::DOUBLE))::BIGINT ELSE 0 END AS budget FROM totals, alpha),
ends AS (SELECT source, CASE WHEN tokens > 0 THEN budget // tokens ELSE 1 END AS epochs, CASE WHEN tokens > 0 THEN budget % tokens ELSE 0 END AS rest, (docs + 1023) // 1024 AS blocks FROM plan),
placed AS (SELECT doc_id, d.source, n_tokens, epochs, rest, epoch, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || ':' || epoch), 1, 12))::BIGINT AS place, blocks
  FROM sized d JOIN ends e ON d.source IS NOT DISTINCT FROM e.source, unnest(generate_series(0, epochs)) AS g(epoch)),
summed AS (SELECT *, place % blocks AS block, sum(n_tokens) OVER (PARTITION BY source, epoch ORDER BY place % blocks, place) AS upto FROM placed),
first_over AS (SELECT source, min((place % blocks, place)) AS stop FROM summed WHERE epoch = epochs AND upto > rest GROUP BY source)
SELECT doc_id, m.source, epoch::INTEGER AS epoch, block, place, n_tokens FROM summed m LEFT JOIN first_over f ON m.source IS NOT DISTINCT FROM f.source
WHERE epoch < epochs OR (f.stop IS NOT NULL AND (block, place) < f.stop)
"""
