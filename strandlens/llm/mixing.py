"""Mixing sources to target weights by temperature.

A source's share p of all tokens is raised to an exponent and normalised.  The
exponent is the one that brings the entropy of the weights to a target, or, if
that would repeat some source more than ``repeats`` times, the one that just
meets that limit; where no exponent reaches the target (equal shares), the
shares stay as they are.  It is found by nested sections: each round evaluates a grid
of exponents in one aggregation over the sources, so they never reach the
driver, however many there are.

A source's budget is its weight of the total.  Whole passes over the source
come first; for the rest its documents lie in blocks by the hash of their id,
the blocks in a keyed permutation, and blocks are taken until the budget is
met.  Only the one block in which it is met is cut, at the document (in hash
order) after which the next would exceed the budget: first the stretch of the
block in which that is, then the document.  A source has at most ``BLOCKS``
blocks, and a block as many stretches, so a source with a third of all rows
spreads over as many tasks, and none orders more than its millionth part.

Nulls and edge cases: a null source is the source with the empty name; a null
text has no tokens; a null id hashes as empty text.  Documents without tokens
cost nothing and are placed like any other.  Repeated rows share an id's place
and are taken together.  Other columns pass through, whatever their names; where
they include ``pass_``, the added column gets one more underscore.  If no
document has tokens, every row is taken once.  An empty table gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import cut, fresh

BLOCKS = 1024
#: A block has at least about so many documents.
BLOCK_DOCUMENTS = 32
SECTIONS, ROUNDS = 32, 6
WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Mixture:
    """Parameters: entropy as a share of the largest possible, most passes over a source, total as a share of all tokens."""

    entropy: float = 0.95
    repeats: float = 3.0
    total: float = 1.0
    seed: int = 17


def _source(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def _key(id_col: str, seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))


def _block(key: Column, blocks: Column) -> Column:
    return F.floor(F.conv(F.substring(key, 1, 8), 16, 10).cast("double") / 2.0**32 * blocks).cast("int")


def _stretch(key: Column, blocks: Column) -> Column:
    """Where in its block a key lies, as one of BLOCKS stretches; it never falls as the key grows."""
    at = F.conv(F.substring(key, 1, 8), 16, 10).cast("double") / 2.0**32 * blocks
    return F.floor((at - F.floor(at)) * BLOCKS).cast("int")


def exponent(sources: DataFrame, m: Mixture) -> float:
    """The exponent for sources(tokens, share), by grids of exponents that narrow around it; rounded to 6 places.

    Below 1 both the entropy and the passes over the smallest source fall as it grows, so it is the least that meets both
    limits.  Above 1, where the shares are more even than the target, the entropy falls while the passes over the largest
    source grow: it is the least that meets the entropy, or the last before the passes exceed theirs.  It has no upper
    bound.  Where even the largest sources alone are too even, as equal shares are, no exponent meets the entropy, and the
    shares stay as they are (1.0).
    """
    top = sources.agg(F.max("share")).first()[0] or 1.0
    ratio = F.col("share") / F.lit(top)  # at most 1, so that no sum vanishes under a large exponent
    facts = sources.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(ratio == 1.0, 1)).alias("ties")).first()
    goal = m.entropy * math.log(facts["n"]) if facts["n"] else 0.0
    most = max(m.repeats, m.total)

    def measured(grid: list[float]) -> list[tuple[float, float]]:
        """(entropy, most passes over a source) at each exponent, in one aggregation."""
        sums = []
        for i, a in enumerate(grid):
            power = F.pow(ratio, F.lit(a))
            sums += [F.sum(power).alias(f"z{i}"), F.sum(power * F.log(ratio)).alias(f"s{i}"), F.max(power / F.col("share")).alias(f"r{i}")]
        row = sources.agg(*sums).first()
        return [(math.log(row[f"z{i}"]) - a * row[f"s{i}"] / row[f"z{i}"], m.total * row[f"r{i}"] / row[f"z{i}"]) for i, a in enumerate(grid)]

    def narrowed(lo: float, hi: float, done) -> tuple[float, float]:
        """lo and hi around the first exponent that is done, hi being so; equal if lo is."""
        for _ in range(ROUNDS):
            grid = [lo + (hi - lo) * i / SECTIONS for i in range(SECTIONS + 1)]
            k = next((i for i, x in enumerate(measured(grid)) if done(*x)), SECTIONS)
            if k == 0:
                return grid[0], grid[0]
            lo, hi = grid[k - 1], grid[k]
        return lo, hi

    if measured([1.0])[0][0] <= goal:
        return round(narrowed(0.0, 1.0, lambda entropy, passes: entropy <= goal and passes <= most)[1], 6)
    if math.log(facts["ties"]) > goal:
        return 1.0
    lo, k = 1.0, None
    while k is None:
        grid = [lo * 2.0**i for i in range(SECTIONS + 1)]
        k = next((i for i, (entropy, passes) in enumerate(measured(grid)) if entropy <= goal or passes > most), None)
        lo, hi = (grid[-1], math.inf) if k is None else (grid[max(0, k - 1)], grid[k])
    lo, hi = narrowed(lo, hi, lambda entropy, passes: entropy <= goal or passes > most)
    return math.floor(lo * 1e6) / 1e6 if measured([hi])[0][1] > most else round(hi, 6)


def plan(docs: DataFrame, m: Mixture = Mixture(), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> tuple[DataFrame, DataFrame]:
    """(sources, blocks): each source's weight, budget and whole passes, and for the rest what is taken of its blocks.

    sources: source_, tokens, share, weight, budget, blocks_, passes_.  blocks: source_, block_, last_ (null: not taken;
    the key of the last document taken, 'g' for the whole block).
    """
    tokens = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    counted = cut(docs.select(_source(source_col).alias("source_"), _key(id_col, m.seed).alias("key_"), tokens.alias("tokens")), "mix-tokens")
    per = counted.groupBy("source_").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("docs"))
    total = per.agg(F.sum("tokens")).first()[0] or 0
    blocks = F.least(F.lit(BLOCKS), F.ceil(F.col("docs") / BLOCK_DOCUMENTS)).cast("int")
    per = cut(per.select("source_", "tokens", blocks.alias("blocks_"), (F.col("tokens") / F.lit(float(max(total, 1)))).alias("share")), "mix-sources")
    some = per.filter("tokens > 0")
    alpha = exponent(some, m) if total else 1.0
    power = F.pow(F.col("share") / F.lit(some.agg(F.max("share")).first()[0] or 1.0), F.lit(alpha))
    z = some.agg(F.sum(power)).first()[0] or 1.0
    weight = F.when(F.col("tokens") > 0, power / F.lit(z)).otherwise(0.0)
    budget = F.floor(F.round(weight * F.lit(m.total * total), 3)).cast("long")
    passes = F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens")).cast("int")).otherwise(1)
    sources = per.withColumn("weight", weight).withColumn("budget", budget).withColumn("passes_", passes).withColumn("alpha", F.lit(alpha))
    rest = sources.select("source_", "blocks_", F.when(F.col("tokens") > 0, F.col("budget") - F.col("tokens") * F.col("passes_")).otherwise(0).alias("rest"))
    placed = counted.join(rest, "source_").withColumn("block_", _block(F.col("key_"), F.col("blocks_")))
    sums = placed.groupBy("source_", "block_", "rest").agg(F.sum("tokens").alias("tokens"))
    order = F.md5(F.concat_ws("|", F.lit(str(m.seed)), "source_", F.col("block_").cast("string")))
    before = Window.partitionBy("source_").orderBy("order", "block_").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("order", order).withColumn("before", F.coalesce(F.sum("tokens").over(before), F.lit(0).cast("long")))
    sums = sums.withColumn("left", F.col("rest") - F.col("before"))
    whole = sums.filter((F.col("left") > 0) & (F.col("tokens") <= F.col("left"))).select("source_", "block_", F.lit("g").alias("last_"))
    # at most one block of each source is cut
    met = sums.filter((F.col("left") > 0) & (F.col("tokens") > F.col("left"))).select("source_", "block_", "left")
    inside = cut(placed.select("source_", "block_", "blocks_", "key_", "tokens").join(met, ["source_", "block_"]).withColumn("stretch_", _stretch(F.col("key_"), F.col("blocks_"))), "mix-cut")
    stretches = inside.groupBy("source_", "block_", "stretch_", "left").agg(F.sum("tokens").alias("tokens"), F.max("key_").alias("last_"))
    lower = Window.partitionBy("source_", "block_").orderBy("stretch_").rowsBetween(Window.unboundedPreceding, -1)
    stretches = stretches.withColumn("room", F.col("left") - F.coalesce(F.sum("tokens").over(lower), F.lit(0).cast("long")))
    full = stretches.filter(F.col("tokens") <= F.col("room")).select("source_", "block_", "last_")
    # at most one stretch of each cut block is cut
    ends = stretches.filter((F.col("room") >= 0) & (F.col("tokens") > F.col("room"))).select("source_", "block_", "stretch_", "room")
    running = Window.partitionBy("source_", "block_", "stretch_").orderBy("key_").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    last = inside.select("source_", "block_", "stretch_", "key_", "tokens").join(ends, ["source_", "block_", "stretch_"]).withColumn("sum", F.sum("tokens").over(running))
    last = last.filter(F.col("sum") <= F.col("room")).select("source_", "block_", F.col("key_").alias("last_"))
    part = full.unionByName(last).groupBy("source_", "block_").agg(F.max("last_").alias("last_"))
    return sources, cut(whole.unionByName(part), "mix-blocks")


def mix(docs: DataFrame, m: Mixture = Mixture(), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The documents as often as their source's budget has them, with pass_ (0, 1, ...; see above for its name) added last."""
    sources, blocks = plan(docs, m, id_col, text_col, source_col)
    (nth,) = fresh(docs.columns, "pass_")
    rows = docs.select(F.struct("*").alias("row_"), _source(source_col).alias("source_"), _key(id_col, m.seed).alias("key_"))
    rows = rows.join(sources.select("source_", "blocks_", "passes_"), "source_").withColumn("block_", _block(F.col("key_"), F.col("blocks_")))
    rows = rows.join(blocks, ["source_", "block_"], "left")
    copies = F.col("passes_") + F.coalesce((F.col("key_") <= F.col("last_")).cast("int"), F.lit(0))
    taken = rows.withColumn("copies_", copies).filter("copies_ > 0").withColumn(nth, F.explode(F.sequence(F.lit(0), F.col("copies_") - 1)))
    return taken.select("row_.*", nth)


def mixture_of(docs: DataFrame, m: Mixture = Mixture()) -> DataFrame:
    """doc_id, source and pass of every document taken, without texts."""
    return mix(docs.select("doc_id", "source", "text"), m).select("doc_id", "source", F.col("pass_").alias("pass"))


#: The same in DuckDB's SQL: doubling and bisection of the exponent, then whole passes, whole blocks and the cut block.
SQL = r"""
WITH RECURSIVE counted AS (
  SELECT doc_id, source, coalesce(source, '') AS s, md5('{seed}|' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS tokens FROM {docs}),
per AS (SELECT s, sum(tokens)::BIGINT AS tokens, least({blocks}, ceil(count(*) / {block_documents}))::INT AS blocks FROM counted GROUP BY s),
shares AS (SELECT *, tokens / (SELECT sum(tokens) FROM per)::DOUBLE AS share FROM per),
filled AS MATERIALIZED (SELECT share, share / (SELECT max(share) FROM shares) AS r FROM shares WHERE tokens > 0),
facts AS MATERIALIZED (SELECT {entropy} * ln(count(*)) AS goal, ln(count(*) FILTER (WHERE r = 1)) AS ties, ln(sum(r)) - sum(r * ln(r)) / sum(r) AS even FROM filled),
steps AS (
  SELECT 0 AS i, CASE WHEN even <= goal THEN 0.0 ELSE 1.0 END::DOUBLE AS lo, CASE WHEN even <= goal THEN 1.0 ELSE 'inf'::DOUBLE END::DOUBLE AS hi FROM facts
  UNION ALL
  SELECT i + 1, CASE WHEN done THEN lo ELSE a END, CASE WHEN done THEN a ELSE hi END
  FROM (SELECT i, lo, hi, a, CASE WHEN even <= goal THEN h <= goal AND passes <= {repeats} ELSE h <= goal OR passes > {repeats} END AS done
    FROM facts, (SELECT *, (SELECT ln(sum(r ** a)) - a * sum(r ** a * ln(r)) / sum(r ** a) FROM filled) AS h, (SELECT {total} * max(r ** a / share) / sum(r ** a) FROM filled) AS passes
      FROM (SELECT *, CASE WHEN hi = 'inf'::DOUBLE THEN 2 * lo ELSE (lo + hi) / 2 END AS a FROM steps WHERE i < 70)))),
alpha AS (SELECT CASE WHEN even > goal AND ties > goal THEN 1.0
    WHEN even > goal AND (SELECT {total} * max(r ** hi / share) / sum(r ** hi) FROM filled) > {repeats} THEN floor(lo * 1e6) / 1e6 ELSE round(hi, 6) END::DOUBLE AS a FROM steps, facts WHERE i = 70),
z AS (SELECT sum(r ** a) AS z FROM filled, alpha),
budgets AS (SELECT s, tokens, blocks, CASE WHEN tokens > 0 THEN floor(round((share / (SELECT max(share) FROM shares)) ** a / z * ({total} * (SELECT sum(tokens) FROM per)), 3))::BIGINT ELSE 0 END AS budget FROM shares, alpha, z),
sources AS (SELECT *, CASE WHEN tokens > 0 THEN budget // tokens ELSE 1 END AS passes, CASE WHEN tokens > 0 THEN budget % tokens ELSE 0 END AS rest FROM budgets),
placed AS (SELECT c.*, passes, rest, floor(('0x' || substr(k, 1, 8))::BIGINT / 4294967296.0::DOUBLE * blocks)::INT AS block FROM counted c JOIN sources USING (s)),
sums AS (SELECT s, block, any_value(rest) - coalesce(sum(sum(tokens)) OVER (PARTITION BY s ORDER BY md5('{seed}|' || s || '|' || block), block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room, sum(tokens) AS tokens FROM placed GROUP BY s, block),
chosen AS (SELECT p.*, m.room, m.tokens AS all_, sum(p.tokens) OVER (PARTITION BY p.s, p.block ORDER BY k RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM placed p JOIN sums m ON p.s = m.s AND p.block = m.block),
copies AS (SELECT doc_id, source, passes + CASE WHEN room > 0 AND (all_ <= room OR upto <= room) THEN 1 ELSE 0 END AS n FROM chosen)
SELECT doc_id, source, CAST(pass AS INT) AS pass FROM (SELECT doc_id, source, unnest(range(n)) AS pass FROM copies)
"""


def sql(m: Mixture = Mixture(), docs: str = "documents") -> str:
    return SQL.format(docs=docs, seed=m.seed, blocks=BLOCKS, block_documents=f"{BLOCK_DOCUMENTS}.0", entropy=m.entropy, total=m.total, repeats=max(m.repeats, m.total))
