"""Mixing sources to target weights with hash-threshold histograms.

Every document has a fixed 52-bit hash of its id and text. A source's share of the mix
is the documents whose hash lies below the source's threshold, so a mix is a
filter: nothing is sorted, a smaller budget's documents are a subset of a larger one's,
and reruns agree. Thresholds come from histograms of words by (source, hash
bucket): running sums over the buckets find the one in which the budget ends,
and only that bucket is histogrammed again with the next 13 bits of the hash,
four times in all, which resolves single hash values. Each histogram is one
partially aggregated shuffle over (source, bucket), whatever the source's
share of the rows; no window is ever larger than a source's 8,192 buckets.

The documents at the threshold itself (equal rows share a hash) are taken as far as that
comes nearest to the target: all, none, or some of the equal ones, which are told apart by a number given over sorted ranges.

A target above a source's size is met by taking every document once and the
documents below the threshold a second time.

Defined results: null text has size 0; a null source is a source of its own,
last in the order of weights; null ids count as empty ids; which of several equal rows are taken is open, how many is
not; an empty table gives an empty mix; a source without words
has target 0. A source's words taken differ from its target by at most half the size of one document.
Columns other than doc_id, text and source are ignored. Sources are names: their table is taken to fit one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskbook.functions.ranking import in_ranges
from riskbook.llm.common import stored

WORD = r"[^\x20\x09-\x0D]+"
HASH_BITS = 52
BUCKET_BITS = 13
WEIGHTS = (3, 1, 2)
SHARE = 1.5
REPEATS = 2


def row_hash(doc_id: Column, text: Column) -> Column:
    """First 13 hexadecimal digits of the md5 of id and text."""
    both = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(both.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, hash and size (words) of every document."""
    words = F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)).cast("long"), F.lit(0))
    return docs.select("doc_id", F.col("source").cast("string").alias("source"), row_hash(F.col("doc_id"), F.col("text")).alias("hash"), words.alias("size"))


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """source, source_size, target: ``share`` of all words dealt by weight, no
    source above ``repeats`` times its size.

    Sharing the excess out again until nothing is above has one fixed point:
    target = min(cap, weight x level), with the level at which the targets use up
    the budget. With sources in order of cap / weight, the level is what is left
    after the first k caps over the weights after them, for the first k where it does
    not exceed the next cap / weight; further on it only falls, so it is the largest
    level that does not. One row per source.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    per = per.withColumn("weight", weight).withColumn("cap", F.lit(float(repeats)) * F.col("source_size"))
    ratio = F.col("cap") / F.col("weight")
    by_ratio = Window.orderBy(ratio, F.col("source").asc_nulls_last())
    everyone = Window.partitionBy()
    per = (
        per.withColumn("budget", F.lit(float(share)) * F.sum("source_size").over(everyone))
        .withColumn("caps_before", F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("weights_left", F.sum("weight").over(by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
        .withColumn("level_here", (F.col("budget") - F.col("caps_before")) / F.col("weights_left"))
    )
    fits = F.when(F.col("level_here") <= ratio, F.col("level_here"))
    target = F.least("cap", F.col("weight") * F.max(fits).over(everyone))
    return per.select("source", "source_size", F.coalesce(target, F.col("cap")).alias("target"))


def thresholds(sized: DataFrame, budgets: DataFrame) -> DataFrame:
    """source, threshold, spent: the largest threshold such that the words of the source's
    documents with hash < threshold are within ``budget`` (columns source, budget), and those words."""
    spent, base = F.lit(0).cast("long"), F.lit(0).cast("long")
    state = budgets.select("source", "budget", base.alias("base"), spent.alias("spent"))
    for level in range(HASH_BITS // BUCKET_BITS):
        shift = HASH_BITS - BUCKET_BITS * (level + 1)
        inside = sized.join(state.select(F.col("source").alias("s"), "base"), sized.source.eqNullSafe(F.col("s")))
        if level:  # only the boundary bucket of the level before
            inside = inside.where(F.shiftright("hash", shift + BUCKET_BITS) == F.shiftright("base", shift + BUCKET_BITS))
        histogram = inside.groupBy("source", F.shiftright("hash", shift).alias("bucket")).agg(F.sum("size").alias("words"))
        running = Window.partitionBy("source").orderBy("bucket")
        upto = histogram.select(F.col("source").alias("s"), "bucket", F.sum("words").over(running).alias("upto"))
        fits = F.col("spent") + F.col("upto") <= F.col("budget")
        first_out = F.min(F.when(~fits, F.col("bucket")))
        state = (
            state.join(upto, F.col("source").eqNullSafe(F.col("s")), "left")
            .groupBy("source", "budget", "base", "spent")
            .agg(first_out.alias("out"), F.max(F.when(fits, F.col("upto"))).alias("used"))
            .select(
                "source",
                "budget",
                # Nothing left out: the threshold lies behind all hashes of this bucket.
                F.coalesce(F.shiftleft("out", shift), F.col("base") + F.shiftleft(F.lit(1).cast("long"), shift + BUCKET_BITS)).alias("base"),
                (F.col("spent") + F.coalesce("used", F.lit(0))).alias("spent"),
            )
        )
        # A table of one row per source and level; the next level starts from it.
        state = stored(state, f"mix-level{level}")
    return state.select("source", F.col("base").alias("threshold"), "spent")


def planned(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> tuple[DataFrame, DataFrame]:
    """Sizes of the documents, and one row per source: s, source_size, target, whole, threshold."""
    sized = stored(sizes(docs), "mix-sizes")
    targets = stored(source_targets(sized, weights, share, repeats), "mix-targets")
    whole = F.coalesce(F.floor(F.col("target") / F.when(F.col("source_size") > 0, F.col("source_size"))), F.lit(0))
    budgets = targets.withColumn("whole", whole).withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size"))
    cut = stored(thresholds(sized, budgets).select(F.col("source").alias("t"), "threshold", "spent"), "mix-cut")
    # The documents at the threshold: how many, and their words (one row per source).
    edge = sized.join(cut, F.col("source").eqNullSafe(F.col("t")) & (F.col("hash") == F.col("threshold")))
    edge = edge.groupBy(F.col("source").alias("e")).agg(F.count(F.lit(1)).alias("k"), F.sum("size").alias("words"))
    plan = budgets.select(F.col("source").alias("s"), "source_size", "target", "whole", "budget").join(cut, F.col("s").eqNullSafe(F.col("t")))
    plan = plan.join(edge, F.col("s").eqNullSafe(F.col("e")), "left")
    nearest = F.floor((F.col("budget") - F.col("spent")) * F.col("k") / F.col("words") + 0.5)
    plan = plan.withColumn("some", F.least(F.coalesce("k", F.lit(0)), F.coalesce(nearest, F.lit(0))))
    # Written: a table of one row per source, whose measured size lets the joins with documents broadcast it.
    return sized, stored(plan.select("s", "source_size", "target", "whole", "threshold", F.coalesce("k", F.lit(0)).alias("k"), "some"), "mix-plan")


def copies(again: Column, repeats: int = REPEATS) -> Column:
    """How often the mix takes a document, from its source's row of the plan and whether it is taken beyond that."""
    return F.least(F.col("whole") + again.cast("long"), F.lit(repeats).cast("long"))


def _numbered(rows: DataFrame) -> DataFrame:
    """rows with ``_number`` from 1 within each source, given over sorted ranges."""
    keyed = rows.withColumn("_key", F.coalesce(F.concat(F.lit("="), F.col("s")), F.lit(""))).withColumn("_any", F.monotonically_increasing_id())
    placed = in_ranges(keyed, "_key", "_any")
    counts = placed.groupBy("_part", "_key").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("_part", "_key", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inside = F.row_number().over(Window.partitionBy("_part", "_key").orderBy("_at"))
    return placed.withColumn("_in", inside).join(counts, ["_part", "_key"]).withColumn("_number", F.col("_off") + F.col("_in"))


def _taken(joined: DataFrame, plan: DataFrame, repeats: int) -> DataFrame:
    """joined (rows with hash and their source's plan) with ``_copies``."""
    columns = joined.columns
    at_edge = F.col("hash") == F.col("threshold")
    parted = at_edge & (F.col("some") > 0) & (F.col("some") < F.col("k"))
    whole = (F.col("hash") < F.col("threshold")) | (at_edge & (F.col("some") > 0))
    if not plan.where("some > 0 and some < k").limit(1).count():
        return joined.withColumn("_copies", copies(whole, repeats))
    some = _numbered(joined.where(parted)).withColumn("_copies", copies(F.col("_number") <= F.col("some"), repeats))
    return joined.where(~parted).withColumn("_copies", copies(whole, repeats)).unionByName(some.select(*columns, "_copies"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """doc_id, size, source_size, target, taken for every document."""
    sized, plan = planned(docs, weights, share, repeats)
    # No text here; the plan is broadcast where its measured size allows.
    taken = _taken(sized.join(plan, F.col("source").eqNullSafe(F.col("s"))), plan, repeats)
    return taken.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("_copies")).alias("taken"))


def apply_mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """The rows of docs that the mix takes, each as often as it is taken; all columns kept."""
    _, plan = planned(docs, weights, share, repeats)
    rows = docs.select(F.struct("*").alias("_row"), F.col("source").cast("string").alias("_source"), row_hash(F.col("doc_id"), F.col("text")).alias("hash"))
    # One row per source; where the plan is beyond the broadcast limit, the join shuffles and AQE splits hot sources.
    joined = rows.join(plan.select("s", "whole", "threshold", "k", "some"), F.col("_source").eqNullSafe(F.col("s")))
    taken = _taken(joined, plan, repeats).where(F.col("_copies") > 0)
    return taken.select("_row", F.explode(F.sequence(F.lit(1).cast("long"), "_copies"))).select("_row.*")


def oracle_sql(weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS, docs: str = "documents") -> str:
    """The same mix as DuckDB SQL: targets by resharing in closed form, documents by running sums in hash order."""
    cases = " ".join(f"when {i} then {float(w)}::double" for i, w in enumerate(weights))
    return f"""
with sized as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::bigint as size,
         ('0x' || md5(coalesce(doc_id::varchar, '') || ':' || coalesce(text, ''))[1:13])::bigint as h
  from {docs}),
per as (
  select source, sum(size)::bigint as source_size,
         case (row_number() over (order by source nulls last) - 1) % {len(weights)} {cases} end as weight
  from sized group by source),
leveled as (
  select *, {float(repeats)}::double * source_size as cap, {float(share)}::double * sum(source_size) over () as budget from per),
steps as (
  select *, (budget - coalesce(sum(cap) over (order by cap / weight, source nulls last rows between unbounded preceding and 1 preceding), 0))
         / sum(weight) over (order by cap / weight, source nulls last rows between current row and unbounded following) as level_here
  from leveled),
targets as (
  select source, source_size, coalesce(least(cap, weight * max(case when level_here <= cap / weight then level_here end) over ()), cap) as target from steps),
plan as (
  select *, coalesce(floor(target / nullif(source_size, 0)), 0)::bigint as whole from targets),
hashes as (
  select s.source, s.h, count(*) as k, sum(s.size)::bigint as words, sum(sum(s.size)) over (partition by s.source order by s.h)::bigint as upto
  from sized s group by s.source, s.h),
edges as (
  select p.source, min_by(struct_pack(h := h, j := least(k, floor((p.target - p.whole * p.source_size - (upto - words)) * k / words + 0.5))), h) as edge
  from hashes join plan p on hashes.source is not distinct from p.source where upto > p.target - p.whole * p.source_size group by p.source),
ranked as (
  select s.*, p.source_size, p.target, p.whole, e.edge, row_number() over (partition by s.source, s.h) as rn
  from sized s join plan p on s.source is not distinct from p.source left join edges e on e.source is not distinct from s.source)
select doc_id, size, source_size, target,
       (size * least({repeats}, whole + case when edge is null or h < edge.h or (h = edge.h and rn <= edge.j) then 1 else 0 end))::bigint as taken
from ranked"""
