"""Quality rules whose cutoffs are certified on labelled holdouts.

Every document has a few measures of its text (share of symbols, repeated lines, repeated
words, long and short words). A rule rejects a document whose measure lies in or above a cutoff
bucket. Nothing fixes the cutoffs beforehand: per stratum (by default the language) and rule,

* the tuning half of the labelled documents gives the cutoff that rejects most low-quality
  documents beyond the good ones it costs (a rule that gains nothing is not tested at all);
* the holdout half certifies: going down from the highest bucket to that cutoff, each cutoff is
  tested against "it rejects a share of ``limit / rules`` or more of the good documents" with the exact
  binomial tail P(Bin(n, limit / rules) <= k) for k of n good documents rejected, which is the exact
  (Clopper-Pearson) upper bound read the other way. The walk stops at the first cutoff that is not
  certified, so one level serves the whole walk (fixed-sequence testing); the level is
  ``risk / (strata x rules)`` (Bonferroni).

So with probability 1 - ``risk``, in every stratum at once, the rules together reject less than
``limit`` of the good documents. Where the labels do not suffice, nothing is certified and the
method rejects nothing.

All of it is DataFrame functions. Measures are taken in one pass over the texts; labels join ids
and small numbers only; histograms by (stratum, rule, bucket) are partially aggregated, so a hot
stratum is combined map-side; windows run over at most ``BUCKETS`` rows per rule and stratum.

Defined results: null text has no words; a text without words fails the base rule; null strata are a
stratum of their own; a null id meets no label; several labels of a document count as their
smallest; labels other than 0 and 1 are not used; repeated rows count and are judged one by one;
an empty table gives an empty result; all other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskbook.llm.common import stored
from riskbook.llm.duck import crc32

WHITE = "\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = "#*$%&|<>"
WINDOW_WORDS = 5
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20
BUCKETS = 64
LIMIT = 0.05
RISK = 0.05


@dataclass(frozen=True)
class Rule:
    """``bucket`` = floor(numerator x scale / denominator) + shift, kept within 0..BUCKETS-1; higher is worse."""

    name: str
    numerator: str
    denominator: str
    scale: int
    shift: int = 0

    def sql(self, divide: str) -> str:
        """``divide`` is the engine's integer division of non-negative numbers."""
        bucket = f"({self.numerator} * {self.scale} {divide} greatest({self.denominator}, 1))"
        bucket = f"({self.shift} - {bucket})" if self.shift else bucket
        return f"least({BUCKETS - 1}, greatest(0, {bucket}))"


RULES = (
    Rule("symbols", "n_symbols", "word_chars", 128),
    Rule("dup_lines", "n_dup_lines", "n_lines", 64),
    Rule("repeat_words", "n_repeat_words", "n_words", 128),
    Rule("long_words", "word_chars", "n_words", 6),
    Rule("short_words", "word_chars", "n_words", 6, shift=BUCKETS - 1),
)


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    """The words of a text: what stands between white space."""
    return bound(F.btrim(text, F.lit(WHITE)), lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, f"[{WHITE}]+")))


def _with_equal_neighbour(pairs: Column, key: str) -> Column:
    """Of sorted structs, those whose ``key`` equals that of the one before or after."""
    same = lambda a, b: F.coalesce(a[key] == b[key], F.lit(False))
    kept = lambda p: F.filter(p, lambda x, i: same(x, F.get(p, i - 1)) | same(x, F.get(p, i + 1)))
    return bound(F.sort_array(pairs), kept)


def repeated_words(words: Column, width: int = WINDOW_WORDS) -> Column:
    """Words that lie in a window of ``width`` words which occurs twice or more.

    Hashes tell the texts without any repeated window (equal windows have equal hashes); in the
    others only windows with a repeated hash are compared as text.
    """
    hashes = lambda w: F.transform(
        F.sequence(F.lit(0), F.size(w) - width), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(width)])
    )

    def covered(at: Column) -> Column:
        new = F.transform(at, lambda x, i: F.least(F.lit(width), F.coalesce(F.get(at, i + 1) - x, F.lit(width))))
        return F.aggregate(new, F.lit(0).cast("long"), lambda total, x: total + x)

    def compared(w: Column, h: Column) -> Column:
        alike = _with_equal_neighbour(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))), "h")
        texts = F.transform(alike, lambda x: F.struct(F.concat_ws(" ", F.slice(w, x["i"] + 1, width)).alias("s"), x["i"].alias("i")))
        at = F.array_sort(F.transform(_with_equal_neighbour(texts, "s"), lambda x: x["i"]))
        return bound(at, covered)

    none = F.lit(0).cast("long")
    return bound(
        words,
        lambda w: F.when(F.size(w) <= width, none).otherwise(
            bound(hashes(w), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), none).otherwise(compared(w, h)))
        ),
    )


def measures(docs: DataFrame, stratum: Column) -> DataFrame:
    """doc_id, stratum, and the counts that the rules use, for every row of docs."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(f"[^{WHITE}]"))
    found = docs.select(
        "doc_id",
        stratum.cast("string").alias("stratum"),
        bound(words_of(text), lambda w: F.struct(F.size(w).alias("n_words"), F.length(F.concat_ws("", w)).alias("word_chars"), repeated_words(w).alias("n_repeat_words"))).alias("_w"),
        bound(lines, lambda x: F.struct(F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines"))).alias("_l"),
        F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).alias("n_symbols"),
    )
    long = lambda c: F.col(c).cast("long")
    return found.select(
        "doc_id", "stratum", long("_w.n_words").alias("n_words"), long("_w.word_chars").alias("word_chars"), long("n_symbols").alias("n_symbols"),
        long("_l.n_dup_lines").alias("n_dup_lines"), long("_w.n_repeat_words").alias("n_repeat_words"), long("_l.n_lines").alias("n_lines"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))


def _remainder(x: Column) -> Column:
    """ln x! less Stirling's formula, for x >= 1: from the factorial up to 15, then by the series."""
    small = F.log(F.factorial(F.least(x, F.lit(15)).cast("int")).cast("double")) - (x + 0.5) * F.log(x) + x - 0.9189385332046727
    power = lambda k: F.pow(x, F.lit(float(k)))
    return F.when(x <= 15, small).otherwise(1 / (12 * x) - 1 / (360 * power(3)) + 1 / (1260 * power(5)) - 1 / (1680 * power(7)))


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(Bin(n, p) <= k) for k below n p, else 1 (there the tail is near a half or above, never significant).

    The largest term comes from Stirling's formula with its remainder, the others by their ratios
    from k down; 10 sqrt(n p) + 64 of them hold all that a double can.
    """
    k, n = k.cast("double"), n.cast("double")
    mean = n * p
    deviance = lambda x, m: x * F.log(x / m) + m - x
    rest = n - k
    one = F.least(F.greatest(k, F.lit(1.0)), n)
    density = F.exp(_remainder(n) - _remainder(one) - _remainder(rest) - deviance(one, mean) - deviance(rest, n * (1 - p)))
    density = density * F.sqrt(n / (F.lit(2 * 3.141592653589793) * one * rest))
    top = F.when(k == 0, F.exp(n * F.log1p(F.lit(-p)))).otherwise(density)
    steps = F.least(k, F.floor(10 * F.sqrt(mean)) + 64).cast("int")
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))

    def add(state: Column, j: Column) -> Column:
        term = state["term"] * (k - j + 1) / (n - k + j) * ((1 - p) / p)
        return F.struct(term.alias("term"), (state["total"] + term).alias("total"))

    total = F.aggregate(F.sequence(F.lit(1), F.greatest(steps, F.lit(1))), start, add, lambda s: s["total"])
    return F.when((n > 0) & (k < mean), top * F.when(steps >= 1, total).otherwise(1.0)).otherwise(F.lit(1.0))


def certified(measured: DataFrame, labels: DataFrame, holdout: Column, rules: tuple[Rule, ...] = RULES, limit: float = LIMIT, risk: float = RISK) -> DataFrame:
    """stratum, rule, cutoff (lowest certified bucket), n_good, n_rejected (holdout), p_value: one row for
    each rule and stratum with a certified cutoff.

    ``holdout`` tells by doc_id which labelled documents certify; the others tune.
    """
    judged = labels.where(F.col("quality").isin(0, 1)).groupBy(F.col("doc_id").alias("_id")).agg(F.min("quality").alias("quality"))
    labelled = measured.where(~base_failed()).join(judged, F.col("doc_id") == F.col("_id"))
    buckets = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.expr(r.sql("div")).cast("int").alias("bucket")) for r in rules])
    one = labelled.select("stratum", holdout.alias("held"), "quality", F.explode(buckets).alias("b")).select("stratum", "held", "quality", "b.*")
    count = lambda c: F.sum(c.cast("long"))
    histogram = stored(
        one.groupBy("stratum", "rule", "bucket").agg(
            count(~F.col("held") & (F.col("quality") == 1)).alias("tune_good"),
            count(~F.col("held") & (F.col("quality") == 0)).alias("tune_bad"),
            count(F.col("held") & (F.col("quality") == 1)).alias("good"),
        ),
        "quality-histogram",
    )
    # Rejected at a cutoff: this bucket and those above. At most BUCKETS rows for each rule and stratum.
    per = Window.partitionBy("stratum", "rule")
    above = per.orderBy(F.desc("bucket"))
    walk = histogram.select(
        "stratum", "rule", "bucket",
        (F.sum("tune_bad").over(above) - F.sum("tune_good").over(above)).alias("gain"),
        F.sum("good").over(above).alias("n_rejected"),
        F.sum("good").over(per).alias("n_good"),
    )
    best = F.max(F.struct(F.col("gain"), F.col("bucket"))).over(per)
    walk = walk.withColumn("aim", F.when(best["gain"] > 0, best["bucket"]))
    tests = walk.where((F.col("bucket") >= F.col("aim")) & (F.col("n_good") > 0))
    # Tested are the strata that have good holdout documents.
    strata = max(1, histogram.where("good > 0").select("stratum").distinct().count())
    tests = tests.withColumn("p_value", binomial_tail(F.col("n_rejected"), F.col("n_good"), limit / len(rules)))
    passed = tests.withColumn("ok", F.col("p_value") <= risk / len(rules) / strata)
    unbroken = F.min(F.col("ok").cast("int")).over(above) == 1
    last = F.min(F.struct("bucket", "n_rejected", "p_value"))
    return (
        passed.withColumn("unbroken", unbroken).where("unbroken").groupBy("stratum", "rule", "n_good").agg(last.alias("l"))
        .select("stratum", "rule", F.col("l.bucket").alias("cutoff"), "n_good", F.col("l.n_rejected").alias("n_rejected"), F.col("l.p_value").alias("p_value"))
    )


def judge(docs: DataFrame, labels: DataFrame, stratum: Column, holdout: Column, rules: tuple[Rule, ...] = RULES, limit: float = LIMIT, risk: float = RISK) -> DataFrame:
    """doc_id, the measures, base_failed, kept, and the names of the certified rules that a document breaks."""
    measured = stored(measures(docs, stratum), "quality-measures")
    cutoffs = stored(certified(measured, labels, holdout, rules, limit, risk), "quality-cutoffs")
    # One row per stratum; its measured size lets the join broadcast it.
    per = stored(cutoffs.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs")), "quality-strata")
    joined = measured.join(per.withColumnRenamed("stratum", "_s"), F.col("stratum").eqNullSafe(F.col("_s")), "left")
    broken = [F.when(F.expr(r.sql("div")) >= F.col("cutoffs").getItem(r.name), F.lit(r.name)) for r in rules]
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed().alias("base_failed"),
        F.concat_ws(",", *broken).alias("broken_rules"),
    ).select("*", (~F.col("base_failed") & (F.col("broken_rules") == "")).alias("kept"))


def oracle_sql(rules: tuple[Rule, ...] = RULES, limit: float = LIMIT, risk: float = RISK) -> str:
    """The registered query's verdicts as DuckDB SQL: windows of words by grouping, the tail summed by log factorials."""
    in_holdout = crc32("coalesce(b.doc_id::varchar, '')") + " % 2 = 1"
    word, p = "[^\\x20\\x09-\\x0D]+", limit / len(rules)
    buckets = " union all ".join(
        f"select stratum, held, quality, '{r.name}' as rule, {r.sql('//')} as bucket from labelled" for r in rules
    )
    broken = " or ".join(
        f"exists (select 1 from cutoffs c where c.stratum is not distinct from d.stratum and c.rule = '{r.name}' and {r.sql('//')} >= c.cutoff)" for r in rules
    )
    return f"""
with texts as (select row_number() over () as row, doc_id, lang as stratum, coalesce(text, '') as text from documents),
words as (select row, unnest(w) as word, unnest(range(len(w))) as i from (select row, regexp_extract_all(text, '{word}') as w from texts)),
windows as (
  select row, i, word || ' ' || lead(word, 1) over o || ' ' || lead(word, 2) over o || ' ' || lead(word, 3) over o || ' ' || lead(word, 4) over o as s
  from words window o as (partition by row order by i)),
twice as (select row, i from (select row, i, count(*) over (partition by row, s) as n from windows where s is not null) where n > 1),
repeated as (select row, count(distinct place) as n from (select row, unnest(range(i, i + {WINDOW_WORDS})) as place from twice) group by row),
lines as (
  select row, count(*) as n_lines, count(*) - count(distinct line) as n_dup
  from (select row, unnest(string_split(text, chr(10))) as line from texts) where regexp_matches(line, '{word}') group by row),
measured as (
  select t.doc_id, t.stratum, len(regexp_extract_all(text, '{word}'))::bigint as n_words,
    length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g'))::bigint as word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
    coalesce(n_dup, 0)::bigint as n_dup_lines, coalesce(r.n, 0)::bigint as n_repeat_words, coalesce(n_lines, 0) as n_lines
  from texts t left join repeated r using (row) left join lines l using (row)),
based as (select *, n_words < {LEAST_WORDS} or 100 * n_repeat_words > {MOST_REPEATED_PERCENT} * n_words as base_failed from measured),
labelled as (
  select b.*, {in_holdout} as held, quality from based b
  join (select doc_id, min(quality) as quality from labels where quality in (0, 1) group by doc_id) l using (doc_id) where not base_failed),
buckets as ({buckets}),
histogram as (
  select stratum, rule, bucket, count(*) filter (where not held and quality = 1) as tune_good,
    count(*) filter (where not held and quality = 0) as tune_bad, count(*) filter (where held and quality = 1) as good
  from buckets group by all),
walk as (
  select stratum, rule, bucket, sum(tune_bad - tune_good) over above as gain, (sum(good) over above)::bigint as k, (sum(good) over (partition by stratum, rule))::bigint as n
  from histogram window above as (partition by stratum, rule order by bucket desc)),
aims as (select stratum, rule, max(struct_pack(gain := gain, bucket := bucket)) as best from walk group by all),
tests as (
  select w.*, case when k >= n * {p!r} then 1 else list_sum(list_transform(range(0, k + 1), lambda i:
      exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({p!r}) + (n - i) * ln(1 - {p!r})))) end as p_value
  from walk w join aims a on w.stratum is not distinct from a.stratum and w.rule = a.rule and a.best.gain > 0 and w.bucket >= a.best.bucket where n > 0),
passed as (
  select *, min((p_value <= {risk!r} / {len(rules)} / greatest(1, (select count(*) from (select distinct stratum from histogram where good > 0))))::int) over (partition by stratum, rule order by bucket desc) as ok
  from tests),
cutoffs as (select stratum, rule, min(bucket) as cutoff from passed where ok = 1 group by all)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and not ({broken}) as kept
from based d"""

