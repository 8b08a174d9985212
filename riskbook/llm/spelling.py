"""Spelling variants of a corpus vocabulary, found by probing edits against Bloom filters.

Words are counted in one partially aggregated shuffle. The frequent ones are the vocabulary; two of
them are near if one code point inserted, deleted or replaced turns one into the other.

* A blocked Bloom filter per word length (in shards of at most about ``SHARD_WORDS`` words, by the
  leading hash bits) is built by the group that holds the shard's words.
* Tasks generate every deletion and every replacement (by a larger letter: the other direction is
  found from the other word, an insertion from the longer word) of their words and probe them against
  the broadcast filters. Hashes are XORs of one number per (position, letter), so an edit's hash
  follows from its word's in constant time and whole batches are numpy passes.
* Only positives become strings. An exact equi-join with the vocabulary removes the false ones.

The filters take some 2 to 4 bytes a word and are broadcast in passes of at most ``PASS_BYTES``: a
larger vocabulary takes more passes, never a larger broadcast. No task gathers neighbours: the
near words of a word are counted, and the most frequent chosen, by partial aggregation.

Defined results: null and empty texts have no words; a null id counts as an empty id; repeated rows
count each time; words of any length are probed whole (in chunks of positions); equal frequencies go to
the smaller word in code-point order; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskbook.llm.common import stored
from riskbook.llm.duck import crc32
from riskbook.llm.text_arrays import U64, mix

RUN = "[A-Za-zÀ-ÿ]+"
LOWER, UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DAMAGE = 199
LEAST_LENGTH = 6
LEAST_COUNT = 5
FORM_RATIO = 5
SHARD_WORDS = 1 << 17
BITS_PER_WORD = 16
LANES = 8
PASS_BYTES = 32 << 20
CHUNK = 1 << 21


def lower_ascii(run: Column) -> Column:
    """A-Z lower-cased, other letters as they are."""
    return F.when(run.rlike("[À-Þ]"), F.translate(run, UPPER, LOWER)).otherwise(F.lower(run))


def damaged(run: Column, doc_id: Column) -> Column:
    """The run without the code point that the hash of id and run names, where ``DAMAGE`` divides that hash."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    return F.when(h % DAMAGE == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """word, n, size (code points) of the words frequent enough."""
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.select("doc_id", lower_ascii(F.col("run")).alias("run"))
    words = runs.select(damaged(F.col("run"), F.col("doc_id")).alias("word")).where(F.length("word") >= least_length)
    counted = words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)
    return counted.withColumn("size", F.length("word"))


def letter_hash(position: np.ndarray, code: np.ndarray) -> np.ndarray:
    """One 64-bit number for each position and code point."""
    return mix((position.astype(U64) << U64(21)) ^ code.astype(U64) ^ U64(0x9E3779B97F4A7C15))


def codes(words: list[str], size: int) -> np.ndarray:
    """Code points of words of one size, a row each."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), size)


def word_hash(points: np.ndarray) -> np.ndarray:
    """XOR of the letters' hashes, in chunks of positions."""
    out = np.zeros(len(points), U64)
    step = max(1, CHUNK // max(1, len(points)))
    for at in range(0, points.shape[1], step):
        part = points[:, at : at + step]
        out ^= np.bitwise_xor.reduce(letter_hash(np.arange(at, at + part.shape[1]), part), axis=1)
    return out


class BlockedBloom:
    """Blocks of 512 bits; a hash sets one bit in each of a block's eight 64-bit lanes."""

    _SALTS = mix(np.arange(1, LANES + 1)) | U64(1)

    def __init__(self, lanes: np.ndarray):
        self.lanes = lanes
        self.blocks = U64(len(lanes) // LANES)

    @classmethod
    def of(cls, hashes: np.ndarray) -> BlockedBloom:
        blocks = 1 << int(max(1, -(-len(hashes) * BITS_PER_WORD // 512)) - 1).bit_length()
        out = cls(np.zeros(blocks * LANES, U64))
        for lane in range(LANES):
            at, bit = out._place(hashes, lane)
            np.bitwise_or.at(out.lanes, at, bit)
        return out

    def _place(self, hashes: np.ndarray, lane: int) -> tuple[np.ndarray, np.ndarray]:
        block = (hashes & U64(0xFFFFFFFF)) & (self.blocks - U64(1))
        bit = U64(1) << ((hashes * self._SALTS[lane]) >> U64(58))
        return (block * U64(LANES) + U64(lane)).astype(np.int64), bit

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        """Places in ``hashes`` of those that may have been added; each lane looks only at what the last one left."""
        left = np.arange(len(hashes))
        for lane in range(LANES):
            at, bit = self._place(hashes[left], lane)
            left = left[self.lanes[at] & bit != 0]
        return left


def _shard(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> U64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)


def filters(words: DataFrame) -> DataFrame:
    """size, bits (log2 of the shards of that size), shard, lanes (binary), pass: the filters of all words.

    Passes hold at most ``PASS_BYTES`` of lanes (or a single filter).
    """
    counts = words.groupBy("size").agg(F.count(F.lit(1)).alias("of_size"))
    bits = F.greatest(F.lit(0), F.ceil(F.log2(F.col("of_size") / F.lit(float(SHARD_WORDS))))).cast("int")
    sized = words.join(counts.select(F.col("size").alias("_size"), bits.alias("bits")), F.col("size") == F.col("_size")).select("word", "size", "bits")

    def with_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            frame = batch.to_pandas()
            for (size, shard_bits), part in frame.groupby(["size", "bits"]):
                hashes = word_hash(codes(part["word"].tolist(), size))
                yield pa.RecordBatch.from_pydict(
                    {"size": part["size"].astype("int32"), "bits": part["bits"].astype("int32"), "shard": _shard(hashes, int(shard_bits)), "hash": hashes.view(np.int64)},
                    schema=pa.schema([("size", pa.int32()), ("bits", pa.int32()), ("shard", pa.int64()), ("hash", pa.int64())]),
                )

    def build(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        lanes = BlockedBloom.of(part["hash"].to_numpy().view(U64)).lanes
        return pd.DataFrame({"size": [key[0]], "bits": [key[1]], "shard": [key[2]], "lanes": [lanes.tobytes()]})

    hashed = sized.mapInArrow(with_shard, "size int, bits int, shard long, hash long")
    built = stored(hashed.groupBy("size", "bits", "shard").applyInPandas(build, "size int, bits int, shard long, lanes binary"), "spelling-filters")
    # One row per filter: their running size deals them to passes.
    running = F.sum(F.length("lanes")).over(Window.orderBy("size", "shard"))
    return built.withColumn("pass", F.floor((running - F.length("lanes")) / F.lit(float(PASS_BYTES))).cast("int"))


def _probe(sent: Broadcast, alphabet: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Words in, (word, candidate) out for each edit that the filters sent may hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loaded: dict[int, tuple[int, dict[int, BlockedBloom]]] = {}
        for size, bits, shard, lanes in sent.value:
            loaded.setdefault(size, (bits, {}))[1][shard] = BlockedBloom(np.frombuffer(lanes, U64))

        def held(size: int, hashes: np.ndarray) -> np.ndarray:
            """Places of the hashes that some filter for that size may hold."""
            if size not in loaded or not len(hashes):
                return np.zeros(0, np.int64)
            bits, shards = loaded[size]
            if not bits:
                return shards[0].holds(hashes) if 0 in shards else np.zeros(0, np.int64)
            of = _shard(hashes, bits)
            parts = []
            for shard, bloom in shards.items():
                at = np.flatnonzero(of == shard)
                parts.append(at[bloom.holds(hashes[at])])
            return np.sort(np.concatenate(parts)) if parts else np.zeros(0, np.int64)

        for batch in batches:
            words = batch.column(0).to_pylist()
            by_size: dict[int, list[str]] = {}
            for w in words:
                by_size.setdefault(len(w), []).append(w)
            out: list[tuple[str, str]] = []
            for size, some in by_size.items():
                rows = max(1, CHUNK // (size * (len(alphabet) + 1)))
                for at in range(0, len(some), rows):
                    out.extend(_edits(some[at : at + rows], size, alphabet, held, size in loaded, size - 1 in loaded))
            if out:
                yield pa.RecordBatch.from_pydict({"word": [a for a, _ in out], "candidate": [b for _, b in out]})

    return run


def _edits(words: list[str], size: int, alphabet: np.ndarray, held: Callable, replace: bool, delete: bool) -> Iterator[tuple[str, str]]:
    """(word, edit) for the replacements and deletions of words of one size that ``held`` does not rule out."""
    points = codes(words, size)
    whole = word_hash(points)
    step = max(1, CHUNK // (len(words) * (len(alphabet) + 1)))
    # Deleting position p: letters before it stay, those after it move one place to the front.
    before, after = np.zeros(len(words), U64), np.zeros(len(words), U64)
    if delete:
        for at in range(0, size, step):
            part = points[:, at : at + step]
            after ^= np.bitwise_xor.reduce(letter_hash(np.arange(at, at + part.shape[1]) - 1, part), axis=1)
    for at in range(0, size, step):
        part = points[:, at : at + step]
        places = np.arange(at, at + part.shape[1])
        here = letter_hash(places, part)
        if replace:
            rows, cols, letters = np.nonzero(alphabet[None, None, :] > part[:, :, None])
            table = letter_hash(places[:, None], alphabet[None, :])
            for i in held(size, whole[rows] ^ here[rows, cols] ^ table[cols, letters]):
                w, p = words[rows[i]], at + cols[i]
                yield w, f"{w[:p]}{chr(alphabet[letters[i]])}{w[p + 1 :]}"
        if delete:
            moved = letter_hash(places - 1, part)
            left = np.bitwise_xor.accumulate(here, axis=1) ^ here ^ before[:, None]
            right = np.bitwise_xor.accumulate(moved, axis=1) ^ after[:, None]
            previous = points[:, at - 1 : at] if at else np.zeros((len(words), 1), np.uint32)
            # Of a run of equal letters, deleting the first is deleting any.
            first = part != np.concatenate([previous, part[:, :-1]], axis=1)
            rows, cols = np.nonzero(first)
            for i in held(size - 1, (left ^ right)[rows, cols]):
                w, p = words[rows[i]], at + cols[i]
                yield w, w[:p] + w[p + 1 :]
            before ^= np.bitwise_xor.reduce(here, axis=1)
            after = right[:, -1].copy()


def near_pairs(words: DataFrame) -> DataFrame:
    """a, n_a, b, n_b: every unordered pair of near words of ``words`` (word, n, size), once."""
    spark = words.sparkSession
    found = filters(words).persist()
    # At most one row per letter of the pattern.
    letters = words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).where("c <> ''").distinct()
    alphabet = np.sort(np.array([ord(r.c) for r in letters.collect()], dtype=np.uint32))
    last = found.agg(F.max("pass")).first()[0]
    near = None
    for k in range(-1 if last is None else last + 1):
        sent = spark.sparkContext.broadcast([(r["size"], r["bits"], r["shard"], bytes(r["lanes"])) for r in found.where(F.col("pass") == k).collect()])
        some = stored(words.select("word").mapInArrow(_probe(sent, alphabet), "word string, candidate string"), f"spelling-positives-{k}")
        near = some if near is None else near.unionByName(some)
        sent.destroy()
    found.unpersist()
    if near is None:
        near = words.select("word", F.col("word").alias("candidate")).limit(0)
    target = words.select(F.col("word").alias("b"), F.col("n").alias("n_b"))
    exact = near.join(target, F.col("candidate") == F.col("b")).select("word", "b", "n_b")
    return exact.join(words.select(F.col("word").alias("a"), F.col("n").alias("n_a")), F.col("word") == F.col("a")).select("a", "n_a", "b", "n_b")


def roots(forms: DataFrame) -> DataFrame:
    """word, root for words with a form: forms followed to the last by doubling.

    A form is ``FORM_RATIO`` times as frequent as its word, so chains have at most a few dozen links.
    """
    state = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots-0")
    step = 0
    while True:
        step += 1
        ahead = state.select(F.col("word").alias("_w"), F.col("root").alias("_r"))
        jumped = state.join(ahead, F.col("root") == F.col("_w"), "left")
        state = stored(jumped.select("word", F.coalesce("_r", "root").alias("root"), F.col("_r").isNotNull().alias("moved")), f"spelling-roots-{step}")
        if not state.where("moved").limit(1).count():
            return state.drop("moved")


def variants(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, ratio: int = FORM_RATIO) -> DataFrame:
    """word, n, n_near, form, form_n, root for every word of the vocabulary of docs."""
    words = stored(vocabulary(docs, least_length, least_count), "spelling-words")
    pairs = near_pairs(words)
    side = lambda w, n, o, m: F.struct(F.col(w).alias("word"), F.col(n).alias("n"), F.col(o).alias("other"), F.col(m).alias("m"))
    both = pairs.select(F.explode(F.array(side("a", "n_a", "b", "n_b"), side("b", "n_b", "a", "n_a"))).alias("p")).select("p.*")
    best = F.min(F.struct((-F.col("m")).alias("m"), F.col("other").alias("other")))
    near = both.groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    takes = -F.col("best.m") >= ratio * F.col("n")
    near = stored(
        near.select("word", "n_near", F.when(takes, F.col("best.other")).alias("form"), F.when(takes, -F.col("best.m")).alias("form_n")), "spelling-near"
    )
    rooted = roots(near.where(F.col("form").isNotNull()))
    named = near.withColumnRenamed("word", "_w").join(rooted.select(F.col("word").alias("_v"), F.col("root")), F.col("_w") == F.col("_v"), "left").drop("_v")
    return words.join(named, F.col("word") == F.col("_w"), "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form", "form_n", F.coalesce("root", "word").alias("root")
    )


def oracle_sql(least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, ratio: int = FORM_RATIO) -> str:
    """The same as DuckDB SQL: near words by the text around each position."""
    cut = "substring(run, 1, (h % length(run))::int) || substring(run, (h % length(run))::int + 2)"
    around = "substring(word, 1, i::int) || chr(0) || substring(word, i::int + 2)"
    without = "substring(word, 1, i::int) || substring(word, i::int + 2)"
    return f"""
with recursive runs as (select doc_id, translate(unnest(regexp_extract_all(text, '{RUN}')), '{UPPER}', '{LOWER}') as run from documents),
hashed as (select run, {crc32("coalesce(doc_id::varchar, '') || ':' || run")} as h from runs),
words as (
  select word, count(*) as n from (select case when h % {DAMAGE} = 0 then {cut} else run end as word from hashed)
  where length(word) >= {least_length} group by word having count(*) >= {least_count}),
places as (select word, n, unnest(range(length(word))) as i from words),
replaced as (select word, n, i, {around} as k from places),
deleted as (select distinct word, n, {without} as k from places),
near as (
  select distinct * from (
    select a.word, a.n, b.word as other, b.n as m from replaced a join replaced b using (i, k) where a.word <> b.word
    union all select d.word, d.n, w.word, w.n from deleted d join words w on d.k = w.word
    union all select w.word, w.n, d.word, d.n from deleted d join words w on d.k = w.word)),
best as (
  select word, count(*) as n_near, (arg_min(struct_pack(other := other, m := m), struct_pack(m := -m, other := other))) as best from near group by word),
formed as (
  select w.word, w.n, coalesce(n_near, 0) as n_near, case when best.m >= {ratio} * n then best.other end as form, case when best.m >= {ratio} * n then best.m end as form_n
  from words w left join best using (word)),
chain as (
  select word, word as at, form as next from formed
  union all select c.word, c.next, f.form from chain c join formed f on c.next = f.word)
select f.word, f.n, f.n_near, f.form, f.form_n, c.at as root from formed f join chain c on c.word = f.word and c.next is null"""
