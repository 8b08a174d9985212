"""Packing documents into sequences with a grouping genetic algorithm on islands.

Documents become token pieces (longer ones are cut into full sequences, the
first piece takes the remainder); full pieces are sequences of their own. The
rest is dealt at random to islands of a fixed expected number of pieces, so
work grows with the data and no island grows with any key. An island evolves a
few packings: crossover injects the well-filled sequences of one parent into the
other, removes the sequences that held the same documents, and best-fits the
displaced documents. Pieces of equal length are interchangeable, so a packing is
a list of length patterns, and a pattern bred on one island can be injected on
any other.

An epoch has rounds: after each, an island's fullest patterns migrate to the next island of the ring
(the last one's to the first), where they are injected into the residents' packing; pieces that they displace
are swapped into other sequences where they fill better, then best-fitted. After an epoch, sequences that are full to within
``slack`` tokens are kept, and all other pieces are dealt to new islands; the shortest pieces join
only then, as they fill any gap. So the waste is that of the last, small pool. Each round is one shuffle of narrow rows; its result is a
table in the shared folder.

Defined results: null and empty texts are one piece holding the end id alone;
repeated rows are packed once each; null ids are kept; an empty table gives no
rows. Other columns are ignored.
"""

from __future__ import annotations

import random
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskbook.llm.bpe import encoder
from riskbook.llm.common import stored
from riskbook.llm.text_arrays import runs_within, slices
from riskbook.llm.token_files import ENCODE_BYTES, with_end

SEQUENCE = 1024
END_ID = 2
ISLAND_PIECES = 4096
EPOCHS = 3
#: Unfilled tokens with which a sequence may leave the pool before the last epoch.
SLACK = 0
#: Pieces up to this length stay out of the first epoch: short pieces fill what the others leave.
HOLD_BACK = 40
POPULATION = 4
GENERATIONS = 6
#: In the last epoch, whose pool is what no epoch before could fill: a tenth of the pieces.
LAST_GENERATIONS = 48
ELITES = 64
#: Rounds of an epoch; between them each island sends its elites to the next.
ROUNDS = 2
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, vocabulary: str, sequence: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """Token pieces of all documents: doc_id, piece, start, length, ids_crc32."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for batch in batches:
            for run in slices(batch, limit=ENCODE_BYTES):
                ids, counts = with_end(*enc.encode(run.column(1)), end_id)
                raw = ids.astype("<u4").tobytes()
                n = -(-counts // sequence)
                number = runs_within(n)
                first = np.repeat(counts - sequence * (n - 1), n)
                start = np.where(number == 0, 0, first + sequence * (number - 1))
                length = np.where(number == 0, first, sequence)
                begin = np.repeat(np.cumsum(counts) - counts, n) + start
                crc = [zlib.crc32(raw[4 * b : 4 * (b + k)]) for b, k in zip(begin.tolist(), length.tolist(), strict=True)]
                doc = run.column(0).take(pa.array(np.repeat(np.arange(len(n)), n)))
                yield pa.RecordBatch.from_arrays(
                    [doc, pa.array(number, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(cut, PIECES)


Pattern = tuple[int, ...]


def best_fit(lengths: list[int], open_bins: list[Pattern], size: int) -> list[Pattern]:
    """The open bins with the lengths added, in the order given, each to the
    fullest bin that it fits, or to a new one."""
    by_room: list[list[list[int]]] = [[] for _ in range(size + 1)]
    rooms = 0  # bit r: some bin has room r
    bins = [list(b) for b in open_bins]
    for b in bins:
        room = size - sum(b)
        by_room[room].append(b)
        rooms |= 1 << room
    for length in lengths:
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            b, room = [], size
            bins.append(b)
        b.append(length)
        by_room[room - length].append(b)
        rooms |= 1 << (room - length)
    return [tuple(sorted(b, reverse=True)) for b in bins]


def swap_in(bins: list[Pattern], displaced: list[int], size: int) -> tuple[list[Pattern], list[int]]:
    """Fill the bins further: a piece makes way for a longer displaced one that still fits (the longest such, of all
    the bin's pieces). What is displaced then is shorter, so easier to place."""
    left = [0] * (size + 1)
    present = 0  # bit n: some displaced piece has length n
    for n in displaced:
        left[n] += 1
        present |= 1 << n
    out = []
    for b in bins:
        room = size - sum(b)
        if room and present:
            best, old, new = 0, 0, 0
            for x in set(b):
                fitting = present & ((2 << (x + room)) - 1)
                y = fitting.bit_length() - 1
                if y - x > best:
                    best, old, new = y - x, x, y
            if best:
                left[new] -= 1
                if not left[new]:
                    present ^= 1 << new
                left[old] += 1
                present |= 1 << old
                changed = list(b)
                changed[changed.index(old)] = new
                b = tuple(sorted(changed, reverse=True))
        out.append(b)
    return out, [n for n in range(size, 0, -1) for _ in range(left[n])]


def inject(bins: list[Pattern], into: list[Pattern], counts: np.ndarray, size: int) -> list[Pattern]:
    """Crossover: ``bins`` come whole, as far as the pieces exist; the sequences
    of ``into`` that still find all their pieces stay; the displaced are swapped in where they fill better, and best-fitted."""
    left = counts.tolist()
    child: list[Pattern] = []
    for source in (bins, into):
        for b in source:
            taken = 0
            for length in b:
                if left[length] == 0:
                    break
                left[length] -= 1
                taken += 1
            if taken == len(b):
                child.append(b)
            else:
                for length in b[:taken]:
                    left[length] += 1
    displaced = [length for length in range(size, 0, -1) for _ in range(left[length])]
    child, displaced = swap_in(child, displaced, size)
    return best_fit(displaced, child, size) if displaced else child


def fitness(bins: list[Pattern], size: int) -> tuple[int, float]:
    """Fewer sequences first, then the sum of squared fills (many full ones and a few empty ones)."""
    return -len(bins), sum((sum(b) / size) ** 2 for b in bins)


def evolve(lengths: np.ndarray, residents: list[Pattern], immigrants: list[Pattern], size: int, seed: int, generations: int = GENERATIONS) -> list[Pattern]:
    """The best packing of the pieces that the island breeds, fullest sequences first.

    ``residents`` is the island's packing of the round before, if any; falling best fit is always in the
    population, so the result never needs more sequences than that.
    """
    rng = random.Random(seed)
    counts = np.bincount(lengths, minlength=size + 1)
    order = np.sort(lengths)[::-1].tolist()
    people = [best_fit(order, [], size)]
    if residents:
        people.append(residents)
    if immigrants:
        people.append(inject(immigrants, people[-1], counts, size))
    while len(people) < POPULATION:
        # Best fit of the large pieces in falling, the others in a nearly falling order.
        noisy = sorted(order, key=lambda x: -x * rng.uniform(0.85, 1.15))
        people.append(best_fit(noisy, [], size))
    lower = -(-int(lengths.sum()) // size)
    rank = lambda b: fitness(b, size)
    people.sort(key=rank, reverse=True)
    for _ in range(generations):
        if len(people[0]) <= lower and sum(map(sum, people[0][:-1])) == (len(people[0]) - 1) * size:
            break  # all but one sequence are full
        a, b = rng.sample(range(len(people)), 2)
        full = [x for x in people[b] if size - sum(x) <= SLACK]
        rng.shuffle(full)
        child = inject(full[: max(1, len(full) * 2 // 3)], people[a], counts, size)
        # Mutation: the worst sequences are emptied, and their pieces swapped in or packed anew.
        child.sort(key=sum)
        out = max(2, len(child) // 20)
        kept, again = swap_in(child[out:], [length for x in child[:out] for length in x], size)
        child = best_fit(again, kept, size)
        if rank(child) > rank(people[-1]):
            people[-1] = child
            people.sort(key=rank, reverse=True)
    return sorted(people[0], key=sum, reverse=True)


def _patterns(items: pd.DataFrame) -> list[Pattern]:
    """The sequences that the pieces were in after the round before (none before the first)."""
    if (items["bin"] < 0).any():
        return []
    return [tuple(sorted(map(int, g), reverse=True)) for _, g in items.groupby("bin")["length"]]


def _island(size: int, round_: int, last: bool, slack: int):
    def pack(items: pd.DataFrame, elites: pd.DataFrame) -> pd.DataFrame:
        if not len(items):
            return pd.DataFrame({c: pd.Series(dtype=t) for c, t in (("island", "int64"), ("item", "int64"), ("length", "int64"), ("bin", "int32"), ("offset", "int64"), ("done", "bool"))})
        island = int(items["island"].iloc[0])
        items = items.sort_values("item", kind="stable")
        lengths = items["length"].to_numpy()
        immigrants = [tuple(int(x) for x in p) for p in sorted(map(tuple, elites["lengths"]))]
        bins = evolve(lengths, _patterns(items), immigrants, size, (round_ << 32) + island, LAST_GENERATIONS if last else GENERATIONS)
        # Hand the island's pieces to the patterns, length by length.
        flat = np.array([x for b in bins for x in b], dtype=np.int64)
        per = np.array([len(b) for b in bins])
        number = np.repeat(np.arange(len(bins)), per)
        total = np.concatenate(([0], np.cumsum(flat)))[:-1]
        first = np.cumsum(per) - per
        offset = total - np.repeat(total[first], per)
        fill = np.array([sum(b) for b in bins])
        slots, own = np.argsort(flat, kind="stable"), np.argsort(lengths, kind="stable")
        out = pd.DataFrame({"island": island, "item": items["item"].to_numpy()[own], "length": lengths[own], "bin": number[slots].astype("int32"), "offset": offset[slots]})
        out["done"] = last | (size - fill[out["bin"].to_numpy()] <= slack)
        return out

    return pack


def pack(cut: DataFrame, sequence: int = SEQUENCE, island_pieces: int = ISLAND_PIECES, epochs: int = EPOCHS, slack: int = SLACK) -> DataFrame:
    """The pieces (columns of PIECES) with sequence_id and offset."""
    spark = cut.sparkSession
    cut = stored(cut.withColumn("item", F.monotonically_increasing_id()), "pack-pieces")
    pool = cut.where(F.col("length") < sequence).select("item", "length")
    no_elites = spark.createDataFrame([], "island long, lengths array<long>")
    elites, placed = no_elites, []
    for epoch in range(epochs):
        held = pool.where(F.col("length") <= HOLD_BACK) if epoch == 0 < epochs - 1 else None
        pool = pool.where(F.col("length") > HOLD_BACK) if held is not None else pool
        islands = max(1, -(-pool.count() // island_pieces))
        dealt = pool.withColumn("island", F.pmod(F.xxhash64(F.lit(epoch), "item"), F.lit(islands))).withColumn("bin", F.lit(-1))
        # Elites of the epoch before go to the islands that there are now; within the epoch the ring has all islands.
        elites = elites.withColumn("island", F.col("island") % islands)
        for part in range(ROUNDS):
            round_, final = epoch * ROUNDS + part, epoch == epochs - 1
            evolved = _island(sequence, round_, final, slack)
            result = (
                dealt.groupBy("island").cogroup(elites.groupBy("island")).applyInPandas(evolved, "island long, item long, length long, bin int, offset long, done boolean")
            )
            result = stored(result, f"pack-round{round_}")
            dealt = result.select("item", "length", "island", "bin")
            # The fullest patterns of each island move to the next one of the ring.
            elites = (
                result.where(F.col("bin") < ELITES)
                .groupBy("island", "bin")
                .agg(F.sort_array(F.collect_list("length"), asc=False).alias("lengths"))
                .select(((F.col("island") + 1) % islands).alias("island"), "lengths")
            )
        sequence_id = ((F.lit(epoch).cast("long") * F.lit(1 << 40) + F.col("island")) * F.lit(1 << 16) + F.col("bin")).alias("sequence_id")
        placed.append(result.where("done").select("item", sequence_id, "offset"))
        pool = result.where("not done").select("item", "length")
        pool = pool.unionByName(held) if held is not None else pool
    where = placed[0]
    for more in placed[1:]:
        where = where.unionByName(more)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    full = cut.where(F.col("length") >= sequence).select(*columns[:5], (-1 - F.col("item")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return cut.where(F.col("length") < sequence).join(where, "item").select(*columns).unionByName(full)
