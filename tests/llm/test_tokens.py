"""Token ids against the library, bit packing as a round trip, token files and packing on awkward input."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from riskbook.llm import packing, token_files
from riskbook.llm.bpe import encoder
from riskbook.llm.common import prepare, table, vocabulary
from tests.conftest import SF_SMALL
from tests.llm.edge import SCHEMA, edge_docs, edge_rows


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary())


def test_encoder_equals_the_library(library):
    rng = random.Random(3)
    bits = ["'s", "'re", "'ll", " ", "  ", "\n", "\t", "a", "b'", "é", "12", "½", "!", "?'", " ", "中", "<|endoftext|>", "'", "x", "'ve'd", "\r\n", "̀", "ß", "٣", "\x1c", "\x85"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 30))) for _ in range(1500)] + [None, ""]
    ids, at = encoder(vocabulary()).encode(pa.array(texts))
    for i, t in enumerate(texts):
        assert ids[at[i] : at[i + 1]].tolist() == library.encode(t or "", add_special_tokens=False).ids, t


def test_every_plain_code_point_is_cut_like_the_library(library):
    texts = [f"a{chr(c)}b {chr(c)}1{chr(c)}  {chr(c)}" for c in range(1, 0x3000)]
    ids, at = encoder(vocabulary()).encode(pa.array(texts))
    whole = library.encode_batch(texts, add_special_tokens=False)
    assert [hex(i + 1) for i, e in enumerate(whole) if e.ids != ids[at[i] : at[i + 1]].tolist()] == []


@pytest.mark.parametrize("width", [1, 3, 8, 11, 16, 17, 23, 31])
def test_pack_round_trip_and_random_access(width):
    rng = np.random.default_rng(width)
    ids = rng.integers(0, 1 << width, 1003).astype(np.uint32)
    raw = token_files.pack(ids, width)
    assert len(raw) == -(-len(ids) * width // 8)
    assert (token_files.unpack(raw, width, 0, len(ids)) == ids).all()
    for first, n in ((0, 1), (17, 100), (1002, 1), (500, 0), (3, 1000)):
        assert (token_files.unpack(raw, width, first, n) == ids[first : first + n]).all()
    doc_ids, null, counts = np.array([4, 0, 9]), np.array([False, True, False]), np.array([400, 0, 603])
    f = token_files.TokenFile(token_files.to_file(doc_ids, null, counts, ids, width, block_ids=64))
    assert f.n_ids == 1003 and f.counts.tolist() == [400, 0, 603] and f.is_null.tolist() == [False, True, False] and f.doc_ids[[0, 2]].tolist() == [4, 9]
    assert (f.ids(60, 300) == ids[60:360]).all() and (f.ids(0, 1003) == ids).all()


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def expected_files(library, rows):
    out, at = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((doc_id, at, len(ids), crc(ids)))
        at += len(ids)
    return out


@pytest.mark.parametrize("file_ids", [500, 1 << 22])
def test_token_files_read_back(spark, library, file_ids):
    docs = edge_docs(prepare(spark))
    got = token_files.read_token_files(token_files.write_token_files(docs, vocabulary(), file_ids=file_ids)).collect()
    key = lambda r: (r[1], r[2])
    assert sorted(map(tuple, got), key=key) == sorted(expected_files(library, [r[:2] for r in edge_rows()]), key=key)


def test_token_files_of_the_table(spark, library):
    docs = table(spark, SF_SMALL, "documents")
    got = token_files.read_token_files(token_files.write_token_files(docs, vocabulary(), file_ids=20_000)).collect()
    assert sorted(map(tuple, got)) == sorted(expected_files(library, [(r.doc_id, r.text) for r in docs.collect()]))


def test_no_documents(spark):
    docs = prepare(spark).createDataFrame([], SCHEMA)
    assert token_files.read_token_files(token_files.write_token_files(docs, vocabulary())).count() == 0
    assert packing.pack(packing.pieces(docs, vocabulary())).count() == 0


def check_packing(rows, library, docs, sequence=1024):
    """Every piece once, pieces as defined, sequences gapless and within bounds."""
    expected = []
    for doc_id, text in docs:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        n = -(-len(ids) // sequence)
        start = 0
        for piece in range(n):
            length = len(ids) - sequence * (n - 1) if piece == 0 else sequence
            expected.append((doc_id, piece, start, length, crc(ids[start : start + length])))
            start += length
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted((tuple(r)[:5] for r in rows), key=key) == sorted(expected, key=key)
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= sequence
    return len(by), -(-sum(e[3] for e in expected) // sequence)


def test_packing_of_awkward_documents(spark, library):
    docs = edge_docs(prepare(spark))
    check_packing(packing.pack(packing.pieces(docs, vocabulary())).collect(), library, [r[:2] for r in edge_rows()])


def test_packing_on_several_islands_comes_near_the_bound(spark, library):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = packing.pack(packing.pieces(docs, vocabulary()), island_pieces=300).collect()
    sequences, bound = check_packing(rows, library, [(r.doc_id, r.text) for r in docs.collect()])
    assert sequences <= 1.02 * bound


def test_genetic_steps_keep_every_piece():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 1024, 700)
    counts = np.bincount(lengths, minlength=1025)
    a = packing.best_fit(sorted(lengths.tolist(), reverse=True), [], 1024)
    b = packing.best_fit(lengths.tolist(), [], 1024)
    child = packing.inject([x for x in b if sum(x) > 1000] + [(1024,) * 3], a, counts, 1024)
    for bins in (a, b, child, packing.evolve(lengths, [], [(512, 512), (1000, 24)], 1024, seed=5)):
        assert sorted(x for y in bins for x in y) == sorted(lengths.tolist()) and max(map(sum, bins)) <= 1024
    assert len(packing.evolve(lengths, [], [], 1024, seed=5)) <= len(a)


def triplets(seed=1, n=120):
    """Pieces of which three always fill a sequence exactly, and no four fit."""
    rng = np.random.default_rng(seed)
    a, b = rng.integers(260, 400, n), rng.integers(260, 400, n)
    return np.concatenate([a, b, 1024 - a - b])


def test_crossover_beats_falling_best_fit():
    lengths = triplets()
    plain = len(packing.best_fit(sorted(lengths.tolist(), reverse=True), [], 1024))
    bred = packing.evolve(lengths, [], [], 1024, seed=3, generations=60)
    assert sorted(x for b in bred for x in b) == sorted(lengths.tolist()) and all(sum(b) <= 1024 for b in bred)
    assert len(bred) < plain - 4


def test_migrated_elites_are_used():
    lengths = triplets()
    full = [tuple(sorted((int(x), int(y), int(z)), reverse=True)) for x, y, z in lengths.reshape(3, -1).T]
    without = packing.evolve(lengths, [], [], 1024, seed=3)
    residents = packing.evolve(lengths, without, full[:60], 1024, seed=4)
    assert len(set(full[:60]) & set(residents)) > len(set(full[:60]) & set(without)) + 10
    assert len(residents) < len(without)


def test_swapping_in_fills_bins():
    bins, rest = packing.swap_in([(600, 300), (1000, 24), (500,)], [400, 350, 20], 1024)
    assert bins == [(600, 400), (1000, 24), (500,)] and sorted(rest) == [20, 300, 350]


def test_rounds_send_elites_around_the_ring(spark, monkeypatch):
    """Every island but a lone one gets the patterns of its neighbour, the first from the last."""
    seen = []
    island = packing._island

    def watched(size, round_, last, slack):
        run = island(size, round_, last, slack)
        seen.append(round_)
        return run

    monkeypatch.setattr(packing, "_island", watched)
    rows = [(i, 0, 0, int(n), 0) for i, n in enumerate(triplets(n=200))]
    cut = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")
    got = packing.pack(cut, island_pieces=150).collect()
    assert seen == list(range(packing.EPOCHS * packing.ROUNDS))
    fill = {}
    for r in got:
        fill.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert len(got) == len(rows) and all(sum(n for _, n in v) <= 1024 for v in fill.values())
    assert all(o == sum(n for _, n in sorted(v)[:k]) for v in fill.values() for k, (o, _) in enumerate(sorted(v)))
