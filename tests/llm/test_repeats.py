"""Collection sorting and removal of repeated strings against brute force."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from riskbook.llm import repeats
from riskbook.llm.collection_bwt import suffix_order
from riskbook.llm.common import prepare, table
from tests.conftest import SF_SMALL
from tests.llm.edge import SCHEMA, edge_docs, edge_rows


def test_suffix_order_and_common_prefixes():
    rng = random.Random(1)
    for _ in range(150):
        strings = [bytes(rng.choice(b"ab\x00\xff"[: rng.randint(1, 4)]) for _ in range(rng.randint(0, 14))) for _ in range(rng.randint(1, 9))]
        offsets = np.cumsum([0, *map(len, strings)])
        owner, length, shared = suffix_order(np.frombuffer(b"".join(strings), np.uint8), offsets)
        got = [strings[i][len(strings[i]) - n :] for i, n in zip(owner.tolist(), length.tolist(), strict=True)]
        assert got == sorted(s[k:] for s in strings for k in range(len(s) + 1))
        for x, y, n in zip(got, got[1:], shared.tolist()[1:], strict=False):
            same = next((i for i, (a, b) in enumerate(zip(x, y, strict=False)) if a != b), min(len(x), len(y)))
            assert n == same


def brute(rows, length):
    """rows (doc_id, text) without repeated ids; sorted by id, null last."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            w = raw[p : p + length]
            if w in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(w)
        kept = bytes(c for c, g in zip(raw, gone, strict=True) if not g)
        spans = sum(1 for p in range(len(raw)) if gone[p] and not (p and gone[p - 1]))
        out[doc_id] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept)
    return out


def result(docs, **options):
    rows = repeats.remove_repeats(docs, **options).collect()
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) for r in rows}, len(rows)


def test_table_against_brute_force(spark):
    docs = table(spark, SF_SMALL, "documents")
    got, _ = result(docs)
    expected = brute([(r.doc_id, r.text) for r in docs.collect()], 100)
    assert got == expected and sum(v[1] for v in expected.values()) > 1000


def periodic(rng):
    passage = "".join(rng.choice("abcd") for _ in range(60))
    texts = []
    for i in range(60):
        kind = rng.randint(0, 5)
        own = "".join(rng.choice("abcdé ") for _ in range(rng.randint(0, 90)))
        texts.append((i * 3, [own, passage + own, own + passage[5:50] + own, "ab" * rng.randint(0, 60), own[:20] + "z" * rng.randint(0, 80), texts[-1][1] if texts else ""][kind]))
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize(("seed", "options"), [(1, {}), (2, {"block": 3}), (3, {"largest_group": 2})])
def test_small_alphabets_and_all_ways(spark, seed, options):
    """Periodic texts, copies, shared passages; tiny blocks, and the way for large groups."""
    rows = periodic(random.Random(seed))
    docs = prepare(spark).createDataFrame(rows, "doc_id long, text string").repartition(4)
    got, _ = result(docs, length=20, gram=6, **options)
    assert got == brute(rows, 20)


def test_segments_of_long_rows(monkeypatch):
    rng = random.Random(4)
    texts = ["".join(rng.choice("abc") for _ in range(n)) for n in (700, 5, 0, 333)]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    covered = lambda parts: sorted((int(r), int(s) + k) for r, s, n in zip(*parts[2:], strict=True) for k in range(int(n)))
    whole = repeats.anchors(data, offsets, 20, 6)
    monkeypatch.setattr(repeats, "SEGMENT", 64)
    cut = repeats.anchors(data, offsets, 20, 6)
    assert covered(whole) == covered(cut) == [(i, int(offsets[i]) + p) for i, t in enumerate(texts) for p in range(max(0, len(t) - 19))]


def test_fragments_that_share_the_anchor_alone_are_not_sorted(monkeypatch):
    """Every shared string is within the bytes kept; chance neighbours and bytes beside shared ones are left out."""
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abcdefghij") for _ in range(n))
    common = word(12)
    passage = word(30)
    texts = [word(14) + common + word(14) for _ in range(40)] + [word(40) + passage + word(40) for _ in range(3)]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    h, _, _, at, n = repeats.anchors(data, offsets, 20, 6)
    order = np.argsort(h, kind="stable")
    h, at, n = h[order], at[order], n[order]
    pieces = [data[a : a + k + 19].tobytes() for a, k in zip(at.tolist(), n.tolist(), strict=True)]
    ends = np.cumsum([0, *map(len, pieces)])
    use, first, size = repeats.comparable(h, np.frombuffer(b"".join(pieces), np.uint8), ends, 20, 6)
    holders = {}
    for i, piece in enumerate(pieces):
        for p in range(len(piece) - 19):
            holders.setdefault(piece[p : p + 20], []).append((i, p))
    kept = {i: (a, a + s - 20) for i, a, s in zip(use.tolist(), first.tolist(), size.tolist(), strict=True)}
    shared = [x for found in holders.values() if len(found) > 1 for x in found]
    assert len(shared) == 3 * 11 and all(kept[i][0] <= p <= kept[i][1] for i, p in shared)
    alike = np.unique(h, return_inverse=True, return_counts=True)
    assert (alike[2][alike[1]] > 1).sum() >= 20 and len(kept) <= 9  # those at the passage's ends share a window, but no string

    sorted_bytes = []
    monkeypatch.setattr(repeats, "suffix_order", lambda data, offsets: sorted_bytes.append(len(data)) or suffix_order(data, offsets))
    rows = np.arange(len(h))
    batch = pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(rows), pa.array(0 * rows), pa.array((0 * rows).astype(np.int32)), pa.array(pieces, pa.binary())], names=["h", "node", "variant", "start", "bytes"])
    found = pa.Table.from_batches(repeats._sort_blocks(20, 6, 8)(iter([batch])))
    assert sum(found.column("n").to_pylist()) == 2 * 11  # the earliest of three stays
    assert 0 < sum(sorted_bytes) < ends[-1] // 10


def test_awkward_documents(spark):
    got, n = result(edge_docs(prepare(spark)))
    rows = edge_rows()
    assert n == len(rows)
    one = {}
    for r in rows:
        one.setdefault(r[0], r[1])
    one[None] = rows[3][1]
    expected = brute(list(one.items()), 100)
    for doc_id in (1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11):
        assert got[doc_id] == expected[doc_id], doc_id
    assert got[6][1] == got[6][0] > 100 and got[5][1] < got[5][0]
    assert result(prepare(spark).createDataFrame([], SCHEMA))[1] == 0
