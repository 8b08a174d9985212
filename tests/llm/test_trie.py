"""The conversation trie against one built turn by turn, and the z-fast search against plain walking."""

import hashlib
import random
import zlib

import pytest

import __spark_entry__ as contract
from riskbook.llm import trie
from tests.conftest import SF_SMALL
from tests.oracle_harness import compare, duck_connect

SCHEMA = "conv_id long, turn long, role string, text string, depth int, cp string"


def by_hand(rows):
    own = {}
    for c, t, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((t is not None, t or 0, role or "", hashlib.md5((text or "").encode()).hexdigest(), text or ""))
    own = {c: [(x[2], x[4]) for x in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        rebuilt[c] = own.get(base, [])[:h] + turns[h:]
    members = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    kids, out = {}, set()
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids.get(p, [])) or 1
        saved[p] = sum(saved[k] for k in kids.get(p, [])) + (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
        ends = ",".join(str(c) for c in sorted(members[p]) if len(rebuilt[c]) == len(p))
        out.add((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(kids.get(p, [])), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def random_rows(seed, convs=140, long=0):
    rng = random.Random(seed)
    rows = []
    for c in range(-30, convs):
        if rng.random() < 0.15:
            continue
        for t in range(rng.randrange(1, 9) + (long if c % 50 == 7 else 0)):
            rows.append((c, t, rng.choice(["user", "assistant", None]), rng.choice(["hi", "yes", "héllo", "", None])))
    rows += [(None, 1, "user", "lost"), (3, None, "user", "first"), (3, 1, "a", "b"), (3, 1, "a", "a")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("seed,long", [(1, 0), (2, 60)])
def test_trie_by_hand(spark, seed, long):
    rows = random_rows(seed, long=long)
    got = [tuple(r) for r in trie.prefix_trie(frame(spark, rows)).collect()]
    assert len(got) == len(set(got))
    assert set(got) == by_hand(rows)


def test_small_batches_long_paths_and_chunks_give_the_same(spark, monkeypatch):
    rows = random_rows(4, long=20) + [(c, t, "user", "same") for c in range(500, 560) for t in range(3)]
    monkeypatch.setattr(trie, "BATCH_ROWS", 40)
    monkeypatch.setattr(trie, "LONG", 8)
    monkeypatch.setattr(trie, "ENDS", 4)
    assert {tuple(r) for r in trie.prefix_trie(frame(spark, rows)).collect()} == by_hand(rows)


def test_handles():
    for top in range(0, 40):
        for extent in range(top + 1, 80):
            h = trie.handle(top, extent)
            assert top < h <= extent
            assert all((h & -h) >= (x & -x) for x in range(top + 1, extent + 1))
    assert trie.handle(-1, 0) == 0


def test_exit_nodes_and_probes():
    rng = random.Random(8)
    paths, hashes = [], {}
    for _ in range(300):
        base = list(rng.choice(paths)) if paths and rng.random() < 0.7 else []
        base = base[: rng.randrange(len(base) + 1)] + [rng.randrange(3) for _ in range(rng.randrange(1, 40))]
        paths.append(base)
    digest = lambda p: [hashes.setdefault(tuple(p[:d]), (d, len(hashes))) for d in range(len(p) + 1)]
    digests = [digest(p) for p in paths]
    built = trie.ZFastTrie(digests)
    known = {tuple(p[:d]) for p in paths for d in range(len(p) + 1)}
    longest = max(map(len, paths))
    for _ in range(300):
        q = list(rng.choice(paths))
        q = q[: rng.randrange(len(q) + 1)] + [rng.randrange(4) for _ in range(rng.randrange(6))]
        built.probes = 0
        node, depth = built.exit_node(digest(q))
        assert depth == max(d for d in range(len(q) + 1) if tuple(q[:d]) in known)
        assert node.top < depth <= node.extent or depth == 0
        assert built.probes <= longest.bit_length() + 2


def test_defined_cases(spark):
    assert trie.prefix_trie(frame(spark, [(1, 1, "a", "b")]).limit(0)).count() == 0
    assert trie.prefix_trie(frame(spark, [(None, 1, "a", "b")])).count() == 0
    rows = [(101, 0, "user", "x" * 50000), (101, 0, "user", "x" * 50000), (7, 2, None, None)]
    assert {tuple(r) for r in trie.prefix_trie(frame(spark, rows)).collect()} == by_hand(rows)


def test_query_matches_its_sql(spark):
    name = "op12_conversation_trie"
    r = compare(spark, name, SF_SMALL, contract.queries()[name], contract.oracle_sql()[name], duck_connect(SF_SMALL))
    assert r["status"] == "match", r
