import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from formmart.llm import conversation_trie as T

SCHEMA = "conv_id long, turn long, role string, text string, key string, part int, base int"


def brute(rows, heads=8, every=5):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]
            turns[conv].append(((turn is not None, turn or 0, role, digest), (role, text)))
    own = {c: [t for _, t in sorted(v)] for c, v in turns.items()}
    rebuilt = dict(own)
    if heads:
        for c in own:
            h = zlib.crc32(str(c).encode()) % (heads + 1)
            rebuilt[c] = own.get(c - c % every, [])[:h] + own[c][h:]
    members = defaultdict(list)
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in children[node]) or 1
        saved[node] = sum(saved[k] for k in children[node])
        if node:
            saved[node] += (len(members[node]) - 1) * len(node[-1][1].encode())
    out = []
    for node, convs in members.items():
        ends = sorted(c for c in convs if len(rebuilt[c]) == len(node))
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children[node]),
                    leaves[node], saved[node], hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=repr)


def asked(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
    got = T.prefix_trie(df, **options)
    assert [c for c, _ in got.dtypes] == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                                          "saved_tokens", "ends_sha256"]
    return sorted(map(tuple, got.collect()), key=repr)


def talk(seed, n, longest=12, kinds=2):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.randrange(1, longest)):
            rows.append((c * rng.choice([1, 1, 3]), t, rng.choice(["user", "user", None]),
                         rng.choice(["a", "éé", None][:kinds + 1]) if rng.random() < .9 else f"t{c}"))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("heads", [0, 8])
@pytest.mark.parametrize("seed,n,longest", [(1, 60, 12), (2, 200, 5), (3, 9, 40)])
def test_against_brute_force(spark, monkeypatch, seed, n, longest, heads):
    monkeypatch.setattr(T, "PIECE_TURNS", 3)
    monkeypatch.setattr(T, "PIECE_IDS", 2)
    monkeypatch.setattr(T, "OPEN", 4)
    rows = talk(seed, n, longest)
    assert asked(spark, rows, heads=heads) == brute(rows, heads)


def test_many_ranges_are_merged_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(T, "FAN", 2)
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = talk(5, 150, 9)
        rows += [(1000 + i, t, "user", "copy") for i in range(60) for t in range(6)]      # a third are copies
        rows += [(2000 + i, t, "user", "first" if t == 0 else f"{i}") for i in range(40) for t in range(2)]
        assert asked(spark, rows, heads=0) == brute(rows, 0)
        assert asked(spark, rows, heads=8) == brute(rows, 8)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_odd_rows(spark):
    rows = [(None, 1, "user", "lost"), (1, None, None, None), (1, None, None, None), (1, 2, "", "x" * 5000), (6, 1, "a", "bc"),
            (7, 1, "ab", "c"), (2, 5, "user", "日本"), (2, 5, "user", "日本"), (-3, 1, "user", "neg"), (10, 0, "", "")]
    for heads in (0, 8):
        assert asked(spark, rows, heads=heads) == brute(rows, heads)
    assert asked(spark, []) == []
    assert asked(spark, [(None, 1, "a", "b")]) == []


def test_contraction_gives_the_same_nodes_wherever_it_is_cut():
    """Random words of two letters, contracted whole and in all pairs of cuts."""
    import numpy as np

    rng = random.Random(4)
    for _ in range(40):
        chains = sorted({b"".join(hashlib.md5(w[:i + 1].encode()).digest() for i in range(len(w)))
                         for w in ("".join(rng.choice("ab") for _ in range(rng.randrange(7))) for _ in range(12))})
        parts = [T.Component.of(c, np.arange(len(c) // 16 + 1), i, 1 + i % 3) for i, c in enumerate(chains)]
        edges = [T.shared(a, b) for a, b in zip(chains, chains[1:])]
        want = []
        last, _ = T.contract(parts, edges, want.append, closed=True)
        want.append(last[0].finished(None, -1))
        for cut in range(1, len(parts)):
            got = []
            a, ea = T.contract(parts[:cut], edges[:cut - 1], got.append)
            b, eb = T.contract(parts[cut:], edges[cut:], got.append)
            assert max(len(a), len(b)) <= 2 * 7 + 2
            last, _ = T.contract(a + b, [*ea, edges[cut - 1], *eb], got.append, closed=True)
            assert sorted(got + [last[0].finished(None, -1)], key=repr) == sorted(want, key=repr)
