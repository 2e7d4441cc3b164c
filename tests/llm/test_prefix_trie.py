"""The prefix trie against a dictionary of all prefixes, cut into shards in many ways."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from cardfeat.llm import prefix_trie as trie
from tests.llm import brute

COLUMNS = "conv_id bigint, turn bigint, role string, text string, kind int, number string, family int, path string, depth int"


def turn_hash(role, text):
    return hashlib.sha256(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).hexdigest()[:32]


def rebuilt(rows):
    """Id -> turns, by the plain rule."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append(((turn is not None, turn or 0), turn_hash(role, text), role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    h = {c: zlib.crc32(str(c).encode()) % 9 for c in own}
    return {c: own.get(c - (abs(c) % 5 if c > 0 else -(abs(c) % 5)), [])[: h[c]] + turns[h[c] :] for c, turns in own.items()}


def expected(convs):
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, own in members.items():
        cost = (len(own) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += cost
    return sorted(
        (
            (min(own), len(node), min(members[node[:-1]]) if node else None, len(own), children.get(node, 0), leaves[node], saved[node], brute.sha(",".join(map(str, sorted(ends.get(node, []))))))
            for node, own in members.items()
        ),
        key=repr,
    )


def found(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def conversations(seed, n=120, alphabet=3, most=9):
    draw, rows = random.Random(seed), []
    for c in range(n):
        for turn in range(draw.randrange(most)):
            text = draw.choice(["a", "", "é\U0001f600", None, "long " * 9][:alphabet]) if c % 3 else "same"
            rows.append((c, turn, draw.choice(["user", None]) if c % 4 == 1 else "user", text))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2, "y", 3) for r in rows], COLUMNS)


@pytest.mark.parametrize("shard_turns", [1, 3, 20, 10_000])
def test_shards(spark, shard_turns, monkeypatch):
    monkeypatch.setattr(trie, "PIECE", 40)
    for seed in range(2):
        rows = conversations(seed)
        got = trie.prefix_trie(trie.rebuilt_paths(frame(spark, rows)), shard_turns)
        assert got.columns == trie._RESULT
        assert found(got) == expected(rebuilt(rows))


@pytest.mark.parametrize("nodes, path_bytes", [(3, 16 << 10), (10_000, 32), (8, 16)])
def test_bounds_of_the_skeleton_change_no_result(spark, monkeypatch, nodes, path_bytes):
    monkeypatch.setattr(trie, "MAX_SKELETON", nodes)
    monkeypatch.setattr(trie, "PATH_BYTES", path_bytes)
    rows = conversations(7, alphabet=2)
    paths = trie.rebuilt_paths(frame(spark, rows))
    assert len(trie._places(paths, 4)[1]) <= nodes
    assert found(trie.prefix_trie(paths, 4)) == expected(rebuilt(rows))


def test_copies_of_one_conversation_are_dealt_to_several_shards(spark):
    rows = [(c, turn, "user", f"turn {turn}") for c in range(0, 1500, 5) for turn in range(12)] + [(c, 0, "user", str(c)) for c in range(1, 300, 5)]
    paths = trie.rebuilt_paths(frame(spark, rows))
    places, skeleton = trie._places(paths, 100)
    assert len(places) > 10 and len({p[1] for p in places}) > 10 and len(skeleton) >= 13
    assert found(trie.prefix_trie(paths, 100)) == expected(rebuilt(rows))


def test_long_conversation(spark):
    rows = [(c, turn, "user", str(turn if turn < 19_000 else (c, turn))) for c in (5, 10) for turn in range(20_000)]
    got = {r["depth"]: r for r in trie.prefix_trie(trie.rebuilt_paths(frame(spark, rows))).filter("conv_id = 5").collect()}
    assert len(got) == 20_001 and got[19_000]["n_convs"] == 2 and got[19_001]["n_convs"] == 1 and got[0]["n_leaves"] == 2
    assert got[0]["saved_tokens"] == sum(len(str(k)) for k in range(19_000))


def test_edge_rows(spark):
    rows = [(5, None, "user", "first"), (5, 0, None, None), (5, 0, "user", "tie"), (5, 0, "user", "tie"), (6, 1, "a", "bc"), (6, 2, "ab", "c")]
    rows += [(None, 0, "user", "no id"), (7, 0, "user", ""), (7, 0, "", "user"), (-7, 3, "x", "y"), (-5, 0, "x", "z")]
    rows += [(9, k, "user", "w" * 100_000) for k in range(9)] + [(11, 0, "u", "family absent")]
    for shard_turns in (2, 1000):
        assert found(trie.prefix_trie(trie.rebuilt_paths(frame(spark, rows)), shard_turns)) == expected(rebuilt(rows))
    assert trie.prefix_trie(trie.rebuilt_paths(frame(spark, []))).count() == 0
    turnless = trie.prefix_trie(trie.rebuilt_paths(frame(spark, [(11, 0, "u", "shorter than the head of an absent family")])))
    assert found(turnless) == [(11, 0, None, 1, 0, 1, 0, brute.sha("11"))]


def test_plain_paths(spark):
    rows = [(1, 0, "u", "x"), (2, 0, "u", "x"), (2, 1, "a", "y")]
    got = found(trie.prefix_trie(trie.paths(trie.turn_lists(frame(spark, rows)))))
    assert got == expected({1: [("u", "x")], 2: [("u", "x"), ("a", "y")]})


def test_node_is_above_or_below_a_place_unless_it_is_a_prefix_of_it():
    draw = random.Random(2)
    turn = [bytes([k]) * 16 for k in range(3)]
    convs = sorted((b"".join(draw.choice(turn) for _ in range(draw.randrange(5))), c, 1, True) for c in range(300))
    places = trie.splitters(convs, 40)
    assert places == sorted(places) and 20 < len(places) < 40
    prefixes = {p[:k] for p, _ in places for k in range(0, len(p) + 1, 16)} | {b""}
    for path in {c[0][:k] for c in convs for k in range(0, len(c[0]) + 1, 16)}:
        shards = {sum((p, i) <= (c[0], c[1]) for p, i in places) for c in convs if c[0].startswith(path)}
        assert len(shards) == 1 or path in prefixes
