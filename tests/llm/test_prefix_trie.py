import hashlib
import math
import random
import zlib
from collections import defaultdict

import pytest

from tidemark.llm import prefix_trie as module
from tidemark.llm.prefix_trie import numbered_turns, prefix_trie, rebuilt

SCHEMA = "conv_id long, turn int, role string, text string, place int, conv string, depth int"


def _plain(rows):
    """The contract's rows from (conv_id, turn, role, text), with every prefix spelled out."""
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            convs[conv].append(((turn is not None, turn or 0, role, digest), (role, text)))
    own = {c: [t for _, t in sorted(turns)] for c, turns in convs.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        whole[c] = tuple(own.get(c - int(math.fmod(c, 5)), [])[:h] + turns[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(whole):
        for d in range(len(whole[c]) + 1):
            members[whole[c][:d]].append(c)
        ends[whole[c]].append(c)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, of in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(of) - 1) * (len(node[-1][1].encode()) if node else 0)
    return sorted(
        (
            of[0], len(node), members[node[:-1]][0] if node else None, len(of), children[node], leaves[node], saved[node],
            hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest(),
        )
        for node, of in members.items()
    )


def _got(spark, rows, **options):
    frame = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA).repartition(4)
    turns, sizes = rebuilt(numbered_turns(frame))
    return sorted(map(tuple, prefix_trie(turns, sizes, **options).collect()))


def _rows():
    random.seed(11)
    rows = []
    for conv in range(120):
        if conv % 17 == 3:
            continue
        copied = random.choice([None, 0, 1, 2])
        source = random.Random(copied if copied is not None else conv)
        length = source.randint(0, 14) if copied is None else 14 - conv % 3
        for turn in range(length):
            rows.append((conv * 7, turn, source.choice(["user", "assistant", None]), source.choice(["a", "é", "", None, "long " * 9])))
    rows += [(5, 1, "user", "only")]  # its group's first conversation has more turns than it
    rows += [(1000, 1, "user", "one"), (1001, 1, "user", "one"), (1002, None, "user", "null first"), (1002, 0, "user", "then")]
    rows += [(2000, 1, "user", "same")] * 3 + [(2000, 1, "assistant", "tie"), (2000, 1, "assistant", "tie2")]
    rows += [(None, 1, "user", "no conversation")] * 5 + [(3001, t, "user", "x") for t in range(20)] + [(-3, 0, "user", "below zero")]
    rows += [(c, 0, "user", "a") for c in range(9_000, 9_060)]
    return rows


@pytest.mark.parametrize("block, stretch, bits", [(4, 1024, 10), (1, 2, 1), (3, 3, 3)])
def test_nodes_match_spelled_out_prefixes(spark, monkeypatch, block, stretch, bits):
    monkeypatch.setattr(module, "STRETCH", stretch)
    monkeypatch.setattr(module, "PIECE_BITS", bits)
    rows = _rows()
    assert _got(spark, rows, block=block) == _plain(rows)


def test_chain_of_conversations(spark):
    """Each conversation goes on where the one before ends: the tree of conversations is a path."""
    turns = [(conv, place) for conv in range(40) for place in range(1, conv + 1)]
    frame = spark.createDataFrame(turns, "conv long, place long").selectExpr(
        "conv", "place", "unhex(sha2(cast(place as string), 256)) as digest", "place as n_bytes"
    )
    sizes = spark.createDataFrame([(c, c) for c in range(40)], "conv long, size long")
    got = {r["depth"]: r for r in prefix_trie(frame, sizes).collect()}
    assert sorted(got) == list(range(40))
    for d, row in got.items():
        assert (row["conv_id"], row["parent_conv_id"], row["n_convs"]) == (d, d - 1 if d else None, 40 - d)
        assert (row["n_leaves"], row["n_children"]) == (1, int(d < 39))
        assert row["saved_tokens"] == sum((39 - i) * i for i in range(d, 40))


def test_no_conversations(spark):
    assert _got(spark, []) == []
    assert _got(spark, [(None, 1, "user", "x")]) == []
    one = _got(spark, [(4, 1, None, None)])
    assert one == _plain([(4, 1, None, None)]) and one[0][:4] == (4, 0, None, 1)
