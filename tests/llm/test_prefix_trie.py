"""The burst trie against a trie of Python dictionaries."""

import hashlib
import random
import re
import zlib

import pytest

from tidemark.llm import prefix_trie as module
from tidemark.llm.prefix_trie import NODE_COLUMNS, prefix_trie, rebuilt, shared_turns

SCHEMA = "conv_id long, turn long, role string, text string, box string, k int, level int, n long, head string"


def truth(rows):
    by_conv = {}
    for c, turn, role, text in rows:
        if c is not None:
            by_conv.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {}
    for c, turns in by_conv.items():
        ids = {t: hashlib.md5(f"{len(t[2].encode())}:{t[2]}{t[3]}".encode()).hexdigest() for t in turns}
        own[c] = [t[2:] for t in sorted(turns, key=lambda t: (*t[:2], ids[t]))]
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        donor = c - int(c - 20 * int(c / 20))
        built[c] = [*own.get(donor, [])[:h], *turns[h:]]
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    nodes = {p: {"n": len(m), "conv": min(m), "kids": 0, "leaves": 0, "saved": 0, "ends": sorted(c for c in m if len(built[c]) == len(p))} for p, m in members.items()}
    for p in sorted(nodes, key=len, reverse=True):
        node = nodes[p]
        node["leaves"] = node["leaves"] or 1
        node["saved"] += (node["n"] - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        if p:
            up = nodes[p[:-1]]
            up["kids"] += 1
            up["leaves"] += node["leaves"]
            up["saved"] += node["saved"]
    for p, x in nodes.items():
        yield x["conv"], len(p), nodes[p[:-1]]["conv"] if p else None, x["n"], x["kids"], x["leaves"], x["saved"], hashlib.sha256(",".join(map(str, x["ends"])).encode()).hexdigest()


def some_rows():
    rng = random.Random(0)
    rows = []
    for c in [*range(-25, 90), 400, 2**60 + 5]:
        for t in range(rng.choice([1, 2, 3, 5, 9])):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", rng.choice(["yes", "no", "tell me  more\tnow", ""])))
    for c in range(100, 140):  # copies of a long conversation, some cut short, some going on
        rows += [(c, t, "user", f"turn {t}") for t in range(40 + (c % 3 == 0) * 7 - (c % 5 == 0) * 30)]
    rows += [(200, None, None, None), (200, None, "user", "b"), (200, 0, "user", ""), (200, 0, "", "user"), (200, 0, "user", "")]
    rows += [(None, 0, "user", "nobody"), (201, 5, "é", "  　 ünï"), (202, 0, "a", "x" * 50_000)]
    return rows


@pytest.fixture(scope="module")
def expected():
    return sorted(truth(some_rows()), key=repr)


@pytest.fixture(scope="module")
def conversations(spark):
    """Columns that clash with names inside the operator stand beside the turns."""
    return spark.createDataFrame([(*r, "b", 1, 2, 3, "h") for r in some_rows()], SCHEMA).repartition(4)


@pytest.mark.parametrize(("block", "limit"), [(1024, 8192), (1024, 60), (4, 5), (16, 100)])
def test_against_dictionaries(conversations, rows, expected, block, limit):
    """Whole, with containers that burst, and with conversations of several blocks."""
    trie = prefix_trie(*rebuilt(conversations), block, limit)
    assert trie.columns == NODE_COLUMNS and all(t == "bigint" for _, t in trie.dtypes[:-1])
    assert rows(trie) == expected


def test_one_group_of_most_members(conversations, rows, monkeypatch):
    """Ids of a group are hashed in order across rows of few ids."""
    monkeypatch.setattr(module, "MEMBERS", 2)
    ids = conversations.sparkSession.range(-50, 1000).selectExpr("if(id % 3 = 0, 'a', 'b') key", "id conv_id").repartition(7)
    want = {k: ",".join(str(i) for i in range(-50, 1000) if (i % 3 == 0) == (k == "a")) for k in "ab"}
    assert rows(module.member_digests(ids)) == [(k, hashlib.sha256(v.encode()).hexdigest()) for k, v in want.items()]


def test_a_container_is_divided_every_round(spark, monkeypatch):
    """Suffixes that agree over many turns burst where they part, not turn by turn."""
    rows = [(c, t, "user", f"{t}" if t < 300 else f"{t} {c}") for c in range(20, 28) for t in range(302)]
    calls = []
    real = module.heads_of
    monkeypatch.setattr(module, "heads_of", lambda *a: calls.append(1) or real(*a))
    df = spark.createDataFrame([(*r, "b", 1, 2, 3, "h") for r in rows], SCHEMA)
    trie = prefix_trie(*rebuilt(df), limit=400)
    assert trie.count() == len(list(truth(rows)))
    assert len(calls) <= 3


def test_shared_turns():
    assert shared_turns(b"a" * 16 + b"b" * 16, b"a" * 16 + b"c" * 16, 0) == 1
    assert shared_turns(b"", b"a" * 16, 0) == 0


def test_no_conversation(conversations):
    assert prefix_trie(*rebuilt(conversations.limit(0))).isEmpty()
    assert prefix_trie(*rebuilt(conversations.where("conv_id is null"))).isEmpty()
