import hashlib
import random
import zlib

import pytest
from compare import compare, duck

from alvara.llm import prefix_trie as pt

KIND = "conv_id long, turn long, role string, text string"


def slow(rows):
    """rows: (conv_id, turn, role, text); turns of a conversation have distinct numbers."""
    own = {}
    for conv, turn, role, text in sorted(
            (r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        own.setdefault(conv, []).append((role or "", text or ""))
    made = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        made[c] = tuple(own.get(c - c % 5, [])[:h] + own[c][h:])
    members, ends = {}, {}
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
        ends.setdefault(turns, []).append(c)
    below = {k: [x for x in members if x[:len(k)] == k] for k in members}
    kids = {k: sum(len(x) == len(k) + 1 for x in below[k]) for k in members}
    out = []
    for k, convs in members.items():
        ids = ",".join(map(str, sorted(ends.get(k, []))))
        out.append((
            min(convs), len(k), min(members[k[:-1]]) if k else None, len(convs), kids[k],
            sum(not kids[x] for x in below[k]),
            sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in below[k] if x),
            hashlib.sha256(ids.encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(seed, convs=60, most=9):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        n = rng.choice([1, 2, most, most])
        script = rng.randrange(4)
        for t in range(n):
            text = rng.choice(["a", "bé"]) if rng.random() < 0.15 else f"line {script} {t}"
            rows.append((c, None if t == 0 and rng.random() < 0.3 else t, rng.choice(["u", "u", None]), text))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block, chunk", [(1024, 65536), (1024, 40), (3, 60)])
def test_against_brute_force(spark, block, chunk):
    rows = rows_of(block)
    got = pt.prefix_trie(spark.createDataFrame(rows, KIND), block, chunk)
    assert sorted((tuple(r) for r in got.collect()), key=str) == slow(rows)


def test_long_and_large(spark):
    rows = [(c, t, "u", f"{t}") for c in (0, 5, 10, 15) for t in range(150)] + [(5, 150, "u", "x" * 100_000)]
    got = pt.prefix_trie(spark.createDataFrame(rows, KIND), 64, 200)
    assert sorted((tuple(r) for r in got.collect()), key=str) == slow(rows)


def test_many_copies(spark, monkeypatch):
    monkeypatch.setattr(pt, "IDS", 7)
    rows = [(5 * c, t, "u", f"{t}") for c in range(60) for t in range(3)]
    got = pt.prefix_trie(spark.createDataFrame(rows, KIND))
    assert sorted((tuple(r) for r in got.collect()), key=str) == slow(rows)


def test_odd_rows(spark):
    odd = [(None, 1, "u", "lost"), (0, None, None, None), (5, 1, "u", "x"), (5, 1, "u", "x"), (5, 1, "u", "a"),
           (11, 0, None, ""), (13, 2, "u", "only")]
    frame = spark.createDataFrame([(*r, i, "t") for i, r in enumerate(odd)], KIND + ", at long, TURN_KEY string")
    nodes = {(r["conv_id"], r["depth"]): r for r in pt.prefix_trie(frame).collect()}
    assert nodes[0, 0]["n_convs"] == 4 and nodes[0, 0]["parent_conv_id"] is None
    # rows of equal turn follow each other by digest, so repeated ones stay together
    assert nodes[5, 3]["n_convs"] == 1 and (5, 4) not in nodes
    again = {(r["conv_id"], r["depth"]): r for r in pt.prefix_trie(frame.repartition(5)).collect()}
    assert again == nodes
    empty = pt.prefix_trie(spark.createDataFrame([], KIND))
    assert empty.columns == list(nodes[0, 0].asDict()) and empty.count() == 0


def test_query_against_sql(spark):
    folder = "/root/testdata/sf0.01"
    assert compare(pt.op11_prefix_trie(spark, folder), duck(folder), pt.OP11_SQL) is None
