import re

import duckdb
import numpy as np
import xxhash

from alvara.llm import simhash

FOLDER = "/root/testdata/sf0.001"


def slow_print(text):
    parts = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not parts:
        return 0
    shingles = [b" ".join(parts[i:i + 3]) for i in range(len(parts) - 2)] or [b" ".join(parts)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def slow_groups(prints, radius=3):
    """prints: list of (id, fingerprint); smallest id reachable for each."""
    found = {}
    left = sorted(prints)
    while left:
        group, rest = [left[0]], left[1:]
        for _, fp in group:
            near = [x for x in rest if (x[1] ^ fp).bit_count() <= radius]
            rest = [x for x in rest if (x[1] ^ fp).bit_count() > radius]
            group += near
        found |= {x[0]: group[0][0] for x in group}
        left = rest
    return found


def test_query_equals_brute_force(spark):
    docs = duckdb.execute(f"select doc_id, text from '{FOLDER}/documents.parquet'").fetchall()
    prints = [(d, slow_print(t)) for d, t in docs]
    groups = slow_groups(prints)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.op7_simhash_near_dedup(spark, FOLDER).collect()}
    assert got == {d: (f"{fp:016x}", groups[d]) for d, fp in prints}


def test_edge_rows(spark):
    rows = [(5, None, 1), (2, "", 1), (3, " \t\n", 1), (9, "Same words here", 1), (8, "same WORDS\there", 1),
            (8, "same WORDS\there", 1), (None, "same words here", 1), (7, "É one", 1), (6, "x " * 200_000, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    got = sorted(map(tuple, simhash.simhash_groups(docs).select("doc_id", "component_id").collect()), key=str)
    assert got == sorted([(5, 2), (2, 2), (3, 2), (9, 8), (8, 8), (8, 8), (None, 8), (7, 7), (6, 6)], key=str)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([2, 8, None, 7, 6], key=str)
    assert simhash.simhash_groups(docs.where("false")).count() == 0


def test_tiles_lose_no_pair(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 60, dtype=np.uint64)
    prints = {int(b) for b in base}
    for b in base:
        for _ in range(12):
            x = int(b)
            for bit in rng.choice(64, rng.integers(0, 6), replace=False):
                x ^= 1 << int(bit)
            prints.add(x)
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in prints]
    links = simhash.near_links(spark.createDataFrame(signed, "fp long"), tile=20).collect()
    groups = slow_groups([(x, x) for x in prints])
    root = {x: x for x in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a % 2**64), find(b % 2**64)
        root[max(a, b)] = min(a, b)
    assert {x: find(x) for x in prints} == groups
