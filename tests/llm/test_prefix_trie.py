"""The prefix trie against plain sets of prefixes."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from compare import DATA, difference, oracle_connection

from tsubo.llm import prefix_trie, queries

SCHEMA = "conv_id BIGINT, turn BIGINT, role STRING, text STRING, left INT, at STRING, d INT, words STRING"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def conversations(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2, "y") for r in rows], SCHEMA)


def digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]


def plain(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append(((turn is not None, turn or 0, digest(role or "", text or "")), (role or "", text or "")))
    own = {c: [x for _, x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, seq in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(own.get(c - c % 20, [])[:h] + seq[h:])
    members = {}
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
    kids = {}
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = kids.get(node, [])
        leaves[node] = sum(leaves[k] for k in below) or 1
        saved[node] = (len(members[node]) - 1) * len(WORD.findall(node[-1][1]) if node else []) + sum(saved[k] for k in below)
    out = []
    for node, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(built[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(m), len(node), parent, len(m), len(kids.get(node, [])), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows, size):
    return sorted((tuple(r) for r in prefix_trie.shared_prefixes(conversations(spark, rows), size).select(COLUMNS).collect()), key=str)


def random_rows(seed, families=4):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(families * 20), families * 12):
        copied = rng.random() < 0.4
        for turn in range(rng.choice([1, 2, 2, 3, 5])):
            rows.append((c, turn, "user" if turn % 2 else None, "same words here" if copied else rng.choice(["a b", "", None, "c\td", "é"])))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, size", [(1, 4096), (2, 2), (3, 3), (4, 5)])
def test_random_conversations(spark, seed, size):
    rows = random_rows(seed)
    assert found(spark, rows, size) == plain(rows)


def test_odd_conversations(spark):
    rows = [(None, 0, "user", "no id"), (-7, 0, "user", "negative"), (40, None, None, None), (40, 0, "user", "a"), (40, 0, "user", "a"), (40, 0, "system", "tie")]
    rows += [(45, 2, "user", "x"), (46, 1, "user", "y " * 100_000), (61, 0, "r", "only turn of a family without an opening one")]
    rows += [(i, 0, "user", "one turn only") for i in range(100, 130)]  # many lose their only turn
    rows += [(c, t, "user", f"turn {t}") for c in (200, 201) for t in range(300)]  # long and equal
    rows += [(c, 0, "user", "hello") for c in range(1000, 1100)]
    assert found(spark, rows, 16) == plain(rows)


def test_nothing(spark):
    for rows in ([], [(None, 0, "user", "x")]):
        out = prefix_trie.shared_prefixes(conversations(spark, rows)).select(COLUMNS)
        assert out.count() == 0 and out.columns == COLUMNS


def test_searches_against_scans():
    rng = np.random.default_rng(5)
    for n in (1, 2, 7, 64, 100):
        values = rng.integers(-1, 6, n)
        levels = prefix_trie.sparse_table(values)
        start, d = rng.integers(0, n, 200), rng.integers(0, 7, 200)
        right, left = prefix_trie.first_below(levels, start, d), prefix_trie.last_below(levels, start, d)
        for s, want, r, k in zip(start, d, right, left):
            assert r == next((i for i in range(s, n) if values[i] < want), n)
            assert k == next((i for i in range(s, -1, -1) if values[i] < want), -1)


def test_large_tables_are_joined_by_shuffle(spark, monkeypatch):
    attach = prefix_trie.attach
    monkeypatch.setattr(prefix_trie, "attach", lambda *a: attach(*a, broadcast_bytes=0))
    rows = random_rows(9)
    assert found(spark, rows, 8) == plain(rows)


def test_query_against_its_sql(spark):
    folder = f"{DATA}/sf0.001"
    rows = queries.op11_prefix_trie(spark, folder).toPandas()
    assert difference(rows, oracle_connection(folder).execute(queries.ORACLES["op11_prefix_trie"]).df()) == ""
