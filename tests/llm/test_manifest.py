"""The Merkle manifest against a plain version."""

import hashlib
import zlib

import pytest
from compare import DATA, difference, oracle_connection

from tsubo.llm import manifest, queries

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, at STRING, h STRING, path STRING, key STRING, before INT, _tie INT"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", None, "x", "y", "z", None, 1, 2) for i, t, lang in rows], SCHEMA)


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def lower(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def climb(leaves):
    """Root and, per leaf, its (before, after) of each level."""
    ways, nodes, owner = [[] for _ in leaves], list(leaves), [[i] for i in range(len(leaves))]
    while len(nodes) > 1:
        up, own = [], []
        for a in range(0, len(nodes), 8):
            run = nodes[a : a + 8]
            for k in range(len(run)):
                for i in owner[a + k]:
                    ways[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
            up.append(H(*run))
            own.append([i for o in owner[a : a + 8] for i in o])
        nodes, owner = up, own
    return nodes[0], ways


def plain(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of every row, sorted."""
    keyed = {}
    for i, t, lang in rows:
        leaf = H(field(i), field("s"), field(lang), "-", field(t))
        now = lower(t) if i is not None and zlib.crc32(str(i).encode()) % 3 == 0 else t
        keyed.setdefault(lang, []).append(((i is not None, i or 0, leaf), leaf, H(field(i), field("s"), field(lang), "-", field(now)), i))
    langs = sorted(keyed, key=lambda x: (x is not None, (x or "").encode()))
    trees = {lang: climb([x[1] for x in sorted(keyed[lang], key=lambda x: x[0])]) for lang in langs}
    root, over = climb([trees[lang][0] for lang in langs])
    out = []
    for place, lang in enumerate(langs):
        for at, (_, leaf, h, i) in enumerate(sorted(keyed[lang], key=lambda x: x[0])):
            way = trees[lang][1][at] + over[place]
            for before, after in way:
                h = H(before, h, after)
            out.append((i, leaf, trees[lang][0], root, H(*(b + a for b, a in way)), h, h == root))
    return sorted(out, key=str)


def found(spark, rows):
    return sorted((tuple(r) for r in manifest.document_proofs(documents(spark, rows)).collect()), key=str)


def test_rows_against_a_plain_tree(spark):
    rows = [(i, f"Text Number {i}", "en") for i in range(700)] + [(i, "É Ab", "é") for i in range(900, 909)] + [(5000, "ONE", "z")]
    rows += [(None, "A", "en"), (None, None, None), (3, "Other", "en"), (3, "Other", "en"), (-4, "", None), (7, "x" * 100_000 + "Y", "de")]
    got = found(spark, rows)
    assert got == plain(rows)
    assert {r[6] for r in got} == {True, False}


@pytest.mark.parametrize("n", [1, 2, 8, 9, 65])
def test_run_lengths(spark, n):
    rows = [(i, "Aa", "en") for i in range(n)]
    assert found(spark, rows) == plain(rows)


def test_many_keys_and_none(spark):
    rows = [(i, "Aa", f"l{i % 70}") for i in range(150)]
    assert found(spark, rows) == plain(rows)
    empty = manifest.document_proofs(documents(spark, []))
    assert empty.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"] and empty.count() == 0


def test_large_path_tables_are_joined_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(manifest, "attach", lambda *a: attach(*a, broadcast_bytes=0))
    from tsubo.operators.lookup import attach

    rows = [(i, f"Text {i}", "en") for i in range(100)] + [(1000, "a", "fr")]
    assert found(spark, rows) == plain(rows)


def test_query_against_its_sql(spark):
    folder = f"{DATA}/sf0.001"
    rows = queries.op12_merkle_manifest(spark, folder).toPandas()
    assert difference(rows, oracle_connection(folder).execute(queries.ORACLES["op12_merkle_manifest"]).df()) == ""
