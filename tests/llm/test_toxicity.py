"""The factorization machine against plain sums, on pairs of terms, and on odd input."""

import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tsubo.llm import toxicity
from tsubo.llm.byte_hash import Hasher

ODD = [None, "", " \n", "one", "É" * 3, "x" * 5000, "IDIOT idiot Idiots", "\x00 nul", "a-b_c"]
DOCS = "doc_id BIGINT, text STRING, lang STRING, score STRING, toxic INT, k INT"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, None, "x", None, 1) for i, t in rows], DOCS)


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id BIGINT, toxic INT")


def plain_terms(text):
    def bucket(s, kind):
        data = np.frombuffer(s.encode(), np.uint8)
        return int(toxicity._bucket(Hasher(data).ranges(np.array([0]), np.array([len(data)])), kind)[0])

    found = set()
    for word in re.findall(r"[0-9A-Za-z\u0080-\U0010ffff]+", (text or "").lower()):
        found.add(bucket(word, 0))
        found |= {bucket(word[:k], k) for k in toxicity.BEGINNINGS if len(word) > k}
    return sorted(found)


@pytest.mark.parametrize("size", [64, 1 << 19])
def test_terms_against_a_plain_version(monkeypatch, size):
    monkeypatch.setattr(toxicity, "CHUNK_BYTES", size)
    rng = random.Random(1)
    texts = ODD + [" ".join(rng.choice(["Über", "idiots", "ñandúes", "a", "worthlessness", "x1"]) + rng.choice(["", ".", "!é"]) for _ in range(rng.randrange(60))) for _ in range(40)]
    got, at = {}, 0
    for rows, row, bucket in toxicity.row_terms(pa.array(texts, pa.string()).slice(0)):
        for i in range(rows):
            got[at + i] = bucket[row == i].tolist()
        at += rows
    assert at == len(texts)
    for i, text in enumerate(texts):
        assert got[i] == plain_terms(text), text


def test_margins_against_all_pairs():
    rng = np.random.default_rng(2)
    machine = toxicity.Machine(np.zeros(1), 0.3, rng.normal(size=20), rng.normal(size=(20, 4)))
    sets = [sorted(rng.choice(20, n, replace=False)) for n in (0, 1, 5, 20, 0, 2)]
    row = np.repeat(np.arange(6), [len(s) for s in sets])
    got = machine.margins(6, row, np.array([f for s in sets for f in s], np.int64))
    for value, s in zip(got, sets):
        pairs = sum(machine.factors[a] @ machine.factors[b] for i, a in enumerate(s) for b in s[i + 1 :])
        assert value == pytest.approx(0.3 + machine.weights[s].sum() + pairs)


def test_pairs_that_additive_weights_miss(spark):
    """Toxic only if exactly an insult and a group come together: neither alone."""
    rng = random.Random(3)
    rows, marks = [], []
    for i in range(2400):
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        text = [f"w{rng.randrange(300)}" for _ in range(30)] + ["scoundrel"] * insult + ["martians"] * group
        rng.shuffle(text)
        rows.append((i, " ".join(text)))
        marks.append((i, int(insult and group)))
    got = {r["doc_id"]: r for r in toxicity.assess(docs(spark, rows), labels(spark, marks)).collect()}
    held = [(got[i]["predicted"], y) for i, y in marks if got[i]["held_out"]]
    assert {got[i]["held_out"] for i, _ in marks} == {True, False}
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, _ in marks)
    assert sum(p == y for p, y in held) / len(held) > 0.97
    with_insult = {i for i, t in rows if "scoundrel" in t and "martians" not in t}
    assert max(got[i]["score"] for i in with_insult) < 0.3 < min(got[i]["score"] for i, y in marks if y)


def test_odd_rows_and_labels(spark):
    rows = list(enumerate(ODD)) + [(None, "idiot"), (3, "one"), (3, "one two"), (50, "idiot " * 200_000)]
    rows += [(100 + i, "you idiot" if i % 2 else "fine day") for i in range(80)]
    marks = [(100 + i, i % 2) for i in range(80)] + [(101, 0), (None, 1), (7, None), (999, 1), (3, 0)]
    out = toxicity.assess(docs(spark, rows), labels(spark, marks))
    got = out.collect()
    assert out.columns == ["doc_id", "held_out", "score", "predicted"] and out.dtypes[3] == ("predicted", "int")
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[50]["predicted"] == 1 and by_id[None]["predicted"] == 1 and not by_id[None]["held_out"]
    assert by_id[0]["score"] == by_id[1]["score"] == by_id[2]["score"]
    for empty in (toxicity.assess(docs(spark, rows), labels(spark, [])), toxicity.assess(docs(spark, rows), labels(spark, [(100, 0)]))):
        assert {(r["score"], r["predicted"]) for r in empty.collect()} == {(0.0, 0)}
    assert toxicity.assess(docs(spark, []), labels(spark, marks)).count() == 0


def test_held_out_labels_are_not_read(spark):
    rows = [(i, "you idiot" if i % 2 else "fine day") for i in range(200)]
    kept = [(i, i % 2) for i in range(200) if zlib.crc32(str(i).encode()) % 4 != 2]
    wrong = [(i, 1 - i % 2) for i in range(200) if zlib.crc32(str(i).encode()) % 4 == 2]
    a, b = (sorted((r["doc_id"], r["score"]) for r in toxicity.assess(docs(spark, rows), labels(spark, m)).collect()) for m in (kept, kept + wrong))
    assert a == b


def test_the_machine_does_not_depend_on_the_order_of_texts_and_tasks(spark):
    pick = random.Random(3)
    words = ["you", "idiot", "fine", "day", "rain", "stupid", "garden", "letter", "hate", "sun"]
    rows = [(" ".join(pick.choice(words) for _ in range(12)), 0) for _ in range(300)]
    rows = [(text, int("idiot" in text and "hate" in text)) for text, _ in rows]
    found = []
    for parts in (1, 3, 7):
        pick.shuffle(rows)
        made = toxicity.fit(spark.createDataFrame(rows, "text STRING, toxic INT").repartition(parts), steps=10)
        found.append((made.bias, made.weights.tolist(), made.factors.tolist()))
    assert len(found[0][1]) and found[0] == found[1] == found[2]
