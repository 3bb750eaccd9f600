"""The guess cost against all segmentations, and the report against a plain version."""

import hashlib
import math
import random
import re

import pytest

from tsubo.llm import secrets_scan as scan

DAY = r"(?:19|20)\d\d[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:19|20)\d\d"


def piece_bits(piece, words):
    """The cheapest way to build one piece as a whole."""
    kinds = ["digit" if c.isdigit() else "lower" if c.islower() else "upper" if c.isupper() else "other" for c in piece]
    costs = [scan.CHANGE_BITS * (1 + sum(a != b for a, b in zip(kinds, kinds[1:]))) + sum(scan.CLASS_BITS[k] for k in kinds)]
    low = piece.lower()
    for part in (low, "".join({"4": "a", "3": "e", "1": "i", "0": "o", "$": "s", "5": "s", "@": "a", "7": "t"}.get(c, c) for c in low)):
        if part in words.bits:
            costs.append(words.bits[part] + scan.CHANGE_BITS + (0 if part == piece else 1))
    length = math.floor(math.log2(len(piece))) + 1
    if len(piece) >= 3 and len(set(piece)) == 1:
        costs.append(scan.CLASS_BITS[kinds[0]] + scan.CHANGE_BITS + length)
    if len(piece) >= 3 and all(pair in scan.STEPS for pair in zip(low, low[1:])):
        costs.append(scan.WALK_BITS + length)
    if re.fullmatch(DAY, piece, re.A):
        costs.append(15.2)
    if re.fullmatch(r"(?:19|20)\d\d", piece, re.A):
        costs.append(5.5)
    return min(costs)


def least_bits(value, words):
    """Over all 2 ** (n - 1) ways to cut ``value``."""
    least = math.inf
    for cuts in range(1 << (len(value) - 1)):
        at = [0, *(i + 1 for i in range(len(value) - 1) if cuts >> i & 1), len(value)]
        least = min(least, sum(piece_bits(value[a:b], words) for a, b in zip(at, at[1:])))
    return least


def parts_bits(value, words):
    """The same minimum for longer values, by the plain recurrence over every piece."""
    best = [0.0]
    for j in range(1, len(value) + 1):
        best.append(min(best[i] + piece_bits(value[i:j], words) for i in range(j)))
    return best[-1]


def test_cost_is_the_least_of_all_segmentations():
    words = scan.ranked(["das", "asdf", "éa"])
    rng = random.Random(5)
    values = ["1qaz1qaz", "zaq1zaq1", "p4$$word", "aaaa2020", "x20200131", "aaabbb", "aAaA", "éaÉa", "qwewq", "İabc", "٣٣٣"]
    values += ["".join(rng.choice("asd1qzP42") for _ in range(rng.randint(1, 9))) for _ in range(60)]
    for value in values:
        assert scan.guess_bits(value, words) == pytest.approx(least_bits(value, words)), value


def test_cost_of_longer_values():
    words = scan.ranked(["ddd", "correct", "horse"])
    rng = random.Random(6)
    pieces = ["password", "ddddd", "1qaz", "qwertz", "2021-03-04", "31.12.1999", "correct", "H0rse", "aaaaaaaaa", "7", "X!", "zyx", "poiuytrewq", "0000000000000000000"]
    for _ in range(60):
        value = "".join(rng.choice(pieces) for _ in range(rng.randint(1, 9)))
        assert scan.guess_bits(value, words) == pytest.approx(parts_bits(value, words)), value
    assert scan.guess_bits("passwordddd") < scan.guess_bits("password") + 9
    assert scan.guess_bits("1qaz1qaz1qaz") == scan.guess_bits("zaq1zaq1zaq1")


def test_long_values_take_little_time():
    assert scan.guess_bits("z" * 200_000) < 30
    assert scan.guess_bits("as" * 50_000) < 30
    assert scan.guess_bits("a7Q!" * 20_000) > 1000


def plain_report(text, words):
    """Every span and value of a text by the rules, overlaps tried one by one."""
    text = text or ""
    spans = [("assign", m.start(), m.end()) for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A) if len(m[2]) >= 8]
    spans += [("access", m.start(), m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    spans += [("hex", m.start(), m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    order = scan.KINDS.index
    base = sorted(spans, key=lambda s: (s[1], order(s[0])))
    values = []
    for m in scan.CONTEXT.finditer(text):
        value = m[1].rstrip(".,;:!?)]}")
        if value:
            a, b, bits = m.start(1), m.start(1) + len(value), parts_bits(value, words)
            values.append((a, b, bits))
            if bits >= scan.SECRET_BITS and not any(x < b and a < y for _, x, y in base):
                spans.append(("guess", a, b))
    spans.sort(key=lambda s: (s[1], order(s[0])))
    say = lambda rows: ",".join(f"{k}:{a}:{b}" for k, a, b in rows)
    return {
        **{f"n_{k}": sum(s[0] == k for s in spans) for k in scan.KINDS},
        "base_sha256": hashlib.sha256(say(base).encode()).hexdigest(),
        "spans": say(spans),
        "n_values": len(values),
        "n_weak": sum(v[2] < scan.SECRET_BITS for v in values),
        "guess_costs": ",".join(f"{a}:{b}:{bits:.2f}" for a, b, bits in values),
    }


def texts():
    rng = random.Random(7)
    pieces = [
        "token: ", "password=", "Secret is ", "api_key='", "access-key -> ", "pwd: ", "AKIAABCDEFGHIJKLMN", "0af3" * 9, "Zq8!vK2#mW9xLp$3", "correct.horse", "changeme123",
        " ", "\n", "é ", "hunter2", "aaaa" * 9, "20240131", "none.", '"', "tokentoken=x",
    ]
    made = ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 25))) for _ in range(80)]
    return [None, "", "   ", "password=", *made, made[0], "secret: " + "b7" * 60 + " " + "word " * 2000]


def test_report_against_plain_version(spark):
    rows = [(i, t, "x") for i, t in enumerate(texts())] + [(None, "pwd: Zq8!vK2#mW9xLp$3", None)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, spans STRING")
    words = scan.learn_words(docs)
    got = {r["doc_id"]: r.asDict() for r in scan.report(docs).collect()}
    assert len(got) == len(rows)
    for doc_id, text, _ in rows:
        assert got[doc_id] == {"doc_id": doc_id, **plain_report(text, words)}, text
    assert sum(r["n_guess"] for r in got.values()) > 5 and sum(r["n_weak"] for r in got.values()) > 5


def test_words_come_from_whole_texts_outside_of_credentials(spark):
    rows = [("filler " * 3000 + "Grüße",)] * 3 + [("pwd: swordfishes grüße",)] * 3 + [("once",), (None,), ("",)]
    docs = spark.createDataFrame(rows, "text STRING")
    bits = scan.learn_words(docs).bits
    assert bits["grüße"] == scan.LIST_BITS + 1 and "filler" in bits
    assert "swordfishes" not in bits and "once" not in bits
    assert scan.learn_words(docs.limit(0)) == scan.FIXED
    assert scan.learn_words(docs, most=1).bits.keys() - scan.FIXED.bits.keys() == {"grüße"}


def test_empty_table_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "pwd: Zq8!vK2#mW9xLp$3", "a", "b", "c")], "doc_id BIGINT, text STRING, row STRING, found STRING, values STRING")
    assert scan.report(docs.limit(0)).count() == 0 and scan.redact(docs.limit(0)).columns == docs.columns
    assert scan.report(docs).first()["spans"] == "guess:5:21"
    assert scan.redact(docs).first() == (1, "pwd: [SECRET]", "a", "b", "c")
