"""Operators on training text against plain Python versions, and on odd input."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from tsubo.llm import byte_hash, components, decontaminate, jaccard_join, language, mixing, private_terms, quality, quotes, repeats, secrets_scan, url_filter
from tsubo.sources.staging import stage

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, row STRING, n_words STRING"
ODD = [None, "", " \n\t ", "one", "one two three", "a b", "é" * 30, "x" * 5000, "w " * 3000, "\x00\x01 nul"]


def documents(spark, texts, ids=None):
    """Rows with clashing extra columns, all NULL but the id and the text."""
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, None, None, None, None, None) for i, t in zip(ids, texts)], DOCS)


def prose(rng, words, pool=60):
    return " ".join(rng.choice([f"{a}{b}" for a in "bdfgkl" for b in "aeiou"][:pool]) + str(rng.randrange(40)) for _ in range(words))


# Quality rules --------------------------------------------------------------


def measured(text):
    tokens = WORD.findall(text or "")
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    triples = [tuple(tokens[i : i + 3]) for i in range(len(tokens) - 2)]
    count = Counter(triples)
    covered = {i + k for i, t in enumerate(triples) if count[t] > 1 for k in range(3)}
    return len(tokens), sum(map(len, tokens)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_ledger_measures_and_bits(spark):
    rng = random.Random(1)
    texts = [*ODD, *(prose(rng, rng.randrange(1, 200), 3) for _ in range(30)), "l one\nl one\nl two\n" * 9, "# * $ a b c"]
    rows = {r["doc_id"]: r for r in quality.ledger(documents(spark, texts)).select("row.doc_id", *quality.MEASURES, "failed").collect()}
    for i, text in enumerate(texts):
        got = tuple(rows[i][c] for c in quality.MEASURES[:5])
        assert got == measured(text), (i, text)
        assert bool(rows[i]["failed"] & 1) == (got[0] < 50)
        assert bool(rows[i]["failed"] & 2) == (100 * got[4] > 50 * got[0])


def test_policies_and_ablation(spark):
    entries = spark.createDataFrame([(0,), (1,), (1,), (3,), (4,)], "failed BIGINT")
    kept = {r["version"]: (r["kept"], r["rejected"]) for r in quality.apply_policies(entries).collect()}
    assert kept == {1: (2, 3), 2: (1, 4)}
    alone = {r["bit"]: (r["fails"], r["fails_alone"]) for r in quality.ablation(entries).collect()}
    assert alone[0] == (3, 2) and alone[1] == (1, 0) and alone[2] == (1, 1)
    empty = quality.keep(documents(spark, []))
    assert empty.columns == documents(spark, []).columns and empty.count() == 0


# Language -------------------------------------------------------------------


def test_language_held_out_and_odd_texts(spark):
    rng = random.Random(2)
    syllables = {"aa": ["ba", "na", "ta", "ra"], "bb": ["ix", "oz", "ek", "uv"]}
    rows = [(i, " ".join("".join(rng.choices(s, k=3)) for _ in range(40)), lang) for i, (lang, s) in enumerate(list(syllables.items()) * 40)]
    rows += [(1000 + i, t, None) for i, t in enumerate([None, "", "123 !!", "bana tara nata bara" * 400])] + [(None, "ixoz ekuv ixek", "bb")]
    got = {r["doc_id"]: r for r in language.identify(spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING")).collect()}
    assert len(got) == len(rows)
    assert all(got[i]["lang_pred"] == lang and 0 <= got[i]["score"] <= 1 for i, _, lang in rows if lang)
    assert [got[1000 + i]["lang_pred"] for i in range(4)] == ["und", "und", "und", "aa"]
    nothing = language.identify(spark.createDataFrame([(1, "abc", None)], "doc_id BIGINT, text STRING, lang STRING")).collect()
    assert nothing[0]["lang_pred"] == "und" and nothing[0]["score"] == 0


def plain_grams(text):
    """All n-grams (n = 1 to 3) of a text, lower-cased, with one border sign for what is no letter."""
    text = "".join(c if c.isalpha() else "#" for c in text.lower())
    return {text[i : i + n] for n in (1, 2, 3) for i in range(len(text) - n + 1)}


def test_scores_are_those_of_a_plain_kernel_ridge(spark):
    rng = random.Random(31)
    words = {"x": ["abra", "kedo", "milu", "éta"], "y": ["ubra", "kodi", "melu", "ßan"], "z": ["日本", "語文", "abra", "字"]}
    rows = [(i, " ".join(rng.choices(words[lang], k=rng.randrange(1, 9))) + rng.choice(["", ".", " 12"]), lang) for i, lang in enumerate("xyxzy" * 12)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING")
    model = language.fit(docs, per_language=15, landmarks=20)
    got = {r["doc_id"]: r for r in language.predict(docs, model).collect()}
    order = [r[0] for r in docs.select("doc_id").orderBy(language.shuffle_order(language.F.col("doc_id")), "doc_id").collect()]
    ranked = sorted((order.index(i), i, lang) for i, _, lang in rows)
    sample = [(k, lang, i) for lang in "xyz" for k, i in enumerate([i for _, i, one in ranked if one == lang][:15])]
    texts = {i: t for i, t, _ in rows}
    marks = [plain_grams(texts[i]) for _, _, i in sorted(sample)[:20]]
    known = set().union(*marks)

    def kernel(grams):
        grams = grams & known
        return [len(grams & m) / max(len(grams), 1) ** 0.5 / len(m) ** 0.5 for m in marks]

    learned = np.array([kernel(plain_grams(texts[i])) for _, _, i in sample])
    goal = np.array([[1.0 if lang == one else -1.0 for one in "xyz"] for _, lang, _ in sample])
    ridge = language.RIDGE * len(sample) * np.array([kernel(m) for m in marks]) + 1e-6 * len(sample) * np.eye(20)
    share = Counter(lang for _, lang, _ in sample)
    weighted = learned * np.array([len(sample) / 3 / share[lang] for _, lang, _ in sample])[:, None]
    weights = np.linalg.solve(weighted.T @ learned + ridge, weighted.T @ goal)
    for i, text, _ in rows:
        values = np.exp(4 * (np.array(kernel(plain_grams(text))) @ weights))
        assert got[i]["score"] == pytest.approx(values.max() / values.sum(), abs=1e-3)
        assert got[i]["lang_pred"] == "xyz"[values.argmax()] or np.sort(values)[-1] - np.sort(values)[-2] < 1e-3


def test_scripts_of_thousands_of_letters(spark):
    """Two languages share 2,000 signs and have 400 of their own each; letters that were never learned leave a guess."""
    rng = random.Random(32)
    shared, own = [chr(0x4E00 + i) for i in range(2000)], {"a": [chr(0x6000 + i) for i in range(400)], "b": [chr(0x7000 + i) for i in range(400)]}
    rows = [(i, "".join(rng.choices(shared, k=80) + rng.choices(own[lang], k=20)), lang) for i, lang in enumerate("aab" * 200)]
    unknown = [(1000, "ქართული", "a"), (1001, "...", "b"), (1002, None, "b")]
    got = {r["doc_id"]: r for r in language.identify(spark.createDataFrame(rows + unknown, "doc_id BIGINT, text STRING, lang STRING")).collect()}
    held = [i for i, _, _ in rows if got[i]["held_out"]]
    right = sum(got[i]["lang_pred"] == "aab"[i % 3] for i in held)
    assert len(held) > 100 and right >= 0.97 * len(held), (right, len(held))
    assert got[1001]["lang_pred"] == got[1002]["lang_pred"] == "und" and 0 <= got[1000]["score"] <= 1


def test_lookup_finds_every_gram():
    rng = np.random.default_rng(33)
    grams = np.unique(rng.integers(0, 1 << 62, 50_000))
    model = language.Model(np.append(grams, -1), language.lookup_levels(grams), np.zeros((len(grams), 1), np.float32), np.zeros((1, 1)), ["a"], 0)
    asked = np.concatenate([grams[::3], rng.integers(0, 1 << 62, 1000)])
    assert set(language.features_of(asked, model).tolist()) == set(np.flatnonzero(np.isin(grams, asked)).tolist())
    assert len(language.features_of(asked, language.Model(np.array([-1]), [], np.zeros((0, 1)), np.zeros((1, 1)), [], 0))) == 0


# Repeats --------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(40))
def test_repeated_starts(seed):
    rng = random.Random(seed)
    alphabet = rng.choice([b"ab", b"abcdefghij", bytes(range(256))])
    pool = [bytes(rng.choice(alphabet) for _ in range(rng.randint(1, 150))) for _ in range(6)]
    parts = [b"".join(rng.choice(pool) for _ in range(rng.randint(0, 5))) for _ in range(rng.randint(1, 8))] + [b"\x00" * 120, b"a" * 90] * (seed % 2)
    length = rng.choice([29, 30, 40, 64, 100])
    count = Counter(p[i : i + length] for p in parts for i in range(len(p) - length + 1))
    offsets = np.cumsum([0, *map(len, parts)])
    expected = [int(o) + i for p, o in zip(parts, offsets) for i in range(len(p) - length + 1) if count[p[i : i + length]] > 1]
    assert list(repeats.repeated_starts(np.frombuffer(b"".join(parts), np.uint8), offsets, length)) == expected


@pytest.mark.parametrize("crowded", [4096, 2])
def test_repeated_ranges(spark, crowded, monkeypatch):
    monkeypatch.setattr(repeats, "PIECE", 1500)
    rng = random.Random(3)
    passage = prose(rng, 60)
    texts = [*ODD, "x" * 4000, *(prose(rng, 80) + passage[k : k + 230] + prose(rng, 60) for k in (0, 0, 9, 40)), *[prose(rng, 90)] * 3, prose(rng, 400) + "é" * 120, "é" * 101]
    got = {r["doc_id"]: r for r in repeats.repeated_ranges(documents(spark, texts), crowded=crowded).collect()}
    data = [(t or "").encode() for t in texts]
    count = Counter(b[i : i + 200] for b in data for i in range(len(b) - 199))
    for i, b in enumerate(data):
        cover = bytearray(len(b))
        for k in range(len(b) - 199):
            if count[b[k : k + 200]] > 1:
                cover[k : k + 200] = b"\x01" * 200
        spans = [(m.start(), m.end()) for m in re.finditer(b"\x01+", bytes(cover))]
        assert [(s["from"], s["to"]) for s in got[i]["spans"]] == spans, i
        assert got[i]["kept_sha256"] == hashlib.sha256(bytes(c for c, m in zip(b, cover) if not m)).hexdigest()
    assert repeats.repeated_ranges(documents(spark, [])).count() == 0


# Mixing ---------------------------------------------------------------------


def test_rates_meet_targets(spark, monkeypatch):
    """The projected gradient alone meets targets that can be met."""
    monkeypatch.setattr(mixing, "_dual_step", None)
    rng = random.Random(4)
    rows = []
    for i in range(300):
        p = sorted(rng.random() for _ in range(2))
        rows.append((i, rng.randrange(0, 400), round(p[0], 3), round(p[1] - p[0], 3), round(1 - p[1], 3)))
    members = spark.createDataFrame(rows, "doc_id BIGINT, tokens BIGINT, p_a DOUBLE, p_b DOUBLE, p_c DOUBLE")
    got = mixing.fit_rates(members, {"a": 0.5, "b": 0.3, "c": 0.2}).collect()
    total = sum(r[1] for r in rows)
    assert all(r["rate"] >= 0 for r in got) and all(r["rate"] == 1 for r in got if not r["tokens"])
    for d, share in (("a", 0.5), ("b", 0.3), ("c", 0.2)):
        assert sum(r["rate"] * r["tokens"] * r[f"p_{d}"] for r in got) == pytest.approx(share * total, rel=1e-3)


def test_projected_gradient_with_rates_at_the_border(spark, monkeypatch):
    """Targets far from the documents' own: many rates end at 0, and the targets are met without the dual."""
    monkeypatch.setattr(mixing, "_dual_step", None)
    rng = np.random.default_rng(3)
    shares, tokens = rng.dirichlet([4, 2, 1], 400).round(3), rng.integers(0, 300, 400)
    members = spark.createDataFrame([(i, int(n), *map(float, p)) for i, (n, p) in enumerate(zip(tokens, shares))], "doc_id BIGINT, tokens BIGINT, p_a DOUBLE, p_b DOUBLE, p_c DOUBLE")
    got = mixing.fit_rates(members, {"a": 0.2, "b": 0.5, "c": 0.3}, budget=5000).collect()
    rates = np.array([r["rate"] for r in sorted(got, key=lambda r: r["doc_id"])])
    assert rates.min() == 0 and (rates[tokens > 0] == 0).mean() > 0.1 and (rates[tokens == 0] == 1).all()
    assert (rates * tokens) @ shares == pytest.approx([1000, 2500, 1500], rel=1e-3)


def least_misfit(a, b):
    """The exact least |a x - b| over x >= 0 (Lawson and Hanson)."""
    x, on = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    for _ in range(500):
        slope = a.T @ (b - a @ x)
        slope[on] = -1
        if slope.max() <= 1e-12:
            break
        on[slope.argmax()] = True
        while on.any():
            z = np.zeros_like(x)
            z[on] = np.linalg.lstsq(a[:, on], b, rcond=None)[0]
            if z[on].min() > 1e-13:
                x = z
                break
            bad = on & (z <= 1e-13)
            x = x + (x[bad] / np.maximum(x - z, 1e-300)[bad]).min() * (z - x)
            on &= x > 1e-13
            x[~on] = 0
    return float(np.linalg.norm(a @ x - b))


@pytest.mark.parametrize("seed", [5, 20, 25, 53])
def test_rates_of_soft_posteriors_have_the_least_misfit(spark, seed):
    """Targets that can be met (5, 20) and that cannot: the rates before were 5 to 137 % of all tokens off the least misfit."""
    rng = np.random.default_rng(seed)
    shares = rng.dirichlet(rng.uniform(0.5, 6, 3), 300).round(3)
    tokens = rng.integers(1, 400, 300)
    targets = dict(zip("abc", rng.dirichlet(np.ones(3))))
    members = spark.createDataFrame([(i, int(n), *map(float, p)) for i, (n, p) in enumerate(zip(tokens, shares))], "doc_id BIGINT, tokens BIGINT, p_a DOUBLE, p_b DOUBLE, p_c DOUBLE")
    rates = np.zeros(300)
    for r in mixing.fit_rates(members, targets).collect():
        rates[r["doc_id"]] = r["rate"]
    aim = np.array(list(targets.values()))
    misfit = np.linalg.norm((tokens * rates) @ shares / tokens.sum() - aim)
    assert rates.min() >= 0 and misfit == pytest.approx(least_misfit(shares.T, aim), abs=2e-5)


def test_mix_learns_labels_and_takes_odd_rows(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choices(["good", "fine", "nice"] if i % 2 else ["junk", "spam", "buy"], k=60)) for i in range(60)] + ODD + ["good fine"] * 2
    docs = documents(spark, texts).unionByName(documents(spark, ["junk spam"], [None]))
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)] + [(41, None, None), (None, 1, 0)], "doc_id BIGINT, quality INT, toxic INT")
    got = mixing.mix(docs, labels, {"clean": 0.5, "low": 0.5}).collect()
    assert len(got) == docs.count()
    by_id = {r["doc_id"]: r for r in got}
    assert all((by_id[i]["p_clean"] > 0.5) == bool(i % 2) for i in range(60))
    assert by_id[60]["tokens"] == 0 and by_id[60]["rate"] == 1
    assert mixing.mix(docs.limit(0), labels.limit(0)).count() == 0


def test_mix_writes_few_files_however_many_partitions_there_are(spark, tmp_path):
    settings = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    files = {}

    def counted(df, name, *most):
        written = stage(df, name, *most)
        files[name] = len(written.inputFiles())
        return written

    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        docs = spark.createDataFrame([(i, f"word{i % 7} word{i % 11} other") for i in range(400)], "doc_id BIGINT, text STRING")
        docs.write.parquet(f"{tmp_path}/docs")
        labels = spark.createDataFrame([(i, i % 2, 0) for i in range(100)], "doc_id BIGINT, quality INT, toxic INT")
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(mixing, "stage", counted)
            got = mixing.mix(spark.read.parquet(f"{tmp_path}/docs"), labels).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(r["doc_id"] for r in got) == list(range(400))
    assert max(files["memberships"], files["cells"]) <= spark.sparkContext.defaultParallelism


# Secrets --------------------------------------------------------------------


def test_secret_spans():
    text = 'x password=abc12345 token: "short" AKIAABCDEFGHIJKL é ' + "0af" * 12 + " the passphrase is Zq8!vK2#mW9x and secret is something."
    kinds = [(k, text[a:b]) for k, a, b, _, _ in secrets_scan.find_spans(text)]
    assert kinds == [("assign", "password=abc12345"), ("access", "AKIAABCDEFGHIJKL"), ("hex", "0af" * 12), ("guess", "Zq8!vK2#mW9x")]
    assert secrets_scan.find_spans(None) == [] and secrets_scan.find_spans("z" * 10000) == []
    assert secrets_scan.guess_bits("password123") < 20 < secrets_scan.guess_bits("b7db7aa4a5fcc78305")
    assert secrets_scan.guess_bits("") == 0 and secrets_scan.guess_bits("aaaaaaaaaaaa") < 12 and secrets_scan.guess_bits("20240131") < 16


def test_secret_report_and_redaction(spark):
    docs = documents(spark, [*ODD, "my token = 'abcdef123456' end"])
    rows = {r["doc_id"]: r for r in secrets_scan.report(docs).collect()}
    assert rows[0]["spans"] == "" and rows[0]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert rows[10]["spans"] == "assign:3:24" and rows[10]["n_assign"] == 1
    clean = {r["doc_id"]: r["text"] for r in secrets_scan.redact(docs).collect()}
    assert clean[0] is None and clean[10] == "my token = '[SECRET]' end" and clean[7] == "x" * 5000


# Similarity classes ---------------------------------------------------------


def brute_classes(texts, percent=85, width=4):
    sets = []
    for t in texts:
        tokens = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        sets.append({tuple(tokens[i : i + width]) for i in range(max(1, len(tokens) - width + 1))} if tokens else set())
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [(len(s), find(i)) for i, s in enumerate(sets)]


def test_similarity_classes(spark):
    rng = random.Random(6)
    texts = [*ODD, "ONE two THREE", "é one", "É one"]
    for _ in range(12):
        base = prose(rng, rng.randrange(20, 200)).split()
        for _ in range(rng.randrange(1, 7)):
            copy = list(base)
            for _ in range(rng.randrange(0, 5)):
                copy[rng.randrange(len(copy))] = "new" + str(rng.randrange(99))
            texts.append(" ".join(copy))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.similarity_classes(documents(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == brute_classes(texts)


def test_one_per_class_of_null_and_repeated_ids(spark):
    """One row per class, whatever ids rows share: against brute force over rows."""
    rng = random.Random(16)
    base = [prose(rng, 60) for _ in range(9)]
    near = [" ".join(["new", *b.split()[1:]]) for b in base]
    rows = [(None, base[0]), (None, base[1]), (None, near[1]), (None, base[2]), (3, base[3]), (3, base[4]), (5, base[5]), (6, near[5]), (6, base[6]), (7, near[7]), (7, base[7])]
    rows += [(None, base[8]), (8, near[8]), (9, base[3]), (10, None), (10, ""), (None, None), (11, near[0]), (11, near[0]), (3, base[3])]
    ids, texts = zip(*rows)
    classes = {}
    for row, (n, component) in enumerate(brute_classes(texts)):
        classes.setdefault(component if n else ("wordless", row), []).append(rows[row])
    expected = Counter(min(c, key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")) for c in classes.values())
    kept = jaccard_join.one_per_class(documents(spark, texts, ids))
    assert kept.columns == documents(spark, []).columns
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == expected


def test_pipeline_takes_five_words_and_four_fifths(spark):
    """Two changed words of a hundred: Jaccard 86/106 of five words, but 89/105 of four, below 85 %."""
    words = [f"w{k}" for k in range(100)]
    near = [f"x{k}" if k in (30, 60) else w for k, w in enumerate(words)]
    docs = documents(spark, [" ".join(words), " ".join(near)])
    assert [r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()] == [0]


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (7, 7), (100, 102)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(links, "a BIGINT, b BIGINT")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}
    assert components.components(spark.createDataFrame([], "a BIGINT, b BIGINT")).count() == 0


# Personal data --------------------------------------------------------------


def test_private_spans_and_terms(spark):
    text = "a.b@x.org 1.2.3.4 999.1.1.1 x 4111 1111 1111 1111 y +1 (555) 010-9999 z 4111 1111 1111 1112"
    found = [(kind, text[a:b]) for kind, a, b, _ in private_terms.find_spans(text)]
    assert found == [("email", "a.b@x.org"), ("ip", "1.2.3.4"), ("card", "4111 1111 1111 1111"), ("phone", "+1 (555) 010-9999")]
    rng = random.Random(7)
    texts = [f"{prose(rng, 20)} jo@x.org zebra{'' if k else ' extra'} {k}w" for k in range(4)] + [prose(rng, 20) for _ in range(40)] + [None, ""]
    found = {r["doc_id"]: r for r in private_terms.report(documents(spark, texts)).collect()}
    assert all(found[k]["n_email"] == 1 and found[k]["n_term"] >= 1 for k in range(4))
    assert all(found[k]["spans"] == "" for k in range(4, 46))
    clean = {r["doc_id"]: r["text"] for r in private_terms.sanitise(documents(spark, texts)).collect()}
    assert "zebra" not in clean[0] and "[EMAIL]" in clean[0] and clean[5] == texts[5]


def test_terms_of_entities_seen_once_or_twice(spark):
    """Every datum is protected: terms against plain counts, for entities of one, two and four texts, copies and a list of data."""
    rng = random.Random(17)
    common = [prose(rng, 1) for _ in range(30)]
    texts = [" ".join(rng.choices(common, k=25)) for _ in range(60)]
    texts += [f"{texts[0]} one@x.org walrus 4711", f"{texts[1]} two@x.org heron", f"{texts[2]} two@x.org heron alone", None, ""]
    texts += [f"{texts[3]} copy@x.org ibis"] * 3 + [texts[4] + " lynx " + " ".join(f"p{k}@y.org" for k in range(30))] + [f"{texts[5 + k]} jo@x.org zebra {k}w" for k in range(4)]
    n = len(texts)
    data = [{f"{kind}:{value}" for kind, _, _, value in private_terms.find_spans(t)} for t in texts]
    terms = [set(WORD.findall((t or "").lower())) for t in texts]
    expected = [set() for _ in texts]
    for e in set().union(*data):
        holds = [i for i in range(n) if e in data[i]]
        least = min(private_terms.SUPPORT, len({texts[i] for i in holds}))
        for term in set().union(*(terms[i] for i in holds)):
            both = [i for i in holds if term in terms[i]]
            pmi, content = np.log2(len(both) * n / (len(holds) * sum(term in t for t in terms))), np.log2(n / len(holds))
            if len({texts[i] for i in both}) >= least and pmi >= private_terms.DISCLOSURE * content:
                for i in both:
                    expected[i].add(term)
    found = private_terms.find_private(documents(spark, texts)).collect()
    got = {r["doc_id"]: {s["value"] for s in r["spans"] if s["kind"] == "term"} for r in found}
    # words that overlap a datum are spans of that datum only
    assert [got[i] for i in range(n)] == [{t for t in e if "@" not in t} for e in expected]
    assert got[60] == {"walrus", "4711"} and got[61] >= {"heron"} and "alone" not in got[62] and "heron" in got[62] and "ibis" in got[65] and "lynx" in got[68] and "zebra" in got[69]


# URL lists ------------------------------------------------------------------


def test_judge(spark):
    urls = {
        1: "https://A.Example.org/es/1", 2: "http://example.org/en/19", 3: "http://other.org/x", 4: "https://x.com/fr/1", 5: "https://x.com/de/1?q",
        6: "https://x.net/a.html", 7: "http://www.x.net/a", 8: "http://y.net/#t", 9: None, 10: "nothing", 11: "http://badexample.org/es/", 12: "http://x.net",
    }
    pages = spark.createDataFrame(list(urls.items()), "page_id BIGINT, url STRING")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_filter.judge(pages, url_filter.rules_table(spark), url_filter.mirrored(pages)).collect()}
    assert got == {
        1: ("example.org/es/", "block"), 2: ("example.org/en/1", "block"), 3: ("org/", "allow"), 4: ("com/fr/", "allow"), 5: ("com/de/", "block"),
        6: (None, "block"), 7: (None, "block"), 8: (None, "allow"), 9: (None, "allow"), 10: (None, "allow"), 11: ("org/", "allow"), 12: (None, "allow"),
    }


def test_judge_many_path_lengths_and_no_host(spark):
    rules = url_filter.rules_table(spark, [("block", "x.org", "/" + "a" * n) for n in range(1040)])
    urls = {n: "http://x.org/" + "a" * n for n in range(0, 1040, 4)} | {-1: "file:///a/b", -2: "file:///a/b.html", -3: "file:///c"}
    pages = spark.createDataFrame(list(urls.items()), "page_id BIGINT, url STRING")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_filter.judge(pages, rules, url_filter.mirrored(pages)).collect()}
    assert got == {n: ("x.org/" + "a" * n, "block") for n in range(0, 1040, 4)} | {-1: (None, "block"), -2: (None, "block"), -3: (None, "allow")}


# Contained items ------------------------------------------------------------


def shares_enough(text, item, percent=80):
    """Whether the text holds enough of the item's windows of five words, or all words of a shorter item in a row."""
    held, asked = WORD.findall((text or "").lower()), WORD.findall((item or "").lower())
    width = min(5, len(asked))
    windows = {tuple(asked[i : i + width]) for i in range(len(asked) - width + 1)} if asked else set()
    inside = {tuple(held[i : i + width]) for i in range(len(held) - width + 1)}
    return bool(windows) and 100 * len(windows & inside) >= percent * len(windows)


def test_contained_items(spark):
    rng = random.Random(8)
    items = [prose(rng, n) for n in (3, 5, 12, 40, 1, 2, 4)] + [None, ""]
    broken = items[3].split()
    broken[20] = "other"
    texts = [
        *ODD, items[0], prose(rng, 900) + " " + items[3].upper() + " " + prose(rng, 50), " ".join(broken), items[2], items[1] + " end",
        prose(rng, 300) + " " + items[0] + " " + prose(rng, 300), items[4] + " " + items[5], prose(rng, 40) + "\n" + items[6],
    ]
    item_rows = spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id BIGINT, text STRING")
    docs = documents(spark, texts)
    expected = {(d, i) for d, t in enumerate(texts) for i, x in enumerate(items) if shares_enough(t, x)}
    assert {(15, 0), (16, 4), (16, 5), (17, 6)} <= expected
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.contained(docs, item_rows).collect()} == expected
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.contained(docs, item_rows, broadcast_bytes=0).collect()} == expected
    kept = decontaminate.clean_documents(docs, item_rows)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == set(range(len(texts))) - {d for d, _ in expected}
    assert decontaminate.contained(docs, item_rows.limit(0)).count() == 0 and decontaminate.contained(docs.limit(0), item_rows).count() == 0


@pytest.mark.parametrize("percent", [50, 80, 100])
def test_every_size_class_misses_no_item(spark, percent):
    """Items of 1 to 70 words, of which documents lack words up to and beyond the containment."""
    rng = random.Random(percent)
    items = [" ".join(f"i{k}w{j}" for j in range(n)) for k, n in enumerate([*range(1, 40), 47, 64, 67, 68, 69, 70])]
    texts = []
    for _ in range(150):
        words = rng.choice(items).split()
        held = max(1, round(len(words) * rng.uniform(percent / 100 - 0.1, 1.1)))
        cut = rng.randrange(max(len(words) - held, 0) + 1)
        texts.append(" ".join([*prose(rng, rng.randrange(30)).split(), *words[cut : cut + held], *prose(rng, rng.randrange(30)).split()]))
    item_rows = spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id BIGINT, text STRING")
    expected = {(d, i) for d, t in enumerate(texts) for i, x in enumerate(items) if shares_enough(t, x, percent)}
    got = decontaminate.contained(documents(spark, texts), item_rows, percent=percent).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == expected and 40 < len(got) == len(expected) < 150


def test_clean_documents_of_null_and_repeated_ids(spark):
    rng = random.Random(18)
    item = prose(rng, 12)
    rows = [(None, "a " + item), (None, "clean text one"), (None, None), (1, item + " b"), (1, "clean text two"), (1, item + " b"), (2, "clean text one"), (2, None)]
    items = spark.createDataFrame([(0, item)], "item_id BIGINT, text STRING")
    kept = decontaminate.clean_documents(documents(spark, [t for _, t in rows], [i for i, _ in rows]), items).collect()
    assert Counter((r["doc_id"], r["text"]) for r in kept) == Counter(r for r in rows if item not in (r[1] or ""))


# Quotations -----------------------------------------------------------------


def test_links_between_messages(spark):
    rows = [
        (1, 0, "a", "Hello there\nsecond line"), (1, 1, "b", "> hello  there\nMy answer"), (1, 2, "a", "On Monday b wrote:\n>> Hello there\n> My answer\nThanks"),
        (1, 3, "b", "> never said\nNew"), (2, 0, "a", "> Hello there\nother"), (3, 0, "a", None), (3, 1, "a", ""), (None, 0, "a", "> x"), (4, None, "a", "> x\ny"),
    ]
    got = {(r["conv_id"], r["turn"]): r for r in quotes.link(spark.createDataFrame(rows, "conv_id BIGINT, turn BIGINT, role STRING, text STRING")).collect()}
    assert len(got) == len(rows)
    assert (got[1, 1]["parent"], got[1, 1]["text"]) == (0, "My answer")
    assert (got[1, 2]["parent"], got[1, 2]["thread"], got[1, 2]["text"], got[1, 2]["n_linked"]) == (1, 0, "Thanks", 2)
    assert (got[1, 3]["parent"], got[1, 3]["thread"], got[1, 3]["n_quoted"]) == (None, 3, 1)
    assert got[2, 0]["parent"] is None and got[3, 0]["text"] == "" and got[4, None]["text"] == "y"


def test_prefix_tokens_leave_in_slices():
    """A batch of small prefixes, opened, is many times as large; it used to leave as one batch."""
    sizes = [i % 90 for i in range(10_000)]
    tokens = [np.arange(i, i + n, dtype=np.uint64) for i, n in enumerate(sizes)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(10_000)), pa.array(sizes), pa.array([t.tobytes() for t in tokens], pa.binary())], ["g", "n", "prefix"])
    opened = list(jaccard_join._prefix_tokens(iter([batch])))
    assert max(b.num_rows for b in opened) <= 90 * 1000
    got = pa.Table.from_batches(opened).to_pydict()
    assert got["token"] == [int(x) for t in tokens for x in t]
    assert got["g"] == [i for i, n in enumerate(sizes) for _ in range(n)]
    assert got["place"] == [k for n in sizes for k in range(1, n + 1)]


def test_power_tables_grow_with_their_use():
    """Every Python worker keeps both tables: a short text made them 8 MB each."""
    before = dict(byte_hash._powers)
    try:
        byte_hash._powers.update(up=np.ones(1, np.uint64), down=np.ones(1, np.uint64))
        small = byte_hash.Hasher(np.arange(200, dtype=np.uint8)).windows(7)
        assert all(len(t) <= 1 << 16 for t in byte_hash._powers.values())
        large = byte_hash.Hasher(np.arange(300_000, dtype=np.uint64).astype(np.uint8)).windows(7)
        assert all(300_000 < len(t) <= 1 << 19 for t in byte_hash._powers.values())
        assert (large[: len(small)] == small).all()
    finally:
        byte_hash._powers.update(before)
