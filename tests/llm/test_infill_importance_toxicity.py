"""Fill-in-middle, importance resampling and toxicity against brute force."""
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import crc_spans, fuzzy_lexicon, importance, infill, toxicity

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, n long, form string, __id long, __text int, rank int"


def rows(*texts, start=0):
    return [(start + i, t, "en", 7, "x", 1, 2, 3) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empties, sentinels, wide letters, a very long text and word, repeated rows, clashing names."""
    long = " ".join(f"w{i % 977}é漢" for i in range(60_000))
    data = rows(None, "", " \t\n", "one", "Two Words", "one", long, "a<P>b", "<", "漢字😀é" * 30, "x" * 5000 + " y" * 40,
                " ".join(["same"] * 25))
    data += [data[3], data[6], (None, "one two " * 12, "de") + (None,) * 5, (None,) * 8, (None,) * 8]
    return spark.createDataFrame(data, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.read.parquet(f"{SF}/benchmark.parquet")


# -- fill-in-middle


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_infill(doc_id, text):
    t = text or ""
    n = len(t)
    h = sha(f"1:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not t or any(s in t for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, sha(t), sha(t)
    if h4 % 100 < 20:
        return n, "spm", a, b - a, sha(f"<S>{t[b:]}<P>{t[:a]}<M>{t[a:b]}"), sha(t)
    return n, "psm", a, b - a, sha(f"<P>{t[:a]}<S>{t[b:]}<M>{t[a:b]}"), sha(t)


@pytest.mark.parametrize("table", ["odd", "docs"])
def test_infill_matches_brute_force(request, table):
    df = request.getfixturevalue(table)
    got = Counter((r[0], *r[1:]) for r in infill.infill_digests(df).collect())
    assert got == Counter((r.doc_id, *brute_infill(r.doc_id, r.text)) for r in df.collect())


def test_infill_outputs_are_texts(odd):
    got = infill.infill(odd).collect()
    assert {r.form for r in got} >= {"plain", "psm"}
    for r in got:
        assert r.form == "plain" or r.output.count("<M>") == 1


def test_infill_of_an_empty_table(empty):
    assert infill.infill_digests(empty).collect() == []


def test_infill_with_other_sentinels_and_shares(spark):
    df = spark.createDataFrame([(i, "ab.c*d(" * 9) for i in range(50)], "doc_id long, text string")
    out = infill.infill(df, fim_percent=100, spm_percent=100, sentinels=("(?", "[*", "$^"))
    assert {r.form for r in out.collect()} == {"spm"}
    back = out.select(infill.restored(sentinels=("(?", "[*", "$^")).alias("t")).distinct().collect()
    assert [r.t for r in back] == ["ab.c*d(" * 9]


def test_units_of_random_texts():
    rnd = random.Random(3)
    for _ in range(200):
        t = "".join(rnd.choice("aé漢😀<") for _ in range(rnd.randint(0, 70)))
        ends = [0]
        for ch in t:
            ends.append(ends[-1] + len(ch.encode()))
        units = infill.Units(t.encode())
        assert units.select(np.arange(len(t) + 1)).tolist() == ends
        assert units.before(np.array(ends)).tolist() == list(range(len(t) + 1))


# -- importance resampling

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_features(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = WORDS.findall(low)
    return len(w), [zlib.crc32(x.encode()) % 10000 for x in w + [f"{a} {b}" for a, b in zip(w, w[1:])]]


def brute_resample(table, target):
    raw, aim = Counter(), Counter()
    for r in table:
        raw.update(brute_features(r.text)[1])
    for r in target:
        aim.update(brute_features(r.text)[1])
    s, t = sum(raw.values()), sum(aim.values())
    out = []
    for r in table:
        n, found = brute_features(r.text)
        gains = [math.floor(1000 * math.log((aim[b] + 1) * (s + 10000) / ((raw[b] + 1) * (t + 10000)))) for b in found]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(sha(f"7:{'' if r.doc_id is None else r.doc_id}")[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([r.doc_id, len(found), weight, score, None, n])
    fit = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0], r[1]))
    for i, r in enumerate(fit[:25 * len(fit) // 100], 1):
        r[4] = i
    return Counter(tuple(r[:5]) for r in out)


def test_resample_matches_brute_force(docs, benchmark):
    got = importance.resample(docs, benchmark)
    assert [t for _, t in got.dtypes] == ["bigint"] * 5
    assert Counter(map(tuple, got.collect())) == brute_resample(docs.collect(), benchmark.collect())


@pytest.mark.parametrize("percent", [25, 100])
def test_resample_of_odd_rows(odd, benchmark, percent):
    got = importance.resample(odd, benchmark, draw_percent=percent).collect()
    want = brute_resample(odd.collect(), benchmark.collect())
    assert Counter(tuple(r)[:4] for r in got) == Counter(k[:4] for k in want.elements())
    drawn = sorted(r["rank"] for r in got if r["rank"] is not None)
    fit = sum(brute_features(r.text)[0] >= 20 for r in odd.collect())
    assert drawn == list(range(1, percent * fit // 100 + 1))


def test_many_equal_rows_are_ranked_apart(spark, benchmark):
    """A third of the rows share one id, text and score."""
    text = " ".join(f"t{i}" for i in range(30))
    df = spark.createDataFrame([(5 if i % 3 == 0 else i, text) for i in range(900)], "doc_id long, text string")
    got = importance.resample(df, benchmark, draw_percent=50).collect()
    drawn = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in drawn] == list(range(1, 451))
    assert drawn == sorted(drawn, key=lambda r: (-r.score, r.doc_id))
    least = min((r.score, -r.doc_id) for r in drawn)
    assert all((r.score, -r.doc_id) <= least for r in got if r["rank"] is None)


def test_drawn_documents_keep_their_columns(odd, docs, benchmark, empty):
    drawn = importance.draw_documents(docs, benchmark)
    assert drawn.columns == docs.columns
    ids = {r.doc_id for r in importance.resample(docs, benchmark).filter("rank is not null").collect()}
    assert {r.doc_id for r in drawn.collect()} == ids
    assert importance.draw_documents(odd, benchmark, draw_percent=100).columns == odd.columns


def test_resample_of_empty_tables(empty, docs, benchmark):
    assert importance.resample(empty, benchmark).collect() == []
    assert importance.resample(docs, benchmark.limit(0)).count() == docs.count()


def test_crc_of_spans_of_any_length():
    rnd = random.Random(1)
    for _ in range(60):
        at, start, end = 0, [], []
        for _ in range(rnd.randint(1, 40)):
            at += rnd.randint(0, 3)
            start.append(at)
            at += rnd.choice([1, 2, 5, 63, 64, 65, 128, 129, rnd.randint(1, 5000)])
            end.append(at)
        data = np.frombuffer(rnd.randbytes(at), np.uint8)
        got = crc_spans.crc32_spans(data, np.array(start), np.array(end))
        assert got.tolist() == [zlib.crc32(data[a:b].tobytes()) for a, b in zip(start, end)]


def test_features_in_small_pieces(monkeypatch):
    monkeypatch.setattr(importance, "BLOCK_BYTES", 7)
    texts = ["A b-c  dd Éé x" * 5, "", "z", "漢" * 40 + " q"]
    bucket, owner, words = importance.features([t.encode() for t in texts])
    for i, t in enumerate(texts):
        n, found = brute_features(t)
        assert words[i] == n and sorted(bucket[owner == i].tolist()) == sorted(found)


# -- toxicity


def distance(a, b):
    """Edits with swaps of neighbours (optimal string alignment)."""
    d = {(i, j): i + j for i in range(len(a) + 1) for j in range(len(b) + 1) if not i * j}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


@pytest.mark.parametrize("states", [20_000, 5])
def test_lexicon_finds_what_brute_force_finds(states):
    rnd = random.Random(4)
    terms = {"idiot": 2.0, "idiots": 3.0, "scum": 1.0, "worthless": 4.0, "aabb": 1.0, "abababab": 2.0, "disgusting": 1.0}
    lexicon = fuzzy_lexicon.FuzzyLexicon(terms, max_states=states)
    words = ["idoit", "id1ot", "iidiot", "diot", "scom", "worhtles", "dsgustin", "", "x" * 300, "ababaab"]
    for t in terms:
        for _ in range(60):
            w = list(t)
            for _ in range(rnd.randint(0, 3)):
                i = rnd.randint(0, len(w) - 1) if w else 0
                kind = rnd.randint(0, 3)
                if kind == 0:
                    w.insert(i, rnd.choice("abdiots"))
                elif kind == 1 and w:
                    del w[i]
                elif kind == 2 and w:
                    w[i] = rnd.choice("abdiots")
                elif i + 1 < len(w):
                    w[i], w[i + 1] = w[i + 1], w[i]
            words.append("".join(w))
    for w in words:
        near = [(e, -terms[t], t) for t in terms if (e := distance(w, t)) <= fuzzy_lexicon.edit_budget(t)]
        want = (min(near)[2], min(near)[0]) if near else None
        assert lexicon.find(w) == want, w


def test_quotation_is_told_from_abuse():
    model = toxicity.Model(fuzzy_lexicon.FuzzyLexicon({"idiot": 4.0}), coef=np.array([-2.0, 1, 1, 0, 0, 0]))

    def worth(text):
        return float(toxicity.features(text, model) @ model.coef[1:])

    plain = worth("what an idiot that was")
    assert worth("you are an idiot!") > plain > worth('the word "idiot" was quoted')
    assert plain > worth("he was called “idiot” in the report")
    assert worth("what an id1ot that was") > 0 == worth("what a nice day that was")


def test_toxicity_on_held_out_rows(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = toxicity.toxicity(docs, labels)
    held = got.filter("held_out").join(labels, "doc_id").collect()
    assert held and sum(r.predicted == r.toxic for r in held) / len(held) > 0.95
    for r in got.collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)


def test_toxicity_never_learns_from_held_out_labels(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    other = labels.withColumn("toxic", F.when(toxicity.in_test_fold(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = ({r.doc_id: r.score for r in toxicity.toxicity(docs, x).collect()} for x in (labels, other))
    assert one == two


def test_copies_do_not_make_their_words_toxic(spark):
    """One toxic text a hundred times: its harmless words stay harmless."""
    rnd = random.Random(5)

    def text(*extra):
        return " ".join(rnd.sample([f"word{i}" for i in range(400)], 30) + list(extra))

    hot = text("harmless", "scum")
    data = [(i, hot, 1) for i in range(100)]
    data += [(100 + i, text("scum", "moron"), 1) for i in range(60)] + [(200 + i, text(), 0) for i in range(300)]
    df = spark.createDataFrame(data, "doc_id long, text string, toxic int")
    model = toxicity.train(df, df)
    assert "scum" in model.lexicon.terms and "harmless" not in model.lexicon.terms


def test_toxicity_of_odd_rows(odd, empty, docs, spark):
    labels = spark.createDataFrame([(4, 1), (5, 0), (None, 1), (3, None)], "doc_id long, toxic int")
    got = toxicity.toxicity(odd, labels).collect()
    assert len(got) == odd.count() and {r.predicted for r in got} == {0}
    assert len({r.score for r in got if r.doc_id in (0, 1, 2)}) == 1
    assert toxicity.toxicity(empty, labels).collect() == []
    assert toxicity.toxicity(odd, labels.limit(0)).filter("predicted = 1").count() == 0
    assert toxicity.keep_clean(odd, labels).columns == odd.columns
    known = spark.read.parquet(f"{SF}/labels.parquet")
    clean = toxicity.keep_clean(docs, known)
    assert clean.columns == docs.columns
    assert clean.count() == toxicity.toxicity(docs, known).filter("predicted = 0").count()
