"""Odd rows for operators and pipeline stages: nulls, repeats, long texts, clashing names, empty tables."""
import hashlib
import math
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from starloom.llm import exact_dedup, quality, secret_scan, sentence_pieces, source_mix, token_counts, url_filter
from starloom.llm.common import tokenizer_path

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = SCHEMA + ", __id long, ids string, n_tokens string, __text string, __c0 int, __copy int, __sha string, __k int"


@pytest.fixture(scope="module")
def odd(spark):
    long = " ".join(f"word{i % 997}" for i in range(30_000))
    texts = [None, "", " ", "api_key = abcdef123", "one two", "one two", long, long + " x"]
    data = [(i, t, "en", "a", 1) + ("q",) * 0 + (1, "i", "n", "t", 1, 2, "s", 3) for i, t in enumerate(texts)]
    data += [data[3], (None, "one two", None, None, None) + (None,) * 8, (None,) * 13, (None,) * 13]
    return spark.createDataFrame(data, CLASHING)


@pytest.fixture(scope="module")
def empty(odd):
    return odd.limit(0)


# -- url filter


def test_a_very_long_url_is_read_whole(spark):
    long = "http://a.org/" + "x/" * 200_000 + "casino/win"
    got = url_filter.judge_urls(spark.createDataFrame([(1, long)], "page_id long, url string")).first()
    assert (got.soft_terms, got.verdict, len(got.path)) == (2, "block", len(long) - len("http://a.org"))


def test_vocabulary_from_a_table(spark, monkeypatch):
    table = spark.createDataFrame([("Spam", 2.0), ("spam", 0.5), ("ham", 0.4), ("egg", 0.9), ("", 3.0), (None, 3.0),
                                   ("nil", None), ("no", 0.0)], "term string, weight double")
    assert url_filter.read_vocabulary(table) == (("spam",), ("egg", "ham"))
    pages = spark.createDataFrame([(1, "http://a.io/spam"), (2, "http://ham.io/egg"), (3, "http://ham.io/ham"),
                                   (4, "http://hams.io/")], "page_id long, url string")
    strict, soft = url_filter.read_vocabulary(table)
    got = {r.page_id: r.verdict for r in url_filter.judge_urls(pages, (), strict, soft).collect()}
    assert got == {1: "block", 2: "block", 3: "allow", 4: "allow"}
    none = url_filter.judge_urls(pages, (), *url_filter.read_vocabulary(table.limit(0))).collect()
    assert {r.verdict for r in none} == {"allow"}
    monkeypatch.setattr(url_filter, "MAX_TERMS", 2)
    with pytest.raises(ValueError):
        url_filter.read_vocabulary(table)


# -- mixing


def test_no_document_is_taken_more_than_three_times(spark):
    # source b has few words, so its target is three times its size; empty documents lie under any threshold
    data = [(i, "w " * 500, "a") for i in range(40)] + [(100 + i, "w" if i < 3 else "", "b") for i in range(60)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string")
    got = source_mix.mix_sources(docs).collect()
    assert max(r.copies for r in got) <= 3 and all(r.taken <= 3 * r.size for r in got)
    taken = Counter(r.doc_id for r in source_mix.take_mix(docs).collect())
    assert max(taken.values()) <= 3 and taken == Counter({r.doc_id: r.copies for r in got if r.copies})


# -- exact dedup


def test_rows_equal_in_all_but_an_uncompared_column(spark, monkeypatch):
    df = spark.createDataFrame([(1, "t", "a", {"k": 1}), (1, "t", "a", {"k": 1}), (1, "t", "b", {}), (1, "t", "b", {}),
                                (2, "u", None, None), (2, "u", None, None), (None, "v", "x", None), (3, "v", None, None)],
                               "doc_id int, text string, lang string, extra map<string,int>")
    for limit in (exact_dedup.MAX_BROADCAST_GROUPS, 0):
        monkeypatch.setattr(exact_dedup, "MAX_BROADCAST_GROUPS", limit)
        got = sorted((r.doc_id, r.text, r.lang) for r in exact_dedup.drop_copies(df).collect())
        assert got == [(1, "t", "b"), (2, "u", None), (3, "v", None)]


# -- quality


def test_ftrl_equals_its_formula():
    rng = np.random.default_rng(2)
    model, dim = quality.Ftrl(0.4), 6
    z, n = [0.0] * dim, [0.0] * dim
    a, b, l1, l2 = quality.ALPHA, quality.BETA, quality.L1, quality.L2
    assert l1 > 0 and l2 > 0

    def weight(i):
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - math.copysign(l1, z[i])) / ((b + math.sqrt(n[i])) / a + l2)

    for _ in range(200):
        ids = np.sort(rng.choice(dim, rng.integers(1, dim), replace=False)).astype(np.int32)
        x, y = rng.random(len(ids)), int(rng.integers(0, 2))
        model.update(ids, x, y)
        w = [weight(i) for i in ids]
        p = 1 / (1 + math.exp(-(sum(u * v for u, v in zip(w, x)) + math.log(0.4 / 0.6))))
        for i, v, u in zip(ids, x, w):
            g = (p - y) * v
            sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / a
            z[i] += g - sigma * u
            n[i] += g * g
    assert np.allclose(model.weights()[:dim], [weight(i) for i in range(dim)]) and not model.weights()[dim:].any()


def test_repeated_rows_score_alike(odd, spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = quality.quality(odd, labels).collect()
    assert len(got) == odd.count()
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, set()).add(r.score)
    assert len(by_id[3]) == 1 and by_id[4] == by_id[5]


# -- secrets


def test_secrets_of_repeated_rows_and_null_ids(odd):
    got = secret_scan.scan_secrets(odd, tokenizer_path("byte_bpe_50k.tiktoken")).collect()
    assert len(got) == odd.count()
    assert [r.spans for r in got if r.doc_id == 3] == ["assign:0:19"] * 2
    none = hashlib.sha256(b"").hexdigest()
    assert [(r.n_assign, r.base_sha256) for r in got if r.doc_id is None] == [(0, none)] * 3


def test_many_secrets_in_one_text_take_time_in_proportion():
    import time
    enc = secret_scan.encoding(tokenizer_path("byte_bpe_50k.tiktoken"))
    line = "token = abcdef{0:06d} k9Xq2Lz7Vb4Nw8Rt1Yp5{0:06d} "

    def took(n):
        text = "".join(line.format(i) for i in range(n))
        start = time.perf_counter()
        secret_scan.random_spans(text, enc, secret_scan.base_spans(text))
        return time.perf_counter() - start

    took(100)
    assert took(4000) < 12 * took(1000) + 1


# -- tokens and pieces


def test_token_counts_of_odd_rows(odd, empty):
    path = tokenizer_path("byte_bpe_50k.json")
    got = token_counts.count_tokens(odd, path)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    want = {r.doc_id: len((r.text or "").encode()) for r in odd.collect() if r.doc_id is not None}
    rows = got.collect()
    assert len(rows) == odd.count() and all(r.n_bytes == want[r.doc_id] for r in rows if r.doc_id is not None)
    assert sum(r.doc_id == 3 for r in rows) == 2 and sum(r.doc_id is None for r in rows) == 3
    assert all(r.over_limit == (r.n_tokens > 512) for r in rows)
    assert token_counts.count_tokens(empty, path).collect() == []


def test_pieces_of_odd_rows(odd, empty, spark):
    model = tokenizer_path("piece_bpe_32k.model")
    got = sentence_pieces.round_trip(odd, model)
    assert got.columns == ["doc_id", "n_ids", "ids", "decoded_sha256", "exact"]
    rows = got.collect()
    assert len(rows) == odd.count() and all(r.n_ids == len(r.ids) for r in rows)
    assert sentence_pieces.round_trip(empty, model).collect() == []
    lists = spark.createDataFrame([(1, None), (2, []), (None, [1]), (2, [])], "doc_id long, ids array<int>")
    texts = {(r.doc_id, r.text) for r in sentence_pieces.decode_ids(lists, model).collect()}
    assert (1, None) in texts and (2, "") in texts and len(texts) == 3


# -- the pipeline


def test_stages_on_odd_rows(odd, empty, spark):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, odd, SF)
        assert got.columns == odd.columns, name
        assert set(map(str, got.collect())) <= set(map(str, odd.collect())), name
        assert stage(spark, empty, SF).collect() == [], name
    assert corpus_pipeline.STAGES[-1][1](spark, empty, SF).collect() == []


def test_stages_do_what_their_operators_say(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = corpus_pipeline.good_documents(spark, docs, SF)
    want = {r.doc_id for r in quality.quality(docs, labels).filter("predicted = 1").collect()}
    assert {r.doc_id for r in good.collect()} == want
    mixed = Counter(r.doc_id for r in corpus_pipeline.mix(spark, docs, SF).collect())
    assert mixed == Counter({r.doc_id: r.copies for r in source_mix.mix_sources(docs).collect() if r.copies})
    kept = {r.doc_id for r in exact_dedup.exact_dedup(docs).filter("kept").collect()}
    assert {r.doc_id for r in corpus_pipeline.exact_copies(spark, docs, SF).collect()} == kept
