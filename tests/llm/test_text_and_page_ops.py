"""Tokenizers against their libraries, URL and HTML operators against stated
rules, nearest neighbours against brute force, and the pipeline."""
import random

import duckdb
import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

import corpus_pipeline
from starloom.llm import html_extract, html_pages, neighbours, queries, sentence_pieces, token_counts, url_filter
from starloom.llm.common import tokenizer_path

SF = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"
ALPHABET = " \n\t\r  ▁aAbetheéçß漢字😀\x00\x1c\x1d\x85\xa0​0123٣½²Ⅷ'\"s,.!<|endoftext|>¨"


def random_texts(n, seed=1):
    rng = random.Random(seed)
    texts = ["", "<|endoftext|>", " " * 40 + "the", "a" * 500, "the" * 300]
    for i in range(n):
        x = "".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 40)))
        texts.append(x + rng.choice(["", "<|endoftext|>", " " * i, "".join(rng.choice(["an", "er", "aa", "tion", "1"])
                                                                          for _ in range(100))]))
    return texts


@pytest.fixture(scope="module")
def texts(spark):
    real = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    return real + random_texts(400)


def test_counts_equal_the_library(texts):
    path = tokenizer_path("byte_bpe_50k.json")
    lib = Tokenizer.from_file(path)
    want = [len(e.ids) for e in lib.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert token_counts.ByteBPE(path).count_texts(texts) == want


def test_counts_of_long_texts_and_small_caches(monkeypatch):
    path = tokenizer_path("byte_bpe_50k.json")
    monkeypatch.setattr(token_counts, "BLOCK", 50)
    monkeypatch.setattr(token_counts, "HOLD", 400)
    monkeypatch.setattr(token_counts, "CACHE_ROWS", 60)
    some = ["".join(random_texts(60, seed)) for seed in range(4)] + random_texts(50)
    want = [len(Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids) for t in some]
    assert token_counts.ByteBPE(path).count_texts(some) == want


def test_count_query(spark):
    got = queries.QUERIES["op8_token_counts"](spark, SMALL).collect()
    lib = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert len(got) == len(docs)
    for r in got:
        n = len(lib.encode(docs[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(docs[r.doc_id].encode()), n, n > 512)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))


def test_pieces_equal_the_library_and_decode(texts, library):
    sp = sentence_pieces.Pieces(tokenizer_path("piece_bpe_32k.model"))
    for t in texts:
        ids = sp.encode(t)
        assert ids.tolist() == library.encode(t or "")
        assert sp.decode(ids) == library.decode(ids.tolist())
        if "▁" not in (t or ""):
            assert sp.decode(ids) == (t or "")


def test_streaming_commits_equal_one_pass(library):
    sp = sentence_pieces.Pieces(tokenizer_path("piece_bpe_32k.model"))
    rng = random.Random(2)
    text = "".join(rng.choice(["an", "er", "aa", "tion", "the", "x", "1", "ing"]) for _ in range(3000))
    first = next(sp.viterbi("▁" + text))  # given out before the text ends
    assert first == library.encode(text)[0]
    assert list(sp.viterbi("▁" + text)) == library.encode(text)


def test_unigram_paths_have_the_best_score():
    sp = sentence_pieces.Pieces(tokenizer_path("piece_bpe_32k.model"))
    sp.kind = sentence_pieces.UNIGRAM
    rng = random.Random(4)
    names = list(sp.ids)
    sp.score = {p: -rng.random() * 5 * len(p) ** 0.5 for p in names}
    sp.unknown_score = min(sp.score.values()) - 10
    for n in (1, 5, 30, 120):
        text = "".join(rng.choice("theraingot") for _ in range(n))
        best = [0.0]
        for end in range(1, n + 1):
            best.append(max(best[s] + sp.score.get(text[s:end], sp.unknown_score if end - s == 1 else -1e9)
                            for s in range(max(0, end - sp.longest), end)))
        ids = list(sp.viterbi(text))
        by_id = {i: p for p, i in sp.ids.items()}
        assert abs(sum(sp.score[by_id[i]] for i in ids) - best[-1]) < 1e-6
        assert "".join(by_id[i] for i in ids) == text


def test_piece_operators(spark, library):
    path = tokenizer_path("piece_bpe_32k.model")
    data = [(1, "a b", 5), (1, "a b", 5), (2, None, 5), (None, "", 5), (3, "x\ny " * 30_000, 5)]
    docs = spark.createDataFrame(data, "doc_id long, text string, ids int")
    encoded = sentence_pieces.encode_texts(docs, path)
    assert sorted((str(r.doc_id), r.ids) for r in encoded.collect()) == sorted(
        (str(d), library.encode(t or "")) for d, t, _ in data)
    back = sentence_pieces.decode_ids(encoded, path).collect()
    assert sorted((str(r.doc_id), r.text) for r in back) == sorted((str(d), t or "") for d, t, _ in data)
    assert all(r.exact for r in sentence_pieces.round_trip(docs, path).collect())
    assert sentence_pieces.round_trip(docs.limit(0), path).collect() == []


# -- URLs


def test_url_parts_and_rules():
    assert url_filter.split_url("HTTP://Ex.ORG:80/A?b#c") == ("ex.org:80", "/A")
    assert url_filter.split_url("a://b://c") == ("b:", "//c")
    assert url_filter.split_url("no scheme") == url_filter.split_url(None) == ("", "")
    assert url_filter.split_url("x://É.org") == ("É.org", "")
    assert url_filter.match_rule("a.example.net", "/en/1") == ("allow", "example.net/en/")
    assert url_filter.match_rule("a.example.net", "/fr/1") == ("block", "net/")
    assert url_filter.match_rule("net", "/") == ("block", "net/")
    assert url_filter.match_rule("planet", "/") == (None, None)
    assert url_filter.match_rule("example.net", "") == (None, None)


def test_terms_count_at_boundaries_only():
    assert url_filter.count_terms("http://a.com/xxx-XXX/xxxy") == (2, 0)
    assert url_filter.count_terms("http://casino.com/free/casino?bet=1") == (0, 3)
    assert url_filter.count_terms("http://casinos.com/freed/alphabet") == (0, 0)
    assert url_filter.count_terms(None) == (0, 0)


def test_url_query_matches_sql(spark):
    urls = [None, "", "http://x.com", "http://x.com/porn", "https://Poker.com/free-bet", "http://a.example.COM/de/1",
            "http://free.com/poker", "ftp://fr.org/fr/?xxx", "http://x.com/pornography", "://", "http://é.com/xxxé",
            "http://x.com/xxx/xxx\n/a", "http://a.com/xxx xxx", "a://b\nc/d"]
    pages = spark.createDataFrame([(i, u, "", 1) for i, u in enumerate(urls)] + [(0, None, "", 1)],
                                  "page_id long, url string, html string, host int")
    con = duckdb.connect()
    con.register("pages", pages.select("page_id", "url").toPandas())
    cur = con.execute(queries.SQL["op1_url_filter"])
    names = [c[0] for c in cur.description]
    want = sorted(map(str, cur.fetchall()))
    got = url_filter.judge_urls(pages)
    assert got.columns == names
    assert sorted(str(tuple(r)) for r in got.collect()) == want
    assert url_filter.judge_urls(pages.limit(0)).collect() == []


# -- pages


def page(body, title="T"):
    return (f"<!DOCTYPE html><html><head><title>{title}</title><script>var a='<p>no</p>';</script></head>"
            f"<body>{body}</body></html>")


ARTICLE = ("<header><h2>Site</h2></header><nav><ul><li>menu</ul></nav><div class='cookie-notice'>We use cookies</div>"
           "<article><h1>Head &amp; line</h1><p>One <b>two</b>\n three<br>four<p>Fünf &eacute;&#33;"
           "<div class=ad>buy</div><form><p>mail</form><!-- c --><style>x</style><ul><li>a<li>b</ul>"
           "<section id=comments><p>Nice!</section></article><aside>side</aside><footer>&copy; me</footer>")
MAIN = "Head & line\nOne two three four\nFünf é!\na\nb"


def test_article_slots():
    got = html_extract.main_text(page(ARTICLE), set(), set())
    assert got == MAIN
    cut = page(ARTICLE)
    for n in range(len(cut)):  # cut-off markup never fails
        html_extract.main_text(cut[:n], set(), set())
    assert html_extract.main_text(None, set(), set()) == html_extract.main_text("", set(), set()) == ""


def test_template_text_leaves_pages_without_an_article(spark):
    body = "<div><p>Welcome to the site</p></div><div class=b><p>{}</p><p>{}</p></div><div>All rights kept</div>"
    data = [(i, f"http://H.org/{i}", page(body.format(f"first {i}", "again" if i % 2 else f"other {i}")), 1)
            for i in range(8)]
    data += [(90, None, None, 1), (91, "http://lone.org/", page("<p>All rights kept"), 1), (92, "", "", 1),
             (93, "http://lone.org/", "plain  text", 1), (0, "http://H.org/0", data[0][2], 1), (None, "x", "<p>y", 1)]
    pages = spark.createDataFrame(data, "page_id long, url string, html string, host int")
    got = html_extract.extract_text(pages).collect()
    assert len(got) == len(data)
    by_id = {r.page_id: r.text for r in got}
    assert by_id[3] == "first 3\nagain" and by_id[0] == "first 0\nother 0"
    assert by_id[90] == by_id[92] == "" and by_id[91] == "All rights kept" and by_id[93] == "plain text"
    assert by_id[None] == "y" and all(r.n_chars == len(r.text) for r in got)
    assert html_extract.extract_text(pages.limit(0)).collect() == []


def test_pages_keep_whole_articles(spark):
    got = queries.QUERIES["op5_html_extract"](spark, SMALL).collect()
    raw = {r.page_id: r.html for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    assert len(got) == len(raw)
    import html
    import re
    for r in got:
        inner = re.search("<article>(.*?)(</article>|$)", raw[r.page_id], re.S)[1]
        blocks = (" ".join(html.unescape(re.sub("</?b>|<br>", " ", x)).split())
                  for x in re.split("</?(?:p|h1)>", inner))
        assert r.text == "\n".join(x for x in blocks if x)


def test_reader_survives_odd_markup():
    for source in ("<", "<a", "<p class=\"x", "</p></p>", "<!-- x", "<script>", "<div/>x", "a < b > c", "<p\n>x</P>"):
        html_pages.read_page(source)


# -- neighbours


def brute_nearest(vectors, k, every):
    ids = sorted(vectors)
    m = np.array([vectors[i] for i in ids])
    out = {}
    for i in ids:
        if i % every == 0:
            s = (m * np.array(vectors[i])).sum(axis=1)
            best = sorted((-x, j) for x, j in zip(s.tolist(), ids) if j != i)[:k]
            out[i] = [(j, -x) for x, j in best]
    return out


def found_nearest(table, **more):
    out = {}
    for r in neighbours.nearest(table, **more).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_recall_of_the_neighbours(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 400)
    monkeypatch.setattr(neighbours, "CHUNK_QUERIES", 60)
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    vectors = {r.vec_id: [float(x) for x in r.embedding] for r in table.collect()}
    want, got = brute_nearest(vectors, 20, 20), found_nearest(table)
    assert want.keys() == got.keys() and all(len(x) == 20 for x in got.values())
    hits = sum(len({j for j, _ in want[q]} & {j for j, _ in got[q]}) for q in want)
    assert hits / (20 * len(want)) >= 0.95
    for q in got:
        assert all(abs(s - float(np.dot(vectors[q], vectors[j]))) < 1e-9 for j, s in got[q])


def test_recall_at_full_block_size():
    rng = np.random.default_rng(0)
    v = rng.standard_normal((8192, 64)) * rng.uniform(0.5, 1, (8192, 1))
    block = neighbours.Block(np.arange(8192), v)
    got = block.search(np.arange(0, 400, 20), v[:400:20], 20)
    hits = 0
    for q, (ids, _) in zip(range(0, 400, 20), got):
        s = v @ v[q]
        s[q] = -np.inf
        hits += len(set(np.argsort(-s)[:20]) & set(ids.tolist()))
    assert hits / 400 >= 0.95


def test_neighbours_of_odd_rows(spark):
    rng = np.random.default_rng(1)
    data = [(i, [float(x) for x in rng.standard_normal(5)]) for i in range(1, 40)]
    data += [(40, [1.0, 0.0, 0.0, 0.0, 0.0])] + [(100 + i, [2.0, 0.0, 0.0, 0.0, 0.0]) for i in range(30)]
    good = dict(data)
    data += [(200, None), (201, []), (220, [0.0] * 5), (240, [1.0, None, 0.0, 0.0, 0.0]), (260, [float("nan")] * 5),
             (280, [float("inf")] * 5), (300, [1.0, 2.0]), (None, [1.0] * 5), data[3], data[40]]
    table = spark.createDataFrame([(a, b, "x") for a, b in data], "vec_id long, embedding array<double>, score string")
    assert found_nearest(table) == brute_nearest(good, 20, 20)  # ties go to the smaller id
    assert found_nearest(table.limit(0)) == {}
    few = spark.createDataFrame([(20, [1.0]), (21, [2.0])], "vec_id long, embedding array<double>")
    assert found_nearest(few) == {20: [(21, 2.0)]}


# -- pipeline


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "simhash_dedup", "source_mix",
                                                      "sentence_pieces"]
    step, sizes = docs, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        step = stage(spark, step, SMALL)
        assert step.columns == docs.columns
        step = spark.createDataFrame(step.collect(), docs.schema)
        sizes.append(step.count())
    assert docs.count() > sizes[0] > sizes[1] >= sizes[2]
    got = corpus_pipeline.run(spark, SMALL)
    assert sorted(r.doc_id for r in got.collect()) == sorted(r.doc_id for r in step.collect())
    assert all(r.exact for r in got.collect())
