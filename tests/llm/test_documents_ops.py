"""Dedup, mixing, quality and scanning operators against brute force, with
null, empty, very long, tied and repeated rows, and clashing extra columns."""
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from starloom.llm import common, components, exact_dedup, quality, secret_scan, simhash, source_mix

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, __id long, __sha string, size int"


def rows(*texts, source="a", start=0):
    return [(start + i, t, "en", source, len(t or ""), 7, "x", 1) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empties, white space, a very long text, repeated rows, clashing names."""
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    data = rows(None, "", " \t\n", "one", "Two words", "one", long, long + " end", "one", None)
    data += [(3, "one", "en", "a", 3, 7, "x", 1), (None, "one", "de", None, 3, 7, "x", 1), (None, None) + (None,) * 6]
    return spark.createDataFrame(data, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(params=["broadcast", "heavy and light"])
def lookup_path(request, monkeypatch):
    if request.param != "broadcast":
        monkeypatch.setattr(common, "MAX_HEAVY_GROUPS", 1)
        monkeypatch.setattr(common, "MIN_HEAVY_ROWS", 2)


def brute_groups(table):
    groups = {}
    for r in table:
        groups.setdefault(r.text or "", []).append(r.doc_id)
    return groups


def test_exact_dedup_on_odd_rows(odd, lookup_path):
    got = exact_dedup.exact_dedup(odd).collect()
    groups = brute_groups(odd.collect())
    assert len(got) == odd.count()
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for r in got:
        ids = by_sha[r.text_sha256]
        assert r.group_size == len(ids)
        assert r.keep_id == max((i for i in ids if i is not None), default=None)
    for sha, ids in by_sha.items():
        assert sum(r.kept for r in got if r.text_sha256 == sha) == 1


def test_exact_dedup_is_exact_with_a_saturated_filter(docs):
    whole = exact_dedup.exact_dedup(docs)
    tiny = exact_dedup.exact_dedup(docs, max_filter_bits=64)
    assert whole.exceptAll(tiny).count() == 0 and whole.count() == tiny.count() == docs.count()


def test_bloom_filter_lets_unique_rows_pass(docs):
    digests = docs.select(exact_dedup.text_digest("text").alias("__sha"))
    n = docs.count()
    words = exact_dedup.filter_words(n)
    marked = exact_dedup.mark_candidates(digests, exact_dedup.repeated_bits(digests, words), words)
    copies = sum(len(x) for x in brute_groups(docs.collect()).values() if len(x) > 1)
    maybe = marked.filter("__maybe").count()
    assert copies <= maybe <= copies + 0.05 * n


def test_drop_copies_keeps_one_row_of_each_text(odd, docs):
    for table in (odd, docs):
        got = exact_dedup.drop_copies(table)
        assert got.columns == table.columns
        groups = brute_groups(table.collect())
        kept = {r.text or "": r.doc_id for r in got.collect()}
        assert got.count() == len(groups)
        assert kept == {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}


def test_empty_tables(empty):
    assert exact_dedup.exact_dedup(empty).collect() == []
    assert exact_dedup.drop_copies(empty).collect() == []
    assert source_mix.mix_sources(empty).collect() == []
    assert source_mix.take_mix(empty).collect() == []
    assert simhash.simhash_groups(empty).collect() == []
    assert simhash.keep_one_each(empty).collect() == []


# -- mixing


def brute_targets(sizes, weights=(1, 2, 3)):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, capped, target = sum(sizes.values()), set(), {}
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(3 * sizes[s] for s in capped)
        for s in free:
            target[s] = left * w[s] / sum(w[x] for x in free)
        over = [s for s in free if target[s] > 3 * sizes[s]]
        if not over:
            return target
        for s in over:
            target[s] = 3.0 * sizes[s]
            capped.add(s)


def check_mix(table, near):
    got = source_mix.mix_sources(table).collect()
    assert len(got) == table.count()
    sizes, taken, targets = {}, {}, {}
    source = {}
    for r in table.collect():
        n = len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        sizes[r.source] = sizes.get(r.source, 0) + n
        source.setdefault(r.doc_id, r.source)
    want = brute_targets(sizes)
    for r in got:
        s = source[r.doc_id]
        assert r.taken == r.copies * r.size <= 3 * r.size
        assert r.source_size == sizes[s] and abs(r.target - want[s]) < 1e-6 * max(1, want[s])
        taken[s] = taken.get(s, 0) + r.taken
        targets[s] = r.target
    for s in taken:
        assert abs(taken[s] - targets[s]) <= near(sizes[s])
    return got


def test_mix_meets_its_targets(docs, lookup_path):
    got = check_mix(docs, lambda size: 0.15 * size)
    again = {(r.doc_id, r.taken) for r in source_mix.mix_sources(docs.repartition(5)).collect()}
    assert again == {(r.doc_id, r.taken) for r in got}


def test_targets_stop_at_three_times_a_source(spark):
    data = rows(*["a b"] * 2, source="a") + rows(*["c " * 50] * 40, source="b", start=10)
    data += rows("d", source="c", start=90) + rows("e f", source=None, start=99)
    check_mix(spark.createDataFrame(data, SCHEMA), lambda size: 50)


def test_take_mix_repeats_rows(docs):
    want = {r.doc_id: r.copies for r in source_mix.mix_sources(docs).collect() if r.copies}
    got = source_mix.take_mix(docs)
    assert got.columns == docs.columns
    assert {r.doc_id: r["count"] for r in got.groupBy("doc_id").count().collect()} == want


def test_mix_of_odd_rows(odd):
    got = source_mix.mix_sources(odd).collect()
    assert len(got) == odd.count() and all(0 <= r.copies <= 3 for r in got)
    assert source_mix.take_mix(odd).columns == odd.columns


# -- SimHash


def brute_fingerprint(text, k=4):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]+", lambda m: m[0].lower(), (text or "").encode()))
    if not words:
        return 0
    grams = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(table, bits=4):
    fps = np.array([brute_fingerprint(r.text) for r in table], np.uint64)
    ids = [r.doc_id for r in table]
    label = list(range(len(ids)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= bits):
            a, b = root(i), root(int(j))
            label[max(a, b)] = min(a, b)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted((str(d), f"{int(fps[i]):016x}", str(least.get(root(i)))) for i, d in enumerate(ids))


def found_components(table):
    return sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in simhash.simhash_groups(table).collect())


def test_simhash_matches_brute_force(docs, lookup_path):
    assert found_components(docs) == brute_components(docs.collect())


def test_simhash_of_odd_rows(odd):
    assert found_components(odd) == brute_components(odd.collect())
    kept = simhash.keep_one_each(odd)
    assert kept.columns == odd.columns


@pytest.mark.parametrize("code", simhash.CODES)
def test_no_link_is_lost_whatever_the_code(code):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    flips = np.array([sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 5), replace=False)) for _ in x], np.uint64)
    at, anchor, home = simhash.replicas(x, code, 4)
    assert np.bincount(at[home], minlength=len(x)).tolist() == [1] * len(x)
    homes = dict(zip(at[home].tolist(), anchor[home].tolist()))
    at, anchor, _ = simhash.replicas(x ^ flips, code, 4)
    visits = {(i, a) for i, a in zip(at.tolist(), anchor.tolist())}
    assert all((i, a) in visits for i, a in homes.items())


def test_small_cells_find_the_same(docs, monkeypatch):
    monkeypatch.setattr(simhash, "CELL_HOMES", 1)
    monkeypatch.setattr(simhash, "CELL_VISITORS", 8)
    assert found_components(docs) == brute_components(docs.collect())


def test_components_of_a_long_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(1001, 1300)] + [(5, 5), (70, 69)]
    got = {r.u: r.root for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = {**{i: 0 for i in range(1, 61)}, **{i: 1000 for i in range(1001, 1300)}, 70: 69}
    assert got == want


# -- quality


def test_quality_on_held_out_rows(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = quality.quality(docs, labels)
    assert got.count() == docs.count()
    held = got.filter("held_out").join(labels, "doc_id").collect()
    assert held and sum(r.predicted == r.quality for r in held) / len(held) > 0.95
    for r in got.collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)


def test_quality_never_learns_from_held_out_labels(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    other = labels.withColumn("quality", F.when(quality.in_test_fold(), 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = ({r.doc_id: r.score for r in quality.quality(docs, x).collect()} for x in (labels, other))
    assert one == two


def test_quality_of_odd_rows(odd, empty, spark):
    labels = spark.createDataFrame([(4, 1), (5, 0), (None, 1), (3, None)], "doc_id long, quality int")
    got = quality.quality(odd, labels).collect()
    assert len(got) == odd.count()
    scores = {(r.doc_id, r.score) for r in got if r.doc_id in (0, 1, 2, 9)}
    assert len({s for _, s in scores}) == 1  # nothing to go by: the prior
    assert quality.quality(empty, labels).collect() == []
    assert quality.quality(odd, labels.limit(0)).filter("score <> 0.5").count() == 0
    assert quality.keep_good(odd, labels).columns == odd.columns


def test_long_texts_count_every_word():
    words = [f"w{i}" for i in range(300)] * 1000
    ids, x = quality.features(" ".join(words))
    few, y = quality.features(" ".join(words[:300]))
    assert set(few.tolist()) <= set(ids.tolist()) and abs(float((x * x).sum()) - 1) < 0.01


# -- secrets


def brute_base(text):
    out = []
    for m in re.finditer(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, "assign", m.end()))
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(out))


@pytest.fixture(scope="module")
def ranks():
    return common.tokenizer_path("byte_bpe_50k.tiktoken")


def test_secrets_match_brute_force(docs, odd, ranks):
    for table in (docs, odd):
        texts = sorted((str(r.doc_id), hashlib.sha256(brute_base(r.text or "").encode()).hexdigest())
                       for r in table.collect())
        got = secret_scan.scan_secrets(table, ranks).collect()
        assert sorted((str(r.doc_id), r.base_sha256) for r in got) == texts


def test_token_efficiency_finds_random_strings_only(spark, ranks):
    rng = random.Random(5)
    key = "".join(rng.choice("ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz23456789") for _ in range(36))
    texts = [f"the key {key} is new", "internationalization2 of interdependencies2024-and-more",
             "id 123e4567-e89b-12d3-a456-426614174000 and d41d8cd98f00b204e9800998ecf8427e",
             "PASSWORD: 'abc.def' secret=12345 tokEN=1234567 AKIA" + "A" * 16 + " é" + "0a" * 12]
    got = secret_scan.scan_secrets(spark.createDataFrame(rows(*texts), SCHEMA), ranks).orderBy("doc_id").collect()
    assert got[0].spans == f"random:8:{8 + 36}" and got[0].n_random == 1
    assert got[1].spans == "" and got[2].n_random == 0
    assert (got[3].n_assign, got[3].n_access, got[3].n_hex) == (2, 1, 1)


def test_secrets_of_an_empty_table(empty, ranks):
    assert secret_scan.scan_secrets(empty, ranks).collect() == []
