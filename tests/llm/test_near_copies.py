"""Rows that near dedup drops, when ids repeat or are null."""
import numpy as np
import pytest

from starloom.llm import simhash

BASE = " ".join(f"word{i}" for i in range(400))
NEAR = BASE + " more"
OTHER = " ".join(f"thing{i}" for i in range(400))
THIRD = " ".join(f"item{i}" for i in range(400))


@pytest.mark.parametrize("kind", ["long", "string"])
def test_only_rows_of_the_group_leave(spark, kind):
    near = [simhash.fingerprint(t, 4) for t in (BASE, NEAR)]
    assert bin((near[0] ^ near[1]) & (2 ** 64 - 1)).count("1") <= 4
    rows = [(3, BASE), (5, NEAR), (5, OTHER), (None, NEAR), (None, THIRD), (None, THIRD + " more"), (7, None), (8, "")]
    table = spark.createDataFrame([(i if i is None or kind == "long" else str(i), t) for i, t in rows],
                                  f"doc_id {kind}, text string")
    got = [(r.doc_id and int(r.doc_id), r.text) for r in simhash.keep_one_each(table).collect()]
    assert sorted(i for i, _ in got if i) == [3, 5, 7]
    assert (5, OTHER) in got and (3, BASE) in got
    assert sum(i is None and t.startswith(THIRD) for i, t in got) == 1 and len(got) == 4


@pytest.mark.parametrize("plan", simhash.PLANS)
def test_linked_fingerprints_meet_under_every_plan(plan):
    rng = np.random.default_rng(3)
    for bits in (4, 3):
        x = rng.integers(0, 1 << 63, 50, dtype=np.uint64)
        flips = [sum(1 << int(b) for b in rng.choice(64, rng.integers(0, bits + 1), replace=False)) for _ in x]
        at, anchor, home = simhash.plan_replicas(x, plan, bits)
        assert np.bincount(at[home], minlength=len(x)).tolist() == [len(plan)] * len(x)
        homes = {}
        for i, a in zip(at[home].tolist(), anchor[home].tolist()):
            homes.setdefault(i, set()).add(a)
        at, anchor, _ = simhash.plan_replicas(x ^ np.array(flips, np.uint64), plan, bits)
        met = {i for i, a in zip(at.tolist(), anchor.tolist()) if a in homes[i]}
        assert met == set(range(len(x)))


def test_every_plan_finds_the_same_groups(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = []
    for plan in (simhash.PLANS[0], *simhash.PLANS[-3:]):
        monkeypatch.setattr(simhash, "choose_plan", lambda distinct, bits, plan=plan: plan)
        found.append(sorted(map(str, simhash.simhash_groups(docs).collect())))
    assert all(f == found[0] for f in found)


def test_replicas_stay_few_as_fingerprints_grow():
    """Bytes of replicas a fingerprint, by number of fingerprints."""
    for distinct, most in ((10**5, 400), (14 * 10**6, 1500), (10**8, 1500), (10**9, 3000)):
        plan = simhash.choose_plan(distinct, 4)
        assert 8 * sum(visits for visits, _ in simhash.reach(plan, 4)) <= most


@pytest.mark.parametrize("most", [1 << 18, 0])
def test_few_and_many_drops_leave_the_same_rows(spark, monkeypatch, most):
    monkeypatch.setattr(simhash, "MAX_BROADCAST_DROPS", most)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    smallest = {r.component_id for r in simhash.simhash_groups(docs).collect()}
    assert sorted(r.doc_id for r in simhash.keep_one_each(docs).collect()) == sorted(smallest)
