"""Recall where the k-th neighbours lie just inside the distance at which a search stops."""
import numpy as np

from starloom.llm import neighbours


def test_recall_of_clustered_vectors():
    rng = np.random.default_rng(0)
    for spread in (0.3, 0.65):
        centres = rng.standard_normal((100, 384))
        centres /= np.linalg.norm(centres, axis=1)[:, None]
        v = centres.repeat(40, axis=0) + rng.standard_normal((4000, 384)) * spread / np.sqrt(2 * 384)
        v /= np.linalg.norm(v, axis=1)[:, None]
        asked = np.arange(0, 4000, 20)
        recalls = []
        for q, (ids, _) in zip(asked, neighbours.Block(np.arange(4000), v).search(asked, v[asked], 20)):
            s = (v * v[q]).sum(axis=1)
            s[q] = -np.inf
            recalls.append(len(set(np.argsort(-s, kind="stable")[:20]) & set(ids)) / 20)
        assert np.mean(recalls) >= 0.99 and min(recalls) >= 0.9


def recall_and_verified(v, k=20, every=20):
    asked = np.arange(0, len(v), every)
    recalls, shares = [], []
    for q, (ids, score, verified) in zip(asked, neighbours.Block(np.arange(len(v)), v).search_counted(asked, v[asked], k)):
        s = (v * v[q]).sum(axis=1)
        s[q] = -np.inf
        recalls.append(len(set(np.argsort(-s, kind="stable")[:k]) & set(ids.tolist())) / k)
        shares.append(verified / (len(v) - 1))
    return np.mean(recalls), np.mean(shares), max(shares)


def test_collisions_are_counted_and_few_vectors_verified(spark):
    """No query is answered by verifying a whole block; shares are of the block's vectors."""
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").orderBy("vec_id").collect()
    given = np.array([r.embedding for r in rows], float)
    rng = np.random.default_rng(0)
    centres = rng.standard_normal((200, 64))
    clustered = centres.repeat(30, axis=0) + 0.3 * rng.standard_normal((6000, 64))
    for v, most in ((given, 0.2), (rng.standard_normal((8192, 64)), 0.3), (clustered, 0.05)):
        recall, share, largest = recall_and_verified(v)
        assert recall >= 0.95 and share <= most and largest < 0.9, (recall, share, largest)


def test_small_and_equal_blocks():
    one = neighbours.Block(np.array([4]), np.ones((1, 3)))
    assert [len(x) for x in one.search(np.array([4]), np.ones((1, 3)), 5)[0]] == [0, 0]
    assert one.search(np.array([9]), np.ones((1, 3)), 5)[0][0].tolist() == [4]
    same = neighbours.Block(np.arange(100), np.ones((100, 3)))
    assert same.search(np.array([50]), np.ones((1, 3)), 5)[0][0].tolist() == [0, 1, 2, 3, 4]
