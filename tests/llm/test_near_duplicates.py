"""SimHash classes and embedding links against all pairs."""

import re

import numpy as np
import pytest
import xxhash

from cellbulk.llm import embedding_join, simhash, vp_tree
from cellbulk.llm.components import connected_components
from tests.llm.conftest import components_of


def plain_fingerprint(text):
    lowered = (text or "").translate({i: i + 32 for i in range(65, 91)})
    words = [w for w in re.split("[\x20\x09-\x0d]+", lowered) if w]
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("frame", ["docs", "sample"])
def test_classes(request, frame):
    rows = request.getfixturevalue(frame).collect()
    found = [(r.doc_id, plain_fingerprint(r.text)) for r in rows]
    known = [(i, f) for i, f in found if i is not None]
    pairs = [(a, b) for a, f in known for b, g in known if a < b and (f ^ g).bit_count() <= 2]
    part = components_of({i for i, _ in known}, pairs)
    want = sorted((str(i), f"{f:016x}", str(part.get(i))) for i, f in found)
    got = simhash.near_duplicate_classes(request.getfixturevalue(frame)).collect()
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == want
    kept = simhash.keep_one_of_each(request.getfixturevalue(frame))
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(
        [str(i) for i in set(part.values())] + ["None"] * sum(i is None for i, _ in found))
    assert kept.columns == request.getfixturevalue(frame).columns


def test_empty_table(no_docs):
    assert simhash.near_duplicate_classes(no_docs).collect() == []
    assert simhash.keep_one_of_each(no_docs).collect() == []


def test_tree_finds_every_link(spark):
    rng = np.random.default_rng(0)
    base = rng.integers(0, 1 << 63, 700, dtype=np.int64)
    near = base[:200] ^ (np.int64(1) << rng.integers(0, 62, 200)) ^ (np.int64(1) << rng.integers(0, 62, 200))
    clump = base[0] ^ (np.int64(1) << np.arange(60))  # all within two bits of each other
    fps = np.unique(np.concatenate([base, near, clump, [0, 1, 3, 7, 15]]))
    items = spark.createDataFrame([(i, int(f)) for i, f in enumerate(fps)], "id long, fp long")
    links = vp_tree.hamming_links(items, leaf_rows=32)
    u = fps.view(np.uint64)
    pairs = [(int(a), int(b)) for a, b in zip(*np.nonzero(np.triu(np.bitwise_count(u[:, None] ^ u[None, :]) <= 2, 1)))]
    want = components_of(range(len(fps)), pairs)
    got = {r.id: r.component for r in connected_components(links).collect()}
    assert {i: got.get(i, i) for i in range(len(fps))} == want
    assert links.count() < len(fps) * 8  # a forest, not all pairs of the clump


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(8, 60)] + [(200, 200), (3, None), (90, 7)]
    frame = spark.createDataFrame(edges, "a long, b long")
    got = {r.id: r.component for r in connected_components(frame).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 7 for i in [*range(7, 60), 90]}}
    assert connected_components(frame.where("a > 900")).collect() == []


def vectors(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(120, 32))
    close = base[:40] + rng.normal(size=(40, 32)) * rng.uniform(0.05, 0.6, (40, 1))
    clump = base[0] + rng.normal(size=(80, 32)) * 0.05
    made = np.float32(np.concatenate([base, close, clump, 3 * base[:5], base[:5]]))
    rows = [(int(i), [float(x) for x in v], 0) for i, v in zip(rng.permutation(len(made)), made)]
    odd = [(1001, None, 1), (1002, [], 1), (1003, [0.0] * 32, 1), (1004, [float("nan")] + [1.0] * 31, 1),
           (1005, [float("inf")] + [1.0] * 31, 1), (1006, [None] + [1.0] * 31, 1), (None, rows[0][1], 1),
           (1007, [1.0] * 5, 1), (1008, [2.0] * 5, 1), (1009, [1.0], 1), (1010, [-1.0], 1)]
    return rows + odd, spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, id int")


@pytest.mark.parametrize("tile", [4096, 16])
def test_embedding_links(spark, monkeypatch, tile):
    rows, frame = vectors(spark)
    monkeypatch.setattr(embedding_join.cosine_links, "__defaults__", (0.9, embedding_join.BLOCKS, tile))
    fine = {}
    for i, v, _ in rows:
        if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v):
            fine[i] = np.array(v, dtype=np.float64) / np.linalg.norm(v)
    pairs = [(a, b) for a in fine for b in fine if a < b and len(fine[a]) == len(fine[b]) and fine[a] @ fine[b] >= 0.9]
    ids = [i for i, _, _ in rows if i is not None]
    part, links = components_of(ids, pairs), dict.fromkeys(ids, 0)
    for a, b in pairs:
        links[a] += 1
        links[b] += 1
    got = embedding_join.near_duplicates(frame).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.vec_id is None:
            assert (r.n_links, r.component_id, r.kept) == (0, None, False)
        else:
            assert (r.n_links, r.component_id, r.kept) == (links[r.vec_id], part[r.vec_id], r.vec_id == part[r.vec_id])


def test_embeddings_may_be_missing(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embedding_join.near_duplicates(empty).collect() == []


def test_rotation_keeps_lengths_and_angles():
    x = np.random.default_rng(2).normal(size=(20, 48))
    assert np.allclose(embedding_join.rotated(x) @ embedding_join.rotated(x).T, x @ x.T)
    assert (embedding_join.rotated(x)[3] == embedding_join.rotated(x[3:4])[0]).all()
