import hashlib
from collections import Counter

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from wardlight.llm import exact_dedup, simhash
from wardlight.llm.components import components

SF = "/root/testdata/sf0.001"


def texts(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@given(st.lists(st.lists(st.integers(0, 30), max_size=40), max_size=8))
@settings(max_examples=60, deadline=None)
def test_misra_gries_falls_short_by_its_bound(batches):
    k, counts, truth = 4, {}, Counter()
    for batch in batches:
        truth.update(batch)
        counts = exact_dedup.add_counts(counts, dict(Counter(batch)), k)
    rows = truth.total()
    for key, n in truth.items():
        assert n - rows / (k + 1) <= counts.get(key, 0) <= n


def test_exact_groups_of_a_hot_text(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"t{i % 50}") for i in range(3000)]
    groups = exact_dedup.exact_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(7), share=0.1)
    winners, sizes = {}, Counter(t for _, t in rows)
    for i, t in rows:
        winners[t] = max(winners.get(t, -1), i)
    by_id = dict(rows)
    got = groups.collect()
    assert len(got) == 3000
    for r in got:
        t = by_id[r["doc_id"]]
        assert (r["keep_id"], r["group_size"], r["kept"]) == (winners[t], sizes[t], r["doc_id"] == winners[t])


def test_exact_odd_rows(odd, none):
    got = exact_dedup.exact_groups(odd).collect()
    assert len(got) == odd.count()
    kept = [r for r in got if r["kept"]]
    assert len(kept) == len({r["digest"] for r in got})  # one of each text, also of repeated rows
    empty = [r for r in got if r["digest"] == hashlib.sha256(b"").digest()]
    assert {r["keep_id"] for r in empty} == {3} and {r["group_size"] for r in empty} == {4}
    assert exact_dedup.exact_groups(none).count() == 0
    stays = exact_dedup.drop_exact(odd)
    assert stays.columns == odd.columns and stays.count() == len(kept)
    assert {r["doc_id"] for r in stays.collect()} == {r["doc_id"] for r in kept}


def test_components_match_union_find(spark):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, None)]
    root = {}

    def top(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if b is not None:
            a, b = sorted((top(a), top(b)))
            root[b] = a
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {x: top(x) for x in root if top(x) != x}
    assert {x: r for x, r in got.items() if x != r} == want


def test_masks_cover_every_pair_within_the_radius():
    masks = simhash.covering_masks()
    rng = np.random.default_rng(0)
    assert len(masks) == 15
    for _ in range(2000):
        change = sum(1 << int(b) for b in set(rng.integers(0, 64, 3)))
        assert any(not change & m for m in masks)


def fingerprint(text):
    lower = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    w = lower.split()
    if not w:
        return 0
    shingles = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [b" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_matches_all_pairs(spark):
    prints = {i: fingerprint(t) for i, t in texts(spark).items()}
    least = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for i, a in prints.items():
            low = min(least[j] for j, b in prints.items() if (a ^ b).bit_count() <= 3)
            if low < least[i]:
                least[i], changed = low, True
    got = simhash.near_groups(spark.read.parquet(f"{SF}/documents.parquet")).collect()
    assert {r["doc_id"]: r["fp"] & (2**64 - 1) for r in got} == prints
    assert {r["doc_id"]: r["component_id"] for r in got} == least


def test_large_buckets_are_dealt_out_again(spark):
    """Chains and clusters in one bucket, with room for three fingerprints only."""
    rng = np.random.default_rng(1)
    base = int(rng.integers(0, 2**62))
    prints = {base}
    for _ in range(150):
        x = list(prints)[int(rng.integers(0, len(prints)))]
        for b in rng.integers(0, 12, int(rng.integers(1, 6))):
            x ^= 1 << int(b)
        prints.add(x)
    prints |= {int(x) for x in rng.integers(0, 2**62, 50)}
    root = {x: x for x in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            low = min(root[b] for b in prints if (a ^ b).bit_count() <= 3)
            if low < root[a]:
                root[a], changed = low, True
    frame = spark.createDataFrame([(x,) for x in prints], "fp long")
    got = {x: x for x in prints} | {r["node"]: r["root"] for r in components(simhash.near_edges(frame, most=3)).collect()}
    assert got == root


def test_simhash_odd_rows(odd, none):
    got = simhash.near_groups(odd).collect()
    assert len(got) == odd.count()
    assert {r["component_id"] for r in got if r["fp"] == 0} == {1}
    assert simhash.near_groups(none).count() == 0
    stays = simhash.drop_near(odd)
    assert stays.columns == odd.columns
    assert stays.count() == len({(r["component_id"], r["fp"] if r["component_id"] is None else 0) for r in got})
