"""Phrase mining, suffix-array dedup and ranked search against brute force."""

import hashlib
import math
import random
import re
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wardlight.llm import collocations, lexical_search, suffix_arrays, suffix_dedup
from wardlight.session import shared_dir

CAPITALS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SF = "/root/testdata/sf0.001"


def phrase_rows(rows, least, top):
    """Ranked phrases of (lang, text) rows."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(CAPITALS)):
            w = [x for x in re.split(r"[ \t]+", piece) if x]
            n[lang] += len(w)
            f.update((lang, *w[i : i + k]) for k in range(1, 6) for i in range(len(w) - k + 1))
    out = {}
    for (lang, *p), a in f.items():
        if len(p) < 2 or a < least:
            continue
        longer = [a2 for (l2, *q), a2 in f.items() if l2 == lang and len(q) > len(p) and a2 >= least and any(q[i : i + len(p)] == p for i in range(len(q)))]
        if any(100 * x >= 100 * a for x in longer):
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, *p[:k]] * f[lang, *p[k:]]), k, f[lang, *p[:k]], f[lang, *p[k:]]) for k in range(1, len(p))]
        score, _, left, right = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), left, right))
    return {(lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for lang, found in out.items() for i, (s, a, p, left, right) in enumerate(sorted(found)[:top])}


def phrases_of(frame, **how):
    return {tuple(r) for r in collocations.collocations(frame, **how).collect()}


def test_scans_read_words_and_carry_open_sums_only(spark):
    """What the scans share holds no texts, and of a phrase that has met every shard below the threshold no sum."""
    rows = [(i, "en", f"p q r rare{i}. P q! other{i % 9} p q r") for i in range(60)]
    before = set(Path(shared_dir(spark).removeprefix("file:")).glob("phrases-*"))
    collocations.frequent(spark.createDataFrame(rows, "doc_id long, lang string, text string"), least=10, shards=3)
    (base,) = set(Path(shared_dir(spark).removeprefix("file:")).glob("phrases-*")) - before
    assert "text" not in spark.read.parquet(f"{base}/corpus").columns
    steps = sorted((base / "counts").iterdir())
    assert len(steps) > 3
    for step, folder in enumerate(steps):
        found = spark.read.parquet(str(folder))
        assert found.filter(f"total < 10 AND until <= {step}").isEmpty()
        assert found.filter(f"until >= {step + 3}").isEmpty()


@pytest.mark.parametrize("shards, bits", [(1, 15), (2, 16), (4, 3)])
def test_phrases_match_brute_force(spark, shards, bits):
    """Also with so few slots that most phrases are counted without need."""
    rng = random.Random(shards)
    vocabulary = ["a", "B", "cé", "d", "the", "of", "zz", "y"]
    rows = [(rng.choice(["en", "de", None]), "".join(rng.choice(vocabulary) + rng.choice([" ", " ", "\t", "  ", ". ", "\n"]) for _ in range(rng.randrange(30)))) for _ in range(80)]
    rows += [("en", "of the zz y a of the zz y a")] * 8 + [(None, None), ("en", ""), ("und", "a B a B")]
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, lang string, text string").repartition(5)
    assert phrases_of(frame, least=4, top=30, shards=shards, bits=bits) == phrase_rows(rows, 4, 30)


def test_phrases_of_odd_rows(odd, none):
    rows = [(r["lang"], r["text"]) for r in odd.collect()]
    small = [(lang, text) for lang, text in rows if text is None or len(text) < 60_000]
    assert phrases_of(none) == set()
    got = phrases_of(odd, least=3)  # the long text is met three times, in other rows phrases are met once
    n = sum(len((text or "").split()) for lang, text in rows if lang == "en")
    assert len(got) == 2000 and {(r[0], r[3], len(r[2].split()), r[6]) for r in got} == {("en", 3, 5, n)}
    frame = odd.filter("length(text) < 60000 OR text IS NULL")
    assert phrases_of(frame, least=1) == phrase_rows(small, 1, 2000)


def test_long_words_with_a_pattern_are_told_apart(spark):
    """Thue-Morse words: a polynomial modulo 2^64 is the same for both, whatever its base."""
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(2048))
    other = one.translate(str.maketrans("ab", "ba"))
    rows = [("en", f"{one} x")] * 5 + [("en", f"{other} x")] * 7 + [("en", f"{one.upper()} {other}. y")] * 4
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, lang string, text string")
    assert phrases_of(frame, least=4) == phrase_rows(rows, 4, 2000)


def test_slots_reach_the_driver_in_one_job(spark):
    """However many partitions hold them; each level in its turn."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.sparkContext.setJobGroup("slots", "")
    try:
        rows = spark.range(1 << 18).selectExpr("int(id % 3) AS level", "id * 4 AS h")
        found = [(level, x) for level, slot in collocations._bitmap(rows, 21) for x in slot.tolist()]
    finally:
        spark.sparkContext.setJobGroup(None, None)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert [x[0] for x in found] == sorted(x[0] for x in found) and sorted(found) == sorted((i % 3, i * 4) for i in range(1 << 18))
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("slots")) <= 3


def test_scores_beyond_64_bits(spark):
    rows = [("en", "p q")] * 3 + [("en", "r " * 1000)] * 5
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, lang string, text string")
    counted = collocations.frequent(frame, least=3)
    big = counted.withColumn("c", counted["c"] * 10**11)
    original = collocations.frequent
    collocations.frequent = lambda *a, **k: big
    try:
        got = {r["phrase"]: r["score"] for r in collocations.collocations(frame, least=3).collect()}
    finally:
        collocations.frequent = original
    assert got["p q"] == 1000 * 5006 // 3


@given(st.lists(st.integers(1, 3), max_size=60), st.sampled_from([1, 7]), st.sampled_from([4, 600]))
@settings(max_examples=200, deadline=None)
def test_suffix_arrays_match_sorting(symbols, repeats, alphabet):
    text = (symbols * repeats)[:120] + [0]
    s = np.array(text, np.int64)
    order = suffix_arrays.suffix_array(s, alphabet)
    want = sorted(range(len(text)), key=lambda i: text[i:])
    assert order.tolist() == want
    before, shared = suffix_arrays.common_prefixes(s, order)
    for a, b in zip(want, want[1:], strict=False):
        n = 0
        while max(a, b) + n < len(text) and text[a + n] == text[b + n]:
            n += 1
        assert (before[b], shared[b]) == (a, n)


def stripped_rows(texts, window=suffix_dedup.WINDOW):
    texts = [(t or "").encode() for t in texts]
    places = Counter(hashlib.md5(t[i : i + window]).digest() for t in texts for i in range(len(t) - window + 1))
    out = []
    for t in texts:
        lost = bytearray(len(t))
        for i in range(len(t) - window + 1):
            if places[hashlib.md5(t[i : i + window]).digest()] > 1:
                lost[i : i + window] = b"\1" * window
        kept = bytes(b for b, gone in zip(t, lost, strict=True) if not gone)
        out.append((len(t), sum(lost), len([x for x in bytes(lost).split(b"\0") if x]), kept))
    return out


def strip_all(frame, **how):
    return sorted((tuple(r)[2:] for r in suffix_dedup.strip_repeats(frame, **how).collect()), key=repr)


@pytest.mark.parametrize("most", [2048, 2])
def test_repeated_bytes_match_brute_force(spark, most):
    """Copies, shared passages in many surroundings, overlaps with itself, passages just too short."""
    rng = random.Random(most)

    def noise(n):
        return "".join(rng.choice("abcdé 文") for _ in range(n))

    passage, hot = noise(350), noise(300)
    texts = [noise(rng.randrange(900)) for _ in range(20)] + [passage + noise(60) + passage, "xy" * 450, "z" * 1200]
    texts += [noise(rng.randrange(300)) + hot + noise(rng.randrange(300)) for _ in range(12)]
    texts += [noise(200) + passage * 2 + noise(150) for _ in range(4)] + ["q" * 399, "q" * 400, "w" * 400, "w" * 400, None, ""] + [texts[3]] * 5
    short = noise(500).encode()[:399].decode(errors="ignore")
    texts += [noise(30) + short + "1" + noise(20), noise(10) + short + "2" + noise(50)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    assert strip_all(frame, most=most, shard_bytes=3_000) == sorted(stripped_rows(texts), key=repr)


def test_suffix_dedup_of_given_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = [r["text"] for r in docs.collect()]
    assert strip_all(docs) == sorted(stripped_rows(texts), key=repr)


def test_suffix_dedup_odd_rows(odd, none):
    got = {}
    for r in suffix_dedup.strip_repeats(odd).collect():
        got.setdefault(r["doc_id"], []).append((r["n_bytes"], r["n_removed"], r["n_spans"]))
    assert sum(map(len, got.values())) == odd.count()
    assert got[1] == got[2] == [(0, 0, 0)] and (0, 0, 0) in got[None]
    size = got[4][0][0]
    assert got[4] == [(size, size, 1)] and got[5] == [(size, size, 1)] * 2  # repeated rows are two documents
    assert got[8] == [(50_000, 50_000, 1)]  # repeats itself
    assert suffix_dedup.strip_repeats(none).count() == 0


def ranked(texts, items, k):
    """Best documents (score, place) of each item by the formula."""
    def terms(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(CAPITALS))

    docs = [Counter(terms(t)) for _, t in texts]
    big_n, length = sum(bool(d) for d in docs), sum(d.total() for d in docs)
    df = Counter(t for d in docs for t in d)
    out = {}
    for item, text in items:
        found = []
        for (doc_id, _), d in zip(texts, docs, strict=True):
            m = 100 - 25 + 25 * d.total() * big_n // max(length, 1)
            score = sum(math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * d[t] // (1000 * d[t] + 12 * m)) for t in terms(text) if t in d)
            if score > 0:
                found.append((-score, doc_id is None, doc_id))
        out[item] = [(i + 1, d, -s) for i, (s, _, d) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return {item: rows for item, rows in out.items() if rows}


def found_by_item(docs, items, **how):
    out = {}
    for r in sorted(lexical_search.search(docs, items, **how).collect(), key=lambda r: r["rank"]):
        out.setdefault(r["item_id"], []).append((r["rank"], r["doc_id"], r["score"]))
    return out


@pytest.mark.parametrize("k, block_bytes", [(3, 1 << 20), (20, 60)])
def test_search_matches_brute_force(spark, k, block_bytes):
    rng = random.Random(k)
    weight = [1 / (i + 1) for i in range(60)]
    names = [f"w{i}" if i % 3 else f"É{i}x" for i in range(60)]

    def text(n):
        return " ".join(rng.choices(names, weight, k=n))

    texts = [(i, text(rng.randrange(80))) for i in range(1500)] + [(7, text(9)), (None, text(5)), (None, None), (2000, ""), (2001, "!?")]
    texts += [(3000 + i, "tie tie") for i in range(30)]
    items = [(i, text(rng.randrange(12))) for i in range(12)] + [(20, "tie w1 w1"), (21, None), (22, "missing word"), (None, "É0x")]
    docs, asked = spark.createDataFrame(texts, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string")
    assert found_by_item(docs, asked, k=k, block_bytes=block_bytes) == ranked(texts, items, k)


def test_places_are_kept_over_many_blocks(spark, monkeypatch):
    for name, value in {"DOCUMENTS": 64, "POSTINGS": 500, "STRIDE": 8}.items():
        monkeypatch.setattr(lexical_search, name, value)
    rng = np.random.default_rng(5)
    lists = [(np.sort(rng.choice(4000, n, replace=False)), rng.integers(1, 90 if n > 500 else 2000, n)) for n in (3900, 3000, 2500, 700, 90, 30, 5)]
    places = lexical_search.Places(20)
    for low in range(0, 4000, 64):
        own = [(d[(d >= low) & (d < low + 64)] - low, g[(d >= low) & (d < low + 64)]) for d, g in lists]
        ids = np.arange(low, low + 64)
        lexical_search.search_block([x for x in own if len(x[0])], 64, places, ids, np.zeros(64, bool), 8)
    sums = np.zeros(4000, np.int64)
    for d, g in lists:
        sums[d] += g
    want = np.lexsort((np.arange(4000), -sums))[:20]
    assert places.ids.tolist() == want.tolist() and places.score.tolist() == sums[want].tolist()


def test_search_odd_rows(spark, odd, none):
    items = spark.createDataFrame([(1, "another text of nine"), (2, None), (3, "word1 thing1"), (3, "word1 thing1"), (None, "")], "item_id long, text string")
    texts = [(r["doc_id"], r["text"]) for r in odd.collect()]
    want = ranked(texts, [(1, "another text of nine"), (3, "word1 thing1")], 20)
    assert found_by_item(odd, items) == want
    assert found_by_item(none, items) == {} and found_by_item(odd, items.limit(0)) == {}
    assert lexical_search.norms(np.array([10**8]), 10**12, 10**15)[0] == 75 + 25 * 10**8 * 10**12 // 10**15
