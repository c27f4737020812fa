import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from wardlight.llm import langid, quotes, repeated_phrases, sentencepiece_codec, words
from wardlight.llm.common import byte_view

import pyarrow as pa

SF = "/root/testdata/sf0.001"


@given(st.lists(st.text(alphabet="aB \t\n\x1fé中\U0001f600.", max_size=30), max_size=6))
@settings(max_examples=150, deadline=None)
def test_spans_split_like_bytes(texts):
    data, offsets = byte_view(pa.array(texts, pa.string()))
    starts, ends, firsts = words.spans(data, offsets, "spaced")
    got = [[data[s:e].tobytes() for s, e in zip(starts[a:b], ends[a:b], strict=True)] for a, b in zip(firsts, firsts[1:], strict=False)]
    assert got == [t.encode().split() for t in texts]
    hashes = words.hashes(data, starts, ends)
    flat = [w for ws in got for w in ws]
    assert len(set(hashes.tolist())) == len(set(flat))
    assert dict(zip(flat, hashes.tolist(), strict=True)) == {w: h for w, h in zip(flat, hashes.tolist(), strict=True)}


def tiny():
    pieces = [("<unk>", 0.0), *((f"<0x{b:02X}>", 0.0) for b in range(256))]
    texts = ["▁", "a", "b", "c", "▁a", "ab", "bc", "abc", "▁▁", "▁ab", "é"]
    pieces += [(t, -float(i) / 3) for i, t in enumerate(texts)]
    return sentencepiece_codec.vocabulary(pieces, {b: b + 1 for b in range(256)}, {0})


def brute(text, v):
    """The same rule over the whole text, one text at a time."""
    if not text:
        return []
    units = ["L" if c == "▁" else "▁" if c == " " else c for c in " " + text]
    known = {v.raw[i].decode().replace(" ", "▁"): int(i) for i in v.ids}
    best = [(0.0, 0, 0)] + [(-1e18, 0, 0)] * len(units)
    for end in range(1, len(units) + 1):
        for k in range(1, min(v.longest, end) + 1):
            part = units[end - k : end]
            i = known.get("".join(part)) if "L" not in part else None
            worth = v.scores[i] if i is not None else v.unknown if k == 1 else None
            if worth is not None and best[end - k][0] + worth > best[end][0]:
                best[end] = (best[end - k][0] + worth, k, i)
    out, end = [], len(units)
    while end:
        _, k, i = best[end]
        text_ = "▁" if units[end - 1] == "L" else units[end - 1]
        out.append([i] if i is not None else [int(v.byte_ids[b]) for b in text_.encode()])
        end -= k
    return [i for part in reversed(out) for i in part]


@given(st.lists(st.text(alphabet="aabbcc  \n▁é中\x00", max_size=25), max_size=5))
@settings(max_examples=200, deadline=None)
def test_viterbi_and_round_trip(texts):
    v = tiny()
    ids, counts = sentencepiece_codec.Encoder(v).encode(texts)
    ends = np.cumsum(counts)
    assert [ids[e - n : e].tolist() for e, n in zip(ends, counts, strict=True)] == [brute(t, v) for t in texts]
    assert sentencepiece_codec.decode_ids(ids.astype(np.int64), counts, v) == texts


def test_codec_odd_rows(spark, odd, none):
    v = sentencepiece_codec.load()
    coded = sentencepiece_codec.encode(odd, v, ["doc_id", "text", "key"])
    back = sentencepiece_codec.decode(coded.withColumnRenamed("text", "was"), v, ["doc_id", "was", "key"])
    rows = back.collect()
    assert len(rows) == odd.count() and all(r["text"] == (r["was"] or "") for r in rows)
    assert sentencepiece_codec.encode(none, v, ["doc_id"]).count() == 0
    strange = spark.createDataFrame([([-1, 99_999, 0, 1, None],), (None,)], "ids array<int>")
    assert [r["text"] for r in sentencepiece_codec.decode(strange, v, [sentencepiece_codec.F.lit(1).alias("x")]).collect()] == ["", ""]


def test_language_of_documents_never_learned_from(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = langid.predict(docs, langid.fit(docs)).join(docs, "doc_id").filter("crc32(cast(doc_id as string)) % 4 = 2").toPandas()
    assert (found.lang == found.lang_pred).mean() > 0.97
    assert found.score.between(0, 1).all()


def test_ftrl_learns_and_keeps_weights_sparse():
    rng = np.random.default_rng(0)
    model = langid.Ftrl(2)
    for _ in range(400):
        y = int(rng.integers(0, 2))
        model.step(np.array([y, 2, int(rng.integers(10, 5000))]), np.array([1.0, 1.0, 0.0]), y)
    w = model.weights(np.arange(5000))
    assert w[0, 0] > w[0, 1] and w[1, 1] > w[1, 0]
    assert (w[10:] == 0).all()


def test_temperature_flattens_what_is_too_sure():
    rng = np.random.default_rng(0)
    logits = rng.normal(0, 1, (4000, 3))
    shares = np.exp(logits) / np.exp(logits).sum(axis=1, keepdims=True)
    truth = np.array([rng.choice(3, p=p) for p in shares])
    assert abs(langid.temperature(5 * logits, truth) - 5) < 0.6


def test_language_odd_rows(odd, none):
    for model in (langid.fit(odd), langid.fit(none)):
        rows = langid.predict(odd, model).collect()
        assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
        assert {r["lang_pred"] for r in rows if r["doc_id"] in (1, 2, 3, 7)} == {"und"}
        assert langid.predict(none, model).count() == 0


def test_signs_beyond_the_first_plane_are_no_letters(spark):
    docs = spark.createDataFrame([(i, f"text number {i} of words", "en") for i in range(40)], "doc_id long, text string, lang string")
    odd = spark.createDataFrame([(1, "\U0001f389\U0001f389", "en"), (2, "\U0001f600 \U0001d7d8", None), (3, "\U00020000", None)], docs.schema)
    rows = {r["doc_id"]: r for r in langid.predict(odd, langid.fit(docs)).collect()}
    assert [(rows[i]["lang_pred"], rows[i]["score"]) for i in (1, 2)] == [("und", 0.0)] * 2 and rows[3]["lang_pred"] == "en"
    assert langid.runs(["a\U0001f389b"])[0].tolist() == langid.runs(["a b"])[0].tolist()


def test_every_language_is_a_class(spark, monkeypatch):
    monkeypatch.setattr(langid, "LANGUAGES", 2)
    said = {"en": "the cat and the dog", "de": "der Hund und die Katze", "fr": "le chien avec une souris", "fi": "kissa ja koira talossa"}
    rows = [(i * 10 + k, f"{text} {text}", lang) for i in range(60) for k, (lang, text) in enumerate(said.items())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs)
    assert model.languages == sorted(said)
    assert langid.predict(docs, model).join(docs, "doc_id").filter("lang != lang_pred").count() == 0


def stripped(rows):
    """Brute force over (doc_id, text)."""
    seen, out = set(), {}
    for i, text in sorted(rows):
        w = text.encode().split()
        stay = [True] * len(w)
        for p in range(len(w) - 19):
            window = tuple(w[p : p + 20])
            if window in seen:
                stay[p : p + 20] = [False] * 20
            seen.add(window)
        out[i] = (len(w), len(w) - sum(stay), b" ".join(x for x, s in zip(w, stay, strict=True) if s).decode())
    return out


def test_repeated_phrases_match_brute_force(spark):
    rng = np.random.default_rng(2)

    def prose(n):
        return [f"w{x}" for x in rng.integers(0, 60, n)]

    line = prose(25)
    rows = []
    for i in range(60):
        text = prose(int(rng.integers(0, 90)))
        if i % 3:
            at = int(rng.integers(0, len(text) + 1))
            text[at:at] = line[int(rng.integers(0, 4)) :]
        if i % 7 == 0:
            text = text + text
        if i % 11 == 0:
            text = ["same"] * 50
        rows.append((i, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for most in (20_000, 2):
        got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in repeated_phrases.strip_repeats(docs, most).collect()}
        assert got == stripped(rows)


def test_repeated_phrases_odd_rows(odd, none):
    rows = repeated_phrases.strip_repeats(odd).collect()
    assert len(rows) == odd.count()
    by_id = {}
    for r in rows:
        by_id.setdefault(r["doc_id"], []).append((r["n_words"], r["n_removed"]))
    assert by_id[5] == [(60_000, 60_000)] * 2  # a repeated row is one document
    assert by_id[4][0][1] < 60_000 and by_id[7] == [(0, 0)]
    assert repeated_phrases.strip_repeats(none).count() == 0


def test_quotes_are_linked(spark):
    rows = [
        (1, 1, "u", "Hello there friend\nHow are you?"), (1, 2, "a", "> How are you?\nFine, thanks"),
        (1, 3, "u", "On Monday X wrote:\n>> How are you?\n> fine,   thanks\ngood"), (1, 4, "u", "> Hello there friend\nback"),
        (2, 1, "u", "> good\nsame"), (2, 1, "u", "> good\nsame"), (2, 2, "u", "> nobody said this\nanswer"), (None, 1, "x", None), (3, None, None, "z"),
    ]
    got = {(r["conv_id"], r["turn"]): r for r in quotes.link(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")).collect()}
    assert len(got) == 8
    reply = {k: (r["reply_conv"], r["reply_turn"]) for k, r in got.items()}
    assert reply == {(1, 1): (None, None), (1, 2): (1, 1), (1, 3): (1, 2), (1, 4): (1, 1), (2, 1): (1, 3), (2, 2): (2, 1), (None, 1): (None, None), (3, None): (None, None)}
    assert got[2, 2]["depth"] == 4 and (got[2, 2]["thread_conv"], got[2, 2]["thread_turn"]) == (1, 1)
    assert got[1, 3]["body"] == "good" and got[1, 3]["levels"] == 2


def test_nested_quotes_are_linked(spark):
    rows = [
        (1, 1, "u", "the first words"), (1, 2, "a", "an answer"), (1, 3, "u", "something else"),
        (1, 4, "a", ">> the first words\nonly nested"), (1, 5, "u", "> nobody said this\n>> an answer\n>>> the first words\nunknown above"),
        (1, 6, "a", "> something else\n>> the first words\nboth"), (2, 1, "u", ">>> something else\nelsewhere"),
    ]
    got = {(r["conv_id"], r["turn"]): r for r in quotes.link(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")).collect()}
    reply = {k: (r["reply_conv"], r["reply_turn"]) for k, r in got.items()}
    assert reply == {(1, 1): (None, None), (1, 2): (1, 1), (1, 3): (1, 2), (1, 4): (1, 1), (1, 5): (1, 2), (1, 6): (1, 3), (2, 1): (1, 3)}
    originals = {k: [tuple(x) for x in r["originals"]] for k, r in got.items()}
    assert originals == {(1, 1): [], (1, 2): [], (1, 3): [], (1, 4): [(2, 1, 1)], (1, 5): [(2, 1, 2), (3, 1, 1)], (1, 6): [(1, 1, 3), (2, 1, 1)], (2, 1): [(3, 1, 3)]}


def test_latest_before_over_slices(spark):
    rng = np.random.default_rng(4)
    held = [(int(c), int(k), int(t), int(t)) for c, k, t in zip(rng.integers(0, 3, 80), rng.integers(0, 3, 80), rng.integers(0, 50, 80), strict=True)]
    asked = [(int(c), int(k), int(t)) for c, k, t in zip(rng.integers(0, 3, 80), rng.integers(0, 3, 80), rng.integers(0, 50, 80), strict=True)]
    found = quotes.latest_before(spark.createDataFrame(held, "conv long, key long, turn long, mark long"), spark.createDataFrame(asked, "conv long, key long, turn long"), chunk=7)
    got = {(r["conv"], r["key"], r["turn"]): r["source"]["turn"] for r in found.collect()}
    for c, k, t in asked:
        want = max((h[2] for h in held if h[:2] == (c, k) and h[2] < t), default=None)
        assert got.get((c, k, t)) == want


def test_quotes_empty_table(spark):
    assert quotes.link(spark.createDataFrame([], "conv_id long, turn int, role string, text string, key string")).count() == 0


def test_kept_digest(spark):
    docs = spark.createDataFrame([(1, "a  b")], "doc_id long, text string")
    row = repeated_phrases.strip_repeats(docs).selectExpr("sha2(kept, 256) AS digest").first()
    assert row["digest"] == hashlib.sha256(b"a b").hexdigest()
