"""The registered queries: thin digests of what the operators return."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlight.llm import collocations, decontaminate, exact_dedup, langid, lexical_search, licenses, quotes, repeated_phrases, secrets, sentencepiece_codec, simhash, suffix_dedup, toxicity
from wardlight.llm.common import held_out, table, text_of
from wardlight.session import settle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = lambda spark, sf_dir: fn(settle(spark), sf_dir)
    return fn


@query
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_dedup.exact_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


ORACLE["op8_exact_dedup"] = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@query
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    predicted = (F.col("score") >= toxicity.THRESHOLD).cast("int")
    return scored.select("doc_id", held_out().alias("held_out"), "score", predicted.alias("predicted"), F.size("passages").alias("n_passages"))


@query
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, and whether they decode to that text."""
    vocabulary = sentencepiece_codec.load()
    docs = table(spark, sf_dir, "documents")
    coded = sentencepiece_codec.encode(docs, vocabulary, ["doc_id", F.sha2(text_of(), 256).alias("text_sha256")])
    back = sentencepiece_codec.decode(coded, vocabulary, ["doc_id", "text_sha256", "ids"])
    return back.select("doc_id", F.size("ids").alias("n_tokens"), "ids", (F.sha2("text", 256) == F.col("text_sha256")).alias("round_trip"))


@query
def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secrets.find_secrets(docs, secrets.dictionary(docs))

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def of(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "novel")
    return found.select("doc_id", of("assign"), of("access"), of("hex"), F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"), of("novel"))


@query
def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.fit(docs)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


@query
def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.find_licenses(table(spark, sf_dir, "documents"))


@query
def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    stripped = repeated_phrases.strip_repeats(table(spark, sf_dir, "documents"))
    return stripped.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op2_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.link(table(spark, sf_dir, "conversations"))


@query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


_CAPITALS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

ORACLE["op11_collocations"] = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), {_CAPITALS}), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
split AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS words FROM pieces),
totals AS (SELECT lang, sum(len(words)) AS n FROM split GROUP BY lang),
places AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM split),
grams AS (SELECT lang, k, array_to_string(words[i : i + k - 1], ' ') AS phrase FROM places, range(1, 6) s(k) WHERE i + k - 1 <= len(words)),
f AS (SELECT lang, phrase, k AS size, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 100),
candidates AS (SELECT lang, phrase, size, a, string_split(phrase, ' ') AS words FROM f WHERE size >= 2),
cuts AS (
  SELECT c.lang, c.phrase, c.a, k, l.a AS l, r.a AS r, n, (1000::HUGEINT * c.a * n) // (l.a::HUGEINT * r.a) AS score
  FROM candidates c JOIN range(1, 5) s(k) ON k < c.size
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(words[1 : k], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(words[k + 1 : c.size], ' ')
  JOIN totals t ON t.lang = c.lang),
scored AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_runs AS (
  SELECT lang, array_to_string(words[i : i + k - 1], ' ') AS phrase, max(a) AS longer
  FROM candidates, range(2, 5) s(k), range(1, 5) p(i) WHERE k < size AND i + k - 1 <= size GROUP BY ALL)
SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank, s.phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM scored s LEFT JOIN inner_runs i ON i.lang = s.lang AND i.phrase = s.phrase
WHERE longer IS NULL OR 100 * longer < 100 * a
QUALIFY rank <= 2000
"""


@query
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE["op13_lexical_search"] = rf"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, translate(coalesce(text, ''), {_CAPITALS}) AS text FROM documents),
items AS (SELECT row_number() OVER () AS item, item_id, text FROM (SELECT DISTINCT item_id, translate(coalesce(text, ''), {_CAPITALS}) AS text FROM benchmark)),
terms AS (SELECT row, doc_id, unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
asked AS (SELECT item, item_id, unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM items),
lengths AS (SELECT row, count(*) AS n FROM terms GROUP BY row),
whole AS (SELECT count(*) AS docs_n, sum(n)::BIGINT AS terms_n FROM lengths),
tf AS (SELECT row, doc_id, term, count(*) AS tf FROM terms WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2.0::DOUBLE * docs_n + 2) / (2.0::DOUBLE * count(*) + 1)))::BIGINT AS w FROM tf, whole GROUP BY term, docs_n),
gains AS (
  SELECT row, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * docs_n) // terms_n))) AS gain
  FROM tf JOIN lengths USING (row) JOIN weights USING (term), whole),
scores AS (SELECT item, item_id, row, doc_id, sum(gain)::BIGINT AS score FROM asked JOIN gains USING (term) GROUP BY ALL HAVING sum(gain) > 0)
SELECT item_id, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
FROM scores QUALIFY rank <= 20
"""


@query
def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    stripped = suffix_dedup.strip_repeats(table(spark, sf_dir, "documents"))
    return stripped.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
