"""One query per operator, over the whole of its table, with production parameters."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import collocations, cover_tree, decontaminate, ngram_join, packing, pii, secrets, sharding, token_counts, topk_products, toxicity, url_filter, warc_zstd
from .common import shared_folder, table, tokenizer_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return register


def _held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


@query("op1_toxicity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels, ~_held_out())
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id", _held_out().alias("held_out"), "score", "predicted", F.size("segments").cast("long").alias("n_segments"))


@query("op5_ngram_jaccard_join")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicate_components(table(spark, sf_dir, "documents"))


@query("op3_pii")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *[count(k) for k in pii.KINDS], F.sha2(pii.spans_text(F.col("base")), 256).alias("base_sha256"),
        pii.spans_text(F.concat("base", "added")).alias("spans"))


@query("op4_best_fit_packing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


@query("op10_benchmark_decontamination")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op9_token_counts")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.with_token_counts(docs, tokenizer_path("byte_bpe_50k.json"))
    return counted.select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "n_tokens",
        (F.col("n_tokens") > 1024).alias("over_limit"))


@query("op2_exact_topk")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_products.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


#: The rules as given.
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


@query("op6_url_filter")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.verdicts(pages, URL_RULES).drop("url")


@query("op8_sharding")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    dealt = sharding.deal(sharding.external_shuffle(docs), 8)
    return dealt.select(
        "doc_id", sharding.record_size(F.col("text")).alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query("op7_secret_scan")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan(docs, secrets.fit(docs))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")

    everything = F.array_sort(F.transform(F.concat("base", "added"), lambda s: F.struct(
        s["start"].alias("start"), F.array_position(F.array(*map(F.lit, (*secrets.KINDS, "learned"))), s["kind"]).alias("rank"),
        s["stop"].alias("stop"), s["kind"].alias("kind"))))
    return found.select(
        "doc_id", *[count(k) for k in secrets.KINDS], F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(everything).alias("spans"))


@query("op11_phrase_collocations", """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
split AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM split GROUP BY lang),
grams AS (
  SELECT lang, k, unnest([w[i:i + k - 1] FOR i IN range(1, len(w) - k + 2)]) AS g
  FROM split, (VALUES (1), (2), (3), (4)) AS lengths(k)),
f AS (SELECT lang, k, array_to_string(g, ' ') AS phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 30),
cand AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
inside AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, a, array_to_string(w[i:i + m - 1], ' ') AS phrase
    FROM cand, (VALUES (2), (3)) AS inner_lengths(m), (VALUES (1), (2), (3)) AS starts(i) WHERE m < k AND i + m - 1 <= k)
  GROUP BY ALL),
kept AS (SELECT c.* FROM cand c LEFT JOIN inside i USING (lang, phrase) WHERE longer IS NULL OR longer::HUGEINT * 100 < a::HUGEINT * 80),
cuts AS (
  SELECT c.lang, c.phrase, a, j, l.f AS l, r.f AS r, (a::HUGEINT * 2000000) // (l.f::HUGEINT + r.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM kept) c
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(w[1:j], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(w[j + 1:c.k], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM best JOIN totals USING (lang) QUALIFY rank <= 2000
""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def _lloyd_sql(rounds: int = 2) -> str:
    """The codes by plain comparison with every entry, for vectors of 64 components."""
    square = " + ".join(f"(p.x[{j}] - b.x[{j}]) * (p.x[{j}] - b.x[{j}])" for j in range(1, 5))
    mean = ", ".join(f"floor(sum(p.x[{j}]) / count(*))::BIGINT" for j in range(1, 5))
    steps = ["""
kept AS (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS row, vec_id, label, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
p AS (SELECT row, part, v[4 * part + 1:4 * part + 4] AS x FROM kept, range(16) AS parts(part)),
b0 AS (SELECT part, row - 1 AS entry, x FROM p WHERE row <= 64)"""]
    for i in range(rounds + 1):
        steps.append(f"""
a{i} AS (
  SELECT row, part, min({{'d': {square}, 'entry': b.entry}}) AS best FROM p JOIN b{i} b USING (part) GROUP BY row, part)""")
        if i < rounds:
            steps.append(f"""
m{i} AS (SELECT part, best.entry AS entry, [{mean}] AS x FROM p JOIN a{i} USING (row, part) GROUP BY ALL),
b{i + 1} AS (SELECT part, entry, coalesce(m.x, b.x) AS x FROM b{i} b LEFT JOIN m{i} m USING (part, entry))""")
    return f"""WITH {",".join(steps)},
book AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{rounds}),
code AS (
  SELECT row, string_agg(format('{{:02x}}', best.entry), '' ORDER BY part) AS code, sum(best.d)::BIGINT AS error FROM a{rounds} GROUP BY row)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM code JOIN kept USING (row), book"""


@query("op12_vector_codes", _lloyd_sql())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = cover_tree.compress(table(spark, sf_dir, "embeddings"))
    digest = hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
    return cover_tree.with_label_error(codes).select(
        F.col("id").alias("vec_id"), F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


@query("op13_warc_archives", """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages),
bits AS (
  SELECT *, array_to_string([format('{:04b}', instr('0123456789abcdef', c) - 1) FOR c IN string_split(sha1(html), '')], '') AS b FROM p)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_sum([substr(b, 5 * i + j, 1)::INT << (5 - j) FOR j IN range(1, 6)])::INT, 1)
                        FOR i IN range(32)], '') AS payload_digest,
       CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM bits
""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/archives-{uuid.uuid4().hex}"
    warc_zstd.write_pages(table(spark, sf_dir, "pages"), path)
    found = warc_zstd.read_archives(spark, path, payloads=False)
    # A broken place in archives just written is a fault, not a row less.
    sound = F.when(F.col("error").isNotNull(), F.raise_error(F.concat_ws(": ", "archive", "error")))
    return found.select(
        warc_zstd.page_of(F.coalesce(sound, F.col("record_id"))).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        warc_zstd.page_of(F.col("refers_to")).alias("refers_to"))
