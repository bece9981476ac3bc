"""One query for each corpus operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import (chosen_path, collocations, exact_dedup, licenses, line_dedup, packing, passage_dedup, pii, sentencepieces,
               simhash, topk, toxicity, vector_codes)
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer(name: str) -> str:
    """Path of a public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def held_out() -> Column:
    """Rows whose labels are kept for evaluation."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2


def learnable() -> Column:
    return ~held_out()


@query
def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = passage_dedup.dedup_passages(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
                        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    fitted, scores = toxicity.train(docs, labels.where(learnable()))
    return (toxicity.judged(scores, fitted)
            .select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"),
                    "lang_threshold", "flagged"))


@query
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.tokenize(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), with_ids=False)
    return packing.pack(pieces)


@query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    text = F.coalesce("text", F.lit(""))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2(text.cast("binary"), 256).alias("kept_sha256"))


ORACLE["op2_line_dedup"] = """
WITH lines AS (
  SELECT doc_id, UNNEST(string_split(COALESCE(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(COALESCE(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines),
judged AS (
  SELECT *, (length(k) >= 10 AND doc_id > MIN(doc_id) OVER (PARTITION BY k)) AS gone FROM keyed)
SELECT doc_id, COUNT(*) AS n_lines, COUNT(*) FILTER (WHERE gone) AS n_dropped,
       sha256(COALESCE(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


@query
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


ORACLE["op7_exact_dedup"] = """
SELECT doc_id, MAX(doc_id) OVER w AS keep_id, COUNT(*) OVER w AS group_size,
       doc_id = MAX(doc_id) OVER w AS kept, sha256(COALESCE(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY COALESCE(text, ''))
"""


@query
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "spans")
    spans = F.col("spans")
    counts = [F.size(pii.of_kinds(spans, [k])).cast("long").alias(f"n_{k}") for k in pii.BASE]
    base = pii.digest(pii.of_kinds(spans, pii.BASE))
    return found.select("doc_id", *counts, F.sha2(base.cast("binary"), 256).alias("base_sha256"), pii.digest(spans).alias("spans"))


@query
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = tokenizer("piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents")
    return sentencepieces.round_trip(docs, model).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_ids"), F.crc32("ids").alias("ids_crc32"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    base = F.array_sort(F.array_distinct("places.label"))
    every = F.array_sort(F.array_distinct(F.concat("places.label", "spans.label")))
    cover = F.coalesce(F.array_max("spans.cover"), F.lit(0.0))
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min("places.start").alias("first_word"),
        F.array_max("places.start").alias("last_word"), F.array_join(base, ",").alias("base_labels"), F.array_join(every, ",").alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(cover).alias("score"))


@query
def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


ORACLE["op8_exact_top_k"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
ranked AS (
  SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


ORACLE["op11_collocations"] = r"""
WITH pieces AS (
  SELECT COALESCE(lang, 'und') AS lang, UNNEST(regexp_split_to_array(
    translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
worded AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
grams AS (SELECT lang, t.n, array_to_string(list_slice(w, i, i + t.n - 1), ' ') AS phrase
  FROM (SELECT lang, w, t.n, UNNEST(range(1, CAST(len(w) - t.n + 2 AS BIGINT))) AS i FROM worded, (VALUES (1), (2), (3)) t(n) WHERE len(w) >= t.n) t),
f AS MATERIALIZED (SELECT lang, n, phrase, COUNT(*) AS f FROM grams GROUP BY lang, n, phrase),
total AS (SELECT lang, CAST(SUM(f) AS BIGINT) AS n FROM f WHERE n = 1 GROUP BY lang),
cand AS (SELECT lang, n, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE n > 1 AND f >= 10),
cuts AS (SELECT lang, phrase, a, k, array_to_string(list_slice(w, 1, k), ' ') AS x, array_to_string(list_slice(w, k + 1, n), ' ') AS y
  FROM (SELECT *, UNNEST(range(1, n)) AS k FROM cand)),
cut AS (SELECT c.lang, c.phrase, c.a, c.k, l.f AS l, r.f AS r,
  CAST((CAST(1000000 AS HUGEINT) * c.a * c.a) // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
  FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = c.x JOIN f r ON r.lang = c.lang AND r.phrase = c.y),
best AS (SELECT * FROM cut QUALIFY ROW_NUMBER() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
holders AS (SELECT lang, part, MAX(a) AS longer FROM (
  SELECT lang, a, array_to_string(list_slice(w, i, i + 1), ' ') AS part FROM (SELECT *, UNNEST([1, 2]) AS i FROM cand WHERE n = 3)) GROUP BY lang, part),
kept AS (SELECT b.* FROM best b LEFT JOIN holders h ON b.lang = h.lang AND b.phrase = h.part WHERE h.longer IS NULL OR 100 * h.longer < 50 * b.a),
ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, total.n AS n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""


@query
def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.near_duplicates(table(spark, sf_dir, "documents"))


ORACLE["op12_minhash"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                   '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS g
  FROM (SELECT doc_id, w, UNNEST(range(1, CAST(greatest(len(w), 2) AS BIGINT))) AS i FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, COUNT(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, COUNT(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS MATERIALIZED (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 80 * (nx.n + ny.n - c)),
e AS MATERIALIZED (SELECT x AS u, y AS v FROM l UNION SELECT y, x FROM l),
r(u, v) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.u, e.v FROM r JOIN e ON r.v = e.u),
c AS (SELECT u AS doc_id, MIN(v) AS component_id FROM r GROUP BY u)
SELECT c.doc_id, COALESCE(n.n, 0) AS n_shingles, component_id, c.doc_id = component_id AS kept FROM c LEFT JOIN n ON c.doc_id = n.doc_id
"""


@query
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    digest = "" if books is None else vector_codes.books_digest(books)
    return vector_codes.with_label_error(codes).select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _codes_sql() -> str:
    p, k, rounds = vector_codes.PARTS, vector_codes.ENTRIES, vector_codes.ROUNDS
    ctes = [f"""v AS MATERIALIZED (SELECT vec_id, label,
  list_transform(embedding, lambda x: CAST(floor({vector_codes.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
            f"""parts AS MATERIALIZED (SELECT v.vec_id, v.label, t.p AS p, list_slice(e, t.p * len(e) // {p} + 1, (t.p + 1) * len(e) // {p}) AS x
  FROM v, range({p}) t(p))""",
            f"""b0 AS MATERIALIZED (SELECT p, i, x FROM (SELECT p, x, ROW_NUMBER() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS i FROM parts) WHERE i < {k})"""]
    for r in range(rounds + 1):
        ctes.append(f"""a{r} AS MATERIALIZED (SELECT vec_id, ANY_VALUE(label) AS label, p, ANY_VALUE(x) AS x, MIN(d * {k} + i) % {k} AS i, MIN(d) AS d FROM (
  SELECT parts.vec_id, parts.label, parts.p, parts.x, b.i,
    CAST(list_sum(list_transform(list_zip(parts.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
  FROM parts JOIN b{r} b ON parts.p = b.p) GROUP BY vec_id, p)""")
        if r < rounds:
            ctes.append(f"""m{r} AS MATERIALIZED (SELECT p, i, list((s - ((s % n) + n) % n) // n ORDER BY j) AS x FROM (
  SELECT p, i, j, SUM(c) AS s, COUNT(*) AS n FROM (SELECT p, i, UNNEST(x) AS c, generate_subscripts(x, 1) AS j FROM a{r}) GROUP BY p, i, j) GROUP BY p, i)""")
            ctes.append(f"""b{r + 1} AS MATERIALIZED (SELECT b.p, b.i, COALESCE(CAST(m.x AS BIGINT[]), b.x) AS x FROM b{r} b LEFT JOIN m{r} m ON b.p = m.p AND b.i = m.i)""")
    return f"""WITH {", ".join(ctes)},
digest AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, i)) AS h FROM b{rounds}),
coded AS (SELECT vec_id, ANY_VALUE(label) AS label, string_agg(printf('%02x', CAST(i AS INTEGER)), '' ORDER BY p) AS code, CAST(SUM(d) AS BIGINT) AS error
  FROM a{rounds} GROUP BY vec_id)
SELECT vec_id, code, error, CAST(SUM(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, (SELECT h FROM digest) AS codebooks_sha256 FROM coded"""


ORACLE["op13_vector_codes"] = _codes_sql()
