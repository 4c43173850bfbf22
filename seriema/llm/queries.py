"""Registered queries of the operators, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import constant_frame, scratch_path, stage
from . import chat, codes, minhash, mixing, packing, periods, quality, recompression, rules, suffixes, toxicity, vectors, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with its SQL where there is one."""
    def register(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


WORDS_SQL = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"

MIXING_SQL = f"""
WITH sized AS (
  SELECT doc_id, source, len({WORDS_SQL})::BIGINT AS size FROM documents
), keyed AS (
  SELECT *, md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, '?') || ':' || size::VARCHAR) AS k FROM sized
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM sized GROUP BY source
), weighed AS (
  SELECT source, source_size, 3 * source_size AS cap,
         CASE place % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM sources
), filled AS (
  -- In the order of cap by weight, the clamped ones come first.
  SELECT *, (SELECT sum(source_size) FROM sources)
              - coalesce(sum(cap) OVER up, 0) AS left_before,
            sum(weight) OVER () - coalesce(sum(weight) OVER up, 0) AS weight_before
  FROM weighed
  WINDOW up AS (ORDER BY cap::DOUBLE / weight, source NULLS LAST
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), clamps AS (
  SELECT *, (weight * left_before)::DOUBLE / weight_before::DOUBLE > cap AS clamped FROM filled
), aimed AS (
  SELECT source, source_size, CASE WHEN clamped THEN cap::DOUBLE ELSE
    (weight * ((SELECT sum(source_size) FROM sources)
               - (SELECT coalesce(sum(cap), 0) FROM clamps WHERE clamped)))::DOUBLE
    / (SELECT sum(weight) FROM clamps WHERE NOT clamped)::DOUBLE END AS target FROM clamps
), planned AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM aimed
), budgets AS (
  SELECT *, greatest(0, round(target - whole * source_size))::BIGINT AS budget FROM planned
), runs AS (
  SELECT source, k, sum(size)::BIGINT AS words, count(*) AS n,
         (sum(sum(size)) OVER (PARTITION BY source ORDER BY k))::BIGINT AS upto FROM keyed GROUP BY source, k
)
SELECT d.doc_id, d.size, b.source_size, b.target,
       (b.whole * d.size + CASE WHEN r.upto <= b.budget THEN d.size
          WHEN r.upto - r.words >= b.budget THEN 0
          ELSE (b.budget - (r.upto - r.words)) // r.n END)::BIGINT AS taken
FROM keyed d JOIN budgets b ON d.source IS NOT DISTINCT FROM b.source
JOIN runs r ON r.source IS NOT DISTINCT FROM d.source AND r.k = d.k
"""


@query(MIXING_SQL)
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


RULES_SQL = f"""
WITH cut AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, {WORDS_SQL} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l
  FROM documents
), windows AS (
  SELECT rid, unnest(range(1, len(w) - 3)) AS i, w FROM cut WHERE len(w) >= 5
), placed AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, w[i:i + 4]) AS n FROM windows
), covered AS (
  SELECT rid, count(DISTINCT j)::BIGINT AS n_repeat_words
  FROM (SELECT rid, unnest(range(i, i + 5)) AS j FROM placed WHERE n > 1) GROUP BY rid
), measured AS (
  SELECT rid, doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(l)::BIGINT AS n_lines,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         len(regexp_extract_all(text, '\\p{{Lu}}')) AS n_upper,
         len(regexp_extract_all(text, '!')) AS n_exclamations
  FROM cut LEFT JOIN covered USING (rid)
), judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (10 * n_symbols > n_words AND n_symbols > 5)
       AND NOT (10 * n_dup_lines > 5 * n_lines)
       AND NOT (word_chars < 2 * n_words OR word_chars > 15 * n_words)
       AND NOT (10 * n_upper > 6 * word_chars) AND NOT (10 * n_exclamations > 3 * n_words) AS kept
FROM judged
"""


@query(RULES_SQL)
def op5_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements of every document, the two base rules and the verdict of the current policy."""
    entries = rules.ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return entries.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~rules.passes("base")).alias("base_failed"), rules.passes().alias("kept"),
    )


@query()
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, by a network that never sees the held-out third."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    params = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, params).select(
        "doc_id", quality.held_out().alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query()
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity of every document, and whether it is toxic."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", "severity", "p_toxic", "toxic")


@query()
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every piece of every document in the training sequences."""
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"))


SHINGLES_SQL = """
WITH cut AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), sets AS (
  SELECT rid, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM cut
)"""


@query()
def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under links between sets of two-word shingles."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=2, exact=True)


WINDOWS_SQL = f"""
WITH cut AS (
  SELECT row_number() OVER () AS rid, doc_id, {WORDS_SQL} AS w FROM documents
), windows AS (
  SELECT rid, doc_id, i, md5(array_to_string(w[i:i + 12], ' ')) AS h
  FROM (SELECT rid, doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM cut WHERE len(w) >= 13)
), firsts AS (
  SELECT h, min(doc_id) AS first_id FROM windows GROUP BY h
), gone AS (
  SELECT rid, list(DISTINCT j) AS places FROM (
    SELECT rid, unnest(range(i, i + 13)) AS j FROM windows JOIN firsts USING (h) WHERE first_id < doc_id
  ) GROUP BY rid
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(places), 0)::BIGINT AS n_removed,
       sha256(array_to_string(CASE WHEN places IS NULL THEN w ELSE
         list_transform(list_filter(list_zip(w, range(1, len(w) + 1)), lambda z: NOT list_contains(places, z[2])), lambda z: z[1])
         END, ' ')) AS kept_sha256
FROM cut LEFT JOIN gone USING (rid)
"""


@query(WINDOWS_SQL)
def op9_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that stay when windows of 13 words found in earlier documents go."""
    return recompression.digests(table(spark, sf_dir, "documents"))


@query()
def op2_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that stay when strings of 50 bytes found in earlier documents go."""
    return suffixes.spans(table(spark, sf_dir, "documents"))


WARC_SQL = """
WITH digests AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
), firsts AS (
  SELECT *, min(page_id) OVER (PARTITION BY h) AS first_id FROM digests
)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         ((('0x' || substr(h, (i // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM firsts
"""


@query(WARC_SQL)
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, written to an archive and read back from it."""
    path = scratch_path(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), path)
    return warc.catalogued(stage(warc.read(spark, path), "warc-records"))


@query()
def op7_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector at a cosine of 0.95."""
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


ESCAPED_SQL = "replace(replace(replace({}, '\\', '\\s'), '<turn', '\\lturn'), '</turn', '\\l/turn')"
CHAT_SQL = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length({ESCAPED_SQL.format("role")}) + length({ESCAPED_SQL.format("text")})
           + length(role) - length(replace(role, '>', '')) + {len(chat.OPEN + chat.CLOSE + chat.END)})::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""


@query(CHAT_SQL)
def op11_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns and trainable text of every conversation, read back from its examples."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = "\\### Assistant: </turn> ok"
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
    planted = constant_frame(spark, given.columns, [(-7, 0, "user", text), (-7, 1, "assistant", text)], kinds)
    return chat.digests(chat.examples(given.unionByName(planted)))


def _codes_sql(rounds: int = codes.ROUNDS) -> str:
    steps = [f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS rid, vec_id, label,
         list_transform(embedding, lambda x: floor({codes.SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT rid, p, v[p * (len(v) // {codes.PARTS}) + 1:(p + 1) * (len(v) // {codes.PARTS})] AS x FROM kept, range({codes.PARTS}) r(p)
), book0 AS MATERIALIZED (
  SELECT p, rid - 1 AS e, x AS y FROM parts WHERE rid <= {codes.ENTRIES}
)"""]
    for r in range(rounds + 1):
        steps.append(f""", near{r} AS MATERIALIZED (
  SELECT rid, p, min({{'far': list_sum(list_transform(list_zip(x, y), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, 'e': e}}) AS best
  FROM parts JOIN book{r} USING (p) GROUP BY rid, p
)""")
        if r < rounds:
            steps.append(f""", sums{r} AS MATERIALIZED (
  SELECT p, e, k, sum(c)::BIGINT AS s, count(*) AS n FROM (
    SELECT p, best.e AS e, unnest(x) AS c, generate_subscripts(x, 1) AS k FROM parts JOIN near{r} USING (rid, p)
  ) GROUP BY p, e, k
), book{r + 1} AS MATERIALIZED (
  SELECT p, e, coalesce(m, y) AS y FROM book{r} LEFT JOIN (
    SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY k) AS m FROM sums{r} GROUP BY p, e
  ) USING (p, e)
)""")
    steps.append(f""", coded AS (
  SELECT rid, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, sum(best.far)::BIGINT AS error FROM near{rounds} GROUP BY rid
), totals AS (
  SELECT label, sum(error)::BIGINT AS label_error FROM coded JOIN kept USING (rid) GROUP BY label
)
SELECT vec_id, code, error, label_error,
       sha256((SELECT string_agg(array_to_string(y, ','), ',' ORDER BY p, e) FROM book{rounds})) AS codebooks_sha256
FROM coded JOIN kept USING (rid) JOIN totals t ON t.label IS NOT DISTINCT FROM kept.label
""")
    return "".join(steps)


CODES_SQL = _codes_sql()


@query(CODES_SQL)
def op12_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code of every vector, its error and that of its label, and the digest of the codebooks."""
    return codes.compress(table(spark, sf_dir, "embeddings"))


@query()
def op13_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, one in ten of which is made periodic, and the digest of what stays without their repeats."""
    return periods.digests(table(spark, sf_dir, "documents"), periods.seeded_period)
