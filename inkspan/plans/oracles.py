"""The registered queries as DuckDB SQL."""

from __future__ import annotations

from inkspan.operators import lsh
from inkspan.plans import queries as q
from inkspan.schemas import FAILURE_REASON


def literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# Blanks by Unicode: white space, and the separators of files, groups, records and units.
SPACES = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
BLANKS = literal(SPACES)
STEM = r"(?s)^((?:.*/)?\.*[^/.][^/]*)\.[^./]*\z"

DOCUMENTS = """docs AS (
  SELECT *, source || '/doc_' || doc_id || CASE lang WHEN 'en' THEN '.pdf' WHEN 'fr' THEN '.PDF'
    WHEN 'de' THEN '.txt' ELSE '.pdf.bak' END AS file_name FROM documents)"""


def html(column: str) -> str:
    """Without comments, scripts, styles and tags; runs of HTML blanks are one blank."""
    hidden = "(?is)<(?:!--.*?--|script\\b[^>]*>.*?</script|style\\b[^>]*>.*?</style)>"
    text = f"regexp_replace(regexp_replace({column}, '{hidden}', ' ', 'g'), '<[^>]*>', ' ', 'g')"
    return f"trim(regexp_replace({text}, '[\\t\\n\\f\\r ]+', ' ', 'g'), ' ')"


def chunked(source: str, size: int, separator: str, overlap: int = 0, fallback: bool = True) -> str:
    """CTEs that end in ``chunks(k, pos, chunk)`` over a query of (k, text)."""
    sep = len(separator)
    whole = f"""
      UNION ALL SELECT k, 0, text FROM src
      WHERE trim(text, {BLANKS}) <> '' AND k NOT IN (SELECT k FROM cut)""" if fallback else ""
    return f"""src AS ({source}),
  parts AS (
    SELECT k, ps, len(ps) AS n, list_transform(ps, lambda p: length(p)) AS ls
    FROM (SELECT k, list_filter(string_split(text, {literal(separator)}), lambda p: p <> '') AS ps
          FROM src)),
  d AS (
    SELECT *, list_prepend(0, list_transform(range(1, n + 1),
      lambda j: (list_sum(ls[1:j]) + j * {sep})::BIGINT)) AS sums FROM parts WHERE n > 0),
  fold AS (
    SELECT k, 0::BIGINT AS i, 0::BIGINT AS s, NULL::BIGINT AS first, NULL::BIGINT AS last FROM d
    UNION ALL
    SELECT k, i + 1,
      CASE WHEN over THEN list_min(list_filter(range(s, i + 1), lambda x: x = i OR
        (sums[i + 1] - sums[x + 1] - {sep} <= {overlap}
         AND sums[i + 1] - sums[x + 1] + ls[i + 1] <= {size}))) ELSE s END,
      CASE WHEN over THEN s END, CASE WHEN over THEN i END
    FROM (SELECT f.k, f.i, f.s, d.sums, d.ls,
            f.i > f.s AND d.sums[f.i + 1] - d.sums[f.s + 1] + d.ls[f.i + 1] > {size} AS over
          FROM fold f JOIN d ON f.k = d.k WHERE f.i < d.n)),
  spans AS (
    SELECT k, first, last FROM fold WHERE first IS NOT NULL
    UNION ALL SELECT f.k, f.s, f.i FROM fold f JOIN d ON f.k = d.k WHERE f.i = d.n),
  cut AS (
    SELECT k, row_number() OVER (PARTITION BY k ORDER BY first) - 1 AS pos, chunk
    FROM (SELECT spans.k, first,
            trim(array_to_string(d.ps[first + 1:last], {literal(separator)}), {BLANKS}) AS chunk
          FROM spans JOIN d ON spans.k = d.k)
    WHERE chunk <> ''),
  chunks AS (SELECT k, pos, chunk FROM cut{whole})"""


TURN_KEY = "conv_id * 1000000 + turn"
TURN_CHUNKS = chunked(
    f"SELECT {TURN_KEY} AS k, text FROM conversations", q.TURN_CHUNK_SIZE, "\n"
)
DOC_CHUNKS = chunked("SELECT doc_id AS k, text FROM documents", q.CHUNK_SIZE, "\n")

CHUNK_ROWS = f"""numbered AS (
  SELECT (k // 1000000)::VARCHAR AS file_name, (k % 1000000)::INTEGER AS document_page,
    (row_number() OVER (PARTITION BY k // 1000000 ORDER BY k, pos) - 1)::INTEGER AS chunk_no,
    chunk AS text FROM chunks)"""


def lines(source: str) -> str:
    """CTE ``lines(k, pos, line)``: stripped non-blank lines, or the page itself."""
    return f"""src AS ({source}),
  raw AS (SELECT k, text, unnest(string_split(text, chr(10))) AS line,
    generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM src),
  kept AS (SELECT k, pos, trim(line, {BLANKS}) AS line FROM raw WHERE trim(line, {BLANKS}) <> ''),
  lines AS (SELECT k, pos, line FROM kept
    UNION ALL SELECT k, 1, text FROM src WHERE text <> '' AND k NOT IN (SELECT k FROM kept))"""


TOKENS = f"list_filter(regexp_split_to_array(lower(text), '[{SPACES}]+'), lambda t: t <> '')"


def embedded(source: str, name: str) -> str:
    """CTE ``name(k, v)``: the hashing embedder over a query of (k, text)."""
    return f"""{name}_counts AS (
    SELECT k, ('0x' || substr(md5(t), 1, 8))::BIGINT % {q.DIM} AS bucket, count(*)::DOUBLE AS n
    FROM (SELECT k, unnest({TOKENS}) AS t FROM ({source})) GROUP BY ALL),
  {name}_weights AS (
    SELECT k, bucket, (n / sqrt(sum(n * n) OVER (PARTITION BY k)))::FLOAT::DOUBLE AS w
    FROM {name}_counts),
  {name} AS (
    SELECT k, list_transform(range(0, {q.DIM}),
      lambda b: coalesce(map_extract_value(m, b), 0)::DOUBLE) AS v
    FROM (SELECT k, map(list(bucket), list(w)) AS m FROM {name}_weights GROUP BY k))"""


LABEL_MEANS = """means AS (
  SELECT label, list(x ORDER BY pos) AS mean FROM (
    SELECT label, pos, round(avg(x), 6) AS x FROM (
      SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos
      FROM embeddings) GROUP BY label, pos) GROUP BY label)"""
ASKED_MEANS = "asked AS (SELECT label AS query_id, mean AS v FROM means)"
ASKED_ROWS = """asked AS (SELECT vec_id AS query_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE vec_id % 50 = 0)"""
STORED = "stored AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings)"
# NaN, infinite and NULL vectors never match; small ones do.
CLEAN = """stored AS (SELECT vec_id, CASE WHEN label = 6
    THEN list_transform(embedding::DOUBLE[], lambda x: x * 1e-6) ELSE embedding::DOUBLE[] END AS e
  FROM embeddings WHERE label NOT IN (1, 2, 4))"""
SCORED = """scored AS (
  SELECT query_id, vec_id, list_inner_product(v, e) AS score FROM asked, stored)"""
EXACT = f"""exact AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank,
    vec_id, score FROM scored QUALIFY rank <= {q.K})"""
MATCHES = "SELECT query_id, rank::INTEGER AS rank, vec_id, round(score, 6) AS score FROM {}"
ASSIGNED = """assigned AS (
  SELECT label AS list_id, vec_id FROM means, stored
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY list_inner_product(mean, e) DESC, label) = 1)"""
IVF = f"""probed AS (
  SELECT query_id, label AS list_id FROM asked, means
  QUALIFY row_number() OVER (PARTITION BY query_id
    ORDER BY list_inner_product(v, mean) DESC, label) <= {q.PROBES}),
  found AS (
  SELECT s.query_id, row_number() OVER (PARTITION BY s.query_id ORDER BY s.score DESC, s.vec_id)
    AS rank, s.vec_id, s.score
  FROM scored s JOIN assigned a USING (vec_id) JOIN probed p USING (query_id, list_id)
  QUALIFY rank <= {q.K})"""
LSH = f"""planes AS (
  SELECT t, b, list(CASE WHEN substr(md5('7:' || t || ':' || b || ':' || d), 1, 1) < '8'
    THEN -1.0::DOUBLE ELSE 1.0::DOUBLE END ORDER BY d) AS plane
  FROM range({lsh.TABLES}) r1(t), range({lsh.BITS}) r2(b), range({q.DIM}) r3(d) GROUP BY t, b),
  coded AS (
    SELECT vec_id, t, sum(CASE WHEN list_inner_product(e, plane) >= 0 THEN 1 << b ELSE 0 END)
      AS code FROM stored, planes GROUP BY vec_id, t),
  margins AS (SELECT query_id, t, b, list_inner_product(v, plane) AS m FROM asked, planes),
  costs AS (
    SELECT query_id, t, code, sum(CASE WHEN (m >= 0) = ((code >> b) & 1 = 1) THEN 0 ELSE m * m END) AS cost
    FROM margins, range({1 << lsh.BITS}) r4(code) GROUP BY query_id, t, code),
  probed AS (
    SELECT query_id, t, code FROM costs
    QUALIFY row_number() OVER (PARTITION BY query_id, t ORDER BY cost, code) <= {lsh.PROBES}),
  shared AS (SELECT DISTINCT query_id, vec_id FROM coded JOIN probed USING (t, code)),
  found AS (
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank,
      vec_id, score FROM scored JOIN shared USING (query_id, vec_id)
    QUALIFY rank <= {q.K})"""
RECALL = """SELECT query_id, count(f.vec_id) AS found, count(*) AS wanted,
  count(f.vec_id)::DOUBLE / count(*) AS recall
FROM exact LEFT JOIN found f USING (query_id, vec_id) GROUP BY query_id"""

ELEMENTS = """elements AS (
  SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS pos, unnest(embedding)::DOUBLE AS x
  FROM embeddings)"""
def half(x: str) -> str:
    step = f"pow(2.0::DOUBLE, greatest(floor(log2(abs(nullif({x}, 0)))), -14) - 10)"
    return f"""(CASE WHEN {x} = 0 THEN {x}
    WHEN abs({x}) >= 65520 THEN sign({x}) * 'Infinity'::DOUBLE
    ELSE round_even({x} / {step}, 0)::DOUBLE * {step} END)"""


HALVES = f"halves AS (SELECT vec_id, pos, x, {half('x')} AS half FROM elements)"
HALF_SCORED = f"""scored AS (
  SELECT means.label AS query_id, vec_id, list_inner_product(
    list_transform(mean, lambda x: {half('x')}),
    list_transform(embedding::DOUBLE[], lambda x: {half('x')})) AS score
  FROM means, embeddings)"""


def bits(x: str, exponent_bits: int, mantissa_bits: int) -> str:
    bias = 2 ** (exponent_bits - 1) - 1
    size = f"abs({x})"
    exponent = f"floor(log2(nullif({size}, 0)))"
    return f"""(CASE WHEN {size} < pow(2.0::DOUBLE, {1 - bias})
      THEN {size} * pow(2.0::DOUBLE, {bias - 1 + mantissa_bits})
      ELSE ({exponent} + {bias}) * {2**mantissa_bits}
        + ({size} / pow(2.0::DOUBLE, {exponent}) - 1) * {2**mantissa_bits} END)::BIGINT
      + CASE WHEN {x}::VARCHAR LIKE '-%' THEN {2 ** (exponent_bits + mantissa_bits)} ELSE 0 END"""


ROUTED = """routed AS (
  SELECT event_id, user_id, attempt, CASE WHEN NOT failed THEN 'done' WHEN attempt = 3
    THEN 'dead_letter' ELSE 'retry' END AS route
  FROM (
    SELECT *, ((row_number() OVER (PARTITION BY user_id, cycle ORDER BY ts, event_id) - 1) % 3
      + 1)::INTEGER AS attempt
    FROM (
      SELECT *, event_type = 'error' AS failed, coalesce(sum((event_type <> 'error')::INT) OVER (
        PARTITION BY user_id ORDER BY ts, event_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cycle
      FROM events)))"""
ROUTES = f"WITH {ROUTED} SELECT event_id, user_id, attempt, route FROM routed"
MANIFEST = """manifest AS (
  SELECT file_name AS key, CASE WHEN lang = 'fr' THEN reverse(md5(text))
    WHEN lang <> 'de' THEN md5(text) END AS file_hash FROM docs)"""
VERIFIED = """verified AS (
  SELECT d.doc_id, d.file_name AS key, md5(d.text) AS content_hash, m.file_hash,
    m.file_hash IS NULL OR m.file_hash = md5(d.text) AS verified
  FROM docs d LEFT JOIN manifest m ON d.file_name = m.key)"""
BODY = """'{"Records":[{"s3":{"bucket":{"name":"' || '%s' || '"},"object":{"key":"' || %s || '"}}}]}'"""
KEY = "'user_' || user_id || '.pdf'"
UNEVEN = f"""uneven AS (
  SELECT vec_id, label, CASE WHEN label = 3 THEN embedding[1:{q.DIM - 1}] ELSE embedding END AS v
  FROM embeddings)"""
TURN_TOKENS = f"len({TOKENS})::INTEGER"
CREATED = "'2024-01-01 09:00:00 JST'"

ORACLES: dict[str, str] = {
    "chunk_text": f"""WITH RECURSIVE {DOC_CHUNKS}
SELECT k AS doc_id, pos::INTEGER AS chunk_no, chunk AS text FROM chunks""",
    "chunk_overlap": f"""WITH RECURSIVE {chunked(
        "SELECT doc_id AS k, text FROM documents", q.CHUNK_SIZE, chr(10), q.OVERLAP)}
SELECT k AS doc_id, pos::INTEGER AS chunk_no, chunk AS text FROM chunks""",
    "line_chunks": f"""WITH {DOCUMENTS}, {lines("SELECT file_name AS k, text FROM docs")}
SELECT k AS file_name, 'pdf' AS file_type, '0' AS page,
  (row_number() OVER (PARTITION BY k ORDER BY pos) - 1)::INTEGER AS chunk_number, line AS text
FROM lines""",
    "line_chunks_by_file": f"""WITH {lines(f"SELECT {TURN_KEY} AS k, text FROM conversations")}
SELECT (k // 1000000)::VARCHAR AS file_name, 'pdf' AS file_type,
  (k % 1000000)::VARCHAR AS page,
  (row_number() OVER (PARTITION BY k // 1000000 ORDER BY k, pos) - 1)::INTEGER AS chunk_number,
  line AS text FROM lines""",
    "chunk_rows": f"WITH RECURSIVE {TURN_CHUNKS}, {CHUNK_ROWS} SELECT * FROM numbered",
    "chunk_rows_blocked": f"WITH RECURSIVE {TURN_CHUNKS}, {CHUNK_ROWS} SELECT * FROM numbered",
    "chunk_rows_compact": f"""WITH RECURSIVE {chunked(
        f"SELECT {TURN_KEY} AS k, text FROM conversations", q.TURN_CHUNK_SIZE, chr(10), 0, False)}
SELECT (k // 1000000)::VARCHAR AS file_name, (k % 1000000)::INTEGER AS page_num,
  pos::INTEGER AS chunk_no, chunk AS chunk_text FROM chunks""",
    "nonblank_filter": f"""WITH raw AS (
  SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos,
    unnest(string_split(text, chr(10))) AS line FROM documents)
SELECT doc_id, pos::INTEGER AS line_no, line FROM raw WHERE trim(line, {BLANKS}) <> ''""",
    "scan_suffix_filter": f"""WITH {DOCUMENTS}
SELECT file_name, ends_with(file_name, '.pdf') AS is_pdf,
  ends_with(lower(file_name), '.pdf') AS is_pdf_any_case FROM docs
WHERE ends_with(lower(file_name), '.pdf')""",
    "scan_folder": """SELECT doc_id, strlen(text)::BIGINT AS length, lang = 'en' AS is_exact
FROM documents WHERE lang IN ('en', 'fr')""",
    "page_failures": """SELECT doc_id, CASE WHEN bad THEN -1 ELSE 0 END::INTEGER AS page,
  CASE WHEN bad THEN 0 ELSE length(text) END::INTEGER AS n_chars,
  CASE WHEN bad THEN 'ValueError: a broken file' END AS error
FROM (SELECT *, octet_length(encode(text)) % 5 = 0 AS bad FROM documents)""",
    "pages_of_files": """SELECT conv_id::VARCHAR || '.txt' AS file_name, turn::INTEGER AS page, text
FROM conversations""",
    "column_listing": """SELECT (row_number() OVER () - 1)::INTEGER AS position, column_name
FROM (DESCRIBE embeddings)""",
    "chunk_keys": f"""WITH RECURSIVE {TURN_CHUNKS}, {CHUNK_ROWS}
SELECT count(*) AS n_rows, count(*) AS n_keys FROM numbered""",
    "provider_choice": f"SELECT doc_id, {TURN_TOKENS} AS total_tokens FROM documents",
    "notify_to_table": f"""WITH RECURSIVE {DOC_CHUNKS},
  counted AS (SELECT k, count(*) AS n FROM chunks GROUP BY k)
SELECT doc_id, CASE lang WHEN 'fr' THEN 3 ELSE 1 END::INTEGER AS receive_count,
  CASE lang WHEN 'fr' THEN 'dead_letter' ELSE 'done' END AS route,
  CASE lang WHEN 'fr' THEN 0 ELSE coalesce(n, 0) END::BIGINT AS n_chunks
FROM documents LEFT JOIN counted ON k = doc_id WHERE lang IN ('en', 'fr')""",
    "redrive_job": """SELECT doc_id, 1::INTEGER AS receive_count, 'done' AS route FROM documents
WHERE lang IN ('en', 'fr')""",
    "path_parts": f"""WITH named AS (
  SELECT *, string_split(url, '/')[-1] AS base_name FROM pages)
SELECT page_id, base_name, regexp_replace(url, '{STEM}', '\\1') AS stem,
  regexp_replace(base_name, '{STEM}', '\\1') || '.csv' AS csv_name, url AS slashed
FROM named""",
    "html_text": f"SELECT page_id, {html('html')} AS text FROM pages",
    "extract_pages": f"""SELECT page_id::VARCHAR AS path, 0 AS page, {html('html')} AS text,
  true AS parsed FROM pages""",
    "pages_json": """SELECT conv_id::VARCHAR AS file_name, turn::INTEGER AS page,
  to_json(struct_pack(page_content := text, metadata := struct_pack(
    source := conv_id::VARCHAR, page := turn::INTEGER)))::VARCHAR AS json FROM conversations""",
    "doc_text_join": """SELECT conv_id::VARCHAR AS file_name, turn::INTEGER AS page,
  CASE WHEN turn = min(turn) OVER (PARTITION BY conv_id) THEN '' ELSE chr(10) || chr(10) END || text
    AS text FROM conversations""",
    "csv_roundtrip": f"""WITH {ELEMENTS}
SELECT vec_id, label, '' AS text, {CREATED} AS created, pos::INTEGER AS pos, x AS value
FROM elements JOIN embeddings USING (vec_id)""",
    "csv_text_roundtrip": "SELECT doc_id, text FROM documents",
    "csv_two_step": f"""WITH RECURSIVE {TURN_CHUNKS}, {CHUNK_ROWS}
SELECT *, 'token-hash' AS model, {TURN_TOKENS} AS prompt_tokens, {q.DIM} AS n_dims
FROM numbered""",
    "append_chunks": """SELECT vec_id, label, CASE WHEN label < 5 THEN 0 ELSE 1 END AS ingest_id,
  len(embedding)::INTEGER AS n_dims FROM embeddings""",
    "failed_rerun": """SELECT vec_id, label, CASE WHEN label < 5 THEN 0 ELSE 1 END AS ingest_id
        FROM embeddings""",
    "append_empty_rerun": """SELECT vec_id, 1 AS ingest_id FROM embeddings
WHERE label >= 5 OR label IS NULL""",
    "ingest_counts": """SELECT CASE WHEN label < 3 THEN 0 WHEN label < 7 THEN 1 ELSE 2 END AS ingest_id,
  count(DISTINCT label) AS n_files, count(*) AS n_rows FROM embeddings GROUP BY ALL""",
    "table_lifecycle": """SELECT true AS kept_empty, count(*) AS n_rows, true AS dropped_filled,
  true AS then_missing, 0::BIGINT AS n_rows_again FROM embeddings""",
    "vectorize_html": f"""WITH RECURSIVE {chunked(
        f"SELECT page_id AS k, {html('html')} AS text FROM pages", q.CHUNK_SIZE, ". ")}
SELECT k::VARCHAR AS file_name, 0::INTEGER AS document_page, pos::INTEGER AS chunk_no,
  text, 'token-hash' AS model, {TURN_TOKENS} AS total_tokens, {q.DIM} AS n_dims
FROM (SELECT k, pos, chunk AS text FROM chunks)""",
    "vector_table": f"""WITH RECURSIVE {TURN_CHUNKS}, {CHUNK_ROWS}
SELECT *, 'token-hash' AS model, {TURN_TOKENS} AS prompt_tokens, {TURN_TOKENS} AS total_tokens,
  {CREATED} AS created, true AS is_normalized FROM numbered""",
    "scan_vectors": """SELECT vec_id, label, len(embedding)::INTEGER AS n_dims,
  round(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[]), 6) AS square_sum
FROM embeddings""",
    "sample_row": "SELECT vec_id, label FROM embeddings ORDER BY vec_id LIMIT 1",
    "table_profile": """SELECT count(*) AS n_rows, (SELECT count(*)::INTEGER FROM
  (DESCRIBE embeddings)) AS n_columns FROM embeddings""",
    "doc_stats": f"""WITH RECURSIVE {TURN_CHUNKS},
  per_page AS (SELECT k, count(*) AS n FROM chunks GROUP BY k)
SELECT conv_id::VARCHAR AS file_name, count(*) AS n_pages, sum(coalesce(n, 0))::BIGINT AS n_chunks
FROM conversations LEFT JOIN per_page ON k = {TURN_KEY} GROUP BY conv_id""",
    "empty_docs": f"WITH {DOCUMENTS} SELECT file_name FROM docs WHERE lang = 'es'",
    "dim_filter": f"WITH {UNEVEN} SELECT vec_id FROM uneven WHERE len(v) = {q.DIM}",
    "dim_rejects": f"""WITH {UNEVEN} SELECT len(v)::INTEGER AS n_dims, count(*) AS n_rows
FROM uneven WHERE len(v) <> {q.DIM} GROUP BY ALL""",
    "dim_histogram": f"""WITH {UNEVEN} SELECT len(v)::INTEGER AS n_dims, count(*) AS n_rows
FROM uneven GROUP BY ALL""",
    "vector_parse": f"WITH {ELEMENTS} SELECT vec_id, pos::INTEGER AS pos, x AS value FROM elements",
    "vector_preview": """SELECT vec_id, embedding[1]::DOUBLE AS first, embedding[2]::DOUBLE AS second,
  2 AS n_shown, 100 AS n_characters FROM embeddings""",
    "text_preview": "SELECT doc_id, substr(text, 1, 100) AS shown FROM documents",
    "vector_norm": """SELECT vec_id, round(n, 6) AS norm, abs(n - 1) <= 1e-5 + 1e-8 AS is_normalized
FROM (SELECT vec_id, sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS n
      FROM embeddings)""",
    "pair_distance": """SELECT a.vec_id,
  round(-list_inner_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6)
    AS negative_inner_product,
  round(list_cosine_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS cosine_distance
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""",
    "half_quantize": f"""WITH {ELEMENTS}, {HALVES}
SELECT vec_id, pos::INTEGER AS pos, half FROM halves""",
    "precision_audit": f"""WITH {ELEMENTS}, {HALVES}
SELECT vec_id, round(max(abs(x - half)), 9) AS max_error FROM halves GROUP BY vec_id""",
    "float_bits": f"""WITH {ELEMENTS}, {HALVES},
  shown AS (SELECT vec_id, printf('%08x', {bits('x', 8, 23)}) AS f,
    printf('%04x', {bits('half', 5, 10)}) AS h FROM halves WHERE pos = 0)
SELECT vec_id, f[7:8] || f[5:6] || f[3:4] || f[1:2] AS float32_hex, h[3:4] || h[1:2] AS float16_hex
FROM shown""",
    "knn_single": f"""WITH asked AS (SELECT embedding::DOUBLE[] AS v FROM embeddings
  ORDER BY vec_id LIMIT 1)
SELECT vec_id, round(score, 6) AS score FROM (
  SELECT vec_id, list_inner_product(embedding::DOUBLE[], (SELECT v FROM asked)) AS score
  FROM embeddings) ORDER BY score DESC, vec_id LIMIT {q.K}""",
    "knn_inner_product": f"""WITH {LABEL_MEANS}, {ASKED_MEANS}, {STORED}, {SCORED}, {EXACT} {MATCHES.format('exact')}""",
    "knn_cosine": f"""WITH {LABEL_MEANS}, scored AS (
  SELECT means.label AS query_id, vec_id,
    list_cosine_similarity(mean, embedding::DOUBLE[]) AS score FROM means, embeddings),
  {EXACT}
SELECT query_id, rank::INTEGER AS rank, vec_id, round(1 - score, 6) AS distance FROM exact""",
    "knn_half": f"WITH {LABEL_MEANS}, {HALF_SCORED}, {EXACT} {MATCHES.format('exact')}",
    "retrieve_chunks": f"""WITH RECURSIVE {DOC_CHUNKS},
  {embedded("SELECT k || '/' || pos AS k, chunk AS text FROM chunks", "stored")},
  {embedded("SELECT item_id AS k, text FROM benchmark", "asked")},
  scored AS (SELECT a.k AS item_id, s.k AS chunk, list_inner_product(a.v, s.v) AS score
    FROM asked a, stored s)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, chunk))::INTEGER AS rank,
  chunk, round(score, 6) AS score FROM scored QUALIFY rank <= 5""",
    "knn_join": f"""WITH {embedded("SELECT 'b' || item_id AS k, text FROM benchmark", "texts")},
  asked AS (
    SELECT 'v' || vec_id AS query_id, embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id % 50 = 0
    UNION ALL SELECT k, v FROM texts),
  {STORED}, {SCORED}, {EXACT} {MATCHES.format('exact')}""",
    "knn_bounded": f"""WITH {LABEL_MEANS}, {ASKED_MEANS}, {STORED}, {SCORED}, {EXACT}, {ASSIGNED},
  radii AS (
    SELECT list_id, max(list_distance(e, mean)) AS radius
    FROM assigned JOIN stored USING (vec_id) JOIN means ON label = list_id GROUP BY list_id),
  bounds AS (
    SELECT query_id, list_id, list_inner_product(v, mean) + sqrt(list_inner_product(v, v)) * radius AS bound
    FROM asked, means JOIN radii ON label = list_id),
  placed AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY bound DESC, list_id) AS place FROM bounds),
  early AS (
    SELECT s.query_id, s.score, row_number() OVER (PARTITION BY s.query_id ORDER BY s.score DESC, vec_id) AS rank
    FROM scored s JOIN assigned USING (vec_id) JOIN placed p ON p.query_id = s.query_id AND p.list_id = assigned.list_id
    WHERE place <= 2),
  floors AS (SELECT query_id, score AS least FROM early WHERE rank = {q.K}),
  listed AS (
    SELECT query_id, count(*) FILTER (place <= 2 OR bound >= coalesce(least, -1e300) - 1e-9)::INTEGER AS lists_read
    FROM placed LEFT JOIN floors USING (query_id) GROUP BY query_id)
SELECT query_id, rank::INTEGER AS rank, vec_id, round(score, 6) AS score, lists_read FROM exact JOIN listed USING (query_id)""",
    "ivf_assign": f"WITH {LABEL_MEANS}, {STORED}, {ASSIGNED} SELECT vec_id, list_id FROM assigned",
    "ivf_search": f"""WITH {LABEL_MEANS}, {ASKED_MEANS}, {STORED}, {SCORED}, {ASSIGNED}, {IVF} {MATCHES.format('found')}""",
    "ivf_recall": f"WITH {LABEL_MEANS}, {ASKED_ROWS}, {STORED}, {SCORED}, {EXACT}, {ASSIGNED}, {IVF} {RECALL}",
    "ivf_full_probe": f"""WITH {LABEL_MEANS}, {ASKED_MEANS}, {STORED}, {SCORED}, {EXACT} {MATCHES.format('exact')}""",
    "lsh_search": f"WITH {LABEL_MEANS}, {ASKED_MEANS}, {STORED}, {SCORED}, {LSH} {MATCHES.format('found')}",
    "lsh_recall": f"WITH {ASKED_ROWS}, {STORED}, {SCORED}, {EXACT}, {LSH} {RECALL}",
    "knn_dirty": f"""WITH {ASKED_ROWS}, {CLEAN}, {SCORED}, {EXACT}
SELECT query_id, rank::INTEGER AS rank, vec_id, round(score, 9) AS score FROM exact""",
    "ivf_dirty": f"""WITH {LABEL_MEANS}, {ASKED_ROWS}, {CLEAN}, {SCORED}, {ASSIGNED}, {IVF}
SELECT query_id, rank::INTEGER AS rank, vec_id, round(score, 9) AS score FROM found""",
    "lsh_dirty": f"""WITH {ASKED_ROWS}, {CLEAN}, {SCORED}, {LSH}
SELECT query_id, rank::INTEGER AS rank, vec_id, round(score, 9) AS score FROM found""",
    "ivf_kmeans": f"""SELECT 20::BIGINT AS n_lists, count(*) AS n_rows, 0::BIGINT AS n_misplaced
FROM embeddings""",
    "hash_embed": f"""WITH {embedded("SELECT doc_id AS k, text FROM documents", "made")}
SELECT k AS doc_id, bucket::INTEGER AS bucket, round(w, 6) AS weight FROM made_weights""",
    "token_usage": f"""SELECT doc_id, 'token-hash' AS model, {TURN_TOKENS} AS prompt_tokens,
  {TURN_TOKENS} AS total_tokens FROM documents""",
    "content_hash": "SELECT doc_id, md5(text) AS content_hash FROM documents",
    "dedup_content": """SELECT min(doc_id) AS doc_id, md5(text) AS content_hash, count(*) AS copies
FROM documents GROUP BY md5(text)""",
    "dedup_rows": """SELECT doc_id, lang, text FROM documents
QUALIFY row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) = 1""",
    "hash_verify": f"""WITH {DOCUMENTS}, {MANIFEST}, {VERIFIED}
SELECT key, content_hash, coalesce(file_hash, 'none') AS file_hash, verified FROM verified""",
    "ledger_anti": f"""WITH {DOCUMENTS} SELECT doc_id, file_name FROM docs
WHERE NOT EXISTS (SELECT 1 FROM labels WHERE labels.doc_id = docs.doc_id)""",
    "notify_build": f"""WITH {DOCUMENTS}
SELECT file_name AS message_group, {BODY % (q.BUCKET,
        "CASE WHEN lang = 'en' THEN file_name ELSE 'in/' || string_split(file_name, '/')[-1] END")}
  AS body FROM docs WHERE ends_with(lower(file_name), '.pdf')""",
    "event_key": f"SELECT event_id, {KEY} AS key, 2 AS n_keys FROM events",
    "jst_format": """SELECT event_id,
  strftime(ts + INTERVAL 9 HOUR, '%Y-%m-%d %H:%M:%S') || ' JST' AS jst,
  strftime(ts, '%Y-%m-%d %H:%M:%S') || ' UTC' AS utc,
  hour(ts + INTERVAL 9 HOUR)::INTEGER AS jst_hour FROM events""",
    "unix_roundtrip": """SELECT event_id, floor(epoch(ts))::BIGINT AS seconds,
  strftime(ts, '%Y-%m-%d %H:%M:%S') AS shown, floor(epoch(ts))::BIGINT AS seconds_again
FROM events""",
    "retry_route": ROUTES,
    "retry_route_blocked": ROUTES,
    "retry_stream": ROUTES,
    "retry_timed": """WITH m AS (
  SELECT *, CASE WHEN event_type = 'error' THEN event_id % 3 + 1 ELSE 0 END AS failures FROM events)
SELECT user_id, event_id, attempt::INTEGER AS attempt, epoch_us(ts) // 1000 + 30000 * (attempt - 1) AS at_ms,
  CASE WHEN attempt > failures THEN 'done' WHEN attempt = 3 THEN 'dead_letter' ELSE 'retry' END AS route
FROM m, range(1, 4) r(attempt) WHERE attempt <= failures + 1""",
    "dead_letters": f"""WITH {ROUTED} SELECT event_id, user_id, {literal(FAILURE_REASON)}
  AS failure_reason FROM routed WHERE route = 'dead_letter'""",
    "dlq_redrive": f"""WITH {ROUTED}, {DOCUMENTS}, {MANIFEST}, {VERIFIED}
SELECT event_id, user_id AS doc_id FROM routed WHERE route = 'dead_letter'
  AND user_id NOT IN (SELECT doc_id FROM verified WHERE verified)""",
    "dlq_redrive_stream": f"""WITH {ROUTED}, {DOCUMENTS}, {MANIFEST}, {VERIFIED}
SELECT event_id, user_id AS doc_id, CASE WHEN user_id IN (SELECT doc_id FROM verified WHERE verified)
  THEN 'redriven' ELSE 'kept' END AS outcome FROM routed WHERE route = 'dead_letter'""",
    "queue_stream": f"""SELECT event_id::VARCHAR AS message_id, {KEY} AS key, 1 AS receive_count
FROM events""",
    "dedup_stream": f"SELECT event_id::VARCHAR AS message_id, {KEY} AS key FROM events",
    "idempotent_ingest": f"SELECT event_id::VARCHAR AS message_id, {KEY} AS key FROM events",
}
