"""SQL twins of the queries of this subpackage, where SQL can express them.

The others learn a model, hash with XXH64 or draw by a hash; tests hold them
against brute force.
"""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"

_QUALITY = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, regexp_extract_all(t, '{_WORD}') AS words FROM d),
pos AS (SELECT r, generate_subscripts(words, 1) AS i, unnest(words) AS word FROM w),
win AS (
    SELECT r, i, word || ' ' || lead(word, 1) OVER x || ' ' || lead(word, 2) OVER x || ' '
        || lead(word, 3) OVER x || ' ' || lead(word, 4) OVER x AS g
    FROM pos WINDOW x AS (PARTITION BY r ORDER BY i)
),
rep AS (
    SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM win WHERE g IS NOT NULL)
    WHERE c > 1
),
covered AS (SELECT r, count(DISTINCT i + o) AS n FROM rep, range(5) AS five(o) GROUP BY r),
each AS (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d),
lined AS (
    SELECT r, count(*) AS n, count(*) - count(DISTINCT line) AS again
    FROM each WHERE regexp_matches(line, '{_WORD}') GROUP BY r
),
m AS (
    SELECT doc_id, len(words)::BIGINT AS n_words,
        length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
        (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        coalesce(lined.n, 0)::BIGINT AS n_lines, coalesce(again, 0)::BIGINT AS n_dup_lines,
        coalesce(covered.n, 0)::BIGINT AS n_repeat_words
    FROM d JOIN w USING (r) LEFT JOIN covered USING (r) LEFT JOIN lined USING (r)
),
f AS (
    SELECT *, n_words < 10 AS few, 100 * n_repeat_words > 20 * n_words AS again,
        2 * n_symbols > word_chars AS symbols, word_chars > 60 * n_words AS long,
        2 * n_dup_lines > n_lines AS lines
    FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    few OR again AS base_failed, NOT (few OR again OR symbols OR long OR lines) AS kept,
    (few::BIGINT + 2 * again::BIGINT + 4 * symbols::BIGINT + 8 * long::BIGINT + 16 * lines::BIGINT)::BIGINT
        AS failures
FROM f
"""

_ABLATIONS = f"""
WITH ledger AS ({_QUALITY}),
rules AS (SELECT unnest(['few_words', 'repeated_words', 'symbol_share', 'long_words', 'repeated_lines']) AS rule, unnest([1, 2, 4, 8, 16]) AS bit)
SELECT rule, count(*) FILTER (failures & bit > 0) AS n_rejected, count(*) FILTER (failures = bit) AS n_only,
    count(*) FILTER (failures & ~bit & 31 = 0) AS n_kept_without
FROM rules, ledger GROUP BY rule
"""

_SECRETS = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
found AS (
    SELECT r, 0 AS k, 'assign' AS kind, 12 AS least, string_split_regex(t, '(?i)(?:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?(?:[A-Za-z0-9+/_.=-]+)') AS gaps,
        regexp_extract_all(t, '(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 0) AS hits,
        regexp_extract_all(t, '(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2) AS parts
    FROM d
    UNION ALL SELECT r, 1, 'access', 18, string_split_regex(t, 'AKIA[A-Z0-9]+'),
        regexp_extract_all(t, 'AKIA[A-Z0-9]+'), regexp_extract_all(t, 'AKIA[A-Z0-9]+') FROM d
    UNION ALL SELECT r, 2, 'hex', 16, string_split_regex(t, '[0-9a-f]+'),
        regexp_extract_all(t, '[0-9a-f]+'), regexp_extract_all(t, '[0-9a-f]+') FROM d
    UNION ALL SELECT r, 3, 'github', 0, string_split_regex(t, 'gh[oprsu]_[A-Za-z0-9]{36}'),
        regexp_extract_all(t, 'gh[oprsu]_[A-Za-z0-9]{36}'), regexp_extract_all(t, 'gh[oprsu]_[A-Za-z0-9]{36}') FROM d
    UNION ALL SELECT r, 4, 'private', 0, string_split_regex(t, '-----BEGIN [A-Z ]*PRIVATE KEY-----'),
        regexp_extract_all(t, '-----BEGIN [A-Z ]*PRIVATE KEY-----'),
        regexp_extract_all(t, '-----BEGIN [A-Z ]*PRIVATE KEY-----') FROM d
    UNION ALL SELECT r, 5, 'webtoken', 0, string_split_regex(t, 'eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+'),
        regexp_extract_all(t, 'eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+'),
        regexp_extract_all(t, 'eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+') FROM d
),
each AS (
    SELECT r, k, kind, least, unnest(range(1, len(hits) + 1)) AS i, unnest(gaps[1:len(hits)]) AS gap,
        unnest(hits) AS hit, unnest(parts) AS part
    FROM found WHERE len(hits) > 0
),
placed AS (
    SELECT *, (sum(length(gap) + length(hit)) OVER (PARTITION BY r, k ORDER BY i))::BIGINT AS stop FROM each
),
spans AS (
    SELECT r, k, stop - length(hit) AS start, kind || ':' || (stop - length(hit)) || ':' || stop AS span, kind
    FROM placed WHERE length(part) >= least
),
per AS (
    SELECT r, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access,
        count(*) FILTER (k = 2) AS n_hex,
        string_agg(span, ',' ORDER BY start, k) FILTER (k < 3) AS base, string_agg(span, ',' ORDER BY start, k) AS spans
    FROM spans GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
    coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN per USING (r)
"""


def _proposed(kind: str, place: int, form: str) -> str:
    """The matches of an expression in every text, and what stands before each."""
    return f"""SELECT r, t, {place} AS k, '{kind}' AS kind, string_split_regex(t, '{form}') AS gaps,
        regexp_extract_all(t, '{form}') AS hits FROM d"""


#: Kind: expression, and the words of its context with its prior score in hundredths.
_PERSONAL_FORMS = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "mail|email|contact|write", 70),
    "ip": (r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", "ip|address|server|host", 50),
    "card": (r"[0-9](?:[\x20-]?[0-9])+", "card|credit|visa|payment", 60),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "phone|tel|call|mobile|fax", 60),
    "iban": (
        r"\b[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)\b",
        "iban|bank|account|transfer", 70,
    ),
    "ssn": (r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b", "ssn|social|security|taxpayer", 30),
}
_PERSONAL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
found AS ({" UNION ALL ".join(_proposed(kind, k, form) for k, (kind, (form, _, _)) in enumerate(_PERSONAL_FORMS.items()))}),
each AS (
    SELECT r, t, k, kind, unnest(range(1, len(hits) + 1)) AS i, unnest(gaps[1:len(hits)]) AS gap, unnest(hits) AS hit
    FROM found WHERE len(hits) > 0
),
placed AS (
    SELECT *, (sum(length(gap) + length(hit)) OVER (PARTITION BY r, k ORDER BY i))::BIGINT AS stop,
        regexp_replace(hit, '[^0-9]', '', 'g') AS digits, replace(hit, ' ', '') AS account
    FROM each
),
checked AS (
    SELECT *, stop - length(hit) AS start, CASE kind
        WHEN 'email' THEN true
        WHEN 'ip' THEN len(list_filter(string_split(hit, '.'), lambda p: length(ltrim(p, '0')) > 3
            OR coalesce(try_cast(ltrim(p, '0') AS INTEGER), 0) > 255)) = 0
        WHEN 'card' THEN length(digits) BETWEEN 13 AND 19 AND list_sum(list_transform(
            range(1, length(digits) + 1), lambda i: CASE
                WHEN i % 2 = 1 THEN substring(digits, length(digits) - i + 1, 1)::INTEGER
                ELSE substring('0246813579', substring(digits, length(digits) - i + 1, 1)::INTEGER + 1, 1)::INTEGER
            END)) % 10 = 0
        WHEN 'phone' THEN length(digits) BETWEEN 9 AND 15
        WHEN 'iban' THEN length(account) BETWEEN 15 AND 34 AND list_reduce(list_concat([0], list_transform(
            range(1, length(account) + 1), lambda i: strpos('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                substring(account[5:] || account[:4], i, 1)) - 1)),
            lambda a, v: (a * CASE WHEN v < 10 THEN 10 ELSE 100 END + v) % 97) = 1
        ELSE hit[:3] NOT IN ('000', '666') AND hit[1] <> '9' AND hit[5:6] <> '00' AND hit[8:] <> '0000'
        END AS fine
    FROM placed
),
scored AS (
    SELECT r, k, kind, start, stop, kind || ':' || start || ':' || stop AS span, CASE kind
        {" ".join(f"WHEN '{kind}' THEN {prior} + CASE WHEN regexp_matches(substring(t, greatest(start - 39, 1), least(start, 40)), '(?i)\b(?:{words})\b') OR regexp_matches(substring(t, stop + 1, 40), '(?i)\b(?:{words})\b') THEN 30 ELSE 0 END" for kind, (_, words, prior) in _PERSONAL_FORMS.items())}
        END AS score
    FROM checked WHERE fine
),
per AS (
    SELECT r, count(*) FILTER (k = 0) AS n_email, count(*) FILTER (k = 1) AS n_ip, count(*) FILTER (k = 2) AS n_card,
        count(*) FILTER (k = 3) AS n_phone, string_agg(span, ',' ORDER BY k, start) FILTER (k < 4) AS base,
        string_agg(span, ',' ORDER BY k, start) AS spans,
        string_agg(printf('%.2f', score / 100), ',' ORDER BY k, start) AS scores
    FROM scored WHERE k < 4 OR score >= 50 GROUP BY r
)
SELECT doc_id, coalesce(n_email, 0)::BIGINT AS n_email, coalesce(n_ip, 0)::BIGINT AS n_ip,
    coalesce(n_card, 0)::BIGINT AS n_card, coalesce(n_phone, 0)::BIGINT AS n_phone,
    sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(scores, '') AS scores
FROM d LEFT JOIN per USING (r)
"""


def _checksums(values: str) -> str:
    """CTEs that give ``summed (value, crc)`` for the distinct texts of CTE ``values``.

    CRC-32 is linear: a byte adds a value that depends on it and on how far from the
    end it stands, and texts of zeros give what is the same for all of a length.
    """
    return f"""
each_value AS (SELECT DISTINCT value, hex(encode(value)) AS h FROM {values}),
longest AS (SELECT coalesce(max(length(h)), 0) // 2 AS l FROM each_value),
bits(b, i, v) AS (
    SELECT b, 0, b FROM range(256) AS byte(b)
    UNION ALL SELECT b, i + 1, xor(v >> 1, CASE v & 1 WHEN 1 THEN 3988292384 ELSE 0 END) FROM bits WHERE i < 8
),
one AS (SELECT b, v FROM bits WHERE i = 8),
far(k, b, v) AS (
    SELECT 0, b, v FROM one
    UNION ALL SELECT k + 1, far.b, xor(far.v >> 8, one.v) FROM far JOIN one ON one.b = far.v & 255
    WHERE k < (SELECT l FROM longest)
),
named AS (SELECT k, printf('%02X', b) AS byte, v FROM far),
zeros(l, v) AS (
    SELECT 0, 4294967295
    UNION ALL SELECT l + 1, xor(zeros.v >> 8, one.v) FROM zeros JOIN one ON one.b = zeros.v & 255
    WHERE l < (SELECT l FROM longest)
),
byte_of AS (SELECT value, h, unnest(range(length(h) // 2)) AS i FROM each_value),
mixed AS (
    SELECT value, any_value(length(h) // 2) AS l, bit_xor(v) AS v
    FROM byte_of JOIN named ON k = length(h) // 2 - 1 - i AND byte = substring(h, (2 * i + 1)::INTEGER, 2) GROUP BY value
),
summed AS (SELECT value, xor(xor(zeros.v, 4294967295), mixed.v) AS crc FROM mixed JOIN zeros USING (l))"""


_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

_RESAMPLED = rf"""
WITH RECURSIVE
texts AS (
    SELECT row_number() OVER () AS r, true AS ours, doc_id, coalesce(text, '') AS t FROM documents
    UNION ALL SELECT -row_number() OVER (), false, NULL, coalesce(text, '') FROM benchmark
),
w AS (
    SELECT r, ours, doc_id, regexp_extract_all(translate(t, {_LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM texts
),
pos AS (SELECT r, ours, generate_subscripts(words, 1) AS i, unnest(words) AS a FROM w),
next AS (SELECT r, ours, a, lead(a, 1) OVER x AS b, lead(a, 2) OVER x AS c FROM pos WINDOW x AS (PARTITION BY r ORDER BY i)),
feature AS (
    SELECT r, ours, a AS value FROM next
    UNION ALL SELECT r, ours, a || ' ' || b FROM next WHERE b IS NOT NULL
    UNION ALL SELECT r, ours, a || ' ' || b || ' ' || c FROM next WHERE c IS NOT NULL
),
{_checksums("feature")},
hashed AS (SELECT r, ours, crc % 10000 AS bucket FROM feature JOIN summed USING (value)),
per AS (SELECT bucket, count(*) FILTER (ours) AS s, count(*) FILTER (NOT ours) AS t FROM hashed GROUP BY bucket),
total AS (SELECT sum(s) AS s, sum(t) AS t FROM per),
gain AS (
    SELECT bucket, floor(1000 * ln(((per.t + 1)::DOUBLE * (total.s + 10000)::DOUBLE)
        / ((per.s + 1)::DOUBLE * (total.t + 10000)::DOUBLE)))::BIGINT AS gain FROM per, total
),
weighed AS (SELECT r, count(*) AS n, sum(gain)::BIGINT AS weight FROM hashed JOIN gain USING (bucket) WHERE ours GROUP BY r),
scored AS (
    SELECT r, doc_id, len(words) >= 20 AS able, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
        coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((
            ('0x' || sha256('42:' || coalesce(doc_id::VARCHAR, ''))[:8])::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
    FROM w LEFT JOIN weighed USING (r) WHERE ours
),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id NULLS LAST, r) AS place,
        count(*) FILTER (able) OVER () AS able_rows FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= able_rows * 5 // 100 THEN place END AS rank FROM placed
"""

_SPELLED = rf"""
WITH RECURSIVE
runs AS (
    SELECT coalesce(doc_id::VARCHAR, '') AS id,
        translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), {_LOWER}) AS run FROM documents
),
counted AS (SELECT id, run, count(*) AS n, id || ':' || run AS value FROM runs WHERE length(run) >= 5 GROUP BY id, run),
{_checksums("counted")},
kept AS (
    SELECT CASE WHEN crc % 97 > 0 THEN run
        ELSE substring(run, 1, (crc % length(run))::INTEGER) || substring(run, (crc % length(run) + 2)::INTEGER) END AS word, n
    FROM counted JOIN summed USING (value)
),
v AS (SELECT word, sum(n)::BIGINT AS n FROM kept WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
less AS (
    SELECT word, k, substring(word, 1, k - 1) || substring(word, k + 1) AS rest
    FROM (SELECT word, unnest(range(1, length(word) + 1))::INTEGER AS k FROM v)
),
pairs AS (
    SELECT x.word, y.word AS other FROM less x JOIN less y ON x.k = y.k AND x.rest = y.rest AND x.word <> y.word
    UNION SELECT less.word, v.word FROM less JOIN v ON rest = v.word
    UNION SELECT v.word, less.word FROM less JOIN v ON rest = v.word
),
best AS (
    SELECT pairs.word, count(*) AS n_near, (list({{'w': v.word, 'n': v.n}} ORDER BY v.n DESC, v.word))[1] AS top
    FROM pairs JOIN v ON v.word = pairs.other GROUP BY pairs.word
),
formed AS (
    SELECT v.word, v.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN top.n >= 2 * v.n THEN top.w END AS form,
        CASE WHEN top.n >= 2 * v.n THEN top.n END AS form_n FROM v LEFT JOIN best USING (word)
),
walk(word, stop) AS (
    SELECT word, word FROM formed
    UNION ALL SELECT walk.word, form FROM walk JOIN formed ON formed.word = walk.stop WHERE form IS NOT NULL
)
SELECT formed.word, formed.form, walk.stop AS root, formed.n, formed.n_near, formed.form_n
FROM formed JOIN walk ON walk.word = formed.word JOIN formed last ON last.word = walk.stop AND last.form IS NULL
"""

ORACLES: dict[str, str] = {
    "op9_quality_rules": _QUALITY, "op10_secret_scan": _SECRETS, "op11_importance_resampling": _RESAMPLED,
    "op12_spelling_variants": _SPELLED, "op13_personal_data": _PERSONAL,
    "quality_ablations": _ABLATIONS,
}
