"""The SQL forms, for DuckDB, of the queries that SQL can express."""

from marquee.llm.divergence import (
    COMMON_WORDS, MAX_CLASS_DISTANCE, MAX_WORD_DISTANCE, MIN_CHARS, MIN_WORDS, PATTERNS,
)

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

REPEATS = f"""
    WITH texts AS (SELECT doc_id, row_number() OVER () AS r, {WORDS} AS ws FROM documents),
    windows AS (
        SELECT r, i, md5(array_to_string(ws[i:i + 34], ' ')) AS h
        FROM (SELECT r, ws, unnest(range(1, len(ws) - 33)) AS i FROM texts)),
    starts AS (SELECT r, i FROM windows WHERE h IN (SELECT h FROM windows GROUP BY h HAVING count(*) > 1)),
    words AS (SELECT r, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM texts),
    marked AS (
        SELECT w.r, w.word, w.i, max(s.i) OVER (PARTITION BY w.r ORDER BY w.i) AS latest
        FROM words w LEFT JOIN starts s ON s.r = w.r AND s.i = w.i),
    kept AS (
        SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text
        FROM marked WHERE latest IS NULL OR latest < i - 34 GROUP BY r)
    SELECT doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
    FROM texts LEFT JOIN kept USING (r)"""


def _shares(table, key):
    return f"SELECT {key}, k, n / greatest(sum(n) OVER (PARTITION BY {key}), 1) AS share FROM {table}"


def _distances(own, reference, name):
    """Jensen-Shannon distance of each text's shares and those of its language."""
    return f"""
        SELECT o.r, sqrt(greatest((sum(CASE WHEN o.share > 0 THEN o.share * log2(2 * o.share / (o.share + coalesce(q.share, 0))) ELSE 0 END
                   + CASE WHEN q.share > 0 THEN q.share * log2(2 * q.share / (o.share + q.share)) ELSE 0 END)
                   + greatest(1 - sum(coalesce(q.share, 0)), 0)) / 2, 0)) AS {name}
        FROM {own} o JOIN texts t ON t.r = o.r
        LEFT JOIN {reference} q ON q.lang IS NOT DISTINCT FROM t.lang AND q.k = o.k
        GROUP BY o.r"""


def _class(pattern):
    return "len(regexp_replace(text, '[^" + pattern.replace("'", "''")[1:] + "', '', 'g'))"


_COMMON = ", ".join(f"'{w}'" for w in dict.fromkeys(COMMON_WORDS))

DIVERGENCE = f"""
    WITH texts AS (
        SELECT doc_id, lang, row_number() OVER () AS r, coalesce(text, '') AS text, {WORDS} AS ws FROM documents),
    sized AS (SELECT *, len(array_to_string(ws, '')) AS word_chars FROM texts),
    counted AS (
        SELECT *, [{", ".join(_class(p) for p in PATTERNS)}, len(text) - word_chars, strlen(text) - len(text)] AS c FROM sized),
    windows AS (
        SELECT r, i, array_to_string(ws[i:i + 2], ' ') AS h
        FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM texts)),
    starts AS (
        SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, h) AS n FROM windows) WHERE n > 1),
    words AS (SELECT r, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM texts),
    marked AS (
        SELECT w.r, w.i, max(s.i) OVER (PARTITION BY w.r ORDER BY w.i) AS latest
        FROM words w LEFT JOIN starts s ON s.r = w.r AND s.i = w.i),
    repeats AS (SELECT r, count(*) AS n FROM marked WHERE latest >= i - 2 GROUP BY r),
    classes AS (
        SELECT r, lang, unnest(range(1, {len(PATTERNS) + 4})) AS k,
               unnest(list_append(c, greatest(len(text) - list_sum(c), 0)::BIGINT)) AS n FROM counted),
    uses AS (
        SELECT r, lang, k, count(*) FILTER (word IS NOT NULL) AS n FROM (
            SELECT t.r, t.lang, w.word, CASE WHEN lower(w.word) IN ({_COMMON}) THEN lower(w.word) ELSE '' END AS k
            FROM texts t JOIN words w ON w.r = t.r
            UNION ALL SELECT r, lang, NULL, '' FROM texts)
        GROUP BY r, lang, k),
    class_sums AS (SELECT lang, k, sum(n) AS n FROM classes GROUP BY lang, k),
    use_sums AS (SELECT lang, k, sum(n) AS n FROM uses GROUP BY lang, k),
    class_ref AS ({_shares("class_sums", "lang")}),
    use_ref AS ({_shares("use_sums", "lang")}),
    class_own AS ({_shares("classes", "r")}),
    use_own AS ({_shares("uses", "r")}),
    class_far AS ({_distances("class_own", "class_ref", "class_distance")}),
    use_far AS ({_distances("use_own", "use_ref", "word_distance")}),
    base AS (
        SELECT t.r, doc_id, text, len(ws) AS n_words, word_chars, c[4] + c[5] AS n_symbols,
               len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')))
               - len(list_distinct(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')))) AS n_dup_lines,
               coalesce(p.n, 0) AS n_repeat_words
        FROM counted t LEFT JOIN repeats p ON p.r = t.r),
    failed AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND NOT (len(text) >= {MIN_CHARS} AND class_distance > {MAX_CLASS_DISTANCE})
               AND NOT (n_words >= {MIN_WORDS} AND word_distance > {MAX_WORD_DISTANCE}) AS kept,
           round(class_distance, 6) AS class_distance, round(word_distance, 6) AS word_distance
    FROM failed JOIN class_far USING (r) JOIN use_far USING (r)"""


INFILL = """
    WITH units AS (
        SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
               sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS d
        FROM documents),
    drawn AS (
        SELECT *, len(u) AS n, [('0x' || substr(d, 8 * i + 1, 8))::UBIGINT FOR i IN range(4)] AS h FROM units),
    cut AS (
        SELECT *, least(h[1] % (n + 1), h[2] % (n + 1))::BIGINT AS a, greatest(h[1] % (n + 1), h[2] % (n + 1))::BIGINT AS b,
               CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 90
                    THEN 'plain' WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
        FROM drawn),
    pieces AS (
        SELECT doc_id, text, n, form, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m,
               array_to_string(u[b + 1:], '') AS s
        FROM cut)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN len(p) END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN len(m) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                  ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
           sha256(text) AS restored_sha256
    FROM pieces"""

PHRASES = r"""
    WITH pieces AS (
        SELECT lang, row_number() OVER () AS p, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
    places AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM pieces),
    spans AS (SELECT lang, ws, i, unnest(range(1, least(4, len(ws) - i + 1) + 1)) AS k FROM places),
    found AS (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase, count(*) AS f FROM spans GROUP BY ALL),
    sizes AS (SELECT lang, sum(f)::BIGINT AS n FROM found WHERE k = 1 GROUP BY lang),
    candidates AS (SELECT *, string_split(phrase, ' ') AS ws FROM found WHERE k > 1 AND f >= 30),
    cuts AS (SELECT *, unnest(range(1, k)) AS c FROM candidates),
    scored AS (
        SELECT c.lang, c.phrase, c.k, c.ws, c.f, c.c, l.f AS l, r.f AS r, (c.f::HUGEINT * 2000000) // (l.f + r.f) AS score
        FROM cuts c JOIN found l ON l.lang = c.lang AND l.phrase = array_to_string(c.ws[1:c.c], ' ')
        JOIN found r ON r.lang = c.lang AND r.phrase = array_to_string(c.ws[c.c + 1:], ' ')),
    best AS (
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) AS pos FROM scored) WHERE pos = 1),
    inner_ AS (
        SELECT lang, array_to_string(ws[s:s + m - 1], ' ') AS phrase, max(f) AS longer
        FROM (SELECT *, unnest(range(1, k - m + 2)) AS s FROM (SELECT *, unnest(range(2, k)) AS m FROM candidates))
        GROUP BY ALL),
    kept AS (
        SELECT b.* FROM best b LEFT JOIN inner_ i ON i.lang = b.lang AND i.phrase = b.phrase
        WHERE i.longer IS NULL OR 100 * i.longer::HUGEINT < 80 * b.f::HUGEINT),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, f DESC, phrase) AS rank FROM kept)
    SELECT lang, rank, phrase, f AS a, l, r, n, score::BIGINT AS score
    FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000"""

SIMILAR = r"""
    WITH RECURSIVE texts AS (
        SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x20\x09-\x0D]+') AS ws FROM documents),
    tokens AS (
        SELECT DISTINCT r, md5(array_to_string(ws[i:i + 4], ' ')) AS t
        FROM (SELECT r, ws, unnest(range(1, greatest(len(ws) - 4, least(len(ws), 1)) + 1)) AS i FROM texts)),
    sizes AS (SELECT r, count(*) AS n FROM tokens GROUP BY r),
    shared AS (SELECT a.r AS x, b.r AS y, count(*) AS n FROM tokens a JOIN tokens b ON a.t = b.t AND a.r <> b.r GROUP BY ALL),
    links AS (
        SELECT x, y FROM shared s JOIN sizes a ON a.r = x JOIN sizes b ON b.r = y
        WHERE 100 * s.n >= 80 * (a.n + b.n - s.n)),
    reached AS (SELECT r AS x, r AS y FROM texts UNION SELECT c.x, l.y FROM reached c JOIN links l ON l.x = c.y),
    least AS (SELECT x, min(doc_id) AS component_id FROM reached JOIN texts ON r = y GROUP BY x)
    SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
    FROM texts t LEFT JOIN sizes s ON s.r = t.r JOIN least ON x = t.r"""
