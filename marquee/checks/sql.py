"""Named SQL building blocks and their assembly into one WITH query."""

import re

from marquee.sources.sample import PREFERENCES, SAMPLE_GENRES


def text_list(names):
    return "[" + ", ".join(f"'{n}'" for n in names) + "]"


PREFS = text_list(PREFERENCES)

BLOCKS = {
    "np": "SELECT count(*) AS n FROM part",
    "ratings": """
        SELECT CAST(o_custkey AS INT) AS uid, CAST(l_partkey AS INT) AS mid,
               CAST(ceil(l_quantity / 5) AS DOUBLE) / 2 AS score,
               CAST(floor(epoch(l_shipdate)) AS INT) AS "timestamp"
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "movies": """
        SELECT CAST(p_partkey AS INT) AS mid, p_name AS name,
               concat(p_brand, ' ', lower(p_type), ' ', p_name) AS descri,
               concat(CAST(p_size AS VARCHAR), ' minutes') AS timelong,
               concat(CAST(1990 + p_partkey % 30 AS VARCHAR), '-01-01') AS issue,
               '1977' AS shoot, 'English' AS language,
               concat(upper(substr(p_type, 1, 1)), lower(substr(p_type, 2)), '|', replace(p_name, ' ', '|')) AS genres,
               concat('Cast|', p_brand) AS actors, p_brand AS directors
        FROM part""",
    "tags": """
        SELECT CAST(user_id AS INT) AS uid, CAST(event_id % (SELECT n FROM np) AS INT) AS mid,
               event_type AS tag, CAST(floor(epoch(ts)) AS INT) AS "timestamp"
        FROM events""",
    "users": f"""
        SELECT CAST(c_custkey AS INT) AS uid, c_name AS username, c_custkey % 2 = 0 AS "first",
               c_custkey * 1000 AS "timestamp",
               CASE WHEN c_mktsegment = 'MACHINERY' THEN []
                    WHEN c_custkey % 6 = c_custkey % 5 THEN [{PREFS}[c_custkey % 6 + 1]]
                    ELSE [{PREFS}[c_custkey % 6 + 1], {PREFS}[c_custkey % 5 + 1]] END AS "prefGenres"
        FROM customer""",
    "log_lines": """
        SELECT event_id,
               CASE WHEN event_type = 'purchase'
                    THEN concat('2024-01-01 INFO --- [exec] web.ratings : MOVIE_RATING_PREFIX:',
                                CAST(user_id AS VARCHAR), '|', CAST(event_id % (SELECT n FROM np) AS VARCHAR), '|',
                                CAST(CAST(1 + event_id % 10 AS DOUBLE) / 2 AS VARCHAR), '|',
                                CAST(CAST(floor(epoch(ts)) AS BIGINT) AS VARCHAR))
                    ELSE concat('2024-01-01 INFO --- [exec] ', event_type) END AS value
        FROM events""",
    "stream_ratings": """
        SELECT CAST(user_id AS INT) AS uid, CAST(event_id % (SELECT n FROM np) AS INT) AS mid,
               CAST(1 + event_id % 10 AS DOUBLE) / 2 AS score, CAST(floor(epoch(ts)) AS INT) AS "timestamp"
        FROM events WHERE event_type = 'purchase'""",
    "averages": "SELECT mid, avg(score) AS avg FROM ratings GROUP BY mid",
    "counts": "SELECT mid, count(*) AS count FROM ratings GROUP BY mid",
    "monthly": """
        SELECT mid, count(*) AS count,
               CAST(strftime(make_timestamp(CAST("timestamp" AS BIGINT) * 1000000), '%Y%m') AS INT) AS yearmonth
        FROM ratings GROUP BY mid, yearmonth""",
    "genre_names": f"SELECT unnest({text_list(SAMPLE_GENRES)}) AS genre",
    "genre_top": """
        SELECT genre AS genres, rank, mid, score FROM (
            SELECT genre, mid, round(avg, 6) AS score,
                   CAST(row_number() OVER (PARTITION BY genre ORDER BY round(avg, 6) DESC, mid) AS INT) AS rank
            FROM movies JOIN averages USING (mid) JOIN genre_names
                 ON contains(lower(genres), lower(genre)))
        WHERE rank <= 10""",
    "info": """
        SELECT mid, name, coalesce(round(avg, 6), 0.0) AS avg_score
        FROM movies LEFT JOIN averages USING (mid)""",
    # similar movies by genre words
    "words": """
        SELECT mid, unnest(regexp_split_to_array(lower(replace(genres, '|', ' ')), '\\s')) AS term FROM movies""",
    "tf": "SELECT mid, term, count(*) AS tf FROM words GROUP BY mid, term",
    "idf": """
        SELECT term, count(*) AS df, ln(((SELECT count(*) FROM movies) + 1) / (count(*) + 1)) AS idf
        FROM tf GROUP BY term""",
    "tfidf": "SELECT mid, term, tf, df, idf, tf * idf AS tfidf FROM tf JOIN idf USING (term)",
    "unit": """
        SELECT mid, term, tfidf / sqrt(sum(tfidf * tfidf) OVER (PARTITION BY mid)) AS w FROM tfidf""",
    "sims": """
        SELECT a.mid AS mid, b.mid AS other, round(sum(a.w * b.w), 6) AS score
        FROM unit a JOIN unit b ON a.term = b.term AND a.mid <> b.mid
        GROUP BY a.mid, b.mid HAVING round(sum(a.w * b.w), 6) > 0.6""",
    "members": """
        SELECT mid, min(mid) OVER (PARTITION BY terms) AS pid
        FROM (SELECT mid, string_agg(term, ' ' ORDER BY term) AS terms FROM words GROUP BY mid)""",
    "sims_ranked": """
        SELECT mid, other, score, CAST(row_number() OVER (PARTITION BY mid ORDER BY score DESC, other) AS INT) AS rank FROM sims""",
    # similar vectors
    "all_vectors": "SELECT CAST(vec_id AS INT) AS mid, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings",
    # copies of a vector are one profile, named by the smallest mid
    "vectors": "SELECT min(mid) AS mid, vec FROM all_vectors GROUP BY vec",
    "vec_sims": """
        SELECT mid, other, score FROM (
            SELECT a.mid AS mid, b.mid AS other,
                   round(list_inner_product(a.vec, b.vec)
                         / (sqrt(list_inner_product(a.vec, a.vec)) * sqrt(list_inner_product(b.vec, b.vec))), 6) AS score
            FROM vectors a JOIN vectors b ON a.mid <> b.mid)
        WHERE score > 0.3""",
    "vec_ranked": """
        SELECT mid, other, score, CAST(row_number() OVER (PARTITION BY mid ORDER BY score DESC, other) AS INT) AS rank FROM vec_sims""",
}


def live_blocks(prefix, source):
    """Blocks of the real-time lists for the ratings in block ``source``."""
    p = prefix
    return {
        f"{p}recent": f"""
            SELECT uid, position, mid, score FROM (
                SELECT *, CAST(row_number() OVER (PARTITION BY uid ORDER BY "timestamp" DESC, mid DESC, score DESC) AS INT) AS position
                FROM {source}) WHERE position <= 20""",
        f"{p}last": f"SELECT uid, mid FROM {p}recent WHERE position = 1",
        f"{p}seen": f"SELECT DISTINCT uid, mid FROM {source}",
        f"{p}unseen": f"""
            SELECT * FROM (
                SELECT l.uid, l.mid, s.other AS candidate, s.score,
                       CAST(row_number() OVER (PARTITION BY l.uid, l.mid ORDER BY s.score DESC, s.other) AS INT) AS rank
                FROM {p}last l JOIN sims s ON s.mid = l.mid
                WHERE NOT EXISTS (SELECT 1 FROM {p}seen e WHERE e.uid = l.uid AND e.mid = s.other))
            WHERE rank <= 20""",
        f"{p}matched": f"""
            SELECT c.uid, c.candidate, r.position, r.score, s.score AS similarity
            FROM {p}unseen c JOIN {p}recent r ON r.uid = c.uid
                 JOIN sims s ON s.mid = c.candidate AND s.other = r.mid
            WHERE s.score > 0.7""",
        f"{p}scores": f"""
            SELECT uid, candidate AS mid,
                   round(avg(similarity * score)
                         + log10(greatest(count(*) FILTER (WHERE score > 3), 1))
                         - log10(greatest(count(*) FILTER (WHERE score <= 3), 1)) + 1e-10::DOUBLE, 6) AS score
            FROM {p}matched GROUP BY uid, candidate""",
        f"{p}ranked": f"""
            SELECT uid, mid, score, CAST(row_number() OVER (PARTITION BY uid ORDER BY score DESC, mid) AS INT) AS rank
            FROM {p}scores""",
    }


BLOCKS.update(live_blocks("", "ratings"))
BLOCKS.update(live_blocks("stream_", "stream_ratings"))


def _used(text, known):
    return [n for n in known if re.search(rf"\b{n}\b", text)]


def query(body, **extra):
    """``body`` with a WITH clause of all blocks it needs, in order of dependence."""
    known = {**BLOCKS, **extra}
    ordered = []

    def add(name):
        if name in ordered:
            return
        for other in _used(known[name], known):
            if other != name:
                add(other)
        ordered.append(name)

    for name in _used(body, known):
        add(name)
    if not ordered:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({known[n]})" for n in ordered) + "\n" + body
