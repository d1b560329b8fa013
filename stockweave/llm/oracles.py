"""SQL that gives the rows of the queries on licenses, resampling and vector codes."""

from __future__ import annotations

from stockweave.llm.licenses import LOWER, STRETCH, TEMPLATES, UPPER

_LOW = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
_WORDS = r"list_filter(string_split_regex({text}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"


def _template_rows() -> str:
    rows = []
    for number, t in enumerate(TEMPLATES):
        words = ", ".join(f"'{w}'" for w in t.words)
        rows.append(f"({number}, '{t.label}', [{words}], CAST({t.least} AS DOUBLE), {str(t.base).lower()}, {t.run}, {t.shift})")
    return ",\n            ".join(rows)


LICENSES = rf"""
    WITH templates(id, label, words, least, base, k, shift) AS (
        VALUES {_template_rows()}),
    runs AS (
        SELECT id, k, i AS slot, array_to_string(words[i + 1 : i + k], ' ') AS run
        FROM (SELECT *, unnest(range(0, len(words) - k + 1)) AS i FROM templates)),
    docs AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS.format(text=_LOW)} AS w FROM documents),
    words AS (SELECT rid, unnest(w) AS word, unnest(range(len(w))) AS pos FROM docs),
    next_words AS (
        SELECT rid, pos, word, lead(word, 1) OVER p AS w1, lead(word, 2) OVER p AS w2, lead(word, 3) OVER p AS w3
        FROM words WINDOW p AS (PARTITION BY rid ORDER BY pos)),
    grams AS (
        SELECT rid, pos, 2 AS k, word || ' ' || w1 AS run FROM next_words WHERE w1 IS NOT NULL
        UNION ALL
        SELECT rid, pos, 4 AS k, word || ' ' || w1 || ' ' || w2 || ' ' || w3 FROM next_words WHERE w3 IS NOT NULL),
    hits AS (
        SELECT g.rid, r.id, r.k, g.pos - r.slot AS diagonal, r.slot FROM grams g JOIN runs r ON g.k = r.k AND g.run = r.run),
    covered AS (SELECT DISTINCT rid, id, diagonal, unnest(range(slot, slot + k)) AS place FROM hits),
    lone AS (
        SELECT rid, id, diagonal, count(*) AS n, diagonal + min(place) AS first, diagonal + max(place) + 1 AS "end"
        FROM covered GROUP BY rid, id, diagonal),
    steps AS (
        SELECT l.*, t.shift, len(t.words) AS length,
               diagonal - lag(diagonal) OVER (PARTITION BY rid, id ORDER BY diagonal) AS gap
        FROM lone l JOIN templates t USING (id)),
    clusters AS (
        SELECT *, sum(CASE WHEN gap <= shift THEN 0 ELSE 1 END) OVER (PARTITION BY rid, id ORDER BY diagonal) AS cluster
        FROM steps),
    merged AS (
        SELECT c.rid, c.id, c.cluster, c.length, count(DISTINCT v.place) AS n, min(c.first) AS first, max(c."end") AS "end",
               max({{'n': c.n, 'first': c.first, 'end': c."end"}}) AS best
        FROM clusters c JOIN covered v USING (rid, id, diagonal) GROUP BY ALL),
    judged AS (
        SELECT rid, id, CASE WHEN "end" - first <= ceil(length * {1 + STRETCH}) AND n >= best.n
                             THEN {{'n': n, 'first': first, 'end': "end"}} ELSE best END AS span, length
        FROM merged),
    spans AS (
        SELECT j.rid, t.label, t.base, j.span.first AS first, CAST(j.span.n AS DOUBLE) / j.length AS coverage
        FROM judged j JOIN templates t USING (id) WHERE CAST(j.span.n AS DOUBLE) / j.length >= t.least),
    found AS (
        SELECT rid, count(*) FILTER (base) AS n_base, min(first) FILTER (base) AS first_word, max(first) FILTER (base) AS last_word,
               string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
               string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(coverage) AS score
        FROM spans GROUP BY rid)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word,
           CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
           coalesce(score, 0.0) AS score
    FROM docs LEFT JOIN found USING (rid)"""

# a CRC-32 from its definition: the table of all bytes, then a step per byte of each distinct word
RESAMPLING = rf"""
    WITH crc_table AS (
        SELECT list(list_reduce(list_concat([i], range(8)),
                    lambda c, step: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS tab
        FROM (SELECT unnest(range(256)) AS i)),
    docs AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS.format(text=_LOW)} AS w FROM documents),
    wanted AS (SELECT unnest({_WORDS.format(text=_LOW)}) AS word FROM benchmark),
    words AS (SELECT rid, unnest(w) AS word FROM docs),
    vocabulary AS (SELECT word, hex(encode(word)) AS bytes FROM (SELECT word FROM words UNION SELECT word FROM wanted)),
    buckets AS (
        SELECT word, xor(list_reduce(list_concat([4294967295], list_transform(range(len(bytes) // 2),
                            lambda i: CAST('0x' || substr(bytes, 2 * i + 1, 2) AS BIGINT))),
                         lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
        FROM vocabulary, crc_table),
    s AS (SELECT bucket, count(*) AS s FROM words JOIN buckets USING (word) GROUP BY bucket),
    t AS (SELECT bucket, count(*) AS t FROM wanted JOIN buckets USING (word) GROUP BY bucket),
    totals AS (SELECT (SELECT count(*) FROM words) AS all_s, (SELECT count(*) FROM wanted) AS all_t),
    gains AS (
        SELECT bucket, CAST(floor(1000 * ln(CAST(coalesce(t, 0) + 1 AS DOUBLE) * CAST(all_s + 10000 AS DOUBLE)
                       / (CAST(s + 1 AS DOUBLE) * CAST(all_t + 10000 AS DOUBLE)))) AS BIGINT) AS gain
        FROM s LEFT JOIN t USING (bucket), totals),
    sums AS (
        SELECT rid, CAST(sum(gain) AS BIGINT) AS gain, count(*) AS n FROM words JOIN buckets USING (word) JOIN gains USING (bucket) GROUP BY rid),
    weighed AS (
        SELECT rid, doc_id, coalesce(n, 0) AS n_features,
               CASE WHEN n > 0 THEN (gain - ((gain % n) + n) % n) // n ELSE 0 END AS weight,
               CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
        FROM docs LEFT JOIN sums USING (rid)),
    scored AS (
        SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + CAST(0.5 AS DOUBLE)) / 4294967296))) AS BIGINT) AS score FROM weighed),
    ranked AS (
        SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, rid) AS rank, count(*) OVER () AS n
        FROM scored WHERE n_features >= 20)
    SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank
    FROM scored LEFT JOIN ranked USING (rid)"""


def _assigned(name: str, books: str) -> str:
    return f"""
    {name} AS (
        SELECT rid, part, x, min({{'d': d, 'entry': entry}}) AS near
        FROM (SELECT r.rid, r.part, r.x, b.entry,
                     list_sum(list_transform(list_zip(r.x, b.c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
              FROM parts r JOIN {books} b ON r.part = b.part)
        GROUP BY ALL)"""


def _moved(name: str, assigned: str, books: str) -> str:
    return f"""
    {name}_sums AS (
        SELECT part, near.entry AS entry, slot, sum(x[slot]) AS total, count(*) AS n
        FROM (SELECT part, near, x, unnest(range(1, len(x) + 1)) AS slot FROM {assigned}) GROUP BY ALL),
    {name}_means AS (
        SELECT part, entry, list(CAST((total - ((total % n) + n) % n) // n AS BIGINT) ORDER BY slot) AS c FROM {name}_sums GROUP BY ALL),
    {name} AS (SELECT b.part, b.entry, coalesce(m.c, b.c) AS c FROM {books} b LEFT JOIN {name}_means m USING (part, entry))"""


CODES = f"""
    WITH usable AS (
        SELECT row_number() OVER () AS rid, vec_id, label,
               list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS v
        FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
    parts AS (
        SELECT rid, vec_id, part, v[part * len(v) // 16 + 1 : (part + 1) * len(v) // 16] AS x
        FROM (SELECT *, unnest(range(16)) AS part FROM usable)),
    first AS (SELECT rid, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS entry FROM usable QUALIFY entry < 64),
    books0 AS (SELECT part, entry, x AS c FROM parts JOIN first USING (rid)),
    {_assigned("near0", "books0").strip()},
    {_moved("books1", "near0", "books0").strip()},
    {_assigned("near1", "books1").strip()},
    {_moved("books2", "near1", "books1").strip()},
    {_assigned("near2", "books2").strip()},
    coded AS (
        SELECT vec_id, label, string_agg(printf('%02x', near.entry), '' ORDER BY part) AS code, CAST(sum(near.d) AS BIGINT) AS error
        FROM near2 JOIN usable USING (rid) GROUP BY rid, vec_id, label)
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
           (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) FROM books2) AS codebooks_sha256
    FROM coded"""

ORACLE = {"op11_license_scan": LICENSES, "op12_importance_resampling": RESAMPLING, "op13_vector_codes": CODES}
