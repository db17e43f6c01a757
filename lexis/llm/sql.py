"""DuckDB SQL of the queries that SQL can express on whole tables."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS = ("regexp_extract_all(translate(coalesce(text, ''), '" + UPPER + "', '" + LOWER + "'), "
         "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')")

DECONTAMINATE = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {WORDS} AS w FROM documents),
b AS (SELECT item_id, {WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i + 1:i + 10], ' ') AS k
       FROM (SELECT item_id, w, unnest(range(greatest(len(w) - 9, 1))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT rid, n, i, array_to_string(w[i + 1:i + n], ' ') AS k
       FROM (SELECT rid, w, n, unnest(range(len(w) - n + 1)) AS i FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT rid, item_id, i, n FROM dw JOIN bw USING (n, k)),
covered AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM hit) GROUP BY rid),
items AS (SELECT rid, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS ids FROM hit GROUP BY rid)
"""

LINES = """
WITH l0 AS (SELECT rid, doc_id, text, unnest(range(len(string_split(text, chr(10))))) AS i,
                   unnest(string_split(text, chr(10))) AS line
            FROM (SELECT row_number() OVER (ORDER BY doc_id) AS rid, doc_id, coalesce(text, '') AS text FROM documents)),
l AS (SELECT *, len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS w FROM l0),
x AS (SELECT rid, row_number() OVER (PARTITION BY rid ORDER BY i) AS p, i, line, w,
             sum(w) OVER (PARTITION BY rid ORDER BY i) AS upto FROM l WHERE w > 0),
fore AS (SELECT a.rid, a.p AS first, min(b.p) AS last FROM x a JOIN x b ON a.rid = b.rid AND b.p >= a.p
         AND b.p < a.p + 50 AND b.upto - a.upto + a.w >= 50 GROUP BY ALL),
aft AS (SELECT b.rid, max(a.p) AS first, b.p AS last FROM x a JOIN x b ON a.rid = b.rid AND b.p >= a.p
        AND b.p < a.p + 50 AND b.upto - a.upto + a.w >= 50 GROUP BY ALL),
runs AS (SELECT * FROM fore UNION SELECT * FROM aft),
content AS (SELECT r.rid, r.first, r.last, string_agg(x.line, chr(10) ORDER BY x.p) AS k
            FROM runs r JOIN x ON r.rid = x.rid AND x.p BETWEEN r.first AND r.last GROUP BY ALL),
later AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY rid, first) AS copy FROM content) WHERE copy > 1),
gone AS (SELECT DISTINCT x.rid, x.i FROM later r JOIN x ON r.rid = x.rid AND x.p BETWEEN r.first AND r.last),
final AS (SELECT l.rid, any_value(l.doc_id) AS doc_id, count(g.i) AS n_deleted,
                 coalesce(string_agg(CAST(g.i AS VARCHAR), ',' ORDER BY l.i) FILTER (g.i IS NOT NULL), '') AS deleted,
                 coalesce(string_agg(l.line, chr(10) ORDER BY l.i) FILTER (g.i IS NULL), '') AS text
          FROM l LEFT JOIN gone g ON l.rid = g.rid AND l.i = g.i GROUP BY l.rid)
"""

NEIGHBOURS = """
WITH x AS (SELECT DISTINCT CAST(vec_id AS BIGINT) AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
             AND len(list_filter(embedding, lambda e: e <> 0)) > 0),
near AS (SELECT q.id AS query_id, x.id AS vec_id, list_distance(q.v, x.v) AS score
         FROM x q JOIN x ON x.id <> q.id AND len(x.v) = len(q.v) WHERE q.id % 100 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM near) WHERE rank <= 10
"""

AUDIT = """
WITH w AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
                  regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
f AS (SELECT doc_id, part, [len(w) < 100, 100 * len(list_distinct(w)) < 80 * len(w),
             100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text),
             regexp_matches(text, '[#$%&*|]'),
             coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)] AS fails FROM w),
l AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS bad
      FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
d AS (SELECT part, fails, coalesce(good, false) AS good, coalesce(bad, false) AS bad FROM f LEFT JOIN l USING (doc_id)),
m AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (bad) AS bad FROM d GROUP BY ALL),
i AS (SELECT unnest(range(1, 6)) AS i),
o AS (SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM i a, i b, i c, i d, i e
      WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
s AS (SELECT o, i.i AS step, array_to_string(list_transform(o, lambda k: chr(CAST(64 + k AS INTEGER))), '') AS filter_order,
             o[i.i] AS k, o[:i.i - 1] AS earlier FROM o, i),
x AS (SELECT part, filter_order, step, k, n, good, bad, fails, fails[k] AS hit,
             len(list_filter(earlier, lambda e: fails[e])) > 0 AS gone FROM m, s),
r AS (SELECT part, filter_order, step, any_value(k) AS k, sum(n) FILTER (NOT hit AND NOT gone) AS kept,
             sum(n) FILTER (hit AND NOT gone) AS removed, sum(n) FILTER (hit AND gone) AS redundant,
             sum(n) FILTER (hit AND len(list_filter(fails, lambda b: b)) = 1) AS unique_fails,
             sum(good) FILTER (hit AND NOT gone) AS good_lost, sum(bad) FILTER (hit AND NOT gone) AS toxic_lost
      FROM x GROUP BY part, filter_order, step)
"""

SQL: dict[str, str] = {
    "op3_neighbours": NEIGHBOURS,
    "op5_decontaminate": DECONTAMINATE + """
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(len(ids), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (rid) LEFT JOIN items USING (rid)
""",
    "op8_line_dedup": LINES + """
SELECT doc_id, CAST(n_deleted AS BIGINT) AS n_deleted, deleted, sha256(text) AS text_sha256 FROM final
""",
    "op13_filter_audit": AUDIT + """
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept,
       CAST(coalesce(removed, 0) AS BIGINT) AS removed,
       CAST(coalesce(redundant, 0) AS BIGINT) AS redundant,
       CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
       CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost,
       CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
       CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, k) AS BIGINT) AS shapley FROM r
""",
}
