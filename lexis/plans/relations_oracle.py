"""DuckDB oracle SQL for the entity / relation queries (F3, F3t, F4)."""

F3 = """
rel AS (
  SELECT c.c_custkey AS sent_id,
         concat_ws(' ',
           '[[ ' || c.c_name || ' ' || c.c_mktsegment || ' | /m/c' || c.c_custkey || ' ]]',
           'trades from',
           '[[ ' || n.n_name || ' | /m/n' || n.n_nationkey || ' ]]',
           'in',
           CASE WHEN c.c_custkey % 19 = 0 THEN '[[ ' || r.r_name || ' ]]'
                ELSE '[[ ' || r.r_name || ' | /m/r' || r.r_regionkey || ' ]]' END,
           CASE WHEN c.c_custkey % 7 = 0 THEN 'near [[ ' || n.n_name || ' | /m/n' || n.n_nationkey || ' ]]' END,
           CASE WHEN c.c_custkey % 11 = 0 THEN 'via /m/r' || r.r_regionkey END,
           CASE WHEN c.c_custkey % 13 = 0 THEN 'via /m/z' || c.c_custkey END,
           CASE WHEN c.c_custkey % 5 = 0 THEN 'for [[ AGENT | /m/a' || c.c_custkey || ' ]]' END) AS sentence,
         c.c_name || ' ' || c.c_mktsegment AS s_name, '/m/c' || c.c_custkey AS s_mid,
         n.n_name AS o_name,
         CASE WHEN c.c_custkey % 17 = 0 THEN '/m/c' || c.c_custkey ELSE '/m/n' || n.n_nationkey END AS o_mid
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey),
raw AS (
  SELECT sent_id, unnest(regexp_extract_all(sentence, '\\[\\[ (.*?) \\]\\]', 1)) AS m,
         unnest(range(1, len(regexp_extract_all(sentence, '\\[\\[ (.*?) \\]\\]', 1)) + 1)) AS idx
  FROM rel),
ph AS (
  SELECT sent_id, idx, trim(split_part(m, '|', 1)) AS phrase,
         row_number() OVER (PARTITION BY sent_id, trim(split_part(m, '|', 1)) ORDER BY idx) AS rn
  FROM raw),
mentions AS (
  SELECT sent_id, CAST(row_number() OVER (PARTITION BY sent_id ORDER BY idx) AS INTEGER) AS ord, phrase
  FROM ph WHERE rn = 1),
clean AS (
  SELECT sent_id, array_to_string(list_filter(string_split(sentence, ' '),
           lambda w: NOT (w IN ('[[', ']]', '|') OR starts_with(w, '/m/'))), ' ') AS text
  FROM rel),
cw AS (SELECT sent_id, string_split(text, ' ') AS words FROM clean),
f3t AS (
  SELECT sent_id, list_transform(range(1, len(words) + 1), lambda i:
    CASE WHEN i > 1 AND starts_with(words[i - 1], 'Customer#') THEN 'JJ'
         WHEN starts_with(words[i], 'Customer#') THEN 'NNP'
         WHEN regexp_matches(words[i], '^NATION_[0-9]+$')
           THEN CASE WHEN CAST(regexp_extract(words[i], '^NATION_([0-9]+)$', 1) AS INTEGER) % 3 = 0
                     THEN 'JJ' ELSE 'NNP' END
         WHEN words[i] = 'trades' THEN 'VBZ'
         WHEN words[i] = lower(words[i]) THEN 'IN'
         ELSE 'NNP' END) AS tags, words AS texts
  FROM cw),
spans AS (
  SELECT m.sent_id, m.ord, m.phrase, t.texts, t.tags, string_split(m.phrase, ' ') AS p
  FROM mentions m JOIN f3t t USING (sent_id)),
matched AS (
  SELECT sent_id, ord, phrase,
         list_filter(range(1, len(texts) - len(p) + 2), lambda s: texts[s:s + len(p) - 1] = p)[1] AS start,
         tags, p
  FROM spans),
sm AS (
  SELECT sent_id, ord, phrase, CAST(start AS INTEGER) AS start, tags[start:start + len(p) - 1] AS mtags
  FROM matched WHERE start IS NOT NULL),
ent AS (
  SELECT r.sent_id, r.idx, upper(trim(string_split(r.m, '|')[1])) AS name, trim(string_split(r.m, '|')[2]) AS mid,
         rel.s_mid, rel.o_mid
  FROM raw r JOIN rel USING (sent_id)),
fresh AS (
  SELECT sent_id, idx, name, mid FROM (
    SELECT *, row_number() OVER (PARTITION BY sent_id, mid ORDER BY idx) AS rn FROM ent WHERE mid IS NOT NULL)
  WHERE rn = 1 AND mid <> s_mid AND mid <> o_mid),
roles AS (
  SELECT sent_id, 1 AS ord, 'SUBJECT' AS role, upper(s_name) AS name, s_mid AS mid FROM rel
  UNION ALL SELECT sent_id, 2, 'OBJECT', upper(o_name), o_mid FROM rel
  UNION ALL SELECT sent_id, 2 + row_number() OVER (PARTITION BY sent_id ORDER BY idx),
                   'ENTITY' || row_number() OVER (PARTITION BY sent_id ORDER BY idx), name, mid FROM fresh),
rw AS (
  SELECT sent_id, unnest(string_split(sentence, ' ')) AS w, unnest(range(1, len(string_split(sentence, ' ')) + 1)) AS idx
  FROM rel),
rw2 AS (
  SELECT rw.*, coalesce(last_value(CASE WHEN w IN ('[[', ']]') THEN w END IGNORE NULLS)
           OVER (PARTITION BY sent_id ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) = '[[', false) AS inside
  FROM rw),
rl AS (SELECT sent_id, mid, arg_min(role, ord) AS role FROM roles GROUP BY ALL),
rw3 AS (
  SELECT rw2.sent_id, rw2.idx,
         CASE WHEN w IN ('[[', ']]') THEN NULL WHEN starts_with(w, '/m/') THEN rl.role
              WHEN inside THEN NULL ELSE w END AS out
  FROM rw2 LEFT JOIN rl ON rl.sent_id = rw2.sent_id AND rl.mid = rw2.w),
rewritten AS (
  SELECT sent_id, coalesce(list(out ORDER BY idx) FILTER (WHERE out IS NOT NULL), []::VARCHAR[]) AS words
  FROM rw3 GROUP BY sent_id),
f4 AS (
  SELECT sent_id, words AS texts,
         list_transform(range(1, len(words) + 1), lambda k:
           CASE WHEN sent_id % 4 = 0 AND list_position(list_reverse(words), 'OBJECT') > 0
                     AND k = len(words) - list_position(list_reverse(words), 'OBJECT') + 1 THEN 0
                ELSE k // 2 END) AS heads
  FROM rewritten),
starts AS (
  SELECT sent_id, 'SUBJECT' AS role, len(texts) - list_position(list_reverse(texts), 'SUBJECT') + 1 AS s
  FROM f4 WHERE list_position(list_reverse(texts), 'SUBJECT') > 0
  UNION ALL
  SELECT sent_id, 'OBJECT', len(texts) - list_position(list_reverse(texts), 'OBJECT') + 1
  FROM f4 WHERE list_position(list_reverse(texts), 'OBJECT') > 0),
walk AS (
  SELECT sent_id, role, [s] AS path, s AS cur, 0 AS steps FROM starts
  UNION ALL
  SELECT w.sent_id, w.role, list_append(w.path, f.heads[w.cur]), f.heads[w.cur], w.steps + 1
  FROM walk w JOIN f4 f ON f.sent_id = w.sent_id WHERE f.heads[w.cur] <> 0 AND w.steps < len(f.heads)),
full_path AS (SELECT sent_id, role, arg_max(path, steps) AS path FROM walk GROUP BY ALL),
pp AS (
  SELECT f.sent_id, f.texts, sp.path AS sp, op.path AS op
  FROM f4 f LEFT JOIN full_path sp ON sp.sent_id = f.sent_id AND sp.role = 'SUBJECT'
  LEFT JOIN full_path op ON op.sent_id = f.sent_id AND op.role = 'OBJECT'),
pr AS (
  SELECT sent_id, texts, sp, op,
         array_to_string(list_transform(sp, lambda k: texts[k]), ' -> ') AS subject_path,
         array_to_string(list_transform(op, lambda k: texts[k]), ' -> ') AS object_path,
         sp IS NOT NULL AND op IS NOT NULL AS valid
  FROM pp),
lc AS (
  SELECT sent_id, valid, subject_path, object_path,
         coalesce(list_position(list_transform(range(1, least(len(sp), len(op)) + 1),
                                               lambda j: list_reverse(sp)[j] = list_reverse(op)[j]), false),
                  least(len(sp), len(op)) + 1) - 1 AS k, sp
  FROM pr WHERE valid),
lca AS (
  SELECT l.sent_id, CASE WHEN l.k > 0 THEN p.texts[list_reverse(l.sp)[l.k]] ELSE '-None-' END AS lca
  FROM lc l JOIN pr p USING (sent_id))
"""

SQL = {
    "mention_extract": f"WITH {F3} SELECT sent_id, ord, phrase FROM mentions",
    "mention_clean": f"WITH {F3} SELECT sent_id, text FROM clean",
    "mention_span_match": f"WITH {F3} SELECT sent_id, phrase, start, array_to_string(mtags, ' ') AS tags FROM sm",
    "noun_mismatch": f"""WITH {F3}
SELECT sent_id, phrase, array_to_string(mtags, ' ') AS tags FROM sm
WHERE NOT list_has_any(mtags, ['NN', 'NNS', 'NNP', 'NNPS'])""",
    "entity_roles": f"WITH {F3} SELECT sent_id, CAST(ord AS INTEGER) AS ord, role, name, mid FROM roles",
    "role_rewrite": f"WITH {F3} SELECT sent_id, array_to_string(words, ' ') AS text FROM rewritten",
    "relation_validity": f"""WITH RECURSIVE {F3},
nm AS (SELECT sent_id, count(*) AS n FROM mentions GROUP BY ALL),
nx AS (SELECT sent_id, count(*) AS n FROM sm GROUP BY ALL),
eo AS (SELECT sent_id, bool_and(len(string_split(m, '|')) >= 2) AS ok FROM raw GROUP BY ALL)
SELECT r.sent_id, CAST(coalesce(nm.n, 0) AS INTEGER) AS n_mentions, CAST(coalesce(nx.n, 0) AS INTEGER) AS n_matched,
       coalesce(nm.n, 0) = coalesce(nx.n, 0) AS mentions_ok, coalesce(eo.ok, true) AS entities_ok,
       coalesce(pr.valid, false) AS paths_ok
FROM rel r LEFT JOIN nm USING (sent_id) LEFT JOIN nx USING (sent_id) LEFT JOIN eo USING (sent_id)
LEFT JOIN pr USING (sent_id)""",
    "path_to_root": f"WITH RECURSIVE {F3} SELECT sent_id, subject_path, object_path FROM pr",
    "lca": f"WITH RECURSIVE {F3} SELECT sent_id, lca FROM lca",
    "relation_report": f"""WITH RECURSIVE {F3},
el AS (SELECT sent_id, string_agg(role || ':' || chr(9) || '[[ ' || name || ' | ' || mid || ' ]]', chr(10) ORDER BY ord)
         AS entities FROM roles GROUP BY sent_id)
SELECT w.sent_id, array_to_string(w.words, ' ') AS text, el.entities, pr.subject_path, pr.object_path, lca.lca
FROM rewritten w JOIN el USING (sent_id) JOIN pr USING (sent_id) JOIN lca USING (sent_id)""",
}
SQL["lca_lifted"] = SQL["lca"]
SQL["ancestor_steps"] = f"""WITH RECURSIVE {F3},
st AS (SELECT sent_id, role, unnest(path) AS i, unnest(range(0, len(path))) AS step FROM full_path)
SELECT s.sent_id, s.role, CAST(s.step AS INTEGER) AS step, CAST(s.i AS INTEGER) AS i, f.texts[s.i] AS text
FROM st s JOIN f4 f USING (sent_id)"""
SQL["phrase_matches"] = f"""WITH {F3},
every AS (SELECT DISTINCT phrase, len(string_split(phrase, ' ')) AS k FROM mentions),
sizes AS (SELECT DISTINCT k FROM every),
cut AS (SELECT sent_id, k, s, array_to_string(words[s:s + k - 1], ' ') AS phrase
        FROM (SELECT cw.*, k, unnest(range(1, len(words) - k + 2)) AS s FROM cw, sizes WHERE len(words) >= k))
SELECT cut.sent_id, cut.phrase, CAST(cut.s AS INTEGER) AS start FROM cut JOIN every USING (phrase, k)"""
