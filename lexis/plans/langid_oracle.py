"""DuckDB oracle SQL for the language-identification queries.

Written directly from the reference's definitions (per-occurrence lookups with
left joins and a plain product with the model list), not from the Spark
decomposition, so the two sides check each other.
"""

F1 = """
f1 AS (
  SELECT doc_id, lang, doc_id % 5 <> 0 AS is_train,
         CASE WHEN replace(text, chr(10), '') = '' THEN []::VARCHAR[]
              ELSE string_split(replace(text, chr(10), ''), '') END AS u
  FROM documents),
occ AS (
  SELECT lang, unnest(list_transform(range(1, len(u) + 1),
           lambda i: {'g1': u[i], 'g2': u[i] || u[i + 1], 'g3': u[i] || u[i + 1] || u[i + 2]})) AS s
  FROM f1 WHERE is_train),
grams AS (
  SELECT lang AS model, 1 AS n, s.g1 AS gram, count(*) AS cnt FROM occ GROUP BY ALL
  UNION ALL
  SELECT lang, 2, s.g2, count(*) FROM occ WHERE s.g2 IS NOT NULL GROUP BY ALL
  UNION ALL
  SELECT lang, 3, s.g3, count(*) FROM occ WHERE s.g3 IS NOT NULL GROUP BY ALL),
uni AS (SELECT model, gram, cnt FROM grams WHERE n = 1),
bi AS (SELECT model, gram, cnt FROM grams WHERE n = 2),
tri AS (SELECT model, gram, cnt FROM grams WHERE n = 3),
models AS (
  SELECT model, sum(cnt) FILTER (WHERE n = 1) AS t, count(*) FILTER (WHERE n = 2) AS v2
  FROM grams GROUP BY model),
ev AS (SELECT doc_id, lang, u, len(u) AS m FROM f1 WHERE NOT is_train)
"""

LAMBDAS = """
lv AS (
  SELECT tr.model, u1.cnt AS c1, b2.cnt AS c2, tr.cnt AS c3,
         CASE WHEN mo.t - 1 <> 0 THEN (u1.cnt - 1)::DOUBLE / (mo.t - 1) ELSE 0 END AS p1,
         CASE WHEN uy.cnt - 1 <> 0 THEN (b2.cnt - 1)::DOUBLE / (uy.cnt - 1) ELSE 0 END AS p2,
         CASE WHEN bxy.cnt - 1 <> 0 THEN (tr.cnt - 1)::DOUBLE / (bxy.cnt - 1) ELSE 0 END AS p3,
         CASE WHEN mo.t <> 0 THEN (u1.cnt - 1)::DOUBLE / mo.t ELSE 0 END AS p1f
  FROM tri tr JOIN models mo ON mo.model = tr.model
  JOIN uni u1 ON u1.model = tr.model AND u1.gram = substr(tr.gram, 3, 1)
  JOIN bi b2 ON b2.model = tr.model AND b2.gram = substr(tr.gram, 2, 2)
  JOIN uni uy ON uy.model = tr.model AND uy.gram = substr(tr.gram, 2, 1)
  JOIN bi bxy ON bxy.model = tr.model AND bxy.gram = substr(tr.gram, 1, 2)),
votes AS (
  SELECT model,
    sum(c1 * ((p1 = greatest(p1, 0.0, 0.0))::INT + (p1 = greatest(p1, p2, 0.0))::INT
              + (p1 = greatest(p1, p2, p3))::INT)) AS L1,
    sum(c2 * ((p2 = greatest(p1, p2, 0.0))::INT + (p2 = greatest(p1, p2, p3))::INT)) AS L2,
    sum(c3 * (p3 = greatest(p1, p2, p3))::INT) AS L3,
    sum(c1 * (p1f = greatest(p1f, p2, p3))::INT) AS F1,
    sum(c2 * (p2 = greatest(p1f, p2, p3))::INT) AS F2,
    sum(c3 * (p3 = greatest(p1f, p2, p3))::INT) AS F3
  FROM lv GROUP BY model),
lam AS (
  SELECT model, L1::DOUBLE / (L1 + L2 + L3) AS l1, L2::DOUBLE / (L1 + L2 + L3) AS l2,
         L3::DOUBLE / (L1 + L2 + L3) AS l3,
         F1::DOUBLE / (F1 + F2 + F3) AS f1, F2::DOUBLE / (F1 + F2 + F3) AS f2, F3::DOUBLE / (F1 + F2 + F3) AS f3
  FROM votes)
"""

PPL = {
    "unsmoothed": """
sc AS (
  SELECT e.doc_id, mo.model,
         sum(log2(coalesce(g.cnt, 1)::DOUBLE / (mo.t + 1))) AS lp
  FROM (SELECT doc_id, unnest(u) AS g1 FROM ev) e CROSS JOIN models mo
  LEFT JOIN uni g ON g.model = mo.model AND g.gram = e.g1
  GROUP BY ALL),
ppl AS (
  SELECT d.doc_id, mo.model, pow(2, -coalesce(sc.lp, 0) / d.m) AS perplexity
  FROM ev d CROSS JOIN models mo LEFT JOIN sc ON sc.doc_id = d.doc_id AND sc.model = mo.model)
""",
    "laplace": """
eb AS (
  SELECT doc_id, unnest(list_transform(range(1, m), lambda i: {'h': u[i], 'g': u[i] || u[i + 1]})) AS s
  FROM ev),
sc AS (
  SELECT e.doc_id, mo.model,
         sum(log2((coalesce(g2.cnt, 0) + 1)::DOUBLE / (coalesce(g1.cnt, 0) + mo.v2))) AS lp
  FROM eb e CROSS JOIN models mo
  LEFT JOIN bi g2 ON g2.model = mo.model AND g2.gram = e.s.g
  LEFT JOIN uni g1 ON g1.model = mo.model AND g1.gram = e.s.h
  GROUP BY ALL),
ppl AS (
  SELECT d.doc_id, mo.model, pow(2, -coalesce(sc.lp, 0) / d.m) AS perplexity
  FROM ev d CROSS JOIN models mo LEFT JOIN sc ON sc.doc_id = d.doc_id AND sc.model = mo.model)
""",
    "interpolation": LAMBDAS + """,
et AS (
  SELECT doc_id, unnest(list_transform(range(1, m - 1),
           lambda i: {'g': u[i] || u[i + 1] || u[i + 2], 'xy': u[i] || u[i + 1], 'yz': u[i + 1] || u[i + 2],
                      'y': u[i + 1], 'z': u[i + 2]})) AS s
  FROM ev),
sc AS (
  SELECT e.doc_id, mo.model,
         sum(log2(
             la.l1 * coalesce(uz.cnt, 1)::DOUBLE / (mo.t + 1)
           + la.l2 * CASE WHEN coalesce(uy.cnt, 0) > 0 THEN coalesce(byz.cnt, 0)::DOUBLE / uy.cnt ELSE 0 END
           + la.l3 * CASE WHEN coalesce(bxy.cnt, 0) > 0 THEN coalesce(txyz.cnt, 0)::DOUBLE / bxy.cnt ELSE 0 END
         )) AS lp
  FROM et e CROSS JOIN models mo JOIN lam la ON la.model = mo.model
  LEFT JOIN uni uz ON uz.model = mo.model AND uz.gram = e.s.z
  LEFT JOIN uni uy ON uy.model = mo.model AND uy.gram = e.s.y
  LEFT JOIN bi byz ON byz.model = mo.model AND byz.gram = e.s.yz
  LEFT JOIN bi bxy ON bxy.model = mo.model AND bxy.gram = e.s.xy
  LEFT JOIN tri txyz ON txyz.model = mo.model AND txyz.gram = e.s.g
  GROUP BY ALL),
ppl AS (
  SELECT d.doc_id, mo.model, pow(2, -coalesce(sc.lp, 0) / d.m) AS perplexity
  FROM ev d CROSS JOIN models mo LEFT JOIN sc ON sc.doc_id = d.doc_id AND sc.model = mo.model)
""",
}

# fixed values: n per smoothing mode
MODE_N = {"unsmoothed": 1, "laplace": 2, "interpolation": 3}


def _best(mode: str) -> str:
    return f"""
best_{mode} AS (
  SELECT doc_id, model, round(perplexity, 2) AS perplexity, CAST({MODE_N[mode]} AS INTEGER) AS n
  FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY round(perplexity, 4), model) AS rk
        FROM ppl_{mode}) WHERE rk = 1)"""


def _with_ppl(mode: str) -> str:
    return PPL[mode].replace("sc AS", f"sc_{mode} AS").replace("JOIN sc ON sc.", f"JOIN sc_{mode} sc ON sc.") \
        .replace("ppl AS", f"ppl_{mode} AS").replace("eb AS", f"eb_{mode} AS").replace("FROM eb e", f"FROM eb_{mode} e") \
        .replace("et AS", f"et_{mode} AS").replace("FROM et e", f"FROM et_{mode} e")


SQL = {
    "char_ngram_counts": f"WITH {F1} SELECT model, CAST(n AS INTEGER) AS n, gram, CAST(cnt AS BIGINT) AS cnt FROM grams",
    "model_stats": f"""WITH {F1}
SELECT model, CAST(sum(cnt) FILTER (WHERE n = 1) + 1 AS BIGINT) AS n_tokens,
       CAST(count(*) FILTER (WHERE n = 1) AS BIGINT) AS n_types,
       CAST(count(*) FILTER (WHERE n = 2) AS BIGINT) AS n_bigrams,
       CAST(count(*) FILTER (WHERE n = 3) AS BIGINT) AS n_trigrams
FROM grams GROUP BY model""",
    "oov_rate": f"""WITH {F1},
e AS (SELECT doc_id, unnest(u) AS g1 FROM ev),
x AS (SELECT e.doc_id, mo.model, count(*) FILTER (WHERE g.gram IS NULL) AS n_oov
      FROM e CROSS JOIN models mo LEFT JOIN uni g ON g.model = mo.model AND g.gram = e.g1 GROUP BY ALL)
SELECT d.doc_id, mo.model, CAST(d.m AS BIGINT) AS m, CAST(coalesce(x.n_oov, 0) AS BIGINT) AS n_oov
FROM ev d CROSS JOIN models mo LEFT JOIN x ON x.doc_id = d.doc_id AND x.model = mo.model""",
    "interp_lambdas": f"WITH {F1}, {LAMBDAS} SELECT model, round(l1, 6) AS l1, round(l2, 6) AS l2, round(l3, 6) AS l3 FROM lam",
    "interp_lambdas_final": f"WITH {F1}, {LAMBDAS} SELECT model, round(f1, 6) AS l1, round(f2, 6) AS l2, round(f3, 6) AS l3 FROM lam",
}

for _m in ("unsmoothed", "laplace", "interpolation"):
    SQL[f"lm_ppl_{_m}"] = f"WITH {F1}, {PPL[_m]} SELECT doc_id, model, round(perplexity, 4) AS perplexity FROM ppl"
    SQL[f"langid_best_{_m}"] = (f"WITH {F1}, {_with_ppl(_m)}, {_best(_m)} "
                                f"SELECT doc_id, model, perplexity, n FROM best_{_m}")

# one model per language and source: the same SQL over another model column
SQL["langid_topk"] = (
    "WITH docs AS (SELECT doc_id, text, concat_ws('/', lang, source) AS lang FROM documents), "
    + F1.replace("FROM documents)", "FROM docs)").lstrip() + ", " + PPL["laplace"] + """
SELECT doc_id, CAST(rk AS INTEGER) AS rank, model, round(perplexity, 4) AS perplexity
FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY round(perplexity, 4), model) AS rk FROM ppl
      WHERE perplexity IS NOT NULL) WHERE rk <= 3""")

SQL["langid_confusion"] = (
    f"WITH {F1}, " + ", ".join(_with_ppl(m) + ", " + _best(m) for m in ("unsmoothed", "laplace", "interpolation"))
    + """
SELECT mode, label, predicted, CAST(count(*) AS BIGINT) AS cnt FROM (
  SELECT 'unsmoothed' AS mode, e.lang AS label, b.model AS predicted FROM best_unsmoothed b JOIN ev e USING (doc_id)
  UNION ALL SELECT 'laplace', e.lang, b.model FROM best_laplace b JOIN ev e USING (doc_id)
  UNION ALL SELECT 'interpolation', e.lang, b.model FROM best_interpolation b JOIN ev e USING (doc_id))
GROUP BY ALL""")

WORDS = """
wl AS (
  SELECT doc_id, lang, doc_id % 5 <> 0 AS is_train, text,
         flatten(list_transform(string_split(text, chr(10)), lambda ln:
           list_concat(['<S>'], CASE WHEN trim(ln) = '' THEN []::VARCHAR[]
                                     ELSE regexp_split_to_array(trim(ln), '\\s+') END, ['</S>']))) AS pu,
         CASE WHEN trim(regexp_replace(text, '\\s+', ' ', 'g')) = '' THEN []::VARCHAR[]
              ELSE string_split(trim(regexp_replace(text, '\\s+', ' ', 'g')), ' ') END AS wu
  FROM documents),
wocc AS (
  SELECT lang, unnest(list_transform(range(1, len(pu) + 1), lambda i: {'g1': pu[i], 'g2': pu[i] || ' ' || pu[i + 1]})) AS s
  FROM wl WHERE is_train),
wgrams AS (
  SELECT lang AS model, 1 AS n, s.g1 AS gram, count(*) AS cnt FROM wocc GROUP BY ALL
  UNION ALL
  SELECT lang, 2, s.g2, count(*) FROM wocc WHERE s.g2 IS NOT NULL GROUP BY ALL),
wmodels AS (SELECT model, count(*) FILTER (WHERE n = 2) AS v2 FROM wgrams GROUP BY model)
"""

SQL["word_ngram_counts"] = f"WITH {WORDS} SELECT model, CAST(n AS INTEGER) AS n, gram, CAST(cnt AS BIGINT) AS cnt FROM wgrams"
SQL["lm_ppl_word_laplace"] = f"""WITH {WORDS},
wev AS (SELECT doc_id, wu AS u, len(wu) AS m FROM wl WHERE NOT is_train),
eb AS (SELECT doc_id, unnest(list_transform(range(1, m), lambda i: {{'h': u[i], 'g': u[i] || ' ' || u[i + 1]}})) AS s FROM wev),
sc AS (
  SELECT e.doc_id, mo.model,
         sum(log2((coalesce(g2.cnt, 0) + 1)::DOUBLE / (coalesce(g1.cnt, 0) + mo.v2))) AS lp
  FROM eb e CROSS JOIN wmodels mo
  LEFT JOIN wgrams g2 ON g2.model = mo.model AND g2.n = 2 AND g2.gram = e.s.g
  LEFT JOIN wgrams g1 ON g1.model = mo.model AND g1.n = 1 AND g1.gram = e.s.h
  GROUP BY ALL)
SELECT d.doc_id, mo.model, round(pow(2, -coalesce(sc.lp, 0) / d.m), 4) AS perplexity
FROM wev d CROSS JOIN wmodels mo LEFT JOIN sc ON sc.doc_id = d.doc_id AND sc.model = mo.model"""
SQL["rare_words"] = f"""WITH {WORDS},
w AS (SELECT doc_id, lang, unnest(wu) AS word FROM wl WHERE is_train),
c AS (SELECT lang, word, count(*) AS cnt FROM w GROUP BY ALL)
SELECT w.doc_id, w.lang AS model, CAST(count(*) AS BIGINT) AS n_words,
       CAST(sum(CASE WHEN c.cnt <= 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_unk
FROM w JOIN c USING (lang, word) GROUP BY ALL"""
SQL["ngram_counts_1_to_6"] = r"""
WITH t AS (SELECT lang, replace(text, chr(10), '') AS t, regexp_extract_all(text, '[^\s\x1C-\x1F\x{85}\p{Z}\x0B]+') AS w FROM documents),
o AS (SELECT unnest(range(1, 7)) AS n),
c AS (SELECT 'char' AS unit, lang, n, unnest(list_transform(range(1, length(t) - n + 2), lambda i: substr(t, i, n))) AS gram
      FROM t, o WHERE length(t) >= n),
v AS (SELECT 'word' AS unit, lang, n,
             unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS gram
      FROM t, o WHERE len(w) >= n)
SELECT unit, lang AS model, CAST(n AS INTEGER) AS n, gram, count(*) AS cnt
FROM (SELECT * FROM c UNION ALL SELECT * FROM v) GROUP BY ALL HAVING count(*) >= 2"""
