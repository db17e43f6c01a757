"""DuckDB oracle SQL for the classification queries."""


def _f5(label: str = "quality") -> str:
    lab = "CAST(l.quality AS VARCHAR)" if label == "quality" else "d.lang"
    return f"""
f5 AS (
  SELECT d.doc_id AS sample_id, {lab} AS label, d.text AS raw_text,
         regexp_replace(d.text, '[0-9]+', 'D', 'g') AS text, d.doc_id % 5 <> 0 AS is_train
  FROM documents d JOIN labels l USING (doc_id)),
tk AS (SELECT sample_id, regexp_extract_all(text, '[\\p{{L}}\\p{{N}}]+|[^\\s\\p{{L}}\\p{{N}}]', 0) AS toks FROM f5),
tok AS (SELECT sample_id, unnest(toks) AS token, unnest(range(0, len(toks))) AS pos FROM tk),
lem AS (
  SELECT token, CASE WHEN suffix(token, 'ing') AND length(token) > 4 THEN left(token, length(token) - 3)
                     WHEN suffix(token, 'ed') AND length(token) > 3 THEN left(token, length(token) - 2)
                     WHEN suffix(token, 's') AND length(token) > 2 THEN left(token, length(token) - 1) END AS lemma
  FROM (SELECT DISTINCT token FROM tok)),
terms AS (SELECT t.sample_id, t.pos, coalesce(l.lemma, t.token) AS term FROM tok t LEFT JOIN lem l USING (token)),
ps AS (SELECT sample_id, term, count(*) AS cnt, min(pos) AS first_pos FROM terms GROUP BY ALL)
"""


HOLDOUT_ASG = """
asg AS (SELECT 0 AS fold_id, sample_id, NOT is_train AS is_test FROM f5)
"""

CV_ASG = """
own AS (SELECT sample_id, ntile(3) OVER (ORDER BY sample_id) - 1 AS own_fold FROM f5 WHERE is_train),
asg AS (SELECT f.fold_id, o.sample_id, o.own_fold = f.fold_id AS is_test
        FROM own o CROSS JOIN (SELECT unnest(range(3)) AS fold_id) f)
"""

NB = """
tf AS (
  SELECT a.fold_id, p.term, sum(p.cnt) AS cnt, min(p.sample_id * 100000000 + p.first_pos) AS first
  FROM ps p JOIN asg a ON a.sample_id = p.sample_id AND NOT a.is_test GROUP BY ALL),
vr AS (SELECT fold_id, term, row_number() OVER (PARTITION BY fold_id ORDER BY cnt DESC, first) AS rank FROM tf),
vocab AS (SELECT fold_id, term, rank FROM vr WHERE rank > 100 AND rank <= 600),
pres AS (
  SELECT a.fold_id, a.sample_id, a.is_test, p.term
  FROM ps p JOIN asg a ON a.sample_id = p.sample_id JOIN vocab v ON v.fold_id = a.fold_id AND v.term = p.term),
lbl AS (
  SELECT a.fold_id, f.label, count(*) AS n_l, min(a.sample_id) AS ord
  FROM asg a JOIN f5 f USING (sample_id) WHERE NOT a.is_test GROUP BY ALL),
nlt AS (
  SELECT p.fold_id, f.label, p.term, count(*) AS n_lt
  FROM pres p JOIN f5 f USING (sample_id) WHERE NOT p.is_test GROUP BY ALL),
tl AS (SELECT fold_id, label, sum(n_lt) AS t_l FROM nlt GROUP BY ALL),
tot AS (SELECT fold_id, sum(t_l) AS t FROM tl GROUP BY ALL),
nn AS (SELECT fold_id, sum(n_l) AS n FROM lbl GROUP BY ALL),
sc AS (
  SELECT a.fold_id, a.sample_id, lb.label, lb.ord,
         log2(lb.n_l::DOUBLE / nn.n + 1.0 / nn.n)
         + coalesce(sum(CASE WHEN p.term IS NOT NULL THEN log2(coalesce(c.n_lt, 0)::DOUBLE / tl.t_l + 1.0 / tot.t) END), 0)
           AS score
  FROM asg a JOIN lbl lb ON lb.fold_id = a.fold_id JOIN nn ON nn.fold_id = a.fold_id
  LEFT JOIN tl ON tl.fold_id = a.fold_id AND tl.label = lb.label
  LEFT JOIN tot ON tot.fold_id = a.fold_id
  LEFT JOIN pres p ON p.fold_id = a.fold_id AND p.sample_id = a.sample_id
  LEFT JOIN nlt c ON c.fold_id = a.fold_id AND c.label = lb.label AND c.term = p.term
  WHERE a.is_test
  GROUP BY a.fold_id, a.sample_id, lb.label, lb.ord, lb.n_l, nn.n),
pred AS (
  SELECT s.fold_id, s.sample_id, s.label AS predicted, f.label AS label
  FROM (SELECT *, row_number() OVER (PARTITION BY fold_id, sample_id ORDER BY round(score, 4) DESC, ord) AS rk
        FROM sc) s JOIN f5 f USING (sample_id) WHERE rk = 1),
acc AS (
  SELECT fold_id, CAST(count(*) AS BIGINT) AS n, CAST(sum(CASE WHEN predicted = label THEN 1 ELSE 0 END) AS BIGINT) AS correct,
         avg(CASE WHEN predicted = label THEN 1.0 ELSE 0.0 END) AS accuracy
  FROM pred GROUP BY fold_id)
"""


def _holdout(label="quality"):
    return f"WITH {_f5(label)}, {HOLDOUT_ASG}, {NB}"


def _cv():
    return f"WITH {_f5()}, {CV_ASG}, {NB}"


SQL = {
    "digit_normalise": f"WITH {_f5()} SELECT sample_id, text FROM f5",
    "lemma_map": f"WITH {_f5()} SELECT token, lemma FROM lem WHERE lemma IS NOT NULL",
    "term_freq": f"{_holdout()} SELECT term, CAST(cnt AS BIGINT) AS cnt FROM tf",
    "vocab_band": f"{_holdout()} SELECT term, CAST(rank AS INTEGER) AS rank FROM vocab",
    "doc_term_presence": f"{_holdout()} SELECT sample_id, term FROM pres",
    "nb_counts": f"""{_holdout()}
SELECT lb.label, CAST(lb.n_l AS BIGINT) AS n_docs, CAST(coalesce(tl.t_l, 0) AS BIGINT) AS n_present
FROM lbl lb LEFT JOIN tl USING (fold_id, label)""",
    "nb_term_counts": f"{_holdout()} SELECT label, term, CAST(n_lt AS BIGINT) AS cnt FROM nlt",
    "nb_classify": f"{_holdout()} SELECT sample_id, label, round(score, 4) AS score FROM sc",
    "nb_holdout": f"{_holdout()} SELECT sample_id, label AS original_label, predicted AS classifier_label FROM pred",
    "nb_holdout_accuracy": f"{_holdout()} SELECT n, correct, round(accuracy, 6) AS accuracy FROM acc",
    "nb_holdout_lang_accuracy": f"{_holdout('lang')} SELECT n, correct, round(accuracy, 6) AS accuracy FROM acc",
    "nb_folds": f"WITH {_f5()}, {CV_ASG} SELECT sample_id, CAST(fold_id AS INTEGER) AS fold FROM asg WHERE is_test",
    "nb_cv": f"{_cv()} SELECT CAST(fold_id AS INTEGER) AS fold, n, correct, round(accuracy, 6) AS accuracy FROM acc",
    "nb_cv_mean": f"{_cv()} SELECT round(avg(accuracy), 6) AS mean_accuracy, CAST(count(*) AS BIGINT) AS folds FROM acc",
}
SQL["vocab_band_bounds"] = SQL["vocab_band"]
