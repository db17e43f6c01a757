"""DuckDB oracle SQL for the tagging queries (F2).  Sequential taggers use
recursive CTEs over positions."""

F2 = """
ln AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         unnest(range(0, len(string_split(text, chr(10))))) AS line_no
  FROM documents),
sa AS (
  SELECT doc_id * 2147483648 + line_no AS sent_id, doc_id % 5 <> 0 AS is_train,
         regexp_extract_all(lower(line), '\\S+') AS words
  FROM ln),
tok AS (
  SELECT sent_id, is_train, unnest(list_transform(range(1, len(words) + 1),
           lambda i: {'pos': i, 'word': words[i], 'prev': CASE WHEN i > 1 THEN words[i - 1] END})) AS t
  FROM sa WHERE len(words) > 0),
f2 AS (
  SELECT sent_id, CAST(t.pos AS INTEGER) AS pos, t.word AS word,
         CASE WHEN t.prev = 'the' THEN 'NN' WHEN suffix(t.word, 'ing') THEN 'VB'
              WHEN t.word IN ('of', 'in', 'on') THEN 'IN' WHEN length(t.word) <= 3 THEN 'DT' ELSE 'JJ' END AS tag,
         is_train
  FROM tok),
wc AS (SELECT word, count(*) AS cnt FROM f2 WHERE is_train GROUP BY word)
"""

BACKOFF_MODEL = """
ctx AS (
  SELECT f.sent_id, f.pos, f.word, f.tag,
         coalesce(p1.tag, '^') AS c1, coalesce(p2.tag, '^') || ' ' || coalesce(p1.tag, '^') AS c2
  FROM f2 f LEFT JOIN f2 p1 ON p1.sent_id = f.sent_id AND p1.pos = f.pos - 1
  LEFT JOIN f2 p2 ON p2.sent_id = f.sent_id AND p2.pos = f.pos - 2
  WHERE f.is_train),
cc AS (
  SELECT 1 AS ord, '' AS ctx, word, tag, sent_id, pos FROM ctx
  UNION ALL SELECT 2, c1, word, tag, sent_id, pos FROM ctx
  UNION ALL SELECT 3, c2, word, tag, sent_id, pos FROM ctx),
cn AS (
  SELECT ord, ctx, word, tag, count(*) AS cnt, min((sent_id, pos)) AS first
  FROM cc GROUP BY ALL),
bm AS (
  SELECT CAST(ord AS INTEGER) AS ord, ctx, word, tag FROM (
    SELECT *, row_number() OVER (PARTITION BY ord, ctx, word ORDER BY cnt DESC, first) AS rk FROM cn)
  WHERE rk = 1)
"""

BACKOFF_TAG = """
ev AS (SELECT sent_id, pos, word FROM f2 WHERE NOT is_train),
bt AS (
  SELECT e.sent_id, e.pos, e.word, '^' AS p2, coalesce(m3.tag, m2.tag, m1.tag, 'NN') AS tag
  FROM ev e
  LEFT JOIN bm m3 ON m3.ord = 3 AND m3.word = e.word AND m3.ctx = '^ ^'
  LEFT JOIN bm m2 ON m2.ord = 2 AND m2.word = e.word AND m2.ctx = '^'
  LEFT JOIN bm m1 ON m1.ord = 1 AND m1.word = e.word
  WHERE e.pos = 1
  UNION ALL
  SELECT e.sent_id, e.pos, e.word, t.tag AS p2,
         coalesce(m3.tag, m2.tag, m1.tag, 'NN') AS tag
  FROM bt t JOIN ev e ON e.sent_id = t.sent_id AND e.pos = t.pos + 1
  LEFT JOIN bm m3 ON m3.ord = 3 AND m3.word = e.word AND m3.ctx = t.p2 || ' ' || t.tag
  LEFT JOIN bm m2 ON m2.ord = 2 AND m2.word = e.word AND m2.ctx = t.tag
  LEFT JOIN bm m1 ON m1.ord = 1 AND m1.word = e.word)
"""

HMM_MODEL = """
tr AS (
  SELECT f.sent_id, f.pos, CASE WHEN w.cnt <= 1 THEN '<UNK>' ELSE f.word END AS word, f.tag
  FROM f2 f JOIN wc w USING (word) WHERE f.is_train),
nsent AS (SELECT count(DISTINCT sent_id) AS n FROM tr),
hs AS (
  SELECT tag, CASE WHEN count(*)::DOUBLE / (SELECT n FROM nsent) > 0
                   THEN round(log2(count(*)::DOUBLE / (SELECT n FROM nsent)), 9) ELSE -1e6 END AS logp
  FROM tr WHERE pos = 1 GROUP BY tag),
pc AS (
  SELECT a.tag AS prev, b.tag AS tag, count(*) AS c
  FROM tr a JOIN tr b ON b.sent_id = a.sent_id AND b.pos = a.pos + 1 GROUP BY ALL),
ht AS (
  SELECT prev, tag, round(log2(c::DOUBLE / sum(c) OVER (PARTITION BY prev)), 9) AS logp FROM pc),
ec AS (SELECT tag, word, count(*) AS c FROM tr GROUP BY ALL),
he AS (
  SELECT tag, word, round(log2(c::DOUBLE / sum(c) OVER (PARTITION BY tag)), 9) AS logp FROM ec)
"""

VITERBI = """
states AS (SELECT DISTINCT tag FROM (SELECT tag FROM hs UNION SELECT tag FROM he UNION SELECT prev FROM ht
                                     UNION SELECT tag FROM ht)),
ev AS (
  SELECT f.sent_id, f.pos, f.word,
         CASE WHEN w.cnt IS NULL OR w.cnt <= 1 THEN '<UNK>' ELSE f.word END AS mword
  FROM f2 f LEFT JOIN wc w USING (word) WHERE NOT f.is_train),
emit AS (
  SELECT e.sent_id, e.pos, s.tag, coalesce(h.logp, -1e6) AS le
  FROM ev e CROSS JOIN states s LEFT JOIN he h ON h.tag = s.tag AND h.word = e.mword),
trans AS (
  SELECT a.tag AS prev, b.tag AS tag, coalesce(t.logp, -1e6) AS lt
  FROM states a CROSS JOIN states b LEFT JOIN ht t ON t.prev = a.tag AND t.tag = b.tag),
vt AS (
  SELECT m.sent_id, m.pos, m.tag, coalesce(h.logp, -1e6) + m.le AS delta, CAST(NULL AS VARCHAR) AS bp
  FROM emit m LEFT JOIN hs h ON h.tag = m.tag WHERE m.pos = 1
  UNION ALL
  SELECT sent_id, pos, tag, cand + le AS delta, prev AS bp FROM (
    SELECT m.sent_id, m.pos, m.tag, m.le, v.tag AS prev, v.delta + tr.lt AS cand,
           row_number() OVER (PARTITION BY m.sent_id, m.tag ORDER BY v.delta + tr.lt DESC, v.tag) AS rk
    FROM vt v JOIN emit m ON m.sent_id = v.sent_id AND m.pos = v.pos + 1
    JOIN trans tr ON tr.prev = v.tag AND tr.tag = m.tag)
  WHERE rk = 1),
lastpos AS (SELECT sent_id, max(pos) AS l FROM ev GROUP BY sent_id),
fin AS (
  SELECT v.sent_id, v.pos, v.tag FROM (
    SELECT v.*, row_number() OVER (PARTITION BY v.sent_id ORDER BY v.delta DESC, v.tag) AS rk
    FROM vt v JOIN lastpos l ON l.sent_id = v.sent_id AND v.pos = l.l) v WHERE rk = 1),
bt AS (
  SELECT sent_id, pos, tag FROM fin
  UNION ALL
  SELECT b.sent_id, b.pos - 1, v.bp FROM bt b JOIN vt v ON v.sent_id = b.sent_id AND v.pos = b.pos AND v.tag = b.tag
  WHERE b.pos > 1),
hmm_pred AS (SELECT e.sent_id, e.pos, e.word, b.tag FROM ev e JOIN bt b USING (sent_id, pos))
"""

LINES = """
lines AS (
  SELECT sent_id // 2147483648 AS file, sent_id, p, line FROM (
    SELECT sent_id, CAST(pos - 1 AS INTEGER) AS p,
           CASE WHEN pos % 4 = 1 THEN chr(9) || word || chr(9) || tag || chr(9) ELSE word || ' ' || tag END AS line FROM f2
    UNION ALL
    SELECT sent_id, CAST(max(pos) AS INTEGER), '' FROM f2 GROUP BY sent_id)),
lx AS (
  SELECT *, sum(CASE WHEN line = '' THEN 1 ELSE 0 END) OVER (PARTITION BY file ORDER BY sent_id, p
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - CASE WHEN line = '' THEN 1 ELSE 0 END AS sent_no,
         sum(CASE WHEN line = '' THEN 1 ELSE 0 END) OVER (PARTITION BY file) AS n_closed
  FROM lines)
"""

SQL = {
    "tagged_sentences": f"""WITH {F2}, {LINES}
SELECT file, CAST(sent_no AS BIGINT) AS sent_no,
       CAST(row_number() OVER (PARTITION BY file, sent_no ORDER BY sent_id, p) AS INTEGER) AS pos,
       regexp_extract_all(line, '\\S+')[1] AS word, regexp_extract_all(line, '\\S+')[-1] AS tag
FROM lx WHERE line <> '' AND sent_no < n_closed""",
    "word_counts": f"WITH {F2} SELECT word, CAST(cnt AS BIGINT) AS cnt FROM wc",
    "unk_replace": f"""WITH {F2}
SELECT f.sent_id, f.pos, CASE WHEN w.cnt <= 1 THEN '<UNK>' ELSE f.word END AS word, f.tag
FROM f2 f JOIN wc w USING (word) WHERE f.is_train""",
    "unk_restore": f"""WITH {F2}
SELECT f.sent_id, f.pos, f.word, CASE WHEN w.cnt IS NULL OR w.cnt <= 1 THEN '<UNK>' ELSE f.word END AS model_word
FROM f2 f LEFT JOIN wc w USING (word) WHERE NOT f.is_train""",
    "slash_tag_encode": f"""WITH {F2}
SELECT sent_id, string_agg(word || '_' || tag, ' ' ORDER BY pos) AS line FROM f2 GROUP BY sent_id""",
    "slash_tag_decode": f"""WITH {F2}
SELECT sent_id, pos, split_part(word || '_' || tag, '_', 1) AS word,
       string_split(word || '_' || tag, '_')[-1] AS tag FROM f2""",
    "backoff_model": f"WITH {F2}, {BACKOFF_MODEL} SELECT ord AS \"order\", ctx, word, tag FROM bm",
    "backoff_tag": f"WITH RECURSIVE {F2}, {BACKOFF_MODEL}, {BACKOFF_TAG} SELECT sent_id, CAST(pos AS INTEGER) AS pos, word, tag FROM bt",
    "hmm_start": f"WITH {F2}, {HMM_MODEL} SELECT tag, logp FROM hs",
    "hmm_transition": f"WITH {F2}, {HMM_MODEL} SELECT prev, tag, logp FROM ht",
    "hmm_emission": f"WITH {F2}, {HMM_MODEL} SELECT tag, word, logp FROM he",
    "hmm_tag": f"WITH RECURSIVE {F2}, {HMM_MODEL}, {VITERBI} SELECT sent_id, CAST(pos AS INTEGER) AS pos, word, tag FROM hmm_pred",
}

ALIGN = """
truth AS (SELECT row_number() OVER (ORDER BY sent_id, pos) AS idx, word, tag FROM f2 WHERE NOT is_train),
pred AS (SELECT row_number() OVER (ORDER BY sent_id, pos) AS idx, word, tag FROM hmm_pred),
al AS (
  SELECT t.idx, t.word AS truth_word, t.tag AS truth_tag, p.word AS pred_word, p.tag AS pred_tag,
         CAST(coalesce(w.cnt, 0) AS BIGINT) AS train_count
  FROM truth t JOIN pred p USING (idx) LEFT JOIN wc w ON w.word = p.word)
"""

SQL["tag_alignment"] = (f"WITH RECURSIVE {F2}, {HMM_MODEL}, {VITERBI}, {ALIGN} "
                        "SELECT idx, truth_word, truth_tag, pred_word, pred_tag, train_count FROM al")
SQL["tag_accuracy"] = (f"WITH RECURSIVE {F2}, {HMM_MODEL}, {VITERBI}, {ALIGN} "
                       "SELECT train_count > 0 AS known, CAST(count(*) AS BIGINT) AS n, "
                       "round(avg(CASE WHEN truth_tag = pred_tag THEN 1.0 ELSE 0.0 END), 6) AS accuracy "
                       "FROM al GROUP BY ALL")


# Rule templates as (feature, offset), written out here on purpose: the oracle
# shares nothing with the operator but these fixed values and their names.
BRILL_TEMPLATES = """tag-1; tag+1; tag-2; tag+2; tag-2 tag-1; tag+1 tag+2; tag-1 tag+1; word+0; word-1; word+1;
word+0 tag-1; word+0 tag+1; word-1 tag-1; tag-3 tag-2 tag-1; tag+1 tag+2 tag+3"""
TEMPLATES = [[(f[:-2], int(f[-2:])) for f in t.split()] for t in BRILL_TEMPLATES.split(";")]
NAMES = " ".join(f"WHEN {k} THEN '" + " & ".join(f"{f}[{o:+d}]" for f, o in t) + "'" for k, t in enumerate(TEMPLATES))


def _key(t):
    """SQL of a template's key at position ``pos`` of ``words`` and ``cur``."""
    parts = [f"coalesce(CASE WHEN pos + {o} >= 1 THEN {'words' if f == 'word' else 'cur'}[pos + {o}] END, '<none>')" for f, o in t]
    return f"concat_ws(' ', {', '.join(parts)})"


KEYS = ", ".join(f"{{'tpl': {k}, 'key': {_key(t)}}}" for k, t in enumerate(TEMPLATES))
KEY_OF = "CASE tpl " + " ".join(f"WHEN {k} THEN {_key(t)}" for k, t in enumerate(TEMPLATES)) + " END"
TRAIN_TAG = BACKOFF_TAG.replace("ev AS (SELECT sent_id, pos, word FROM f2 WHERE NOT is_train)",
                                "ev0 AS (SELECT sent_id, pos, word FROM f2 WHERE is_train)") \
    .replace("bt AS (", "bt0 AS (").replace("FROM ev e", "FROM ev0 e").replace("FROM bt t JOIN ev e", "FROM bt0 t JOIN ev0 e")
STATE = """
st AS (
  SELECT f.sent_id, list(f.word ORDER BY f.pos) AS words, list(f.tag ORDER BY f.pos) AS gold,
         list(b.tag ORDER BY f.pos) AS cur
  FROM f2 f JOIN bt0 b ON b.sent_id = f.sent_id AND b.pos = f.pos WHERE f.is_train GROUP BY f.sent_id)
"""


def _scores(state):
    """Proposed rules with fixes and breaks, from the rows of ``state``."""
    return f"""
    SELECT *, sum(CASE WHEN from_tag = to_tag THEN n ELSE 0 END) OVER (PARTITION BY tpl, from_tag, key) AS breaks
    FROM (SELECT k.tpl AS tpl, c AS from_tag, k.key AS key, g AS to_tag, count(*) AS n
          FROM (SELECT cur[pos] AS c, gold[pos] AS g, unnest([{KEYS}]) AS k
                FROM (SELECT words, gold, cur, unnest(range(1, len(words) + 1)) AS pos FROM {state})) GROUP BY ALL)"""


SCORES = f"""
sc AS (SELECT tpl, from_tag, to_tag, key, CAST(n AS BIGINT) AS fixes, CAST(breaks AS BIGINT) AS breaks,
              CAST(n - breaks AS BIGINT) AS score FROM ({_scores('st')}) WHERE from_tag <> to_tag)
"""
CHANGED = f"""list_transform(range(1, len(words) + 1), lambda pos:
    CASE WHEN cur[pos] = from_tag AND ({KEY_OF}) = key THEN to_tag ELSE cur[pos] END)"""
# one round of learning per recursion: the rule, and the training tags after it
LEARN = f"""
learn AS (
  SELECT 0 AS rnd, sent_id, words, gold, cur, CAST(NULL AS STRUCT(tpl INT, from_tag VARCHAR, to_tag VARCHAR, key VARCHAR, score BIGINT)) AS rule
  FROM st
  UNION ALL
  SELECT rnd + 1, sent_id, words, gold, {CHANGED}, {{'tpl': tpl, 'from_tag': from_tag, 'to_tag': to_tag, 'key': key, 'score': score}}
  FROM learn, (SELECT CAST(tpl AS INT) AS tpl, from_tag, to_tag, key, CAST(n - breaks AS BIGINT) AS score FROM ({_scores('learn')})
               WHERE from_tag <> to_tag AND n - breaks >= 2 ORDER BY score DESC, tpl, from_tag, to_tag, key LIMIT 1) best),
rules AS (SELECT DISTINCT rnd, rule.tpl AS tpl, rule.from_tag AS from_tag, rule.to_tag AS to_tag, rule.key AS key, rule.score AS score
          FROM learn WHERE rnd > 0)
"""
APPLIED = f"""
base AS (SELECT 0 AS rnd, sent_id, list(word ORDER BY pos) AS words, list(tag ORDER BY pos) AS cur FROM bt GROUP BY sent_id),
steps AS (
  SELECT rnd, sent_id, words, cur FROM base
  UNION ALL
  SELECT s.rnd + 1, s.sent_id, s.words, {CHANGED} FROM steps s JOIN rules r ON r.rnd = s.rnd + 1),
brill_pred AS (
  SELECT sent_id, unnest(range(1, len(words) + 1)) AS pos, unnest(words) AS word, unnest(cur) AS tag
  FROM steps WHERE rnd = (SELECT coalesce(max(rnd), 0) FROM rules))
"""
# words with rare and unseen ones replaced, for the same queries
F2_UNK = F2.replace("f2 AS (", "f2w AS (").replace("FROM f2 WHERE is_train GROUP BY word", "FROM f2w WHERE is_train GROUP BY word") + """,
f2 AS (SELECT f.sent_id, f.pos, CASE WHEN coalesce(w.cnt, 0) <= 1 THEN '<UNK>' ELSE f.word END AS word, f.tag, f.is_train
       FROM f2w f LEFT JOIN wc w USING (word))
"""
HMM_PLAIN = HMM_MODEL.replace("CASE WHEN w.cnt <= 1 THEN '<UNK>' ELSE f.word END AS word", "f.word AS word")
VITERBI_PLAIN = VITERBI.replace("CASE WHEN w.cnt IS NULL OR w.cnt <= 1 THEN '<UNK>' ELSE f.word END AS mword", "f.word AS mword")
ACCURACY = ("SELECT train_count > 0 AS known, CAST(count(*) AS BIGINT) AS n, "
            "round(avg(CASE WHEN truth_tag = pred_tag THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM al GROUP BY ALL")


def _brill(f2=F2):
    return f"WITH RECURSIVE {f2}, {BACKOFF_MODEL}, {TRAIN_TAG}, {STATE}"


TAG = "SELECT sent_id, CAST(pos AS INTEGER) AS pos, word, tag FROM"
SQL |= {
    "brill_rule_scores": f"{_brill()}, {SCORES} SELECT CASE tpl {NAMES} END AS template, from_tag, to_tag, key, fixes, breaks, score FROM sc",
    "brill_apply": f"""{_brill()}, {SCORES},
best AS (SELECT * FROM sc ORDER BY score DESC, tpl, from_tag, to_tag, key LIMIT 1),
pos AS (SELECT sent_id, words, cur, unnest(range(1, len(words) + 1)) AS pos FROM st)
SELECT sent_id, CAST(pos AS INTEGER) AS pos, words[pos] AS word, cur[pos] AS old_tag, to_tag AS new_tag
FROM pos CROSS JOIN best WHERE cur[pos] = from_tag AND ({KEY_OF}) = key""",
    "brill_train": f"""{_brill()}, {LEARN}
SELECT CAST(rnd AS INTEGER) AS rule_no, CASE tpl {NAMES} END AS template, from_tag, to_tag, key, score FROM rules""",
    "brill_tag": f"{_brill()}, {LEARN}, {BACKOFF_TAG}, {APPLIED} {TAG} brill_pred",
    "brill_tag_unk": f"""{_brill(F2_UNK)}, {LEARN}, {BACKOFF_TAG}, {APPLIED}
SELECT p.sent_id, CAST(p.pos AS INTEGER) AS pos, w.word, p.tag FROM brill_pred p JOIN f2w w ON w.sent_id = p.sent_id AND w.pos = p.pos""",
    "brill_accuracy": f"{_brill()}, {LEARN}, {BACKOFF_TAG}, {APPLIED}, {ALIGN.replace('FROM hmm_pred', 'FROM brill_pred')} {ACCURACY}",
    "backoff_accuracy": f"WITH RECURSIVE {F2}, {BACKOFF_MODEL}, {BACKOFF_TAG}, {ALIGN.replace('FROM hmm_pred', 'FROM bt')} {ACCURACY}",
    "hmm_tag_plain": f"WITH RECURSIVE {F2}, {HMM_PLAIN}, {VITERBI_PLAIN} {TAG} hmm_pred",
}

# whole documents as sequences, scores as whole numbers of 1e-9
DOCUMENTS = """
states AS (SELECT tag, row_number() OVER (ORDER BY tag) AS k FROM (
             SELECT tag FROM hs UNION SELECT tag FROM he UNION SELECT prev FROM ht UNION SELECT tag FROM ht)),
dw AS (SELECT doc_id, regexp_extract_all(lower(text), '\\S+') AS ws FROM documents WHERE doc_id % 5 = 0),
dt AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS pos FROM dw),
mw AS (SELECT d.doc_id, d.pos, d.word, CASE WHEN coalesce(w.cnt, 0) <= 1 THEN '<UNK>' ELSE d.word END AS mword
       FROM dt d LEFT JOIN wc w USING (word)),
ew AS (SELECT v.mword, list(CAST(round(coalesce(h.logp, -1e6) * 1e9) AS HUGEINT) ORDER BY s.k) AS e
       FROM (SELECT DISTINCT mword FROM mw) v CROSS JOIN states s LEFT JOIN he h ON h.tag = s.tag AND h.word = v.mword
       GROUP BY v.mword),
ev AS MATERIALIZED (SELECT m.doc_id, m.pos, e.e FROM mw m JOIN ew e USING (mword)),
md AS MATERIALIZED (
  SELECT (SELECT list(CAST(round(coalesce(h.logp, -1e6) * 1e9) AS HUGEINT) ORDER BY s.k)
          FROM states s LEFT JOIN hs h USING (tag)) AS st,
         (SELECT list(c ORDER BY k) FROM (
            SELECT b.k, list(CAST(round(coalesce(t.logp, -1e6) * 1e9) AS HUGEINT) ORDER BY a.k) AS c
            FROM states a CROSS JOIN states b LEFT JOIN ht t ON t.prev = a.tag AND t.tag = b.tag GROUP BY b.k)) AS tr),
vt AS (
  SELECT ev.doc_id, ev.pos, list_transform(ev.e, lambda x, j: x + md.st[j]) AS d, CAST([] AS BIGINT[]) AS bp
  FROM ev, md WHERE ev.pos = 1
  UNION ALL
  SELECT doc_id, pos, list_transform(c, lambda x, j: list_max(x) + e[j]), list_transform(c, lambda x: list_position(x, list_max(x)))
  FROM (SELECT ev.doc_id, ev.pos, ev.e, list_transform(md.tr, lambda col: list_transform(col, lambda t, i: t + vt.d[i])) AS c
        FROM vt JOIN ev ON ev.doc_id = vt.doc_id AND ev.pos = vt.pos + 1, md)),
fin AS (SELECT v.doc_id, v.pos, list_position(v.d, list_max(v.d)) AS k, list_max(v.d) AS total
        FROM vt v JOIN (SELECT doc_id, max(pos) AS pos FROM ev GROUP BY doc_id) l USING (doc_id, pos)),
back AS (
  SELECT doc_id, pos, k, total FROM fin
  UNION ALL
  SELECT b.doc_id, b.pos - 1, v.bp[b.k], b.total FROM back b JOIN vt v ON v.doc_id = b.doc_id AND v.pos = b.pos WHERE b.pos > 1)
"""
SQL["hmm_tag_documents"] = f"""WITH RECURSIVE {F2}, {HMM_MODEL}, {DOCUMENTS}
SELECT b.doc_id, CAST(b.pos AS INTEGER) AS pos, m.word, s.tag,
       CAST((b.total - CASE WHEN b.total % 1000000 < 0 THEN b.total % 1000000 + 1000000 ELSE b.total % 1000000 END) // 1000000 AS BIGINT) AS score_milli
FROM back b JOIN mw m USING (doc_id, pos) JOIN states s USING (k)"""
