"""Rule learning by posting lists: the rules of ``rules.fit_rules`` without writing all
counts anew every round.  On small tables its rounds take longer (README).

A round reads what its rule touches.  ``RuleIndex`` keeps posting lists
(condition -> sentences) and the sentences in blocks, both written once; what a
round changes goes to small signed delta tables beside them, merged in tiers.
``RuleHeap`` holds the best conditions with upper bounds of their scores, so counts
are looked up only for conditions that a round touched and whose bound reaches the
best score.

Null tags make neither fixes nor breaks, an empty state gives no rules, and columns
beside ``sent_id, words, gold, cur`` are ignored; ``sent_id`` must be unique.
Tables are deleted when merged and at the end.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexis.operators.rules import TEMPLATES, _keys, apply_rule, positions, score_counts, template_name
from lexis.session import drop_written, written_at

TOKENS_PER_BLOCK = 500_000
HEAP = 20_000         # conditions with a score bound on the driver; others share one bound
LOOK = 64             # conditions whose postings are read in one job
DELTA_ROWS = 200_000  # count changes of a round that the heap takes; above, it is filled anew
TIER = 8              # delta tables of one size that are merged into one of the next


def _signed(col: str, n: int) -> Column:
    """The position struct's rows under the tags ``col`` with the sign ``n``."""
    return F.transform(F.col(f"x.ks_{col}"), lambda k: F.struct(
        k["tpl"].alias("tpl"), k["key"].alias("key"), F.col(f"x.{col}").alias("cur"), F.col("x.gold").alias("gold"),
        F.lit(n).alias("cnt")))


class RuleIndex:
    """The learning state as tables in the shared checkpoint folder.

    * sentences ``block, round, sent_id, words, gold, cur``: the first table with one
      folder a block, beside it the sentences that a round changed; the row of the
      latest round is the sentence's present state;
    * postings ``tpl, key, cur, gold, cnt, block, sent_id``: the first table sorted by
      condition, so that a condition's rows are few row groups (a hot one is split by
      sentence), and signed ones (+1 / -1) of the rounds since."""

    def __init__(self, state: DataFrame):
        self.spark = state.sparkSession
        self.paths: set[str] = set()
        base = state.select("sent_id", "words", "gold", "cur")
        tokens = base.agg(F.sum(F.size("words"))).first()[0] or 0
        self.n_parts = max(2 * self.spark.sparkContext.defaultParallelism, -(-tokens // TOKENS_PER_BLOCK))
        block = F.pmod(F.xxhash64("sent_id"), F.lit(self.n_parts)).cast("int")
        sents = base.select("sent_id", "words", "gold", "cur", F.lit(0).alias("round"), block.alias("block"))
        self.sentences = [[self._keep(sents.repartition(self.n_parts, "block"), "tags", ["block"])]]
        posts = (positions(self.sentences[0][0][0], "block")
                 .select("tpl", "key", "cur", "gold", F.lit(1).alias("cnt"), "block", "sent_id"))
        n = self.n_parts * max(1, len(TEMPLATES) // 4)
        self.first = self._keep(posts.repartitionByRange(n, "tpl", "key", "sent_id")
                                .sortWithinPartitions("tpl", "key", "sent_id"), "rules")
        self.deltas: list[list] = [[]]

    def _keep(self, df: DataFrame, name: str, by: list[str] | None = None):
        table = written_at(df, name, by)
        self.paths.add(table[1])
        return table

    def _drop(self, path: str):
        drop_written(self.spark, path)
        self.paths.discard(path)

    def close(self):
        for path in list(self.paths):
            self._drop(path)

    def postings(self) -> DataFrame:
        return reduce(DataFrame.union, [df for tier in self.deltas for df, _ in tier], self.first[0])

    def counts(self, conditions: list | None = None) -> DataFrame:
        """``tpl, key, cur, gold, cnt`` now, of some ``(tpl, key)`` or of all."""
        posts = self.postings()
        if conditions is not None:
            posts = posts.where(reduce(Column.__or__, [
                (F.col("tpl") == F.lit(t)) & (F.col("key") == F.lit(k)) for t, k in conditions]))
        return posts.groupBy("tpl", "key", "cur", "gold").agg(F.sum("cnt").alias("cnt")).where("cnt > 0")

    def _latest(self, sents: DataFrame) -> DataFrame:
        return (sents.groupBy("block", "sent_id")
                .agg(F.max_by(F.struct("words", "gold", "cur", "round"), "round").alias("s"))
                .select("sent_id", "s.words", "s.gold", "s.cur", "s.round", "block"))

    def _merge(self, tiers: list[list], merge):
        """Full tiers become one table of the next, so a row is rewritten once a tier."""
        level = len(tiers) - 1
        while level >= 0 and len(tiers[level]) >= TIER:
            old = tiers[level]
            merged = merge(reduce(DataFrame.union, [df for df, _ in old]))
            tiers[level] = []
            if level == 0:
                tiers.insert(0, [])
                level = 1
            tiers[level - 1].append(merged)
            for _, path in old:
                self._drop(path)
            level -= 1

    def compact(self):
        """Merge full tiers; tables that were merged are deleted."""
        self._merge(self.sentences, lambda df: self._keep(self._latest(df).select(df.columns), "pairs"))
        self._merge(self.deltas, lambda df: self._keep(
            df.groupBy("tpl", "key", "cur", "gold", "block", "sent_id").agg(F.sum("cnt").cast("int").alias("cnt"))
            .where("cnt <> 0").select(df.columns), "delta"))

    def apply(self, rule: dict, number: int) -> DataFrame:
        """Apply a rule to the sentences in its posting list; returns the signed counts
        ``tpl, key, cur, gold, cnt`` that it changes."""
        hits = (self.postings().where((F.col("tpl") == F.lit(rule["tpl"])) & (F.col("key") == F.lit(rule["key"]))
                                      & (F.col("cur") == F.lit(rule["from_tag"])))
                .groupBy("block", "sent_id").agg(F.sum("cnt").alias("n")).where("n > 0")
                .select("block", "sent_id").persist())
        blocks = [r["block"] for r in hits.select("block").distinct().collect()]
        now = reduce(DataFrame.union, [df.where(F.col("block").isin(blocks)) for tier in self.sentences for df, _ in tier])
        old = self._latest(now.join(hits, ["block", "sent_id"], "left_semi")
                           .select(now.columns))
        new = apply_rule(old.withColumn("was", F.col("cur")), rule["tpl"], rule["from_tag"], rule["to_tag"], rule["key"])
        pairs, path = self._keep(new.withColumn("round", F.lit(number)), "pairs")
        hits.unpersist()
        # only positions whose tag or conditions differ give rows
        z = F.filter(F.transform("words", lambda w, i: F.struct(
            F.get(F.col("was"), i).alias("was"), F.get(F.col("cur"), i).alias("cur"),
            F.get(F.col("gold"), i).alias("gold"), _keys(i, "was").alias("ks_was"), _keys(i, "cur").alias("ks_cur"))),
            lambda x: ~x["was"].eqNullSafe(x["cur"]) | (x["ks_was"] != x["ks_cur"]))
        delta = (pairs.select("block", "sent_id", F.explode(z).alias("x"))
                 .select("block", "sent_id", F.inline(F.concat(_signed("was", -1), _signed("cur", 1))))
                 .select("tpl", "key", "cur", "gold", "cnt", "block", "sent_id"))
        table = self._keep(delta, "delta")
        self.sentences[-1].append((pairs.select(now.columns), path))
        self.deltas[-1].append(table)
        return table[0].groupBy("tpl", "key", "cur", "gold").agg(F.sum("cnt").alias("cnt")).where("cnt <> 0")


class RuleHeap:
    """The best rule of every round from bounds on the driver.

    ``top[(tpl, key)] = (bound, rule)``: no rule of the condition scores more than
    ``bound``; ``rule`` is its best one if that is its score, None if it must be looked
    up.  Conditions outside score ``floor`` at most.  At most ``HEAP`` conditions are
    taken when it is filled, and ``DELTA_ROWS`` changes a round; beyond them it is filled
    anew from all counts, so the choice is exact whatever the sizes."""

    def __init__(self, index: RuleIndex, min_score: int):
        self.index, self.min_score = index, min_score
        self.top: dict = {}
        self.known: dict = {}  # (tpl, key) -> {(cur, gold): count}, looked up and kept current
        self.stale = True

    @staticmethod
    def _order(rule: dict):
        return (-rule["score"], rule["tpl"], rule["from_tag"], rule["to_tag"], rule["key"])

    def _fill(self):
        rows = (score_counts(self.index.counts(), self.min_score)
                .orderBy(F.col("score").desc(), "tpl", "from_tag", "to_tag", "key").limit(HEAP + 1).collect())
        self.top, self.known, self.stale = {}, {}, False
        self.floor = self.min_score - 1
        if len(rows) > HEAP:
            self.floor = max(self.floor, rows[-1]["score"])
        for r in rows[:HEAP]:
            self.top.setdefault((r["tpl"], r["key"]), (r["score"], r.asDict()))

    def _set(self, cond, counts: dict):
        """Exact best rule of a condition from its counts."""
        self.known[cond] = counts
        found = [{"tpl": cond[0], "from_tag": cur, "to_tag": gold, "key": cond[1], "fixes": n,
                  "breaks": counts.get((cur, cur), 0), "score": n - counts.get((cur, cur), 0)}
                 for (cur, gold), n in counts.items() if cur is not None and gold is not None and cur != gold and n > 0]
        best = min(found, key=self._order, default=None)
        if best is not None:
            self.top[cond] = (best["score"], best)
        else:
            self.top.pop(cond, None)
            # stays known: a rule of it can come back by a change only

    def best(self) -> dict | None:
        if self.stale:
            self._fill()
        while True:
            rule = min((r for _, r in self.top.values() if r is not None), key=self._order, default=None)
            bar = max(self.min_score, rule["score"]) if rule else self.min_score
            unsure = sorted((c for c, (bound, r) in self.top.items() if r is None and bound >= bar),
                            key=lambda c: (-self.top[c][0], c))[:LOOK]
            if not unsure:
                break
            counts: dict = {c: {} for c in unsure}
            for r in self.index.counts(unsure).collect():
                counts[(r["tpl"], r["key"])][(r["cur"], r["gold"])] = r["cnt"]
            for cond, c in counts.items():
                self._set(cond, c)
        if self.floor >= bar:   # a condition outside may score as much
            self._fill()
            rule = min((r for _, r in self.top.values()), key=self._order, default=None)
        return rule if rule and rule["score"] >= self.min_score else None

    def change(self, delta: DataFrame):
        """Take a round's count changes: exact where counts are known, else by bounds."""
        rows = delta.limit(DELTA_ROWS + 1).collect()
        if len(rows) > DELTA_ROWS:
            self.stale = True
            return
        by_cond: dict = {}
        for r in rows:
            by_cond.setdefault((r["tpl"], r["key"]), []).append((r["cur"], r["gold"], r["cnt"]))
        for cond, changed in by_cond.items():
            if cond in self.known:
                counts = self.known[cond]
                for cur, gold, n in changed:
                    counts[(cur, gold)] = counts.get((cur, gold), 0) + n
                self._set(cond, counts)
            else:
                rise = sum(max(0, -n if cur == gold else n) for cur, gold, n in changed)
                self.top[cond] = (self.top.get(cond, (self.floor, None))[0] + rise, None)


def fit_rules_indexed(state: DataFrame, min_score: int = 2, max_rules: int | None = None) -> list[dict]:
    """The rules of ``rules.fit_rules``, in order: greedy learning until no rule scores
    ``min_score`` (1 or more).  A round looks up conditions whose bound reaches the best
    score and writes the sentences of its rule's posting list and their count changes."""
    rules = []
    index = RuleIndex(state)
    try:
        heap = RuleHeap(index, min_score)
        while max_rules is None or len(rules) < max_rules:
            best = heap.best()
            if best is None:
                break
            r = {**best, "rule_no": len(rules) + 1, "template": template_name(TEMPLATES[best["tpl"]])}
            rules.append(r)
            heap.change(index.apply(r, len(rules)))
            index.compact()
    finally:
        index.close()
    return rules
