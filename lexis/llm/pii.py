"""Personal data by patterns, and by bootstrapped contextual extraction.

Regular expressions find the base identifiers (e-mail, IP address, card and
phone number); they are the seeds.  Every base span is a candidate, and so is
every token outside them that looks like an identifier (``SHORT`` characters or more, with
a digit or an @) and every sequence of digit groups with spaces between; the two words
before it (fewer at a text's start) and the kinds of characters in it are its lexical
pattern.  Spark scores the graph of patterns and instances:

* a pattern's score for a kind is the mean score of its distinct instances,
  reduced for patterns with few of them; it counts if the mean is at least half;
* an instance's score is the chance that one of its patterns is right.

What one round finds scores the patterns of the next, so contexts that hold no
seed are reached too, one step a round.  Scores only grow; rounds end when one
finds no other instance and all scores together grow by less than ``REST``.

Candidates that no base span covers are reported as ``<kind>_ctx`` if their score
reaches the threshold, with the kind of the highest score and, among equal ones, the
last kind by name.  Edges are distinct (pattern, instance) pairs that carry
hashes, not text; both steps are sums with map-side aggregation, and hot
patterns or instances meet a one-row side in the joins.  Rounds are written
tables.

Positions are code points, ends are exclusive.  Null and empty texts have no
spans; repeated rows each get theirs (an instance counts once however often it
is repeated); columns beside id and text are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexis.llm.common import SPAN, id_and_text, map_texts
from lexis.session import written

KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN_AT = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TOKEN = re.compile(r"\S+")
EDGES = ".,;:!?\"'()[]{}<>"
REST = 0.01             # rounds end when all scores together grow by less and no instance is new
SHORT = 6               # characters of a candidate that no base pattern knows, at least
LABEL = re.compile(r"[^\W\d_]\w*[:=]")     # glued to an identifier: tel:555-7713
NUMBER = frozenset("0123456789+-()./ ")      # characters of a number in groups
GROUPING = str.maketrans("", "", "+-()/ ")
JOINING = str.maketrans("", "", ".-_")
SPACES = " \xa0\u202f"     # between groups

CANDIDATE = T.StructType([
    T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("instance", T.LongType()),
    T.StructField("pattern", T.LongType()), T.StructField("kind", T.StringType())])


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) by start, then by kind as listed."""
    out = []
    done, at = 0, text.find("@")
    while at >= 0:   # the local part reaches back from an @ to where its characters begin
        a = at
        while a > done and text[a - 1] in LOCAL:
            a -= 1
        if a < at and (m := DOMAIN_AT.match(text, at + 1)):
            out.append((a, m.end(), "email"))
            done = m.end()
        else:
            done = at + 1
        at = text.find("@", done)
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((m.start(), m.end(), "ip"))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), m.end(), "card"))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c in "0123456789" for c in m[0]) <= 15:
                out.append((m.start(), m.end(), "phone"))
    out.sort(key=lambda s: (s[0], KINDS.index(s[2])))
    return out


def _shape(core: str) -> str:
    """The kinds of characters of an identifier: letters, digits, others each; those that only
    group the digits of a number or join the parts of a name do not count."""
    kinds = {"a" if c.isalpha() else "0" if c.isdigit() else c
             for c in core.translate(GROUPING if NUMBER.issuperset(core) else JOINING)}
    return "".join(sorted(kinds))


def candidates(text: str, base: list[tuple[int, int, str]]) -> list[tuple]:
    """Identifiers: (start, end, instance, pattern, kind of the base span or None).
    Each base span is one; so are the identifier-like tokens and the groups of digits with
    spaces between them that no base span overlaps."""
    from xxhash import xxh64_intdigest

    signed = lambda s: xxh64_intdigest(s) - (1 << 63)
    out = []

    def add(a, b, words, kind=None):
        core = text[a:b]
        out.append((a, b, signed(core.lower()), signed("\0".join((*words, _shape(core)))), kind))

    def before(first, a, last):   # what is glued to an identifier is the word before it
        glued = text[first:a].lower()
        return (last[1], glued) if glued.strip(EDGES) else last

    group, words = [], ("", "")     # pieces of a number in sequence, the words before the first

    def close():
        if len(group) > 1 and group[-1][1] - group[0][0] >= SHORT:
            add(group[0][0], group[-1][1], words)
        group.clear()

    i, covered, last, ended = 0, 0, ("", ""), 0     # base spans begun, their furthest end; empty words: the text's start
    for m in TOKEN.finditer(text):
        first, end = m.span()
        overlaps, at = covered > first, first
        while i < len(base) and base[i][0] < end:
            a, b, kind = base[i]
            add(a, b, before(max(at, min(covered, a)), a, last), kind)
            covered = max(covered, b)
            overlaps, i = True, i + 1
        word = m[0]
        core = word.strip(EDGES)
        if overlaps or not any(map(str.isdigit, core)) and "@" not in core:
            close()
        else:
            a = first + word.index(core)
            b = a + len(core)
            label = LABEL.match(core)
            rest = core[label.end():].strip(EDGES) if label else ""
            if rest and (len(rest) >= SHORT or NUMBER.issuperset(rest)):
                a = b - len(rest)
                core = rest
            context = before(first, a, last)
            left, right = text[first:a], text[b:end]
            if group and (left not in ("", "(") or text[ended:first].strip(SPACES)):
                close()
            if NUMBER.issuperset(core):
                if not group:
                    words = context
                opened = "(" in left[-1:] and (right.startswith(")") or ")" in core)
                group.append((a - opened, b + (opened and right.startswith(")"))))
                if right not in ("", ")"):
                    close()
            else:
                close()
            if len(core) >= SHORT:
                add(a, b, context)
        last, ended = (last[1], word.lower()), end
    close()
    return out


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int | None = None,
             threshold: float = 0.8, support: int = 3) -> DataFrame:
    """``doc_id, spans`` (base), ``found`` (contextual), both arrays of start, end, kind,
    for every text.  A pattern needs ``support`` distinct instances; ``rounds`` stops the
    search earlier."""
    def setup():
        import pyspark

        part = pyspark.TaskContext.get().partitionId() << 33
        count = [0]

        def f(texts):
            rows, base, cand = [], [], []
            for t in texts:
                spans = base_spans(t)
                rows.append(part + count[0])
                count[0] += 1
                base.append([{"start": a, "end": b, "kind": k} for a, b, k in spans])
                cand.append([dict(zip(("start", "end", "instance", "pattern", "kind"), c, strict=True))
                             for c in candidates(t, spans)])
            return [rows, base, cand]
        return f

    seen = written(map_texts(id_and_text(docs, id_col, text_col), [
        T.StructField("row", T.LongType()), T.StructField("spans", T.ArrayType(SPAN)),
        T.StructField("candidates", T.ArrayType(CANDIDATE))], setup), "pii")
    each = seen.where(F.size("candidates") > 0).select("row", F.explode("candidates").alias("c")).select("row", "c.*")
    edges = written(each.groupBy("pattern", "instance").agg(F.max("kind").alias("kind")), "graph")
    # patterns with too few instances can not score; those without a seed can, once a round has found some of theirs
    use = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).where(f"n >= {support}")
    edges = written(edges.join(use, "pattern"), "graph")
    seeds = edges.where("kind is not null").groupBy("instance", "kind").agg(F.lit(1.0).alias("score"))
    known = seeds.select("instance").distinct()
    count = lambda df: tuple(df.agg(F.count(F.lit(1)), F.coalesce(F.sum("score"), F.lit(0.0))).first())
    scores, before, done = seeds, count(seeds), 0
    while before[0] and (rounds is None or done < rounds):
        patterns = (edges.drop("kind").join(scores, "instance").groupBy("pattern", "kind")
                    .agg((F.sum("score") / F.max("n")).alias("mean"), F.max("n").alias("n")).where("mean >= 0.5")
                    .select("pattern", "kind", F.expr("mean * (n / (n + 1.0))").alias("trust")))
        fresh = (edges.where("kind is null").select("pattern", "instance").join(patterns, "pattern")
                 .groupBy("instance", "kind")
                 .agg((1.0 - F.exp(F.sum(F.log(F.greatest(F.lit(1.0) - F.col("trust"), F.lit(1e-6)))))).alias("score")))
        scores = written(seeds.union(fresh.join(known, "instance", "left_anti").select("instance", "kind", "score")), "scores")
        done, after = done + 1, count(scores)
        if after[0] == before[0] and after[1] - before[1] < REST:
            break
        before = after
    good = (scores.join(known, "instance", "left_anti").where(F.col("score") >= threshold)
            .groupBy("instance").agg(F.max(F.struct("score", "kind"))["kind"].alias("kind")))
    found = (each.where("kind is null").select("row", "start", "end", "instance").join(good, "instance")
             .groupBy("row").agg(F.sort_array(F.collect_set(F.struct(
                 "start", "end", F.concat("kind", F.lit("_ctx")).alias("kind")))).alias("found")))
    none = F.array().cast(T.ArrayType(SPAN))
    return seen.join(found, "row", "left").select("doc_id", "spans", F.coalesce("found", none).alias("found"))
