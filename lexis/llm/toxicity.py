"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on ordinary text and one on toxic
text.  A text is cut into word windows; the distance of a window is its
compressed length under the ordinary dictionary minus that under the toxic
one, so windows that only the toxic dictionary knows score high.  Thresholds
on a document's largest distances are calibrated on labelled rows that did not
train the dictionaries, by a small logistic model.

* The toxic compressor's dictionary is the ordinary content followed by the
  toxic content: ordinary text costs the same under both, which leaves the
  difference to what is specific to toxic text.
* Ordinary windows that still look toxic are appended to the ordinary content
  and the toxic dictionary is trained anew (hard-negative rounds).
* Each window is compressed between two fixed pieces of text that both
  dictionaries hold: zstandard stores very short inputs raw and finds no match
  in an input's last bytes, which would hide short words.

Results for odd inputs: null and empty texts have no windows and get the score
of a text without toxic windows; a word longer than ``PIECE`` bytes is cut into
pieces, so long texts are scored whole; repeated rows each get their row.
Labels that are null take no part; without both classes among the training
rows every score is the share of toxic ones (0 without any).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexis.llm.common import col, give_back, id_and_text, map_texts, per_worker, text_chunks
from lexis.session import written

BEFORE = b" the of and to in that is was for with as on by at from are this be "
AFTER = b" when which there their "
PIECE = 48             # bytes of a window at most
TOP = 3                # largest distances of a text that enter its score
FIT_ORDINARY = 2500    # labelled rows of each class that fit the model, at most
FIT_TOXIC = 1500
FIT_BYTES = 12_000_000  # bytes of their whole texts for each class, at most
ROUNDS = 6             # training rounds; the first two look for candidates
CACHE = 150_000        # window distances kept per task


@dataclass
class ToxicityModel:
    ordinary: bytes = b""   # raw dictionary contents
    toxic: bytes = b""
    weights: tuple = ()     # logistic weights over (1, top distances)
    prior: float = 0.0      # the score if nothing could be fitted


def windows(text: str) -> list[bytes]:
    """Lower-cased words between single spaces, long ones in pieces."""
    out = []
    for w in text.lower().encode().split():
        if len(w) <= PIECE:
            out.append(b" " + w + b" ")
        else:
            out += [b" " + w[i:i + PIECE] + b" " for i in range(0, len(w), PIECE)]
    return out


def _cost(content: bytes):
    """Compressed length of a window under a dictionary."""
    import zstandard as z

    whole = content + AFTER + BEFORE
    dic = z.ZstdCompressionDict(whole, dict_type=z.DICT_TYPE_RAWCONTENT)
    par = z.ZstdCompressionParameters(
        window_log=20, hash_log=17, chain_log=18, search_log=4, min_match=4, target_length=32,
        strategy=z.STRATEGY_BTLAZY2, write_content_size=0, write_checksum=0, write_dict_id=0,
        format=z.FORMAT_ZSTD1_MAGICLESS)
    dic.precompute_compress(compression_params=par)
    press = z.ZstdCompressor(dict_data=dic, compression_params=par).compress
    return lambda w: len(press(BEFORE + w + AFTER))


def _memo(f, limit: int = 0):
    seen: dict[bytes, int] = {}

    def g(w):
        v = seen.get(w)
        if v is None:
            if limit and len(seen) >= limit:
                seen.clear()
            v = seen[w] = f(w)
        return v
    return g


def _train(samples: list[bytes], size: int) -> bytes:
    """Dictionary content trained by zstandard; too little text is its own."""
    import zstandard as z

    samples = [s for s in samples if len(s) >= 8]
    if sum(map(len, samples)) < 8 * size:
        return b"".join(dict.fromkeys(samples))[:size]
    try:
        return z.train_dictionary(size, samples, k=16, d=6).as_bytes()
    except z.ZstdError:
        return b"".join(samples)[:size]


def _top(distances: list[int]) -> list[float]:
    best = sorted(distances, reverse=True)[:TOP]
    return [float(max(-2, min(10, d))) for d in best + [0] * (TOP - len(best))]


def fit_rows(ordinary: list[str], toxic: list[str], calibrate: list[tuple[str, int]],
             ordinary_bytes: int = 65_536, toxic_bytes: int = 32_768, novelty: float = 0.3,
             alarm: int = 2) -> ToxicityModel:
    """Fit on texts held in memory (their number is bounded by the caller)."""
    import numpy as np

    known = len(toxic) + sum(y for _, y in calibrate)
    rows = len(ordinary) + len(toxic) + len(calibrate)
    prior = known / rows if rows else 0.0
    if not ordinary or not toxic:
        return ToxicityModel(prior=prior)
    ord_w = [windows(t) for t in ordinary]
    tox_w = [windows(t) for t in toxic]
    ord_set = [dict.fromkeys(w) for w in ord_w]
    tox_set = [dict.fromkeys(w) for w in tox_w]
    base = _train([b"".join(w[i:i + 8]) for w in ord_w for i in range(0, max(1, len(w) - 8), 8)], ordinary_bytes)
    false_alarms: dict[bytes, None] = {}
    found: dict[bytes, None] = {}
    top = b""
    for r in range(ROUNDS):
        plain = _memo(_cost(base))
        blank = plain(b"")
        if r < 2:   # candidates: windows of toxic rows that ordinary text does not explain
            pick = lambda w: w not in false_alarms and plain(w) - blank >= novelty * len(w)
        else:       # those that the last toxic dictionary knew and ordinary rows never raised
            pick = found.__contains__
        top = _train([b"".join(w for w in s if pick(w)) for s in tox_set], toxic_bytes)
        special = _memo(_cost(base + top))
        alarms = {w: None for s in ord_set for w in s if plain(w) - special(w) >= alarm}
        in_rows: dict[bytes, int] = {}
        for s in tox_set:
            for w in s:
                in_rows[w] = in_rows.get(w, 0) + 1
        found |= {w: None for w, n in in_rows.items() if n >= 2 and plain(w) - special(w) >= alarm}
        false_alarms |= alarms
        found = {w: None for w in found if w not in false_alarms}
        if r < ROUNDS - 1:
            base = base + b"".join(alarms)
    model = ToxicityModel(base, base + top, prior=prior)
    dist = _distance(model)
    x = np.array([[1.0, *_top([dist(w) for w in windows(t)])] for t, _ in calibrate] or np.zeros((0, TOP + 1)))
    y = np.array([float(v) for _, v in calibrate])
    if not len(y) or y.min() == y.max():
        x = np.array([[1.0, *_top([dist(w) for w in ws])] for ws in ord_w + tox_w])
        y = np.array([0.0] * len(ord_w) + [1.0] * len(tox_w))
    weights = np.zeros(TOP + 1)
    for _ in range(50):   # Newton steps of ridge logistic regression
        p = 1 / (1 + np.exp(-x @ weights))
        grad = x.T @ (p - y) + 0.1 * weights
        hess = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(TOP + 1)
        step = np.linalg.solve(hess, grad)
        weights -= step
        if np.abs(step).max() < 1e-8:
            break
    return ToxicityModel(model.ordinary, model.toxic, tuple(map(float, weights)), prior)


def _distance(model: ToxicityModel, limit: int = 0):
    plain, special = _cost(model.ordinary), _cost(model.toxic)
    return _memo(lambda w: plain(w) - special(w), limit)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", fit_ordinary: int = FIT_ORDINARY, fit_toxic: int = FIT_TOXIC) -> ToxicityModel:
    """Fit on at most ``fit_ordinary`` + ``fit_toxic`` labelled rows, taken in the
    order of a hash of the id.  Only labelled ids travel to find them; their
    texts are then fetched by one scan against that bounded id list.  Of these
    rows, whole texts go to the driver in the same order while they fit into
    FIT_BYTES per class; a row that does not fit any more is left out.

    An id whose crc32 leaves remainder 4 by 5 calibrates, 0 is held out by the
    caller, the rest train the dictionaries."""
    lab = (labels.select(col(id_col).alias("_id"), col(label_col).cast("int").alias("_y"))
           .where("_id is not null and _y in (0, 1)").groupBy("_id").agg(F.max("_y").alias("_y"))
           .withColumn("_h", F.xxhash64("_id")))
    some = [lab.where(F.col("_y") == y).orderBy("_h", "_id").limit(n) for y, n in ((0, fit_ordinary), (1, fit_toxic))]
    ids = some[0].union(some[1])   # fit_ordinary + fit_toxic rows at most: safe to broadcast
    rows = (id_and_text(docs, id_col, text_col).join(F.broadcast(ids), F.col("doc_id") == F.col("_id"))
            .dropDuplicates(["doc_id"])
            .select("_id", "_y", "text", F.octet_length("text").alias("_n"),
                    (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5).alias("_part"), "_h"))
    rows = written(rows, "labelled")
    left, chosen = {0: FIT_BYTES, 1: FIT_BYTES}, []
    for r in sorted(rows.select("_h", "_id", "_y", "_n").collect(), key=lambda r: (r["_h"], str(r["_id"]))):
        if r["_n"] <= left[r["_y"]]:
            left[r["_y"]] -= r["_n"]
            chosen.append((r["_id"],))
    kept = docs.sparkSession.createDataFrame(chosen, rows.select("_id").schema)
    rows = rows.join(F.broadcast(kept), "_id").collect()   # two times FIT_BYTES at most
    rows.sort(key=lambda r: (r["_h"], r["text"]))
    train = [r for r in rows if r["_part"] != 4]
    return fit_rows([r["text"] for r in train if not r["_y"]], [r["text"] for r in train if r["_y"]],
                    [(r["text"], r["_y"]) for r in rows if r["_part"] == 4])


def _judge(model: ToxicityModel):
    """``text -> (score, worst window)``."""
    import math

    if not model.weights:
        return lambda text: (model.prior, None)
    dist = per_worker(("toxicity", hash((model.ordinary, model.toxic))), lambda: _distance(model, CACHE))

    def one(text):
        ws = windows(text)
        ds = {w: dist(w) for w in ws}
        best = max(ds, key=lambda w: (ds[w], w), default=None)
        z = sum(a * b for a, b in zip(model.weights, [1.0, *_top([ds[w] for w in ws])], strict=True))
        worst = best.strip().decode(errors="replace") if best is not None and ds[best] > 0 else None
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, z)))), worst
    return one


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, toxicity`` (0 to 1) and ``worst``: the window of the largest distance
    (null without a window above 0)."""
    def setup():   # the model travels with the task: two dictionaries of some 100 kB
        judge = _judge(model)
        return lambda texts: [list(x) for x in zip(*map(judge, texts))]

    return map_texts(id_and_text(docs, id_col, text_col), [
        T.StructField("toxicity", T.DoubleType()), T.StructField("worst", T.StringType())], setup)


def scorer(model: ToxicityModel):
    """The score as a column function, for filters that keep whole rows."""
    @F.arrow_udf("double")
    def toxicity(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        judge = _judge(model)
        for column in batches:
            yield pa.array([judge(t)[0] for _, _, texts in text_chunks(column) for t in texts], pa.float64())
        give_back()
    return toxicity
