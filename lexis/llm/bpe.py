"""BPE encoding and decoding by speculation and verification.

Words are proposed greedily: the longest token that matches, again and again.
That is the right encoding if every token is one that merging can produce and
every adjacent pair is compatible, that is, no merge across its border comes
before the merges on either side take the border's symbols away.  The checks
run over all distinct adjacent pairs of a batch at once; only words that fail
one are merged exactly.

The tokenizer file (Hugging Face JSON: BPE with an end-of-word suffix) is a
parameter and is read where the tasks run or, if it is only on the driver, is
sent along.  Texts are cut as its normalizer and pre-tokenizer do; strings of
its special tokens inside a text become these tokens, as the tokenizers
library does by default.

Results for odd inputs: null and empty texts have no tokens and decode to an
empty string; long texts are cut at spaces and encoded whole; repeated rows
each get their row; columns beside id and text are ignored.
"""

from __future__ import annotations

import heapq
import re

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lexis.llm.common import id_and_text, map_texts, per_worker
from lexis.llm.pretokens import Cutter, WordCache, encode_texts

NEVER = 1 << 40
SHORT = 48          # symbols up to which a list is faster than a heap
CACHE = 100_000    # words of a generation whose encoding is kept, and four times as many pairs


class Bpe:
    def __init__(self, spec: str):
        import json

        import numpy as np

        self.text, self.cuts = spec, None
        spec = json.loads(spec)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.suffix = end = spec["model"].get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: w for w, i in vocab.items()} | {i: w for w, i in self.special.items()}
        n = max(self.names) + 1
        self.form = np.full(n, -1, np.int64)       # rank of the merge that forms a token
        self.left, self.right = np.zeros(n, np.int64), np.zeros(n, np.int64)
        twice = np.zeros(n, bool)
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(merges):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            x, y, z = vocab[a], vocab[b], vocab[a + b]
            self.merges[x, y] = rank, z
            twice[z] |= self.form[z] >= 0
            self.form[z], self.left[z], self.right[z] = rank, x, y
        keys = np.array([x * n + y for x, y in self.merges], np.int64)
        order = np.argsort(keys)
        self.n, self.keys = n, np.append(keys[order], np.iinfo(np.int64).max)
        self.ranks = np.append(np.array([r for r, _ in self.merges.values()], np.int64)[order], NEVER)
        # tokens that merging makes of their own string
        made = np.flatnonzero(self.form >= 0)
        self.valid = ~twice
        self.valid[made] &= ~self._crossed(self.left[made], self.right[made], self.form[made], self.form[made])
        for z in made[np.argsort(self.form[made])]:
            self.valid[z] &= self.valid[self.left[z]] and self.valid[self.right[z]]
        byte = {c: b for b, c in enumerate(byte_letters())}
        as_bytes = lambda w: bytes(map(byte.__getitem__, w))
        self.inner, self.last = {}, {}
        for w, i in vocab.items():
            if end and w.endswith(end):
                self.last[as_bytes(w[:-len(end)])] = i
            else:
                self.inner[as_bytes(w)] = i
        if not end:
            self.last = self.inner
        self.longest = max(map(len, [*self.inner, *self.last]))
        self.byte = byte
        self.pair_ok: dict[int, bool] = {}
        self.words, self.stretches = WordCache(CACHE), WordCache(CACHE // 4)
        self.cutter = Cutter(special=list(self.special))
        self.cut_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")

    def _crossed(self, a, b, until_a=None, until_b=None):
        """For each pair of tokens: does a merge across their border come first?

        Walks both sides down from the last merge to the first, always undoing
        the later one, and looks up the pair that faces each other.  A merge
        fires if its rank is below that of the merge which took the left symbol
        away, and not above the one for the right symbol (equal ranks merge
        from the left)."""
        import numpy as np

        x, y = a.copy(), b.copy()
        cx = np.full(len(x), NEVER) if until_a is None else until_a.copy()
        cy = np.full(len(x), NEVER) if until_b is None else until_b.copy()
        out = np.zeros(len(x), bool)
        live = np.arange(len(x))
        while len(live):
            key = x * self.n + y
            at = np.searchsorted(self.keys, key)
            rank = np.where(self.keys[at] == key, self.ranks[at], NEVER)
            bad = (rank < cx) & (rank <= cy)
            out[live[bad]] = True
            fx, fy = self.form[x], self.form[y]
            go = ~bad & ((fx >= 0) | (fy >= 0))
            live, x, y, cx, cy, fx, fy = (v[go] for v in (live, x, y, cx, cy, fx, fy))
            undo = fx > fy
            cx, x = np.where(undo, fx, cx), np.where(undo, self.right[x], x)
            cy, y = np.where(undo, cy, fy), np.where(undo, y, self.left[y])
        return out

    def propose(self, w: bytes) -> list[int]:
        """Greedy longest match."""
        out, i, n, inner, last = [], 0, len(w), self.inner, self.last
        while i < n:
            if n - i <= self.longest and (t := last.get(w[i:])) is not None:
                out.append(t)
                break
            for j in range(min(n - 1, i + self.longest) if last is not inner else min(n, i + self.longest), i, -1):
                if (t := inner.get(w[i:j])) is not None:
                    break
            out.append(t)
            i = j
        return out

    def merge(self, w: bytes) -> list[int]:
        """Exact merging: lowest rank first, from the left among equals."""
        ids = [self.inner[w[i:i + 1]] for i in range(len(w) - 1)] + [self.last[w[-1:]]]
        n = len(ids)
        if n <= SHORT:
            return self._merge_short(ids)
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def offer(i):
            j = nxt[i]
            if j < n and (m := self.merges.get((ids[i], ids[j]))):
                heapq.heappush(heap, (m[0], i, ids[i], ids[j], m[1]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, a, b, z = heapq.heappop(heap)
            j = nxt[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = z, -1
            nxt[i] = nxt[j]
            if nxt[j] < n:
                prv[nxt[j]] = i
            offer(i)
            if prv[i] >= 0:
                offer(prv[i])
        return [t for t in ids if t >= 0]

    def _merge_short(self, ids: list[int]) -> list[int]:
        none = (NEVER, -1)
        found = [self.merges.get(p, none) for p in zip(ids, ids[1:])]
        while found and (best := min(found))[0] != NEVER:
            i = found.index(best)
            ids[i:i + 2] = [best[1]]
            del found[i]
            if i:
                found[i - 1] = self.merges.get((ids[i - 1], ids[i]), none)
            if i < len(found):
                found[i] = self.merges.get((ids[i], ids[i + 1]), none)
        return ids

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        """Ids of distinct words: proposals, checked pair by pair, mended where wrong."""
        import numpy as np

        out = [self.propose(w) for w in words]
        size = np.fromiter(map(len, out), np.int64, len(out))
        flat = np.array([t for o in out for t in o], np.int64)
        word = np.repeat(np.arange(len(out)), size)
        wrong = np.zeros(len(out), bool)
        wrong[word[~self.valid[flat]]] = True
        inside = word[1:] == word[:-1]
        pairs = (flat[:-1] * self.n + flat[1:])[inside]
        distinct, inverse = np.unique(pairs, return_inverse=True)
        known = [self.pair_ok.get(p) for p in distinct.tolist()]
        new = np.flatnonzero([k is None for k in known])
        ok = np.array([bool(k) for k in known], bool)
        if len(new):
            ok[new] = ~self._crossed(distinct[new] // self.n, distinct[new] % self.n)
            if len(self.pair_ok) > 4 * CACHE:
                self.pair_ok.clear()
            self.pair_ok.update(zip(distinct[new].tolist(), ok[new].tolist()))
        wrong[word[1:][inside][~ok[inverse]]] = True
        for i in np.flatnonzero(wrong):
            out[i] = self.merge(words[i])
        return out

    def words_to_ids(self, words: list[str]) -> list[bytes]:
        from array import array

        return self.words.get_all(words, lambda missing: [
            array("I", ids).tobytes() for ids in self.encode_words([w.encode() for w in missing])])

    def whole_to_ids(self, text: str):
        """A stretch with any characters; short ones are kept."""
        if len(text) > 40:
            return self._whole(text)
        return self.stretches.get_all([text], lambda missing: [self._whole(t) for t in missing])[0]

    def _whole(self, text: str):
        """Any text, cut by the tokenizer's own normalizer and pre-tokenizer."""
        import numpy as np
        from tokenizers import Tokenizer

        if self.cuts is None:   # loaded for the first such text
            library = Tokenizer.from_str(self.text)
            self.cuts = library.normalizer, library.pre_tokenizer

        out = []
        for part in self.cut_special.split(text):
            if part in self.special:
                out.append(np.array([self.special[part]], np.uint32))
            elif part:
                cut = self.cuts[1].pre_tokenize_str(self.cuts[0].normalize_str(part))
                words = [bytes(map(self.byte.__getitem__, w)) for w, _ in cut if w]
                distinct = list(dict.fromkeys(words))
                ids = dict(zip(distinct, self.encode_words(distinct))) if distinct else {}
                out.append(np.array([t for w in words for t in ids[w]], np.uint32))
        return np.concatenate(out) if out else np.zeros(0, np.uint32)

    def encode(self, texts: list[str]) -> list:
        return encode_texts(texts, self.cutter, self.words_to_ids, self.whole_to_ids)

    def decode(self, ids) -> str:
        """Token strings between spaces: what a tokenizer without a decoder gives."""
        return " ".join(map(self.names.__getitem__, ids.tolist()))


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies:
    printable Latin-1 characters for themselves, the others from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


def _load(spec: str) -> Bpe:
    return per_worker(("bpe", hash(spec)), lambda: Bpe(spec))


def round_trip(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids`` (binary, little-endian unsigned 32-bit) and ``decoded``
    of every text, with the tokenizer file of that path on the driver."""
    spec = open(tokenizer, encoding="utf-8").read()   # 2 MB; travels with the task

    def setup():
        import pyarrow as pa

        bpe = _load(spec)

        def f(texts):
            ids = bpe.encode(texts)
            return [[len(x) for x in ids], pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary()),
                    [bpe.decode(x) for x in ids]]
        return f

    return map_texts(id_and_text(docs, id_col, text_col), [
        T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()),
        T.StructField("decoded", T.StringType())], setup)


def decode(rows: DataFrame, tokenizer: str, ids_col: str = "ids") -> DataFrame:
    """``rows`` with its binary ids column decoded into column ``text``."""
    spec = open(tokenizer, encoding="utf-8").read()
    keep = [f for f in rows.schema.fields if f.name != "text"]
    schema = T.StructType([*keep, T.StructField("text", T.StringType())])

    def run(batches):
        import numpy as np
        import pyarrow as pa

        bpe = _load(spec)
        for b in batches:
            ids = b.column(b.schema.get_field_index(ids_col)).to_pylist()
            text = [None if x is None else bpe.decode(np.frombuffer(x, "<u4")) for x in ids]
            yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index(f.name)) for f in keep]
                                             + [pa.array(text, pa.string())], names=schema.names)

    return rows.select(*[f.name for f in keep]).mapInArrow(run, schema)
