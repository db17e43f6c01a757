"""Cutting texts into the words a BPE tokenizer merges, with array operations.

Characters below U+0300 (that keep there when lower-cased) are cut by character
classes over whole batches; each distinct word of a batch is then looked at once.
Stretches between spaces that hold other characters take the tokenizer's own
normalizer and pre-tokenizer, so results never depend on these tables.
"""

from __future__ import annotations

import re

TOP = 0x300
SPACE, LETTER, NUMBER, OTHER = range(4)
EDGE = 255
PIECE = 500_000    # characters cut at once
SEED = 20_022


class Cutter:
    """Words of simple texts: lower-cased, without white space, numbers one by one."""

    def __init__(self, special: list[str]):
        import unicodedata

        import numpy as np

        to = [chr(i).lower() for i in range(TOP)]
        odd = [i for i in range(TOP) if len(to[i]) != 1 or ord(to[i]) >= TOP
               or unicodedata.normalize("NFC", to[i]) != to[i]]
        self.map = np.array([ord(x) if i not in odd else 0 for i, x in enumerate(to)], np.uint16)
        white = {9, 10, 11, 12, 13, 32, 0x85, 0xA0}
        self.kind = np.array([SPACE if i in white else {"L": LETTER, "N": NUMBER}.get(unicodedata.category(chr(i))[0], OTHER)
                              for i in range(TOP)], np.uint8)
        rare = "".join(re.escape(chr(i)) for i in odd)
        self.not_simple = re.compile(f"[^\\x00-{chr(TOP - 1)}]" + (f"|[{rare}]" if rare else "")
                                     + "".join("|" + re.escape(s) for s in special))
        self.value = np.random.default_rng(SEED).integers(0, 1 << 63, TOP, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.up = self.down = np.zeros(0, np.uint64)

    def stretches(self, text: str):
        """(part of the text, is it simple): parts border on a space, which no word holds."""
        done = 0
        while (m := self.not_simple.search(text, done)) is not None:
            a, b = text.rfind(" ", done, m.start()) + 1, text.find(" ", m.end())
            a, b = max(a, done), len(text) if b < 0 else b
            if a > done:
                yield text[done:a], True
            yield text[a:b], False
            done = b
        if done < len(text):
            yield text[done:], True

    @staticmethod
    def pieces(text: str):
        """Parts of a long text, cut before a single space between other characters."""
        a = 0
        while len(text) - a > PIECE:
            b = a + PIECE
            while (b := text.find(" ", b)) >= 0 and (text[b - 1].isspace() or text[b + 1:b + 2].isspace() or b + 1 == len(text)):
                b += 1
            if b < 0:
                break
            yield text[a:b]
            a = b
        yield text[a:] if a else text

    def cut(self, pieces: list[str]):
        """(the text as it is cut, starts, ends, first word of each piece)."""
        import numpy as np

        joined = "".join(pieces)
        code = self.map[np.frombuffer(joined.encode("utf-16-le"), np.uint16)]
        n = len(code)
        size = np.array([len(p) for p in pieces], np.int64)
        at = np.cumsum(size) - size
        if not n:
            z = np.zeros(0, np.int64)
            return "", z, z, np.zeros(len(pieces), np.int64), code
        kind = self.kind[code]
        begin = np.zeros(n + 4, bool)          # of a piece; what follows the end counts as another
        begin[at[size > 0]] = True
        begin[n:] = True
        edge = np.ones(n + 4, bool)
        edge[1:n] = kind[1:] != kind[:-1]
        edge[1:n] |= kind[1:] == NUMBER
        edge |= begin
        far = np.concatenate((code, np.zeros(4, np.uint16)))
        quote = np.flatnonzero((code == ord("'")) & edge[:n])
        if len(quote):
            c1, c2 = far[quote + 1], far[quote + 2]
            two = np.isin(c1, [ord(c) for c in "stmd"]) & ~begin[quote + 1]
            three = np.zeros(len(quote), bool)
            for x, y in ("re", "ve", "ll"):
                three |= (c1 == ord(x)) & (c2 == ord(y))
            three &= ~begin[quote + 1] & ~begin[quote + 2]
            edge[quote[two | three] + 1] = False
            edge[quote[two] + 2] = True
            edge[quote[three] + 3] = True
        edge[n] = True
        cuts = np.flatnonzero(edge[:n + 1])
        starts, ends = cuts[:-1], cuts[1:]
        word = kind[starts] != SPACE
        starts, ends = starts[word], ends[word]
        text = code.tobytes().decode("utf-16-le")
        return text, starts, ends, np.searchsorted(starts, at), code

    def distinct(self, code, starts, ends):
        """(first place of each distinct word, index of its word for every place)."""
        import numpy as np

        n = len(code)
        if n > len(self.up):
            factor = 0x9E3779B97F4A7C15
            self.up = np.cumprod(np.full(n, factor, np.uint64), dtype=np.uint64)
            self.down = np.cumprod(np.full(n, pow(factor, -1, 1 << 64), np.uint64), dtype=np.uint64)
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(self.value[code] * self.up[:n], dtype=np.uint64)))
        size = ends - starts
        h = ((total[ends] - total[starts]) * self.down[starts]) ^ size.astype(np.uint64)
        _, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        # exact: every word is compared with the one that stands for it
        base = starts[first][inverse]
        same = (size == size[first][inverse]).all()
        if same:
            step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            same = (code[np.repeat(starts, size) + step] == code[np.repeat(base, size) + step]).all()
        if not same:   # two words share a hash: tell words apart by themselves
            names = [code[a:b].tobytes() for a, b in zip(starts, ends)]
            seen: dict = {}
            inverse = np.array([seen.setdefault(w, len(seen)) for w in names])
            first = np.array([names.index(w) for w in seen])
        return first, inverse


class WordCache:
    """Encodings of words seen lately: two generations of dictionaries, of which the
    older is dropped when the younger is full; used words move to the younger."""

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def get_all(self, words: list, encode) -> list:
        """The value of each word; ``encode(missing words) -> values``."""
        if len(self.young) > self.size:
            self.young, self.old = {}, self.young
        young, old = self.young, self.old
        missing = []
        for w in words:
            if w not in young:
                if (v := old.get(w)) is not None:
                    young[w] = v
                else:
                    missing.append(w)
        if missing:
            young.update(zip(missing, encode(missing), strict=True))
        return list(map(young.__getitem__, words))


def encode_texts(texts: list[str], cutter: Cutter, words_to_ids, whole_to_ids) -> list:
    """Ids (uint32 array) of every text.  ``words_to_ids(list of distinct words) ->
    list of bytes`` (little-endian uint32), ``whole_to_ids(stretch) -> array``."""
    import numpy as np

    none = np.zeros(0, np.uint32)
    parts: list[list] = [[] for _ in texts]
    batch: list[tuple[list, int, str]] = []     # pieces, and where their ids belong
    held = 0

    def flush():
        nonlocal batch, held
        if not batch:
            return
        joined, starts, ends, first_word, code = cutter.cut([p for *_, p in batch])
        if len(starts):
            first, inverse = cutter.distinct(code, starts, ends)
            ids = words_to_ids([joined[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())])
            flat = np.frombuffer(b"".join(ids), np.uint32)
            n = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
            off = np.cumsum(n) - n
            size = n[inverse]
            upto = np.cumsum(size)
            out = flat[np.repeat(off[inverse] - (upto - size), size) + np.arange(upto[-1])]
            upto = np.concatenate(([0], upto))
            bound = upto[np.append(first_word, len(starts))]
            for k, (part, i, _) in enumerate(batch):
                part[i] = out[bound[k]:bound[k + 1]]
        batch, held = [], 0

    for part, text in zip(parts, texts):
        for stretch, simple in cutter.stretches(text):
            if not simple:
                part.append(whole_to_ids(stretch))
                continue
            for p in cutter.pieces(stretch):
                if held and held + len(p) > PIECE:
                    flush()
                batch.append((part, len(part), p))
                part.append(none)
                held += len(p)
    flush()
    return [np.concatenate(p) if len(p) > 1 else p[0] if p else none for p in parts]
