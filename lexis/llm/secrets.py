"""Secret scans: a keyword automaton finds where to look, anchored regular
expressions match there, and embedded checksums decide about tokens that have one.

One Aho-Corasick pass over a text (lower-cased in A-Z) reports keywords and all
places where four hexadecimal digits begin; a pattern is tried at such a place
only, unless the last match of its kind reaches beyond it.  As every match of
a kind begins with one of its keywords, that equals a leftmost search of the
whole text, in time linear in it.

Kinds: ``assign`` (key and value), ``access`` (access key id), ``hex`` (long hexadecimal
strings), and ``checksum`` (prefixed tokens whose last six characters are the
base-62 CRC-32 of the thirty before).  Positions are code points, ends are
exclusive.  Null and empty texts have no spans; repeated rows each get theirs;
columns beside id and text are ignored.
"""

from __future__ import annotations

import re
import zlib

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lexis.llm.common import SPAN, id_and_text, map_texts, per_worker

KINDS = ("assign", "access", "hex", "checksum")
# fixed values: what introduces a secret, and prefixes of tokens with a checksum
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = "akia"
PREFIXES = ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_")
HEX = "0123456789abcdef"
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

ASSIGN_AT = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
                       re.IGNORECASE | re.ASCII)
ACCESS_AT = re.compile(r"AKIA[A-Z0-9]+")
HEX_AT = re.compile(r"[0-9a-f]{24,}")
CHECKED_AT = re.compile(r"(?:gh[pousr]|npm)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")


def automaton():
    import ahocorasick

    a = ahocorasick.Automaton()
    for kind, words in (("assign", WORDS), ("access", (ACCESS,)), ("checksum", PREFIXES)):
        for w in words:
            a.add_word(w, (kind, len(w)))
    for n in range(16 ** 4):   # any four hexadecimal digits
        a.add_word(f"{n:04x}", ("hex", 4))
    a.make_automaton()
    return a


def checksum_ok(body: str, check: str) -> bool:
    n, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        n, r = divmod(n, 62)
        out = BASE62[r] + out
    return out == check


def scan(text: str, find) -> list[tuple[int, int, str]]:
    """(start, end, kind) by start, then by kind as listed."""
    out = []
    done = dict.fromkeys(KINDS, 0)
    low = text if text.islower() else text.encode().lower().decode()   # bytes: A-Z only, lengths stay
    for last, (kind, size) in find(low):
        at = last - size + 1
        if kind == "hex":
            if at < done["hex"] or at and text[at - 1] in HEX:
                continue
            if m := HEX_AT.match(text, at):
                out.append((at, m.end(), kind))
                done["hex"] = m.end()
        elif at >= done[kind]:
            if kind == "assign":
                if m := ASSIGN_AT.match(text, at):
                    done[kind] = m.end()
                    if m.end(2) - m.start(2) >= 6:
                        out.append((at, m.end(), kind))
            elif kind == "access":
                if m := ACCESS_AT.match(text, at):
                    done[kind] = m.end()
                    if m.end() - at >= 20:
                        out.append((at, m.end(), kind))
            elif m := CHECKED_AT.match(text, at):
                if not (at and text[at - 1].isalnum() and text[at - 1].isascii()) and checksum_ok(m[1], m[2]):
                    out.append((at, m.end(), kind))
                    done[kind] = m.end()
    out.sort(key=lambda s: (s[0], KINDS.index(s[2])))
    return out


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, spans`` (array of start, end, kind) of every text."""
    def setup():
        find = per_worker("secrets", automaton).iter
        return lambda texts: [[[{"start": a, "end": b, "kind": k} for a, b, k in scan(t, find)] for t in texts]]

    return map_texts(id_and_text(docs, id_col, text_col), [T.StructField("spans", T.ArrayType(SPAN))], setup)
