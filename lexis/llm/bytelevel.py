"""Byte-level BPE files (Hugging Face JSON) without a normalizer.

Where merges stand in the order of their tokens' ids, the pre-tokenizer is the usual
one and the special tokens are plain strings, tiktoken gives the same ids as the
tokenizers library in a fraction of the time, whatever the script of the text; every
other file is left to the tokenizers library.
"""

from __future__ import annotations

from lexis.llm.bpe import byte_letters

# the pre-tokenizer's pattern (fixed)
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class ByteLevel:
    """``special``: strings of special tokens in a text become these tokens, as the
    tokenizers library does by default; else they are plain text."""

    def __init__(self, spec: str, special: bool = True):
        import json
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"   # Spark's tasks are the parallelism
        d = json.loads(spec)
        byte = {c: b for b, c in enumerate(byte_letters())}
        added = {t["content"]: t["id"] for t in d["added_tokens"]}
        vocab = {w: i for w, i in d["model"]["vocab"].items() if w not in added}
        names = {i: bytes(map(byte.__getitem__, w)) for w, i in vocab.items()}
        self.bytes = [names.get(i, b"") for i in range(max([*vocab.values(), *added.values()]) + 1)]
        made = [vocab[x + y] for x, y in (m.split(" ") if isinstance(m, str) else m for m in d["model"]["merges"])]
        pre = d["pre_tokenizer"]
        usual = (made == sorted(set(made)) and len(made) + 256 == len(names) and d["normalizer"] is None
                 and pre["type"] == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"]
                 and not any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in d["added_tokens"]))
        if usual:
            import tiktoken

            coder = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks={w: i for i, w in names.items()},
                                      special_tokens=added if special else {})
            self.ids = (lambda text: coder.encode(text, allowed_special="all")) if special else coder.encode_ordinary
            self.array = lambda text: coder.encode_to_numpy(text, allowed_special="all", disallowed_special=())
        else:
            import numpy as np
            from tokenizers import Tokenizer

            library = Tokenizer.from_str(spec)
            library.encode_special_tokens = not special
            self.ids = lambda text: library.encode(text, add_special_tokens=False).ids
            self.array = lambda text: np.array(self.ids(text), np.uint32)
