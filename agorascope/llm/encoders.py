"""Token ids of public vocabulary files, as the tokenizers library gives them, by faster equal ways where those are proven.

Text of characters whose classes all libraries agree on goes the fast way; any other text, and text that holds a special
string or a very long run of white space, goes through the tokenizers library itself. Tests compare both over all such characters.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from itertools import chain

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: The pre-token pattern that byte-level BPE files of this kind fix.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Long runs of white space overflow the stack of the fast way's pattern matcher.
_LONG_BLANK = 10_000
_BLANKS = re.compile(r"\s{2,}+")
#: Tab, line ends, printable Latin (without the dotted capital I, whose lower case is two characters) and dashes, quotes.
_UNSURE = re.compile("[^\t\n\r\x20-\x7e\xa1-\xac\xae-įı-ɏ‐-‧]")


def _sure(text: str, special: list[str]) -> bool:
    """Whether the fast way gives this text's ids."""
    return not (_UNSURE.search(text) or any(s in text for s in special) or (len(text) >= _LONG_BLANK and any(m.end() - m.start() >= _LONG_BLANK for m in _BLANKS.finditer(text))))


class ByteBpe:
    """Ids of a byte-level BPE file, by tiktoken over the same vocabulary."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        from agorascope.llm.fst_count import _bytes_of_symbols

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec["added_tokens"]]
        symbols = _bytes_of_symbols()
        ranks = {bytes(symbols[c] for c in s): i for s, i in spec["model"]["vocab"].items() if s not in self.special}
        self.fast = tiktoken.Encoding("byte", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})
        self.slow = Tokenizer.from_file(path)

    def ids(self, text: str) -> np.ndarray:
        if not _sure(text, self.special):
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(self.fast.encode_ordinary(text), np.uint32)

    def many(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        return [self.ids(t) for t in texts]


class WordBpe:
    """Ids of a lower-casing BPE file that drops white space, by a bounded cache from the pieces between white space.

    No pre-token spans white space, so a text's ids are its pieces' ids. New pieces are cut by the file's pattern and
    merged by tiktoken, in which a blank after a pre-token stands for the word end, so a last character and its blank
    merge before anything else, as the file's word-end symbols do; ids rise in the order of merges, so they are the ranks.
    A full cache takes no more pieces: by then it holds the frequent ones."""

    def __init__(self, path: str, most: int = 700_000):
        import regex
        import tiktoken
        from tokenizers import Tokenizer

        from agorascope.llm.fst_count import _bytes_of_symbols

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.slow, self.most, self.cache = Tokenizer.from_file(path), most, {}
        self.special = [t["content"] for t in spec["added_tokens"]]
        end, vocab, symbols = spec["model"]["end_of_word_suffix"], spec["model"]["vocab"], _bytes_of_symbols()
        raw = lambda t: bytes(symbols[c] for c in t.removesuffix(end)) + b" " * t.endswith(end)
        ranks = {raw(t): i for t, i in vocab.items() if t not in self.special}
        made = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in spec["model"]["merges"]]
        if made != sorted(made) or made[0] < 512 or len(ranks) != len(set(vocab) - set(self.special)):
            raise ValueError(f"ids of {path} do not rise with its merges")
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = regex.compile(split["pattern"]["Regex"])
        self.fast = tiktoken.Encoding("words", pat_str=r"[^ \n]+ |\n", mergeable_ranks=ranks, special_tokens={})
        self.line = ranks[b"\n"]

    def pieces(self, new: list[str]) -> list[bytes]:
        """Ids of pieces without white space, as unsigned 32-bit integers."""
        text = "\n".join("".join([f"{w} " for w in self.pattern.findall(p)]) for p in new)
        ids = np.array(self.fast.encode_ordinary(text), np.uint32)
        cuts = np.flatnonzero(ids == self.line)
        body = ids.tobytes()
        return [body[4 * a : 4 * z] for a, z in zip([0, *(cuts + 1).tolist()], [*cuts.tolist(), len(ids)], strict=True)]

    def many(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        sure = [_sure(t, self.special) for t in texts]
        parts = [t.lower().split() if ok else [] for t, ok in zip(texts, sure, strict=True)]
        flat = list(chain.from_iterable(parts))
        ids = list(map(self.cache.get, flat))
        gaps = [i for i, x in enumerate(ids) if x is None]
        if gaps:
            new = list({flat[i] for i in gaps})
            got = dict(zip(new, self.pieces(new), strict=True))
            for i in gaps:
                ids[i] = got[flat[i]]
            if len(self.cache) + len(got) <= self.most:
                self.cache.update(got)
        out, at = [], 0
        for own, ok, text in zip(parts, sure, texts, strict=True):
            out.append(np.frombuffer(b"".join(ids[at : at + len(own)]), np.uint32) if ok else np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32))
            at += len(own)
        return out


_made: dict[tuple, object] = {}


def encoder(kind: type, path: str):
    """One encoder per worker process."""
    if (kind, path) not in _made:
        _made[kind, path] = kind(path)
    return _made[kind, path]
