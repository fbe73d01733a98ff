"""Token counts by finite-state machines compiled from a byte-level BPE vocabulary file.

Two deterministic machines replace the tokenizer:

* The *splitter* cuts text into pre-tokens. Its few states form a finite monoid of state maps; each character stands for
  one map, fixed chunks of the batch are composed side by side, then a prefix scan over the chunks' maps gives every
  chunk's entry state, and with it the state before every character. Texts are separated by a reset character, so chunk
  borders may fall anywhere and a single huge text is scanned like many small ones.
* The *counter* reads a pre-token's bytes. After each prefix its state holds all that later bytes can ask for: the
  longest suffix that begins some vocabulary entry and, for each shorter such suffix, the last token before it. A
  transition is annotated with the change in the number of tokens. States are determinised on demand and kept in a hash
  table per worker process (they are started anew beyond MOST_STATES, which costs time and no result).

The last token of a prefix is the one entry that may follow the last token before it: two tokens may stand side by side
unless a merge across their border comes before the merges that made them.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agorascope.llm.textkit import slices, strings, utf8

# Character classes of the splitter.
LETTER, CONTRACTED, R, V, L, E, NUMBER, BLANK, SPACE, QUOTE, OTHER, RESET = range(12)
# States: what the character before was part of.
START, IN_LETTERS, IN_NUMBERS, IN_OTHERS, AFTER_BLANK, AFTER_SPACE, AFTER_QUOTE, QUOTE_R, QUOTE_V, QUOTE_L, CONTRACTION = range(11)
STATES, CLASSES, UNKNOWN = 11, 12, 255
CHUNK = 4096
MOST_STATES = 300_000
#: So few pre-tokens are walked one by one; more side by side.
FEW = 48


def _next(state: int, cls: int) -> int:
    if cls == RESET:
        return START
    if cls <= E:
        if state == AFTER_QUOTE:
            return {CONTRACTED: CONTRACTION, R: QUOTE_R, V: QUOTE_V, L: QUOTE_L}.get(cls, IN_LETTERS)
        return CONTRACTION if (state, cls) in ((QUOTE_R, E), (QUOTE_V, E), (QUOTE_L, L)) else IN_LETTERS
    if cls == NUMBER:
        return IN_NUMBERS
    if cls == BLANK:
        return AFTER_BLANK
    if cls == SPACE:
        return AFTER_SPACE
    if cls == QUOTE and state not in (IN_OTHERS, AFTER_BLANK, AFTER_QUOTE):
        return AFTER_QUOTE
    return IN_OTHERS


def _begins(state: int, cls: int, after: int) -> bool:
    """Whether a pre-token begins at a character of this class, in this state, before a character of class `after`."""
    if cls == RESET:
        return False
    if cls in (BLANK, SPACE):
        return state not in (AFTER_BLANK, AFTER_SPACE) or after not in (BLANK, SPACE, RESET)
    if cls <= E:
        if state == AFTER_QUOTE:
            return not (cls == CONTRACTED or (cls in (R, V) and after == E) or (cls == L and after == L))
        return state in (START, IN_NUMBERS, IN_OTHERS, AFTER_SPACE, CONTRACTION)
    if cls == NUMBER:
        return state not in (IN_NUMBERS, AFTER_BLANK)
    return state not in (IN_OTHERS, AFTER_BLANK, AFTER_QUOTE)


class Splitter:
    def __init__(self):
        from tokenizers.pre_tokenizers import ByteLevel

        # Classes of characters are asked of the library when they first occur: tables of Unicode differ by version.
        self.probe = ByteLevel(add_prefix_space=False, use_regex=True)
        self.cls = np.full(0x110000 + 1, UNKNOWN, np.uint8)
        for c, cls in (("stmd", CONTRACTED), ("r", R), ("v", V), ("l", L), ("e", E), (" ", BLANK), ("'", QUOTE)):
            self.cls[[ord(x) for x in c]] = cls
        self.cls[0x110000] = RESET
        gens = [tuple(_next(q, c) for q in range(STATES)) for c in range(CLASSES)]
        maps, index = [tuple(range(STATES))], {}
        index[maps[0]] = 0
        row = 0
        after: list[list[int]] = []
        while row < len(maps):
            out = []
            for g in gens:
                m = tuple(g[q] for q in maps[row])
                if m not in index:
                    index[m] = len(maps)
                    maps.append(m)
                out.append(index[m])
            after.append(out)
            row += 1
        self.maps = np.array(maps, np.uint8)  # element of the monoid, entry state -> exit state
        self.step = np.array(after, np.uint8 if len(maps) < 256 else np.uint16)  # element, class -> element
        self.begins = np.array([[[_begins(q, c, n) for n in range(CLASSES)] for c in range(CLASSES)] for q in range(STATES)])

    def states(self, cls: np.ndarray) -> np.ndarray:
        """The state before each character, from the start state on."""
        n = len(cls)
        rows = -(-n // CHUNK)
        grid = np.full(rows * CHUNK, RESET, np.uint8)
        grid[:n] = cls
        grid = np.ascontiguousarray(grid.reshape(rows, CHUNK).T)
        element = np.zeros(rows, self.step.dtype)
        before = np.empty((CHUNK, rows), self.step.dtype)
        for i in range(CHUNK):
            before[i] = element
            element = self.step[element, grid[i]]
        # Prefix scan over the chunks' maps, doubling the span each turn.
        total = self.maps[element]
        span = 1
        while span < rows:
            total[span:] = np.take_along_axis(total[span:], total[:-span].astype(np.int64), 1)
            span *= 2
        entry = np.append(np.uint8(START), total[:-1, START])
        return self.maps[before.T.reshape(-1)[:n], np.repeat(entry, CHUNK)[:n]]

    def classify(self, c: str) -> int:
        """The class that the library's own pattern gives a character: what it joins with is of its class."""
        for before, cls in (("a", LETTER), ("1", NUMBER), ("!", OTHER)):
            if len(self.probe.pre_tokenize_str(before + c)) == 1:
                return cls
        return SPACE

    def starts(self, codes: np.ndarray) -> np.ndarray:
        """Flags of the characters at which a pre-token begins; code 0x110000 resets."""
        cls = self.cls[codes]
        new = np.unique(codes[cls == UNKNOWN])
        if len(new):
            self.cls[new] = [self.classify(chr(c)) for c in new.tolist()]
            cls = self.cls[codes]
        after = np.append(cls[1:], np.uint8(RESET))
        return self.begins[self.states(cls), cls, after]


def _bytes_of_symbols() -> dict[str, int]:
    """The printable stand-ins of a byte-level vocabulary."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Counter:
    def __init__(self, vocab: dict[str, int], merges: list):
        symbols = _bytes_of_symbols()
        raw = {t: bytes(symbols[c] for c in s) for s, t in vocab.items() if all(c in symbols for c in s)}
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        self.rank, self.made = {}, {}
        for r, (a, b) in enumerate(pairs):
            a, b, c = vocab[a], vocab[b], vocab[a + b]
            self.rank[a, b] = (r, c)
            self.made.setdefault(c, (r, a, b))
        self.fits: dict[tuple[int, int], bool] = {}
        # Trie of the entries: children by byte, entry that ends here, and the lengths of the suffixes that begin an entry.
        self.child: list[dict[int, int]] = [{}]
        self.entry: list[int] = [-1]
        for t, s in raw.items():
            if t not in self.made and len(s) > 1:
                continue  # special strings are no products of merges
            node = 0
            for b in s:
                if b not in self.child[node]:
                    self.child[node][b] = len(self.child)
                    self.child.append({})
                    self.entry.append(-1)
                node = self.child[node][b]
            self.entry[node] = t
        self.reset()

    def reset(self) -> None:
        """Drops the determinised states."""
        self.known: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.walked: dict[int, tuple[int, int]] = {}
        # Arcs: state * 256 + byte -> state and change in tokens, in an open-addressed table.
        self.arcs = 0
        self.keys = np.full(1 << 12, -1, np.int64)
        self.goto = np.zeros(1 << 12, np.int32)
        self.delta = np.zeros(1 << 12, np.int8)
        # A state: nodes of the suffixes by length, longest first, each with the token before it and the tokens since.
        self.root = self._state(((0, -1, 0),))

    def _slots(self, key: np.ndarray) -> np.ndarray:
        """Where each key is, or the free place for it."""
        mask = len(self.keys) - 1
        slot = ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.int64) & mask
        held = self.keys[slot]
        off = np.flatnonzero((held != key) & (held >= 0))
        while len(off):
            slot[off] = (slot[off] + 1) & mask
            held = self.keys[slot[off]]
            off = off[(held != key[off]) & (held >= 0)]
        return slot

    def _put(self, keys: np.ndarray, goto: np.ndarray, delta: np.ndarray) -> None:
        """Adds arcs that are not there yet; the table is kept half empty."""
        if 2 * (self.arcs + len(keys)) >= len(self.keys):
            old = np.flatnonzero(self.keys >= 0)
            keys, goto, delta = (np.append(x[old], y) for x, y in ((self.keys, keys), (self.goto, goto), (self.delta, delta)))
            size = 1 << (4 * len(keys)).bit_length()
            self.keys, self.goto, self.delta, self.arcs = np.full(size, -1, np.int64), np.zeros(size, np.int32), np.zeros(size, np.int8), 0
        self.arcs += len(keys)
        todo = np.arange(len(keys))
        while len(todo):  # keys that meet at one free place take turns
            slot = self._slots(keys[todo])
            _, first = np.unique(slot, return_index=True)
            won = todo[first]
            self.keys[slot[first]], self.goto[slot[first]], self.delta[slot[first]] = keys[won], goto[won], delta[won]
            todo = np.delete(todo, first)

    def may_follow(self, a: int, b: int) -> bool:
        """Whether tokens a, b stand side by side in the encoding of their joined text."""
        key = (a, b)
        if key not in self.fits:
            self.fits[key] = self._seam(a, b)
        return self.fits[key]

    def _seam(self, a: int, b: int) -> bool:
        # Undo the merges of both sides, latest first. A merge across the border spoils the pair if it comes before the
        # merge that used up its part: strictly before on the left, where equal ranks fire earlier, or equally on the right.
        limit = (len(self.rank), 0)
        while True:
            hit = self.rank.get((a, b))
            if hit and (hit[0], 0) < limit:
                return False
            left, right = self.made.get(a), self.made.get(b)
            if left is None and right is None:
                return True
            if right is None or (left is not None and left[0] > right[0]):
                limit, a = (left[0], 0), left[2]
            else:
                limit, b = (right[0], 1), right[1]

    def _state(self, chain: tuple) -> int:
        if chain not in self.known:
            self.known[chain] = len(self.states)
            self.states.append(chain)
        return self.known[chain]

    def _arc(self, state: int, byte: int) -> tuple[int, int]:
        best, carried = None, []
        for node, token, since in self.states[state]:
            child = self.child[node].get(byte)
            if child is None:
                continue
            carried.append((child, token, since))
            entry = self.entry[child]
            if best is None and entry >= 0 and (token < 0 or self.may_follow(token, entry)):
                best = (entry, since)
        entry, since = best
        delta = 1 - since
        chain = (*((c, t, s + delta) for c, t, s in carried if self.child[c]), (0, entry, 0))
        return self._state(chain), delta

    def _walk(self, data: bytes, chain: tuple) -> int:
        """Tokens that a long pre-token's rest adds, from a state on; states are started anew beyond MOST_STATES here too."""
        state, total, arcs = self._state(chain), 0, self.walked
        for byte in data:
            key = state << 8 | byte
            arc = arcs.get(key)
            if arc is None:
                if len(self.states) > MOST_STATES or len(arcs) > 4 * MOST_STATES:
                    chain = self.states[state]
                    self.reset()
                    state, arcs = self._state(chain), self.walked
                    key = state << 8 | byte
                arc = arcs[key] = self._arc(state, byte)
            state, delta = arc
            total += delta
        return total

    def counts(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Tokens of each pre-token data[start:end]."""
        if len(self.states) > MOST_STATES:
            self.reset()
        lengths = ends - starts
        order = np.argsort(-lengths, kind="stable")
        at, lengths = starts[order], lengths[order]
        state = np.full(len(at), self.root, np.int64)
        tokens = np.zeros(len(at), np.int64)
        active = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1 if len(lengths) else 1), "right")
        for k, m in enumerate(active):
            if m <= FEW:
                chains = [self.states[s] for s in state[:m].tolist()]
                for j, chain in enumerate(chains):
                    tokens[j] += self._walk(data[at[j] + k : at[j] + lengths[j]].tobytes(), chain)
                break
            key = state[:m] * 256 + data[at[:m] + k]
            slot = self._slots(key)
            new = self.keys[slot] != key
            if new.any():
                fresh = np.unique(key[new])
                made = [self._arc(x >> 8, x & 255) for x in fresh.tolist()]
                self._put(fresh, np.array([m[0] for m in made]), np.array([m[1] for m in made]))
                slot = self._slots(key)
            tokens[:m] += self.delta[slot]
            state[:m] = self.goto[slot]
        out = np.empty_like(tokens)
        out[order] = tokens
        return out


class Machine:
    """Both machines for one vocabulary file, with its special strings."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec["model"]["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["normalizer"]:
            raise ValueError(f"not a plain byte-level BPE: {path}")
        if spec["pre_tokenizer"].get("add_prefix_space"):
            raise ValueError("add_prefix_space is not supported")
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.splitter, self.counter = Splitter(), Counter(spec["model"]["vocab"], spec["model"]["merges"])

    def count(self, column: pa.Array) -> np.ndarray:
        """Tokens of each text of a large-string column without nulls."""
        out = np.zeros(len(column), np.int64)
        for a, z in slices(column, 2 << 20):
            out[a:z] = self._count(column.slice(a, z - a))
        return out

    def _count(self, part: pa.Array) -> np.ndarray:
        specials = np.zeros(len(part), np.int64)
        owner = np.arange(len(part))
        texts = part.to_pylist()
        if any(s in t for s in self.special for t in texts):
            import re

            cut = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))))
            pieces = [cut.split(t) for t in texts]
            specials = np.array([len(p) - 1 for p in pieces])
            owner = np.repeat(owner, [len(p) for p in pieces])
            texts = [x for p in pieces for x in p]
            part = pa.array(texts, pa.large_string())
        data, at = utf8(part)
        head = (data & 0xC0) != 0x80  # first byte of a character
        place = np.flatnonzero(head)
        codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        firsts = np.searchsorted(place, at[:-1])  # characters before each text
        mixed = np.insert(codes, firsts, 0x110000)
        real = np.ones(len(mixed), bool)
        real[firsts + np.arange(len(firsts))] = False
        begin = place[self.splitter.starts(mixed)[real]]
        if not len(begin):
            return specials
        tokens = self.counter.counts(data, begin, np.append(begin[1:], len(data)))
        text = np.searchsorted(at, begin, "right") - 1
        return specials + np.bincount(owner[text], weights=tokens, minlength=len(specials)).astype(np.int64)


_machines: dict[str, Machine] = {}


def machine(path: str) -> Machine:
    if path not in _machines:
        _machines[path] = Machine(path)
    return _machines[path]


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for each row; null text counts as empty, ids pass as they are, null or not.

    Every column is a function of one row: repeated rows get equal rows, ties do not arise, other columns are not used, an
    empty table gives no rows. No shuffle; memory is bounded by a 2 MB slice of text (or one text) and the tables of the machines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = machine(path)
        for batch in batches:
            text = strings(batch.column("text"))
            tokens = own.count(text)
            sizes = np.diff(utf8(text)[1])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes), pa.array(tokens), pa.array(tokens > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
