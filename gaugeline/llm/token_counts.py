"""Token counts by finite-state tokenizer compilation.

Two deterministic transducers stand for a byte-level BPE tokenizer:

* the *splitter* reads character classes and annotates each transition with
  the piece starts that it emits (for this or the previous character). A block
  of texts is cut into equal chunks; for every chunk the map from each start
  state to its end state is computed, the maps are composed by a parallel
  prefix scan, and a second pass from the known start states emits the piece
  starts;
* the *piece* transducer reads the bytes of a piece. Its transitions carry the
  change of the number of emitted tokens, which may be negative where a byte
  lets tokens merge. It is compiled lazily: a state is the longest suffix that
  may still grow into a vocabulary entry, with the last token and relative
  count of each of its prefixes.

Memory is bounded: the piece memo and the compiled states are dropped and
rebuilt when they reach a fixed number of entries, also within a piece, which goes on from its current
state; long pieces aren't kept. Long texts are counted in blocks cut before a blank. None of this changes results.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import named, slices, text_blocks

CHUNK = 64
BLOCK_CHARS = 1 << 21
MEMO_PIECES = 250_000
MEMO_CHARS = 64
MAX_STATES = 150_000
#: Characters of Unicode's White_Space property (fixed values).
WHITE = [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

# Character classes.
LETTER, NUMBER, SPACE, BLANK, QUOTE, OTHER, C_STMD, C_RV, C_E, C_L, END = range(11)
# States of the splitter.
FRESH, IN_L, IN_N, IN_O, AFTER_Q, Q_RV, Q_L, ONE_SP, ONE_BL, RUN_SP, RUN_BL = range(11)
N_CLASS, N_STATE = 11, 11
HERE, BEFORE = 1, 2

_class_table: np.ndarray | None = None


def class_table() -> np.ndarray:
    """Class of every code point, built once per process."""
    global _class_table
    if _class_table is None:
        table = np.full(0x110000, OTHER, np.uint8)
        for c in range(0x110000):
            kind = unicodedata.category(chr(c))[0]
            if kind == "L":
                table[c] = LETTER
            elif kind == "N":
                table[c] = NUMBER
        table[WHITE] = BLANK
        table[0x20] = SPACE
        table[ord("'")] = QUOTE
        for text, kind in (("stmd", C_STMD), ("rv", C_RV), ("e", C_E), ("l", C_L)):
            for ch in text:
                table[ord(ch)] = kind
        _class_table = table
    return _class_table


def compile_splitter() -> tuple[np.ndarray, np.ndarray]:
    """Next state and emission for (class, state); the emission's bits mark starts here and one before."""
    go = np.zeros((N_CLASS, N_STATE), np.uint8)
    out = np.zeros((N_CLASS, N_STATE), np.uint8)
    letters = (LETTER, C_STMD, C_RV, C_E, C_L)
    enter = {NUMBER: IN_N, SPACE: ONE_SP, BLANK: ONE_BL, QUOTE: AFTER_Q, OTHER: IN_O, END: FRESH} | dict.fromkeys(letters, IN_L)
    run = {**dict.fromkeys(letters, IN_L), NUMBER: IN_N, QUOTE: IN_O, OTHER: IN_O}
    for c in range(N_CLASS):
        for s in range(N_STATE):
            mark, to = HERE, enter[c]
            if s == IN_L and c in letters or s == IN_N and c == NUMBER or s == IN_O and c in (QUOTE, OTHER):
                mark, to = 0, s
            elif s == AFTER_Q and c in (QUOTE, OTHER):
                mark, to = 0, IN_O
            elif s == AFTER_Q and c in (C_STMD, C_RV, C_L):
                mark, to = 0, {C_STMD: FRESH, C_RV: Q_RV, C_L: Q_L}[c]
            elif s == Q_RV and c == C_E or s == Q_L and c == C_L:
                mark, to = 0, FRESH
            elif s in (Q_RV, Q_L):  # no contraction: the letter before starts a piece
                mark, to = (BEFORE, IN_L) if c in letters else (BEFORE | HERE, enter[c])
            elif s in (ONE_SP, ONE_BL, RUN_SP, RUN_BL):
                split = BEFORE if s in (RUN_SP, RUN_BL) else 0
                if c in (SPACE, BLANK):
                    mark, to = 0, RUN_SP if c == SPACE else RUN_BL
                elif c == END:
                    mark, to = HERE, FRESH
                elif s in (ONE_SP, RUN_SP):  # the last space joins what follows
                    mark, to = split, run[c]
                else:
                    mark = split | HERE
            go[c, s], out[c, s] = to, mark
    return go, out


GO, OUT = compile_splitter()
_GO_FLAT = GO.reshape(-1).astype(np.intp)
_OUT_FLAT = OUT.reshape(-1)


def compose_scan(maps: np.ndarray) -> np.ndarray:
    """Inclusive prefix composition of state maps (chunks x states) in log2(chunks) vectorised steps."""
    n, step = len(maps), 1
    maps = maps.copy()
    while step < n:
        maps[step:] = np.take_along_axis(maps[step:], maps[:-step].copy(), axis=1)
        step *= 2
    return maps


def piece_starts(codes: np.ndarray) -> np.ndarray:
    """Positions where pieces (or END sentinels) start in a block of classes that ends with END."""
    n = len(codes)
    rows = -(-n // CHUNK)
    grid = np.full(rows * CHUNK, END, np.uint8)
    grid[:n] = codes
    by_step = np.ascontiguousarray(grid.reshape(rows, CHUNK).T).astype(np.intp) * N_STATE
    maps = np.tile(np.arange(N_STATE, dtype=np.intp), (rows, 1))
    for step in by_step:
        maps = _GO_FLAT[step[:, None] + maps]
    ends = compose_scan(maps)[:, FRESH]
    state = np.concatenate(([FRESH], ends[:-1])).astype(np.intp)
    marks = np.empty((CHUNK, rows), np.uint8)
    for i, step in enumerate(by_step):
        at = step + state
        marks[i] = _OUT_FLAT[at]
        state = _GO_FLAT[at]
    flat = marks.T.reshape(-1)
    begin = (flat & HERE).astype(bool)
    begin[:-1] |= (flat[1:] & BEFORE).astype(bool)
    return np.flatnonzero(begin[:n])


class PieceTransducer:
    """Counts the BPE tokens of one piece by a lazily determinised transducer with signed output."""

    def __init__(self, vocabulary: dict[bytes, int], ranks: dict[tuple[int, int], tuple[int, int]]):
        self.ids, self.merges = vocabulary, ranks
        self.single = [vocabulary[bytes([b])] for b in range(256)]
        self.prefixes = {t[:i] for t in vocabulary for i in range(1, len(t) + 1)}
        self.of = {i: t for t, i in vocabulary.items()}
        self.valid: dict[int, bool] = {}
        self.fits: dict[tuple[int, int], bool] = {}
        self.reset()

    def reset(self) -> None:
        self.states: list[tuple] = [(b"", (-1,), (0,))]
        self.known = {self.states[0]: 0}
        self.steps: dict[int, tuple[int, int]] = {}

    def bpe(self, data: bytes) -> list[int]:
        """Plain merging by rank; only used to compile pairs."""
        parts = [self.single[b] for b in data]
        while len(parts) > 1:
            best = min(((self.merges[p][0], i) for i, p in enumerate(zip(parts, parts[1:], strict=False)) if p in self.merges), default=None)
            if best is None:
                break
            i = best[1]
            parts[i : i + 2] = [self.merges[parts[i], parts[i + 1]][1]]
        return parts

    def follows(self, left: int, right: int) -> bool:
        """Whether the two tokens stay apart when their bytes are tokenized together."""
        if left < 0:
            if right not in self.valid:
                self.valid[right] = self.bpe(self.of[right]) == [right]
            return self.valid[right]
        pair = left, right
        if pair not in self.fits:
            if len(self.fits) > 4 * MAX_STATES:
                self.fits.clear()
            self.fits[pair] = self.bpe(self.of[left] + self.of[right]) == [left, right]
        return self.fits[pair]

    def step(self, state: int, byte: int) -> tuple[int, int]:
        """Compile one transition: the next state and the change of the token count."""
        tail, last, counts = self.states[state]
        tail += bytes([byte])
        for size in range(len(tail), 0, -1):
            token = self.ids.get(tail[-size:])
            if token is not None and self.follows(last[len(tail) - size], token):
                break
        change = counts[len(tail) - size] + 1
        last, counts = (*last, token), (*counts, change)
        keep = len(tail)
        while keep and tail[-keep:] not in self.prefixes:
            keep -= 1
        new = tail[len(tail) - keep :], last[-keep - 1 :], tuple(c - change for c in counts[-keep - 1 :])
        to = self.known.get(new)
        if to is None:
            to = self.known[new] = len(self.states)
            self.states.append(new)
        self.steps[state << 8 | byte] = to, change
        return to, change

    def keep_only(self, state: int) -> int:
        """Forget all states but the first and the given one; its new number."""
        own = self.states[state]
        self.reset()
        if own not in self.known:
            self.known[own] = len(self.states)
            self.states.append(own)
        return self.known[own]

    def count(self, piece: bytes) -> int:
        state = total = 0
        steps = self.steps
        for byte in piece:
            found = steps.get(state << 8 | byte)
            if found is None:
                if len(self.states) > MAX_STATES:
                    state = self.keep_only(state)
                    steps = self.steps
                found = self.step(state, byte)
            state, change = found
            total += change
        return total


#: Places before which a text may be cut: a blank after a visible character never continues a piece.
CUT = re.compile(r"(?<=[A-Za-z0-9.,;:!?)]) ")


def cut_text(text: str, most: int) -> Iterator[str]:
    """The text in parts of about ``most`` characters, cut before blanks; without such blanks a part is longer."""
    at = 0
    while len(text) - at > most:
        place = CUT.search(text, at + most)
        if place is None:
            break
        yield text[at : place.start()]
        at = place.start()
    yield text[at:]


class TokenCounter:
    """Counts tokens of whole texts as the ``tokenizers`` library does for a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        back = {ch: b for b, ch in byte_alphabet().items()}
        as_bytes = lambda t: bytes(back[ch] for ch in t)
        special = {t["content"] for t in spec["added_tokens"]}
        ids = {t: i for t, i in spec["model"]["vocab"].items() if t not in special}
        merges = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            merges[ids[a], ids[b]] = rank, ids[a + b]
        self.special = sorted(special, key=len, reverse=True)
        self.pieces = PieceTransducer({as_bytes(t): i for t, i in ids.items()}, merges)
        self.memo: dict[str, int] = {}

    def split_special(self, text: str) -> list[str]:
        """Texts between the special strings, which count one token each; their order is the library's leftmost match."""
        parts = [text]
        for s in self.special:
            parts = [y for x in parts for y in x.split(s)]
        return parts

    def count_block(self, texts: list[str]) -> np.ndarray:
        """Token counts of texts that hold no special string."""
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        block = "\0".join(texts) + "\0"
        codes = class_table()[np.frombuffer(block.encode("utf-32-le", "surrogatepass"), np.uint32)]
        ends = np.cumsum(sizes) - 1
        codes[ends] = END
        starts = piece_starts(codes)
        after = np.append(starts[1:], len(codes))
        is_end = np.zeros(len(codes), bool)
        is_end[ends] = True
        real = ~is_end[starts]
        starts, after = starts[real], after[real]
        memo = self.memo
        if len(memo) > MEMO_PIECES:
            memo.clear()
        words = [block[a:b] for a, b in zip(starts.tolist(), after.tolist(), strict=True)]
        count = self.pieces.count
        long: dict[str, int] = {}
        for w in set(words).difference(memo):
            (memo if len(w) <= MEMO_CHARS else long)[w] = count(w.encode("utf-8", "surrogatepass"))
        counts = np.fromiter((long[w] if w in long else memo[w] for w in words) if long else map(memo.__getitem__, words), np.int64, len(words))
        total = np.concatenate(([0], np.cumsum(counts)))
        bounds = np.searchsorted(starts, np.concatenate(([0], ends + 1)))
        return total[bounds[1:]] - total[bounds[:-1]]

    def count(self, texts: list[str]) -> np.ndarray:
        result = np.zeros(len(texts), np.int64)
        flat: list[str] = []
        owner: list[int] = []
        for i, text in enumerate(texts):
            parts = self.split_special(text) if any(s in text for s in self.special) else [text]
            result[i] = len(parts) - 1
            parts = [x for p in parts for x in cut_text(p, BLOCK_CHARS)]
            flat += parts
            owner += [i] * len(parts)
        for a, b in slices([len(x) for x in flat], BLOCK_CHARS):
            np.add.at(result, np.asarray(owner[a:b]), self.count_block(flat[a:b]))
        return result


def byte_alphabet() -> dict[int, str]:
    """The printable stand-ins of byte-level vocabularies: visible Latin-1 characters stand for themselves, the others take code points from 256 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


_counters: dict[str, TokenCounter] = {}


def counter(path: str) -> TokenCounter:
    """The compiled tokenizer of this Python worker."""
    if path not in _counters:
        _counters[path] = TokenCounter(path)
    return _counters[path]


def count_tokens(df: DataFrame, tokenizer_path: str, text: str = "text", limit: int = 512, bytes_col: str = "n_bytes", tokens_col: str = "n_tokens", over_col: str = "over_limit") -> DataFrame:
    """Add the UTF-8 size, the token count and whether it exceeds ``limit`` to every row.

    Null texts count as empty: 0 bytes, 0 tokens. Empty texts have 0 tokens. Rows, their
    repetition and all other columns are kept as they are; existing columns of the three
    result names are replaced. Texts of any length are read whole; memory is that of a block (2 million characters) or, where a text has
    no blank for longer, of such a stretch. ``tokenizer_path`` is a
    file that every executor can open.
    """

    @F.arrow_udf("long")
    def tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = counter(tokenizer_path)
        for batch in batches:
            yield pa.array(np.concatenate([np.empty(0, np.int64), *map(own.count, text_blocks(batch, BLOCK_CHARS))]), pa.int64())

    n = tokens(F.coalesce(named(text), F.lit("")))
    out = df.withColumns({bytes_col: F.coalesce(F.octet_length(named(text)), F.lit(0)).cast("long"), tokens_col: n})
    return out.withColumn(over_col, F.col(tokens_col) > limit)
