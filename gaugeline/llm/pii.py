"""Personal data by fixed patterns and a bidirectional LSTM with CRF transitions.

The patterns give the base spans. A small recurrent network, trained in numpy from
labelled spans, reads texts character by character in overlapping windows and adds spans
that the patterns miss, such as national telephone numbers or a card number with digits
attached. Two windows tell of each place; what they tell is blended, and one Viterbi search decodes
the whole text. A span has the form of its kind, so it lies in a stretch of non-blank characters
with an ``@`` or in one of digits and their separators with enough digits. Everything
outside such stretches is tagged O, which splits the search into independent parts without changing
its result; windows that touch no stretch cannot matter and are not read.
"""

from __future__ import annotations

import functools
import random
import re
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, named, slices, text_blocks

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

# ---- base spans

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")


def digits_of(text: str) -> str:
    return "".join(ch for ch in text if "0" <= ch <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def valid_ip(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in text.split("."))


def valid_card(text: str) -> bool:
    d = digits_of(text)
    return 13 <= len(d) <= 19 and luhn(d)


def valid_phone(text: str) -> bool:
    return 9 <= len(digits_of(text)) <= 15


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping addresses, in linear time: the run of local characters before each @."""
    at, end = text.find("@"), 0
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            end = found.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns by kind, then start. Failing matches are dropped and not retried."""
    out: list[Span] = []
    if "@" in text:
        out += [("email", a, b) for a, b in emails(text)]
    if DIGIT.search(text):
        for kind, pattern, valid in (("ip", IP, valid_ip), ("card", CARD, valid_card), ("phone", PHONE, valid_phone)):
            if kind != "phone" or "+" in text:
                out += [(kind, *m.span()) for m in pattern.finditer(text) if valid(m.group())]
    return out


# ---- steps of the network

MARKS = "@.-_+%()/:,;#='\"<>[]*|!?&"
LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
PAD, LETTER, BLANK, LINE, OTHER = range(5)
SYMBOLS = LETTERS + "0123456789" + MARKS
N_SYMBOL = 5 + len(SYMBOLS)


@functools.cache
def symbol_table() -> np.ndarray:
    """The step of each code point: a symbol of its own for ASCII letters, digits and MARKS, else a class."""
    table = np.full(0x110000, OTHER, np.uint8)
    for c in range(0x80, 0x110000):
        if unicodedata.category(chr(c))[0] in "LM":
            table[c] = LETTER
    table[0] = PAD
    for symbols, step in ((" \t\xa0", BLANK), ("\n\r\x0b\x0c", LINE)):
        for ch in symbols:
            table[ord(ch)] = step
    for i, ch in enumerate(SYMBOLS):
        table[ord(ch)] = 5 + i
    return table


def encode(windows: list[str]) -> np.ndarray:
    """(WIDTH, windows) steps; shorter windows are padded at their end."""
    codes = np.frombuffer("".join(w.ljust(WIDTH, "\0") for w in windows).encode("utf-32-le", "surrogatepass"), np.uint32)
    return symbol_table()[codes].reshape(len(windows), WIDTH).T.astype(np.intp)


# ---- the network

HIDDEN = 12
TAGS = ["O"] + [f"{p}-{k}" for k in KINDS for p in "BI"]
N_TAG = len(TAGS)
STRIDE = 48
WIDTH = 2 * STRIDE
BATCH = 1024
NEVER = np.float32(-1e4)


@dataclass
class TaggerModel:
    """p: for each direction ``x`` (symbols, 4H), ``u`` (H, 4H), ``w`` (H, tags); ``c`` (tags,); ``a`` (tags, tags); ``s`` (tags,)."""

    p: dict[str, np.ndarray]

    def run(self, x: np.ndarray, side: str, keep: bool = False):
        """Hidden states (T, B, H) of one direction; with ``keep`` also what the gradient needs.

        Columns of gates: input, forget, output, candidate. A sigmoid is taken as (1 + tanh(z / 2)) / 2.
        """
        t_max, n = x.shape
        table, u = self.p["x" + side], self.p["u" + side]
        scale = np.ones(4 * HIDDEN, table.dtype)
        scale[: 3 * HIDDEN] = 0.5
        table, u = table * scale, u * scale
        h, c = np.zeros((n, HIDDEN), table.dtype), np.zeros((n, HIDDEN), table.dtype)
        out = np.empty((t_max, n, HIDDEN), table.dtype)
        saved = []
        z, r = np.empty((n, 4 * HIDDEN), table.dtype), np.empty((n, 4 * HIDDEN), table.dtype)
        for t in range(t_max) if side == "f" else range(t_max - 1, -1, -1):
            np.take(table, x[t], axis=0, out=z, mode="clip")
            np.dot(h, u, out=r)
            z += r
            np.tanh(z, out=z)
            gates = z[:, : 3 * HIDDEN]
            gates *= 0.5
            gates += 0.5
            before = c
            c = z[:, HIDDEN : 2 * HIDDEN] * c
            c += z[:, :HIDDEN] * z[:, 3 * HIDDEN :]
            tc = np.tanh(c)
            h_before, h = h, z[:, 2 * HIDDEN : 3 * HIDDEN] * tc
            out[t] = h
            if keep:
                saved.append((t, z.copy(), before, tc, h_before))
        return (out, saved) if keep else out

    def emissions(self, x: np.ndarray) -> np.ndarray:
        return self.run(x, "f") @ self.p["wf"] + self.run(x, "b") @ self.p["wb"] + self.p["c"]

    def moves(self) -> np.ndarray:
        return self.p["a"] + FORBIDDEN


#: I tags follow only B and I of their kind.
FORBIDDEN = np.zeros((N_TAG, N_TAG), np.float32)
for _i in range(2, N_TAG, 2):
    FORBIDDEN[:, _i] = NEVER
    FORBIDDEN[[_i - 1, _i], _i] = 0
#: A text begins with O or a B tag.
START = np.where((np.arange(N_TAG) % 2 == 0) & (np.arange(N_TAG) > 0), NEVER, 0).astype(np.float32)


def gradients(model: TaggerModel, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean negative log-likelihood of the tags (T, B) and its gradients, by forward-backward and through time.

    A window may begin within a span, so every tag may come first.
    """
    p = model.p
    kind = p["c"].dtype
    t_max, n = x.shape
    (hf, kf), (hb, kb) = model.run(x, "f", True), model.run(x, "b", True)
    e = (hf @ p["wf"] + hb @ p["wb"] + p["c"]).astype(np.float64)
    a, s = model.moves().astype(np.float64), p["s"].astype(np.float64)
    # probabilities of tags, scaled at each step; ``c`` holds the scales
    top = e.max(axis=2, keepdims=True)
    own, move = np.exp(e - top), np.exp(a)
    alpha, beta, c = np.empty_like(e), np.ones_like(e), np.empty((t_max, n, 1))
    now = np.exp(s) * own[0]
    for t in range(t_max):
        if t:
            now = (alpha[t - 1] @ move) * own[t]
        c[t] = now.sum(axis=1, keepdims=True)
        alpha[t] = now / c[t]
    ahead = own / c
    for t in range(t_max - 2, -1, -1):
        beta[t] = (ahead[t + 1] * beta[t + 1]) @ move.T
    z = (np.log(c) + top).sum(axis=(0, 2))
    g = {k: np.zeros_like(v) for k, v in p.items()}
    pair = move * np.tensordot(alpha[:-1], ahead[1:] * beta[1:], ((0, 1), (0, 1)))
    np.add.at(pair, (y[:-1].ravel(), y[1:].ravel()), -1)
    rows, steps = np.arange(n), np.arange(t_max)[:, None]
    gold = (s[y[0]] + e[steps, rows, y].sum(axis=0)) + a[y[:-1], y[1:]].sum(axis=0)
    de = alpha * beta
    de[steps, rows, y] -= 1
    g["s"] += (de[0].sum(axis=0) / n).astype(kind)
    g["a"] += (pair / n).astype(kind)
    de = (de / n).astype(kind)
    g["c"] += de.sum(axis=(0, 1))
    hot = (np.arange(N_SYMBOL)[:, None] == x.ravel()).astype(kind)
    for side, hs, kept in (("f", hf, kf), ("b", hb, kb)):
        g["w" + side] += np.tensordot(hs, de, ((0, 1), (0, 1)))
        back, u = de @ p["w" + side].T, p["u" + side].T
        dh, dc = np.zeros((n, HIDDEN), kind), np.zeros((n, HIDDEN), kind)
        dz, before = np.empty((t_max, n, 4 * HIDDEN), kind), np.empty((t_max, n, HIDDEN), kind)
        for t, gate, c_before, tc, h_before in reversed(kept):
            i, f, o, q = (gate[:, k * HIDDEN : (k + 1) * HIDDEN] for k in range(4))
            dh = dh + back[t]
            dc = dc + dh * o * (1 - tc * tc)
            dz[t] = np.concatenate((dc * q * i * (1 - i), dc * c_before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - q * q)), axis=1)
            before[t] = h_before
            dh, dc = dz[t] @ u, dc * f
        g["x" + side] += hot @ dz.reshape(-1, 4 * HIDDEN)
        g["u" + side] += np.tensordot(before, dz, ((0, 1), (0, 1)))
    return float((z - gold).mean()), g


def train(windows: np.ndarray, tags: np.ndarray, steps: int, batch: int = 32, rate: float = 0.02, seed: int = 5) -> TaggerModel:
    """Adam over (WIDTH, N) windows and tags."""
    rng = np.random.default_rng(seed)
    p = {}
    for side in "fb":
        p["x" + side] = rng.normal(0, 0.4, (N_SYMBOL, 4 * HIDDEN)).astype(np.float32)
        p["x" + side][:, HIDDEN : 2 * HIDDEN] += 1
        p["u" + side] = rng.normal(0, 0.3, (HIDDEN, 4 * HIDDEN)).astype(np.float32)
        p["w" + side] = rng.normal(0, 0.3, (HIDDEN, N_TAG)).astype(np.float32)
    p |= {"c": np.zeros(N_TAG, np.float32), "a": np.zeros((N_TAG, N_TAG), np.float32), "s": np.zeros(N_TAG, np.float32)}
    model, moment = TaggerModel(p), {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in p.items()}
    for step in range(1, steps + 1):
        pick = rng.integers(0, windows.shape[1], batch)
        _, g = gradients(model, windows[:, pick], tags[:, pick])
        norm = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
        now = rate * min(1.0, 3 * (1 - step / (steps + 1)))
        for k, v in g.items():
            v = v * min(1.0, 5 / (norm + 1e-9))
            m = moment[k]
            m[0] = 0.9 * m[0] + 0.1 * v
            m[1] = 0.99 * m[1] + 0.01 * v * v
            p[k] -= (now * m[0] / (1 - 0.9**step) / (np.sqrt(m[1] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return model


def tagged_windows(texts: list[str], spans: list[list[Span]]) -> tuple[np.ndarray, np.ndarray]:
    """(WIDTH, windows) steps and tags of all windows of labelled texts."""
    cut, tags = [], []
    for text, own in zip(texts, spans, strict=True):
        y = np.zeros(len(text) + WIDTH, np.intp)
        for kind, a, b in own:
            y[a:b] = 2 + 2 * KINDS.index(kind)
            y[a] -= 1
        for at in range(0, max(1, len(text)), STRIDE):
            cut.append(text[at : at + WIDTH])
            tags.append(y[at : at + WIDTH])
    return encode(cut), np.stack(tags, axis=1)


def labelled_examples(n: int, seed: int = 11) -> tuple[list[str], list[list[Span]]]:
    """Invented texts with labelled spans: each kind in several spellings among look-alikes that are none."""
    rng = random.Random(seed)
    number = lambda k: "".join(rng.choices("0123456789", k=k))
    word = lambda a=1, b=10: "".join(rng.choices("etaoinshrdlu", k=rng.randrange(a, b)))
    pick = lambda *x: rng.choice(x)

    def card() -> str:
        d = pick("4", "5", "37", "60") + number(rng.randrange(12, 15))
        d += next(c for c in "0123456789" if luhn(d + c))
        sep = pick("", "", " ", "-")
        return sep.join(d[i : i + 4] for i in range(0, len(d), 4))

    def phone() -> str:
        a, b, c = number(3), number(3), number(4)
        return pick(f"+1 ({a}) {b}-{c}", f"+{number(2)} {a} {b} {c}", f"+{number(2)}{a}{b}{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"({a}) {b} {c}", f"+1-{a}-{b}-{c}", f"{a}.{b}.{c}")

    def email() -> str:
        host = pick(f"{word(2)}.com", f"mail{number(1)}.{word(3)}.org", f"{word(2)}-{word(2)}.co.uk")
        return pick(word(2), f"{word()}.{number(2)}", f"{word()}_{word()}", f"{word()}+{word()}", f"{word()}.{word()}") + "@" + host

    def ip() -> str:
        return ".".join(str(rng.randrange(256)) for _ in range(4))

    def other() -> str:
        return pick(
            number(rng.randrange(1, 12)), f"{number(2)}.{number(2)}", f"{rng.randrange(1900, 2030)}", f"{number(2)}:{number(2)}", f"{rng.randrange(1900, 2030)}-{number(2)}-{number(2)}",
            f"{number(1)}.{number(1)}.{number(1)}", f"{word()}={number(3)}{word(2)}{number(4)}{word(1)}", f"v{number(1)}.{number(1)}", f"${number(3)}.{number(2)}", f"{number(3)}-{number(3)}", f"{number(1)},{number(3)},{number(3)}",
            f"http://{word()}.com/{word()}/{number(4)}", f"@{word()}", f"{word()}@ {word()}", f"({number(4)})", f"+{number(1)}", f"#{number(6)}", f"{number(2)}/{number(2)}/{number(4)}", f'"{word()}{number(9)}{word()}{number(3)}"', f"{word(3).upper()}{number(2)}{word(3).upper()}", f"{number(1)}.", "***", "&&&", "|", "!!",
        )

    makers: dict[str, Callable[[], str]] = {"email": email, "ip": ip, "card": card, "phone": phone}
    texts, spans = [], []
    for _ in range(n):
        parts, own, size = [], [], 0
        for _ in range(rng.randrange(3, 12)):
            kind = rng.choices([*KINDS, "other", "words"], [0.08, 0.08, 0.08, 0.12, 0.22, 0.42])[0]
            if kind in makers:
                piece = makers[kind]()
                lead = pick("", "", "", "(", '"', "<", "tel:", "") if kind != "email" else pick("", "", "<", "(")
                parts.append(lead + piece)
                own.append((kind, size + len(lead), size + len(lead) + len(piece)))
            elif kind == "other":
                parts.append(other())
            else:
                parts.append(" ".join(word() for _ in range(rng.randrange(1, 9))))
            parts.append(pick(" ", " ", " ", ". ", ", ", "\n", ") ", "; "))
            size += len(parts[-1]) + len(parts[-2])
        texts.append("".join(parts))
        spans.append(own)
    return texts, spans


def fit(texts: list[str] | None = None, spans: list[list[Span]] | None = None, steps: int = 500) -> TaggerModel:
    """Train from labelled spans; without any, from ``labelled_examples``, once in a process."""
    if texts is None:
        return _own_model(steps)
    return train(*tagged_windows(texts, spans), steps=steps)


@functools.cache
def _own_model(steps: int) -> TaggerModel:
    return train(*tagged_windows(*labelled_examples(3000)), steps=steps)


# ---- whole texts

LIKELY = {
    "email": lambda s: s.count("@") == 1 and "." in s.partition("@")[2] and not re.search(r"\s", s),
    "ip": lambda s: re.fullmatch(r"[0-9]{1,3}(\.[0-9]{1,3}){3}", s) is not None and valid_ip(s),
    "card": lambda s: re.fullmatch(r"[0-9 ().-]+", s) is not None and valid_card(s),
    "phone": lambda s: re.fullmatch(r"\+?[0-9 ().-]+", s) is not None and 9 <= len(digits_of(s)) <= 15 and len(re.findall(r"[ ().-]+", s)) >= 2 and s.count("(") == s.count(")"),
}
# What LIKELY demands of characters: numbers have at least nine digits or are four with dots between.
GAPS = frozenset(" +().-")
NUMBERS = (re.compile(r"(?:[0-9][ +().-]*+){9,}+"), re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"))
IN_NUMBER = GAPS | frozenset("0123456789")
MAIL, NUMBER = 1, 2
#: Characters that are put into windows at once, and steps of sequences that are decoded side by side.
PIECE, AREA = 1 << 16, 1 << 18
#: Longer segments are decoded alone, in blocks of so many characters.
LONG = 1 << 17
#: Tags that a character may have, by MAIL + NUMBER.
OPEN = np.array([[0] + [0 if (stretch & (MAIL if k == "email" else NUMBER)) else NEVER for k in KINDS for _ in "BI"] for stretch in range(4)], np.float32)


def grown(text: str, a: int, b: int, low: int, inside: Callable[[str], bool]) -> tuple[int, int]:
    while a > low and inside(text[a - 1]):
        a -= 1
    while b < len(text) and inside(text[b]):
        b += 1
    return a, b


def stretches(text: str) -> list[tuple[int, int, int]]:
    """(begin, end, MAIL or NUMBER) of the longest runs in which a span of a likely form may lie."""
    out = []
    at, end = text.find("@"), 0
    while at >= 0:
        a, end = grown(text, at, at + 1, end, lambda ch: not ch.isspace())
        out.append((a, end, MAIL))
        at = text.find("@", end)
    if DIGIT.search(text):
        for pattern in NUMBERS:
            end = 0
            for m in pattern.finditer(text):
                if m.end() > end:
                    a, end = grown(text, *m.span(), end, IN_NUMBER.__contains__)
                    out.append((a, end, NUMBER))
    return sorted(out)


def segments(text: str) -> list[tuple[int, int, np.ndarray]]:
    """(begin, end, OPEN's row of each character): stretches that touch are one segment."""
    joined: list[list] = []
    for a, b, kind in stretches(text):
        if joined and a <= joined[-1][1]:
            joined[-1][1] = max(b, joined[-1][1])
            joined[-1][2].append((a, b, kind))
        else:
            joined.append([a, b, [(a, b, kind)]])
    out = []
    for begin, end, own in joined:
        kinds = np.zeros(end - begin, np.uint8)
        for a, b, kind in own:
            kinds[a - begin : b - begin] |= kind
        out.append((begin, end, kinds))
    return out


def blended(model: TaggerModel, pieces: list[tuple[str, int, int]]) -> np.ndarray:
    """Emissions (characters, tags) of ranges of texts, one after the other.

    Windows begin at the multiples of STRIDE. Of the two that hold a character, the one in whose middle it
    lies counts more, in proportion to the distance from the window's ends.
    """
    at: dict[tuple[int, int], int] = {}
    cut: list[str] = []
    places, late, early = [], [], []
    for text, a, b in pieces:
        windows = range(max(0, a // STRIDE - 1), (b - 1) // STRIDE + 1)
        for w in windows:
            if (id(text), w) not in at:
                at[id(text), w] = len(cut)
                cut.append(text[w * STRIDE : w * STRIDE + WIDTH])
        index, t = np.array([at[id(text), w] for w in windows]), np.arange(a, b)
        places.append(t)
        late.append(index[t // STRIDE - windows[0]])
        early.append(index[np.maximum(t // STRIDE - 1, 0) - windows[0]])
    e = np.concatenate([model.emissions(encode(cut[i : i + BATCH])).transpose(1, 0, 2) for i in range(0, len(cut), BATCH)])
    t, late, early = map(np.concatenate, (places, late, early))
    inside, alone = t % STRIDE, t < STRIDE
    share = np.where(alone, 1, (inside + 0.5) / STRIDE).astype(e.dtype)[:, None]
    return share * e[late, inside] + (1 - share) * e[early, np.where(alone, inside, inside + STRIDE)]


def viterbi(e: np.ndarray, sizes: np.ndarray, first: np.ndarray, moves: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Best tags (T, B) of B sequences of ``sizes`` steps, the longest first: emissions (T, B, tags), scores of the first and of the last tag (B, tags)."""
    t_max, n = e.shape[:2]
    best = first + e[0]
    back = np.zeros((t_max, n, N_TAG), np.int8)
    back[:] = np.arange(N_TAG, dtype=np.int8)
    for t in range(1, t_max):
        m = int(np.searchsorted(-sizes, -t, side="left"))  # those with more than t steps
        score = best[:m, :, None] + moves
        back[t, :m] = score.argmax(axis=1)
        best[:m] = score.max(axis=1) + e[t, :m]
    state = (best + last).argmax(axis=1)
    tags = np.zeros((t_max, n), np.int8)
    for t in range(t_max - 1, -1, -1):
        tags[t] = state
        state = back[t, np.arange(n), state]
    return tags


def long_tags(model: TaggerModel, text: str, a: int, b: int, kinds: np.ndarray, first: np.ndarray, last: np.ndarray, block: int) -> np.ndarray:
    """Best tags of one long segment, as ``viterbi`` gives them, with the steps of ``block`` characters in memory.

    After each block the best paths to all tags are followed back to where they meet; what lies before is decided. Paths
    that don't meet for long keep their steps, one byte for a tag, until they do.
    """
    tags, done, moves = np.zeros(b - a, np.int8), 0, model.moves()
    backs = np.zeros((0, N_TAG), np.int8)  # backs[k]: from a tag at done + k + 1 to the one before it
    best = None
    for x in range(a, b, block):
        y = min(x + block, b)
        e = blended(model, [(text, p, min(p + PIECE, y)) for p in range(x, y, PIECE)]) + OPEN[kinds[x - a : y - a]]
        own = np.zeros((len(e), N_TAG), np.int8)
        for t in range(len(e)):
            if best is None:
                best = first + e[0]
                continue
            score = best[:, None] + moves
            own[t] = score.argmax(axis=0)
            best = score.max(axis=0) + e[t]
        backs = np.concatenate((backs, own[1:] if x == a else own))
        best = best - best.max()
        if y == b:
            states = np.array([(best + last).argmax()])
        else:
            states = np.arange(N_TAG)
        t = len(backs)  # states are those at done + t
        while t and (states != states[0]).any():
            states = backs[t - 1][states]
            t -= 1
        if (states != states[0]).any():
            continue
        state, end = int(states[0]), t
        steps = backs[:end].tolist()
        path = [state]
        for row in reversed(steps):
            state = row[state]
            path.append(state)
        tags[done : done + end + 1] = path[::-1]
        backs, done = backs[end:], done + end
    return tags


def spans_of_tags(tags: np.ndarray) -> Iterator[tuple[str, int, int]]:
    """(kind, begin, end) of each B tag and the I tags of its kind that follow."""
    for t in np.flatnonzero(tags % 2 == 1).tolist():
        end, kind = t + 1, tags[t]
        while end < len(tags) and tags[end] == kind + 1:
            end += 1
        yield KINDS[kind // 2], t, end


def network_spans(model: TaggerModel, texts: list[str]) -> list[list[Span]]:
    """Spans that the network finds in each text, those whose text has the form of their kind."""
    found: list[list[Span]] = [[] for _ in texts]
    parts = [(i, a, b, kinds) for i, text in enumerate(texts) for a, b, kinds in segments(text)]
    parts.sort(key=lambda s: s[1] - s[2])
    moves, start = model.moves(), model.p["s"] + START

    def note(i: int, a: int, tags: np.ndarray) -> None:
        for name, x, y in spans_of_tags(tags):
            if LIKELY[name](texts[i][a + x : a + y]):
                found[i].append((name, a + x, a + y))

    def ends_of(i: int, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        return start if a == 0 else moves[0], 0 * start if b == len(texts[i]) else moves[:, 0]

    while parts and parts[0][2] - parts[0][1] > LONG:
        i, a, b, kinds = parts.pop(0)
        note(i, a, long_tags(model, texts[i], a, b, kinds, *ends_of(i, a, b), LONG))
    while parts:
        many = max(1, AREA // (parts[0][2] - parts[0][1]))
        own, parts = parts[:many], parts[many:]
        pieces = [(texts[i], x, min(b, x + PIECE)) for i, a, b, _ in own for x in range(a, b, PIECE)]
        told = np.concatenate([blended(model, pieces[x:y]) for x, y in slices([b - a for _, a, b in pieces], PIECE)])
        told += OPEN[np.concatenate([k for *_, k in own])]
        sizes = np.array([b - a for _, a, b, _ in own])
        ends = np.cumsum(sizes)
        e = np.zeros((sizes[0], len(own), N_TAG), np.float32)
        for j, n in enumerate(sizes.tolist()):
            e[:n, j] = told[ends[j] - n : ends[j]]
        first, last = (np.stack(x) for x in zip(*(ends_of(i, a, b) for i, a, b, _ in own), strict=True))
        tags = viterbi(e, sizes, first, moves, last)
        for j, (i, a, b, _) in enumerate(own):
            note(i, a, tags[: b - a, j])
    return found


def all_spans(model: TaggerModel, texts: list[str]) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, all spans) of each text; the network's spans that touch a base span or an earlier one are dropped."""
    result = []
    for text, extra in zip(texts, network_spans(model, texts), strict=True):
        base = base_spans(text)
        taken = sorted((a, b) for _, a, b in base)
        own = list(base)
        if extra:
            ends = np.maximum.accumulate([b for _, b in taken]) if taken else []
            firsts = [a for a, _ in taken]
            free = 0
            for kind, a, b in sorted(extra, key=lambda s: s[1]):
                i = int(np.searchsorted(firsts, b)) if firsts else 0
                if a >= free and (i == 0 or ends[i - 1] <= a):
                    own.append((kind, a, b))
                    free = b
        own.sort(key=lambda s: (KINDS.index(s[0]), s[1]))
        result.append((base, own))
    return result


SPAN_TYPE = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
BLOCK_CHARS = 1 << 20


def find_spans(df: DataFrame, model: TaggerModel, text: str = "text", base_col: str = "base_spans", spans_col: str = "spans") -> DataFrame:
    """Add the base spans and all spans, arrays of (kind, start, end) in code points, by kind and start.

    Null and empty texts have no spans. Whole texts are read, whatever their length, in linear time; memory is the text, two bytes for
    each character of its longest stretch and one block of steps. Rows,
    repetitions and other columns are kept; existing columns of the two result names are replaced.
    """

    @F.arrow_udf("struct<base:array<struct<kind:string,start:long,end:long>>,spans:array<struct<kind:string,start:long,end:long>>>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            both = [r for texts in text_blocks(batch, BLOCK_CHARS) for r in all_spans(model, texts)]
            as_array = lambda k: pa.array([[dict(zip(("kind", "start", "end"), s, strict=True)) for s in r[k]] for r in both], pa.list_(SPAN_TYPE))
            yield pa.StructArray.from_arrays([as_array(0), as_array(1)], names=["base", "spans"])

    found = free_name(df, "found")
    out = df.withColumn(found, run(F.coalesce(named(text), F.lit(""))))
    return out.withColumns({base_col: named(found)["base"], spans_col: named(found)["spans"]}).drop(found)


def replaced(text: str, spans: list[dict]) -> str:
    parts, at = [], 0
    for s in sorted(spans, key=lambda s: (s["start"], s["end"], s["kind"])):
        if s["start"] >= at:
            parts += [text[at : s["start"]], f"[{s['kind'].upper()}]"]
        at = max(at, s["end"])
    return "".join([*parts, text[at:]])


def redact(df: DataFrame, text: str = "text", spans_col: str = "spans") -> DataFrame:
    """Replace each span of ``text`` by its kind in brackets, such as ``[EMAIL]``; a null text stays null.

    Overlapping spans are replaced together by the kind of the first. Only texts with spans go to Python.
    """

    @F.arrow_udf("string")
    def run(texts: pa.Array, spans: pa.Array) -> pa.Array:
        return pa.array([t and replaced(t, s) for t, s in zip(texts.to_pylist(), spans.to_pylist(), strict=True)], pa.string())

    some = F.size(named(spans_col)) > 0
    return df.withColumn(text, F.coalesce(run(F.when(some, named(text)), F.when(some, named(spans_col))), named(text)))
