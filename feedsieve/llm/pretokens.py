"""Splitting text into byte-level pre-tokens by a transducer over character classes.

A text is cut into chunks of equal length; the map of a chunk takes the state before it
to the state after it. Maps compose, so a parallel prefix scan over the chunks of a
slice gives every chunk its entry state, and all chunks then run side by side, one
character a step. What is a letter, a number or white space depends on the Unicode tables
of the library to agree with, so the classes are read from that library.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import tiktoken
from tokenizers import Regex, normalizers

CHUNK = 512
SETTLED = 16  # steps after which most chunk maps no longer depend on the entry state

# A lone surrogate occurs in no UTF-8 text and ends a document.
FENCE = "\ud800"

# Classes of characters, then symbols: a contraction's apostrophe with one or two
# letters to come; white space before more of it or the end; a space, or other
# white space, directly before something else.
LETTER, NUMBER, OTHER, SPACE, BLANK, END = range(6)
S_LETTER, S_NUMBER, S_OTHER, S_SHORT, S_LONG, S_RUN, S_SPACE, S_BLANK, S_END = range(9)
# States: nothing open; an open space; a run of letters, numbers, other characters or
# white space; one or two letters of a contraction to come.
CLOSED, SPACED, LETTERS, NUMBERS, OTHERS, BLANKS, ONE_MORE, TWO_MORE = range(8)
N_STATES, N_SYMBOLS = 8, 9


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Next state and whether a pre-token begins, by state and symbol."""
    step = np.zeros((N_STATES, N_SYMBOLS), np.uint8)
    begins = np.ones((N_STATES, N_SYMBOLS), bool)
    runs = {S_LETTER: LETTERS, S_NUMBER: NUMBERS, S_OTHER: OTHERS, S_RUN: BLANKS}
    for state in range(N_STATES):
        for symbol, run in runs.items():
            step[state, symbol] = run
            begins[state, symbol] = not (state == run or (state == SPACED and symbol != S_RUN))
        for symbol, then in ((S_SHORT, ONE_MORE), (S_LONG, TWO_MORE)):
            joins = state in (SPACED, OTHERS)
            step[state, symbol] = OTHERS if joins else then
            begins[state, symbol] = not joins
        step[state, S_SPACE], step[state, S_BLANK], step[state, S_END] = SPACED, CLOSED, CLOSED
    for state, then in ((ONE_MORE, CLOSED), (TWO_MORE, ONE_MORE)):
        step[state, :S_END] = then
        begins[state, :S_END] = False
    return step.ravel(), begins.ravel()


STEP, BEGINS = _tables()


def _matched_by_tiktoken(pattern: str, points: str) -> str:
    """What the pattern matches; text between matches is not encoded."""
    single = {bytes((b,)): b for b in range(256)}
    probe = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks=single, special_tokens={})
    return probe.decode(probe.encode_ordinary(points))


def _matched_by_tokenizers(pattern: str, points: str) -> str:
    remove = normalizers.Replace(Regex(pattern), "").normalize_str
    blocks = [points[i : i + 8192] for i in range(0, len(points), 8192)]
    return "".join(c for b in blocks for c in sorted(set(b) - set(remove(b))))


@lru_cache(2)
def classes(library: str) -> np.ndarray:
    """The class of every code point, by ``tiktoken`` or ``tokenizers``."""
    matched = {"tiktoken": _matched_by_tiktoken, "tokenizers": _matched_by_tokenizers}[library]
    table = np.full(0x110000, OTHER, np.uint8)
    points = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (BLANK, r"\s+")):
        table[np.frombuffer(matched(pattern, points).encode("utf-32-le"), np.uint32)] = kind
    table[ord(" ")] = SPACE
    table[ord(FENCE)] = END
    return table


@lru_cache(1)
def disputed() -> str:
    """The characters that the two libraries class differently."""
    return "".join(map(chr, np.flatnonzero(classes("tiktoken") != classes("tokenizers"))))


def symbols(points: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Each character's symbol, from its class and what follows; ends with a fence."""
    kind = table[points]
    symbol = kind.copy()
    follows = np.append(kind[1:], END)
    before_text = follows <= OTHER
    blank = (kind == SPACE) | (kind == BLANK)
    symbol[blank] = S_RUN
    symbol[(kind == SPACE) & before_text] = S_SPACE
    symbol[(kind == BLANK) & before_text] = S_BLANK
    symbol[kind == END] = S_END
    quote = np.flatnonzero(points == ord("'"))
    if len(quote):
        padded = np.append(points, [0, 0, 0])
        one, two = padded[quote + 1], padded[quote + 2]
        symbol[quote[np.isin(one, [ord(c) for c in "stmd"])]] = S_SHORT
        pair = one.astype(np.uint64) << np.uint64(32) | two.astype(np.uint64)
        long = [ord(a) << 32 | ord(b) for a, b in ("re", "ve", "ll")]
        symbol[quote[np.isin(pair, np.array(long, np.uint64))]] = S_LONG
    return symbol


def compose_scan(maps: np.ndarray) -> np.ndarray:
    """Row i: the composition of maps 0 to i, by doubling."""
    maps, width = maps.copy(), 1
    while width < len(maps):
        maps[width:] = np.take_along_axis(maps[width:], maps[:-width], 1)
        width *= 2
    return maps


def beginnings(points: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Where pre-tokens begin."""
    symbol = symbols(points, table)
    n = len(symbol)
    chunks = -(-n // CHUNK)
    lanes = np.full(chunks * CHUNK, S_END, np.uint8)
    lanes[:n] = symbol
    lanes = np.ascontiguousarray(lanes.reshape(chunks, CHUNK).T)
    maps = np.tile(np.arange(N_STATES, dtype=np.uint8), (chunks, 1))
    for s in lanes[:SETTLED]:
        maps = STEP[maps * np.intp(N_SYMBOLS) + s[:, None]]
    state = maps[:, 0]
    open_maps = np.flatnonzero((maps != maps[:, :1]).any(1))
    rest = maps[open_maps]
    for s in lanes[SETTLED:]:
        state = STEP[state * np.intp(N_SYMBOLS) + s]
        if len(open_maps):
            rest = STEP[rest * np.intp(N_SYMBOLS) + s[open_maps][:, None]]
    maps = np.repeat(state[:, None], N_STATES, 1)
    maps[open_maps] = rest
    state = np.append(np.uint8(CLOSED), compose_scan(maps)[:-1, CLOSED])
    found = np.empty(lanes.shape, bool)
    for c, s in enumerate(lanes):
        at = state * np.intp(N_SYMBOLS) + s
        found[c] = BEGINS[at]
        state = STEP[at]
    return np.flatnonzero(found.T.ravel()[:n])


def split(texts: list[str], library: str) -> tuple[list[str], np.ndarray]:
    """Pre-tokens of all texts in order, a fence after each text, and where each text ends."""
    joined = FENCE.join(texts) + FENCE
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    begin = beginnings(points, classes(library))
    cuts = begin.tolist()
    cuts.append(len(joined))
    words = [joined[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
    return words, np.searchsorted(begin, np.cumsum([len(t) + 1 for t in texts]))
