"""Byte-level pre-tokenizer as a deterministic finite-state transducer.

The split pattern of byte-level BPE vocabularies (contractions, words, numbers,
other runs, white space) is compiled into a transducer over character classes.
Each transition says whether a piece starts at the character read and whether
one starts at the character before it (white space and contractions are decided
one character late).

``piece_bounds`` runs it over a whole batch at once: the character stream is cut
into chunks, every chunk is run from all states at the same time (its state
map), the maps are composed by a parallel prefix scan, and one more run from
each chunk's now known entry state emits the marks. Texts are kept apart by an
end symbol.
"""

from __future__ import annotations

import functools
import sys

import numpy as np
import regex

from tablepipe.llm._text import code_points

# Character classes. The letters of contractions have classes of their own.
CLASSES = ("letter", "number", "space", "white", "quote", "other", "end",
           "one", "e", "r", "v", "l")  # one: s t m d, which end a contraction alone
LETTER, NUMBER, SPACE, WHITE, QUOTE, OTHER, END, ONE, E, R, V, L = range(len(CLASSES))
LETTERS = (LETTER, ONE, E, R, V, L)

STATES = ("start", "in_letters", "in_numbers", "in_other", "one_space", "more_space",
          "one_white", "more_white", "fresh_quote", "quote_r", "quote_v", "quote_l", "closed")
(START, IN_L, IN_N, IN_O, SP1, SPN, WH1, WHN, FQ, QR, QV, QL, CLOSED) = range(len(STATES))

HERE, BACK = 1, 2  # a piece starts at this character; at the one before
CHUNK = 256


def _fresh(c):
    """State after a piece starts with class ``c``."""
    if c in LETTERS:
        return IN_L
    return {NUMBER: IN_N, SPACE: SP1, WHITE: WH1, QUOTE: FQ, OTHER: IN_O}[c]


def _attached(c):
    """State after a space has attached itself to class ``c`` (no contraction there)."""
    return IN_L if c in LETTERS else IN_N if c == NUMBER else IN_O


def _step(state, c):
    """(next state, marks) of the transducer."""
    if c == END:
        return START, BACK if state in (QR, QV, QL) else 0
    white = c in (SPACE, WHITE)
    if state in (SP1, SPN, WH1, WHN):
        if white:
            return (SPN if c == SPACE else WHN), 0
        if state == SP1:
            return _attached(c), 0
        if state == SPN:
            return _attached(c), BACK
        return _fresh(c), HERE | (BACK if state == WHN else 0)
    if state == FQ:
        if c == ONE:
            return CLOSED, 0
        if c in (R, V, L):
            return {R: QR, V: QV, L: QL}[c], 0
        if c in (QUOTE, OTHER):
            return IN_O, 0
        return _fresh(c), HERE
    if state in (QR, QV, QL):
        if c == (L if state == QL else E):
            return CLOSED, 0
        if c in LETTERS:
            return IN_L, BACK
        return _fresh(c), BACK | HERE
    if state == IN_L and c in LETTERS:
        return IN_L, 0
    if state == IN_N and c == NUMBER:
        return IN_N, 0
    if state == IN_O and c in (QUOTE, OTHER):
        return IN_O, 0
    return _fresh(c), HERE


@functools.lru_cache(1)
def _tables():
    """(class of each code point, next state and marks by state * classes + class)."""
    everything = "".join(map(chr, range(sys.maxunicode + 1)))
    classes = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    for cls, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (WHITE, r"\s")):
        for m in regex.finditer(pattern + "+", everything):
            classes[m.start():m.end()] = cls
    classes[0xD800:0xE000] = OTHER
    classes[ord(" ")] = SPACE
    classes[ord("'")] = QUOTE
    for letters, cls in (("stmd", ONE), ("e", E), ("r", R), ("v", V), ("l", L)):
        for ch in letters:
            classes[ord(ch)] = cls
    width = len(CLASSES)
    nexts = np.zeros(len(STATES) * width, np.uint8)
    marks = np.zeros(len(STATES) * width, np.uint8)
    for s in range(len(STATES)):
        for c in range(width):
            nexts[s * width + c], marks[s * width + c] = _step(s, c)
    return classes, nexts, marks


def _entry_states(grid, nexts):
    """Entry state of every chunk (column of ``grid``), by state maps and a prefix scan."""
    width, n_states, chunks = len(CLASSES), len(STATES), grid.shape[1]
    maps = np.repeat(np.arange(n_states, dtype=np.uint8)[:, None], chunks, 1)
    for row in grid:
        maps = nexts[maps * np.uint8(width) + row]
    reach = 1
    while reach < chunks:  # composition is associative: log2(chunks) rounds
        maps[:, reach:] = np.take_along_axis(maps[:, reach:], maps[:, :-reach].copy(), 0)
        reach *= 2
    entry = np.zeros(chunks, np.uint8)
    entry[1:] = maps[START, :-1]
    return entry


def piece_bounds(data, offsets):
    """Pieces of texts given as (bytes, offsets): (start bytes, end bytes, text of each piece)."""
    classes, nexts, marks = _tables()
    points, at = code_points(data)
    n_texts = len(offsets) - 1
    cut = np.searchsorted(at, offsets[1:])  # an end symbol after each text's last character
    stream = np.insert(classes[points], cut, END)
    at = np.insert(at, cut, offsets[1:])
    total, width = len(stream), len(CLASSES)
    chunks = -(-total // CHUNK)
    grid = np.full(chunks * CHUNK, END, np.uint8)
    grid[:total] = stream
    grid = np.ascontiguousarray(grid.reshape(chunks, CHUNK).T)
    state = _entry_states(grid, nexts)
    out = np.empty((CHUNK, chunks), np.uint8)
    for i, row in enumerate(grid):
        step = state * np.uint8(width) + row
        out[i] = marks[step]
        state = nexts[step]
    out = out.T.reshape(-1)[:total]
    starts = (out & HERE) != 0
    starts[:-1] |= (out[1:] & BACK) != 0
    ends = stream == END
    place = np.flatnonzero(starts | ends)
    text_of = np.cumsum(ends[place]) - ends[place]
    is_piece = ~ends[place[:-1]] if len(place) else np.zeros(0, bool)
    begin, stop = at[place[:-1]][is_piece], at[place[1:]][is_piece]
    assert n_texts == int(ends.sum())
    return begin, stop, text_of[:-1][is_piece]
