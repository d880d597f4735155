"""Token counts by finite-state transducers compiled from a BPE vocabulary.

Two transducers run one after the other:

* the pre-tokenizer (``pretoken``): chunk state maps composed by a parallel
  prefix scan give the piece boundaries of whole texts;
* the piece transducer compiled here from the merge list. A BPE encoding is
  settled by neighbouring tokens: the last token of a prefix is the one token
  ending there that stands unmerged after the last token of what is left. So a
  state holds, for each start that may still grow into a token, its trie node,
  the last token before it and the tokens emitted since. Reading a byte moves to
  the next state and emits the change of the token count, which is written on
  the transition. States are made deterministic when they are first reached and
  kept; past ``MAX_STATES`` the machine starts over, so memory is bounded while
  counts do not change.

A text's count is the sum over its pieces; special strings inside a text count
as one token each, as the vocabulary's library does by default.
"""

from __future__ import annotations

import functools
import json

import numpy as np
import pyarrow as pa

from tablepipe.llm._text import long_column, map_arrow, slices, utf8_view
from tablepipe.llm.pretoken import piece_bounds

VOCABULARY = "byte_bpe_50k.json"
MAX_STATES = 300_000
CACHE_PIECES = 600_000


def default_path(name=VOCABULARY):
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters():
    """{letter: byte} of byte-level vocabularies: printable bytes stand for
    themselves, the others for the code points from 256 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Machine:
    """Lazily determinised transducer of one merge list.

    A state's entries are packed integers: trie node, token before it (0: none)
    and tokens since (plus 2048: a later byte can lower the count), in that order. ``moves`` maps state * 256 + byte to the
    next state and the change of the count.
    """

    def __init__(self, vocab, merges):
        letters = byte_letters()
        spell = lambda t: bytes(letters[ch] for ch in t)
        names = [bytes([b]) for b in range(256)]
        self.number = {t: i + 1 for i, t in enumerate(names)}
        pairs = []
        for pair in merges:
            a, b = map(spell, pair.split(" ") if isinstance(pair, str) else pair)
            pairs.append((a, b))
            if a + b not in self.number:
                names.append(a + b)
                self.number[a + b] = len(names)
        # how the last (first) part of a token grows: (part, rank of the merge that takes it)
        forever = len(pairs)
        self.last = [()] + [((i + 1, forever),) for i in range(len(names))]
        self.first = list(self.last)
        self.rank, made = {}, {}
        for k, (a, b) in enumerate(pairs):
            x, y, t = self.number[a], self.number[b], self.number[a + b]
            self.rank.setdefault((x, y), k)
            if max(made.get(x, -1), made.get(y, -1)) >= k:
                raise ValueError("a merge uses a token that a later merge makes")
            if t not in made:
                made[t] = k
                self.last[t] = (*self.last[y][:-1], (y, k), (t, forever))
                self.first[t] = (*self.first[x][:-1], (x, k), (t, forever))
        self.trie, self.token = [{}], [0]
        for t in names:
            node = 0
            for b in t:
                if b not in self.trie[node]:
                    self.trie[node][b] = len(self.trie)
                    self.trie.append({})
                    self.token.append(0)
                node = self.trie[node][b]
            self.token[node] = self.number[t]
        self.size = [0, *map(len, names)]
        self.beside: dict = {}
        self.counts: dict = {}
        self.restart()

    def restart(self):
        start = (2048,)
        self.states, self.keys, self.moves = [start], {start: 0}, {}

    def stands(self, before, token):
        """Whether the two tokens stay as they are when encoded together: no part
        at the end of the first merges with one at the start of the second while
        both are there."""
        if not before:
            return True
        key = before << 20 | token
        got = self.beside.get(key)
        if got is None:
            if len(self.beside) > 1_000_000:
                self.beside.clear()
            rank = self.rank
            got = self.beside[key] = not any(
                (r := rank.get((x, y))) is not None and r < x_until and r <= y_until
                for x, x_until in self.last[before] for y, y_until in self.first[token])
        return got

    def move(self, state, b):
        """Compile one transition: next state * 64 + 32 + change of the token count."""
        grown, best, best_since = [], 0, 0
        for entry in self.states[state]:
            node, before, since = entry >> 32, entry >> 12 & 0xFFFFF, (entry & 0xFFF) - 2048
            child = self.trie[node].get(b)
            if child is None:
                continue
            t = self.token[child]
            if t and (not best or self.size[t] > self.size[best]) and self.stands(before, t):
                best, best_since = t, since
            if self.trie[child]:
                grown.append((child, before, since))
        change = 1 - best_since
        key = (*[n << 32 | x << 12 | (s + change + 2048) for n, x, s in grown], best << 12 | 2048)
        nxt = self.keys.get(key)
        if nxt is None:
            nxt = self.keys[key] = len(self.states)
            self.states.append(key)
        step = self.moves[state << 8 | b] = nxt << 6 | (change + 32)
        return step

    def count(self, piece):
        """Tokens of one piece: a walk through the transducer."""
        if len(self.states) > MAX_STATES:
            self.restart()
        state = total = 0
        known = self.moves.get
        for b in piece:
            step = known(state << 8 | b)
            if step is None:
                step = self.move(state, b)
            state = step >> 6
            total += (step & 63) - 32
        return total

    def count_pieces(self, pieces):
        """Token counts of byte strings; each distinct one is walked once while it is cached."""
        known = self.counts
        if len(known) > CACHE_PIECES:
            known.clear()
        for p in set(pieces).difference(known):
            known[p] = self.count(p)
        return [known[p] for p in pieces]


@functools.lru_cache(2)
def machine(path):
    """(transducer, special strings) of a byte-level BPE vocabulary file."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model = spec["model"]
    return Machine(model["vocab"], model["merges"]), tuple(t["content"] for t in spec["added_tokens"])


def count_texts(texts, path):
    """(bytes, tokens) of each text of a string array, as int64 arrays."""
    m, specials = machine(path)
    data, offsets = utf8_view(texts)
    sizes, extra = np.diff(offsets), np.zeros(len(texts), np.int64)
    buf = data.tobytes()
    owner = None
    if any(s.encode() in buf for s in specials):  # cut the texts around special strings
        import re

        cut = re.compile("|".join(re.escape(s) for s in sorted(specials, key=len, reverse=True)))
        parts, owner = [], []
        for i, t in enumerate(texts.to_pylist()):
            own = cut.split(t)
            extra[i] = len(own) - 1
            parts += own
            owner += [i] * len(own)
        data, offsets = utf8_view(pa.array(parts, pa.large_string()))
        buf = data.tobytes()
    begin, stop, text = piece_bounds(data, offsets)
    if owner is not None:
        text = np.asarray(owner, np.int64)[text]
    counts = m.count_pieces([buf[s:e] for s, e in zip(begin.tolist(), stop.tolist())])
    tokens = np.bincount(text, weights=np.asarray(counts, np.float64), minlength=len(sizes)).astype(np.int64)
    return sizes, tokens + extra


def token_counts(df, id_col="doc_id", text_col="text", path=None, limit=1024):
    """One row per document: (id, n_bytes, n_tokens, over_limit).

    Whole texts, no begin or end tokens, no truncation. Null text counts as
    empty (0 bytes, 0 tokens); a null id stays null; repeated rows each give a
    row; other columns are not read. ``path``: a byte-level BPE vocabulary in
    the tokenizers library's format that every executor can open.
    """
    path = path or default_path()

    def run(batches):
        for batch, texts in slices(batches, text_col):
            sizes, tokens = count_texts(texts, path)
            yield pa.RecordBatch.from_arrays(
                [long_column(batch, id_col), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()),
                 pa.array(tokens > limit)], [id_col, "n_bytes", "n_tokens", "over_limit"])

    schema = f"`{id_col}` long, n_bytes long, n_tokens long, over_limit boolean"
    return map_arrow(df.select(id_col, text_col), run, schema)
