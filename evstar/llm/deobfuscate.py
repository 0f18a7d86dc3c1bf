"""Noisy-channel restoration of disguised words.

A disguised token (``1d10t``, ``stuuupid``, ``l o s e r``) is a lattice: each
character may stand for itself or for the letters it imitates, a repeat (of
an imitation too) may be dropped, and a separator between single letters may be dropped. Viterbi
decoding finds the path with the least channel cost plus code length under a
character trigram model of the corpus.
"""

from __future__ import annotations

import re

import numpy as np

#: The letters a character may stand for.
IMITATES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i",
}
SUBSTITUTED, SPLIT, REPEATED, KEPT = 1.0, 0.5, 0.7, 5.0  # channel costs in bits
SYMBOLS = 28  # space, a to z, any other letter
LETTERS = 27

_FAKE = "".join(re.escape(c) for c in IMITATES)
_SEPARATORS = " \t\xa0.-_*"
_SEP = "[" + re.escape(_SEPARATORS) + "]+"
#: A token with an imitation, a letter twice running, or separators between
#: three letters or more.
DISGUISED = re.compile(rf"[{_FAKE}]|([^\W\d_])\1|(?:[^\W\d_]{_SEP}[^\W\d_]{{2}}|[^\W\d_]{{2}}{_SEP}[^\W\d_]|[^\W\d_]{_SEP}[^\W\d_]{_SEP}[^\W\d_])")
_EDGE = ".,;:?\"'*#%&"
_AFTER = re.escape(_EDGE + "!)]}…")
SPACED = re.compile(
    rf"(?:(?<!\S)|(?<=\s[\"'\[])|(?<=^[\"'\[]))(?:[^\W\d_]|[{_FAKE}])(?:{_SEP}(?:[^\W\d_]|[{_FAKE}])){{2,}}(?=[{_AFTER}]*(?:\s|\Z))"
)
#: What every match of ``SPACED`` begins with, in a text after a blank; much
#: cheaper to look for.
_SPACED_BEGINS = re.compile(rf"\s[\"'\[]?\S{_SEP}\S{_SEP}\S(?![^\W\d_])")
_LETTER = re.compile(r"[^\W\d_]")
_RUN = re.compile(r"[^\W\d_]+")


def spaced_runs(text: str) -> list[str]:
    """Runs of single letters or imitations with separators between them."""
    return [m.group() for m in SPACED.finditer(text)] if _SPACED_BEGINS.search(" " + text) else []


def _symbol_table() -> np.ndarray:
    table = np.zeros(256, np.int64)
    table[97:123] = np.arange(1, 27)
    table[192:] = LETTERS  # the first byte of a letter beyond ASCII; the others are dropped
    table[128:192] = -1
    return table


_SYMBOL_OF = _symbol_table()


def trigram_counts(texts: list[str]) -> np.ndarray:
    """Counts of symbol trigrams of lower-cased texts, runs of anything but
    letters being one space."""
    counts = np.zeros(SYMBOLS**3, np.int64)
    data = np.frombuffer("\n\n".join(["", *(t.lower() for t in texts), ""]).encode("utf-8", "surrogatepass"), np.uint8)
    s = _SYMBOL_OF[data]
    s = s[s >= 0]
    s = s[np.r_[True, (s[1:] != 0) | (s[:-1] != 0)]]
    if len(s) >= 3:
        counts += np.bincount((s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:], minlength=SYMBOLS**3)
    return counts


def symbol(c: str) -> int:
    if "a" <= c <= "z":
        return ord(c) - 96
    return LETTERS if c.isalpha() else 0


class Restorer:
    """Decodes tokens under a trigram model given as counts."""

    def __init__(self, counts: np.ndarray) -> None:
        c = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS).astype(float)
        pair = c.sum(axis=0) + 0.5
        lower = pair / pair.sum(axis=1, keepdims=True)
        smooth = c + 8 * lower[None]
        self.bits = (-np.log2(smooth / smooth.sum(axis=2, keepdims=True))).tolist()
        self.known: dict[str, str] = {}

    def _steps(self, text: str, k: int) -> list[tuple[str, float]]:
        """What character ``k`` may emit, with the channel's cost."""
        c, last = text[k], text[k - 1] if k else ""
        if c.isalpha():
            out = [(c, 0.0)]
            if last and (last == c or c in IMITATES.get(last, "")):
                out.append(("", REPEATED))
            return out
        out = [(letter, SUBSTITUTED) for letter in IMITATES.get(c, "")]
        if out and last and (last == c or last in IMITATES[c]):
            out.append(("", REPEATED))
        if c in _SEPARATORS:
            out.append(("", SPLIT))
        out.append((" ", KEPT if out else 0.0))
        return out

    def decode(self, token: str) -> str:
        """The likeliest original of a lower-case token."""
        best: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}
        for k in range(len(token)):
            after: dict[tuple[int, int], tuple[float, tuple]] = {}
            for emitted, channel in self._steps(token, k):
                s = symbol(emitted) if emitted else -1
                for (a, b), (cost, path) in best.items():
                    if s < 0:
                        state, new, way = (a, b), cost + channel, path
                    else:
                        state, new, way = (b, s), cost + channel + self.bits[a][b][s], (path, emitted)
                    if state not in after or new < after[state][0]:
                        after[state] = (new, way)
            best = after
        ended = min(best.items(), key=lambda x: x[1][0] + self.bits[x[0][0]][x[0][1]][0])
        path, out = ended[1][1], []
        while path:
            path, c = path
            out.append(c)
        return "".join(reversed(out))

    def restore(self, token: str) -> str:
        """``decode``, remembered."""
        if token not in self.known:
            if len(self.known) > 100_000:
                self.known.clear()
            self.known[token] = self.decode(token)
        return self.known[token]

    def words(self, token: str) -> set[str]:
        """The words of a token as written and as restored."""
        found = {token} if token.isalpha() else set(_RUN.findall(token))
        core = token.rstrip(_EDGE + "!)]}…").lstrip(_EDGE + "[{")  # without punctuation at the ends
        if _LETTER.search(core) and DISGUISED.search(core):
            for shown in {core, core.lstrip("(")}:  # a bracket or an imitation
                found.update(_RUN.findall(self.restore(shown)))
        return found
