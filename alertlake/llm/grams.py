"""Character n-grams as whole numbers, and interpolated Kneser-Ney models over them.

Four characters of 16 bits each make one unsigned 64-bit number, so the n-gram's beginning
and end are shifts and masks, and a model is a few sorted arrays.  Characters beyond 16 bits
are folded into that range, where a few of them share a code.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

ORDER = 4
BITS = 16
#: The code of a boundary: between words, and before and after a text.
EDGE = 1


def _fold(points: np.ndarray) -> np.ndarray:
    """Code points as codes from 2 on."""
    wide = 2 + (points.astype(np.uint64) * np.uint64(40503)) % np.uint64(65534)
    return np.where((points < 1 << BITS) & (points > EDGE), points, wide).astype(np.uint16)


@lru_cache(maxsize=1)
def letter_codes() -> np.ndarray:
    """By code point: the code of a letter, else 0."""
    points = np.arange(0x110000, dtype=np.uint32)
    letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return np.where(letters, _fold(points), 0).astype(np.uint16)


@lru_cache(maxsize=1)
def visible_codes() -> np.ndarray:
    """By code point: the code of a character, one for all digits, 0 for white space."""
    points = np.arange(0x110000, dtype=np.uint32)
    codes = _fold(points)
    for i in range(0x3100):
        if chr(i).isspace():
            codes[i] = 0
        elif chr(i).isdigit():
            codes[i] = ord("0")
    return codes


def text_grams(texts: list[str], codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of all texts in a row, and how many each has.

    Runs of characters of code 0 are one boundary.  A text has an n-gram for each code and one
    for its end; those of a text's beginning are filled up with boundaries."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    size = np.array([len(t) for t in texts], np.int64)
    text = np.repeat(np.arange(len(texts)), size)
    code = codes[points]
    begins = np.zeros(len(code), bool)
    begins[(np.cumsum(size) - size)[size > 0]] = True
    keep = code != 0
    keep[1:] |= (code[:-1] != 0) & ~begins[1:]  # the first of a run of zeros, not at a text's beginning
    code, text = code[keep], text[keep]
    code[code == 0] = EDGE
    held = np.bincount(text, minlength=len(texts))
    first = np.cumsum(held + ORDER) - (held + ORDER)
    row = np.full(int((held + ORDER).sum()), EDGE, np.uint64)
    row[np.arange(len(code)) + ORDER * text + (ORDER - 1)] = code
    gram = row.copy()
    for back in range(1, ORDER):
        gram[back:] |= row[:-back] << np.uint64(BITS * back)
    whole = np.ones(len(row), bool)
    for k in range(ORDER - 1):
        whole[first + k] = False
    return gram[whole], held + 1


def _mask(order: int) -> np.uint64:
    return np.uint64((1 << BITS * order) - 1)


def discounts(n: list[int], modified: bool) -> np.ndarray:
    """What is taken off a count of 0, 1, 2, 3 and more, from how many n-grams have the counts 1, 2, 3, 4.

    One discount for all unless ``modified``."""
    y = n[0] / (n[0] + 2 * n[1]) if n[0] and n[1] else 0.5
    if not modified:
        return np.array([0, y, y, y])
    d = [1 - 2 * y * n[1] / n[0] if n[0] else y]
    d.append(2 - 3 * y * n[2] / n[1] if n[1] else d[0])
    d.append(3 - 4 * y * n[3] / n[2] if n[2] else d[1])
    return np.array([0, *np.clip(d, 0.05, [0.95, 1.95, 2.95])])


class Model:
    """An interpolated Kneser-Ney model from the n-grams of the highest order and their counts.

    For each order there are sorted n-grams with what is left of their probability after
    discounting, and sorted contexts with the weight that they leave to the next lower order.
    The lower orders count in how many different contexts an n-gram goes on, and the lowest is
    interpolated with an equal share for every code seen and one for all others."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, modified: bool):
        order = np.argsort(grams)
        grams, counts = grams[order], counts[order]
        self.levels = []
        for k in range(ORDER, 0, -1):
            off = discounts([np.count_nonzero(counts == c) for c in range(1, 5)], modified)[np.minimum(counts, 3)]
            context = grams >> np.uint64(BITS)
            names, first = np.unique(context, return_index=True)
            total = np.add.reduceat(counts, first).astype(float)
            share = (counts - off) / np.repeat(total, np.diff(np.append(first, len(grams))))
            left = np.add.reduceat(off, first) / total
            self.levels.append((grams, share, names, left))
            if k > 1:
                grams, counts = np.unique(grams & _mask(k - 1), return_counts=True)
        self.levels.reverse()
        self.even = 1.0 / (len(self.levels[0][0]) + 1)

    @classmethod
    def of_levels(cls, levels: list[tuple], even: float) -> Model:
        """A model from its tables, lowest order first: n-grams, shares, contexts, what these leave."""
        model = cls.__new__(cls)
        model.levels, model.even = levels, even
        return model

    def log_probability(self, grams: np.ndarray) -> np.ndarray:
        p = np.full(len(grams), self.even)
        for k, (names, share, contexts, left) in enumerate(self.levels, 1):
            at, found = _find(contexts, (grams & _mask(k)) >> np.uint64(BITS))
            weight = np.where(found, left[at], 1.0)
            at, found = _find(names, grams & _mask(k))
            p = np.where(found, share[at], 0.0) + weight * p
        return np.log(p)


def _find(names: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.searchsorted(names, wanted)
    at[at == len(names)] = 0
    return at, names[at] == wanted


class Tally:
    """Counts n-grams, holding each different one once."""

    def __init__(self):
        self.grams, self.counts = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.new: list[np.ndarray] = []
        self.waiting = 0

    def add(self, grams: np.ndarray) -> None:
        self.new.append(grams)
        self.waiting += len(grams)
        if self.waiting > 2_000_000:
            self.close()

    def close(self) -> tuple[np.ndarray, np.ndarray]:
        if self.new:
            grams, counts = np.unique(np.concatenate(self.new), return_counts=True)
            both = np.concatenate([self.grams, grams])
            self.grams, at = np.unique(both, return_inverse=True)
            self.counts = np.bincount(at, np.concatenate([self.counts, counts])).astype(np.int64)
            self.new, self.waiting = [], 0
        return self.grams, self.counts
