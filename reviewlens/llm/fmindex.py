"""Two-way full-text index over a delimited vocabulary, searched for words one error away.

A word one edit away from a query has the query's first half as its own beginning or its second half as its own end:
one error cannot touch both. So there are two searches, each of which matches one half exactly and extends across the
other allowing one error: the first reads words from the left, the second from the right. A `Reader` is the index for
one reading direction: it holds the suffix order of the words written against it, so every step of reading narrows an
interval of suffix ranks. All states of many queries step together, as arrays.
"""

from __future__ import annotations

import numpy as np

#: Letters packed into the first sort key of a suffix, seven bits each.
_PACKED, _BITS = 9, 7


class Reader:
    """Rank intervals over words (bytes, distinct, without byte 0), which are read from their first byte on."""

    def __init__(self, words: list[bytes]):
        turned = sorted(word[::-1] for word in words)
        joined = np.frombuffer(b"\0" + b"".join(word + b"\0" for word in turned), np.uint8)
        letters = np.unique(joined)
        letters = letters[letters > 0]
        if len(letters) >= 1 << _BITS:
            raise ValueError("more letters than the packed sort key can hold")
        self.code = np.full(256, -1, np.int64)
        self.code[letters] = np.arange(1, len(letters) + 1)
        self.code[0] = 0
        text = self.code[joined]
        order = _suffix_order(text)
        self.before = text[order - 1]
        self.rows, self.letters = len(text), len(letters)
        # Rank of (letter, row) among all sorted pairs: where the letter's suffixes begin plus those before the row.
        self.pairs = np.sort(self.before * (self.rows + 1) + np.arange(self.rows))
        self.words = [word[::-1] for word in turned]
        self.all = (0, len(turned) + 1)

    def step(self, lo: np.ndarray, hi: np.ndarray, letter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals after reading one more letter; empty ones for letters that no word has (-1)."""
        base = letter * (self.rows + 1)
        low = np.searchsorted(self.pairs, base + lo)
        high = np.searchsorted(self.pairs, base + hi)
        return low, np.where(letter < 0, low, high)

    def branches(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(state, letter) of every letter, ends aside, that can be read next in the intervals."""
        size, narrow = hi - lo, (hi - lo) <= self.letters
        wide = np.flatnonzero(~narrow)
        few = np.flatnonzero(narrow)
        state = np.repeat(few, size[few])
        within = np.arange(len(state)) - np.repeat(np.cumsum(size[few]) - size[few], size[few])
        pair = np.unique(state * (1 << _BITS) + self.before[lo[state] + within])
        pair = pair[pair % (1 << _BITS) > 0]
        every = np.arange(1, self.letters + 1)
        return (np.concatenate([pair >> _BITS, np.repeat(wide, self.letters)]),
                np.concatenate([pair % (1 << _BITS), np.tile(every, len(wide))]))


def _suffix_order(text: np.ndarray) -> np.ndarray:
    """Places of the text in the order of what follows them up to the next end (0); equal ones in order of place."""
    n = len(text)
    padded, key, alive = np.concatenate([text, np.zeros(_PACKED, np.int64)]), np.zeros(n, np.int64), np.ones(n, bool)
    for k in range(_PACKED):
        letter = padded[k : k + n]
        alive &= letter > 0
        key |= np.where(alive, letter, 0) << (_BITS * (_PACKED - 1 - k))
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    size = np.diff(np.append(first, n))
    open_group = (size > 1) & (ranked[first] % (1 << _BITS) > 0)
    # A suffix that ends within the key has its final rank; one that goes on has the rank its group begins at.
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    slots = np.flatnonzero(np.repeat(open_group, size))
    rank[order[slots]] = np.repeat(first[open_group], size[open_group])
    depth = _PACKED
    while len(slots):
        places = order[slots]
        head, tail = rank[places], rank[places + depth]
        by = np.lexsort((places, tail, head))
        places, head, tail = places[by], head[by], tail[by]
        order[slots] = places
        new = np.concatenate([[True], (head[1:] != head[:-1]) | (tail[1:] != tail[:-1])])
        begin = np.flatnonzero(new)
        size = np.diff(np.append(begin, len(places)))
        rank[places] = np.repeat(slots[begin], size)
        again = np.repeat(size > 1, size)
        slots, depth = slots[again], depth * 2
    return order


def one_error(reader: Reader, queries: list[bytes], exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, word) places of all words one edit from a query that share its first `exact` letters; each pair once.

    Of equal edits within a run of one letter the last is taken, which stays behind the exact part.
    """
    length = np.fromiter(map(len, queries), np.int64, len(queries))
    flat = reader.code[np.frombuffer(b"".join(q + b"\0" for q in queries), np.uint8)]
    start = np.cumsum(length + 1) - (length + 1)
    query = np.arange(len(queries))
    lo, hi = np.full(len(queries), reader.all[0]), np.full(len(queries), reader.all[1])
    at = np.zeros(len(queries), np.int64)
    while (reading := np.flatnonzero((at < exact[query]) & (lo < hi))).size:
        lo[reading], hi[reading] = reader.step(lo[reading], hi[reading], flat[start[reading] + at[reading]])
        at[reading] += 1
    clean = _alive(query, at, lo, hi)
    wrong = _alive(*(np.zeros(0, np.int64),) * 4)
    found_query, found_word = [wrong[0]], [wrong[0]]
    while clean[0].size or wrong[0].size:
        query, at, lo, hi = wrong
        low, high = reader.step(lo, hi, flat[start[query] + at])
        # Words are distinct, so an ended one is a single row: that of the end before it, counted from 1. Row 0 is the
        # empty word, which is none.
        ends = (at == length[query]) & (low < high) & (low > 0)
        found_query.append(query[ends])
        found_word.append(low[ends] - 1)
        on = at < length[query]
        states = [_alive(query[on], at[on] + 1, low[on], high[on])]
        query, at, lo, hi = clean
        if query.size:
            here = flat[start[query] + at]
            inside = at < length[query]
            state, letter = reader.branches(lo, hi)
            other = letter != here[state]
            state, letter = state[other], letter[other]
            low, high = reader.step(lo[state], hi[state], letter)
            swapped = inside[state]
            states.append(_alive(query[state], at[state], low, high))
            states.append(_alive(query[state][swapped], at[state][swapped] + 1, low[swapped], high[swapped]))
            query, at, lo, hi, here = (a[inside] for a in (query, at, lo, hi, here))
            last = here != flat[start[query] + at + 1]
            states.append(_alive(query[last], at[last] + 1, lo[last], hi[last]))
            clean = _alive(query, at + 1, *reader.step(lo, hi, here))
        wrong = tuple(np.concatenate(parts) for parts in zip(*states))
    return np.concatenate(found_query), np.concatenate(found_word)


def _alive(query, at, lo, hi):
    keep = lo < hi
    return query[keep], at[keep], lo[keep], hi[keep]
