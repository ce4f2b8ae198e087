"""Simple-8b: ids packed into 64-bit words.

The top four bits of a word select how many ids of how many bits the other sixty
hold, the first id lowest. Selector 0 is an escape: the next word is one id as it
is. Ids are coded in blocks of 1,024; a block begins a new word, and the offset of
its first word is kept, so that blocks are coded and decoded side by side.
"""

from __future__ import annotations

import numpy as np

BLOCK = 1024
#: Ids per word and bits per id of each selector; selector 0 is the escape.
COUNTS = np.array([1, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([64, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
_AHEAD = 120
_WIDTHS_16 = np.frexp(np.arange(1 << 16, dtype=np.float64))[1].astype(np.uint8)


def _choices(widths: np.ndarray) -> np.ndarray:
    """Selector of the word that would begin at each place: the one that holds most ids.

    A place that fits a selector fits all above it too, which hold fewer and wider ids.
    """
    best = np.where(widths <= 60, 15, 0).astype(np.uint8)
    reach, span = widths, 1
    spans = {1: widths}
    for selector in range(14, 0, -1):
        count = int(COUNTS[selector])
        while span < count:
            step = max(n for n in spans if n <= count - span)
            ahead = np.zeros_like(reach)
            ahead[:, :-span] = spans[step][:, span:]
            reach, span = np.maximum(reach, ahead), span + step
        spans[span] = reach
        best -= reach <= BITS[selector]
    return best


def _widths(ids: np.ndarray) -> np.ndarray:
    if len(ids) and ids.max() < 1 << 16:
        return _WIDTHS_16[ids]
    # rounded up at the most, so that a number of more than 53 bits may take an escape
    return np.frexp(ids.astype(np.float64))[1].astype(np.uint8)


def encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words, and the offset of each block's first word with the number of words at the end."""
    ids = np.asarray(ids, np.uint64)
    blocks = -(-len(ids) // BLOCK)
    if not blocks:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    wide = BLOCK + _AHEAD
    padded = np.zeros((blocks, wide), np.uint64)
    whole = len(ids) // BLOCK
    padded[:whole, :BLOCK] = ids[: whole * BLOCK].reshape(whole, BLOCK)
    if whole < blocks:
        padded[whole, : len(ids) - whole * BLOCK] = ids[whole * BLOCK :]
    flat = padded.reshape(-1)
    choice = _choices(_widths(flat).reshape(blocks, wide)).reshape(-1)
    steps = COUNTS[choice]
    ends = np.arange(blocks) * wide + BLOCK
    ends[-1] -= blocks * BLOCK - len(ids)
    at, begins = np.arange(blocks) * wide, np.zeros(len(flat), bool)
    while len(at):
        begins[at] = True
        at = at + steps[at]
        going = at < ends
        at, ends = at[going], ends[going]
    places = np.flatnonzero(begins)
    selectors = choice[places]
    where = np.r_[0, np.cumsum(np.where(selectors == 0, 2, 1))]
    words = np.zeros(where[-1], np.uint64)
    for selector in np.unique(selectors).tolist():
        mine = np.flatnonzero(selectors == selector)
        from_ = places[mine]
        if selector == 0:
            words[where[mine] + 1] = flat[from_]
            continue
        word = np.full(len(mine), selector << 60, np.uint64)
        for k in range(COUNTS[selector] if BITS[selector] else 0):
            word |= flat[from_ + k] << np.uint64(k * BITS[selector])
        words[where[mine]] = word
    first = np.searchsorted(places, np.arange(blocks) * wide)
    return words, np.r_[where[first], where[-1]]


def decode(words: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ids of ``encode``; all blocks at the same time."""
    blocks = len(offsets) - 1
    selectors = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words), bool)
    for i in np.flatnonzero(selectors == 0):
        if not raw[i]:
            raw[i + 1] = True
    counts = np.where(raw, 0, COUNTS[selectors])
    before = np.r_[0, np.cumsum(counts)]
    block = np.repeat(np.arange(blocks), np.diff(offsets))
    place = block * (BLOCK + _AHEAD) + before[:-1] - before[offsets[:-1]][block]
    out = np.zeros(blocks * (BLOCK + _AHEAD), np.uint64)
    for selector in np.unique(selectors[~raw]):
        mine = np.flatnonzero((selectors == selector) & ~raw)
        if selector == 0:
            out[place[mine]] = words[mine + 1]
            continue
        steps = np.arange(COUNTS[selector])
        mask = np.uint64((1 << int(BITS[selector])) - 1)
        out[place[mine][:, None] + steps] = (words[mine][:, None] >> (steps * BITS[selector]).astype(np.uint64)) & mask
    return out.reshape(blocks, BLOCK + _AHEAD)[:, :BLOCK].reshape(-1)[:n]
