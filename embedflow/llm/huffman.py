"""Canonical length-limited Huffman codes for ids: code lengths, bit packing and table-driven decoding.

Ids are packed in lanes of ``LANE``; a lane's bit offset is its checkpoint, so lanes can be decoded apart.
:func:`decode_lanes` looks up the next bits of all lanes at once in one table, id after id.
"""

from __future__ import annotations

import numpy as np

#: Ids from one checkpoint to the next.
LANE = 256
#: Longest code, and codes' bits beyond what equal lengths would take.
MAX_BITS, SLACK = 24, 1


def code_lengths(counts: np.ndarray) -> np.ndarray:
    """Bits of each id's code (uint8; 0: the id does not occur), by package-merge.

    The limit is ``SLACK`` bits over the length that equally long codes would have, and 12 at least, so the
    decoding table stays small.  Equal counts go by id.  A single id gets one bit.
    """
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) == 0:
        return lengths
    if len(used) == 1:
        lengths[used] = 1
        return lengths
    limit = max(12, int(len(used) - 1).bit_length() + SLACK)
    if limit > MAX_BITS:
        raise ValueError(f"{len(used)} different ids are too many for codes of {MAX_BITS} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.int64)
    is_leaf, row = [], np.zeros(0, np.int64)
    for _ in range(limit):
        pairs = row[: len(row) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([leaves, pairs])
        by = np.argsort(both, kind="stable")
        row = both[by]
        is_leaf.append(by < len(leaves))
    taken, depth = 2 * len(leaves) - 2, np.zeros(len(leaves), np.int64)
    for level in reversed(is_leaf):
        n = int(level[:taken].sum())
        depth[:n] += 1
        taken = 2 * (taken - n)
    lengths[order] = depth
    return lengths


def canonical(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(codes, order)``: each id's code (uint32), and the ids by code; both follow from the lengths alone."""
    used = np.flatnonzero(lengths)
    order = used[np.argsort(lengths[used], kind="stable")]
    size = lengths[order].astype(np.int64)
    top = int(size.max(initial=0))
    spans = np.left_shift(1, top - size)
    codes = np.zeros(len(lengths), np.uint32)
    codes[order] = (np.cumsum(spans) - spans) >> (top - size)
    return codes, order


def decoding_table(lengths: np.ndarray) -> tuple[np.ndarray, int]:
    """``(table, bits)``: for every value of the next ``bits`` bits, ``id << 5 | length of its code``."""
    _, order = canonical(lengths)
    size = lengths[order].astype(np.int64)
    bits = int(size.max(initial=1))
    table = np.zeros(1 << bits, np.uint32)
    filled = np.repeat((order.astype(np.uint32) << np.uint32(5)) | size.astype(np.uint32), np.left_shift(1, bits - size))
    table[: len(filled)] = filled
    return table, bits


def pack(ids: np.ndarray, counts: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(data, sizes, lane_bits)`` of runs of ids, ``counts`` ids each.

    Every run begins at a byte of data and takes sizes bytes; lane_bits are the bits (uint16) of its lanes.
    """
    size = lengths[ids].astype(np.int64)
    if len(ids) and not size.min():
        raise ValueError("an id has no code")
    before = np.concatenate([[0], np.cumsum(size)])
    stop = np.cumsum(counts)
    begin = stop - counts
    bits = before[stop] - before[begin]
    sizes = (bits + 7) >> 3
    byte = np.cumsum(sizes) - sizes
    at = before[:-1] + np.repeat(byte * 8 - before[begin], counts)
    # A code lies within two words of 32 bits; bits of different codes never meet, so sums are unions.
    value = codes[ids].astype(np.uint64) << (64 - size - (at & 31)).astype(np.uint64)
    word = at >> 5
    new = np.flatnonzero(np.diff(word, prepend=-1))
    words = np.zeros((int(sizes.sum()) >> 2) + 2, np.uint32)
    if len(new):
        both = np.add.reduceat(value, new)  # of the codes that begin in a word
        words[word[new]] = both >> np.uint64(32)
        words[word[new] + 1] |= both.astype(np.uint32)
    data = words.astype(">u4").view(np.uint8)[: int(sizes.sum())]
    lanes = lane_counts(counts)
    first = np.repeat(begin - (np.cumsum(lanes) - lanes) * LANE, lanes) + np.arange(int(lanes.sum())) * LANE
    last = np.minimum(first + LANE, np.repeat(stop, lanes))
    return data, sizes, (before[last] - before[first]).astype(np.uint16)


def lane_counts(counts: np.ndarray) -> np.ndarray:
    return (counts + LANE - 1) // LANE


def lane_lengths(counts: np.ndarray) -> np.ndarray:
    """Ids of every lane of runs of ``counts`` ids."""
    lanes = lane_counts(counts)
    out = np.full(int(lanes.sum()), LANE, np.int64)
    some = counts > 0
    out[np.cumsum(lanes)[some] - 1] = counts[some] - (lanes[some] - 1) * LANE
    return out


def decode_lanes(data: np.ndarray, at: np.ndarray, size: np.ndarray, table: np.ndarray, bits: int) -> np.ndarray:
    """The ids (uint32) of lanes that begin at bits ``at`` of data and have ``size`` ids, lane after lane."""
    if not len(at):
        return np.zeros(0, np.uint32)
    b = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint32)
    ahead = (b[:-3] << np.uint32(24)) | (b[1:-2] << np.uint32(16)) | (b[2:-1] << np.uint32(8)) | b[3:]
    order = np.argsort(-size, kind="stable")
    pos = at[order].astype(np.int64)
    active = np.searchsorted(-size[order], -np.arange(int(size.max())), "left")  # lanes with more ids than that
    out = np.zeros((len(at), int(size.max())), np.uint32)
    mask = np.uint32((1 << bits) - 1)
    for k, n in enumerate(active.tolist()):
        p = pos[:n]
        entry = table[(ahead[p >> 3] >> (32 - bits - (p & 7)).astype(np.uint32)) & mask]
        out[:n, k] = entry >> np.uint32(5)
        p += entry & np.uint32(31)
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    out = out[back]
    return out[np.arange(out.shape[1]) < size[:, None]]
