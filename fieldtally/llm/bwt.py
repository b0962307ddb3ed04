"""Burrows-Wheeler transforms of sets of strings, and their merge by refinement of an interleave.

A shard is a set of byte strings, each ended by a terminator smaller than all bytes and different from all other
terminators. Its transform lists, for all suffixes in order, the byte before each. Transforms are merged without
sorting suffixes again: an interleave says from which shard each suffix of the merged order comes, and refining it
puts the merged suffixes in order of twice as many bytes, by a merge of the shards' orders. Blocks of suffixes that
the refinements have not told apart give the common prefixes; suffixes that share `length` bytes form an interval of
a repeated string of that length.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

_END = 0  # the terminator; symbols are 1 .. the number of different bytes, in byte order


class Shard(NamedTuple):
    bwt: np.ndarray  # the symbol before each suffix in suffix order, 0 for the first of a string
    back: np.ndarray  # the place, in suffix order, of the suffix one symbol longer (of no meaning where bwt is 0)
    order: np.ndarray  # where each suffix starts in the shard's text


def build(text: np.ndarray, length: int) -> Shard:
    """The transform of `text`, strings of symbols each ended by 0, with suffixes in order of their first `length` symbols.

    Suffixes are ordered by doubling: a rank for a few symbols, then for twice as many and so on. Which of two equal
    suffixes with different terminators comes first is of no account.
    """
    n = len(text)
    bits = 8 if text.dtype == np.uint8 else 9
    done = 64 // bits
    ends = np.flatnonzero(text == _END)
    at = np.arange(n)
    left = ends[np.searchsorted(ends, at)] - at  # symbols up to the terminator, which tells suffixes apart
    value = np.zeros(n, np.uint64)
    for i in range(done):
        value <<= np.uint64(bits)
        m = max(0, n - i)
        value[:m] |= text[i:].astype(np.uint64) * (left[:m] >= i)

    def ranked(order: np.ndarray, same: np.ndarray) -> np.ndarray:
        rank = np.zeros(n, np.int64)
        rank[order[1:]] = np.cumsum(~same)
        return rank

    order = np.argsort(value)
    v, told = value[order], left[order] < done
    rank = ranked(order, (v[1:] == v[:-1]) & ~(told[1:] & told[:-1]))
    while done < length and rank.max(initial=0) < n - 1:
        after = np.zeros(n, np.int64)
        after[: max(0, n - done)] = rank[done:] + 1
        after[left < done] = 0
        pair = rank * (n + 1) + after
        order = np.argsort(pair)
        p = pair[order]
        rank = ranked(order, p[1:] == p[:-1])
        done *= 2
    # suffixes that are still alike need one order: a permutation, the same for `order` and `back`
    place = np.empty(n, np.int32)
    place[order] = np.arange(n)
    return Shard(text[order - 1], place[order - 1], order)


def merge(shards: list[Shard], length: int, prefixes: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """The merged order by `length` symbols, and common prefixes.

    Returns, for each place of the merged order, the number of its suffix among all shards' suffixes put one after
    the other, and how many symbols it shares with its predecessor (`length`: so many at least). Without
    `prefixes` only those are counted that share `length`; the others are given as 0.

    The interleave starts as the order by the first symbol, which the transforms tell by themselves. A refinement
    knows for each suffix its block in the order by k symbols and, through the transforms, the block of the suffix k
    symbols on; the two put it in order of 2k symbols. Each shard's suffixes already are in that order, so the
    refined interleave is a merge of the shards' sorted runs and nothing is sorted again. The last refinement looks
    on by what is missing to `length`.
    """
    sizes = [len(s.bwt) for s in shards]
    n = sum(sizes)
    first = np.cumsum(sizes) - sizes
    bwt = np.concatenate([s.bwt for s in shards])
    back = np.concatenate([s.back + np.int32(a) for s, a in zip(shards, first)])
    # blocks by the first symbol: terminators differ from each other, in order of shard and string
    block = np.concatenate([np.sort(s.bwt, kind="stable") for s in shards]).astype(np.int64)
    ends = np.flatnonzero(block == _END)
    symbols, block = np.unique(block, return_inverse=True)
    block += len(ends) - int(len(symbols) > 0 and symbols[0] == _END)
    block[ends] = np.arange(len(ends))
    # where the suffix k symbols on lies; -1 beyond the end of a string, where suffixes are told apart already
    on = np.full(n, -1, np.int32)
    inner = np.flatnonzero(bwt != _END)
    on[back[inner]] = inner
    block = block.astype(np.int32)
    known, steps, jumps = 1, [block], [on]
    interleave = np.argsort(block, kind="stable")
    while known < length:
        k = min(known, length - known)
        jump = jumps[-1] if k == known else _jump(jumps, k)
        after = block[jump]
        after += 1
        after[jump < 0] = 0
        key = block.astype(np.int64)
        key *= n + 1
        key += after
        interleave = np.argsort(key, kind="stable")  # merges the shards' runs, in which keys ascend
        key = key[interleave]
        told = np.zeros(n, np.int32)
        np.cumsum(key[1:] != key[:-1], out=told[1:])
        block = np.empty(n, np.int32)
        block[interleave] = told
        known += k
        if prefixes:
            steps.append(block)
        if n == 0 or block[interleave[-1]] == n - 1:
            break
        if known < length:
            jumps.append(_further(jumps[-1], jumps[-1]))
    common = np.zeros(n, np.uint16)
    here, before = interleave[1:], interleave[:-1]
    common[1:][block[here] == block[before]] = length
    if prefixes:
        _count_shared(common, here, before, steps, jumps, length)
    return interleave.astype(np.int32), common


def _further(jump: np.ndarray, then: np.ndarray) -> np.ndarray:
    """One jump and then another, -1 where either leaves the string."""
    out = then[jump]
    out[jump < 0] = -1
    return out


def _jump(jumps: list[np.ndarray], k: int) -> np.ndarray:
    """Where the suffix k symbols on lies, from jumps of 1, 2, 4 ... symbols."""
    out = np.arange(len(jumps[0]), dtype=np.int32)
    for i, jump in enumerate(jumps):
        if k >> i & 1:
            out = _further(out, jump)
    return out


def _count_shared(common: np.ndarray, here: np.ndarray, before: np.ndarray, steps: list[np.ndarray],
                  jumps: list[np.ndarray], length: int) -> None:
    """Common prefixes of neighbours that share less than `length`: the largest blocks that they share, one after the other."""
    at = np.flatnonzero(common[1:] < length)
    a, b = here[at], before[at]
    for i in range(min(len(steps), len(jumps)) - 1, -1, -1):
        same = (a >= 0) & (b >= 0)
        same[same] = steps[i][a[same]] == steps[i][b[same]]
        common[1:][at[same]] += np.uint16(1 << i)
        a[same], b[same] = jumps[i][a[same]], jumps[i][b[same]]


def least_by_repeat(strings: list[bytes], values: np.ndarray, length: int, shard_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """For each place of each string where `length` bytes start, the least value of a string that holds them.

    Returns the numbers of all strings one after the other and where each string's begin; the last `length` places
    of a string, terminator included, mean nothing. Strings are dealt into shards of about `shard_bytes`, two at
    least if there are two strings, whose transforms are built and merged.
    """
    sizes = np.array([len(s) + 1 for s in strings])
    raw = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8)
    begins = np.cumsum(sizes) - sizes
    seen = np.flatnonzero(np.bincount(raw, minlength=256))
    codes = np.zeros(256, np.uint8 if len(seen) < 256 else np.uint16)
    codes[seen] = np.arange(1, len(seen) + 1)
    text = codes[raw]
    text[begins + sizes - 1] = _END
    n_shards = min(len(strings), max(2, -(-len(text) // shard_bytes)))
    cuts = begins[[len(strings) * i // n_shards for i in range(n_shards)]].tolist() + [len(text)]
    shards = [build(text[a:b], length) for a, b in zip(cuts, cuts[1:])]
    suffix, common = merge(shards, length, prefixes=False)
    place = np.concatenate([s.order + a for s, a in zip(shards, cuts)])[suffix]
    value = np.repeat(values, sizes)[place]
    first = np.flatnonzero(common < length)  # repeated intervals begin where less is shared
    least = np.empty(len(text), np.int64)
    least[place] = np.repeat(np.minimum.reduceat(value, first), np.diff(np.append(first, len(text))))
    return least, begins
