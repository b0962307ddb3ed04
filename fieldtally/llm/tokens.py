"""Token ids of whole texts with a public tokenizer, each distinct piece of text tokenized once per task.

A text is cut before ASCII white space that follows a visible character, and between an ASCII letter and a
punctuation mark. Both tokenizers in use start a new word at these places whatever comes next (white space only
ever opens a word, a run of letters ends at punctuation, no added token is cut, and neither white space nor
ASCII punctuation combines with the character before it), so the ids of a text are those of its pieces, one
after the other.
"""

from __future__ import annotations

import functools
import os

import numpy as np
import pyarrow as pa

from fieldtally.llm.bytescan import Hashed, gather, table

_SPACE = table([(0x20, 0x20), (0x09, 0x0D)])
_SEEN = table([(0x21, 0x7E)])
_LETTER = table([(0x41, 0x5A), (0x61, 0x7A)])
_MARK = table([(ord(c), ord(c)) for c in ".,;:!?()'\"-/"])
#: First byte of the two-byte characters U+00C0 to U+00FF, none of which is white space.
_LATIN = 0xC3
#: An added token of both vocabularies, put between pieces that are tokenized together.
_BETWEEN = "<|endoftext|>"


def vocabulary(name: str) -> str:
    """The place of a public vocabulary file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.lru_cache(maxsize=2)
def _tokenizer(name: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(name if os.path.sep in name else vocabulary(name))


class Encoder:
    """Encodes texts with the vocabulary file `name` (a name of the public set, or a path) and ends each with `end`.

    `kept` bounds the distinct pieces remembered between calls; beyond it only those met again are remembered.
    """

    def __init__(self, name: str, end: int, kept: int = 1_000_000):
        self.tokenizer, self.end, self.kept = _tokenizer(name), end, kept
        self.known = np.zeros(0, np.uint64)  # sorted hashes
        self.start = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)
        self.again = np.zeros(0, bool)
        self.ids = np.zeros(0, np.uint32)

    def _forget(self) -> None:
        keep = self.again if self.again.sum() <= self.kept // 2 else np.zeros(len(self.again), bool)
        length = self.length[keep]
        self.ids = self.ids[gather(self.start[keep], length)]
        self.known, self.length, self.start = self.known[keep], length, np.cumsum(length) - length
        self.again = np.zeros(len(length), bool)

    def _learn(self, new: np.ndarray, pieces: list[str]) -> None:
        sep = self.tokenizer.token_to_id(_BETWEEN)
        plain = [i for i, p in enumerate(pieces) if _BETWEEN not in p] if sep is not None else []
        length, flat = np.zeros(len(pieces), np.int64), {}
        for lo in range(0, len(plain), 4096):
            part = plain[lo: lo + 4096]
            ids = np.array(self.tokenizer.encode(
                _BETWEEN.join(pieces[i] for i in part), add_special_tokens=False).ids, np.uint32)
            edges = np.concatenate([[-1], np.flatnonzero(ids == sep), [len(ids)]])
            length[part] = np.diff(edges) - 1
            flat[part[0]] = ids[ids != sep]
        for i in set(range(len(pieces))).difference(plain):
            flat[i] = np.array(self.tokenizer.encode(pieces[i], add_special_tokens=False).ids, np.uint32)
            length[i] = len(flat[i])
        new, length, flat = self._in_order(new, length, plain, flat)
        start = len(self.ids) + np.cumsum(length) - length
        known = np.concatenate([self.known, new])
        order = np.argsort(known, kind="stable")
        self.known = known[order]
        self.start = np.concatenate([self.start, start])[order]
        self.length = np.concatenate([self.length, length])[order]
        self.again = np.concatenate([self.again, np.zeros(len(length), bool)])[order]
        self.ids = np.concatenate([self.ids, flat])

    @staticmethod
    def _in_order(new, length, plain, flat):
        """Hashes and lengths in the order in which the ids were made: joined pieces first, then the others."""
        rest = sorted(set(range(len(new))).difference(plain))
        order = np.array(plain + rest, np.int64)
        made = [flat[plain[lo]] for lo in range(0, len(plain), 4096)] + [flat[i] for i in rest]
        return new[order], length[order], np.concatenate(made) if made else np.zeros(0, np.uint32)

    def encode(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, end ids included, and where each text's ids start (one more at the end)."""
        n = len(at) - 1
        cut = np.zeros(len(data) + 1, bool)
        if len(data):
            here, before = data[1:], data[:-1]
            seen = _SEEN[before]
            seen[1:] |= (before[1:] >= 0x80) & (data[:-2] == _LATIN)
            cut[1:-1] = (_SPACE[here] & seen) | (_MARK[here] & _LETTER[before])
        cut[at] = True
        edges = np.flatnonzero(cut)
        start, end = edges[:-1], edges[1:]
        hashes = Hashed(data, safe=True).spans(start, end)
        unique, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) > self.kept:
            self._forget()
        spot = np.searchsorted(self.known, unique)
        missing = np.ones(len(unique), bool)
        inside = spot < len(self.known)
        missing[inside] = self.known[spot[inside]] != unique[inside]
        if missing.any():
            raw = data.tobytes()
            at_new = first[missing]
            self._learn(unique[missing], [raw[a:b].decode() for a, b in zip(start[at_new].tolist(), end[at_new].tolist())])
            spot = np.searchsorted(self.known, unique)
        self.again[spot[~missing]] = True
        spot = spot[which]
        length = self.length[spot]
        # ids per text, with one place left for the end id
        owner = np.searchsorted(at, start, side="right") - 1
        per_text = np.bincount(owner, weights=length, minlength=n).astype(np.int64) if n else np.zeros(0, np.int64)
        begins = np.zeros(n + 1, np.int64)
        np.cumsum(per_text + 1, out=begins[1:])
        out = np.empty(int(begins[-1]), np.uint32)
        body = np.ones(len(out), bool)
        body[begins[1:] - 1] = False
        out[body] = self.ids[gather(self.start[spot], length)]
        out[~body] = self.end
        return out, begins


@functools.lru_cache(maxsize=2)
def encoder(name: str, end: int) -> Encoder:
    """The encoder of this Python worker; what it remembers serves the tasks that follow."""
    return Encoder(name, end)


def id_lists(ids: np.ndarray, begins: np.ndarray) -> pa.Array:
    """One binary value per text: its ids as little-endian unsigned 32-bit integers."""
    data = np.ascontiguousarray(ids, "<u4")
    return pa.Array.from_buffers(pa.binary(), len(begins) - 1,
                                 [None, pa.py_buffer((begins * 4).astype(np.int32)), pa.py_buffer(data)])
