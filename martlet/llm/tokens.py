"""Token ids of whole texts, by the ``tokenizers`` library, inside Spark tasks.

Byte-level BPE with the usual pre-tokenising pattern never joins a word to the
space behind it, so a text may be cut before a space and its cuts encoded one
by one, as long as that space does not stand inside a run of white space. Cuts
repeat; each task encodes a cut once and remembers its ids.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: a space inside a run of white space, or at the end of one that ends the text
UNSAFE = re.compile(r"\s (?:\s|\Z)")

#: cuts of a generation (some 200 bytes each); a Python worker holds two, and
#: forgets the older when the newer is full. Affects speed only.
MEMO = 400_000

#: characters numbered at a time: a cut is looked up once among so many
CHARS = 8_000_000


class _Memo:
    """Ids by cut: slot k has ``flat[start[k]:start[k + 1]]``."""

    def __init__(self):
        self.slot: dict[str, int] = {}
        self.flat = np.empty(0, np.uint32)
        self.start = np.zeros(1, np.int64)

    def add(self, cuts: list[str], ids: np.ndarray, size: np.ndarray) -> None:
        first = len(self.start) - 1
        self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(size)])
        self.flat = np.concatenate([self.flat, ids])
        self.slot.update(zip(cuts, range(first, first + len(cuts))))

    def find(self, cuts: list[str]) -> np.ndarray:
        """Slots of cuts, -1 for those that aren't there."""
        return np.fromiter(map(self.slot.get, cuts, repeat(-1)), np.int64, len(cuts))

    def get(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of slots, end to end, and the length of each."""
        begin, size = self.start[at], self.start[at + 1] - self.start[at]
        out = np.cumsum(size)
        return self.flat[np.repeat(begin - out + size, size) + np.arange(out[-1])], size


class Encoder:
    """``encode(texts)`` gives one uint32 array per text, equal to
    ``Tokenizer.encode(text, add_special_tokens=False).ids``."""

    def __init__(self, path: str, memo: int = MEMO):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.memo = memo
        self.spaced = np.array([(self.tokenizer.id_to_token(i) or "").startswith("Ġ")
                                for i in range(self.tokenizer.get_vocab_size())])
        self.old, self.new = _Memo(), _Memo()

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32)
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _joined(self, cuts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of cuts, end to end, and the length of each. None has white space
        at an end, so they are encoded in one text: only the first token of each
        begins with a space."""
        ids = self._plain([" " + " ".join(cuts)])[0]
        begin = np.flatnonzero(self.spaced[ids])
        if len(begin) != len(cuts):
            raise ValueError("the vocabulary joins words to the space behind them")
        return ids, np.diff(np.append(begin, len(ids)))

    def _learn(self, cuts: list[str]) -> None:
        """Put cuts into the memo that aren't there; those of the generation before are copied."""
        at = self.old.find(cuts)
        if (at >= 0).any():
            self.new.add([c for c, k in zip(cuts, at.tolist()) if k >= 0], *self.old.get(at[at >= 0]))
            cuts = [c for c, k in zip(cuts, at.tolist()) if k < 0]
        even = [c for c in cuts if c and c == c.strip()]
        got = [self._joined(even[i:i + 500]) for i in range(0, len(even), 500)]
        if len(even) < len(cuts):
            odd = [c for c in cuts if not c or c != c.strip()]
            plain = self._plain([" " + c for c in odd])
            got.append((np.concatenate(plain), np.array([len(x) for x in plain], np.int64)))
            even += odd
        if got:
            self.new.add(even, *(np.concatenate(x) for x in zip(*got)))

    def _ids(self, cuts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all cuts, each with a space before it, end to end; the length
        of each. Cuts are numbered by Arrow first: each word is looked up once."""
        if not len(cuts):
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        numbered = cuts.dictionary_encode()
        words = numbered.dictionary.to_numpy(zero_copy_only=False).tolist()  # several times as fast as to_pylist
        at = self.new.find(words)
        if (at < 0).any():
            if len(self.new.slot) > self.memo:
                self.old, self.new = self.new, _Memo()
                at[:] = -1
            new = [c for c, k in zip(words, at.tolist()) if k < 0]
            self._learn(new)
            at[at < 0] = self.new.find(new)
        return self.new.get(at[numbered.indices.to_numpy()])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if not texts:
            return []
        unsafe = [UNSAFE.search(t) is not None for t in texts]
        lists = pc.split_pattern(pa.array(["" if u else t for t, u in zip(texts, unsafe)]), " ")
        first = lists.offsets.to_numpy().astype(np.int64)
        values = lists.flatten()
        rest = np.ones(len(values), bool)
        rest[first[:-1]] = False
        # a text's first cut has no space before it; one that can't be cut is encoded whole
        heads = [t if u else h for t, u, h in zip(texts, unsafe, values.take(pa.array(first[:-1])).to_pylist())]
        flat, size = self._ids(values.filter(pa.array(rest)))
        edge = np.concatenate([[0], np.cumsum(size)])[first - np.arange(len(first))].astype(np.int64)
        return [np.concatenate([h, flat[a:b]]) for h, a, b in zip(self._plain(heads), edge[:-1], edge[1:])]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per Python worker and vocabulary."""
    return Encoder(path)


def groups(texts: pa.Array, chars: int = 2_000_000):
    """Lists of texts of about ``chars`` characters, with the place of the
    first; null counts as empty. No more than a list of them is in Python at a time."""
    begin, held, n = 0, [], 0
    for i in range(0, len(texts), 64):
        for t in texts.slice(i, 64).to_pylist():
            t = t or ""
            if held and n + len(t) > chars:
                yield begin, held
                begin, held, n = begin + len(held), [], 0
            held.append(t)
            n += len(t)
    if held:
        yield begin, held
