"""Token ids of whole texts, a dictionary look-up a word.

The tokenizer's file splits at white space before anything else and none of its merges or special tokens
holds any, so a text's ids are those of its words one after another (split here at ASCII white space, and before a
stop or comma that ends a word; other white space is left to the tokenizer). Each worker keeps the ids of words it has seen, in bounded
memory, and encodes only new ones.
"""

from __future__ import annotations

import os

import numpy as np

from .common import Grown

DEFAULT_FILE = "word_bpe_49k.json"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(DEFAULT_FILE)


_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def apart(text: bytes) -> list[bytes]:
    """Words of a text, a single stop or comma between an ASCII letter and white space as a word of its own.

    The tokenizer splits there too, and words without their stops repeat far more often.
    """
    data = np.frombuffer(b" " + text + b" ", dtype=np.uint8)
    at = np.flatnonzero((data == 46) | (data == 44))
    if len(at):
        at = at[_LETTER[data[at - 1]] & _SPACE[data[at + 1]]]
        data = np.insert(data, at, 32)
    return data.tobytes().split()


class WordIds(dict):
    """Word in UTF-8 -> its number; where a word's ids begin in a flat store, and how many. New words wait in `fresh` and are
    encoded together."""

    LIMIT = 600_000
    JOIN = 200

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.last[[i for w, i in vocab.items() if w.endswith("</w>")]] = True
        self._empty()

    def _empty(self) -> None:
        self.clear()
        self.fresh: list[bytes] = []
        self.ids, self.start, self.size = Grown(np.uint32), Grown(np.int64), Grown(np.int64)

    def __missing__(self, word: bytes) -> int:
        i = self[word] = len(self)
        self.fresh.append(word)
        return i

    def _encode_fresh(self) -> None:
        """Words of letters are encoded many to a call and told apart by the pieces that end a word; the rest singly."""
        words = [w.decode(errors="replace") for w in self.fresh]
        start, size = np.zeros(len(words), dtype=np.int64), np.zeros(len(words), dtype=np.int64)
        rest = [i for i, w in enumerate(words) if not (w.isalpha() and w.lower().isalpha())]
        plain = np.delete(np.arange(len(words)), rest)
        groups = [plain[k : k + self.JOIN] for k in range(0, len(plain), self.JOIN)]
        joined = self.tokenizer.encode_batch_fast([" ".join([words[i] for i in g.tolist()]) for g in groups], add_special_tokens=False)
        for g, x in zip(groups, joined, strict=True):
            ids = np.array(x.ids, dtype=np.uint32)
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) == len(g) and ends[-1] == len(ids):
                size[g] = np.diff(ends, prepend=0)
                start[g] = self.ids.n + ends - size[g]
                self.ids.add(ids)
            else:
                rest += g.tolist()
        for i, x in zip(rest, self.tokenizer.encode_batch_fast([words[i] for i in rest], add_special_tokens=False), strict=True):
            own = np.array(x.ids, dtype=np.uint32)
            start[i], size[i] = self.ids.n, len(own)
            self.ids.add(own)
        self.start.add(start)
        self.size.add(size)
        self.fresh = []

    def encode(self, texts: list[bytes | None], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of all texts, each followed by end_id, as uint32, and where each text's ids end."""
        if len(self) > self.LIMIT or self.ids.n > 12 * self.LIMIT:
            self._empty()
        words, counts = [], []
        for x in texts:
            mine = apart(x) if x else []
            words += mine
            counts.append(len(mine))
        at = np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))
        if self.fresh:
            self._encode_fresh()
        end_at = self.ids.n
        self.ids.add(np.array([end_id], dtype=np.uint32))
        store = self.ids.all
        self.ids.n = end_at
        # A text's end is one more "word", whose id is the last of the store.
        ends = np.cumsum(counts, dtype=np.int64)
        lo, n = np.insert(self.start.all[at], ends, end_at), np.insert(self.size.all[at], ends, 1)
        total = np.cumsum(n)
        flat = store[np.repeat(lo - total + n, n) + np.arange(total[-1] if len(total) else 0)]
        return flat, total[ends + np.arange(len(ends))]


_OPEN: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    if path not in _OPEN:
        _OPEN[path] = WordIds(path)
    return _OPEN[path]
