"""Token ids of whole texts, computed inside tasks with the ``tokenizers`` library.

Both public byte-pair vocabularies used here pre-tokenise a text before they
merge bytes, and a pre-token never reaches over a change from a visible
character to a space. The ids of a text are therefore the ids of its
space-led words, one after the other. The distinct words of a run of texts are looked up,
and new ones encoded: letters by the model alone, letters and closing punctuation from the
ids of both, which are pre-tokens of their own, others by the library as a batch.
Texts in which a space touches other white space have pre-tokens that span it;
those are encoded whole.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MEMO_BYTES = 64_000_000
# No apostrophe: the vocabularies split contractions off at it.
CLOSING = '.,;:!?#$%&*()"-'

_ENCODERS: dict[tuple, "WordMemoEncoder"] = {}


class _Letters(dict):
    """For ``str.translate``: what the vocabulary's byte alphabet writes for a character."""

    def __init__(self):
        super().__init__()
        from tokenizers import pre_tokenizers

        self.bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)

    def __missing__(self, code: int) -> str:
        self[code] = self.bytes.pre_tokenize_str(chr(code))[0][0]
        return self[code]


class WordMemoEncoder:
    """Encodes lists of texts to one flat id array and the length of each text.

    ``max_words`` and ``max_bytes``, about, bound what a worker process remembers; it forgets all of it when one
    is reached. Words over ``max_word_chars`` are encoded anew each time.
    """

    def __init__(self, path: str, end_id: int | None = None, max_words: int = 2_000_000, max_bytes: int = MEMO_BYTES, max_word_chars: int = 48):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model, self.normalizer = self.tokenizer.model, self.tokenizer.normalizer
        self.end_id = end_id
        self.max_words, self.max_bytes, self.max_word_chars = max_words, max_bytes, max_word_chars

        self.letters = _Letters()
        self.lead = self.letters[ord(" ")] if self.normalizer is None else ""
        self._forget()

    def _forget(self) -> None:
        self.memo: dict[str, int] = {}  # word to its row in the store
        self.tails: dict[str, list[int]] = {}
        self.flat, self.starts, self.lens = array("I"), array("q"), array("i")
        self.held = 0
        self.end_row = self._store([] if self.end_id is None else [self.end_id])

    def _encode(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _store(self, ids) -> int:
        self.starts.append(len(self.flat))
        self.lens.append(len(ids))
        self.flat.extend(ids)
        return len(self.lens) - 1

    def _learn(self, words: list[str]) -> None:
        """Encodes new words and remembers where the store has their ids."""
        known = self.memo
        stems = {w: w.rstrip(CLOSING) for w in words}
        lettered = [w for w in {*stems.values(), *words} if w not in known and w.isalpha() and len(w) <= self.max_word_chars]
        if self.normalizer is None:
            plain = lettered
        else:  # a letter may be normalised to more than letters
            shown = {w: w.lower() if w.isascii() else self.normalizer.normalize_str(w) for w in lettered}
            lettered = [w for w, own in shown.items() if own.isalpha()]
            plain = [shown[w] for w in lettered]
        tokenize, lead, letters = self.model.tokenize, self.lead, self.letters
        # the byte alphabet writes ASCII letters as they are
        ids = [[t.id for t in tokenize(lead + (w if w.isascii() else w.translate(letters)))] for w in plain]
        self._store_all(lettered, ids)
        parted = [w for w in words if w not in known and stems[w] in known and self._lettered(stems[w])]
        self._store_all(parted, [[*self._ids_at(known[stems[w]]), *self._tail(w[len(stems[w]) :])] for w in parted])
        # a word after a space, or, if it begins with a line break, without one
        whole = [w for w in words if w not in known]
        encoded = self.tokenizer.encode_batch([w if w[0] == "\n" else " " + w for w in whole], add_special_tokens=False)
        self._store_all(whole, [e.ids for e in encoded])

    def _store_all(self, words: list[str], ids: list) -> None:
        lens = array("i", map(len, ids))
        self.memo.update(zip(words, range(len(self.lens), len(self.lens) + len(lens))))
        self.starts.extend(accumulate(lens[:-1], initial=len(self.flat)) if lens else ())
        self.lens.extend(lens)
        self.flat.extend(chain.from_iterable(ids))
        self.held += 200 * len(lens) + sum(map(len, words)) + 4 * sum(lens)

    def _lettered(self, word: str) -> bool:
        """Whether a word is one of letters, also as the vocabulary sees it: closing punctuation is then parted from it."""
        return word.isalpha() and (word.isascii() or self.normalizer is None or self.normalizer.normalize_str(word).isalpha())

    def _ids_at(self, row: int) -> array:
        return self.flat[self.starts[row] : self.starts[row] + self.lens[row]]

    def _tail(self, tail: str) -> list[int]:
        if not tail:
            return []
        if tail not in self.tails:
            if len(tail) > self.max_word_chars:
                return self._encode(tail)
            self.tails[tail] = self._encode(tail)
        return self.tails[tail]

    def _rows(self, words: list[str]) -> np.ndarray:
        """Where the store has the ids of each of these distinct words."""
        rows = list(map(self.memo.get, words))
        new = [n for n, row in enumerate(rows) if row is None]
        self._learn([words[n] for n in new])
        for n in new:
            rows[n] = self.memo[words[n]]
            if len(words[n]) > self.max_word_chars:
                del self.memo[words[n]]
        return np.array(rows, np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts as one uint32 array, and how many belong to each text."""
        if len(self.memo) > self.max_words or self.held > self.max_bytes:
            self._forget()
        # what begins a text, or all of it, is encoded as it is; the words after it are looked up, each distinct one once
        heads, rests = [], []
        for text in texts:
            first, blank, rest = text.partition(" ")
            apart = bool(blank) and self._apart(text)
            heads.append(first if apart else text)
            rests.append(rest if apart else None)
        begin = np.array([self._store(e.ids) for e in self.tokenizer.encode_batch(heads, add_special_tokens=False)], np.int64)
        words = pc.split_pattern(pa.array(rests, pa.large_string()), " ")
        coded = pc.list_flatten(words).dictionary_encode()
        counts = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 2
        index = np.empty(int(counts.sum()), np.int64)  # for every unit of every text, where the store has its ids
        last = np.cumsum(counts) - 1
        between = np.ones(len(index), bool)
        between[last] = between[last - counts + 1] = False
        index[between] = self._rows(coded.dictionary.to_numpy(zero_copy_only=False).tolist())[coded.indices.to_numpy()]
        index[last], index[last - counts + 1] = self.end_row, begin
        flat = np.frombuffer(self.flat, np.uint32) if self.flat else np.zeros(0, np.uint32)
        lens = np.frombuffer(self.lens, np.int32)[index].astype(np.int64)
        ends = np.concatenate(([0], np.cumsum(lens)))
        starts = np.frombuffer(self.starts, np.int64)[index]
        ids = flat[np.repeat(starts - ends[:-1], lens) + np.arange(ends[-1])]
        return ids, np.diff(ends[np.concatenate(([0], np.cumsum(counts)))])

    @staticmethod
    def _apart(text: str) -> bool:
        """Whether every space stands between two visible characters."""
        if "  " in text or text[0] == " " or text[-1] == " ":
            return False
        if text.isprintable():  # of white space, only U+0020 counts as printable
            return True
        lines = text.split("\n")
        if any(x and (x[0] == " " or x[-1] == " ") for x in lines):
            return False
        return all(x.isprintable() for x in lines)


def encoder(path: str, end_id: int | None = None, memo_bytes: int = MEMO_BYTES) -> WordMemoEncoder:
    """The worker's encoder of this vocabulary, which may remember so much; later tasks of the process reuse it."""
    if (path, end_id) not in _ENCODERS:
        _ENCODERS[path, end_id] = WordMemoEncoder(path, end_id)
    _ENCODERS[path, end_id].max_bytes = memo_bytes
    return _ENCODERS[path, end_id]


def runs(texts, most: int = 1_000_000) -> Iterator[tuple[int, int]]:
    """Index ranges of consecutive texts of an Arrow string array with about ``most`` bytes
    together; a longer text stands alone."""
    begin = total = n = 0
    for n, size in enumerate(pc.binary_length(texts).to_pylist()):
        if n > begin and total + size > most:
            yield begin, n
            begin, total = n, 0
        total += size
    if len(texts):
        yield begin, len(texts)
