"""Search for many words in many texts at once, on UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa

# Bytes of text whose places are looked up at a time, however long a text is.
SEGMENT = 1 << 19
# Texts that are searched together.
ROWS = 512
# Longer words are looked up only where their first bytes stand.
HEAD = 4
BITS = 18

_U64 = np.uint64


class WordSearch:
    """Polynomial hashes of all places, from running sums, are looked up for each length of a word; what has the hash of a
    word is then compared with it byte by byte. Valid UTF-8 holds a word's bytes only where it holds the word."""

    def __init__(self, words: Iterable[str]):
        self.words = sorted(set(words) - {""})
        self.out = pa.array(self.words, pa.string())
        sizes: dict[int, list[int]] = {}
        for k, word in enumerate(self.words):
            sizes.setdefault(len(word.encode()), []).append(k)
        self.longest = max(sizes, default=1)
        flat = {n: np.frombuffer(b"".join(self.words[k].encode() for k in ids), np.uint8).reshape(-1, n) for n, ids in sizes.items()}
        for seed in range(100):
            self._powers(seed)
            self.sizes = {}
            for n, ids in sorted(sizes.items()):
                hashes = self._whole(flat[n])
                order = np.argsort(hashes)
                self.sizes[n] = (hashes[order], flat[n][order], np.array(ids)[order], self._bits(hashes))
            if all(len(np.unique(h)) == len(h) for h, *_ in self.sizes.values()):
                break
        else:
            raise RuntimeError("no seed gives all words hashes of their own")
        self.heads = self._bits(np.concatenate([self._whole(w[:, :HEAD]) for n, w in flat.items() if n >= HEAD] or [np.zeros(0, _U64)]))

    def _powers(self, seed: int) -> None:
        rng = np.random.default_rng(seed)
        self.values = rng.integers(1 << 64, size=256, dtype=_U64)
        base = int(rng.integers(1 << 62)) * 4 + 3
        several = lambda b: np.multiply.accumulate(np.r_[_U64(1), np.full(SEGMENT + self.longest - 1, b, _U64)])
        self.power, self.back = several(base), several(pow(base, -1, 1 << 64))

    def _whole(self, rows: np.ndarray) -> np.ndarray:
        return (self.values[rows] * self.power[: rows.shape[1]]).sum(axis=1, dtype=_U64)

    @staticmethod
    def _bits(hashes: np.ndarray) -> np.ndarray:
        table = np.zeros(1 << BITS, dtype=bool)
        table[hashes >> _U64(64 - BITS)] = True
        return table

    def _segment(self, data: np.ndarray, places: int) -> tuple[np.ndarray, np.ndarray]:
        """Place and word of all hits that begin in the first ``places`` bytes."""
        sums = np.zeros(len(data) + 1, dtype=_U64)
        np.cumsum(self.values[data] * self.power[: len(data)], out=sums[1:])
        at, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        few = None
        for n, (hashes, rows, ids, bits) in self.sizes.items():
            if n > len(data):
                break
            if n < HEAD:
                k = min(places, len(data) - n + 1)
                here = (sums[n : n + k] - sums[:k]) * self.back[:k]
                where = np.flatnonzero(bits[here >> _U64(64 - BITS)])
                here = here[where]
            else:
                if few is None:
                    k = min(places, len(data) - HEAD + 1)
                    few = np.flatnonzero(self.heads[((sums[HEAD : HEAD + k] - sums[:k]) * self.back[:k]) >> _U64(64 - BITS)])
                few = few[: np.searchsorted(few, len(data) - n, "right")]
                here = (sums[few + n] - sums[few]) * self.back[few]
                some = np.flatnonzero(bits[here >> _U64(64 - BITS)])
                where, here = few[some], here[some]
            slot = np.minimum(np.searchsorted(hashes, here), len(hashes) - 1)
            same = hashes[slot] == here
            where, slot = where[same], slot[same]
            for c in range(n):
                same = data[where + c] == rows[slot, c]
                if not same.all():
                    where, slot = where[same], slot[same]
            at.append(where)
            found.append(ids[slot])
        return np.concatenate(at), np.concatenate(found)

    def of_texts(self, texts: pa.Array) -> pa.Array:
        """For each text the words in it, by first place, then by word; null and empty texts have none."""
        parts = [self._few(texts.slice(i, ROWS)) for i in range(0, len(texts), ROWS)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.string()))

    def _few(self, texts: pa.Array) -> pa.Array:
        texts = texts.fill_null("").cast(pa.large_binary())
        _, places, content = texts.buffers()
        ends = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(content, np.uint8)[ends[0] : ends[-1]] if content else np.zeros(0, np.uint8)
        ends = ends - ends[0]
        n_words = max(1, len(self.words))
        size = np.array([len(w.encode()) for w in self.words], dtype=np.int64)
        firsts: dict[str, list[np.ndarray]] = {"key": [], "at": []}
        for start in range(0, len(data), SEGMENT):
            part = data[start : start + SEGMENT + self.longest - 1]
            at, word = self._segment(part, min(SEGMENT, len(data) - start))
            at = at + start
            text = np.searchsorted(ends, at, "right") - 1
            inside = at + size[word] <= ends[text + 1]
            key, at = (text * n_words + word)[inside], at[inside]
            order = np.lexsort((at, key))
            order = order[np.r_[True, np.diff(key[order]) != 0][: len(order)]]
            firsts["key"].append(key[order])
            firsts["at"].append(at[order])
        key, at = (np.concatenate([*firsts[c], np.zeros(0, np.int64)]) for c in ("key", "at"))
        # Segments go on, so of a text in several the first one counts.
        key, first = np.unique(key, return_index=True)
        order = np.lexsort((key, at[first]))
        text, word = key[order] // n_words, key[order] % n_words
        starts = np.searchsorted(text, np.arange(len(texts) + 1))
        return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), self.out.take(pa.array(word)))
