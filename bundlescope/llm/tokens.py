"""Token ids of whole texts with a public tokenizer."""

from __future__ import annotations

import functools
import os
import string
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from bundlescope.llm.arrow import list_bounds, ragged

#: Distinct chunks whose ids a worker keeps, some 40 bytes each; then it keeps those just used.
CACHED_CHUNKS = 1_500_000
#: Words given to the tokenizer in one string, and strings at once.
GROUP, STRINGS = 16, 2048


def _parts(chunks: pa.Array) -> tuple[list[str], list[str]]:
    """Of each chunk the ASCII word before its last marks, in lower case, and the marks.

    The tokenizer lower-cases, and it parts letters from marks before any merge.
    A chunk that does not begin with an ASCII word stays whole, with no marks.
    """
    stems = pc.ascii_rtrim(chunks, string.punctuation)
    word = pc.ascii_is_alpha(stems)
    heads = pc.if_else(word, pc.ascii_lower(stems), chunks)
    sizes = pc.if_else(word, pc.binary_length(stems), pc.binary_length(chunks))
    marked = pc.less(sizes, pc.binary_length(chunks))
    cuts = sizes.filter(marked).to_numpy().tolist()
    tails = np.full(len(chunks), "", object)
    tails[marked.to_numpy(zero_copy_only=False)] = [c[n:] for c, n in zip(chunks.filter(marked).to_pylist(), cuts)]
    return heads.to_pylist(), tails.tolist()


class _Collision(Exception):
    """Two chunks share the first half of their hashes."""


class Encoder:
    """Ids of texts, by the ids of their chunks between ASCII white space.

    The tokenizer collapses white space and drops it before any merge, so no
    merge crosses a chunk and a text's ids are those of its chunks in a row. Each
    distinct chunk is encoded by the tokenizers library and then looked up, by a
    128-bit hash in a table sorted by the hash's first half; should two chunks share
    that half, the worker starts over with other hashes. That holds for tokenizers that drop white space, lower-case and part letters from other marks, as the default one does.
    """

    def __init__(self, path: str, cached: int = CACHED_CHUNKS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library, self.cached = Tokenizer.from_file(path), cached
        vocabulary = self.library.get_vocab()
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.ends[[n for word, n in vocabulary.items() if word.endswith("</w>")]] = True
        self._start(0)

    def _start(self, seed: int) -> None:
        self.seed, self.pool = seed, np.zeros(0, np.uint32)
        self.keys, self.checks = np.zeros(0, "<u8"), np.zeros(0, "<u8")
        self.starts, self.lengths = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _hashes(self, chunks: list[str]) -> np.ndarray:
        import xxhash

        digest = functools.partial(xxhash.xxh3_128_digest, seed=self.seed)
        return np.frombuffer(b"".join(map(digest, chunks)), "<u8").reshape(-1, 2)

    def _run(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts in a row, and how many each has."""
        ids, lengths = array("I"), []
        for k in range(0, len(texts), STRINGS):
            for found in self.library.encode_batch_fast(texts[k : k + STRINGS], add_special_tokens=False):
                own = found.ids
                ids.extend(own)
                lengths.append(len(own))
        return np.array(ids, np.uint32), np.array(lengths, np.int64)

    def _encoded(self, pieces: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The pieces in another order, their ids in a row, and how many each has.

        Words go in groups. A group with as many word ends as words is cut at
        them; the words of others are encoded alone.
        """
        words = [p for p in pieces if p.isalpha()] if self.ends.any() else []
        alone = [p for p in pieces if not p.isalpha()] if words else pieces
        ids, totals = self._run([" ".join(words[k : k + GROUP]) for k in range(0, len(words), GROUP)])
        sizes = np.full(len(totals), GROUP)
        sizes[-1:] = len(words) - GROUP * (len(totals) - 1)
        stops = np.concatenate([[0], np.cumsum(totals)])
        ended = np.concatenate([[0], np.cumsum(self.ends[ids])])
        good = (np.diff(ended[stops]) == sizes) & (totals > 0)
        if len(ids):
            good &= self.ends[ids[np.maximum(stops[1:] - 1, 0)]]
        if not good.all():
            alone = alone + [w for w, ok in zip(words, np.repeat(good, sizes)) if not ok]
            words = [w for w, ok in zip(words, np.repeat(good, sizes)) if ok]
            ids = ids[np.repeat(good, totals)]
        lengths = np.diff(np.flatnonzero(self.ends[ids]), prepend=-1)
        more, rest = self._run(alone)
        return words + alone, np.concatenate([ids, more]), np.concatenate([lengths, rest])

    def _found(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each chunk is kept, and whether it is."""
        if not len(self.keys):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        order = np.argsort(hashes[:, 0])
        at = np.empty(len(hashes), np.int64)
        at[order] = np.searchsorted(self.keys, hashes[order, 0])
        at = np.minimum(at, len(self.keys) - 1)
        known = self.keys[at] == hashes[:, 0]
        if (self.checks[at[known]] != hashes[known, 1]).any():
            raise _Collision
        return at, known

    def _keep(self, hashes: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> None:
        order = np.argsort(hashes[:, 0])
        at = np.searchsorted(self.keys, hashes[order, 0])
        starts = len(self.pool) + np.cumsum(lengths) - lengths
        self.keys = np.insert(self.keys, at, hashes[order, 0])
        self.checks = np.insert(self.checks, at, hashes[order, 1])
        self.starts = np.insert(self.starts, at, starts[order])
        self.lengths = np.insert(self.lengths, at, lengths[order])
        self.pool = np.concatenate([self.pool, ids])

    def _keep_only(self, slots: np.ndarray) -> None:
        slots = np.unique(slots)
        self.pool = self._ids(slots)
        self.keys, self.checks, self.lengths = self.keys[slots], self.checks[slots], self.lengths[slots]
        self.starts = np.cumsum(self.lengths) - self.lengths

    def _ids(self, slots: np.ndarray) -> np.ndarray:
        return self.pool[ragged(self.starts[slots], self.lengths[slots])]

    def _learn(self, chunks: pa.Array, hashes: np.ndarray) -> None:
        """Keep the ids of chunks that are not kept yet."""
        heads, tails = _parts(chunks)
        pieces = list(dict.fromkeys([*heads, *filter(None, tails)]))
        known = self._found(self._hashes(pieces))[1]
        if not known.all():
            fresh, ids, lengths = self._encoded([p for p, k in zip(pieces, known) if not k])
            self._keep(self._hashes(fresh), ids, lengths)
        left = np.flatnonzero(~self._found(hashes)[1])
        if len(left):
            first = self._found(self._hashes([heads[k] for k in left]))[0]
            marked = np.array([bool(tails[k]) for k in left])
            second = np.zeros(len(left), np.int64)
            second[marked] = self._found(self._hashes([tails[k] for k in left[marked]]))[0]
            slots = np.stack([first, second], axis=1)[np.stack([np.ones_like(marked), marked], axis=1)]
            lengths = self.lengths[first] + np.where(marked, self.lengths[second], 0)
            self._keep(hashes[left], self._ids(slots), lengths)

    def _slots(self, chunks: pa.Array) -> np.ndarray:
        """Where each of these distinct chunks is kept."""
        hashes = self._hashes(chunks.to_pylist())
        at, known = self._found(hashes)
        if not known.all():
            if len(self.keys) + 2 * np.count_nonzero(~known) > self.cached:
                self._keep_only(at[known])
            self._learn(chunks.filter(pa.array(~known)), hashes[~known])
            at, known = self._found(hashes)
            if not known.all():
                raise _Collision
        return at

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids as unsigned 32-bit integers, and each text's bounds in them."""
        lists = pc.ascii_split_whitespace(texts)
        bounds = list_bounds(lists)
        coded = lists.flatten().dictionary_encode()
        try:
            at = self._slots(coded.dictionary)
        except _Collision:
            self._start(self.seed + 1)
            return self.encode(texts)
        slots = at[coded.indices.to_numpy()]
        return self._ids(slots), np.concatenate([[0], np.cumsum(self.lengths[slots])])[bounds]


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The worker's encoder: its chunks stay known from one task to the next."""
    return Encoder(path)


def with_end(ids: np.ndarray, bounds: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The same ids with one end id after each text."""
    out = np.insert(ids, bounds[1:], np.uint32(end))
    return out.astype(np.uint32, copy=False), bounds + np.arange(len(bounds))


def library_path(name: str) -> str:
    """Where a vocabulary file of the installed public tokenizers is."""
    import public_tokenizers

    return public_tokenizers.path(name)
