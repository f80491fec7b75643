"""Words of a batch of texts as positions in its UTF-8 bytes.

Separators are ASCII in every rule used here, so a word never cuts a character and
byte positions give the same words as code points do. ``A-Z`` are lower-cased first.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Byte -> belongs to a word, for words between blanks and for words of digits, letters
#: and everything beyond ASCII.
NOT_BLANK = np.ones(256, bool)
NOT_BLANK[[9, 10, 11, 12, 13, 32]] = False
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[128:] = ALPHANUMERIC[ord("0"):ord("9") + 1] = ALPHANUMERIC[ord("a"):ord("z") + 1] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32

LONG_WORD = 4096
STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x):
    """A bijection of 64 bits in which every input bit moves every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def text_bytes(texts):
    """The UTF-8 bytes of a text array, one after another, and the bounds of its texts in
    them. Null counts as empty; the array may be a slice."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    return raw[bounds[0]:bounds[-1]], bounds - bounds[0]


class Words:
    """``starts`` and ``ends`` of all words in ``data``; document i has the words
    ``first[i]`` up to ``first[i + 1]``. Null counts as empty."""

    def __init__(self, texts, inside=NOT_BLANK):
        raw, bounds = text_bytes(texts)
        self.data, self.bounds = LOWER[raw], bounds
        member = inside[self.data]
        fresh = self.bounds[self.bounds < len(member)]  # where a document begins
        before = np.empty_like(member)
        before[:1], before[1:] = False, member[:-1]
        before[fresh] = False
        self.starts = np.flatnonzero(member & ~before)
        after = np.empty_like(member)
        after[-1:], after[:-1] = False, member[1:]
        after[fresh[fresh > 0] - 1] = False
        self.ends = np.flatnonzero(member & ~after) + 1
        self.first = np.searchsorted(self.starts, self.bounds)

    def __len__(self):
        return len(self.starts)

    def counts(self):
        return np.diff(self.first)

    def owners(self):
        """The document of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def text(self, i):
        return self.data[self.starts[i]:self.ends[i]].tobytes()

    def hashes(self):
        """A 64-bit hash of each word."""
        padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
        eight = np.ndarray((len(self.data) + 1,), "<u8", padded.data, strides=(1,))
        size = self.ends - self.starts
        keep = np.concatenate([(np.uint64(1) << np.arange(0, 64, 8, dtype=np.uint64)) - np.uint64(1),
                               [np.uint64(0xFFFFFFFFFFFFFFFF)]]).astype(np.uint64)
        found = mix((eight[self.starts] & keep[np.minimum(size, 8)]) ^ (size.astype(np.uint64) * STEP))
        rest, done = np.flatnonzero((size > 8) & (size <= LONG_WORD)), 8
        while len(rest):
            part = eight[self.starts[rest] + done] & keep[np.minimum(size[rest] - done, 8)]
            found[rest] = mix(found[rest] * STEP + part)
            done += 8
            rest = rest[size[rest] > done]
        for i in np.flatnonzero(size > LONG_WORD):
            found[i] = xxhash.xxh3_64_intdigest(self.text(i))
        return found
