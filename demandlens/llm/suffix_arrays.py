"""Benchmark decontamination with suffix arrays over shards of the documents.

Each shard (a few MB of text inside a task) turns its words into ids of the benchmark's
vocabulary. Words outside it can be in no match, so only runs of known words that are long
enough for some window are kept, and a suffix array is built over them. Every suffix of
every benchmark item is then narrowed down in that array by binary search, one word at a
time, for all suffixes at once: the interval at a window's length holds all occurrences of
that window, the last interval that is not empty the longest verbatim matches.

The benchmark is sent to the tasks in blocks of bounded size, one at a time; documents pass from
block to block through the shared folder, without a shuffle. Words and windows are
compared by 64-bit hashes.
"""

from math import ceil

import numpy as np
import pyarrow as pa
from demandlens.llm.frames import fresh, steps, stored
from demandlens.llm.words import ALPHANUMERIC, STEP, Words, mix
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

WINDOW = 10
#: Bytes of benchmark text that are held by the driver and each task at a time.
BLOCK_BYTES = 8 << 20
SIEVE = 1 << 16


class TestSuffixes:
    """The items of one block: word ids one after another, and the windows among them."""

    def __init__(self, items, texts, window):
        words = Words(texts, ALPHANUMERIC)
        hashes = words.hashes()
        self.items = items
        self.vocabulary, ids = np.unique(hashes, return_inverse=True)
        self.ids = ids.astype(np.int64) + 1
        self.sieve = np.zeros(SIEVE, bool)
        self.sieve[(self.vocabulary & np.uint64(SIEVE - 1)).astype(np.int64)] = True
        self.owner = words.owners()
        counts = words.counts()
        at = np.arange(len(self.ids)) - np.repeat(words.first[:-1], counts)
        own = np.repeat(counts, counts)
        self.left = own - at  # words from here to the item's end
        self.begin = at == 0
        short = np.where(self.begin & (own < window), own, 0)
        self.window = np.where(self.left >= window, window, short)  # 0: no window starts here
        self.shortest = int(self.window[self.window > 0].min(initial=window))
        self.longest = int(counts.max(initial=0))
        self._group(window)

    def _group(self, window):
        """``group``: the number of each different window (-1 where none starts), ``first_of``
        marks one place of each, and ``holders`` lists the items of group g between
        ``bounds[g]`` and ``bounds[g + 1]``."""
        places = np.flatnonzero(self.window > 0)
        key = self.window[places].astype(np.uint64) * STEP
        padded = np.concatenate([self.ids, np.zeros(window, np.int64)]).astype(np.uint64)
        for k in range(window):
            word = np.where(k < self.window[places], padded[places + k], np.uint64(0))
            key = mix(key * STEP + word)
        _, first, number = np.unique(key, return_index=True, return_inverse=True)
        self.group, self.first_of = np.full(len(self.ids), -1), np.zeros(len(self.ids), bool)
        self.group[places], self.first_of[places[first]] = number, True
        pairs = np.unique(number * max(len(self.items), 1) + self.owner[places])
        self.holders = pairs % max(len(self.items), 1)
        self.bounds = np.searchsorted(pairs // max(len(self.items), 1), np.arange(len(first) + 1))

    def items_of(self, groups):
        """The ids of the items that hold any of the windows ``groups``."""
        numbers = {i for g in groups for i in self.holders[self.bounds[g]:self.bounds[g + 1]].tolist()}
        return {self.items[i] for i in numbers} - {None}

    def known(self, hashes):
        """The id of each hash, 0 for words of no item."""
        found = np.zeros(len(hashes), np.int64)
        maybe = np.flatnonzero(self.sieve[(hashes & np.uint64(SIEVE - 1)).astype(np.int64)])
        if len(maybe):
            at = np.minimum(np.searchsorted(self.vocabulary, hashes[maybe]), len(self.vocabulary) - 1)
            hit = self.vocabulary[at] == hashes[maybe]
            found[maybe[hit]] = at[hit] + 1
        return found


class Shard:
    """The suffix array over the runs of known words of some documents.

    ``ids`` are the runs, each closed by a 0, ``word`` the word number of each place,
    ``order`` the places of words sorted by what follows up to the end of their run.
    """

    def __init__(self, known, first, shortest, longest):
        place = known > 0
        opens = place.copy()
        opens[1:] &= ~place[:-1]
        begins = first[:-1][first[:-1] < len(known)]
        opens[begins] = place[begins]
        starts = np.flatnonzero(opens)
        closes = place.copy()
        closes[:-1] &= ~place[1:]
        last = begins[begins > 0] - 1
        closes[last] = place[last]
        lengths = np.flatnonzero(closes) + 1 - starts
        starts, lengths = starts[lengths >= shortest], lengths[lengths >= shortest]
        size = int(lengths.sum() + len(lengths))
        begin = np.cumsum(lengths + 1) - (lengths + 1)
        self.word = np.arange(size) - np.repeat(begin, lengths + 1) + np.repeat(starts, lengths + 1)
        self.ids = np.zeros(size, np.int64)
        inside = np.ones(size, bool)
        inside[begin + lengths] = False
        self.ids[inside] = known[self.word[inside]]
        self.order = np.flatnonzero(inside)
        rank, step = self.ids.copy(), 1
        while step < longest and size:
            ahead = np.zeros(size, np.int64)
            ahead[:-step] = rank[step:] if step < size else 0
            _, after = np.unique(np.where(inside, rank * (size + rank.max() + 1) + ahead, 0), return_inverse=True)
            if (after == rank).all():
                break
            rank, step = after.astype(np.int64), 2 * step
        self.order = self.order[np.argsort(rank[self.order], kind="stable")]

    def bound(self, low, high, depth, target, above):
        """The first place in [low, high) of the array whose word at ``depth`` is not
        below ``target`` (with ``above``: is beyond it), for many intervals at once."""
        low, high = low.copy(), high.copy()
        while True:
            active = np.flatnonzero(low < high)
            if not len(active):
                return low
            middle = (low[active] + high[active]) // 2
            value = self.ids[self.order[middle] + depth]
            right = value <= target[active] if above else value < target[active]
            low[active[right]] = middle[right] + 1
            high[active[~right]] = middle[~right]


def spread(low, high):
    """(row, place) for every place of every interval."""
    sizes = high - low
    rows = np.repeat(np.arange(len(low)), sizes)
    return rows, np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(low, sizes)


def search(test, shard, want_longest=True):
    """Narrow all test suffixes down in a shard.

    Returns the occurrences of windows as (test place, document word, length), each different
    window at one of its test places only, and the longest matches of at least a window
    likewise, for every suffix; without ``want_longest`` a suffix is done at its window.
    """
    suffix = np.arange(len(test.ids)) if want_longest else np.flatnonzero(test.first_of)
    low, high = np.zeros(len(suffix), np.int64), np.full(len(suffix), len(shard.order), np.int64)
    windows, longest, depth = [], [], 0

    def report(to, rows, lows, highs):
        at, place = spread(lows, highs)
        to.append((rows[at], shard.word[shard.order[place]], np.full(len(at), depth)))

    while len(suffix):
        target = test.ids[suffix + depth]
        below = shard.bound(low, high, depth, target, False)
        beyond = shard.bound(below, high, depth, target, True)
        found = below < beyond
        if want_longest:
            ended = ~found & (depth >= test.window[suffix]) & (test.window[suffix] > 0)
            report(longest, suffix[ended], low[ended], high[ended])
        suffix, low, high, depth = suffix[found], below[found], beyond[found], depth + 1
        whole = (test.window[suffix] == depth) & test.first_of[suffix]
        report(windows, suffix[whole], low[whole], high[whole])
        done = test.left[suffix] == depth
        if want_longest:
            full = done & (test.window[suffix] > 0)
            report(longest, suffix[full], low[full], high[full])
        else:
            done |= test.window[suffix] <= depth
        suffix, low, high = suffix[~done], low[~done], high[~done]
    return [[np.concatenate(x) if x else np.empty(0, np.int64) for x in zip(*part)] or [np.empty(0, np.int64)] * 3
            for part in (windows, longest)]


def blocks(benchmark, item_id, text, window, limit):
    """The benchmark as ``TestSuffixes`` of about ``limit`` bytes of text each."""
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(text).alias("text")).where("text <> ''")
    total = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    count = ceil(total / limit)
    for i in range(count):
        rows = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(count)) == i).toArrow()
        rows = rows.combine_chunks()
        if rows.num_rows:
            yield TestSuffixes(rows.column("item").to_pylist(),
                               pa.concat_arrays(rows.column("text").chunks), window)


def hits(docs, benchmark, window=WINDOW, text="text", item_id="item_id", item_text="text",
         names=("n_words", "n_hit", "items"), block_bytes=BLOCK_BYTES):
    """``docs`` plus its number of words, of words inside a window's occurrence, and the
    sorted ids (as text) of the items with an occurring window.

    A window is ``window`` consecutive words of an item, or the whole item where it has
    fewer. Null texts have no words; items without words have no windows; an item without
    an id marks words but is not listed. Items that repeat count once. ``names`` get
    leading underscores where ``docs`` has such columns. An empty benchmark hits nothing.
    """
    out = []
    for name in names:
        out.append(fresh(docs.columns + out, name))
    spans = fresh(docs.columns + out, "spans")
    kept = docs.columns
    schema = StructType(list(docs.schema.fields))
    schema = (schema.add(out[0], LongType()).add(out[1], LongType()).add(out[2], ArrayType(StringType()))
              .add(spans, ArrayType(LongType())))
    tests, number, shared = blocks(benchmark, item_id, item_text, window, block_bytes), 0, None
    test = next(tests, None)
    while number == 0 or test is not None:
        if shared is not None:  # the block before is written and let go
            docs = stored(docs, "hits")
            shared.destroy()
        shared = docs.sparkSession.sparkContext.broadcast(test)

        def each(batches, shared=shared, later=number > 0):
            test = shared.value
            for part in steps(batches, text):
                words = Words(part.column(text), ALPHANUMERIC)
                counts, first = words.counts(), words.first
                edge = np.zeros(len(words) + 1, np.int64)
                listed = [set() for _ in range(part.num_rows)]
                if later:
                    for i, (own, old) in enumerate(zip(part.column(out[2]).to_pylist(),
                                                       part.column(spans).to_pylist())):
                        listed[i] |= set(own)
                        np.add.at(edge, first[i] + np.array(old[::2], np.int64), 1)
                        np.add.at(edge, first[i] + np.array(old[1::2], np.int64), -1)
                if test is not None:
                    shard = Shard(test.known(words.hashes()), first, test.shortest, test.longest)
                    (place, word, size), _ = search(test, shard, want_longest=False)
                    np.add.at(edge, word, 1)
                    np.add.at(edge, word + size, -1)
                    owner = np.searchsorted(first, word, "right") - 1
                    groups = max(len(test.bounds) - 1, 1)
                    pairs = np.unique(owner * groups + test.group[place])
                    for i in np.unique(pairs // groups).tolist():
                        listed[i] |= test.items_of((pairs[pairs // groups == i] % groups).tolist())
                covered = np.cumsum(edge[:-1]) > 0
                total = np.concatenate([[0], np.cumsum(covered)])
                bounds = []
                for a, b in zip(first[:-1], first[1:]):
                    change = np.flatnonzero(np.diff(np.concatenate([[0], covered[a:b], [0]]))) if total[b] > total[a] else []
                    bounds.append(change)
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in kept]
                    + [pa.array(counts, pa.int64()), pa.array(total[first[1:]] - total[first[:-1]], pa.int64()),
                       pa.array([sorted(x) for x in listed], pa.list_(pa.string())),
                       pa.array(bounds, pa.list_(pa.int64()))], names=schema.names)

        docs = docs.mapInArrow(each, schema)
        test, number = next(tests, None), number + 1
    return docs.drop(spans)


def longest_matches(docs, benchmark, window=WINDOW, doc_id="doc_id", text="text", item_id="item_id",
                    item_text="text", block_bytes=BLOCK_BYTES):
    """The longest verbatim matches: doc, item, doc_word, item_word, n_words.

    One row per place of the longest match of a test suffix that has at least a window,
    unless the match also extends to the left there.
    """
    wanted = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text"))
    schema = StructType([wanted.schema["doc"]]).add("item", StringType())
    for name in ("doc_word", "item_word", "n_words"):
        schema = schema.add(name, LongType())
    found = None
    for test in blocks(benchmark, item_id, item_text, window, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(test)

        def each(batches, shared=shared):
            test = shared.value
            for part in steps(batches, "text"):
                words = Words(part.column("text"), ALPHANUMERIC)
                known = test.known(words.hashes())
                _, (place, word, size) = search(test, Shard(known, words.first, test.shortest, test.longest))
                owner = np.searchsorted(words.first, word, "right") - 1
                left = ~test.begin[place] & (word > words.first[owner])
                left[left] = known[word[left] - 1] == test.ids[place[left] - 1]
                place, word, size, owner = place[~left], word[~left], size[~left], owner[~left]
                begins = np.searchsorted(test.owner, test.owner[place])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc").take(pa.array(owner)),
                     pa.array([test.items[i] for i in test.owner[place]], pa.string()),
                     pa.array(word - words.first[owner], pa.int64()), pa.array(place - begins, pa.int64()),
                     pa.array(size, pa.int64())], names=schema.names)

        block = wanted.mapInArrow(each, schema)
        found = block if found is None else found.union(block)
    return docs.sparkSession.createDataFrame([], schema) if found is None else found


def decontaminate(docs, benchmark, window=WINDOW, text="text", item_id="item_id", item_text="text"):
    """The documents without a word inside an occurrence of a benchmark window."""
    names = []
    for name in ("n_words", "n_hit", "items"):
        names.append(fresh(docs.columns + names, name))
    marked = hits(docs, benchmark, window, text, item_id, item_text, names)
    return marked.where(F.col(names[1]) == 0).drop(*names)
