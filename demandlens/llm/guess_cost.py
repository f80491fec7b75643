"""Secrets in texts, and how many guesses they would stand.

Three fixed patterns find assignments, access keys and long hex runs. A dynamic program
then prices every value in a credential context: the cheapest split into dictionary words,
dates, repeats, keyboard walks and single brute-force characters, in log10 of guesses. The
dictionary is the most frequent words of the corpus itself, counted over all texts.
Values at or above the threshold are reported as spans of their own.
"""

import math
import re

import pyarrow as pa
from demandlens.llm.frames import as_bytes, fresh, steps
from demandlens.llm.word_counts import word_counts
from demandlens.llm.words import ALPHANUMERIC
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructType

KINDS = ("assign", "access", "hex", "guess")
ASSIGN = re.compile(rb"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{24,}")
#: Wider credential contexts, whose values count only by their guess cost. A name may be any
#: part of an identifier, between characters other than letters and digits. An identifier is
#: read once, from its start, so that long ones cost linear time.
NAME = (rb"(?<![A-Za-z0-9])(?:pass(?:word|wd|phrase|code)?|pwd|pin|secret|token|(?:api|access|private|auth)[_-]?key"
        rb"|credentials?)(?![A-Za-z0-9])")
CONTEXT = re.compile(
    rb"""(?i:(?<![A-Za-z0-9_-])(?>[A-Za-z0-9_-]*?%b)[A-Za-z0-9_-]*+["']?\x20*[:=]\x20*"""
    rb"""|(?<![A-Za-z0-9_])(?>[A-Za-z0-9_]*?%b)[A-Za-z0-9_]*+["']?\x20+is\x20+"""
    rb"""|(?<![A-Za-z0-9])bearer\x20+)["']?""" % (NAME, NAME))
#: A value goes on up to the next delimiter, whatever symbols it holds.
VALUE = re.compile(rb"""[^\s"'`,;<>]+""")
HINTS = (b"pass", b"pwd", b"pin", b"secret", b"token", b"api", b"key", b"credential", b"bearer")
#: A value of 10**10 guesses or more is reported.
THRESHOLD = 10.0
MIN_VALUE = 6
#: Words in the dictionary: a top list, so its size is bound.
DICTIONARY = 20_000
LONGEST_WORD = 24
#: Each further segment costs something, else two guesses would be as cheap as one.
JOINT = 0.3
LEET = bytes.maketrans(b"430157@$", b"aeolstas")
ROWS = (b"1234567890", b"qwertyuiop", b"asdfghjkl", b"zxcvbnm")


def _neighbours():
    near = {}
    for y, row in enumerate(ROWS):
        for x, key in enumerate(row):
            near[key] = {ROWS[j][i] for j in (y - 1, y, y + 1) if 0 <= j < len(ROWS)
                         for i in (x - 1, x, x + 1) if 0 <= i < len(ROWS[j])} - {key}
    return near


NEAR = _neighbours()
MONTH, MONTHDAY = rb"(?:0[1-9]|1[0-2])", rb"(?:0[1-9]|[12]\d|3[01])"
DAY, YEAR = math.log10(200 * 365), math.log10(200)
DATES = ((re.compile(rb"(?:19|20)\d\d"), YEAR),
         (re.compile(rb"(?:19|20)\d\d[-/.]?" + MONTH + rb"[-/.]?" + MONTHDAY), DAY),
         (re.compile(MONTHDAY + rb"[-/.]?" + MONTH + rb"[-/.]?(?:19|20)\d\d"), DAY))
#: Characters of a block that is written several times.
LONGEST_BLOCK = 32
TWICE = re.compile(rb"(?s)(.{2,%d}?)\1" % LONGEST_BLOCK)
TWICE_OF = {n: re.compile(rb"(?s)(.{%d})\1" % n) for n in range(2, LONGEST_BLOCK + 1)}


def brute(byte):
    """log10 of the characters of this one's class."""
    if 48 <= byte <= 57:
        return 1.0
    if 97 <= byte <= 122 or 65 <= byte <= 90:
        return math.log10(26)
    return math.log10(33)


class Starts:
    """The least of base + log10(end - start) over all starts given so far, for ends that
    never decrease. An earlier start that is behind can only catch up, so the starts are
    kept in the order in which they will lead, the leading one last."""

    def __init__(self):
        self.leads = []  # (base, start, the end from which the entry before leads)

    @staticmethod
    def caught(early, late):
        """The end from which ``early`` costs no more than ``late``."""
        gap = late[0] - early[0]
        if gap <= 0:
            return math.inf
        if gap > 300:
            return late[1]
        ratio = 10 ** gap
        return (ratio * late[1] - early[1]) / (ratio - 1) if ratio > 1 else math.inf

    def settle(self, end):
        while len(self.leads) > 1 and self.leads[-1][2] <= end:
            self.leads.pop()

    def add(self, base, start, end):
        self.settle(end)
        leads, new = self.leads, (base, start)
        if leads and leads[-1][0] + math.log10(end - leads[-1][1]) <= base + math.log10(end - start):
            return  # the earlier start leads now, so it always will
        while leads:
            turn = self.caught(leads[-1], new)
            if len(leads) == 1 or turn < leads[-1][2]:
                break
            leads.pop()  # the one before it leads first
        leads.append((base, start, self.caught(leads[-1], new) if leads else math.inf))

    def least(self, end):
        self.settle(end)
        base, start, _ = self.leads[-1]
        return base + math.log10(end - start)


def guesses(value, ranks, known=None):
    """log10 of the guesses that ``value`` (bytes) stands: the cheapest segmentation.

    Repeats, walks and repeated blocks begin anywhere in their run; a block costs what it
    stands by itself, times how often it is written. About linear in the length, since
    ``Starts`` drops starts that no longer can be the cheapest, and words and blocks have a
    longest length. ``known`` holds the blocks priced so far."""
    known = {} if known is None else known
    low = value.lower()
    plain = low.translate(LEET)
    size = len(value)
    dates = {}
    for start in range(size):
        if 48 <= low[start] <= 57:
            for pattern, cost in DATES:
                match = pattern.match(low, start)
                if match:
                    dates.setdefault(match.end(), []).append((start, cost))
    best = [0.0] + [math.inf] * size
    single = math.inf  # the best split so far that ends in a brute-force character
    run = walk = turns = 0
    repeats, straight, bent, turned = Starts(), Starts(), Starts(), [0] * (size + 1)
    alike, blocks = [0] * (LONGEST_BLOCK + 1), {}
    lengths = [n for n, twice in TWICE_OF.items() if twice.search(low)] if TWICE.search(low) else []
    for end in range(1, size + 1):
        at = end - 1
        if at and low[at] != low[at - 1]:
            run, repeats = at, Starts()
        if at and low[at] not in NEAR.get(low[at - 1], ()):
            walk, straight, bent = at, Starts(), Starts()
        turns += at > 0 and abs(low[at] - low[at - 1]) != 1
        turned[at] = turns  # up to the pair that ends here, so turned[b] - turned[a] are inside a..b
        single = brute(value[at]) + min(best[at] + JOINT, single)
        cost = single
        if end - run >= 3:
            repeats.add(best[end - 3], end - 3, end)
            cost = min(cost, repeats.least(end) + brute(value[run]) + JOINT)
        if end - walk >= 3:
            start = end - 3
            straight.add(best[start] - 0.3 * turned[start], start, end)
            bent.add(best[start] + 0.3 * 8, start, end)
            cost = min(cost, min(straight.least(end) + 0.3 * turns, bent.least(end)) + math.log10(47) + JOINT)
        for length in lengths:
            if at < length or low[at] != low[at - length]:
                if alike[length] >= length:
                    blocks[length] = None
                alike[length] = 0
                continue
            alike[length] += 1
            if alike[length] >= length:
                starts = blocks.get(length)
                if starts is None:
                    starts = blocks[length] = [Starts() for _ in range(length)]
                start = end - 2 * length
                block = value[start:start + length]
                if block not in known:
                    known[block] = guesses(block, ranks, known)
                starts[end % length].add(best[start] + known[block], start, end)
                cost = min(cost, starts[end % length].least(end) - math.log10(length) + JOINT)
        for start, worth in dates.get(end, ()):
            cost = min(cost, best[start] + worth + JOINT)
        for start in range(max(0, end - LONGEST_WORD), end - 2):
            word = low[start:end]
            rank, extra = ranks.get(word), 0.0
            if rank is None and plain[start:end] != word:
                rank, extra = ranks.get(plain[start:end]), 0.6
            if rank is not None:
                if value[start:end] != word:
                    extra += 0.3
                cost = min(cost, best[start] + math.log10(rank + 1) + extra + JOINT)
        best[end] = cost
    return best[size]


def dictionary(docs, text="text", size=DICTIONARY):
    """Word (bytes) -> rank from 1, the ``size`` most frequent words of ASCII letters, ties
    by spelling."""
    top = (word_counts(docs, text, ALPHANUMERIC).where(F.col("word").rlike(f"^[a-z]{{3,{LONGEST_WORD}}}$"))
           .orderBy(F.desc("n"), "word").limit(size).collect())
    return {r["word"].encode(): i for i, r in enumerate(top, 1)}


def values(text):
    """(start, end) of each value in a credential context, whole; one that begins inside
    another is part of it."""
    starts = {m.end() for m in CONTEXT.finditer(text)} | {m.start(2) for m in ASSIGN.finditer(text)}
    end = 0
    for start in sorted(starts):
        value = VALUE.match(text, start) if start >= end else None
        if value:
            end = value.end()
            if end - start >= MIN_VALUE:
                yield start, end


def find(text, ranks, threshold=THRESHOLD):
    """(kind, start, end, cost) of all spans of one text (bytes), in bytes; cost is null
    but for ``guess``."""
    found = []
    low = text.lower()
    if any(h in low for h in HINTS):
        found += [("assign", m.start(), m.end(), None) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE]
        for start, end in values(text):
            cost = guesses(text[start:end], ranks)
            if cost >= threshold:
                found.append(("guess", start, end, cost))
    if b"AKIA" in text:
        found += [("access", m.start(), m.end(), None) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [("hex", m.start(), m.end(), None) for m in HEX.finditer(text)]
    found.sort(key=lambda x: (x[1], KINDS.index(x[0])))
    return found


def code_points(text, places):
    """Byte places -> code points, in one pass over the text."""
    if text.isascii():
        return {p: p for p in places}
    out, last, points = {}, 0, 0
    for place in sorted(set(places)):
        points += len(text[last:place].decode())
        out[place], last = points, place
    return out


SPAN = StructType().add("kind", StringType()).add("start", LongType()).add("end", LongType()).add("cost", DoubleType())
ARROW_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("cost", pa.float64())])


def secrets(docs, text="text", name="secrets", ranks=None, threshold=THRESHOLD):
    """``docs`` plus an array of spans (kind, start, end, cost) in code points, by start,
    then kind.

    Null and empty texts have none. ``ranks`` defaults to the dictionary of ``docs``. ``name``
    gets leading underscores where ``docs`` has such a column.
    """
    shared = docs.sparkSession.sparkContext.broadcast(dictionary(docs, text) if ranks is None else ranks)
    schema = StructType(list(docs.schema.fields)).add(fresh(docs.columns, name), ArrayType(SPAN))

    def each(batches):
        ranks = shared.value
        for part in steps(batches, text):
            spans = []
            for value in as_bytes(part.column(text)):
                own = find(value, ranks, threshold) if value else []
                if own:
                    points = code_points(value, [p for s in own for p in s[1:3]])
                    own = [{"kind": k, "start": points[a], "end": points[b], "cost": c} for k, a, b, c in own]
                spans.append(own)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(spans, pa.list_(ARROW_SPAN))], names=schema.names)

    return docs.mapInArrow(each, schema)
