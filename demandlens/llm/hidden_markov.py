"""A hidden Markov language model over word classes.

A text is its words and one end token. The class of a word is a hash of its last bytes, so
the model has a fixed number of classes and knows something about words it never saw. A
latent state emits a class, and the class emits the word by its smoothed share among the
class's training words; both are proper distributions, so the score is an exact
probability of the text. Baum-Welch counts are gathered on every partition and summed by
class; scaled forward recursion gives the likelihood.

Counts of words are exact and cover all training texts: the tasks cut the texts into chunks,
number the words of a chunk, and shuffle one narrow row per different word (its 64-bit hash)
and chunk. What comes back to a chunk are the counts of its own words, never the vocabulary
of the corpus.
Only tables of the fixed size states x classes are collected or broadcast.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from demandlens.llm.frames import steps, stored
from demandlens.llm.words import Words, mix
from pyspark import TaskContext
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, DoubleType, IntegerType, LongType, StructType

STATES = 8
CLASSES = 1 << 14
END = CLASSES
#: Baum-Welch rounds over all training texts, and rounds on a bounded sample before them,
#: which only choose the starting point.
ROUNDS, WARM_ROUNDS, WARM_TOKENS = 2, 20, 200_000
#: Pseudo-counts: of each transition, and of the class distribution in each state.
PRIOR_MOVE, PRIOR_CLASS = 1.0, 50.0
#: Tokens that forward and backward recursion work on at a time; longer texts wait for
#: each other, since a step of the recursion costs the same for one text as for many.
TOKENS_IN_FLIGHT, LONG_TEXT = 1_000_000, 2_048
SEED = 20


def word_classes(words, at):
    """The class of the words at places ``at``: by the last four bytes, shorter words with
    their length."""
    padded = np.concatenate([np.zeros(4, np.uint8), words.data])
    four = np.ndarray((len(words.data) + 1,), "<u4", padded.data, strides=(1,))
    size = np.minimum(words.ends[at] - words.starts[at], 4)
    tail = four[words.ends[at]] >> (np.uint32(8) * (4 - size).astype(np.uint32))
    return (mix(tail.astype(np.uint64) * np.uint64(8) + size.astype(np.uint64)) >> np.uint64(50)).astype(np.int32)


def packed(codes):
    """Whole numbers as compressed byte planes."""
    planes = np.ascontiguousarray(codes.astype("<i4").view(np.uint8).reshape(-1, 4).T)
    return pa.compress(planes.tobytes(), "zstd", asbytes=True)


def unpacked(data, size):
    planes = np.frombuffer(pa.decompress(data, 4 * size, "zstd", asbytes=True), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<i4").reshape(-1)


def chunks(docs, doc_id, text, held_out):
    """One row per chunk of texts: chunk, ids, held, sizes (words per text), codes (word numbers
    of all texts, packed), classes (of each number, packed), and by number the hash, class and
    count (in the texts that are not held out) of each different word."""
    wanted = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text"),
                         F.coalesce(held_out, F.lit(False)).alias("held"))
    schema = (StructType().add("chunk", LongType()).add("ids", ArrayType(wanted.schema["doc"].dataType))
              .add("held", ArrayType(BooleanType())).add("sizes", ArrayType(IntegerType()))
              .add("codes", BinaryType()).add("classes", BinaryType()).add("hash", ArrayType(LongType()))
              .add("class", ArrayType(IntegerType())).add("n", ArrayType(LongType())))

    def each(batches):
        chunk = TaskContext.get().partitionId() << 32
        for part in steps(batches, "text"):
            words, held = Words(part.column("text")), part.column("held").to_numpy(zero_copy_only=False)
            hashes, first, inverse, counts = np.unique(words.hashes(), return_index=True, return_inverse=True,
                                                       return_counts=True)
            order = np.argsort(-counts, kind="stable")  # frequent words get small numbers
            number = np.empty(len(order), np.int64)
            number[order] = np.arange(len(order))
            codes, first = number[inverse], first[order]
            kinds = word_classes(words, first)
            n = np.bincount(codes[~held[words.owners()]], minlength=len(first))
            chunk += 1

            def one(values):
                return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk], pa.int64()), one(part.column("doc")), one(part.column("held")),
                 one(pa.array(words.counts(), pa.int32())), pa.array([packed(codes)], pa.binary()),
                 pa.array([packed(kinds)], pa.binary()), one(pa.array(hashes[order].view(np.int64))),
                 one(pa.array(kinds, pa.int32())), one(pa.array(n, pa.int64()))], names=schema.names)

    return wanted.mapInArrow(each, schema)


@dataclass
class Model:
    """Start, transitions (from, to) and emissions (class, state) of the states; and per
    class how many training tokens and different words it has."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray
    tokens: np.ndarray
    types: np.ndarray


def by_length(sizes):
    """Texts by falling length; at step t the first ``alive[t]`` of them have a token."""
    order = np.argsort(-sizes, kind="stable")
    alive = np.searchsorted(-sizes[order], -np.arange(sizes.max(initial=0)), "left")
    return order, alive


def forward(model, symbols, begins, sizes, keep=False):
    """ln likelihood of each text; with ``keep`` also the scaled forward rows and scales of
    each token."""
    order, alive = by_length(sizes)
    begins = begins[order]
    total = np.zeros(len(sizes))
    rows = np.empty((len(symbols), len(model.start))) if keep else None
    scales = np.empty(len(symbols)) if keep else None
    state = None
    for t, n in enumerate(alive):
        at = begins[:n] + t
        state = (model.start if t == 0 else state[:n] @ model.move) * model.emit[symbols[at]]
        scale = state.sum(axis=1)
        state /= scale[:, None]
        total[:n] += np.log(scale)
        if keep:
            rows[at], scales[at] = state, scale
    out = np.empty(len(sizes))
    out[order] = total
    return (out, rows, scales) if keep else out


def expected(model, symbols, begins, sizes):
    """Baum-Welch counts of some texts: starts, moves and (class, state) emissions."""
    _, rows, scales = forward(model, symbols, begins, sizes, keep=True)
    order, alive = by_length(sizes)
    begins = begins[order]
    moves, after = np.zeros_like(model.move), None
    for t in range(len(alive) - 1, -1, -1):
        n = alive[t]
        at = begins[:n] + t
        back = np.ones((n, len(model.start)))
        if after is not None:
            moves += rows[at[:len(after)]].T @ after
            back[:len(after)] = after @ model.move.T
        after = model.emit[symbols[at]] * back / scales[at][:, None]
        rows[at] *= back
    emitted = np.stack([np.bincount(symbols, rows[:, k], END + 1) for k in range(len(model.start))], axis=1)
    return rows[begins].sum(axis=0), moves * model.move, emitted


def maximised(start, moves, emitted, shares, tokens, types):
    """The model of the counts, smoothed; ``shares`` is the class distribution."""
    start = start + PRIOR_MOVE
    moves = moves + PRIOR_MOVE
    emitted = emitted + PRIOR_CLASS * shares[:, None]
    return Model(start / start.sum(), moves / moves.sum(axis=1, keepdims=True),
                 emitted / emitted.sum(axis=0), tokens, types)


def sequences(batches, training):
    """(symbols, begins, sizes) of about ``TOKENS_IN_FLIGHT`` tokens at a time, end tokens
    included; long texts are kept together."""
    waiting = {False: [], True: []}
    held = {False: 0, True: 0}

    def flush(long):
        parts, waiting[long], held[long] = waiting[long], [], 0
        sizes = np.array([len(p) for p in parts])
        return np.concatenate(parts), np.cumsum(sizes) - sizes, sizes

    for batch in batches:
        for row in batch.to_pylist():
            for symbols, out in zip(texts_of(row), row["held"]):
                if out and training:
                    continue
                long = len(symbols) > LONG_TEXT
                waiting[long].append(symbols)
                held[long] += len(symbols)
                if held[long] >= TOKENS_IN_FLIGHT:
                    yield flush(long)
    for long in (False, True):
        if waiting[long]:
            yield flush(long)


def texts_of(row):
    """The classes of each text of a document row, closed by the end class."""
    sizes = np.array(row["sizes"], np.int64)
    codes = unpacked(row["codes"], int(sizes.sum()))
    kinds = unpacked(row["classes"], int(codes.max(initial=-1)) + 1)[codes]
    bounds = np.cumsum(sizes)
    return [np.append(kinds[b - n:b], END) for b, n in zip(bounds, sizes)]


def warmed(texts, shares, tokens, types):
    """A starting model: random states, a few rounds on the sample of texts."""
    draw = np.random.default_rng(SEED)
    emitted = shares[:, None] * np.exp(draw.normal(0, 0.5, (END + 1, STATES)))
    model = Model(np.full(STATES, 1 / STATES), np.full((STATES, STATES), 0.1 / (STATES - 1)),
                  emitted / emitted.sum(axis=0), tokens, types)
    np.fill_diagonal(model.move, 0.9)
    if texts:
        sizes = np.array([len(x) for x in texts])
        for _ in range(WARM_ROUNDS):
            model = maximised(*expected(model, np.concatenate(texts), np.cumsum(sizes) - sizes, sizes),
                              shares, tokens, types)
    return model


def train(documents, tokens, types, rounds=ROUNDS):
    """A ``Model`` from the document rows; ``tokens`` and ``types`` per class cover all
    training texts."""
    spark = documents.sparkSession
    shares = (tokens + 0.5) / (tokens + 0.5).sum()
    rows = documents.select("sizes", "codes", "classes", "held")

    def sample(batches):
        texts, total = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                for symbols, out in zip(texts_of(row), row["held"]):
                    if not out and len(symbols) <= LONG_TEXT and total < WARM_TOKENS:
                        texts.append(symbols)
                        total += len(symbols)
        model = warmed(texts, shares, tokens, types)
        yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in
                                          (model.start, model.move, model.emit)], names=["start", "move", "emit"])

    few = documents.orderBy(F.xxhash64("chunk")).limit(2).select(rows.columns).coalesce(1)
    first = few.mapInArrow(sample, "start binary, move binary, emit binary").first()
    start, move, emit = (np.frombuffer(x) for x in first)
    model = Model(start, move.reshape(STATES, STATES), emit.reshape(END + 1, STATES), tokens, types)
    names = [f"s{k}" for k in range(STATES)]
    schema = "symbol int, " + ", ".join(f"{n} double" for n in names)
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(model)

        def counted(batches, shared=shared):
            model = shared.value
            totals = [np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros((END + 1, STATES))]
            for symbols, begins, sizes in sequences(batches, True):
                for total, own in zip(totals, expected(model, symbols, begins, sizes)):
                    total += own
            # negative symbols carry the starts and, below them, the moves
            table = np.vstack([totals[2], totals[0][None], totals[1]])
            symbol = np.concatenate([np.arange(END + 1), -1 - np.arange(STATES + 1)])
            used = table.any(axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(symbol[used], pa.int32())] +
                                             [pa.array(table[used, k]) for k in range(STATES)], names=["symbol", *names])

        sums = (rows.mapInArrow(counted, schema).groupBy("symbol")
                .agg(*[F.sum(n).alias(n) for n in names]).toPandas())  # END + STATES + 2 rows at most
        table = np.zeros((END + 1 + STATES + 1, STATES))
        at = sums["symbol"].to_numpy()
        table[np.where(at >= 0, at, END - at)] = sums[names].to_numpy()
        model = maximised(table[END + 1], table[END + 2:], table[:END + 1], shares, tokens, types)
        shared.unpersist()
    return model


def score(docs, held_out, doc_id="doc_id", text="text", rounds=ROUNDS):
    """One row per row of ``docs``: doc, held_out, n_tokens, n_known, train_tokens, base_score
    and score.

    Learns from the rows where ``held_out`` (a boolean expression over ``docs``, null as
    false) is false. Tokens are the words and one end token; null and empty texts have the
    end alone. ``base_score`` is the log10 unigram probability with 0.5 added to every count,
    ``score`` the model's log10 probability of the text. Without training texts all scores
    are those of the bare smoothing. Repeated rows and ids are scored each for itself.
    """
    spark = docs.sparkSession
    table = stored(chunks(docs, doc_id, text, held_out), "chunks")
    documents = table.select("chunk", "ids", "held", "sizes", "codes", "classes")
    words = table.select("chunk", F.posexplode(F.arrays_zip("hash", "class", "n")).alias("code", "x")).select(
        "chunk", "code", F.col("x.hash").alias("hash"), F.col("x.class").alias("class"), F.col("x.n").alias("n"))
    totals = stored(words.where("n > 0").groupBy("hash", "class").agg(F.sum("n").alias("c")), "word-totals")
    by_class = totals.groupBy("class").agg(
        F.sum("c").alias("tokens"), F.count("*").alias("types")).toPandas()  # CLASSES rows at most
    ends = documents.select(F.sum(F.size(F.filter("held", lambda h: ~h)))).first()[0] or 0
    tokens, types = np.zeros(END + 1), np.zeros(END + 1)
    tokens[by_class["class"]], types[by_class["class"]] = by_class["tokens"], by_class["types"]
    tokens[END], types[END] = ends, min(ends, 1)
    model = train(documents, tokens, types, rounds)
    shared = spark.sparkContext.broadcast(model)

    train_tokens, vocabulary = int(tokens.sum()), int(types.sum())
    floor = train_tokens + 0.5 * (vocabulary + 1)
    # the counts of a chunk's own words; those that no training text has are not among them
    own = (words.select(F.col("chunk").alias("at"), "code", "hash").join(totals.select("hash", "c"), "hash")
           .select("at", "code", "c"))
    kind = docs.schema[doc_id].dataType
    schema = (StructType().add("doc", kind).add("held_out", BooleanType()).add("n_tokens", LongType())
              .add("n_known", LongType()).add("train_tokens", LongType()).add("base_score", DoubleType())
              .add("score", DoubleType()))

    def settle(chunk, counts):
        row = chunk.select(["sizes", "codes", "classes"]).to_pylist()[0]
        codes = unpacked(row["codes"], sum(row["sizes"]))
        c = np.zeros(int(codes.max(initial=-1)) + 1, np.int64)
        c[counts["code"].to_numpy()] = counts["c"].to_numpy()
        return pa.Table.from_arrays(
            [chunk["ids"].combine_chunks().flatten(), chunk["held"].combine_chunks().flatten(),
             *scored(shared.value, row, c, floor, train_tokens, ends)], names=schema.names)

    return documents.groupBy("chunk").cogroup(own.groupBy("at")).applyInArrow(settle, schema)


def scored(model, row, c, floor, train_tokens, ends):
    """The columns of ``score`` for a chunk whose word numbers have training counts ``c``."""
    sizes = np.array(row["sizes"], np.int64)
    codes = unpacked(row["codes"], int(sizes.sum()))
    kinds = unpacked(row["classes"], len(c))
    within = np.log10((c + 0.5) / (model.tokens[kinds] + 0.5 * (model.types[kinds] + 1)))
    bounds = np.concatenate([[0], np.cumsum(sizes)])

    def summed(values):
        owner = np.repeat(np.arange(len(sizes)), sizes)
        return np.bincount(owner, values[codes], len(sizes))

    base = summed(np.log10((c + 0.5) / floor)) + np.log10((ends + 0.5) / floor)
    known = summed((c > 0).astype(float)).astype(np.int64) + int(ends > 0)
    end = np.log10((model.tokens[END] + 0.5) / (model.tokens[END] + 0.5 * (model.types[END] + 1)))
    symbols = np.insert(kinds[codes], bounds[1:], END)
    likely = np.zeros(len(sizes))
    for some in groups(sizes + 1):
        likely[some] = forward(model, symbols, (bounds[:-1] + np.arange(len(sizes)))[some], sizes[some] + 1)
    return [pa.array(sizes + 1, pa.int64()), pa.array(known, pa.int64()),
            pa.repeat(pa.scalar(train_tokens, pa.int64()), len(sizes)), pa.array(base),
            pa.array(likely / np.log(10) + summed(within) + end)]


def groups(sizes):
    """Short and long texts apart."""
    long = sizes > LONG_TEXT
    return [x for x in (np.flatnonzero(~long), np.flatnonzero(long)) if len(x)]
