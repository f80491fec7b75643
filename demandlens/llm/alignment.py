"""Alignment of two tokenizers over the same texts, on Arrow tables.

Both tokenizers encode a step of texts. Their id lists are flattened beside the index of
the text each id belongs to; the byte length of every token, added up within its text,
gives the byte at which it ends. Tokens of either side that end at the same byte of the same
text meet in an Acero hash join on (text, end): these are the links, and the ends they share
cut both token sequences into groups.

The links of a step are counted by ``Table.group_by`` per pair of ids; Spark adds the counts of all
steps and finds the highest count of each B id. A step then gets the totals of its own
pairs back, and looks them up for every link of its texts, whose places in the step's list
of pairs were kept. Neither links nor vocabularies are shuffled one by one: a pair of ids
is one row per step.
"""

import hashlib
import json
import os
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from demandlens.llm.frames import steps, stored
from demandlens.llm.hidden_markov import packed, unpacked
from pyspark import TaskContext
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructType
from tokenizers import Tokenizer

FIRST, SECOND = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
#: The tokenizer files are sent to every task.
MAX_FILE_BYTES = 64 << 20
#: Bytes of text of a step.
STEP_BYTES = 4 << 20
#: A text and a byte in it share a number: so many bits are the byte's.
END_BITS = 40
#: Bytes of text that are in the tokenizers' hands at a time.
PART_BYTES = 1 << 20
MARK = "▁"
#: Fixed value: the pattern by which byte-level tokenizers split a text.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_of_letter():
    """Letter -> byte of the byte-level alphabet: visible Latin-1 letters stand for
    themselves, the other bytes in order for the letters from 256 on."""
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Surface:
    """The bytes of every id, one after another."""

    def __init__(self, tokens):
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.begin = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(tokens), np.uint8)

    def joined(self, ids):
        """The bytes of the tokens ``ids``."""
        width = self.size[ids]
        ends = np.cumsum(width)
        return self.data[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.begin[ids] - (ends - width), width)]


class ByteLevel:
    """A byte-level BPE in the tokenizers format. Special tokens in a text are plain text.

    Where the ids follow the order of the merges and nothing but the usual splitting comes
    before them, tiktoken gives the same ids in a quarter of the time and is used; any other
    file goes to the tokenizers library."""

    def __init__(self, data):
        model = json.loads(data)
        entries = model["model"]["vocab"] | {t["content"]: t["id"] for t in model["added_tokens"]}
        own, letters = [b""] * (max(entries.values()) + 1), byte_of_letter()
        for text, i in entries.items():
            own[i] = bytes(letters[c] for c in text) if all(c in letters for c in text) else text.encode()
        self.surface = Surface(own)
        self.ranked, self.core = by_rank(model), None
        if self.ranked is None:
            self.core = Tokenizer.from_str(data.decode())
            self.core.encode_special_tokens = True

    def encode(self, texts):
        if self.ranked is not None:
            return [self.ranked.encode_to_numpy(" " + t, disallowed_special=()) for t in texts]
        return [e.ids for e in self.core.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]


def by_rank(model):
    """The tiktoken encoding of a tokenizers file, ``None`` where it could differ."""
    core, before, letters = model["model"], model.get("pre_tokenizer") or {}, byte_of_letter()
    usual = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    if core["type"] != "BPE" or model.get("normalizer") or any(before.get(k) != v for k, v in usual.items()):
        return None
    if any(core.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")):
        return None
    vocabulary = core["vocab"]
    if any(c not in letters for text in vocabulary for c in text):
        return None
    joined = ["".join(m if isinstance(m, list) else m.split(" ")) for m in core["merges"]]
    single = sorted(vocabulary[c] for c in letters if c in vocabulary)
    if single != list(range(256)) or [vocabulary.get(t) for t in joined] != list(range(256, len(vocabulary))):
        return None
    ranks = {bytes(letters[c] for c in text): i for text, i in vocabulary.items()}
    return tiktoken.Encoding("file", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


class Pieces:
    """A sentencepiece model, which sets the blank before a text itself."""

    def __init__(self, data):
        self.core = core = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.surface = Surface([bytes([int(core.id_to_piece(i)[3:5], 16)]) if core.is_byte(i)
                                else core.id_to_piece(i).replace(MARK, " ").encode() for i in range(core.vocab_size())])

    def encode(self, texts):
        return self.core.encode(texts, num_threads=1)


_ready = {}


def loaded(key, first, second):
    """Both tokenizers, built once per Python worker."""
    if key not in _ready:
        _ready.clear()
        _ready[key] = ByteLevel(first), Pieces(second)
    return _ready[key]


class Tokens:
    """The tokens of a step on one side: ids, the text each belongs to, and the byte of
    the text at which it ends."""

    def __init__(self, lists, surface):
        sizes = np.array([len(x) for x in lists], np.int64)
        if lists and isinstance(lists[0], np.ndarray):
            flat = pa.array(np.concatenate(lists).astype(np.int32))
        else:
            flat = pa.array(np.fromiter(chain.from_iterable(lists), np.int32, int(sizes.sum())))
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        lists = pa.LargeListArray.from_arrays(pa.array(bounds), flat)
        self.surface, self.sizes = surface, sizes
        self.ids, self.owner = pc.list_flatten(lists), pc.list_parent_indices(lists)
        ends = pc.cumulative_sum(pc.take(pa.array(surface.size), self.ids))
        # each text's running sum begins after the sum of the texts before it
        before = np.concatenate([[0], ends.to_numpy()])[bounds]
        self.bytes = np.diff(before)
        self.end = pc.subtract(ends, pc.take(pa.array(before[:-1]), self.owner))

    def of(self, good):
        """The tokens of the texts marked in ``good``."""
        keep = pc.take(pa.array(good), self.owner)
        return pa.table({"id": self.ids.filter(keep), "owner": self.owner.filter(keep), "end": self.end.filter(keep)})


def spelled(tokens, texts):
    """Which texts the tokens spell byte by byte, a blank in front; empty texts are not."""
    texts = texts.cast(pa.large_string())
    wanted = pc.binary_join_element_wise(pa.scalar("", texts.type), texts, pa.scalar(" ", texts.type))
    size = pc.binary_length(wanted).to_numpy()
    good = (size == tokens.bytes) & (size > 1)
    own = tokens.surface.joined(tokens.of(good)["id"].to_numpy())
    _, offsets, data = wanted.filter(pa.array(good)).buffers()
    other = np.frombuffer(data, np.uint8)[:len(own)] if len(own) else own
    bounds = np.cumsum(size[good])
    wrong = np.unique(np.searchsorted(bounds, np.flatnonzero(own != other), "right"))
    good[np.flatnonzero(good)[wrong]] = False
    return good


def keyed(table):
    """The rows with (text, end) as one number, in order."""
    key = pc.bit_wise_or(pc.shift_left(table["owner"].cast(pa.int64()), END_BITS), table["end"])
    return pa.table({"key": key, "id": table["id"]})


def joined_ids(tokens, cuts):
    """The ids of each group as text: the tokens that end after the cut before it and not
    after its own."""
    place = np.searchsorted(tokens["key"].to_numpy(), cuts, "right")
    bounds = pa.array(np.concatenate([[0], place]).astype(np.int32))
    return pc.binary_join(pa.ListArray.from_arrays(bounds, pc.cast(tokens["id"].combine_chunks(), pa.string())), ",")


def aligned(texts, first, second):
    """Per text of a step n_a, n_b, n_groups, n_links and groups, and the pair of ids of every
    link, in the order of the texts."""
    texts = pc.fill_null(texts.cast(pa.string()), "")
    values = texts.to_pylist()
    sides = [Tokens(x.encode(values), x.surface) for x in (first, second)]
    good = spelled(sides[0], texts) & spelled(sides[1], texts)
    a, b = (keyed(s.of(good)) for s in sides)
    links = a.join(b.rename_columns(["key", "other"]), "key", join_type="inner", use_threads=False).sort_by("key")
    key = links["key"].to_numpy()
    cuts = key[np.diff(key, prepend=-1) > 0]
    groups = pc.binary_join_element_wise(joined_ids(a, cuts), joined_ids(b, cuts), "|")
    n = len(good)
    edges = np.arange(n + 1, dtype=np.int64) << END_BITS
    group_at, link_at = np.searchsorted(cuts, edges, "right"), np.searchsorted(key, edges, "right")
    spelt = pc.binary_join(pa.ListArray.from_arrays(pa.array(group_at.astype(np.int32)), groups), ";")
    pairs = pc.bit_wise_or(pc.shift_left(links["id"].cast(pa.int64()), 32), links["other"].cast(pa.int64()))
    counts = [np.where(good, s.sizes, 0) for s in sides]
    return [*counts, np.diff(group_at), np.diff(link_at)], spelt, pairs.combine_chunks()


def digests(spelt):
    """SHA-256 of each text as lowercase hex, nothing for no text."""
    return pa.array([hashlib.sha256(x.as_buffer()).hexdigest() if len(x.as_buffer()) else "" for x in spelt], pa.string())


def files(first_path, second_path):
    """The bytes of both tokenizer files and a name for them."""
    out = []
    for path in (first_path, second_path):
        with open(path, "rb") as file:
            out.append(file.read(MAX_FILE_BYTES + 1))
        if len(out[-1]) > MAX_FILE_BYTES:
            raise ValueError(f"{path} has more than {MAX_FILE_BYTES} bytes")
    return hashlib.sha256(b"".join(out)).hexdigest(), *out


FIGURES = ("n_a", "n_b", "n_groups", "n_links")


def encoded(docs, doc_id, text, first_path, second_path, step_bytes):
    """One row per step: its texts' ids, figures and digests of groups, the place of every link's pair
    in ``pairs`` (packed), and the different ``pairs`` with their ``counts``."""
    wanted = docs.select(F.col(doc_id).alias("doc"), F.col(text).cast("string").alias("text"))
    own = files(first_path, second_path)
    shared = docs.sparkSession.sparkContext.broadcast(own)
    schema = StructType().add("step", LongType()).add("doc", ArrayType(wanted.schema["doc"].dataType))
    for name in FIGURES:
        schema = schema.add(name, ArrayType(LongType()))
    schema = (schema.add("groups_sha256", ArrayType(StringType())).add("places", BinaryType())
              .add("pairs", ArrayType(LongType())).add("counts", ArrayType(LongType())))

    def each(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        first, second = loaded(*shared.value)
        number = TaskContext.get().partitionId() << 32
        for part in steps(batches, "text", step_bytes):
            number += 1
            found = [(f, digests(spelt), p) for f, spelt, p in (
                aligned(own.column("text"), first, second) for own in steps([part], "text", PART_BYTES))]
            figures = [np.concatenate(own) for own in zip(*(f for f, *_ in found))]
            hashed = pa.concat_arrays([h for _, h, _ in found])
            pairs = pa.concat_arrays([p for *_, p in found])
            counted = pa.table({"pair": pairs}).group_by("pair").aggregate([("pair", "count")])
            counted = counted.sort_by("pair")
            known = counted["pair"].combine_chunks()
            places = np.searchsorted(known.to_numpy(), pairs.to_numpy())

            def one(values):
                return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

            yield pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), one(part.column("doc")), *[one(pa.array(f, pa.int64())) for f in figures],
                 one(hashed), pa.array([packed(places)], pa.binary()), one(known),
                 one(counted["pair_count"].combine_chunks())], names=schema.names)

    return wanted.mapInArrow(each, schema)


def tallied(pairs):
    """pair, total and whether no other pair of its B id has a higher total, of the partial
    counts (pair, n)."""
    total = pairs.groupBy("pair").agg(F.sum("n").alias("total"))
    other = F.col("pair").bitwiseAND((1 << 32) - 1).alias("other")
    highest = total.groupBy(other).agg(F.max("total").alias("highest"))
    return (total.withColumn("other", other).join(highest, "other")
            .select("pair", "total", (F.col("total") == F.col("highest")).alias("best")))


def align(docs, doc_id="doc_id", text="text", first_path=FIRST, second_path=SECOND, step_bytes=STEP_BYTES):
    """One row per row of ``docs``: doc, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A is a byte-level BPE that encodes a blank and the text, B a sentencepiece model that
    sets the blank itself. A null or empty text, and one that either side does not spell
    byte by byte, has no tokens: zeros and an empty digest. ``count_sum`` adds up, over the
    text's links, how many links of all texts have the same two ids; ``n_best`` counts the links whose
    ids have the highest such number for their B id. Ids may repeat or be null; each
    row is aligned for itself and adds to the counts. No rows in, no rows out.
    """
    spark = docs.sparkSession
    table = stored(encoded(docs, doc_id, text, first_path, second_path, step_bytes), "aligned-steps")
    listed = table.select("step", F.explode(F.arrays_zip("pairs", "counts")).alias("x")).select(
        "step", F.col("x.pairs").alias("pair"), F.col("x.counts").alias("n"))
    totals = stored(tallied(listed), "pair-totals")
    own = listed.select(F.col("step").alias("at"), "pair").join(totals, "pair")
    rows = table.drop("pairs", "counts")
    schema = StructType().add("doc", rows.schema["doc"].dataType.elementType)
    for name in (*FIGURES, "n_best", "count_sum"):
        schema = schema.add(name, LongType())
    schema = schema.add("groups_sha256", StringType())

    def settle(step, counts):
        counts = counts.sort_by("pair")
        total, best = (counts[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in ("total", "best"))
        size = step["n_links"].combine_chunks().flatten().to_numpy()
        places = unpacked(step["places"][0].as_py(), int(size.sum()))
        edges = np.concatenate([[0], np.cumsum(size)])

        def summed(values):
            run = np.concatenate([[0], np.cumsum(values[places])])
            return pa.array(run[edges[1:]] - run[edges[:-1]], pa.int64())

        flat = {c: step[c].combine_chunks().flatten() for c in ("doc", *FIGURES, "groups_sha256")}
        return pa.table({**flat, "n_best": summed(best), "count_sum": summed(total)}).select(schema.names)

    return rows.groupBy("step").cogroup(own.groupBy("at")).applyInArrow(settle, schema)
