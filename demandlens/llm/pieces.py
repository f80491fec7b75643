"""SentencePiece encoding and decoding on the tokenizers library.

The model file is parsed here (protobuf wire format), and its normaliser, metaspace
marker, scores, merge order and byte fallback are rebuilt as a tokenizers pipeline, which
encodes batches on as many threads as a task has cores. Every text is also encoded by the sentencepiece
library; where the two differ, its ids are returned and ``parity`` is false, so the ids
are the model's in any case.
"""

import hashlib
import os
import struct
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from demandlens.llm.frames import fresh, steps
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StructType
from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: The model is sent to every task.
MAX_MODEL_BYTES = 64 << 20
STEP_BYTES = 2 << 20
MARK = "▁"
#: Fixed values of the model format: piece types and model types.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def fields(data):
    """(field number, value) of one protobuf message: int, four bytes or bytes."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind)
            if size is None:
                size = varint()
            yield key >> 3, data[at:at + size]
            at += size


@dataclass
class Pieces:
    """What the backend needs of a model file; the defaults are those of the format."""

    pieces: list = field(default_factory=list)  # (text, score, type)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    squeeze: bool = True
    escape: bool = True


def parse(data):
    model = Pieces()
    for number, value in fields(data):
        if number == 1:
            own = dict(fields(value))
            score = struct.unpack("<f", own[2])[0] if 2 in own else 0.0
            model.pieces.append((own.get(1, b"").decode(), score, own.get(3, NORMAL)))
        elif number == 2:
            own = dict(fields(value))
            model.kind, model.byte_fallback = own.get(3, UNIGRAM), bool(own.get(35, 0))
        elif number == 3:
            own = dict(fields(value))
            model.charsmap = bytes(own.get(2, b""))
            model.dummy_prefix, model.squeeze = bool(own.get(3, 1)), bool(own.get(4, 1))
            model.escape = bool(own.get(5, 1))
    return model


def merges(model):
    """All ways to join two pieces to a third, best score first, shorter left part first."""
    normal = {text: score for text, score, kind in model.pieces if kind in (NORMAL, USER_DEFINED, UNUSED)}
    found = [(-score, len(left), left, right) for text, score in normal.items()
             for left, right in ((text[:i], text[i:]) for i in range(1, len(text)))
             if left in normal and right in normal]
    return [(left, right) for *_, left, right in sorted(found)]


def backend(model):
    """The tokenizers pipeline of a parsed model."""
    unknown = next((i for i, p in enumerate(model.pieces) if p[2] == UNKNOWN), None)
    if model.kind == BPE:
        vocabulary = {text: i for i, (text, _, _) in enumerate(model.pieces)}
        core = models.BPE(vocabulary, merges(model), unk_token=model.pieces[unknown][0] if unknown is not None else None,
                          fuse_unk=True, byte_fallback=model.byte_fallback)
    elif model.kind == UNIGRAM:
        core = models.Unigram([(text, score) for text, score, _ in model.pieces], unknown, model.byte_fallback)
    else:
        raise ValueError(f"model type {model.kind} has no counterpart")
    built = Tokenizer(core)
    rules = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.squeeze:
        rules += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.dummy_prefix:
        rules.append(normalizers.Prepend(MARK if model.escape else " "))
    built.normalizer = normalizers.Sequence(rules)
    if model.escape:
        # a text stays whole: to cut it into words and encode these costs more than merging it at once
        built.pre_tokenizer = pre_tokenizers.Metaspace(MARK, "never", split=False)
    own = [decoders.Metaspace(MARK, "never"), decoders.ByteFallback(), decoders.Fuse()]
    if model.dummy_prefix:
        own.append(decoders.Strip(" ", 1, 0))
    built.decoder = decoders.Sequence(own)
    return built


def decoding(model):
    """A tokenizers pipeline that only decodes, as ``backend`` does: its pieces hold blanks in
    place of markers, so that none has to be replaced in every piece of every text."""
    vocabulary = {text.replace(MARK, " "): i for i, (text, _, _) in enumerate(model.pieces)}
    if len(vocabulary) < len(model.pieces):
        return backend(model)  # two pieces differ in blank and marker only
    built = Tokenizer(models.BPE(vocabulary, []))
    own = [decoders.Strip(" ", 1, 0)] if model.dummy_prefix else []
    built.decoder = decoders.Sequence([decoders.ByteFallback(), decoders.Fuse(), *own])
    return built


_ready = {}


def shipped(spark, model_path):
    """(key, broadcast pipelines and model) of a model file."""
    with open(model_path, "rb") as file:
        data = file.read(MAX_MODEL_BYTES + 1)
    if len(data) > MAX_MODEL_BYTES:
        raise ValueError(f"{model_path} has more than {MAX_MODEL_BYTES} bytes")
    model = parse(data)
    shared = spark.sparkContext.broadcast((backend(model).to_str(), decoding(model).to_str(), data))
    return hashlib.sha256(data).hexdigest(), shared


def loaded(key, built, back, data):
    """Encoder, decoder and library of a model, built once per Python worker."""
    if key not in _ready:
        _ready.clear()
        _ready[key] = (Tokenizer.from_str(built), Tokenizer.from_str(back),
                       sentencepiece.SentencePieceProcessor(model_proto=data))
    return _ready[key]


def encode(docs, model_path=MODEL, text="text", threads=None,
           names=("ids", "n_tokens", "parity", "round_trip")):
    """``docs`` plus the piece ids of ``text``, their number, whether both libraries agree
    on them, and whether the decoder gives the text back from them.

    Null and empty texts have no ids, agree and come back (null as null). Texts that hold
    the marker character itself, or that the model's normaliser changes, do not come back;
    that is the model's rule. A task encodes on ``threads`` threads, by default as many as it
    has cores (``spark.task.cpus``). ``names`` get leading underscores where ``docs`` has such
    columns.
    """
    threads = threads or int(docs.sparkSession.conf.get("spark.task.cpus", "1"))
    key, shared = shipped(docs.sparkSession, model_path)
    out = []
    for name in names:
        out.append(fresh(docs.columns + out, name))
    schema = StructType(list(docs.schema.fields))
    for name, kind in zip(out, (ArrayType(IntegerType()), IntegerType(), BooleanType(), BooleanType())):
        schema = schema.add(name, kind)

    def each(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        fast, decoder, plain = loaded(key, *shared.value)
        for part in steps(batches, text, STEP_BYTES):
            texts = part.column(text).fill_null("").to_pylist()
            ours = [e.ids for e in fast.encode_batch_fast(texts, add_special_tokens=False)]
            theirs = plain.encode(texts, num_threads=threads)
            same = [a == b for a, b in zip(ours, theirs)]
            ids = [a if s else b for a, b, s in zip(ours, theirs, same)]
            sizes = [len(x) for x in ids]
            flat = np.fromiter(chain.from_iterable(ids), np.int32, sum(sizes))
            back = decoder.decode_batch(ids, skip_special_tokens=False)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays(
                [*part.columns, lists, pa.array(sizes, pa.int32()), pa.array(same),
                 pa.array([a == b for a, b in zip(back, texts)])], names=schema.names)

    return docs.mapInArrow(each, schema)


def decode(rows, model_path=MODEL, ids="ids", name="decoded"):
    """``rows`` plus the text of its column of piece ids; null stays null."""
    key, shared = shipped(rows.sparkSession, model_path)
    out = fresh(rows.columns, name)
    schema = StructType(list(rows.schema.fields)).add(out, "string")

    def each(batches):
        _, decoder, _ = loaded(key, *shared.value)
        for batch in batches:
            lists = batch.column(ids).to_pylist()
            texts = decoder.decode_batch([x or [] for x in lists], skip_special_tokens=False)
            texts = [None if x is None else t for x, t in zip(lists, texts)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=schema.names)

    return rows.mapInArrow(each, schema)
