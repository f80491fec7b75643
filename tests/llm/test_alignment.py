"""Alignment of two tokenizers against a plain version."""

import hashlib
import json
from collections import Counter

import pyarrow as pa
import pytest
import sentencepiece
from compare import connect
from demandlens.llm import alignment, catalog
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.01"
TEXTS = [None, "", "Hello world", "a ▁ b", "<|endoftext|> x <s> </s> <unk>", " lead", "tab\tnew\n\n x   y ",
         "日本語 ünï", "\x00zero", "é ﬁ", "x" * 50, "  ", "😀🏽 ok", " nb", "trail ", "Hello world"]


@pytest.fixture(scope="module")
def both():
    first = Tokenizer.from_file(alignment.FIRST)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=alignment.SECOND)
    names = {i: t for t, i in first.get_vocab().items()}
    letters = alignment.byte_of_letter()
    return (lambda t: first.encode(" " + t, add_special_tokens=False).ids, second.encode,
            lambda i: bytes(letters[c] for c in names[i]),
            lambda i: bytes([int(second.id_to_piece(i)[3:5], 16)]) if second.is_byte(i)
            else second.id_to_piece(i).replace("▁", " ").encode())


def ends(sizes):
    out, total = [], 0
    for s in sizes:
        total += s
        out.append(total)
    return out


def plain(text, both):
    """n_a, n_b, n_groups, groups and the linked ids of a text."""
    encode_a, encode_b, bytes_a, bytes_b = both
    if not text:
        return 0, 0, 0, "", []
    a, b = encode_a(text), encode_b(text)
    x, y = [bytes_a(i) for i in a], [bytes_b(i) for i in b]
    if b"".join(x) != (" " + text).encode() or b"".join(y) != (" " + text).encode():
        return 0, 0, 0, "", []
    x, y = ends(map(len, x)), ends(map(len, y))
    at = {}
    for i, e in zip(b, y):
        at.setdefault(e, []).append(i)
    links = [(i, j) for i, e in zip(a, x) for j in at.get(e, ())]
    cuts, groups, before = sorted(set(x) & set(y)), [], 0
    parts = [{c: [] for c in cuts} for _ in range(2)]
    for ids, e, part in ((a, x, parts[0]), (b, y, parts[1])):
        k = 0
        for i, end in zip(ids, e):
            while cuts[k] < end:
                k += 1
            part[cuts[k]].append(str(i))
    groups = ";".join(f"{','.join(parts[0][c])}|{','.join(parts[1][c])}" for c in cuts)
    return len(a), len(b), len(cuts), groups, links


def expected(rows, both):
    found = [(i, plain(t, both)) for i, t in rows]
    counts = Counter(x for _, f in found for x in f[4])
    top = {}
    for (_, j), n in counts.items():
        top[j] = max(top.get(j, 0), n)
    return sorted(((i if i is not None else -1), n_a, n_b, g, len(links), sum(counts[x] == top[x[1]] for x in links),
                   sum(counts[x] for x in links), hashlib.sha256(s.encode()).hexdigest() if s else "")
                  for i, (n_a, n_b, g, s, links) in found)


def told(rows, name="doc"):
    return sorted((-1 if r[name] is None else r[name], r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum,
                   r.groups_sha256) for r in rows)


def test_query_equals_plain(spark, both):
    rows = connect(SF).execute("SELECT doc_id, text FROM documents").fetchall()
    got = catalog.QUERIES["op13_tokenizer_alignment"](spark, SF).collect()
    assert told(got, "doc_id") == expected(rows, both)


@pytest.mark.parametrize("step_bytes", [1, 40, 1 << 20])
def test_edges_in_steps_of_any_size(spark, both, step_bytes):
    rows = [(i if i != 4 else None, t) for i, t in enumerate(TEXTS)] + [(2, "Hello world")]
    frame = spark.createDataFrame([(i, t, "s", 1) for i, t in rows], "doc_id long, text string, step string, pair int")
    got = alignment.align(frame.repartition(3), step_bytes=step_bytes).collect()
    assert told(got) == expected(rows, both)
    assert alignment.align(frame.limit(0)).collect() == []


def test_aligned_takes_slices(both):
    _, first, second = alignment.files(alignment.FIRST, alignment.SECOND)
    sides = alignment.ByteLevel(first), alignment.Pieces(second)
    whole = pa.array(TEXTS, pa.string())
    for begin in range(0, len(TEXTS), 3):
        figures, spelt, pairs = alignment.aligned(whole.slice(begin, 5), *sides)
        want = [plain(t, both) for t in TEXTS[begin:begin + 5]]
        assert [tuple(int(f[i]) for f in figures[:3]) + (spelt[i].as_py(),) for i in range(len(want))] == [w[:4] for w in want]
        assert [(p >> 32, p & 0xFFFFFFFF) for p in pairs.to_pylist()] == [x for w in want for x in w[4]]


def test_ids_by_rank_are_those_of_the_tokenizers_library():
    _, data, _ = alignment.files(alignment.FIRST, alignment.SECOND)
    ours, plain = alignment.ByteLevel(data), Tokenizer.from_str(data.decode())
    plain.encode_special_tokens = True
    assert ours.ranked is not None
    own = ours.surface
    entries = [own.data[b:b + n].tobytes() for b, n in zip(own.begin, own.size)]
    texts = [e.decode() for e in entries if e.decode("utf-8", "replace").encode() == e]
    assert len(texts) > 45_000
    letters = [chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    texts += ["".join(f"a{c}b 1{c}2 {c}{c} .{c}.'{c}  {c}\n{c} " for c in letters[i:i + 400]) for i in range(0, len(letters), 400)]
    want = [e.ids for e in plain.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
    assert [x.tolist() for x in ours.encode(texts)] == want


def test_other_files_go_to_the_tokenizers_library():
    _, data, _ = alignment.files(alignment.FIRST, alignment.SECOND)
    model = json.loads(data)
    core = model["model"]
    core["merges"][0], core["merges"][1] = core["merges"][1], core["merges"][0]
    other = alignment.ByteLevel(json.dumps(model).encode())
    assert other.ranked is None and other.encode(["Hello there"])
