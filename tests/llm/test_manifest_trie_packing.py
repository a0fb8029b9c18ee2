"""Merkle manifest, prefix trie and packed ids against brute force on awkward rows."""

import hashlib
import random
import sys
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vellumark.llm import merkle, packing, trie
from vellumark.session import new_path

DRAW = random.Random(11)


# Merkle manifest


def h(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, text):
    return h(["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (*row[:4], text)])


def climb(nodes):
    """The root, and per node its runs with the node's place, from the bottom."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, path in enumerate(paths):
            first = at[i] // 3 * 3
            path.append((nodes[first : first + 3], at[i] - first))
            at[i] //= 3
        nodes = [h(nodes[i : i + 3]) for i in range(0, len(nodes), 3)]
    return nodes[0], paths


def expected_manifest(rows):
    by = defaultdict(list)
    for row in rows:
        by[row[1]].append((row[0] is not None, row[0] or 0, leaf_of(row, row[4]), row))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: climb([x[2] for x in sorted(by[s], key=lambda x: x[:3])]) for s in sources}
    root, upper = climb([trees[s][0] for s in sources])
    out = []
    for source, above in zip(sources, upper, strict=True):
        for (_, _, leaf, row), below in zip(sorted(by[source], key=lambda x: x[:3]), trees[source][1], strict=True):
            path = below + above
            node = leaf
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[4] is not None:
                node = leaf_of(row, row[4].replace("\n", ""))
            for run, i in path:
                node = h([*run[:i], node, *run[i + 1 :]])
            siblings = [d for run, i in path for k, d in enumerate(run) if k != i]
            out.append((row[0], leaf, trees[source][0], root, h(siblings), node, node == root))
    return sorted(out, key=str)


def manifest_rows():
    rows = [(i, DRAW.choice(["a", "a", "b", "é", ""]), "en", i % 5, f"line {i}\nof text é") for i in range(60)]
    rows += [(i, "lone", None, None, None) for i in (7,)]
    rows += [(None, "a", "en", 1, "x\ny"), (None, None, None, None, None), (3, None, "fr", 2, ""), (3, None, "fr", 2, ""), (-4, "b", "en", 1, "\n\n")]
    rows += [(900, "a", "en", 1, "word\n" * 200_000)]
    return rows


@pytest.mark.parametrize("levels", [1, 2, 7])
def test_manifest(spark, monkeypatch, levels):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle.appended, "__defaults__", (levels,))
    rows = manifest_rows()
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, source string, lang string, n_chars long, text string, tree string, node int")
    got = sorted((tuple(r) for r in merkle.verified(merkle.manifest(docs)).collect()), key=str)
    assert got == expected_manifest(rows)
    changed = {r[0] for r in rows if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and "\n" in (r[4] or "")}
    assert {r[0] for r in got if not r[-1]} == changed


def test_manifest_of_one_row_and_none(spark):
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    row = (1, None, "en", 3, "abc")
    got = merkle.verified(merkle.manifest(spark.createDataFrame([row], schema))).collect()
    leaf = leaf_of(row, "abc")
    assert [tuple(r) for r in got] == [(1, leaf, leaf, leaf, hashlib.sha256(b"").hexdigest(), leaf, True)]
    assert merkle.verified(merkle.manifest(spark.createDataFrame([], schema))).count() == 0


@pytest.mark.parametrize("size", [*range(1, 12), 27, 28, 80, 82])
def test_appended_witnesses_lead_to_the_root(size):
    nodes = [hashlib.sha256(bytes([i])).digest() for i in range(size)]
    tree = merkle.Appender()
    for node in nodes:
        tree.append(node)
    root = tree.close()
    assert root.hex() == climb([n.hex() for n in nodes])[0]
    for node, witness, shape in zip(nodes, tree.witness, tree.shape, strict=True):
        assert merkle.fold(node, b"".join(witness), bytes(shape)) == root


# Prefix trie


def expected_trie(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {conv: [t[2:] for t in sorted(own)] for conv, own in turns.items()}
    rebuilt = {}
    for conv, own in turns.items():
        taken = zlib.crc32(str(conv).encode()) % 4
        rebuilt[conv] = tuple(turns.get(conv - conv % 20, [])[:taken] + own[taken:])
    members, children = defaultdict(list), defaultdict(list)
    for conv, sequence in rebuilt.items():
        for depth in range(len(sequence) + 1):
            members[sequence[:depth]].append(conv)
    for prefix in members:
        if prefix:
            children[prefix[:-1]].append(prefix)
    out = []

    def totals(prefix):
        leaves = 0 if children[prefix] else 1
        saved = (len(members[prefix]) - 1) * len(prefix[-1][1].encode().split()) if prefix else 0
        for child in children[prefix]:
            more = totals(child)
            leaves, saved = leaves + more[0], saved + more[1]
        ends = ",".join(str(c) for c in sorted(members[prefix]) if len(rebuilt[c]) == len(prefix))
        parent = min(members[prefix[:-1]]) if prefix else None
        out.append((min(members[prefix]), len(prefix), parent, len(members[prefix]), len(children[prefix]), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
        return leaves, saved

    sys.setrecursionlimit(5000)
    if members:
        totals(())
    return sorted(out, key=str)


SCHEMA = "conv_id long, turn long, role string, text string, name string, depth int"


def conversation_rows(longest):
    rows = []
    for conv in range(70):
        for turn in range(DRAW.choice([1, 2, 3, 5])):
            rows.append((conv, turn, DRAW.choice(["user", "assistant"]), DRAW.choice(["a b", "c", "d  e\nf", ""])))
    rows += [(85, t, "user", "same") for t in range(longest)] + [(86, t, "user", "same") for t in range(longest - 1)]
    rows += [(None, 1, "user", "lost"), (40, None, None, None), (40, None, None, None), (119, 0, "user", "no head"), (3, 1, "user", "tie"), (3, 1, "user", "tie")]
    rows += [(200, 0, "user", "long " * 300_000), (201, 5, None, "x")]
    return rows


@pytest.mark.parametrize("longest", [1, 4, 37])
def test_trie(spark, monkeypatch, longest):
    monkeypatch.setattr(trie, "CHUNK_IDS", 3)
    monkeypatch.setattr(trie, "HEAVY", 10)
    rows = conversation_rows(longest)
    table = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)
    got = sorted((tuple(r)[:8] for r in trie.conversation_trie(table).collect()), key=str)
    assert got == expected_trie(rows)


def test_trie_of_turnless_conversations_and_none(spark):
    lone = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 >= 1)
    got = trie.conversation_trie(spark.createDataFrame([(lone, 0, "user", "x", "", 0)], SCHEMA)).collect()
    assert [tuple(r)[:8] for r in got] == [(lone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(lone).encode()).hexdigest())]
    assert trie.conversation_trie(spark.createDataFrame([], SCHEMA)).count() == 0


# Packed ids


TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "Plain words, plain words and 12345 numbers.",
    None,
    "",
    " \t\n\x0b\x0c\r",
    "ÅNGSTRÖM café café İstanbul ΣΑΣ Σ ΑΣ. ﬁn",
    "a b   c\x1cd \x85 e​f ́x e ́ ",
    "<|endoftext|> and <|startoftext|>x <|endoftext|",
    "it's we'll 'S don't''ve",
    "漢字かな交じり文 😀👩‍👩‍👧 اللغة",
    "x" * 5000,
    "wörter " * 60_000,
    "line\nline\n\nline",
]


def test_piecewise_ids_are_those_of_the_library():
    encoder, whole = packing.PieceEncoder(TOKENIZER, limit=50), Tokenizer.from_file(TOKENIZER)
    assert encoder.cuts
    letters = "aBéÉ '’s.,!?\u0301é\n\tΣ漢😀1<|>\u00a0\u2003İßŉſÞ×"
    texts = TEXTS + ["".join(DRAW.choices(letters, k=DRAW.randint(1, 200))) for _ in range(2000)]
    for start in range(0, len(texts), 7):
        part = texts[start : start + 7]
        got = [ids.tolist() for ids in encoder(pa.array(part, pa.string()))]
        assert got == [whole.encode(text or "", add_special_tokens=False).ids for text in part]
    assert encoder(pa.array([], pa.string())) == []


def test_tokenizers_that_keep_white_space_encode_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder, whole = packing.PieceEncoder(path), Tokenizer.from_file(path)
    assert not encoder.cuts
    assert [ids.tolist() for ids in encoder(pa.array(TEXTS))] == [whole.encode(t or "", add_special_tokens=False).ids for t in TEXTS]


@pytest.mark.parametrize("width", [1, 3, 8, 13, 16, 17, 24, 31, 32])
@pytest.mark.parametrize("count", [0, 1, 7, 4096, 70_001])
def test_bits(width, count):
    ids = np.random.default_rng(width).integers(0, 1 << width, count, dtype=np.uint32)
    data = packing.pack(ids, width)
    assert len(data) == -(-count * width // 8)
    assert np.array_equal(packing.unpack(data, width, count), ids)


def test_random_access(tmp_path):
    path, draw = str(tmp_path / "x.vpk"), np.random.default_rng(3)
    documents = [draw.integers(0, 1 << 17, n, dtype=np.uint32) for n in (0, 5, 10_000, 1, 4096, 3)]
    with pa.OSFile(path, "wb") as raw:
        writer = packing.FileWriter(raw, 17)
        for i, ids in enumerate(documents):
            writer.add(i if i else None, ids)
        writer.close()
    file = packing.PackedFile(pa.OSFile(path))
    everything = np.concatenate(documents)
    assert [np.array_equal(file.document(i), ids) for i, ids in enumerate(documents)] == [True] * 6
    for start, end in ((0, 0), (0, 1), (4095, 4097), (9000, 14_000), (0, len(everything))):
        assert np.array_equal(file.range(start, end), everything[start:end])
    damaged = bytearray(open(path, "rb").read())
    damaged[100] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        packing.PackedFile(pa.BufferReader(bytes(damaged))).range(0, 10)
    with pytest.raises(ValueError, match="cut off"):
        packing.PackedFile(pa.BufferReader(bytes(damaged[:-3])))


def test_packed_documents(spark):
    rows = [(i if i != 3 else None, text, "x", 1) for i, text in enumerate(TEXTS)] + [(5, TEXTS[0], "y", 2), (5, TEXTS[0], "y", 2), (-9, "first", "z", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, packed string, start int").repartition(3)
    whole = Tokenizer.from_file(TOKENIZER)
    expected = []
    for doc, text, *_ in rows:
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        expected.append((doc is not None, doc or 0, len(ids), zlib.crc32(packing.pack(ids, 16)), ids))
    expected.sort(key=lambda r: r[:4])
    starts = np.cumsum([0, *[r[2] for r in expected]])
    path = new_path(spark, "packed-test")
    got = packing.packed_documents(docs, TOKENIZER, path=path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("sum")).collect()
    want = [(r[1] if r[0] else None, int(s), r[2], zlib.crc32(r[4].tobytes())) for r, s in zip(expected, starts, strict=False)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    # Filters on the id reach the index; arrays and no ids at all are other forms of reading.
    arrays = packing.read_packed(spark, path, "array")
    assert [r.ids for r in arrays.filter("doc_id = -9").collect()] == [expected[1][4].tolist()]
    assert sorted(r.doc_id for r in packing.read_packed(spark, path, "none").filter("doc_id in (5, 10, 77)").collect()) == [5, 5, 5, 10]
    empty = packing.packed_documents(spark.createDataFrame([], docs.schema), TOKENIZER)
    assert empty.count() == 0 and empty.columns == ["doc_id", "start", "n_tokens", "ids"]


def test_files_of_bounded_size_keep_the_order(spark):
    rows = [(i, f"w{i} " * (i % 7)) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    table, path = packing.written(packing.encoded(docs, TOKENIZER, 17, 1), "packed-test"), new_path(spark, "packed-test")
    packing.write_packed(table, path, 17, file_ids=50)
    got = packing.read_packed(spark, path).orderBy("doc_id").collect()
    assert [r.doc_id for r in got] == list(range(200))
    assert [r.start for r in got] == np.cumsum([0, *[r.n_tokens for r in got]])[:-1].tolist()
