"""The operators against brute force on a small table with the awkward cases."""

import gzip
import hashlib
import io
import random
import subprocess
import sys
import tracemalloc
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import tiktoken
from pyspark.sql import functions as F

from vellumark.llm import bpe, classifier, knn, mixing, neardup, phrases, pseudo, rules, suffixes, warc

DRAW = random.Random(7)
VOCABULARY = ["".join(DRAW.choice("abcdefgh") for _ in range(DRAW.randint(2, 7))) for _ in range(400)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, row string, score double"


def words(n):
    return [DRAW.choice(VOCABULARY) for _ in range(n)]


def sample_rows():
    base, passage = words(300), words(70)
    near = [*base[:150], "changed", *base[151:]]
    rows = [
        (1, " ".join(base), "en", "b"),
        (2, " ".join(base), "en", "b"),
        (2, " ".join(base), "en", "b"),
        (3, " ".join(near), "en", "a"),
        (4, " ".join([*words(40), *passage, *words(40)]), "fr", None),
        (5, " ".join([*words(20), *passage, *words(60)]) + "\n\n é😀 tail", "fr", "c"),
        (6, None, None, None),
        (7, "", "en", "c"),
        (8, "\t \n", "en", "c"),
        (9, "one two", "en", "a"),
        (10, "a " * 5000 + "###", "en", "d"),
        (None, " ".join(base), "en", "d"),
        (11, " ".join(words(3000)), "en", "a"),
    ]
    return [(i, t, lang, s, 0, 1, "x", 0.0) for i, t, lang, s in rows]


ROWS = sample_rows()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, None) for i in range(1, 12)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")


def split(text):
    return (text or "").encode().split()


def removed(rows, units, span, join):
    """By brute force: (units, removed, digest of the rest) per document."""
    first = {}
    for doc, text in rows:
        if doc is not None:
            unit = units(text)
            for i in range(len(unit) - span + 1):
                key = tuple(unit[i : i + span])
                first[key] = min(first.get(key, doc), doc)
    out = []
    for doc, text in rows:
        unit = units(text)
        gone = np.zeros(len(unit), bool)
        for i in range(len(unit) - span + 1):
            if doc is not None and first[tuple(unit[i : i + span])] < doc:
                gone[i : i + span] = True
        kept = [u for u, g in zip(unit, gone, strict=True) if not g]
        out.append((doc, len(unit), int(gone.sum()), hashlib.sha256(join(kept)).hexdigest()))
    return sorted(out, key=str)


def plain(rows):
    return [(r[0], r[1]) for r in rows]


def test_phrases(docs, empty):
    got = phrases.without_repeats(docs, docs.columns).select("row.doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=str) == removed(plain(ROWS), split, 50, b" ".join)
    assert phrases.without_repeats(empty, ["doc_id"]).count() == 0


def test_words_of_an_automaton_branch_in_two_steps():
    symbols = phrases.Symbols()
    texts = {symbols[b"%d" % i] for i in range(200_000)}
    assert len(texts) == 200_000 and symbols.UNKNOWN not in texts
    first, second = ({t[i] for t in texts} for i in (0, 1))
    assert len(first) < 200 and len(second) <= symbols.BASE and not first & second
    assert not any(0xD800 <= ord(c) < 0xE000 for c in first | second)


def test_passages_go_to_as_many_shards_as_the_words_need(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "211")
    try:
        few = spark.sparkContext.defaultParallelism
        assert phrases.shard_count(spark, 10) == few
        assert phrases.shard_count(spark, 50 * few * phrases.WORDS_PER_SHARD) == 50 * few
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_pooling_holds_few_words_at_once():
    texts = [b"one two three four " * 5000] * 30
    memo, vectors = classifier.WordHash(classifier.BUCKETS), np.ones((classifier.BUCKETS, classifier.WIDTH), np.float32)
    tracemalloc.start()
    try:
        classifier.pooled(texts, vectors, memo)
        assert tracemalloc.get_traced_memory()[1] < 100 << 20
    finally:
        tracemalloc.stop()


def test_scores_are_equal_with_and_without_the_kept_text(docs):
    random = np.random.default_rng(2)
    x, y, held = random.normal(size=(40, classifier.FEATURES)), np.arange(40) % 2, np.arange(40) % 5 == 0
    vectors = random.normal(size=(classifier.BUCKETS, classifier.WIDTH)).astype(np.float32)
    model = classifier.Model(vectors, classifier.Network(x, y, held))
    kept, alone = (classifier.scored(docs, model, keep).select("row.doc_id", "score").collect() for keep in (docs.columns, ["doc_id"]))
    assert sorted(map(tuple, kept), key=str) == sorted(map(tuple, alone), key=str)


def test_passages_go_only_to_documents_behind_their_owner(spark):
    passages = spark.createDataFrame([(1, 5, [70, 71]), (2, 8, [72])], "key long, owner long, phrases array<long>")
    rows = [(70, 5, 0), (70, 4, 1), (71, 4, 1), (71, 9, 2), (70, 6, 2), (72, 8, 0), (72, 7, 3)]
    got = phrases.passage_shards(passages, spark.createDataFrame(rows, "phrase long, doc long, shard int"))
    assert [tuple(r) for r in got.collect()] == [(1, 2)]


def test_a_window_belongs_to_its_smallest_owner():
    words = [b"w%d" % i for i in range(60)]
    for passages in ([(3, words), (7, words)], [(7, words), (3, words)]):
        automaton = phrases.PassageAutomaton(passages)
        assert automaton.removed(3, words) is None
        assert automaton.removed(4, words).all()


@pytest.mark.parametrize("most", [20_000, 1])
def test_suffixes(docs, empty, monkeypatch, most):
    monkeypatch.setattr(suffixes, "MOST_COPIES", most)
    got = suffixes.without_copies(docs, docs.columns).select("row.doc_id", "n_bytes", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=str) == removed(plain(ROWS), lambda t: (t or "").encode(), 50, bytes)
    assert suffixes.without_copies(empty, ["doc_id"]).count() == 0

def test_ranges_of_a_shard_are_one_row_for_each_bucket():
    """However many documents lose something, a shard gives no more rows than there are buckets."""
    text = random.Random(3).randbytes(60)
    kinds = ("<u4", "<i8", "<i8", "<u4", "u1", "u1")
    columns = np.full(30, 7), np.arange(30), np.zeros(30), np.zeros(30), np.full(30, 20), np.full(30, 60)
    arrays = [pa.array([c.astype(k).tobytes()], pa.binary()) for c, k in zip(columns, kinds, strict=True)]
    body = pa.array([pa.compress(text * 30, "zstd", asbytes=True)], pa.binary())
    table = pa.Table.from_arrays([pa.array([0], pa.int32()), pa.array([False]), *arrays, body], suffixes.FRAGMENTS)
    packed = suffixes.fragment_ranges(table, 3)
    assert packed.num_rows <= 3
    got = [r for n in packed.column("bucket").to_pylist() for r in suffixes.bucket_ranges(packed.filter(pc.equal(packed.column("bucket"), n))).to_pylist()]
    assert sorted((r["d"], r["starts"], r["ends"]) for r in got) == [(d, [0], [60]) for d in range(1, 30)]


def test_anchors_of_a_shard_are_one_row_for_each_bucket():
    """However many documents share an anchor, a shard gives no more rows than there are buckets."""
    kinds = ("<i8", "<i8", "<u2", "<u4", "<u4", "<u4")
    docs = np.arange(30)
    columns = docs, docs + 500, np.tile(docs, 2), np.repeat([7, 8], 30), np.concatenate([docs + 9, docs + 3]), np.full(60, 1 << 16 | 1)
    arrays = [pa.array([c.astype(k).tobytes()], pa.binary()) for c, k in zip(columns, kinds, strict=True)]
    packed = suffixes.shared_anchors(pa.Table.from_arrays([pa.array([0], pa.int32()), *arrays], suffixes.PACKED), 3)
    assert packed.num_rows <= 3
    parts = [packed.filter(pc.equal(packed.column("bucket"), n)) for n in packed.column("bucket").to_pylist()]
    got = sorted(tuple(r.values()) for part in parts for r in suffixes.document_anchors(part).to_pylist())
    assert got == [(d, d + 500, [d + 3, d + 9], []) for d in range(30)]


def test_previous_factors():
    text = "".join(DRAW.choice("ab") for _ in range(300)).encode()
    starts = np.arange(len(text) - suffixes.SPAN)
    rows = np.array([list(text[i : i + suffixes.SPAN]) for i in starts], np.uint8)
    doc = starts // 60
    order = suffixes.suffix_order(rows, doc)
    got = suffixes.previous_factors(suffixes.common_prefixes(rows[order]), doc[order])

    def shared(a, b):
        return next((k for k in range(suffixes.SPAN) if rows[a, k] != rows[b, k]), suffixes.SPAN)

    for rank, i in enumerate(order):
        assert got[rank] == max((shared(i, j) for j in starts if doc[j] < doc[i]), default=0)


def test_near_duplicates(docs, empty):
    got = {(r.doc_id, r.class_id) for r in neardup.near_duplicates(docs).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (None, None), *((i, i) for i in range(4, 12))}
    assert neardup.near_duplicates(docs).count() == docs.count()
    assert neardup.near_duplicates(empty).count() == 0
    kept = neardup.first_of_each_class(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, *range(4, 12)]


def test_near_duplicates_of_an_id_with_several_texts(spark):
    draw = random.Random(9)
    a, b, c, d = (" ".join(draw.choice(VOCABULARY) for _ in range(100)) for _ in range(4))
    rows = [(5, a), (5, b), (9, b), (7, c), (7, c + " tail"), (8, d), (8, d), (-3, None), (-3, d)]
    texts = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.class_id) for r in neardup.near_duplicates(texts).collect())
    assert got == [(-3, -3), (-3, -3), (5, 5), (5, 5), (7, 7), (7, 7), (8, -3), (8, -3), (9, 5)]
    kept = {tuple(r) for r in neardup.first_of_each_class(texts).collect()}
    assert {(5, a), (5, b), (-3, None), (-3, d)} < kept and len(kept) == 5 and {doc for doc, _ in kept} == {-3, 5, 7}


def family(draw, base, first, copies, most):
    """Copies of a text with up to ``most`` words changed, some of them cut short."""
    rows = []
    for i in range(copies):
        own = list(base)
        for _ in range(draw.randint(0, most)):
            own[draw.randrange(len(own))] = draw.choice(VOCABULARY)
        rows.append((first + i, " ".join(own[: draw.choice([len(own), len(own), len(own) - 20])])))
    return rows


@pytest.mark.parametrize("few", [32, 3])
def test_near_duplicates_of_large_groups(spark, monkeypatch, few):
    monkeypatch.setattr(neardup, "FEW", few)
    draw = random.Random(11)
    one, two = ([draw.choice(VOCABULARY) for _ in range(140)] for _ in range(2))
    # The second family shares most of its text with the first and goes its own way in ten words.
    near = [*one[:60], *two[60:64], *one[64:100], *two[100:104], *one[104:]]
    rows = family(draw, one, 0, 60, 9) + family(draw, near, 100, 60, 9) + family(draw, two, 200, 20, 4)
    memo = neardup.WordHash()
    sets = [neardup.text_multiset(t.encode(), memo) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if neardup.multiset_similarity(sets[i], sets[j]) >= neardup.SIMILARITY and root(i) != root(j):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    want = {(doc, rows[root(i)][0]) for i, (doc, _) in enumerate(rows)}
    got = {tuple(r) for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want


def test_signatures_are_unbiased():
    rng = np.random.default_rng(3)
    hashes = rng.integers(0, 1 << 63, 60).astype(np.uint64)
    a, b = rng.integers(1, 9, 60), rng.integers(1, 9, 60)
    truth = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    agree = []
    for turn in range(60):
        own = hashes + np.uint64(turn)
        one = neardup.signatures(np.zeros(60, np.int64), own, a, 1)
        two = neardup.signatures(np.zeros(60, np.int64), own, b, 1)
        agree.append((one == two).mean())
    assert abs(np.mean(agree) - truth) < 0.02


def test_classes(spark):
    links = spark.createDataFrame([(5, 4), (4, 3), (3, 2), (2, 1), (9, 8), (8, 7), (9, 7), (20, 1)], "a long, b long")
    got = {r.doc: r["class"] for r in neardup.classes(links).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 20: 1, 7: 7, 8: 7, 9: 7}


def test_rules(docs, labels, empty):
    got = {r.doc_id: r for r in rules.quality_verdicts(docs, labels).collect()}
    for doc, text in plain(ROWS):
        own, lines, seen = split(text), (text or "").split("\n"), Counter()
        for i in range(len(own) - 2):
            seen[tuple(own[i : i + 3])] += 1
        repeated = {i + j for i in range(len(own) - 2) if seen[tuple(own[i : i + 3])] > 1 for j in range(3)}
        full = [line for line in lines if line.strip()]
        row = got[doc]
        assert row.n_words == len(own) and row.n_repeat_words == len(repeated)
        assert row.n_dup_lines == len(full) - len(set(full))
        assert row.word_chars == sum(len(w.decode()) for w in own)
        assert row.n_symbols == sum((text or "").count(c) for c in "#*$%&|<>")
        assert row.base_failed == (len(own) < 50 or 100 * len(repeated) > 50 * len(own))
        assert not (row.base_failed and row.kept)
    assert rules.quality_verdicts(empty, labels).count() == 0


def test_rules_reject_planted_junk(spark):
    """Proven cutoffs reject what the base rule lets pass, in large strata and, pooled, in small ones."""
    draw = random.Random(4)
    sizes = {"en": 900, "de": 400, "ia": 170, "eo": 170}
    rows, good = [], {}
    for lang, size in sizes.items():
        for _ in range(size):
            good[len(rows)] = lang
            rows.append((len(rows), " ".join(draw.choice(VOCABULARY) for _ in range(draw.randint(80, 120))), lang))
    junk = {}
    for lang in ("en", "de", "ia", "eo", "none", None):
        for _ in range(5):
            junk[len(rows)] = lang
            rows.append((len(rows), " ".join(f"{draw.choice(VOCABULARY)}##$$%%" for _ in range(90)), lang))
    texts = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i in good)) for i in range(len(rows))], "doc_id long, quality int")
    got = {r.doc_id: r for r in rules.quality_verdicts(texts, labels).collect()}
    assert len(got) == len(rows) and not any(r.base_failed for r in got.values())
    for doc, lang in junk.items():
        assert got[doc].kept == (lang in ("none", None)) and ("symbols" in got[doc].rejected_by) == (not got[doc].kept)
    assert sum(not got[doc].kept for doc in good) <= rules.RISK * len(good)


def test_proposed_cutoffs_never_get_looser():
    path = rules.proposed([0] * 10 + [1, 2, 5, 9, 40] + [100] * 25, 100, 0.02)
    assert path == sorted(path, reverse=True) and len(path) == rules.LOOSER + 1 + rules.SHARES
    assert path[rules.LOOSER] == 2.0 ** (-9 / 4) and path[-1] == 2.0 ** (-11 / 4)
    assert (1 - 0.02) ** rules.least_total(0.02, 0.01) <= 0.01 < (1 - 0.02) ** (rules.least_total(0.02, 0.01) - 1)


def test_binomial_tail():
    from math import comb

    for bad, total, share in ((0, 50, 0.1), (3, 400, 0.02), (1, 3, 0.9)):
        exact = sum(comb(total, i) * share**i * (1 - share) ** (total - i) for i in range(bad + 1))
        assert rules.binomial_tail(bad, total, share) == pytest.approx(exact, rel=1e-9)


def test_mixing(docs, empty):
    rows = mixing.mixed(docs).collect()
    assert len(rows) == docs.count() and all(r.taken <= 3 * r["size"] for r in rows)
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, mixing.mixed(docs).collect()), key=str)
    sizes = Counter()
    for row in ROWS:
        sizes[row[3]] += len(split(row[1]))
    order = [*sorted(s for s in sizes if s is not None), None]
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    fixed = {}
    while True:
        free = {s for s in sizes if s not in fixed}
        left = sum(sizes.values()) - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        if not over:
            break
        fixed |= {s: 3.0 * sizes[s] for s in over}
    target = fixed | share
    taken = Counter()
    for row in rows:
        assert row.source_size == sizes[row.source] and row.target == pytest.approx(target[row.source])
        taken[row.source] += row.taken
    for source, wanted in target.items():
        assert abs(taken[source] - wanted) <= 2 * mixing.BLOCK_WORDS
    assert mixing.mixed(empty).count() == 0
    assert mixing.mixed_documents(docs).columns == docs.columns


def test_mixed_documents_keep_rows_without_an_id(spark):
    draw = random.Random(6)
    rows = [(None if i % 2 or i < 200 else i, " ".join(draw.choices(VOCABULARY, k=50)), "abc"[i % 3]) for i in range(900)]
    rows.append((None, None, "a"))
    own = spark.createDataFrame(rows, "doc_id long, text string, source string")
    target = {r.source: r.target for r in mixing.mixed(own).select("source", "target").distinct().collect()}
    got = mixing.mixed_documents(own).collect()
    assert {tuple(r) for r in got} <= set(rows) and any(r.doc_id is None for r in got)
    words_of = Counter()
    for r in got:
        words_of[r.source] += len(split(r.text))
    for source, wanted in target.items():
        assert abs(words_of[source] - wanted) <= 0.1 * wanted


def test_permutation():
    for size in (1, 2, 3, 17, 64, 1000):
        at = mixing.permuted(np.arange(size), np.full(size, size), np.full(size, 12345, np.uint64))
        assert sorted(at.tolist()) == list(range(size))


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def test_recurring_windows_travel_packed(spark):
    passage, draw = words(80), random.Random(5)
    texts = {doc: [*words(draw.randint(0, 60)), *passage[draw.randint(0, 9) :], *words(20)] for doc in (-(1 << 62), -3, 4, 9, 300, 1 << 62)}
    texts[12] = words(200)
    first, last = {}, {}
    for doc, text in sorted(texts.items()):
        for at in range(len(text) - phrases.SPAN + 1):
            window = tuple(text[at : at + phrases.SPAN])
            first.setdefault(window, (doc, at))
            last[window] = doc
    rows = [(doc, " ".join(text), list(range(len(text) - phrases.PHRASE + 1))) for doc, text in texts.items()]
    for buckets in (1, 3, 50):
        frame = spark.createDataFrame(rows * 20, "doc long, body string, places array<int>").repartition(2)
        packed = phrases.candidate_windows(frame, buckets)
        # A bucket is one row for each batch, and a window is in it twice at most, however many documents hold it.
        assert packed.count() <= 2 * buckets
        assert packed.agg(F.sum(F.length("one"))).first()[0] <= 2 * 2 * 8 * len(first)
        found = phrases.owned_windows(packed).collect()
        assert sorted(map(tuple, found)) == sorted(place for window, place in first.items() if place[0] < last[window])
    assert phrases.owned_windows(phrases.candidate_windows(frame.limit(0), 3)).count() == 0


def test_bpe(docs, empty, ranks):
    table = bpe.parse_ranks(ranks)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
    encoder = bpe.Encoder(table, public_tokenizers.PATTERN)
    parts = ["a", "é", "😀", "\n", " ", "  ", "1", "ing", "tion", "中", "'s", "\t", "\x1c", "\xa0", "²", "<|endoftext|>"]
    texts = ["".join(DRAW.choice(parts) for _ in range(DRAW.randint(0, 60))) for _ in range(400)]
    texts += ["".join(DRAW.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(40)) for _ in range(200)]
    for text in texts:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library.encode_ordinary(text)
    out = bpe.decoded(bpe.encoded(docs, ranks, public_tokenizers.PATTERN, ["doc_id", "score"]), ranks, ["doc_id", "n_tokens"])
    wanted = []
    for doc, text in plain(ROWS):
        ids = np.array(library.encode_ordinary(text or ""), "<u4")
        wanted.append((doc, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest(), text or ""))
    assert sorted(map(tuple, out.collect()), key=str) == sorted(wanted, key=str)
    assert bpe.encoded(empty, ranks, public_tokenizers.PATTERN, ["doc_id"]).count() == 0


def test_bpe_of_short_pieces_builds_no_states(ranks):
    table, plain = bpe.parse_ranks(ranks), tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.parse_ranks(ranks), special_tokens={})
    encoder = bpe.Encoder(table, public_tokenizers.PATTERN)
    draw = random.Random(11)
    text = " ".join("".join(draw.choice("aeinorstXÉß9") for _ in range(draw.randint(1, 14))) for _ in range(3000))
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == plain.encode_ordinary(text)
    assert len(encoder.transducer.items) == 1
    long = "".join(draw.choice("aeinorst") for _ in range(500))
    assert np.frombuffer(encoder.encode(long), "<u4").tolist() == plain.encode_ordinary(long)
    assert len(encoder.transducer.items) > 1


def test_bpe_of_short_pieces_passes_through_the_transducer(ranks):
    table, plain = bpe.parse_ranks(ranks), tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.parse_ranks(ranks), special_tokens={})
    encoder, draw = bpe.Encoder(table, public_tokenizers.PATTERN), random.Random(12)
    pieces = ["".join(draw.choice("aeinorstbcdh") for _ in range(draw.randint(1, 64))) for _ in range(2000)]
    for piece in pieces:
        assert encoder.transducer.encode(piece.encode()) == plain.encode_ordinary(piece)
        assert np.frombuffer(encoder.encode(piece), "<u4").tolist() == plain.encode_ordinary(piece)
    # What it knows of neighbouring tokens comes from its steps only.
    assert len(encoder.transducer.fits) > 1000


def test_bpe_at_spaces_beside_other_white_space(ranks):
    table = bpe.parse_ranks(ranks)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
    encoder = bpe.Encoder(table, public_tokenizers.PATTERN)
    texts = ["foo \xa0 \xa0 bar", "foo \xa0 \xa0bar", "\xa0 \xa0", " \xa0 \xa0 ", "a \n b", "a \xa0 \n \xa0 b c", "a  b \xa0 c", "a ", " a"]
    draw = random.Random(3)
    parts = ["a", "1", "!", " ", " ", "\xa0", "\xa0 \xa0", "\n", "\t", "\u2003", "\x1c", "é"]
    texts += ["".join(draw.choice(parts) for _ in range(draw.randint(1, 14))) for _ in range(20_000)]
    for text in texts:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library.encode_ordinary(text), repr(text)


def test_utf8_stream():
    data = "aé中😀\x00z".encode() + b"\xff\xe4\xb8" + "ß".encode() + b"\xf0\x9f"
    for step in (1, 2, 3, 5):
        stream = bpe.Utf8Stream()
        text = "".join(stream.feed(data[i : i + step]) for i in range(0, len(data), step)) + stream.finish()
        assert text == data.decode("utf-8", "replace")


def test_knn(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(0, 1, 8)]) for i in range(120)]
    rows += [(200 + i, rows[0][1]) for i in range(40)] + [rows[3]]
    bad = [(900, None), (901, [1.0, None]), (902, [float("nan")] * 8), (None, rows[1][1]), (903, [])]
    data = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>")
    got = {tuple(r) for r in knn.top_products(data, F.col("id") % 20 == 0, pivots=6, block=30).collect()}
    held = {i: np.floor(64 * np.array(v)).astype(int) for i, v in rows}
    wanted = set()
    for query in (i for i in held if i % 20 == 0):
        best = sorted((-int(held[query] @ v), i) for i, v in held.items() if i != query)[:20]
        wanted |= {(query, rank + 1, i, -score) for rank, (score, i) in enumerate(best)}
    assert got == wanted
    assert knn.top_products(data.limit(0), F.col("id") % 20 == 0).count() == 0


@pytest.mark.parametrize("scale", [1, 1 << 58])
def test_leading_products(scale):
    rng = np.random.default_rng(2)
    score = rng.integers(-4, 5, (30, 17)) * scale
    score[3, 5:] = score[4] = knn.LEAST
    least = np.where(np.arange(30) % 2, 0, knn.LEAST)
    row, column = knn.leading_products(score, least, 4)
    for i in range(30):
        usable = [j for j in range(17) if score[i, j] > knn.LEAST and score[i, j] >= least[i]]
        assert sorted(column[row == i].tolist()) == sorted(sorted(usable, key=lambda j: (-int(score[i, j]), j))[:4])


def test_mixed_widths():
    vectors = [np.array([1, -2]), np.array([300, 4]), np.array([1 << 40, -(1 << 40)])]
    packed = [v.astype(knn._narrowest(v)).tobytes() for v in vectors]
    assert [len(p) for p in packed] == [2, 4, 16]
    assert (knn.matrix(packed, 2) == np.stack(vectors)).all()


def test_warc(spark, tmp_path):
    long = "<p>équal</p>" * 20
    rows = [(5, "http://a.example/ä b", long), (3, None, long), (9, "u", long), (1, "u", None), (2, "u", "x"), (4, "v", "x"), (None, "w", "alone" * 50)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.record_id: (r.record_type, r.refers_to, r.payload_bytes) for r in warc.archived_pages(spark, pages).collect()}
    size = len(long.encode())
    assert got == {
        "3": ("response", None, size), "5": ("revisit", "3", size), "9": ("revisit", "3", size), "1": ("response", None, 0),
        "2": ("response", None, 1), "4": ("response", None, 1), None: ("response", None, 250),
    }
    path = f"file://{tmp_path}/archive"
    warc.write_archive(warc.archive_records(pages), path)
    found = warc.read_archive(spark, path).filter("record_type = 'revisit' and record_id in ('5', '3')").collect()
    assert [(r.record_id, r.target_uri, r.payload) for r in found] == [("5", "http://a.example/ä b", None)]
    assert warc.read_archive(spark, path, payload=False).filter("payload is not null").count() == 0
    assert warc.archived_pages(spark, pages.limit(0)).count() == 0


def test_warc_headers_as_given_and_checksums(spark, tmp_path):
    given = ["http://a/b%2Fc?q=%0A", "http://a/é 😀", "two\r\nWARC-Type: revisit\u2028", " edge ", "", None]
    rows = [(f"{i}\nx" if i == 2 else str(i), uri, b"" if i == 1 else b"pay%d" % i) for i, uri in enumerate(given)] + [(None, "u", b"z" * 300_000)]
    frame = spark.createDataFrame(rows, "record_id string, target_uri string, payload binary").selectExpr(
        "'response' record_type", "record_id", "target_uri", "cast(null as string) refers_to", "sha2(payload, 256) payload_digest",
        "cast(length(payload) as long) payload_length", "payload",
    )
    path = str(tmp_path / "own")
    warc.write_archive(frame, path)
    columns = warc.SCHEMA.fieldNames()
    assert sorted(map(str, warc.read_archive(spark, path).select(columns).collect())) == sorted(map(str, frame.select(columns).collect()))
    assert warc.read_archive(spark, path).filter(F.col("target_uri") == given[0]).select("record_id").first()[0] == "0"

    record = warc.record_bytes({"record_type": "response", "record_id": "1"}, b"payload" * 99)
    broken = record[:-8] + bytes([record[-8] ^ 1]) + record[-7:]
    with pytest.raises(ValueError, match="checksum"):
        list(warc.read_records(io.BytesIO(broken), {}, True))
    # An unwanted record is jumped over.
    kept = list(warc.read_records(io.BytesIO(broken + record), {"record_type": {"revisit"}}, True))
    assert kept == [] and len(list(warc.read_records(io.BytesIO(broken + record), {}, False))) == 2


def test_warc_of_other_writers(spark, tmp_path):
    def record(kind, ident, body, more=""):
        return f"WARC/1.0\r\nWARC-Type:{kind}\r\nwarc-record-id: <urn:uuid:{ident}>\r\n{more}Content-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"

    parts = [
        record("warcinfo", "a", b"software: x\r\n"),
        record("response", "b", b"HTTP/1.1 200 OK\r\n\r\n<p>\r\n\r\n</p>", "WARC-Target-URI: http://x/%41\r\n  b\r\n"),
        record("request", "c", b"G" * 100_000),
    ]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "plain.warc").write_bytes(b"".join(parts))
    (tmp_path / "in" / "each.warc.gz").write_bytes(b"".join(map(gzip.compress, parts)))
    (tmp_path / "in" / "whole.warc.gz").write_bytes(gzip.compress(b"".join(parts)))
    (tmp_path / "in" / "notes.txt").write_bytes(b"none")
    for path, files in ((tmp_path / "in", 3), (tmp_path / "in" / "each.warc.gz", 1)):
        got = warc.read_archive(spark, f"file://{path}").collect()
        assert sorted((r.record_type, r.record_id, r.payload_length) for r in got) == sorted(
            [("warcinfo", "<urn:uuid:a>", 13), ("response", "<urn:uuid:b>", 30), ("request", "<urn:uuid:c>", 100_000)] * files
        )
        found = warc.read_archive(spark, f"file://{path}").filter("record_type = 'response'").collect()
        assert {(r.target_uri, bytes(r.payload)) for r in found} == {("http://x/%41 b", b"HTTP/1.1 200 OK\r\n\r\n<p>\r\n\r\n</p>")}


def test_classifier(spark, docs, labels, empty):
    rows = [(i, " ".join(words(60)) if i % 2 else "JUNK!! " * 30, i % 2) for i in range(400)]
    own = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    out = classifier.quality_scores(own, own).toPandas().merge(own.toPandas(), on="doc_id")
    held = out[out.held_out]
    assert len(held) > 40 and ((held.score > 0.5) == (held.quality == 1)).mean() > 0.95
    assert set(classifier.quality_scores(docs, labels.limit(0)).select("score").toPandas().score) == {0.5}
    assert classifier.quality_scores(docs, labels).count() == docs.count()
    assert classifier.quality_scores(empty, labels).count() == 0


def test_pseudo_likelihood(spark, docs, empty):
    rows = [(i, "the cat sat on the mat and the dog ran " * 10) for i in range(200)] + [(999, " ".join(words(100)))]
    own = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r.mean_log_likelihood for r in pseudo.pseudo_likelihood(own).collect()}
    assert out[5] > out[999] and out[5] > -8
    again = {r.doc_id: r.mean_log_likelihood for r in pseudo.pseudo_likelihood(own.repartition(3)).collect()}
    assert out == pytest.approx(again)
    got = {r.doc_id: r for r in pseudo.pseudo_likelihood(docs).collect()}
    assert got[6].n_tokens == 0 and got[6].log_likelihood == 0 and got[6].mean_log_likelihood is None
    assert pseudo.pseudo_likelihood(empty).count() == 0


def test_pseudo_likelihood_tells_words_of_a_class_apart(spark):
    memo = pseudo.WordHash(4096)
    usual = memo[b"the"]
    junk = next(w for w in (f"junk{i}" for i in range(100_000)) if memo[w.encode()] == usual)
    rows = [(i, "the cat sat on the mat and the dog ran " * 10) for i in range(200)]
    rows += [(900, "cat sat on the mat and " * 3), (901, f"cat sat on {junk} mat and " * 3)]
    out = {r.doc_id: r.log_likelihood for r in pseudo.pseudo_likelihood(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[900] > out[901] + 5


def test_pseudo_likelihood_probabilities_add_up(spark):
    """With more words than classes the probabilities of all words at a place still add up to 1."""
    draw = random.Random(5)
    names = [f"w{i}" for i in range(9000)]
    rows = [(i, " ".join(draw.choices(names, [1 / (j + 1) for j in range(9000)], k=1000))) for i in range(40)]
    rows.append((41, " ".join(names)))
    own = spark.createDataFrame(rows, "doc_id long, text string")
    counts = pseudo.word_counts(own, "text")
    truth = Counter(w for _, t in rows for w in t.split())
    assert {r.word: r.n for r in counts.collect()} == {int(np.uint64(pseudo.WordHash()[w.encode()]).view(np.int64)): n for w, n in truth.items()}
    known = pseudo.vocabulary(counts)
    assert 0 < len(known.own) < 9000 and known.occurrences.sum() > 0 and known.total == sum(truth.values())
    # The same network scores each word between the same neighbours.
    places = spark.createDataFrame([(i, f"w1 w2 {w} w3 w4") for i, w in enumerate(names)], "doc_id long, text string")
    network = pseudo.fitted(pseudo.numbered(own, "doc_id", "text", known), known.clusters)
    ids = {w: int(known.classes(np.array([pseudo.WordHash()[w.encode()]], np.uint64).view(np.int64))[0]) for w in names}
    total = 0.0
    for w in names:
        around = np.array([ids["w1"], ids["w2"], ids[w], ids["w3"], ids["w4"]])
        at = float(pseudo.log_probabilities(network, around, np.zeros(5, np.int64))[2])
        inside = 1.0 if ids[w] < len(known.own) else truth[w] / known.occurrences[ids[w] - len(known.own)]
        total += np.exp(at) * inside
    assert 0.999 < total < 1.0001
    got = {r.doc: r.total for r in pseudo.scored(pseudo.numbered(places, "doc_id", "text", known), counts, known, network).collect()}
    for i in (0, 1, 100, 5000, 8999):
        parts = [ids[x] for x in ("w1", "w2", names[i], "w3", "w4")]
        want = float(pseudo.log_probabilities(network, np.array(parts), np.zeros(5, np.int64)).sum())
        for x in ("w1", "w2", names[i], "w3", "w4"):
            if ids[x] >= len(known.own):
                want += np.log(truth[x] / known.occurrences[ids[x] - len(known.own)])
        assert got[i] == pytest.approx(want, rel=1e-6)


def test_pseudo_likelihood_trains_on_every_place():
    for shard in range(3):
        places = np.concatenate([pseudo.targets(1001, shard, turn) for turn in range(pseudo.ROUNDS)])
        assert sorted(places.tolist()) == list(range(1001))


def test_pseudo_likelihood_of_a_small_vocabulary_adds_up(spark):
    """With ten words nearly all classes are empty; none of them takes probability from the words."""
    draw = random.Random(6)
    names = [f"v{i}" for i in range(10)]
    own = spark.createDataFrame([(i, " ".join(draw.choices(names, k=200))) for i in range(20)], "doc_id long, text string")
    known = pseudo.vocabulary(pseudo.word_counts(own, "text"))
    network = pseudo.fitted(pseudo.numbered(own, "doc_id", "text", known), known.clusters)
    ids = known.classes(as_signed_hashes(names))
    for around in ([0, 1, 2, 3], [9, 9, 9, 9]):
        places = [np.array([*ids[around[:2]], i, *ids[around[2:]]]) for i in ids]
        total = sum(np.exp(pseudo.log_probabilities(network, p, np.zeros(5, np.int64))[2]) for p in places)
        assert 0.999 < total < 1.001


def as_signed_hashes(names):
    return np.array([int(np.uint64(pseudo.WordHash()[w.encode()]).view(np.int64)) for w in names], np.int64)


def test_a_worker_gives_the_memory_of_a_group_back():
    """Freed below what is still held, memory stays with the process unless it is trimmed."""
    code = """
import numpy as np, pyarrow as pa
from vellumark.llm import common

def resident():
    return int(open("/proc/self/statm").read().split()[1]) * 4 // 1024

kept = []
def group(table):
    parts = []
    for _ in range(2000):
        parts.append(np.ones(100_000, np.uint8))
        kept.append(np.ones(1000, np.uint8))
    return table

run = getattr(common, "trimmed_groups", lambda f: f)(group)
before = resident()
run(pa.table({"x": [1]}))
print(resident() - before)
"""
    said = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).parents[2], capture_output=True, text=True, check=True)
    assert int(said.stdout) < 60


def test_pseudo_likelihood_keeps_a_shard_in_one_row(spark, monkeypatch):
    """Turns and the scoring read the words where they are; the shares of several shards come from several ranges of hashes."""
    monkeypatch.setattr(pseudo, "WORDS_PER_SHARD", 30_000)
    draw = random.Random(8)
    names = [f"w{i}" for i in range(9000)]
    texts = {i: " ".join(draw.choices(names, [1 / (j + 1) for j in range(9000)], k=1000)) for i in range(80)}
    texts[80], texts[81], texts[82] = " ".join(names), "", None
    own = spark.createDataFrame([*texts.items(), (7, texts[7])], "doc_id long, text string")
    counts = pseudo.word_counts(own, "text")
    known = pseudo.vocabulary(counts)
    rows = pseudo.numbered(own, "doc_id", "text", known)
    kept = rows.collect()
    assert len(kept) == len({r.shard for r in kept}) > 1
    assert all(r.docs == sorted(r.docs) and 4 * sum(r.sizes) == len(r.ids) for r in kept)
    assert sorted(d for r in kept for d in r.docs) == sorted([*texts, 7])
    network = pseudo.new_network(known.clusters)
    often = {r.word: r.n for r in counts.collect()}
    got = {r.doc: (r.n, r.total) for r in pseudo.scored(rows, counts, known, network).collect()}
    for doc in (3, 7, 80, 81, 82):
        hashes = as_signed_hashes((texts[doc] or "").split())
        ids = known.classes(hashes)
        want = pseudo.log_probabilities(network, ids, np.zeros(len(ids), np.int64)).sum()
        want += sum(np.log(often[int(h)] / known.occurrences[i - len(known.own)]) for h, i in zip(hashes, ids, strict=True) if i >= len(known.own))
        assert got[doc] == (len(ids), pytest.approx(want, rel=1e-6))
