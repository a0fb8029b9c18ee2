"""Removing repeated byte strings with longest-previous-factor arrays.

A byte goes if a string of ``SPAN`` bytes that covers it also starts in a document
with a smaller doc_id.

1. Anchors: of every string of ``SPAN`` bytes, the ``GRAM`` bytes with the least hash.
   Equal strings have equal anchors. They travel once, packed: a task sends each shard one
   row of arrays. The shard drops anchors of one text only, and those whose ``SIDE`` bytes before
   and whose ``SIDE`` bytes after are both found in one document only: a string of
   ``SPAN`` bytes reaches that far to one side at least. What is left goes on packed, one row for
   each shard and bucket of documents, and is put together by document there.
   Of equal texts only the first document goes on; later ones lose every byte.
2. Around each anchor left, a fragment holds all strings that it anchors. Fragments are
   dealt out by the hash of their anchor, so all copies of a string meet in one shard.
   Of equal fragments of a batch only those of the first document travel with their bytes.
   Distinct fragments of an anchor with more than ``MOST_COPIES`` copies are cut into their
   strings first and dealt out by the hash of all bytes, so no anchor fills a shard.
3. A shard keeps, of equal fragments, the first document; later ones are covered
   whole. Over the distinct fragments it sorts the suffixes, takes the common prefixes
   of neighbours, and gets for every suffix the longest previous factor from the
   nearest positions above and below in suffix order whose document is smaller.
4. The ranges that have a previous factor of ``SPAN`` bytes or more travel packed, one row for each
   shard and bucket of documents, are joined within a document there, and are cut.

Null texts are empty. Rows without an id match nothing and lose nothing. A row that
repeats a document is treated like it; rows that repeat an id with another text (told apart
by 64 bits of its hash) are cut by their own text, and not by each other.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import anchors, chunks, covered, discard, gram_hashes, mix, prepare, release, shards_for, texts_of, trimmed, trimmed_groups, written

SPAN = 50
GRAM = 16
LEFT = SPAN - GRAM
SIDE = LEFT // 2
MOST_COPIES = 20_000
CHUNK_BYTES = 1 << 20
SUFFIXES_AT_ONCE = 150_000
ANCHORS_AT_ONCE = 1 << 20
ANCHORS_PER_SHARD = 1_000_000
FRAGMENTS_PER_SHARD = 60_000
BYTES_PER_BUCKET = 256 << 20

_BYTE = mix(np.arange(256, dtype=np.uint64) + np.uint64(7))


def _firsts(docs: np.ndarray, texts: list[bytes]) -> list[int]:
    """Rows of a batch that hold a text's smallest document, one for each text."""
    least = {}
    for row in np.argsort(docs, kind="stable").tolist():
        least.setdefault(texts[row], row)
    return sorted(least.values())


def _runs(values: np.ndarray) -> np.ndarray:
    """Where runs of equal neighbours begin."""
    return np.flatnonzero(np.concatenate([[len(values) > 0], values[1:] != values[:-1]])) if len(values) else np.empty(0, np.int64)


def _by_shard(shard: np.ndarray):
    """(shard, rows) for each shard that occurs."""
    order = np.argsort(shard, kind="stable")
    for rows in np.split(order, _runs(shard[order])[1:]) if len(order) else ():
        yield int(shard[rows[0]]), rows


def byte_anchors(df: DataFrame, shards: int) -> DataFrame:
    """Packed anchors of (doc, variant, body): one row for each shard that a task has anchors for.

    An anchor has 14 bytes: 32 bits of its hash below those that name the shard (more anchors may meet
    by chance, which costs work only), its text, its place, and 16 bits of a hash of the bytes before it
    and 16 of those after it; 0 where the text ends sooner.
    """

    def side(values, owner, at, begin):
        """Hash of the SIDE bytes from ``at + begin`` on, 1 to 65535."""
        first, last = at + begin, at + begin + SIDE - 1
        inside = (first >= 0) & (last < len(owner))
        inside &= owner[np.clip(first, 0, len(owner) - 1)] == owner[at]
        inside &= owner[np.clip(last, 0, len(owner) - 1)] == owner[at]
        hashes = gram_hashes(values, SIDE)[np.clip(first, 0, max(0, len(owner) - SIDE))]
        return np.where(inside, mix(hashes) % np.uint64(65535) + np.uint64(1), np.uint64(0)).astype(np.uint32)

    def packed(held):
        docs, kinds, owners, grams, places, sides = (np.concatenate(c) for c in zip(*held, strict=True))
        out = []
        for shard, rows in _by_shard(((grams >> np.uint64(32)) % np.uint64(shards)).astype(np.int64)):
            used, owner = np.unique(owners[rows], return_inverse=True)
            arrays = (docs[used], kinds[used], owner.astype("<u2"), grams[rows].astype("<u4"), places[rows], sides[rows])
            out.append((shard, *(x.tobytes() for x in arrays)))
        columns = list(zip(*out, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[1:])], PACKED)

    def find(batches):
        held, rows_held, anchors_held = [], 0, 0
        for batch in batches:
            docs, kinds = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            texts = texts_of(batch.column(2))
            rows = _firsts(docs, texts)
            docs, kinds, texts = docs[rows], kinds[rows], [texts[i] for i in rows]
            sizes = np.array([len(t) for t in texts], np.int64)
            for first, last in chunks(sizes, CHUNK_BYTES):
                part = sizes[first:last]
                owner = np.repeat(np.arange(last - first, dtype=np.int32), part)
                values = _BYTE[np.frombuffer(b"".join(texts[first:last]), np.uint8)]
                grams = mix(gram_hashes(values, GRAM))
                at = anchors(grams, owner, GRAM, SPAN)
                if not len(at):
                    continue
                sides = (side(values, owner, at, -SIDE) << np.uint32(16)) | side(values, owner, at, GRAM)
                place = (at - (np.cumsum(part) - part)[owner[at]]).astype("<u4")
                held.append((docs[first:last], kinds[first:last], owner[at] + rows_held, grams[at], place, sides))
                rows_held += last - first
                anchors_held += len(at)
                if anchors_held >= ANCHORS_AT_ONCE or rows_held > 60_000:
                    yield packed(held)
                    held, rows_held, anchors_held = [], 0, 0
        if held:
            yield packed(held)

    schema = "shard int, " + ", ".join(f"{name} binary" for name in PACKED[1:])
    return df.select("doc", "variant", "body").mapInArrow(trimmed(find), schema)


PACKED = ["shard", "docs", "kinds", "owners", "grams", "places", "sides"]
SHARED = "bucket int, docs binary, kinds binary, hot binary, sizes binary, places binary"
PLACED = "d long, v long, places array<int>, hot array<int>"


def _unpacked(table: pa.Table, name: str, kind: str) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), kind) for x in table.column(name)]


def _lists(values: np.ndarray, begins: np.ndarray) -> pa.Array:
    offsets = np.append(begins, len(values)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))


def _bucket(docs: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(docs.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def _by_bucket(rows: list[tuple], names: list[str]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    kinds = [pa.int32(), *[pa.binary()] * (len(names) - 1)]
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def shared_anchors(table: pa.Table, buckets: int) -> pa.Table:
    """Places of a shard's anchors that two documents have with the same bytes before or after.

    One row for each bucket of documents that has some: documents, how many places each has, and the places.
    """
    parts = _unpacked(table, "docs", "<i8")
    base = np.cumsum([0, *map(len, parts)])[:-1]
    docs, kinds = np.concatenate(parts), np.concatenate(_unpacked(table, "kinds", "<i8"))
    text = np.concatenate([o + b for o, b in zip(_unpacked(table, "owners", "<u2"), base, strict=True)])
    grams, places, sides = (np.concatenate(_unpacked(table, name, "<u4")) for name in ("grams", "places", "sides"))

    def shared(keys, rows):
        """Rows whose key is found in two documents and two texts, and the size of their groups."""
        rows = rows[np.argsort(keys[rows], kind="stable")]
        begin = _runs(keys[rows])
        if not len(begin):
            return rows, rows
        of = text[rows]
        several = np.ones(len(begin), bool)
        for values in (docs[of], kinds[of]):
            several &= np.minimum.reduceat(values, begin) < np.maximum.reduceat(values, begin)
        size = np.diff(np.append(begin, len(rows)))
        chosen = np.repeat(several, size)
        return rows[chosen], np.repeat(size, size)[chosen]

    rows, copies = shared(grams, np.arange(len(grams)))
    hot = np.zeros(len(grams), bool)
    hot[rows] = copies > MOST_COPIES
    wanted = np.zeros(len(grams), bool)
    for part in (sides >> np.uint32(16), sides & np.uint32(0xFFFF)):
        keys = (grams.astype(np.uint64) << np.uint64(16)) | part
        wanted[shared(keys, rows[part[rows] > 0])[0]] = True
    rows = np.flatnonzero(wanted)
    rows = rows[np.lexsort((places[rows], hot[rows], text[rows]))]
    out = []
    for bucket, chosen in _by_shard(_bucket(docs[text[rows]], buckets)):
        at = rows[chosen]
        begin = _runs(text[at] * 2 + hot[at])
        of, sizes = text[at[begin]], np.diff(np.append(begin, len(at)))
        arrays = docs[of], kinds[of], hot[at[begin]].astype("u1"), sizes.astype("<u4"), places[at].astype("<u4")
        out.append((bucket, *(x.tobytes() for x in arrays)))
    return _by_bucket(out, ["bucket", "docs", "kinds", "hot", "sizes", "places"])


def document_anchors(table: pa.Table) -> pa.Table:
    """(d, v, places, hot) of a bucket's documents, one row each: places of their anchors, and of those with many copies."""
    names = (("docs", "<i8"), ("kinds", "<i8"), ("hot", "u1"), ("sizes", "<u4"), ("places", "<u4"))
    docs, kinds, hot, sizes, places = (np.concatenate(_unpacked(table, name, kind)) for name, kind in names)
    order = np.lexsort((kinds, docs))
    new = np.ones(len(order), bool)
    new[1:] = (docs[order[1:]] != docs[order[:-1]]) | (kinds[order[1:]] != kinds[order[:-1]])
    number = np.empty(len(order), np.int32)
    number[order] = np.cumsum(new) - 1
    first = order[new]
    number, hot = np.repeat(number, sizes), np.repeat(hot, sizes)
    lists = []
    for kind in (0, 1):
        rows = np.flatnonzero(hot == kind)
        rows = rows[np.lexsort((places[rows], number[rows]))]
        lists.append(_lists(places[rows], np.searchsorted(number[rows], np.arange(len(first)))))
    return pa.Table.from_arrays([pa.array(docs[first]), pa.array(kinds[first]), *lists], ["d", "v", "places", "hot"])


FRAGMENTS = ["shard", "known", "grams", "docs", "kinds", "starts", "offsets", "lengths", "bytes"]


def fragments(df: DataFrame, shards: int) -> DataFrame:
    """Packed fragments of (doc, variant, body, places, hot): one row for each shard that a batch has some for.

    Of an anchor's hash the upper half is sent, which the shard does not tell; the bytes are compressed. Rows that are ``known`` hold ranges without bytes: of a fragment that a smaller document of the batch has, too.
    """

    def of_first(docs, pieces):
        """Which pieces of a batch are those of their first document, and their lengths."""
        code, _ = pd.factorize(pieces)
        first = np.full(code.max() + 1, np.iinfo(np.int64).max)
        np.minimum.at(first, code, docs)
        return docs == first[code], np.fromiter(map(len, pieces), np.uint8, len(pieces))

    def cut(batches):
        for batch in batches:
            docs, kinds = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            columns = {False: [], True: []}
            for row, text in enumerate(texts_of(batch.column(2))):
                hashes = mix(gram_hashes(_BYTE[np.frombuffer(text, np.uint8)], GRAM))
                for hot, column in ((False, 3), (True, 4)):
                    at = batch.column(column)[row].values.to_numpy(zero_copy_only=False)
                    if not len(at):
                        continue
                    start, end = np.maximum(at - LEFT, 0), np.minimum(at + SPAN, len(text))
                    pieces = [text[a:b] for a, b in zip(start.tolist(), end.tolist(), strict=True)]
                    n = len(at)
                    columns[hot].append((hashes[at], np.full(n, docs[row]), np.full(n, kinds[row]), start, at - start, pieces))
            out = []
            for hot, parts in columns.items():
                if not parts:
                    continue
                held = [np.concatenate(c) for c in list(zip(*parts, strict=True))[:5]]
                pieces = np.array([p for part in parts for p in part[5]], object)
                own, lengths = of_first(held[1], pieces)
                out.extend(_known(held, lengths, ~own))
                if hot:
                    # Strings that hold the anchor, each a fragment of its own.
                    held, pieces = _cut_apart(held, pieces, np.flatnonzero(own))
                    own, lengths = of_first(held[1], pieces)
                    out.extend(_known(held, lengths, ~own))
                rows = np.flatnonzero(own)
                for shard, chosen in _by_shard((held[0][rows] % np.uint64(shards)).astype(np.int64)):
                    body = pa.compress(b"".join(pieces[rows[chosen]]), "zstd", asbytes=True)
                    out.append((shard, False, *_arrays(held, lengths, rows[chosen]), body))
            if out:
                done = list(zip(*out, strict=True))
                kinds_of = [pa.int32(), pa.bool_(), *[pa.binary()] * 7]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(done, kinds_of, strict=True)], FRAGMENTS)

    def _arrays(held, lengths, rows):
        grams, docs, kinds, starts, offsets = (c[rows] for c in held)
        arrays = (grams >> np.uint64(32)).astype("<u4"), docs.astype("<i8"), kinds.astype("<i8"), starts.astype("<u4"), offsets.astype(np.uint8), lengths[rows]
        return [x.tobytes() for x in arrays]

    def _known(held, lengths, which):
        """Ranges that need no further comparison, for the shard that their documents hash to."""
        rows = np.flatnonzero(which)
        shard = mix(held[1][rows].view(np.uint64)) % np.uint64(shards)
        return [(s, True, *_arrays(held, lengths, rows[chosen]), b"") for s, chosen in _by_shard(shard.astype(np.int64))]

    def _cut_apart(held, pieces, rows):
        grams, docs, kinds, starts, offsets = held
        low, high = _strings(np.fromiter(map(len, pieces[rows]), np.int64, len(rows)), offsets[rows])
        count = high - low + 1
        of = np.repeat(rows, count)
        inside = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
        strings = np.empty(len(of), object)
        strings[:] = [pieces[i][a : a + SPAN] for i, a in zip(of.tolist(), inside.tolist(), strict=True)]
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, strings), np.uint64, len(of))
        return [hashes, docs[of], kinds[of], starts[of] + inside, offsets[of] - inside], strings

    schema = "shard int, known boolean, " + ", ".join(f"{name} binary" for name in FRAGMENTS[2:])
    return df.select("doc", "variant", "body", "places", "hot").mapInArrow(trimmed(cut), schema)


def suffix_order(suffixes: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Order of suffixes (rows of SPAN bytes) by their bytes, then by document."""
    padded = np.zeros((len(suffixes), -(-SPAN // 8) * 8), np.uint8)
    padded[:, :SPAN] = suffixes
    keys = padded.view(">u8").astype(np.uint64)
    return np.lexsort((docs, *keys.T[::-1]))


def common_prefixes(ordered: np.ndarray) -> np.ndarray:
    """Bytes that each row shares with the row before; 0 for the first."""
    out = np.zeros(len(ordered), np.int64)
    if len(ordered) > 1:
        differs = ordered[1:] != ordered[:-1]
        out[1:] = np.where(differs.any(1), differs.argmax(1), ordered.shape[1])
    return out


def previous_factors(prefixes: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Per suffix, in suffix order, the longest prefix that a suffix of a smaller document shares.

    That suffix is the nearest one above or the nearest one below whose document is
    smaller. Both are found for all suffixes at once: every suffix points at its
    neighbour, and while the document there is not smaller, it jumps to where that
    one points, keeping the least common prefix on the way.
    """
    n = len(docs)
    best = np.zeros(n, np.int64)
    for step in (-1, 1):
        to = np.arange(n) + step
        # The prefix shared with the neighbour; nothing lies beyond the ends.
        shared = prefixes.copy() if step < 0 else np.concatenate([prefixes[1:], [0]])
        to = np.clip(to, 0, n - 1)
        todo = np.flatnonzero(shared > 0)
        while len(todo):
            todo = todo[(shared[todo] > 0) & (docs[to[todo]] >= docs[todo])]
            if not len(todo):
                break
            there = to[todo]
            least, jump = np.minimum(shared[todo], shared[there]), to[there]
            shared[todo], to[todo] = least, jump
        best = np.maximum(best, np.where(docs[to] < docs, shared, 0))
    return best


def _strings(lengths: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last start of a SPAN-byte string of a fragment that holds its anchor."""
    return np.maximum(offsets - LEFT, 0), np.minimum(offsets, lengths - SPAN)


def _joined(d: np.ndarray, v: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Ranges in the order of their documents, those of one document that touch as one."""
    order = np.lexsort((start, v, d))
    d, v, start, end = d[order], v[order], start[order], end[order]
    same = np.zeros(len(d), bool)
    same[1:] = (d[1:] == d[:-1]) & (v[1:] == v[:-1])
    block = np.cumsum(~same) - 1
    reach = np.maximum.accumulate(end + (block << 32)) - (block << 32)
    new = ~same
    new[1:] |= start[1:] > reach[:-1]
    begin = np.flatnonzero(new)
    end = reach[np.append(begin[1:], len(d)) - 1] if len(begin) else reach
    return d[begin], v[begin], start[begin], end


PACKED_RANGE = "bucket int, docs binary, kinds binary, starts binary, ends binary"


def fragment_ranges(table: pa.Table, buckets: int) -> pa.Table:
    """Packed ranges that the fragments of a shard lose, one row for each bucket of documents that loses some."""
    known = table.filter(table.column("known"))
    table = table.filter(pc.invert(table.column("known")))

    def arrays(table, name, kind):
        return np.concatenate([np.empty(0, kind), *_unpacked(table, name, kind)]).astype(np.int64)

    grams, docs, kinds = (arrays(table, name, kind) for name, kind in (("grams", "<u4"), ("docs", "<i8"), ("kinds", "<i8")))
    starts, offsets, sizes = (arrays(table, name, kind) for name, kind in (("starts", "<u4"), ("offsets", "u1"), ("lengths", "u1")))
    given = [arrays(known, name, kind) for name, kind in (("docs", "<i8"), ("kinds", "<i8"), ("starts", "<u4"), ("lengths", "u1"))]
    amounts = [int(n.sum(dtype=np.int64)) for n in _unpacked(table, "lengths", "u1")]
    body = b"".join([pa.decompress(x.as_buffer(), n, "zstd", asbytes=True) for x, n in zip(table.column("bytes"), amounts, strict=True)])
    ends = np.cumsum(sizes)
    pieces = np.empty(len(sizes), object)
    pieces[:] = [body[a:b] for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True)]
    code, distinct = pd.factorize(pieces)
    lengths = np.array([len(p) for p in distinct], np.int64)
    first = np.full(len(distinct), np.iinfo(np.int64).max)
    np.minimum.at(first, code, docs)
    later = docs > first[code]
    out = [(docs[later], kinds[later], starts[later], starts[later] + lengths[code[later]])]
    out.append((given[0], given[1], given[2], given[2] + given[3]))

    # Distinct fragments whose anchor has others, in runs of whole anchors.
    one = np.zeros(len(distinct), np.int64)
    one[code[::-1]] = np.arange(len(code))[::-1]
    gram_of, offset_of = grams[one], offsets[one]
    _, group, sizes = np.unique(gram_of, return_inverse=True, return_counts=True)
    order = np.argsort(group, kind="stable")
    order = order[sizes[group[order]] > 1]
    low, high = _strings(lengths, offset_of)
    amount = np.maximum(high - low + 1, 0)
    flagged = {}
    begin = 0
    while begin < len(order):
        total, end = 0, begin
        while end < len(order) and (total < SUFFIXES_AT_ONCE or group[order[end]] == group[order[end - 1]]):
            total += int(amount[order[end]])
            end += 1
        part = order[begin:end]
        begin = end
        size = amount[part]
        if not size.sum():
            continue
        text = np.frombuffer(b"".join(distinct[part]), np.uint8)
        base = np.cumsum(lengths[part]) - lengths[part]
        which = np.repeat(np.arange(len(part)), size)
        inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + low[part][which]
        suffixes = np.lib.stride_tricks.sliding_window_view(text, SPAN)[base[which] + inside]
        owner = first[part][which]
        sort = suffix_order(suffixes, owner)
        factor = previous_factors(common_prefixes(suffixes[sort]), owner[sort])
        hit = sort[factor >= SPAN]
        for piece, at in zip(part[which[hit]].tolist(), inside[hit].tolist(), strict=True):
            flagged.setdefault(piece, []).append(at)
    if flagged:
        mine = np.flatnonzero(~later & np.isin(code, np.fromiter(flagged, np.int64)))
        rows = []
        for i in mine.tolist():
            at = np.unique(flagged[code[i]])
            for run in np.split(at, np.flatnonzero(np.diff(at) > 1) + 1):
                rows.append((docs[i], kinds[i], starts[i] + run[0], starts[i] + run[-1] + SPAN))
        out.append(tuple(np.array(c, np.int64) for c in zip(*rows, strict=True)))
    columns = _joined(*(np.concatenate([o[i] for o in out]) for i in range(4)))
    rows = []
    for bucket, chosen in _by_shard(_bucket(columns[0], buckets)):
        rows.append((bucket, *(c[chosen].astype(k).tobytes() for c, k in zip(columns, ("<i8", "<i8", "<u4", "<u4"), strict=True))))
    return _by_bucket(rows, ["bucket", "docs", "kinds", "starts", "ends"])


def bucket_ranges(table: pa.Table) -> pa.Table:
    """Ranges (d, v, starts, ends) of a bucket's documents, one row each."""
    names = (("docs", "<i8"), ("kinds", "<i8"), ("starts", "<u4"), ("ends", "<u4"))
    d, v, start, end = _joined(*(np.concatenate(_unpacked(table, name, kind)).astype(np.int64) for name, kind in names))
    lists = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (v[1:] != v[:-1])]))
    return pa.Table.from_arrays([pa.array(d[lists]), pa.array(v[lists]), _lists(start, lists), _lists(end, lists)], ["d", "v", "starts", "ends"])


RANGE = "d long, v long, starts array<int>, ends array<int>"


def later_copies(texts: DataFrame) -> DataFrame:
    """(d, v, n) of documents whose whole text a smaller document has, with its bytes."""
    light = texts.select(F.col("doc").alias("d"), F.col("variant").alias("v"), F.octet_length("body").alias("n"), F.sha2("body", 256).alias("digest"))
    light = light.filter(F.col("n") >= SPAN)
    firsts = light.groupBy("digest").agg(F.min("d").alias("first"))
    return light.join(firsts, "digest").filter(F.col("first") < F.col("d")).select("d", "v", "n").distinct()


def repeated_ranges(plain: DataFrame) -> DataFrame:
    """(d, v, starts, ends): byte ranges that documents (doc, variant, body) lose."""
    spark = plain.sparkSession
    texts = plain.filter("doc is not null")
    copies = written(later_copies(texts), "suffix-copies")
    size = texts.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    # Two anchors for each window of SPAN - GRAM + 1 bytes, and one more.
    shards = shards_for(spark, 2 * size // (SPAN - GRAM + 2), ANCHORS_PER_SHARD)
    buckets = shards_for(spark, size, BYTES_PER_BUCKET)

    def shared_of(table: pa.Table) -> pa.Table:
        return shared_anchors(table, buckets)

    found = byte_anchors(texts, shards).groupBy("shard").applyInArrow(trimmed_groups(shared_of), SHARED)
    per_doc = found.groupBy("bucket").applyInArrow(trimmed_groups(document_anchors), PLACED)
    shared = written(per_doc.join(copies, ["d", "v"], "left_anti"), "suffix-shared")
    release(spark)
    amount = shared.agg(F.sum(F.size("places") + F.size("hot"))).first()[0] or 0
    shards = shards_for(spark, amount, FRAGMENTS_PER_SHARD)
    placed = texts.join(shared, (F.col("doc") == F.col("d")) & (F.col("variant") == F.col("v")))

    def ranges_of(table: pa.Table) -> pa.Table:
        return fragment_ranges(table, buckets)

    packed = fragments(placed, shards).groupBy("shard").applyInArrow(trimmed_groups(ranges_of), PACKED_RANGE)
    ranges = packed.groupBy("bucket").applyInArrow(trimmed_groups(bucket_ranges), RANGE)
    # Whole copies have no anchors here, so no document is in both.
    whole = copies.select("d", "v", F.array(F.lit(0)).alias("starts"), F.array(F.col("n").cast("int")).alias("ends"))
    out = written(ranges.unionByName(whole), "suffix-ranges")
    discard(shared, copies)
    release(spark)
    return out


def without_copies(df: DataFrame, keep: list[str], text: str = "text", ident: str = "doc_id", kept: str | None = "binary") -> DataFrame:
    """A struct ``row`` of the columns ``keep``, with n_bytes, n_removed, n_spans, kept_sha256 and kept.

    ``kept`` is what is left as "binary", as "string" (without characters that were cut apart), or null.
    """
    prepare(df.sparkSession)
    plain = df.select(
        F.struct(*keep).alias("row"), F.col(ident).cast("long").alias("doc"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("variant"), F.coalesce(F.col(text), F.lit("")).alias("body")
    )
    # A text that is kept travels in its row only.
    sent, body = (plain.drop("body"), F.coalesce(F.col("row")[text], F.lit(""))) if text in keep else (plain, F.col("body"))
    joined = sent.join(
        repeated_ranges(plain.select("doc", "variant", "body")), (F.col("doc") == F.col("d")) & (F.col("variant") == F.col("v")), "left"
    ).select("row", body.alias("body"), "starts", "ends")

    def cut(batches):
        for batch in batches:
            out = []
            starts, ends = batch.column(2), batch.column(3)
            for i, text in enumerate(texts_of(batch.column(1))):
                spans, left = 0, text
                if starts[i].is_valid and len(text):
                    gone = covered(starts[i].values.to_numpy(zero_copy_only=False), ends[i].values.to_numpy(zero_copy_only=False), len(text))
                    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                    left = np.frombuffer(text, np.uint8)[~gone].tobytes()
                shown = left if kept == "binary" else left.decode("utf-8", "ignore") if kept else None
                out.append((len(text), len(text) - len(left), spans, hashlib.sha256(left).hexdigest(), shown))
            columns = list(zip(*out, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary() if kept == "binary" else pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                ["row", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
            )

    fields = plain.schema["row"].dataType.simpleString()
    return joined.mapInArrow(trimmed(cut), f"row {fields}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept {kept or "string"}")
