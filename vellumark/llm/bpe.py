"""Byte-level BPE by a transducer, and streaming decoding.

Merging by rank is a function of bytes that a finite-state transducer can
compute from left to right: a prefix of a piece has one tokenisation, and two
tokens may stand next to each other exactly if merging their joined bytes gives
these two again. A state holds the token starts that may still matter: the
token before, the place in the trie of token bytes, and the tokens not yet
emitted. States are built when first met and remembered. What all starts of a
state agree on is emitted; a start dies once no token continues it, so output
waits for at most the longest token.

Every piece that is no token itself passes through it. In pieces of up to ``SHORT_PIECE`` bytes, as nearly
all words are, most states are met once: there one way is followed, and no state is remembered.

Null texts are empty; empty texts have no tokens.
"""

from __future__ import annotations

import base64
import hashlib
import struct

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, texts_of

MAX_STATES = 200_000
MAX_LOOKS = 24
MAX_PIECES = 400_000
MAX_BARE = 100_000
SHORT_PIECE = 64


def read_ranks(path: str) -> bytes:
    """The rank file, to be sent to the workers (its size is that of the vocabulary)."""
    with open(path, "rb") as file:
        return file.read()


def parse_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line)}


_PACK = [struct.Struct(f"<{n}I").pack for n in range(40)]


class Transducer:
    """Token ids of a piece; ``ranks`` must hold every byte."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {rank: token for token, rank in ranks.items()}
        self.fits: dict[int, bool] = {}
        self.spines: dict[tuple[int, bool], list[tuple[int, float]]] = {}
        self.halves: dict[int, list[int]] = {}
        self.reached: dict[int, bool] = {}
        self.forget()

        # Trie of token bytes: by node and byte the next node, the token it ends, and whether any goes on.
        self.child: dict[int, tuple[int, int | None, bool]] = {}
        child: dict[int, int] = {}
        ends: dict[int, int] = {}
        nodes = 1
        below: dict[int, list[int]] = {}
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                key = node << 8 | byte
                if key not in child:
                    child[key] = nodes
                    nodes += 1
                node = child[key]
                below.setdefault(node, []).append(rank)
            ends[node] = rank
        inner = {key >> 8 for key in child}
        self.child = {key: (node, ends.get(node), node in inner) for key, node in child.items()}
        self.below = {node: tokens for node, tokens in below.items() if len(tokens) <= MAX_LOOKS}
        self.open: dict[int, bool] = {}

    def forget(self) -> None:
        self.states: dict[tuple, int] = {}
        self.items: list[tuple] = []
        self.steps: list[dict[int, tuple[int, tuple]]] = []
        self.start = self._state(((-1, 0, ()),))

    def _state(self, items: tuple) -> int:
        found = self.states.get(items)
        if found is None:
            found = self.states[items] = len(self.items)
            self.items.append(items)
            self.steps.append({})
        return found

    def merged(self, data: bytes, least: int = 1) -> list[int]:
        """Merging by rank until ``least`` parts are left, for the bytes of single tokens."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > least:
            best, at = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 40), i) for i in range(len(parts) - 1))
            if best == 1 << 40:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[part] for part in parts]

    def _spine(self, token: int, right: bool) -> list[tuple[int, float]]:
        """The parts of a token at one of its edges, from a byte to the whole, each with the rank of the merge that ends it."""
        key = (token, right)
        found = self.spines.get(key)
        if found is None:
            parts, ends = [token], [float("inf")]
            while len(self.token[parts[-1]]) > 1:
                ends.append(parts[-1])
                parts.append(self._halves(parts[-1])[right])
            found = self.spines[key] = list(zip(parts[::-1], ends[::-1], strict=True))
        return found

    def _halves(self, token: int) -> list[int]:
        found = self.halves.get(token)
        if found is None:
            found = self.halves[token] = self.merged(self.token[token], 2)
        return found

    def _reached(self, token: int) -> bool:
        """Whether merging a token's bytes gives the token (a rank file may hold others)."""
        found = self.reached.get(token)
        if found is None:
            found = self.reached[token] = self.merged(self.token[token]) == [token]
        return found

    def _fit(self, before: int, token: int) -> bool:
        """Whether merging gives the second token, and the two stay apart when their bytes are merged together.

        A ``before`` below 0 is the start of a piece. Merges happen in the order of their ranks. Along that time the boundary
        lies between a part at the right edge of the first and a part at the left
        edge of the second; the two stay apart if neither pair of parts merges
        before one of them is taken by a merge of its own side.
        """
        key = before << 32 | token
        found = self.fits.get(key)
        if found is None:
            found = self._reached(token)
            if found and before >= 0:
                left, right, i, j = self._spine(before, True), self._spine(token, False), 0, 0
            while found and before >= 0:
                (a, a_end), (b, b_end) = left[i], right[j]
                joined = self.ranks.get(self.token[a] + self.token[b])
                if joined is not None and joined < a_end and joined <= b_end:
                    found = False
                    break
                if i + 1 == len(left) and j + 1 == len(right):
                    break
                if a_end <= b_end:
                    i += 1
                else:
                    j += 1
            if len(self.fits) >= 10 * MAX_STATES:
                self.fits.clear()
            self.fits[key] = found
        return found

    def _may_end(self, before: int, node: int) -> bool:
        """Whether a token at or below the node fits ``before``; assumed where that takes many looks."""
        tokens = self.below.get(node)
        if tokens is None or before < 0:
            return True
        key = node << 32 | before
        found = self.open.get(key)
        if found is None:
            found = any(self._fit(before, t) for t in tokens)
            if len(self.open) >= 10 * MAX_STATES:
                self.open.clear()
            self.open[key] = found
        return found

    def _step(self, state: int, byte: int) -> tuple[int, tuple]:
        moved, ended = [], None
        for before, node, pending in self.items[state]:
            found = self.child.get(node << 8 | byte)
            if found is None:
                continue
            node, token, _ = found
            if self._may_end(before, node):
                moved.append((before, node, pending))
            if ended is None and token is not None and self._fit(before, token):
                ended = (token, 0, (*pending, token))
        if ended is not None:
            moved.append(ended)
        common = moved[0][2]
        for _, _, pending in moved[1:]:
            n = 0
            while n < len(common) and n < len(pending) and common[n] == pending[n]:
                n += 1
            common = common[:n]
        n = len(common)
        items = tuple([(before, node, pending[n:]) for before, node, pending in moved])
        return self._state(items), common

    def stepped(self, piece: bytes) -> list[int]:
        """The tokens of a piece by steps whose states are not remembered.

        One way through the transducer is followed, token by token and the longest first; where no token fits, it goes
        back. A prefix has one tokenisation, so a place that led nowhere once is not entered again.
        """
        child, fits, size = self.child.get, self.fits.get, len(piece)
        tokens, ways, dead, at, before, fresh = [], [], set(), 0, -1, True
        while at < size:
            if fresh:
                node, inner, end, ways_on = 0, True, at, []
                while inner and end < size:
                    found = child(node << 8 | piece[end])
                    if found is None:
                        break
                    node, token, inner = found
                    end += 1
                    if token is not None:
                        ways_on.append((end, token))
            fresh = False
            while ways_on:
                end, token = ways_on.pop()
                if end not in dead:
                    fit = fits(before << 32 | token)
                    if fit or fit is None and self._fit(before, token):
                        ways.append((at, before, ways_on))
                        tokens.append(token)
                        at, before, fresh = end, token, True
                        break
            if not fresh:
                dead.add(at)
                at, before, ways_on = ways.pop()
                tokens.pop()
        return tokens

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(piece) <= SHORT_PIECE:
            return self.stepped(piece)
        if len(self.items) > MAX_STATES:
            self.forget()
        out: list[int] = []
        state, steps = self.start, self.steps
        for byte in piece:
            try:
                state, tokens = steps[state][byte]
            except KeyError:
                step = steps[state][byte] = self._step(state, byte)
                state, tokens = step
            if tokens:
                out += tokens
        out.extend(self.items[state][-1][2])  # the start at the end of the piece comes last
        return out


class NoCut(Exception):
    """A space at which no match needs to start."""


class Encoder:
    """Token ids of texts as little-endian 32-bit bytes; remembers words.

    ``at_spaces`` says that the pattern always starts a match at a space that
    precedes a character that is no white space, as patterns do whose words may
    begin with one space. Texts are then cut there first, and the pattern runs
    once per distinct word. A space before other white space, as in
    " \\xa0 \\xa0", may lie inside a match and is no cut.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, at_spaces: bool = True):
        self.transducer = Transducer(ranks)
        self.find = regex.compile(pattern).findall
        # White space as str.isspace has it, which is more than \s.
        self.cut = regex.compile(r" (?=[^\s\x1c-\x1f])").split
        self.at_spaces = at_spaces

        encoder = self

        class Words(dict):
            """Word -> ids of a space and the word."""

            def __missing__(self, word: str) -> bytes:
                if not word or word[0].isspace():
                    raise NoCut
                pieces = encoder.find(" " + word)
                ids = encoder._piece(pieces[0]) if len(pieces) == 1 else encoder._pieces(pieces)
                if len(word) <= 64:
                    if len(self) >= MAX_PIECES:
                        self.clear()
                    self[word] = ids
                return ids

        self.words = Words()
        # Ids of pieces that do not begin with a space.
        self.bare: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        found = self.bare.get(piece)
        if found is None:
            ids = self.transducer.encode(piece.encode())
            found = _PACK[len(ids)](*ids) if len(ids) < len(_PACK) else np.array(ids, "<u4").tobytes()
            if len(piece) <= 64 and piece[0] != " ":
                if len(self.bare) >= MAX_BARE:
                    self.bare.clear()
                self.bare[piece] = found
        return found

    def _pieces(self, pieces: list[str]) -> bytes:
        words = self.words
        return b"".join(
            [
                words[p[1:]] if len(p) > 1 and p[0] == " " and not p[1].isspace() and self.at_spaces else self._piece(p)
                for p in pieces
            ]
        )

    def _encode(self, text: str) -> bytes:
        return self._pieces(self.find(text))

    def encode(self, text: str) -> bytes:
        if not self.at_spaces:
            return self._encode(text)
        try:
            return self._joined(text.split(" "))
        except NoCut:
            return self._joined(self.cut(text))

    def _joined(self, words: list[str]) -> bytes:
        return self._encode(words[0]) + b"".join(map(self.words.__getitem__, words[1:]))


class Utf8Stream:
    """Text from chunks of UTF-8 bytes; a character may be split between chunks.

    The state is the unfinished character at the end of a chunk (at most three
    bytes) and how many bytes it still lacks. Bytes that are no UTF-8 become
    U+FFFD, as in ``bytes.decode(errors="replace")``.
    """

    def __init__(self) -> None:
        self.rest = b""

    def feed(self, chunk: bytes) -> str:
        data = self.rest + chunk
        cut = len(data)
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte >= 0xC0:
                needed = 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4
                if needed > back and self._may_follow(data[len(data) - back :]):
                    cut = len(data) - back
                break
            if byte < 0x80:
                break
        self.rest = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    @staticmethod
    def _may_follow(tail: bytes) -> bool:
        """Whether ``tail`` begins some character."""
        lead = tail[0]
        if lead < 0xC2 or lead > 0xF4:
            return False
        if len(tail) == 1:
            return True
        low = {0xE0: 0xA0, 0xF0: 0x90}.get(lead, 0x80)
        high = {0xED: 0x9F, 0xF4: 0x8F}.get(lead, 0xBF)
        return low <= tail[1] <= high

    def finish(self) -> str:
        rest, self.rest = self.rest, b""
        return rest.decode("utf-8", "replace")


def decode_stream(token_bytes: list[bytes], ids: np.ndarray, step: int = 4096):
    """(bytes, text) chunks of a list of ids."""
    stream = Utf8Stream()
    for start in range(0, len(ids), step):
        chunk = b"".join(map(token_bytes.__getitem__, ids[start : start + step].tolist()))
        yield chunk, stream.feed(chunk)
    yield b"", stream.finish()


_HELD: dict[str, tuple[tuple, object]] = {}


def held(kind: str, key: tuple, make):
    """What ``make`` gives, kept by the worker process for its next tasks; one of each kind."""
    if kind not in _HELD or _HELD[kind][0] != key:
        _HELD[kind] = (key, make())
    return _HELD[kind][1]


def tokens_by_rank(ranks: bytes) -> list[bytes]:
    table = parse_ranks(ranks)
    token_bytes = [b""] * (max(table.values()) + 1)
    for token, rank in table.items():
        token_bytes[rank] = token
    return token_bytes


def encoded(df: DataFrame, ranks: bytes, pattern: str, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` with ``ids`` (binary, unsigned 32-bit little-endian) and ``n_tokens``.

    ``keep`` must not name ``ids``, ``n_tokens`` or ``body``.
    """
    plain = df.select(*keep, F.col(text).alias("body"))
    prepare(df.sparkSession)

    def run(batches):
        encoder = held("encoder", (ranks, pattern), lambda: Encoder(parse_ranks(ranks), pattern))
        for batch in batches:
            texts = batch.column(len(keep)).to_pylist()
            ids = [encoder.encode(t) if t else b"" for t in texts]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array(ids, pa.binary()), pa.array([len(i) // 4 for i in ids], pa.int64())],
                [*keep, "ids", "n_tokens"],
            )

    fields = [f"`{name}` {plain.schema[name].dataType.simpleString()}" for name in keep]
    return plain.mapInArrow(run, ", ".join([*fields, "ids binary", "n_tokens long"]))


def decoded(df: DataFrame, ranks: bytes, keep: list[str], text: bool = True) -> DataFrame:
    """The columns ``keep`` with the SHA-256 of ids and decoded bytes, and the decoded text if wanted."""
    plain = df.select(*keep, "ids")
    names = [*keep, "ids_sha256", "decoded_sha256", *(["decoded"] if text else [])]

    def run(batches):
        token_bytes = held("tokens", (ranks,), lambda: tokens_by_rank(ranks))
        for batch in batches:
            digests, hashes, texts = [], [], []
            for ids in texts_of(batch.column(len(keep))):
                digest, out = hashlib.sha256(), []
                for chunk, piece in decode_stream(token_bytes, np.frombuffer(ids, "<u4")):
                    digest.update(chunk)
                    if text:
                        out.append(piece)
                digests.append(hashlib.sha256(ids).hexdigest())
                hashes.append(digest.hexdigest())
                texts.append("".join(out))
            columns = [pa.array(digests, pa.string()), pa.array(hashes, pa.string()), *([pa.array(texts, pa.string())] if text else [])]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *columns], names)

    fields = [f"`{name}` {plain.schema[name].dataType.simpleString()}" for name in keep]
    extra = ["ids_sha256 string", "decoded_sha256 string", *(["decoded string"] if text else [])]
    return plain.mapInArrow(run, ", ".join([*fields, *extra]))
