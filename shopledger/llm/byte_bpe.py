"""Byte-level BPE by a lazily determinised transducer, and a streaming decoder.

The merges fix one valid token sequence for every byte string, and a sequence is valid exactly if
every token in it, alone, and every pair of neighbours is. So a transducer whose paths spell
tokens, and may pass from token u to token v only if u v is what the merges make of their bytes,
has exactly one accepting path per string. Read byte by byte, the places in the tree of tokens that open paths have
come to are one state of the determinised machine, made when first met. Tokens that all open paths share are
emitted, and as an open path is inside one token, the lookahead this takes is bounded. Pairs of
tokens are checked by the merges at their ends and kept, as are chunks of text with their ids, in
two generations of bounded size: what was not met again when the younger is full is dropped.

As in the tokenizers this agrees with, a match of the pattern that is itself a token is that token.

Decoding maps ids to bytes and feeds a UTF-8 state machine that hands out whole code points and
holds back the start of an unfinished one; bytes that can't be UTF-8 give U+FFFD.

Defined results: null and empty texts have no ids and decode to nothing; repeated rows are encoded
each; texts of any length are read piece by piece; other columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.llm.common import arrow_rows, texts

PAIRS, CHUNKS = 300_000, 500_000  # entries of each generation kept in a worker, at most
#: White space as Unicode has it; the rank files' tokenizers split at these and no other code points.
SPACES = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Where the pattern always ends a match: before a run of other characters with at most one space in front.
CHUNK = re.compile(f" ?[^{SPACES}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+")
WORD = re.compile(" ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+")  # one match by itself
TAIL = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'")  # a contraction starts with '
CHUNK_IDS = 8_192  # ids decoded at a time
NONE = 1 << 60
PAIR = 1 << 32  # a pair of tokens as one number: (token before + 1) x PAIR + token; at the start, only the token
HELD = 1_024  # bytes held before the tokens that are certain are emitted


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines) if token}


class Transducer:
    """Encodes byte strings; compiled from ranks alone.

    A path spells a token along the tree of tokens and may begin after any byte. The places in the tree that
    open paths have come to after a byte are one determinised state; states and their steps are made when first met,
    and as the deepest place decides all others there are no more of them than places. A state names the tokens that
    end there, longest first. The one of them that may follow the token with which the bytes before it end is the
    token with which a valid sequence of all bytes so far ends; going back from any position over these tokens gives
    the sequence up to it. As exactly one of them may, the last needs no check if no longer one may.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.lengths = {rank: len(token) for token, rank in ranks.items()}
        self.children: list[dict[int, int]] = [{}]  # the tree of all tokens
        self.token_at: list[int | None] = [None]
        self.depths = [0]
        for token, rank in ranks.items():
            node = 0
            for b in token:
                here = self.children[node]
                node = here.get(b) or here.setdefault(b, len(self.children))
                if node == len(self.children):
                    self.children.append({})
                    self.token_at.append(None)
                    self.depths.append(0)
            self.token_at[node] = rank
        for node, here in enumerate(self.children):  # a child comes after its parent
            for child in here.values():
                self.depths[child] = self.depths[node] + 1
        self.pairs: dict[int, bool] = {}  # two generations
        self.old_pairs: dict[int, bool] = {}
        self.edges: dict[int, tuple] = {}
        self.numbers: dict[tuple[int, ...], int] = {(): 0}
        self.places: list[tuple[int, ...]] = [()]  # of each state, deepest first
        self.steps: list[dict[int, tuple]] = [{}]  # by byte: the state, its steps, the tokens that end there

    def merged(self, data: bytes) -> tuple[list[bytes], list[bytes], list[bytes]]:
        """The merges applied to a short byte string, lowest rank first, leftmost of equals.

        Also what stood at its left and at its right end in the course of it.
        """
        parts = [data[i : i + 1] for i in range(len(data))]
        left, right = parts[:1], parts[-1:]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(parts[i] + parts[i + 1], NONE), i) for i in range(len(parts) - 1))
            if rank == NONE:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            if at == 0:
                left.append(parts[0])
            if at == len(parts) - 1:
                right.append(parts[-1])
        return parts, left, right

    def _ends(self, token: int) -> tuple:
        """(is the token what the merges make of its bytes, its left ends, its right ends)."""
        known = self.edges.get(token)
        if known is None:
            parts, left, right = self.merged(self.tokens[token])
            known = self.edges[token] = (len(parts) == 1, left, right)
        return known

    def _apart(self, before: int, token: int) -> bool:
        """Whether no merge joins the end of one token with the start of the next.

        Both ends grow by their own merges; a merge across comes first if its rank is below that of
        the growth on the left, and not above that of the growth on the right.
        """
        ranks = self.ranks
        _, _, mine = self._ends(before)
        _, other, _ = self._ends(token)
        i = j = 0
        while True:
            across = ranks.get(mine[i] + other[j], NONE)
            grow = ranks[mine[i + 1]] if i + 1 < len(mine) else NONE
            grow_other = ranks[other[j + 1]] if j + 1 < len(other) else NONE
            if across < grow and across <= grow_other and across != NONE:
                return False
            if grow == grow_other == NONE:
                return True
            if grow <= grow_other:
                i += 1
            else:
                j += 1

    def fits(self, before: int, token: int) -> bool:
        return self._pair((before + 1) * PAIR + token)

    def _pair(self, key: int) -> bool:
        known = self.pairs.get(key)
        if known is None:
            known = self.old_pairs.get(key)
            if known is None:
                before, token = divmod(key, PAIR)
                known = self._ends(token)[0] and (before == 0 or self._apart(before - 1, token))
            if len(self.pairs) >= PAIRS:
                self.old_pairs, self.pairs = self.pairs, {}
            self.pairs[key] = known
        return known

    def _step(self, state: int, byte: int) -> tuple:
        """Follow all open paths, and a new one, over one more byte.

        Tokens that end there, longest first: (token, length, its share of a pair's number); the last by itself.
        """
        ahead = tuple([c for c in (self.children[node].get(byte) for node in (*self.places[state], 0)) if c is not None])
        number = self.numbers.get(ahead)
        if number is None:
            number = self.numbers[ahead] = len(self.places)
            self.places.append(ahead)
            self.steps.append({})
        met = [(self.token_at[n], self.depths[n]) for n in ahead if self.token_at[n] is not None and self._ends(self.token_at[n])[0]]
        if not met:
            raise ValueError("a byte is not in the vocabulary")
        ending = [(token, length, (token + 1) * PAIR) for token, length in met]
        made = self.steps[state][byte] = (number, self.steps[number], tuple(ending[:-1]), ending[-1][2])
        return made

    def _back(self, held: list[int], at: int) -> list[int]:
        """Starts of the tokens before position `at`, nearest first."""
        out = []
        while at > 0:
            at -= self.lengths[held[at] // PAIR - 1]
            out.append(at)
        return out

    def encode(self, data: bytes) -> list[int]:
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        out: list[int] = []
        held = [0]  # the token before those held, and for each byte held the last token of all up to it, as shares of pairs
        state, n = 0, 0
        steps, pair, known, add = self.steps[0], self._pair, self.pairs.get, held.append
        for byte in data:
            state, steps, ending, last = steps.get(byte) or self._step(state, byte)
            n += 1
            for token, length, share in ending:
                if length <= n:
                    key = held[n - length] + token
                    fits = known(key)
                    if fits or (fits is None and pair(key)):
                        add(share)
                        break
            else:
                add(last)
            if n >= HELD:  # emit what all open paths share
                common = set(self._back(held, n))
                for node in self.places[state]:
                    start = n - self.depths[node]
                    if start >= 0:
                        common &= {start, *self._back(held, start)}
                cut = max(common)
                if cut:
                    out += self._tokens(held, cut)
                    del held[:cut]
                    n -= cut
        return out + self._tokens(held, n)

    def _tokens(self, held: list[int], at: int) -> list[int]:
        found = []
        while at > 0:
            token = held[at] // PAIR - 1
            found.append(token)
            at -= self.lengths[token]
        return found[::-1]


class Utf8Stream:
    """Turns byte chunks into text; the start of an unfinished code point waits for the next chunk."""

    # what a lead byte asks for: number of following bytes, and the range of the first of them
    @staticmethod
    def _lead(byte: int) -> tuple[int, int, int]:
        if 0xC2 <= byte <= 0xDF:
            return 1, 0x80, 0xBF
        if 0xE0 <= byte <= 0xEF:
            return 2, 0xA0 if byte == 0xE0 else 0x80, 0x9F if byte == 0xED else 0xBF
        if 0xF0 <= byte <= 0xF4:
            return 3, 0x90 if byte == 0xF0 else 0x80, 0x8F if byte == 0xF4 else 0xBF
        return 0, 0, 0

    def __init__(self):
        self.waiting = b""

    def feed(self, chunk: bytes) -> str:
        data = self.waiting + chunk
        cut = len(data)
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if 0x80 <= byte <= 0xBF:
                continue
            follows, low, high = self._lead(byte)
            if follows >= back and (back == 1 or low <= data[-back + 1] <= high):
                cut = len(data) - back
            break
        self.waiting = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def finish(self) -> str:
        rest, self.waiting = self.waiting, b""
        return rest.decode("utf-8", "replace")


class Codec:
    """Text to ids and back, with a bounded table of the chunks met.

    For patterns of the GPT-2 kind: a match never crosses the start of a chunk (see CHUNK).
    """

    made: dict[tuple[str, str], "Codec"] = {}  # for all tasks of a worker

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.transducer = Transducer(ranks)
        inside = pattern.replace(r"[^\s", f"[^{SPACES}").replace(r"\S", f"[^{SPACES}]").replace(r"\s", f"[{SPACES}]")
        self.pattern = regex.compile(inside)
        self.known: dict[str, tuple[tuple[int, ...], str]] = {}  # two generations
        self.old: dict[str, tuple[tuple[int, ...], str]] = {}

    @classmethod
    def of(cls, vocabulary: str, pattern: str) -> "Codec":
        key = (vocabulary, pattern)
        if key not in cls.made:
            cls.made[key] = cls(read_ranks(vocabulary), pattern)
        return cls.made[key]

    def _new(self, chunk: str) -> tuple[tuple[int, ...], str]:
        """A chunk that is not in the younger generation: from the older, or from its two parts, or by the transducer.

        Punctuation that follows a letter or digit is a match of its own, so the chunk without it may be known.
        """
        made = self.old.get(chunk)
        if made is None:
            core = chunk.rstrip(TAIL)
            if core and len(core) < len(chunk) and core[-1].isalnum():
                a, b = (self.known.get(p) or self._new(p) for p in (core, chunk[len(core) :]))
                made = a[0] + b[0], f"{a[1]} {b[1]}"
            else:
                encode = self.transducer.encode
                pieces = (chunk,) if WORD.fullmatch(chunk) else self.pattern.findall(chunk)
                ids = tuple([i for piece in pieces for i in encode(piece.encode())])
                made = ids, " ".join(map(str, ids))
        if len(chunk) <= 64:
            if len(self.known) >= CHUNKS:  # what was not met again since the last time goes
                self.old, self.known = self.known, {}
            self.known[chunk] = made
        return made

    def chunks(self, text: str) -> list[tuple[tuple[int, ...], str]]:
        """Ids, and ids as decimal text, of each chunk."""
        new = self._new
        return [self.known.get(c) or new(c) for c in CHUNK.findall(text)]

    def encode(self, text: str) -> list[int]:
        return list(itertools.chain.from_iterable([c[0] for c in self.chunks(text)]))

    def decode_bytes(self, ids: list[int]) -> Iterator[bytes]:
        tokens = self.transducer.tokens
        for i in range(0, len(ids), CHUNK_IDS):
            yield b"".join(map(tokens.__getitem__, ids[i : i + CHUNK_IDS]))


def decode_stream(chunks: Iterable[bytes]) -> Iterator[str]:
    stream = Utf8Stream()
    for chunk in chunks:
        yield stream.feed(chunk)
    yield stream.finish()


def encoded(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """doc_id, ids of every document; `vocabulary` is a rank file every executor can read."""

    def encode(batches):
        codec = Codec.of(vocabulary, pattern)
        for batch in batches:
            ids = [codec.encode(t) for t in texts(batch)]
            yield arrow_rows({"doc_id": (pa.int64(), batch.column("doc_id").to_pylist()), "ids": (pa.list_(pa.int32()), ids)})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(encode, "doc_id long, ids array<int>")


def decoded(ids: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """doc_id, text of every row of (doc_id, ids)."""

    def decode(batches):
        codec = Codec.of(vocabulary, pattern)
        for batch in batches:
            out = ["".join(decode_stream(codec.decode_bytes(row or []))) for row in batch.column("ids").to_pylist()]
            yield arrow_rows({"doc_id": (pa.int64(), batch.column("doc_id").to_pylist()), "text": (pa.string(), out)})

    return ids.select("doc_id", "ids").mapInArrow(decode, "doc_id long, text string")


def digests(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """Encode, decode, and return counts and checksums in one pass; `same` tells that the text came back."""

    def both(batches):
        codec = Codec.of(vocabulary, pattern)
        for batch in batches:
            counts, of_ids, of_bytes, same = [], [], [], []
            for text in texts(batch):
                chunks = codec.chunks(text)
                ids = list(itertools.chain.from_iterable([c[0] for c in chunks]))
                counts.append(len(ids))
                of_ids.append(hashlib.sha256(" ".join([c[1] for c in chunks]).encode()).hexdigest())
                sha, stream, back = hashlib.sha256(), Utf8Stream(), []
                for chunk in codec.decode_bytes(ids):
                    sha.update(chunk)
                    back.append(stream.feed(chunk))
                back.append(stream.finish())
                of_bytes.append(sha.hexdigest())
                same.append("".join(back) == text)
            yield arrow_rows({
                "doc_id": (pa.int64(), batch.column("doc_id").to_pylist()), "n_tokens": (pa.int64(), counts),
                "ids_sha256": (pa.string(), of_ids), "decoded_sha256": (pa.string(), of_bytes), "same": (pa.bool_(), same),
            })

    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return kept.mapInArrow(both, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, same boolean")
