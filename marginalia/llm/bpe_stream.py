"""Byte-pair encoding as a streaming transducer, and the way back.

A merge list cuts a word into tokens so that every two neighbours are *compatible*: encoding
the two side by side gives them back. The converse holds too, so for each prefix of a
word there is exactly one token it can end with, given the last tokens of shorter prefixes. The
transducer keeps that last token for each position and needs no merging.

What has been read so far fixes all tokens but those near its end. Whether a merge takes
place can depend on what follows only through a chain of overlapping tokens of ever lower
rank; ``lookahead`` is the length of the longest such chain, a property of the merge list
alone. Tokens that end that far before the last byte read are final: they are emitted, and their
bytes are forgotten. Memory is thus bounded by the merge list, whatever the word's length.

Decoding feeds the bytes of tokens to an incremental UTF-8 state machine; incomplete
sequences wait for their rest, impossible ones become U+FFFD.

Defined cases: NULL and empty texts have no tokens; the text of a special token is that token;
repeated rows are encoded alike; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import codecs
import hashlib
import json
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from marginalia.llm.batches import pieces, texts_of
from marginalia.llm.tokens import TOKENIZER, PartEncoder

KEPT_PAIRS = 1_000_000
KEPT_WORDS = 300_000
KEPT_BYTES = 64
DECODE_BLOCK = 4096


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies.

    Bytes that print in Latin-1 stand for themselves, the others follow from U+0100 on.
    """
    printing = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in set(printing)]
    return {chr(b): b for b in printing} | {chr(256 + i): b for i, b in enumerate(others)}


class Transducer:
    """Words (bytes) to token ids by a proper merge list: each token has one merge."""

    def __init__(self, vocab: dict[bytes, int], merges: list[tuple[bytes, bytes]]):
        self.ids = vocab
        self.bytes_of = {i: b for b, i in vocab.items()}
        self.pair_rank: dict[tuple[int, int], int] = {}
        # For a merged token: rank of its merge and its two parts.
        self.made: dict[int, tuple[int, int, int]] = {}
        for rank, (left, right) in enumerate(merges):
            a, b, whole = vocab[left], vocab[right], vocab[left + right]
            if whole in self.made:
                raise ValueError(f"{left + right!r} has two merges")
            self.pair_rank[a, b] = rank
            self.made[whole] = (rank, a, b)
        self.longest = max(map(len, vocab))
        self._suffixes = {b[i:] for b in vocab for i in range(len(b))}
        self._prefixes = {b[:i]: -1 for b in vocab for i in range(1, len(b))} | vocab
        self._compatible: dict[tuple[int, int], bool] = {}
        self.lookahead = self._sufficient_lookahead()

    def _sufficient_lookahead(self) -> int:
        """Longest chain of overlapping tokens of falling rank, in bytes.

        By rising rank: a token can be kept from forming by one of lower rank that starts inside
        it, and that one by another. ``reach[p]`` is how far such chains go beyond ``p``
        where ``p`` is the start of their first token.
        """
        reach: dict[bytes, int] = {}
        most = 1
        for token in self.made:  # in order of rank
            word = self.bytes_of[token]
            own = max((reach.get(word[i:], 0) for i in range(1, len(word))), default=0)
            most = max(most, len(word) + own)
            for i in range(1, len(word)):
                far = len(word) - i + own
                if far > reach.get(word[:i], 0):
                    reach[word[:i]] = far
        return most

    def compatible(self, first: int, second: int) -> bool:
        """Whether no merge crosses the border before both tokens are complete."""
        known = self._compatible.get((first, second))
        if known is None:
            if len(self._compatible) >= KEPT_PAIRS:
                self._compatible.clear()
            known = self._compatible[first, second] = self._check(first, second)
        return known

    def _check(self, first: int, second: int) -> bool:
        made, pair_rank = self.made, self.pair_rank
        taken = 1 << 62  # rank of the merge that takes the part at the border away
        while True:
            part, other_taken = second, 1 << 62
            while True:
                rank = pair_rank.get((first, part))
                # At equal rank the merge further left happens first.
                if rank is not None and rank < taken and rank <= other_taken:
                    return False
                if part not in made:
                    break
                other_taken, part, _ = made[part]
            if first not in made:
                return True
            taken, _, first = made[first]

    def encode(self, blocks: Iterable[bytes]) -> Iterator[int]:
        """Tokens of one word that comes in blocks, each as soon as it is final."""
        ids, suffixes, compatible = self.ids, self._suffixes, self.compatible
        word, last = b"", [-1]  # what is not emitted yet; the token each prefix ends with
        limit = 2 * (self.lookahead + self.longest)
        for block in blocks:
            for start in range(0, len(block), limit):
                word += block[start : start + limit]
                for end in range(len(last), len(word) + 1):
                    fits = []
                    for at in range(end - 1, -1, -1):
                        piece = word[at:end]
                        if piece not in suffixes:
                            break
                        token = ids.get(piece)
                        if token is not None and last[at] is not None:
                            fits.append((at, token))
                    last.append(None)
                    for at, token in reversed(fits):
                        if at == 0 and last[0] == -1 or compatible(last[at], token):
                            last[end] = token
                            break
                if len(word) > limit:
                    path = self._path(word, last)
                    final = len(word) - self.lookahead
                    done = 0
                    for token in path:
                        size = len(self.bytes_of[token])
                        if done + size > final:
                            break
                        done += size
                        yield token
                        before = token
                    if done:
                        word, last = word[done:], self._beyond(last, done, before)
        yield from self._path(word, last)

    def _path(self, word: bytes, last: list[int | None]) -> list[int]:
        path, at = [], len(word)
        while at:
            path.append(last[at])
            at -= len(self.bytes_of[last[at]])
        return path[::-1]

    def _beyond(self, last: list[int | None], done: int, before: int) -> list[int | None]:
        """Last tokens after ``done``; prefixes whose tokens skip that border are out."""
        kept: list[int | None] = [before]
        for at in range(done + 1, len(last)):
            start = None if last[at] is None else at - done - len(self.bytes_of[last[at]])
            kept.append(last[at] if start is not None and start >= 0 and kept[start] is not None else None)
        return kept

    def word(self, word: bytes) -> list[int]:
        """Tokens of a word that is there as a whole: the same rule, applied forwards.

        The longest token that is compatible with the one before is tried first. A position
        from which no token leads on is no border of the result and is not tried again.
        """
        whole = self.ids.get(word)
        if whole is not None:
            return [whole]
        compatible, end, before = self.compatible, 0, -1
        fits, stack, dead = self._starting(word, 0), [], set()
        while True:
            while fits:
                ahead, token = fits.pop()
                if ahead not in dead and (before < 0 or compatible(before, token)):
                    if ahead == len(word):
                        return [t for _, t, _ in stack[1:]] + [before, token] if stack else [token]
                    stack.append((end, before, fits))
                    end, before, fits = ahead, token, self._starting(word, ahead)
                    break
            else:
                dead.add(end)
                end, before, fits = stack.pop()

    def _starting(self, word: bytes, at: int) -> list[tuple[int, int]]:
        """End and id of the tokens that start at ``at``, the longest last."""
        fits = []
        for end in range(at + 1, len(word) + 1):
            token = self._prefixes.get(word[at:end])
            if token is None:
                break
            if token >= 0:
                fits.append((end, token))
        return fits


class TextDecoder:
    """Token ids to text, piece by piece."""

    def __init__(self, bytes_of: dict[int, bytes]):
        self._bytes_of = bytes_of
        self._machine = codecs.getincrementaldecoder("utf-8")(errors="replace")

    def feed(self, ids: Iterable[int]) -> str:
        return self._machine.decode(b"".join(map(self._bytes_of.__getitem__, ids)))

    def close(self) -> str:
        return self._machine.decode(b"", final=True)


class ByteLevelBpe:
    """A tokenizer file: word pattern, special tokens, merge list."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            found = json.load(file)
        alphabet = byte_alphabet()
        self.special = {t["content"]: t["id"] for t in found["added_tokens"]}
        vocab = {
            bytes(map(alphabet.__getitem__, word)): i
            for word, i in found["model"]["vocab"].items()
            if word not in self.special
        }
        pairs = (m.split(" ") if isinstance(m, str) else m for m in found["model"]["merges"])
        self.transducer = Transducer(
            vocab, [tuple(bytes(map(alphabet.__getitem__, part)) for part in pair) for pair in pairs]
        )
        self.bytes_of = self.transducer.bytes_of | {i: s.encode() for s, i in self.special.items()}
        self._words = regex.compile(public_tokenizers.PATTERN)
        self._specials = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        self._known: dict[str, list[int]] = {}

    def encode(self, text: str) -> Iterator[int]:
        at = 0
        for special in self._specials.finditer(text):
            yield from self._section(text, at, special.start())
            yield self.special[special[0]]
            at = special.end()
        yield from self._section(text, at, len(text))

    def _section(self, text: str, start: int, end: int) -> Iterator[int]:
        known = self._known
        for match in self._words.finditer(text, start, end):
            word = match[0]
            ids = known.get(word)
            if ids is None:
                if len(word) > KEPT_BYTES:
                    blocks = (word[i : i + KEPT_BYTES].encode() for i in range(0, len(word), KEPT_BYTES))
                    yield from self.transducer.encode(blocks)
                    continue
                if len(known) >= KEPT_WORDS:
                    known.clear()
                ids = known[word] = self.transducer.word(word.encode())
            yield from ids

    def decode(self, ids: np.ndarray) -> Iterator[str]:
        decoder = TextDecoder(self.bytes_of)
        for start in range(0, len(ids), DECODE_BLOCK):
            yield decoder.feed(ids[start : start + DECODE_BLOCK].tolist())
        yield decoder.close()


@lru_cache(maxsize=2)
def _worker(name: str) -> tuple[ByteLevelBpe, PartEncoder]:
    """One per Python worker: the words it has met are looked up in later tasks as well."""
    bpe = ByteLevelBpe(public_tokenizers.path(name))
    parts = PartEncoder(lambda found: [np.array([*bpe.encode(p)], "<u4").tobytes() for p in found])
    return bpe, parts


_ENCODED = "doc_id long, n_tokens long, ids binary"
_CODES = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit integers) of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _worker(tokenizer)[1]
        for piece in pieces(batches):
            ids = encoder.encode(texts_of(piece))
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                names=["doc_id", "n_tokens", "ids"],
            )

    return docs.selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(run, _ENCODED)


def _over_ids(encoded: DataFrame, schema: str, out: Callable[[ByteLevelBpe, pa.RecordBatch], list], tokenizer: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _worker(tokenizer)[0]
        for piece in pieces(batches, "ids"):
            yield pa.RecordBatch.from_arrays(out(bpe, piece), names=[c.split()[0] for c in schema.split(", ")])

    return encoded.mapInArrow(run, schema)


def decode(encoded: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id, text from doc_id, ids; special tokens stay."""

    def texts(bpe: ByteLevelBpe, piece: pa.RecordBatch) -> list:
        ids = (np.frombuffer(x or b"", "<u4") for x in piece.column("ids").to_pylist())
        return [piece.column("doc_id"), pa.array(["".join(bpe.decode(x)) for x in ids], pa.string())]

    return _over_ids(encoded.select("doc_id", "ids"), "doc_id long, text string", texts, tokenizer)


def round_trip_digests(encoded: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and the digest of the decoded text, fed as it is decoded."""

    def digests(bpe: ByteLevelBpe, piece: pa.RecordBatch) -> list:
        found, texts = [], []
        for raw in piece.column("ids").to_pylist():
            found.append(hashlib.sha256(raw).hexdigest())
            text = hashlib.sha256()
            for part in bpe.decode(np.frombuffer(raw, "<u4")):
                text.update(part.encode())
            texts.append(text.hexdigest())
        return [piece.column("doc_id"), piece.column("n_tokens"), pa.array(found), pa.array(texts)]

    return _over_ids(encoded, _CODES, digests, tokenizer)
