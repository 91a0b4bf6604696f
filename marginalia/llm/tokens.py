"""Token ids of whole texts by a public byte-level BPE, with the repeated words looked up.

The tokenizer cuts a text into words before it merges anything, and it always cuts before
a space that has no white space on one side. A text may thus be split there and
each part encoded alone; parts recur, so the encoder keeps those it has met. What comes
out is exactly what encoding the whole text at once gives.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from functools import lru_cache
from itertools import islice

import public_tokenizers
from tokenizers import Tokenizer

TOKENIZER = "byte_bpe_50k.json"

# Parts kept by one encoder, and the longest that is kept: some 150 MB at most.
KEPT_PARTS = 700_000
KEPT_CHARS = 48

_BETWEEN_WORDS = re.compile(r"(?<=\S) (?=\S)")


class PartEncoder:
    """Texts to little-endian unsigned 32-bit ids.

    ``encode_parts`` maps texts to such bytes one by one; ``encode_spaced`` does so for parts that
    get a space in front, hold no other and have no white space at their edges. Parts without
    their leading space are the keys of ``_inner``; a text's first part, which has none, is one of
    ``_first``.
    """

    def __init__(
        self,
        encode_parts: Callable[[list[str]], list[bytes]],
        encode_spaced: Callable[[list[str]], list[bytes]] | None = None,
    ):
        self._encode_parts = encode_parts
        self._encode_spaced = encode_spaced or (lambda parts: encode_parts([" " + p for p in parts]))
        self._inner: dict[str, bytes | None] = {}
        self._first: dict[str, bytes] = {}

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        texts = list(texts)
        split = [text.split(" ") for text in texts]
        heads = [parts.pop(0) for parts in split]
        if len(self._inner) + len(self._first) > KEPT_PARTS:
            # Frequent parts were met early; the later half is mostly rare ones.
            self._inner = dict(islice(self._inner.items(), KEPT_PARTS // 2))
            self._first = {}
        inner, long_ones = self._inner, {}
        missing = set().union(*split).difference(inner)
        # White space at an edge: whether to cut there depends on the neighbouring part.
        plain = [p for p in missing if p and not p[0].isspace() and not p[-1].isspace()]
        for part, ids in zip(plain, self._encode_spaced(plain)):
            (inner if len(part) <= KEPT_CHARS else long_ones)[part] = ids
        for part in missing.difference(plain):
            (inner if len(part) <= KEPT_CHARS else long_ones)[part] = None
        starts = list(set(heads).difference(self._first))
        long_starts = {}
        for part, ids in zip(starts, self._encode_parts(starts)):
            (self._first if len(part) <= KEPT_CHARS else long_starts)[part] = ids
        of = (lambda p: inner[p] if p in inner else long_ones[p]) if long_ones else inner.__getitem__
        out = []
        for text, head, parts in zip(texts, heads, split):
            try:
                # A part with white space at an edge has no ids, so that nothing can be joined.
                rest = None if parts and (not head or head[-1].isspace()) else b"".join(map(of, parts))
            except TypeError:
                rest = None
            if rest is None:
                out.append(self._with_white_space(text))
            else:
                out.append((self._first[head] if head in self._first else long_starts[head]) + rest)
        return out

    def _with_white_space(self, text: str) -> bytes:
        """A text with runs of white space: cut only at single spaces between words."""
        head, *rest = _BETWEEN_WORDS.split(text)
        inner = self._inner
        todo = [" " + p for p in dict.fromkeys(rest) if inner.get(p) is None]
        new = dict(zip(todo, self._encode_parts(todo)))
        first = self._encode_parts([head])[0]
        return first + b"".join(inner.get(p) or new[" " + p] for p in rest)


@lru_cache(maxsize=4)
def tokenizer(name: str = TOKENIZER) -> Tokenizer:
    found = Tokenizer.from_file(public_tokenizers.path(name))
    found.no_padding()
    found.no_truncation()
    return found


@lru_cache(maxsize=4)
def library_encoder(name: str = TOKENIZER) -> PartEncoder:
    """One per Python worker, kept from task to task: the parts it has met are used again."""
    import numpy as np

    library = tokenizer(name)
    special = [token.content for token in library.get_added_tokens_decoder().values()]

    def encode_parts(parts: list[str]) -> list[bytes]:
        if not parts:
            return []
        if any(word in part for word in special for part in parts):
            encoded = library.encode_batch_fast(parts, add_special_tokens=False)
            return [np.asarray(e.ids, "<u4").tobytes() for e in encoded]
        # As the words of one text: one result object for all of them, which costs less.
        whole = library.encode_batch([parts], is_pretokenized=True, add_special_tokens=False)[0]
        ids = np.asarray(whole.ids, "<u4").tobytes()
        part_of = np.asarray(whole.word_ids, np.int64)
        ends = (4 * np.searchsorted(part_of, np.arange(len(parts) + 1))).tolist()
        return [ids[a:b] for a, b in zip(ends, ends[1:])]

    first_byte = library.pre_tokenizer.pre_tokenize_str(" ")[0][0]
    vocabulary = library.get_vocab(with_added_tokens=True)
    opens = np.zeros(max(vocabulary.values()) + 1, bool)
    opens[[i for token, i in vocabulary.items() if token.startswith(first_byte)]] = True

    def encode_spaced(parts: list[str]) -> list[bytes]:
        if not parts:
            return []
        if any(word in part for word in special for part in parts) or any(" " in word for word in special):
            return encode_parts([" " + p for p in parts])
        # As one text, cut before every space: the token with the space's byte opens a part.
        ids = np.asarray(library.encode_batch_fast([" " + " ".join(parts)], add_special_tokens=False)[0].ids, "<u4")
        starts = np.flatnonzero(opens[ids])
        if len(starts) != len(parts):
            raise ValueError("a part has no token of its own at its start")
        ends = [*(4 * starts).tolist(), ids.nbytes]
        data = ids.tobytes()
        return [data[a:b] for a, b in zip(ends, ends[1:])]

    return PartEncoder(encode_parts, encode_spaced)
