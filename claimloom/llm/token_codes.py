"""Token ids of whole texts by the tokenizers library, as little-endian 32-bit numbers.

The library encodes every distinct chunk, by its model alone where the chunk's split is plain;
a chunk that comes again is looked up in the worker's cache (plain chunks of words are
distinct within a call only). The ids are those of the whole text encoded at once (see
``chunks``).
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from claimloom.llm.chunks import ChunkCache, cut_at_each_space, space_led_chunks

ID_BYTES = 4
CACHE_CHUNKS = 400_000
_JOINED_CHUNKS = 250
_JOINED_TEXTS = 64
_PLACED_CHUNKS = 500_000
_SHORT_CHARS = 1 << 28
_LETTERS = "A-Za-zÀ-ÖØ-öø-ſ"


def _load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


# where each chunk begins and ends, from the joined ids
Cuts = Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]


def _as_bytes(ids) -> bytes:
    return np.asarray(ids, dtype="<u4").tobytes()


def _arrow(texts: list[str | None]) -> pa.Array:
    """Short offsets are numbered in half the time; four bytes a character at most."""
    short = sum(len(t) for t in texts if t) < _SHORT_CHARS
    return pa.array(texts, pa.string() if short else pa.large_string())


def _placed(
    data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, numbers: np.ndarray
) -> np.ndarray:
    """One after the other, the ids in ``data`` of the chunks with these numbers."""
    found = np.empty(sizes[numbers].sum(), dtype="<u4")
    done = 0
    for at in range(0, len(numbers), _PLACED_CHUNKS):
        part = numbers[at : at + _PLACED_CHUNKS]
        n = sizes[part]
        ends = np.cumsum(n)
        # where each id lies in data: its chunk's start and its place in the chunk
        places = np.arange(ends[-1]) + np.repeat(starts[part] - ends + n, n)
        found[done : done + len(places)] = data[places]
        done += len(places)
    return found


def _bounds(sizes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Where each list's ids begin, and their end, from its chunks' sizes and their count."""
    return np.append(0, np.cumsum(sizes))[np.append(0, np.cumsum(counts))]


def _texts(
    data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, numbers: np.ndarray, counts: np.ndarray
) -> list[bytes]:
    """The ids of each text, which has ``counts`` of the numbered chunks."""
    ids = _placed(data, starts, sizes, numbers)
    cuts = _bounds(sizes[numbers], counts).tolist()
    return [ids[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _laid(codes: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The chunks' ids, one chunk after the other, where each begins, and how many it has."""
    sizes = np.fromiter(map(len, codes), np.int64, len(codes)) // ID_BYTES
    return np.frombuffer(b"".join(codes), dtype="<u4"), np.cumsum(sizes) - sizes, sizes


class _Codes:
    """Shared part: chunks are joined to longer texts, as single ones cost more to encode.

    ``_joined`` gives the text of several chunks, or None where they cannot be told apart in
    it, and a function that gives where in the joined ids each chunk begins and ends.
    """

    def __init__(self, path: str, limit: int = CACHE_CHUNKS):
        self._tokenizer = _load(path)
        self._cache = ChunkCache(self._encode_many, limit)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [f.ids for f in found]

    def _joined(self, chunks: list[str]) -> tuple[str, Cuts] | None:
        raise NotImplementedError

    def _alone(self, chunk: str) -> str:
        raise NotImplementedError

    def _encode_many(self, chunks: list[str]) -> list[bytes]:
        parts = [chunks[i : i + _JOINED_CHUNKS] for i in range(0, len(chunks), _JOINED_CHUNKS)]
        joined = [self._joined(p) for p in parts]
        found = iter(self._ids([j[0] for j in joined if j]))
        codes: list[bytes] = []
        for part, text in zip(parts, joined, strict=True):
            if text:
                ids = np.asarray(next(found), dtype="<u4")
                starts, ends = text[1](ids)
                if len(starts) == len(part):
                    data = ids.tobytes()
                    places = zip(
                        (starts * ID_BYTES).tolist(), (ends * ID_BYTES).tolist(), strict=True
                    )
                    codes.extend([data[a:b] for a, b in places])
                    continue
            codes.extend(map(_as_bytes, self._ids([self._alone(c) for c in part])))
        return codes


def _byte_letters() -> list[str]:
    """The letter that the byte-level alphabet writes for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


class _PlainChunks:
    """Ids of chunks of ASCII and Latin letters, from the library's model directly.

    The library's own splitting by its pattern costs more than its model. On these
    characters, which Python's pattern takes to be the same letters, digits and white space,
    the split is made here. A chunk that holds another character, or one that an added
    token has, has no code here.
    """

    _SETTINGS = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    _BLANKS = r"\t\n\r "
    _WORD = re.compile(f"[{_LETTERS}]+")
    _MATCHES = re.compile(
        f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[^{_BLANKS}{_LETTERS}0-9]+"
        f"|[{_BLANKS}]+(?![^{_BLANKS}])|[{_BLANKS}]+"
    )

    def __init__(self, tokenizer):
        added = [t.content for t in tokenizer.get_added_tokens_decoder().values() if t.content]
        # one character of each is enough, a sign where there is one: words are the most
        barred = {next((c for c in a if not c.isalpha()), a[0]) for a in added}
        taken = re.compile(f"[\\t\\n\\r -~{_LETTERS}]")
        plain = {c for c in map(chr, range(ord("ſ") + 1)) if taken.match(c)} - barred
        # one class without a group, which needs no memory for a chunk of any length
        self._plain = re.compile(f"[{re.escape(''.join(sorted(plain)))}]*")
        self._bars_letters = any(c.isalpha() for c in barred)
        self._tokens_of = tokenizer.model.tokenize
        self._id_bytes = [_as_bytes([n]) for n in range(tokenizer.get_vocab_size())]
        letters = _byte_letters()
        self._spelled = {
            n: "".join(letters[b] for b in chr(n).encode()) for n in range(ord("ſ") + 1)
        }
        self._space = self._spelled[ord(" ")]
        # what follows a word is mostly one of few signs
        self._kept = lru_cache(1 << 14)(lambda text: self._match(self._spell(text)))

    @classmethod
    def of(cls, tokenizer) -> _PlainChunks | None:
        """None where the library does more to a text than to split and to merge."""
        model, splits = tokenizer.model, tokenizer.pre_tokenizer
        if tokenizer.normalizer or not splits or not hasattr(model, "dropout") or model.dropout:
            return None
        settings = json.loads(splits.__getstate__())
        return cls(tokenizer) if cls._SETTINGS.items() <= settings.items() else None

    def _spell(self, text: str) -> str:
        return text.translate(self._spelled)

    def _match(self, text: str) -> bytes:
        return b"".join([self._id_bytes[t.id] for t in self._tokens_of(text)])

    def code(self, chunk: str) -> bytes | None:
        """The ids of the chunk with a space before it."""
        if not self._bars_letters and self._WORD.fullmatch(chunk):
            # ASCII letters are spelled as they are
            plain = chunk.isascii()
            return self._match(self._space + chunk if plain else self._spell(" " + chunk))
        if not self._plain.fullmatch(chunk):
            return None
        first, *more = self._MATCHES.findall(" " + chunk)
        return self._match(self._spell(first)) + b"".join(map(self._kept, more))


class ByteLevelCodes(_Codes):
    """Ids of a byte-level BPE tokenizer without a normaliser."""

    _SPACES = re.compile(r"\s\s")

    def __init__(self, path: str, limit: int = CACHE_CHUNKS):
        super().__init__(path, limit)
        size = self._tokenizer.get_vocab_size()
        tokens = map(self._tokenizer.id_to_token, range(size))
        # the byte-level alphabet writes the space as this letter
        self._led = np.array([bool(t) and t.startswith("Ġ") for t in tokens])
        self._plain = _PlainChunks.of(self._tokenizer)

    def _encode_many(self, chunks: list[str]) -> list[bytes]:
        if not self._plain:
            return super()._encode_many(chunks)
        codes = list(map(self._plain.code, chunks))
        places = [n for n, code in enumerate(codes) if code is None]
        others = super()._encode_many([chunks[n] for n in places])
        for n, code in zip(places, others, strict=True):
            codes[n] = code
        return codes

    def _joined(self, chunks: list[str]) -> tuple[str, Cuts] | None:
        """With the spaces that begin the chunks: an id with a space begins a chunk."""
        text = " " + " ".join(chunks)
        return None if self._SPACES.search(text) or text[-1].isspace() else (text, self._cuts)

    def _cuts(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts = np.flatnonzero(self._led[ids])
        return starts, np.append(starts[1:], len(ids))

    def _alone(self, chunk: str) -> str:
        return " " + chunk

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        regular = [cut_at_each_space(t) for t in texts]
        cuts = [t.partition(" ") for t, each in zip(texts, regular, strict=True) if each]
        heads = map(_as_bytes, self._ids([first for first, _, _ in cuts]))
        tails = self._space_led([rest if space else None for _, space, rest in cuts])
        found = iter([head + tail for head, tail in zip(heads, tails, strict=True)])
        others = iter(self._chunked([t for t, each in zip(texts, regular, strict=True) if not each]))
        return [next(found if each else others) for each in regular]

    def _chunked(self, texts: list[str]) -> list[bytes]:
        """The ids of texts that are not cut at each space."""
        split = [space_led_chunks(t) for t in texts]
        firsts = [chunks.pop(0) for chunks in split]
        known = self._cache.codes_of(set().union(*split))
        return [
            _as_bytes(first) + b"".join(map(known, chunks))
            for first, chunks in zip(self._ids(firsts), split, strict=True)
        ]

    def _space_led(self, texts: list[str | None]) -> list[bytes]:
        """The ids of texts of which every chunk is led by a space; a null has no chunk.

        Arrow splits the texts and numbers the chunks, so Python sees only distinct ones.
        """
        lists = pc.split_pattern(_arrow(texts), " ")
        counts = lists.value_lengths().fill_null(0).to_numpy()
        numbered = lists.flatten().dictionary_encode()
        chunks = numbered.dictionary.to_numpy(zero_copy_only=False).tolist()
        codes = list(map(self._cache.codes_of(set(chunks)), chunks))
        return _texts(*_laid(codes), numbered.indices.to_numpy(), counts)


class _PlainWords:
    """Ids of chunks of ASCII and Latin letters, digits and signs, which are split here.

    The library's own lower-casing and splitting cost more than its model. On these
    characters Arrow makes the same split, so the library gets each distinct piece once,
    lower-cased, and does the rest. A chunk that holds another character, or one that an
    added token has, is not taken. No white space is within a chunk.
    """

    _NORMALIZER = {
        "type": "Sequence",
        "normalizers": [
            {"type": "NFC"},
            {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
            {"type": "Lowercase"},
        ],
    }
    _BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False}
    _SPLIT = {
        "type": "Split",
        "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
        "behavior": "Removed",
        "invert": True,
    }
    _PIECE = f"('s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^ {_LETTERS}0-9]+)"

    def __init__(self, tokenizer, ends: np.ndarray):
        """``ends`` says which ids end a word; the tokenizer is changed."""
        from tokenizers import pre_tokenizers as pre

        added = [t.content for t in tokenizer.get_added_tokens_decoder().values() if t.content]
        # one character of each is enough, a sign where there is one: words are the most
        barred = {next((c for c in a if not c.isalpha()), a[0]).lower() for a in added}
        taken = re.compile(f"[!-~{_LETTERS}]")
        # İ becomes two characters
        plain = [c for c in map(chr, range(ord("ſ") + 1)) if taken.match(c) and c != "İ"]
        kept = re.escape("".join(c for c in plain if c.lower() not in barred))
        self._plain = f"^[{kept}]*$"
        tokenizer.normalizer = None
        byte_level = pre.ByteLevel(add_prefix_space=False, use_regex=False)
        tokenizer.pre_tokenizer = pre.Sequence([pre.WhitespaceSplit(), byte_level])
        self._tokenizer, self._ends = tokenizer, ends

    @classmethod
    def of(cls, path: str, ends: np.ndarray) -> _PlainWords | None:
        """None where the library does something else to a text, or drops parts of it."""
        tokenizer = _load(path)
        model, parts = tokenizer.model, (tokenizer.normalizer, tokenizer.pre_tokenizer)
        if not all(parts) or getattr(model, "end_of_word_suffix", None) != "</w>" or model.dropout:
            return None
        normalizer, splits = (json.loads(p.__getstate__()) for p in parts)
        split, *more = splits.get("pretokenizers", [None])
        known = normalizer == cls._NORMALIZER and split == cls._SPLIT and len(more) == 1
        if not known or not cls._BYTE_LEVEL.items() <= more[0].items():
            return None
        added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        whole = all(
            model.token_to_id(letter + end) is not None
            for letter in _byte_letters()
            for end in ("", "</w>")
        )
        # an added token with white space could come from joining
        spaced = any(c.isspace() for content in added for c in content)
        return cls(tokenizer, ends) if whole and not spaced else None

    def takes(self, chunks: pa.Array) -> np.ndarray:
        found = pc.match_substring_regex(chunks, self._plain)
        return found.to_numpy(zero_copy_only=False).astype(bool)

    def ids(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all these chunks, one after the other, and how many each has."""
        marked = pc.replace_substring_regex(pc.utf8_lower(chunks), self._PIECE, r"\1 ")
        lists = pc.split_pattern(marked, " ")
        numbered = lists.flatten().dictionary_encode()
        pieces, numbers = numbered.dictionary, numbered.indices.to_numpy()
        # what follows the last piece is empty
        full = pc.not_equal(pieces, "").to_numpy(zero_copy_only=False).astype(bool)
        data = self._encoded(pieces.filter(pa.array(full)))
        sizes = np.zeros(len(pieces), np.int64)
        sizes[full] = np.diff(np.flatnonzero(self._ends[data]) + 1, prepend=0)
        ids = _placed(data, np.cumsum(sizes) - sizes, sizes, numbers)
        return ids, np.diff(_bounds(sizes[numbers], lists.value_lengths().to_numpy()))

    def _encoded(self, pieces: pa.Array) -> np.ndarray:
        """The ids of distinct pieces; many are joined to one text."""
        cuts = np.append(np.arange(0, len(pieces), _JOINED_CHUNKS), len(pieces))
        joined = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pieces)
        texts = pc.binary_join(joined, pa.scalar(" ", pieces.type)).to_pylist()
        found = [np.empty(0, dtype="<u4")]
        for at in range(0, len(texts), _JOINED_TEXTS):
            part = texts[at : at + _JOINED_TEXTS]
            codes = self._tokenizer.encode_batch_fast(part, add_special_tokens=False)
            found.extend(np.asarray(c.ids, dtype="<u4") for c in codes)
        return np.concatenate(found)


class WordCodes(_Codes):
    """Ids of a BPE tokenizer that drops white space; words do not influence each other."""

    # A letter whose first byte begins no character that the pattern lets through, put
    # between the chunks; those characters keep their number when normalised.
    _MARK = "\u65e5"
    _OTHER = re.compile("[^\x00-\u012f]")

    def __init__(self, path: str, limit: int = CACHE_CHUNKS):
        super().__init__(path, limit)
        self._mark = np.asarray(self._ids([self._MARK])[0], dtype="<u4")
        size = self._tokenizer.get_vocab_size()
        tokens = map(self._tokenizer.id_to_token, range(size))
        self._ends = np.array([bool(t) and t.endswith("</w>") for t in tokens])
        self._plain = _PlainWords.of(path, self._ends)

    def _joined(self, chunks: list[str]) -> tuple[str, Cuts] | None:
        """Words of letters only end with an id that ends a word; others get marks between."""
        text = " ".join(chunks)
        if self._OTHER.search(text):
            return None
        if text.replace(" ", "").isalpha() and all(chunks):
            return text, self._word_ends
        return f" {self._MARK} ".join(chunks), self._marks

    def _word_ends(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ends = np.flatnonzero(self._ends[ids]) + 1
        return np.append(0, ends[:-1]), ends

    def _marks(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        marks = np.flatnonzero(ids == self._mark[0])
        return np.append(0, marks + len(self._mark)), np.append(marks, len(ids))

    def _alone(self, chunk: str) -> str:
        return chunk

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        column = _arrow(texts)
        for blank in "\n\t\r":
            column = pc.replace_substring(column, blank, " ")
        lists = pc.split_pattern(column, " ")
        numbered = lists.flatten().dictionary_encode()
        counts = lists.value_lengths().to_numpy()
        return _texts(*self._chunks(numbered.dictionary), numbered.indices.to_numpy(), counts)

    def _chunks(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of distinct chunks, where each chunk's begin, and how many it has."""
        plain = self._plain.takes(chunks) if self._plain else np.zeros(len(chunks), bool)
        others = chunks.filter(pa.array(~plain)).to_pylist()
        data, starts, sizes = _laid(list(map(self._cache.codes_of(set(others)), others)))
        if not self._plain:
            return data, starts, sizes
        ids, each = self._plain.ids(chunks.filter(pa.array(plain)))
        all_starts, all_sizes = np.empty((2, len(chunks)), np.int64)
        all_starts[~plain], all_sizes[~plain] = starts, sizes
        all_starts[plain], all_sizes[plain] = np.cumsum(each) - each + len(data), each
        return np.concatenate([data, ids]), all_starts, all_sizes


@lru_cache(maxsize=4)
def codes(kind: str, path: str, limit: int = CACHE_CHUNKS) -> ByteLevelCodes | WordCodes:
    """One encoder per worker and tokenizer file; ``kind`` is ``bytes`` or ``words``."""
    return {"bytes": ByteLevelCodes, "words": WordCodes}[kind](path, limit)
