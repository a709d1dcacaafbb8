"""Cutting text into the pieces that byte-level BPE merges within.

``split_batch`` is the pattern ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+|
?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+`` as a finite automaton over character
classes, evaluated for many texts at once with array operations.  Where one
piece ends and the next begins depends on the classes of two neighbouring
characters and, for contractions, on the two letters after an apostrophe.
"""

from __future__ import annotations

import re
import string
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Regex, Tokenizer
from tokenizers.pre_tokenizers import Split

OTHER, LETTER, NUMBER, END, BLANK, SPACE = range(6)

#: Between a word character and a following space or line break a piece always
#: ends, whatever stands around: the automaton is back in its first state.
SURE_CUT = re.compile(r"\w(?=[ \n])")


@lru_cache(maxsize=1)
def character_classes() -> np.ndarray:
    """Class of every code point: the categories L and N, white space (the
    Unicode property, so without the four separators U+001C to U+001F)."""
    kinds = {"L": LETTER, "N": NUMBER}
    names = list(map(unicodedata.category, map(chr, range(0x110000))))
    table = np.array([kinds.get(n[0], OTHER) for n in names], np.uint8)
    table[[c for c in range(0x3001) if chr(c).isspace() and not 0x1C <= c <= 0x1F]] = BLANK
    # characters younger than Python's tables: ask the library's own expressions
    young = "".join(chr(c) for c in range(0x40000) if names[c] == "Cn")
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER)):
        for run, _ in Split(Regex(pattern), "removed", invert=True).pre_tokenize_str(young):
            table[[ord(c) for c in run]] = kind
    table[0x20] = SPACE
    return table


def split_batch(texts: list[str]) -> tuple[list[str], np.ndarray]:
    """Pieces of all texts in order, and the number of pieces of each text."""
    if not texts:
        return [], np.zeros(0, np.int64)
    joined = "\n".join([*texts, ""])
    codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    kind = character_classes()[codes]
    kind[ends] = END
    blank = kind >= BLANK
    start = np.ones(len(codes) + 3, bool)
    group = np.minimum(kind, BLANK)
    start[1:len(codes)] = group[1:] != group[:-1]
    start[ends] = True
    # the last blank before a visible character stands alone, or, a space, joins that character
    last = np.flatnonzero(blank[:-1] & ~blank[1:] & (kind[1:] != END))
    start[last] = True
    start[last[kind[last] == SPACE] + 1] = False
    mark = np.flatnonzero((codes == 0x27) & start[:len(codes)])
    if len(mark):
        after = np.concatenate([codes, np.zeros(2, np.uint32)])
        one, two = after[mark + 1], after[mark + 2]
        short = mark[np.isin(one, [ord(c) for c in "stmd"])]
        pairs = [(ord(a), ord(b)) for a, b in ("re", "ve", "ll")]
        long = mark[np.logical_or.reduce([(one == a) & (two == b) for a, b in pairs])]
        for at, n in ((short, 2), (long, 3)):
            start[at + 1] = False
            start[at + n] = True
    at = np.flatnonzero(start[:len(codes)])
    to = np.append(at[1:], len(codes))
    real = kind[at] != END
    at, to = at[real], to[real]
    pieces = [joined[a:b] for a, b in zip(at.tolist(), to.tolist())]
    return pieces, np.diff(np.searchsorted(at, ends), prepend=0)


def sure_chunks(text: str, limit: int) -> list[str]:
    """``text`` in chunks of about ``limit`` characters, cut only where a piece
    surely ends (a run without any such place stays whole)."""
    out, at = [], 0
    while len(text) - at > limit:
        m = SURE_CUT.search(text, at + limit - 1)
        if m is None:
            break
        out.append(text[at:m.end()])
        at = m.end()
    out.append(text[at:])
    return out


def document_pieces(texts: list[str], special: str | None = None,
                    limit: int = 1 << 19) -> Iterator[tuple[int, list[str]]]:
    """``(index of the text, pieces)`` in order; a long text comes in parts.

    ``special`` is a string that the tokenizer takes out of the text before it
    cuts pieces; it comes out as a piece of its own.
    """
    waiting: list[int] = []
    held = 0

    def flush():
        pieces, counts = split_batch([texts[i] for i in waiting])
        at = 0
        for i, n in zip(waiting, counts.tolist()):
            yield i, pieces[at:at + n]
            at += n

    for i, t in enumerate(texts):
        if len(t) > limit or special and special in t:
            yield from flush()
            waiting, held = [], 0
            for k, part in enumerate(t.split(special) if special else [t]):
                if k:
                    yield i, [special]
                for chunk in sure_chunks(part, limit):
                    yield i, split_batch([chunk])[0]
            continue
        waiting.append(i)
        held += len(t)
        if held > limit:
            yield from flush()
            waiting, held = [], 0
    yield from flush()


def byte_characters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level
    vocabularies: printable Latin-1 characters for themselves, the other bytes,
    in order, for the characters from 256 on."""
    own = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}


def token_bytes(vocab: dict[str, int]) -> dict[int, bytes]:
    """Bytes of each token of a byte-level vocabulary, by id."""
    back = {c: b for b, c in byte_characters().items()}
    return {i: bytes(back[c] for c in t) for t, i in vocab.items() if all(c in back for c in t)}


#: White space other than the space and the line feed.
OTHER_BLANKS = [chr(c) for c in range(0x3001)
                if chr(c).isspace() and c not in (0x20, 0x0A) and not 0x1C <= c <= 0x1F]
ASCII_BLANKS = [c for c in OTHER_BLANKS if c.isascii()]


def is_plain(text: str) -> bool:
    """Whether single spaces and line feeds are the only white space, each
    between two visible characters.  A piece then ends before each of them."""
    return (bool(text) and text[0] not in " \n" and text[-1] not in " \n"
            and not any(two in text for two in ("  ", "\n\n", " \n", "\n "))
            and not any(c in text for c in (ASCII_BLANKS if text.isascii() else OTHER_BLANKS)))


class WordMemo:
    """Values of whole texts, from the remembered values of their words.

    A word is what stands between two blanks, with the space before it; since a
    piece always ends where a blank follows a visible character, the value of a
    plain text is that of its words in order.  Other texts go by pieces.
    ``piece_values`` gives the values of new pieces, ``total`` combines values.
    Only the first ``size`` words are remembered, so the memory has a bound.
    """

    def __init__(self, piece_values, total, special: dict | None = None, size: int = 700_000):
        self.piece_values, self.total, self.size = piece_values, total, size
        self.special = next(iter(special), None) if special else None
        self.pieces: dict = dict(special or {})
        self.head: dict = {}
        self.inner: dict = {}

    def _pieces(self, lists: list[list[str]]) -> list:
        """The value of each list of pieces."""
        known = self.pieces
        new = list({p for pieces in lists for p in pieces if p not in known})
        look = known
        if new:
            values = dict(zip(new, self.piece_values(new)))
            if len(known) < self.size // 2:
                known.update(values)
            else:
                look = {p: known[p] if p in known else values[p] for pieces in lists for p in pieces}
        return [self.total(map(look.__getitem__, pieces)) for pieces in lists]

    def _words(self, memo: dict, lead: str, lists: list[list[str]]) -> list[list]:
        """The values of the words of each list."""
        found = [list(map(memo.get, words)) for words in lists]
        gaps = [k for k, values in enumerate(found) if None in values]
        new = list({w for k in gaps for w, v in zip(lists[k], found[k]) if v is None})
        if new:
            pieces, counts = split_batch([lead + w for w in new])
            at = np.cumsum(counts).tolist()
            values = self._pieces([pieces[b - n:b] for b, n in zip(at, counts.tolist())])
            fresh = dict(zip(new, values))
            if len(memo) < self.size:
                memo.update(fresh)
            for k in gaps:
                found[k] = [fresh[w] if v is None else v for w, v in zip(lists[k], found[k])]
        return found

    def _plain(self, texts: list[str]) -> list:
        lines = [line.split(" ") for t in texts for line in t.split("\n")]
        head = self._words(self.head, "", [[x[0]] for x in lines])
        inner = self._words(self.inner, " ", [x[1:] for x in lines])
        feed = self._pieces([["\n"]])[0]
        out, at = [], 0
        for t in texts:
            n = t.count("\n") + 1
            values = head[at] + inner[at]
            for k in range(at + 1, at + n):
                values.append(feed)
                values += head[k]
                values += inner[k]
            out.append(self.total(values))
            at += n
        return out

    def values(self, texts: list[str], size: int = 1 << 20) -> list:
        """The value of each text."""
        out: list = [None] * len(texts)
        plain = [i for i, t in enumerate(texts) if len(t) <= size and is_plain(t)
                 and not (self.special and self.special in t)]
        group, held = [], 0
        for i in plain:
            group.append(i)
            held += len(texts[i])
            if held >= size or i == plain[-1]:
                for k, v in zip(group, self._plain([texts[k] for k in group])):
                    out[k] = v
                group, held = [], 0
        other = [i for i, v in enumerate(out) if v is None]
        parts: list[list] = [[] for _ in other]
        for k, pieces in document_pieces([texts[i] for i in other], self.special):
            parts[k] += self._pieces([pieces])
        for i, p in zip(other, parts):
            out[i] = self.total(p)
        return out


#: Last bytes of the blanks beyond ASCII, as one number each.
WIDE_BLANKS = np.array([int.from_bytes(c.encode(), "big") for c in OTHER_BLANKS if not c.isascii()], np.uint32)
BLANK_BYTES = np.isin(np.arange(256), [ord(c) for c in (*ASCII_BLANKS, " ", "\n")])
#: ASCII letters, digits and other visible characters but the apostrophe, which
#: contractions take with what follows.
ASCII_CLASS = np.zeros(256, np.uint8)
for _k, _kind in enumerate((string.ascii_letters, string.digits, string.punctuation.replace("'", "")), 1):
    ASCII_CLASS[[ord(c) for c in _kind]] = _k


def chunk_starts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where chunks of the UTF-8 bytes ``data`` begin: at ``starts``, where texts do,
    at each space or line feed that follows a visible character, and between ASCII
    characters of two classes.  A piece surely ends there, whatever stands around,
    so a chunk's pieces depend on nothing outside it."""
    first = (data == 0x20) | (data == 0x0A)
    first[1:] &= ~BLANK_BYTES[data[:-1]]
    at = np.flatnonzero(first)
    at = at[at > 0]
    at = at[data[at - 1] >= 0x80]
    two = data[at - 2].astype(np.uint32) << 8 | data[at - 1]
    first[at[np.isin(two, WIDE_BLANKS) | np.isin(data[at - 3].astype(np.uint32) << 16 | two, WIDE_BLANKS)]] = False
    kind = ASCII_CLASS[data]
    first[1:] |= (kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0)
    first[starts[starts < len(data)]] = True
    return np.flatnonzero(first)


class TokenIds:
    """Ids of texts as little-endian unsigned 32-bit integers.

    Texts are cut into chunks, a word with the blanks before it or a run of marks as
    a rule (``chunk_starts``).  Arrow numbers the distinct ones, behind those that are
    remembered, and takes the ids of all by number, so Python sees new chunks only.
    Of more than ``size`` remembered chunks the half met most often stays.

    New pieces are encoded by the tokenizers library, many in one call: they
    are written with one printable character per byte, one to a line, and the
    library is told to split at the line ends (a character that no byte is
    written as).
    """

    def __init__(self, tokenizer: Tokenizer, special: dict[str, int] | None = None, size: int = 600_000):
        tokenizer.pre_tokenizer = Split("\n", "removed")
        self.tokenizer, self.size = tokenizer, size
        # UTF-8 has no byte 255: it stands between two pieces
        self.table = np.array([ord(c) for _, c in sorted((byte_characters() | {255: "\n"}).items())], "<u4")
        self.special = next(iter(special), None) if special else None
        self.special_id = np.array([*(special or {}).values()], "<u4").tobytes()
        self.chunks, self.ids = pa.array([], pa.string()), pa.array([], pa.binary())
        self.met = np.zeros(0, np.int64)

    def _encode(self, pieces: list[str]) -> pa.BinaryArray:
        """The ids of each piece."""
        ids, counts = [np.zeros(0, "<u4")], [np.zeros(1, np.int64)]
        for k in range(0, len(pieces), 1000):
            group = pieces[k:k + 1000]
            lines = self.table[np.frombuffer(b"\xff".join(map(str.encode, group)), np.uint8)].tobytes()
            e = self.tokenizer.encode(lines.decode("utf-32-le"), add_special_tokens=False)
            ids.append(np.array(e.ids, "<u4"))
            counts.append(np.bincount(np.array(e.word_ids, np.int64), minlength=len(group)))
        return _binary(np.concatenate(ids), np.concatenate(counts))

    def _split(self, chunks: pa.StringArray) -> pa.BinaryArray:
        """The ids of chunks that are not remembered, by their pieces."""
        pieces, counts, group, held = [], [np.zeros(1, np.int64)], [], 0
        for c in [*chunks.to_numpy(zero_copy_only=False), None]:
            if group and (c is None or held > 1 << 19):
                found, n = split_batch(group)
                pieces += found
                counts.append(n)
                group, held = [], 0
            if c is not None:
                group.append(c)
                held += len(c)
        once = {p: k for k, p in enumerate(dict.fromkeys(pieces))}
        ids = self._encode([*once]).take(pa.array(map(once.__getitem__, pieces), pa.int32()))
        return _bounded(ids, np.cumsum(np.concatenate(counts)))

    def _take(self, chunks: pa.StringArray) -> pa.BinaryArray:
        """The ids of chunks, remembered or new."""
        known = len(self.chunks)
        coded = pa.concat_arrays([self.chunks, chunks]).dictionary_encode()
        new, codes = coded.dictionary.slice(known), coded.indices.slice(known)
        ids = pa.concat_arrays([self.ids, self._split(new)]) if len(new) else self.ids
        self._remember(coded.dictionary, ids, codes.to_numpy())
        return ids.take(codes)

    def _remember(self, chunks: pa.StringArray, ids: pa.BinaryArray, codes: np.ndarray) -> None:
        met = np.bincount(codes, minlength=len(chunks))
        met[:len(self.met)] += self.met
        keep = np.flatnonzero(pc.binary_length(chunks).to_numpy() <= LONGEST)
        if len(keep) > self.size:
            keep = np.sort(keep[np.argsort(-met[keep], kind="stable")[:self.size // 2]])
            met //= 2
        if len(keep) < len(chunks):
            chunks, ids, met = chunks.take(pa.array(keep)), ids.take(pa.array(keep)), met[keep]
        self.chunks, self.ids, self.met = chunks, ids, met

    def _plain(self, texts: list[str]) -> list[bytes]:
        """The ids of texts without the special string."""
        column = pa.array(texts, pa.string())
        ends = np.frombuffer(column.buffers()[1], np.int32)[:len(texts) + 1]
        if not ends[-1]:
            return [b""] * len(texts)
        data = column.buffers()[2].slice(0, int(ends[-1]))
        at = chunk_starts(np.frombuffer(data, np.uint8), ends[:-1])
        offsets = pa.py_buffer(np.append(at, ends[-1]).astype(np.int32))
        ids = self._take(pa.StringArray.from_buffers(len(at), offsets, data))
        return _bounded(ids, np.searchsorted(at, ends)).to_pylist()

    def values(self, texts: list[str], size: int = 1 << 23) -> list[bytes]:
        """The ids of each text."""
        out: list = [[] for _ in texts]
        group: list[tuple[int, str | None]] = []  # None: the special string
        held = 0

        def flush():
            found = iter(self._plain([t for _, t in group if t is not None]))
            for i, t in group:
                out[i].append(self.special_id if t is None else next(found))
            group.clear()

        for i, text in enumerate(texts):
            for k, part in enumerate(text.split(self.special) if self.special else [text]):
                if k:
                    group.append((i, None))
                for chunk in sure_chunks(part, size):
                    group.append((i, chunk))
                    held += len(chunk)
                    if held >= size:
                        flush()
                        held = 0
        flush()
        return list(map(b"".join, out))


#: Bytes of the longest chunk that is remembered.
LONGEST = 256


def _binary(ids: np.ndarray, counts: np.ndarray) -> pa.BinaryArray:
    """Rows of ids; ``counts``: 0, then the number of ids of each row."""
    offsets = (4 * np.cumsum(counts)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(counts) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(ids)])


def _bounded(rows: pa.BinaryArray, first: np.ndarray) -> pa.BinaryArray:
    """The rows from ``first[k]`` to ``first[k + 1]`` as one row each."""
    offsets = np.frombuffer(rows.buffers()[1], np.int32)[rows.offset:][first]
    return pa.Array.from_buffers(pa.binary(), len(first) - 1, [None, pa.py_buffer(offsets), rows.buffers()[2]])
