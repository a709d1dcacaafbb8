"""Token counts by finite-state tokenizer compilation.

A byte-level BPE tokenizer is a chain of two deterministic machines: the
automaton over character classes that cuts pieces (``pieces.split_batch``) and,
within a piece, a transducer over bytes whose transitions carry the number of
tokens that they add.  ``CountingTransducer`` compiles the second one while it
reads: a state holds, for every position from which a token may still be
running, the place in the vocabulary's trie, the last token of the encoding up
to that position, and its token count relative to the present one.  A byte
extends these; the longest token that ends here and may follow the token before
it is the last token of the new prefix (in a BPE encoding exactly one does), so
the state after the byte and the count that it adds are determined.  Two
prefixes with equal states behave alike for ever, so states are shared and the
table stays far smaller than the set of pieces.  The count on a transition may
be 0 or negative: a byte can turn several tokens into one.

A text is a chain of chunks: a word with the blank before it, or for texts with
other white space about half a million characters.  Each chunk has a map from
the state in which it may be entered to the state in which it is left and the
tokens added; maps compose associatively, so a prefix scan over them gives the
count.  Chunks are cut only where the machines are surely back in their first
state, so each map has that one entry and its scan is a running sum; the maps
of words are remembered, and most of a text is read by looking them up.
"""

from __future__ import annotations

import json

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .pieces import WordMemo, byte_characters

#: State of the piece automaton at every sure cut.
FIRST = 0
#: Rank of a merge that does not exist.
NEVER = 1 << 60


class CountingTransducer:
    """Number of BPE tokens of a piece of bytes.

    At most ``states`` states are remembered; what comes later is computed by
    the same rule and forgotten, so the memory has a bound and the result never
    depends on it.
    """

    def __init__(self, vocab: dict[str, int], merges: list, states: int = 200_000):
        back = {c: b for b, c in byte_characters().items()}
        words = {t: bytes(back[c] for c in t) for t in vocab if all(c in back for c in t)}
        number = {w: k for k, w in enumerate(words.values())}
        self.max_states = states
        self.rank: dict[tuple[int, int], int] = {}
        self.split: dict[int, tuple[int, int]] = {}
        for k, m in enumerate(merges):
            a, b = m.split(" ") if isinstance(m, str) else m
            pair = number[words[a]], number[words[b]]
            self.rank.setdefault(pair, k)
            self.split.setdefault(number[words[a] + words[b]], pair)
        self.seams: dict[tuple[int, int], list[tuple[int, int]]] = {}
        self.follows: dict[int, bool] = {}
        self._build_trie(number)
        #: state: (trie node, last token before it, its count relative to now), longest first
        start = ((0, -1, 0),)
        self.states, self.number = [start], {start: FIRST}
        self.table: list[dict[int, tuple[int, int]]] = [{}]

    def _build_trie(self, number: dict[bytes, int]) -> None:
        """``child[node][byte]``: next node, its token or -1, whether it goes on."""
        nodes: dict[bytes, int] = {b"": 0}
        for w in number:
            for n in range(1, len(w) + 1):
                nodes.setdefault(w[:n], len(nodes))
        inner = {w[:-1] for w in nodes if w}
        self.child: list[dict[int, tuple[int, int, bool]]] = [{} for _ in nodes]
        for w, k in nodes.items():
            if w:
                self.child[nodes[w[:-1]]][w[-1]] = (k, number.get(w, -1), w in inner)

    def seam(self, word: int, side: int) -> list[tuple[int, int]]:
        """Tokens at the right (side 1) or left (side 0) edge of ``word`` while
        it is being merged, from a byte up to the word itself, each with the
        rank of the merge that made it."""
        found = self.seams.get((word, side))
        if found is None:
            made = self.split.get(word)
            found = [*self.seam(made[side], side), (word, self.rank[made])] if made else [(word, -1)]
            self.seams[word, side] = found
        return found

    def may_follow(self, a: int, b: int) -> bool:
        """Whether a and b stay two tokens when a + b is encoded: at no time is
        the merge of what stands left and right of the seam the next to happen."""
        left, right = self.seam(a, 1), self.seam(b, 0)
        i = j = 0
        while True:
            grow_left = left[i + 1][1] if i + 1 < len(left) else NEVER
            grow_right = right[j + 1][1] if j + 1 < len(right) else NEVER
            across = self.rank.get((left[i][0], right[j][0]), NEVER)
            if across < grow_left and across <= grow_right and across < NEVER:
                return False
            if grow_left == grow_right == NEVER:
                return True
            if grow_left <= grow_right:
                i += 1
            else:
                j += 1

    def step(self, state: tuple, byte: int) -> tuple[tuple, int]:
        """The state after ``byte`` and the tokens that it adds."""
        running, last, added = [], -1, 0
        for node, before, count in state:
            edge = self.child[node].get(byte)
            if edge is None:
                continue
            node, word, goes_on = edge
            if goes_on:
                running.append((node, before, count))
            if last < 0 and word >= 0:
                if before >= 0:
                    ok = self.follows.get(before << 20 | word)
                    if ok is None:
                        ok = self.follows[before << 20 | word] = self.may_follow(before, word)
                    if not ok:
                        continue
                last, added = word, count + 1
        return (*[(n, b, c - added) for n, b, c in running], (0, last, 0)), added

    def run(self, state: int, data: bytes) -> int:
        """Tokens of ``data`` read from ``state``; transitions are compiled at first use."""
        n = 0
        for at, byte in enumerate(data):
            found = self.table[state].get(byte)
            if found is None:
                key, added = self.step(self.states[state], byte)
                to = self.number.get(key)
                if to is None:
                    if len(self.states) >= self.max_states:
                        n += added
                        for b in data[at + 1:]:
                            key, added = self.step(key, b)
                            n += added
                        return n
                    to = self.number[key] = len(self.states)
                    self.states.append(key)
                    self.table.append({})
                self.table[state][byte] = found = to, added
            state = found[0]
            n += found[1]
        return n

    def counts(self, pieces: list[str]) -> list[int]:
        """Tokens of pieces, each of which begins in the first state."""
        if len(self.follows) > 4 * self.max_states:
            self.follows.clear()
        return [self.run(FIRST, p.encode()) for p in pieces]


def machine(model: str) -> WordMemo:
    """Token counts of texts by a tokenizers file (kept while the worker lives)."""
    key = hash(model)
    if key not in _MACHINES:
        j = json.loads(model)
        if j["model"]["type"] != "BPE" or j.get("normalizer"):
            raise ValueError("a byte-level BPE file without a normaliser is needed")
        special = [t["content"] for t in j.get("added_tokens", []) if t["special"]]
        if len(special) > 1:
            raise ValueError("at most one special string is supported")
        transducer = CountingTransducer(j["model"]["vocab"], j["model"]["merges"])
        _MACHINES.clear()
        _MACHINES[key] = WordMemo(transducer.counts, sum, dict.fromkeys(special, 1))
    return _MACHINES[key]


_MACHINES: dict[int, WordMemo] = {}


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 512,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token count of every whole text.

    Columns: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).
    Special strings inside a text count one token, as the library has it by
    default.  Null and empty texts: 0 bytes, 0 tokens.  Rows with equal ids
    each give a row; an empty table gives an empty result.  One pass, no
    shuffle; the tokenizer file is read on the driver and broadcast (its size
    is the vocabulary's, not the data's).
    """
    spark = docs.sparkSession
    common.ship(spark)
    with open(tokenizer_path, encoding="utf-8") as f:
        model = spark.sparkContext.broadcast(f.read())
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])

    def run(batches):
        counter = machine(model.value)
        for b in common.row_slices(batches):
            counts = counter.values(b.column("text").to_pylist())
            size = pc.binary_length(b.column("text")).cast(pa.int64())
            yield common.table_batch(schema, doc_id=b.column("doc_id"), n_bytes=size, n_tokens=counts)

    out = common.texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
