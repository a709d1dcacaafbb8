"""Periodic runs of words by a suffix automaton with link-cut access.

A run is a stretch of words with a smallest period q (words q apart are
identical) that holds at least ``min_exponent`` periods and ``min_length`` words
and that no neighbouring word extends.

Automaton.  The suffix automaton of a stretch is built word by word; its suffix
links are a tree in which the path from a prefix's state to the root holds all
suffixes of the prefix.  Each state knows where its strings occurred last.
Appending the word at i gives that whole path the new last occurrence i.  States
with one last occurrence form segments of such paths, held as the preferred paths
of a link-cut tree (one splay tree each, its last occurrence at the root): the
access to a prefix's state meets each old segment once, O(log n) amortised.

Squares.  A segment with last occurrence e whose longest string has L words says
that prefixes i and e have exactly these L words as their longest common suffix.
Their distance p = i - e is the smallest period of the L + p words that end at i,
which are a square if p <= L and hold k periods if (k - 1) p <= L.  They
start at i - L - p + 1; while following words go on with the period, that start
stays, so the last report of a (start, period) is its run.

Stretches.  All but the first q words of a run have occurred at most q words
before, and at least (k - 1) q words follow each other so.  ``stretches`` cuts a text
where a word's distance to its last occurrence is too large for that and gives
the parts that are left to the automaton; nothing else can hold a run.

The operator works on the words ``[^\\x20\\x09-\\x0D]+`` of whole texts.  Each text is
one task's work in memory linear in its length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


class _Tree:
    """Suffix links of an automaton as a link-cut tree of which only ``access`` is
    needed: preferred paths as splay trees ordered by depth."""

    def __init__(self, link: list[int], length: list[int]):
        n = len(link)
        self.length = length
        self.left, self.right = [-1] * n, [-1] * n
        self.up = list(link)      # splay parent, or the path's parent for a splay root
        self.last = [-1] * n      # last occurrence of a path, held at its splay root

    def _rotate(self, x: int) -> None:
        left, right, up = self.left, self.right, self.up
        p = up[x]
        g = up[p]
        if left[p] == x:
            b = right[x]
            left[p], right[x] = b, p
        else:
            b = left[x]
            right[p], left[x] = b, p
        if b >= 0:
            up[b] = p
        up[p], up[x] = x, g
        if g >= 0:
            if left[g] == p:
                left[g] = x
            elif right[g] == p:
                right[g] = x

    def _splay(self, x: int) -> None:
        left, right, up = self.left, self.right, self.up
        root = x
        while (p := up[root]) >= 0 and (left[p] == root or right[p] == root):
            root = p
        self.last[x] = self.last[root]
        while (p := up[x]) >= 0 and (left[p] == x or right[p] == x):
            g = up[p]
            if g >= 0 and (left[g] == p or right[g] == p):
                self._rotate(p if (left[g] == p) == (left[p] == x) else x)
            self._rotate(x)

    def access(self, state: int, now: int) -> list[tuple[int, int]]:
        """Gives the path from ``state`` to the root the last occurrence ``now``;
        returns (longest string, last occurrence) of the segments it had."""
        met, below, x = [], -1, state
        while x >= 0:
            self._splay(x)
            if self.last[x] >= 0:
                met.append((self.length[x], self.last[x]))
            r = self.right[x]
            if r >= 0:
                self.last[r] = self.last[x]  # what is deeper keeps its last occurrence
            self.right[x] = below
            below, x = x, self.up[x]
        self.last[below] = now
        self._splay(state)
        return met


def automaton(words: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Suffix links and lengths of the states (state 0: the empty string, without a
    link: -1), and each prefix's state."""
    link, length, after = [-1], [0], [{}]
    prefix, last = [], 0
    for i, w in enumerate(words):
        cur = len(link)
        link.append(0)
        length.append(i + 1)
        after.append({})
        p = last
        while p >= 0 and w not in after[p]:
            after[p][w] = cur
            p = link[p]
        if p >= 0:
            q = after[p][w]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                copy = len(link)
                link.append(link[q])
                length.append(length[p] + 1)
                after.append(dict(after[q]))
                while p >= 0 and after[p].get(w) == q:
                    after[p][w] = copy
                    p = link[p]
                link[q] = link[cur] = copy
        last = cur
        prefix.append(cur)
    return link, length, prefix


def runs_of(words: list[int], min_length: int = 6, min_exponent: int = 4) -> list[tuple[int, int, int]]:
    """All runs as (start, length, period), by start, then period."""
    link, length, prefix = automaton(words)
    tree = _Tree(link, length)
    end: dict[tuple[int, int], int] = {}
    for i, state in enumerate(prefix):
        for longest, seen in tree.access(state, i):
            p = i - seen
            if (min_exponent - 1) * p <= longest:
                end[i - longest - p + 1, p] = i
    return sorted((s, e - s + 1, p) for (s, p), e in end.items() if e - s + 1 >= min_length)


def distances(words: np.ndarray) -> np.ndarray:
    """Each place's distance to the last occurrence of its word, len(words) without one."""
    order = np.argsort(words, kind="stable")
    out = np.full(len(words), len(words), np.int64)
    same = words[order[1:]] == words[order[:-1]]
    out[order[1:][same]] = (order[1:] - order[:-1])[same]
    return out


def stretches(gap: np.ndarray, min_length: int = 6, min_exponent: int = 4) -> list[tuple[int, int]]:
    """(first, last) of the parts of a text where the repeating words of a run may
    lie: n words in a row, none farther than n / (min_exponent - 1) from its last occurrence."""
    least, found = max(1, min(min_length - 1, min_exponent - 1)), []
    todo = [(0, len(gap) - 1)]
    while todo:
        a, z = todo.pop()
        n = z - a + 1
        if n < least:
            continue
        far = np.flatnonzero(gap[a:z + 1] * (min_exponent - 1) > n)
        if len(far):
            cut = np.concatenate([[a - 1], far + a, [z + 1]])
            wide = np.flatnonzero(np.diff(cut) > least)
            todo += [(int(cut[k]) + 1, int(cut[k + 1]) - 1) for k in wide]
        else:
            found.append((a, z))
    return sorted(found)


def runs_of_text(words: list, min_length: int = 6, min_exponent: int = 4) -> list[tuple[int, int, int]]:
    """``runs_of`` of any words; the automaton reads only the stretches that may hold a run."""
    number: dict = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    out = []
    if len(ids) - len(number) < min(min_length - 1, min_exponent - 1):  # fewer repeats than a run has
        return out
    for a, z in stretches(distances(ids), min_length, min_exponent):
        # a run whose repeats lie in the stretch begins at most so many words before it;
        # one word more shows whether it goes on to the left
        start = max(0, a - (z - a + 1) // (min_exponent - 1) - 1)
        for s, n, p in runs_of(ids[start:z + 1].tolist(), min_length, min_exponent):
            if start + s + n > a:  # otherwise its repeats lie in an earlier stretch
                out.append((start + s, n, p))
    return sorted(out)


def collapsed(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    drop = np.zeros(len(words) + 1, np.int64)
    for s, n, p in runs:
        drop[s + p] += 1
        drop[s + n] -= 1
    inside = np.cumsum(drop) > 0
    return [w for w, d in zip(words, inside) if not d]


def periodic_runs(docs: DataFrame, min_length: int = 6, min_exponent: int = 4, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """doc_id, runs: array of struct<start, length, period> (word numbers; by start,
    then period), collapsed: the text without what runs repeat, its words joined by
    one space.

    One row for each row of ``docs``, whatever its id: null and repeated ids keep their
    rows.  A null, empty or blank text has no run and collapses to the empty text; an
    empty table gives an empty result.  ``min_exponent`` is a whole number of at least 2.
    """
    if min_exponent < 2:
        raise ValueError("min_exponent has to be 2 or more")
    common.ship(docs.sparkSession)
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    schema = pa.schema([("doc_id", pa.int64()), ("runs", pa.list_(run)), ("collapsed", pa.string())])

    def find(batches):
        for b in common.row_slices(batches):
            found, kept = [], []
            for text in b.column("text").to_pylist():
                words = text.encode().split()  # bytes are split at \x20 and \x09-\x0D alone
                runs = runs_of_text(words, min_length, min_exponent)
                found.append([{"start": s, "length": n, "period": p} for s, n, p in runs])
                kept.append(b" ".join(collapsed(words, runs)).decode())
            yield common.table_batch(schema, doc_id=b.column("doc_id"), runs=found, collapsed=kept)

    return common.texts(docs, id_col, text_col).mapInArrow(
        find, "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def planted(docs: DataFrame) -> DataFrame:
    """doc_id, text: documents in some of which words repeat.  With h = crc32 of the
    id as text and g = h / 10, a document with h % 10 = 0 and n words has word
    a + (i - a) % p in the place of each word i >= a, a = g % n, p = 1 + (n - a) / (3 + g % 8);
    others, and rows without an id, stay as they are."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = F.coalesce(h % 10 == 0, F.lit(False))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = common.texts(docs).withColumn("g", F.floor(h / 10).cast("long"))
    rows = rows.withColumn("w", F.when(chosen, words)).withColumn("n", F.size("w").cast("long"))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    rows = rows.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("long"))
    place = F.sequence(F.lit(0).cast("long"), F.col("n") - 1)
    moved = F.transform(place, lambda i: F.get("w", F.when(i < F.col("a"), i).otherwise(
        F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(moved, " "))
                       .otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """The longest run and digests of ``periodic_runs``."""
    best = F.col("best")
    by_rank = F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"),
                                                     r["period"].alias("p")))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n"))), "")
    rows = found.withColumn("best", F.array_min(by_rank))
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["s"].alias("start"),
        (-best["l"]).alias("length"), best["p"].alias("period"),
        F.floor(-1000 * best["l"] / best["p"]).cast("long").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
