"""Near-duplicate detection with min-max hashing.

Each document is a set of word shingles.  Under every permutation both the
smallest and the largest hash are kept, so ``permutations`` hash evaluations a
shingle give twice as many signature values; each agrees between two sets with
the probability of their Jaccard similarity, and the two of one permutation
vary less together than two independent ones.  Bands of ``rows`` values make
candidates.

Groups of copies cost no pairs of all with all:

* documents with one and the same set are one class, represented by its
  smallest id;
* in each bucket one hub is chosen, the member that shares buckets with most
  others (the original that copies were made from, as a rule), and each member
  is compared with the hubs of its buckets only; links are confirmed on the full
  sets and give components;
* what the hubs leave open, members of one bucket in different components, is
  settled block by block: the documents around a hub are dealt to blocks of
  bounded size, blocks that meet in a bucket are compared in one task, by
  signature first and on the full sets where that does not rule a link out, and
  only links leave the task.

Documents that already are in one component are never compared again, and no
task gets an unbounded group.
"""

from __future__ import annotations

import math
from collections import OrderedDict
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

PERMUTATIONS = 128
BANDS = 40
ROWS = 5
#: Signature bits that are compared before full sets are: two of each value.
WORDS = 2 * PERMUTATIONS // 64
#: Standard deviations of the signature's estimate below the threshold at which a
#: pair is left out.
MARGIN = 3.5
#: Documents of a block; two blocks meet in one task.
BLOCK = 128
#: Size of the filter that tells which documents may share a bucket: fixed, so
#: what is broadcast does not grow with the data; a join decides exactly.
FILTER_BITS = 1 << 23
#: Words of which a worker remembers the hash.
REMEMBERED = 500_000

_RNG = np.random.default_rng(20240601)
MULTIPLY = _RNG.integers(1, 1 << 63, PERMUTATIONS, dtype=np.uint64) | np.uint64(1)
ADD = _RNG.integers(1, 1 << 63, PERMUTATIONS, dtype=np.uint64)
POSITION = _RNG.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) < REMEMBERED:
            self[word] = h
        return h


_WORDS = _WordHashes()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads their bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of ``text``.  A-Z is
    lower-cased, words end at ASCII white space; fewer than ``width`` words are
    one shingle, no word none."""
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    n = len(h) - width + 1
    if n < 1:
        width, n = len(h), 1
    total = np.full(n, width, np.uint64)
    for k in range(width):
        total = mix(total + h[k:k + n] * POSITION[k % 64])
    return np.unique(total)


def signature(hashes: np.ndarray) -> np.ndarray:
    """2 x PERMUTATIONS values: the minimum and the maximum of each permutation."""
    low = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(PERMUTATIONS, np.uint64)
    for at in range(0, len(hashes), 512):
        x = hashes[at:at + 512, None] * MULTIPLY + ADD
        x ^= x >> np.uint64(32)
        x *= np.uint64(0x9E3779B97F4A7C15)
        np.minimum(low, x.min(axis=0), out=low)
        np.maximum(high, x.max(axis=0), out=high)
    return mix(np.concatenate([low, high]))


_INTERLEAVE = np.arange(2 * PERMUTATIONS).reshape(2, -1).T.ravel()


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One 64-bit key a band; a band takes minima and maxima in turn."""
    rows = sig[_INTERLEAVE][:BANDS * ROWS].reshape(BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        key = mix(key + rows[:, k] * POSITION[k])
    return key.view(np.int64)


def signature_bits(sig: np.ndarray) -> np.ndarray:
    """Two bits of each value: WORDS integers of first bits, then of second ones."""
    planes = np.concatenate([sig & np.uint64(1), (sig >> np.uint64(1)) & np.uint64(1)]).astype(np.uint8)
    return np.packbits(planes).view(np.int64)


SIGNED_DDL = "doc_id long, n long, low long, high long, bands array<long>, bits array<long>"
SIGNED = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("low", pa.int64()), ("high", pa.int64()),
                    ("bands", pa.list_(pa.int64())), ("bits", pa.list_(pa.int64()))])


def signed(docs: DataFrame, width: int) -> DataFrame:
    """Set size, a 128-bit digest of the set, band keys and signature bits."""

    def run(batches):
        for b in common.row_slices(batches):
            rows = []
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                s = shingle_set(text, width)
                if not len(s):
                    rows.append((doc, 0, None, None, None, None))
                    continue
                d = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64)
                sig = signature(s)
                rows.append((doc, len(s), int(d[0]), int(d[1]), band_keys(sig), signature_bits(sig)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(zip(*rows), SIGNED)], schema=SIGNED)

    return docs.mapInArrow(run, SIGNED_DDL)


def confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have a Jaccard similarity of at least
    ``percent`` hundredths.  ``texts``: rep, text."""
    left = pairs.join(texts.withColumnRenamed("rep", "a").withColumnRenamed("text", "text_a"), "a")
    both = left.join(texts.withColumnRenamed("rep", "b").withColumnRenamed("text", "text_b"), "b")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        sets: OrderedDict[int, np.ndarray] = OrderedDict()

        def get(doc, text):
            if doc not in sets:
                sets[doc] = shingle_set(text, width)
                if len(sets) > 256:
                    sets.popitem(last=False)
            return sets[doc]

        for whole in batches:
            for batch in common.row_slices(iter([whole]), "text_a"):
                a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
                ok = []
                for x, y, tx, ty in zip(a, b, batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist()):
                    s, t = get(x, tx), get(y, ty)
                    both = len(np.intersect1d(s, t, assume_unique=True))
                    ok.append(100 * both >= percent * (len(s) + len(t) - both))
                yield common.table_batch(schema, a=[x for x, k in zip(a, ok) if k],
                                         b=[y for y, k in zip(b, ok) if k])

    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """node, label: the smallest node that each node of ``links`` (a, b) reaches.

    Labels spread along links and jump to the label of the label, so the number
    of rounds grows with the logarithm of the longest path.  Every round is
    written, so it is not recomputed, and read as the next one's input.
    """
    both = common.cut(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = common.cut(both.groupBy("a").agg(F.min(F.least("a", "b")).alias("label"))
                        .withColumnRenamed("a", "node"), "labels")
    while True:
        heard = (both.join(labels.withColumnRenamed("node", "b"), "b")
                 .groupBy("a").agg(F.min("label").alias("heard")).withColumnRenamed("a", "node"))
        near = labels.join(heard, "node").select(
            "node", F.col("label").alias("old"), F.least("label", "heard").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("far"))
        far = near.join(jump, "label", "left").select(
            "node", "old", F.least("label", F.coalesce("far", "label")).alias("label"))
        written = common.cut(far, "labels")
        labels = written.select("node", "label")
        if written.where("old <> label").isEmpty():
            return labels


def least_agreement(percent: int) -> int:
    """The number of signature values that two sets with the threshold's
    similarity agree in at least, but for MARGIN standard deviations."""
    values = 2 * PERMUTATIONS
    agree = percent / 100 + (1 - percent / 100) / 4
    return int((agree - MARGIN * math.sqrt(agree * (1 - agree) / values)) * values)


def _similar(a: str, b: str, percent: int) -> Column:
    """Whether sizes and signature bits leave room for a link of rows a and b."""
    differ = reduce(lambda x, y: x + y, [F.bit_count(
        F.col(f"{a}.bits")[k].bitwiseXOR(F.col(f"{b}.bits")[k])
        .bitwiseOR(F.col(f"{a}.bits")[k + WORDS].bitwiseXOR(F.col(f"{b}.bits")[k + WORDS])))
        for k in range(WORDS)])
    size = ((100 * F.col(f"{a}.n") >= percent * F.col(f"{b}.n"))
            & (100 * F.col(f"{b}.n") >= percent * F.col(f"{a}.n")))
    return size & (differ <= F.lit(2 * PERMUTATIONS - least_agreement(percent)))


def chosen_texts(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """rep, text of the rows of ``rows`` (doc_id, text) that ``ids`` (rep) names.

    A bit map of the ids' hashes leaves out most other rows where they are read,
    so that the join does not move the whole corpus."""
    slot = F.pmod(F.xxhash64("rep"), F.lit(FILTER_BITS))
    words = (ids.select((slot / 32).cast("int").alias("word"), (slot % 32).cast("int").alias("bit"))
             .groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")).collect())
    held = np.zeros(FILTER_BITS // 32, np.uint32)
    for w in words:
        held[w.word] = w.bits
    held = rows.sparkSession.sparkContext.broadcast(held)

    def run(batches):
        for b in batches:
            slots = b.column("slot").to_numpy(zero_copy_only=False)
            yield b.filter(pa.array((held.value[slots >> 5] >> (slots & 31).astype(np.uint32) & 1).astype(bool)))

    named = rows.where("doc_id is not null").select(
        F.col("doc_id").alias("rep"), "text").withColumn("slot", slot)
    near = named.mapInArrow(run, "rep long, text string, slot long")
    return near.join(ids, "rep", "left_semi").groupBy("rep").agg(F.min("text").alias("text"))


def _block_links(width: int, percent: int):
    """Links between the documents of two blocks that are in different components."""

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            bits = [np.stack(t["bits"].to_numpy()).astype(np.int64).view(np.uint64) for t in (left, right)]
            n = [t["n"].to_numpy() for t in (left, right)]
            label = [t["label"].to_numpy() for t in (left, right)]
            rep = [t["rep"].to_numpy() for t in (left, right)]
            x = bits[0][:, None, :] ^ bits[1][None, :, :]
            differ = np.bitwise_count(x[:, :, :WORDS] | x[:, :, WORDS:]).sum(axis=2)
            ok = ((differ <= 2 * PERMUTATIONS - least_agreement(percent)) & (label[0][:, None] != label[1][None, :])
                  & (rep[0][:, None] != rep[1][None, :])
                  & (100 * n[0][:, None] >= percent * n[1][None, :]) & (100 * n[1][None, :] >= percent * n[0][:, None]))
            sets: list[dict[int, np.ndarray]] = [{}, {}]
            for i, j in zip(*np.nonzero(ok)):
                for k, (side, at) in enumerate(((left, i), (right, j))):
                    if at not in sets[k]:
                        sets[k][at] = shingle_set(side["text"].iat[at], width)
                s, t = sets[0][i], sets[1][j]
                both = len(np.intersect1d(s, t, assume_unique=True))
                if 100 * both >= percent * (len(s) + len(t) - both):
                    out.append((int(rep[0][i]), int(rep[1][j])))
        return pd.DataFrame(out, columns=["a", "b"]).astype({"a": "int64", "b": "int64"})

    return run


def open_links(member: DataFrame, labelled: DataFrame, hub: DataFrame, texts: DataFrame, width: int,
               percent: int) -> DataFrame:
    """Links (a, b) between documents that share a bucket and not a component.

    ``member``: bucket, rep; ``labelled``: rep, n, bits, label; ``hub``: rep, hub.
    """
    for _ in range(2):  # to the hub of the hub: groups around lesser hubs join the group that they lie in
        far = hub.select(F.col("rep").alias("hub"), F.col("hub").alias("far"))
        hub = common.cut(hub.join(far, "hub", "left").select("rep", F.coalesce("far", "hub").alias("hub")), "nearest")
    size = hub.groupBy("hub").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("parts"))
    dealt = hub.join(size, "hub").select("rep", F.xxhash64(
        "hub", F.pmod(F.xxhash64("rep"), F.col("parts"))).alias("block"))
    known = common.cut(labelled.join(dealt, "rep"), "dealt")
    here = (member.join(known.select("rep", "block", "label"), "rep").groupBy("bucket", "block")
            .agg(F.min("label").alias("first"), F.max("label").alias("last")))
    mixed = here.groupBy("bucket").agg(F.min("first").alias("low"), F.max("last").alias("high")).where("low <> high")
    here = common.cut(here.join(mixed.select("bucket"), "bucket", "left_semi"), "meeting")
    a, b = here.alias("a"), here.alias("b")
    meeting = common.cut(
        a.join(b, (F.col("a.bucket") == F.col("b.bucket")) & (F.col("a.block") <= F.col("b.block"))
               & (F.least("a.first", "b.first") != F.greatest("a.last", "b.last")))
        .select(F.col("a.block").alias("one"), F.col("b.block").alias("two")).distinct(), "pairs-of-blocks")
    rows = common.cut(known.join(texts, "rep"), "block-rows")
    names = ["one", "two", "rep", "n", "bits", "label", "text"]
    sides = [meeting.withColumn("block", F.col(c)).join(rows, "block").select(*names).toDF(*names)
             .groupBy("one", "two") for c in ("one", "two")]
    return sides[0].cogroup(sides[1]).applyInPandas(_block_links(width, percent), "a long, b long")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Components of documents linked by a Jaccard similarity of their sets of
    ``width``-word shingles of at least ``percent`` hundredths.

    Returns a row for each row of ``docs``: doc_id, n_shingles (set size),
    component_id (smallest id that links reach), kept (doc_id = component_id).
    A null or empty text has an empty set and is linked with nothing.  Rows that
    share an id are expected to share the text; if not, the smallest text decides
    on links of that id.  A row without id is linked with
    nothing: component_id null, kept true.  An empty table gives an empty result.
    """
    common.ship(docs.sparkSession)
    rows = common.texts(docs, id_col, text_col)
    seen = common.cut(signed(rows, width), "signed")
    key = ["n", "low", "high"]
    usable = seen.where("n > 0 and doc_id is not null")
    classes = common.cut(usable.groupBy(*key).agg(F.min("doc_id").alias("rep"),
                                                  F.min_by(F.struct("bands", "bits"), "doc_id").alias("s"))
                         .select(*key, "rep", "s.bands", "s.bits"), "classes")
    # buckets with two classes at least, and their members
    member = classes.select("rep", F.explode("bands").alias("bucket"))
    sizes = common.cut(member.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1"), "buckets")
    member = common.cut(member.join(sizes, "bucket"), "members")
    degree = member.groupBy("rep").agg(F.sum("size").alias("degree"))
    involved = common.cut(classes.join(degree, "rep").select("rep", "n", "bits", "degree"), "involved")
    texts = common.cut(chosen_texts(rows, involved.select("rep")), "texts")
    hubs = common.cut(member.join(involved.select("rep", "degree"), "rep").groupBy("bucket")
                      .agg(F.min(F.struct(-F.col("degree"), "rep"))["rep"].alias("hub")), "hubs")
    stars = member.join(hubs, "bucket").where("rep <> hub").select(F.col("rep").alias("one"), "hub").distinct()
    a, b = involved.alias("a"), involved.alias("b")
    stars = (stars.join(a, F.col("one") == F.col("a.rep"))
             .join(b, (F.col("hub") == F.col("b.rep")) & _similar("a", "b", percent))
             .select(F.col("a.rep").alias("a"), F.col("b.rep").alias("b")))
    links = common.cut(confirmed(common.cut(stars, "stars"), texts, width, percent), "links")
    label = components(links)

    # what the hubs left open
    labelled = (involved.join(label.withColumnRenamed("node", "rep"), "rep", "left")
                .select("rep", "n", "bits", F.coalesce("label", "rep").alias("label")))
    nearest = (member.join(hubs, "bucket").join(involved.select(F.col("rep").alias("hub"), "degree"), "hub")
               .groupBy("rep").agg(F.min(F.struct(-F.col("degree"), "hub"))["hub"].alias("hub")))
    more = open_links(member.select("bucket", "rep"), labelled, common.cut(nearest, "nearest"), texts, width, percent)
    label = components(common.cut(links.union(more), "links"))

    final = (classes.select(*key, "rep").join(label.withColumnRenamed("node", "rep"), "rep", "left")
             .select(*key, F.coalesce("label", "rep").alias("component_id")))
    out = seen.select("doc_id", *key).join(final, key, "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
