"""Packing tokenised documents into sequences by a grouping genetic algorithm.

A chromosome is a list of bins (groups of pieces).  Crossover injects whole
well-filled bins of one parent into the other, removes the bins that now hold
duplicates, and best-fits the pieces that lost their place; mutation dissolves
the emptiest bins.  The pieces are dealt at random into islands of a few
thousand, small enough for one task, whatever the input; on an island several
populations evolve the same pieces and pass their elite on around a ring.
After an epoch the well-filled bins of an island's best chromosome are final;
the pieces of its other bins migrate: they are dealt anew and meet pieces of
other islands in the next epoch.
"""

from __future__ import annotations

import random
import zlib
from bisect import bisect_left, insort

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from . import common
from .pieces import TokenIds

PIECE_DDL = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _memo(model: str) -> TokenIds:
    key = hash(model)
    if key not in _MEMOS:
        tokenizer = Tokenizer.from_str(model)
        special = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items() if t.special}
        if len(special) > 1:
            raise ValueError("at most one special string is supported")
        _MEMOS.clear()
        _MEMOS[key] = TokenIds(tokenizer, special)
    return _MEMOS[key]


_MEMOS: dict[int, TokenIds] = {}


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0,
                 with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenise whole texts, add ``end_id`` and cut what is longer than ``capacity``.

    Columns: doc_id, piece, start, length, ids_crc32, deal (a random number that
    deals pieces to islands) and, if asked for, ids (binary, little-endian
    unsigned 32-bit).  All pieces of a document but the first are full.
    """
    spark = docs.sparkSession
    common.ship(spark)
    with open(tokenizer_path, encoding="utf-8") as f:
        model = spark.sparkContext.broadcast(f.read())
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
              ("length", pa.int64()), ("ids_crc32", pa.int64()), ("deal", pa.int64())]
    schema = pa.schema(fields + [("ids", pa.binary())] * with_ids)
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        memo = _memo(model.value)
        rng = random.Random(TaskContext.get().partitionId())
        for b in common.row_slices(batches):
            rows = []
            for doc, data in zip(b.column("doc_id").to_pylist(), memo.values(b.column("text").to_pylist())):
                data += end
                n = len(data) // 4
                cuts = [0, *range((n - 1) % capacity + 1, n + 1, capacity)]
                for k, (a, z) in enumerate(zip(cuts, cuts[1:])):
                    part = data[4 * a:4 * z]
                    rows.append((doc, k, a, z - a, zlib.crc32(part), rng.getrandbits(62), part))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    ddl = PIECE_DDL + ", deal long" + ", ids binary" * with_ids
    return common.texts(docs, id_col, text_col).mapInArrow(run, ddl)


# ---- one island ------------------------------------------------------------

def best_fit(bins: list[list[int]], loads: list[int], items: list[int], size: list[int],
             capacity: int) -> None:
    """Put ``items`` one by one into the fullest bin with room, else a new one."""
    rooms = sorted((capacity - load, k) for k, load in enumerate(loads))
    for i in items:
        at = bisect_left(rooms, (size[i], -1))
        if at < len(rooms):
            room, k = rooms.pop(at)
        else:
            room, k = capacity, len(bins)
            bins.append([])
            loads.append(0)
        bins[k].append(i)
        loads[k] += size[i]
        if room > size[i]:
            insort(rooms, (room - size[i], k))


class Chromosome:
    """Bins with their loads; fewer bins are better, then unevener fill."""

    def __init__(self, bins: list[list[int]], loads: list[int], capacity: int):
        self.bins, self.loads = bins, loads
        self.cost = (len(bins), -sum((x / capacity) ** 2 for x in loads))


def crossover(a: Chromosome, b: Chromosome, size: list[int], capacity: int,
              rng: random.Random) -> Chromosome:
    """Inject well-filled bins of ``b`` into ``a``."""
    order = sorted(range(len(b.bins)), key=lambda k: -b.loads[k])
    good = order[:max(1, len(order) // 2)]
    chosen = rng.sample(good, rng.randint(1, max(1, len(good) // 2)))
    injected = {i for k in chosen for i in b.bins[k]}
    bins, loads, displaced = [list(b.bins[k]) for k in chosen], [b.loads[k] for k in chosen], []
    for content, load in zip(a.bins, a.loads):
        if injected.isdisjoint(content):
            bins.append(list(content))
            loads.append(load)
        else:
            displaced += [i for i in content if i not in injected]
    best_fit(bins, loads, sorted(displaced, key=lambda i: -size[i]), size, capacity)
    return Chromosome(bins, loads, capacity)


def mutate(c: Chromosome, size: list[int], capacity: int, rng: random.Random) -> Chromosome:
    """Dissolve the emptiest bins and some others; best-fit their pieces."""
    order = sorted(range(len(c.bins)), key=lambda k: c.loads[k])
    n = max(1, len(order) // 20)
    gone = {*order[:n], *rng.sample(order, min(len(order), n))}
    bins = [list(x) for k, x in enumerate(c.bins) if k not in gone]
    loads = [x for k, x in enumerate(c.loads) if k not in gone]
    free = [i for k in sorted(gone) for i in c.bins[k]]
    free.sort(key=lambda i: -size[i] * rng.uniform(0.9, 1.0))
    best_fit(bins, loads, free, size, capacity)
    return Chromosome(bins, loads, capacity)


def evolve(size: list[int], capacity: int, seed: int, populations: int = 2, members: int = 4,
           generations: int = 6) -> Chromosome:
    """The best grouping found on one island."""
    rng = random.Random(seed)
    bound = max(-(-sum(size) // capacity), sum(2 * s > capacity for s in size))
    items = sorted(range(len(size)), key=lambda i: -size[i])

    def grown(order):
        bins, loads = [], []
        best_fit(bins, loads, order, size, capacity)
        return Chromosome(bins, loads, capacity)

    best = grown(items)
    if len(best.bins) <= bound:
        return best
    ring = [[best] + [grown(sorted(items, key=lambda i: -size[i] * rng.uniform(0.8, 1.0)))
                      for _ in range(members - 1)] for _ in range(populations)]
    for _ in range(generations):
        for group in ring:
            group.sort(key=lambda c: c.cost)
            child = crossover(group[0], rng.choice(group[1:]), size, capacity, rng)
            other = mutate(crossover(rng.choice(group[1:]), group[0], size, capacity, rng),
                           size, capacity, rng)
            group[-2:] = [child, other]
        elite = [min(group, key=lambda c: c.cost) for group in ring]
        for k, group in enumerate(ring):  # each population's elite goes to its neighbour
            group.sort(key=lambda c: c.cost)
            group[-1] = elite[k - 1]
        best = min([best, *elite], key=lambda c: c.cost)
        if len(best.bins) <= bound:
            break
    return best


def _island(capacity: int, keep: int, epoch: int):
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "deal"], kind="stable").reset_index(drop=True)
        best = evolve(pdf["length"].tolist(), capacity, int(pdf["deal"].iloc[0] % (1 << 31)))
        bin_of, offset = np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
        final = np.zeros(len(pdf), bool)
        for k, (content, load) in enumerate(zip(best.bins, best.loads)):
            at = 0
            for i in content:
                bin_of[i], offset[i], final[i] = k, at, load >= keep
                at += int(pdf["length"].iat[i])
        pdf["sequence_id"] = (epoch << 56) + pdf["island"].to_numpy() * (1 << 20) + bin_of
        pdf["offset"], pdf["final"] = offset, final
        rng = np.random.default_rng(int(pdf["deal"].iloc[0] % (1 << 31)))
        pdf["deal"] = rng.integers(0, 1 << 62, len(pdf))
        return pdf.drop(columns="island")

    return pack


def pack(pieces: DataFrame, capacity: int = 2048, island: int = 4096, epochs: int = 3,
         fill: float = 0.99) -> DataFrame:
    """Place every row of ``pieces`` (the columns of ``token_pieces``; further
    columns are carried along) in a sequence: adds sequence_id and offset.

    Pieces of full length are a sequence each.  The others are packed in
    ``epochs`` rounds of islands of about ``island`` pieces; bins filled to
    ``fill`` become final after each round, all after the last.  Rows with equal
    keys are packed like any others; an empty table gives an empty result.
    """
    if not 0 < island < 1 << 19:
        raise ValueError("island must be between 1 and 524287")
    pieces = common.cut(pieces, "pieces")
    common.ship(pieces.sparkSession)
    columns = [c for c in pieces.columns if c != "deal"]
    full = (pieces.where(F.col("length") >= capacity).select(*columns)
            .withColumn("sequence_id", -1 - F.monotonically_increasing_id())
            .withColumn("offset", F.lit(0).cast("long")))
    done, rest = [full], pieces.where(F.col("length") < capacity)
    for epoch in range(1, epochs + 1):
        n = rest.count()
        if not n:
            break
        islands = -(-n // island)
        last = epoch == epochs or islands == 1
        schema = rest.schema.add("sequence_id", "long").add("offset", "long").add("final", "boolean")
        keep = 0 if last else int(capacity * fill)
        packed = common.cut(
            rest.withColumn("island", F.pmod("deal", F.lit(islands)))
            .groupBy("island").applyInPandas(_island(capacity, keep, epoch), schema), f"epoch-{epoch}")
        done.append(packed.where("final").select(*columns, "sequence_id", "offset"))
        if last:
            break
        rest = packed.where("not final").select(*columns, "deal")
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0,
                   with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text",
                   **options) -> DataFrame:
    """Tokenise and pack whole documents: doc_id, piece, start, length,
    ids_crc32, (ids,) sequence_id, offset.  A null or empty text is a piece of
    one token (``end_id``); ids and repeated rows are kept as they are."""
    return pack(token_pieces(docs, tokenizer_path, capacity, end_id, with_ids, id_col, text_col),
                capacity, **options)
