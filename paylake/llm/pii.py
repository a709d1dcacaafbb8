"""Personal data: patterns, and information-theoretic sanitisation.

Mail addresses, IP addresses, card and phone numbers are found by pattern in
every whole text; each distinct value is a protected entity.  How much a term
reveals of an entity is estimated from the corpus: with p(t) the share of
documents that hold term t, p(c) that of entity c, and p(c, t) that of documents
where t stands close to c, the disclosure of c by t is

    PMI(c; t) / IC(c),   PMI = log2 p(c, t) / (p(c) p(t)),   IC = -log2 p(c),

1 if t occurs only with c.  A term is disclosing if this reaches ``threshold``
for some entity and the pair is not due to chance: with b different contexts
(copies of a document repeat a context and add nothing) of an entity in n
documents, Chernoff's bound for at least b of them to hold a term of share p is
2^-(n KL(b/n || p)), and has to lie below ``alpha`` over the number of pairs of an
entity and a term that could have as many contexts (``_needed``).  Two contexts of
a rare name can so be enough; a single one hardly ever is.  Disclosing terms are
marked wherever they occur, with or without the entity; ``sanitise`` replaces
patterns by their kind, generalises disclosing terms that have a more general
form (numbers, names) and removes the others.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

# The kinds in the order in which ties of start are listed.
KINDS = ("email", "ip", "card", "phone")
TERM = "term"
# What replaces each kind.
MASKS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]++(\.[0-9]++\.[0-9]++\.[0-9]++)?")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
WORD = re.compile(r"\S+")
EDGE = ".,;:!?\"'()[]{}<>*_"


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of the address pattern, in time linear in the text: a
    match ends its local part at an @ and takes all of the run before it."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            free = m.end()
        else:
            free = max(free, at + 1)
        at = text.find("@", max(at + 1, free))
    return out


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of all patterns, sorted."""
    out = [(a, 0, z) for a, z in emails(text)] if "@" in text else []
    for m in DOTTED.finditer(text):
        if m.group(1) and all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if 12 <= m.end() - m.start() <= 37:
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c in "0123456789" for c in m.group()) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{(*KINDS, TERM)[k]}:{a}:{z}" for a, k, z in spans)


def term_of(word: str) -> str:
    return word.strip(EDGE).lower()


def entity_of(text: str, span: tuple[int, int, int]) -> str:
    """The entity's name: its kind, and its value without separators."""
    value = text[span[0]:span[2]].lower()
    return f"{KINDS[span[1]]}:{re.sub(r'[^0-9]', '', value) if span[1] > 1 else value}"


def words_before(text: str, at: int, words: int) -> list[str]:
    """The last ``words`` whole words (the part of one at ``at`` counts) before ``at``, however long."""
    size = 40 * words
    while True:
        start = max(0, at - size)
        found = text[start:at].split()
        if start == 0 or len(found) > words:  # the first one may be cut
            return found[-words:]
        size *= 4


def words_after(text: str, at: int, words: int) -> list[str]:
    """The first ``words`` whole words after ``at``."""
    size = 40 * words
    while True:
        found = text[at:at + size].split()
        if at + size >= len(text) or len(found) > words:
            return found[:words]
        size *= 4


def contexts(text: str, spans: list[tuple[int, int, int]], words: int) -> dict[tuple[str, str], int]:
    """(entity, term) -> hash of a context, for terms within ``words`` words of
    a mention; the smallest hash if the pair stands in several contexts."""
    out: dict[tuple[str, str], int] = {}
    for s in spans:
        around = words_before(text, s[0], words) + words_after(text, s[2], words)
        near = [t for t in map(term_of, around) if t]
        entity = entity_of(text, s)
        mark = zlib.crc32(" ".join(near).encode())
        for t in near:
            out[entity, t] = min(mark, out.get((entity, t), mark))
    return out


GATHERED = pa.schema([("role", pa.string()), ("entity", pa.string()), ("term", pa.string()),
                      ("context", pa.int64()), ("n", pa.int64())])


def gather(docs: DataFrame, words: int) -> DataFrame:
    """Corpus counts, added up within each task: role D (documents), T
    (documents with a term), E (with an entity), C (with both, close)."""

    def run(batches):
        counts: Counter = Counter()

        def out():
            rows = [(*k, n) for k, n in counts.items()]
            counts.clear()
            for at in range(0, len(rows), 50_000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=f.type) for c, f in zip(zip(*rows[at:at + 50_000]), GATHERED)],
                    schema=GATHERED)

        terms: Counter = Counter()
        for b in common.row_slices(batches):
            for text in b.column("text").to_pylist():
                counts["D", "", "", 0] += 1
                terms.update({term_of(w) for w in set(text.split())})
                spans = base_spans(text)
                if spans:
                    for e in {entity_of(text, s) for s in spans}:
                        counts["E", e, "", 0] += 1
                    for (e, t), mark in contexts(text, spans, words).items():
                        counts["C", e, t, mark] += 1
            if len(terms) + len(counts) > 400_000:
                yield from _terms(terms)
                yield from out()
        yield from _terms(terms)
        yield from out()

    def _terms(terms):
        rows = [(t, n) for t, n in terms.items() if t]
        terms.clear()
        for at in range(0, len(rows), 50_000):
            part = rows[at:at + 50_000]
            yield common.table_batch(GATHERED, role=["T"] * len(part), entity=[""] * len(part),
                                     term=[t for t, _ in part], context=[0] * len(part),
                                     n=[n for _, n in part])

    return docs.mapInArrow(run, "role string, entity string, term string, context long, n long")


def _needed(entity: DataFrame, terms: DataFrame, alpha: float) -> list[float]:
    """Bits that b contexts have to give, for each level L with 2^L <= b < 2^(L+1):
    log2 of the entities and of the terms that are in 2^L documents at least, and
    of 2^(L+1) / alpha, so that all levels together have the error ``alpha``."""
    def reach(df, c):
        held = {r.level: r["count"] for r in df.groupBy(_level(c).alias("level")).count().collect()}
        return [sum(n for at, n in held.items() if at >= level) for level in range(64)]

    return [math.log2(max(1, e) * max(1, t)) + level + 1 - math.log2(alpha)
            for level, (e, t) in enumerate(zip(reach(entity, "with_entity"), reach(terms, "with_term")))]


def _level(c: str) -> Column:
    return F.length(F.bin(c)) - 1


def disclosing_terms(docs: DataFrame, threshold: float = 0.9, alpha: float = 0.05,
                     words: int = 5, text_col: str = "text") -> DataFrame:
    """term, disclosure: the terms that reveal some protected entity.

    A term counts once a document, whatever forms it stands in; counts are over
    all documents and whole texts.  ``alpha``: the chance that any pair of the
    corpus passes as evidence without being any.
    """
    common.ship(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    seen = common.cut(gather(rows, words), "terms")
    total = seen.where("role = 'D'").agg(F.sum("n").alias("all_docs"))
    entity = seen.where("role = 'E'").groupBy("entity").agg(F.sum("n").alias("with_entity"))
    n_docs = int(total.head()[0] or 0)
    terms = common.cut(seen.where("role = 'T'").groupBy("term").agg(F.sum("n").alias("with_term")), "term_counts")
    needed = F.element_at(F.array(*[F.lit(x) for x in _needed(entity, terms, alpha)]), _level("contexts") + 1)
    share = lambda c: F.least(F.col(c) / F.lit(float(max(1, n_docs))), F.lit(1.0))
    # evidence first: the most that b contexts can give, as the entity and the term are in
    # b documents at least; few pairs have enough, so the joins below are small
    pairs = (seen.where("role = 'C'").groupBy("entity", "term", "context").agg(F.sum("n").alias("n"))
             .groupBy("entity", "term").agg(F.sum("n").alias("both"), F.count("*").alias("contexts"))
             .where(-F.col("contexts") * F.log2(share("contexts")) >= needed))
    information = -F.log2(share("with_entity"))
    pmi = F.log2(share("both") / (share("with_entity") * share("with_term")))
    hit, p = F.least(F.col("contexts") / F.col("with_entity"), F.lit(1.0)), share("with_term")
    miss = F.when(hit < 1, (1 - hit) * F.log2((1 - hit) / (1 - p))).otherwise(0.0)
    bits = F.when(hit > p, F.col("with_entity") * (hit * F.log2(hit / p) + miss)).otherwise(0.0)
    return (pairs.join(entity, "entity").join(terms, "term")
            .withColumn("disclosure", F.when(information > 0, pmi / information))
            .where((F.col("disclosure") >= threshold) & (bits >= needed))
            .groupBy("term").agg(F.max("disclosure").alias("disclosure")))


#: Size of the filter that tells which words may be disclosing terms: fixed, so
#: what is broadcast does not grow with the data; a join decides exactly.
FILTER_BITS = 1 << 20


def _filter(terms: DataFrame) -> bytes:
    """One bit for each hash of a disclosing term."""
    slot = F.pmod(F.crc32(F.col("term").cast("binary")), F.lit(FILTER_BITS))
    bits = bytearray(FILTER_BITS // 8)
    for r in terms.select(slot.alias("slot")).distinct().collect():
        bits[r.slot >> 3] |= 1 << (r.slot & 7)
    return bytes(bits)


def find(docs: DataFrame, keep: list[str] | None = None, threshold: float = 0.9,
         alpha: float = 0.05, words: int = 5, text_col: str = "text") -> DataFrame:
    """Spans of personal data in every whole text.

    Returns a row for each input row: ``row`` (struct of the columns ``keep``),
    n_email, n_ip, n_card, n_phone, base_sha256, base (spans of the patterns)
    and terms (spans of disclosing terms outside them), both arrays of
    struct<start, kind, end> sorted by start, in code points, end exclusive.
    A null text counts as empty; repeated rows each give a row.
    """
    spark = docs.sparkSession
    common.ship(spark)
    flagged = common.cut(disclosing_terms(docs, threshold, alpha, words, text_col), "disclosing")
    bits = spark.sparkContext.broadcast(_filter(flagged))
    rows = docs.select(F.struct(*[F.col(c) for c in keep or docs.columns]).alias("row"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    span = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())])
    maybe = pa.struct([("term", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches):
        key = TaskContext.get().partitionId() << 40
        held = bits.value
        any_term = any(held)
        for b in common.row_slices(batches):
            found = []
            for text in b.column("text").to_pylist():
                spans = base_spans(text)
                terms = []
                if any_term:
                    for m in WORD.finditer(text):
                        t = term_of(m.group())
                        h = zlib.crc32(t.encode()) % FILTER_BITS
                        if t and held[h >> 3] >> (h & 7) & 1:
                            a = m.start() + m.group().index(m.group().strip(EDGE))
                            z = a + len(m.group().strip(EDGE))
                            if not any(a < s[2] and s[0] < z for s in spans):
                                terms.append({"term": t, "start": a, "end": z})
                n = Counter(s[1] for s in spans)
                found.append((key, *[n[k] for k in range(4)], hashlib.sha256(listed(spans).encode()).hexdigest(),
                              [{"start": a, "kind": k, "end": z} for a, k, z in spans], terms))
                key += 1
            cols = [*zip(*found)]
            kinds = [pa.int64()] * 5 + [pa.string(), pa.list_(span), pa.list_(maybe)]
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), *[pa.array(c, type=t) for c, t in zip(cols, kinds)]],
                names=["row", "key", *[f"n_{k}" for k in KINDS], "base_sha256", "base", "maybe"])

    counts = ", ".join(f"n_{k} long" for k in KINDS)
    ddl = (f"row {rows.schema['row'].dataType.simpleString()}, key long, {counts}, base_sha256 string, "
           "base array<struct<start:long,kind:int,end:long>>, "
           "maybe array<struct<term:string,start:long,end:long>>")
    scanned = common.cut(rows.mapInArrow(run, ddl), "spans")
    marked = (scanned.where(F.size("maybe") > 0).select("key", F.explode("maybe").alias("m"))
              .select("key", "m.*").join(flagged, "term")
              .groupBy("key").agg(F.sort_array(F.collect_list(
                  F.struct("start", F.lit(len(KINDS)).alias("kind"), "end"))).alias("terms")))
    none = F.lit(None).cast("array<struct<start:bigint,kind:int,end:bigint>>")
    out = (scanned.where(F.size("maybe") == 0).drop("maybe").withColumn("terms", none)
           .unionByName(scanned.where(F.size("maybe") > 0).drop("maybe").join(marked, "key", "left")))
    return out.withColumn("terms", F.coalesce("terms", F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>"))).drop("key")


def listed_column(spans: Column) -> Column:
    """kind:start:end of an array of spans, joined by commas."""
    names = F.array(*[F.lit(k) for k in (*KINDS, TERM)])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def pii_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans (all spans,
    as kind:start:end), n_term for every row of ``docs``."""
    found = find(docs, [id_col], text_col=text_col, **options)
    spans = F.sort_array(F.concat("base", "terms"))
    return found.select(F.col("row")[id_col].cast("long").alias("doc_id"), *[f"n_{k}" for k in KINDS],
                        "base_sha256", listed_column(spans).alias("spans"),
                        F.size("terms").cast("long").alias("n_term"))


def mask(text: str, spans: list[tuple[int, int, int]]) -> str:
    """``text`` with spans replaced; of overlapping spans the union is replaced
    by what stands for the first."""
    out, at, last = [], 0, -1
    for a, k, z in spans:
        if a < last:
            last = max(last, z)
            at = max(at, z)
            continue
        word = text[a:z]
        if k < len(KINDS):
            new = MASKS[KINDS[k]]
        elif any(c.isdigit() for c in word):
            new = "[NUMBER]"
        else:
            new = "[NAME]" if word[:1].isupper() else ""
        out += [text[at:a], new]
        at = last = z
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """``docs`` with personal data replaced in ``text_col``; rows and columns
    stay as they are otherwise, a null text stays null."""
    found = find(docs, text_col=text_col, **options)
    rows = found.select(F.col("row"), F.sort_array(F.concat("base", "terms")).alias("spans"))

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                b = whole.slice(at, 512)
                row = b.column("row")
                old = row.field(text_col).to_pylist()
                new = [t if t is None or not s else mask(t, [(x["start"], x["kind"], x["end"]) for x in s])
                       for t, s in zip(old, b.column("spans").to_pylist())]
                k = row.type.get_field_index(text_col)
                fields = [row.type.field(i) for i in range(row.type.num_fields)]
                parts = [pa.array(new, type=f.type) if i == k else row.field(i) for i, f in enumerate(fields)]
                yield pa.RecordBatch.from_arrays([pa.StructArray.from_arrays(parts, fields=fields)], names=["row"])

    masked = rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}")
    return masked.select(*[F.col("row")[c].alias(c) for c in docs.columns])
