import hashlib
import random
import tracemalloc
import zlib
from types import SimpleNamespace

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from paylake.llm import bpe_codec, common, packing, pieces, token_counts

from .conftest import EDGES

ALPHABET = ["'", " ", "  ", "\n", "\t", "s", "re", "ll", "a", "é", "1", "٣", "!", "''", "漢", " ", "d", "ve",
            "<|endoftext|>", "\x1c", "\x85", "😀", "Ⅷ", "=", "--------", "aaa", "\r\n", " the", "ing"]


def fuzz(seed, n=4000):
    rng = random.Random(seed)
    out = ["".join(rng.choices(ALPHABET, k=rng.randint(0, 30))) for _ in range(n)]
    out += ["".join(chr(rng.choice([rng.randint(1, 0xD7FF), rng.randint(0xE000, 0x1FFFF)])) for _ in range(12))
            for _ in range(n // 4)]
    return out + [t for t in EDGES if t]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(P.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def ranks():
    return bpe_codec.read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def reference(ranks):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_transducer_equals_library(library):
    with open(P.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        counter = token_counts.machine(f.read())
    texts = fuzz(1)
    want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert counter.values(texts) == want


def test_bounded_tables_give_the_same_counts(library):
    import json

    with open(P.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        j = json.load(f)["model"]
    small = token_counts.CountingTransducer(j["vocab"], j["merges"], states=50)
    memo = pieces.WordMemo(small.counts, sum, {"<|endoftext|>": 1}, size=10)
    texts = fuzz(2, 500)
    assert memo.values(texts) == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_long_texts_are_cut_without_effect(library):
    text = " ".join(fuzz(3, 300)) * 3
    parts = [p for _, ps in pieces.document_pieces([text], "<|endoftext|>", limit=500) for p in ps]
    assert parts == [p for _, ps in pieces.document_pieces([text], "<|endoftext|>") for p in ps]
    assert "".join(parts) == text


def test_ids_equal_library_with_a_bounded_memory(library):
    rng = random.Random(11)
    blanks = [*pieces.OTHER_BLANKS, " ", "\n", "  ", "\n ", "a", "é", "1", ",", "'s", "漢", "<|endoftext|>"]
    texts = fuzz(12, 1000) + ["".join(rng.choices(blanks, k=12)) for _ in range(2000)] + ["", "x" * 3000, "é,\x85 a"]
    want = [np.array(e.ids, "<u4").tobytes() for e in library.encode_batch(texts, add_special_tokens=False)]
    special = {"<|endoftext|>": library.token_to_id("<|endoftext|>")}
    for remembered, size in ((50, 300), (1000, 5000), (600_000, 1 << 23)):
        memo = pieces.TokenIds(Tokenizer.from_file(P.path("byte_bpe_50k.json")), special, remembered)
        for _ in range(2):
            assert memo.values(texts, size) == want
        assert len(memo.chunks) <= remembered and max(map(len, memo.chunks.to_pylist())) <= pieces.LONGEST
    assert memo.values([]) == []


def test_a_word_is_encoded_once_whatever_marks_follow_it(library):
    memo = pieces.TokenIds(Tokenizer.from_file(P.path("byte_bpe_50k.json")))
    seen, encode = [], memo._encode
    memo._encode = lambda new: seen.extend(new) or encode(new)
    memo.values(["it is a wordlike, thing of marks", "it 'is' a wordlike. \"thing\" (of) marks!"])
    memo.values(["a wordlike: thing"])
    assert seen.count(" wordlike") == 1 and " wordlike," not in memo.chunks.to_pylist()
    assert len(seen) == len(set(seen))


def test_remembered_words_take_little_memory():
    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    rng = random.Random(13)
    text = " ".join("".join(rng.choices("abcdefghij", k=10)) for _ in range(60_000))
    tracemalloc.start()
    try:
        memo = pieces.TokenIds(tokenizer)
        memo.values([text])
        held = tracemalloc.get_traced_memory()[0] + memo.chunks.nbytes + memo.ids.nbytes
    finally:
        tracemalloc.stop()
    assert held < 6 << 20


def test_slices_give_unused_memory_back(monkeypatch):
    batches = [pa.record_batch({"text": ["a" * 10, "b"] * 5}) for _ in range(3)]
    released = []
    monkeypatch.setattr(common.pa, "default_memory_pool",
                        lambda: SimpleNamespace(release_unused=lambda: released.append(1)))
    out = [r for b in common.row_slices(iter(batches), limit=12) for r in b.column("text").to_pylist()]
    assert out == ["a" * 10, "b"] * 15 and len(released) == 3


def test_codec_equals_reference_and_round_trips(ranks, reference):
    codec = bpe_codec.Codec(bpe_codec.tokenizer_json(ranks))
    texts = fuzz(4)
    for t, ids in zip(texts, codec.encode(texts)):
        assert ids.tolist() == reference.encode_ordinary(t)
        assert codec.decode(ids.tolist()) == t.encode()
        assert "".join(codec.decode_parts(ids.tolist())) == t


def test_offsets_cover_the_text(ranks):
    codec = bpe_codec.Codec(bpe_codec.tokenizer_json(ranks))
    for t in ("né 漢字😀'll go", "plain words", "😀😀"):
        ids = codec.encode([t])[0]
        spans = codec.offsets(t, ids)
        whole = {k for a, z in spans for k in range(a, z)}
        assert whole == set(range(len(t)))
        for (a, z), i in zip(spans, ids.tolist()):
            assert codec.bytes[i] in t[a:z].encode()


def test_codec_queries(spark, edge_docs, no_docs, clash, reference):
    path = P.path("byte_bpe_multi_50k.tiktoken")
    sha = lambda b: hashlib.sha256(b).hexdigest()
    rows = clash.add(edge_docs).select("doc_id", "text").collect()
    want = sorted((str(r.doc_id), len(i := reference.encode_ordinary(r.text or "")),
                   sha(np.array(i, "<u4").tobytes()), sha((r.text or "").encode())) for r in rows)
    got = bpe_codec.codec_digests(clash.add(edge_docs), path).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == want
    both = bpe_codec.decode(bpe_codec.encode(edge_docs, path, offsets=True), path)
    assert sorted(r.text for r in both.collect()) == sorted(r.text or "" for r in rows)
    assert bpe_codec.codec_digests(no_docs, path).count() == 0


def test_count_queries(edge_docs, no_docs, clash, library):
    path = P.path("byte_bpe_50k.json")
    rows = edge_docs.collect()
    want = sorted((str(r.doc_id), len((r.text or "").encode()), n := len(library.encode(r.text or "").ids), n > 512)
                  for r in rows)
    got = token_counts.token_counts(clash.add(edge_docs), path).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in got) == want
    assert token_counts.token_counts(no_docs, path).count() == 0


def check_packing(rows, texts, library, capacity=2048):
    docs = {}
    for r in rows:
        docs.setdefault(r.doc_id, []).append(r)
    for d, t in texts.items():
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        at = 0
        for k, r in enumerate(sorted(docs[d], key=lambda r: r.piece)):
            part = np.array(ids[at:at + r.length], "<u4").tobytes()
            assert (r.piece, r.start, r.ids_crc32) == (k, at, zlib.crc32(part))
            assert r.length == capacity or k == 0
            at += r.length
        assert at == len(ids)
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins), -(-sum(r.length for r in rows) // capacity)


def test_packing_given_documents(read, library):
    docs = read("documents")
    rows = packing.pack_documents(docs, P.path("byte_bpe_50k.json"), island=64).collect()
    bins, bound = check_packing(rows, {r.doc_id: r.text for r in docs.collect()}, library)
    assert bins <= 1.05 * bound + 2


def test_packing_edges(edge_docs, no_docs, clash, library):
    once = edge_docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    rows = packing.pack_documents(clash.add(once), P.path("byte_bpe_50k.json")).collect()
    check_packing(rows, {r.doc_id: r.text for r in once.collect()}, library)
    assert packing.pack_documents(edge_docs, P.path("byte_bpe_50k.json")).count() >= edge_docs.count()
    assert packing.pack_documents(no_docs, P.path("byte_bpe_50k.json")).count() == 0


def test_genetic_operators_keep_every_piece():
    rng = random.Random(9)
    size = [rng.choice([1000, 700, 400, 333, 90, 1500]) + rng.randint(-50, 50) for _ in range(300)]
    best = packing.evolve(size, 2048, 1)
    assert sorted(i for b in best.bins for i in b) == list(range(300))
    assert all(sum(size[i] for i in b) == load <= 2048 for b, load in zip(best.bins, best.loads))
    first, loads = [], []
    packing.best_fit(first, loads, sorted(range(300), key=lambda i: -size[i]), size, 2048)
    assert len(best.bins) <= len(first)
