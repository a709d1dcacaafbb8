import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from paylake.llm import periodic_runs as R
from paylake.llm.queries import op11_periodic_runs


def brute_runs(w, min_length=6, k=4):
    """Every maximal stretch of each period that has no smaller one."""
    out, n = [], len(w)
    for q in range(1, n // k + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            z = i
            while z + q < n and w[z] == w[z + q]:
                z += 1
            length = z - i + q
            if length >= max(min_length, k * q):
                part = w[i:i + length]
                if not any(part[d:] == part[:-d] for d in range(1, q)):
                    out.append((i, length, q))
            i = z
    return sorted(out)


def brute_collapsed(w, runs):
    return [x for i, x in enumerate(w) if not any(s + p <= i < s + n for s, n, p in runs)]


periodic = st.builds(lambda parts: [x for unit, times, tail in parts for x in unit * times + unit[:tail]],
                     st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=5), st.integers(1, 7),
                                        st.integers(0, 4)), max_size=6))


@settings(max_examples=1500, deadline=None)
@given(st.one_of(periodic, st.lists(st.integers(0, 1), max_size=60), st.lists(st.integers(0, 3), max_size=80)))
def test_runs_equal_brute_force(words):
    want = brute_runs(words)
    assert R.runs_of(words) == want          # the automaton over the whole text
    assert R.runs_of_text(words) == want     # and over the stretches only
    assert R.collapsed(words, want) == brute_collapsed(words, want)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=50), st.integers(1, 9), st.integers(2, 5))
def test_other_limits(words, least, k):
    assert R.runs_of_text(words, least, k) == R.runs_of(words, least, k) == brute_runs(words, least, k)


def test_automaton_access_finds_last_occurrences():
    rng = random.Random(1)
    words = [rng.randrange(3) for _ in range(120)]
    link, length, prefix = R.automaton(words)
    tree = R._Tree(link, length)
    for i, state in enumerate(prefix):
        got = {e: n for n, e in tree.access(state, i)}
        for e in range(i):
            n = 0
            while n <= e and words[e - n] == words[i - n]:
                n += 1
            suffix = words[i - n + 1:i + 1]
            later = any(words[j - n + 1:j + 1] == suffix for j in range(e + 1, i))
            assert got.get(e) == (n if n and not later else None) or (e in got and not n)


def test_long_texts():
    unit = [f"w{k}" for k in range(700)]
    words = unit * 9 + ["x"] * 5000 + list(range(20000))
    assert R.runs_of_text(words) == [(0, 6300, 700), (6300, 5000, 1)]
    rng = np.random.default_rng(2)
    words = rng.integers(0, 40, 60_000).tolist() + [7] * 40
    got = R.runs_of_text(words)
    assert got[-1][0] + got[-1][1] == 60_040 and got[-1][2] == 1


def digests(doc, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if doc is not None and words:
        h = zlib.crc32(str(doc).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    s, n, p = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc, len(runs), s, n, p, 1000 * n // p if runs else None,
            sha("".join(f"{a},{b},{c}\n" for a, b, c in runs)), sha(" ".join(brute_collapsed(words, runs))))


def same(df, docs):
    got = sorted((tuple(r) for r in df.collect()), key=str)
    return got == sorted((digests(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()), key=str)


def test_query_equals_brute_force(spark, small, read):
    docs = read("documents").where("length(text) < 4000")
    assert same(R.digests(R.periodic_runs(R.planted(docs))), docs)
    assert op11_periodic_runs(spark, small).count() == read("documents").count()


def test_edges(spark, edge_docs, no_docs, clash):
    odd = spark.createDataFrame([(i, f"a\x0bb\x0cc\x1cd e a\x0bb\x0cc\x1cd e x{i} " * (i % 7)) for i in range(60)],
                                "doc_id long, text string")
    rows = edge_docs.select("doc_id", "text").unionByName(odd).where("coalesce(length(text), 0) < 4000")
    assert same(R.digests(R.periodic_runs(R.planted(clash.add(rows)))), rows)
    long = edge_docs.where("length(text) >= 4000")
    assert {(r.start, r.length, r.period) for r in R.digests(R.periodic_runs(long)).collect()} == {
        (0, 30_000, 1), (None, None, None)}
    assert R.periodic_runs(no_docs).count() == 0 and R.digests(R.planted(no_docs).limit(0).selectExpr(
        "doc_id", "cast(null as array<struct<start:long,length:long,period:long>>) runs", "text collapsed")).count() == 0
    with pytest.raises(ValueError):
        R.periodic_runs(no_docs, min_exponent=1)
