import random
import re

import numpy as np

from paylake.llm import minmax_dedup as M


def word_sets(text, width):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")) if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1)))


def brute(rows, width):
    sets = {i: word_sets(t, width) for i, t in rows}
    parent = {i: i for i in sets}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for a, i in enumerate(ids):
        for j in ids[a + 1:]:
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                x, y = sorted((top(i), top(j)))
                parent[y] = x
    return {i: (len(sets[i]), top(i)) for i in ids}


def check(spark, rows, width):
    got = M.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=width).collect()
    want = brute(rows, width)
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_shingles, r.component_id) == want[r.doc_id] and r.kept == (r.doc_id == r.component_id)


def copies(seed):
    """Groups of exact and near copies with edits around the threshold, chains,
    and texts that share a passage."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefghij", k=5))
    rows, n = [], 0
    passage = [word() for _ in range(40)]
    for _ in range(12):
        base = [word() for _ in range(rng.choice([3, 4, 20, 90, 150]))]
        for _ in range(rng.randint(1, 12)):
            t = list(base)
            for _ in range(rng.randint(0, 4)):
                t[rng.randrange(len(t))] = word()
            rows.append((n, (" " if n % 2 else "\n").join(t).upper() if n % 3 == 0 else " ".join(t)))
            n += 1
    for _ in range(30):
        rows.append((n, " ".join(passage + [word() for _ in range(rng.randint(2, 60))])))
        n += 1
    rng.shuffle(rows)
    return rows


def test_equals_brute_force(spark):
    check(spark, copies(1), 4)


def test_equals_brute_force_five_words(spark):
    check(spark, copies(2), 5)


def test_given_documents(spark, read):
    rows = [(r.doc_id, r.text) for r in read("documents").collect()]
    check(spark, rows, 4)


def test_min_and_max_are_unbiased():
    rng = np.random.default_rng(3)
    shared, only = rng.integers(0, 1 << 62, 800, dtype=np.uint64), rng.integers(0, 1 << 62, 400, dtype=np.uint64)
    a, b = np.concatenate([shared, only[:200]]), np.concatenate([shared, only[200:]])
    agree = (M.signature(a) == M.signature(b)).mean()
    assert abs(agree - 800 / 1200) < 0.1


def test_long_chain(spark):
    """A path of texts each like the next only."""
    words = [f"w{k}" for k in range(400)]
    rows = [(k, " ".join(words[5 * k:5 * k + 100])) for k in range(50)]
    check(spark, rows, 4)


def test_edges(edge_docs, no_docs, clash):
    out = M.near_duplicates(clash.add(edge_docs)).collect()
    assert len(out) == edge_docs.count()
    by = {r.doc_id: r for r in out if r.doc_id is not None}
    assert by[10].component_id == 9 and not by[10].kept and by[0].n_shingles == 0 and by[0].kept
    assert all(r.component_id is None and r.kept for r in out if r.doc_id is None)
    assert M.near_duplicates(no_docs).count() == 0
