"""Near-duplicates against brute force on full sets."""

import itertools
import random
import re

import numpy as np
from pyspark.sql import functions as F

from paymart.llm import minhash
from paymart.llm.components import connected_components

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text):
    w = _WORD.findall((text or "").translate(_LOWER))
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """doc index -> (set size, smallest id reached)."""
    sets = [shingles(t) for _, t in rows]
    top = list(range(len(rows)))

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            top[root(a)] = root(b)
    best = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            best[root(i)] = min(best.get(root(i), d), d)
    return [(len(s), best.get(root(i))) for i, s in enumerate(sets)]


def corpus(seed=3, words=90):
    r = random.Random(seed)
    vocabulary = ["w%d" % k for k in range(4000)]
    base = [[r.choice(vocabulary) for _ in range(words)] for _ in range(12)]
    texts = []
    for b in base:
        for _ in range(r.randint(1, 9)):  # near copies around the threshold, exact copies, case and spacing variants
            w = list(b)
            for _ in range(r.choice([0, 0, 1, 2, 3, 4])):
                w[r.randrange(len(w))] = r.choice(vocabulary)
            texts.append(r.choice([" ", "\n", "\t "]).join(w).replace("w1", r.choice(["w1", "W1"])))
    passage = " ".join(vocabulary[:40])
    texts += [passage + " " + " ".join(r.choice(vocabulary) for _ in range(60)) for _ in range(30)]
    texts += [None, "", " \t\n", "one two", "One  two", "one two three four", "a", "a", "long " * 30_000]
    return texts


def result(df):
    return [tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect()]


def test_components_equal_brute_force(documents):
    texts = corpus()
    rows = list(enumerate(texts))
    got = {d: (n, c) for d, n, c, _ in result(minhash.near_duplicates(documents(texts)))}
    assert got == dict(enumerate(brute(rows)))


def test_kept_is_the_smallest_id_and_null_ids_are_reached(documents):
    text = " ".join(f"x{k}" for k in range(30))
    found = result(minhash.near_duplicates(documents([text, text, text, None, "solo words here", ""], [7, 5, None, 9, None, None])))
    assert sorted(found, key=str) == sorted(
        [(7, 26, 5, False), (5, 26, 5, True), (None, 26, 5, False), (9, 0, 9, True), (None, 1, None, True), (None, 0, None, True)], key=str
    )


def test_empty_table(documents):
    assert result(minhash.near_duplicates(documents(["a"]).limit(0))) == []


def test_blocks_cut_a_large_bucket_and_lose_no_link(documents, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 4)
    texts = corpus(seed=8)
    got = {d: (n, c) for d, n, c, _ in result(minhash.near_duplicates(documents(texts)))}
    assert got == dict(enumerate(brute(list(enumerate(texts)))))


def test_estimate_is_corrected_for_chance():
    r = np.random.default_rng(1)
    for share in (0.0, 0.5, 0.75, 0.9):
        found = []
        for _ in range(40):
            both = r.integers(1 << 63, size=int(300 * share), dtype=np.uint64)
            a, b = (np.concatenate((both, r.integers(1 << 63, size=(300 - len(both)) // 2, dtype=np.uint64))) for _ in range(2))
            true = len(both) / len(np.union1d(a, b))
            x, y = (np.frombuffer(minhash.pack(minhash.minima(s)), np.uint64) for s in (a, b))
            found.append(float(minhash.estimate(x, y)) - true)
        assert abs(np.mean(found)) < 0.012 and np.std(found) < 0.04


def test_keep_one_keeps_columns_and_one_row_a_group(documents):
    text = " ".join(f"y{k}" for k in range(40))
    docs = documents([text, text, text + " tail", "other words entirely", None, text], [4, 4, 2, 3, 8, None])
    kept = minhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 8]


def test_keep_one_judges_rows_of_one_id_apart(documents):
    one, two, three = (" ".join(f"{c}{k}" for k in range(40)) for c in "abc")
    rows = [
        (5, one), (5, two), (5, "  "), (5, None), (5, two),  # unrelated and blank texts under an id, and a true copy
        (2, one + " tail"),  # a near copy of smaller id
        (7, three), (7, ""), (None, two), (None, "no id, own words"), (None, "no id, other text"), (None, "no id, own words"),
    ]
    kept = minhash.keep_one(documents([t for _, t in rows], [d for d, _ in rows]))
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
        [(5, two), (5, "  "), (5, None), (2, one + " tail"), (7, three), (7, ""), (None, "no id, own words"), (None, "no id, other text")], key=str
    )


def test_components_of_long_chains_stars_and_loops(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(1000, k) for k in range(1001, 1100)]
    links = spark.createDataFrame(chain + star + [(5, 5), (7, 6), (6, 7), (7, 6)], "a long, b long").union(spark.createDataFrame([(None, 9)], "a long, b long"))
    got = {r.node: r.label for r in connected_components(links).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 1000 for i in range(1000, 1100)}, 6: 6, 7: 6}
    assert connected_components(links.where(F.lit(False))).count() == 0


def test_words_that_cancel_out_in_polynomials_differ(documents):
    """Thue-Morse words of 1,024 bytes have one polynomial value modulo 2**64, whatever the base."""
    bits = [bin(k).count("1") % 2 for k in range(1024)]
    a, b = "".join("ab"[x] for x in bits), "".join("ba"[x] for x in bits)
    got = minhash.near_duplicates(documents([f"{a} one two three four", f"{b} one two three four"])).collect()
    assert {r["component_id"] for r in got} == {0, 1}


def test_many_rows_without_an_id(documents):
    texts = [f"word{i} " * 3 + " ".join(f"x{i}y{k}" for k in range(30)) for i in range(40)]
    rows = [t for t in texts for _ in range(2)]
    got = minhash.near_duplicates(documents(rows, [None] * len(rows))).collect()
    assert len(got) == 80 and {r["component_id"] for r in got} == {None}


def test_keep_one_leaves_columns_of_any_name(spark):
    text = " ".join(f"w{k}" for k in range(40))
    names = "doc_id long, text string, _row long, _hash long, line long, text_hash long, _of long, stays long"
    rows = [(1, text, 900, 1, 2, 3, 4, 5), (2, text, 901, 1, 2, 3, 4, 5), (3, "another text " * 9, 902, 1, 2, 3, 4, 5)]
    out = minhash.keep_one(spark.createDataFrame(rows, names))
    assert sorted(map(tuple, out.collect())) == [rows[0], rows[2]]
