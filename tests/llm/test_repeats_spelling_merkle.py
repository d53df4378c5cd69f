"""Substring dedup, spelling variants and the Merkle manifest against brute force on small tables."""

import hashlib
import random
import re
import zlib
from collections import Counter

import pytest

from paymart.llm import merkle, repeats, spelling

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- substring dedup ---------------------------------------------------------


def cut(texts, window=35):
    words = [_WORD.findall(t or "") for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = {i + k for i in range(len(w) - window + 1) if seen[tuple(w[i : i + window])] > 1 for k in range(window)}
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def _texts(rng):
    vocabulary = [f"w{k}" for k in range(60)] + ["é", "日本", "x" * 200, "thue" * 300]
    words = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passage, common = words(60), words(34)
    texts = [" ".join(words(40) + passage[a:b] + words(30)) for a, b in ((0, 60), (0, 60), (5, 41), (10, 45), (25, 60), (20, 54))]
    texts += [" ".join(common), " ".join(common), " ".join(words(5) + common + words(5))]  # 34 words do not reach a window
    texts += ["a " * 100, "b " * 35, "b " * 36, "c " * 35, "d \t\n" * 70 + "end", " ".join(words(3000))]
    texts += [texts[0], texts[0], None, "", " \n\t ", "one", "\n".join(passage), " ".join(passage) + "\x0b" + " ".join(passage)]
    return texts


def test_repeats_are_removed_as_by_brute_force(documents):
    texts = _texts(random.Random(3))
    ids = [None, None, *range(2, len(texts))]
    ids[15] = ids[0]  # a repeated row, its id null
    got = repeats.remove_repeats(documents(texts, ids)).collect()
    assert sorted((r["n_words"], sum(s["end"] - s["start"] for s in r["spans"]), r["kept"]) for r in got) == sorted(cut(texts))
    assert {r["doc_id"] for r in got} == set(ids)
    digest = repeats.digests(repeats.remove_repeats(documents(texts, ids))).collect()
    assert sorted((r["n_words"], r["n_removed"], r["kept_sha256"]) for r in digest) == sorted((n, k, _sha(t)) for n, k, t in cut(texts))


@pytest.mark.parametrize(("window", "levels"), [(7, 1), (12, 2), (35, 3)])
def test_other_windows(documents, window, levels):
    rng = random.Random(window)
    texts = [" ".join(rng.choice("ab") if k % 9 else f"u{rng.randrange(6)}" for k in range(rng.randrange(120))) for _ in range(25)]
    got = repeats.remove_repeats(documents(texts), window, levels).collect()
    assert sorted((r["doc_id"], r["n_words"], r["kept"]) for r in got) == [(i, n, kept) for i, (n, _, kept) in enumerate(cut(texts, window))]


def test_nothing_repeats_and_empty_table(documents):
    texts = [" ".join(f"{k}-{i}" for i in range(50)) for k in range(4)]
    assert {r["kept"] for r in repeats.remove_repeats(documents(texts)).collect()} == set(texts)
    assert repeats.remove_repeats(documents([])).collect() == []


def test_levels():
    assert repeats.lengths() == [9, 18, 35]
    with pytest.raises(ValueError, match="62 bits"):
        repeats.lengths(500, 2)


# ---- spelling variants -------------------------------------------------------


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def grouped(counts):
    nears = {a: [b for b in counts if near(a, b)] for a in counts}
    form = {}
    for a, found in nears.items():
        best = min(found, key=lambda b: (-counts[b], b), default=None)
        form[a] = best if best is not None and counts[best] >= 5 * counts[a] else None
    out = set()
    for a in counts:
        root = a
        while form[root]:
            root = form[root]
        out.add((a, form[a], root, counts[a], len(nears[a]), counts.get(form[a])))
    return out


def _words(rng):
    base = ["".join(rng.choice("abé") for _ in range(rng.randrange(6, 9))) for _ in range(150)]
    base += ["aaaaaa", "aaaaaaa", "aaaaaaaa", "abcdef" * 2000, "abcdef" * 2000 + "x", "日本語日本語", "日本語日本話"]
    return {w: rng.choice([5, 5, 30, 200, 1500]) for w in base}


@pytest.mark.parametrize(("tile", "cells"), [(spelling.TILE, spelling.CELLS), (3, 1 << 20), (512, 64)])
def test_variants_as_by_brute_force(spark, tile, cells):
    counts = _words(random.Random(5))
    words = spark.createDataFrame([(*c, 0, "x") for c in counts.items()], "word string, n long, grp int, side string")
    assert {tuple(r) for r in spelling.variants(words, tile=tile, cells=cells).collect()} == grouped(counts)


def test_corpus_words(documents):
    rng = random.Random(9)
    vocabulary = ["Wörterbuch", "straße", "LETTERS", "letters", "Übergang", "short", "naïveté", "x×÷y×÷z"]
    texts = [" ".join(rng.choice(vocabulary) + rng.choice(["", ",", "9", "日"]) for _ in range(rng.randrange(60))) for _ in range(120)]
    texts += [None, "", texts[0]]
    ids = [*range(120), 7, 8, None]
    counts = Counter()
    for i, text in zip(ids, texts, strict=True):
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(_LOWER)
            h = zlib.crc32(f"{i}:{run}".encode())
            if i is not None and h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 6:
                counts[run] += 1
    got = {r["word"]: r["n"] for r in spelling.corpus_words(documents(texts, ids)).collect()}
    assert got == {w: n for w, n in counts.items() if n >= 5}


def test_no_words(spark, documents):
    assert spelling.variants(spelling.corpus_words(documents([]))).collect() == []
    rows = spark.createDataFrame([(None, 9), ("lonely", 7)], "word string, n long")
    assert [tuple(r) for r in spelling.variants(rows).collect()] == [("lonely", None, "lonely", 7, 0, None)]


# ---- Merkle manifest ---------------------------------------------------------


def _leaf(row, lower=False):
    out = ""
    for c in merkle.FIELDS:
        v = row[c]
        if v is not None:
            v = str(v).translate(_LOWER) if lower and c == "text" else str(v)
        out += "-" if v is None else f"{len(v.encode())}:{v}"
    return _sha(out)


def _tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([_sha("".join(levels[-1][i : i + 16])) for i in range(0, len(levels[-1]), 16)])
    return levels


def _path(levels, i):
    out = []
    for nodes in levels[:-1]:
        low = i // 16 * 16
        out.append(("".join(nodes[low:i]), "".join(nodes[i + 1 : low + 16])))
        i //= 16
    return out


def manifest(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for found in groups.values():
        found.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, _leaf(r)))
    trees = {s: _tree([_leaf(r) for r in groups[s]]) for s in order}
    top = _tree([trees[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for i, r in enumerate(groups[s]):
            path = _path(trees[s], i) + _path(top, k)
            node = _leaf(r, r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
            for a, b in path:
                node = _sha(a + node + b)
            out.append((r["doc_id"], trees[s][0][i], trees[s][-1][0], top[-1][0], _sha("".join(a + b for a, b in path)), node, node == top[-1][0]))
    return sorted(out, key=str)


def _rows(spark, rows):
    return spark.createDataFrame(
        [(*r, 0, "g") for r in rows], "doc_id long, source string, lang string, n_chars long, text string, pos int, grp string"
    )


@pytest.mark.parametrize("sizes", [[1], [16], [17], [300, 1, 0, 33], [2] * 18])
def test_manifest_as_by_hand(spark, sizes):
    rng = random.Random(sum(sizes))
    rows = [(rng.randrange(1000), f"s{k}é", "en", 3, rng.choice(["Text", "text", "ÄB", "z" * 5000])) for k, n in enumerate(sizes) for _ in range(n)]
    df = _rows(spark, rows)
    assert sorted((tuple(r) for r in merkle.digests(df).collect()), key=str) == manifest(df.collect())


def test_manifest_of_nulls_and_repeated_rows(spark):
    rows = [(None, None, None, None, None)] * 40 + [(5, "", "en", 0, "")] * 20 + [(None, "", "en", 1, "A"), (5, None, "", 7, "b"), (7, "x", "en", None, "C")]
    df = _rows(spark, rows)
    assert sorted((tuple(r) for r in merkle.digests(df).collect()), key=str) == manifest(df.collect())
    assert merkle.digests(df.limit(0)).collect() == []


def test_path_folds_to_the_root(spark):
    df = _rows(spark, [(i, f"s{i % 2}", "en", 1, f"t{i}") for i in range(50)])
    found = merkle.manifest(df).withColumn("again", merkle.fold(merkle.F.col("leaf"), merkle.F.col("path")))
    assert found.where("again <> root").count() == 0
    assert {len(r["path"]) for r in found.collect()} == {3}
