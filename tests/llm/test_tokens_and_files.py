"""Tokenizing, coded files, packing and sampled segmentations."""

import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from paymart.llm import lattice, packing, rans, tokens
from paymart.sources.storage import new_table_path

ODD = [
    None, "", " ", "a", "a  b", "a\n b\nc", "x \n y", "foo\tbar", "<|endoftext|> hi", "It's we're DON'T o'clock's 's .'s 12's", "Ünïcödé çà. İstanbul İ, ΣΑΣ",
    "1234 5a6 a1!", "é ́x", "中文 字", "a\n", "\na", "a ", "!!!", "x×y ÷ ɐ ɏ", "a\n\nb", "z" * 23 + " " + "y" * 24 + " " + "é" * 20, "a\x00b", "end\x1c x",
    "— “q” ¿qué?", "x y　z", "tab\t", "a<b|c <|", "\r\nx", "word " * 30_000, "same text", "same text",
]


def fuzz(n=3000):
    r = random.Random(1)
    return ["".join(r.choice("ab cdE.,'!1\n éßÄ<|-\t") for _ in range(r.randint(0, 40))) for _ in range(n)]


@pytest.mark.parametrize("name", [rans.TOKENIZER, packing.TOKENIZER])
def test_pieces_give_the_ids_of_whole_texts(name):
    path = tokens.tokenizer_path(name)
    library = Tokenizer.from_file(path)
    texts = ODD + fuzz()
    found = list(tokens.Encoder(path).encode(pa.array(texts)))
    assert [x.tolist() for x in found] == [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert list(tokens.Encoder(path).encode(pa.array([], pa.string()))) == []
    assert [len(x) for x in tokens.Encoder(path).encode(pa.array([None, ""]))] == [0, 0]


def test_a_full_memo_starts_anew(monkeypatch):
    monkeypatch.setattr(tokens, "FULL", 200)
    monkeypatch.setattr(tokens, "LONG_FULL", 2)
    monkeypatch.setattr(tokens, "GROUP_BYTES", 500)
    e = tokens.Encoder(tokens.tokenizer_path(packing.TOKENIZER))
    texts = fuzz(400) + ["q" * 30 + " " + "r" * 40 + " " + "s" * 50]
    assert all(x.tolist() == e.whole(t).tolist() for t, x in zip(texts, e.encode(pa.array(texts))))


# ---- coded files -----------------------------------------------------------------

@pytest.mark.parametrize("n", [1, 5, 1023, 1024, 1025, rans.LANES * rans.EVERY, rans.LANES * rans.EVERY + 1, 700_000])
def test_blocks_come_back_from_any_checkpoint(n):
    ids = np.minimum(np.random.default_rng(n).geometric(0.01, n) - 1, 49_000).astype(np.uint16)
    table = rans.Table(rans.scaled(np.bincount(ids, minlength=49_408)))
    states, places, words = table.encode(ids)
    for first in range(len(states)):
        assert (table.decode(n, states, places, words, first) == ids[first * rans.EVERY * rans.LANES :]).all()


def test_frequencies_fill_the_range():
    r = np.random.default_rng(0)
    for counts in (np.array([1]), np.array([0, 5, 0, 1]), r.integers(0, 3, 49_000), np.concatenate((np.ones(49_000, np.int64), [10**12]))):
        freq = rans.scaled(counts)
        assert int(freq.sum()) == 1 << rans.SCALE and ((freq > 0) == (counts > 0)).all()
    assert rans.scaled(np.zeros(0, np.int64)).sum() == 0


def test_files_hold_every_document_in_order(spark, documents):
    ids = [None, 9, 3, *range(10, 10 + len(ODD) - 4), 3]
    path = new_table_path(spark, "ids-test")
    rans.write_ids(documents(ODD, ids), path)
    library = Tokenizer.from_file(tokens.tokenizer_path(rans.TOKENIZER))
    want = defaultdict(list)
    for i, t in zip(ids, ODD):
        want[i].append(np.array([*library.encode(t or "", add_special_tokens=False).ids, rans.END_ID], "<u4").tobytes())
    rows = sorted(rans.read_ids(spark, path).collect(), key=lambda r: r.start)
    at, got = 0, defaultdict(list)
    for r in rows:
        assert r.start == at and r.n_tokens == len(r.ids) // 4
        at += r.n_tokens
        got[r.doc_id].append(bytes(r.ids))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    order = [r.doc_id for r in rows]
    assert order == sorted(order, key=lambda d: (d is not None, d or 0))
    crcs = {(r.start, r.ids_crc32) for r in rans.read_ids(spark, path, digest=True).collect()}
    assert crcs == {(r.start, zlib.crc32(r.ids)) for r in rows}


def test_rows_of_one_id_are_cut_over_shards(spark, documents):
    path = new_table_path(spark, "ids-test")
    rans.write_ids(documents([f"text {k}" for k in range(300)] + ["same"] * 300, [None] * 600).repartition(4), path)
    shards = spark.read.parquet(f"{path}/blocks").groupBy("shard").agg(F.sum(F.size("doc_ids")).alias("n")).collect()
    assert len(shards) > 4 and max(r.n for r in shards) < 300
    rows = sorted(rans.read_ids(spark, path).collect(), key=lambda r: r.start)
    assert len(rows) == 600 and all(a.start + a.n_tokens == b.start for a, b in itertools.pairwise(rows))


def test_empty_table_and_damaged_block(spark, documents):
    path = new_table_path(spark, "ids-test")
    rans.write_ids(documents(["x"]).limit(0), path)
    assert rans.read_ids(spark, path).count() == 0
    path = new_table_path(spark, "ids-test")
    rans.write_ids(documents(["some words to store"]), path)
    blocks = spark.read.parquet(f"{path}/blocks")
    bad = new_table_path(spark, "ids-test")
    spark.read.parquet(f"{path}/table").write.parquet(f"{bad}/table")
    blocks.selectExpr(*[c if c != "crc32" else "crc32 + 1 AS crc32" for c in blocks.columns]).write.parquet(f"{bad}/blocks")
    with pytest.raises(Exception, match="checksum"):
        rans.read_ids(spark, bad).collect()


# ---- packing ---------------------------------------------------------------------

def check_packing(rows, texts, ids):
    library = Tokenizer.from_file(tokens.tokenizer_path(packing.TOKENIZER))
    want = Counter()
    for d, t in zip(ids, texts):
        want[d, tuple([*library.encode(t or "", add_special_tokens=False).ids, packing.END_ID])] += 1
    assert sum(r.length for r in rows) == sum(len(k[1]) * n for k, n in want.items())
    single = {k[0]: k[1] for k, n in want.items() if n == 1 and sum(x[0] == k[0] for x in want) == 1}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for d, have in single.items():
        at = 0
        for r in sorted(by_doc[d], key=lambda r: r.start):
            part = np.array(have[r.start : r.start + r.length], "<u4")
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(have), zlib.crc32(part.tobytes()))
            at += r.length
        assert at == len(have)
    padding = 0
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048 and len({(r.context, r.step_group) for r in parts}) == 1
        padding += 0 if at & (at - 1) == 0 else 2048 - at
        assert parts[0].context == (at if at in packing.TIERS else 2048)
    return padding, by_sequence


def test_packing_covers_every_id_once(spark, documents):
    r = random.Random(5)
    texts = ODD + [" ".join(r.choice(["alpha", "beta", "gamma,", "delta."]) for _ in range(r.randint(1, 3000))) for _ in range(150)]
    ids = [None, 1, 1, *range(2, len(texts) - 1)]
    rows = packing.pack(documents(texts, ids)).collect()
    padding, sequences = check_packing(rows, texts, ids)
    assert padding <= 2048  # one sequence that is not full
    steps = defaultdict(set)
    for s, parts in sequences.items():
        steps[parts[0].step_group].add(s)
    assert all(len(s) * next(iter(sequences[x][0].context for x in s)) <= packing.STEP for s in steps.values())
    assert packing.pack(documents(["x"]).limit(0)).count() == 0


def test_routes_cover_and_end_in_windows():
    for n in itertools.chain(range(1, 5000), (100_000,)):
        at = 0
        for start, length, tier in packing.route(n):
            assert start == at and 0 < length <= tier and tier in packing.TIERS
            assert length == tier or tier - length < packing.GAP or tier == packing.TIERS[-1]
            at += length
        assert at == n


def test_sequences_without_crumbs_still_fit():
    for lengths, tiers in (([1000] * 7, [1024] * 7), ([2000, 500, 450], [2048, 512, 512]), ([10], [256]), ([], [])):
        made = packing.sequences(np.array(lengths, np.int64), np.array(tiers, np.int64))
        whole = Counter()
        for i, _, n in itertools.chain(*made):  # windows may be cut to fill others
            whole[i] += n
        assert sorted(whole.items()) == sorted(enumerate(lengths))
        assert all(sum(p[2] for p in s) <= 2048 for s in made)


def test_windows_are_cut_where_crumbs_lack():
    r = random.Random(3)
    for lengths, tiers in (
        ([1000] * 4000, [1024] * 4000), ([2000] * 50, [2048] * 50), ([400, 2000, 1000], [512, 2048, 1024]), ([1930] * 5 + [20], [2048] * 5 + [256]),
        *(zip(*[(t - r.randint(1, 127), t) for t in r.choices((512, 1024, 2048), k=n)], strict=True) for n in (1, 2, 7, 300)),
    ):
        made = packing.sequences(np.array(lengths, np.int64), np.array(tiers, np.int64))
        assert sum(sum(p[2] for p in s) not in packing.TIERS for s in made) <= 1
        spans = defaultdict(list)
        for i, at, n in itertools.chain(*made):
            spans[i].append((at, n))
        for i, length in enumerate(lengths):
            at = 0
            for start, n in sorted(spans[i]):
                assert start == at and n > 0
                at += n
            assert at == length


def test_packing_does_not_depend_on_splits(spark, documents, monkeypatch):
    texts = ["alpha beta " * k for k in range(1, 90)] + ["same text"] * 300 + [None, ""] * 20
    ids = [*range(89), *[7] * 150, *[None] * 150, *[3] * 40]
    monkeypatch.setattr(packing, "GROUP", 100)
    one, two = (
        Counter(map(tuple, packing.pack(documents(t, i).repartition(n)).collect()))
        for t, i, n in ((texts, ids, 2), (texts[::-1], ids[::-1], 7))
    )
    assert one == two


# ---- sampled segmentations ----------------------------------------------------------

@pytest.fixture(scope="module")
def lattices():
    return lattice.Lattices(lattice.vocabulary_of(tokens.tokenizer_path(lattice.MODEL)))


def every_segmentation(v, text):
    """ids -> log chance, by trying every cut of the whole text."""
    text = "▁" + text.replace(" ", "▁")
    out = {}

    def walk(i, ids, log_p):
        if i == len(text):
            out[tuple(ids)] = log_p
            return
        node, single = 0, False
        for j in range(i, len(text)):
            node = int(v.step(np.array([node]), np.array([ord(text[j])]))[0])
            if node < 0:
                break
            if v.piece[node] >= 0:
                single |= j == i
                walk(j + 1, [*ids, int(v.piece[node])], log_p + v.score[node])
        if not single:
            walk(i + 1, ids + v.bytes_of(text[i]), log_p + len(text[i].encode()) * v.byte_score)

    walk(0, [], 0.0)
    total = np.logaddexp.reduce(list(out.values()))
    return {k: v - total for k, v in out.items()}


@pytest.mark.parametrize("text", ["thé ab", "a, b.c", "x\ny!", "🤗 a"])
def test_samples_follow_the_law_without_replacement(lattices, text):
    want = every_segmentation(lattices.vocabulary, text)
    chance = {k: np.exp(x) for k, x in want.items()}
    n, k = 6000, min(3, len(want))
    first, second, estimate = Counter(), Counter(), Counter()
    for samples in lattice.sample_texts([text] * n, [lattice.seed_of(i) for i in range(n)], lattices, 3):
        keys = [tuple(lattice.expand(p, lattices.vocabulary).tolist()) for p, *_ in samples]
        assert len(set(keys)) == len(keys) == k
        assert [x[2] for x in samples] == sorted((x[2] for x in samples), reverse=True)
        first[keys[0]] += 1
        if k > 1:
            second[keys[1]] += 1
        for key, (_, log_p, _, inclusion) in zip(keys, samples):
            assert abs(want[key] - log_p) < 1e-6
            estimate[key] += chance[key] / inclusion
    for key, p in sorted(chance.items(), key=lambda x: -x[1])[:4]:
        assert abs(first[key] / n - p) < 0.02
        assert abs(estimate[key] / n - p) < 0.02 * max(p, 0.05)  # inclusion scores make the sum unbiased
        if k > 1:
            assert abs(second[key] / n - sum(q * p / (1 - q) for o, q in chance.items() if o != key and q < 1)) < 0.02


def test_texts_come_back_and_rows_seed_themselves(spark, documents):
    ids = [i for i in range(len(ODD))]
    ids[3] = None
    docs = documents(ODD, ids)
    sampled = lattice.sample_segmentations(docs)
    rows = lattice.decode_ids(sampled).collect()
    texts = dict(zip(ids, ODD))
    by_doc = defaultdict(list)
    for r in rows:
        assert r.decoded == (texts[r.doc_id] or "") and r.n_pieces == len(r.ids) // 4 and 0 <= r.inclusion <= 1
        by_doc[r.doc_id].append(bytes(r.ids))
    assert all(len(set(x)) == len(x) <= lattice.SAMPLES for x in by_doc.values())
    assert by_doc[1] == [b""] and set(by_doc) == set(ids)
    again = lattice.sample_segmentations(docs.repartition(5))
    said = lambda df: sorted(((str(r.doc_id), r.sample, bytes(r.ids)), round(r.log_p, 6), round(r.perturbed, 6), round(r.inclusion, 6)) for r in df.collect())
    assert said(again) == said(sampled)
    assert lattice.sample_segmentations(docs.limit(0)).count() == 0
