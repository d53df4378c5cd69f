"""Chat formatting, vector links, pseudonyms and shards."""

import datetime
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from paymart.llm import caps, chat, pii, shards

# ---- chat ---------------------------------------------------------------------------

TALK = [
    (1, 1, "assistant", "fine <|im_end|>\n<\\|x <\\\\|"), (1, 0, "user", "how <|im_start|>are\nyou"), (2, 0, "system", None), (2, 1, "user", ""),
    (2, 2, "assistant", "é🤗" * 20_000), (2, 3, None, "x"), (None, 0, "user", "no id"), (3, 0, "user", "same"), (3, 0, "user", "same"), (3, None, "assistant", "first"),
    (4, 0, "us\ner\\n", "role with a line"),
]


def formatted(spark, rows):
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return chat.format_turns(turns.withColumn("parts", chat.text_parts(F.col("text"))).withColumn("segment", F.lit("clash")))


def test_conversations_come_back(spark):
    got = {r.conv_id: r for r in chat.read_back(formatted(spark, TALK)).collect()}
    assert set(got) == {1, 2, 3, 4, None}
    for conv, r in got.items():
        rows = sorted((t for t in TALK if t[0] == conv), key=lambda t: (t[1] is not None, t[1] or 0, t[2] or ""))
        said = "".join(f"{role or ''}\n{text or ''}\n" for _, _, role, text in rows)
        loss = "".join(text or "" for _, _, role, text in rows if role == "assistant")
        assert (r.n_turns, r.turns_sha256) == (len(rows), hashlib.sha256(said.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    segments = formatted(spark, TALK).collect()
    assert sum(len(s.segment) for s in segments if s.conv_id == 1) == got[1].formatted_chars
    assert all(len(re.findall(r"<\|", s.segment)) == 2 for s in segments)  # no control string inside a text
    assert chat.read_back(formatted(spark, TALK).limit(0)).count() == 0


def test_a_foreign_segment_is_refused(spark):
    with pytest.raises(Exception, match="did not write"):
        chat.read_back(formatted(spark, TALK[:1]).withColumn("segment", F.lit("<|im_start|>user\nno end"))).collect()


def test_parts_are_flattened_in_order(spark):
    parts = [
        ("text", "see <|", None, None, None, None, None), ("image", None, "s3://a.png", 100, 57, None, None), None, ("text", None, None, None, None, None, None),
        ("audio", None, "b.wav", None, None, 2.5, None), ("document", None, "c.pdf", None, None, None, 3), ("note", "n", None, None, None, None, None),
    ]
    row = chat.format_turns(spark.createDataFrame([(1, 0, "assistant", parts), (1, 1, "user", None)], f"conv_id long, turn long, role string, parts {chat.PARTS}")).orderBy("turn").collect()
    assert row[0].segment == "<|im_start|>assistant\nsee <\\|<|image|><|audio|><|document|>n<|im_end|>\n"
    assert [(a.kind, a.ref, a.tokens) for a in row[0].attachments] == [("image", "s3://a.png", 4 * 3), ("audio", "b.wav", 63), ("document", "c.pdf", 1536)]
    assert [row[0].segment[a.at :].startswith(f"<|{a.kind}|>") for a in row[0].attachments] == [True] * 3
    assert row[0].expanded_tokens == 12 + 63 + 1536 and row[1].expanded_tokens == 0
    assert row[0].segment[row[0].loss_start : row[0].loss_end] == "see <\\|<|image|><|audio|><|document|>n" and row[1].loss_start is None


# ---- vectors -----------------------------------------------------------------------

def vectors(seed=1, dim=24):
    r = np.random.default_rng(seed)
    out = [None, [], [0.0] * dim, [float("nan")] + [1.0] * (dim - 1), [float("inf")] * dim, [1.0, None] + [0.0] * (dim - 2)]
    for _ in range(12):
        base = r.normal(size=dim)
        out += [(base + r.normal(size=dim) * s).tolist() for s in (0, 0, 0.1, 0.2, 0.25, 0.3, 0.35)]
    out += [(np.array(out[8]) * k).tolist() for k in (1e-200, 1e200, -1)]
    out += [[1.0, 2.0, 3.0], [1.0, 2.0, 3.001], [5.0], [7.0]]
    return out


def brute_links(rows):
    good = [i for i, v in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    unit = {i: np.array(rows[i]) / np.abs(rows[i]).max() for i in good}
    unit = {i: u / np.linalg.norm(u) for i, u in unit.items()}
    near = {i: [j for j in good if j != i and len(rows[i]) == len(rows[j]) and unit[i] @ unit[j] >= caps.COSINE] for i in good}
    label = {i: i for i in range(len(rows))}
    while True:
        lower = {i: min([label[i], *(label[j] for j in near.get(i, []))]) for i in label}
        if lower == label:
            return [(len(near.get(i, [])), label[i]) for i in range(len(rows))]
        label = lower


def links(df):
    return {r.vec_id: (r.n_links, r.component_id) for r in df.collect()}


@pytest.mark.parametrize("block", [1024, 3])
def test_links_and_components_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(caps, "BLOCK", block)
    rows = vectors()
    table = spark.createDataFrame([(i, v, 0, "x") for i, v in enumerate(rows)], "vec_id long, embedding array<double>, label int, node string")
    assert links(caps.near_vectors(table, words=64)) == dict(enumerate(brute_links(rows)))
    assert caps.near_vectors(table.limit(0)).count() == 0


def test_repeated_and_nameless_vectors(spark):
    v = [1.0] * 8
    got = caps.near_vectors(spark.createDataFrame([(3, v), (3, v), (None, v), (5, v), (None, None)], "vec_id long, embedding array<float>"), words=16).collect()
    assert Counter(map(tuple, got)) == Counter([(3, 3, 3, True), (3, 3, 3, True), (None, 3, 3, False), (5, 3, 3, False), (None, 0, None, True)])


def test_recall_at_the_threshold():
    r = np.random.default_rng(3)
    x = r.normal(size=(2000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = r.normal(size=x.shape)
    z -= (z * x).sum(axis=1, keepdims=True) * x
    y = 0.95 * x + np.sqrt(1 - 0.95**2) * z / np.linalg.norm(z, axis=1, keepdims=True)
    shared = [len(np.intersect1d(a, b)) for a, b in zip(caps.filters_of(x), caps.filters_of(y))]
    assert np.mean(np.array(shared) > 0) > 0.995


# ---- pseudonyms ----------------------------------------------------------------------

def test_feistel_is_a_permutation_and_comes_back():
    for size in (1, 2, 7, 1000, 4097):
        f = pii.Feistel(b"key", "x", size)
        assert sorted(map(f, range(size))) == list(range(size)) and all(f.back(f(i)) == i for i in range(0, size, 7))
    f, g = pii.Feistel(b"key", "card", 10**15), pii.Feistel(b"other", "card", 10**15)
    assert f.back(f(123456789012345)) == 123456789012345 and f(1) != g(1)


def luhn(digits):
    return sum(sum(divmod(int(d) * (1 + k % 2), 10)) for k, d in enumerate(reversed(digits))) % 10 == 0


def test_values_keep_their_format_and_stay_linked(spark):
    card = "4539578763621486"
    assert luhn(card)
    spaced = " ".join(card[k : k + 4] for k in range(0, 16, 4))
    texts = [
        f"pay {card} now", f"again {spaced}, é", "bad 4539578763621487", "mail ann.b99@mail4.example.com!", "call +1 (017) 555-7713 or 152.143.123.131.", "on 2024-02-29, 31.12.1999 not 2023-02-29",
        "id 078-05-1120", "a@b", None, "", "1 " * 40_000, f"152.143.123.131 {card} +1 (017) 555-7713",
    ]
    got = {r.doc_id: r for r in pii.pseudonymize(spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, spans string")).collect()}
    new = re.findall(r"\d{16}", got[0].text)[0]
    assert new != card and luhn(new) and got[1].text == "again " + " ".join(new[k : k + 4] for k in range(0, 16, 4)) + ", é"
    assert got[2].text == texts[2] and got[7].text == texts[7] and got[8].text is None and got[9].text == "" and got[10].text == texts[10]
    assert re.fullmatch(r"mail [a-z]{3}\.[a-z]\d\d@mail4\.example\.com!", got[3].text) and "ann.b99" not in got[3].text
    assert re.fullmatch(r"call \+1 \(\d{3}\) \d{3}-\d{4} or \d+\.\d+\.\d+\.\d+\.", got[4].text) and "555-7713" not in got[4].text
    days = re.fullmatch(r"on (\S+), (\S+) not 2023-02-29", got[5].text)
    assert datetime.date.fromisoformat(days[1]) and datetime.datetime.strptime(days[2], "%d.%m.%Y")
    assert re.fullmatch(r"id \d{3}-\d{2}-\d{4}", got[6].text) and "078-05" not in got[6].text
    assert new in got[11].text and re.search(r"\+1 \(\d{3}\) \d{3}-\d{4}", got[4].text)[0] in got[11].text
    assert got[11].spans == "ip:0:15,card:16:32,phone:33:50" and (got[11].n_ip, got[11].n_card, got[11].n_phone) == (1, 1, 1)
    assert pii.pseudonymize(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_several_addresses_in_a_text():
    close = "write to ann@x.com or bob@y.com"
    new, spans = pii.pseudonyms(close)
    assert spans == [("email", 9, 18), ("email", 22, 31)]
    assert re.fullmatch(r"write to [a-z]{3}@x\.com or [a-z]{3}@y\.com", new) and "ann" not in new and "bob" not in new
    texts = [
        "ann@x.com @ bob@y.com", "@ @@ ann@x.com@ bob@y.com @", "ann@x.com,bob@y.com;ann@x.com", "ann@x.com " + "z" * 100 + " @home bob@y.com",
        "l" * 64 + "@x.com " + "l" * 65 + "@x.com", "a@b.com " * 5_000, "@" * 5_000,
    ]
    for text in texts:
        assert [s[1:] for s in pii.pseudonyms(text)[1]] == [m.span() for m in pii._EMAIL.finditer(text)]


def test_month_first_dates_and_phones_without_separators():
    new, spans = pii.pseudonyms("on 12/25/2020, 25/12/2020 and 2020-12-25, not 13/25/2020 or 02/30/2020")
    assert [s[0] for s in spans] == ["date"] * 3
    first, second, third = re.findall(r"[0-9/-]{10}", new)[:3]
    day = datetime.datetime.strptime(first, "%m/%d/%Y")
    assert day.day > 12 and day == datetime.datetime.strptime(second, "%d/%m/%Y") == datetime.datetime.fromisoformat(third) != datetime.datetime(2020, 12, 25)
    days = [datetime.date(2020, 1, 1) + datetime.timedelta(k) for k in range(366)]
    slashed = {d.strftime("%d/%m/%Y") for d in days} | {d.strftime("%m/%d/%Y") for d in days if d.day > 12}
    assert len({pii.pseudonyms(t)[0] for t in slashed}) == len(slashed)
    new, spans = pii.pseudonyms("call +15551234567 or +1 555 123 4567, +442079460958; 3+15551234567 +1234567")
    assert [s[0] for s in spans] == ["phone"] * 3
    one, two, three = re.fullmatch(r"call \+1(\d{10}) or \+1 (\d{3} \d{3} \d{4}), \+44(\d{10}); 3\+15551234567 \+1234567", new).groups()
    assert one == two.replace(" ", "") != "5551234567" and three != "2079460958"


def test_planted_values_are_found_and_nothing_else(spark):
    """Texts of plain words and planted values: the spans are known from the making, not from a pattern."""
    r, texts, want = random.Random(11), [], []

    def value():
        kind = r.choice(["email", "ip", "date", "phone", "card", "none"])
        if kind == "email":
            return kind, f"{''.join(r.choices('abcxyz', k=6))}@host{r.randint(1, 9)}.org"
        if kind == "ip":
            return kind, ".".join(str(r.randint(0, 255)) for _ in range(4))
        if kind == "date":
            return kind, (datetime.date(1990, 1, 1) + datetime.timedelta(r.randint(0, 9000))).isoformat()
        if kind == "phone":
            return kind, f"+1 ({r.randint(200, 999)}) {r.randint(200, 999)}-{r.randint(0, 9999):04}"
        if kind == "card":
            digits = "4" + "".join(r.choices("0123456789", k=14))
            return kind, next(digits + c for c in "0123456789" if luhn(digits + c))
        return kind, r.choice(["2023-02-30", "300.1.2.999", "a@b", "12:30", "4539578763621487", "v1.2", "#5"])

    for _ in range(300):
        text, spans = "start", []
        for _ in range(r.randint(0, 12)):
            kind, found = value()
            text += " " + r.choice(["word", "é🤗", "Zeile\nzwei"]) + " "
            if kind != "none":
                spans.append(f"{kind}:{len(text)}:{len(text) + len(found)}")
            text += found
        texts.append(text + r.choice(["", " end", "\n"]))
        want.append(",".join(spans))
    ids = [None if k % 3 == 0 else k % 50 for k in range(300)]  # null and repeated ids
    rows = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    assert Counter((r.doc_id, r.spans) for r in pii.pseudonymize(rows).collect()) == Counter(zip(ids, want))


# ---- shards ---------------------------------------------------------------------------

def test_matrix_has_exact_sums_and_the_right_means():
    parts, wanted = np.array([30, 0, 50, 20]), np.array([40, 35, 25])
    total = np.zeros((4, 3))
    for seed in range(400):
        m = shards.communication_matrix(parts, wanted, seed)
        assert (m.sum(axis=1) == parts).all() and (m.sum(axis=0) == wanted).all() and (m >= 0).all()
        total += m
    assert np.abs(total / 400 - np.outer(parts, wanted) / 100).max() < 0.6
    huge = shards.communication_matrix(np.array([3 * 10**9, 10**9]), np.array([2 * 10**9, 2 * 10**9]), 1)
    assert (huge.sum(axis=1) == [3 * 10**9, 10**9]).all() and (huge.sum(axis=0) == 2 * 10**9).all()


def test_counts_follow_the_hypergeometric_law_at_any_size():
    random = np.random.default_rng(5)
    few = [int(shards._draw(random, np.array([10**7, 2 * 10**9 - 10**7]), 100)[0]) for _ in range(4000)]
    for k in range(3):  # 100 draws at a share of 1 in 200
        assert abs(few.count(k) / 4000 - math.comb(100, k) * 0.005**k * 0.995 ** (100 - k)) < 0.035
    small = [int(shards._draw(random, np.array([7, 5]), 6)[0]) for _ in range(4000)]
    for k in range(1, 7):
        assert abs(small.count(k) / 4000 - math.comb(7, k) * math.comb(5, 6 - k) / math.comb(12, 6)) < 0.035
    large = np.array([shards._draw(random, np.array([10**12] * 2), 10**10)[0] for _ in range(300)], float)
    spread = np.sqrt(10**10 / 4 * (1 - 10**10 / (2 * 10**12)))
    assert abs(large.mean() - 5e9) < 5 * spread / np.sqrt(300) and 0.8 < large.std() / spread < 1.2


def test_every_row_lands_once_in_a_shard_of_exact_size(spark):
    rows = [(i if i % 5 else None, f"t{i % 7}", "clash") for i in range(1003)] + [(1, "same", "clash")] * 500
    table = spark.createDataFrame(rows, "doc_id long, text string, shard string")
    out = shards.uniform_shards(table, ["doc_id", "text"], shards=8, parts=16)
    found = out.collect()
    assert Counter((r.doc_id, r.text) for r in found) == Counter((a, b) for a, b, _ in rows)
    sizes = Counter(r.shard for r in found)
    assert set(sizes) == set(range(8)) and max(sizes.values()) - min(sizes.values()) <= 1
    for shard, n in sizes.items():
        assert sorted(r.slot for r in found if r.shard == shard) == list(range(n))
    hot = Counter(r.shard for r in found if r.text == "same")
    assert min(hot.values()) > 30  # equal rows spread over the shards
    assert shards.uniform_shards(table.limit(0), ["doc_id"], shards=8).count() == 0
    assert zlib.crc32(b"") == spark.range(1).select(F.crc32(F.lit("").cast("binary")).alias("c")).first().c


def chained(*values, seed=42):
    """The 64-bit hash of a chain of columns: each value's hash seeds the next one's; null leaves it."""
    for v in values:
        if v is not None:
            seed = xxhash.xxh64(v.encode() if isinstance(v, str) else v, seed=seed % 2**64).intdigest()
    return seed - 2**64 if seed >= 2**63 else seed


def long(v):
    return None if v is None else v.to_bytes(8, "little", signed=True)


def test_shards_as_by_hand(spark):
    """Both permutations and the matrix applied to a list of rows."""
    rows = [(i if i % 9 else None, f"t{i % 4}") for i in range(400)] + [(5, "same")] * 100
    n, parts, seed = 6, 8, 77
    seen, firsts = Counter(), []
    for i, text in rows:
        same = chained(long(i), text)
        firsts.append((chained(long(same), long(seen[same]), seed.to_bytes(4, "little")), i, text))
        seen[same] += 1

    def part(h):
        return min(((h >> 32) + 2**31) * parts // 2**32, parts - 1)

    by_part = [sorted((f for f in firsts if part(f[0]) == p), key=lambda f: f[0]) for p in range(parts)]
    wanted = np.array([len(rows) // n + (k < len(rows) % n) for k in range(n)])
    matrix = shards.communication_matrix(np.array([len(p) for p in by_part]), wanted, seed)
    dealt = [[] for _ in range(n)]
    for own, sent in zip(by_part, matrix.tolist(), strict=True):
        at = 0
        for k, count in enumerate(sent):
            dealt[k] += own[at : at + count]
            at += count
    want = Counter()
    for k, own in enumerate(dealt):
        own.sort(key=lambda f: chained(long(f[0]), (seed + 1).to_bytes(4, "little")))
        want.update((i, text, k, slot) for slot, (_, i, text) in enumerate(own))
    for split in (1, 5):
        table = spark.createDataFrame(rows, "doc_id long, text string").repartition(split)
        got = shards.uniform_shards(table, ["doc_id", "text"], shards=n, seed=seed, parts=parts)
        assert Counter(map(tuple, got.select("doc_id", "text", "shard", "slot").collect())) == want


def test_names_of_the_caller_are_free(spark):
    names = ["p", "ends", "_first", "_second", "_part", "_rank", "_at", "same", "copy", "row", "part", "rank", "start", "first", "second", "a.b"]
    rows = [tuple(f"{c}{i}" for c in names) for i in range(30)]
    out = shards.uniform_shards(spark.createDataFrame(rows, names), ["row", "a.b"], shards=4)
    assert out.columns == [*names, "shard", "slot"]
    assert sorted(tuple(r)[:-2] for r in out.collect()) == sorted(rows)
