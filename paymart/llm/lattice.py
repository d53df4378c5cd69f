"""Sampled segmentations without replacement by perturbed search (operator 9).

The lattice of a text has a node before each character and an edge for each
piece of the vocabulary that matches there (a character without a piece is an
edge of its UTF-8 byte pieces).  Piece scores are log probabilities: those of a
unigram model as they are, those of a BPE model, which are merge ranks, by
Zipf's law on the rank.  Backward sums give each node the log mass of all its
completions, so a partial path has an exact bound and the search is best first.

Gumbel noise on all complete segmentations would rank them like sampling
without replacement.  It is drawn top down instead: the best of a set passes
its value to the subset that holds it, and the rest of the set gets a Gumbel
value of its log mass truncated below it.  The search keeps sets "leaves this
path at some step" on its frontier, one a path, with their values.  The set of
highest value is opened next: the step is drawn by the mass that leaves there,
then another piece, and the path is completed; what is left of the set and what
leaves the new path go back with values below.  After ``k`` paths the highest
value left over is the threshold that inclusion scores refer to:
1 - exp(-exp(log_p - threshold)).

Pieces never cross a space or a line feed, so the lattice is a chain of
words, and equal words share their part (up to KEEP words a worker process,
then it starts anew).  Random numbers are
hashes of (row key, sample, word, step): but for the last digits of sums, results
do not depend on how rows are grouped or which task runs.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from paymart.llm.common import mix64, tidy
from paymart.llm.tokens import tokenizer_path

MODEL = "piece_bpe_32k.model"
SAMPLES = 3
SEED = 20240607
GROUP_CHARS = 1 << 20
KEEP = 600_000
ZIPF_SHIFT = 2.7
_UNIT = re.compile("▁[^▁\n]*|[^▁\n]+|\n")
_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
_LATIN = re.compile(f"[{_LETTERS}]")
_TOP = 1 << 21  # above any code point


class Vocabulary:
    """A trie of the pieces as sorted (node, character) keys, and the log probability of each piece."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        scores = np.array([self.model.get_score(i) for i in range(n)])
        plain = [i for i in range(n) if not (self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_byte(i) or self.model.is_unused(i)) and (scores[i] > -1e8 or len(self.model.id_to_piece(i)) == 1)]
        self.byte_ids = np.full(256, -1, np.int64)
        for i in range(n):
            if self.model.is_byte(i):
                self.byte_ids[int(self.model.id_to_piece(i)[1:-1], 16)] = i
        scores = np.where(scores > -1e8, scores, -float(n))  # a character kept out of merges is as rare as the last rank
        ranked = bool(plain) and all(float(s).is_integer() for s in scores[plain])
        weight = -np.log(-scores[plain] + ZIPF_SHIFT) if ranked else scores[plain]
        weight = weight - np.logaddexp.reduce(weight)
        self.byte_score = float(weight.min()) - 1.0
        tree: dict[int, int] = {}
        piece, score = [-1], [0.0]
        for i, w in zip(plain, weight.tolist(), strict=True):
            node = 0
            for c in self.model.id_to_piece(i):
                key = node * _TOP + ord(c)
                if key not in tree:
                    tree[key] = len(piece)
                    piece.append(-1)
                    score.append(0.0)
                node = tree[key]
            piece[node], score[node] = i, w
        self.keys = np.array(sorted(tree), np.int64)
        self.next = np.array([tree[k] for k in self.keys.tolist()], np.int64)
        self.piece, self.score = np.array(piece, np.int64), np.array(score)
        apart = {chr(c) for c in range(0x21, 0x7F) if not chr(c).isalpha()}
        for i in plain:
            text = self.model.id_to_piece(i)
            for a, b in zip(text, text[1:], strict=False):
                apart -= {a} if _LATIN.match(b) else {b} if _LATIN.match(a) else set()
        marks = re.escape("".join(sorted(apart)))
        self.simple = re.compile(f"[{_LETTERS}{marks} \n]*") if apart else None
        self.parts = re.compile(f"▁?[{_LETTERS}]+|▁?[{marks}]+|▁|\n") if apart else None
        self.first = np.full(1 << 16, -1, np.int64)  # children of the root
        for k in self.keys[self.keys < 1 << 16].tolist():
            self.first[k] = tree[k]

    def units(self, text: str) -> list[str]:
        """The parts of a text that no piece crosses: words, cut again between letters and marks where no piece joins the two."""
        if not text:
            return []
        parts = self.parts if self.simple is not None and self.simple.fullmatch(text) else _UNIT
        return parts.findall("▁" + text.replace(" ", "▁"))

    def step(self, node: np.ndarray, char: np.ndarray) -> np.ndarray:
        key = node * _TOP + char
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.next[at], -1)

    def bytes_of(self, char: str) -> list[int]:
        return [int(self.byte_ids[b]) for b in char.encode()]


class Lattices:
    """The lattices of words, kept for later texts: edges by node, longest first, with their pieces and chances.

    ``upto`` is the chance of an edge and those before it at its node.
    """

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.nodes = self.edges = 0
        self.base, self.end = np.empty(0, np.int64), np.empty(0, np.int64)  # of each word
        self.at = np.zeros(1, np.int32)  # of each node
        self.size, self.piece = np.empty(0, np.uint8), np.empty(0, np.int32)  # of each edge
        self.log_p = np.empty(0)
        self.log_rest, self.upto = np.empty(0, np.float32), np.empty(0, np.float32)

    def indices(self, cut: list[list[str]]) -> list[list[int]]:
        """Numbers of the words of some texts; unknown words are added."""
        here = set().union(*cut)
        new = here.difference(self.known)
        if new and len(self.known) + len(new) > KEEP:
            self.clear()
            new = here
        if new:
            words = list(new)
            first = len(self.known)
            self._add(words)
            self.known.update(zip(words, range(first, first + len(words)), strict=True))
        get = self.known.__getitem__
        return [list(map(get, one)) for one in cut]

    def _add(self, words: list[str]) -> None:
        vocabulary = self.vocabulary
        lengths = np.array([len(w) for w in words], np.int64)
        chars = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        starts = np.cumsum(lengths) - lengths
        word = np.repeat(np.arange(len(words)), lengths)
        node_of = np.arange(len(chars)) + word  # a word of n characters has n + 1 nodes
        left = (starts + lengths)[word] - np.arange(len(chars))  # characters to the end of the word
        nodes = len(chars) + len(words)

        pos = np.arange(len(chars))
        small = chars < 1 << 16
        state = np.where(small, vocabulary.first[np.where(small, chars, 0)], -1)
        if not small.all():
            state[~small] = vocabulary.step(np.zeros(int((~small).sum()), np.int64), chars[~small])
        found = []
        single = np.zeros(len(chars), bool)
        size = 1
        alive = state >= 0
        pos, state = pos[alive], state[alive]
        while len(pos):
            hit = vocabulary.piece[state] >= 0
            if size == 1:
                single[pos[hit]] = True
            found.append((pos[hit], size, vocabulary.piece[state[hit]], vocabulary.score[state[hit]]))
            more = left[pos] > size
            pos, state = pos[more], state[more]
            state = vocabulary.step(state, chars[pos + size])
            alive = state >= 0
            pos, state = pos[alive], state[alive]
            size += 1
        bare = np.flatnonzero(~single)
        code = chars[bare]
        wide = 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)
        ids = np.where(code < 0x80, vocabulary.byte_ids[np.minimum(code, 127)], -1 - code)  # several bytes: minus the character
        found.append((bare, 1, ids, wide * vocabulary.byte_score))

        counts = np.zeros(nodes, np.int64)
        for at, *_ in found:
            counts[node_of[at]] += 1
        ends = np.cumsum(counts)
        edges = int(ends[-1])
        sizes, pieces, score = np.empty(edges, np.uint8), np.empty(edges, np.int32), np.empty(edges)
        cursor = ends.copy()
        for at, long, piece, value in found:
            cursor[node_of[at]] -= 1
            slot = cursor[node_of[at]]
            sizes[slot], pieces[slot], score[slot] = long, piece, value
        begin = ends - counts

        mass = np.zeros(nodes)
        src = np.repeat(np.arange(nodes), counts)
        far = int(left.max())
        order = np.argsort(left.astype(np.int16) if far < 32767 else left, kind="stable")
        bounds = np.searchsorted(left[order], np.arange(1, far + 2))
        value = np.empty(edges)
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):  # nodes by distance to the end of their word
            own = node_of[order[a:b]]
            n = counts[own]
            first = np.cumsum(n) - n
            e = np.arange(int(n.sum())) + np.repeat(begin[own] - first, n)
            v = score[e] + mass[src[e] + sizes[e]]
            value[e] = v
            top = np.maximum.reduceat(v, first)
            mass[own] = top + np.log(np.add.reduceat(np.exp(v - np.repeat(top, n)), first))
        log_p = value - mass[src]
        chance = np.exp(log_p)
        with np.errstate(divide="ignore"):
            log_rest = np.where(counts[src] > 1, np.log1p(-np.minimum(chance, 1.0)), -np.inf)

        base = self.nodes + starts + np.arange(len(words))
        join = lambda old, new: np.concatenate((old, new.astype(old.dtype)))
        self.base, self.end = join(self.base, base), join(self.end, base + lengths)
        self.at = join(self.at, self.edges + ends)
        self.size, self.piece = join(self.size, sizes), join(self.piece, pieces)
        self.log_p, self.log_rest = join(self.log_p, log_p), join(self.log_rest, log_rest)
        run = np.concatenate(([0.0], np.cumsum(chance)))
        self.upto = join(self.upto, run[1:] - run[begin][src])
        self.nodes += nodes
        self.edges += edges

    def draw(self, node: np.ndarray, u: np.ndarray) -> np.ndarray:
        """An edge of each node, by its chance.  Long pieces come first and are the likeliest, so few looks are needed."""
        e, last = self.at[node].astype(np.int64), self.at[node + 1].astype(np.int64) - 1
        on = np.flatnonzero((self.upto[e] <= u) & (e < last))
        while len(on):
            now = e[on] + 1
            e[on] = now
            on = on[(self.upto[now] <= u[on]) & (now < last[on])]
        return e


_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _row_seed(seed: np.ndarray, place: np.ndarray | int) -> np.ndarray:
    return mix64(np.atleast_1d(np.asarray(place, np.uint64)) * _GOLDEN ^ np.asarray(seed, np.uint64))


def _uniform(row_seed: np.ndarray, sample: int, step: int) -> np.ndarray:
    """Numbers in (0, 1) from (row seed and place, sample, step)."""
    fixed = hashlib.blake2b(f"{SEED}:{sample}:{step}".encode(), digest_size=8).digest()
    h = mix64(row_seed + np.frombuffer(fixed, np.uint64))
    return (np.right_shift(h, np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)


def _gumbel(row_seed: np.ndarray, sample: int, step: int) -> np.ndarray:
    return -np.log(-np.log(_uniform(row_seed, sample, step)))


#: Values of ``step`` of draws that are not steps of a word: what leaves a new path, the root, where and how to leave
#: a path, what is then left of its set.
_FRONT, _ROOT, _STEP, _LEAVE, _REST = -1, -2, -3, -4, -5


def _walk(lat: Lattices, node: np.ndarray, end: np.ndarray, row_seed: np.ndarray, sample: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Draws each word from its node to its end: (word row, node, edge) of all steps in the order of the text."""
    node = node.copy()
    live = np.flatnonzero(node < end)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    steps = np.zeros(len(node), np.int64)
    while len(live):
        at = node[live]
        e = lat.draw(at, _uniform(row_seed[live], sample, len(out)))
        out.append((live, at, e))
        steps[live] += 1
        at = at + lat.size[e]
        node[live] = at
        live = live[at < end[live]]
    first = np.cumsum(steps) - steps
    total = int(steps.sum())
    nodes, edges = np.empty(total, np.int64), np.empty(total, np.int64)
    for k, (row, at, e) in enumerate(out):
        nodes[first[row] + k], edges[first[row] + k] = at, e
    return np.repeat(np.arange(len(node)), steps), nodes, edges


class _Wave:
    """One sample of every text that has one: the steps drawn for it, and the set that leaves its path.

    The steps of text ``i`` are rows ``at[i]`` to ``at[i + 1]``; they follow the first ``skip[i]`` steps
    of sample ``of[i]``, whose log chance is ``before[i]``.  ``weight`` is the mass, relative to that,
    that leaves the path at each step; ``value`` the perturbed value of all that leaves it.
    """

    def __init__(self, lat: Lattices, texts: int, docs: np.ndarray, doc: np.ndarray, place: np.ndarray, node: np.ndarray, edge: np.ndarray,
                 noise: np.ndarray, before: np.ndarray, top: np.ndarray, skip: np.ndarray, of: np.ndarray) -> None:
        self.place, self.node, self.edge, self.skip, self.of, self.top, self.before = place, node, edge, skip, of, top, before
        self.at = np.searchsorted(doc, np.arange(texts + 1))
        run = np.concatenate(([0.0], np.cumsum(lat.log_p[edge])))
        start = run[self.at[:-1]]
        self.log_p = run[self.at[1:]] - start + before
        self.path = run[:-1] - np.repeat(start, np.diff(self.at))  # log chance of the steps before each step
        self.weight = np.exp(self.path + lat.log_rest[edge])
        self.sums = np.concatenate(([0.0], np.cumsum(self.weight)))
        total = np.zeros(texts)
        some = np.flatnonzero(self.at[1:] > self.at[:-1])
        if len(some):
            total[some] = np.add.reduceat(self.weight, self.at[some])
        self.there = np.zeros(texts, bool)
        self.there[docs] = True
        self.value = np.where(self.there, _below(top, before, total, noise), -np.inf)
        self.taken: dict[int, set[int]] = {}

    def draw(self, i: int, u: float) -> int:
        """A step of text ``i``, by the mass that leaves its path there."""
        a, b = int(self.at[i]), int(self.at[i + 1])
        weight = self.weight[a:b]
        sums = self.sums[a : b + 1] if not self.taken else np.concatenate(([0.0], np.cumsum(weight)))
        r = int(np.searchsorted(sums, sums[0] + u * (sums[-1] - sums[0]), side="right")) - 1
        r = min(max(r, 0), b - a - 1)
        return a + (r if weight[r] > 0 else int(weight.argmax()))


def _below(top: np.ndarray, before: np.ndarray, mass: np.ndarray, noise: np.ndarray) -> np.ndarray:
    """The perturbed value of sets of a relative mass, truncated below ``top``; -inf for empty ones."""
    with np.errstate(divide="ignore"):
        return np.where(mass > 0, -np.logaddexp(-top, -(before + np.log(mass) + noise)), -np.inf)


def sample_texts(texts: list[str], seeds: list[int], lat: Lattices, k: int) -> list[list[tuple[np.ndarray, float, float, float]]]:
    """For each text at most ``k`` distinct segmentations, best first: (pieces of the edges, log_p, perturbed value, inclusion)."""
    count = len(texts)
    lists = lat.indices([lat.vocabulary.units(t) for t in texts])
    text_at = np.concatenate(([0], np.cumsum([len(x) for x in lists])))
    unit = np.fromiter(itertools.chain.from_iterable(lists), np.int64, int(text_at[-1]))
    doc = np.repeat(np.arange(count), np.diff(text_at))
    place = np.arange(len(unit)) - text_at[doc]
    seed = np.array(seeds, np.uint64)
    text_seed = _row_seed(seed, 0)
    base, end, row_seed = lat.base[unit], lat.end[unit], _row_seed(seed[doc], place)
    zero, none = np.zeros(count), np.zeros(count, np.int64)

    row, node, edge = _walk(lat, base, end, row_seed, 0)
    top = _gumbel(text_seed, 0, _ROOT)
    waves = [_Wave(lat, count, np.arange(count), doc[row], place[row], node, edge, _gumbel(text_seed, 0, _FRONT), zero, top, none, none)]
    for sample in range(1, k):
        values = np.stack([w.value for w in waves])
        of, top = values.argmax(axis=0), values.max(axis=0)
        docs = np.flatnonzero(top > -np.inf)
        if not len(docs):
            break
        step, leave, rest = _uniform(text_seed, sample, _STEP), _uniform(text_seed, sample, _LEAVE), _gumbel(text_seed, sample, _REST)
        before, skip = np.zeros(count), np.zeros(count, np.int64)
        first_place, first_node, first_edge = np.zeros(count, np.int64), np.zeros(count, np.int64), np.zeros(count, np.int64)
        left_mass = [np.zeros(count) for _ in waves]
        for i in docs.tolist():
            wave = waves[of[i]]
            r = wave.draw(i, float(step[i]))
            n, e = int(wave.node[r]), int(wave.edge[r])
            gone = wave.taken.setdefault(r, {e})
            free = [x for x in range(int(lat.at[n]), int(lat.at[n + 1])) if x not in gone]
            chances = np.exp(lat.log_p[free]).tolist()
            mark, pick = leave[i] * sum(chances), 0
            while pick < len(free) - 1 and mark >= chances[pick]:
                mark -= chances[pick]
                pick += 1
            gone.add(free[pick])
            wave.weight[r] = math.exp(wave.path[r]) * (sum(chances[:pick]) + sum(chances[pick + 1 :]))
            left_mass[of[i]][i] = wave.weight[wave.at[i] : wave.at[i + 1]].sum()
            before[i] = wave.before[i] + wave.path[r] + math.log(chances[pick])
            skip[i] = r - wave.at[i] + wave.skip[i]
            first_place[i], first_node[i], first_edge[i] = wave.place[r], n, free[pick]
        for s, wave in enumerate(waves):  # what is left of an opened set keeps a value below the one just used
            opened = docs[of[docs] == s]
            wave.value[opened] = _below(top[opened], wave.before[opened], left_mass[s][opened], rest[opened])
        begin = text_at[docs] + first_place[docs]
        n_rows = text_at[docs + 1] - begin
        rows = np.arange(int(n_rows.sum())) + np.repeat(begin - (np.cumsum(n_rows) - n_rows), n_rows)
        nodes = base[rows]
        nodes[np.cumsum(n_rows) - n_rows] = first_node[docs] + lat.size[first_edge[docs]]
        row, node, edge = _walk(lat, nodes, end[rows], row_seed[rows], sample)
        row = rows[row]
        wave = _Wave(lat, count, docs, doc[row], place[row], node, edge, _gumbel(text_seed, sample, _FRONT), before, top, skip + 1, of)
        wave.first_edge = first_edge
        waves.append(wave)

    threshold = np.stack([w.value for w in waves]).max(axis=0)
    out: list[list[tuple[np.ndarray, float, float, float]]] = []
    for i in range(count):
        paths: list[np.ndarray | None] = []
        rows_of = []
        for s, wave in enumerate(waves):
            if not wave.there[i]:
                paths.append(None)
                continue
            own = wave.edge[wave.at[i] : wave.at[i + 1]]
            path = own if s == 0 else np.concatenate((paths[wave.of[i]][: wave.skip[i] - 1], [wave.first_edge[i]], own))
            paths.append(path)
            log_p = float(wave.log_p[i])
            inclusion = 1.0 if threshold[i] == -np.inf else -math.expm1(-math.exp(min(700.0, log_p - threshold[i])))
            rows_of.append((lat.piece[path], log_p, float(wave.top[i]), inclusion))
        out.append(rows_of)
    return out


def expand(pieces: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """Edge pieces to ids: a character without a piece becomes its byte pieces."""
    if not len(pieces) or pieces.min() >= 0:
        return pieces
    return np.array([i for p in pieces.tolist() for i in ([p] if p >= 0 else vocabulary.bytes_of(chr(-1 - p)))], np.int64)


def seed_of(key: int | None) -> int:
    return int.from_bytes(hashlib.blake2b(b"null" if key is None else str(key).encode(), digest_size=8).digest(), "little")


@functools.lru_cache(4)
def vocabulary_of(path: str) -> Vocabulary:
    return Vocabulary(path)


@functools.lru_cache(4)
def lattices_of(path: str) -> Lattices:
    """One set of lattices a model and worker process."""
    return Lattices(vocabulary_of(path))


_SAMPLE = pa.schema(
    [("doc_id", pa.int64()), ("sample", pa.int32()), ("n_pieces", pa.int64()), ("log_p", pa.float64()), ("perturbed", pa.float64()), ("inclusion", pa.float64()), ("ids", pa.binary())]
)
_DIGEST = pa.schema([*list(_SAMPLE)[:-1], pa.field("ids_crc32", pa.int64())])


@tidy
def _sampled(batches: Iterator[pa.RecordBatch], path: str, k: int, digest: bool) -> Iterator[pa.RecordBatch]:
    lattices = lattices_of(path)
    schema = _DIGEST if digest else _SAMPLE

    def flush(keys: list, texts: list[str]) -> pa.RecordBatch:
        rows: list[list] = [[] for _ in schema]
        for key, samples in zip(keys, sample_texts(texts, [seed_of(x) for x in keys], lattices, k), strict=True):
            for r, (pieces, log_p, value, inclusion) in enumerate(samples):
                ids = expand(pieces, lattices.vocabulary).astype("<u4").tobytes()
                for column, v in zip(rows, (key, r, len(ids) // 4, log_p, value, inclusion, zlib.crc32(ids) if digest else ids), strict=True):
                    column.append(v)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, schema, strict=True)], schema=schema)

    for batch in batches:
        keys, texts, size = [], [], 0
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            keys.append(key)
            texts.append(text or "")
            size += len(texts[-1])
            if size >= GROUP_CHARS:
                yield flush(keys, texts)
                keys, texts, size = [], [], 0
        if keys:
            yield flush(keys, texts)


def sample_segmentations(docs: DataFrame, k: int = SAMPLES, model: str | None = None, digest: bool = False) -> DataFrame:
    """At most ``k`` distinct segmentations of each text, sampled without replacement and seeded by doc_id.

    doc_id, sample (0 is the highest perturbed value), n_pieces, log_p, perturbed, inclusion, ids
    (little-endian unsigned 32-bit; ``digest``: their checksum ids_crc32 in place).  Null and empty texts have the one empty segmentation (inclusion 1).
    Rows with equal ids (or null ids) share a seed.  Other columns are ignored.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        functools.partial(_sampled, path=model or tokenizer_path(MODEL), k=k, digest=digest),
        "doc_id long, sample int, n_pieces long, log_p double, perturbed double, inclusion double, " + ("ids_crc32 long" if digest else "ids binary"),
    )


def _joined(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    model = vocabulary_of(path).model
    for batch in batches:
        texts = [model.decode(np.frombuffer(v.as_buffer(), "<u4").tolist()) for v in batch.column(batch.num_columns - 1)]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded"])


def decode_ids(sampled: DataFrame, model: str | None = None) -> DataFrame:
    """``sampled`` with the text that its ids (last column) stand for."""
    schema = StructType([*sampled.schema.fields, StructField("decoded", StringType())])
    return sampled.mapInArrow(functools.partial(_joined, path=model or tokenizer_path(MODEL)), schema)
