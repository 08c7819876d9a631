"""Spelling variants, vector codes and packing against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from landgauge.llm import packing, variants, vector_codes

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(rows, shortest, every=31):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= shortest:
                counts[run] += 1
    return counts


def plain_variants(counts, ratio):
    near = defaultdict(set)
    gaps = defaultdict(set)
    for w in counts:
        for i in range(len(w)):
            gaps[w[:i], w[i + 1 :]].add(w)
            if w[:i] + w[i + 1 :] in counts:
                near[w].add(w[:i] + w[i + 1 :])
                near[w[:i] + w[i + 1 :]].add(w)
    for group in gaps.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w in counts:
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        if best is not None and counts[best] >= ratio * counts[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, n, len(near[w]), form.get(w), counts.get(form.get(w)), root(w)) for w, n in counts.items()}


def variant_rows(df):
    return {(r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect()}


def test_variants_of_documents(spark, odd, odd_rows, none):
    got = variant_rows(variants.variants_of(odd, shortest=4, least=2, ratio=3))
    counts = {w: n for w, n in plain_words([(r[0], r[1]) for r in odd_rows], 4).items() if n >= 2}
    assert got == plain_variants(counts, 3)
    assert variants.variants_of(none).collect() == []


def test_variants_of_words(spark):
    """Runs of equal characters, long words around the border of plain prefixes, ties, chains of forms."""
    rng = random.Random(5)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(1, 6))) for _ in range(400)}
    for n in (62, 63, 64, 65, 66, 200):
        long = "".join(rng.choice("xy") for _ in range(n))
        words |= {long, long[:30] + "z" + long[31:], long[:n // 2] + long[n // 2 + 1 :], "q" + long, long + "q", "a" * n}
    counts = {w: rng.choice([1, 1, 2, 10, 11, 100, 1000]) for w in words}
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(5)
    assert variant_rows(variants.spelling_variants(df)) == plain_variants(counts, 10)


def test_long_texts_and_words(spark):
    """A text of several slabs, and a run longer than a slab."""
    rng = random.Random(6)
    long = " ".join("".join(rng.choice("abcdeé") for _ in range(8)) for _ in range(400_000))
    rows = [(1, long), (2, "x" * 5_000_000 + " " + "wordword"), (3, "wordword " * 5)]
    found = variants.word_counts(spark.createDataFrame(rows, "doc_id long, text string"), shortest=7)
    assert {r.word: r.n for r in found.collect()} == plain_words(rows, 7)


def plain_codes(rows, parts, k, rounds):
    rows = [(i, v) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    if not rows:
        return set(), None
    width = -(-max(len(v) for _, v in rows) // parts) * parts or parts
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    x = np.zeros((len(rows), width), np.int64)
    for i, (_, v) in enumerate(rows):
        x[i, : len(v)] = np.floor(4096 * np.array(v, np.float64))
    x = x.reshape(len(rows), parts, -1)
    books = x[:k].transpose(1, 0, 2).copy()

    def nearest():
        square = ((x[:, :, None, :] - books[None]) ** 2).sum(-1)
        return square.argmin(-1), square.min(-1)

    for _ in range(rounds):
        own, _ = nearest()
        for p in range(parts):
            for e in range(books.shape[1]):
                if (own[:, p] == e).any():
                    books[p, e] = x[own[:, p] == e, p].sum(0) // (own[:, p] == e).sum()
    own, square = nearest()
    codes = ["".join(f"{c:02x}" for c in row) for row in own]
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return sorted((str(i), c, int(e)) for (i, _), c, e in zip(rows, codes, square.sum(1))), digest


@pytest.mark.parametrize("dims, n, parts, k", [(16, 300, 8, 16), (6, 60, 4, 5), (8, 9, 8, 16), (8, 1, 8, 16)])
def test_vector_codes(spark, dims, n, parts, k):
    rng = np.random.default_rng(dims)
    rows = [(i * 7 % n, [float(np.float32(x)) for x in rng.normal(size=dims)], int(i % 3) or None) for i in range(n)]
    rows += [(5, None, 1), (None, rows[0][1], None), (n + 1, [None] * dims, 2), (n + 2, [float("nan")] * dims, 2)]
    rows += [(n + 3, [float("inf")] + [0.0] * (dims - 1), 2), rows[0], rows[0], (n + 4, [0.5], 1), (n + 5, [], 1)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, code string")
    got = vector_codes.vector_codes(df.repartition(3), parts, k).collect()
    want, digest = plain_codes([r[:2] for r in rows], parts, k, 6)
    assert sorted((str(r.vec_id), r.code, r.error) for r in got) == want
    assert {r.codebooks_sha256 for r in got} == {digest}
    errors = Counter()
    for r in got:
        errors[r.label] += r.error
    assert all(r.label_error == errors[r.label] for r in got)


def test_vector_codes_of_nothing_and_of_huge_values(spark):
    kind = "vec_id long, embedding array<float>, label int"
    assert vector_codes.vector_codes(spark.createDataFrame([], kind)).collect() == []
    assert vector_codes.vector_codes(spark.createDataFrame([(1, None, 1)], kind)).collect() == []
    rows = [(i, [(-1.0) ** i * 3e38] * 8, 1) for i in range(40)]
    got = vector_codes.vector_codes(spark.createDataFrame(rows, kind)).collect()
    assert {r.code for r in got} == {"00" * 8, "01" * 8} and {r.error for r in got} == {0}


def fewest(items, capacity):
    items, best = sorted(items, reverse=True), [len(items)]

    def go(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(items):
            best[0] = len(rooms)
            return
        for k in range(len(rooms)):
            if rooms[k] >= items[i] and rooms[k] not in rooms[:k]:
                rooms[k] -= items[i]
                go(i + 1, rooms)
                rooms[k] += items[i]
        go(i + 1, [*rooms, capacity - items[i]])

    go(0, [])
    return best[0]


def plain_best_fit(items, capacity):
    rooms = []
    for x in sorted(items, reverse=True):
        fits = [r for r in rooms if r >= x]
        if fits:
            rooms.remove(min(fits))
        rooms.append((min(fits) if fits else capacity) - x)
    return len(rooms)


def test_bin_completion_finds_the_fewest():
    rng, better = random.Random(1), 0
    for _ in range(400):
        capacity = rng.choice([10, 20, 37, 60, 100])
        low, high = rng.randint(1, capacity // 4), rng.choice([capacity // 2, capacity])
        items = [rng.randint(low, high) for _ in range(rng.randint(1, 10))]
        counts = np.bincount(items, minlength=capacity + 1)
        greedy, found = packing.best_fit(counts), packing.bin_completion(counts)
        for patterns in (greedy, found):
            held = Counter()
            for n, parts in patterns:
                assert sum(s * t for s, t in parts) <= capacity
                for s, t in parts:
                    held[s] += n * t
            assert held == Counter(items)
        n = sum(m for m, _ in found)
        assert sum(m for m, _ in greedy) == plain_best_fit(items, capacity)
        assert packing.lower_bound(counts) <= n == fewest(items, capacity)
        better += n < sum(m for m, _ in greedy)
    assert better > 0


def test_packing_is_a_round_trip(spark, odd, odd_rows, none):
    path, capacity = public_tokenizers.path("word_bpe_49k.json"), 64
    got = packing.pack(odd, path, capacity).collect()
    model = Tokenizer.from_file(path)
    want = Counter()
    for row in odd_rows:
        ids = np.array([*model.encode(row[1] or "", add_special_tokens=False).ids, 1], "<u4")
        for k in range(0, len(ids), capacity):
            part = ids[k : k + capacity]
            want[row[0], k // capacity, k, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    ends = Counter()
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends[r.sequence_id]
        ends[r.sequence_id] += r.length
    assert max(ends.values()) <= capacity
    assert -(-sum(ends.values()) // capacity) <= len(ends) <= plain_best_fit([r.length for r in got], capacity)
    assert packing.pack(none, path).collect() == []


def test_chunks_are_encoded_as_whole_texts(monkeypatch):
    """Odd blanks, special strings, combining marks, long chunks, and a table that is thinned out and forgotten."""
    path = public_tokenizers.path("word_bpe_49k.json")
    model, mine = Tokenizer.from_file(path), packing.ChunkEncoder(path)
    rng = random.Random(2)
    signs = [" ", "\n", "\t", " ", "　", "\x0b", "\x1c", "\x85", "'s", "'", "<|endoftext|>", "<|start", "A", "é", "é",
             "́", "Σ", "ς", "İ", "ß", "1", "23", "₤", "漢字", "\U0001f600", "​", ".", "--", "word", "Words" * 30, "\x00",
             "J", "\u030c", "=", "\u0338", "I", "\u0307", "|", "<|", "|>", "<|ENDOFTEXT|>", "x", "'S", "'LL", "7", ","]
    monkeypatch.setattr(packing, "KEPT", 300)
    for _ in range(60):
        batch = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(20)]
        data = [t.encode() for t in batch]
        offsets = np.concatenate([[0], np.cumsum([len(d) for d in data])])
        ids, counts = mine.encode(np.frombuffer(b"".join(data), np.uint8), offsets)
        plain = [e.ids for e in model.encode_batch(batch, add_special_tokens=False)]
        assert counts.tolist() == [len(p) for p in plain]
        assert ids.tolist() == [i for p in plain for i in p]
