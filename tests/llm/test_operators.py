"""Each operator against a plain version in Python, on rows with every odd case."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from landgauge.llm import attention, components, exact_index, fm_index, line_filter, mixing, prefix_free, superminhash, token_counts

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
LAST = 1 << 62


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))


def by_id(df):
    """Rows with an id, one per id (repeated rows have equal results)."""
    return {r["doc_id"]: r for r in df.collect() if r["doc_id"] is not None}


def ids(rows):
    return {r[0]: r[1] for r in rows if r[0] is not None}


@pytest.mark.parametrize("key", [F.xxhash64, lambda norm: F.xxhash64(F.length(norm) % 29)])
def test_exact_duplicates_with_and_without_collisions(odd, odd_rows, key):
    got = exact_index.duplicates(odd, capacity=2, key=key).collect()
    groups = defaultdict(list)
    for r in odd_rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "")].append(LAST if r[0] is None else r[0])
    want = sorted(
        (i, min(g), len(g), i == min(g), hashlib.sha256(n.encode()).hexdigest()) for n, g in groups.items() for i in g
    )
    plain = [tuple(r) for r in got]
    assert sorted((LAST if a is None else a, LAST if b is None else b, *rest) for a, b, *rest in plain) == want


def test_directory_splits_until_no_bucket_is_overfull(spark):
    keys = spark.range(3000).select(F.xxhash64("id").alias("h"))
    buckets = exact_index.split_buckets(keys, 10).collect()
    assert sum(b["keys"] for b in buckets) == 3000 and max(b["keys"] for b in buckets) <= 10
    pointers, deepest = exact_index.directory(exact_index.split_buckets(keys, 10))
    assert pointers.count() == pointers.select("pointer").distinct().count() <= 1 << deepest


def test_mix(odd, odd_rows):
    got = mixing.mix(odd, block=2).collect()
    assert len(got) == len(odd_rows)
    taken, target = Counter(), {}
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert abs(sum(target.values()) - sum(r["size"] for r in got)) < 1e-6
    assert all(abs(taken[s] - t) <= 4 for s, t in target.items())
    assert sorted(map(tuple, mixing.mix(odd, block=2).collect()), key=repr) == sorted(map(tuple, got), key=repr)


def test_seats_go_to_the_highest_quotients(spark):
    rng = np.random.default_rng(0)
    votes = {p: rng.integers(1, 1000, 40).astype(float) for p in range(3)}
    rows = [(p, i, float(v), 500 + p, 60) for p, vs in votes.items() for i, v in enumerate(vs)]
    items = spark.createDataFrame(rows, "party int, item int, votes double, seats long, cap long")
    got = {(r["party"], r["item"]): r["won"] for r in mixing.sainte_lague(items).collect()}
    for p, vs in votes.items():
        ranked = sorted(((-v / (2 * k + 1), i, k) for i, v in enumerate(vs) for k in range(60)))[: 500 + p]
        won = Counter(i for _, i, _ in ranked)
        assert {i: got[p, i] for i in range(40)} == {i: won[i] for i in range(40)}


def test_lines(odd, odd_rows):
    docs = ids(odd_rows)
    holders = defaultdict(set)
    strip = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOW)
    for r in odd_rows:
        for line in (r[1] or "").split("\n"):
            holders[strip(line)].add(-1 if r[0] is None else r[0])
    got = by_id(line_filter.drop_lines(odd))
    for i, text in docs.items():
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (len(strip(x)) >= 20 and len(holders[strip(x)]) >= 3 and i != max(holders[strip(x)]))]
        assert (got[i]["n_lines"], got[i]["n_dropped"], got[i]["text"]) == (len(lines), len(lines) - len(kept), "\n".join(kept))


def test_perfect_hash_is_minimal_and_rejects_others():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 63, 5000, dtype=np.uint64))
    built = line_filter.PerfectHash.build(keys, np.arange(len(keys)), np.arange(len(keys)))
    packed = line_filter.PerfectHash.unpack(built.pack())
    places = packed.find(keys)
    assert sorted(places) == list(range(len(keys))) and (packed.counts[places] == np.arange(len(keys))).all()
    assert (packed.find(rng.integers(1 << 63, (1 << 64) - 1, 5000, dtype=np.uint64)) == -1).all()


def test_decontamination(odd, odd_rows, spark):
    docs = ids(odd_rows)
    pick = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOW))
    items = {1: " ".join(odd_rows[6][1].split(" ")[10:31]), 2: "One", 3: None, 4: "a b c", 5: odd_rows[21][1], 10: "!!", 11: "be " * 12}
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    got = by_id(fm_index.contamination(odd, bench))
    cut = by_id(fm_index.without_spans(odd, bench))
    for i, text in docs.items():
        w, hit, found = pick(text), set(), set()
        for item, t in items.items():
            p = pick(t)
            n = min(10, len(p))
            wins = {tuple(p[k : k + n]) for k in range(len(p) - n + 1)} if n else set()
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in wins:
                    hit.update(range(k, k + n))
                    found.add(str(item))
        assert (got[i]["n_words"], got[i]["n_hit"], got[i]["items"]) == (len(w), len(hit), sorted(found))
        left = pick(cut[i]["text"])
        assert not hit or len(left) <= len(w) - len(hit) + 1
        assert hit or cut[i]["text"] == text or not text


def test_backward_search_and_locate():
    rng = np.random.default_rng(2)
    text = np.append(rng.integers(1, 5, 400), 0)
    index = fm_index.FMIndex(text, 5)
    patterns = np.array([text[k : k + 4] for k in range(0, 300, 7)])
    low, high = index.search(patterns)
    for p, a, z in zip(patterns, low, high):
        want = [k for k in range(len(text) - 3) if (text[k : k + 4] == p).all()]
        assert sorted(index.locate(np.arange(a, z))) == want


@pytest.mark.parametrize("crowd", [20_000, 1])
def test_repeated_passages(odd, odd_rows, crowd):
    got = Counter(
        (r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in prefix_free.remove_repeats(odd, crowd=crowd).collect()
    )
    hashes = {r.text: r.h for r in odd.select("text", F.xxhash64("text").alias("h")).collect()}
    seen, want = set(), Counter()
    for i, text in sorted(((r[0], r[1]) for r in odd_rows), key=lambda r: (r[0] is None, r[0], hashes[r[1]])):
        data = (text or "").encode()
        gone, end = bytearray(len(data)), 0
        for p in range(len(data) - 99):
            window = data[p : p + 100]
            if window in seen:
                gone[max(end, p) : p + 100] = b"\1" * (p + 100 - max(end, p))
                end = p + 100
            seen.add(window)
        kept = bytes(c for c, g in zip(data, gone) if not g)
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        want[i, len(data), sum(gone), spans, kept] += 1
    assert got == want


@pytest.mark.parametrize("rounds", [0, 2])
def test_near_duplicates(odd, odd_rows, rounds, monkeypatch):
    # Without rounds of stars all links come from the pairs that remain.
    monkeypatch.setattr(superminhash, "STAR_ROUNDS", rounds)
    docs = ids(odd_rows)
    sets = {}
    for i, t in docs.items():
        w = split(t)
        sets[i] = {tuple(w[k : k + 4]) for k in range(len(w) - 3)} or ({tuple(w)} if w else set())
    label = {i: i for i in docs}
    for _ in docs:
        for i in docs:
            for j in docs:
                common = len(sets[i] & sets[j])
                if common and 100 * common >= 80 * len(sets[i] | sets[j]):
                    label[i] = min(label[i], label[j])
    got = by_id(superminhash.near_duplicates(odd, width=4))
    assert {i: (r["n_shingles"], r["component_id"], r["kept"]) for i, r in got.items()} == {
        i: (len(sets[i]), label[i], label[i] == i) for i in docs
    }
    assert superminhash.near_duplicates(odd).count() == len(odd_rows)


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(4)
    pool = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    a, b = pool[:200], pool[100:]
    held = superminhash.signatures(np.concatenate([a, b, pool[:3]]), np.array([200, 200, 3]), 128)
    assert abs((held[0] == held[1]).mean() - 1 / 3) < 0.15
    # A slot's offer is a step plus a fraction, and every slot of even a tiny set is filled.
    assert np.isfinite(held).all() and sorted(set(np.floor(held[2]).astype(int)))[0] == 0


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "u long, v long")
    got = {r["id"]: r["label"] for r in components.components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


def test_token_counts(odd, odd_rows):
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    got = by_id(token_counts.token_counts(odd, path, limit=50))
    for i, text in ids(odd_rows).items():
        text = text or ""
        assert (got[i]["n_bytes"], got[i]["n_tokens"]) == (len(text.encode()), len(library.encode(text)))
    prefixes = by_id(token_counts.prefix_counts(odd.where("length(text) < 500"), path))
    for i, r in prefixes.items():
        text = ids(odd_rows)[i]
        want = [len(library.encode(text[:k])) for k in range(len(text) + 1)]
        assert r["counts"] == want
        assert got[i]["fits_chars"] == max(k for k, n in enumerate(want) if n <= 50)


def test_probabilities_of_the_model_sum_to_one_and_gradients_hold():
    counts = np.zeros(900)
    counts[:700] = np.arange(700)
    own = attention.Vocabulary(counts)
    assert abs(sum(np.exp(own.share)[own.outputs == k].sum() for k in set(own.outputs)) - len(set(own.outputs))) < 1e-9
    net = attention.Attention(own.output_counts)
    rng = np.random.default_rng(0)
    inputs = own.inputs[rng.integers(0, 900, (3, attention.LENGTH))]
    outputs = own.outputs[rng.integers(0, 900, (3, attention.LENGTH))].astype(np.int64)
    scored = np.ones(outputs.shape, bool)
    grads = net.gradients(inputs, outputs)
    for name in net.NAMES:
        w = getattr(net, name)
        at = np.unravel_index(np.abs(grads[name]).argmax(), w.shape)
        losses = []
        for step in (1e-2, -2e-2):
            w[at] += step
            losses.append(-net.log_probabilities(inputs, outputs, scored).mean())
        w[at] += 1e-2
        assert abs((losses[0] - losses[1]) / 2e-2 - grads[name][at]) < 0.05 * abs(grads[name][at]) + 1e-4, name
    # Causal: a later input changes no earlier probability.
    before = net.log_probabilities(inputs, outputs, scored).reshape(3, -1)
    inputs[:, 20] = (inputs[:, 20] + 1) % 100
    after = net.log_probabilities(inputs, outputs, scored).reshape(3, -1)
    assert np.allclose(before[:, :20], after[:, :20], atol=1e-5) and not np.allclose(before[:, 20:], after[:, 20:], atol=1e-5)


def test_windows_score_each_token_once():
    sizes = np.array([1, 0, 32, 33, 100, 56])
    starts = np.cumsum(sizes) - sizes
    first, length, context, _ = attention.windows(starts, sizes)
    hits = Counter(p for f, n, c in zip(first, length, context) for p in range(f + c, f + n))
    assert hits == Counter(range(sizes.sum()))


def test_language_scores(odd, odd_rows):
    import public_tokenizers

    from landgauge.llm.attention_lm import language_scores

    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 1
    column = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1, F.lit(False))
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    got = by_id(language_scores(odd, column, path, public_tokenizers.PATTERN))
    counts = Counter()
    for r in odd_rows:
        if r[0] is None or not held(r[0]):
            counts.update([*split(r[1]), "\0"])
    n, v = sum(counts.values()), len(counts)
    for i, text in ids(odd_rows).items():
        tokens = [*split(text), "\0"]
        base = sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens)
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(tokens), sum(counts[t] > 0 for t in tokens), n)
        assert abs(r["base_score"] - base) < 1e-6 * max(1, -base) and r["score"] < 0
