"""Parts of the operators against plain forms, and cases that once went wrong."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from landgauge.llm import bytesops, quality, superminhash, token_counts, toxicity
from landgauge.llm.common import utf8
from landgauge.llm.labelled import training_rows


def test_long_regular_ranges_have_hashes_of_their_own():
    """Two texts that sums modulo 2^64 can't tell apart, whatever the multiplier."""
    a = "a"
    while len(a) < 4096:
        a += a.translate(str.maketrans("ab", "ba"))
    buf = np.frombuffer((a + a.translate(str.maketrans("ab", "ba"))).encode(), np.uint8)
    sums, starts = bytesops.prefix_sums(buf), np.array([0, 4096])
    weak = bytesops.range_hash(sums, starts, starts + 4096)
    safe = bytesops.range_hash(sums, starts, starts + 4096, buf)
    assert weak[0] == weak[1] and safe[0] != safe[1]


def test_segments_with_a_blank_or_its_mark_are_counted_alike():
    path = public_tokenizers.path("piece_bpe_32k.model")
    own, library = token_counts.PrefixCounter(path), sentencepiece.SentencePieceProcessor(model_file=path)
    rng, signs = random.Random(3), [" ", "▁", " a", "▁a", "the", "▁the", "é", "漢", "\U0001f600", "1", "\n", "</s>", "tion"]
    for _ in range(40):
        batch = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 20))) for _ in range(15)] + ["x a", "x▁a"]
        assert own.totals(*utf8(pa.array(batch))).tolist() == [len(t) for t in library.encode(batch)]


def test_training_rows_are_bounded(spark):
    docs = spark.createDataFrame([(i % 3, "x" * (i % 5 + 1)) for i in range(300)], "doc_id long, text string")
    labels = spark.createDataFrame([(0, 1), (1, 0), (2, 1), (2, 0), (9, 1)], "doc_id long, toxic int")

    def rows(**limits):
        return training_rows(docs, labels, "toxic", 1000, 999, **limits).collect()

    assert len(rows(limit=100)) == 15 and len(rows(limit=2)) == 2
    assert {(r.doc_id, r.y) for r in rows(limit=100)} == {(0, 1), (1, 0), (2, 1)}
    assert 0 < sum(len(r.text) for r in rows(limit=100, max_bytes=12)) <= 12
    assert rows(limit=100, max_bytes=0) == []


def test_the_factorisation_machine_sums_all_pairs():
    rng = np.random.default_rng(1)
    fm = quality.FactorisationMachine(np.sort(rng.normal(size=(quality.STATS, quality.BINS - 1))))
    fm.factors[:] = rng.normal(size=fm.factors.shape)
    fm.linear[:] = rng.normal(size=fm.linear.shape)
    fm.bias = 0.3
    row = np.repeat(np.arange(4), [3, 1, 5, 2])
    feature, value = rng.integers(0, 500, 11), rng.random(11).astype(np.float32)
    got, _ = fm.raw(row, feature, value, 4)
    for r in range(4):
        f, x = feature[row == r], value[row == r]
        want = 0.3 + (fm.linear[f] * x).sum()
        for i in range(len(f)):
            for j in range(i):
                want += (fm.factors[f[i]] @ fm.factors[f[j]]) * x[i] * x[j]
        assert got[r] == pytest.approx(want, rel=1e-4)


def test_documents_are_the_noisy_or_of_their_sentences():
    rng = np.random.default_rng(2)
    texts = ["One. Two words here. And three!", "", "Only one", "A. B. C. D. E? F"]
    buf, offsets = utf8(pa.array(texts))
    ids, _, _ = toxicity.sentences(buf, offsets)
    weights = np.zeros(1 << 22, np.float32)
    weights[np.unique(ids)] = rng.normal(size=len(np.unique(ids)))
    doc, p, _, row = toxicity.NoisyOr(weights[: ids.max() + 1], -0.5).score(buf, offsets)
    for i in range(len(texts)):
        assert doc[i] == pytest.approx(1 - np.prod([1 - x for x, r in zip(p, row) if r == i]), abs=1e-6)


def plain_pairs(sets, percent):
    names = sorted(sets)
    return {
        (u, v) for u in names for v in names
        if u < v and 100 * len(sets[u] & sets[v]) >= percent * len(sets[u] | sets[v])
    }


def candidates(spark, sets, percent):
    df = spark.createDataFrame([(i, sorted(s)) for i, s in sets.items()], "id long, shingles array<long>")
    rare = superminhash.rare_shingles(df, percent).withColumn("label", F.col("id"))
    return {(min(r.u, r.v), max(r.u, r.v)) for r in superminhash.possible_pairs(rare, percent).collect()}


@pytest.mark.parametrize("percent", [50, 80, 95])
def test_no_link_lacks_a_rare_shingle(spark, percent):
    rng = random.Random(percent)
    sets = {}
    for i in range(150):
        base = set(sets[rng.randrange(i)]) if i and rng.random() < 0.7 else {rng.randrange(400) for _ in range(rng.randint(1, 40))}
        for _ in range(rng.randint(0, 6)):
            base.add(rng.randrange(400))
            if len(base) > 1 and rng.random() < 0.5:
                base.discard(rng.choice(sorted(base)))
        sets[i] = base
    want, got = plain_pairs(sets, percent), candidates(spark, sets, percent)
    assert want and want <= got and len(got) < 150 * 149 / 2


def test_a_common_passage_makes_no_pairs(spark):
    """A third of the rows share 85 % of their shingles and differ in the rest: no pair is a link, and none is compared."""
    sets = {i: set(range(85)) | set(range(1000 + 15 * i, 1015 + 15 * i)) for i in range(200)}
    assert candidates(spark, sets, 80) == set()
