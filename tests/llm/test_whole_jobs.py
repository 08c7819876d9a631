"""Cases in which an operator once did less than the whole job."""

import random

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from landgauge.llm import attention, attention_lm, line_filter, superminhash


def small_vocabulary():
    counts = np.zeros(3000)
    counts[:2500] = 10_000 / np.arange(1, 2501)
    return attention.Vocabulary(counts)


def test_tokens_inside_an_output_depend_on_the_context():
    own = small_vocabulary()
    net = attention.Attention(own.output_counts, own)
    rng = np.random.default_rng(0)
    inputs = own.inputs[rng.integers(0, 3000, (1, attention.LENGTH))]
    every = np.arange(3000)
    whole = lambda: net.log_probabilities(
        np.repeat(inputs, 3000, 0), np.repeat(own.outputs[every][:, None], attention.LENGTH, 1),
        np.arange(attention.LENGTH)[None] == np.full((3000, 1), 9), np.repeat(every[:, None], attention.LENGTH, 1),
    )
    # Untrained, a token has its share of its output.
    bare = net.log_probabilities(np.repeat(inputs, 3000, 0), np.repeat(own.outputs[every][:, None], attention.LENGTH, 1), np.arange(attention.LENGTH)[None] == np.full((3000, 1), 9))
    assert np.allclose(whole(), bare + own.share, atol=1e-3)
    net.nodes[:, :-1] = rng.normal(0, 1, net.nodes[:, :-1].shape)
    assert abs(np.exp(whole()).sum() - 1) < 1e-3
    one = whole()
    inputs = np.roll(inputs, 1, 1)
    inside = own.outputs == own.outputs[2000]
    moved = (whole() - one)[inside]
    assert moved.max() - moved.min() > 0.1
    # Gradients of the new parts.
    ids = rng.integers(0, 3000, (3, attention.LENGTH))
    batch, outputs, scored = own.inputs[ids], own.outputs[ids].astype(np.int64), np.ones(ids.shape, bool)
    grads = net.gradients(batch, outputs, ids)
    dense = np.zeros_like(net.nodes)
    dense[grads["passed"]] = grads["nodes"]
    for w, g in ((net.nodes, dense), (net.down, grads["down"]), (net.emb, grads["emb"]), (net.o, grads["o"])):
        at = np.unravel_index(np.abs(g).argmax(), w.shape)
        losses = []
        for step in (1e-2, -2e-2):
            w[at] += step
            losses.append(-net.log_probabilities(batch, outputs, scored, ids).mean())
        w[at] += 1e-2
        assert abs((losses[0] - losses[1]) / 2e-2 - g[at]) < 0.05 * abs(g[at]) + 1e-4


def test_every_training_window_is_kept_and_all_trainers_count(spark, odd):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    found = attention_lm.gathered(odd.select(F.coalesce("doc_id", F.lit(0)).alias("id"), "text"), path, public_tokenizers.PATTERN)
    tokens = attention_lm.Tokens.of(path, public_tokenizers.PATTERN)
    rows = odd.select("text").toArrow()["text"].combine_chunks()
    sizes = tokens.batch(rows)[-1]
    want = len(attention.windows(np.cumsum(sizes) - sizes, sizes)[0])
    assert found.where("kind = 2").agg(F.sum("n")).first()[0] == want
    weights = [(i, 1 + i, np.array([i, 2 * i], np.float32).tobytes()) for i in range(123)]
    rows = spark.createDataFrame(weights, "trainer long, n long, weights binary")
    (row,) = attention_lm.averaged(rows, 123).collect()
    mean = sum(i * (1 + i) for i in range(123)) / sum(range(1, 124))
    assert row.n == sum(range(1, 124)) and np.allclose(np.frombuffer(row.weights, np.float32), [mean, 2 * mean])


def test_probes_of_unique_lines_count_for_the_copies(spark, monkeypatch):
    monkeypatch.setattr(line_filter, "COPY_PROBES", 100)
    monkeypatch.setattr(line_filter, "ROW_PROBES", 10)
    rows = [(i, "\n".join(f"line {k} of document {i} alone" for k in range(50)) + "\nthe one line that all share") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    seen = []
    build = line_filter.build_shards
    monkeypatch.setattr(line_filter, "build_shards", lambda *a: seen.append(build(*a)) or seen[-1])
    got = {r["doc_id"]: r["n_dropped"] for r in line_filter.drop_lines(docs).collect()}
    assert got == {i: int(i != 39) for i in range(40)}
    # 40 documents of 51 lines.
    assert [r["copies"] for r in seen[0].collect()] == [1 + 40 * 51 // 100]


def test_lines_of_repeated_ids_count_once_without_merging_texts(spark, monkeypatch):
    shared = ["a line that three documents share", "a line that two ids share in four rows"]
    rows = [(1, shared[0]), (1, shared[1]), (1, shared[1] + "\nmore"), (2, "\n".join(shared)), (2, shared[1]), (3, shared[0]), (None, "x"), (None, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    plans = []
    monkeypatch.setattr(line_filter, "stored", lambda df, name, put=line_filter.stored: plans.append(df._jdf.queryExecution().toString()) or put(df, name))
    got = sorted((r["doc_id"] or 0, r["text"]) for r in line_filter.drop_lines(docs).collect())
    want = [(0, "x"), (0, "y"), (1, ""), (1, shared[1]), (1, shared[1] + "\nmore"), (2, shared[1]), (2, shared[1]), (3, shared[0])]
    assert got == want
    assert not any("collect_set(text" in p or "collect_list(text" in p for p in plans)


def test_near_copies_of_rows_without_id_or_with_a_shared_one(spark):
    rng = random.Random(1)
    a, b, c = (" ".join(str(rng.random()) for _ in range(60)) for _ in range(3))
    rows = [(1, a), (2, b), (None, a + " x"), (None, b + " x"), (None, c), (None, c), (7, c + " x"), (7, a + " y"), (7, "alone " * 9), (7, "alone " * 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["component_id"], r["kept"]) for r in superminhash.near_duplicates(docs).collect()}
    assert got == {(1, 1, True), (2, 2, True), (None, 1, False), (None, 2, False), (None, 7, False), (7, 7, True), (7, 1, False)}
    left = sorted(map(tuple, corpus_pipeline.near_copies(spark, docs, "").collect()))
    assert left == sorted([(1, a), (2, b), (7, c + " x"), (7, "alone " * 9)])


def test_positions_that_are_context_only_change_no_score():
    own = small_vocabulary()
    net = attention.Attention(own.output_counts, own)
    rng = np.random.default_rng(1)
    net.nodes[:, :-1] = rng.normal(0, 1, net.nodes[:, :-1].shape)
    ids = rng.integers(0, 3000, (40, attention.LENGTH))
    lead = attention.LENGTH - attention.STRIDE
    scored = (np.arange(attention.LENGTH) >= lead) & (rng.random(ids.shape) < 0.9)
    whole = net.log_probabilities(own.inputs[ids], own.outputs[ids], scored, ids)
    assert np.allclose(net.log_probabilities(own.inputs[ids], own.outputs[ids], scored, ids, lead), whole, atol=1e-5)
    # Only the states that are scored are worked out.
    assert len(net.hidden(own.inputs[ids], lead)[-1]) == len(ids) * attention.STRIDE


def test_a_path_holds_the_nodes_that_lead_to_a_token():
    own = small_vocabulary()
    assert len(own.path) == len(own.bend) == own.steps.sum() and set(own.bend) == {1.0, -1.0}
    for token in (0, 300, 1500, 2999):
        # Ranks of the tokens of the same output, halved at each node.
        ranks = np.lexsort((np.arange(3000), -np.where(np.arange(3000) < 2500, 10_000 / np.arange(1, 3001), 0)))
        low, high = np.flatnonzero(own.outputs[ranks] == own.outputs[token])[[0, -1]] + [0, 1]
        path = slice(own.begin[token], own.begin[token] + own.steps[token])
        for node, bend in zip(own.path[path], own.bend[path]):
            assert node == (low + high) // 2
            low, high = (node, high) if bend > 0 else (low, node)
        assert high - low == 1 and ranks[low] == token


def test_windows_are_cut_with_the_token_before_them():
    end = 99
    texts = [list(range(1, 80)), [], list(range(200, 231)), list(range(300, 333))]
    sizes = np.array([len(t) + 1 for t in texts])
    starts = np.cumsum(sizes) - sizes
    tokens = np.array([i for t in texts for i in [*t, end]], np.int32)
    first, length, context, owner = attention.windows(starts, sizes)
    rows = attention_lm.filled(tokens, first, length, end)
    for row, f, n, o in zip(rows.tolist(), first, length, owner):
        text = [end, *texts[o], end]
        at = f - starts[o]
        assert row == text[at : at + n + 1] + [-1] * (attention.LENGTH - n)
    # One row at a time gives the same: nothing depends on the other windows asked for.
    assert all(np.array_equal(attention_lm.filled(tokens, first[i : i + 1], length[i : i + 1], end)[0], rows[i]) for i in range(len(rows)))


def test_scores_of_texts_are_those_of_their_windows_one_by_one():
    own = small_vocabulary()
    net = attention.Attention(own.output_counts, own)
    rng = np.random.default_rng(2)
    end = 2999
    sizes = np.array([1, 32, 33, 500, 7, 90])
    tokens = rng.integers(0, 2999, sizes.sum()).astype(np.int32)
    tokens[np.cumsum(sizes) - 1] = end
    got = attention_lm.text_scores(own, net, tokens, sizes, end)
    for text, score in zip(np.split(tokens, np.cumsum(sizes)[:-1]), got):
        total = 0.0
        for f, n, c, _ in zip(*attention.windows(np.array([0]), np.array([len(text)]))):
            targets = np.full((1, attention.LENGTH), end)
            targets[0, :n] = text[f : f + n]
            inputs = np.append(end if f == 0 else text[f - 1], targets[0, :-1])[None]
            scored = (np.arange(attention.LENGTH) >= c) & (np.arange(attention.LENGTH) < n)
            total += net.log_probabilities(own.inputs[inputs], own.outputs[targets], scored[None], targets).sum()
        assert abs(score - total / np.log(10)) < 1e-4 * abs(score)


def test_training_moves_as_plain_adam_does():
    own = small_vocabulary()
    rng = np.random.default_rng(3)
    ids = rng.integers(0, 3000, (9, attention.LENGTH))
    outputs = own.outputs[ids].astype(np.int64)
    outputs[4, 20:] = -1  # padding
    net, plain = attention.Attention(own.output_counts, own), attention.Attention(own.output_counts, own)
    net.train(own.inputs[ids], outputs, 0.01, batch=3, tokens=ids)
    moments = {n: [np.zeros(getattr(plain, n).shape), np.zeros(getattr(plain, n).shape)] for n in plain.NAMES}
    for step in (1, 2, 3):
        part = slice(3 * step - 3, 3 * step)
        grads = plain.gradients(own.inputs[ids[part]], outputs[part], ids[part])
        pace = 0.01 * step / 20 * np.sqrt(1 - 0.98**step) / (1 - 0.9**step)
        passed = grads.pop("passed")
        for n, g in grads.items():
            where = passed if n == "nodes" else ...
            m, v = moments[n]
            m[where] = 0.9 * m[where] + 0.1 * g
            v[where] = 0.98 * v[where] + 0.02 * g * g
            getattr(plain, n)[where] -= pace * m[where] / (np.sqrt(v[where]) + 1e-8)
    for n in net.NAMES:
        # Where a gradient is all but zero, rounding decides its direction.
        assert np.mean(np.abs(getattr(net, n) - getattr(plain, n)) > 1e-5) < 0.01, n
