"""The queries of the corpus operators over the driver tables, and their SQL forms where SQL has one."""

from __future__ import annotations

from pyspark.sql import functions as F

from landgauge.llm.common import crc_remainder, read

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


@query(
    "op2_exact_dedup",
    """
    SELECT doc_id, min(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
           doc_id = min(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256
    FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS norm FROM documents)
    """,
)
def exact_dedup(spark, sf):
    from landgauge.llm.exact_index import duplicates

    return duplicates(read(spark, sf, "documents"))


@query("op9_token_counts")
def token_counts(spark, sf):
    import public_tokenizers

    from landgauge.llm.token_counts import token_counts

    limit = 4096
    counted = token_counts(read(spark, sf, "documents"), public_tokenizers.path("piece_bpe_32k.model"), limit)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


@query(
    "op10_line_dedup",
    """
    WITH lines AS (
        SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
    ), keyed AS (
        SELECT doc_id, i, line,
               translate(trim(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '),
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
        FROM lines
    ), common AS (
        SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 20
        GROUP BY key HAVING count(DISTINCT doc_id) >= 3
    ), marked AS (
        SELECT k.doc_id, k.i, k.line, c.key IS NOT NULL AND c.last <> k.doc_id AS dropped
        FROM keyed k LEFT JOIN common c ON k.key = c.key
    )
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT dropped), '')) AS kept_sha256
    FROM marked GROUP BY doc_id
    """,
)
def line_dedup(spark, sf):
    from landgauge.llm.line_filter import drop_lines

    kept = drop_lines(read(spark, sf, "documents"), min_chars=20, min_docs=3)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query("op3_toxicity")
def toxicity(spark, sf):
    from landgauge.llm.toxicity import toxicity_scores

    scored = toxicity_scores(read(spark, sf, "documents"), read(spark, sf, "labels"), folds=4, held_out=2)
    held = (crc_remainder("doc_id", 4) == 2).alias("held_out")
    return scored.select("doc_id", held, "score", "predicted", "offending")


@query("op4_quality")
def quality(spark, sf):
    from landgauge.llm.quality import quality_scores

    scored = quality_scores(read(spark, sf, "documents"), read(spark, sf, "labels"), folds=5, held_out=0)
    return scored.select("doc_id", (crc_remainder("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


@query(
    "op1_source_mix",
    """
    WITH sized AS (
        SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents
    ), summed AS (
        SELECT source, sum(size)::BIGINT AS size FROM sized GROUP BY source
    ), weighed AS (
        SELECT source, size, (row_number() OVER (ORDER BY source NULLS LAST) - 1)::BIGINT AS place,
               CASE WHEN source IS NULL THEN '~' ELSE '=' || source END AS key FROM summed
    ), ordered AS (
        SELECT *, place % 3 + 1 AS weight FROM weighed
    ), filled AS (
        SELECT *, (sum(size) OVER ())::BIGINT - 3 * coalesce((sum(size) OVER before)::BIGINT, 0) AS rest,
               (sum(weight) OVER onward)::BIGINT AS left_weight
        FROM ordered
        WINDOW before AS (ORDER BY size / weight::DOUBLE, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
               onward AS (ORDER BY size / weight::DOUBLE, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
    ), level AS (
        SELECT rest::DOUBLE AS rest, left_weight::DOUBLE AS left_weight FROM filled
        WHERE rest::DOUBLE * weight / left_weight <= 3 * size ORDER BY size / weight::DOUBLE, place LIMIT 1
    ), targets AS (
        SELECT o.key, o.source, o.size AS source_size, place,
               CASE WHEN rest * weight / left_weight > 3 * o.size THEN 3 * o.size::DOUBLE ELSE rest * weight / left_weight END AS target
        FROM ordered o, level
    ), lined AS (
        SELECT s.doc_id, s.size, t.*, md5('1:' || coalesce(s.doc_id::VARCHAR, 'null')) AS digest FROM sized s JOIN targets t
        ON s.source IS NOT DISTINCT FROM t.source
    ), sharded AS (
        SELECT *, ('0x' || substr(digest, 1, 15))::BIGINT % (1 + source_size // 1048576) AS shard FROM lined
    ), shards AS (
        SELECT key, place, target, shard, sum(size)::BIGINT AS shard_size, (3 * sum(size)::BIGINT) // 8 AS cap
        FROM sharded GROUP BY key, place, target, shard
    ), parties AS (
        SELECT key, place, target, sum(cap)::BIGINT AS cap FROM shards GROUP BY key, place, target
    ), won AS (
        SELECT key, count(*) AS seats FROM (
            SELECT key, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, place, k) AS rank
            FROM (SELECT key, place, target, unnest(range(cap)) AS k FROM parties WHERE target > 0)
        ) WHERE rank <= (SELECT (2 * sum(size)::BIGINT + 8) // 16 FROM summed) GROUP BY key
    ), quotas AS (
        SELECT s.key, s.shard, s.shard_size, coalesce(q.quota, 0) AS quota,
               ('0x' || substr(md5('1:start:' || s.key || ':' || s.shard), 1, 15))::BIGINT
                   % greatest(1, (s.shard_size + 7) // 8) * 8 AS first
        FROM shards s LEFT JOIN (
            SELECT r.key, r.shard, count(*) * 8 AS quota FROM (
                SELECT key, shard, row_number() OVER (PARTITION BY key ORDER BY shard_size::DOUBLE / (2 * k + 1) DESC, shard, k) AS rank
                FROM (SELECT key, shard, shard_size, unnest(range(cap)) AS k FROM shards WHERE shard_size > 0)
            ) r JOIN won USING (key) WHERE rank <= seats GROUP BY r.key, r.shard
        ) q ON s.key = q.key AND s.shard = q.shard
    ), placed AS (
        SELECT l.*, q.shard_size, q.quota, q.first, (sum(size) OVER line)::BIGINT AS stop,
               CASE WHEN q.shard_size > 0 THEN q.quota // q.shard_size ELSE 0 END AS laps
        FROM sharded l JOIN quotas q ON l.key = q.key AND l.shard = q.shard
        WINDOW line AS (PARTITION BY l.key, l.shard ORDER BY digest, doc_id, size ROWS UNBOUNDED PRECEDING)
    ), ran AS (
        SELECT *, stop - size AS start, first + quota - laps * shard_size AS run_end FROM placed
    )
    SELECT doc_id, source, size, source_size, target, laps::BIGINT AS laps,
           (laps * size + CASE WHEN size = 0 THEN 0 ELSE
               greatest(0, least(stop, least(run_end, shard_size)) - greatest(start, first))
               + greatest(0, least(stop, run_end - shard_size) - greatest(start, 0)) END)::BIGINT AS taken
    FROM ran
    """,
)
def source_mix(spark, sf):
    from landgauge.llm.mixing import mix

    return mix(read(spark, sf, "documents"))


@query(
    "op6_decontamination",
    """
    WITH d AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
    ), i AS (
        SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark
    ), iw AS (
        SELECT DISTINCT item_id, l, array_to_string(w[p:p + l - 1], ' ') AS win
        FROM (SELECT item_id, w, least(10, len(w)) AS l, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p FROM i WHERE len(w) > 0)
    ), dw AS (
        SELECT doc_id, p, l, array_to_string(w[p:p + l - 1], ' ') AS win
        FROM (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS p FROM d, (SELECT DISTINCT l FROM iw) WHERE len(w) >= l)
    ), hits AS (
        SELECT doc_id, p, l, item_id FROM dw JOIN iw USING (win, l)
    ), hit_words AS (
        SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + l)) AS q FROM hits) GROUP BY doc_id
    ), hit_items AS (
        SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
    )
    SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
    """,
)
def decontamination(spark, sf):
    from landgauge.llm.fm_index import contamination

    found = contamination(read(spark, sf, "documents"), read(spark, sf, "benchmark"))
    named = F.array_join(F.array_sort("items"), ",")
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(named, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("op8_near_dedup")
def near_dedup(spark, sf):
    from landgauge.llm.superminhash import near_duplicates

    return near_duplicates(read(spark, sf, "documents"), width=4, percent=80)


@query("op7_repeated_passages")
def repeated_passages(spark, sf):
    from landgauge.llm.prefix_free import remove_repeats

    cut = remove_repeats(read(spark, sf, "documents"), window=100)
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op5_language_model")
def language_model(spark, sf):
    import public_tokenizers

    from landgauge.llm.attention_lm import language_scores

    held = crc_remainder("doc_id", 5) == 1
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    scored = language_scores(read(spark, sf, "documents"), held, vocabulary, public_tokenizers.PATTERN)
    return scored.withColumn("held_out", held)


@query(
    "op11_spelling_variants",
    """
    WITH RECURSIVE steps AS (
        SELECT list(list_reduce([b] || range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)
                    ORDER BY b) AS t
        FROM range(256) r(b)
    ), runs AS (
        SELECT doc_id, unnest(regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run
        FROM documents
    ), counted AS (
        SELECT run, hex(coalesce(doc_id::VARCHAR, '') || ':' || run) AS code, count(*) AS n
        FROM runs WHERE length(run) >= 7 GROUP BY ALL
    ), summed AS (
        SELECT run, n, xor(4294967295, list_reduce([4294967295::BIGINT] || list_transform(range(length(code) // 2),
                   lambda k: ('0x' || code[2 * k + 1:2 * k + 2])::BIGINT),
                   lambda c, b: xor(t[xor(c, b) % 256 + 1], c // 256))) AS h
        FROM counted, steps
    ), cut AS (
        SELECT CASE WHEN h % 31 <> 0 THEN run
                    ELSE substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) END AS word, n
        FROM summed
    ), words AS (
        SELECT word, sum(n)::BIGINT AS n FROM cut WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
    ), gaps AS (
        SELECT word, n, substr(word, 1, p) AS a, substr(word, p + 2) AS b FROM (SELECT word, n, unnest(range(length(word))) AS p FROM words)
    ), pairs AS (
        SELECT x.word, y.word AS near, y.n FROM gaps x JOIN gaps y ON x.a = y.a AND x.b = y.b AND x.word <> y.word
        UNION
        SELECT g.word, w.word, w.n FROM gaps g JOIN words w ON w.word = g.a || g.b
        UNION
        SELECT w.word, g.word, g.n FROM gaps g JOIN words w ON w.word = g.a || g.b
    ), best AS (
        SELECT word, count(*) AS n_near, first(near ORDER BY n DESC, near) AS near, max(n) AS near_n FROM pairs GROUP BY word
    ), forms AS (
        SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 10 * w.n THEN near END AS form,
               CASE WHEN near_n >= 10 * w.n THEN near_n END AS form_n
        FROM words w LEFT JOIN best USING (word)
    ), walk AS (
        SELECT word, form AS at FROM forms WHERE form IS NOT NULL
        UNION ALL
        SELECT k.word, f.form FROM walk k JOIN forms f ON f.word = k.at WHERE f.form IS NOT NULL
    ), ends AS (
        SELECT k.word, k.at AS root FROM walk k JOIN forms f ON f.word = k.at WHERE f.form IS NULL
    )
    SELECT word, n, n_near, form, form_n, coalesce(root, word) AS root FROM forms LEFT JOIN ends USING (word)
    """,
)
def spelling_variants(spark, sf):
    from landgauge.llm.variants import variants_of

    return variants_of(read(spark, sf, "documents"), every=31, shortest=7, least=2, ratio=10)


@query("op13_best_fit_packing")
def best_fit_packing(spark, sf):
    import public_tokenizers

    from landgauge.llm.packing import pack

    return pack(read(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"), capacity=4096, end_id=1)


def codebook_sql(parts: int = 8, k: int = 16, rounds: int = 6) -> str:
    """The rounds written out: entries and nearest entries of each round are a table of their own."""
    steps = []
    for r in range(rounds + 1):
        if r:
            steps.append(f"""
    moved{r} AS (
        SELECT part, entry, list(m ORDER BY pos) AS x FROM (
            SELECT part, entry, pos, floor(sum(v) / count(*)::DOUBLE)::BIGINT AS m
            FROM (SELECT a.part, a.entry, unnest(p.x) AS v, generate_subscripts(p.x, 1) AS pos
                  FROM nearest{r - 1} a JOIN split p USING (vec_id, part)) GROUP BY part, entry, pos
        ) GROUP BY part, entry
    ), entries{r} AS MATERIALIZED (
        SELECT part, entry, coalesce(m.x, e.x) AS x FROM entries{r - 1} e LEFT JOIN moved{r} m USING (part, entry)
    )""")
        steps.append(f"""
    nearest{r} AS MATERIALIZED (
        SELECT vec_id, part, (min((d, entry))).entry AS entry, (min((d, entry))).d AS d
        FROM (SELECT vec_id, p.part, {{'d': list_sum([(a[1] - a[2]) * (a[1] - a[2]) FOR a IN list_zip(p.x, e.x)])::BIGINT,
                     'entry': e.entry}} AS o
              FROM split p JOIN entries{r} e ON p.part = e.part) GROUP BY vec_id, part
    )""".replace("(min((d, entry)))", "min(o)"))
    return f"""
    WITH kept AS MATERIALIZED (
        SELECT vec_id, label, [floor(4096 * v::DOUBLE)::BIGINT FOR v IN embedding] AS q FROM embeddings
        WHERE embedding IS NOT NULL AND len([v FOR v IN embedding IF v IS NULL OR NOT isfinite(v)]) = 0
    ), split AS MATERIALIZED (
        SELECT vec_id, part, q[len(q) // {parts} * part + 1:len(q) // {parts} * (part + 1)] AS x
        FROM (SELECT *, unnest(range({parts})) AS part FROM kept)
    ), entries0 AS MATERIALIZED (
        SELECT part, entry, x FROM split JOIN
            (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept ORDER BY vec_id LIMIT {k}) USING (vec_id)
    ), {",".join(steps)},
    named AS (
        SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY part, entry, pos)) AS codebooks_sha256
        FROM (SELECT part, entry, unnest(x) AS v, generate_subscripts(x, 1) AS pos FROM entries{rounds})
    ), coded AS (
        SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error
        FROM nearest{rounds} GROUP BY vec_id
    )
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
    FROM coded JOIN kept USING (vec_id), named
    """


@query("op12_vector_codes", codebook_sql())
def vector_codes(spark, sf):
    from landgauge.llm.vector_codes import vector_codes

    return vector_codes(read(spark, sf, "embeddings"), parts=8, k=16, rounds=6).drop("label")
