"""One query per operator over its whole table, and SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import functions as F

from kpicast.llm import (
    alignment,
    byte_bpe,
    chat,
    crf,
    itq,
    line_dedup,
    mixing,
    ngram_lm,
    packing,
    partenum,
    prefix_trie,
    pstable,
    token_fst,
)
from kpicast.llm.common import documents, fold, prepare
from kpicast.llm.vectors import of_common_length, usable
from kpicast.session import written

MIX_SEED = 11


def vocabulary(name):
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_ngram_lm(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = ngram_lm.train(docs.filter(fold(F.col("doc_id"), 7) != 2))
    return ngram_lm.score(docs, model).select(
        "doc_id",
        (fold(F.col("doc_id"), 7) == 2).alias("held_out"),
        F.col("_tokens").alias("n_tokens"),
        F.col("_known").alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"),
        F.col("_base").alias("base_score"),
        F.col("_score").alias("score"),
    )


def op2_chat_format(spark, sf_dir):
    turns = prepare(spark).read.parquet(f"{sf_dir}/conversations.parquet")
    tricky = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(0, "user"), (1, "assistant")], "turn int, role string").select(
        F.lit(-1).cast("long").alias("conv_id"), "turn", "role", F.lit(tricky).alias("text")
    )
    rows = turns.select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.digests(chat.expand(chat.conversations(rows)))


def op8_source_mix(spark, sf_dir):
    return mixing.planned(documents(spark, sf_dir), MIX_SEED).select(
        "doc_id",
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_size") * F.col("_copies")).alias("taken"),
    )


def quality_model(spark, sf_dir, docs):
    """Fitted without the fold that is held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return crf.fit(docs, labels.filter(fold(F.col("doc_id"), 5) != 0))


def op9_ngram_jaccard(spark, sf_dir):
    return partenum.near_duplicates(documents(spark, sf_dir))


def op10_crf_quality(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    scored = crf.score(docs, quality_model(spark, sf_dir, docs))
    return scored.select(
        "doc_id",
        (fold(F.col("doc_id"), 5) == 0).alias("held_out"),
        F.col("_score").alias("score"),
        F.col("_predicted").alias("predicted"),
    )


def op3_best_fit_packing(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return packing.pack(packing.pieces(docs, vocabulary("word_bpe_49k.json")))


def op4_line_dedup(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return line_dedup.dedup_lines(docs).withColumnRenamed("_deleted_lines", "deleted_lines")


def embeddings(spark, sf_dir):
    return prepare(spark).read.parquet(f"{sf_dir}/embeddings.parquet")


def op5_multiprobe_neighbours(spark, sf_dir):
    rows = written(usable(embeddings(spark, sf_dir), ["vec_id"]), "vectors")
    rows = of_common_length(rows)
    return pstable.search(rows, rows.filter("vec_id % 100 = 0"), pstable.fit(rows))


def op6_itq_near_dup(spark, sf_dir):
    return itq.near_duplicates(embeddings(spark, sf_dir))


def op7_token_counts(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    counted = token_fst.count_tokens(docs, vocabulary("byte_bpe_50k.json"))
    return counted.select(
        "doc_id",
        F.col("_bytes").alias("n_bytes"),
        F.col("_tokens").alias("n_tokens"),
        (F.col("_tokens") > 512).alias("over_limit"),
    )


def op11_token_alignment(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    paths = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
    return alignment.link_statistics(docs, *paths).withColumnRenamed("digest", "groups_sha256")


def op12_prefix_trie(spark, sf_dir):
    turns = prepare(spark).read.parquet(f"{sf_dir}/conversations.parquet")
    own = prefix_trie.conversations(turns.select("conv_id", "turn", "role", "text"))
    heads = own.filter("id % 100 = 0").select(
        F.col("id").alias("_head"), F.slice("elements", 1, 5).alias("_first")
    )
    h = fold(F.col("id"), 6).cast("int")
    joined = own.withColumn("_h", h).join(heads, F.expr("id - id % 100 = _head"), "left")
    rebuilt = joined.select(
        "id",
        F.expr(
            "concat(slice(coalesce(_first, slice(elements, 1, 0)), 1, _h), slice(elements, _h + 1, size(elements)))"
        ).alias("elements"),
    )
    return prefix_trie.nodes(prefix_trie.sequences(rebuilt)).select(
        F.col("id").alias("conv_id"),
        "depth",
        F.col("parent_id").alias("parent_conv_id"),
        F.col("members").alias("n_convs"),
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.sha2(F.array_join(F.col("ends").cast("array<string>"), ","), 256).alias("ends_sha256"),
    )


def op13_byte_bpe(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    path = vocabulary("byte_bpe_multi_50k.tiktoken")
    encoded = byte_bpe.encode(docs, path)
    counted = encoded.select(
        "doc_id",
        F.expr("CAST(octet_length(_ids) DIV 4 AS long)").alias("n_tokens"),
        F.sha2("_ids", 256).alias("ids_sha256"),
        "_ids",
    )
    return byte_bpe.decode(counted, path).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2("_bytes", 256).alias("decoded_sha256")
    )


QUERIES = {f.__name__: f for f in (op1_ngram_lm, op2_chat_format, op3_best_fit_packing, op4_line_dedup, op5_multiprobe_neighbours, op6_itq_near_dup, op7_token_counts, op8_source_mix, op9_ngram_jaccard, op10_crf_quality, op11_token_alignment, op12_prefix_trie, op13_byte_bpe)}

OP2_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), numbered AS (
  SELECT *, row_number() OVER w AS n, count(*) OVER (PARTITION BY conv_id) AS n_turns,
         3 + sum(17 + length(regexp_replace(role, '([<\[\\])', '\1\\', 'g'))
                    + length(regexp_replace(text, '([<\[\\])', '\1\\', 'g'))) OVER w AS upto
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING)
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS bigint) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(upto) FILTER (role = 'assistant' OR n = n_turns) AS bigint) AS formatted_chars
FROM numbered GROUP BY conv_id
"""

OP8_SQL = rf"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents
), totals AS (
  SELECT source, CAST(sum(size) AS bigint) AS source_size,
         (row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 + 1 AS weight
  FROM sized GROUP BY source
), ordered AS (
  SELECT *, 3.0::double * source_size AS lim, 3.0::double * source_size / weight AS ord FROM totals
), levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(lim) OVER b, 0)) /
            (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS level
  FROM ordered
  WINDOW b AS (ORDER BY ord, source IS NULL, encode(source) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT source, source_size,
         coalesce(least(lim, max(level) FILTER (ord >= level) OVER () * weight), lim) AS target FROM levels
), rated AS (
  SELECT doc_id, size, source_size, target,
         CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
         ('0x' || substr(md5('{MIX_SEED}|' || doc_id), 1, 13))::bigint / 4503599627370496.0::double AS draw
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) AS bigint) AS taken
FROM rated
"""

OP12_SQL = r"""
WITH own AS (
  SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')}
                       ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), hashed AS (
  SELECT *, xor(4294967295, list_reduce(list_transform(string_split(CAST(conv_id AS varchar), ''), lambda c: CAST(ascii(c) AS bigint)),
                lambda a, b: list_reduce(range(8), lambda v, k: xor(v >> 1, 3988292384 * (v & 1)), xor(a, b)),
                CAST(4294967295 AS bigint))) % 6 AS h
  FROM own
), rebuilt AS (
  SELECT o.conv_id, list_concat(coalesce(g.turns[1:o.h], []), o.turns[o.h + 1:]) AS turns
  FROM hashed o LEFT JOIN own g ON g.conv_id = o.conv_id - o.conv_id % 100
), prefixes AS (
  SELECT conv_id, len(turns) AS n, d AS depth, turns[1:d] AS prefix
  FROM rebuilt, unnest(range(len(turns) + 1)) AS u(d)
), nodes AS (
  SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(conv_id AS varchar), ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256,
         CASE WHEN depth = 0 THEN 0 ELSE length(prefix[depth].t) END AS size
  FROM prefixes GROUP BY prefix, depth
), children AS (
  SELECT prefix[1:depth - 1] AS up, depth - 1 AS at, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL
), counted AS (
  SELECT v.*, coalesce(c.n, 0) AS n_children FROM nodes v LEFT JOIN children c ON c.up = v.prefix AND c.at = v.depth
), below AS (
  SELECT prefix[1:d] AS top, d AS at, sum((n_children = 0)::int) AS n_leaves, sum((n_convs - 1) * size) AS saved_tokens
  FROM counted, unnest(range(depth + 1)) AS u(d) GROUP BY ALL
)
SELECT v.conv_id, v.depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children,
       CAST(b.n_leaves AS bigint) AS n_leaves, CAST(b.saved_tokens AS bigint) AS saved_tokens, v.ends_sha256
FROM counted v JOIN below b ON b.top = v.prefix AND b.at = v.depth
LEFT JOIN nodes p ON p.prefix = v.prefix[1:v.depth - 1] AND p.depth = v.depth - 1
"""

ORACLES = {"op12_prefix_trie": OP12_SQL, "op2_chat_format": OP2_SQL, "op8_source_mix": OP8_SQL}
