"""The queries of this package and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from tallybook.llm import (
    bloom_dedup,
    byte_bpe,
    counterfactual_toxicity,
    fm_quality,
    lang_fusion,
    length_buckets,
    minhash_inverted,
    page_diff,
    prefix_forest,
    prefix_trie,
    rans,
    threshold_topk,
    zone_negatives,
)
from tallybook.llm.common import in_fold, table

SCORED = 0.3  # from this score on a label is predicted


def _scored(docs, score, held_out):
    rows = docs.select(F.col("doc_id"), held_out.alias("held_out"), score.alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= SCORED).cast("int"))


def op1_fm_quality(spark, sf_dir):
    docs, labels, held_out = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), in_fold(F.col("doc_id"), 5, 0)
    return _scored(docs, fm_quality.score(docs, fm_quality.fit(docs, labels, ~held_out)), held_out)


def op2_page_diff(spark, sf_dir):
    return page_diff.extract(table(spark, sf_dir, "pages"))


def op3_length_buckets(spark, sf_dir):
    return length_buckets.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), added=True)


def op4_threshold_topk(spark, sf_dir):
    x = threshold_topk.scaled(table(spark, sf_dir, "embeddings"))
    return threshold_topk.top_k(x, x.where("vec_id % 100 = 0"), 10)


def op5_counterfactual_toxicity(spark, sf_dir):
    docs, labels, held_out = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), in_fold(F.col("doc_id"), 4, 2)
    return _scored(docs, counterfactual_toxicity.score(docs, counterfactual_toxicity.fit(docs, labels, ~held_out)), held_out)


def op6_minhash_inverted(spark, sf_dir):
    return minhash_inverted.link(table(spark, sf_dir, "documents"))


def op7_byte_bpe(spark, sf_dir):
    return byte_bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op8_rans_blocks(spark, sf_dir):
    return rans.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), added=True)


def op9_bloom_dedup(spark, sf_dir):
    return bloom_dedup.decide(table(spark, sf_dir, "documents"))


def op10_lang_fusion(spark, sf_dir):
    rows, name = lang_fusion.of_documents(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.col(name)["language"].alias("language"), F.col(name)["probability"].alias("probability"), F.col(name)["accepted"].alias("kept"))


def pages_lang_fusion(spark, sf_dir):
    """The fusion over pages: markup language, host and suffix of the address beside the text."""
    rows, name = lang_fusion.of_pages(table(spark, sf_dir, "pages"))
    return rows.select("page_id", "url", F.col(name)["language"].alias("language"), F.col(name)["probability"].alias("probability"), F.col(name)["accepted"].alias("kept"))


def op11_prefix_trie(spark, sf_dir):
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def op12_prefix_forest(spark, sf_dir):
    x = prefix_forest.valid(table(spark, sf_dir, "embeddings"))
    return prefix_forest.search(x, x.where("vec_id % 50 = 0"), 5)


def op13_zone_negatives(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    x = zone_negatives.scaled(table(spark, sf_dir, "embeddings"), label, 256)
    return zone_negatives.mine(x, x.where("vec_id % 50 = 0"))


QUERIES = {f.__name__: f for f in (op1_fm_quality, op2_page_diff, op3_length_buckets, op4_threshold_topk, op5_counterfactual_toxicity,
                                   op6_minhash_inverted, op7_byte_bpe, op8_rans_blocks, op9_bloom_dedup, op10_lang_fusion,
                                   op11_prefix_trie, op12_prefix_forest, op13_zone_negatives, pages_lang_fusion)}

ORACLE = {
    "op4_threshold_topk": """
        with v as (select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as x from embeddings
                   where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        s as (select q.vec_id as query_id, v.vec_id, list_sum(list_transform(range(1, len(q.x) + 1), lambda i: q.x[i] * v.x[i])) as score
              from v as q join v on q.vec_id <> v.vec_id where q.vec_id % 100 = 0),
        r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
        select query_id, cast(rank as integer) as rank, vec_id, cast(score as bigint) as score from r where rank <= 10""",
    "op9_bloom_dedup": r"""
        with t as (select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256 from documents),
        g as (select text_sha256, min(doc_id) as keep_id, count(*) as group_size from t group by 1)
        select doc_id, keep_id, group_size, doc_id is not distinct from keep_id as kept, text_sha256 from t join g using (text_sha256)""",
    "op11_prefix_trie": r"""
        with crc as (select conv_id, 4294967295 - list_reduce(
            [4294967295] || list_transform(string_split(cast(conv_id as varchar), ''), lambda x: cast(ascii(x) as bigint)),
            lambda c, b: list_reduce([xor(c, b)] || range(8), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))) as crc
            from (select distinct conv_id from conversations where conv_id is not null)),
        own as (select conv_id, list(struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as turns
                from conversations where conv_id is not null group by 1),
        built as (select o.conv_id, list_slice(coalesce(b.turns, []), 1, crc % 9) || list_slice(o.turns, crc % 9 + 1, len(o.turns)) as turns
                  from own o join crc using (conv_id) left join own b on b.conv_id = o.conv_id - o.conv_id % 5),
        member as (select conv_id, turns, unnest(range(len(turns) + 1)) as depth from built),
        node as (select list_slice(turns, 1, depth) as path, depth, min(conv_id) as conv_id, count(*) as n_convs,
                        sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (where len(turns) = depth), '')) as ends_sha256
                 from member group by 1, 2),
        kids as (select n.path, n.depth, count(c.depth) as n_children from node n left join node c on c.depth = n.depth + 1 and list_slice(c.path, 1, n.depth) = n.path group by 1, 2),
        tree as (select n.path, n.depth, sum(case when k.n_children = 0 then 1 else 0 end) as n_leaves,
                        sum(case when d.depth = 0 then 0 else (d.n_convs - 1) * octet_length(encode(d.path[d.depth].t)) end) as saved_tokens
                 from node n join node d on d.depth >= n.depth and list_slice(d.path, 1, n.depth) = n.path join kids k on k.path = d.path and k.depth = d.depth group by 1, 2)
        select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, n_children, cast(n_leaves as bigint) as n_leaves, cast(saved_tokens as bigint) as saved_tokens, n.ends_sha256
        from node n join kids using (path, depth) join tree using (path, depth) left join node p on p.depth = n.depth - 1 and p.path = list_slice(n.path, 1, n.depth - 1)""",
    # tables of up to prefix_forest.LEAST different vectors are searched exactly
    "op12_prefix_forest": """
        with v as (select vec_id, list_transform(embedding, lambda x: cast(x as double)) as x from embeddings
                   where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
        s as (select q.vec_id as query_id, v.vec_id, list_cosine_similarity(q.x, v.x) as score from v as q join v on q.vec_id <> v.vec_id where q.vec_id % 50 = 0),
        r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
        select query_id, cast(rank as integer) as rank, vec_id, score from r where rank <= 5""",
    "op13_zone_negatives": """
        with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                          list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as x from embeddings
                   where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        s as (select a.vec_id as anchor_id, v.vec_id, a.label = v.label as same, cast(list_sum(list_transform(range(1, len(a.x) + 1), lambda i: a.x[i] * v.x[i])) as bigint) as score
              from v as a join v on a.vec_id <> v.vec_id where a.vec_id % 50 = 0),
        p as (select anchor_id, vec_id as positive_id, score as positive_score from s where same qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5),
        n as (select anchor_id, positive_id, vec_id as negative_id, positive_score, score as negative_score,
                     cast(row_number() over (partition by anchor_id, positive_id order by score desc, vec_id) as integer) as rank
              from p join s using (anchor_id) where not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score)
        select * from n where rank <= 3""",
}
