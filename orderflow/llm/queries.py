"""The queries of this package for the driver contract, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.llm import bpe, centroids, chat, classifier, contamination, learning_sql, mixing, ngram_trie, perplexity, resampling, simhash, substrings, url_sql, urls, warc
from orderflow.llm.text import table
from orderflow.llm.workers import importable

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(importable(spark), sf_dir)

        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return run

    return register


@query(r"""
    with docs as (select doc_id as id, text from documents), items as (select item_id as id, text from benchmark),
    doc_words as (select id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from docs),
    item_words as (select id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from items),
    item_shingles as (select distinct id, least(len(w), 5) as k, unnest(list_transform(range(1, greatest(len(w) - 3, 2)), lambda i: array_to_string(w[i:i + 4], ' '))) as s
                      from item_words where len(w) > 0),
    lengths as (select distinct k from item_shingles),
    doc_shingles as (select distinct id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) as s
                     from doc_words, lengths where len(w) >= k),
    sizes as (select id, count(*) as n from item_shingles group by id),
    shared as (select d.id as doc_id, i.id as item_id, count(*) as n from doc_shingles d join item_shingles i using (k, s) group by all)
    select doc_id, item_id, shared.n as n_shared, sizes.n as n_item, cast(shared.n as double) / sizes.n as containment
    from shared join sizes on sizes.id = item_id where 5 * shared.n >= 4 * sizes.n""")
def op1_decontamination(spark, sf_dir):
    return contamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op2_lm_scoring(spark, sf_dir):
    return ngram_trie.evaluated(table(spark, sf_dir, "documents"), order=3)


URL_RULES = [urls.Rule("org/", "allow"), urls.Rule("example.org/es/", "block"), urls.Rule("example.org/en/1", "block"),
             urls.Rule("com/fr/", "allow"), urls.Rule("com/de/", "block")]


@query(url_sql.judged_sql(URL_RULES))
def op3_url_filter(spark, sf_dir):
    judged = urls.judged(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "template", "purity")


@query("""
    with p as (select page_id, coalesce(html, '') as html, strlen(coalesce(html, '')) as n from pages),
    d as (select page_id, n, sha1(html) as digest, case when n >= 1000 then max(page_id) over (partition by html) end as first from p)
    select page_id, n as payload_bytes, digest as payload_digest,
           case when first is null or first = page_id then 'response' else 'revisit' end as record_type,
           case when first <> page_id then first end as refers_to
    from d""")
def op4_warc(spark, sf_dir):
    return warc.read(warc.archive(table(spark, sf_dir, "pages"))).drop("payload")


@query()
def op5_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return classifier.classified(docs).select("doc_id", "quality_score", F.col("good").alias("kept"))


@query("""
    with d as (select doc_id, hex(encode(coalesce(text, ''))) as x from documents),
    w as (select doc_id, pos, substr(x, 2 * pos + 1, 100) as s
          from (select doc_id, x, unnest(range(0, length(x) // 2 - 49)) as pos from d where length(x) >= 100)),
    m as (select s, min(doc_id) as least from w group by s),
    hits as (select doc_id, pos from w join m using (s) where least < doc_id),
    marked as (select *, case when pos <= 50 + lag(pos) over (partition by doc_id order by pos) then 0 else 1 end as new from hits),
    numbered as (select *, sum(new) over (partition by doc_id order by pos) as run from marked),
    runs as (select doc_id, run, min(pos) as low, max(pos) + 50 as high from numbered group by all),
    ends as (select doc_id, low, high from runs union all select doc_id, length(x) // 2, length(x) // 2 from d),
    gaps as (select doc_id, low, high, coalesce(lag(high) over (partition by doc_id order by low, high), 0) as before from ends)
    select doc_id, any_value(length(x) // 2) as n_bytes, cast(sum(high - low) as bigint) as n_removed, count(*) filter (high > low) as n_spans,
           sha256(unhex(string_agg(substr(x, 2 * before + 1, 2 * (low - before)), '' order by low, high))) as kept_sha256
    from gaps join d using (doc_id) group by doc_id""")
def op6_substring_dedup(spark, sf_dir):
    found = substrings.removed(table(spark, sf_dir, "documents").select("doc_id", "text"), length=50)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


# A text made of the control strings of the template itself.
HARD_TEXT = r"\### Assistant: </turn> ok"


@query(r"""
    with rows as (
        select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
        union all select -7, i, r, '\### Assistant: </turn> ok' from (values (0, 'user'), (1, 'assistant')) v(i, r)),
    sized as (
        select *, regexp_replace(text, '(\\|###|</turn>)', '\\\1', 'g') as inner_text,
               case when role in ('user', 'system', 'assistant') then role
                    else '@' || regexp_replace(role, '(\\|###|</turn>|:)', '\\\1', 'g') end as name
        from rows)
    select conv_id, count(*) as n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
           cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
           sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
           cast(sum(4 + length(name) + 2 + length(inner_text) + 8) as bigint) as formatted_chars
    from sized group by conv_id""")
def op7_chat_format(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(HARD_TEXT).alias("text"))
    return chat.digests(chat.formatted(rows.union(turns)))


@query()
def op8_quality_rules(spark, sf_dir):
    return perplexity.ruled(table(spark, sf_dir, "documents"))


@query()
def op9_simhash_near_dedup(spark, sf_dir):
    near = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return near.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query()
def op10_source_mixing(spark, sf_dir):
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    packed = mixed.packed
    taken = mixed.parts().groupBy("skey", "start").agg(F.sum("n_words").alias("taken"))
    rows = packed.where("size > 0").join(taken, ["skey", "start"], "left").unionByName(packed.where("size = 0").withColumn("taken", F.lit(0)))
    totals = mixed.sources.select("skey", F.col("words").alias("source_size"), "target")
    return rows.join(totals, "skey").select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


@query()
def op11_bpe(spark, sf_dir):
    import public_tokenizers

    tokenizer = bpe.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = bpe.encoded(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer).select("doc_id", "ids")
    return bpe.decoded(ids, tokenizer).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query(learning_sql.resampled_sql(percent=5, least_words=20, buckets=10_000, seed=42))
def op12_importance_resampling(spark, sf_dir):
    docs, target = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")
    drawn = resampling.resampled(docs, target, percent=5, least_words=20, order=3, buckets=10_000, seed=42)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


@query(learning_sql.clustered_sql(k=16, rounds=3, dims=64, scale=64, seed=1))
def op13_centroid_clustering(spark, sf_dir):
    return centroids.clustered(table(spark, sf_dir, "embeddings"), k=16, rounds=3, dims=64, scale=64, width=32, seed=1)
