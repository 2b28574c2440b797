"""The corpus queries, one for each operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from priceloom.llm import (
    bpe,
    chat_format,
    exact_dedup,
    hnsw,
    jaccard_join,
    language_id,
    licenses,
    mixing,
    periodic_runs,
    pii,
    prefix_trie,
    quality,
    warc,
)
from priceloom.llm.common import ship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op2_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.round_trip(spark, table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_counts(table(spark, sf_dir, "documents"))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.jaccard_components(table(spark, sf_dir, "documents"), width=3, threshold=0.9)
    return found.select("doc_id", F.col("n_shingles").cast("long").alias("n_shingles"), "component_id")


def op7_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.duplicate_groups(table(spark, sf_dir, "documents"), hash_all=True)
    return found.withColumnRenamed("text_hash", "text_sha256")


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return hnsw.nearest(vectors, vectors.filter(F.col("vec_id") % 20 == 0), k=20)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digests(periodic_runs.with_planted_periods(table(spark, sf_dir, "documents")))


#: The conversation that op12 adds: both turns say what a template might say.
ODD_TEXT = r"\### Assistant: </turn> ok"
ODD_TURNS = [(-7, 0, "user", ODD_TEXT), (-7, 1, "assistant", ODD_TEXT)]


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("conv_id", "turn", "role", "text")
    conversations = table(spark, sf_dir, "conversations").select(*columns)
    odd = spark.createDataFrame(ODD_TURNS, "conv_id long, turn long, role string, text string")
    return chat_format.read_back(*chat_format.format_conversations(conversations.unionByName(odd)))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_pii": op1_pii,
    "op2_warc_index": op2_warc_index,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_license_scan": op4_license_scan,
    "op5_mix_sources": op5_mix_sources,
    "op6_ngram_jaccard_join": op6_ngram_jaccard_join,
    "op7_bpe_encode_decode": op7_bpe_encode_decode,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_nearest_neighbours": op9_nearest_neighbours,
    "op10_language_id": op10_language_id,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_chat_format": op12_chat_format,
    "op13_prefix_trie": op13_prefix_trie,
}

#: Upper and lower case of ASCII letters, as translate() takes them.
CASES = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"



def crc32_sql(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit."""
    bits = f"flatten([[(ascii({text}[i]) >> k) & 1 for k in range(8)] for i in range(1, length({text}) + 1)])"
    step = "lambda c, b: xor(c >> 1, case when xor(c, b) & 1 = 1 then 3988292384 else 0 end)"
    return f"xor(list_reduce([cast(b as bigint) for b in list_prepend(4294967295, {bits})], {step}), 4294967295)"


def escaped_sql(text: str, role: bool = False) -> str:
    out = f"replace({text}, '\\', '\\\\')"
    marks = ["### ", "</turn>", "<|endoftext|>", *([": "] if role else [])]
    for mark in marks:
        out = f"replace({out}, '{mark}', '{mark[0]}\\{mark[1:]}')"
    return out


ORACLE_SQL: dict[str, str] = {
    "op2_warc_index": """
        with p as (
            select page_id, strlen(coalesce(html, '')) as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages
        ), g as (
            select *, case when payload_bytes >= 100 then min(page_id) over (partition by payload_digest) else page_id end as first
            from p
        )
        select page_id, payload_bytes, payload_digest,
            case when page_id = first then 'response' else 'revisit' end as record_type,
            case when page_id = first then null else first end as refers_to
        from g""",
    "op8_exact_dedup": f"""
        with d as (
            select doc_id, sha256(translate(coalesce(text, ''), {CASES})) as text_sha256 from documents
        ), g as (
            select text_sha256, max(doc_id) as keep_id, count(*) as group_size from d group by text_sha256
        )
        select d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id as kept, d.text_sha256
        from d join g using (text_sha256)""",
    "op11_periodic_runs": rf"""
        with d as (
            select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
                {crc32_sql("cast(doc_id as varchar)")} as h from documents
        ), sized as (
            select *, len(w) as n, h // 10 as g from d
        ), placed as (
            select *, g % greatest(n, 1) as a from sized
        ), planted as (
            select *, 1 + (n - a) // (3 + g % 8) as p from placed
        ), texts as (
            select r, doc_id, n, case when h % 10 = 0 and n > 0
                then [w[1 + case when i < a then i else a + (i - a) % p end] for i in range(n)] else w end as w from planted
        ), numbered as (
            select r, n, w, unnest(range(n)) as i from texts
        ), blocks as (
            select r, n, i, md5(array_to_string(w[i + 1 : i + 16], ' ')) as block from numbered where i + 16 <= n
        ), pairs as (
            select x.r, x.i, x.i - y.i as lag from blocks x join blocks y on x.r = y.r and x.block = y.block
            and x.i > y.i and x.i - y.i <= x.n // 3
        ), islands as (
            select r, lag, i, i - row_number() over (partition by r, lag order by i) as island from pairs
        ), diagonals as (
            select r, lag, min(i) - lag as start, count(*) + 15 + lag as length from islands group by r, lag, island
        ), runs as (
            select r, start, length, min(lag) as period from diagonals
            where length >= greatest(24, 3 * lag) group by r, start, length
        ), listed as (
            select r, count(*) as n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as lines
            from runs group by r
        ), best as (
            select * from runs qualify row_number() over
                (partition by r order by cast(length as double) / period desc, start, period) = 1
        ), kept as (
            select r, string_agg(w[i + 1], ' ' order by i) as text from numbered x
            where not exists (select 1 from runs y where y.r = x.r and x.i >= y.start + y.period and x.i < y.start + y.length)
            group by r
        )
        select doc_id, coalesce(n_runs, 0) as n_runs, start, length, period, 1000 * length // period as exponent_milli,
            sha256(coalesce(lines, '')) as runs_sha256, sha256(coalesce(text, '')) as collapsed_sha256
        from texts left join listed using (r) left join best using (r) left join kept using (r)""",
    "op12_chat_format": rf"""
        with t as (
            select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
            union all select -7, 0, 'user', '{ODD_TEXT}' union all select -7, 1, 'assistant', '{ODD_TEXT}'
        ), g as (
            select conv_id, count(*) as n_turns,
                string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text) as turns,
                coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (where role = 'assistant'), '') as loss,
                sum(length({escaped_sql("role", True)}) + length({escaped_sql("text")}) + 14) as shown
            from t group by conv_id
        )
        select conv_id, n_turns, sha256(turns) as turns_sha256, length(loss) as loss_chars, sha256(loss) as loss_sha256,
            cast(shown as bigint) as formatted_chars from g""",
    "op13_prefix_trie": f"""
        with o as (
            select conv_id as c, row_number() over (partition by conv_id order by turn nulls first, role, text) - 1 as place,
                coalesce(role, '') as role, coalesce(text, '') as text from conversations
        ), own as (
            select c, count(*) as n_own, {crc32_sql("cast(c as varchar)")} % 9 as h, c - c % 5 as base from o group by c
        ), convs as (
            select own.*, least(own.h, coalesce(b.n_own, 0)) as taken from own left join own b on own.base = b.c
        ), turns as (
            select convs.c, o.place + 1 as depth, role, text from convs join o on o.c = base where place < h
            union all select convs.c, taken + place - h + 1, role, text from convs join o on o.c = convs.c where place >= h
        ), path as (
            select c, depth, strlen(text) as bytes, string_agg(md5(role || chr(31) || text), '') over
                (partition by c order by depth rows between unbounded preceding and current row) as node from turns
            union all select c, 0, 0, '' from convs
        ), ends as (
            select node, string_agg(c, ',' order by c) as ids
            from (select c, node from path qualify row_number() over (partition by c order by depth desc) = 1) group by node
        ), nodes as (
            select node, any_value(depth) as depth, min(c) as conv_id, count(*) as n_convs, any_value(bytes) as bytes from path group by node
        ), linked as (
            select n.*, p.conv_id as parent_conv_id, p.node as up
            from nodes n left join nodes p on n.depth > 0 and p.node = left(n.node, 32 * (n.depth - 1))
        ), children as (
            select up as node, count(*) as n_children from linked where up is not null group by up
        ), below as (
            select a.node, cast(count_if(u.node not in (select node from children)) as bigint) as n_leaves, sum((u.n_convs - 1) * u.bytes) as saved
            from nodes u join path a on a.c = u.conv_id and a.depth <= u.depth group by a.node
        )
        select conv_id, depth, parent_conv_id, n_convs, coalesce(n_children, 0) as n_children, n_leaves,
            cast(saved as bigint) as saved_tokens, sha256(coalesce(ids, '')) as ends_sha256
        from linked left join children using (node) join below using (node) left join ends using (node)""",
}
