"""The registered queries of the training-data operators, over whole tables, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from odoflow.llm import align, exact, hmm, linedup, packing, quality, rans, simhash, syncmers, toolcalls, toxicity, variants, winnow
from odoflow.llm.common import Scratch, table


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token-id files of all documents, written and read back."""
    path = Scratch(spark, "token-files").path("files")
    rans.write_token_files(table(spark, sf_dir, "documents"), path)
    return rans.read_token_files(spark, path).drop("ids").select("doc_id", "start", "n_tokens", "ids_crc32")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts of all documents; the largest doc_id stays."""
    found = exact.exact_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints of all documents and their components."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents."""
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op5_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and hidden Markov log10 probabilities of all documents."""
    return hmm.score_texts(table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of all documents without those that match an earlier line: counts and the digest of what stays."""
    found = linedup.LineDedup(table(spark, sf_dir, "documents")).report()
    return found.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


#: The tools of the calls that op9 derives from conversations.
TOOLS = {
    "search": {"required": ["query"], "properties": {"query": {"type": "string", "maxLength": 1000}, "size": {"type": "integer"}}},
    "store": {"properties": {"query": {"type": "string"}, "size": {"type": "integer", "minimum": 200}}, "additionalProperties": False},
    "refine": {"required": ["query", "size"], "properties": {"size": {"type": "integer", "maximum": 1500}}},
}


def op9_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations with their calls linked. The table holds no calls, so every assistant turn stands for
    one (tool by the length of its text, arguments from the text); the next user turn is its result, and a
    ``refine`` call comes after the assistant's call before it."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    named = F.concat(F.lit("call-"), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string"))
    tool = F.element_at(F.array(*map(F.lit, TOOLS)), (F.length("text") % 3 + 1).cast("int"))
    said = turns.where("role = 'assistant'").select("conv_id", "turn", named.alias("call_id"), tool.alias("name"), F.to_json(F.struct(F.col("text").alias("query"), F.length("text").alias("size"))).alias("arguments"))
    earlier = said.select("conv_id", (F.col("turn") + 2).alias("turn"), F.col("call_id").alias("prior"))
    calls = said.join(earlier, ["conv_id", "turn"], "left").withColumn("after", F.when((F.col("name") == "refine") & F.col("prior").isNotNull(), F.array("prior")).otherwise(F.array().cast("array<string>")))
    results = turns.where("role = 'user'").join(said.select("conv_id", (F.col("turn") + 1).alias("turn"), "call_id"), ["conv_id", "turn"]).select("conv_id", "turn", "call_id", F.col("text").alias("content"))
    return toolcalls.link_and_format(turns, calls, results, TOOLS)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlap of all documents with all benchmark items."""
    found = winnow.Winnowing(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).report()
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2("item_ids", 256).alias("items_sha256"), "contaminated")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between the tokens of both vocabularies in all documents, with the pairs' corpus-wide counts."""
    return align.Alignment(table(spark, sf_dir, "documents")).documents()


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Syncmer fingerprints of all documents and of their edited texts, and their likeness."""
    return syncmers.fingerprints(table(spark, sf_dir, "documents"))


def op13_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with their near words, forms and roots."""
    return variants.variants(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_token_files, op2_exact_dedup, op3_simhash, op4_quality, op5_hmm, op6_packing, op7_toxicity, op8_line_dedup, op9_tool_calls, op10_decontamination, op11_alignment, op12_fingerprints, op13_variants)}
QUERIES["pipeline"] = corpus_pipeline.run

ORACLE = {
    "op2_exact_dedup": """
        select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
               doc_id is not distinct from max(doc_id) over same as kept, sha256(coalesce(text, '')) as text_sha256
        from documents window same as (partition by coalesce(text, ''))
    """,
    "op9_tool_calls": """
        with said as (
          select conv_id, turn, 'call-' || conv_id || '-' || turn as call_id, coalesce(text, '') as text,
                 case length(coalesce(text, '')) % 3 when 0 then 'search' when 1 then 'store' else 'refine' end as name
          from conversations where role = 'assistant'),
        marked as (
          select s.*, case when name = 'refine' and p.call_id is not null then 0 else 1 end as starts
          from said s left join (select conv_id, turn + 2 as turn, call_id from said) p using (conv_id, turn)),
        runs as (
          select *, turn // 2 - row_number() over (partition by conv_id, turn % 2 order by turn) as lane,
                 sum(starts) over (partition by conv_id, turn % 2 order by turn) as part from marked),
        leveled as (select *, (row_number() over (partition by conv_id, turn % 2, part order by turn) - 1)::int as level from runs),
        answer as (
          select c.conv_id, c.turn, s.call_id, s.level, coalesce(c.text, '') as text
          from conversations c join leveled s on s.conv_id = c.conv_id and s.turn + 1 = c.turn where c.role = 'user'),
        checked as (
          select l.*, case when name = 'search' and length(text) > 1000 then '$.query: length'
                           when name = 'store' and length(text) < 200 then '$.size: out of range'
                           when name = 'refine' and length(text) > 1500 then '$.size: out of range' else '' end as fault
          from leveled l)
        select conv_id, turn::bigint as turn, 'message' as kind, null::varchar as call_id, null::int as level, null::boolean as linked,
               null::boolean as valid, '' as fault, '{"content":' || to_json(coalesce(text, '')) || ',"role":' || to_json(coalesce(role, '')) || '}' as json
        from conversations
        union all
        select conv_id, turn, 'call', call_id, level, call_id in (select call_id from answer), fault = '', fault,
               '{"arguments":{"query":' || to_json(text) || ',"size":' || length(text) || '},"id":' || to_json(call_id) || ',"name":"' || name || '"}'
        from checked
        union all
        select conv_id, turn, 'result', call_id, level, true, null, '', '{"call_id":' || to_json(call_id) || ',"content":' || to_json(text) || '}'
        from answer
    """,
    "op10_decontamination": """
        with d as (
          select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
          from documents),
        b as (
          select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
          from benchmark),
        item as (
          select distinct item_id, least(len(w), 13) as n, w[i : i + least(len(w), 13) - 1] as win
          from (select item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) as i from b where len(w) > 0)),
        sizes as (select distinct n from item),
        spot as (
          select doc_id, i, n, w[i : i + n - 1] as win
          from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from d, sizes)),
        hit as (select doc_id, i, a.n, item_id from spot a join item using (n, win)),
        words as (
          select doc_id, count(distinct pos) as n_hit
          from (select doc_id, unnest(range(i, i + n)) as pos from (select distinct doc_id, i, n from hit)) group by doc_id),
        ids as (
          select doc_id, count(distinct item_id) as n_items, string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as ids
          from hit group by doc_id)
        select d.doc_id, len(d.w)::bigint as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
               sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * n_hit >= len(d.w) as contaminated
        from d left join words using (doc_id) left join ids using (doc_id)
    """,
}
