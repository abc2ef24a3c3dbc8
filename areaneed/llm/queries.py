"""Registered queries of the operators: each over its whole table, with its digest columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from areaneed.llm.ann import tree_neighbours
from areaneed.llm.decontam import decontaminate
from areaneed.llm.divergence import source_divergence
from areaneed.llm.exact import mark_copies
from areaneed.llm.fim import fill_in_middle, restore_text
from areaneed.llm.jaccard import jaccard_components
from areaneed.llm.licenses import scan_licenses
from areaneed.llm.packing import harmonic_pack
from areaneed.llm.quality import classify
from areaneed.llm.sharding import LAW, shuffle_shards
from areaneed.llm.substring import substring_dedup
from areaneed.llm.toolcalls import link_tool_calls
from areaneed.llm.warc import read_archives, write_archives

_BLANKS = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality and toxicity of every document; the host is its source, the path its language there."""
    judged = classify(
        read(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang"),
        read(spark, sf_dir, "labels"),
        host=F.col("source"),
        path=F.col("lang"),
        columns=["doc_id"],
    )
    return judged.select(
        "doc_id",
        F.round("quality", 6).alias("quality"),
        F.round("toxicity", 6).alias("toxicity"),
        "keep",
    )


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the passages of 50 words that an earlier document has."""
    kept = substring_dedup(read(spark, sf_dir, "documents").select("doc_id", "text"), window=50)
    text = F.coalesce(F.trim(F.regexp_replace("text", _BLANKS, " ")), F.lit(""))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(text, 256).alias("kept_sha256"))


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every 20th vector."""
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return tree_neighbours(vectors, F.col("vec_id") % 20 == 0, k=20)


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents linked by three quarters of their 5-word shingles, as components."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard_components(docs, n=5, similarity=(3, 4))


def tokenizer_path() -> str:
    """The public tokenizer that packing uses; its folder is the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as pieces of sequences of 4096 tokens."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = harmonic_pack(docs, tokenizer_path(), end_id=2, capacity=4096)
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as records of ZIP packages, written and read back."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    records = read_archives(write_archives(pages))
    payload = F.col("payload")
    return records.select(
        "page_id",
        F.coalesce(F.octet_length(payload).cast("long"), "payload_bytes").alias("payload_bytes"),
        F.coalesce(F.sha2(payload, 256), "payload_digest").alias("payload_digest"),
        "record_type",
        "refers_to",
    )


#: Arguments that a reply takes; longer replies and later turns break it.
REPLY = {
    "type": "object",
    "properties": {
        "text": {"type": "string", "minLength": 1, "maxLength": 1500},
        "turn": {"type": "integer", "minimum": 0, "maximum": 200},
    },
    "required": ["text", "turn"],
    "additionalProperties": False,
}


def tool_messages(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations as tool traffic: each assistant turn is a call that comes after the assistant
    turn two before it, the turns 5 and 7 also after the one four before; every other turn is the
    result of the call just before it, or of none, as first turns and those of the system are."""
    name = lambda turn: F.concat_ws(":", F.col("conv_id"), turn)
    is_call = F.coalesce(F.col("role") == "assistant", F.lit(False))
    turn = F.col("turn")
    earlier = F.array(name(turn - 2), F.when(turn.isin(5, 7), name(turn - 4)))
    calls = turns.where(is_call).select(
        "conv_id",
        name(turn).alias("call_id"),
        F.lit("reply").alias("name"),
        F.to_json(F.struct("turn", "text")).alias("arguments"),
        F.array_compact(earlier).alias("after"),
    )
    results = turns.where(~is_call).select(
        "conv_id", name(turn - 1).alias("call_id"), F.col("text").alias("content")
    )
    return calls, results


def op7_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of all conversations as linked calls and results, in order, as canonical JSON."""
    calls, results = tool_messages(read(spark, sf_dir, "conversations"))
    linked = link_tool_calls(calls, results, {"reply": REPLY})
    return linked.withColumn("errors", F.array_join("errors", "; "))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of documents inside 10-word windows of benchmark items."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    judged = decontaminate(docs, read(spark, sf_dir, "benchmark"), window=10, k=5)
    return judged.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def document_path() -> Column:
    """A place in a tree of files: source/language/folder/file, every 50th file a LICENSE."""
    name = F.when(F.col("doc_id") % 50 == 0, "LICENSE").otherwise(
        F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))
    )
    folder = F.concat(F.lit("f"), (F.col("doc_id") % 7).cast("string"))
    some = lambda c: F.coalesce(F.col(c), F.lit("unknown"))
    return F.concat_ws("/", some("source"), some("lang"), folder, name)


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licence of every document: its own, or that of the nearest directory above."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    return scan_licenses(docs, document_path())


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents shuffled into 24 shards, which are written and read back."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    rows = shuffle_shards(docs, shards=24)
    return rows.select(
        "doc_id",
        "size",
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit(LAW).alias("law"),
        "shard",
        "slot",
        "grown_shard",
    )


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as fill-in-the-middle examples, and their texts restored from those."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    rows = restore_text(fill_in_middle(docs, seed=1, percent=90, suffix_first_percent=20))
    return rows.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"),
    )


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words by which sources differ from their language, and distances between sources."""
    docs = read(spark, sf_dir, "documents").select("lang", "source", "text")
    return source_divergence(docs, least_docs=30, top=50)


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one of its copies that stays."""
    marks = mark_copies(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return marks.select(
        "doc_id",
        "keep_id",
        "group_size",
        "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


QUERIES = {
    "op1_quality": op1_quality,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_neighbours": op3_neighbours,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_packing": op5_packing,
    "op6_warc": op6_warc,
    "op7_tool_calls": op7_tool_calls,
    "op8_decontamination": op8_decontamination,
    "op9_licenses": op9_licenses,
    "op10_sharding": op10_sharding,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_source_divergence": op12_source_divergence,
    "op13_exact_dedup": op13_exact_dedup,
}

ORACLES = {
    "op2_substring_dedup": r"""
with words as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
), windows as (
  select doc_id, i, array_to_string(w[i:i + 49], ' ') as passage
  from (select doc_id, w, unnest(range(1, len(w) - 48)) as i from words where len(w) >= 50)
), firsts as (
  select passage, min(doc_id) as first_doc from windows group by passage
), gone as (
  select distinct doc_id, unnest(range(i, i + 50)) as p
  from windows join firsts using (passage) where first_doc < doc_id
), removed as (
  select doc_id, count(*) as n_removed, list(p) as ps from gone group by doc_id
)
select words.doc_id, cast(len(w) as bigint) as n_words,
  cast(coalesce(n_removed, 0) as bigint) as n_removed,
  sha256(array_to_string(case when ps is null then w
    else list_filter(w, lambda x, i: not list_contains(ps, i)) end, ' ')) as kept_sha256
from words left join removed using (doc_id)""",
    "op4_jaccard_join": r"""
with recursive words as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as w
  from documents
), shingles as (
  select distinct doc_id, array_to_string(w[i:i + 4], ' ') as s
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i
        from words where len(w) > 0)
), sizes as (
  select doc_id, count(*) as n from shingles group by doc_id
), common as (
  select a.doc_id as x, b.doc_id as y, count(*) as c
  from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id
  group by a.doc_id, b.doc_id
), links as (
  select x, y from common join sizes p on p.doc_id = x join sizes q on q.doc_id = y
  where 100 * c >= 75 * (p.n + q.n - c)
), reach(doc_id, other) as (
  select doc_id, doc_id from words
  union
  select r.doc_id, l.y from reach r join links l on l.x = r.other
)
select w.doc_id, cast(coalesce(any_value(s.n), 0) as bigint) as n_shingles,
  min(r.other) as component_id
from words w left join sizes s using (doc_id) join reach r using (doc_id)
group by w.doc_id""",
    "op6_warc": """
select page_id, cast(octet_length(encode(p)) as bigint) as payload_bytes,
  sha256(p) as payload_digest,
  case when first_id < page_id then 'revisit' else 'response' end as record_type,
  case when first_id < page_id then first_id end as refers_to
from (
  select page_id, p, case when octet_length(encode(p)) >= 100
    then min(page_id) over (partition by p) end as first_id
  from (select page_id, coalesce(html, '') as p from pages) t
) u""",
    "op8_decontamination": r"""
with items as (
  select item_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark
), windows as (
  select distinct item_id, least(len(w), 10) as n, array_to_string(w[i:i + 9], ' ') as s
  from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i
        from items where len(w) > 0)
), words as (
  select doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) as w
  from documents
), lengths as (
  select distinct n from windows
), places as (
  select doc_id, n, w, unnest(range(1, len(w) - n + 2)) as i from words, lengths where len(w) >= n
), found as (
  select doc_id, i, n, item_id
  from (select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') as s from places) p
  join windows using (n, s)
), hit as (
  select doc_id, count(distinct p) as n_hit
  from (select doc_id, unnest(range(i, i + n)) as p from found) t group by doc_id
), named as (
  select doc_id, count(*) as n_items,
    string_agg(cast(item_id as varchar), ',' order by cast(item_id as varchar)) as names
  from (select distinct doc_id, item_id from found) t group by doc_id
)
select words.doc_id, cast(len(w) as bigint) as n_words,
  cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
  sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from words left join hit using (doc_id) left join named using (doc_id)""",
    "op11_fill_in_middle": r"""
with hashed as (
  select doc_id, coalesce(text, '') as t, cast(length(coalesce(text, '')) as bigint) as n,
    sha256('1:' || cast(doc_id as varchar)) as h
  from documents
), drawn as (
  select doc_id, t, n,
    least(cast('0x' || substr(h, 1, 8) as bigint) % (n + 1),
      cast('0x' || substr(h, 9, 8) as bigint) % (n + 1)) as x,
    greatest(cast('0x' || substr(h, 1, 8) as bigint) % (n + 1),
      cast('0x' || substr(h, 9, 8) as bigint) % (n + 1)) as y,
    case when n = 0 or h is null or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>')
        or cast('0x' || substr(h, 17, 8) as bigint) % 100 >= 90 then 'plain'
      when cast('0x' || substr(h, 25, 8) as bigint) % 100 < 20 then 'spm' else 'psm' end as form
  from hashed
), cut as (
  select *, substring(t, 1, x) as p, substring(t, x + 1, y - x) as m, substring(t, y + 1) as s
  from drawn
)
select doc_id, n, form, case when form <> 'plain' then x end as prefix_chars,
  case when form <> 'plain' then y - x end as middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
    else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
  sha256(t) as restored_sha256
from cut""",
    "op12_source_divergence": r"""
with d as (
  select coalesce(lang, '') as lang, coalesce(source, '') as source, row_number() over () as r,
    regexp_extract_all(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as w
  from documents
), per_doc as (
  select lang, source, r, term, count(*) as n
  from (select lang, source, r, unnest(w) as term from d) t group by all
), kept as (
  select lang, term from per_doc group by lang, term having count(*) >= 30
), sizes as (
  select lang, count(*) as v from kept group by lang
), groups as (
  select distinct lang, source from d
), counts as (
  select lang, source, term, sum(n) as n from per_doc join kept using (lang, term) group by all
), cells as (
  select lang, g.source, term, coalesce(c.n, 0) as n
  from groups g join kept using (lang) left join counts c using (lang, source, term)
), source_p as (
  select lang, source, term, n, 1 + (cast(n + 5 as hugeint) * 1000000000)
    // cast(sum(n) over (partition by lang, source) + 5 * v as hugeint) as p
  from cells join sizes using (lang)
), lang_p as (
  select lang, term, 1 + (cast(n + 5 as hugeint) * 1000000000)
    // cast(sum(n) over (partition by lang) + 5 * v as hugeint) as q
  from (select lang, term, sum(n) as n from counts group by lang, term) t join sizes using (lang)
), sums as (
  select lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value
  from source_p a join source_p b using (lang, term) where a.source <> b.source
  group by lang, a.source, b.source
), parts as (
  select lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0) as value
  from groups a join groups b using (lang) left join sums s
    on s.lang = a.lang and s.source = a.source and s.item = b.source
  where a.source <> b.source
  union all
  select lang, source, 'term', term, p - q from source_p join lang_p using (lang, term)
  where n > 0 and p > q
), ranked as (
  select *, row_number() over (partition by lang, source, part order by value desc, item) as rank
  from parts
)
select lang, source, part, item, cast(value as bigint) as value, cast(rank as integer) as rank
from ranked where part = 'pair' or rank <= 50""",
    "op13_exact_dedup": r"""
select doc_id, min(doc_id) over same as keep_id, count(*) over same as group_size,
  doc_id = min(doc_id) over same as kept, sha256(t) as text_sha256
from (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t
      from documents) d
window same as (partition by t)""",
}
