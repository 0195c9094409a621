"""One query per operator, over its whole intended table, with production
parameters. ``QUERIES`` and ``ORACLE`` are what ``__spark_entry__`` adds."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeops.llm.bestfit import pack_best_fit
from lakeops.llm.bm25 import build_index, search as search_text
from lakeops.llm.bpe import bpe_encode
from lakeops.llm.common import held_out, table, tokenizer
from lakeops.llm.language import fit_language, identify_language
from lakeops.llm.licenses import scan_licenses
from lakeops.llm.packing import pack
from lakeops.llm.passages import duplicate_passages
from lakeops.llm.prefixtrie import conversation_pieces, prefix_trie, share_heads
from lakeops.llm.resampling import resample
from lakeops.llm.simhash import near_duplicates
from lakeops.llm.tokencount import count_tokens
from lakeops.llm.toxicity import fit_toxicity, score_toxicity
from lakeops.llm.vectors import search
from lakeops.session import materialize

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

WORD_BPE, PIECE_BPE, BYTE_BPE = "word_bpe_49k.json", "piece_bpe_32k.model", "byte_bpe_50k.json"


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text encoded, then decoded; digests of both."""
    docs = table(spark, sf_dir, "documents")
    both = bpe_encode(docs, tokenizer(WORD_BPE), decode=True)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text's toxicity, learned from labels outside the held-out third."""
    docs = table(spark, sf_dir, "documents")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    scored = score_toxicity(docs, model)
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"), "offending")


@query
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text's language, learned from documents outside the held-out third."""
    docs = table(spark, sf_dir, "documents")
    model = fit_language(docs, tokenizer(PIECE_BPE))
    return identify_language(docs, model).select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


@query
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and near-duplicate component."""
    found = near_duplicates(table(spark, sf_dir, "documents"), shingle=4, radius=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2048 tokens along the curve."""
    pieces = pack(table(spark, sf_dir, "documents"), tokenizer(WORD_BPE), end_id=1, length=2048)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every vector whose id is divisible by 20."""
    return search(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20)


@query
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that nearly repeat one of an earlier document."""
    return duplicate_passages(table(spark, sf_dir, "documents"), min_words=50, similarity=0.8)


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of ``corpus_pipeline`` over documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


@query
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy word-piece counts of every whole text."""
    return count_tokens(table(spark, sf_dir, "documents"), tokenizer(PIECE_BPE))


@query
def op9_bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 documents that score best for each benchmark item whose id is divisible by 20."""
    index = materialize(build_index(table(spark, sf_dir, "documents")), "bm25-index")
    asked = table(spark, sf_dir, "benchmark").where(F.col("item_id") % 20 == 0)
    return search_text(index, asked, k=20).withColumn("score", F.round("score", 6))


ORACLE["op9_bm25"] = r"""
with docs as (select doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') as words from documents where doc_id is not null),
about as (select count(*) as n, avg(len(words)) as mean from docs),
asked as (select item_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+')) as word from benchmark where item_id % 20 = 0),
terms as (select item_id, word, count(*) as times from asked group by all),
postings as (select doc_id, len_, word, count(*) as tf from (select doc_id, len(words) as len_, unnest(words) as word from docs)
  where word in (select word from terms) group by all),
freq as (select word, count(*) as df from postings group by word),
scored as (select item_id as query_id, doc_id, round(sum(times * ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len_ / mean))), 6) as score
  from terms join postings using (word) join freq using (word) cross join about group by item_id, doc_id),
ranked as (select query_id, cast(row_number() over (partition by query_id order by score desc, doc_id) as integer) as rank, doc_id, score from scored)
select * from ranked where rank <= 20
"""


@query
def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in every whole text."""
    return scan_licenses(table(spark, sf_dir, "documents"), containment=0.8)

#: CRC32 of a list of byte values (named b), in DuckDB's lambdas.
_CRC = """xor(list_reduce(list_prepend(4294967295::bigint, b), lambda c, x: list_reduce(list_prepend(xor(c, x::bigint), range(8)), lambda a, i: xor(a >> 1, 3988292384 * (a & 1)))), 4294967295)"""


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all conversations, rebuilt with shared heads."""
    pieces = conversation_pieces(table(spark, sf_dir, "conversations"))
    return prefix_trie(share_heads(pieces, every=20, most=3))


ORACLE["op11_prefix_trie"] = rf"""
with turns as (select conv_id, list(struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) order by turn nulls first, role, text) as turns
  from conversations where conv_id is not null group by conv_id),
heads as (select conv_id, turns, (select {_CRC} from (select list_transform(string_split(cast(conv_id as varchar), ''), lambda x: ascii(x)) as b)) % 4 as h from turns),
rebuilt as (select a.conv_id, list_concat(coalesce(b.turns[1:a.h], []), a.turns[a.h + 1:]) as turns
  from heads a left join turns b on b.conv_id = a.conv_id - a.conv_id % 20),
steps as (select conv_id, turns, unnest(range(0, len(turns) + 1)) as depth from rebuilt),
paths as (select conv_id, depth, min(conv_id) over (partition by depth, turns[1:depth]) as low, depth = len(turns) as ends,
  case when depth > 0 then len(regexp_extract_all(turns[depth].t, '[^ 	-]+')) else 0 end as words from steps),
nodes as (select depth, low, count(*) as n, any_value(words) as words, coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (ends), '') as ended from paths group by depth, low),
parents as (select n.*, p.low as parent from nodes n left join paths p on p.conv_id = n.low and p.depth = n.depth - 1),
children as (select parent as low, depth - 1 as depth, count(*) as children from parents where depth > 0 group by all),
own as (select p.*, coalesce(c.children, 0) as children from parents p left join children c using (depth, low)),
totals as (select p.depth, p.low, sum((o.children = 0)::int) as leaves, sum((o.n - 1) * o.words) as saved from own o join paths p on p.conv_id = o.low and p.depth <= o.depth group by all)
select low as conv_id, depth, parent as parent_conv_id, n as n_convs, children as n_children, cast(leaves as bigint) as n_leaves, cast(saved as bigint) as saved_tokens, sha256(ended) as ends_sha256
from own join totals using (depth, low)
"""


@query
def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the documents of 20 words or more, drawn towards the benchmark's words."""
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), percent=10, max_words=1, buckets=10_000, seed=2024, least_words=20)


ORACLE["op12_resampling"] = rf"""
with words as (select 'd' as side, doc_id as id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from documents
  union all select 'b', item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') from benchmark),
each as (select side, id, unnest(words) as word from words),
distinct_words as (select distinct word from each),
bytes as (select word, list_transform(range(0, octet_length(encode(word))), lambda i: cast('0x' || substr(hex(encode(word)), cast(2 * i + 1 as int), 2) as bigint)) as b from distinct_words),
buckets as (select word, {_CRC} % 10000 as bucket from bytes),
counted as (select side, bucket, count(*) as n from each join buckets using (word) group by all),
sides as (select bucket, coalesce(sum(n) filter (side = 'd'), 0)::double as s, coalesce(sum(n) filter (side = 'b'), 0)::double as t from counted group by bucket),
about as (select sum(s) as all_s, sum(t) as all_t from sides),
gains as (select bucket, floor(1000 * ln((t + 1) * (all_s + 10000) / ((s + 1) * (all_t + 10000)))) as gain from sides, about),
weights as (select id, cast(floor(sum(gain) / count(*)) as bigint) as weight from each join buckets using (word) join gains using (bucket) where side = 'd' group by id),
scored as (select w.id as doc_id, len(w.words) as n_features, coalesce(weight, 0) as weight,
  coalesce(weight, 0) + cast(floor(-1000 * ln(-ln((cast('0x' || substr(sha256('2024:' || w.id), 1, 8) as bigint) + 0.5::double) / 4294967296))) as bigint) as score
  from words w left join weights using (id) where w.side = 'd'),
ranked as (select doc_id, row_number() over (order by score desc, doc_id) as rank from scored where n_features >= 20)
select doc_id, cast(n_features as bigint) as n_features, weight, score, case when rank <= (select count(*) from ranked) * 10 // 100 then rank end as rank from scored left join ranked using (doc_id)
"""


@query
def op13_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in as few sequences of 1024 tokens as can be."""
    pieces = pack_best_fit(table(spark, sf_dir, "documents"), tokenizer(BYTE_BPE), end_id=2, length=1024)
    return pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")
