"""One query per operator, over its whole table, and the SQL that must agree."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from itemflow.llm.chat import rotate
from itemflow.llm.collocations import collocations
from itemflow.llm.common import SPACE_CLASS, table
from itemflow.llm.disclosure import BASE_KINDS, without_personal_data
from itemflow.llm.line_dedup import without_repeated_lines
from itemflow.llm.mixing import mixed_rows
from itemflow.llm.nn_descent import near_vectors
from itemflow.llm.periodic_runs import periodic_runs
from itemflow.llm.quality import CUTOFF, quality_verdicts
from itemflow.llm.simhash import near_duplicates
from itemflow.llm.substring_dedup import without_repeats
from itemflow.llm.toxicity import toxicity
from itemflow.llm.token_files import read_token_files, write_token_files
from itemflow.llm.unigram import encode_documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ["doc_id"])


@query
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = without_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLES["op2_substring_dedup"] = r"""
with words as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
windows as (
  select doc_id, unnest(range(1, len(w) - 18)) as i, w from words where len(w) >= 20),
named as (select doc_id, i, w[i:i + 19] as x from windows),
later as (
  select doc_id, i from (
    select doc_id, i, row_number() over (partition by x order by doc_id, i) as place from named) where place > 1),
gone as (select distinct doc_id, unnest(range(i, i + 20)) as p from later),
each as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as p from words),
kept as (
  select e.doc_id, string_agg(e.word, ' ' order by e.p) as k, count(*) as n
  from each e anti join gone g on e.doc_id = g.doc_id and e.p = g.p group by e.doc_id)
select d.doc_id, cast(len(d.w) as bigint) as n_words, cast(len(d.w) - coalesce(k.n, 0) as bigint) as n_removed,
  sha256(coalesce(k.k, '')) as kept_sha256
from words d left join kept k using (doc_id)
"""


@query
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed_rows(table(spark, sf_dir, "documents"))


@query
def op4_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rendered = rotate(table(spark, sf_dir, "conversations"))
    spans = F.transform("mask", lambda x: F.concat_ws("-", x["from"], x["to"]))
    return rendered.withColumn("mask", F.array_join(spans, ","))


ORACLES["op4_chat_rotation"] = r"""
with turns as (
  select conv_id, replace(coalesce(role, ''), '<|', '< |') as speaker, replace(coalesce(text, ''), '<|', '< |') as text,
    row_number() over (partition by conv_id order by turn nulls last, replace(coalesce(role, ''), '<|', '< |'), text) - 1 as number
  from conversations),
participants as (select distinct conv_id, speaker as participant from turns where lower(speaker) <> 'system'),
said as (
  select t.conv_id, p.participant, t.number // 128 as piece, t.number, t.speaker = p.participant as own,
    '<|im_start|>' || case when t.speaker = p.participant then 'assistant' when lower(t.speaker) = 'system' then 'system'
      else 'user name=' || t.speaker end || chr(10) as head,
    t.text || '<|im_end|>' || chr(10) as body
  from turns t join participants p on t.conv_id is not distinct from p.conv_id),
placed as (
  select *, sum(length(head) + length(body)) over (partition by conv_id, participant, piece order by number) as stop from said)
select conv_id, participant, cast(piece as bigint) as piece, count(*) as n_turns,
  string_agg(head || body, '' order by number) as text,
  string_agg(cast(stop - length(body) as bigint) || '-' || cast(stop as bigint), ',' order by number) filter (where own) as mask
from placed group by conv_id, participant, piece
"""


@query
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_verdicts(table(spark, sf_dir, "documents"), ["doc_id"], CUTOFF)


@query
def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), 0.93)


ORACLES["op6_embedding_near_dedup"] = """
with recursive v as (
  select vec_id, label, cast(embedding as double[]) as e from embeddings),
links as (
  select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id
  where list_cosine_similarity(a.e, b.e) >= 0.93),
reached as (
  select vec_id as a, vec_id as b from v union select r.a, l.b from reached r join links l on r.b = l.a),
parts as (select a as vec_id, min(b) as component_id from reached group by a),
counts as (select a as vec_id, count(*) as n from links group by a)
select p.vec_id, cast(coalesce(c.n, 0) as bigint) as n_links, p.component_id, p.vec_id = p.component_id as kept
from parts p left join counts c using (vec_id)
"""


@query
def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = near_duplicates(table(spark, sf_dir, "documents"), ["doc_id"], words=3, most=2)
    return marked.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = without_repeated_lines(table(spark, sf_dir, "documents"), ["doc_id"])
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = write_token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return read_token_files(files)


@query
def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    rows = table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = encode_documents(rows, model, ["doc_id"], check=True)
    return ids.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.crc32(F.concat_ws(" ", F.col("ids").cast("array<string>"))).alias("ids_crc32"),
        "round_trip",
    )


@query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLES["op11_collocations"] = r"""
with pieces as (
  select lang, row_number() over () as piece, regexp_extract_all(p, '[^\x20\x09]+') as w from (
    select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as p
    from documents)),
spots as (select lang, w, unnest(range(1, len(w) + 1)) as i from pieces),
grams as (
  select lang, words, array_to_string(w[i:i + words - 1], ' ') as phrase
  from spots, (values (1), (2), (3)) as sizes(words) where i + words - 1 <= len(w)),
counted as materialized (select lang, words, phrase, count(*) as f from grams group by all),
totals as (select lang, cast(sum(f) as bigint) as n from counted where words = 1 group by lang),
candidates as (select lang, words, phrase, f as a, string_split(phrase, ' ') as w from counted where words > 1 and f >= 10),
cuts as materialized (
  select lang, words, phrase, a, k, array_to_string(w[:k], ' ') as head, array_to_string(w[k + 1:], ' ') as tail
  from candidates, (values (1), (2)) as cut(k) where k < words),
heads as materialized (select c.*, f as l from cuts c join counted x on x.lang = c.lang and x.phrase = head),
scored as (
  select c.*, f as r, cast(1000000::hugeint * a * a // (l::hugeint * f) as bigint) as score
  from heads c join counted x on x.lang = c.lang and x.phrase = tail),
lowest as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
around as (
  select lang, phrase, max(a) as longer from (
    select lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) as phrase from candidates where words = 3)
  group by all),
kept as (
  select s.*, row_number() over (partition by s.lang order by score desc, a desc, s.phrase) as rank
  from lowest s left join around u on s.lang = u.lang and s.phrase = u.phrase and s.words = 2
  where u.longer is null or 100 * u.longer < 50 * s.a)
select k.lang, k.rank, k.phrase, k.a, k.l, k.r, t.n, k.score from kept k join totals t using (lang) where rank <= 2000
"""


def with_repeated_tails(docs: DataFrame) -> DataFrame:
    """Every tenth document repeats a passage from one of its words to its end."""
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.select("doc_id", "text", hashed.alias("h"))
    chosen = F.col("h") % 10 == 0
    words = F.filter(F.split("text", SPACE_CLASS + "+"), lambda w: w != "")
    rows = rows.withColumn("words", F.when(chosen, words)).withColumn("n", F.size("words"))
    rows = rows.withColumn("g", F.expr("h div 10")).withColumn("a", F.expr("cast(if(n > 0, g % n, 0) as int)"))
    rows = rows.withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)"))
    tail = "slice(flatten(array_repeat(slice(words, a + 1, p), cast(ceil((n - a) / p) as int))), 1, n - a)"
    changed = F.array_join(F.concat(F.expr("slice(words, 1, a)"), F.expr(tail)), " ")
    return rows.select("doc_id", F.when(chosen & (F.col("n") > 0), changed).otherwise(F.col("text")).alias("text"))


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_repeated_tails(table(spark, sf_dir, "documents")), ["doc_id"])
    most = F.array_min(F.transform("runs", lambda r: F.struct((-r.length / r.period).alias("e"), r.start, r.period, r.length)))
    lines = F.transform("runs", lambda r: F.concat(r.start, F.lit(","), r.length, F.lit(","), r.period, F.lit("\n")))
    rows = found.withColumn("most", most)
    return rows.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "most.start",
        "most.length",
        "most.period",
        F.expr("1000 * most.length div most.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed_text", 256).alias("collapsed_sha256"),
    )


ORACLES["op12_periodic_runs"] = r"""
with crc_table as (
  select list(list_reduce(list_prepend(i, range(8)), lambda c, _: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)
    order by i) as t
  from range(256) bytes(i)),
hashed as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
    xor(4294967295, list_reduce(
      list_prepend(4294967295, list_transform(string_split(cast(doc_id as varchar), ''), lambda c: cast(ascii(c) as bigint))),
      lambda c, b: xor(c >> 8, t[cast((xor(c, b) & 255) + 1 as int)]))) as h
  from documents, crc_table),
placed as (
  select doc_id, w, len(w) as n, h % 10 = 0 and len(w) > 0 as chosen, h // 10 as g,
    case when len(w) > 0 then (h // 10) % len(w) else 0 end as a from hashed),
words as (
  select doc_id, i, w[case when chosen and i >= a then a + (i - a) % (1 + (n - a) // (3 + g % 8)) else i end + 1] as word, n
  from (select *, unnest(range(n)) as i from placed)),
pairs as (
  select x.doc_id, x.i, y.i - x.i as q from words x join words y
  on x.doc_id = y.doc_id and x.word = y.word and x.i < y.i and 3 * (y.i - x.i) <= x.n),
stretches as (
  select doc_id, q, min(i) as start, count(*) + q as length from (
    select doc_id, i, q, i - row_number() over (partition by doc_id, q order by i) as part from pairs)
  group by doc_id, q, part having count(*) + q >= greatest(24, 3 * q)),
runs as (select doc_id, start, length, min(q) as period from stretches group by all),
best as (
  select * from runs
  qualify row_number() over (partition by doc_id order by length / period desc, start, period) = 1),
told as (
  select doc_id, count(*) as n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as lines
  from runs group by doc_id),
gone as (select distinct doc_id, unnest(range(start + period, start + length)) as i from runs),
kept as (
  select doc_id, string_agg(word, ' ' order by i) as k from words anti join gone using (doc_id, i) group by doc_id)
select d.doc_id, coalesce(t.n_runs, 0) as n_runs, cast(b.start as bigint) as start, cast(b.length as bigint) as length,
  cast(b.period as bigint) as period, cast(1000 * b.length // b.period as bigint) as exponent_milli,
  sha256(coalesce(t.lines, '')) as runs_sha256, sha256(coalesce(k.k, '')) as collapsed_sha256
from documents d left join told t using (doc_id) left join best b using (doc_id) left join kept k using (doc_id)
"""


def _told(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")


@query
def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_personal_data(table(spark, sf_dir, "documents"), ["doc_id"])
    counts = [F.size(F.expr(f"filter(spans, s -> s.kind = '{k}')")).cast("bigint").alias(f"n_{k}") for k in BASE_KINDS]
    base = F.filter("spans", lambda s: s.kind != "term")
    return found.select("doc_id", *counts, F.sha2(_told(base), 256).alias("base_sha256"), _told(F.col("spans")).alias("spans"))
