"""The operators over their whole tables, as thin queries, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoquill.llm import archives, codes, conversations, decontaminate, fingerprints, katz, lines, neardup, packing, repeats, resample, token_files, toxicity
from geoquill.workspace import Workspace


def small_batches(spark: SparkSession) -> None:
    """Rows hold whole texts: few of them at a time go to Python."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of documents inside any occurrence of a benchmark window. Null and empty texts have no words, nor hits; repeated rows are reported each; without items nothing is hit."""
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of documents, written to files and read back. Null and empty texts have the end id alone; repeated ids stand side by side, ordered by text; an empty table gives no rows."""
    import public_tokenizers

    path = f"{Workspace(spark, 'token-files').root}"
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.read_token_files(spark, path)


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of documents and of their edited texts. Null is the empty text; of repeated ids each row has a fingerprint; a single document is its own next one."""
    return fingerprints.edit_fingerprints(table(spark, sf_dir, "documents"))


def op4_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and trigram backoff scores of documents. Null and empty texts are one end token; without training documents counts are 0; repeated rows count and are scored each."""
    return katz.held_out_scores(table(spark, sf_dir, "documents"), order=3)


def op5_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as WARC records, read back. Null html is the empty payload; a null page_id or url stays possible; of equal payloads the smallest page_id is the response, and so is each row that repeats it."""
    path = f"{Workspace(spark, 'archives').root}/warc"
    archives.write_archives(table(spark, sf_dir, "pages"), path)
    return archives.read_archives(spark, path)


def op6_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations that no longer one begins with, rendered. A null role is unknown, a null text empty; turns without conv_id belong to no conversation; of equal conversations one stays; an empty table gives no rows."""
    got = conversations.maximal_chats(table(spark, sf_dir, "conversations"))
    return got.select("conv_id", F.col("part").cast("long").alias("part"), "n_turns", "n_equal", F.sha2("text", 256).alias("text_sha256"), F.length("text").cast("long").alias("n_chars"))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents by shared 3-word shingles. Texts without words are linked with nothing; equal texts are one class, so repeats cost nothing; an empty table gives no rows."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), 3, 85)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of documents. Null and empty texts have a score too; documents without a label, or with a null one, are scored but not learned from; without labels every score is the same."""
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bucket, batch and slot of each document. Null and empty texts have length one; documents that tie in length may take each other's places; an empty table gives no rows."""
    docs = table(spark, sf_dir, "documents")
    return packing.pack(docs, packing.word_count(docs["text"]))


def op10_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each document, and those that go because an earlier line resembles them. A null text has one empty line; lines without letters and digits stay; rows that repeat id and text change alike."""
    return lines.line_report(table(spark, sf_dir, "documents"))


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of the longer documents, drawn towards the benchmark's words. Null and empty texts have no features; a null id ranks before others; repeated rows are scored and drawn each; an empty table gives no rows."""
    got = resample.draw(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 25, 20, 7, ["doc_id"])
    return got.select("doc_id", F.col("gq_features").alias("n_features"), F.col("gq_weight").alias("weight"), F.col("gq_score").alias("score"), F.col("gq_rank").alias("rank"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of vectors and their errors. Null vectors and those with null or non-finite components are dropped; a null label is a label; repeated rows are coded each; an empty table gives no rows."""
    rows, books = codes.compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "embedding", "vec_id", ["vec_id", "label"])
    rows = rows.select("vec_id", "label", codes.hex_code(F.col("gq_codes")).alias("code"), F.col("gq_error").alias("error"))
    got = codes.with_group_sum(rows, "label", "error", "label_error", Workspace(spark, "codes"))
    return got.select("vec_id", "code", "error", "label_error", F.lit(codes.digest(books)).alias("codebooks_sha256"))


def op13_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that an earlier document's passage covers, removed. Null and empty texts have no words; rows without id lose nothing and take nothing from others; rows of one id don't count as earlier than each other; an empty table gives no rows."""
    got = repeats.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), 13)
    return got.select("doc_id", F.col("gq_words").alias("n_words"), F.col("gq_removed").alias("n_removed"), F.sha2(F.coalesce("gq_kept", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def queries() -> dict:
    return {f.__name__: f for f in (op1_decontaminate, op2_token_files, op3_fingerprints, op4_katz, op5_archives, op6_chats, op7_near_duplicates, op8_toxicity, op9_packing, op10_lines, op11_resampling, op12_vector_codes, op13_repeats)}


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP1 = rf"""
with item_words as (
  select item_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark where text is not null and item_id is not null),
windows as (
  select distinct item_id, least(len(w), 10) as n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') as s
  from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from item_words where len(w) > 0)),
doc_words as (
  select row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
places as (
  select r, w, n, unnest(range(1, len(w) - n + 2)) as i from doc_words, (select distinct n from windows)),
hits as (
  select p.r, p.i, p.n, x.item_id from (select r, i, n, array_to_string(w[i:i + n - 1], ' ') as s from places) p join windows x on p.n = x.n and p.s = x.s),
hit_words as (select r, count(distinct k) as n_hit from (select r, unnest(range(i, i + n)) as k from hits) group by r),
hit_items as (
  select r, count(*) as n_items, string_agg(s, ',' order by s) as items from (select distinct r, cast(item_id as varchar) as s from hits) group by r)
select d.doc_id, cast(len(d.w) as bigint) as n_words, cast(coalesce(h.n_hit, 0) as bigint) as n_hit, cast(coalesce(t.n_items, 0) as bigint) as n_items,
  sha256(coalesce(t.items, '')) as items_sha256, coalesce(h.n_hit, 0) > 0 as contaminated
from doc_words d left join hit_words h using (r) left join hit_items t using (r)"""

OP5 = """
with p as (select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages),
f as (select payload_digest, min(page_id) as first_id from p where payload_bytes >= 100 group by 1)
select page_id, cast(payload_bytes as bigint) as payload_bytes, payload_digest,
  case when first_id is null or page_id = first_id then 'response' else 'revisit' end as record_type,
  case when page_id <> first_id then first_id end as refers_to
from p left join f using (payload_digest)"""

OP6 = r"""
with t as (select conv_id, turn, role, text, row_number() over (partition by conv_id order by turn nulls first, role nulls first, text nulls first) as place from conversations where conv_id is not null),
h as (select *, md5(cast(place as varchar) || '|' || coalesce('r' || role, 'null') || '|' || coalesce('t' || text, 'null')) as k from t),
pre as (select conv_id, place, md5(string_agg(k, ',') over (partition by conv_id order by place rows between unbounded preceding and current row)) as p from h),
whole as (select conv_id, max(place) as n, arg_max(p, place) as p from pre group by conv_id),
one as (select min(conv_id) as conv_id, n, p, count(*) as n_equal from whole group by n, p),
kept as (select * from one o where not exists (select 1 from pre join whole w using (conv_id) where pre.place < w.n and pre.place = o.n and pre.p = o.p)),
parts as (
  select k.conv_id, cast(floor(coalesce(t.turn, -1) / 64.0) as bigint) as part, cast(k.n as bigint) as n_turns, k.n_equal,
    string_agg('<|' || coalesce(t.role, 'unknown') || '|>' || chr(10) || coalesce(t.text, '') || chr(10) || '<|end|>' || chr(10), '' order by t.place) as text
  from kept k join t on t.conv_id = k.conv_id group by all)
select conv_id, part, n_turns, n_equal, sha256(text) as text_sha256, cast(length(text) as bigint) as n_chars from parts"""


OP7 = rf"""
with recursive w as (
  select row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') as w from documents),
s as (
  select distinct r, array_to_string(w[i:i + least(len(w), 3) - 1], ' ') as s
  from (select r, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) as i from w where len(w) > 0)),
n as (select r, count(*) as n from s group by r),
overlap as (select a.r as a, b.r as b, count(*) as x from s a join s b on a.s = b.s and a.r < b.r group by 1, 2),
links as (select a, b from overlap join n na on na.r = a join n nb on nb.r = b where 100 * x >= 85 * (na.n + nb.n - x)),
either as (select a, b from links union all select b, a from links),
reach(r, t) as (select r, r from w union select reach.r, either.b from reach join either on reach.t = either.a),
low as (select reach.r, min(w.doc_id) as c from reach join w on w.r = reach.t group by reach.r)
select w.doc_id, cast(coalesce(n.n, 0) as bigint) as n_shingles, low.c as component_id, w.doc_id = low.c as kept
from w left join n using (r) join low using (r)"""


#: crc32 by its table of 256 remainders, made from the polynomial; byte values from hexadecimal digits.
OP11 = rf"""
with t as (select list(list_reduce([k, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by k) as t from (select cast(range as bigint) as k from range(256))),
w as (
  select row_number() over () as r, 1 as side, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents
  union all select 0, 2, null, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') from benchmark),
f as (select side, r, unnest(w) as f from w union all select side, r, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) from w where len(w) > 1),
h as (select f, hex(encode(f)) as x from (select distinct f from f)),
b as (
  select f, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(x), 2), lambda i: 16 * (instr('0123456789ABCDEF', x[i]) - 1) + instr('0123456789ABCDEF', x[i + 1]) - 1)), lambda c, v: xor(c >> 8, t[(xor(c, v) & 255) + 1])), 4294967295) % 10000 as bucket from h, t),
n as (select side, r, bucket, count(*) as n from f join b using (f) group by all),
c as (select range as bucket, coalesce(s, 0) as s, coalesce(t, 0) as t from range(10000) left join (select bucket, sum(n) filter (side = 1) as s, sum(n) filter (side = 2) as t from n group by 1) m on m.bucket = range),
g as (select bucket, floor(1000 * ln(cast((t + 1) * (sum(s) over () + 10000) as double) / cast((s + 1) * (sum(t) over () + 10000) as double))) as gain from c),
d as (select r, sum(n) as n, cast(floor(sum(n * gain) / sum(n)) as bigint) as weight from n join g using (bucket) where side = 1 group by r),
s as (
  select w.r, w.doc_id, len(w.w) as words, cast(coalesce(d.n, 0) as bigint) as n_features, coalesce(weight, 0) as weight,
    coalesce(weight, 0) + cast(floor(-1000 * ln(-ln((cast('0x' || substr(sha256('7:' || coalesce(cast(doc_id as varchar), '')), 1, 8) as bigint) + 0.5) / 4294967296))) as bigint) as score
  from w left join d using (r) where side = 1),
o as (select r, row_number() over (order by score desc, doc_id nulls first) as rank, count(*) over () as n from s where words >= 20)
select doc_id, n_features, weight, score, case when rank <= 25 * n // 100 then rank end as rank from s left join o using (r)"""

_NEAREST = """{a} as (
  select r, part, v, entry, dist from (select r, part, v, entry, list_sum(list_transform(range(1, len(v) + 1), lambda i: (v[i] - c[i]) * (v[i] - c[i]))) as dist from p join {b} using (part))
  qualify row_number() over (partition by r, part order by dist, entry) = 1)"""
_MEANS = """{b} as (
  with m as (select part, entry, i, cast(floor(sum(x) / count(*)) as bigint) as x from (select part, entry, unnest(v) as x, generate_subscripts(v, 1) as i from {a}) group by all), n as (select part, entry, list(x order by i) as c from m group by all)
  select o.part, o.entry, coalesce(n.c, o.c) as c from {old} o left join n using (part, entry))"""
OP12 = f"""
with e as (
  select row_number() over (order by vec_id nulls last) - 1 as r, vec_id, label, list_transform(embedding, lambda x: cast(floor(256 * x) as bigint)) as v
  from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
p as (select r, part, v[part * len(v) // 16 + 1:(part + 1) * len(v) // 16] as v from (select r, v, unnest(range(16)) as part from e)),
b0 as (select part, r as entry, v as c from p where r < 64),
{_NEAREST.format(a="a0", b="b0")}, {_MEANS.format(a="a0", b="b1", old="b0")},
{_NEAREST.format(a="a1", b="b1")}, {_MEANS.format(a="a1", b="b2", old="b1")},
{_NEAREST.format(a="a2", b="b2")},
c as (select r, string_agg(lower(lpad(to_hex(entry), 2, '0')), '' order by part) as code, cast(sum(dist) as bigint) as error from a2 group by r),
k as (select sha256(string_agg(array_to_string(c, ','), ',' order by part, entry)) as k from b2)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, k as codebooks_sha256 from e join c using (r), k"""

OP13 = r"""
with w as (select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
win as (select r, doc_id, i, array_to_string(w[i:i + 12], ' ') as s from (select r, doc_id, w, unnest(range(1, len(w) - 11)) as i from w where doc_id is not null)),
f as (select s, min(doc_id) as first_id from win group by s),
gone as (select distinct r, k from (select r, unnest(range(i, i + 13)) as k from win join f using (s) where first_id < doc_id)),
each as (select r, unnest(w) as x, generate_subscripts(w, 1) as k from w),
kept as (select r, string_agg(x, ' ' order by k) as kept from each anti join gone using (r, k) group by r),
n as (select r, count(*) as n from gone group by r)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n, 0) as bigint) as n_removed, sha256(coalesce(kept, '')) as kept_sha256 from w left join n using (r) left join kept using (r)"""


def oracle_sql() -> dict[str, str]:
    return {"op11_resampling": OP11, "op12_vector_codes": OP12, "op13_repeats": OP13, "op7_near_duplicates": OP7, "op1_decontaminate": OP1, "op5_archives": OP5, "op6_chats": OP6}
