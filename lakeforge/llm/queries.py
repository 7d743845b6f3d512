"""One query for each numbered operator, over whole tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeforge.llm import bpe, dualtree, hostrules, itq, langid, minhash, mixing, pfor, phrases, pii, preference, topk, toxicity
from lakeforge.llm.common import shared_folder, table


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixed.select(F.col("did").alias("doc_id"), "size", "source_size", "target", "taken")


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(topk.quantised(table(spark, sf_dir, "embeddings")), F.col("vec_id") % 20 == 0)


def op3_itq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return itq.near_duplicates(table(spark, sf_dir, "embeddings"))


def op4_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations 2n (chosen) and 2n + 1 (rejected) are a pair."""
    c = table(spark, sf_dir, "conversations")
    return preference.format_pairs(c.select(F.shiftright("conv_id", 1).alias("pair_id"), (F.col("conv_id") % 2 == 0).alias("chosen"), "turn", "role", "text"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op6_pfor(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/shards-{uuid.uuid4().hex}"
    pfor.write_shards(table(spark, sf_dir, "documents"), path, tokenizer_path(), end_id=2)
    return pfor.read_shards(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer_path()))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    said = langid.predict(docs, langid.learn(docs))
    return said.select("doc_id", (~langid.teaches(F.col("doc_id")) & F.col("doc_id").isNotNull()).alias("held_out"), "lang_pred", "score")


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_dualtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dualtree.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(table(spark, sf_dir, "documents"))


def op13_hostrules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The host of a document is its source."""
    judged = hostrules.judged(table(spark, sf_dir, "documents"), F.col("source"), keep=("doc_id",))
    return judged.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


QUERIES = {f.__name__: f for f in (op1_mixing, op2_topk, op3_itq, op4_preference, op5_pii, op6_pfor, op7_bpe, op8_toxicity, op9_langid, op10_minhash, op11_dualtree, op12_phrases, op13_hostrules)}

ORACLES = {
    "op4_preference": r"""
with t as (
  select conv_id >> 1 as pair_id, conv_id % 2 = 0 as chosen, coalesce(role, '') as role, coalesce(text, '') as text,
    row_number() over (partition by conv_id order by turn nulls first, role nulls first, text nulls first) as pos
  from conversations where conv_id is not null),
both_sides as (select pair_id from t group by pair_id having count(distinct chosen) = 2),
same as (
  select a.pair_id, a.pos from t a join t b on a.pair_id = b.pair_id and a.pos = b.pos and a.role = b.role and a.text = b.text
  where a.chosen and not b.chosen),
prefix as (
  select pair_id, count(*) as n from (select pair_id, pos, row_number() over (partition by pair_id order by pos) as k from same)
  where pos = k group by pair_id),
turns as (
  select t.*, coalesce(n, 0) as n, '<|' || role || '|>' || chr(10) as head, replace(text, '<|', '< |') as body
  from t join both_sides using (pair_id) left join prefix using (pair_id)),
rendered as (select *, head || body || '<|end|>' || chr(10) as r from turns),
placed as (
  select *, coalesce(sum(length(r)) over (partition by pair_id, chosen order by pos rows between unbounded preceding and 1 preceding), 0) as pos_before
  from rendered where pos > n)
select p.pair_id, cast(p.n as integer) as prompt_turns, p.prompt,
  coalesce(a.r, '') as chosen, coalesce(a.s, '') as chosen_spans, coalesce(b.r, '') as rejected, coalesce(b.s, '') as rejected_spans
from (select pair_id, max(n) as n, coalesce(string_agg(case when pos <= n and chosen then r end, '' order by pos), '') as prompt from rendered group by pair_id) p
left join (select pair_id, string_agg(r, '' order by pos) as r, string_agg(case when role = 'assistant' then cast(pos_before + length(head) as bigint)::varchar || ':' || cast(pos_before + length(head) + length(body) + 7 as bigint)::varchar end, ',' order by pos) as s from placed where chosen group by pair_id) a on p.pair_id = a.pair_id
left join (select pair_id, string_agg(r, '' order by pos) as r, string_agg(case when role = 'assistant' then cast(pos_before + length(head) as bigint)::varchar || ':' || cast(pos_before + length(head) + length(body) + 7 as bigint)::varchar end, ',' order by pos) as s from placed where not chosen group by pair_id) b on p.pair_id = b.pair_id
""",
    "op11_dualtree": r"""
with terms as (
  select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from documents),
tf as (select doc_id, term, count(*) as tf from terms group by all),
lengths as (select doc_id, sum(tf)::bigint as n from tf group by all),
corpus as (select count(*) as docs, sum(n)::bigint as words from lengths),
asked as (select distinct item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark),
weights as (
  select term, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)))::bigint as w
  from tf, corpus group by term, docs),
scores as (
  select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // words))))::bigint as score
  from asked join weights using (term) join tf using (term) join lengths using (doc_id), corpus group by all)
select item_id, rank, doc_id, score
from (select *, row_number() over (partition by item_id order by score desc, doc_id)::int as rank from scores where score > 0)
where rank <= 50
""",
    "op12_phrases": r"""
with pieces as (
  select coalesce(lang, 'und') as lang, row_number() over () as id,
    unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
w as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
p as (
  select lang, k, array_to_string(w[i : i + k - 1], ' ') as phrase
  from (select lang, w, k, unnest(range(1, len(w) - k + 2)) as i from w, range(1, 6) t(k))),
f as (select lang, k, phrase, count(*) as f from p group by all having count(*) >= 100),
total as (select lang, sum(len(w))::bigint as n from w group by all),
cuts as (
  select f.lang, f.k, phrase, f as a, n, cut, array_to_string(string_split(phrase, ' ')[: cut], ' ') as first, array_to_string(string_split(phrase, ' ')[cut + 1 :], ' ') as rest
  from f join total using (lang), range(1, 5) t(cut) where cut < k),
scored as (
  select c.lang, c.k, c.phrase, a, n, cut, x.f as l, y.f as r, ((1000::hugeint * a * n) // (x.f::hugeint * y.f))::bigint as score
  from cuts c join f x on x.lang = c.lang and x.phrase = c.first join f y on y.lang = c.lang and y.phrase = c.rest),
best as (select * from scored qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
longer as (
  select lang, f, unnest([array_to_string(string_split(phrase, ' ')[: k - 1], ' '), array_to_string(string_split(phrase, ' ')[2 :], ' ')]) as phrase
  from f where k > 2),
left_over as (select * from best b where not exists (select 1 from longer x where x.lang = b.lang and x.phrase = b.phrase and x.f >= b.a))
select lang, rank, phrase, a, l, r, n, score
from (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from left_over)
where rank <= 2000
""",
    "op13_hostrules": r"""
with words as (
  select doc_id, source as host, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines,
    row_number() over () as id
  from documents),
windows as (
  select id, i, array_to_string(w[i : i + 4], ' ') as x
  from (select id, w, unnest(range(1, len(w) - 3)) as i from words)),
twice as (select id, i, lead(i) over (partition by id order by i) as following from (select id, i, count(*) over (partition by id, x) as m from windows) where m > 1),
repeats as (select id, sum(least(5, coalesce(following - i, 5)))::bigint as n from twice group by id),
measured as (
  select words.id, doc_id, host, len(w) as n_words, coalesce(len(array_to_string(w, '')), 0) as word_chars, len(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as n_symbols,
    len(lines) as n_lines, len(lines) - len(list_distinct(lines)) as n_dup_lines, coalesce(n, 0) as n_repeat_words
  from words left join repeats using (id)),
failed as (
  select *, n_words < 10 as r1, 100 * n_repeat_words > 20 * n_words as r2, 10 * n_symbols > n_words as r3,
    n_words > 0 and (word_chars < 3 * n_words or word_chars > 10 * n_words) as r4, 100 * n_dup_lines > 30 * n_lines as r5
  from measured),
long as (select id, host, rule, bad from failed unpivot (bad for rule in (r1, r2, r3, r4, r5)) where host is not null),
hosts as (select host, rule, count(*)::double as n, count(*) filter (bad)::double as f from long group by all),
moments as (select rule, count(*) as hosts, sum(n) as n, sum(n * n) as squares, sum(f * f / n) as spread, sum(f) / sum(n) as mean from hosts group by rule),
alike as (
  select rule, mean, case when hosts < 2 or mean * (1 - mean) <= 0 or n - squares / n - (hosts - 1) <= 0 then null
    else (spread - n * mean * mean - mean * (1 - mean) * (hosts - 1)) / (mean * (1 - mean) * (n - squares / n - (hosts - 1))) end as alike
  from moments),
priors as (select rule, mean, case when alike is null then 1e6 when alike >= 1 then 0 else 1 / greatest(alike, 1e-6) - 1 end as strength from alike),
shrunk as (select host, rule, n + strength as weight, (f + mean * strength) / (n + strength) as p, mean from hosts join priors using (rule)),
rates as (select host, rule, p - sqrt(p * (1 - p) / (weight + 1)) as rate, mean from shrunk),
verdicts as (select host, max(rate) >= 0.5 as rejected, list(rule) filter (rate >= greatest(0.1, 2 * mean)) as strict from rates group by host)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, r1 or r2 as base_failed,
  not (r1 or r2 or coalesce(rejected, false) or (r1 and coalesce(list_contains(strict, 'r1'), false)) or (r2 and coalesce(list_contains(strict, 'r2'), false))
    or (r3 and coalesce(list_contains(strict, 'r3'), false)) or (r4 and coalesce(list_contains(strict, 'r4'), false)) or (r5 and coalesce(list_contains(strict, 'r5'), false))) as kept
from failed left join verdicts using (host)
""",
}
