"""The registered queries of this package, and the SQL that checks those which SQL can express."""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from .bitplanes import document_digests, read_pieces, write_tokens
from .conversation_repair import repair, summary
from .decontamination import decontaminate
from .entropy_mixing import mix
from .fill_in_middle import fill_in_middle, restore
from .jaccard_join import link
from .lm_scoring import cross_entropy_difference
from .pairwise_quality import CUT, featurize, fit as fit_ranking, score
from .paragraph_dedup import repeated_passages
from .pii import BASE_KINDS, candidates, fit as fit_spans, personal_spans
from .simhash_pigeonhole import fingerprints, near_duplicates
from .store import written
from .url_rules import judge_urls
from .weak_rules import METRIC, fit, judge, measure

QUERIES = {}
CHECKS = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def query(sql: str | None = None):
    """Registers a query under its function's name, with its checking SQL."""
    def register(build):
        QUERIES[build.__name__] = build
        if sql:
            CHECKS[build.__name__] = sql
        return build

    return register


@query("""
with w as (select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w,
      doc_id in (select doc_id from labels where quality = 1) as target from documents),
t as (select doc_id, target, unnest(w) as word, unnest(range(1, len(w) + 1)) as i from w),
c as (select word, count(*) as b, count(*) filter (target) as t from t group by word),
n as (select cast(sum(b) as double) as nb, cast(sum(t) as double) as nt from c),
v as (select word, b, t from c, n where b >= 2 and b >= 1e-6 * nb),
u as (select word, b, t from v union all select null, (select nb from n) - coalesce(sum(b), 0), (select nt from n) - coalesce(sum(t), 0) from v),
p as (select u.word, (b + 1) / (nb + (select count(*) from u)) as pb, (t + 1) / (nt + (select count(*) from u)) as pt,
             case when u.word is not null and b >= 1e-3 * nb then u.word end as class from u, n),
o as (select sum(pb) as ob, sum(pt) as ot from p where class is null),
k as (select count(distinct class) + 1 as k from p),
x as (select doc_id, i, target, pb, pt, class, case when class is null then pb / ob else 1 end as wb, case when class is null then pt / ot else 1 end as wt
      from t left join v using (word) join p on p.word is not distinct from v.word, o),
y as (select *, case when lag(i) over (partition by doc_id order by i) is null then ' start' else coalesce(lag(class) over (partition by doc_id order by i), ' other') end as before, coalesce(class, ' other') as now from x),
g as (select before, now, count(*) as gb, count(*) filter (target) as gt from y group by all),
f as (select before, sum(gb) as fb, sum(gt) as ft from g group by before),
z as (select doc_id, -ln(0.5 * (gb + 1) / (fb + k) * wb + 0.5 * pb) as lb, -ln(0.5 * (gt + 1) / (ft + k) * wt + 0.5 * pt) as lt
      from y join g using (before, now) join f using (before), k),
s as (select doc_id, count(*) as n, avg(lb) as lb, avg(lt) as lt from z group by doc_id)
select d.doc_id, coalesce(n, 0) as n_tokens, round(lt, 6) as target_loss, round(lb, 6) as background_loss, round(lt - lb, 6) as difference from documents d left join s using (doc_id)
""")
def op1_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    scored = cross_entropy_difference(table(spark, folder, "documents"), table(spark, folder, "labels").filter("quality = 1"))
    return scored.withColumns({c: F.round(c, 6) for c in ("target_loss", "background_loss", "difference")})


#: Fixed values of the token output: the tokenizer's file, and the id that ends a document.
TOKENIZER, END_ID, ID_BITS = "word_bpe_49k.json", 2, 16


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def token_output(docs: DataFrame) -> DataFrame:
    """Write the token store of ``docs`` and return each document's digest from the files."""
    spark = docs.sparkSession
    folder = f"{checkpoint_dir(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    write_tokens(docs, folder, tokenizer_path(), END_ID, width=ID_BITS)
    return document_digests(read_pieces(spark, folder, with_ids=False))


@query()
def op2_bitplanes(spark: SparkSession, folder: str) -> DataFrame:
    return token_output(table(spark, folder, "documents"))


@query()
def op3_pairwise_quality(spark: SparkSession, folder: str) -> DataFrame:
    features = written(featurize(table(spark, folder, "documents")), "features")
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))
    ranking = fit_ranking(features, table(spark, folder, "labels").filter(~held_out).select("doc_id", "quality"))
    scored = features.select("doc_id", held_out.alias("held_out"), score(ranking).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= CUT).cast("int"))


@query("""
with recursive w as (select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w from documents),
s as (select distinct doc_id, array_to_string(w[i:i + 4], ' ') as shingle from (select *, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from w where len(w) > 0)),
n as (select doc_id, count(*) as n from s group by doc_id),
pairs as (select a.doc_id as x, b.doc_id as y, count(*) as n_both from s a join s b using (shingle) where a.doc_id <> b.doc_id group by all),
links as (select x, y from pairs join n a on a.doc_id = x join n b on b.doc_id = y where 100 * n_both >= 75 * (a.n + b.n - n_both)),
reach(x, y) as (select doc_id, doc_id from documents union select reach.x, links.y from reach join links on links.x = reach.y)
select d.doc_id, cast(coalesce(n.n, 0) as bigint) as n_shingles, c.component_id, cast(coalesce(l.n_links, 0) as bigint) as n_links
from documents d left join n using (doc_id) join (select x as doc_id, min(y) as component_id from reach group by x) c using (doc_id)
left join (select x as doc_id, count(*) as n_links from links group by x) l using (doc_id)
""")
def op4_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return link(table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id", "n_links")


@query()
def op5_weak_rules(spark: SparkSession, folder: str) -> DataFrame:
    measured = written(measure(table(spark, folder, "documents").select("doc_id", "text")).drop("text"), "quality-metrics")
    judged = judge(measured, fit(measured))
    m, v = F.col(METRIC), F.col("_verdict")
    return judged.select(
        "doc_id", *[m[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        v.base_failed.alias("base_failed"), v.kept.alias("kept"), v.quality_probability.alias("quality_probability"))


@query()
def op6_entropy_mixing(spark: SparkSession, folder: str) -> DataFrame:
    m = F.col("_mix")
    return mix(table(spark, folder, "documents").select("doc_id", "text", "source")).select(
        "doc_id", m["size"].alias("size"), m.source_size.alias("source_size"), m.target.alias("target"), (m["size"] * m.copies).alias("taken"))


@query("""
with w as (select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') as w from documents),
b as (select item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') as w from benchmark),
bw as (select distinct item_id, n, array_to_string(w[i:i + n - 1], ' ') as pattern
       from (select *, unnest(range(1, len(w) - n + 2)) as i from (select *, least(10, len(w)) as n from b where len(w) > 0))),
lengths as (select distinct n from bw),
dw as (select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') as pattern
       from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from w, lengths where len(w) >= n)),
hits as (select distinct doc_id, dw.n, i, item_id from dw join bw using (n, pattern)),
hit_words as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + n)) as p from hits) group by doc_id),
items as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as ids from (select distinct doc_id, cast(item_id as varchar) as item from hits) group by doc_id)
select w.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from w left join hit_words using (doc_id) left join items using (doc_id)
""")
def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate(table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "benchmark"))
    hit = F.col("decontamination")
    return found.select(
        "doc_id", hit.n_words.alias("n_words"), hit.n_hit.alias("n_hit"), F.size(hit["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(hit["items"], ","), 256).alias("items_sha256"), (hit.n_hit > 0).alias("contaminated"))


@query()
def op8_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = written(candidates(table(spark, folder, "documents").select("doc_id", "text")).drop("text"), "pii-spans")
    spans = found.select("doc_id", personal_spans(fit_spans(found)).alias("s"))
    base = F.filter("s", lambda s: s["base"])

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return spans.select(
        "doc_id", *map(number, BASE_KINDS),
        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("s")).alias("spans"))


#: Fixed values of the query: action, host, path.
URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]


@query("""
with rules(action, host, path) as (values ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
rest as (select page_id, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
parts as (select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
                 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from rest),
fits as (select page_id, r.host || r.path as rule, action, row_number() over (partition by page_id order by length(r.host || r.path) desc) as rank
         from parts p join rules r on (p.host = r.host or ends_with(p.host, '.' || r.host)) and starts_with(p.path, r.path))
select p.page_id, p.host, p.path, f.rule, coalesce(f.action, 'allow') as verdict
from parts p left join fits f on p.page_id = f.page_id and rank = 1
""")
def op9_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "action string, host string, path string")
    return judge_urls(table(spark, folder, "pages").select("page_id", "url"), rules)


@query()
def op10_paragraph_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_passages(table(spark, folder, "documents"))


@query()
def op12_simhash_pigeonhole(spark: SparkSession, folder: str) -> DataFrame:
    found = near_duplicates(written(fingerprints(table(spark, folder, "documents")), "simhash"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


@query("""
with d as (select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as units, sha256('1:' || coalesce(cast(doc_id as varchar), '')) as h from documents),
c as (select *, len(units) as n, cast('0x' || substr(h, 1, 8) as bigint) % (len(units) + 1) as a, cast('0x' || substr(h, 9, 8) as bigint) % (len(units) + 1) as b from d),
p as (select doc_id, text, n, array_to_string(units[1:least(a, b)], '') as prefix, array_to_string(units[least(a, b) + 1:greatest(a, b)], '') as middle, array_to_string(units[greatest(a, b) + 1:], '') as suffix,
             case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or cast('0x' || substr(h, 17, 8) as bigint) % 100 >= 90 then 'plain'
                  when cast('0x' || substr(h, 25, 8) as bigint) % 100 < 20 then 'spm' else 'psm' end as form from c)
select doc_id, cast(n as bigint) as n, form, case when form <> 'plain' then length(prefix) end as prefix_chars, case when form <> 'plain' then length(middle) end as middle_chars,
       sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
       sha256(text) as restored_sha256
from p
""")
def op13_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    cut = restore(fill_in_middle(table(spark, folder, "documents").select("doc_id", "text")))
    fim = F.col("fim")
    return cut.select(
        "doc_id", fim.n.alias("n"), fim.form.alias("form"), fim.prefix_chars.alias("prefix_chars"), fim.middle_chars.alias("middle_chars"),
        F.sha2(fim.output, 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


def damaged(conversations: DataFrame) -> DataFrame:
    """The query's input: rows damaged by their key's crc32 modulo 20; nulls are one space."""
    text, role = (F.coalesce(F.col(c), F.lit(" ")) for c in ("text", "role"))
    key = F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c else F.lit(":") for c in ("conv_id", "", "turn")])
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(key.cast("binary")) % 20).alias("kind")).filter("kind <> 0")
    broken = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), broken.alias("text"), copies.alias("copy"))


def _repair_sql() -> str:
    """Dynamic programming over rows: k0 to k3 hold, for each state, cost, audit and repaired turns as one comparable text."""
    def add(k: str, cost: str, letter: str, line: str = "''") -> str:
        return (f"printf('%06d', cast(substr({k}, 1, 6) as int) + {cost}) || substr({k}, 7, strpos({k}, chr(1)) - 7) || '{letter}' || chr(1)"
                f" || substr({k}, strpos({k}, chr(1)) + 1) || {line}")

    user, assistant = "'user:' || chr(10)", "'assistant:' || chr(10)"
    kept, new_user, new_assistant = "role || ':' || text || chr(10)", "'user:' || text || chr(10)", "'assistant:' || text || chr(10)"

    def keep(k: str, initial: str) -> str:
        return f"case when not gone and left(role, 1) = '{initial}' then {add(k, 'cut', 'K', kept)} end"

    def rerole(k: str, line: str) -> str:
        return f"case when not gone then {add(k, '2 + cut', 'R', line)} end"

    return f"""
with recursive keyed as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') as key from conversations),
hashed as (select *, xor(list_reduce(list_concat([4294967295], list_transform(range(1, length(key) + 1), lambda i: cast(ascii(substr(key, i, 1)) as bigint))),
             lambda c, b: list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, z: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) % 20 as kind from keyed),
rows as (select conv_id, turn, case when kind = 4 then 'user' else role end as role, case kind when 1 then '' when 2 then translate(text, '.!?', '') else text end as text,
           unnest(case when kind = 3 then [1, 2] else [1] end) as copy from hashed where kind <> 0),
numbered as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text, copy) as i from rows),
seen as (select *, regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) as last, row_number() over (partition by conv_id, role, text order by i) as nth from numbered),
faults as (select *, last = '' or nth > 1 as gone, case when last not in ('.', '!', '?') then 1 else 0 end as cut, lag(left(role, 1)) over (partition by conv_id order by i) || left(role, 1) as two from seen),
walk as (
  select conv_id, 0 as i, '000000' || chr(1) as k0, cast(null as varchar) as k1, {add("('000000' || chr(1))", '2', 'I', user)} as k2,
         {add("('000002I' || chr(1) || 'user:' || chr(10))", '2', 'I', assistant)} as k3 from (select distinct conv_id from faults)
  union all
  select conv_id, i, k0, k1, k2, least(k3, {add('k2', '2', 'I', assistant)}) from (
    select conv_id, i, k0, k1, least(k2, {add('k0', '2', 'I', user)}, {add('k1', '2', 'I', user)}, {add('k3', '2', 'I', user)}) as k2, k3 from (
      select w.conv_id, f.i, {add('k0', '3', 'D')} as k0,
        least({add('k1', '3', 'D')}, {keep('k0', 's')}) as k1,
        least({add('k2', '3', 'D')}, {keep('k0', 'u')}, {keep('k1', 'u')}, {keep('k3', 'u')}, {rerole('k0', new_user)}, {rerole('k1', new_user)}, {rerole('k3', new_user)}) as k2,
        least({add('k3', '3', 'D')}, {keep('k2', 'a')}, {rerole('k2', new_assistant)}) as k3
      from walk w join faults f on f.conv_id is not distinct from w.conv_id and f.i = w.i + 1))),
ends as (select conv_id, i, max(i) over (partition by conv_id) as n, least(k0, k3) as k from walk),
best as (select conv_id, cast(substr(k, 1, 6) as bigint) as cost, substr(k, 7, strpos(k, chr(1)) - 7) as audit, regexp_replace(substr(k, strpos(k, chr(1)) + 1), '\\n$', '') as repaired from ends where i = n),
counts as (select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (last = '') as blank, count(*) filter (last <> '' and nth > 1) as duplicate,
             count(*) filter (not gone and cut = 1) as truncated, count(*) filter (two not in ('su', 'ua', 'au')) as illegal from faults group by conv_id)
select o.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal,
       coalesce(cost, 0) as cost, coalesce(audit, '') as audit, sha256(coalesce(repaired, '')) as repaired_sha256
from (select distinct conv_id from conversations) o left join counts c on c.conv_id is not distinct from o.conv_id left join best b on b.conv_id is not distinct from o.conv_id
"""


@query(_repair_sql())
def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    conversations = table(spark, folder, "conversations")
    repaired = repair(damaged(conversations))
    lines = F.array_join(F.transform(F.arrays_zip("roles", "texts"), lambda t: F.concat(t["roles"], F.lit(":"), t["texts"])), "\n")
    whole = repaired.filter(F.size("roles") > 0).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("part", "chunk", lines.alias("lines")))).alias("c"))
    whole = whole.select("conv_id", F.array_join(F.transform("c", lambda x: x["lines"]), "\n").alias("repaired"))
    every = conversations.select(F.col("conv_id").alias("every")).distinct()
    found = summary(repaired).join(whole.withColumnRenamed("conv_id", "c"), F.col("conv_id").eqNullSafe(F.col("c")), "left")
    out = every.join(found, F.col("every").eqNullSafe(F.col("conv_id")), "left")
    zeros = [F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select(F.col("every").alias("conv_id"), *zeros, F.coalesce("audit", F.lit("")).alias("audit"), F.sha2(F.coalesce("repaired", F.lit("")), 256).alias("repaired_sha256"))
