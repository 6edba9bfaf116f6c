"""The queries of this subpackage: each operator over its whole table, and the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.llm.brown import score
from readloom.llm.contamination import contained_items
from readloom.llm.divergence import source_divergence
from readloom.llm.jaccard_join import near_duplicates
from readloom.llm.kneser_ney import judge_quality
from readloom.llm.line_rules import quality_rules
from readloom.llm.packing import pack
from readloom.llm.pii import KINDS, find_personal_data, rendered
from readloom.llm.sharding import shuffle_into_shards
from readloom.llm.tokens import count_tokens
from readloom.llm.toxicity import score_toxicity
from readloom.llm.url_rules import judge_urls
from readloom.llm.vector_codes import compress_vectors, digest, with_label_error

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
PIECE_COLUMNS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")

#: The rules of the URL query: host, path, verdict.
URL_RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(n: int) -> Column:
    """crc32 of the document's id as text, modulo n."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(n))


def op1_brown_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), fold(7) == 2)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), TOKENIZER).select(*PIECE_COLUMNS)


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(table(spark, sf_dir, "documents"))
    counts = [F.size(F.filter("base", kind_is(kind))).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(rendered(F.col("base")), 256).alias("base_sha256"), rendered(F.col("spans")).alias("spans"))


def kind_is(kind: str):
    return lambda span: span["kind"] == kind


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), fold(4) == 2)


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return judge_urls(table(spark, sf_dir, "pages"), rules)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), TOKENIZER)


def op7_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op9_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lost_percent")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = compress_vectors(table(spark, sf_dir, "embeddings"))
    return with_label_error(coded).select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.encode(F.coalesce("text", F.lit("")), "utf-8")
    dealt = shuffle_into_shards(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return dealt.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_brown_score": op1_brown_score,
    "op2_packing": op2_packing,
    "op3_pii": op3_pii,
    "op4_toxicity": op4_toxicity,
    "op5_url_rules": op5_url_rules,
    "op6_token_counts": op6_token_counts,
    "op7_kneser_ney": op7_kneser_ney,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_contamination": op9_contamination,
    "op10_line_rules": op10_line_rules,
    "op11_vector_codes": op11_vector_codes,
    "op12_sharding": op12_sharding,
    "op13_source_divergence": op13_source_divergence,
}
#: One round of op11's oracle: each part's nearest entry, and the entries' means.
NEAREST = """near{0} as (select vec_id, p, any_value(x) as x, min(d * 64 + e) as m from (
            select s.vec_id, s.p, s.x, b.e, list_sum(list_transform(range(1, len(s.x) + 1), lambda i: (s.x[i] - b.x[i]) * (s.x[i] - b.x[i]))) :: bigint as d from sliced s join book{0} b on s.p = b.p) group by vec_id, p)"""
MEANS = """sums{0} as (select p, e, i, count(*) as n, sum(x[i]) :: bigint as total from (select p, m % 64 as e, x, unnest(range(1, len(x) + 1)) as i from near{0}) group by p, e, i),
        book{1} as (select b.p, b.e, coalesce(u.x, b.x) as x from book{0} b left join (select p, e, list((total - ((total % n) + n) % n) // n order by i) as x from sums{0} group by p, e) u on b.p = u.p and b.e = u.e)"""
ORACLES: dict[str, str] = {
    "op11_vector_codes": f"""
        with kept as (select vec_id, label, list_transform(embedding, lambda x: floor(256 * x :: double) :: bigint) as v from embeddings
            where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        sliced as (select vec_id, label, p, v[p * len(v) // 16 + 1 : (p + 1) * len(v) // 16] as x from kept, (select unnest(range(16)) as p)),
        book0 as (select p, e, x from (select p, x, row_number() over (partition by p order by vec_id) - 1 as e from sliced) where e < 64),
        {NEAREST.format(0)}, {MEANS.format(0, 1)}, {NEAREST.format(1)}, {MEANS.format(1, 2)}, {NEAREST.format(2)},
        coded as (select k.vec_id, any_value(k.label) as label, string_agg(format('{{:02x}}', m % 64), '' order by p) as code, sum(m // 64) :: bigint as error from near2 n join kept k on n.vec_id = k.vec_id group by k.vec_id)
        select vec_id, code, error, sum(error) over (partition by label) :: bigint as label_error,
            (select sha256(string_agg(array_to_string(x, ','), ',' order by p, e)) from book2) as codebooks_sha256 from coded""",
    "op13_source_divergence": r"""
        with docs as (select doc_id, coalesce(lang, '') as lang, coalesce(source, '') as source, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
        found as (select doc_id, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from docs),
        kept as (select lang, term, count(*) as lang_n from found group by lang, term having count(distinct doc_id) >= 3),
        whole as (select lang, count(*) as v, sum(lang_n) as total from kept group by lang),
        counts as (select f.lang, f.source, f.term, count(*) as n from found f join kept k on f.lang = k.lang and f.term = k.term group by all),
        groups as (select g.lang, g.source, coalesce(any_value(w.v), 0) as v, coalesce(any_value(w.total), 0) as lang_total, coalesce(sum(c.n), 0) as total
            from (select distinct lang, source from docs) g left join whole w on w.lang = g.lang left join counts c on c.lang = g.lang and c.source = g.source group by g.lang, g.source),
        grid as (select g.lang, g.source, k.term, coalesce(c.n, 0) as n, (1 + (1000000000 :: hugeint * (coalesce(c.n, 0) + 1)) // (g.total + g.v)) :: bigint as p,
                (1 + (1000000000 :: hugeint * (k.lang_n + 1)) // (g.lang_total + g.v)) :: bigint as q
            from groups g join kept k on k.lang = g.lang left join counts c on c.lang = g.lang and c.source = g.source and c.term = k.term),
        priced as (select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // b.p) :: bigint as value from grid a join grid b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
        pairs as (select a.lang, a.source, 'pair' as part, b.source as item, coalesce(p.value, 0) as value from groups a join groups b on a.lang = b.lang and a.source <> b.source left join priced p on p.lang = a.lang and p.source = a.source and p.item = b.source),
        terms as (select lang, source, 'term' as part, term as item, (p - q) * (p - q) // q as value from grid where n > 0 and p > q),
        ranked as (select *, cast(row_number() over (partition by lang, source, part order by value desc, item) as integer) as rank from (select * from pairs union all select * from terms))
        select lang, source, part, item, value, rank from ranked where part = 'pair' or rank <= 200""",
    "op5_url_rules": """
        with rules(host, path, verdict) as (values ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
        p as (select page_id,
            translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
            coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path from pages),
        hit as (select distinct p.host, p.path, first_value(r.host || r.path) over w as rule, first_value(r.verdict) over w as verdict
            from (select distinct host, path from p) p join rules r on (p.host = r.host or ends_with(p.host, '.' || r.host)) and starts_with(p.path, r.path)
            window w as (partition by p.host, p.path order by length(r.host || r.path) desc, r.verdict desc))
        select page_id, p.host, p.path, rule, coalesce(verdict, 'allow') as verdict from p left join hit on p.host = hit.host and p.path = hit.path""",
    "op8_jaccard_join": r"""
        with recursive words as (
            select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') as w from documents),
        shingles as (
            select distinct doc_id, unnest(case when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s from words),
        sizes as (select doc_id, count(*) as n from shingles group by 1),
        pairs as (select a.doc_id as a, b.doc_id as b, count(*) as shared from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id group by 1, 2),
        links as (select a, b from pairs join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * shared >= 80 * (x.n + y.n - shared)),
        reached(a, b) as (select doc_id, doc_id from documents union select r.a, l.b from reached r join links l on r.b = l.a)
        select d.doc_id, coalesce(any_value(n), 0) as n_shingles, min(b) as component_id
        from documents d join reached on a = d.doc_id left join sizes on sizes.doc_id = d.doc_id group by d.doc_id""",
    "op9_contamination": r"""
        with folded as (
            select 'd' as side, doc_id as id, text from documents union all select 'i', item_id, text from benchmark),
        words as (
            select side, id, list_filter(string_split_regex(translate(regexp_replace(text, '[!-/:-@\[-`{-~]', ' ', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') as w from folded),
        shingles as (
            select distinct side, id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) as s from words where len(w) >= 5),
        sizes as (select id, count(*) as n from shingles where side = 'i' group by id)
        select d.id as doc_id, i.id as item_id, any_value(n) as n_item_shingles, count(*) as n_shared
        from shingles d join shingles i on d.s = i.s and d.side = 'd' and i.side = 'i' join sizes on sizes.id = i.id
        group by 1, 2 having 100 * count(*) >= 80 * any_value(n)""",
}
