"""The registered queries over the operators of this folder: (spark, sf_dir) -> rows."""

from __future__ import annotations

import functools
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    collocations, context_tree, decontaminate, idfiles, jaccard_join, packing, quality_model, repetition, resampling, toxicity,
    url_filter, warc,
)
from .common import crc_remainder, table
from .near_dedup import near_duplicates

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


def tokenizer_file(name: str) -> str:
    """Where a public vocabulary file lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def ship(spark: SparkSession) -> None:
    """Python workers find this package where the driver runs it from, if it is not installed."""
    home = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if home not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([home, *filter(None, paths)])


@_query
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write(table(spark, sf_dir, "pages"))
    return warc.read(archives, with_payload=False).drop("payload").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "error")


ORACLES["op1_warc"] = """
with p as (select page_id, coalesce(html, '') as html, strlen(coalesce(html, '')) as payload_bytes,
                  sha1(coalesce(html, '')) as payload_digest from pages),
     q as (select *, case when payload_bytes >= 1000 then max(page_id) over (partition by payload_digest) end as stored from p)
select page_id, payload_bytes, payload_digest,
       case when stored is not null and page_id is distinct from stored then 'revisit' else 'response' end as record_type,
       case when page_id is distinct from stored then stored end as refers_to,
       cast(null as varchar) as error
from q
"""


@_query
def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@_query
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = packing.pieces(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))
    return packing.pack(cut)


@_query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_query
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = idfiles.write(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))
    return idfiles.read(files)


@_query
def op6_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_tree.score(table(spark, sf_dir, "documents"), crc_remainder(F.col("doc_id"), 10) == 0)


@_query
def op7_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.judge(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


URL_RULES = [
    url_filter.Rule("allow", "org", "/"),
    url_filter.Rule("block", "example.org", "/es/"),
    url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"),
    url_filter.Rule("block", "com", "/de/"),
]


@_query
def op8_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled URLs are those that the rules decide."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    model = url_filter.train(url_filter.ruled(pages, URL_RULES))
    return url_filter.judge(pages, URL_RULES, model).drop("url")


@_query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    chain = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs.select("doc_id", "text"), chain).drop("text")
    return scored.select(
        "doc_id", *[F.col("toxic_scores")[i].alias(f"p_{name}") for i, name in enumerate(chain.categories)], "rejected")


@_query
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = crc_remainder(F.col("doc_id"), 3) == 1
    model = quality_model.train(docs, labels.where(~held_out))
    scored = quality_model.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out.alias("held_out"), F.col("quality_score").alias("score"),
                         (F.col("quality_score") >= 0.5).cast("int").alias("predicted"))


@_query
def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op11_resampling"] = r"""
with steps as materialized (
       select list(v order by i) as t from (
         select i, list_reduce(list_prepend(i, range(8)), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as v
         from range(256) r(i))),
     texts as (select 0 as side, doc_id, text from documents union all select 1, item_id, text from benchmark),
     words as materialized (
       select side, doc_id, row_number() over () as row_id,
              regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                 '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
       from texts),
     features as materialized (
       select side, row_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) as f from words),
     named as materialized (
       select f, xor(list_reduce(list_prepend(4294967295, list_transform(range(len(hex(encode(f))) // 2),
                       lambda i: ('0x' || substr(hex(encode(f)), 2 * i + 1, 2))::bigint)),
                       lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 10000 as bucket
       from (select distinct f from features), steps),
     placed as materialized (select side, row_id, bucket from features join named using (f)),
     counts as (select b.i as bucket, count(*) filter (where side = 0) as s, count(*) filter (where side = 1) as t
                from range(10000) b(i) left join placed on bucket = b.i group by 1),
     totals as (select sum(s)::bigint as all_s, sum(t)::bigint as all_t from counts),
     gains as (select bucket, floor(1000 * ln(((t + 1)::double * (all_s + 10000)::double) / ((s + 1)::double * (all_t + 10000)::double)))::bigint as gain
               from counts, totals),
     weights as (select row_id, floor(sum(gain) / count(*))::bigint as weight, count(*) as n_features
                 from placed join gains using (bucket) where side = 0 group by 1),
     scored as (select doc_id, coalesce(n_features, 0)::bigint as n_features, coalesce(weight, 0)::bigint as weight, len(w) >= 20 as eligible,
                       coalesce(weight, 0)::bigint + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint + 0.5::double) / 4294967296::double)))::bigint as score
                from words left join weights using (row_id) where side = 0),
     ranked as (select *, case when eligible then row_number() over (partition by eligible order by score desc, doc_id nulls last, n_features) end as place,
                       (25 * count(*) filter (where eligible) over ()) // 100 as drawn from scored)
select doc_id, n_features, weight, score, case when place <= drawn then place end as rank from ranked
"""


@_query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents").select("lang", "text"))


ORACLES["op12_collocations"] = r"""
with pieces as materialized (
       select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w
       from (select coalesce(lang, 'und') as lang,
                    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                 '[.,;:!?\x0A-\x0D]')) as piece
             from documents)),
     sizes as (select lang, sum(len(w))::bigint as n from pieces group by 1),
     f as materialized (
       select lang, m, w[i:i + m - 1] as p, count(*) as f
       from (select lang, w, m, unnest(range(1, len(w) - m + 2)) as i from pieces, range(1, 5) t(m))
       group by all having count(*) >= 30),
     c as (select lang, m, p, f as a from f where m >= 2),
     longer as (
       select lang, p[i:i + s - 1] as p, max(a) as longer
       from (select lang, p, a, s, unnest(range(1, m - s + 2)) as i from c, range(2, 4) t(s) where s < m)
       group by all),
     kept as (select c.* from c left join longer using (lang, p) where longer is null or 100 * longer < 80 * a),
     cuts as (
       select k.lang, k.p, k.a, n.i as k, x.f as l, y.f as r, (2000000::hugeint * k.a) // (x.f + y.f) as score
       from kept k, range(1, 4) n(i), f x, f y
       where n.i < k.m and x.lang = k.lang and x.p = k.p[1:n.i] and y.lang = k.lang and y.p = k.p[n.i + 1:k.m]),
     best as (select * from cuts qualify row_number() over (partition by lang, p order by score, k) = 1),
     ranked as (select *, array_to_string(p, ' ') as phrase,
                       row_number() over (partition by lang order by score desc, a desc, array_to_string(p, ' ')) as rank from best)
select lang, rank, phrase, a, l, r, n, score::bigint as score from ranked join sizes using (lang) where rank <= 2000
"""


@_query
def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


ORACLES["op13_jaccard_join"] = r"""
with recursive words as materialized (
       select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x20\x09-\x0D]+') as w
       from documents),
     shingles as materialized (
       select distinct doc_id, w[i:i + least(3, len(w)) - 1] as s
       from (select doc_id, w, unnest(range(1, greatest(len(w) - 1, least(len(w), 1) + 1))) as i from words)),
     sizes as materialized (select doc_id, count(*) as n from shingles group by 1),
     common as (
       select x.doc_id as a, y.doc_id as b, count(*) as c
       from shingles x join shingles y on x.s = y.s and x.doc_id > y.doc_id group by all),
     links as materialized (
       select a, b from common join sizes m on m.doc_id = a join sizes n on n.doc_id = b
       where 100 * c >= 90 * (m.n + n.n - c)),
     reach as (
       select doc_id, doc_id as r from words
       union
       select e.x, r from reach join (select a as x, b as y from links union all select b, a from links) e on e.y = reach.doc_id)
select words.doc_id, coalesce(n, 0)::bigint as n_shingles, min(r) as component_id
from words left join sizes using (doc_id) join reach using (doc_id) group by words.doc_id, n
"""
