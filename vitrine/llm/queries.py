"""The registered queries of the operators, over whole tables, and their DuckDB statements where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm import decontamination, html_text, merkle, near_dups, packing, periodic, quality_fm, robust_rules, sharding, suffix_dedup, toxicity, url_rules, warc
from vitrine.llm.storage import new_folder

#: The public tokenizer that the packing query counts with.
TOKENIZER = "byte_bpe_50k.json"


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_factorisation_machine_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_fm.quality_scores(_read(spark, sf_dir, "documents").select("doc_id", "text", "n_chars"), _read(spark, sf_dir, "labels"))


def op2_minimum_bin_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op3_robust_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = robust_rules.robust_rules(_read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.digest(warc.round_trip(_read(spark, sf_dir, "pages")))


def op5_bottom_k_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(_read(spark, sf_dir, "documents"), percent=85)


#: Shards of the placement query, and how they stand after one more has joined.
SHARDS = [f"shard-{k:03d}" for k in range(64)]
SLOTS = 4099


def op6_permutation_table_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents are written to their shards and read back; where each would go if a shard joined."""
    placed = sharding.place(_read(spark, sf_dir, "documents"), ["doc_id"], SHARDS, SLOTS)
    stored = sharding.stored_shards(placed, new_folder(spark, "shards"), files_per_shard=2)
    text = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256")
    return sharding.next_place(stored, [*SHARDS, "shard-064"], SLOTS).select("doc_id", "slot", "shard", "next_shard", text)


def op7_prefix_doubling_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(suffix_dedup.remove_repeats(_read(spark, sf_dir, "documents")))


def op8_recurrent_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(_read(spark, sf_dir, "documents").select("doc_id", "text"), _read(spark, sf_dir, "labels"))


def op9_prefix_join_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.digest(decontamination.contamination(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark")))


def op10_consensus_path_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.main_text(_read(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


#: What a row of documents is hashed over.
LEAF_FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def op11_butterfly_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").withColumn("_tampered", merkle.tampered(LEAF_FIELDS, "n_chars"))
    return merkle.audit(merkle.manifest(docs, LEAF_FIELDS, carry=("_tampered",)))


#: Rules of the URL query.
URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


def op12_cascade_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = url_rules.judge(_read(spark, sf_dir, "pages"), url_rules.read_rules(spark, URL_RULES), carry=("page_id",))
    return found.select("page_id", "host", "path", "rule", "verdict")


def op13_convolution_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digest(periodic.periodic_runs(periodic.repeating(_read(spark, sf_dir, "documents"))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_factorisation_machine_quality,
        op2_minimum_bin_slack_packing,
        op3_robust_quality_rules,
        op4_warc_round_trip,
        op5_bottom_k_near_duplicates,
        op6_permutation_table_shards,
        op7_prefix_doubling_dedup,
        op8_recurrent_toxicity,
        op9_prefix_join_decontamination,
        op10_consensus_path_text,
        op11_butterfly_merkle_manifest,
        op12_cascade_url_rules,
        op13_convolution_periodic_runs,
    )
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE: dict[str, str] = {
    # The table itself is compared with a plain filling in the tests; here it is a given.
    "op6_permutation_table_shards": f"""
        with slots as (select {sharding.lookup_table(SHARDS, SLOTS)} as old, {sharding.lookup_table([*SHARDS, "shard-064"], SLOTS)} as new),
        hashed as (
            select doc_id, (('0x' || md5(coalesce(length(doc_id::varchar) || ':' || doc_id::varchar, '-'))[1:15])::bigint % {SLOTS})::bigint as slot,
                   sha256(coalesce(text, '')) as text_sha256 from documents
        )
        select doc_id, slot, printf('shard-%03d', old[slot + 1]) as shard, printf('shard-%03d', new[slot + 1]) as next_shard, text_sha256 from hashed, slots
    """,
    "op4_warc_round_trip": """
        with payload as (select page_id, coalesce(html, '') as body from pages),
        last as (select body, max(page_id) as response from payload where strlen(body) >= 1000 group by 1)
        select page_id, strlen(payload.body)::bigint as payload_bytes, sha1(payload.body) as payload_digest,
               case when page_id < response then 'revisit' else 'response' end as record_type,
               case when page_id < response then response end as refers_to
        from payload left join last on last.body = payload.body
    """,
    "op5_bottom_k_near_duplicates": rf"""
        with recursive doc as (
            select doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') as words from documents
        ), shingle as (
            select distinct doc_id, words[i : i + 4] as s
            from (select doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) as i from doc where len(words) > 0)
        ), sizes as (select doc_id, count(*) as n from shingle group by 1),
        common as (
            select a.doc_id as a, b.doc_id as b, count(*) as n from shingle a join shingle b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2
        ), link as (
            select a, b from common join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * common.n >= 85 * (x.n + y.n - common.n)
        ), both_ways as (select a, b from link union all select b, a from link),
        reach as (
            select doc_id as node, doc_id as root from documents
            union
            select both_ways.b, reach.root from reach join both_ways on both_ways.a = reach.node where reach.root < both_ways.b
        ), component as (select node, min(root) as component_id from reach group by 1)
        select doc.doc_id, coalesce(sizes.n, 0)::bigint as n_shingles, component_id, doc.doc_id = component_id as kept
        from doc join component on node = doc.doc_id left join sizes on sizes.doc_id = doc.doc_id
    """,
    "op7_prefix_doubling_dedup": """
        with doc as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
        starts as (
            select doc_id, p, hash(substr(h, 2 * p + 1, 200)) as a, md5(substr(h, 2 * p + 1, 200)) as b
            from (select doc_id, h, unnest(range(0, length(h) // 2 - 99)) as p from doc where length(h) >= 200)
        ),
        again as (select doc_id, p from starts qualify row_number() over (partition by a, b order by doc_id, p) > 1),
        fresh as (select doc_id, p, coalesce(p - lag(p) over (partition by doc_id order by p) > 100, true) as gap from again),
        numbered as (select doc_id, p, sum(gap::int) over (partition by doc_id order by p) as span from fresh),
        spans as (select doc_id, span, min(p) as low, max(p) + 100 as high from numbered group by 1, 2),
        parts as (
            select doc_id, low, high, coalesce(lag(high) over (partition by doc_id order by low), 0) as since from spans
        ),
        cut as (
            select doc.doc_id, sum(high - low) as n_removed, count(*) as n_spans,
                   string_agg(substr(h, 2 * since + 1, 2 * (low - since)), '' order by low) || substr(any_value(h), 2 * max(high) + 1) as kept
            from parts join doc on doc.doc_id = parts.doc_id group by 1
        )
        select doc.doc_id, (length(h) // 2)::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed,
               coalesce(n_spans, 0)::bigint as n_spans, sha256(unhex(coalesce(kept, h))) as kept_sha256
        from doc left join cut on cut.doc_id = doc.doc_id
    """,
    "op9_prefix_join_decontamination": rf"""
        with doc as (
            select doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from documents
        ), item as (
            select item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from benchmark
        ), wanted as (
            select distinct item_id, words[i : i + 9] as w, len(words[i : i + 9]) as size
            from (select item_id, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) as i from item where len(words) > 0)
        ), sizes as (select distinct size from wanted),
        seen as (
            select doc_id, i, size, words[i : i + size - 1] as w
            from (select doc_id, words, size, unnest(range(1, len(words) - size + 2)) as i from doc, sizes where len(words) >= size)
        ), hit as (select doc_id, i, size, item_id from seen join wanted using (size, w)),
        places as (select doc_id, count(distinct p) as n from (select doc_id, unnest(range(i, i + size)) as p from hit) group by 1),
        items as (
            select doc_id, count(*) as n, string_agg(name, ',' order by name) as names
            from (select distinct doc_id, item_id::varchar as name from hit) group by 1
        )
        select doc.doc_id, len(words)::bigint as n_words, coalesce(places.n, 0)::bigint as n_hit,
               coalesce(items.n, 0)::bigint as n_items, sha256(coalesce(names, '')) as items_sha256,
               coalesce(places.n, 0) > 0 as contaminated
        from doc left join places on places.doc_id = doc.doc_id left join items on items.doc_id = doc.doc_id
    """,
    # CRC-32 by the table that its polynomial gives, over the decimal digits of the id.
    "op11_butterfly_merkle_manifest": """
        with recursive step as (
            select b, b::ubigint as c, 0 as k from range(256) r(b)
            union all
            select b, case when c % 2 = 1 then xor(c // 2, 3988292384::ubigint) else c // 2 end, k + 1 from step where k < 8
        ), lut as (select list(c order by b) as t from step where k = 8),
        digits as (
            select doc_id, doc_id::varchar as s, 0 as k, 4294967295::ubigint as c, t
            from (select distinct doc_id from documents where doc_id is not null), lut
            union all
            select doc_id, s, k + 1, xor(c // 256, t[(xor(c % 256, ascii(s[k + 1])::ubigint) + 1)::bigint]), t from digits where k < length(s)
        ), crc as (select doc_id, xor(c, 4294967295::ubigint) as h from digits where k = length(s)),
        field as (
            select d.doc_id, lang, row_number() over (partition by lang order by d.doc_id nulls first) - 1 as place,
                   coalesce(strlen(d.doc_id::varchar) || ':' || d.doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                   || coalesce(strlen(lang) || ':' || lang, '-') as a,
                   n_chars, coalesce(strlen(text) || ':' || text, '-') as b, coalesce(h % 7 = 0, false) as changed
            from documents d left join crc on crc.doc_id = d.doc_id
        ), leaf as (
            select *, sha256(a || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') || b) as leaf,
                   sha256(a || coalesce(strlen((n_chars + changed::int)::varchar) || ':' || (n_chars + changed::int), '-') || b) as met
            from field
        ), tree as (
            select coalesce('=' || lang, '') as grp, 0 as level, place, leaf as digest, count(*) over (partition by lang) as size from leaf
            union all
            select grp, level + 1, place // 2, sha256(string_agg(digest, '' order by place)), (any_value(size) + 1) // 2
            from tree where size > 1 group by grp, level, place // 2
        ), subroots as (select grp, digest, row_number() over (order by grp) - 1 as place, count(*) over () as size from tree where size = 1),
        top as (
            select 0 as level, place, digest, size from subroots
            union all
            select level + 1, place // 2, sha256(string_agg(digest, '' order by place)), (any_value(size) + 1) // 2
            from top where size > 1 group by level, place // 2
        ), height as (select grp, max(level) as h from tree group by 1),
        ways as (
            select coalesce('=' || l.lang, '') as grp, l.place, t.level, t.digest, (l.place >> t.level::int) % 2 = 1 as is_left
            from leaf l join tree t on t.grp = coalesce('=' || l.lang, '') and t.place = xor(l.place >> t.level::int, 1)
            union all
            select s.grp, l.place, h.h + t.level, t.digest, (s.place >> t.level::int) % 2 = 1
            from leaf l join subroots s on s.grp = coalesce('=' || l.lang, '') join height h on h.grp = s.grp
            join top t on t.place = xor(s.place >> t.level::int, 1)
        ), proof as (select grp, place, sha256(string_agg(digest, '' order by level)) as p from ways group by 1, 2),
        total as (select max(level) as h, arg_max(digest, level) as root from top),
        fold as (
            select coalesce('=' || lang, '') as grp, place, 0 as level, met as node from leaf
            union all
            select f.grp, f.place, f.level + 1, sha256(case when w.digest is null then f.node when w.is_left then w.digest || f.node else f.node || w.digest end)
            from fold f join height h on h.grp = f.grp, total
            left join ways w on w.grp = f.grp and w.place = f.place and w.level = f.level
            where f.level < h.h + total.h
        ), folded as (select grp, place, arg_max(node, level) as folded_root from fold group by 1, 2)
        select doc_id, leaf, s.digest as subroot, root, coalesce(p, sha256('')) as proof_sha256, folded_root, folded_root = root as verified
        from leaf l join subroots s on s.grp = coalesce('=' || l.lang, '') join folded f on f.grp = s.grp and f.place = l.place
        left join proof on proof.grp = s.grp and proof.place = l.place, total
    """,
    "op12_cascade_url_rules": r"""
        with split as (
            select page_id, translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
                   coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') as path
            from pages
        ), rules (domain, prefix, verdict) as (
            values ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
        ), best as (
            select page_id, host, path, domain || prefix as rule, verdict,
                   row_number() over (partition by page_id, host, path order by length(domain || prefix) desc nulls last) as place
            from (select distinct * from split) left join rules on (host = domain or ends_with(host, '.' || domain)) and starts_with(path, prefix)
        )
        select split.page_id, split.host, split.path, rule, coalesce(verdict, 'allow') as verdict
        from split join best on split.page_id is not distinct from best.page_id and split.host = best.host and split.path = best.path and place = 1
    """,
}
