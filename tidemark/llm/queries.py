"""The operators over their whole tables, and the same in DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import language, licences, pieces, pseudo_lm
from tidemark.llm.contamination import contaminated
from tidemark.llm.line_runs import drop_common_lines
from tidemark.llm.packing import pack_documents
from tidemark.llm.phrases import mine
from tidemark.llm.prefix_trie import numbered_turns, prefix_trie, rebuilt
from tidemark.llm.shared import written
from tidemark.llm.simhash import near_duplicates
from tidemark.llm.token_counts import token_counts
from tidemark.llm.topk import top_products, usable
from tidemark.llm.vector_dedup import near_duplicates as near_vectors

Query = Callable[[SparkSession, str], DataFrame]


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack_documents(_read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    found = language.predict(docs, language.fit(docs, ~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")


def op3_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(_read(spark, sf_dir, "embeddings"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_common_lines(_read(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampled segmentations of all texts, and whether decoding them gives the texts back."""
    docs, model = _read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")
    encoded = pieces.encode(docs, model)
    decoded = pieces.with_decoded(encoded, model)
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_pieces"), F.xxhash64("ids").alias("ids_hash"),
        F.sha2("text", 256).alias("text_sha256"),
    )


def op7_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    found = licences.scan(docs, licences.fit(docs))
    known = F.filter("licences", lambda x: x["family"] != licences.UNKNOWN)
    return found.select(
        "doc_id",
        F.concat_ws(",", F.array_sort(F.array_distinct(F.transform(known, lambda x: x["family"])))).alias("families"),
        F.size(known).alias("n_licences"),
        (F.size("licences") - F.size(known)).alias("n_unknown"),
    )


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(_read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "embeddings")
    vector = F.when(usable(F.col("embedding")), F.transform("embedding", lambda x: F.floor(x.cast("double") * 1024)))
    rows = rows.select("vec_id", vector.alias("vector"))
    return top_products(rows, F.col("vec_id") % 100 == 0, id="vec_id")


def op10_pseudo_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudo_lm.fit_and_score(_read(spark, sf_dir, "documents"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine(_read(spark, sf_dir, "documents"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of conversations that begin with turns of the first of their group of five."""
    turns = written(numbered_turns(_read(spark, sf_dir, "conversations")), "turns")
    turns, sizes = rebuilt(turns)
    return prefix_trie(turns, sizes)


def op13_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_packing, op2_language, op3_vector_dedup, op4_line_dedup, op5_token_counts,
        op6_pieces, op7_licences, op8_simhash, op9_topk, op10_pseudo_lm, op11_phrases, op12_conversation_trie,
        op13_contamination,
    )
}

ORACLES: dict[str, str] = {
    "op3_vector_dedup": """
        with recursive usable as (
            select vec_id, label, embedding::double[] as v from embeddings
            where label is not null and embedding is not null and len(embedding) > 0
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
              and len(list_filter(embedding, lambda x: x <> 0)) > 0),
        links as (
            select a.vec_id as a, b.vec_id as b from usable a join usable b
            on a.label = b.label and a.vec_id <> b.vec_id and len(a.v) = len(b.v)
            where list_cosine_similarity(a.v, b.v) >= 0.98),
        reach(id, root) as (
            select vec_id, vec_id from embeddings union select l.b, r.root from reach r join links l on l.a = r.id),
        least as (select id, min(root) as component_id from reach group by id)
        select e.vec_id, (select count(*) from links l where l.a = e.vec_id) as n_links, component_id,
               e.vec_id = component_id as kept
        from embeddings e join least on least.id = e.vec_id""",
    "op4_line_dedup": r"""
        with lines as (
            select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as place from documents),
        keyed as (
            select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k from lines),
        common as (select k from keyed where k <> '' group by k having count(distinct doc_id) >= 10),
        marked as (select keyed.*, common.k is not null as gone from keyed left join common using (k))
        select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
               sha256(coalesce(string_agg(line, chr(10) order by place) filter (not gone), '')) as kept_sha256
        from marked group by doc_id""",
    "op9_topk": """
        with v as (
            select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)) as v from embeddings
            where embedding is not null and len(embedding) > 0
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        scored as (
            select q.vec_id as query_id, p.vec_id, list_inner_product(q.v, p.v)::bigint as score
            from v q join v p on q.vec_id <> p.vec_id and len(q.v) = len(p.v) where q.vec_id % 100 = 0),
        ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scored)
        select query_id, rank, vec_id, score from ranked where rank <= 10""",
    "op11_phrases": r"""
        with pieces as (
            select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece from documents),
        spelled as (select lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') as w from pieces),
        places as (select lang, w, unnest(range(1, len(w) + 1)) as i from spelled),
        grams as (
            select lang, k, array_to_string(w[i:i + k - 1], ' ') as phrase, count(*) as f
            from places, (values (1), (2), (3)) lengths(k) where i + k - 1 <= len(w) group by all),
        candidates as (select lang, k, phrase, f as a, string_split(phrase, ' ') as w from grams where k > 1 and f >= 10),
        longer as (
            select lang, unnest([array_to_string(w[:2], ' '), array_to_string(w[2:], ' ')]) as phrase, a from candidates where k = 3),
        kept as (
            select * from candidates c where not exists (
                select 1 from longer where longer.lang = c.lang and longer.phrase = c.phrase and c.k = 2 and 100 * longer.a >= 50 * c.a)),
        cuts as (
            select c.lang, c.phrase, c.a, cut, x.f as l, y.f as r, ((1000000::hugeint * c.a * c.a) // (x.f::hugeint * y.f))::bigint as score
            from (select *, unnest(range(1, k)) as cut from kept) c
            join grams x on x.lang = c.lang and x.phrase = array_to_string(c.w[:cut], ' ')
            join grams y on y.lang = c.lang and y.phrase = array_to_string(c.w[cut + 1:], ' ')),
        lowest as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
        sizes as (select lang, sum(f)::bigint as n from grams where k = 1 group by lang),
        ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from lowest)
        select lang, rank, phrase, a, l, r, n, score from ranked join sizes using (lang) where rank <= 2000""",
    "op12_conversation_trie": """
        with turns as (
            select conv_id, [coalesce(role, ''), coalesce(text, '')] as t, row_number() over (
                partition by conv_id order by turn nulls first, coalesce(role, ''), sha256(coalesce(text, ''))) as i
            from conversations where conv_id is not null),
        originals as (
            select conv_id, list(t order by i) as l,
                   list_reduce(list_concat([4294967295::bigint], flatten(list_transform(string_split(conv_id::varchar, ''),
                       lambda c: [ascii(c)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
                       lambda x, y: case when y >= 0 then xor(x, y) when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end) as crc
            from turns group by conv_id),
        heads as (select *, xor(crc, 4294967295) % 9 as h from originals),
        rebuilt as (
            select c.conv_id, list_concat(coalesce(b.l, [])[1:c.h], c.l[c.h + 1:]) as l
            from heads c left join originals b on b.conv_id = c.conv_id - c.conv_id % 5),
        paths as (select conv_id, unnest(range(0, len(l) + 1)) as d, l from rebuilt),
        cut as (select conv_id, d, case when d = 0 then [] else l[1:d] end as p, len(l) = d as ended from paths),
        nodes as (
            select d, p, min(conv_id) as conv_id, count(*) as n_convs,
                   sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (ended), '')) as ends_sha256,
                   (count(*) - 1) * coalesce(strlen(p[d][2]), 0) as saved
            from cut group by d, p),
        kids as (
            select x.d, x.p, x.saved, count(y.p) as n_children from nodes x
            left join nodes y on y.d = x.d + 1 and y.p[1:x.d] = x.p group by x.d, x.p, x.saved),
        above as (select *, unnest(range(0, d + 1)) as place from kids),
        sums as (
            select place as d, case when place = 0 then [] else p[1:place] end as p, count(*) filter (n_children = 0) as n_leaves,
                   sum(saved)::bigint as saved_tokens from above group by all)
        select x.conv_id, x.d as depth, y.conv_id as parent_conv_id, x.n_convs, k.n_children, s.n_leaves, s.saved_tokens, x.ends_sha256
        from nodes x join kids k using (d, p) join sums s using (d, p)
        left join nodes y on y.d = x.d - 1 and y.p = case when y.d = 0 then [] else x.p[1:y.d] end""",
    "op13_contamination": r"""
        with spelled as (
            select doc_id, regexp_extract_all(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
        items as (
            select item_id, regexp_extract_all(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
        starts as (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from items where len(w) > 0),
        windows as (select distinct item_id, array_to_string(w[i:i + 9], ' ') as win, least(len(w), 10) as length from starts),
        places as (select doc_id, w, unnest(range(1, len(w) + 1)) as place from spelled),
        found as (
            select p.doc_id, p.place, v.length, v.item_id
            from (select doc_id, place, length, array_to_string(w[place:place + length - 1], ' ') as win
                  from places, (select distinct length from windows) where place + length - 1 <= len(w)) p
            join windows v using (win, length)),
        marked as (select doc_id, unnest(range(place, place + length)) as place from found),
        hit as (select doc_id, count(distinct place) as n from marked group by doc_id),
        listed as (
            select doc_id, count(*) as n, string_agg(id, ',' order by id) as ids
            from (select distinct doc_id, item_id::varchar as id from found) group by doc_id)
        select s.doc_id, len(w)::bigint as n_words, coalesce(hit.n, 0) as n_hit, coalesce(listed.n, 0) as n_items,
               sha256(coalesce(listed.ids, '')) as items_sha256, coalesce(hit.n, 0) > 0 as contaminated
        from spelled s left join hit using (doc_id) left join listed using (doc_id)""",
}
