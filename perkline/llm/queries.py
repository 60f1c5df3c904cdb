"""The registered queries of the operators, over the whole tables of a folder, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perkline.llm import (
    embed_dedup, host_rules, html_text, infill, lm, mixing, near_dup, negatives, pieces, quality, suffix_dedup, topk, warc,
)

#: Vocabulary file of the last operator; a path every driver can read.
PIECES = "/opt/tokenizers/piece_bpe_32k.model"

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of documents on 3-word shingles, links from a similarity of 0.85."""
    return near_dup.near_duplicates(_table(spark, sf_dir, "documents"), width=3, percent=85)


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes left of each document without passages of 100 bytes that start earlier."""
    cut = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of vectors of one label, links from a cosine of 0.98."""
    return embed_dedup.near_vectors(_table(spark, sf_dir, "embeddings"))


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents repeated by Poisson counts towards tempered source shares, in global random order."""
    return mixing.mix_sources(_table(spark, sf_dir, "documents")).drop("position")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records read back from the archives written of the pages."""
    manifest = warc.write_archives(_table(spark, sf_dir, "pages"))
    return warc.read_archives(manifest, payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of each page."""
    return html_text.main_text(_table(spark, sf_dir, "pages"))


def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best rows for each vector whose id is divisible by 20."""
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence, site posterior and decision for each document; sources are hosts, languages their paths."""
    docs = _table(spark, sf_dir, "documents")
    model = quality.train(docs, _table(spark, sf_dir, "labels"))
    return quality.classify(docs, model).select(
        "doc_id", "source", "lang", "evidence", "site", "probability", "kept")


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model scores of each document, learnt from six sevenths of them."""
    return lm.score_documents(_table(spark, sf_dir, "documents"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of each document and whether they decode to its text."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.encode_decode(docs, pieces.PieceModel.load(PIECES)).drop("text")


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the rearranged documents and of the texts rebuilt from them."""
    made = infill.fill_in_middle(_table(spark, sf_dir, "documents"))
    text = infill.restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(text.cast("binary"), 256).alias("restored_sha256"))


def op12_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of each document, and the verdict that its own rules and the record of its host lead to."""
    judged = host_rules.apply_rules(_table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "host_rejected", F.array_join("broken", ",").alias("broken"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of each vector whose id is divisible by 100, after a change of every seventh label."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding", moved.alias("label"))
    return negatives.hard_negatives(vectors, F.col("vec_id") % 100 == 0)


QUERIES: dict[str, Query] = {
    "op1_near_duplicates": op1_near_duplicates,
    "op2_suffix_array_dedup": op2_suffix_array_dedup,
    "op3_embedding_near_dedup": op3_embedding_near_dedup,
    "op4_source_mixing": op4_source_mixing,
    "op5_warc": op5_warc,
    "op6_html_extraction": op6_html_extraction,
    "op7_exact_top_k": op7_exact_top_k,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_host_rules": op12_host_rules,
    "op13_hard_negatives": op13_hard_negatives,
}

_OP1 = r"""
with recursive words as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
sets as (
  select doc_id, list_distinct(case when len(w) >= 3
    then list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
    when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s from words),
items as (select doc_id, unnest(s) as item from sets),
common as (
  select l.doc_id as a, r.doc_id as b, count(*) as n from items l join items r on l.item = r.item and l.doc_id < r.doc_id
  group by l.doc_id, r.doc_id),
links as (
  select a, b from common join sets x on x.doc_id = a join sets y on y.doc_id = b
  where 100 * n >= 85 * (len(x.s) + len(y.s) - n)),
both_ways as (select a, b from links union all select b, a from links),
reach as (
  select doc_id as node, doc_id as other from documents
  union select reach.node, both_ways.b from reach join both_ways on reach.other = both_ways.a)
select sets.doc_id, len(s)::bigint as n_shingles, c.component_id, sets.doc_id = c.component_id as kept
from sets join (select node, min(other) as component_id from reach group by node) c on c.node = sets.doc_id
"""

_OP3 = """
with recursive v as (
  select vec_id, label, embedding::double[] as e,
    coalesce(label is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
      and list_sum(list_transform(embedding, lambda x: x::double * x::double)) > 0, false) as ok from embeddings),
links as (
  select l.vec_id as a, r.vec_id as b from v l join v r on l.ok and r.ok and l.label = r.label and l.vec_id <> r.vec_id
  where list_cosine_similarity(l.e, r.e) >= 0.98),
reach as (
  select vec_id as node, vec_id as other from embeddings
  union select reach.node, links.b from reach join links on reach.other = links.a)
select v.vec_id, (select count(*) from links where a = v.vec_id) as n_links, c.component_id,
  v.vec_id = c.component_id as kept
from v join (select node, min(other) as component_id from reach group by node) c on c.node = v.vec_id
"""

_OP4 = """
with sizes as (select source, count(*) as n from documents group by source),
means as (
  select source, sqrt(n::double) * (select sum(n) from sizes) / (select sum(sqrt(n::double)) from sizes) / n as mean
  from sizes),
rates as (
  select source, greatest(1, ceil(mean / 16))::integer as parts, mean / greatest(1, ceil(mean / 16)) as rate from means),
steps as (
  select source, parts, k, sum(exp(-rate + k * ln(rate) - lgamma(k + 1))) over (partition by source order by k) as s
  from rates, (select unnest(range(0, 97)) as k)),
draws as (
  select doc_id, documents.source, unnest(range(1, parts + 1)) as part
  from documents join rates on documents.source is not distinct from rates.source),
counts as (
  select doc_id, sum((select count(*) from steps where steps.source is not distinct from draws.source and s <=
      (('0x' || substr(md5(coalesce(doc_id::varchar, 'null') || ':7:' || part), 1, 13))::bigint + 0.5) / 4503599627370496)
    ) as n from draws group by doc_id)
select documents.*, unnest(range(1, counts.n::bigint + 1))::integer as copy
from documents join counts on documents.doc_id is not distinct from counts.doc_id
"""

_OP5 = """
with p as (
  select page_id, octet_length(encode(coalesce(html, ''))) as n, sha256(coalesce(html, '')) as digest from pages),
first as (select digest, min(page_id) as page_id from p where n >= 100 group by digest)
select p.page_id, n::bigint as payload_bytes, p.digest as payload_digest,
  case when first.page_id <> p.page_id then 'revisit' else 'response' end as record_type,
  case when first.page_id <> p.page_id then first.page_id end as refers_to
from p left join first on p.n >= 100 and p.digest = first.digest
"""

_OP7 = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as e from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select q.vec_id as query_id, c.vec_id, list_dot_product(q.e, c.e)::bigint as score
  from v q join v c on q.vec_id % 20 = 0 and q.vec_id <> c.vec_id)
select query_id, rank, vec_id, score from (
  select *, (row_number() over (partition by query_id order by score desc, vec_id))::integer as rank from scored)
where rank <= 20
"""

_OP11 = r"""
with d as (
  select doc_id, coalesce(text, '') as t, sha256('42:' || coalesce(doc_id::varchar, 'null')) as h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as u from documents),
draws as (
  select *, len(u) as n, ('0x' || h[1:8])::bigint % (len(u) + 1) as a, ('0x' || h[9:16])::bigint % (len(u) + 1) as b,
    case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or ('0x' || h[17:24])::bigint % 100 >= 50
      then 'plain' when ('0x' || h[25:32])::bigint % 100 < 80 then 'spm' else 'psm' end as form from d),
parts as (
  select *, array_to_string(u[1:least(a, b)], '') as p, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') as m,
    array_to_string(u[greatest(a, b) + 1:n], '') as s from draws)
select doc_id, n::bigint as n, form, case when form <> 'plain' then length(p) end as prefix_chars,
  case when form <> 'plain' then length(m) end as middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
    else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256, sha256(t) as restored_sha256
from parts
"""

_OP12 = r"""
with t as (select doc_id, source, coalesce(text, '') as s from documents),
split as (
  select *, regexp_extract_all(s, '[^\x20\x09-\x0D]+') as w,
    list_filter(string_split(s, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l from t),
windows as (
  select doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] || ' ' || w[i + 4] as g
  from (select doc_id, w, unnest(range(1, len(w) - 3)) as i from split)),
twice as (select doc_id, i from windows qualify count(*) over (partition by doc_id, g) > 1),
covered as (
  select doc_id, count(distinct i + k) as n from twice, (select unnest(range(0, 5)) as k) group by doc_id),
counts as (
  select split.doc_id, source, len(w) as n_words, length(array_to_string(w, '')) as word_chars,
    len(regexp_extract_all(s, '[#*$%&|<>]')) as n_symbols, len(l) - len(list_distinct(l)) as n_dup_lines,
    coalesce(n, 0) as n_repeat_words, len(l) as n_lines from split left join covered on covered.doc_id = split.doc_id),
judged as (
  select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed, 10 * n_symbols > n_words as symbols,
    10 * n_dup_lines > 3 * n_lines as lines, word_chars < 3 * n_words or word_chars > 10 * n_words as word_length from counts),
failures as (
  select source, rule, count(*) as n, count_if(failed) as f from (
    select source, unnest(['base', 'symbols', 'lines', 'word_length']) as rule,
      unnest([base_failed, symbols, lines, word_length]) as failed from judged) group by source, rule),
moments as (
  select rule, (sum(f) + 0.5) / (sum(n) + 1) as mean, sum(f * f / n) / sum(n) - (sum(f) / sum(n)) ** 2 as spread,
    count(*) / sum(n) as share from failures group by rule),
priors as (
  select rule, mean, case when spread > mean * (1 - mean) * share
    then least(greatest(mean * (1 - mean) / (spread - mean * (1 - mean) * share) - 1, 1), 1e6) else 1e6 end as strength
  from moments),
rates as (
  select source, rule, (f + mean * strength) / (n + strength) as rate from failures join priors using (rule)),
hosts as (
  select source, max(rate) filter (rule = 'base') >= 0.5 as rejected, max(rate) filter (rule = 'symbols') >= 0.05 as on_symbols,
    max(rate) filter (rule = 'lines') >= 0.05 as on_lines, max(rate) filter (rule = 'word_length') >= 0.05 as on_word_length
  from rates group by source)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, rejected as host_rejected,
  not base_failed and not rejected and broken = '' as kept, broken
from (
  select judged.*, rejected, concat_ws(',', case when symbols and on_symbols then 'symbols' end,
    case when lines and on_lines then 'lines' end, case when word_length and on_word_length then 'word_length' end) as broken
  from judged join hosts on judged.source is not distinct from hosts.source)
"""

_OP13 = """
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) as e from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select a.vec_id as anchor_id, o.vec_id, a.label = o.label as same, list_dot_product(a.e, o.e)::bigint as score
  from v a join v o on a.vec_id % 100 = 0 and a.vec_id <> o.vec_id),
positives as (
  select anchor_id, vec_id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select anchor_id, positive_id, (row_number() over pair)::integer as rank, vec_id as negative_id, positive_score,
  score as negative_score
from positives join scored using (anchor_id)
where not same and 80 * positive_score <= 100 * score and 100 * score <= 100 * positive_score
window pair as (partition by anchor_id, positive_id order by score desc, vec_id)
qualify row_number() over pair <= 5
"""

ORACLE: dict[str, str] = {
    "op1_near_duplicates": _OP1,
    "op3_embedding_near_dedup": _OP3,
    "op4_source_mixing": _OP4,
    "op5_warc": _OP5,
    "op7_exact_top_k": _OP7,
    "op11_fill_in_middle": _OP11,
    "op12_host_rules": _OP12,
    "op13_hard_negatives": _OP13,
}
