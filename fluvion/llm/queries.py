"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import audio, codes, counting, fill_middle, languages, mixing, near_duplicates, ordering, packing, passages, sharding, toxicity, vectors
from .common import table


def op1_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token-id sequences in training order."""
    return ordering.materialise(table(spark, sf_dir, "documents"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document, with its source's size and target."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op3_audio_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recordings rendered from vectors: those whose id 50 divides, aligned with all."""
    return audio.align(audio.fingerprints(audio.rendered(table(spark, sf_dir, "embeddings"))))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probabilities of every document and whether it is rejected."""
    scored = toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "p_low_quality", "p_toxic", "rejected")


def op5_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document and its place in a sequence."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op6_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, removed words and a digest of the kept ones, of every document."""
    return passages.digest(passages.remove_passages(table(spark, sf_dir, "documents")))


def op7_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document, by the law rows: counts differ by one at most."""
    rows = sharding.external_shuffle(table(spark, sf_dir, "documents"))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 8
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    return rows.select("doc_id", size.alias("size"), crc.alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class, component and whether it is kept, of every document."""
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "component_id", "kept")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    return counting.count_tokens(table(spark, sf_dir, "documents"))


def op10_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, component and whether it is kept, of every vector."""
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op11_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from four fifths of them."""
    docs = table(spark, sf_dir, "documents")
    found = languages.identify(docs.select("doc_id", "text"), languages.fit(languages.learned(docs)))
    return found.select("doc_id", languages.held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and error of every vector that has finite components."""
    return codes.compress(table(spark, sf_dir, "embeddings"))


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How every document is cut, with digests of the output and of the text rebuilt from it."""
    cut = fill_middle.fill_in_middle(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(fill_middle.restored(), 256).alias("restored_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_training_order, op2_mix_sources, op3_audio_fingerprints, op4_toxicity, op5_pack, op6_passages, op7_shards, op8_near_duplicates, op9_token_counts, op10_near_vectors, op11_languages, op12_vector_codes, op13_fill_middle)
}

#: Words as the operators have them.
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

def _refined(k: int) -> str:
    """One round over books k: every part's nearest entry, then the entries' means as books k + 1."""
    return f"""
near{k} as (select r, p, min(d * 64 + e) as best from (
  select r, p, e, sum((x - y) * (x - y))::bigint as d from comps join books{k} using (p, j) group by r, p, e) group by r, p),
means{k} as (select p, best % 64 as e, j, floor(sum(x)::double / count(*))::bigint as y from near{k} join comps using (r, p) group by 1, 2, 3),
books{k + 1} as (select b.p, b.e, b.j, coalesce(m.y, b.y) as y from books{k} b left join means{k} m on b.p = m.p and b.e = m.e and b.j = m.j)"""


SQL: dict[str, str] = {
    "op2_mix_sources": f"""
with recursive sized as (select doc_id, source, len({_WORDS})::bigint as size from documents),
sums as (select source, sum(size)::bigint as source_size from sized group by source),
weighed as (select source, source_size, 1 + (row_number() over (order by source nulls last) - 1) % 3 as weight, 3 * source_size as cap from sums),
levels as (
  select 0 as turn, (select sum(source_size) from weighed)::double / (select sum(weight) from weighed) as level
  union all
  select turn + 1, (select sum(source_size) - coalesce(sum(cap) filter (where cap <= weight * level), 0) from weighed)::double
    / nullif((select sum(weight) filter (where cap > weight * level) from weighed), 0)
  from levels where turn < 200 and level is not null),
final as (select max(level) as level from levels),
target as (select source, source_size, least(cap::double, case when cap <= weight * level then cap::double else weight * level end) as target from weighed, final),
rates as (select source, source_size, target, case when source_size > 0 then least(target / source_size, 3.0) else 0 end as rate from target),
drawn as (select doc_id, s.source, size, source_size, target, k,
  size * (floor(rate) + case when ('0x' || substr(md5('mix-' || k || ':' || coalesce(doc_id::varchar, 'null')), 1, 12))::bigint / 281474976710656.0::double < rate - floor(rate) then 1 else 0 end) as taken
  from sized s join rates r on s.source is not distinct from r.source, range(16) t(k)),
seeds as (select source, k, abs(sum(taken) - any_value(target)) as off from drawn group by 1, 2),
best as (select source, k from seeds qualify row_number() over (partition by source order by off, k) = 1)
select doc_id, size, source_size, target, taken::bigint as taken from drawn d join best b on d.k = b.k and d.source is not distinct from b.source
""",
    "op6_passages": f"""
with texts as (select row_number() over () as r, doc_id, {_WORDS} as ws from documents),
windows as (select r, i, array_to_string(ws[i:i+34], ' ') as w from (select r, ws, unnest(range(1, len(ws) - 33)) as i from texts where len(ws) >= 35)),
again as (select w from windows group by w having count(*) > 1),
gone as (select distinct r, unnest(range(i, i + 35)) as p from windows join again using (w)),
words as (select r, unnest(ws) as word, generate_subscripts(ws, 1) as p from texts),
kept as (select words.r, count(gone.p) as n_removed, string_agg(word, ' ' order by p) filter (where gone.p is null) as t
  from words left join gone using (r, p) group by words.r)
select doc_id, len(ws)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed, sha256(coalesce(t, '')) as kept_sha256
from texts left join kept using (r)
""",
    "op8_near_duplicates": f"""
with recursive texts as (select doc_id, {_WORDS} as ws from documents),
worded as (select min(doc_id) as id, ws from texts where len(ws) > 0 group by ws),
shingles as (select id, s, count(*) as n from (
  select id, array_to_string(ws[i:i+4], ' ') as s from (select id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) as i from worded)) group by id, s),
totals as (select id, sum(n) as total from shingles group by id),
pairs as (select a.id as x, b.id as y, sum(least(a.n, b.n)) as common from shingles a join shingles b on a.s = b.s and a.id < b.id group by 1, 2),
links as (select x, y from pairs join totals t on x = t.id join totals u on y = u.id where common / (t.total + u.total - common) >= 0.8),
edges as (select x, y from links union all select y, x from links),
reach as (select id, id as other from worded union select reach.id, edges.y from reach join edges on reach.other = edges.x),
parts as (select id, min(other) as component_id from reach group by id)
select doc_id, w.id as class_id, component_id, doc_id = component_id as kept from texts join worded w using (ws) join parts on parts.id = w.id
union all select doc_id, doc_id, doc_id, true from texts where len(ws) = 0
""",
    "op10_near_vectors": """
with recursive v as (select vec_id, embedding::double[] as e from embeddings),
links as (select a.vec_id as x, b.vec_id as y from v a join v b on a.vec_id <> b.vec_id where list_cosine_similarity(a.e, b.e) >= 0.95),
reach as (select vec_id, vec_id as other from v union select reach.vec_id, links.y from reach join links on reach.other = links.x),
parts as (select vec_id, min(other) as component_id from reach group by vec_id),
degrees as (select x as vec_id, count(*) as n_links from links group by x)
select vec_id, coalesce(n_links, 0)::bigint as n_links, component_id, vec_id = component_id as kept from parts left join degrees using (vec_id)
""",
    "op12_vector_codes": f"""
with kept as (select row_number() over (order by vec_id) as r, vec_id, label, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as q
  from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
places as (select r, unnest(q) as x, generate_subscripts(q, 1) - 1 as i, len(q) // 16 as wide from kept),
comps as (select r, i // wide as p, i % wide as j, x from places),
books0 as (select p, r - 1 as e, j, x as y from comps where r <= 64),{_refined(0)},{_refined(1)},{_refined(2)},
coded as (select r, string_agg(format('{{:02x}}', best % 64), '' order by p) as code, sum(best // 64)::bigint as error from near2 group by r),
sums as (select label, sum(error)::bigint as label_error from kept join coded using (r) group by label)
select vec_id, code, error, label_error, (select sha256(string_agg(y::varchar, ',' order by p, e, j)) from books2) as codebooks_sha256, k.label
from kept k join coded using (r) join sums s on k.label is not distinct from s.label
""",
    "op13_fill_middle": r"""
with texts as (select doc_id, coalesce(text, '') as t, sha256('42:' || coalesce(doc_id::varchar, 'null')) as h from documents),
drawn as (select doc_id, t, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as tokens,
  ('0x' || h[1:8])::bigint as h1, ('0x' || h[9:16])::bigint as h2, ('0x' || h[17:24])::bigint as h3, ('0x' || h[25:32])::bigint as h4 from texts),
cuts as (select *, len(tokens)::bigint as n, least(h1 % (len(tokens) + 1), h2 % (len(tokens) + 1)) as a, greatest(h1 % (len(tokens) + 1), h2 % (len(tokens) + 1)) as b,
  case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 50 then 'plain' when h4 % 100 < 80 then 'spm' else 'psm' end as form from drawn),
parts as (select *, array_to_string(tokens[1:a], '') as p, array_to_string(tokens[a + 1:b], '') as m, array_to_string(tokens[b + 1:], '') as s from cuts)
select doc_id, n, form, case when form <> 'plain' then length(p) end as prefix_chars, case when form <> 'plain' then length(m) end as middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256, sha256(t) as restored_sha256
from parts
""",
}
