"""The registered queries of the operators and the SQL that must give the same rows, where SQL can tell."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridplume.llm import (
    dart_minhash,
    de_bruijn,
    decontaminate,
    exact_dedup,
    html_blocks,
    language_id,
    mixing,
    pii_anchors,
    secret_scan,
    threshold_join,
    token_count,
    toxicity_crf,
    va_file,
)
from gridplume.llm.common import table


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_dedup.classes(table(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dart_minhash.classes(table(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), "class_id", "group_size", "kept")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.withColumnRenamed("id", "doc_id")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    rows = token_count.counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return rows.withColumnRenamed("id", "doc_id")


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_blocks.extract(table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_anchors.scan(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page by all evidence, and every document by text and source; a row has a page_id or a doc_id."""
    docs = table(spark, sf_dir, "documents")
    model = language_id.learn(docs)
    pages = language_id.identify(table(spark, sf_dir, "pages"), docs, model=model).withColumnRenamed("id", "page_id")
    texts = language_id.identify_texts(docs, model=model).withColumnRenamed("id", "doc_id")
    return pages.unionByName(texts, allowMissingColumns=True)


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


OP6_SQL = """
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
  doc_id = max(doc_id) over same as kept, sha256(content) as text_sha256
from (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as content
  from documents)
window same as (partition by content)
"""


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(mixing.mix(table(spark, sf_dir, "documents")))


OP2_SQL = r"""
with sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
    md5('mix|' || coalesce(cast(doc_id as varchar), '')) as key
  from documents),
ranked as (
  select *, cast([5, 2, 1][(ix - 1) % 3 + 1] as bigint) as weight, source_size * 3 as most
  from (select source, cast(sum(size) as bigint) as source_size, row_number() over (order by source nulls last) as ix
    from sized group by source)),
levels as (
  select *, cast(sum(source_size) over () - (sum(most) over before - most) as bigint)
    / cast(sum(weight) over (order by most / weight, ix rows between current row and unbounded following) as bigint) as level
  from ranked
  window before as (order by most / weight, ix rows between unbounded preceding and current row)),
targets as (
  select *, cast(floor(target) as bigint) as words
  from (select *, least(cast(most as double), max(level) over () * weight) as target from levels)),
stretches as (
  select *, coalesce(lag(high) over (order by ix), 0) as low
  from (select ix, cast(floor(cast(sum(words) over (order by ix rows between unbounded preceding and current row) as bigint)
      / cast(sum(words) over () as bigint) * 2147483648.0) as bigint) as high
    from targets where words > 0)),
points as (
  select slot, ((slot + 1) % 2147483648) * 1327217885 % 2147483648 as u
  from (select unnest(range(cast((sum(size) + 128) // 256 as bigint))) as slot from sized)),
mapped as (
  select slot, ix, row_number() over (partition by ix order by slot) - 1 as rank
  from points join stretches on u >= low and u < high),
slots as (
  select ix, rank from mapped
  union all select ix, 0 from targets where words > 0 and ix not in (select ix from mapped)),
sources as (
  select targets.*, least(coalesce(n, 0), words) as n
  from targets left join (select ix, count(*) as n from slots group by ix) using (ix)),
rows as (
  select doc_id, size, s.*, row_number() over () as row_id,
    cast(sum(size) over (partition by s.ix order by key, doc_id nulls first, size rows between unbounded preceding and current row)
      as bigint) - size as start
  from sized d join sources s on d.source is not distinct from s.source),
passes as (
  select *, pass * source_size + start as low, least(pass * source_size + start + size, words) as high,
    words // n as base, words % n as more
  from (select *, unnest(range((words - 1) // source_size + 1)) as pass from rows where size > 0 and n > 0)),
cut as (
  select row_id, ix, unnest(range(
      case when low < more * (base + 1) then low // (base + 1) else more + (low - more * (base + 1)) // base end,
      case when high - 1 < more * (base + 1) then (high - 1) // (base + 1)
        else more + (high - 1 - more * (base + 1)) // base end + 1)) as rank,
    low, high, base, more
  from passes where low < high),
pieces as (
  select row_id, least(high, (rank + 1) * base + least(rank + 1, more)) - greatest(low, rank * base + least(rank, more)) as piece
  from cut join slots using (ix, rank))
select doc_id, size, source, source_size, target, cast(coalesce(taken, 0) as bigint) as taken
from rows left join (select row_id, sum(piece) as taken from pieces group by row_id) using (row_id)
"""


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = toxicity_crf.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return rows.withColumnRenamed("id", "doc_id")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.pmod("vec_id", F.lit(7)) == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label"))
    return threshold_join.mine(rows.withColumn("label", moved))


#: Vectors as whole numbers, of the rows that take part.
_VECTORS = """
select row_number() over () as rid, vec_id as id, label, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
from embeddings
where embedding is not null and coalesce(list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(cast(x as double)))), true)
"""

OP11_SQL = f"""
with v as (
  select rid, id, v, case when id % 7 = 0 then (label + 1) % 10 else label end as label from ({_VECTORS}) where label is not null),
scored as (
  select a.rid, a.id as anchor_id, c.id, a.label = c.label as same, cast(list_dot_product(a.v, c.v) as bigint) as score
  from v a, v c where a.id % 100 = 0 and a.rid <> c.rid),
positives as (
  select rid, anchor_id, id as positive_id, score as positive_score, place
  from (select *, row_number() over (partition by rid order by score desc, id) as place from scored where same) where place <= 5),
ranked as (
  select p.*, s.id as negative_id, s.score as negative_score,
    row_number() over (partition by p.rid, p.place order by s.score desc, s.id) as rank
  from positives p join scored s on p.rid = s.rid and not s.same
    and 30 * p.positive_score <= 100 * s.score and 100 * s.score <= 90 * p.positive_score)
select anchor_id, positive_id, cast(rank as integer) as rank, negative_id, positive_score, negative_score from ranked where rank <= 10
"""


def op12_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return va_file.top_k(table(spark, sf_dir, "embeddings"))


OP12_SQL = f"""
with v as ({_VECTORS})
select query_id, cast(rank as integer) as rank, vec_id, score
from (
  select query_id, vec_id, score, row_number() over (partition by rid order by score desc, vec_id) as rank
  from (
    select q.rid, q.id as query_id, c.id as vec_id, cast(list_dot_product(q.v, c.v) as bigint) as score
    from v q, v c where q.id % 50 = 0 and q.rid <> c.rid))
where rank <= 5
"""


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return de_bruijn.collocations(de_bruijn.build(table(spark, sf_dir, "documents")))


OP13_SQL = r"""
with recursive pieces as (
  select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w
  from (
    select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
    from documents)),
starts as (select lang, w, unnest(range(1, len(w) + 1)) as i from pieces where len(w) > 0),
totals as (select lang, count(*) as n from starts group by lang),
phrases as (
  select lang, k, phrase, count(*) as f
  from (
    select lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') as phrase
    from starts, (select unnest(range(1, 6)) as k) where i + k - 1 <= len(w))
  group by all having count(*) >= 100),
split as (select lang, k, phrase, f, string_split(phrase, ' ') as w from phrases),
held as (
  select lang, part, max(f) as f
  from (
    select lang, array_to_string(list_slice(w, i, i + k2 - 1), ' ') as part, f
    from (select *, unnest(range(1, k)) as k2 from split), (select unnest(range(1, 6)) as i) where i + k2 - 1 <= k)
  group by lang, part),
candidates as (
  select s.* from split s left join held h on s.lang = h.lang and s.phrase = h.part where s.k > 1 and not coalesce(100 * h.f >= 100 * s.f, false)),
cuts as (
  select *, array_to_string(list_slice(w, 1, cut), ' ') as first, array_to_string(list_slice(w, cut + 1, k), ' ') as rest
  from (select *, unnest(range(1, k)) as cut from candidates)),
scored as (
  select c.lang, c.phrase, c.k, c.f as a, x.f as l, y.f as r, n,
    cast(cast(1000 as hugeint) * c.f * n // (cast(x.f as hugeint) * y.f) as bigint) as score, cut
  from cuts c join phrases x on c.lang = x.lang and c.first = x.phrase join phrases y on c.lang = y.lang and c.rest = y.phrase
    join totals t on c.lang = t.lang),
worst as (select * from (select *, row_number() over (partition by lang, phrase order by score, cut) as place from scored) where place = 1),
edges as (
  select lang, phrase, f, array_to_string(list_slice(w, 1, 4), ' ') as head, array_to_string(list_slice(w, 2, 5), ' ') as tail from split where k = 5),
links as (
  select x.lang, x.phrase as before, y.phrase
  from edges x join phrases v on x.lang = v.lang and x.tail = v.phrase and x.f = v.f
    join edges y on y.lang = v.lang and y.head = v.phrase and y.f = v.f),
walk as (
  select lang, phrase as path, phrase, 5 as words from edges where (lang, phrase) not in (select lang, phrase from links)
  union all
  select w.lang, w.path, l.phrase, w.words + 1 from walk w join links l on w.lang = l.lang and w.phrase = l.before),
long_paths as (select lang, phrase, max(words) over (partition by lang, path) as path_words from walk)
select w.lang, rank, w.phrase, a, l, r, n, score, cast(coalesce(path_words, k) as bigint) as path_words
from (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from worst) w
  left join long_paths p on w.lang = p.lang and w.phrase = p.phrase
where rank <= 2000
"""


QUERIES = {
    "op1_near_dedup": op1_near_dedup,
    "op2_mixing": op2_mixing,
    "op3_decontamination": op3_decontamination,
    "op4_secret_scan": op4_secret_scan,
    "op5_token_counts": op5_token_counts,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_html_text": op7_html_text,
    "op8_personal_data": op8_personal_data,
    "op9_toxicity": op9_toxicity,
    "op10_language_id": op10_language_id,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_vector_search": op12_vector_search,
    "op13_collocations": op13_collocations,
}
ORACLE = {
    "op2_mixing": OP2_SQL,
    "op6_exact_dedup": OP6_SQL,
    "op11_hard_negatives": OP11_SQL,
    "op12_vector_search": OP12_SQL,
    "op13_collocations": OP13_SQL,
}
