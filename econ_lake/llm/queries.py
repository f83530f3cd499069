"""The registered queries of the ``llm`` operators, over whole tables, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from econ_lake.llm import (
    bpe,
    centroids,
    chat,
    decontaminate,
    exact_dedup,
    jaccard_join,
    markov,
    quality,
    resampling,
    sharding,
    substring_dedup,
    token_counts,
    toxicity,
)
from econ_lake.llm.shared import table


def tokenizer_path(spark: SparkSession, name: str) -> str:
    """A vocabulary file of the public tokenizers; ``spark.llm.tokenizers`` names another folder, the same on all
    machines."""
    folder = spark.conf.get("spark.llm.tokenizers", None)
    if folder:
        return f"{folder}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each document without the passages of 20 words or more that occur earlier."""
    return substring_dedup.dedup_digests(table(spark, sf_dir, "documents"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every whole text, and the text decoded from them, as digests."""
    return bpe.encode_digests(table(spark, sf_dir, "documents"), tokenizer_path(spark, "word_bpe_49k.json"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every whole text."""
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_path(spark, "piece_bpe_32k.model"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents."""
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of documents inside 13-word windows of benchmark items."""
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A keyed permutation of all documents into 40 shards whose counts differ by one at most."""
    return sharding.assign(table(spark, sf_dir, "documents"))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one made of control strings, formatted as tokens and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], rows.schema)
    return chat.report(rows.unionByName(extra), tokenizer_path(spark, "byte_bpe_50k.json"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts by the digest index; the largest doc_id stays."""
    return exact_dedup.mark_duplicates(table(spark, sf_dir, "documents"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents that share four fifths of their 5-word shingles."""
    return jaccard_join.similar_groups(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents."""
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of all embeddings after five rounds of k-means on integers."""
    return centroids.clusters(table(spark, sf_dir, "embeddings"))


def op12_markov_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of all documents under a hidden Markov model, and under counts of single words."""
    return markov.score(table(spark, sf_dir, "documents"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A draw from all documents, weighted towards the benchmark's words."""
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (
    op1_substring_dedup, op2_bpe, op3_token_counts, op4_quality, op5_decontaminate, op6_sharding, op7_chat,
    op8_exact_dedup, op9_jaccard_join, op10_toxicity, op11_centroid_clustering, op12_markov_scores,
    op13_importance_resampling)}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE = {
    "op1_substring_dedup": r"""
with d as (
  select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') as w
  from documents
), win as (
  select doc_id, i, array_to_string(w[i:i + 19], ' ') as k from d, unnest(range(1, len(w) - 18)) as r(i)
), later as (
  select doc_id, i from win
  qualify row_number() over (partition by k order by doc_id, i) > 1
), gone as (
  select distinct doc_id, p from later, unnest(range(i, i + 20)) as r(p)
), kept as (
  select d.doc_id, p, w[p] as word from d, unnest(range(1, len(w) + 1)) as r(p)
  where not exists (select 1 from gone where gone.doc_id = d.doc_id and gone.p = r.p)
), t as (
  select doc_id, count(*) as n, string_agg(word, ' ' order by p) as words from kept group by doc_id
)
select d.doc_id, cast(len(w) as bigint) as n_words, cast(len(w) - coalesce(n, 0) as bigint) as n_removed,
       sha256(coalesce(words, '')) as kept_sha256
from d left join t on t.doc_id = d.doc_id
""",
    "op5_decontaminate": f"""
with d as (
  select doc_id, list_filter(regexp_split_to_array({_LOWER}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'),
                             lambda w: w <> '') as w from documents
), b as (
  select item_id, list_filter(regexp_split_to_array({_LOWER}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'),
                              lambda w: w <> '') as w from benchmark
), bw as (
  select distinct item_id, len(w[i:i + 12]) as n, array_to_string(w[i:i + 12], ' ') as win
  from b, unnest(range(1, greatest(len(w) - 12, 1) + 1)) as r(i) where len(w) > 0
), dw as (
  select doc_id, i as pos, k.n, array_to_string(w[i:i + k.n - 1], ' ') as win
  from d, (select distinct n from bw) as k, unnest(range(1, len(w) - k.n + 2)) as r(i)
), found as (
  select dw.doc_id, dw.pos, dw.n, bw.item_id from dw join bw on dw.win = bw.win and dw.n = bw.n
), hit as (
  select doc_id, count(distinct p) as n_hit from found, unnest(range(pos, pos + n)) as r(p) group by doc_id
), items as (
  select doc_id, count(distinct item_id) as n_items,
         array_to_string(list_sort(list(distinct cast(item_id as varchar))), ',') as ids from found group by doc_id
)
select d.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
       cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(ids, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join hit on hit.doc_id = d.doc_id left join items on items.doc_id = d.doc_id
""",
    "op7_chat": r"""
with c as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), e as (
  select *, length(regexp_replace(text, '([<\[])(\\*)(\|startoftext\|>|\|endoftext\|>|\|im_start\|>|\|im_end\|>|'
    '\|turn\|>|\|text\|>|\|end\|>|/INST\]|INST\]|/s>|s>)', '\1\\\2\3', 'g')) as n_escaped from c
), g as (
  select conv_id, count(*) as n_turns,
    string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text) as turns,
    coalesce(string_agg(case when role = 'assistant' then text end, '' order by turn, role, text), '') as loss,
    sum(n_escaped + length(role) + 23) as formatted
  from e group by conv_id
)
select conv_id, n_turns, sha256(turns) as turns_sha256, cast(length(loss) as bigint) as loss_chars,
       sha256(loss) as loss_sha256, cast(formatted as bigint) as formatted_chars from g
""",
    "op9_jaccard_join": f"""
with recursive d as (
  select doc_id, list_filter(regexp_split_to_array({_LOWER}, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as w
  from documents
), s as (
  select distinct doc_id, array_to_string(w[i:i + 4], ' ') as k
  from d, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as r(i) where len(w) > 0
), n as (
  select doc_id, count(*) as n from s group by doc_id
), common as (
  select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.k = b.k and a.doc_id <> b.doc_id
  group by a.doc_id, b.doc_id
), link as (
  select a, b from common join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 80 * (x.n + y.n - c)
), reach as (
  select doc_id as a, doc_id as b from d union select reach.a, link.b from reach join link on link.a = reach.b
)
select d.doc_id, coalesce(n, 0) as n_shingles, least_id as component_id
from d left join n on n.doc_id = d.doc_id
join (select a, min(b) as least_id from reach group by a) m on m.a = d.doc_id
""",
    "op8_exact_dedup": f"""
with t as (select doc_id, sha256({_LOWER}) as text_sha256 from documents)
select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size,
       doc_id = max(doc_id) over w as kept, text_sha256
from t window w as (partition by text_sha256)
""",
}


def _kmeans_sql(clusters: int = 40, rounds: int = 5) -> str:
    """Rounds of assignment and floored means, one after the other."""
    apart = "list_sum(list_transform(list_zip(v.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    parts = ["""v as materialized (
  select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
  from embeddings where len(embedding) = 64
    and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = 64
)""", f"""c0 as materialized (
  select row_number() over (order by sha256('2:' || vec_id)) - 1 as c, v from v
  order by sha256('2:' || vec_id) limit {clusters}
)"""]
    for k in range(rounds + 1):
        parts.append(f"""a{k} as materialized (
  select vec_id, v.v as v, min(({apart}, c)) as best from v, c{k} as c group by vec_id, v.v
)""")
        if k < rounds:
            parts.append(f"""m{k} as materialized (
  select c, list((s - ((s % n) + n) % n) // n order by i) as v from (
    select best[2] as c, i, cast(sum(v[i]) as bigint) as s, count(*) as n
    from a{k}, unnest(range(1, 65)) as r(i) group by best[2], i) group by c
), c{k + 1} as materialized (
  select c{k}.c, coalesce(m{k}.v, c{k}.v) as v from c{k} left join m{k} on m{k}.c = c{k}.c
)""")
    return "with " + ", ".join(parts) + f"""
select vec_id, cast(best[2] as integer) as "cluster", cast(best[1] as bigint) as distance,
       cast(sum(best[1]) over (partition by best[2]) as bigint) as cluster_inertia,
       cast(sum(best[1]) over () as bigint) as inertia, sha256(array_to_string(c.v, ',')) as centroid_sha256
from a{rounds} join c{rounds} as c on c.c = best[2]
"""


_WORDS = f"list_filter(regexp_split_to_array({_LOWER}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')"

ORACLE["op11_centroid_clustering"] = _kmeans_sql()
# the checksum: each byte is added to the register and moved out by eight steps (the -1 entries)
ORACLE["op13_importance_resampling"] = f"""
with d as (
  select doc_id, row_number() over () as nth, {_WORDS} as w from documents
), b as (
  select unnest({_WORDS}) as word from benchmark
), f as (
  select doc_id, nth, unnest(w) as word from d
), bits as (
  select word, flatten(list_transform(range(1, cast(length(x) / 2 as bigint) + 1), lambda i:
    list_concat([cast(('0x' || x[2 * i - 1:2 * i]) as bigint)], [-1, -1, -1, -1, -1, -1, -1, -1]))) as steps
  from (select word, hex(encode(word)) as x from (select word from f union select word from b))
), crc as materialized (
  select word, xor(list_reduce(list_concat([cast(4294967295 as bigint)], steps), lambda a, x:
    case when x >= 0 then xor(a, x) when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end), 4294967295) % 10000
    as bucket from bits
), s as (
  select bucket, count(*) as n from f join crc using (word) group by bucket
), t as (
  select bucket, count(*) as n from b join crc using (word) group by bucket
), gain as (
  select bucket, cast(floor(1000 * ln((cast(coalesce(t.n, 0) + 1 as double)
      * cast((select count(*) from f) + 10000 as double)) / (cast(s.n + 1 as double)
      * cast((select count(*) from b) + 10000 as double)))) as bigint) as g
  from s left join t using (bucket)
), weight as (
  select nth, cast(sum(g) as bigint) as weight from f join crc using (word) join gain using (bucket) group by nth
), scored as (
  select doc_id, len(w) as n, coalesce(weight, 0) as weight, coalesce(weight, 0) + cast(floor(-1000 * ln(-ln(
      (cast(cast(('0x' || sha256('2024:' || doc_id)[1:8]) as bigint) as double) + 0.5) / 4294967296))) as bigint)
      as score
  from d left join weight using (nth)
), ranked as (
  select *, row_number() over (order by n < 20, score desc, doc_id) as place from scored
)
select doc_id, cast(n as bigint) as n_features, weight, score,
       case when place <= 10 * (select count(*) from scored where n >= 20) // 100 then place end as rank,
       cast(n as bigint) as n_words
from ranked
"""
