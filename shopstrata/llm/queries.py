"""One query for each operator of this package, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import chat, codes, decontaminate, embeddings, fingerprints, licenses, minhash, packing, quality, secrets, token_counts, token_files, tries

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

WORDS_49K, BYTES_50K = "word_bpe_49k.json", "byte_bpe_50k.json"


def query(make: Query) -> Query:
    QUERIES[make.__name__] = make
    return make


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query
def op1_quality(spark, sf_dir):
    docs = documents(spark, sf_dir)
    weights = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs, weights, keep=["doc_id"]).withColumn("held_out", quality.held_out("doc_id"))


@query
def op2_token_counts(spark, sf_dir):
    return token_counts.token_counts(documents(spark, sf_dir), public_tokenizers.path(WORDS_49K), keep=["doc_id"])


@query
def op3_embeddings(spark, sf_dir):
    return embeddings.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), cosine=0.93)


_FINITE = "len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(e, lambda x: x != 0)) > 0"
ORACLE["op3_embeddings"] = f"""
with recursive vectors as materialized (
  select vec_id, label, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) as size
  from (select vec_id, label, cast(embedding as double[]) as e from embeddings)
  where label is not null and e is not null and {_FINITE}
),
links as materialized (
  select x.vec_id as a, y.vec_id as b from vectors x join vectors y on x.label = y.label and x.vec_id != y.vec_id
  where len(x.e) = len(y.e) and list_dot_product(x.e, y.e) / (x.size * y.size) >= 0.93
),
reached(vec_id, other) as (
  select vec_id, vec_id from embeddings
  union select r.vec_id, l.b from reached r join links l on l.a = r.other
)
select vec_id, coalesce(any_value(n), 0) as n_links, min(other) as component_id, vec_id = min(other) as kept
from reached left join (select a as vec_id, count(*) as n from links group by a) using (vec_id) group by vec_id
"""


@query
def op4_secrets(spark, sf_dir):
    return secrets.scan(documents(spark, sf_dir), words=secrets.ranked_words(public_tokenizers.path(WORDS_49K)), keep=["doc_id"])


@query
def op5_token_files(spark, sf_dir):
    files = token_files.write(documents(spark, sf_dir), public_tokenizers.path(WORDS_49K), end_id=1)
    return token_files.read(files)


@query
def op6_chat(spark, sf_dir):
    said = "</s>[INST] ok [/INST]"
    more = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"),
    )
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").unionByName(more)
    out = chat.transcripts(chat.as_replies(rows), "conv_id", "node", "parent")
    turns = chat.read_turns(F.col("formatted"))
    lines = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = chat.read_loss(F.col("formatted"), F.col("loss_spans"))
    return out.select(
        "conv_id", F.size(turns).cast("long").alias("n_turns"), F.sha2(lines.cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def _escaped(column: str) -> str:
    out = f"replace({column}, '\\', '\\\\')"
    for control in (chat.OPEN, chat.CLOSE, chat.ROLE, chat.TEXT):
        out = f"replace({out}, '{control}', '{control[0]}\\{control[1:]}')"
    return out


_MARKS = len(f"{chat.OPEN}{chat.ROLE}  {chat.TEXT}{chat.CLOSE}")
ORACLE["op6_chat"] = f"""
with said as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
  cast(sum({_MARKS} + length({_escaped('role')}) + length({_escaped('text')})) as bigint) as formatted_chars
from said group by conv_id
"""


@query
def op7_decontamination(spark, sf_dir):
    found = decontaminate.marked(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), keep=["doc_id"])
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def _words_sql(pattern: str) -> str:
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"regexp_extract_all(translate(coalesce(text, ''), '{capitals}', '{capitals.lower()}'), '{pattern}')"


_LETTERS_SQL = _words_sql(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ORACLE["op7_decontamination"] = f"""
with docs as materialized (select doc_id, {_LETTERS_SQL} as w from documents),
items as (select cast(item_id as varchar) as item_id, {_LETTERS_SQL} as w from benchmark),
sized as (select item_id, w, least(10, len(w)) as m from items where len(w) > 0),
patterns as (
  select distinct item_id, m, array_to_string(w[i : i + m - 1], ' ') as p
  from (select item_id, w, m, unnest(range(1, len(w) - m + 2)) as i from sized)
),
places as (
  select doc_id, i, m, array_to_string(w[i : i + m - 1], ' ') as p
  from (select doc_id, w, m, unnest(range(1, len(w) - m + 2)) as i
        from docs cross join (select distinct m from sized) as sizes where len(w) >= m)
),
hits as materialized (select doc_id, i, m, item_id from places join patterns using (m, p)),
hit_words as (select doc_id, count(distinct k) as n from (select doc_id, unnest(range(i, i + m)) as k from hits) group by doc_id),
hit_items as (
  select doc_id, count(*) as n, string_agg(item_id, ',' order by item_id) as listed
  from (select distinct doc_id, item_id from hits) group by doc_id
)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(hit_words.n, 0) as n_hit, coalesce(hit_items.n, 0) as n_items,
  sha256(coalesce(listed, '')) as items_sha256, hit_words.n is not null as contaminated
from docs left join hit_words using (doc_id) left join hit_items using (doc_id)
"""


CONTRACT = minhash.Likeness(size=3, above=85, below=100)


@query
def op8_minhash(spark, sf_dir):
    return minhash.near_duplicates(documents(spark, sf_dir), CONTRACT)


_VISIBLE_SQL = _words_sql(r"[^\x20\x09-\x0D]+")
ORACLE["op8_minhash"] = f"""
with recursive docs as materialized (select doc_id, {_VISIBLE_SQL} as w from documents),
shingles as materialized (
  select distinct doc_id, array_to_string(w[i : i + 2], ' ') as s
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) as i from docs where len(w) > 0)
),
sizes as materialized (select doc_id, count(*) as n from shingles group by doc_id),
links as materialized (
  select a, b from (
    select x.doc_id as a, y.doc_id as b, count(*) as shared from shingles x join shingles y using (s)
    where x.doc_id != y.doc_id group by 1, 2
  ) join sizes m on m.doc_id = a join sizes n on n.doc_id = b
  where 100 * shared >= 85 * (m.n + n.n - shared)
),
reached(doc_id, other) as (
  select doc_id, doc_id from docs
  union select r.doc_id, l.b from reached r join links l on l.a = r.other
)
select doc_id, cast(coalesce(any_value(n), 0) as bigint) as n_shingles, min(other) as component_id, doc_id = min(other) as kept
from reached left join sizes using (doc_id) group by doc_id
"""


@query
def op9_licenses(spark, sf_dir):
    found = licenses.scan(documents(spark, sf_dir), keep=["doc_id"])
    part = lambda m: F.concat_ws(":", m["license"], m["begin"], m["end"], F.format_number(m["coverage"], 3))
    return found.select(
        "doc_id", "n_licenses", F.array_join("licenses", ",").alias("licenses"),
        F.array_join(F.transform("matches", part), ",").alias("spans"),
    )


@query
def op10_best_fit_packing(spark, sf_dir):
    return packing.packed(documents(spark, sf_dir), public_tokenizers.path(BYTES_50K), end_id=2, capacity=1024)


@query
def op11_fingerprints(spark, sf_dir):
    pairs = fingerprints.edited(documents(spark, sf_dir))
    own, other, after = F.col("sketch"), F.col("edited_sketch"), F.col("next_sketch")
    found = pairs.select(
        "doc_id", "copies", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprints.as_text(own).alias("fingerprint"), fingerprints.as_text(other).alias("edited_fingerprint"),
        fingerprints.resemblance(own, other).alias("near_edited"), fingerprints.resemblance(own, after).alias("near_next"),
        fingerprints.containment(own, other).alias("kept_in_edited"), fingerprints.distinct_shingles(own).alias("n_shingles"),
    )
    return fingerprints.repeated(found)


FAMILY, SHARED_TURNS = 20, 3


@query
def op12_prefix_trie(spark, sf_dir):
    lists = tries.turn_lists(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    found = tries.nodes(tries.paths(tries.with_shared_starts(lists, FAMILY, SHARED_TURNS)))
    return found.select(
        F.col("conv").alias("conv_id"), F.col("depth").cast("long").alias("depth"), F.col("parent_conv").alias("parent_conv_id"),
        F.col("n").alias("n_convs"), F.col("kids").alias("n_children"), F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), "ends_sha256",
    )


_CRC32 = """xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(c::varchar, ''), lambda s: ord(s)::bigint)),
  lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, k: xor(x >> 1, 3988292384::bigint * (x & 1)))), 4294967295::bigint)"""
ORACLE["op12_prefix_trie"] = f"""
with said as materialized (
  select conv_id as c, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as i,
    sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) as turn,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as words
  from conversations where conv_id is not null
),
ids as (select c, c - c % {FAMILY} as base, {_CRC32} % {SHARED_TURNS + 1} as h from (select distinct c from said)),
rebuilt as (
  select ids.c, 0 as own, i, turn, words from ids join said on said.c = base where i <= h
  union all select ids.c, 1, i, turn, words from ids join said on said.c = ids.c where i > h
),
placed as (select c, row_number() over (partition by c order by own, i) as d, turn, words from rebuilt),
prefixes as materialized (
  select c, d, words, string_agg(turn, '') over (partition by c order by d rows unbounded preceding) as path from placed
  union all select c, 0, 0, '' from ids
),
nodes as materialized (select d, path, min(c) as c, count(*) as n, any_value(words) as words from prefixes group by d, path),
inner_nodes as (select substr(path, 1, 64 * (d - 1)) as path, count(*) as kids from nodes where d > 0 group by 1),
marked as (select nodes.*, coalesce(kids, 0) as kids from nodes left join inner_nodes using (path)),
subtrees as (
  select substr(path, 1, 64 * g) as path, count(*) filter (kids = 0) as leaves, sum((n - 1) * words) as saved
  from (select *, unnest(range(0, d + 1)) as g from marked) group by 1
),
ends as (select path, string_agg(c::varchar, ',' order by c) as listed from (select c, arg_max(path, d) as path from prefixes group by c) group by path)
select m.c as conv_id, m.d as depth, p.c as parent_conv_id, m.n as n_convs, m.kids as n_children, leaves as n_leaves,
  cast(saved as bigint) as saved_tokens, sha256(coalesce(listed, '')) as ends_sha256
from marked m join subtrees using (path) left join ends using (path)
left join nodes p on m.d > 0 and p.d = m.d - 1 and p.path = substr(m.path, 1, 64 * (m.d - 1))
"""


@query
def op13_vector_codes(spark, sf_dir):
    found = codes.compressed(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return found.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def _codes_sql() -> str:
    ctes = [
        f"""vectors as materialized (
  select vec_id, label, list_transform(embedding, lambda x: floor({codes.SCALE} * x::double)::bigint) as v, len(embedding) // {codes.PARTS} as w
  from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
)""",
        f"parts as materialized (select vec_id, label, p, v[p * w + 1 : (p + 1) * w] as v from vectors, range({codes.PARTS}) t(p))",
        f"book0 as materialized (select p, dense_rank() over (order by vec_id) - 1 as k, v as c from parts where vec_id in (select vec_id from vectors order by vec_id limit {codes.ENTRIES}))",
    ]
    for i in range(codes.ROUNDS + 1):
        ctes.append(f"""near{i} as materialized (
  select vec_id, label, p, v, best.d as d, best.k as k from (
    select vec_id, label, p, v, min({{'d': list_sum(list_transform(list_zip(v, c), lambda t: (t[1] - t[2]) * (t[1] - t[2])))::bigint, 'k': k}}) as best
    from parts join book{i} using (p) group by all)
)""")
        if i < codes.ROUNDS:
            ctes.append(f"""book{i + 1} as materialized (
  select p, k, coalesce(n.c, o.c) as c from book{i} o left join (
    select p, k, list((s - (((s % n) + n) % n)) // n order by j) as c
    from (select p, k, j, sum(v[j])::bigint as s, count(*) as n from (select p, k, v, unnest(range(1, len(v) + 1)) as j from near{i}) group by all)
    group by p, k) n using (p, k)
)""")
    return f"""with {', '.join(ctes)},
coded as (select vec_id, label, string_agg(lpad(lower(to_hex(k)), 2, '0'), '' order by p) as code, sum(d)::bigint as error from near{codes.ROUNDS} group by vec_id, label)
select vec_id, code, error, sum(error) over (partition by label)::bigint as label_error,
  (select sha256(string_agg(array_to_string(c, ','), ',' order by p, k)) from book{codes.ROUNDS}) as codebooks_sha256
from coded"""


ORACLE["op13_vector_codes"] = _codes_sql()
