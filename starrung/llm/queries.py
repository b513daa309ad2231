"""The numbered queries over the document tables, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starrung.llm.bpe import decode_documents, encode_documents
from starrung.llm.centroids import CLUSTERS, DIMENSIONS, ROUNDS, SCALE, SEED, cluster_vectors
from starrung.llm.decontam import find_benchmark
from starrung.llm.exact import exact_duplicates
from starrung.llm.infill import fill_in_middle, restore_middle
from starrung.llm.jaccard import jaccard_components
from starrung.llm.language import identify_language
from starrung.llm.lattice import lattice_likelihood
from starrung.llm.lines import remove_shared_lines
from starrung.llm.mixing import mix
from starrung.llm.pii import BASE, KINDS, count_of, find_personal_data, listed
from starrung.llm.quality import score_quality
from starrung.llm.tables import fold, scratch, table
from starrung.llm.toxicity import find_toxicity

Query = Callable[[SparkSession, str], DataFrame]


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    third = fold(F.col("doc_id"), 3)
    found = identify_language(docs, third != 1)
    return found.select("doc_id", (third == 1).alias("held_out"), "lang_pred", "score", "margin")


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = jaccard_components(scratch(spark, f"op2_jaccard_join {sf_dir}"), table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_shingles", "component_id")


OP2_SQL = r"""
with recursive words as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents
), sets as (
    select doc_id, case when len(w) = 0 then []::varchar[] when len(w) < 5 then [array_to_string(w, ' ')]
        else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) end as s
    from words
), elements as materialized (select doc_id, len(s) as n, unnest(s) as e from sets
), links as materialized (
    select a.doc_id as x, b.doc_id as y from elements a join elements b on a.e = b.e and a.doc_id <> b.doc_id
    group by a.doc_id, b.doc_id, a.n, b.n having 175 * count(*) >= 75 * (a.n + b.n)
), reach as (
    select doc_id, doc_id as c from sets
    union
    select l.y, r.c from reach r join links l on l.x = r.doc_id where r.c < l.y
)
select s.doc_id, len(any_value(s.s)) as n_shingles, min(r.c) as component_id
from sets s join reach r on r.doc_id = s.doc_id group by s.doc_id
"""


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    fourth = fold(F.col("doc_id"), 4)
    rows = score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), fourth != 2)
    return rows.select("doc_id", (fourth == 2).alias("held_out"), "score",
                       (F.col("score") >= 0.7).cast("int").alias("predicted"), "passage", "attention")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(scratch(spark, f"op4_exact_dedup {sf_dir}"), table(spark, sf_dir, "documents"))


OP4_SQL = r"""
with t as (
    select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as body from documents
)
select doc_id, min(doc_id) over g as keep_id, count(*) over g as group_size, doc_id = min(doc_id) over g as kept,
       sha256(body) as text_sha256, count(*) over (partition by doc_id, body) as repeated
from t window g as (partition by body)
"""


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    fifth = fold(F.col("doc_id"), 5)
    rows = find_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), fifth != 0)
    return rows.select("doc_id", (fifth == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
                       F.array_join(F.transform("spans", lambda s: F.concat_ws(
                           ":", s["start"].cast("string"), s["end"].cast("string"))), ",").alias("spans"))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = find_personal_data(table(spark, sf_dir, "documents"))
    base = F.filter("found", lambda s: s["kind"].isin(*BASE))
    return rows.select("doc_id", *[count_of(F.col("found"), k.name).alias(f"n_{k.name}") for k in KINDS],
                       F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("found")).alias("spans"))


def _span_sql(kind: str, pattern: str, valid: str) -> str:
    return f"""
        list_filter(list_transform(range(1, len(m_{kind}) + 1), lambda i: {{
            'v': m_{kind}[i], 'a': right(g_{kind}[i], 48), 'b': left(g_{kind}[i + 1], 24),
            's': list_sum(list_transform(g_{kind}[:i], lambda g: length(g)))::bigint
                 + coalesce(list_sum(list_transform(m_{kind}[:i - 1], lambda m: length(m))), 0)::bigint}}),
            lambda x: {valid}) as f_{kind}"""


# Kind, pattern and condition on a span x with value v, start s, text before a and text after b.
_OP6 = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true"),
    ("ip", r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
     "len(list_filter(string_split(x.v, '.'), lambda p: p::hugeint > 255)) = 0"),
    ("card", r"[0-9](?:[\x20-]?[0-9])+", """length(regexp_replace(x.v, '[^0-9]', '', 'g')) between 16 and 19 and
        list_sum(list_transform(string_split(reverse(regexp_replace(x.v, '[^0-9]', '', 'g')), ''), lambda d, i:
            case when i % 2 = 1 then d::int when d::int > 4 then d::int * 2 - 9 else d::int * 2 end)) % 10 = 0"""),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "length(regexp_replace(x.v, '[^0-9]', '', 'g')) between 8 and 15"),
    ("iban", r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)",
     """not regexp_matches(x.a, '[A-Za-z0-9]$') and not regexp_matches(x.b, '^[A-Za-z0-9]') and
        list_reduce(list_transform(string_split(replace(x.v, ' ', '')[5:] || replace(x.v, ' ', '')[:4], ''),
            lambda c: case when c between '0' and '9' then ascii(c) - 48 else ascii(c) - 55 end),
            lambda s, d: (s * case when d > 9 then 100 else 10 end + d) % 97) = 1"""),
    ("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
     """not regexp_matches(x.a, '[A-Za-z0-9]$') and not regexp_matches(x.b, '^[A-Za-z0-9]')
        and not regexp_matches(x.v, '^(?:000|666|9)|-00-|-0000$')
        and regexp_matches(lower(x.a || ' ' || x.b), '(?:^|[^a-z])(?:ssn|social security|taxpayer)')"""),
)
_listed = "list_transform(f_{0}, lambda x: '{0}:' || x.s || ':' || (x.s + length(x.v)))".format
OP6_SQL = f"""
with m as (
    select doc_id, {", ".join(f"regexp_extract_all(coalesce(text, ''), '{p}') as m_{k}, "
                              f"regexp_split_to_array(coalesce(text, ''), '{p}') as g_{k}" for k, p, _ in _OP6)}
    from documents
), f as (select doc_id, {", ".join(_span_sql(*x) for x in _OP6)} from m)
select doc_id, {", ".join(f"len(f_{k}) as n_{k}" for k, _, _ in _OP6)},
       sha256(array_to_string({" || ".join(_listed(k) for k, _, _ in _OP6[:4])}, ',')) as base_sha256,
       array_to_string({" || ".join(_listed(k) for k, _, _ in _OP6)}, ',') as spans
from f
"""


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    rows = find_benchmark(scratch(spark, f"op7_decontaminate {sf_dir}"), docs, items)
    return rows.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                       (F.col("n_hit") > 0).alias("contaminated"),
                       F.array_join(F.transform("spans", lambda s: F.concat_ws(
                           ":", s["start"].cast("string"), s["end"].cast("string"))), ",").alias("spans"))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(scratch(spark, f"op8_mix_sources {sf_dir}"), table(spark, sf_dir, "documents"))


OP8_SQL = r"""
with rows as (
    select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
           case when length(text) > 0 then greatest(0.1::double, 1 - len(regexp_extract_all(text,
               '[0-9#$%&*+/<=>@\[\\\]^_`{|}~!]'))::double / length(text)) else 0.1::double end as weight
    from documents
), keys as (
    select *, -ln((('0x' || substr(md5('1:' || coalesce(doc_id::varchar, '')), 1, 13))::bigint::double + 0.5)
                  / 4503599627370496) / weight as order_key from rows
), sizes as (
    select source, sum(size)::double as source_size, 3 * sum(size)::double as stop,
           ([5.0, 2.0, 1.0]::double[])[(row_number() over (order by source is null, source) - 1) % 3 + 1] as weight
    from rows group by source
), ranked as (
    select *, row_number() over o as place,
           (sum(source_size) over () - coalesce(sum(stop) over (o rows between unbounded preceding and 1 preceding), 0))
           / (sum(weight) over () - coalesce(sum(weight) over (o rows between unbounded preceding and 1 preceding), 0))
               as level
    from sizes window o as (order by stop / weight, source is null, source)
), targets as (
    select source, source_size, case when stop <= level * weight then stop else weight *
           (select arg_min(level, place) from ranked where stop > level * weight) end as target
    from ranked
), budgets as (
    select *, case when source_size > 0 then floor(target / source_size) else 0 end as epochs from targets
), ends as (
    select k.*, source_size, target, epochs, target - epochs * source_size as budget,
           sum(size) over (partition by k.source order by order_key, doc_id, size rows unbounded preceding) as upto
    from keys k join budgets b on k.source is not distinct from b.source
)
select doc_id, size::bigint as size, source_size::bigint as source_size, target,
       (size * (epochs + case when budget > 0 and upto - size / 2.0 <= budget then 1 else 0 end))::bigint as taken,
       source, weight
from ends
"""

def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = remove_shared_lines(scratch(spark, f"op9_line_dedup {sf_dir}"), table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("text_sha256"))


OP9_SQL = r"""
with lines as (
    select d.rowid as r, x.i, x.line, trim(x.line, chr(32) || chr(9) || chr(11) || chr(12) || chr(13)) as body, site
    from (select row_number() over () as rowid, coalesce(source, chr(1)) as site, coalesce(text, '') as text
          from documents) d,
         unnest(string_split(d.text, chr(10))) with ordinality as x(line, i)
), shared as (
    select body from lines where length(body) > 0 group by body having count(distinct site) >= 5
), docs as (select row_number() over () as r, doc_id from documents)
select d.doc_id, count(*) as n_lines, count(s.body) as n_removed,
       sha256(coalesce(string_agg(l.line, chr(10) order by l.i) filter (s.body is null), '')) as text_sha256
from docs d join lines l on l.r = d.r left join shared s on s.body = l.body
group by d.r, d.doc_id
"""

def op10_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    seventh = fold(F.col("doc_id"), 7)
    rows = lattice_likelihood(scratch(spark, f"op10_lattice_lm {sf_dir}"), docs, seventh != 2)
    return rows.select("doc_id", (seventh == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cluster_vectors(scratch(spark, f"op11_centroids {sf_dir}"), table(spark, sf_dir, "embeddings"))
    digests = F.array(*[F.lit(d) for d in found.digests()]).cast("array<string>")
    return found.rows.withColumn("centroid_sha256", F.get(digests, F.col("cluster")))


def _op11_sql() -> str:
    """The rounds written out one after the other."""
    away = "list_sum(list_transform(range(1, {0} + 1), lambda i: (v[i] - c[i]) * (v[i] - c[i])))::bigint".format(DIMENSIONS)
    steps = [f"""
with kept as materialized (
    select row_number() over () as r, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::double)::bigint) as v
    from embeddings where len(embedding) = {DIMENSIONS}
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), c0 as materialized (
    select (row_number() over (order by h, v)) - 1 as k, v as c
    from (select sha256('{SEED}:' || coalesce(vec_id::varchar, '')) as h, v from kept order by h, v limit {CLUSTERS})
)"""]
    for i in range(ROUNDS + 1):
        steps.append(f"""
a{i} as materialized (
    select r, min({{'d': d, 'k': k}}) as best from (select r, k, {away} as d from kept, c{i}) group by r
)""")
        if i < ROUNDS:
            steps.append(f"""
c{i + 1} as materialized (
    select o.k, coalesce(n.c, o.c) as c from c{i} o left join (
        select k, list(((s - ((s % n) + n) % n) // n)::bigint order by i) as c from (
            select best.k as k, i, sum(x) as s, count(*) as n from (
                select r, unnest(v) as x, unnest(range({DIMENSIONS})) as i from kept) join a{i} using (r) group by 1, 2)
        group by k) n using (k)
)""")
    return ",".join(steps) + f"""
select vec_id, best.k::int as cluster, best.d as distance, sum(best.d) over (partition by best.k)::bigint as cluster_inertia,
       sum(best.d) over ()::bigint as inertia, sha256(array_to_string(c, ',')) as centroid_sha256
from a{ROUNDS} join kept using (r) join c{ROUNDS} on k = best.k
"""


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = encode_documents(table(spark, sf_dir, "documents"))
    ids = ids.withColumns({"n_tokens": F.size("ids").cast("long"),
                           "ids_sha256": F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256)})
    rows = decode_documents(ids, carry=("n_tokens", "ids_sha256"))
    return rows.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(table(spark, sf_dir, "documents")).withColumn("output_sha256", F.sha2("output", 256))
    columns = ("n", "form", "prefix_chars", "middle_chars", "output_sha256")
    rows = restore_middle(made, carry=columns)
    return rows.select("doc_id", *columns, F.sha2("restored", 256).alias("restored_sha256"))


OP13_SQL = r"""
with drawn as (
    select doc_id, coalesce(text, '') as t, sha256('1:' || coalesce(doc_id::varchar, '')) as h from documents
), cut as (
    select doc_id, t, length(t)::bigint as n, ('0x' || h[17:24])::bigint as h3, ('0x' || h[25:32])::bigint as h4,
           ('0x' || h[1:8])::bigint % (length(t) + 1) as x, ('0x' || h[9:16])::bigint % (length(t) + 1) as y
    from drawn
), formed as (
    select *, least(x, y) as a, greatest(x, y) as b,
           case when n = 0 or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90 then 'plain'
                when h4 % 100 < 20 then 'spm' else 'psm' end as form from cut
), parts as (
    select *, substring(t, 1, a) as p, substring(t, a + 1, b - a) as m, substring(t, b + 1) as s from formed
)
select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars, case when form <> 'plain' then b - a end as middle_chars,
       sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
              else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256, sha256(t) as restored_sha256
from parts
"""


QUERIES: dict[str, Query] = {
    "op1_language_id": op1_language_id,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_quality": op3_quality,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_toxicity": op5_toxicity,
    "op6_personal_data": op6_personal_data,
    "op7_decontaminate": op7_decontaminate,
    "op8_mix_sources": op8_mix_sources,
    "op9_line_dedup": op9_line_dedup,
    "op10_lattice_lm": op10_lattice_lm,
    "op11_centroids": op11_centroids,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_fill_in_middle": op13_fill_in_middle,
}

SQL: dict[str, str] = {
    "op2_jaccard_join": OP2_SQL,
    "op4_exact_dedup": OP4_SQL,
    "op6_personal_data": OP6_SQL,
    "op8_mix_sources": OP8_SQL,
    "op9_line_dedup": OP9_SQL,
    "op11_centroids": _op11_sql(),
    "op13_fill_in_middle": OP13_SQL,
}
