"""SQL for DuckDB that computes each named query independently of Spark.

Splits rank all rows with a window, residuals are taken row by row and every
effect is a plain grouped average; nothing here shares the library's shortcuts.
"""

from __future__ import annotations

AS_OF_YEAR = 2020

# The label vocabulary of the items view.
LABELS = [
    "ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD", "anvil", "blue", "bolt", "cold", "gear", "gizmo",
    "hot", "large", "new", "old", "plate", "red", "ring", "rod", "small", "widget", "(no genres listed)",
]
FLAG_NAMES = [
    "is_economy", "is_large", "is_medium", "is_promo", "is_small", "is_standard", "is_anvil", "is_blue", "is_bolt",
    "is_cold", "is_gear", "is_gizmo", "is_hot", "is_large_2", "is_new", "is_old", "is_plate", "is_red", "is_ring",
    "is_rod", "is_small_2", "is_widget", "is_nogenreslisted",
]

ITEMS = """
items as materialized (
  select p_partkey as item_id,
         p_name || case when p_partkey % 6 = 0 then ': ' || p_type else '' end
                || case when p_partkey % 50 = 7 then ''
                        else ' (' || cast(1950 + p_size as varchar) || ')' end as title,
         case when p_partkey % 41 = 0 then '(no genres listed)'
              else concat_ws('|', p_type,
                     case when p_partkey % 2 = 0 then split_part(p_name, ' ', 1) end,
                     case when p_partkey % 3 = 0 then split_part(p_name, ' ', 2) end) end as genres
  from part
)"""


def ratings_cte(sparse: bool = False) -> str:
    user = "l_orderkey" if sparse else "o_custkey"
    return f"""
ratings as materialized (
  select {user} as user_id,
         case when l_partkey % 97 = 0 then -1 - l_partkey else l_partkey end as item_id,
         cast(least(10, greatest(1, ceil(l_quantity / 10) + (l_partkey % 7) - 3
              + (o_custkey % 5) - 2 + (year(l_shipdate) % 3) - 1 + 2)) as double) / 2 as rating,
         cast(epoch(l_shipdate) as bigint) as ts,
         concat_ws(':', cast(l_orderkey as varchar), cast(l_linenumber as varchar),
                   cast(l_partkey as varchar), cast(l_suppkey as varchar),
                   cast(cast(l_quantity as bigint) as varchar)) as row_key
  from lineitem join orders on l_orderkey = o_orderkey
)"""


JOINED = """
joined as materialized (
  select r.*, i.title, i.genres from ratings r left join items i on r.item_id = i.item_id
)"""

NUM = "cast(len(genres) - len(replace(genres, '|', '')) + 1 as int)"
RELEASE = r"try_cast(nullif(regexp_extract(title, '\(([0-9]{4})\)', 1), '') as int)"
AGE = f"(({AS_OF_YEAR} - release_year) - ((({AS_OF_YEAR} - release_year) % 5) + 5) % 5)"
YEAR = "cast(year(epoch_ms(ts * 1000)) as int)"
FLAGS = "[" + ", ".join(f"cast(contains(genres, '{label}') as int)" for label in LABELS) + "]"

FEATURES = f"""
feat0 as materialized (
  select item_id, {FLAGS} as flags, {NUM} as num_genre, {RELEASE} as release_year, contains(title, ':') as sequel
  from items
),
feat as materialized (select *, cast({AGE} as int) as age_group from feat0)"""


def split_ctes(source: str, names: tuple[str, str, str, str], seed: int, fraction: float, add_back: bool) -> str:
    """CTEs for drawn, rest, kept hold-out and final train of one split of ``source``."""
    drawn, rest, kept, train = names
    back = (
        f"select * from {rest} union all select * from {drawn} where row_key not in (select row_key from {kept})"
        if add_back
        else f"select * from {rest}"
    )
    return f"""
{drawn}_q as materialized (
  select list_sort(list_distinct(quantile_cont(rating, [0, 0.25, 0.5, 0.75, 1]))) as qs from {source}
),
{drawn}_s as materialized (
  select s.*, md5(concat_ws(':', '{seed}', row_key)) as h,
         len(list_filter(qs[2:len(qs) - 1], lambda q: q < rating)) as stratum
  from {source} s, {drawn}_q
),
{drawn}_r as materialized (
  select *, row_number() over (partition by stratum order by h)
            <= ceil(count(*) over (partition by stratum) * cast({fraction} as double)) as held
  from {drawn}_s
),
{drawn} as materialized (select user_id, item_id, rating, ts, row_key from {drawn}_r where held),
{rest} as materialized (select user_id, item_id, rating, ts, row_key from {drawn}_r where not held),
{kept} as materialized (
  select * from {drawn} where item_id in (select item_id from {rest}) and user_id in (select user_id from {rest})
),
{train} as materialized ({back})"""


OUTER = split_ctes("ratings", ("drawn1", "rest1", "validation", "work"), 1, 0.1, True)
INNER = split_ctes("work", ("drawn2", "rest2", "test", "train"), 42, 0.2, False)


# Predictions of the first three models for a hold-out as it was drawn.
KNOWN = """
mean as materialized (select avg(rating) as mu from train),
by_item as materialized (select item_id, avg(rating - mu) as item_effect from train, mean group by 1),
by_user as materialized (
  select user_id, avg(rating - mu - item_effect) as user_effect from train join by_item using (item_id), mean group by 1
),
known as materialized (
  select rating, mu as p1, mu + item_effect as p2, mu + item_effect + user_effect as p3
  from drawn2 left join by_item using (item_id) left join by_user using (user_id), mean
)"""


def _known_rmse(model: str) -> str:
    return _r6(f"sqrt(avg((rating - p{model}) * (rating - p{model})))")


def ladder_ctes(train: str, test: str) -> str:
    """CTEs of the whole ladder; ``scored`` has the rows of ``test`` with one prediction per model."""
    lab = ",\n  ".join(
        f"max(effect) filter (position = {i} and flag = 1) as y{i}, "
        f"max(effect) filter (position = {i} and flag = 0) as n{i}, "
        f"max(effect) filter (position = {i} and flag is null) as u{i}"
        for i in range(1, len(LABELS) + 1)
    )
    score = " + ".join(
        f"(case when flags[{i}] = 1 then y{i} when flags[{i}] = 0 then n{i} else u{i} end)"
        for i in range(1, len(LABELS) + 1)
    )
    grp = "case when genre_score is null then null else cast(1 + len(list_filter(b[2:len(b) - 1], lambda x: x < genre_score)) as int) end"

    def widened(name: str, source: str) -> str:
        return f"""
{name} as materialized (
  select t.*, {YEAR} as year_stamp, flags, num_genre, release_year, age_group, sequel
  from {source} t left join feat f on t.item_id = f.item_id
)"""

    def grouped(name: str, source: str) -> str:
        return f"""
{name}_p as materialized (select distinct flags from {source}),
{name}_v as materialized (select flags, {score} as genre_score from {name}_p, lab),
{name}_s as materialized (
  select t.*, genre_score from {source} t join {name}_v v on t.flags is not distinct from v.flags
),
{name}_l as materialized (
  select list_sort(list(genre_score)) as v from {name}_s where genre_score is not null
),
{name}_b as materialized (
  select list_transform(range(0, 11), lambda i: v[(len(v) - 1) * i // 10 + 1]
    + (v[least((len(v) - 1) * i // 10 + 2, len(v))] - v[(len(v) - 1) * i // 10 + 1])
      * (cast((len(v) - 1) * i % 10 as double) / 10)) as b
  from {name}_l
),
{name} as materialized (select s.*, {grp} as "group" from {name}_s s, {name}_b)"""

    parts = [
        widened("tr0", train),
        widened("te0", test),
        "mu as materialized (select avg(rating) as m from tr0)",
        """
e_item as materialized (
  select item_id, avg(rating - m) as effect_item, count(*) as n from tr0, mu group by item_id
)""",
        """
e_user as materialized (
  select user_id, avg(rating - m - effect_item) as effect_user, count(*) as n
  from tr0 join e_item using (item_id), mu group by user_id
)""",
        """
tr3 as materialized (
  select t.*, rating - m - effect_item - effect_user as r3
  from tr0 t join (select item_id, effect_item from e_item) using (item_id)
             join (select user_id, effect_user from e_user) using (user_id), mu
)""",
        f"""
vocabulary as (select unnest({LABELS!r}) as label, unnest(generate_series(1, {len(LABELS)})) as position),
tr3l as (
  select r3, coalesce(flags, list_resize(cast([] as int[]), {len(LABELS)}, null)) as flags from tr3
),
e_label as materialized (
  select cast(position as int) as position, label, flags[position] as flag, avg(r3) as effect, count(*) as n
  from tr3l, vocabulary group by 1, 2, 3
)""",
        f"lab as materialized (select {lab} from e_label)",
        grouped("tr4", "tr3"),
        grouped("te4", "te0"),
    ]
    rungs = [
        ("group", '"group"', "r3", "tr4"),
        ("num", "num_genre", "r4", "tr5"),
        ("age", "age_group", "r5", "tr6"),
        ("release", "release_year", "r5", "tr6"),
        ("sequel", "sequel", "r6", "tr7"),
        ("year", "year_stamp", "r7", "tr8"),
    ]
    carried = {"group": ("tr5", "tr4", "r3", "r4"), "num": ("tr6", "tr5", "r4", "r5"),
               "release": ("tr7", "tr6", "r5", "r6"), "sequel": ("tr8", "tr7", "r6", "r7")}
    for name, key, residual, source in rungs:
        parts.append(
            f"e_{name} as materialized (select {key}, avg({residual}) as effect_{name}, count(*) as n "
            f"from {source} group by 1)"
        )
        if name in carried:
            target, before, old, new = carried[name]
            bare = key.strip('"')
            parts.append(
                f"{target} as materialized (select t.*, t.{old} - e.effect_{name} as {new} from {before} t "
                f'left join e_{name} e on t."{bare}" is not distinct from e."{bare}")'
            )
    joins = "\n  ".join(
        f'left join e_{name} on t."{key}" is not distinct from e_{name}."{key}"'
        for name, key in (
            ("item", "item_id"), ("user", "user_id"), ("group", "group"), ("num", "num_genre"), ("age", "age_group"),
            ("release", "release_year"), ("sequel", "sequel"), ("year", "year_stamp"),
        )
    )
    parts.append(f"""
scored as materialized (
  select t.row_key, t.rating,
         m as p1,
         m + effect_item as p2,
         m + effect_item + effect_user as p3,
         m + effect_item + effect_user + effect_group as p4,
         m + effect_item + effect_user + effect_group + effect_num as p5,
         m + effect_item + effect_user + effect_group + effect_num + effect_age as p6a,
         m + effect_item + effect_user + effect_group + effect_num + effect_release as p6b,
         m + effect_item + effect_user + effect_group + effect_num + effect_release + effect_sequel as p7,
         m + effect_item + effect_user + effect_group + effect_num + effect_release + effect_sequel
           + effect_year as p8
  from te4 t {joins}, mu
)""")
    return ",\n".join(part.strip() for part in parts)


MODEL_TITLES = {
    "1": "mean",
    "2": "mean + item",
    "3": "mean + item + user",
    "4": "mean + item + user + group",
    "5": "mean + item + user + group + num",
    "6a": "mean + item + user + group + num + age",
    "6b": "mean + item + user + group + num + release",
    "7": "mean + item + user + group + num + release + sequel",
    "8": "mean + item + user + group + num + release + sequel + year",
}


def _with(*ctes: str, select: str) -> str:
    return "with " + ",\n".join(cte.strip() for cte in ctes) + "\n" + select.strip()


def _r6(expression: str) -> str:
    """Six decimals without summation noise at an exact half, and without a negative zero."""
    return f"round(round({expression}, 12), 6) + 0.0"


# Six significant digits of each error, and the decimals that show them without zeros at the end.
DISPLAY_FROM = """errors as ({errors}),
places as (
    select model, title, rmse, length(rtrim(replace(split_part(printf('%.5e', rmse), 'e', 1), '.', ''), '0')) - 1
           - cast(split_part(printf('%.5e', rmse), 'e', 2) as integer) as decimals from errors
)"""


def _rmse(model: str) -> str:
    return (
        f"case when count(p{model}) = count(*) then {_r6(f'sqrt(avg((rating - p{model}) * (rating - p{model})))')} end"
    )


def _histogram(source: str, value: str, bins: str, weight: str = "1") -> str:
    """Equal-width counts of ``value`` over rows of ``source``."""
    return f"""
hv as materialized (select cast({value} as double) as v, {weight} as w from {source} where {value} is not null),
hr as materialized (select min(v) as lo, max(v) as hi, sum(w) as n from hv),
hb as materialized (select lo, hi, {bins} as bins, (hi - lo) / ({bins}) as width from hr),
hc as materialized (
  select least(bins - 1, floor((v - lo) / width)) as bin, sum(w) as n from hv, hb group by 1
),
hist as (
  select cast(g.bin as int) as bin, {_r6("lo + g.bin * width")} as lower, {_r6("lo + (g.bin + 1) * width")} as upper,
         cast(coalesce(n, 0) as bigint) as count
  from hb, lateral (select unnest(range(cast(bins as bigint))) as bin) g left join hc on hc.bin = g.bin
)"""


STURGES = "cast(ceil(log2(n) + 1) as bigint)"


def all_sql() -> dict[str, str]:
    ratings, sparse = ratings_cte(), ratings_cte(True)
    base = (ITEMS, ratings)
    wide = (ITEMS, ratings, JOINED)
    outer = (ITEMS, ratings, OUTER)
    inner = (ITEMS, ratings, OUTER, INNER)
    sparse_outer = (ITEMS, sparse, OUTER)
    sparse_inner = (ITEMS, sparse, OUTER, INNER)
    train_features = (*inner, FEATURES, f"""
trf as materialized (
  select t.*, num_genre, release_year, age_group, sequel from train t left join feat f on t.item_id = f.item_id
)""")
    ladder = (*inner, FEATURES, ladder_ctes("train", "test"))
    final = (*outer, FEATURES, ladder_ctes("work", "validation"))
    flags = ", ".join(
        f"cast(contains(genres, '{label}') as int) as {name}" for label, name in zip(LABELS, FLAG_NAMES)
    )
    patterns = ", ".join(
        f"cast(regexp_matches(genres, '{label}') as int) as {name}" for label, name in zip(LABELS, FLAG_NAMES)
    )
    tokens = ", ".join(
        f"cast(list_contains(string_split(genres, '|'), '{label}') as int) as {name}"
        for label, name in zip(LABELS, FLAG_NAMES)
    )
    counts = """
select 'rows' as part, count(*) as n from ratings
union all select 'drawn', count(*) from drawn1
union all select 'validation', count(*) from validation
union all select 'given_back', (select count(*) from drawn1) - count(*) from validation
union all select 'work', count(*) from work
union all select 'train', count(*) from train
union all select 'test_drawn', count(*) from drawn2
union all select 'test', count(*) from test"""
    sides1 = "select row_key, 'work' as side from work union all select row_key, 'validation' from validation"
    sides2 = "select row_key, 'train' as side from train union all select row_key, 'test' from test"
    sql = {
        "read_ratings": _with(*base, select="select user_id, item_id, rating, ts from ratings"),
        "read_items": _with(*base, select="select item_id, title, genres from items"),
        "describe_schema": _with(*wide, select="""
select cast(position as int) as position, name, type, (select count(*) from joined) as rows
from (values (1, 'user_id', 'bigint'), (2, 'item_id', 'bigint'), (3, 'rating', 'double'), (4, 'ts', 'bigint'),
             (5, 'row_key', 'string'), (6, 'title', 'string'), (7, 'genres', 'string')) c(position, name, type)"""),
        "ratings_joined": _with(*wide, select="select row_key, user_id, item_id, rating, title, genres from joined"),
        "features": _with(*base, FEATURES, select=f"""
select row_key, num_genre, release_year, age_group, sequel, {YEAR} as year_stamp
from ratings r left join feat f on r.item_id = f.item_id"""),
        "label_flags": _with(*wide, select=f"select row_key, {flags} from joined"),
        "label_flags_token": _with(*wide, select=f"select row_key, {tokens} from joined"),
        "label_flags_regex": _with(*wide, select=f"select row_key, {patterns} from joined"),
        "label_count": _with(ITEMS, select=f"select item_id, {NUM} as num_genre from items"),
        "release_year": _with(ITEMS, select=f"select item_id, {RELEASE} as release_year from items"),
        "age_group": _with(ITEMS, FEATURES, select="select item_id, age_group from feat"),
        "sequel_flag": _with(ITEMS, select="select item_id, contains(title, ':') as sequel from items"),
        "rating_year": _with(ratings, select=f"select row_key, {YEAR} as year_stamp from ratings"),
        "split_holdout": _with(*outer, select=sides1),
        "split_holdout_sparse": _with(*sparse_outer, select=sides1),
        "split_test": _with(*inner, select=sides2),
        "split_test_sparse": _with(*sparse_inner, select=sides2),
        "split_counts": _with(*inner, select=counts),
        "split_counts_sparse": _with(*sparse_inner, select=counts),
        "holdout_semi": _with(*sparse_outer, select="select * from validation"),
        "holdout_removed": _with(*sparse_outer, select="""
select d.* from drawn1 d
where not exists (select 1 from validation v where v.user_id is not distinct from d.user_id
  and v.item_id is not distinct from d.item_id and v.rating is not distinct from d.rating
  and v.ts is not distinct from d.ts and v.row_key is not distinct from d.row_key)"""),
        "sample_keys": _with(*outer, select="""
select user_id from (select distinct user_id from work) order by md5(concat_ws(':', '7', user_id)) limit 10"""),
        "shuffle_keys": _with(*outer, select="""
select item_id, row_number() over (order by md5(concat_ws(':', '7', item_id))) as position
from (select distinct item_id from work)"""),
        "preview": _with(*outer, select="""
select e.*, title, genres from (select * from work order by row_key limit 6) e
left join items i on e.item_id = i.item_id"""),
        "distinct_counts": _with(*outer, select="""
select count(distinct user_id) as unique_users, count(distinct item_id) as unique_items from work"""),
        "ratings_per_item": _with(*outer, select="select item_id, count(*) as num_ratings from work group by 1"),
        "ratings_per_user": _with(*outer, select="select user_id, count(*) as num_ratings from work group by 1"),
        "hist_item_counts": _with(
            *outer, "c as (select item_id, count(*) as k from work group by 1)", _histogram("c", "k", "30"),
            select="select * from hist"),
        "hist_user_counts": _with(
            *outer, "c as (select user_id, count(*) as k from work group by 1)", _histogram("c", "k", "40"),
            select="select * from hist"),
        "hist_release_year": _with(
            *train_features, _histogram("trf", "release_year", STURGES), select="select * from hist"),
        "release_year_range": _with(*train_features, select="""
select case when count(release_year) = count(*) then min(release_year) end as lowest,
       case when count(release_year) = count(*) then max(release_year) end as highest, 'propagate' as na from trf
union all select min(release_year), max(release_year), 'skip' from trf"""),
        "freq_age_group": _with(*train_features, select="""
select age_group, count(*) as count from trf where age_group is not null group by 1 order by 1"""),
        "freq_sequel": _with(*train_features, select="""
select sequel, count(*) as count from trf where sequel is not null group by 1 order by 1"""),
        "label_vocabulary": _with(*outer, select="""
select distinct unnest(string_split(genres, '|')) as label
from work join items using (item_id)"""),
        "sequel_titles": _with(*inner, select="""
select title from train t join items i on t.item_id = i.item_id
where contains(title, ':') order by row_key limit 20"""),
        "sparse_pivot": _with(*outer, """
u as (select user_id from (select distinct user_id from work) order by md5(concat_ws(':', '7', user_id)) limit 10),
r as materialized (select user_id, item_id, rating from work where user_id in (select user_id from u)),
p as materialized (
  select item_id, row_number() over (order by md5(concat_ws(':', '7', item_id))) as k
  from (select distinct item_id from r)
)""", select="""
select user_id, max(rating) filter (k = 1) as pick_1, max(rating) filter (k = 2) as pick_2,
       max(rating) filter (k = 3) as pick_3, max(rating) filter (k = 4) as pick_4
from r join p using (item_id) group by user_id"""),
        "apply_effect": _with(*base, FEATURES, f"""
w as materialized (
  select row_key, rating, release_year from ratings r left join feat f on r.item_id = f.item_id
),
m as (select avg(rating) as m from w),
e as materialized (select release_year, avg(rating - m) as effect from w, m group by 1)""", select=f"""
select row_key, w.release_year, {_r6('effect')} as effect_release
from w left join e on w.release_year is not distinct from e.release_year"""),
        "label_effects": _with(*ladder, select=f"""
select position, label, flag, {_r6('effect')} as effect, n from e_label"""),
        "label_score": _with(*ladder, select=f"""
select item_id, {_r6(_label_score())} as genre_score from feat, lab"""),
        "score_breaks": _with(*ladder, select=f"""
select cast(i as int) as position, {_r6('b[i + 1]')} as score_break
from tr4_b, lateral (select unnest(range(len(b))) as i)"""),
        "score_group": _with(*ladder, select="""
select 'train' as side, item_id, "group", count(*) as n from tr4 group by 1, 2, 3
union all select 'test', item_id, "group", count(*) from te4 group by 1, 2, 3"""),
        "score_group_train_binning": _with(*ladder, select="""
select item_id, case when genre_score is null then null
       else cast(1 + len(list_filter(b[2:len(b) - 1], lambda x: x < genre_score)) as int) end as "group", count(*) as n
from te4_s, tr4_b group by 1, 2"""),
        "freq_group": _with(*ladder, select="""
select "group", count(*) as count from tr4 where "group" is not null group by 1 order by 1"""),
        "hist_label_score": _with(
            *ladder, _histogram("tr4", "genre_score", STURGES), select="select * from hist"),
        "rmse_table": _with(*ladder, select="\nunion all ".join(
            f"select '{m}' as model, '{MODEL_TITLES[m]}' as title, {_rmse(m)} as rmse from scored"
            for m in ("1", "2", "3", "4", "5", "6b", "7", "8"))),
        "rmse_display": _with(*ladder, DISPLAY_FROM.format(errors="\nunion all ".join(
            f"select '{m}' as model, '{MODEL_TITLES[m]}' as title, case when count(p{m}) = count(*) "
            f"then round(sqrt(avg((rating - p{m}) * (rating - p{m}))), 12) end as rmse from scored"
            for m in ("1", "2", "3", "4", "5", "6b", "7", "8"))), select=(
                "select model, title, printf('%.' || greatest(0, max(decimals) over ()) || 'f', rmse) as rmse from places")),
        "rmse_skip": _with(*sparse_inner, KNOWN, select="\nunion all ".join(
            f"select '{m}' as model, {_known_rmse(m)} as rmse, count(p{m}) as scored from known" for m in "123")),
        "rmse_unrepaired": _with(*sparse_inner, KNOWN, select="\nunion all ".join(
            f"select '{m}' as model, case when count(p{m}) = count(*) then {_known_rmse(m)} end as rmse, "
            f"count(p{m}) as scored from known" for m in "123")),
        "rmse_aggregate": _with(*final, select=f"select {_rmse('8')} as rmse from scored"),
        "final_rmse": _with(*final, select=f"select '8' as model, {_rmse('8')} as rmse, count(p8) as scored from scored"),
        "final_predictions": _with(*final, select=f"select row_key, rating, {_r6('p8')} as prediction from scored"),
        "global_mean": _with(ratings, select=f"select {_r6('avg(rating)')} as average from ratings"),
    }
    for name, key in (
        ("item", "item_id"), ("user", "user_id"), ("group", '"group"'), ("num", "num_genre"), ("age", "age_group"),
        ("release", "release_year"), ("sequel", "sequel"), ("year", "year_stamp"),
    ):
        sql[f"effect_{name}"] = _with(*ladder, select=f"""
select {key}, {_r6(f'effect_{name}')} as effect_{name}, n from e_{name}""")
    for name, model in (
        ("model1_mean", "1"), ("model2_item", "2"), ("model3_user", "3"), ("model4_group", "4"), ("model5_num", "5"),
        ("model6a_age", "6a"), ("model6b_release", "6b"), ("model7_sequel", "7"), ("model8_year", "8"),
    ):
        sql[name] = _with(*ladder, select=f"""
select '{model}' as model, {_rmse(model)} as rmse, count(p{model}) as scored from scored""")
    return sql


def _label_score() -> str:
    return " + ".join(
        f"(case when flags[{i}] = 1 then y{i} when flags[{i}] = 0 then n{i} else u{i} end)"
        for i in range(1, len(LABELS) + 1)
    )
